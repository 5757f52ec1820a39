"""Scalar column expressions. Flags are always 0/1 and never null."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

RAISE = "raise"


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as false."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def member_flag(col: Column, values: Iterable) -> Column:
    return flag(col.isin(list(values)))


def all_flag(*conditions: Column) -> Column:
    return flag(reduce(lambda a, b: a & b, conditions))


def case_label(col: Column, rules: Sequence[tuple[str, str]], present: str, absent: str) -> Column:
    """Label of the first substring found; ``present``/``absent`` cover the rest."""
    label = F.when(col.isNull(), F.lit(absent))
    for text, name in rules:
        label = label.when(col.contains(text), F.lit(name))
    return label.otherwise(F.lit(present))


def presence_flag(col: Column, non_empty: bool = False) -> Column:
    present = col.isNotNull()
    return flag(present & (col != "") if non_empty else present)


def presence_label(col: Column, present: str, absent: str) -> Column:
    return F.when(col.isNotNull(), F.lit(present)).otherwise(F.lit(absent))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``; null when ``whole`` is zero."""
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def improvement_percent(before: Column, after: Column) -> Column:
    return percent(before - after, before)


def clip(col: Column, low=None, high=None) -> Column:
    """Bound ``col``; null stays null (``greatest`` alone would skip it)."""
    bounded = col
    if low is not None:
        bounded = F.greatest(bounded, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        bounded = F.least(bounded, high if isinstance(high, Column) else F.lit(high))
    return F.when(col.isNotNull(), bounded)


def round_even(col: Column) -> Column:
    """Nearest integer, halves to the even neighbour."""
    return F.bround(col, 0).cast("long")


def parse_number(col: Column) -> Column:
    """Text to double; text that is no number becomes null."""
    return col.try_cast("double")


def sentinel_number(col: Column, sentinels: Iterable[str], sentinel_to: str) -> Column:
    """Numeric text with sentinels that mean zero (``"zero"``) or unknown (``"null"``)."""
    if sentinel_to not in ("zero", "null"):
        raise ValueError("sentinel_to must be 'zero' or 'null'")
    cleaned = F.when(col.isin(list(sentinels)), F.lit("0" if sentinel_to == "zero" else None))
    return parse_number(cleaned.otherwise(col))


def replace_value(col: Column, old, new) -> Column:
    return F.when(col == F.lit(old), F.lit(new)).otherwise(col)


def replace_first(col: Column, old: str, new: str) -> Column:
    """Replace the first occurrence of a literal substring."""
    safe = new.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(col, f"(?s)^(.*?){re.escape(old)}", f"$1{safe}")


def map_values(col: Column, mapping: Mapping, default=None) -> Column:
    """Look ``col`` up in a small literal map.

    ``default`` is the value for unmapped entries (null included); ``RAISE`` makes an
    unmapped non-null entry an error. Use a lookup join for maps that grow with the data.
    """
    entries = [F.lit(part) for pair in mapping.items() for part in pair]
    found = F.element_at(F.create_map(*entries), col)
    if default == RAISE:
        message = F.concat(F.lit("unmapped value: "), col.cast("string"))
        return F.when(col.isNotNull() & found.isNull(), F.raise_error(message)).otherwise(found)
    return found if default is None else F.coalesce(found, F.lit(default))


def cyclical(col: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a position on a circle of ``period`` steps."""
    angle = col * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def row_sum(cols: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)
