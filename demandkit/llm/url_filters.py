"""URL lists that change over time, joined with captures as of their fetch time.

A list is a feed of dated entries ``(list, pattern, dated, verdict)``. Each entry holds from its
date until the next entry of the same list and pattern; verdict ``none`` ends it. A pattern is a
host or a parent domain (``example.com``), or a host with a path prefix that ends in a slash
(``www.example.com/a/``). Validity intervals are cut at months, so that the join is on pattern and
month: a host with a third of all captures and a daily change does not meet all its changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from demandkit.llm.common import unused

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def url_host(url: Column) -> Column:
    """Lower-cased host without user and port; empty where the text is no absolute URL."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def url_patterns(url: Column) -> Column:
    """Every pattern that covers the URL: its host, parent domains of two labels or more, path prefixes."""
    labels = F.split(url_host(url), r"\.")
    tops = F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1)))
    domains = F.transform(tops, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1), "/")
    # a path /a/b/c has the parts '', a, b, c; what follows the last slash is no prefix
    ends = F.when(F.size(parts) > 2, F.sequence(F.lit(2), F.size(parts) - 1)).otherwise(F.array().cast("array<int>"))
    prefixes = F.transform(ends, lambda i: F.concat(url_host(url), F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))
    return F.when(url_host(url) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, prefixes)))


def _month(day: Column | str) -> Column:
    return F.year(day) * 12 + F.month(day)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``(list, pattern, valid_from, valid_to, verdict)``; ``valid_to`` is null for the last entry.

    Of several entries of one list, pattern and time the largest verdict by name holds. Entries
    without a date or pattern are void. A window partition has one row per time of change.
    """
    once = entries.where("dated IS NOT NULL AND pattern IS NOT NULL").groupBy("list", "pattern", "dated").agg(
        F.max("verdict").alias("verdict")
    )
    following = F.lead("dated").over(Window.partitionBy("list", "pattern").orderBy("dated"))
    return once.select("list", "pattern", F.col("dated").alias("valid_from"), following.alias("valid_to"), "verdict").where(
        "verdict <> 'none'"
    )


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with ``verdict``, ``list``, ``pattern`` and ``valid_from`` of the entry that decides.

    Of the entries active at the fetch time the longest pattern decides, then ``allow`` before
    ``block``, then the list first by name. Captures that no entry covers, or without a URL or fetch
    time, have the verdict ``none`` and nulls. All rows stay, repeated ones too; input columns named
    like the four results are replaced. Verdicts are found once per distinct URL and time.
    """
    made = ["verdict", "list", "pattern", "valid_from"]
    kept = captures.drop(*[c for c in captures.columns if c.lower() in made])
    asked = kept.select(F.col(url).alias("_url"), F.col(fetched).alias("_at")).dropna().distinct()
    span = asked.agg(F.min(_month("_at")), F.max(_month("_at"))).first()
    low, high = (F.lit(x if x is not None else 0) for x in span)
    first = F.greatest(_month("valid_from"), low)
    last = F.least(F.coalesce(_month("valid_to"), high), high)
    pieces = validity_intervals(entries).where(first <= last).select(
        "*", F.explode(F.sequence(first, last)).alias("_month")
    )
    wide = asked.select("_url", "_at", _month("_at").alias("_month"), F.explode(url_patterns(F.col("_url"))).alias("pattern"))
    active = (F.col("valid_from") <= F.col("_at")) & (F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to")))
    met = wide.join(pieces, ["pattern", "_month"]).where(active)
    # min_by over (shortest last, block last, later name last)
    order = F.struct(-F.length("pattern"), (F.col("verdict") != "allow").cast("int"), F.col("list"))
    decided = met.groupBy("_url", "_at").agg(F.min_by(F.struct(*made), order).alias("_d"))
    url_of, at_of, chosen = (unused(kept, x) for x in ("_u", "_t", "_d"))
    decided = decided.select(F.col("_url").alias(url_of), F.col("_at").alias(at_of), F.col("_d").alias(chosen))
    found = kept.join(decided, (kept[url] == F.col(url_of)) & (kept[fetched] == F.col(at_of)), "left")
    verdict = F.coalesce(F.col(chosen)["verdict"], F.lit("none")).alias("verdict")
    return found.select(*[kept[c] for c in kept.columns], verdict, *[F.col(chosen)[c].alias(c) for c in made[1:]])
