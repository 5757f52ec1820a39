"""Documents put into shards of equal row counts by balanced label propagation.

Equal texts are linked. What moves is a cell: a few copies of one text that lie in one shard. Each
round, every cell looks by a join at where the other cells of its text are and asks for the shard
with room that holds most of them; a shard admits cells up to its free quota, by a hash drawn per cell and
round, so that no list of requests is ever ranked in one place. Cells stop where their text already
has its majority. A text with more copies than a shard holds stays spread over several. At the end
the rows are numbered inside the shards, linked ones first, and the surplus of each shard, which is
made of unlinked documents while there are any, then of texts too large for one shard, fills the
gaps of the others, text by text: counts then differ by one at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from demandkit.llm.common import checkpointed

SHARDS = 8
ROUNDS = 8
#: Cells of one text that start in one shard, at most; a text with many copies moves in such parts.
PARTS = 8
#: Quota of a shard while labels move, in equal shares; what is beyond one share moves at the end.
SLACK = 1.1
#: Rows that one window partition numbers, about.
STRETCH_ROWS = 50_000


def _case(key: Column, values: Sequence[float], kind: str) -> Column:
    """One literal per shard: the number of shards is small and fixed."""
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), key + 1)


def _loads(cells: DataFrame, shards: int) -> list[int]:
    found = {r[0]: r[1] for r in cells.groupBy("shard").agg(F.sum("n")).collect()}
    return [int(found.get(s) or 0) for s in range(shards)]


def _shares(loads: Sequence[int], wishes: Sequence[Sequence[int]], capacity: int) -> list[float]:
    """The part of the requests for each shard that it can admit, given what leaves it meanwhile."""
    shares = [1.0] * len(loads)
    asked = [sum(w[to] for w in wishes) for to in range(len(loads))]
    for _ in range(50):
        leaving = [sum(w * s for w, s in zip(row, shares)) for row in wishes]
        free = [max(0.0, capacity - load + out) for load, out in zip(loads, leaving)]
        shares = [min(1.0, f / a) if a else 0.0 for f, a in zip(free, asked)]
    return shares


def _draw(*parts: Column | int) -> Column:
    """A number in [0, 1) from a hash: the same in every run and for every recomputed task."""
    hashed = F.xxhash64(*[F.lit(p) if isinstance(p, int) else p for p in parts])
    return F.pmod(hashed, F.lit(1 << 40)) / F.lit(float(1 << 40))


def propagate(cells: DataFrame, capacity: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``cells(a, b, home, shard, n, copies)`` with ``shard`` moved towards the other cells of ``(a, b)``.

    Ends after ``rounds`` or when no cell moves. No shard is filled beyond ``capacity`` by more than
    the hash draw strays from its mean; the final numbering takes that away again.
    """
    cells = checkpointed(cells)
    for turn in range(rounds):
        loads = _loads(cells, shards)
        held = cells.groupBy("a", "b", "shard").agg(F.sum("n").alias("held"), F.min("n").alias("least"))
        # where most copies are and a cell still fits; ties go by a hash, so that no shard is favoured
        load = _case(F.col("shard"), loads, "long")
        fits = (F.col("held") + F.col("least") <= capacity) & (load < capacity)
        room = F.when(fits, F.col("held")).otherwise(0)
        tie = F.xxhash64("a", "b", "shard")
        spot = F.struct(room.alias("held"), tie.alias("tie"), "shard")
        target = held.groupBy("a", "b").agg(
            F.max(spot).alias("best"), F.count(F.lit(1)).alias("places")
        )
        target = target.where("places > 1").select("a", "b", "best")
        own = held.select("a", "b", "shard", F.struct(F.col("held"), tie.alias("tie"), "shard").alias("own"))
        # a cell leaves only for a shard that holds more of its text than its own shard does
        better = (F.col("own") < F.col("best")) & (F.col("best.held") + F.col("n") <= capacity)
        asked = cells.join(own, ["a", "b", "shard"]).join(target, ["a", "b"], "left")
        # a text that is cut between full shards goes to the emptiest one as a whole
        crowded = (F.col("best.held") == 0) & (F.col("copies") <= capacity)
        to = F.when(crowded, loads.index(min(loads))).when(better, F.col("best.shard")).otherwise(F.col("shard"))
        asked = asked.withColumn("to", to)
        wishes = [[0] * shards for _ in range(shards)]
        for r in asked.where("`to` <> shard").groupBy("shard", "to").agg(F.sum("n").alias("n")).collect():
            wishes[r.shard][r.to] = r.n  # at most a row for each pair of shards
        if not any(map(sum, wishes)):
            break
        share = _shares(loads, wishes, capacity)
        # cells of one text draw together, so that a text moves whole, unless it fits in no shard
        alone = F.when(F.col("copies") > capacity, F.col("home"))
        admitted = _draw(F.col("a"), F.col("b"), alone, turn) < _case(F.col("to"), share, "double")
        moved = F.when(admitted, F.col("to")).otherwise(F.col("shard")).alias("shard")
        cells = checkpointed(asked.select("a", "b", "home", moved, "n", "copies"))
    return cells


def _numbered(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` with ``place``, counting from 0 in each shard, in the order of ``loose``.

    Rows are dealt to stretches by hash, firmly linked ones (``loose`` = 0) with their text; counts
    per stretch are added up, and only rows of one stretch are numbered together. A text with more
    copies than a stretch has rows takes several of its own, one behind the other.
    """
    stretches = max(1, -(-total // STRETCH_ROWS))
    stretch = F.pmod(F.xxhash64(F.lit(7), "a", "b", F.when(F.col("loose") > 0, F.col("doc_id"))), F.lit(stretches))
    large = (F.col("loose") == 0) & (F.col("copies") > STRETCH_ROWS)
    part = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.ceil(F.col("copies") / F.lit(STRETCH_ROWS)))
    rows = rows.withColumns(
        {"stretch": stretch, "own": F.when(large, F.xxhash64("a", "b")).otherwise(0), "part": F.when(large, part).otherwise(-1)}
    )
    keys = ["shard", "loose", "stretch", "own", "part"]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    # one window row per shard and stretch
    running = Window.partitionBy("shard").orderBy(*keys[1:]).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("n").over(running), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*keys).orderBy("a", "b", "doc_id", "size")
    numbered = rows.withColumn("nth", F.row_number().over(inside) - 1)
    return numbered.join(starts, keys).withColumn("place", F.col("start") + F.col("nth"))


def assign_shards(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row for each row of ``docs``.

    ``law`` is ``rows``: the shards' row counts differ by one at most. ``size`` is the UTF-8 length
    plus one; a null text counts as empty and is equal to other empty texts. ``slot`` counts from 0
    without gaps inside a shard. ``grown_shard`` is null, as this law looks at all rows. Repeated
    rows and rows with a null id are placed like others. Other columns are not carried.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    code = F.md5(content.cast("binary"))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(code, 1, 15), 16, 10).cast("long").alias("a"),
        F.conv(F.substring(code, 16, 15), 16, 10).cast("long").alias("b"),
        F.pmod(F.xxhash64(F.lit(3), F.col(doc_id)), F.lit(shards * PARTS)).cast("int").alias("home"),
    )
    rows = checkpointed(rows)
    total = rows.count()
    sizes = [total // shards + (s < total % shards) for s in range(shards)]

    cells = rows.groupBy("a", "b", "home").agg(F.count(F.lit(1)).alias("n"))
    copies = cells.groupBy("a", "b").agg(F.sum("n").alias("copies")).where("copies > 1")
    start = F.pmod("home", F.lit(shards)).alias("shard")
    linked = cells.join(copies, ["a", "b"]).select("a", "b", "home", start, "n", "copies")
    capacity = max(1, int(total / shards * SLACK))
    settled = propagate(linked, capacity, shards, rounds)
    # what gives way first: unlinked rows, then texts that are cut anyway
    loose = F.when(F.col("copies").isNull(), 2).when(F.col("copies") > capacity, 1).otherwise(0)
    placed = rows.join(settled.drop("n"), ["a", "b", "home"], "left").withColumns(
        {"loose": loose, "shard": F.coalesce("shard", F.pmod("home", F.lit(shards)))}
    )
    placed = checkpointed(_numbered(placed, total))

    counts = {r[0]: r[1] for r in placed.groupBy("shard").count().collect()}
    counts = [counts.get(s, 0) for s in range(shards)]
    over = [max(0, c - t) for c, t in zip(counts, sizes)]
    lack = [max(0, t - c) for c, t in zip(counts, sizes)]
    surplus = F.col("place") - _case(F.col("shard"), sizes, "long")
    nth = surplus + _case(F.col("shard"), [sum(over[:s]) for s in range(shards)], "long")
    to, slot = F.lit(None).cast("int"), F.lit(None).cast("long")
    for s in reversed(range(shards)):  # the surplus rows, in order, fill the gaps of shard 0, 1, ...
        start = sum(lack[:s])
        fits = (nth >= start) & (nth < start + lack[s])
        to, slot = F.when(fits, s).otherwise(to), F.when(fits, nth - start + counts[s]).otherwise(slot)
    stays = surplus < 0
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.when(stays, F.col("shard")).otherwise(to).alias("shard"),
        F.when(stays, F.col("place")).otherwise(slot).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def cut_copies(sharded: DataFrame) -> DataFrame:
    """``(n_groups, n_cut)``: texts with copies, and those whose copies lie in several shards."""
    places = sharded.groupBy("text_crc32", "size").agg(
        F.count(F.lit(1)).alias("copies"), (F.max("shard") - F.min("shard")).alias("spread")
    )
    return places.where("copies > 1").agg(
        F.count(F.lit(1)).alias("n_groups"), F.coalesce(F.sum((F.col("spread") > 0).cast("int")), F.lit(0)).alias("n_cut")
    )

