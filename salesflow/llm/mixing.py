"""Mixing sources to target weights: each source gets a budget of words, met by whole documents.

A source whose budget is q times its size and a rest gives every document q times, and once more
the documents of a subset whose sizes sum to the rest. The subset is fixed by lengths first:
documents are counted by exact size, every size gives its proportional share, and a
bounded-knapsack dynamic program over the counts left meets what is then missing, exactly where
that is possible. Which documents of a size are taken is decided by a seeded hash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.common import ship, written

WEIGHTS = (5, 2, 1)
RATIO = 1.5
MAX_REPEATS = 2
SEED = 20240601
DP_WIDTH = 100_000
BUCKETS = 512
_RANGES = 16


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """``rank`` from 0 in order of ``source``, null last, over range partitions."""
    order = F.col("source").asc_nulls_last()
    ranged = sources.repartitionByRange(_RANGES, order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "mix-sources")
    before, starts = 0, []
    for part, n in sorted(ranged.groupBy("part").count().collect()):  # one row per range
        starts.append((part, before))
        before += n
    starts = sources.sparkSession.createDataFrame(starts, "part int, start long")
    within = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return ranged.withColumn("within", within).join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + F.col("within"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, ratio: float = RATIO, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Sources in code-point order, null last, weigh as ``weights``, repeating, and share ``ratio``
    times all sizes. A target stops at ``max_repeats`` times its source's size; the excess is
    shared again by weight until no target is above. Only sums come to the driver.
    """
    sources = _ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(sources.select("source", "source_size", weight.alias("weight")), "mix-weights")
    cap = max_repeats * F.col("source_size").cast("double")
    total, weight_sum = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, last = (ratio * total / weight_sum if weight_sum else 0.0), None
    while level != last:
        last = level
        full = cap <= level * F.col("weight")
        held, open_ = sources.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if not open_:
            break
        level = max(level, (ratio * total - (held or 0.0)) / open_)
    return sources.select("source", "source_size", F.least(cap, F.lit(level) * F.col("weight")).alias("target"))


def fit_counts(size: np.ndarray, count: np.ndarray, budget: int, width: int = DP_WIDTH) -> np.ndarray:
    """How many documents of each size to take so that sizes sum to ``budget``, or as near below as
    can be with the documents left to the dynamic program. Sizes are distinct. The program is given at least
    ``width`` words of what proportional shares leave, or all if there are fewer; no size is preferred before it."""
    taken = np.zeros(len(size), dtype=np.int64)
    total = int((size * count).sum())
    if budget <= 0 or not total:
        return taken
    if budget >= total:
        return np.where(size > 0, count, 0)
    taken = np.array([c * budget // total if s else 0 for s, c in zip(size.tolist(), count.tolist(), strict=True)], dtype=np.int64)
    rest = budget - int((size * taken).sum())
    order = np.argsort(-size, kind="stable")
    if rest > width:  # more than the program holds: all but that by share of what is left, fractions carried to the next smaller size
        left = np.where(size > 0, count - taken, 0)
        share, carried = (rest - width) / int((size * left).sum()), 0.0
        for i in order:
            if left[i]:
                carried += share * int(size[i]) * int(left[i])
                more = min(int(left[i]), int(carried // int(size[i])))
                taken[i] += more
                carried -= more * int(size[i])
        rest = budget - int((size * taken).sum())
    reach = np.zeros(rest + 1, dtype=bool)
    reach[0] = True
    by = np.full(rest + 1, -1, dtype=np.int64)  # the item that first reached a sum
    items = []
    for i in order:
        left, lot = int(count[i] - taken[i]), 1
        while size[i] and left and size[i] <= rest and not reach[rest]:  # lots of 1, 2, 4, ... documents
            lot = min(lot, left)
            gain = lot * int(size[i])
            if gain > rest:
                break
            new = reach[: rest + 1 - gain] & ~reach[gain:]
            by[gain:][new] = len(items)
            reach[gain:] |= new
            items.append((i, lot, gain))
            left, lot = left - lot, lot * 2
    at = int(np.flatnonzero(reach)[-1])
    while at:
        i, lot, gain = items[by[at]]
        taken[i] += lot
        at -= gain
    return taken


def _plan(max_repeats: int):
    def plan(group):
        import pandas as pd

        size, count = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
        total, target = int((size * count).sum()), float(group["target"].iloc[0])
        full = min(int(target // total), max_repeats) if total else 0
        budget = round(target - full * total) if full < max_repeats else 0
        return pd.DataFrame({"rank": group["rank"], "size": size, "full": full, "extra": fit_counts(size, count, budget)})

    return plan


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple = WEIGHTS,
    ratio: float = RATIO,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: id, ``source``, ``size`` (words; null text: 0), ``source_size``, ``target``
    (its source's), ``copies`` (0 to ``max_repeats``) and ``taken`` (``copies * size``).

    Documents without words may get copies but take no words. Sources of size 0 have target 0. A
    null source is a source of its own. Repeated rows count as documents of their own; among those
    of equal id, source and size it does not matter which is taken. An empty table gives no rows.
    Other columns are not read. Equal input gives equal output.

    The text is read once. Documents of a source and size are ranked within hash buckets, of
    which only the one where the count is reached needs the ranks, so a hot group is not ranked in
    one task. The dynamic program sees one source's distinct sizes.
    """
    rows = written(
        docs.select(
            F.col(id).alias("id"),
            F.col(source).cast("string").alias("source"),
            word_count(F.col(text)).alias("size"),
            F.xxhash64(F.col(id), F.lit(seed)).alias("h"),
        ),
        "mix-sizes",
    ).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    ship(docs.sparkSession)
    targets = source_targets(rows, weights, ratio, max_repeats).withColumn("rank", F.xxhash64("source"))
    cells = written(rows.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")), "mix-cells")
    counts = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    same = [F.col("a.source").eqNullSafe(F.col("b.source"))]
    counts = counts.alias("a").join(targets.alias("b"), same).select("a.source", "size", "n", "target", "source_size", "rank")
    plan = counts.groupBy("rank").applyInPandas(_plan(max_repeats), "rank long, size long, full int, extra long")
    plan = written(counts.join(plan, ["rank", "size"]).select("source", "size", "full", "extra", "target", "source_size"), "mix-plan")
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket")) - F.col("n")
    cuts = cells.withColumn("before", before)
    same = [F.col("a.source").eqNullSafe(F.col("b.source")), F.col("a.size") == F.col("b.size")]
    cuts = cuts.alias("a").join(plan.alias("b"), same).select(
        "a.source", "a.size", "bucket", "full", "target", "source_size",
        F.greatest(F.lit(0), F.least(F.col("n"), F.col("extra") - F.col("before"))).alias("more"),
    )
    same = [F.col("a.source").eqNullSafe(F.col("b.source")), F.col("a.size") == F.col("b.size"), F.col("a.bucket") == F.col("b.bucket")]
    chosen = rows.alias("a").join(cuts.alias("b"), same)
    place = F.row_number().over(Window.partitionBy("a.source", "a.size", "a.bucket").orderBy("h", "id"))
    copies = (F.col("full") + F.when(place <= F.col("more"), 1).otherwise(0)).cast("int")
    return chosen.withColumn("copies", copies).select(
        F.col("a.id").alias(id), F.col("a.source").alias("source"), F.col("a.size").alias("size"), "source_size", "target",
        "copies", (F.col("copies") * F.col("a.size")).alias("taken"),
    )
