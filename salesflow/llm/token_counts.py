"""Token counts that follow edits: a segment tree of token counts per document.

Leaves are parts of about ``LEAF`` characters, cut where a space or newline follows a character that
is not white space: a pre-token begins there whatever surrounds it, so a leaf's tokens do not
depend on other leaves. Nodes hold the sums of their leaves, one row each, so neither a long
document nor one with many edits is the work of one task. An edit touches the leaves it meets and,
as boundary context, those that begin or end where it does; only these are encoded again, and only
sums above them change.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.bpe import _batches, _encoding
from salesflow.llm.common import arrow_map, ship, written

LEAF = 1_024
FAN_OUT = 8
RUN_BLOCK = 256


def cuts(text: str, leaf: int = LEAF) -> list[int]:
    """Where leaves begin."""
    out, at = [0], leaf
    while at < len(text):
        spaces = [p for p in (text.find(" ", at), text.find("\n", at)) if p >= 0]
        if not spaces:
            break
        at = min(spaces)
        if text[at - 1].isspace():
            at += 1
            continue
        out.append(at)
        at += leaf
    return out


def _leaves(ranks, pattern: str, leaf: int) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoding, _ = _encoding(ranks.value, pattern)

        def rows(batch):
            for key, id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                starts = cuts(text, leaf)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(text)], strict=True)):
                    yield key, id, k, a, b, text[a:b], len(encoding.encode_ordinary(text[a:b]))

        for batch in batches:
            types = [pa.int64(), batch.schema.field(1).type, *[pa.int64()] * 3, pa.string(), pa.int64()]
            for part in range(0, max(len(batch), 1), 1000):
                yield from _batches(types, ["key", "id", "leaf", "start", "stop", "text", "n"], rows(batch.slice(part, 1000)), lambda row: 4 * len(row[5]) + 64)

    return run


def build_leaves(docs: DataFrame, ranks: bytes, pattern: str, id: str = "doc_id", text: str = "text", leaf: int = LEAF) -> DataFrame:
    """(key, id, leaf, start, stop, text, n): the leaves of every document, written to the work folder.

    ``key`` names a row, so that repeated rows are documents of their own. A null text is empty; an
    empty text has one leaf of no tokens. Other columns are not read. No shuffle.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id).alias("id"), F.col(text).alias("text"))
    kind = docs.schema[id].dataType.simpleString()
    return written(arrow_map(rows, _leaves(shared, pattern, leaf), f"key long, id {kind}, leaf long, start long, stop long, text string, n long"), "count-leaves")


def build_trees(leaves: DataFrame) -> DataFrame:
    """(key, level, node, n): sums of tokens. Level 0 are the leaves; node i of a level sums the nodes
    FAN_OUT * i to FAN_OUT * i + FAN_OUT - 1 below; the level with one node is the root."""
    level = leaves.select("key", F.lit(0).alias("level"), F.col("leaf").alias("node"), "n")
    out, depth = level, 0
    while not (wide := level.where("node > 0").select("key").distinct()).isEmpty():
        depth += 1
        level = level.join(wide, "key", "left_semi").groupBy("key", F.floor(F.col("node") / FAN_OUT).cast("long").alias("node"))
        level = written(level.agg(F.sum("n").alias("n")).select("key", F.lit(depth).alias("level"), "node", "n"), "count-level")
        out = out.unionByName(level)
    return out


def _region(ranks, pattern: str) -> Callable:
    """New texts and counts of regions of touched leaves."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoding, _ = _encoding(ranks.value, pattern)

        def rows(batch):
            for key, first, start, parts, edits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                old = "".join(part["text"] for part in parts)
                out, at = [], 0
                for edit in edits:
                    out += [old[at : edit["from"] - start], edit["put"]]
                    at = max(at, edit["to"] - start)
                new = "".join([*out, old[at:]])
                yield key, first, new, len(encoding.encode_ordinary(new))

        types = [pa.int64(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            for part in range(0, max(len(batch), 1), 500):
                yield from _batches(types, ["key", "leaf", "text", "n"], rows(batch.slice(part, 500)), lambda row: 4 * len(row[2]) + 64)

    return run


def _runs(hits: DataFrame) -> DataFrame:
    """(key, leaf, start, run) of touched leaves; ``run`` is the first leaf of those that edits tie together.

    A cut that no edit meets stays one, so leaves beside it are runs of their own. Runs are found within RUN_BLOCK
    leaves, and carried over from block to block by one row each.
    """
    tied = F.max((F.col("from") <= F.col("start")) & (F.col("leaf") > 0))
    touched = hits.groupBy("key", "leaf", "start").agg(tied.alias("tied")).withColumn("block", F.floor(F.col("leaf") / RUN_BLOCK))
    touched = touched.withColumn("head", F.when(~F.col("tied"), F.col("leaf")))
    earlier = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = touched.groupBy("key", "block").agg(F.max("head").alias("last"))
    carried = carried.select("key", "block", F.max("last").over(earlier).alias("carried"))
    inside = F.max("head").over(Window.partitionBy("key", "block").orderBy("leaf"))
    touched = touched.withColumn("inside", inside).join(carried, ["key", "block"])
    return touched.select("key", "leaf", "start", F.coalesce("inside", "carried").alias("run"))


def apply_edits(leaves: DataFrame, trees: DataFrame, edits: DataFrame, ranks: bytes, pattern: str, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """(changed leaves, trees after the edits).

    ``edits`` are (key, from, to, put): the characters from:to of a document's old text become
    ``put``; those of one document do not overlap. A null ``put`` deletes. Edits of equal place
    follow in order of ``put``; edits of unknown keys, and those with null places, do nothing. A
    changed leaf has columns key, leaf, text, n, old: leaves with an edit across or at the cut between them
    are encoded as one text, which the first of them then holds, the others being empty until trees
    are built anew. Only such a run is one group; it is as long as its edits.
    """
    spark = leaves.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(ranks)
    edits = edits.select("key", "from", "to", F.coalesce("put", F.lit("")).alias("put")).where(F.col("from").isNotNull() & F.col("to").isNotNull())
    block = F.explode(F.sequence(F.floor(F.col("start") / leaf), F.floor(F.col("stop") / leaf))).alias("block")
    places = leaves.select("key", "leaf", "start", "stop", block)
    block = F.explode(F.sequence(F.floor(F.col("from") / leaf), F.floor(F.col("to") / leaf))).alias("block")
    hits = edits.select("key", "from", "to", "put", block).join(places, ["key", "block"])
    hits = hits.where("from <= stop AND to >= start").drop("block").distinct()
    touched = written(_runs(hits), "count-touched")
    parts = leaves.select("key", "leaf", "text", "n").join(touched, ["key", "leaf"])
    old = written(parts, "count-old")
    regions = old.groupBy("key", "run").agg(
        F.min("leaf").alias("leaf"), F.min("start").alias("start"), F.sort_array(F.collect_list(F.struct("leaf", "text"))).alias("parts")
    )
    inside = hits.join(touched.select("key", "leaf", "run"), ["key", "leaf"]).groupBy("key", "run").agg(
        F.sort_array(F.collect_set(F.struct("from", "to", "put"))).alias("edits")
    )
    regions = regions.join(inside, ["key", "run"]).select("key", "leaf", "start", "parts", "edits")
    new = arrow_map(regions, _region(shared, pattern), "key long, leaf long, text string, n long")
    changed = old.select("key", "leaf", F.col("n").alias("old")).join(new, ["key", "leaf"], "left")
    changed = written(changed.select("key", "leaf", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("n", F.lit(0)).alias("n"), "old"), "count-changed")
    delta = changed.select("key", F.col("leaf").alias("node"), (F.col("n") - F.col("old")).alias("delta"))
    depth = trees.agg(F.max("level")).first()[0] or 0
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.floor(F.col("node") / FAN_OUT**k).cast("long").alias("node")) for k in range(depth + 1)]))
    delta = delta.select("key", levels.alias("at"), "delta").groupBy("key", "at.level", "at.node").agg(F.sum("delta").alias("delta"))
    after = trees.join(delta, ["key", "level", "node"], "left")
    return changed, after.select("key", "level", "node", (F.col("n") + F.coalesce("delta", F.lit(0))).alias("n"))


def counts(trees: DataFrame) -> DataFrame:
    """(key, n_tokens): the roots."""
    return trees.groupBy("key").agg(F.max_by("n", "level").alias("n_tokens"))
