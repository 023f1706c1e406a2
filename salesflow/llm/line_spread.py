"""Cross-site boilerplate: lines that appear on many sites are removed.

Each line has a HyperLogLog sketch of its sites. Sketches are built per task and merged by
aggregation, so a line that a third of all documents carry sends one sketch per task. Lines whose
estimate is near the threshold get an exact distinct count.

The lines of a document that was copied to many sites are spread too. A document whose lines are mostly
spread therefore stays whole if another one is proven to have nearly the same lines; a near-duplicate
operator can then keep one of them. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import written

MIN_SITES = 6
LOG2_REGISTERS = 12
DOUBTED = 0.5
ALIKE_PERCENT = 80
PIVOTS = 8
_SPACES = " \t\n\v\f\r"


def line_key(line: Column) -> Column:
    """64 bits of a line without the spaces around it; null for a line without a word."""
    bare = F.btrim(line, F.lit(_SPACES))
    return F.when(bare != "", F.xxhash64(bare))


def _row_key(id: str, text: str, site: str) -> Column:
    """128 bits of a row: rows that are equal in id, site and text are one to the joins, which treat them alike."""
    parts = [F.col(id).cast("string"), F.col(site).cast("string"), F.col(text)]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))


def _split(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _worded(text: str) -> Column:
    """How many lines have a word."""
    return F.coalesce(F.size(F.filter(_split(text), lambda x: F.btrim(x, F.lit(_SPACES)) != "")), F.lit(0))


def _lines(docs: DataFrame, id: str, text: str, site: str) -> DataFrame:
    """(row, site, key, of) of the lines with a word, written once: the text is read for them only here.
    ``of`` is how many there are in the document."""
    rows = docs.select(_row_key(id, text, site).alias("row"), F.col(site).cast("string").alias("site"), _worded(text).alias("of"), _split(text).alias("lines"))
    lines = rows.select("row", "site", "of", F.explode("lines").alias("line"))
    return written(lines.select("row", "site", line_key(F.col("line")).alias("key"), "of").where("key IS NOT NULL"), "spread-lines")


def _spread(lines: DataFrame, min_sites: int) -> DataFrame:
    error = 1.04 / 2 ** (LOG2_REGISTERS / 2)
    band = max(1.0, 3 * error * min_sites)
    sketched = lines.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LOG2_REGISTERS)).alias("sites"))
    sketched = written(sketched.where(F.col("sites") >= min_sites - band), "spread-sketches")
    near = sketched.where(F.col("sites") <= min_sites + band).select("key")
    exact = lines.join(near, "key", "left_semi").select("key", "site").distinct().groupBy("key").agg(F.count("site").alias("sites"))
    return sketched.where(F.col("sites") > min_sites + band).unionByName(exact.where(F.col("sites") >= min_sites))


def spread_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """(key, sites) of the lines on at least ``min_sites`` sites; ``sites`` is exact within three
    standard errors of the threshold, else estimated. A null site is no site."""
    return _spread(_lines(docs, id, text, site), min_sites)


def _alike(a: Column, b: Column) -> Column:
    """Do two arrays of distinct keys share enough of their union?"""
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= ALIKE_PERCENT * (F.size(a) + F.size(b) - both)


def _needed(n: Column) -> Column:
    """The least number of a set's n keys that a set like it has too."""
    return F.ceil(n * F.lit(ALIKE_PERCENT) / 100).cast("int")


def _copies(lines: DataFrame) -> DataFrame:
    """(row) of the rows of (row, key, of) lines whose set of keys is shared, or nearly, by another row.

    Equal sets meet by a hash of the set. Of the others, two that are alike share one of their rarest keys
    (the prefix filter). Under such a key sets are compared with some of its sets, by hash, and those for
    which none was found with 64 times as many, until all have been tried: in a group of copies
    nearly all are settled by the first few.
    """
    keys = F.array_sort(F.collect_set("key"))
    rows = lines.groupBy("row").agg(keys.alias("keys"), (F.count("*") / F.max("of")).alias("n"))
    named = F.struct(F.xxhash64("keys").alias("a"), F.xxhash64(F.lit(1), F.col("keys")).alias("b"))
    rows = written(rows.withColumn("set", named), "spread-doubted")
    sets = written(rows.groupBy("set").agg(F.sum("n").alias("n"), F.first("keys").alias("keys")), "spread-sets")
    whole = sets.where("n > 1").select("set")
    one = sets.select("set", F.size("keys").alias("size"), F.explode("keys").alias("key"))
    rare = one.groupBy("key").agg(F.count("*").alias("sets"))
    ranked = F.array_sort(F.collect_list(F.struct("sets", "key")))
    first = one.join(rare, "key").groupBy("set", "size").agg(ranked.alias("keys"))
    first = first.select("set", "size", F.explode(F.slice("keys", F.lit(1), F.col("size") - _needed(F.col("size")) + 1)).alias("k"))
    first = first.where("k.sets > 1").select("set", "size", F.col("k.key").alias("key"), F.col("k.sets").alias("group"))
    first = written(first.withColumn("chance", F.pmod(F.xxhash64("set"), F.lit(1 << 20)) / F.lit(float(1 << 20))), "spread-rare")
    most = first.agg(F.max("group")).first()[0] or 0
    open_, low, high = sets.where("n = 1").select("set"), 0, PIVOTS
    while low < most:
        share = lambda n: F.lit(float(n)) / F.col("group")
        pivots = first.where((F.col("chance") >= share(low)) & ((F.col("chance") < share(high))))
        pivots = pivots.select("key", F.col("set").alias("pivot"), F.col("size").alias("pivot_size"))
        tried = first.join(open_, "set", "left_semi").select("key", "set", "size").join(pivots, "key")
        larger, smaller = F.greatest("size", "pivot_size"), F.least("size", "pivot_size")
        tried = tried.where(F.col("set") != F.col("pivot")).where(smaller >= _needed(larger)).select("set", "pivot").distinct()
        tried = tried.join(sets.select("set", "keys"), "set")
        tried = tried.join(sets.select(F.col("set").alias("pivot"), F.col("keys").alias("pivot_keys")), "pivot")
        found = written(tried.where(_alike(F.col("keys"), F.col("pivot_keys"))).select("set").distinct(), "spread-alike")
        whole = whole.union(found)
        open_ = open_.join(found, "set", "left_anti")
        low, high = high, 64 * high
    return rows.join(whole, "set", "left_semi").select("row")


def remove_spread_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES, doubted: float = DOUBTED
) -> DataFrame:
    """The documents with ``text`` cleaned, ``n_lines`` (lines with a word), ``n_spread`` (those on
    at least ``min_sites`` sites) and ``n_removed``.

    All spread lines are removed, with one exception: a document of which more than the share ``doubted`` of
    its lines is spread stays whole if another such document, a copy, has at least ALIKE_PERCENT of the union of
    their distinct lines in common. A null text stays null and has no lines, an empty one stays
    empty, one of spread lines only becomes empty. Ids may be null and rows may repeat: each counts its lines and gives a
    row, and equal rows are copies of one another. A null site is no site. All other columns are kept; ``n_lines``,
    ``n_spread`` and ``n_removed`` of the input are replaced.
    """
    lines = _lines(docs, id, text, site)
    spread = _spread(lines, min_sites).select("key", F.lit(True).alias("spread"))
    marked = lines.select("row", "key").join(spread, "key", "left").groupBy("row")
    bad = F.array_sort(F.collect_set(F.when(F.col("spread"), F.col("key"))))
    marked = marked.agg(F.count("*").alias("n"), F.count("spread").alias("s"), bad.alias("bad")).where("s > 0")
    marked = written(marked, "spread-marked")
    mostly = marked.where(F.col("s") > doubted * F.col("n")).select("row")
    copies = _copies(lines.join(mostly, "row", "left_semi").select("row", "key", "of"))
    marked = marked.join(copies.withColumn("copy", F.lit(True)), "row", "left")
    marked = marked.select(F.col("row").alias("__row"), F.col("bad").alias("__bad"), F.coalesce("copy", F.lit(False)).alias("__copy"))
    own = [c for c in docs.columns if c not in ("n_lines", "n_spread", "n_removed")]
    rows = docs.select(*own, _row_key(id, text, site).alias("__row")).join(marked, "__row", "left")
    is_bad = lambda x: F.coalesce(_among(line_key(x)), F.lit(False))
    n_spread = F.when(F.col("__bad").isNull(), 0).otherwise(F.size(F.filter(_split(text), is_bad)))
    cut = F.col("__bad").isNotNull() & ~F.col("__copy")
    cleaned = F.when(cut, F.array_join(F.filter(_split(text), lambda x: ~is_bad(x)), "\n")).otherwise(F.col(text))
    rows = rows.withColumns({"n_lines": _worded(text).cast("long"), "n_spread": n_spread.cast("long")})
    rows = rows.withColumn("n_removed", F.when(cut, F.col("n_spread")).otherwise(0).cast("long"))
    return rows.withColumn(text, cleaned).select(*own, "n_lines", "n_spread", "n_removed")


def _among(key: Column) -> Column:
    """Is the key in the sorted array ``__bad``? By halving, as a document may have very many spread lines."""
    bad = F.col("__bad")
    steps = F.transform(F.sequence(F.lit(0), F.length(F.bin(F.size(bad))) - 1), lambda i: F.call_function("shiftleft", F.lit(1), i))
    passed = F.aggregate(F.reverse(steps), F.lit(0), lambda at, step: F.when(F.get(bad, at + step - 1) <= key, at + step).otherwise(at))
    return F.get(bad, passed - 1) == key
