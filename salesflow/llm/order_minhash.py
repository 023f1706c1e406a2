"""Order MinHash fingerprints: likeness of fingerprints follows edit distance, not shared content alone.

A text is cut into units: words, and single characters of scripts that are written without spaces. Its
k-mers are runs of ``K`` units, and the i-th occurrence of a k-mer in the text is an item of its own.
Items lie on a circle of hash values. From each of ``POINTS`` even places on it the next two items are
selected; their k-mers, put in the order they have in the text, are hashed to one number of the
signature. A moved passage changes that order, so it changes the signature as an edit does, where plain
MinHash would see the same set.

Built-in functions only, and all work on a text is within its row: no k-mer is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A word of up to 64 characters, or one character from U+2E80 on.
UNIT = "[^\\x20\\x09-\\x0D⺀-\U0010ffff]{1,64}|[^\\x20\\x09-\\x0D]"
K = 2
POINTS = 64
CUTS = 256
SAMPLED = 50
SHARDS = 16
_PLACE_BITS = 31  # an item is 33 bits of hash over 31 bits of position
_HIGH = -(1 << _PLACE_BITS)
_POINT_SHIFT = 58  # the upper 6 bits: POINTS


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _item(hash_: Column, place: Column) -> Column:
    return hash_.bitwiseAND(F.lit(_HIGH)).bitwiseOR(place.cast("long"))


def _place(item: Column) -> Column:
    return item.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")


def _same(item: Column, other: Column) -> Column:
    return F.shiftright(item.bitwiseXOR(other), _PLACE_BITS) == 0


def _point(item: Column) -> Column:
    return F.shiftright(item, _POINT_SHIFT).cast("int")


def _indices(n: Column) -> Column:
    """0 to n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _starts(items: Column) -> Column:
    """Indices in sorted items at which another k-mer begins."""
    return F.filter(_indices(F.size(items)), lambda j: (j == 0) | ~_same(F.get(items, j), F.get(items, j - 1)))


def _leading(items: Column) -> Column:
    """Of sorted items the first two beyond each point: all that selection can reach."""
    return _let(items, lambda s: F.filter(s, lambda x, j: (j < 2) | (_point(x) != _point(F.get(s, j - 2)))))


def _later(kmers: Column, items: Column, starts: Column) -> Column:
    """Items of the second and later occurrences, whose hash is that of the k-mer's and their number."""

    def of(again: Column) -> Column:
        def run(starts: Column) -> Column:
            def number(r: Column) -> Column:
                begin, end = F.get(starts, r), F.coalesce(F.get(starts, r + 1), F.size(again))

                def one(q: Column) -> Column:
                    place = _place(F.get(again, q))
                    return _item(F.xxhash64(F.get(kmers, place), q - begin + 1), place)

                return F.transform(F.sequence(begin, end - 1), one)

            return F.flatten(F.transform(_indices(F.size(starts)), number))

        return _let(_starts(again), run)

    rest = F.array_except(_indices(F.size(items)), starts)
    return _let(F.transform(rest, lambda j: F.get(items, j)), of)


def _items(kmers: Column) -> Column:
    """The sorted items that selection can reach. A k-mer's first occurrence has the k-mer's own hash."""

    def numbered(items: Column) -> Column:
        def split(starts: Column) -> Column:
            firsts = _leading(F.transform(starts, lambda j: F.get(items, j)))
            whole = _leading(F.sort_array(F.concat(firsts, _later(kmers, items, starts))))
            return F.when(F.size(starts) == F.size(items), firsts).otherwise(whole)

        return _let(_starts(items), split)

    return _let(F.sort_array(F.transform(kmers, _item)), numbered)


def _pairs(kmers: Column) -> Column:
    """The signature: for each point the hash of the next two items' k-mers in text order."""

    def select(items: Column) -> Column:
        n, half = F.size(items), POINTS // 2
        before = lambda j: F.when(j == 0, F.lit(-half - 1)).otherwise(_point(F.get(items, j - 1)))
        met = F.flatten(F.transform(items, lambda x, j: F.array_repeat(j, _point(x) - before(j))))
        nexts = F.concat(met, F.array_repeat(F.lit(0), F.lit(half - 1) - _point(F.element_at(items, -1))))
        round_ = F.concat(F.slice(items, 2, n), F.slice(items, 1, 1))
        kmer = lambda place: F.get(kmers, place)
        pair = lambda a, b: F.xxhash64(kmer(F.least(a, b)), kmer(F.greatest(a, b)))
        hashed = F.zip_with(items, round_, lambda x, y: pair(_place(x), _place(y)))
        return _let(hashed, lambda pairs: F.transform(nexts, lambda j: F.get(pairs, j)))

    return _let(_items(kmers), select)


def signature(text: Column) -> Column:
    """POINTS 64-bit numbers; none for a text without units, such as a null or empty one. A text of
    fewer than K units has one k-mer, all of it."""
    units = F.transform(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), lambda u: F.xxhash64(u))
    none = F.array().cast("array<bigint>")

    def of(u: Column) -> Column:
        runs = F.transform(u, lambda x, i: F.xxhash64(x, *[F.get(u, i + d) for d in range(1, K)]))
        kmers = F.slice(runs, F.lit(1), F.greatest(F.size(u) - (K - 1), F.lit(1)))
        return F.when(F.size(u) == 0, none).otherwise(_let(kmers, _pairs))

    return _let(F.coalesce(units, none), of)


def fingerprint(signature: Column) -> Column:
    """The signature in hexadecimal digits, 32 bits a number."""
    return F.array_join(F.transform(signature, lambda x: F.substring(F.lpad(F.lower(F.hex(x)), 16, "0"), 9, 8)), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal numbers, 0 to 1. Signatures without numbers are like one another only."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + F.coalesce(x, F.lit(0)))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(equal / F.lit(float(POINTS)))


def _cuts(rows: DataFrame, buckets: int) -> list[int]:
    """About ``buckets`` quantiles of the id, from a sample that has SAMPLED ids for each: they balance the work only."""
    count = rows.count()
    if not count:
        return []
    ids = rows.select("id").sample(min(1.0, buckets * SAMPLED / count), 1)
    shares = [i / buckets for i in range(buckets + 1)]
    return sorted(set(ids.agg(F.percentile_approx("id", shares, 10 * buckets)).first()[0] or []))


def _below(cuts: list[int], id: Column) -> Column:
    """How many of the sorted cuts are smaller, found among every so many of them and then between two."""
    step = max(1, round(len(cuts) ** 0.5))
    numbers = lambda some: F.array(*[F.lit(c) for c in some]).cast("array<bigint>")
    smaller = lambda some: F.size(F.filter(some, lambda c: c < id))
    before = F.greatest(smaller(numbers(cuts[::step])) - 1, F.lit(0)) * step
    return before + smaller(F.slice(numbers(cuts), before + 1, F.lit(step)))


def _ordered(rows: DataFrame, buckets: int) -> DataFrame:
    """``b`` falls as the order (id descending, null last, then hash descending) goes on: the number of cuts
    below the id. An id that is a cut, as every very frequent one is, has SHARDS numbers of its own by hash."""
    cuts = _cuts(rows, buckets)
    cut = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    rows = rows.withColumn("below", _below(cuts, F.col("id")))
    shard = F.shiftright("h", 60).cast("int") + SHARDS // 2
    among = F.col("below") * (SHARDS + 1)
    is_cut = F.get(cut, F.col("below")) == F.col("id")
    return rows.withColumn("b", F.when(F.col("id").isNull(), shard - SHARDS).when(is_cut, among + 1 + shard).otherwise(among)).drop("below")


def _with_following(rows: DataFrame) -> DataFrame:
    """The rows by ``b`` in which each bucket ends with the row that follows its last one (``ghost``): the first
    of the next bucket, or of all for the last bucket. One row a bucket comes to the driver."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _ordered(rows, max(CUTS, 4 * parts))
    firsts = rows.groupBy("b").agg(F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "h")).alias("first")).collect()
    firsts = sorted(((r.b, r.first.id, r.first.h) for r in firsts), key=lambda r: -r[0])
    into = [(b, i, h, firsts[k - 1][0]) for k, (b, i, h) in enumerate(firsts)]
    into = rows.sparkSession.createDataFrame(into, "fb int, fid long, fh long, into int")
    first = (F.col("b") == F.col("fb")) & F.col("id").eqNullSafe(F.col("fid")) & (F.col("h") == F.col("fh"))
    rows = rows.join(F.broadcast(into), first, "left")
    own = F.struct(F.col("b").alias("at"), F.lit(False).alias("ghost"))
    again = F.struct(F.col("into").alias("at"), F.lit(True).alias("ghost"))
    rows = rows.withColumn("in", F.explode(F.when(F.col("into").isNull(), F.array(own)).otherwise(F.array(own, again))))
    # The number of partitions is given: signatures take long for their bytes, so merging small ones would cost more than it saves.
    return rows.select("id", "text", "h", F.col("in.at").alias("b"), F.col("in.ghost").alias("ghost")).repartition(parts, "b")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ``n_chars``, ``signature``, ``fingerprint``) of every row. A null text counts as empty; empty texts
    and those of white space only have an empty fingerprint. Repeated rows each give a row, an empty table
    none. Other columns are not read."""
    found = signature(F.col("text"))
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("id", F.length("text").cast("long").alias("n_chars"), found.alias("signature"))
    return rows.select(F.col("id").alias(id), "n_chars", "signature", fingerprint(F.col("signature")).alias("fingerprint"))


def edits_and_neighbours(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row its text's fingerprint, that of the text whose last half is replaced by as much of the
    next row's beginning, and the likeness to both: id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The next row is that of the next smaller id, an integer; after the last one comes the first, so a
    single row is its own next. Null ids come last; rows of one id are in order of their text's hash, and
    equal rows follow each other. A null text counts as empty; two texts without units are fully alike, one
    without and one with units not at all. An empty table gives no rows. Other columns are not read.

    Texts are shuffled once, with signatures following in the same partitions and order.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = _with_following(rows.withColumn("h", F.xxhash64("text")))
    follow = Window.partitionBy("b").orderBy("ghost", F.col("id").desc_nulls_last(), F.col("h").desc())
    n = F.length("text")
    rows = rows.withColumn("next", F.lead("text").over(follow))
    taken = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - taken), F.substring("next", F.lit(1), taken))
    rows = rows.select("id", "h", "b", "ghost", n.cast("long").alias("n_chars"), F.col("text"), F.when(~F.col("ghost"), edited).alias("edited"))
    rows = rows.select(
        "id", "h", "b", "ghost", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), signature(F.col("text")).alias("own"),
        signature(F.col("edited")).alias("other"),
    )
    rows = rows.withColumn("next", F.lead("own").over(follow)).where("NOT ghost")
    return rows.select(
        F.col("id").alias(id), "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
