"""Spelling variants: words one edit apart, each with the far more frequent form it is a variant of.

Pairs are found by probing, not by joining. For every length the vocabulary has a blocked Bloom filter,
cut into chunks that tasks build and that are broadcast up to BROADCAST_BYTES at a time; a vocabulary with
more filter than that takes several passes, each over the words that its lengths concern. A word's edits
are probed by hash sums that change by one term an edit, so no edit is spelt out unless a filter has it.
Those go to an exact join with the vocabulary, which removes the false ones. An insertion is the deletion
of the longer word and a replacement is probed from the smaller letter, so each pair is met once.

All letters are in Latin-1, so a word is one byte a letter. State per task is bounded by a batch and one
pass's filters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import arrow_map, ship, written
from salesflow.llm.words import LOWER, mix

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
NOISE = 97
BITS_PER_WORD = 16
LANES = 8  # a block is LANES words of 32 bits, a key is one bit in each
CHUNK_BLOCKS = 1 << 9
BROADCAST_BYTES = 32 << 20
HELD_WORDS = 200_000
PROBES = 1 << 20

_random = np.random.default_rng(20240607)
_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_SALTS = (_random.integers(1, 1 << 31, LANES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def _counts(noise: int, min_length: int) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import re
        import zlib
        from collections import Counter

        import pyarrow as pa

        runs, lower, held = re.compile(RUN).findall, LOWER.tobytes(), Counter()

        def out():
            made = pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})
            held.clear()
            return made

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if not text:
                    continue
                front = b"%d:" % key if key is not None else b":"
                seed = zlib.crc32(front)
                for word, n in Counter(runs(text.translate(lower).decode())).items():
                    code = zlib.crc32(word.encode(), seed) if noise else 1
                    if noise and code % noise == 0:
                        at = code % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
        if held:
            yield out()

    return run


def vocabulary(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, noise: int = 0
) -> DataFrame:
    """(word, n): the words of at least ``min_length`` letters found at least ``min_count`` times. With ``noise``
    a word whose crc32 with its document's id is a multiple of it has lost a letter: invented misspellings."""
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    found = arrow_map(rows, _counts(noise, min_length), "word string, n long")
    return written(found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "spelling-words")


def _matrices(column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, letters) of the words of each length, letters as a matrix of Latin-1 bytes."""
    texts = [w.encode("latin-1") for w in column.to_pylist()]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        yield length, rows, np.frombuffer(b"".join(texts[r] for r in rows.tolist()), np.uint8).reshape(len(rows), length)


def _powers(n: int) -> np.ndarray:
    factors = np.full(n + 1, _BASE, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def _terms(letters: np.ndarray) -> np.ndarray:
    """The terms whose sum is a word's hash before mixing."""
    return _VALUES[letters] * _powers(letters.shape[1])[:-1]


def _block(codes: np.ndarray, blocks: int) -> np.ndarray:
    return (((codes >> _HALF) * np.uint64(blocks)) >> _HALF).astype(np.int64)


def _bit(codes: np.ndarray, lane: int) -> np.ndarray:
    return (((codes & _LOW) * _SALTS[lane]) & _LOW) >> np.uint64(27)


def _keys(blocks: dict[int, int], step: int) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for length, _, letters in _matrices(batch.column(0)):
                codes = mix(_terms(letters).sum(axis=1, dtype=np.uint64))
                chunk = _block(codes, blocks[length]) // step
                columns = [pa.array(np.full(len(codes), length)), pa.array(chunk), pa.array(codes.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["length", "chunk", "code"])

    return run


def _filter(blocks: dict[int, int], step: int) -> Callable:
    def run(key, rows):
        import pyarrow as pa

        length, chunk = (k.as_py() for k in key)
        codes = rows.column("code").to_numpy().view(np.uint64)
        first = chunk * step
        bits = np.zeros((min(step, blocks[length] - first), LANES), dtype=np.uint32)
        at = _block(codes, blocks[length]) - first
        for lane in range(LANES):
            np.bitwise_or.at(bits[:, lane], at, np.left_shift(np.uint32(1), _bit(codes, lane).astype(np.uint32)))
        return pa.table({"length": [length], "chunk": [chunk], "bits": pa.array([bits.tobytes()], pa.binary())})

    return run


class Filters:
    """The filters of one pass: for each length its number of blocks, and the chunks at hand."""

    def __init__(self, blocks: dict[int, int], step: int, chunks: list[tuple[int, int, bytes]]):
        self.blocks, self.parts = blocks, {}
        for length in {c[0] for c in chunks}:
            mine = sorted((c, bits) for n, c, bits in chunks if n == length)
            first, bits = mine[0][0] * step, b"".join(b for _, b in mine)
            self.parts[length] = first, np.frombuffer(bits, np.uint32).reshape(-1, LANES)

    def hits(self, length: int, sums: np.ndarray) -> np.ndarray:
        """Indices of the sums that may belong to a word of that length."""
        if length not in self.parts:
            return np.zeros(0, dtype=np.int64)
        first, bits = self.parts[length]
        codes = mix(sums)
        at = _block(codes, self.blocks[length]) - first
        live = np.flatnonzero((at >= 0) & (at < len(bits)))
        for lane in range(LANES):
            words = bits[at[live], lane]
            live = live[(words >> _bit(codes[live], lane).astype(np.uint32)) & np.uint32(1) == 1]
        return live


def _replaced(letters: np.ndarray, terms: np.ndarray, sums: np.ndarray, alphabet: np.ndarray, filters: Filters) -> Iterator[tuple]:
    """(rows, place, put) of the words that a filter has after one letter gave way to a greater one."""
    length, powers = letters.shape[1], _powers(letters.shape[1])
    for place in range(length):
        row, put = np.nonzero(alphabet[None, :] > letters[:, place, None])
        changed = sums[row] - terms[row, place] + _VALUES[alphabet[put]] * powers[place]
        hit = filters.hits(length, changed)
        if len(hit):
            yield row[hit], place, alphabet[put[hit]]


def _deleted(letters: np.ndarray, terms: np.ndarray, sums: np.ndarray, filters: Filters) -> Iterator[tuple]:
    """(rows, place) of the words that a filter has after one letter went; of a run of equal letters the first."""
    before = np.zeros(len(letters), dtype=np.uint64)
    for place in range(letters.shape[1]):
        after = sums - before - terms[:, place]
        row = np.arange(len(letters)) if not place else np.flatnonzero(letters[:, place] != letters[:, place - 1])
        hit = filters.hits(letters.shape[1] - 1, (before + after * _BASE_INVERSE)[row])
        if len(hit):
            yield row[hit], place
        before = before + terms[:, place]


def _probe(shared) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        filters, alphabet = shared.value
        alphabet = np.frombuffer(alphabet, np.uint8)
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1)
            row, other = [], []
            for length, rows, letters in _matrices(batch.column(0)):
                step = max(1, PROBES // (length + len(alphabet)))
                for a in range(0, len(rows), step):
                    part, mine = letters[a : a + step], rows[a : a + step]
                    terms = _terms(part)
                    sums = terms.sum(axis=1, dtype=np.uint64)
                    if length in filters.parts:
                        for found, place, put in _replaced(part, terms, sums, alphabet, filters):
                            for r, c in zip(mine[found].tolist(), put.tolist(), strict=True):
                                row.append(r)
                                other.append(words[r][:place] + chr(c) + words[r][place + 1 :])
                    if length - 1 in filters.parts:
                        for found, place in _deleted(part, terms, sums, filters):
                            for r in mine[found].tolist():
                                row.append(r)
                                other.append(words[r][:place] + words[r][place + 1 :])
            if row:
                columns = [batch.column(0).take(pa.array(row)), counts.take(pa.array(row)), pa.array(other, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "other"])

    return run


def _alphabet(batches: Iterator) -> Iterator:
    """The letters of a task's words."""
    import pyarrow as pa

    seen: set[str] = set()
    for batch in batches:
        seen.update("".join(batch.column(0).to_pylist()))
    yield pa.RecordBatch.from_pydict({"letter": pa.array(sorted(seen), pa.string())})


def near_pairs(words: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, chunk_blocks: int = CHUNK_BLOCKS) -> DataFrame:
    """(word, n, other, other_n) of the pairs of (word, n) rows that one inserted, deleted or replaced letter
    tells apart, each pair once. Words are distinct and of Latin-1 letters. One row per length and one filter
    of at most ``broadcast_bytes`` at a time come to the driver."""
    spark = words.sparkSession
    ship(spark)
    sized = words.withColumn("length", F.length("word"))
    blocks = {r.length: -(-r.n * BITS_PER_WORD // (32 * LANES)) for r in sized.groupBy("length").agg(F.count("*").alias("n")).collect()}
    letters = arrow_map(words.select("word"), _alphabet, "letter string").distinct().collect()
    alphabet = bytes(sorted(ord(r.letter) for r in letters))
    keys = arrow_map(words.select("word"), _keys(blocks, chunk_blocks), "length long, chunk long, code long")
    built = keys.groupBy("length", "chunk").applyInArrow(_filter(blocks, chunk_blocks), "length long, chunk long, bits binary")
    built = written(built, "spelling-filters")
    chunks = [(length, c) for length in sorted(blocks) for c in range(-(-blocks[length] // chunk_blocks))]
    size = lambda length, c: 4 * LANES * min(chunk_blocks, blocks[length] - c * chunk_blocks)
    found = spark.createDataFrame([], "word string, n long, other string")
    while chunks:
        now, held = [chunks[0]], size(*chunks[0])
        for chunk in chunks[1:]:
            if held + size(*chunk) > broadcast_bytes:
                break
            now.append(chunk)
            held += size(*chunk)
        chunks = chunks[len(now) :]
        (first, a), (last, z) = now[0], now[-1]
        ours = built.where(f"(length > {first} OR length = {first} AND chunk >= {a}) AND (length < {last} OR length = {last} AND chunk <= {z})")
        shared = spark.sparkContext.broadcast((Filters(blocks, chunk_blocks, [tuple(r) for r in ours.collect()]), alphabet))
        reached = sized.where(F.col("length").between(first, last + 1)).select("word", "n")
        found = found.union(written(arrow_map(reached, _probe(shared), "word string, n long, other string"), "spelling-positives"))
        shared.unpersist()
    exact = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return found.join(exact, "other").select("word", "n", "other", "other_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, in steps that double."""
    roots = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = roots.join(on, "root", "left")
        further = written(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        roots = further.select("word", "root")
        if not further.where("moved").limit(1).count():
            return roots


def variants(words: DataFrame, ratio: float = RATIO, **settings) -> DataFrame:
    """word, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of the (word, n) rows.

    A word's form is the word one edit apart of the greatest n, of several the smallest in code-point order,
    if that n is at least ``ratio`` (above 1) times its own; else null. Forms are followed to the root, which is
    the word itself where it has no form; n grows along the way, so it ends. An empty table gives no rows.
    """
    pairs = near_pairs(words, **settings)
    side = lambda *names: F.struct(*[F.col(a).alias(b) for a, b in zip(names, ("word", "near", "near_n"), strict=True)])
    both = pairs.select(F.explode(F.array(side("word", "other", "other_n"), side("other", "word", "n"))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    enough = F.col("near_n") >= ratio * F.col("n")
    rows = words.join(best, "word", "left").select("word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    keep = lambda value: F.when(enough, F.col(value))
    rows = rows.select("word", keep("near").alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), keep("near_n").alias("form_n"))
    rows = written(rows, "spelling-forms")
    roots = _roots(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id: str = "doc_id", text: str = "text", noise: int = 0, **settings) -> DataFrame:
    """``variants`` of the ``vocabulary`` of all documents. A null text has no words, a null id is hashed as an
    empty one (with ``noise``), repeated rows count again, other columns are not read."""
    return variants(vocabulary(docs, id, text, noise=noise), **settings)
