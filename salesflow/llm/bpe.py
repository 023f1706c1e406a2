"""Byte-level BPE over rank files, for texts of any length.

A long text is cut into chunks that overlap. Each chunk is split into pre-tokens by itself, in
parallel; where two neighbours' pre-tokens begin at the same place inside their overlap they agree
from there on, because a match depends on nothing before its start. The text is cut anew at these
places, and the pieces are encoded in parallel. Where an overlap has no such place (one pre-token
is longer than it), the text goes another round with larger chunks. Decoding joins the raw bytes of
the ids.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.common import arrow_map, ship, written

CHUNK = 16_384
OVERLAP = 1_024
GROWTH = 16
LOOKAHEAD = 16  # characters that a match may depend on beyond its end
OUT_BYTES = 4 << 20

_encodings: dict = {}


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _encoding(raw: bytes, pattern: str):
    """(encoding, bytes by id), once per worker."""
    key = (zlib.crc32(raw), pattern)
    if key not in _encodings:
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), table
    return _encodings[key]


def _ids(encoding, text: str) -> bytes:
    return encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def _batches(types: list, names: list, rows: Iterator, weigh: Callable) -> Iterator:
    """Arrow batches of about OUT_BYTES from tuples."""
    import pyarrow as pa

    held, size = [], 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

    for row in rows:
        held.append(row)
        size += weigh(row)
        if size >= OUT_BYTES:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _decoded(table: list[bytes], ids: bytes | None) -> bytes:
    return b"".join(map(table.__getitem__, np.frombuffer(ids or b"", dtype="<u4").tolist()))


def _encode_rows(ranks, pattern: str, keys: int, decoded: bool = False) -> Callable:
    """Encode the text after ``keys`` key columns; with ``decoded``, decode the ids too."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoding, table = _encoding(ranks.value, pattern)

        def rows(batch):
            for *key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = _ids(encoding, text or "")
                yield (*key, ids, _decoded(table, ids)) if decoded else (*key, ids)

        for batch in batches:
            for part in range(0, max(len(batch), 1), 1000):
                some = batch.slice(part, 1000)
                types = [c.type for c in some.columns[:keys]] + [pa.binary()] * (1 + decoded)
                names = some.schema.names[:keys] + ["ids", "decoded"][: 1 + decoded]
                yield from _batches(types, names, rows(some), lambda row: 2 * len(row[-1]))

    return run


def _cut(chunk: int, overlap: int) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows(batch):
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k, start in enumerate(range(0, len(text), chunk)):
                    yield key, k, start, text[start : start + chunk + overlap]

        types = [pa.int64(), pa.int32(), pa.int64(), pa.string()]
        for batch in batches:
            yield from _batches(types, ["key", "k", "start", "text"], rows(batch), lambda row: 4 * len(row[-1]))

    return run


def boundaries(pattern, text: str) -> list[int]:
    """Where pre-tokens begin behind a character that is not white space. A text that ends there is
    split as the longer text is, so pieces cut there can be encoded by themselves."""
    return [m.start() for m in pattern.finditer(text) if m.start() == 0 or not text[m.start() - 1].isspace()]


def _pretokenise(pattern: str, chunk: int, overlap: int) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import regex

        compiled = regex.compile(pattern)

        def rows(batch):
            for key, k, start, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = np.asarray(boundaries(compiled, text), dtype=np.int64)
                sure = found[found <= len(text) - LOOKAHEAD]
                yield key, k, found[found <= overlap] + start, sure[sure >= chunk] + start

        types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for batch in batches:
            yield from _batches(types, ["key", "k", "head", "tail"], rows(batch), lambda row: 8 * len(row[2]))

    return run


def _pieces(batches: Iterator) -> Iterator:
    import pyarrow as pa

    def rows(batch):
        for key, text, cuts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(text)], strict=True)):
                yield key, k, text[a:b]

    types = [pa.int64(), pa.int32(), pa.string()]
    for batch in batches:
        yield from _batches(types, ["key", "k", "text"], rows(batch), lambda row: 4 * len(row[-1]))


def _join_pieces(ranks, pattern: str, decoded: bool) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        _, table = _encoding(ranks.value, pattern)

        def rows(batch):
            for key, pieces in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = b"".join(piece["ids"] for piece in pieces)
                yield (key, ids, _decoded(table, ids)) if decoded else (key, ids)

        types, names = [pa.int64()] + [pa.binary()] * (1 + decoded), ["key", "ids", "decoded"][: 2 + decoded]
        for batch in batches:
            for at in range(len(batch)):
                yield from _batches(types, names, rows(batch.slice(at, 1)), lambda row: len(row[-1]))

    return run


def stitched_pieces(texts: DataFrame, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, k, text): the texts of (key, text) in pieces that encode by themselves."""
    done = None
    while True:
        chunks = arrow_map(texts, _cut(chunk, overlap), "key long, k int, start long, text string").repartition("key", "k")
        ends = arrow_map(chunks, _pretokenise(pattern, chunk, overlap), "key long, k int, head array<long>, tail array<long>")
        before = F.lag("tail").over(Window.partitionBy("key").orderBy("k"))
        cut = F.when(F.col("k") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("head", before)))
        cuts = written(ends.withColumn("cut", cut.cast("long")).select("key", "cut"), "bpe-cuts")
        lost = cuts.where("cut IS NULL").select("key").distinct()
        settled = cuts.join(lost, "key", "left_anti").groupBy("key").agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
        pieces = arrow_map(texts.join(settled, "key").select("key", "text", "cuts"), _pieces, "key long, k int, text string")
        done = pieces if done is None else done.union(pieces)
        if lost.isEmpty():
            return done
        texts = written(texts.join(lost, "key", "left_semi"), "bpe-unsettled")
        chunk, overlap = chunk * GROWTH, overlap * GROWTH


def encode(
    docs: DataFrame, ranks: bytes, pattern: str, id: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP,
    decoded: bool = False,
) -> DataFrame:
    """One row per document: id, ``n_tokens``, and ``ids`` as little-endian unsigned 32-bit integers;
    with ``decoded``, also the bytes that the ids decode to, made in the same pass.

    Every match of ``pattern`` is encoded by itself, without special tokens. A null text is empty;
    an empty text has no ids. Repeated rows each give a row, null ids included; other columns are
    not read. Texts of one chunk stay in their task; longer ones are spread by chunk, and only they
    are shuffled. The vocabulary that is broadcast is a parameter of fixed size.
    """
    if overlap <= LOOKAHEAD or chunk < 2 * overlap:
        raise ValueError("chunk must be at least twice the overlap, and the overlap longer than the look-ahead")
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(ranks)
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    out = ["ids", "decoded"][: 1 + decoded]
    binary = ", ".join(f"{name} binary" for name in out)
    short = arrow_map(rows.where(F.length("text") <= chunk), _encode_rows(shared, pattern, 1, decoded), f"id {kind}, {binary}")
    long = written(rows.where(F.length("text") > chunk).withColumn("key", F.monotonically_increasing_id()), "bpe-long")
    pieces = stitched_pieces(long.select("key", "text"), pattern, chunk, overlap).repartition("key", "k")
    pieces = arrow_map(pieces, _encode_rows(shared, pattern, 2), "key long, k int, ids binary")
    whole = pieces.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("pieces"))
    whole = arrow_map(whole, _join_pieces(shared, pattern, decoded), f"key long, {binary}")
    whole = whole.join(long.select("key", "id"), "key").select("id", *out)
    return short.unionByName(whole).select(F.col("id").alias(id), (F.length("ids") / 4).cast("long").alias("n_tokens"), *out)


def _decode_rows(ranks, pattern: str) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        _, table = _encoding(ranks.value, pattern)

        def rows(batch):
            for *kept, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield *kept, ids, _decoded(table, ids)

        for batch in batches:
            for part in range(0, max(len(batch), 1), 1000):
                some = batch.slice(part, 1000)
                types = [c.type for c in some.columns] + [pa.binary()]
                yield from _batches(types, [*some.schema.names, "decoded"], rows(some), lambda row: 3 * len(row[-1]))

    return run


def decode(encoded: DataFrame, ranks: bytes, pattern: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the raw bytes of their ids. Null ids decode to no bytes. An id that
    the ranks do not have fails the job. Columns other than ``ids`` are kept."""
    kept = [c for c in encoded.columns if c not in (ids, "decoded")]
    ship(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    rows = encoded.select(*kept, F.col(ids))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return arrow_map(rows, _decode_rows(shared, pattern), f"{schema}, decoded binary")
