"""Token ids in binary files: Simple-8b words of 64 bits, in blocks of fixed id counts.

File: magic, blocks, document table, block table, footer. A word's high four bits select how many ids
of how many bits its other 60 bits hold, low bits first; selector 15 escapes one id of 60 bits or
more, which fills the next word. A block holds BLOCK ids (the last one fewer) and is packed by itself;
the block table has its byte offset, so any block is read and unpacked alone. Numbers are little-endian.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm.common import BATCH_BYTES, arrow_map, store, written
from salesflow.llm.words import slices

MAGIC = b"S8BIDS01"
BLOCK = 1 << 16
# Ids per word and bits per id, by selector; 15 is the escape.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15
_WIDTHS = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)  # bits of small ids
_STEPS = np.asarray([*COUNTS, 0, 1], dtype=np.int32)
READ_BLOCKS = 64
UNITS_HELD = 600_000
NEW_PARTS = 50_000
SPACE = " \n\t\r"
_FOOTER = struct.Struct("<qqqq8s")  # documents, blocks, offset of the document table, ids, magic


def pack(ids: np.ndarray) -> np.ndarray:
    """64-bit words of unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    huge = ids >= np.uint64(1 << 60)
    top = int(ids.max())
    if top < len(_WIDTHS):
        width = _WIDTHS[ids]
    elif top < 1 << 53:  # exact as double
        width = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)  # bits of each id
    else:
        width = np.zeros(n, dtype=np.uint8)
        for bits in (0, *BITS[:-1]):
            width[ids >= np.uint64(1 << bits)] = bits + 1
        width[huge] = 61
    widest, have = width.copy(), 1  # widest of the next `have` ids
    selector = np.full(n, len(COUNTS) - 1, dtype=np.uint8)
    for s in range(len(COUNTS) - 1, -1, -1):
        while have < min(COUNTS[s], n):
            widest[: n - have] = np.maximum(widest[: n - have], width[have:])
            have += 1
        fits = widest <= BITS[s]
        fits[max(n - COUNTS[s] + 1, 0) :] = False
        if not fits.any():  # nor do more ids of fewer bits
            break
        selector[fits] = s
    selector[huge] = ESCAPE
    jumps = [np.append(np.arange(n) + _STEPS[selector], n)]  # of one word, of two, of four
    for _ in range(3):
        jumps.append(jumps[-1][jumps[-1]])
    jump, at, starts = jumps.pop().data, 0, []
    while at < n:
        starts.append(at)
        at = jump[at]
    starts = np.asarray(starts)
    for jump in reversed(jumps):
        starts = np.stack([starts, jump[starts]], axis=1).ravel()
    starts = starts[starts < n]
    chosen = selector[starts].astype(np.int64)
    place = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(chosen == ESCAPE)[:-1]])
    words = np.zeros(int(place[-1]) + 1 + int(chosen[-1] == ESCAPE), dtype=np.uint64)
    words[place] = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen).tolist():
        mine = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[place[mine] + 1] = ids[starts[mine]]
            continue
        filled, first = words[place[mine]], starts[mine]
        for k in range(COUNTS[s]):
            filled |= ids[first + k] << np.uint64(k * BITS[s])
        words[place[mine]] = filled
    return words


def unpack(words: np.ndarray) -> np.ndarray:
    """The ids of one block's words. Escaped ids are found first, since any bits may follow an escape."""
    words = np.asarray(words, dtype=np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), dtype=bool)
    for at in np.flatnonzero(selector == ESCAPE).tolist():
        if not raw[at]:
            raw[at + 1] = True
    place = np.flatnonzero(~raw)
    selector = selector[place]
    count = np.append(np.asarray(COUNTS), [0, 1])[selector]
    start = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(int(start[-1]), dtype=np.uint64)
    for s in np.unique(selector).tolist():
        mine = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[start[mine]] = words[place[mine] + 1]
            continue
        mask = np.uint64((1 << BITS[s]) - 1)
        filled, first = words[place[mine]], start[mine]
        for k in range(COUNTS[s]):
            out[first + k] = (filled >> np.uint64(k * BITS[s])) & mask
    return out


class Writer:
    """One file of documents."""

    def __init__(self, out):
        self.out, self.at = out, out.write(MAGIC) or len(MAGIC)
        self.held, self.waiting = [], 0
        self.offsets, self.keys, self.known, self.sizes = [], [], [], []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key or 0)
        self.known.append(key is not None)
        self.sizes.append(len(ids))
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 16 * BLOCK:
            self._blocks(False)

    def _blocks(self, all_: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, dtype=np.uint32)
        stop = len(ids) if all_ else len(ids) // BLOCK * BLOCK
        for a in range(0, stop, BLOCK):
            data = pack(ids[a : min(a + BLOCK, stop)]).astype("<u8").tobytes()
            self.offsets.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.held, self.waiting = [ids[stop:]], len(ids) - stop

    def close(self) -> tuple[int, int, int]:
        """(documents, ids, blocks)"""
        self._blocks(True)
        tables = [np.asarray(self.keys, "<i8"), np.asarray(self.known, "u1"), np.asarray(self.sizes, "<i8"), np.asarray([*self.offsets, self.at], "<i8")]
        for values in tables:
            self.out.write(values.tobytes())
        total = int(sum(self.sizes))
        self.out.write(_FOOTER.pack(len(self.keys), len(self.offsets), self.at, total, MAGIC))
        self.out.close()
        return len(self.keys), total, len(self.offsets)


class Reader:
    def __init__(self, file):
        self.file, size = file, file.size()
        documents, blocks, tables, self.total, magic = _FOOTER.unpack(file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != MAGIC or file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a file of packed ids")
        data = file.read_at(size - _FOOTER.size - tables, tables)
        self.keys = np.frombuffer(data, "<i8", documents)
        self.known = np.frombuffer(data, "u1", documents, 8 * documents)
        sizes = np.frombuffer(data, "<i8", documents, 9 * documents)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.offsets = np.frombuffer(data, "<i8", blocks + 1, 17 * documents)

    def block(self, b: int) -> np.ndarray:
        a, z = int(self.offsets[b]), int(self.offsets[b + 1])
        return unpack(np.frombuffer(self.file.read_at(z - a, a), "<u8"))

    def documents(self, first: int, stop: int) -> Iterator[tuple]:
        """(key, start, ids) of the documents that begin in blocks first:stop."""
        a, z = np.searchsorted(self.starts[:-1], [first * BLOCK, stop * BLOCK])
        z = len(self.keys) if stop >= len(self.offsets) - 1 else z
        held, at, b = np.zeros(0, dtype=np.uint32), first * BLOCK, first
        for d in range(a, z):
            start, end = int(self.starts[d]), int(self.starts[d + 1])
            parts = [held[start - at :]]
            while at + len(held) < end:
                at, held, b = b * BLOCK, self.block(b).astype(np.uint32), b + 1
                parts.append(held[max(start - at, 0) :])
            ids = np.concatenate(parts)[: end - start]
            yield int(self.keys[d]) if self.known[d] else None, start, ids


def _bytes(*values) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for value in values:
        out[list(value) if isinstance(value, bytes | range) else value] = True
    return out


_GAP, _LETTER, _MARK = _bytes(SPACE.encode()), _bytes(range(65, 91), range(97, 123)), _bytes(b".,;:!?)")
# First bytes of white space other than SPACE, and of much else.
_MAY_BE_ODD = _bytes(0x0B, 0x0C, range(0x1C, 0x20), 0xC2, range(0xE1, 0xE4))


def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where parts begin: at texts that are not empty, at white space behind something else, and at a mark behind
    a letter (ASCII, or U+00C0 to U+00FF but for the two signs among them)."""
    gap = _GAP[data]
    begin = np.zeros(len(data), dtype=bool)
    begin[1:] = gap[1:] & ~gap[:-1]
    mark = np.flatnonzero(_MARK[data[1:]]) + 1
    last, ahead = data[mark - 1], data[np.maximum(mark - 2, 0)]
    begin[mark[_LETTER[last] | (ahead == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)]] = True
    begin[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    return np.flatnonzero(begin).astype(np.int64)


class Encoder:
    """Ids by the tokenizers library. Texts are cut where a space or newline follows another character and where
    a mark follows a letter: a pre-token always begins there. The parts of a batch are told apart by Arrow, and
    only distinct ones are looked up; new ones are encoded as one text and told apart by the bytes their ids stand
    for, unless they have no space in front or nothing else: what such a part gives depends on its neighbours.
    Parts are held in two generations: a part that is not met again while UNITS_HELD others are goes. With
    ``added`` the file's added tokens are matched, as the library does by itself, and a text with one is encoded whole."""

    def __init__(self, raw: str, added: bool = False):
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw)
        self.tokenizer.encode_special_tokens = not added
        self.odd = re.compile("[^\\S \\n\\t\\r]|[\x1c-\x1f]")  # other white space: such a text is encoded as one
        known = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.added = re.compile("|".join(map(re.escape, known)).encode()) if known else None
        self.held: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        tokens = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.width = np.asarray([len(t or "") for t in tokens], dtype=np.int64)  # a character is a byte in its tokens

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, dtype="<u4").tobytes() for x in found]

    def _new(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        joined = [p for p in parts if p[0] in SPACE and p[-1] not in SPACE]
        if len(joined) < len(parts):
            alone = [p for p in parts if p[0] not in SPACE or p[-1] in SPACE]
            yield from zip(alone, self._ids(alone), strict=True)
        if joined:
            data = self._ids(["".join(joined)])[0]
            ends = np.cumsum(self.width[np.frombuffer(data, dtype="<u4")])
            bounds = np.cumsum(list(map(len, map(str.encode, joined))))
            stops = np.searchsorted(ends, bounds)
            if stops[-1] != len(ends) - 1 or (ends[stops] != bounds).any():
                raise ValueError("token ids run over the end of a word")
            stops = (4 * (stops + 1)).tolist()
            yield from zip(joined, map(data.__getitem__, map(slice, [0, *stops], stops)), strict=False)

    def _known(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts."""
        if len(self.held) > UNITS_HELD:
            self.older, self.held = self.held, {}
        found = list(map(self.held.get, parts))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            wanted = list(map(parts.__getitem__, missing))
            new = wanted
            if self.older:
                self.held.update((p, ids) for p in wanted if (ids := self.older.get(p)) is not None)
                new = [p for p in wanted if p not in self.held]
            for a in range(0, len(new), NEW_PARTS):
                self.held.update(self._new(new[a : a + NEW_PARTS]))
            for i, ids in zip(missing, map(self.held.__getitem__, wanted), strict=True):
                found[i] = ids
        return found

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows that are encoded as one text."""
        rows = np.unique(np.searchsorted(offsets, np.flatnonzero(_MAY_BE_ODD[data]), side="right") - 1)
        odd = [r for r in rows.tolist() if self.odd.search(data[offsets[r] : offsets[r + 1]].tobytes().decode())]
        at = [m.start() for m in self.added.finditer(data)] if self.added else []
        whole = np.zeros(len(offsets) - 1, dtype=bool)
        whole[odd] = True
        for r in set((np.searchsorted(offsets, at, side="right") - 1).tolist()):
            whole[r] |= self.added.search(data[offsets[r] : offsets[r + 1]].tobytes()) is not None
        return whole

    def batch(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each text, in order; the texts are ``data`` in UTF-8, cut at ``offsets``."""
        import pyarrow as pa

        rows = len(offsets) - 1
        if not len(data):
            yield from (np.zeros(0, dtype="<u4") for _ in range(rows))
            return
        whole = self._whole(data, offsets)
        starts = part_starts(data, offsets)
        per_row = np.searchsorted(starts, offsets)
        bounds = np.append(starts, len(data))
        parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
        if whole.any():
            count = np.diff(per_row)
            parts = parts.filter(pa.array(~np.repeat(whole, count)))
            per_row = np.concatenate([[0], np.cumsum(np.where(whole, 0, count))])
        parts = parts.dictionary_encode()
        found = self._known(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        first = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        code = np.asarray(parts.indices)
        n = size[code]
        before = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(first[code] - before[:-1], n) + np.arange(before[-1])]
        bounds = before[per_row].tolist()
        for r, (a, z) in enumerate(zip(bounds, bounds[1:], strict=False)):
            if whole[r]:
                yield np.frombuffer(self._ids([data[offsets[r] : offsets[r + 1]].tobytes().decode()])[0], dtype="<u4")
            else:
                yield ids[a:z]

    def __call__(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        return next(self.batch(data, np.array([0, len(data)], dtype=np.int64)))


_encoders: dict[int, Encoder] = {}


def _write_files(folder: str, tokenizer, end_id: int, added: bool) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = hash((tokenizer.value, added))
        encode = _encoders.setdefault(known, None) or Encoder(tokenizer.value, added)
        _encoders[known] = encode
        context, writer = TaskContext.get(), None
        files, root = store(folder)
        end = np.asarray([end_id], dtype=np.uint32)
        for batch in batches:
            if len(batch) and writer is None:
                files.create_dir(root, recursive=True)
                temporary = f"{root}/_{context.partitionId()}-{context.taskAttemptId()}"
                writer = Writer(files.open_output_stream(temporary, compression=None))
            for at, data, offsets in slices(batch.column(1), BATCH_BYTES):
                keys = batch.column(0).slice(at, len(offsets) - 1).to_pylist()
                for key, ids in zip(keys, encode.batch(data, offsets), strict=True):
                    writer.add(key, np.concatenate([ids, end]))
        if writer is not None:
            documents, ids, blocks = writer.close()
            name = f"part-{context.partitionId():06d}.s8b"
            files.move(temporary, f"{root}/{name}")  # a repeated task puts the same bytes in place
            yield pa.RecordBatch.from_pydict({"file": [name], "documents": [documents], "ids": [ids], "blocks": [blocks]})

    return run


def write_ids(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id: str = "doc_id", text: str = "text", added: bool = False
) -> DataFrame:
    """Write the ids of all documents below ``folder`` in ascending order of id (null first); returns
    (file, documents, ids, blocks), already computed. File names are in order too.

    Each document's ids end in ``end_id``; null and empty texts have only that. Rows of equal id are
    ordered by the hash of their text. Ids of documents are integers. Other columns are not read.
    ``tokenizer`` is the content of a tokenizer file, broadcast to the workers; its added tokens are
    text like other text, or matched if ``added``. Range partitions are
    cut by id and text hash, so a repeated id is not one task.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer)
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    made = arrow_map(rows, _write_files(folder, shared, end_id, added), "file string, documents long, ids long, blocks long")
    return written(made, "packed-manifest")


def _read_files(folder: str) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types, names = [pa.int64(), pa.int64(), pa.int64(), pa.binary()], ["id", "start", "n_tokens", "ids"]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        files, root = store(folder)
        for batch in batches:
            for name, base, first, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held, weight = [], 0
                with files.open_input_file(f"{root}/{name}") as file:
                    for key, start, ids in Reader(file).documents(first, stop):
                        held.append((key, base + start, len(ids), ids.astype("<u4").tobytes()))
                        weight += 4 * len(ids)
                        if weight >= 4 << 20:
                            yield out(held)
                            held, weight = [], 0
                if held:
                    yield out(held)

    return run


def read_ids(spark: SparkSession, folder: str, manifest: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, ``start``, ``n_tokens``, ``ids``) of every document of the files: ids of all documents before
    it, its own, and they themselves as little-endian unsigned 32-bit integers. Runs of blocks are read
    in parallel. One manifest row per file comes to the driver, which adds up where files start."""
    files, before, runs = [], 0, 0
    for row in sorted(manifest.collect()):
        files.append((row.file, before, max(row.blocks, 1)))
        before += row.ids
        runs += -(-max(row.blocks, 1) // READ_BLOCKS)
    first = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1, F.lit(READ_BLOCKS))).alias("first")
    starts = spark.createDataFrame(files, "file string, base long, blocks long").select("file", "base", first)
    starts = starts.select("file", "base", F.col("first").cast("long"), (F.col("first") + READ_BLOCKS).cast("long").alias("stop"))
    found = arrow_map(starts.repartition(max(runs, 1), "file", "first"), _read_files(folder), "id long, start long, n_tokens long, ids binary")
    return found.withColumnRenamed("id", id)
