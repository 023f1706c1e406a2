"""WARC archives: a writer of gzip members with revisit records, and a salvage reader.

The reader goes through byte ranges of files, so that large archives are read in parallel. A record
counts only if all checks hold: the member unpacks, the version line and header parse, the block has
its length and ends in two line breaks, and the digests match. After a failed check, and at the
start of a range, the next gzip member or version line that holds is searched for. Bytes that no
record covers are reported as gaps.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesflow.llm.common import arrow_map, store, written

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 64 << 20
READ_TASKS = 10_000
RANGE_BYTES = 8 << 20
READ_BYTES = 4 << 20
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)", re.IGNORECASE)
RECORD = (
    "path string, offset long, end long, type string, record_id string, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, name: str, payload: bytes, url: str | None = None, refers_to: str | None = None, date: str = DATE) -> bytes:
    """One record, not packed. A revisit keeps the HTTP header of the payload, not the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if kind == "response":
        block += payload
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Profile", PROFILE if kind == "revisit" else None),
        ("WARC-Refers-To", refers_to and f"<{refers_to}>"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _write_files(folder: str, file_bytes: int) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        context = TaskContext.get()
        files, root = store(folder)
        files.create_dir(root, recursive=True)
        made, out, size, count = [], None, 0, 0

        def close():
            nonlocal out, size, count
            if out is not None:
                out.close()
                final = f"part-{context.partitionId():06d}-{len(made):04d}.warc.gz"
                files.move(temporary, f"{root}/{final}")  # a repeated task puts the same bytes in place
                made.append((final, count, size))
                out, size, count = None, 0, 0

        for batch in batches:
            for name, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    temporary = f"{root}/_{context.partitionId()}-{context.taskAttemptId()}-{len(made)}"
                    out = files.open_output_stream(temporary, compression=None)
                kind = "revisit" if refers_to else "response"
                data = member(record(kind, name, payload or b"", url, refers_to))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    close()
        close()
        names, counts, sizes = zip(*made, strict=True) if made else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=["file", "records", "bytes"])

    return run


def write_archives(pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", payload: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row below ``folder``; returns (file, records, bytes), already computed.

    Payloads are UTF-8; a null one is empty. Of equal payloads that of the largest id is a response and
    the others are revisits of it; rows that repeat the largest id are responses too. Rows with a null
    id are responses that nothing refers to. Other columns are not read. Digests are grouped with sums
    before the shuffle; only ids of repeated payloads join the pages.
    """
    rows = pages.select(
        F.col(id).cast("string").alias("id"), F.col(id).alias("place"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    again = rows.groupBy("sha").agg(F.max("place").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(again, "sha", "left")
    refers = F.when(F.col("place") < F.col("keeper"), F.concat(F.lit("urn:page:"), F.col("keeper").cast("string")))
    rows = rows.select(F.concat(F.lit("urn:page:"), F.coalesce("id", F.lit(""))).alias("name"), "url", "payload", refers.alias("refers_to"))
    return written(arrow_map(rows, _write_files(folder, file_bytes), "file string, records long, bytes long"), "warc-manifest")


class _Bytes:
    """A file from one place on, read as far as asked."""

    def __init__(self, file, size: int, start: int):
        self.file, self.size, self.start, self.held = file, size, start, b""

    def upto(self, end: int) -> bytes:
        """The bytes from the start, to ``end`` or the file's end at least."""
        end = min(end, self.size)
        if end > self.start + len(self.held):
            have = self.start + len(self.held)
            self.held += self.file.read_at(min(self.size - have, max(end - have, READ_BYTES)), have)
        return self.held

    def drop(self, start: int) -> None:
        """Let go of what is before a place, a few MB at a time: what is left is copied."""
        if start - self.start >= READ_BYTES // 2:
            self.held, self.start = self.held[start - self.start :], start


def _unpack(source: _Bytes, at: int) -> tuple[bytes, int] | None:
    """(unpacked bytes, end) of the gzip member at a place."""
    unpacker, parts, end = zlib.decompressobj(31), [], at
    try:
        while not unpacker.eof:
            held = source.upto(end + (1 << 16))
            some = held[end - source.start : end - source.start + (1 << 16)]
            if not some:
                return None
            parts.append(unpacker.decompress(some))
            end += len(some)
    except zlib.error:
        return None
    return b"".join(parts), end - len(unpacker.unused_data)


def _parse(data: bytes, whole: bool) -> tuple[dict, bytes, int] | None:
    """(fields, block, length of the record) at the start of ``data``; None if a check fails, and if
    ``whole`` also if anything follows."""
    version = _VERSION.match(data)
    stop = data.find(b"\r\n\r\n")
    if not version or stop < 0:
        return None
    fields = {}
    for line in data[version.end() : stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d{1,15}", fields.get("content-length", "")) or "warc-type" not in fields:
        return None
    end = stop + 4 + int(fields["content-length"])
    if data[end : end + 4] != b"\r\n\r\n" or whole and len(data) != end + 4:
        return None
    return fields, data[stop + 4 : end], end + 4


def _plain(source: _Bytes, at: int) -> tuple[dict, bytes, int] | None:
    """Like ``_parse``, for a record that is not packed, with its end in the file."""
    ahead = 1 << 16
    while True:
        data = source.upto(at + ahead)[at - source.start : at - source.start + ahead]
        stop = data.find(b"\r\n\r\n")
        length = _LENGTH.search(data[:stop]) if stop >= 0 else None
        need = stop + 8 + int(length[1]) if length else ahead + 1
        if need <= len(data):
            found = _parse(data[:need], True)
            return found and (found[0], found[1], at + found[2])
        if at + ahead >= source.size or not length and ahead > 1 << 20 or need > source.size - at:
            return None
        ahead = max(need, 2 * ahead) if length else 2 * ahead


def _checked(fields: dict, block: bytes) -> tuple | None:
    """(type, record id, refers to, uri, payload digest, payload bytes, payload) if the digests hold."""
    claimed = fields.get("warc-block-digest", "")
    if claimed.startswith("sha1:") and claimed[5:].upper() != digest(block):
        return None
    kind, payload, size = fields["warc-type"], block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        stop = block.find(b"\r\n\r\n")
        if stop < 0:
            return None
        payload, length = block[stop + 4 :], _LENGTH.search(block[:stop])
        size = int(length[1]) if length else len(payload)
    claimed = fields.get("warc-payload-digest", "")
    if kind != "revisit" and claimed.startswith("sha1:") and claimed[5:].upper() != digest(payload):
        return None
    name, refers = (fields.get(x, "").strip("<>") or None for x in ("warc-record-id", "warc-refers-to"))
    return kind, name, refers, fields.get("warc-target-uri"), claimed.removeprefix("sha1:") or None, size, None if kind == "revisit" else payload


def salvage(file, size: int, start: int, stop: int) -> Iterator[tuple]:
    """(offset, end, checked fields...) of the valid records that begin in start:stop."""
    source, at = _Bytes(file, size, start), start
    while at < stop:
        data = source.upto(min(at + READ_BYTES, size))
        found = _START.search(data, at - source.start)
        if not found:
            at = source.start + len(data) - 10 if source.start + len(data) < size else stop
            at = max(at, source.start + 1)
            if at < stop:
                source.drop(at)
            continue
        at = source.start + found.start()
        if at >= stop:
            return
        source.drop(at)
        parsed = None
        if found[0].startswith(b"\x1f"):
            unpacked = _unpack(source, at)
            inner = unpacked and _parse(unpacked[0], True)
            parsed = inner and (inner[0], inner[1], unpacked[1])
        else:
            parsed = _plain(source, at)
        row = parsed and _checked(parsed[0], parsed[1])
        if row:
            yield at, parsed[2], *row
            at = parsed[2]
            if at < size:
                source.drop(at) if at <= source.start + len(source.held) else source.__init__(file, size, at)
        else:
            at += 1


def _read_ranges(with_payload: bool) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
        names = ["range", *(x.split()[0] for x in RECORD.split(", "))]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for path, size, number, begin, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, name = store(path)
                held, weight = [], 0
                with files.open_input_file(name) as file:
                    for row in salvage(file, size, begin, stop):
                        held.append((number, path, *(row if with_payload else (*row[:-1], None))))
                        weight += 300 + len(held[-1][-1] or b"")
                        if weight >= READ_BYTES:
                            yield out(held)
                            held, weight = [], 0
                if held:
                    yield out(held)

    return run


def _records(ranges: DataFrame, with_payload: bool) -> DataFrame:
    """The records of each (path, length, start, begin, stop), with the range's ``start`` as ``range``."""
    tasks = max(1, min(ranges.count(), READ_TASKS))  # a number, or adaptive execution would merge these few rows into one task
    ranges = ranges.select("path", "length", "start", "begin", "stop").repartition(tasks, "path", "start")
    return arrow_map(ranges, _read_ranges(with_payload), f"range long, {RECORD}")


def _aligned(ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records without payloads, and the ranges with the place at which each has to ``begin``.

    A range that starts inside a record may take what is in that record's payload for records of the file. It has to
    begin where the last record of the ranges before it ends, and is read again from there if it found
    anything earlier, until all ranges agree with those before them: in each round the first of a
    file that does not is put right.
    """
    ranges = written(ranges.withColumn("begin", F.col("start")), "warc-ranges")
    found = written(_records(ranges, False), "warc-found")
    while True:
        ends = found.groupBy("path", F.col("range").alias("start")).agg(F.min("offset").alias("first"), F.max("end").alias("last"))
        before = F.max("last").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
        due = F.greatest("start", F.coalesce(before, "start"))
        checked = ranges.join(ends, ["path", "start"], "left").withColumn("due", due)
        unharmed = (F.col("begin") == F.col("start")) & (F.col("first").isNull() | (F.col("first") >= F.col("due")))
        checked = written(checked.withColumn("wrong", (F.col("begin") != F.col("due")) & ~unharmed), "warc-checked")
        again = checked.where("wrong").select("path", "length", "start", F.col("due").alias("begin"), "stop")
        if again.isEmpty():
            return found.drop("range"), ranges
        right = checked.where("NOT wrong").select(again.columns[:3] + ["begin", "stop"])
        wrong = again.select("path", F.col("start").alias("range"))
        found = written(found.join(F.broadcast(wrong), ["path", "range"], "left_anti").select(found.columns).union(_records(again, False)), "warc-found")
        ranges = written(right.union(again), "warc-ranges")


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The valid records of the ``.warc`` and ``.warc.gz`` files below a folder: path, byte offset and
    end, type, ids, uri, payload digest (bare base32), payload size, and the payload (null for revisits
    and without ``with_payload``). An empty folder gives no rows. Whatever ``range_bytes``, they are those that reading each
    file from its start gives. With payloads the archives are read twice, as payloads are not written in between."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").option("recursiveFileLookup", "true").load(folder)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = files.select("path", "length").select("path", "length", each.alias("start"))
    found, ranges = _aligned(ranges.withColumn("stop", F.least("length", F.col("start") + range_bytes)))
    return _records(ranges, True).drop("range") if with_payload else found


def gaps(spark: SparkSession, folder: str, records: DataFrame) -> DataFrame:
    """(path, start, stop) of the bytes that no valid record covers: what salvage left in quarantine.
    A file without a valid record is one gap. Windows hold one file's records each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").option("recursiveFileLookup", "true").load(folder)
    ends = files.select("path", F.col("length").alias("offset"), F.col("length").alias("end"))
    rows = records.select("path", "offset", "end").unionByName(ends)
    before = F.coalesce(F.lag("end").over(Window.partitionBy("path").orderBy("offset", "end")), F.lit(0))
    return rows.select("path", before.alias("start"), F.col("offset").alias("stop")).where("stop > start")
