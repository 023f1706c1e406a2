"""Words, lines and shingles of many texts at once, on the UTF-8 bytes of an Arrow column.

Words are runs of bytes other than space and 0x09-0x0D, which is ``[^\\x20\\x09-\\x0D]+`` over
characters, since every byte of a longer character is 0x80 or above. Spans are compared by 64-bit
fingerprints: two different spans agree with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        factors = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        factors[0] = 1
        _powers[base] = np.multiply.accumulate(factors)
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(column, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with up to ``limit`` bytes, or one longer row.

    Nulls are empty texts.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        stop = min(stop, n)
        yield at, data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        at = stop


def total(mask: np.ndarray) -> np.ndarray:
    """Running count, one longer than the mask: [b] - [a] is the count in a:b."""
    out = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def spans(kept: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the runs of kept bytes; no run crosses rows."""
    n = len(kept)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    before, after = np.empty(n, dtype=bool), np.empty(n, dtype=bool)
    before[0], before[1:] = True, ~kept[:-1]
    after[-1], after[:-1] = True, ~kept[1:]
    full = offsets[1:] > offsets[:-1]
    before[offsets[:-1][full]] = True
    after[offsets[1:][full] - 1] = True
    starts = np.flatnonzero(kept & before)
    ends = np.flatnonzero(kept & after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spans(~SPACE[data], offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the parts between newlines; an empty text is one empty line."""
    at = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], at + 1]))
    ends = np.sort(np.concatenate([at, offsets[1:]]))
    breaks = np.searchsorted(at, offsets)
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(breaks) + 1)


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each span; spans are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + SLICE_BYTES, side="right")))
        first = starts[a]
        part = data[first : ends[b - 1]]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[part] * _power(_BASE, len(part)), out=sums[1:])
        begin, end = starts[a:b] - first, ends[a:b] - first
        out[a:b] = (sums[end] - sums[begin]) * _power(_BASE_INVERSE, len(part) + 1)[begin]
        a = b
    return mix(out)


def windows(prints: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, index of its first word) of every run of ``size`` words within a row."""
    n = len(prints) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out += prints[k : k + n] * factors[k]
    first = np.flatnonzero(row[:n] == row[size - 1 :])
    return mix(out[first]), first


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle fingerprints of all rows, offsets per row).

    ASCII case does not count. A row with fewer words than ``size`` has its whole sequence as one
    shingle, a row without words none.
    """
    rows = len(offsets) - 1
    starts, ends, row = words(data, offsets)
    prints = fingerprints(LOWER[data], starts, ends)
    found, first = windows(prints, row, size)
    count = np.bincount(row, minlength=rows)
    found, owner = [found], [row[first]]
    begin = np.concatenate([[0], np.cumsum(count)])
    for n in range(1, size):
        short = np.flatnonzero(count == n)
        if len(short):
            whole = np.zeros(len(short), dtype=np.uint64)
            factors = mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(1000 * n)) | np.uint64(1)
            for k in range(n):
                whole += prints[begin[short] + k] * factors[k]
            found.append(mix(whole))
            owner.append(short)
    found, owner = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    if len(found):
        new = np.concatenate([[True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])])
        found, owner = found[new], owner[new]
    return found, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])
