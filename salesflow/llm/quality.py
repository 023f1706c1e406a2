"""Line-first quality rules: lines are judged one by one, failing lines are removed, and a document
that loses too much of its text is rejected.

A line fails if it is

- ``symbols``: at least ``min_symbols`` of the characters ``#*$%&|<>`` and more than ``symbol_share``
  of its non-space characters;
- ``navigation``: at least ``min_separators`` menu separators (``|`` or ``>`` between spaces);
- ``shouting``: more than half of at least ten ASCII letters are capitals, or exclamation marks are
  at least a third of at least three words;
- ``punctuation``: no word of it ends a sentence or clause (``.!?;:,``, a closing quote or bracket, or
  a character beyond ASCII);
- ``stutter``: at least half of its words equal the word before;
- ``boilerplate``: it has one of the phrases below between word ends, and at most ``short_words`` words or
  at least ``phrase_share`` of its words in phrases.

Lines without a word are neither judged nor counted.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from salesflow.llm import words as w
from salesflow.llm.common import arrow_map

SYMBOLS = b"#*$%&|<>"
SENTENCE_ENDS = b".!?;:,\"')]}"
WINDOW = 5
# Phrases of page furniture, matched without ASCII case.
BOILERPLATE = (
    "all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy",
    "cookie policy", "use of cookies", "enable javascript", "click here", "lorem ipsum", "sign up",
    "log in", "subscribe to", "share this", "read more", "skip to content", "copyright (c)",
)
COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, "
    "n_bad_lines long, lost_chars long, base_failed boolean, kept boolean"
)


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    max_repeat_percent: int = 20
    symbol_share: float = 0.1
    min_symbols: int = 3
    min_separators: int = 3
    short_words: int = 20
    phrase_share: float = 0.2
    max_loss: float = 0.5


def _mask(characters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters)] = True
    return out


_SYMBOL, _END = _mask(SYMBOLS), _mask(SENTENCE_ENDS)
_END[128:] = True
_PHRASES = re.compile(b"|".join(re.escape(p.encode()) for p in BOILERPLATE), re.IGNORECASE)
# The same between word ends: no ASCII letter or digit and no letter of two bytes, or of three below U+2000, beside it.
_WHOLE_PHRASES = re.compile(
    rb"(?<![0-9A-Za-z_])(?<![\xc3-\xdf][\x80-\xbf])(?<![\xe0\xe1][\x80-\xbf]{2})(?:"
    + b"|".join(re.escape(p.encode()) + (rb"(?![0-9A-Za-z_\xc3-\xe1])" if p[-1].isalnum() else b"") for p in BOILERPLATE)
    + b")",
    re.IGNORECASE,
)
_FIRST_BYTE = np.ones(256, dtype=bool)
_FIRST_BYTE[0x80:0xC0] = False


def _repeats(row: np.ndarray, prints: np.ndarray, rows: int) -> np.ndarray:
    """Per row: words inside windows that occur twice or more in the row."""
    found, first = w.windows(prints, row, WINDOW)
    owner = row[first]
    order = np.lexsort((found, owner))
    same = (found[order][1:] == found[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    again = np.zeros(len(found), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    change = np.zeros(len(prints) + 1, dtype=np.int64)
    np.add.at(change, first[again], 1)
    np.add.at(change, first[again] + WINDOW, -1)
    return np.bincount(row[np.cumsum(change[:-1]) > 0], minlength=rows)


def judge(data: np.ndarray, offsets: np.ndarray, rules: Rules) -> tuple[dict, np.ndarray, tuple]:
    """Measures per row, whether each line fails, and the lines' (starts, ends, row)."""
    rows = len(offsets) - 1
    space = w.SPACE[data]
    starts, ends, row = w.words(data, offsets)
    begin, end, owner = lines = w.lines(data, offsets)

    def each(mask):  # per line
        sums = w.total(mask)
        return sums[end] - sums[begin]

    def whole(mask):  # per row
        sums = w.total(mask)
        return sums[offsets[1:]] - sums[offsets[:-1]]

    inside = ~space & _FIRST_BYTE[data]
    symbol = _SYMBOL[data]
    n_words = np.bincount(row, minlength=rows)
    line_words = np.searchsorted(starts, end) - np.searchsorted(starts, begin)
    real = line_words > 0

    prints = w.fingerprints(data, begin[real], end[real])
    order = np.lexsort((prints, owner[real]))
    same = (prints[order][1:] == prints[order][:-1]) & (owner[real][order][1:] == owner[real][order][:-1])
    dup_lines = np.bincount(owner[real][order][1:][same], minlength=rows)
    word_prints = w.fingerprints(data, starts, ends)
    repeats = _repeats(row, word_prints, rows)
    echoes = starts[1:][(word_prints[1:] == word_prints[:-1]) & (row[1:] == row[:-1])]
    n_echoes = np.searchsorted(echoes, end) - np.searchsorted(echoes, begin)

    chars = each(inside)
    closing = ends[_END[data[ends - 1]]]
    n_closed = np.searchsorted(closing, end, side="right") - np.searchsorted(closing, begin, side="right")
    upper, lower = each((data >= 65) & (data <= 90)), each((data >= 97) & (data <= 122))
    single = starts[ends - starts == 1]
    separators = single[(data[single] == ord("|")) | (data[single] == ord(">"))]
    n_separators = np.searchsorted(separators, end) - np.searchsorted(separators, begin)
    n_symbols, marks = each(symbol), each(data == ord("!"))
    bad = (n_symbols >= rules.min_symbols) & (n_symbols > rules.symbol_share * chars)
    bad |= n_separators >= rules.min_separators
    bad |= (upper + lower >= 10) & (upper > lower)
    bad |= (line_words >= 3) & (3 * marks >= line_words)
    bad |= n_closed == 0
    bad |= 2 * n_echoes >= np.maximum(line_words, 2)
    raw, hit = data.tobytes(), set()
    for match in _PHRASES.finditer(raw):  # a hit over a line's end may hide one behind it
        hit.update((np.searchsorted(begin, [match.start(), match.end() - 1], side="right") - 1).tolist())
    for at in hit:
        held = sum(len(m[0].split()) for m in _WHOLE_PHRASES.finditer(raw[begin[at] : end[at]]))
        bad[at] |= held > 0 and (line_words[at] <= rules.short_words or held >= rules.phrase_share * line_words[at])
    bad &= real

    lost = np.bincount(owner[bad], weights=chars[bad], minlength=rows).astype(np.int64)
    word_chars = whole(inside)
    failed = (n_words < rules.min_words) | (100 * repeats > rules.max_repeat_percent * n_words)
    measures = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": whole(symbol),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeats,
        "n_lines": np.bincount(owner[real], minlength=rows),
        "n_bad_lines": np.bincount(owner[bad], minlength=rows),
        "lost_chars": lost,
        "base_failed": failed,
        "kept": ~failed & (lost <= rules.max_loss * word_chars),
    }
    return measures, bad, lines


def _cleaned(data: np.ndarray, rows: int, bad: np.ndarray, lines: tuple) -> list[str]:
    begin, end, owner = lines
    raw, out = data.tobytes(), [[] for _ in range(rows)]
    for a, b, row in zip(begin[~bad].tolist(), end[~bad].tolist(), owner[~bad].tolist(), strict=True):
        out[row].append(raw[a:b])
    return [b"\n".join(parts).decode("utf-8", "replace") for parts in out]


def _judge_batches(rules: Rules, with_text: bool) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at, data, offsets in w.slices(batch.column(1)):
                rows = len(offsets) - 1
                measures, bad, lines = judge(data, offsets, rules)
                columns = {"id": batch.column(0).slice(at, rows)}
                if with_text:
                    columns["cleaned"] = pa.array(_cleaned(data, rows, bad, lines), pa.string())
                yield pa.RecordBatch.from_pydict(columns | {k: pa.array(v) for k, v in measures.items()})

    return run


def clean(docs: DataFrame, id: str = "doc_id", text: str = "text", rules: Rules = Rules(), with_text: bool = True) -> DataFrame:
    """One row per document: id, the text without its failing lines (``with_text``), the measures
    and ``kept``.

    Base rules reject fewer than ``min_words`` words, or more than ``max_repeat_percent`` percent
    of words within five-word windows that occur twice or more. Then a document is kept if its
    failing lines hold at most ``max_loss`` of its characters in words. Null and empty texts have
    no words, hence are rejected. Rows are judged one by one: repeated rows each give a row, other
    columns are not read. No shuffle.
    """
    schema = f"id {docs.schema[id].dataType.simpleString()}, " + ("cleaned string, " if with_text else "") + COLUMNS
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    return arrow_map(rows, _judge_batches(rules, with_text), schema).withColumnRenamed("id", id)
