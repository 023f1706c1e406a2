"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

A sentence's probability is a logistic function of its words; a document's is their noisy-or,
``1 - prod(1 - p)``. Only documents carry labels; the gradient of the noisy-or shares a document's
label among its sentences, so the model also says which sentences offend.

Words are runs of ASCII letters, digits and characters beyond ASCII, without ASCII case. A word's
features are itself and its first four, five and six bytes, so that a stem is known under endings
never seen. Only features that toxic documents hold far more often than chance get a weight.
Sentences end at ``.``, ``!``, ``?`` and newlines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm import words as w
from salesflow.llm.common import arrow_map, ship

SAMPLE_DOCS = 12_000
STEMS = (4, 5, 6)
MIN_Z = 5.0
BUCKET_Z = 2.5
EPOCHS = 300
RATE = 0.1
L2 = 3e-5
START_BIAS = -6.0
BUCKETS = 1 << 22

_WORD = np.zeros(256, dtype=bool)
_WORD[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
_SENTENCE_END = np.zeros(256, dtype=bool)
_SENTENCE_END[list(b".!?\n")] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features of the words, sentence of each feature, row of each sentence, byte start and end of
    each sentence as two columns). Only sentences with a word count."""
    begin, end, row = w.spans(~_SENTENCE_END[data], offsets)
    starts, ends, _ = w.spans(_WORD[data], offsets)
    lowered = w.LOWER[data]
    sentence = np.searchsorted(begin, starts, side="right") - 1
    full, sentence = np.unique(sentence, return_inverse=True)
    found, owner = [w.fingerprints(lowered, starts, ends)], [sentence]
    for n in STEMS:
        long = ends - starts > n
        found.append(w.fingerprints(lowered, starts[long], starts[long] + n) * np.uint64(2 * n + 1))
        owner.append(sentence[long])
    return np.concatenate(found), np.concatenate(owner), row[full], np.stack([begin[full], end[full]], 1)


class Model:
    """Weights of feature fingerprints, and the bias."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        self.keys, self.weights, self.bias = keys, weights, bias
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[keys >> np.uint64(48)] = True

    def find(self, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of known features, their places among the keys)."""
        at = np.flatnonzero(self.maybe[feature >> np.uint64(48)])
        place = np.searchsorted(self.keys, feature[at])
        same = place < len(self.keys)
        same[same] = self.keys[place[same]] == feature[at][same]
        return at[same], place[same]

    def sentences(self, feature: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        at, place = self.find(feature)
        return _probability(self.weights, self.bias, place, sentence[at], n)


def _probability(weights: np.ndarray, bias: float, column: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    z = bias + np.bincount(owner, weights=weights[column], minlength=n)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _noisy_or(p: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return -np.expm1(np.bincount(row, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=rows))


def _telling(positive: np.ndarray, all_: np.ndarray, rate: float, z: float = MIN_Z) -> np.ndarray:
    """Whether that many toxic documents among those with a feature are far beyond chance."""
    spread = np.sqrt(np.maximum(all_ * rate * (1 - rate), 1e-12))
    return (all_ > 0) & (positive - all_ * rate >= z * spread) & (positive >= 3)


def _documents(feature: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (feature, row) once."""
    order = np.lexsort((row, feature))
    feature, row = feature[order], row[order]
    new = np.ones(len(feature), dtype=bool)
    new[1:] = (feature[1:] != feature[:-1]) | (row[1:] != row[:-1])
    return feature[new], row[new]


def train(texts: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> Model:
    """texts: (bytes, offsets) of slices, whose rows in order have the labels."""
    rate = float(label.mean()) if len(label) else 0.0
    counts = np.zeros((2, BUCKETS), dtype=np.int32)
    at = 0
    for data, offsets in texts:  # which buckets of features are worth keeping
        feature, sentence, row, _ = features(data, offsets)
        bucket, owner = _documents(feature & np.uint64(BUCKETS - 1), row[sentence])
        for k in (0, 1):
            some = bucket[label[at + owner] == k].astype(np.int64)
            counts[k] += np.bincount(some, minlength=BUCKETS).astype(np.int32)
        at += len(offsets) - 1
    good = _telling(counts[1], counts.sum(axis=0), rate, BUCKET_Z)
    del counts
    parts, at, sentences = [], 0, 0
    for data, offsets in texts:
        feature, sentence, row, _ = features(data, offsets)
        kept = good[feature & np.uint64(BUCKETS - 1)]
        parts.append((feature[kept], sentence[kept] + sentences, row + at))
        at, sentences = at + len(offsets) - 1, sentences + len(row)
    if not parts or not 0 < rate < 1:
        return Model(np.zeros(0, dtype=np.uint64), np.zeros(0), START_BIAS)
    feature, sentence, row = (np.concatenate(x) for x in zip(*parts, strict=True))
    names, owner = _documents(feature, row[sentence])
    names, place = np.unique(names, return_inverse=True)
    has = np.bincount(place, minlength=len(names))
    names = names[_telling(np.bincount(place, weights=label[owner], minlength=len(names)), has, rate)]
    known, column = Model(names, np.zeros(len(names)), START_BIAS).find(feature)
    return _ascend(names, column, sentence[known], row, label)


def _ascend(names: np.ndarray, column: np.ndarray, owner: np.ndarray, row: np.ndarray, label: np.ndarray) -> Model:
    """Adam on the regularised log-likelihood of the noisy-or."""
    n, rows = len(row), len(label)
    values, bias = np.zeros(len(names)), START_BIAS
    first, second = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, EPOCHS + 1):
        p = _probability(values, bias, column, owner, n)
        doc = np.clip(_noisy_or(p, row, rows), 1e-9, 1)
        share = np.where(label[row] == 1, p * ((1 - doc) / doc)[row], -p)  # d log-likelihood / d z
        gradient = np.append(np.bincount(column, weights=share[owner], minlength=len(names)), share.sum()) / rows
        gradient[:-1] -= L2 * values
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        values, bias = values + move[:-1], bias + move[-1]
    return Model(names, values, bias)


def _train_batches(batches: Iterator) -> Iterator:
    import pyarrow as pa

    texts, labels = [], [np.zeros(0, dtype=np.int64)]
    for batch in batches:
        labels.append(np.asarray(batch.column(1).to_numpy(zero_copy_only=False), dtype=np.int64))
        texts += [(data.copy(), offsets.copy()) for _, data, offsets in w.slices(batch.column(0))]
    model = train(texts, (np.concatenate(labels) > 0).astype(np.int64))
    columns = {"keys": model.keys.tobytes(), "weights": model.weights.tobytes(), "bias": model.bias}
    yield pa.RecordBatch.from_pylist([columns])


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", sample_docs: int = SAMPLE_DOCS
) -> Model:
    """A model learnt from at most ``sample_docs`` labelled documents, those of least id hash.

    The sample, not the input, bounds the labels that are broadcast, the one task that trains and
    the features that it returns. Rows with a null label or id are left out, and labels without a
    document teach nothing. Without both labels the model knows no word and scores every document
    near 0.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull())
    known = known.select(F.col(id).alias("id"), F.col(label).cast("long").alias("label"), F.xxhash64(F.col(id)).alias("h"))
    known = known.orderBy("h", "id", "label").limit(sample_docs)
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
    sample = rows.orderBy("h", "id", "text").limit(sample_docs).select("text", "label")
    learnt = arrow_map(sample.coalesce(1), _train_batches, "keys binary, weights binary, bias double").first()
    keys, weights, bias = learnt or (b"", b"", START_BIAS)  # without rows there may be no task
    return Model(np.frombuffer(keys, dtype=np.uint64), np.frombuffer(weights, dtype=np.float64), bias)


def _score_batches(model, threshold: float, place: int) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at, data, offsets in w.slices(batch.column(place)):
                rows = len(offsets) - 1
                feature, sentence, row, bounds = features(data, offsets)
                p = model.value.sentences(feature, sentence, len(row))
                hits = np.flatnonzero(p >= threshold)
                raw, found = data.tobytes(), [[] for _ in range(rows)]
                for i in hits.tolist():
                    found[row[i]].append(raw[bounds[i, 0] : bounds[i, 1]].decode("utf-8", "replace").strip())
                columns = [*batch.slice(at, rows).columns, pa.array(_noisy_or(p, row, rows)), pa.array(found, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "score", "offending"])

    return run


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows with ``score`` in [0, 1] and ``offending``, the sentences of at least ``threshold`` in
    order; columns of these names are replaced, all others kept.

    Null and empty texts score 0 and offend nowhere. Rows are scored one by one, repeated ones too.
    No shuffle; the size of the model that is broadcast is bounded by the sample it was learnt from.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "offending")]
    rows = docs.select(*kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return arrow_map(rows, _score_batches(shared, threshold, kept.index(text)), f"{schema}, score double, offending array<string>")
