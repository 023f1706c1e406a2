import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesflow.llm import whitening


def plain(rows, most=16):
    """vec_id, deviation, coordinates of (vec_id, vector) rows, with n, shares and the rank."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    fit = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in distinct])
    cov = fit.T @ fit / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    out = []
    for i, x in kept:
        off = [n * c - s for c, s in zip(x, sums, strict=True)]
        out.append((i, sum(o * o for o in off), np.array([o / n for o in off]) @ vectors))
    return n, values, values / np.trace(cov), out


def compare(found, rows, most=16):
    n, values, share, want = plain(rows, most)
    real = values > 1e-9 * max(values[0], 1e-300)
    got = {}
    for r in found:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert len(found) == len(want) * len(values) and {r.n for r in found} == {n}
    signs = {}
    for i, deviation, coordinates in want:
        for c in range(len(values)):
            r = got[i][c + 1]
            assert r.deviation == deviation and r.explained == pytest.approx(max(share[c], 0), rel=1e-9, abs=1e-12)
            if not real[c]:
                assert r.whitened is None
                continue
            value = coordinates[c] / math.sqrt(values[c])
            if abs(value) > 1e-6:
                signs.setdefault(c, set()).add(r.whitened * value > 0)
            assert abs(r.whitened) == pytest.approx(abs(value), rel=1e-6, abs=1e-8)
    assert all(len(s) == 1 for s in signs.values())
    assert all(r.identity_error < 1e-9 for r in found)


def vectors(seed, count, width):
    rng = np.random.default_rng(seed)
    made = rng.normal(size=(count, width)) * np.linspace(0.5, 3, width)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(made)]
    return rows + [(count + i, rows[0][1]) for i in range(count // 3)]


SCHEMA = "vec_id long, embedding array<float>"


@pytest.mark.parametrize("width, count", [(20, 90), (3, 40), (8, 5)])
def test_whitening_equals_brute_force(spark, width, count):
    rows = vectors(width, count, width)
    odd = [(1000, None), (1001, [None] * width), (1002, [float("nan")] + [0.0] * (width - 1)), (1003, [float("inf")] * width), (1004, [1.0]), (1005, [])]
    docs = spark.createDataFrame(rows + odd, SCHEMA).withColumns({"index": F.lit("clash"), "x": F.lit(0), "n": F.lit(1)}).repartition(4)
    compare(whitening.whiten(docs).collect(), rows)


def test_blocks_of_rows_and_columns(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 5)
    rows = vectors(4, 60, 12)
    compare(whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5), most=9).collect(), rows, 9)


def test_sums_that_need_more_than_a_long(spark):
    rows = [(i, [1.2e5 * i, 9e4 * ((7 * i) % 20), 1.1e5 * ((3 * i) % 20)]) for i in range(20)]  # sums of squares near 2**62
    compare(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), rows)
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    found = whitening.whiten(huge).collect()
    assert len(found) == 6 and all(r.deviation is None for r in found if r.vec_id != 3)


def test_odd_tables(spark):
    none = whitening.whiten(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    copies = spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0]), (1, [1.0, 2.0])], SCHEMA)
    found = whitening.whiten(copies).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in found] == [(1, 0, None, 0.0, None)] * 6


def test_query_on_a_table(spark):
    from salesflow.llm.queries import op13_whitened

    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    compare(op13_whitened(spark, sf).collect(), rows)
