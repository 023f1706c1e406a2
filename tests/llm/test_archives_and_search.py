import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salesflow.llm import neighbours, warc
from salesflow.session import work_dir

PAGES = [(1, "http://a/ b", "<p>one</p>"), (2, None, "<p>two</p>"), (3, "u", "<p>one</p>"), (4, "u", None), (5, "u", ""), (None, "u", "<p>two</p>"), (7, "u", "é" * 5000)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit("clash"))


def test_archives_round_trip(spark):
    folder = work_dir(spark, "warc-test")
    warc.write_archives(pages(spark).repartition(3), folder, file_bytes=300)
    records = warc.read_archives(spark, folder, range_bytes=200).collect()
    got = {(r.record_id, r.type, r.refers_to, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload)) for r in records}
    want = set()
    for page, _, html in PAGES:
        body = (html or "").encode()
        keeper = max((p for p, _, h in PAGES if (h or "") == (html or "") and p is not None), default=None)
        revisit = page is not None and keeper is not None and page < keeper
        name = "urn:page:" if page is None else f"urn:page:{page}"
        want.add((name, "revisit" if revisit else "response", f"urn:page:{keeper}" if revisit else None, len(body), warc.digest(body), None if revisit else body))
    assert got == want and len(records) == len(PAGES)
    assert warc.gaps(spark, folder, warc.read_archives(spark, folder)).count() == 0
    none = work_dir(spark, "warc-none")
    assert warc.write_archives(pages(spark).limit(0), none).count() == 0


class Held:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_skips_what_is_broken(packed):
    plain = [warc.record("response", f"urn:page:{i}", (f"page {i} WARC/1.1\r\n \x1f " * 30).encode(), "http://x") for i in range(12)]
    parts = [warc.member(x) if packed else x for x in plain]
    broken = [*parts]
    broken[3] = broken[3][: len(broken[3]) // 2]  # cut off
    middle = len(broken[6]) // 2
    broken[6] = broken[6][:middle] + bytes([broken[6][middle] ^ 0xFF]) + broken[6][middle + 1 :]  # flipped
    broken.insert(9, b"\x1f\x8b\x08 noise WARC/1.1\r\n more noise")
    data = b"".join(broken)
    for step in (len(data), 700, 97):
        found = [row for a in range(0, len(data), step) for row in warc.salvage(Held(data), len(data), a, min(a + step, len(data)))]
        names = [row[3] for row in found]
        assert names == [f"urn:page:{i}" for i in range(12) if i not in (3, 6)]
        assert all(warc.digest(row[-1]) == row[6] for row in found)


@pytest.mark.parametrize("range_bytes", [400, 517, 1000, 10**6])
@pytest.mark.parametrize("packed", [False, True])
def test_records_do_not_depend_on_ranges(spark, tmp_path, range_bytes, packed):
    """Whole records within payloads, some reaching beyond where their host ends, are no records of the file."""
    inner = [warc.record("response", f"urn:page:{900 + i}", f"inner {i} ".encode() * 30) for i in range(4)]
    hosts = [warc.record("response", f"urn:page:{i}", b"x" * 300 * i + inner[i] + b"y" * 200) for i in range(4)]
    cut = warc.record("response", "urn:page:800", b"z" * 900)[:400]  # claims bytes of what follows it
    hosts.insert(2, warc.record("response", "urn:page:7", b"q" * 700 + cut))
    (tmp_path / "a.warc").write_bytes(b"".join(warc.member(h) if packed else h for h in hosts))
    (tmp_path / "b.warc").write_bytes(hosts[1])
    for with_payload in (False, True):
        records = warc.read_archives(spark, str(tmp_path), with_payload, range_bytes).collect()
        found = sorted((r.path.rsplit("/")[-1], r.record_id) for r in records)
        assert found == sorted([("a.warc", f"urn:page:{i}") for i in (0, 1, 2, 3, 7)] + [("b.warc", "urn:page:1")])
        assert not with_payload or all(warc.digest(bytes(r.payload)) == r.payload_digest for r in records)


def test_an_empty_folder_has_no_records(spark, tmp_path):
    assert warc.read_archives(spark, str(tmp_path)).count() == 0


def test_repeated_rows_of_the_largest_id_are_responses(spark):
    folder = work_dir(spark, "warc-repeated")
    rows = [(9, "u", "<p>same</p>"), (9, "u", "<p>same</p>"), (4, "u", "<p>same</p>")]
    warc.write_archives(pages(spark, rows), folder)
    records = warc.read_archives(spark, folder, with_payload=False).collect()
    assert sorted((r.record_id, r.type, r.refers_to) for r in records) == [
        ("urn:page:4", "revisit", "urn:page:9"), ("urn:page:9", "response", None), ("urn:page:9", "response", None)
    ]


def test_gaps_are_reported(spark, tmp_path):
    good = [warc.member(warc.record("response", f"urn:page:{i}", b"x" * 50)) for i in range(3)]
    (tmp_path / "a.warc.gz").write_bytes(good[0] + b"?" * 40 + good[1] + good[2][:-9])
    (tmp_path / "b.warc").write_bytes(b"nothing here")
    records = warc.read_archives(spark, str(tmp_path))
    assert records.count() == 2
    got = {(r.path.rsplit("/", 1)[1], r.start, r.stop) for r in warc.gaps(spark, str(tmp_path), records).collect()}
    a, b = len(good[0]), len(good[0]) + 40 + len(good[1])
    assert got == {("a.warc.gz", a, a + 40), ("a.warc.gz", b, b + len(good[2]) - 9), ("b.warc", 0, 12)}


def exact(rows, k=20):
    out = {}
    for i, x in rows:
        if i % 20 == 0:
            scores = sorted(((-float(np.dot(x, y)), j) for j, y in rows if j != i))
            out[i] = [j for _, j in scores[:k]]
    return out


def test_recall_against_brute_force(spark, testdata):
    table = spark.read.parquet(str(testdata / "sf0.1/embeddings.parquet"))
    want = exact([(r.vec_id, np.array(r.embedding, dtype=np.float64)) for r in table.collect()])
    found = neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect()
    got = {}
    for row in sorted(found):
        got.setdefault(row.query_id, []).append(row.vec_id)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits / (20 * len(want)) >= 0.9


def test_recall_with_mixed_norms_and_one_long_vector(spark, testdata):
    rng = np.random.default_rng(6)
    rows = [(r.vec_id, np.array(r.embedding, dtype=np.float64)) for r in spark.read.parquet(str(testdata / "sf0.1/embeddings.parquet")).collect()]
    rows = [(i, x * (100 if place == 7 else rng.uniform(0.7, 1.4))) for place, (i, x) in enumerate(rows)]
    want = exact(rows)
    table = spark.createDataFrame([(i, x.tolist()) for i, x in rows], "vec_id long, embedding array<double>")
    got = {}
    for row in neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    assert sum(len(got[q] & set(want[q])) for q in want) / (20 * len(want)) >= 0.9


def test_neighbour_graph_is_a_row_for_each_home(spark, testdata):
    rows = [(r.vec_id, np.array(r.embedding, dtype=np.float32)) for r in spark.read.parquet(str(testdata / "sf0.1/embeddings.parquet")).collect()]
    vectors = spark.createDataFrame([(i, bytearray(np.append(x, np.float32(0)).tobytes())) for i, x in rows], "node long, vec binary")
    homes = neighbours.homes(vectors)
    graph = neighbours.neighbour_graph(homes)
    assert graph.count() <= homes.count() <= 16  # a row for each edge would be 96,000
    node = {r.home: np.frombuffer(r.a, dtype=np.int64) for r in homes.collect()}
    assert sorted(np.concatenate(list(node.values())).tolist()) == sorted(i for i, _ in rows)
    got, bits = {}, neighbours.PLACE_BITS
    for r in graph.collect():
        for u, v in zip(np.frombuffer(r.a, dtype=np.int32).tolist(), np.frombuffer(r.b, dtype=np.int64).tolist(), strict=True):
            got.setdefault(int(node[r.home][u]), set()).add(int(node[v >> bits][v & ((1 << bits) - 1)]))
    ids, x = np.array([i for i, _ in rows]), np.array([x for _, x in rows])
    near = 2 * x @ x.T - (x * x).sum(axis=1)
    np.fill_diagonal(near, -np.inf)
    best = np.argsort(-near, axis=1)[:, : neighbours.NEIGHBOURS]
    assert all(len(v) == neighbours.NEIGHBOURS and u not in v for u, v in got.items()) and len(got) == len(rows)
    assert np.mean([len(got[int(ids[i])] & set(ids[best[i]].tolist())) for i in range(len(ids))]) >= 0.9 * neighbours.NEIGHBOURS


def test_recall_of_many_queries_in_lanes_and_salts(spark, testdata, monkeypatch):
    monkeypatch.setattr(neighbours, "SALT_QUERIES", 300)
    table = spark.read.parquet(str(testdata / "sf0.1/embeddings.parquet"))
    rows = [(r.vec_id, np.array(r.embedding, dtype=np.float64)) for r in table.collect()]
    got = {}
    for row in neighbours.nearest(table, F.lit(True)).collect():
        got.setdefault(row.query_id, []).append(row.vec_id)
    ids, x = np.array([i for i, _ in rows]), np.array([x for _, x in rows])
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    best = np.argsort(-s, axis=1)[:, :20]
    assert len(got) == len(rows) and all(len(set(v)) == len(v) == 20 for v in got.values())
    assert sum(len(set(got[int(ids[i])]) & set(ids[best[i]].tolist())) for i in range(len(ids))) >= 0.9 * 20 * len(ids)


def test_equal_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 0.5], 1) for i in range(60)] + [(100 + i, rng.standard_normal(3).tolist(), 1) for i in range(30)]
    valid = [(i, np.array(x)) for i, x, _ in rows]
    odd = [(200, None, 1), (220, [0.0, 0.0, 0.0], 1), (240, [1.0, float("nan"), 1.0], 1), (260, [1.0, None, 1.0], 1), (280, [1.0], 1), (300, [float("inf"), 1.0, 1.0], 1), (None, [9.0, 9.0, 9.0], 1), (0, [1.0, 2.0, 0.5], 1)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, node int")
    got = {}
    for row in sorted(neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect()):
        got.setdefault(row.query_id, []).append(row.vec_id)
    assert got == exact(valid)
    assert neighbours.nearest(table.limit(0), F.lit(True)).count() == 0


def test_pipeline(spark, testdata):
    folder = str(testdata / "sf0.001")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        path = work_dir(spark, "pipeline-test")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert {r.doc_id for r in docs.collect()} <= before
    got = corpus_pipeline.run(spark, folder)
    assert got.count() == docs.count()
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0


def test_mostly_spread_documents_stay_whole_only_as_copies(spark):
    nav, copy = "Home and away, the front page.\nAll about us, in a few words.", "A shared passage, line one.\nA shared passage, line two."
    own = [" ".join(f"own{i}w{j}" for j in range(30)) + "." for i in range(7)]
    rows = [(i, f"{nav}\n{own[i]}", "en", f"s{i}", 0) for i in range(7)] + [(20 + i, copy, "en", f"s{i}", 0) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_spread_lines(spark, docs, "").collect()}
    assert got == {i: (t, len(t)) for i, t in [*enumerate(own), *((20 + i, copy) for i in range(6))]}


def test_pipeline_with_odd_rows(spark, testdata):
    folder = str(testdata / "sf0.001")
    text = "A sentence that is long enough to be a set of shingles."
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, None, None, None), (None, None, None, None, None), (3, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder)
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "3", "None"]


def test_pipeline_stages_decide_by_row(spark):
    """One id with unlike texts, null ids and equal rows: no text is lost with another's group, none is taken too often."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(12)) for x in "abc")
    rows = [(1, a), (1, b), (2, b + " more"), (None, c), (None, c), (None, a), (3, None), (3, ""), (None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (1, b), (None, c), (3, None), (3, ""), (None, None)], key=str)
    many = [(None, "w x y", "en", "s", 5)] * 40 + [(7, f"w{i} x y", "en", "t", 5) for i in range(40)]
    mixed = corpus_pipeline.mix_sources(spark, spark.createDataFrame(many, schema), "").collect()
    assert sum(r.source == "s" for r in mixed) == 80 and sum(r.source == "t" for r in mixed) == 40
    none = docs.limit(0)
    assert corpus_pipeline.drop_near_duplicates(spark, none, "").count() == corpus_pipeline.mix_sources(spark, none, "").count() == 0
