import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesflow.llm import spelling

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows, noise=97):
    count = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            code = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if noise and code % noise == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(words):
    near = {w: [] for w in words}
    for a in words:
        for b in words:
            if one_edit(a, b):
                near[a].append(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def texts(seed):
    rng = random.Random(seed)
    letters = "abcdeABéèÿÀ×"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaa", "b" * 300]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randint(0, 60)):
            w = base[min(int(rng.expovariate(0.08)), len(base) - 1)]
            if rng.random() < 0.3:
                at, kind = rng.randrange(len(w)), rng.randrange(3)
                put = rng.choice(letters) if kind < 2 else ""
                w = w[:at] + put + w[at + (kind > 0) :]
            words.append(w)
        rows.append((i - 20, rng.choice([" ", "\n", "1", "漢", "."]).join(words)))
    return [*rows, (None, "hello hello hello hellos"), (5, None), (6, ""), (7, "é" * 5 + " 12 " + "é" * 5 + "-" + "é" * 5), (7, "helo1helo hallo hallo hallo")]


@pytest.mark.parametrize("seed, settings", [(1, {}), (2, {"broadcast_bytes": 200, "chunk_blocks": 2}), (3, {"broadcast_bytes": 1, "chunk_blocks": 1})])
def test_variants_equal_brute_force(spark, seed, settings):
    rows = texts(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("clash"), "n": F.lit(1)}).repartition(3)
    want = plain_variants(plain_words(rows))
    got = [tuple(r) for r in spelling.spelling_variants(docs, noise=97, **settings).collect()]
    assert set(got) == want and len(got) == len(want)
    assert any(r[1] for r in want)


def test_query_equals_brute_force(spark):
    from salesflow.llm.queries import op12_spelling_variants

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in op12_spelling_variants(spark, sf).collect()}
    assert got == plain_variants(plain_words(rows))


def test_chains_and_ties(spark):
    rows = [("chain", 3), ("chains", 6), ("chainss", 12), ("chainsss", 25), ("abcde", 5), ("abcdf", 9), ("abcdg", 9), ("lonely", 4), ("zbcde", 10)]
    got = {r.word: (r.form, r.root, r.n_near, r.form_n) for r in spelling.variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got["chain"] == ("chains", "chainsss", 1, 6) and got["chainsss"] == (None, "chainsss", 1, None)
    assert got["abcde"] == ("zbcde", "zbcde", 3, 10) and got["lonely"] == (None, "lonely", 0, None)
    assert got["abcdf"] == (None, "abcdf", 2, None)
    ties = spark.createDataFrame([("abcde", 4), ("abcdg", 9), ("abcdf", 9)], "word string, n long")
    assert {r.word: r.form for r in spelling.variants(ties).collect()} == {"abcde": "abcdf", "abcdg": None, "abcdf": None}


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(empty, noise=97).collect() == []
    assert spelling.spelling_variants(spark.createDataFrame([(1, "ab cd"), (2, None)], empty.schema)).collect() == []


def test_a_very_long_text_counts_whole(spark):
    text = "Words " * 300_000 + "wards wards wards"
    got = {r.word: (r.n, r.form) for r in spelling.spelling_variants(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()}
    assert got == {"words": (300_000, None), "wards": (3, "words")}
