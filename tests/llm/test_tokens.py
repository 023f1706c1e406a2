import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as tokenizers_data
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesflow.llm import bpe, packed_ids, token_counts
from salesflow.llm.queries import END_ID, QUERIES, RANKS, TOKENIZER
from salesflow.session import work_dir

RAW = bpe.read_ranks(tokenizers_data.path(RANKS))
PATTERN = tokenizers_data.PATTERN
TEXTS = [
    None, "", " ", "a", "Hello  world\n\n x", "it's we'll 12345 !!! 　 wide \xa0 space", "x" * 700, " " * 300 + "end",
    "word " * 300, "été naïve \U0001f600 " * 40, "a\tb\r\nc", "same text", "same text", "\n".join(["line of text."] * 60),
]


def rows(spark, texts=TEXTS):
    data = [(i if i != 3 else None, t, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id long, text string, ids string, key int")


def reference(text):
    encoding, _ = bpe._encoding(RAW, PATTERN)
    return encoding.encode_ordinary(text or "")


@pytest.mark.parametrize("chunk, overlap", [(64, 24), (200, 50), (16_384, 1_024)])
def test_encoding_equals_the_library_whatever_the_chunks(spark, chunk, overlap):
    found = bpe.encode(rows(spark), RAW, PATTERN, chunk=chunk, overlap=overlap, decoded=True).collect()
    got = {(r.doc_id, bytes(r.ids), r.n_tokens, bytes(r.decoded)) for r in found}
    want = set()
    for i, text in enumerate(TEXTS):
        ids = reference(text)
        want.add((i if i != 3 else None, np.array(ids, "<u4").tobytes(), len(ids), (text or "").encode()))
    assert got == want and len(found) == len(TEXTS)


def test_decoding_restores_bytes_and_keeps_columns(spark):
    decoded = bpe.decode(bpe.encode(rows(spark), RAW, PATTERN).withColumn("other", F.lit(7)), RAW, PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in decoded) == sorted((t or "").encode() for t in TEXTS)
    assert {r.other for r in decoded} == {7}


def test_empty_tables(spark):
    none = rows(spark).limit(0)
    assert bpe.encode(none, RAW, PATTERN).count() == 0
    leaves = token_counts.build_leaves(none, RAW, PATTERN)
    assert token_counts.counts(token_counts.build_trees(leaves)).count() == 0


def test_chunks_must_exceed_the_overlap(spark):
    with pytest.raises(ValueError):
        bpe.encode(rows(spark), RAW, PATTERN, chunk=100, overlap=80)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60_000), max_size=400))
def test_packing_round_trip(ids):
    ids = np.array(ids, dtype=np.uint64)
    assert (packed_ids.unpack(packed_ids.pack(ids)) == ids).all()


def test_packed_files_against_the_library(spark):
    from tokenizers import Tokenizer

    with open(tokenizers_data.path(TOKENIZER)) as file:
        raw = file.read()
    library = Tokenizer.from_str(raw)
    library.encode_special_tokens = True
    texts = [*TEXTS, "<|endoftext|> is text", "tail"]
    docs = rows(spark, texts).repartition(3)
    folder = work_dir(spark, "packed-test")
    manifest = packed_ids.write_ids(docs, folder, raw, END_ID)
    got = packed_ids.read_ids(spark, folder, manifest).orderBy("start").collect()
    order = sorted(range(len(texts)), key=lambda i: (i != 3, i))
    start = 0
    for i, row in zip(order, got, strict=True):
        ids = np.array([*library.encode(texts[i] or "", add_special_tokens=False).ids, END_ID], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, bytes(row.ids)) == (i if i != 3 else None, start, len(ids), ids.tobytes())
        start += len(ids)
    none = packed_ids.write_ids(docs.limit(0), work_dir(spark, "packed-none"), raw, END_ID)
    assert packed_ids.read_ids(spark, folder, none).count() == 0


def test_added_tokens_are_matched_as_the_library_does(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(str(tokenizers_data.path(TOKENIZER)))
    texts = ["a <|endoftext|> b", "plain text", "x<|endoftext|>", "<|endoftext|><|endoftext|> ", "<|endof text|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op6_packed_ids"](spark, str(tmp_path)).collect()}
    want, start = {}, 0
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, END_ID], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want and 50256 in library.encode(texts[0], add_special_tokens=False).ids


PIECES = ["a", "B", "é", "×", "÷", "ß", " ", "  ", "\n", "\t", "\r", "\xa0", "\u2003", "\u3000", "\x0b", "\x1c", "\x85", ".", ",", "'s", "'", "'ll", "!"]
PIECES += ["?", ")", "(", "…", "“", "1", "23", "ñ", "<|endoftext|>", "<|", "日本", "ÿ", "À", "\u0301", "²", "ª", "😀", "word", "The"]


@pytest.mark.parametrize("held, size", [(50, 300), (600_000, 100_000)])
def test_batches_give_what_the_library_gives(monkeypatch, held, size):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from salesflow.llm.words import slices

    monkeypatch.setattr(packed_ids, "UNITS_HELD", held)
    monkeypatch.setattr(packed_ids, "NEW_PARTS", 40)
    with open(tokenizers_data.path(TOKENIZER)) as file:
        raw = file.read()
    rng = np.random.default_rng(held)
    texts = ["".join(rng.choice(PIECES, int(rng.integers(0, 30)))) for _ in range(4_000)] + [None, "", "word. " * 50_000]
    encoder = packed_ids.Encoder(raw, added=True)
    got = [ids.tolist() for _, data, offsets in slices(pa.array(texts), size) for ids in encoder.batch(data, offsets)]
    assert got == [x.ids for x in Tokenizer.from_str(raw).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_documents_longer_than_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packed_ids, "BLOCK", 50)
    from pyarrow import fs

    files, name = fs.LocalFileSystem(), str(tmp_path / "ids.s8b")
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 50_000, n, dtype=np.uint32) for n in (3, 0, 170, 49, 1, 0, 900, 12)]
    writer = packed_ids.Writer(files.open_output_stream(name))
    for i, ids in enumerate(docs):
        writer.add(i, ids)
    writer.close()
    with files.open_input_file(name) as file:
        reader = packed_ids.Reader(file)
        found = [x for b in range(len(reader.offsets) - 1) for x in reader.documents(b, b + 1)]
    assert [k for k, _, _ in found] == list(range(8))
    assert all((ids == docs[k]).all() for k, _, ids in found)


def edited(text, edits):
    for a, b, put in sorted(edits, reverse=True):
        text = text[:a] + put + text[b:]
    return text


@pytest.mark.parametrize("leaf", [8, 40, 1_024])
def test_counts_follow_edits(spark, leaf, monkeypatch):
    monkeypatch.setattr(token_counts, "RUN_BLOCK", 3)
    rng = np.random.default_rng(leaf)
    leaves = token_counts.build_leaves(rows(spark), RAW, PATTERN, leaf=leaf)
    trees = token_counts.build_trees(leaves)
    keys = {r.key: r.text for r in leaves.groupBy("key").agg(F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("leaf", "text"))), lambda x: x.text)).alias("text")).collect()}
    edits = {}
    for key, text in keys.items():
        cut = sorted(rng.choice(len(text) + 1, size=min(6, len(text) + 1) // 2 * 2, replace=False).tolist())
        edits[key] = [(a, b, str(rng.choice(["", " ", "new words", "\n", "x"]))) for a, b in zip(cut[::2], cut[1::2], strict=True)]
    data = [(k, a, b, put) for k, es in edits.items() for a, b, put in es] + [(10**9, 0, 1, "x"), (0, None, 1, "x")]
    table = spark.createDataFrame(data, "key long, `from` long, `to` long, put string")
    changed, after = token_counts.apply_edits(leaves, trees, table, RAW, PATTERN, leaf=leaf)
    before = {r.key: r.n_tokens for r in token_counts.counts(trees).collect()}
    now = {r.key: r.n_tokens for r in token_counts.counts(after).collect()}
    assert before == {k: len(reference(t)) for k, t in keys.items()}
    assert now == {k: len(reference(edited(t, edits[k]))) for k, t in keys.items()}
    if leaf == 8:
        assert changed.count() < leaves.count()


def test_only_leaves_that_an_edit_ties_together_are_one_run(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "RUN_BLOCK", 3)
    text = "abcde " * 4_000
    leaves = token_counts.build_leaves(rows(spark, [text]), RAW, PATTERN, leaf=11)
    trees = token_counts.build_trees(leaves)
    held = leaves.orderBy("leaf").collect()
    edits = [(r.start + 2, r.start + 3, "zz") for r in held if r.stop - r.start > 4 and r.leaf % 50]  # inside a leaf
    edits += [(r.start - 1, r.start + 1, "") for r in held if r.leaf and r.leaf % 50 == 0]  # across a cut
    edits.append((held[100].start + 4, held[120].start + 2, "long"))
    edits = [e for e in edits if e[2] == "long" or not (held[100].start + 2 <= e[0] <= held[120].start + 3)]
    table = spark.createDataFrame([(held[0].key, *e) for e in edits], "key long, `from` long, `to` long, put string")
    changed, after = token_counts.apply_edits(leaves, trees, table, RAW, PATTERN, leaf=11)
    assert token_counts.counts(after).first().n_tokens == len(reference(edited(text, edits)))
    assert changed.where("text <> ''").count() > len(held) * 0.9


def test_digest_query_matches_a_plain_run(spark, testdata):
    from salesflow.llm.queries import op1_byte_bpe

    got = {r.doc_id: r for r in op1_byte_bpe(spark, str(testdata / "sf0.001")).collect()}
    docs = spark.read.parquet(str(testdata / "sf0.001/documents.parquet")).collect()
    for doc in docs:
        ids = reference(doc.text)
        assert got[doc.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc.doc_id].decoded_sha256 == hashlib.sha256(doc.text.encode()).hexdigest()
        assert got[doc.doc_id].n_tokens == len(ids)


def test_masked_counts_query_matches_a_plain_run(spark, testdata):
    from salesflow.llm.queries import op2_edited_token_counts

    mask = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]*\w|\b[0-9a-f]{8,}\b")
    got = {r.doc_id: r for r in op2_edited_token_counts(spark, str(testdata / "sf0.001")).collect()}
    assert any(r.n_edits for r in got.values())
    for doc in spark.read.parquet(str(testdata / "sf0.001/documents.parquet")).collect():
        new = mask.sub(lambda m: "[mail]" if "@" in m[0] else "[number]", doc.text)
        assert (got[doc.doc_id].n_tokens, got[doc.doc_id].n_tokens_after) == (len(reference(doc.text)), len(reference(new)))


def test_crc_query(spark, testdata):
    from salesflow.llm.queries import op6_packed_ids

    got = op6_packed_ids(spark, str(testdata / "sf0.001")).orderBy("start").collect()
    docs = spark.read.parquet(str(testdata / "sf0.001/documents.parquet")).orderBy("doc_id").collect()
    start = 0
    for row, doc in zip(got, docs, strict=True):
        ids = np.array([*reference(doc.text), END_ID], "<u4")
        assert tuple(row) == (doc.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
