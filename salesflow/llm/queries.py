"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm import bpe, jaccard, line_spread, mixing, neighbours, order_minhash, packed_ids, quality, spelling, token_counts, toxicity, warc, whitening
from salesflow.llm.common import arrow_map, table, written
from salesflow.session import work_dir

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
TOXIC_SCORE = 0.7


def _crc32(column: str):
    return F.crc32(F.col(column).cast("string"))


def _ranks() -> bytes:
    return bpe.read_ranks(public_tokenizers.path(RANKS))


def token_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes they decode to."""
    out = bpe.encode(docs, _ranks(), public_tokenizers.PATTERN, decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def _mask_edits(batches: Iterator) -> Iterator:
    """(key, from, to, put) for mail addresses and runs of eight or more digits or hexadecimal digits."""
    import re

    import pyarrow as pa

    personal = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]*\w|\b[0-9a-f]{8,}\b")
    for batch in batches:
        keys, starts, stops, puts = [], [], [], []
        for key, start, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for match in personal.finditer(text):
                keys.append(key)
                starts.append(start + match.start())
                stops.append(start + match.end())
                puts.append("[mail]" if "@" in match[0] else "[number]")
        yield pa.RecordBatch.from_pydict(
            {"key": pa.array(keys, pa.int64()), "from": pa.array(starts, pa.int64()), "to": pa.array(stops, pa.int64()), "put": pa.array(puts, pa.string())}
        )


def op2_edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after personal data is masked."""
    ranks, pattern = _ranks(), public_tokenizers.PATTERN
    leaves = token_counts.build_leaves(table(spark, sf_dir, "documents"), ranks, pattern)
    trees = token_counts.build_trees(leaves)
    edits = arrow_map(leaves.select("key", "start", "text"), _mask_edits, "key long, from long, to long, put string")
    edits = written(edits, "mask-edits")
    changed, after = token_counts.apply_edits(leaves, trees, edits, ranks, pattern)
    documents = leaves.groupBy("key", "id").agg(F.count("*").alias("n_leaves"))
    n_edits = edits.groupBy("key").agg(F.count("*").alias("n_edits"))
    encoded = changed.groupBy("key").agg(F.count("*").alias("n_leaves_encoded"))
    out = documents.join(token_counts.counts(trees), "key").join(token_counts.counts(after).withColumnRenamed("n_tokens", "n_tokens_after"), "key")
    out = out.join(n_edits, "key", "left").join(encoded, "key", "left")
    zero = F.lit(0)
    return out.select(
        F.col("id").alias("doc_id"), "n_tokens", "n_tokens_after", F.coalesce("n_edits", zero).alias("n_edits"), "n_leaves",
        F.coalesce("n_leaves_encoded", zero).alias("n_leaves_encoded"),
    )


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_components(table(spark, sf_dir, "documents"))


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = warc.read_archives(spark, folder, with_payload=False)
    page = lambda name: F.try_to_number(F.regexp_extract(name, "^urn:page:(-?[0-9]+)$", 1), F.lit("S" + "9" * 19)).cast("long")
    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to")
    )


def op6_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "packed-ids")
    with open(public_tokenizers.path(TOKENIZER)) as file:
        tokenizer = file.read()
    manifest = packed_ids.write_ids(table(spark, sf_dir, "documents"), folder, tokenizer, END_ID, added=True)
    read = packed_ids.read_ids(spark, folder, manifest)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learnt from the labelled documents that are not held out."""
    labels = table(spark, sf_dir, "labels").where(_crc32("doc_id") % 3 != 1)
    return toxicity.fit(table(spark, sf_dir, "documents"), labels)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), toxicity_model(spark, sf_dir))
    held_out = F.coalesce(_crc32("doc_id") % 3 == 1, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"), F.size("offending").alias("n_offending")
    )


def op8_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_spread.remove_spread_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_spread", "n_removed", F.md5("text").alias("text_md5"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.clean(table(spark, sf_dir, "documents"), with_text=False)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_bad_lines", "lost_chars"
    )


def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edits_and_neighbours(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.spelling_variants(table(spark, sf_dir, "documents"), noise=spelling.NOISE)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_byte_bpe, op2_edited_token_counts, op3_source_mix, op4_jaccard_components, op5_warc_round_trip, op6_packed_ids,
        op7_toxicity, op8_line_spread, op9_nearest, op10_quality, op11_order_minhash, op12_spelling_variants,
        op13_whitened,
    )
}
