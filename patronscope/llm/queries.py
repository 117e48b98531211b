"""One query per operator over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronscope.llm import language, oracle, toxicity
from patronscope.llm.alignment import align_corpus
from patronscope.llm.bpe import bpe_round_trip
from patronscope.llm.common import documents, table
from patronscope.llm.decontaminate import contaminated
from patronscope.llm.packing import Limits, pack_documents
from patronscope.llm.quality import quality_rules
from patronscope.llm.simhash import simhash_groups
from patronscope.llm.substring_dedup import remove_repeated_windows
from patronscope.llm.suffix_dedup import remove_repeats
from patronscope.llm.token_counts import token_counts
from patronscope.llm.warc import archive_table
from patronscope.llm.whitening import whitened_rows
from patronscope.session import scratch_path

TOKEN_LIMIT = 512
END_ID = 2
SEQUENCE = Limits(tokens=1024, documents=1024, cost=1024 * 1024)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return remove_repeats(docs).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return remove_repeated_windows(docs).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    vocabulary = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
    counted = token_counts(docs, vocabulary)
    return counted.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return quality_rules(docs, keep_text=False).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return simhash_groups(docs).select(
        "row.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    ranks = Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes()
    return bpe_round_trip(docs, ranks, public_tokenizers.PATTERN).select(
        "row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    model = language.fit(documents(spark, sf_dir).select("lang", "text"))
    return language.identify(pages, model).select("row.page_id", "lang", "probability", "text_lang", "declared")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    who = F.col("row.doc_id")
    held_out = F.coalesce(toxicity.fold(who) == toxicity.HELD_OUT, F.lit(False))
    return toxicity.score(docs, model).select(
        who.alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("passages"),
        F.aggregate("passages", F.lit(0).cast("long"), lambda total, p: total + p["end"] - p["start"]).alias("passage_tokens"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    records = archive_table(pages, scratch_path(spark, "warc"))
    return records.where("problem is null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SEQUENCE`` limits attention cost and documents to what 1024 tokens can hold, so the token capacity decides."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    vocabulary = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
    packed = pack_documents(docs, vocabulary, public_tokenizers.PATTERN, END_ID, SEQUENCE)
    return packed.select("row.doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = whitened_rows(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = rows.select("row.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    n, explained, error = (model.n, model.explained.tolist(), model.identity_error) if model else (0, [], 0.0)
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, explained)).cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    vocabulary = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    scored, _ = align_corpus(docs, vocabulary, public_tokenizers.PATTERN, model)
    return scored.select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_dedup, op2_substring_dedup, op3_token_counts, op4_quality_rules, op5_simhash, op6_bpe, op7_language,
        op8_decontamination, op9_toxicity, op10_warc, op11_packing, op12_whitening, op13_alignment,
    )
}
ORACLE: dict[str, str] = {
    "op4_quality_rules": oracle.QUALITY_RULES,
    "op10_warc": oracle.WARC,
}
