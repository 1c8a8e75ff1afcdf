"""Queries over the test tables, one per operator, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.chat import CHAT_SQL, format_chats
from tallybrook.llm.common import read, stored
from tallybrook.llm.exact_dups import EXACT_SQL, exact_duplicates
from tallybrook.llm.lexical import RANKED_SQL, ranked_documents
from tallybrook.llm.mixing import MIX_SQL, mix_plan
from tallybrook.llm.near_dups import near_duplicates
from tallybrook.llm.packing import pack_documents
from tallybrook.llm.quality import judged, quality_counts
from tallybrook.llm.sharding import record_size, shards
from tallybrook.llm.spelling import spelling_variants
from tallybrook.llm.token_files import round_trip
from tallybrook.llm.topk import TOPK_SQL, top_k
from tallybrook.llm.toxicity import THRESHOLD, fit, held_out, toxicity
from tallybrook.llm.urls import URL_SQL, judge_urls


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 tokens; one row per piece."""
    return pack_documents(read(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations that no longer one continues, rendered."""
    return format_chats(read(spark, sf_dir, "conversations"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the url of every page."""
    return judge_urls(read(spark, sf_dir, "pages").select("page_id", "url")).select(
        "row.page_id", "host", "path", "rule", "template", "purity", "verdict"
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of each whole text, learned from labels that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, fit(docs, read(spark, sf_dir, "labels"))).select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in random order in 40 shards with row counts at most one apart."""
    text = F.col("row.text")
    return shards(read(spark, sf_dir, "documents")).select(
        "row.doc_id",
        record_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes of them."""
    plan = mix_plan(read(spark, sf_dir, "documents"))
    return plan.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of all documents as read back from the written matrix, with checksums of their ids."""
    return round_trip(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        "length",
        "sequence_id",
        "offset",
        F.crc32("ids").alias("ids_crc32"),
        F.crc32("positions").alias("positions_crc32"),
    )


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of all vectors for each vector whose id is divisible by 100."""
    vectors = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return top_k(vectors, F.col("id") % 100 == 0)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the counts of the rules and the verdict of their votes."""
    counted = quality_counts(read(spark, sf_dir, "documents").select("doc_id", "text"))
    counted = stored(counted.select(F.struct("row.doc_id").alias("row"), "counts"), "quality")
    return judged(counted).select(
        "row.doc_id",
        *(f"counts.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        "base_failed",
        "kept",
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of each document under links of four-word shingles."""
    return near_duplicates(read(spark, sf_dir, "documents"), size=4)


def op11_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the row that stays of those with the same text."""
    return exact_duplicates(spark, f"{sf_dir}/documents.parquet").select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of all documents with the spelling that each is a variant of."""
    return spelling_variants(read(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of all documents for each item of the benchmark."""
    return ranked_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


LLM_QUERIES = {
    "op1_packing": op1_packing,
    "op2_chat_format": op2_chat_format,
    "op3_url_filter": op3_url_filter,
    "op4_toxicity": op4_toxicity,
    "op5_sharding": op5_sharding,
    "op6_mixing": op6_mixing,
    "op7_token_files": op7_token_files,
    "op8_top_k": op8_top_k,
    "op9_quality_rules": op9_quality_rules,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_exact_duplicates": op11_exact_duplicates,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_lexical_search": op13_lexical_search,
}
LLM_ORACLES: dict[str, str] = {
    "op2_chat_format": CHAT_SQL,
    "op3_url_filter": URL_SQL,
    "op6_mixing": MIX_SQL,
    "op8_top_k": TOPK_SQL,
    "op11_exact_duplicates": EXACT_SQL,
    "op13_lexical_search": RANKED_SQL,
}
