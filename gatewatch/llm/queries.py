"""Registered queries of this folder: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.llm import (conversation, decontaminate, html_extract, language_id, line_dedup, mixing, quality,
                           secrets, sharding, simhash, token_counts, vector_codes, warc)
from gatewatch.llm.common import read


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_counts.token_counts(docs, token_counts.load_vocabulary(spark))
    return out.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "n_words", "n_tokens")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs).select("doc_id", F.col("shard_bytes_row").alias("n_bytes"), "shard", "shard_depth")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language_id.train(docs)
    rows = docs.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"),
                       language_id.predict_column(model, F.col("text"), spark).alias("p"))
    return rows.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))
    count = lambda c: F.size(c).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secrets.listing("assign", "access", "hex"), 256).alias("base_sha256"),
        secrets.listing(*secrets.KINDS).alias("spans"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", *quality.MEASURES, (~quality.kept(F.col("failed"), "base")).alias("base_failed"),
                       quality.kept(F.col("failed")).alias("kept"), F.col("failed").cast("long").alias("failed_rules"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(read(spark, sf_dir, "pages"))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = vector_codes.encode(read(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(codes.rows).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codes.books_sha256()).alias("codebooks_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation.damaged(read(spark, sf_dir, "conversations"))
    return conversation.repaired_digests(rows, conversation.search_edits(rows))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_sharding, op3_decontamination, op4_language_id, op5_secret_scan, op6_simhash_near_dedup,
    op7_html_extraction, op8_quality_rules, op9_source_mixing, op10_warc, op11_line_dedup, op12_vector_codes, op13_conversation_repair, pipeline)}
