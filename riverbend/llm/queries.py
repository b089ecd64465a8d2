"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.tables import read_table
from . import (decontaminate, exact_text, language, licenses, line_chunks, mixing, near_text, near_vectors, periodic_runs, quality,
               token_alignment, token_counts, warc)


TOKEN_LIMIT = 2048


def op1_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    path = scratch_dir(spark, "warc")
    warc.archive_pages(pages, path)
    page_id = pages.schema["page_id"].dataType.simpleString()
    refers = F.regexp_extract(warc.field("WARC-Refers-To"), "^<urn:x-page:(.*)>$", 1).cast(page_id)
    return warc.read_archive(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        warc.field("WARC-Type").alias("record_type"), refers.alias("refers_to"))


def op2_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"]))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return licenses.find_licenses(docs, licenses.train(docs))


def op4_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    table = token_counts.prefix_table(docs, public_tokenizers.path("word_bpe_49k.json"))
    return table.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op5_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                                    read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def op6_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    model = language.train(docs.where(docs.doc_id.isNotNull() & ~language.held_out()))
    return language.predict(docs, model).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op7_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    _, scorer = quality.train(docs)
    return quality.judge(docs, scorer).drop("text")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.link_documents(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op9_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.remove_repeats(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.link_vectors(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    found = token_alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = found.documents.select("row", F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", sha.alias("groups_sha256"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return rows.join(found.contributions, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_text.label_copies(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` where every tenth id, by its CRC, repeats a stretch of its text to the end; the others as they are."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.withColumn("crc", crc).withColumn("words", F.when(F.col("crc") % 10 == 0, F.filter(
        F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")))
    sized = split.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("crc") / 10))
    at = sized.withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("slice(concat(slice(words, 1, cast(a as int)), flatten(array_repeat(slice(words, cast(a + 1 as int), cast(p as int)), "
                   "cast(1 + (n - a) div p as int)))), 1, n)")
    return at.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_planted_runs(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    best = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start as start, -r.period as period)))")
    found = periodic_runs.periodic_runs(docs).withColumn("best", best)
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'), '')")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
                        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
                        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (op1_warc_archive, op2_hierarchical_mixing, op3_license_scan, op4_prefix_token_counts, op5_spaced_seed_decontamination,
                                   op6_language_spans, op7_weak_label_quality, op8_minhash_near_dedup, op9_line_chunk_dedup, op10_embedding_near_dedup, op11_token_alignment,
                                   op12_exact_dedup, op13_periodic_runs)}
