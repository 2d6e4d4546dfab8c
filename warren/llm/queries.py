"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warren.llm import collocations, fingerprinting, license_scan, line_dedup, mixing, packing, quality, secret_scan, simhash, spelling, token_counts, toxicity, warc
from warren.llm.common import shared_folder, table



def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda x: F.concat_ws(":", x["label"], x["word"], x["words"], x["edits"])
    return license_scan.license_scan(table(spark, sf_dir, "documents")).withColumn("spans", F.array_join(F.transform("spans", one), ","))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), path or public_tokenizers.path(packing.VOCABULARY)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path or public_tokenizers.path(token_counts.VOCABULARY))


def op5_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"), shared_folder(spark)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op10_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinting.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), shared_folder(spark))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_source_mix, op2_license_scan, op3_best_fit_packing, op4_token_counts, op5_simhash_near_duplicates, op6_toxicity, op7_quality_rules, op8_warc_revisits, op9_secret_scan, op10_syncmer_fingerprints, op11_collocations, op12_spelling_variants, op13_line_dedup)
    return {f.__name__: f for f in own} | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"op1_source_mix": mixing.ORACLE, "op7_quality_rules": quality.ORACLE, "op8_warc_revisits": warc.ORACLE, "op11_collocations": collocations.ORACLE, "op12_spelling_variants": spelling.ORACLE, "op13_line_dedup": line_dedup.ORACLE}
