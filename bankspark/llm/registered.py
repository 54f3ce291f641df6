"""The registered queries of this subpackage, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bankspark.llm import (
    decontamination,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    quality_rules,
    sharding,
    source_audit,
    spelling,
    substring_dedup,
    token_counts,
    token_files,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]


def _over(job: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda spark, sf_dir: job(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))


def queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": _over(line_dedup.op1_line_dedup, "documents"),
        "op2_token_files": _over(token_files.op2_token_files, "documents"),
        "op3_decontamination": _over(decontamination.op3_decontamination, "documents", "benchmark"),
        "op4_quality_rules": _over(quality_rules.op4_quality_rules, "documents"),
        "op5_token_counts": _over(token_counts.op5_token_counts, "documents"),
        "op6_mixing": _over(mixing.op6_mixing, "documents"),
        "op7_url_filter": _over(url_filter.op7_url_filter, "pages", "labels"),
        "op8_ngram_join": _over(ngram_join.op8_ngram_join, "documents"),
        "op9_sharding": _over(sharding.op9_sharding, "documents"),
        "op10_substring_dedup": _over(substring_dedup.op10_substring_dedup, "documents"),
        "op11_source_audit": _over(source_audit.op11_source_audit, "documents"),
        "op12_spelling_variants": _over(spelling.op12_spelling_variants, "documents"),
        "op13_language_id": _over(language_id.op13_language_id, "documents"),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.ORACLE,
        "op3_decontamination": decontamination.ORACLE,
        "op4_quality_rules": quality_rules.ORACLE,
        "op6_mixing": mixing.ORACLE,
        "op7_url_filter": url_filter.ORACLE,
        "op8_ngram_join": ngram_join.ORACLE,
        "op11_source_audit": source_audit.ORACLE,
        "op12_spelling_variants": spelling.ORACLE,
    }
