"""Registered queries of this subpackage: each dealt operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, chat, hnsw, jaccard, langid, lexical, linededup, mixing, periodic, quality,
               sharding, suffixdedup, warc)
from .common import table


def byte_bpe_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Place of the public vocabulary file the registered queries use."""
    import public_tokenizers
    return public_tokenizers.path(name)


QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op7_line_dedup", linededup.SQL)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.op7(spark, sf_dir, table(spark, sf_dir, "documents"))


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op10(spark, table(spark, sf_dir, "documents"), byte_bpe_path())


@query("op2_mix_sources")
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op2(table(spark, sf_dir, "documents"))


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op5(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op1_chat_rotation", chat.SQL)
def op1_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op1(table(spark, sf_dir, "conversations"))


@query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op3(table(spark, sf_dir, "documents"))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op4(table(spark, sf_dir, "documents"))


@query("op9_ngram_jaccard")
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.op9(table(spark, sf_dir, "documents"))


@query("op6_hnsw")
def op6_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.op6(table(spark, sf_dir, "embeddings"))


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.op8(table(spark, sf_dir, "documents"))


@query("op13_periodic_runs", periodic.SQL)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.op13(table(spark, sf_dir, "documents"))


@query("op12_lexical_search", lexical.SQL)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.op12(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_warc", warc.SQL)
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op11(spark, table(spark, sf_dir, "pages"))
