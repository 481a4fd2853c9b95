"""From raw documents to a mixed, tokenised training corpus.

Each stage takes all that its predecessor kept, written as Parquet in the shared
folder and read again, and all but the last return the columns of documents:

1. language_id: documents whose language cannot be told go.
2. line_dedup: lines that many documents hold stay in one of them only.
3. near_duplicates: one document of each group of near copies stays.
4. mix_sources: documents are repeated or left out as the sources' targets ask.
5. byte_bpe: token ids, with the digest of what they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.llm import bpe, jaccard, langid, linededup, mixing
from tunemill.llm.common import cut, table
from tunemill.llm.queries import byte_bpe_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(docs)
    changed = F.col(out.columns[-1]) > 0
    return (out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType))
                           .otherwise(F.col("n_chars"))).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), byte_bpe_path())
    return out.select("doc_id", "lang", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("mix_sources", mix_sources), ("byte_bpe", byte_bpe)]

# Training, signatures and merges have no SQL form: tests/llm/test_pipeline.py checks the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
