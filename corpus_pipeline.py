"""A corpus pipeline of five stages; each is a Parquet table that the next one reads.

1. toxicity: rows that the classifier marks as toxic go.
2. jaccard: of each group of near-duplicates one row stays, that of the smallest doc_id. Rows without words all
   stay; rows that repeat another in id and text go.
3. suffixes: byte strings of 200 bytes and more that occur twice are cut out of all texts (a character at a
   cut stays whole); rows that lose all their words go. ``n_chars`` follows the text.
4. decontamination: rows that hold a benchmark item, or one with other parameters, go.
5. sentencepiece: adds n_tokens, ids_crc32, round_trip and token_ids (columns of these names are replaced).

All columns of documents are kept, further ones too. Null texts, ids and other nulls pass all stages (a null text is
neither toxic nor a duplicate; it stays). Empty tables give empty tables. All decisions of a stage are
judged on its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namebridge.llm import decontamination, jaccard_join, sentencepiece_codec, suffix_dedup, toxicity
from namebridge.llm.stages import small_batches, written

_WORD = r"[^\x20\x09-\x0D]"
#: Rows of all columns that go through Python at a time: both sides hold a batch of texts in memory.
_ROWS = 200


def _apart(docs: DataFrame, *names: str) -> DataFrame:
    """docs with those columns renamed that an operator would replace."""
    return docs.toDF(*[f"_own_{c}" if c.lower() in names else c for c in docs.columns])


def _back(out: DataFrame, docs: DataFrame, *names: str) -> DataFrame:
    return out.select([F.col(f"`_own_{c}`" if c.lower() in names else f"`{c}`").alias(c) for c in docs.columns])


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark, _ROWS)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = ("score", "predicted")
    scored = toxicity.score(_apart(docs, *names), model)
    return _back(scored.where((F.col("predicted") == 0) | F.col("text").isNull()), docs, *names)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark, _ROWS)
    return jaccard_join.keep_one(docs).select(docs.columns)


def repeats_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    cut = suffix_dedup.dedup(_apart(docs, *names), whole_characters=True)
    left = F.col("n_removed") == 0
    cut = cut.where(left | F.coalesce(F.col("text").rlike(_WORD), F.lit(False)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(left, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return _back(cut, docs, *names)


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("jaccard", near_duplicates_out),
    ("suffixes", repeats_out),
    ("decontamination", leaks_out),
    ("sentencepiece", encoded),
]

#: The first stage is a trained model, which SQL cannot express; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
