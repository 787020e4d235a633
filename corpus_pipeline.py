"""A corpus from raw documents to token digests: each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm.common import discard, new_path, table, tables_begun
from retailflow.llm.decontaminate import clean
from retailflow.llm.ngram_join import one_of_each_group
from retailflow.llm.quality_rules import filter_documents
from retailflow.llm.queries import bpe_digests
from retailflow.llm.substring_dedup import dedup_substrings


def _forget_earlier(spark: SparkSession, docs: DataFrame) -> None:
    """Removes what earlier stages kept in the shared folder: docs is what they made, written and read again."""
    read = {f.split(":", 1)[-1] for f in docs.inputFiles()}
    discard(spark, *[path for path in tables_begun() if not any(path.split(":", 1)[-1] + "/" in f for f in read)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits of their language and source."""
    return filter_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id."""
    _forget_earlier(spark, docs)
    return one_of_each_group(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word passages that one with a smaller id has; texts without any stay as they are."""
    _forget_earlier(spark, docs)
    kept = dedup_substrings(docs, window=50, rest_text=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = kept.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    _forget_earlier(spark, docs)
    return clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the texts that are left."""
    _forget_earlier(spark, docs)
    return bpe_digests(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeats),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", tokens),
]

#: MinHash, adaptive limits and tokens are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again. What only an earlier stage needed is removed."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        path = new_path(spark, name.replace(" ", "_"))
        result.write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
