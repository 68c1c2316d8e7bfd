"""Readers and writers of document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A Parquet table of documents; only the columns that a query uses are read."""
    return spark.read.parquet(path).select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *[c for c in spark.read.parquet(path).columns if c not in (key, text, "doc_id", "text")])


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One document a file: doc_id (the path) and text."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc_id"), F.col("value").alias("text"))


def read_json_lines(spark: SparkSession, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    return spark.read.json(path).select(F.col(key).alias("doc_id"), F.col(text).alias("text"))


def write_masked(masked: DataFrame, path: str, mapping_path: str | None = None, key: str = "doc_id") -> None:
    """Masked texts without any original; the mapping goes to a place of its own, and only if one is named."""
    from ..operators.mask import mapping

    masked.select(key, "anonymized", "warnings", "skipped").write.parquet(path)
    if mapping_path:
        mapping(masked, key).write.parquet(mapping_path)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where it has fewer partitions than there are cores, so that costly rules do not keep a few busy.

    A scan's partitions are bounded in size, so what moves is at most that size for each core."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if cores < 2 or df.rdd.getNumPartitions() >= cores else df.repartition(2 * cores)
