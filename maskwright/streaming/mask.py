"""Masking and audit of streams. Every operator of a document is row-local, so no state or watermark is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.audit import audit
from ..operators.mask import Options, mask


def read_stream(spark: SparkSession, path: str, schema: str = "doc_id long, text string", max_files: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def masked_stream(stream: DataFrame, options: Options = Options(), threshold: str = "high") -> DataFrame:
    """Masked documents of a stream with their leaks."""
    return audit(mask(stream, options=options), threshold)


def leak_counts(stream: DataFrame, time: str, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Leaks a window and severity, with a bound on lateness; the stream has a time column and leaks."""
    each = stream.withWatermark(time, late).select(time, F.explode("leaks").alias("leak"))
    return each.groupBy(F.window(time, window), F.col("leak.severity").alias("severity")).count()


def write_stream(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
