"""Streams of delivered rows.  An extension: the batch operators need none of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def delivered(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    """A folder that files are delivered to, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def once(stream: DataFrame, key: list[str], at: str, late: str = "7 days") -> DataFrame:
    """Rows delivered again within ``late`` of each other count once."""
    return stream.where(F.col(at).isNotNull()).withWatermark(at, late).dropDuplicatesWithinWatermark(key)


def counts(stream: DataFrame, at: str, by: list[str], width: str = "1 day", late: str = "7 days") -> DataFrame:
    """Rows per window and group; rows later than the watermark are left out."""
    grouped = stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(F.col("w.start").alias("window_start"), *by, "n")


def upsert_slices(stream: DataFrame, path: str, slice_column: str, checkpoint: str):
    """Every batch replaces the slices it brings."""
    from stemma.operators.merge import write_slices

    return stream.writeStream.foreachBatch(lambda batch, _: write_slices(batch, path, slice_column)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
