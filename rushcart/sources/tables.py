"""Parquet tables of the shop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType = EVENTS,
    *,
    files: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Event files as a stream. ``files`` is a name pattern inside ``path``.

    Watermarks need a ``TIMESTAMP``, so ``ts`` is cast from ``TIMESTAMP_NTZ``.
    """
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
