"""Load-test samples: one row per request."""

from __future__ import annotations

import csv
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rushcart.sources.folders import stored

#: Columns declared as not nullable must be present in a record.
SAMPLES = T.StructType(
    [
        T.StructField("version", T.StringType(), False),
        T.StructField("route", T.LongType(), False),
        T.StructField("ts", T.TimestampNTZType(), False),
        T.StructField("latency_ms", T.DoubleType(), False),
        T.StructField("is_error", T.BooleanType()),
    ]
)

_RAW = "malformed_record"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW}
#: Different header lines of CSV files that are read together.
HEADERS = 100


def read_samples(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType = SAMPLES
) -> tuple[DataFrame, DataFrame]:
    """Split files into good rows and bad ones.

    A row is bad if the record does not parse (text formats) or lacks a value the
    schema declares as not nullable. Bad rows keep what could be read, the raw
    text in ``malformed_record`` and the ``reason``.
    """
    optional = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    if fmt == "parquet":
        rows = spark.read.schema(optional).parquet(path).withColumn(_RAW, F.lit(None).cast("string"))
    else:
        rows = _parsed_lines(spark, path, fmt, optional)
    missing = [
        F.when(F.col(f.name).isNull(), F.lit(f"missing {f.name}")) for f in schema if not f.nullable
    ]
    malformed = F.when(F.col(_RAW).isNotNull(), F.lit("malformed"))
    rows = rows.withColumn("reason", F.coalesce(malformed, *missing))
    good = rows.where(F.col("reason").isNull()).drop("reason", _RAW)
    bad = rows.where(F.col("reason").isNotNull())
    return good, bad


def _parsed_lines(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    """JSON or CSV records, one per line, every column of each parsed exactly once.

    Spark's own readers parse only the columns a query uses, so whether a record
    counts as malformed would depend on the query. CSV columns stand as the first line of their
    file says, if that names all of the schema's columns, else in the schema's order; columns
    that the schema does not name are left out.
    """
    full = T.StructType([*schema, T.StructField(_RAW, T.StringType())])
    text = spark.read.text(path).where(F.trim("value") != "")
    if fmt == "json":
        return text.select(F.inline(F.array(F.from_json("value", full, _OPTIONS))))
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}")
    rows, headers = _with_headers(text, schema)
    known = {f.name: f for f in schema}
    parts = [_parsed_csv(rows.where(F.col("_header").isNull()), list(schema), full)]
    for header in headers:
        order = [known.get(c, T.StructField(c, T.StringType())) for c in _cells(header)]
        own = rows.where((F.col("_header") == header) & (F.col("value") != header))
        parts.append(_parsed_csv(own, order, full))
    return reduce(DataFrame.unionByName, parts)


def _cells(line: str) -> list[str]:
    return [cell.strip() for cell in next(csv.reader([line], skipinitialspace=True))]


def _with_headers(text: DataFrame, schema: T.StructType) -> tuple[DataFrame, list[str]]:
    """Lines with the header of their file, null where it has none, and all headers there are.

    A file's first line is the first one of the block that begins at 0.
    """
    lines = text.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
    places = lines.where("_start = 0").withColumn("_place", F.monotonically_increasing_id())
    firsts = places.groupBy("_file").agg(F.min_by("value", "_place").alias("_header"))
    cells = F.transform(F.split("_header", ","), lambda c: F.trim(F.regexp_replace(c, '^\\s*"|"\\s*$', "")))
    named = reduce(lambda a, b: a & b, [F.array_contains(cells, f.name) for f in schema])
    files = stored(firsts.where(named), "headers")  # a row per file
    headers = [r[0] for r in files.select("_header").distinct().orderBy("_header").limit(HEADERS + 1).collect()]
    if len(headers) > HEADERS:
        raise ValueError(f"more than {HEADERS} different header lines")
    return lines.drop("_start").join(files, "_file", "left"), headers


def _parsed_csv(lines: DataFrame, order: list[T.StructField], full: T.StructType) -> DataFrame:
    record = F.from_csv("value", T.StructType([*order, full[_RAW]]).toDDL(), _OPTIONS)
    return lines.select(F.inline(F.array(record))).select(*full.names)


#: Line JSON of the load tool: one point of one metric per line.
POINTS = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("time", T.StringType()),
                    T.StructField("value", T.DoubleType()),
                    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
                ]
            ),
        ),
    ]
)


def read_points(
    spark: SparkSession, path: str, metric: str = "http_req_duration", route: str = "name", version: str = "version"
) -> tuple[DataFrame, DataFrame]:
    """Samples from a load tool's line JSON, and the lines that are none.

    Points of ``metric`` become samples: ``version`` and ``route`` are tags, times are taken
    to UTC, and a request failed if its tag ``expected_response`` is false or, without that tag,
    its ``status`` is 400 or above or 0. Lines of other metrics or types are neither good nor bad.
    """
    full = T.StructType([*POINTS, T.StructField(_RAW, T.StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "")
    points = lines.select("value", F.inline(F.array(F.from_json("value", full, _OPTIONS))))
    tag = lambda name: F.try_element_at("data.tags", F.lit(name))
    status = tag("status").try_cast("int")
    rows = points.where(F.col(_RAW).isNotNull() | ((F.col("type") == "Point") & (F.col("metric") == metric))).select(
        tag(version).alias("version"),
        tag(route).alias("route"),
        F.to_utc_timestamp(F.col("data.time").try_cast("timestamp"), "UTC").cast("timestamp_ntz").alias("ts"),
        F.col("data.value").alias("latency_ms"),
        F.coalesce(tag("expected_response") == "false", (status >= 400) | (status == 0)).alias("is_error"),
        F.col(_RAW),
    )
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in ("version", "route", "ts", "latency_ms")]
    rows = rows.withColumn("reason", F.coalesce(F.when(F.col(_RAW).isNotNull(), F.lit("malformed")), *missing))
    return rows.where(F.col("reason").isNull()).drop("reason", _RAW), rows.where(F.col("reason").isNotNull())


def samples_from_events(events: DataFrame) -> DataFrame:
    """A stand-in for load-test output, derived from the event log.

    It exercises the operators; its latencies measure no real system.
    """
    k = F.get_json_object("props", "$.k").try_cast("long")
    return events.withColumn("_k", k).select(
        F.concat(F.lit("V"), (F.col("_k") % 4 + 1).cast("string")).alias("version"),
        F.expr("_k div 4").alias("route"),
        "ts",
        F.col("value").alias("latency_ms"),
        (F.col("event_type") == "error").alias("is_error"),
    )


def write_samples(df: DataFrame, path: str, run: str | None = None) -> None:
    """Parquet by version, day and run, so that each can be read alone.

    The rebalance hint splits a large version-day over several files and packs small ones.
    What other runs wrote stays. Writing under a ``run`` again replaces that run's rows of the
    versions and days written; without a name every call is a run of its own.
    """
    (
        df.withColumn("day", F.to_date("ts"))
        .withColumn("run", F.lit(run or uuid.uuid4().hex))
        .hint("rebalance", "version", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("version", "day", "run")
        .parquet(path)
    )
