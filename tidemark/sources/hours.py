"""Hour partitions of the hourly feed.

Hour files are named ``YYYY-MM-DD-H.json.gz`` (hour not zero-padded); the
scheduler keys hours as ``YYYY-MM-DD-HH:MM``.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import hour_file_name, hour_partition_key

HOUR_COLUMNS = ["hour_start", "partition_key", "file_name"]


def _label(df: DataFrame, ts: str) -> DataFrame:
    c = F.col(ts)
    return df.select(
        c.alias("hour_start"), hour_partition_key(c).alias("partition_key"),
        hour_file_name(c).alias("file_name"),
    )


def hour_partitions(spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
    """Every hour from ``start`` to ``end`` (inclusive, truncated to the hour).

    Generated with ``spark.range``, so a long backfill range is spread over
    tasks rather than built on the driver.
    """
    s = start.replace(minute=0, second=0, microsecond=0)
    e = end.replace(minute=0, second=0, microsecond=0)
    n = int((e - s) / timedelta(hours=1)) + 1
    base = F.lit(s).cast("timestamp_ntz")
    hours = spark.range(max(n, 0)).select(
        (base + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("h"))
    return _label(hours, "h")


def hour_range(bounds: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """S7 from data: hours between two columns of a one-row frame (none if a
    bound is null). The two instants are read first, so the range is dealt over
    tasks however long a stray date makes it."""
    span = bounds.select(*[(F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz").alias(n)
                           for n, c in (("lo", start), ("hi", end))]).first()
    if span is None or span["lo"] is None or span["hi"] is None:
        return hour_partitions(bounds.sparkSession, datetime(1970, 1, 1, 1), datetime(1970, 1, 1))
    return hour_partitions(bounds.sparkSession, span["lo"], span["hi"])


def loaded_hours(bronze: DataFrame) -> DataFrame:
    """Hours spanned by the loaded events, from first to last event time."""
    bounds = bronze.agg(F.min("created_at").alias("lo"), F.max("created_at").alias("hi"))
    return hour_range(bounds, "lo", "hi")


def backfill_hours(bronze: DataFrame, until) -> DataFrame:
    """Hours a backfill covers: from the first event's day up to ``until``
    (exclusive)."""
    end = (until if isinstance(until, Column) else F.lit(until)).cast("timestamp_ntz")
    bounds = bronze.agg(F.date_trunc("day", F.min("created_at")).alias("lo")).select(
        "lo", (end - F.expr("INTERVAL 1 HOUR")).alias("hi"))
    return hour_range(bounds, "lo", "hi")


def missing_partitions(hours: DataFrame, bronze: DataFrame) -> DataFrame:
    """Hours in range with no loaded file (anti join on the file name)."""
    loaded = bronze.select(F.col("_source_file").alias("file_name")).distinct()
    return hours.join(loaded, "file_name", "left_anti").select(*HOUR_COLUMNS)


def partition_rows(bronze: DataFrame, source_file: str | None = None) -> DataFrame:
    """Rows landed per source file, or for one file."""
    df = bronze if source_file is None else bronze.where(F.col("_source_file") == source_file)
    return df.groupBy("_source_file").agg(F.count("*").alias("rows"))
