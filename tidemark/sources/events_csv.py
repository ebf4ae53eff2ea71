"""CSV event samples (S11): header row, instants with a UTC offset
(``2024-01-15 20:30:00+05:30``), empty field = null, no ``_loaded_at``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.silver import utc_naive
from tidemark.schemas import EVENT_CSV

CSV_COLUMNS = [f.name for f in EVENT_CSV.fields]
#: Every form of offset: ``+05:30``, ``+0530``, ``+05`` and ``Z``.
OFFSET_PATTERN = "yyyy-MM-dd HH:mm:ss[.SSSSSS][XXX][XX][X]"


def read_event_csv(spark: SparkSession, path: str) -> DataFrame:
    """Parse the sample into bronze columns (``created_at`` naive UTC).
    An empty time is null; text that is no time fails the load."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    raw = spark.read.schema(EVENT_CSV).option("header", True).option("mode", "FAILFAST").csv(path)
    parsed = F.try_to_timestamp(F.col("created_at"), F.lit(OFFSET_PATTERN))
    instant = F.when(F.col("created_at").isNotNull() & parsed.isNull(), F.raise_error(
        F.concat(F.lit("not a time with an offset: "), F.col("created_at"))).cast("timestamp")).otherwise(parsed)
    return raw.withColumn(
        "created_at", utc_naive(instant, T.TimestampType(), tz)).select(*CSV_COLUMNS)


def write_event_csv(rows: DataFrame, path: str, offset: str = "+05:30") -> None:
    """Write bronze-shaped rows as a CSV sample, instants shown at ``offset``."""
    local = F.from_utc_timestamp(F.col("created_at").cast("timestamp"), offset)
    text = F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(offset))
    (rows.withColumn("created_at", text).select(*CSV_COLUMNS)
     .write.option("header", True).csv(path))
