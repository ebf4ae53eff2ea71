"""Silver layer: typing, the data-quality verdict and the clean/quarantine
split (P1-P5). All narrow transformations: no shuffle until P5's count.

Both splits come from one shared ``tag_quality`` result, so every bronze row
lands in exactly one of them (bronze = staged + quarantined).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import DQ_RULES
from tidemark.schemas import QUARANTINE_COLUMNS, STG_COLUMNS


def utc_naive(c: Column, dtype: T.DataType, session_tz: str) -> Column:
    """Naive UTC wall-clock of an event time column.

    A ``timestamp`` (instant) is rendered in UTC whatever the session zone;
    a ``timestamp_ntz`` is taken as UTC already.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        local = c.cast("timestamp_ntz")  # wall clock in the session zone
        if session_tz.upper() in ("UTC", "Z", "+00:00", "ETC/UTC", "GMT"):
            return local
        return F.convert_timezone(F.lit(session_tz), F.lit("UTC"), local)
    return F.to_timestamp_ntz(c.cast("string"))


def type_events(bronze: DataFrame) -> DataFrame:
    """Keep the instant as ``created_at_tz``, add naive UTC time and date."""
    tz = bronze.sparkSession.conf.get("spark.sql.session.timeZone")
    dtype = bronze.schema["created_at"].dataType
    utc = utc_naive(F.col("created_at"), dtype, tz)
    return bronze.select(
        "event_id", "event_type", "actor_id", "actor_login", "repo_id", "repo_name",
        F.col("created_at").alias("created_at_tz"),
        utc.alias("created_at_utc"),
        F.to_date(utc).alias("event_date"),
        "payload_action", "_source_file", "_loaded_at",
    )


def quality_reason() -> Column:
    """First failing contract rule wins; null means the row passes."""
    reason = F.lit(None).cast("string")
    for column, name in reversed(DQ_RULES):
        reason = F.when(F.col(column).isNull(), F.lit(name)).otherwise(reason)
    return reason


def tag_quality(typed: DataFrame) -> DataFrame:
    return typed.withColumn("dq_reason", quality_reason())


def base_events(bronze: DataFrame) -> DataFrame:
    """The shared, typed and tagged step both silver tables derive from."""
    return tag_quality(type_events(bronze))


def stg_events(bronze: DataFrame) -> DataFrame:
    """Clean events."""
    return base_events(bronze).where(F.col("dq_reason").isNull()).select(*STG_COLUMNS)


def quarantine_events(bronze: DataFrame) -> DataFrame:
    """Rejected events, with the reason kept (login and name dropped)."""
    return base_events(bronze).where(F.col("dq_reason").isNotNull()).select(*QUARANTINE_COLUMNS)


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    """P5: rejected rows per reason."""
    return quarantine.groupBy("dq_reason").agg(F.count("*").alias("rows"))
