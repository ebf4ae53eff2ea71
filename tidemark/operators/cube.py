"""Count cube of the event stream.

Per-minute views used to read the fact, a row per event. The cube holds what
they show: per day the count of every (minute, type), and of every minute, from
one pass with grouping sets. Its size follows the minutes on record, not the
events in them, and a day's rows depend on that day's events alone, so a load
replaces the days that it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import is_bot, minute_of, safe_ratio

CUBE_COLUMNS = ["event_date", "minute", "event_type", "level", "events"]
#: Rows of the cube: of a minute and type, and of a whole minute.
BY_TYPE, BY_MINUTE = "type", "minute"


def minute_cube(events: DataFrame) -> DataFrame:
    """The cube of ``events`` (fact or staged rows). All grouping sets share one
    hash aggregate, and a hot minute collapses map-side."""
    rows = events.select("event_date", minute_of("created_at_utc").alias("minute"), "event_type")
    keys = [F.col(c) for c in ("event_date", "minute", "event_type")]
    return rows.groupingSets([keys, keys[:2]], *keys).agg(
        F.when(F.grouping("event_type") == 0, BY_TYPE).otherwise(BY_MINUTE).alias("level"),
        F.count("*").alias("events")).select(*CUBE_COLUMNS)


def replace_days(cube: DataFrame, events: DataFrame, days: DataFrame) -> DataFrame:
    """The cube after a load: the ``days`` (distinct ``event_date``) that it
    touched are counted again from ``events``, all others are kept."""
    again = minute_cube(events.join(days, "event_date", "left_semi"))
    return cube.join(days, "event_date", "left_anti").select(*CUBE_COLUMNS).unionByName(again)


def _minutes(cube: DataFrame) -> DataFrame:
    return cube.where(F.col("level") == BY_MINUTE)


def _types(cube: DataFrame) -> DataFrame:
    return cube.where(F.col("level") == BY_TYPE)


def peak_minute(cube: DataFrame) -> DataFrame:
    """The busiest minute's event count (a minute lies in one day)."""
    return _minutes(cube).agg(F.max("events").alias("peak_minute"))


def per_minute_by_type(cube: DataFrame) -> DataFrame:
    """V2: events per (minute, type), ordered by minute; nothing to aggregate."""
    return _types(cube).select("minute", "event_type", "events").orderBy("minute", "event_type")


def per_minute_total(cube: DataFrame) -> DataFrame:
    """Events per minute, ordered by minute."""
    return _minutes(cube).select("minute", "events").orderBy("minute")


def composition_by_minute(cube: DataFrame) -> DataFrame:
    """Share of each type within its minute, a window over a handful of rows."""
    total = F.sum("events").over(Window.partitionBy("event_date", "minute"))
    return _types(cube).select("minute", "event_type", "events", (
        F.col("events").cast("double") / total.cast("double")).alias("share")).orderBy("minute", "event_type")


def headline_metrics(cube: DataFrame, dim_repo: DataFrame, dim_actor: DataFrame, quarantine: DataFrame) -> DataFrame:
    """V1 from the cube and the dimensions; the columns of ``serving.headline_metrics``."""
    def counted(condition: Column, value: Column) -> Column:
        return F.when(condition, value)

    traffic = cube.agg(
        F.coalesce(F.sum(counted(F.col("level") == BY_MINUTE, F.col("events"))), F.lit(0)).cast("bigint").alias("events"),
        F.count_distinct(counted(F.col("level") == BY_TYPE, F.col("event_type"))).alias("event_types"),
        F.max(counted(F.col("level") == BY_MINUTE, F.col("events"))).alias("peak_minute"))
    bots = F.sum(F.when(is_bot("actor_login"), F.col("total_events")))
    row = traffic.select(
        "events", dim_repo.agg(F.count("*")).scalar().alias("repos"), dim_actor.agg(F.count("*")).scalar().alias("actors"),
        quarantine.agg(F.count("*")).scalar().alias("quarantined"), "event_types",
        dim_actor.agg(F.coalesce(bots, F.lit(0)).cast("bigint")).scalar().alias("bot_events"), "peak_minute")
    return row.select(
        "*",
        safe_ratio(F.col("events"), F.col("repos")).alias("avg_events_per_repo"),
        safe_ratio(F.col("bot_events"), F.col("events"), 100.0).alias("bot_share_pct"),
        safe_ratio(F.col("quarantined"), F.col("events") + F.col("quarantined"), 100.0).alias("quarantine_rate_pct"))
