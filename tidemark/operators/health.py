"""Pipeline-health queries over the run ledger and bronze (M1-M9).

M5-M9 cover the whole ledger; ``limit`` narrows them to the most recent runs
(a page window), as a top-k.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import hour_boundaries, safe_ratio, sla_class
from tidemark.sources.run_ledger import INGEST_ASSET

RUN_VIEW_COLUMNS = ["recorded_at", "asset", "partition", "status", "rows", "duration_s", "error"]


def has_run_metadata(spark: SparkSession, ledger_path: str) -> bool:
    """M1: whether a run ledger has been written at ``ledger_path``."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(ledger_path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(path))


def latest_runs(runs: DataFrame, limit: int | None) -> DataFrame:
    """The ``limit`` most recent runs (ties by run id), ledger columns kept;
    without a limit all of them."""
    if limit is None:
        return runs
    return runs.orderBy(F.desc("recorded_at"), "run_id").limit(int(limit))


def recent_runs(runs: DataFrame, limit: int = 100) -> DataFrame:
    """M2: recent runs, newest first."""
    return latest_runs(runs, limit).select(*RUN_VIEW_COLUMNS)


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp_ntz")


def freshness(bronze: DataFrame, as_of: datetime | str | Column | None = None) -> DataFrame:
    """M3: last load, hour boundaries since it, distinct source files."""
    return bronze.agg(
        F.max("_loaded_at").alias("last_loaded_at"),
        F.count_distinct("_source_file").alias("batches"),
    ).select(
        "last_loaded_at",
        hour_boundaries(F.col("last_loaded_at"), _as_of(as_of)).alias("hours_since_load"),
        "batches",
    )


def sla_status(fresh: DataFrame) -> DataFrame:
    """M4: freshness class from ``hours_since_load``."""
    return fresh.withColumn("sla", sla_class(F.col("hours_since_load")))


def run_kpis(runs: DataFrame, limit: int | None = None) -> DataFrame:
    """M6: KPIs over the ledger, or its latest ``limit`` runs."""
    window = latest_runs(runs, limit)
    k = window.agg(
        F.count("*").alias("total_runs"),
        F.count_if(F.col("status") == "failure").alias("failures"),
        F.sum(F.coalesce(F.col("rows"), F.lit(0))).cast("bigint").alias("total_rows"),
        F.avg("duration_s").alias("avg_duration_s"),
    )
    return k.select(
        "total_runs", "failures",
        (F.col("total_runs") - F.col("failures")).alias("successes"),
        safe_ratio(F.col("total_runs") - F.col("failures"), F.col("total_runs"), 100.0)
        .alias("success_pct"),
        F.coalesce(F.col("total_rows"), F.lit(0).cast("bigint")).alias("total_rows"),
        F.coalesce(F.col("avg_duration_s"), F.lit(0.0)).alias("avg_duration_s"),
    )


def overall_status(runs: DataFrame, bronze: DataFrame, as_of=None, limit: int | None = None) -> DataFrame:
    """M5: healthy / failed / stale from the latest runs and freshness."""
    fresh = sla_status(freshness(bronze, as_of))
    failures = latest_runs(runs, limit).agg(F.count_if(F.col("status") == "failure")).scalar()
    row = fresh.select("sla", "hours_since_load", failures.alias("failures"))
    return row.withColumn(
        "status",
        F.when((F.col("failures") == 0) & F.col("sla").isin("Fresh", "Unknown"), F.lit("healthy"))
        .when(F.col("failures") > 0, F.lit("failed"))
        .otherwise(F.lit("stale")),
    )


def ingest_by_partition(runs: DataFrame, limit: int | None = None) -> DataFrame:
    """M7: rows ingested per hour partition (ingest runs with a row count)."""
    return (
        latest_runs(runs, limit)
        .where((F.col("asset") == INGEST_ASSET) & F.col("rows").isNotNull())
        .select("partition", "rows", "duration_s", "status")
    )


def run_outcomes(runs: DataFrame, limit: int | None = None) -> DataFrame:
    """M8: runs per status."""
    return latest_runs(runs, limit).groupBy("status").agg(F.count("*").alias("runs"))


def run_durations(runs: DataFrame, limit: int | None = None) -> DataFrame:
    """M9: the run-duration series (runs with a duration)."""
    return (
        latest_runs(runs, limit).where(F.col("duration_s").isNotNull())
        .select("recorded_at", "asset", "partition", "duration_s", "rows", "status")
    )
