"""Run ledger (S10, M1): an append-only Parquet table of pipeline runs."""

from __future__ import annotations

import contextlib
import sys
import time
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import ERROR_MAX_CHARS, file_instant, hour_partition_key
from tidemark.schemas import RUNS, conform


INGEST_ASSET, BUILD_ASSET = "raw.gh_events", "dbt_build"


def prepare_runs(records: DataFrame, max_error: int = ERROR_MAX_CHARS) -> DataFrame:
    """Ledger rules: error text cut to ``max_error`` characters, empty text -> null."""
    err = F.nullif(F.substring(F.col("error"), 1, max_error), F.lit(""))
    return conform(records.withColumn("error", err), RUNS)


def append_runs(ledger_path: str, records: DataFrame) -> None:
    """Append run records (any number, in one write)."""
    prepare_runs(records).write.mode("append").parquet(ledger_path)


def run_record(spark: SparkSession, run_id: str, asset: str, partition: str | None, status: str,
               rows: int | None, duration_s: float, error: str | None = None,
               recorded_at: datetime | None = None) -> DataFrame:
    """One run as a one-row frame (what an orchestrator hands to ``append_runs``).

    A failed ingest reports ``rows=0``; a transform reports ``rows=None``.
    """
    when = recorded_at or datetime.now(timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame(
        [(run_id, asset, partition, status, rows, float(duration_s), error, when)], RUNS)


def read_runs(spark: SparkSession, ledger_path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(ledger_path)


def ingest_runs(batch: DataFrame, run_id: str, status: str, duration_s: float, error: str | None = None) -> DataFrame:
    """One ingest run for every hour partition in ``batch``: the rows of that
    hour, or 0 and the error on failure. A file whose name is no hour of the
    feed is recorded without a partition."""
    counted = batch.groupBy(hour_partition_key(file_instant("_source_file")).alias("partition")).agg(F.count("*").alias("n"))
    failed = status != "success"
    return counted.select(
        F.concat_ws(":", F.lit(run_id), "partition").alias("run_id"), F.lit(INGEST_ASSET).alias("asset"), "partition",
        F.lit(status).alias("status"), F.lit(0).cast("long").alias("rows") if failed else F.col("n").alias("rows"),
        F.lit(float(duration_s)).alias("duration_s"), F.lit(error).cast("string").alias("error"),
        F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz").alias("recorded_at"))


@contextlib.contextmanager
def recorded(batch: DataFrame, ledger_path: str | None, run: str) -> Iterator[None]:
    """Record the loading of ``batch`` done inside: an ingest run for every hour
    in it, with the hour's rows, and a build run, which has no rows.

    On failure the hours have 0 rows and the error (if even the batch's hours
    cannot be read, one run without a partition has them), the build fails with
    the error, and the error propagates. Trouble with the ledger itself is
    reported and does not fail the work. Without a path nothing is recorded."""
    if ledger_path is None:
        yield
        return
    spark, started = batch.sparkSession, time.time()
    run = f"{run}:{uuid.uuid4().hex[:8]}"

    def attempt(*choices: Callable[[], DataFrame]) -> None:
        for i, records in enumerate(choices, 1):
            try:
                append_runs(ledger_path, records())
                return
            except Exception as e:  # noqa: BLE001
                if i == len(choices):
                    print(f"run ledger {ledger_path}: {e}", file=sys.stderr)

    def note(status: str, error: str | None) -> None:
        took = time.time() - started
        attempt(lambda: ingest_runs(batch, run, status, took, error),
                lambda: run_record(spark, run, INGEST_ASSET, None, status, None if error is None else 0, took, error))
        attempt(lambda: run_record(spark, f"{run}:build", BUILD_ASSET, None, status, None, took, error))

    try:
        yield
    except BaseException as e:
        note("failure", str(e))
        raise
    note("success", None)
