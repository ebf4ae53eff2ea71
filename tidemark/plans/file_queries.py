"""Registered queries that land their input as files first.

Each writes what it needs from the binding into a fresh folder under the
session's shared folder (``spark.checkpoint.dir``), runs the operator on
those files, and returns the resulting table. Batches are split by load
time at fixed cutoffs.
"""

from __future__ import annotations

import contextlib
from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.catalog import AS_OF, bronze, landing, models, register, runs
from tidemark.functions.columns import file_instant, hour_file_name, hour_partition_key, partition_key_to_file
from tidemark.operators import drift, health, quality, silver
from tidemark.operators.merge import merge_bronze, upsert
from tidemark.plans import medallion
from tidemark.plans.incremental import new_rows, read_model, refresh
from tidemark.schemas import FACT_COLUMNS, RAW_EVENT, STG_COLUMNS
from tidemark.session import scratch_path
from tidemark.sources import binding, events_csv, events_json, run_ledger
from tidemark.sources.tables import TableStore
from tidemark.streaming.ingest import stream_ingest

CUTOFFS = [datetime(2024, 1, 11), datetime(2024, 1, 21)]
CAP = 2  # lines per file for the sampling read


def load_batches(rows):
    """Split landed rows into consecutive load-time batches at ``CUTOFFS``."""
    bounds = [None, *CUTOFFS, None]
    out = []
    for lo, hi in zip(bounds, bounds[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("_loaded_at") >= F.lit(lo).cast("timestamp_ntz"))
        if hi is not None:
            cond = cond & (F.col("_loaded_at") < F.lit(hi).cast("timestamp_ntz"))
        out.append(rows.where(cond))
    return out


def landing_files(spark, sf_dir) -> str:
    root = scratch_path(spark, "landing")
    events_json.write_hour_files(landing(spark, sf_dir), root)
    return root


@register("read_event_files")
def q_read_event_files(spark, sf_dir):
    """Every delivery as hour files, scanned back (load time = file time)."""
    root = landing_files(spark, sf_dir)
    return events_json.read_event_files(spark, f"{root}/*/*.json.gz", loaded_at="file_time")


@register("read_event_files_capped")
def q_read_event_files_capped(spark, sf_dir):
    """The hour files read with a cap of 2 lines per file; rows per file."""
    root = landing_files(spark, sf_dir)
    capped = events_json.read_event_files(spark, f"{root}/*/*.json.gz", max_events=CAP,
                                          loaded_at="file_time")
    return capped.groupBy("_source_file", "_loaded_at").agg(F.count("*").alias("rows"))


@register("read_event_files_capped_early")
def q_read_event_files_capped_early(spark, sf_dir):
    """S4 where every hour file goes on, past the cap, with a line that is no
    event: what the cap leaves is read all the same."""
    lines = landing(spark, sf_dir).select("_source_file", F.to_json(F.struct(
        F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("value"))
    rank = F.row_number().over(Window.partitionBy("_source_file").orderBy("value"))
    lines = lines.withColumn("rank", rank).select("_source_file", "rank", F.when(
        F.col("rank") > CAP, "no event").otherwise(F.col("value")).alias("value"))
    root = scratch_path(spark, "broken-hours")
    (lines.repartition("_source_file").sortWithinPartitions("_source_file", "rank").drop("rank")
     .write.partitionBy("_source_file").text(root))
    kept = events_json.read_event_files(spark, root, max_events=CAP, loaded_at=AS_OF)
    return kept.groupBy("event_type").agg(F.count("*").alias("rows"))


@register("partition_key_files")
def q_partition_key_files(spark, sf_dir):
    """The hour key of every run that ingested one, and the file it names."""
    keys = runs(spark, sf_dir).where("partition is not null").select("partition").distinct()
    return keys.select("partition", partition_key_to_file(F.col("partition")).alias("file_name"))


@register("merge_across_midnight")
def q_merge_across_midnight(spark, sf_dir):
    """S5 with one load stamp for everything: every redelivery sits in the next
    hour's file, which is the next day's first one after 23:00."""
    hour = file_instant("_source_file")
    again = F.col("payload_action") == "redelivered"
    rows = landing(spark, sf_dir).withColumns({
        "_loaded_at": F.lit(AS_OF).cast("timestamp_ntz"),
        "_source_file": F.when(again, hour_file_name(hour + F.expr("INTERVAL 1 HOUR")))
        .otherwise(F.col("_source_file"))})
    return merge_bronze(None, rows)


@register("read_event_csv")
def q_read_event_csv(spark, sf_dir):
    """Bronze written as an offset-timestamp CSV sample and parsed back."""
    path = scratch_path(spark, "sample-csv")
    events_csv.write_event_csv(bronze(spark, sf_dir), path)
    return events_csv.read_event_csv(spark, path)


@register("append_run")
def q_append_run(spark, sf_dir):
    """Ingest runs, then build runs, appended to a ledger and read back."""
    path = scratch_path(spark, "ledger")
    runs = binding.runs(bronze(spark, sf_dir))
    run_ledger.append_runs(path, runs.where(F.col("asset") == "raw.gh_events"))
    run_ledger.append_runs(path, runs.where(F.col("asset") != "raw.gh_events"))
    return run_ledger.read_runs(spark, path)


@register("new_rows")
def q_new_rows(spark, sf_dir):
    """Staged rows newer than a target holding the loads before the 2nd cutoff."""
    stg = models(spark, sf_dir).stg
    target = stg.where(F.col("_loaded_at") < F.lit(CUTOFFS[1]).cast("timestamp_ntz"))
    return new_rows(stg, target)


@register("upsert_events")
def q_upsert_events(spark, sf_dir):
    """Staged rows of the later loads upserted into those of the earlier."""
    early, late = (merge_bronze(None, b) for b in
                   (landing(spark, sf_dir).where(F.col("_loaded_at") < F.lit(CUTOFFS[0])),
                    landing(spark, sf_dir).where(F.col("_loaded_at") >= F.lit(CUTOFFS[0]))))
    return upsert(silver.stg_events(early), silver.stg_events(late)).select(*STG_COLUMNS)


@register("refresh_incremental")
def q_refresh_incremental(spark, sf_dir):
    """Three load batches through the store, the middle one replayed."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    batches = load_batches(landing(spark, sf_dir))
    for i, b in enumerate(batches):
        refresh(store, b, f"batch-{i}")
    refresh(store, batches[1], "batch-1")
    return read_model(store, "fact", FACT_COLUMNS)


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """I4: hour files drained by a file stream into bronze, then restarted."""
    root = landing_files(spark, sf_dir)
    store = TableStore(spark, scratch_path(spark, "stream-warehouse"))
    checkpoint = scratch_path(spark, "stream-checkpoint")
    for _ in range(2):  # the second run finds nothing new
        stream_ingest(spark, f"{root}/*/*.json.gz", store, checkpoint, max_files_per_trigger=400)
    return read_model(store, "bronze")


@register("stream_then_refresh")
def q_stream_then_refresh(spark, sf_dir):
    """I4, then I3 on the same store: the first load batch as a file stream, the
    others as batches, the second of them twice under two ids; the staged rows."""
    store = TableStore(spark, scratch_path(spark, "mixed-warehouse"))
    first, second, third = load_batches(landing(spark, sf_dir))
    root = scratch_path(spark, "mixed-landing")
    events_json.write_hour_files(first, root)
    stream_ingest(spark, f"{root}/*/*.json.gz", store, scratch_path(spark, "mixed-checkpoint"),
                  max_files_per_trigger=1000)
    refresh(store, second, "batch-1", name_rule="latest")
    refresh(store, second, "batch-1-again")
    refresh(store, third, "batch-2")
    store.vacuum(keep=1, older_than_s=0)
    return read_model(store, "stg", STG_COLUMNS)


def drifting_feed(spark, sf_dir) -> str:
    """Raw lines in a folder per load batch. From the second load on, records
    name their organisation; the third has no payload, and actor ids are text."""
    shapes = []
    for number, rows in enumerate(load_batches(landing(spark, sf_dir))):
        docs = events_json.raw_documents(rows, ("repo_id", "repo_name")).drop("_source_file")
        if number > 0:
            docs = docs.withColumn("org", F.struct(F.floor(F.col("repo_id") / 1000).alias("id"),
                                                   F.split("repo_name", "/")[0].alias("login")))
        if number == 2:
            docs = docs.drop("payload").withColumn("actor", F.struct(
                F.col("actor.id").cast("string").alias("id"), F.col("actor.login").alias("login")))
        docs = docs.drop("repo_id", "repo_name")
        shapes.append(docs.select(F.to_json(F.struct(*docs.columns)).alias("value"), F.lit(f"load-{number}").alias("load")))
    root = scratch_path(spark, "drifting-feed")
    shapes[0].unionByName(shapes[1]).unionByName(shapes[2]).write.partitionBy("load").text(root)
    return root


def feed_shapes(spark, sf_dir):
    """The logged shape of every load of the drifting feed."""
    root, log = drifting_feed(spark, sf_dir), scratch_path(spark, "feed-shapes")
    load = F.regexp_extract("_metadata.file_path", "load=([^/]+)/", 1)
    drift.log_shapes(log, drift.raw_records(spark, f"{root}/*", load))
    return spark.read.parquet(log)


@register("feed_schema_drift")
def q_feed_schema_drift(spark, sf_dir):
    """Q8: fields that later loads of the feed added, dropped and retyped."""
    return drift.schema_drift(feed_shapes(spark, sf_dir))


@register("feed_contract_violations")
def q_feed_contract_violations(spark, sf_dir):
    """Q8: fields that the raw reader declares and a load lacks or types otherwise."""
    return drift.contract_violations(feed_shapes(spark, sf_dir), RAW_EVENT)


@register("observed_checks")
def q_observed_checks(spark, sf_dir):
    """Q2 and Q4 observed while the models of a build were written."""
    metrics: dict = {}
    medallion.materialize(spark, bronze(spark, sf_dir), scratch_path(spark, "observed-build"), metrics=metrics)
    return quality.observed_checks(spark, metrics)


@register("run_log")
def q_run_log(spark, sf_dir):
    """S10 from real runs: two refreshes and one that fails; asset, hour, status, rows."""
    return run_ledger.read_runs(spark, _real_runs(spark, sf_dir)).select("asset", "partition", "status", "rows")


@register("ingested_hours")
def q_ingested_hours(spark, sf_dir):
    """M7 on a ledger of real runs: the hours loaded, how often and with how many rows."""
    return health.ingest_by_partition(run_ledger.read_runs(spark, _real_runs(spark, sf_dir))) \
        .groupBy("partition").agg(F.count("*").alias("runs"), F.sum("rows").alias("rows"))


def _real_runs(spark, sf_dir) -> str:
    """A ledger kept by three refreshes, the second of which fails."""
    path = scratch_path(spark, "run-log")
    store = TableStore(spark, scratch_path(spark, "logged-warehouse"))
    first, second, _ = load_batches(landing(spark, sf_dir))
    refresh(store, first, "batch-0", ledger=path)
    with contextlib.suppress(Exception):
        refresh(store, second.withColumn("repo_id", F.raise_error(F.lit("broken")).cast("long")),
                "batch-1", ledger=path)
    refresh(store, second, "batch-1", ledger=path)
    return path


@register("check_log")
def q_check_log(spark, sf_dir):
    """Q6-Q9: two logged runs of all checks; the rows of the second."""
    path = scratch_path(spark, "check-log")
    m = models(spark, sf_dir).as_dict()
    quality.log_checks(path, m, "run-0", datetime(2024, 1, 31))
    return quality.log_checks(path, m, "run-1", AS_OF)
