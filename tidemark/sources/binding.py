"""Binding of the driver's ``events`` table to raw repository events.

The test tables carry a generic event stream (``event_id, ts, user_id,
event_type, value, props``). This module derives, as Spark jobs over that
table, the landing rows an hourly event feed would deliver, the bronze table
after the merge, and a run ledger. Every case the operators care about is
planted by a fixed rule (see FIXTURES.md §2), so all work grows with the
input table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import merge_bronze

# ---------------------------------------------------------------------------
# Fixed values of the binding (FIXTURES.md §2).
# Driver event type -> repository event type:
#   click PushEvent, view WatchEvent, purchase PullRequestEvent,
#   error IssuesEvent, signup ForkEvent when event_id is even,
#   else PullRequestReviewEvent.
# Null planted when event_id is a multiple of: event_id 113, event_type 107,
#   repo_id 101, actor_id 103, created_at 109; actor_login 211 (non-bots).
# Bots: user_id multiple of 10. Renamed repos: repo_id multiple of 10 after
#   day 15. Redelivery: every 50th event again, one day later.
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landing(events: DataFrame) -> DataFrame:
    """Delivered rows, redeliveries included (bronze schema).

    One scan of ``events``: a row that is redelivered is exploded into its
    two deliveries (copy 0 and copy 1) instead of unioning a second scan.
    """
    k = F.get_json_object("props", "$.k").cast("bigint")
    src = events.select(
        F.col("event_id").alias("eid"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("user_id").alias("uid"),
        F.col("event_type").alias("et"),
        k.alias("k"),
    )
    eid, uid, et, ts, kk = F.col("eid"), F.col("uid"), F.col("et"), F.col("ts"), F.col("k")
    redelivered = (eid % 113 != 0) & (eid % 50 == 0)
    keyed = src.select(
        "*",
        (kk * 1000 + eid % (kk + 1)).alias("rid"),
        F.explode(F.when(redelivered, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    rid, copy = F.col("rid"), F.col("copy")

    def none():
        return F.lit(None)

    action = (
        F.when(et.isin("purchase", "error"),
               F.when(eid % 3 == 0, F.lit("closed")).otherwise(F.lit("opened")))
        .when(et == "view", F.lit("started"))
    )
    loaded = (F.date_trunc("hour", ts) + F.expr("INTERVAL 1 HOUR")).cast("timestamp_ntz")
    return keyed.select(
        F.when(eid % 113 == 0, none()).otherwise(eid.cast("string")).alias("event_id"),
        F.when(eid % 107 == 0, none())
        .when(et == "click", "PushEvent")
        .when(et == "view", "WatchEvent")
        .when(et == "purchase", "PullRequestEvent")
        .when(et == "error", "IssuesEvent")
        .when(eid % 2 == 0, "ForkEvent")
        .otherwise("PullRequestReviewEvent").alias("event_type"),
        F.when(eid % 103 == 0, none()).otherwise(uid).cast("bigint").alias("actor_id"),
        F.when(uid % 10 == 0, F.concat(F.lit("user"), uid.cast("string"), F.lit("[bot]")))
        .when(eid % 211 == 0, none())
        .otherwise(F.concat(F.lit("user"), uid.cast("string"))).alias("actor_login"),
        F.when(eid % 101 == 0, none()).otherwise(rid).cast("bigint").alias("repo_id"),
        F.concat(
            F.lit("org"), kk.cast("string"),
            F.when((rid % 10 == 0) & (F.dayofmonth(ts) > 15), F.lit("/renamed"))
            .otherwise(F.lit("/repo")),
            rid.cast("string"),
        ).alias("repo_name"),
        F.when(eid % 109 == 0, none()).otherwise(ts).cast("timestamp_ntz").alias("created_at"),
        F.when(copy == 1, F.lit("redelivered")).otherwise(action).alias("payload_action"),
        F.concat(F.to_date(ts).cast("string"), F.lit("-"), F.hour(ts).cast("string"),
                 F.lit(".json.gz")).alias("_source_file"),
        F.when(copy == 1, loaded + F.expr("INTERVAL 1 DAY")).otherwise(loaded).alias("_loaded_at"),
    )


def bronze(events: DataFrame) -> DataFrame:
    """Bronze after merging every delivery on ``event_id``."""
    return merge_bronze(None, landing(events))


def runs(bronze_df: DataFrame) -> DataFrame:
    """Run ledger: one ingest run per hour file, one build run per load day."""
    n = F.count("*")
    failed = n % 5 == 0
    ingest = bronze_df.groupBy("_source_file").agg(
        F.when(failed, F.lit("failure")).otherwise(F.lit("success")).alias("status"),
        F.when(failed, F.lit(0).cast("bigint")).otherwise(n).alias("rows"),
        (n * F.lit(0.25)).cast("double").alias("duration_s"),
        F.when(failed, F.lit("planted failure")).alias("error"),
        F.max("_loaded_at").alias("recorded_at"),
    ).select(
        F.md5("_source_file").alias("run_id"),
        F.lit("raw.gh_events").alias("asset"),
        F.concat(
            F.substring("_source_file", 1, 10), F.lit("-"),
            F.lpad(F.replace(F.substring("_source_file", 12, 1 << 20), F.lit(".json.gz"), F.lit("")),
                   2, "0"),
            F.lit(":00"),
        ).alias("partition"),
        "status", "rows", "duration_s", "error", "recorded_at",
    )
    build = bronze_df.groupBy(F.to_date("_loaded_at").alias("d")).agg(
        (n * F.lit(0.5)).cast("double").alias("duration_s"),
        F.max("_loaded_at").alias("recorded_at"),
    ).select(
        F.md5(F.concat(F.lit("build"), F.col("d").cast("string"))).alias("run_id"),
        F.lit("dbt_build").alias("asset"),
        F.lit(None).cast("string").alias("partition"),
        F.lit("success").alias("status"),
        F.lit(None).cast("bigint").alias("rows"),
        "duration_s",
        F.lit(None).cast("string").alias("error"),
        "recorded_at",
    )
    return ingest.unionByName(build)
