"""Explicit schemas for every table of the medallion layout.

Nothing is inferred: the raw reader declares only the leaves it keeps, so the
JSON source never materialises the heavy event payloads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Raw event document, one JSON object per line. Only the kept leaves.
RAW_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("actor", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("login", T.StringType()),
    ])),
    T.StructField("repo", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
    ])),
    T.StructField("payload", T.StructType([
        T.StructField("action", T.StringType()),
    ])),
    T.StructField("created_at", T.StringType()),
])

# Bronze: flattened events plus lineage stamps. created_at is the event
# instant as naive UTC; _loaded_at is the batch instant as naive UTC.
BRONZE = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("actor_id", T.LongType()),
    T.StructField("actor_login", T.StringType()),
    T.StructField("repo_id", T.LongType()),
    T.StructField("repo_name", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("payload_action", T.StringType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_loaded_at", T.TimestampNTZType()),
])

BRONZE_COLUMNS = [f.name for f in BRONZE.fields]

STG_COLUMNS = [
    "event_id", "event_type", "actor_id", "actor_login", "repo_id", "repo_name",
    "created_at_utc", "event_date", "payload_action", "_source_file", "_loaded_at",
]

QUARANTINE_COLUMNS = [
    "event_id", "event_type", "actor_id", "repo_id", "created_at_tz",
    "payload_action", "dq_reason", "_source_file", "_loaded_at",
]

FACT_COLUMNS = [
    "event_id", "repo_sk", "actor_sk", "repo_id", "actor_id", "event_type",
    "payload_action", "created_at_utc", "event_date", "_loaded_at",
]

# Sample CSV: header row, offset timestamps, no _loaded_at.
EVENT_CSV = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("actor_id", T.LongType()),
    T.StructField("actor_login", T.StringType()),
    T.StructField("repo_id", T.LongType()),
    T.StructField("repo_name", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("payload_action", T.StringType()),
    T.StructField("_source_file", T.StringType()),
])

# Run ledger, append-only.
RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("asset", T.StringType()),
    T.StructField("partition", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("duration_s", T.DoubleType()),
    T.StructField("error", T.StringType()),
    T.StructField("recorded_at", T.TimestampNTZType()),
])

RUN_COLUMNS = [f.name for f in RUNS.fields]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` (missing columns become nulls)."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
