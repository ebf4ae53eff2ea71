"""What one task is dealt, and what passes through the driver, is bounded."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.merge import upsert
from tidemark.plans.incremental import refresh
from tidemark.session import configure, scratch_path
from tidemark.sources.tables import TableStore
from conftest import bronze_rows, event

SIZES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20, "spark.sql.files.maxPartitionBytes": 32 << 20}


@pytest.fixture
def session(spark):
    kept = {key: spark.conf.get(key) for key in (*SIZES, "spark.sql.autoBroadcastJoinThreshold")}
    yield spark
    for key, value in kept.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("key", SIZES)
def test_a_task_is_dealt_so_much_at_most(session, key):
    """event keys of all models met in tasks of 64 MB of packed keys."""
    session.conf.set(key, "256m")
    configure(session)
    assert session.conf.get(key) == f"{SIZES[key]}b"
    session.conf.set(key, "5m")  # a session's own smaller size stays
    configure(session)
    assert session.conf.get(key) == "5m"


def test_large_key_sets_do_not_pass_through_the_driver(session):
    """a refresh sent every batch's keys to the driver, up to 64 MB each time."""
    spark = configure(session)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # sizes as found at runtime only
    ids = spark.range(0, 600_000, 1, 4).select(F.sha2(F.col("id").cast("string"), 256).alias("event_id"))
    some = ids.where("event_id > '1'")
    kept = upsert(ids, some.limit(0), delete_keys=some.distinct())
    assert kept.collect() and "BroadcastHashJoin" not in kept._jdf.queryExecution().executedPlan().toString()


def test_a_batch_is_not_searched_again_in_the_bronze_it_went_to(spark, monkeypatch):
    """silver comes from the winners of the merge, not from another
    join of the written bronze with the batch's keys."""
    store = TableStore(spark, scratch_path(spark, "t-winners"))
    refresh(store, bronze_rows(spark, [event("1"), event("2"), event(None)]), "a")
    read, seen = store.read, []
    monkeypatch.setattr(store, "read", lambda table, *a, **b: seen.append(table) or read(table, *a, **b))
    refresh(store, bronze_rows(spark, [event("2", "ForkEvent", loaded="2024-01-15 07:00:00"), event("3")]), "b")
    assert seen.count("bronze") == 2  # days of the keys, and the rows to merge into
    assert sorted((r.event_id, r.event_type) for r in read("stg").collect()) == [
        ("1", "PushEvent"), ("2", "ForkEvent"), ("3", "PushEvent")]
    assert [r.dq_reason for r in read("quarantine").collect()] == ["missing_event_id"]
