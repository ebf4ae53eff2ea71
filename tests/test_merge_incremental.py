import itertools

from pyspark.sql import functions as F

from tidemark.operators.merge import merge_bronze, upsert
from tidemark.plans.incremental import new_rows, read_model, refresh
from tidemark.schemas import BRONZE_COLUMNS
from tidemark.session import scratch_path
from tidemark.sources.tables import TableStore
from conftest import bronze_rows, event


def _rows(df):
    return sorted((tuple(r) for r in df.select(*BRONZE_COLUMNS).collect()), key=repr)


def test_later_load_wins_and_null_keys_append(spark):
    a = bronze_rows(spark, [event("1", action="old", loaded="2024-01-15 06:00:00"),
                            event(None, action="n1")])
    b = bronze_rows(spark, [event("1", action="new", loaded="2024-01-16 06:00:00"),
                            event(None, action="n2")])
    merged = merge_bronze(merge_bronze(None, a), b)
    got = {(r["event_id"], r["payload_action"]) for r in merged.collect()}
    assert got == {("1", "new"), (None, "n1"), (None, "n2")}


def test_merge_is_order_independent_and_hours_compare_as_numbers(spark):
    # Same load instant: the later hour file wins, and hour 10 is later than 5.
    b5 = bronze_rows(spark, [event("7", action="h5", source="2024-01-15-5.json.gz")])
    b10 = bronze_rows(spark, [event("7", action="h10", source="2024-01-15-10.json.gz")])
    b_old = bronze_rows(spark, [event("7", action="old", loaded="2024-01-01 00:00:00")])
    results = set()
    for order in itertools.permutations([b5, b10, b_old]):
        acc = None
        for b in order:
            acc = merge_bronze(acc, b)
            acc = spark.createDataFrame(acc.collect(), acc.schema)  # materialise like a commit
        results.add(tuple(_rows(acc)))
    assert len(results) == 1
    assert [r[7] for r in list(results)[0]] == ["h10"]


def test_upsert_deletes_keys_and_appends(spark):
    target = bronze_rows(spark, [event("1", action="a"), event("2", action="b")])
    batch = bronze_rows(spark, [event("2", action="c"), event(None, action="z")])
    got = sorted((r["event_id"] or "", r["payload_action"]) for r in upsert(target, batch).collect())
    assert got == [("", "z"), ("1", "a"), ("2", "c")]


def test_new_rows_watermark_with_empty_target_floor(spark):
    src = bronze_rows(spark, [event("1", loaded="2024-01-15 06:00:00"),
                              event("2", loaded="2024-01-16 06:00:00")])
    assert new_rows(src, None).count() == 2
    tgt = src.where(F.col("event_id") == "1")
    assert [r["event_id"] for r in new_rows(src, tgt).collect()] == ["2"]
    assert new_rows(src, tgt.limit(0)).count() == 2


def _store(spark, name):
    return TableStore(spark, scratch_path(spark, name))


def test_repaired_row_leaves_quarantine(spark):
    # Hazard A: a row quarantined first and valid after re-delivery.
    store = _store(spark, "t-hazard-a")
    refresh(store, bronze_rows(spark, [event("1", repo=None), event("2")]), "b1")
    assert read_model(store, "quarantine").count() == 1
    refresh(store, bronze_rows(spark, [event("1", loaded="2024-01-16 06:00:00")]), "b2")
    assert read_model(store, "quarantine").count() == 0
    assert read_model(store, "stg").count() == 2
    assert read_model(store, "bronze").count() == 2


def test_late_commit_of_older_batch_is_not_skipped(spark):
    # Hazard B: a batch stamped earlier but committed after a newer one.
    store = _store(spark, "t-hazard-b")
    refresh(store, bronze_rows(spark, [event("1", loaded="2024-01-16 06:00:00")]), "newer")
    refresh(store, bronze_rows(spark, [event("2", loaded="2024-01-15 06:00:00")]), "older")
    assert read_model(store, "stg").count() == 2
    assert read_model(store, "fact").count() == 2


def test_replay_is_a_no_op(spark):
    store = _store(spark, "t-replay")
    batch = bronze_rows(spark, [event("1"), event(None, repo=None)])
    assert refresh(store, batch, "b1") is True
    assert refresh(store, batch, "b1") is False
    assert read_model(store, "quarantine").count() == 1


def test_batch_splits_equal_one_build(spark):
    from tidemark import catalog
    from tidemark.plans import file_queries
    from conftest import SF_SMALL

    landing = catalog.landing(spark, SF_SMALL)
    full = _rows(catalog.bronze(spark, SF_SMALL))
    store = _store(spark, "t-splits")
    batches = file_queries.load_batches(landing)
    for i in (2, 0, 1):  # out of load order
        refresh(store, batches[i], f"b{i}")
    assert _rows(read_model(store, "bronze")) == full
    full_models = catalog.models(spark, SF_SMALL)
    assert read_model(store, "stg").count() == full_models.stg.count()

    def same(name, df_full):
        cols = sorted(df_full.columns)
        got = sorted(map(tuple, read_model(store, name).select(*cols).collect()), key=repr)
        want = sorted(map(tuple, df_full.select(*cols).collect()), key=repr)
        assert got == want, name

    same("momentum", full_models.momentum)
    same("dim_repo", full_models.dim_repo)
    same("dim_actor", full_models.dim_actor)
    same("fact", full_models.fact)


def test_refresh_rewrites_only_touched_days(spark):
    store = _store(spark, "t-days")
    first = [event(str(i), created=f"2024-01-{d:02d} 05:00:00", source=f"2024-01-{d:02d}-5.json.gz")
             for i, d in enumerate([10, 11, 12], start=1)]
    refresh(store, bronze_rows(spark, first), "b1")
    before = store.current()["stg"].parts
    refresh(store, bronze_rows(spark, [event("2", action="again", created="2024-01-11 05:00:00",
                                             source="2024-01-11-5.json.gz",
                                             loaded="2024-01-16 06:00:00")]), "b2")
    after = store.current()["stg"].parts
    assert after["2024-01-10"] == before["2024-01-10"]
    assert after["2024-01-12"] == before["2024-01-12"]
    assert after["2024-01-11"] != before["2024-01-11"]
    assert read_model(store, "stg").where("event_id = '2'").first()["payload_action"] == "again"


def test_row_that_changes_day_leaves_its_old_day(spark):
    store = _store(spark, "t-move")
    refresh(store, bronze_rows(spark, [event("1", created="2024-01-10 05:00:00")]), "b1")
    refresh(store, bronze_rows(spark, [event("1", created="2024-01-14 05:00:00",
                                             loaded="2024-01-20 00:00:00")]), "b2")
    stg = read_model(store, "stg").collect()
    assert [(r["event_id"], str(r["event_date"])) for r in stg] == [("1", "2024-01-14")]
    assert read_model(store, "bronze").count() == 1
    assert read_model(store, "fact").count() == 1
