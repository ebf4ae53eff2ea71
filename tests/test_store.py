"""The incremental path: one apply step, versioned states, recorded runs."""

import os
from types import SimpleNamespace

import pytest

from tidemark.operators import gold, health, quality, serving
from tidemark.operators.merge import merge_bronze
from tidemark.plans import incremental
from tidemark.plans.incremental import read_model, refresh
from tidemark.plans.medallion import build
from tidemark.schemas import RUNS
from tidemark.session import scratch_path, shared_dir
from tidemark.sources import events_csv, events_json, run_ledger
from tidemark.sources.tables import Conflict, TableStore, days_with_ids, Entry
from conftest import bronze_rows, event, ts
from test_sources_streaming import _local, _write_gz


def store_at(spark, name):
    return TableStore(spark, scratch_path(spark, name))


def test_the_later_file_wins_across_midnight(spark):
    rows = bronze_rows(spark, [event("1", action="old", source="2024-01-15-23.json.gz"),
                               event("1", action="new", source="2024-01-16-0.json.gz")])
    assert [r.payload_action for r in merge_bronze(None, rows).collect()] == ["new"]


def test_the_same_hour_loaded_again_adds_no_rows(spark):
    store = store_at(spark, "t-again")
    hour = [event("1"), event(None, action="x"), event(None, action="x"), event(None, action="y")]
    refresh(store, bronze_rows(spark, hour), "a")
    counts = {n: read_model(store, n).count() for n in ("bronze", "stg", "quarantine")}
    assert counts == {"bronze": 4, "stg": 1, "quarantine": 3}
    again = [(*e[:9], "2024-01-15 09:00:00") for e in hour]
    refresh(store, bronze_rows(spark, again), "b")
    assert {n: read_model(store, n).count() for n in counts} == counts


def test_silver_is_built_from_all_of_a_bronze_that_came_first(spark):
    store = store_at(spark, "t-bronze-first")
    rows = bronze_rows(spark, [event(str(i), created=f"2024-01-1{i} 05:00:00") for i in range(5)] + [event(None)])
    base, current = store.snapshot()
    staged = store.stage_parts("bronze", rows, incremental.DAY["bronze"](), None, current, "event_id")
    store.commit({"bronze": staged}, "stream-0", base, current)
    refresh(store, bronze_rows(spark, [event("9", created="2024-01-20 05:00:00")]), "b")
    assert read_model(store, "stg").count() == 6
    assert read_model(store, "quarantine").count() == 1
    models = {n: read_model(store, n) for n in ("bronze", "stg", "quarantine")}
    assert quality.check_reconciliation(**models).count() == 0


def test_name_rules_may_change_between_batches(spark):
    store = store_at(spark, "t-rules")
    for i, rule in enumerate(["max", "latest", "max"]):
        refresh(store, bronze_rows(spark, [event(str(i), created=f"2024-01-1{i} 05:00:00", name=f"o/{9 - i}")]),
                f"b{i}", name_rule=rule)
    assert read_model(store, "momentum").count() == 3
    assert [(r.total_events, r.repo_name) for r in read_model(store, "dim_repo").collect()] == [(3, "o/9")]
    with pytest.raises(ValueError):
        gold.dim_repo(read_model(store, "stg"), "first")


def test_latest_name_of_events_at_one_instant(spark):
    for order in (1, -1):
        rows = [event("1", name="o/b"), event("2", name="o/a")][::order]
        assert gold.dim_repo(build(bronze_rows(spark, rows)).stg, "latest").first().repo_name == "o/a"


def test_the_second_of_two_writers_starts_again(spark, monkeypatch):
    store = store_at(spark, "t-writers")
    refresh(store, bronze_rows(spark, [event("1")]), "a")
    base, current = store.snapshot()
    real, calls = incremental._apply, []

    def interrupted(store_, batch, current_, rule):
        staged = real(store_, batch, current_, rule)
        if not calls:
            calls.append(1)
            refresh(store, bronze_rows(spark, [event("2")]), "other writer")
        return staged

    monkeypatch.setattr(incremental, "_apply", interrupted)
    refresh(store, bronze_rows(spark, [event("3")]), "mine")
    assert sorted(r.event_id for r in read_model(store, "fact").collect()) == ["1", "2", "3"]
    with pytest.raises(Conflict):
        store.commit({}, "late", base, current)


def test_a_state_cut_short_is_skipped(spark):
    store = store_at(spark, "t-cut")
    refresh(store, bronze_rows(spark, [event("1")]), "a")
    with open(_local(store.root) + "/_state/0000000002.json", "w") as f:
        f.write('{"bronze": ')
    assert read_model(store, "bronze").count() == 1
    refresh(store, bronze_rows(spark, [event("2")]), "b")
    assert read_model(store, "bronze").count() == 2


def test_vacuum_keeps_what_the_newest_state_names(spark):
    store = store_at(spark, "t-vacuum")
    for i in range(3):
        refresh(store, bronze_rows(spark, [event(str(i), created=f"2024-01-1{i} 05:00:00")]), f"b{i}")
    assert store.vacuum(keep=1, older_than_s=3600)  # old states only: folders are young
    before = len(os.listdir(_local(store.root) + "/momentum"))
    assert store.vacuum(keep=1, older_than_s=-1) and before == 3
    assert len(os.listdir(_local(store.root) + "/momentum")) == 1
    assert read_model(store, "fact").count() == 3 and read_model(store, "momentum").count() == 3


def test_id_ranges_rule_days_out(spark):
    entry = Entry(parts={"d1": ["p", 1, 10], "d2": ["p", 11, 20], "odd": ["p", None, None], "empty": ["p", 1, 0]})
    assert days_with_ids(entry, 12, 30) == {"d2", "odd"}
    assert days_with_ids(entry, None, None) == set(entry.parts)
    store = store_at(spark, "t-ranges")
    refresh(store, bronze_rows(spark, [event("5", created="2024-01-10 05:00:00"), event("x", created="2024-01-11 05:00:00"),
                                       event(None, created="2024-01-12 05:00:00")]), "a")
    assert {d: p[1:] for d, p in store.current()["bronze"].parts.items()} == {
        "2024-01-10": [5, 5], "2024-01-11": [None, None], "2024-01-12": [1, 0]}


def test_runs_are_recorded_also_when_they_fail(spark):
    path, store = scratch_path(spark, "t-ledger"), store_at(spark, "t-ledger-store")
    refresh(store, bronze_rows(spark, [event("1"), event("2")]), "a", ledger=path)
    with pytest.raises(Exception):
        refresh(store, bronze_rows(spark, [event("3")]), "b", name_rule="none such", ledger=path)
    rows = sorted((r.asset, r.partition, r.status, r["rows"], r.error and "none such" in r.error)
                  for r in run_ledger.read_runs(spark, path).collect() if r.asset == run_ledger.INGEST_ASSET)
    hour = "2024-01-15-05:00"
    assert rows == [("raw.gh_events", hour, "failure", 0, True), ("raw.gh_events", hour, "success", 2, None)]
    builds = {r.status: r for r in run_ledger.read_runs(spark, path).where("asset = 'dbt_build'").collect()}
    assert builds["success"]["rows"] is None and builds["failure"]["rows"] is None and builds["failure"].partition is None
    # An unusable ledger does not fail the work.
    assert refresh(store, bronze_rows(spark, [event("4")]), "c", ledger="nowhere://x/y")
    assert len(read_model(store, "bronze").collect()) == 3


def test_health_covers_the_whole_ledger(spark):
    runs = spark.createDataFrame(
        [(str(i), "a", None, "failure" if i == 0 else "success", 1, 1.0, None, ts(f"2024-01-01 {i % 24:02d}:00:00"))
         for i in range(300)], RUNS)
    assert health.run_kpis(runs).first().total_runs == 300
    assert health.run_kpis(runs, 200).first().total_runs == 200
    bronze = bronze_rows(spark, [event("1")])
    assert health.overall_status(runs, bronze, ts("2024-01-15 07:00:00")).first().status == "failed"


def test_check_log_finds_schema_changes(spark):
    path = scratch_path(spark, "t-checks")
    models = build(bronze_rows(spark, [event("1"), event("2")])).as_dict()
    first = quality.log_checks(path, models, "r1", ts("2024-01-15 08:00:00"))
    assert {r.status for r in first.collect()} == {"pass"}
    models["stg"] = models["stg"].drop("payload_action")
    second = quality.log_checks(path, models, "r2", ts("2024-01-17 08:00:00")).collect()
    bad = {(r.check_name, r.model): (r.failures, r.status) for r in second if r.status != "pass"}
    assert bad == {("schema_changes", "stg_events"): (1, "fail"), ("source_freshness", "raw.gh_events"): (1, "fail")}


def test_csv_takes_every_offset_form_and_refuses_other_text(spark):
    d = scratch_path(spark, "t-offsets")
    os.makedirs(_local(d))

    def load(*times):
        with open(_local(d) + "/s.csv", "w") as f:
            f.write(",".join(events_csv.CSV_COLUMNS) + "\n")
            f.writelines(f"{i},PushEvent,1,a,2,o/r,{t},,f.json\n" for i, t in enumerate(times))
        return [r.created_at for r in events_csv.read_event_csv(spark, d).orderBy("event_id").collect()]

    assert load("2024-01-15 15:00:00+00", "2024-01-15 20:30:00+0530", "2024-01-15 20:30:00.5+05:30".replace(".5", ".500000"),
                "2024-01-15 15:00:00Z", "") == [
        ts("2024-01-15 15:00:00"), ts("2024-01-15 15:00:00"), ts("2024-01-15 15:00:00.5"), ts("2024-01-15 15:00:00"), None]
    with pytest.raises(Exception, match="not a time"):
        load("yesterday")


def test_the_cap_comes_before_parsing(spark):
    d = scratch_path(spark, "t-early-cap")
    _write_gz(d, "2024-01-15-5.json.gz", [{"id": "1"}, "", {"id": "2"}, "no event"])
    assert sorted(r.event_id for r in events_json.read_event_files(spark, d, max_events=2).collect()) == ["1", "2"]
    with pytest.raises(Exception):
        events_json.read_event_files(spark, d, max_events=3).collect()


def test_a_time_that_is_none_fails_a_strict_load(spark):
    d = scratch_path(spark, "t-times")
    _write_gz(d, "2024-01-15-5.json.gz", [{"id": "1", "created_at": "soon"}])
    with pytest.raises(Exception, match="not an instant"):
        events_json.read_event_files(spark, d).collect()
    assert events_json.read_event_files(spark, d, mode="PERMISSIVE").first().created_at is None


def test_a_window_prunes_days(spark):
    root = scratch_path(spark, "t-prune")
    build(bronze_rows(spark, [event("1"), event("2", created="2024-01-20 05:00:00")])).fact \
        .write.partitionBy("event_date").parquet(root)
    plan = serving.window_breakdown(spark.read.parquet(root), ts("2024-01-15 00:00:00"), ts("2024-01-16 00:00:00")) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_a_cluster_without_a_shared_folder_is_refused():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session)
