from datetime import datetime

from pyspark.sql import functions as F

from tidemark import catalog
from tidemark.operators import health, quality
from tidemark.sources import run_ledger
from tidemark.session import scratch_path
from conftest import SF_SMALL, bronze_rows, event


def test_unique_fails_on_landing_passes_on_bronze(spark):
    assert quality.check_unique(catalog.landing(spark, SF_SMALL), "event_id").count() > 0
    assert quality.check_unique(catalog.bronze(spark, SF_SMALL), "event_id").count() == 0


def test_not_null_reports_only_failing_columns(spark):
    df = bronze_rows(spark, [event("1", repo=None), event("2")])
    got = {r["column_name"]: r["null_rows"] for r in
           quality.check_not_null(df, ["event_id", "repo_id"]).collect()}
    assert got == {"repo_id": 1}


def test_relationship_finds_orphans(spark):
    m = catalog.models(spark, SF_SMALL)
    assert quality.check_relationship(m.fact, m.dim_repo, "repo_sk").count() == 0
    partial = m.dim_repo.where(F.col("repo_id") % 5 != 0)
    orphans = quality.check_relationship(m.fact, partial, "repo_sk")
    assert orphans.count() == m.fact.where(F.col("repo_id") % 5 == 0).count() > 0


def test_reconciliation_and_grain_fail_on_defects(spark):
    m = catalog.models(spark, SF_SMALL)
    assert quality.check_reconciliation(m.bronze, m.stg, m.quarantine).count() == 0
    lost = m.stg.where(F.col("_source_file") != m.stg.first()["_source_file"])
    assert quality.check_reconciliation(m.bronze, lost, m.quarantine).count() == 1
    assert quality.check_grain(m.momentum, ["repo_id", "event_date"]).count() == 0
    dup = m.momentum.unionByName(m.momentum.where(F.col("repo_id") % 7 == 0))
    assert quality.check_grain(dup, ["repo_id", "event_date"]).count() > 0


def test_freshness_thresholds(spark):
    b = catalog.bronze(spark, SF_SMALL)
    last = b.agg(F.max("_loaded_at")).first()[0]
    from datetime import timedelta
    got = [r["status"] for r in quality.check_freshness(
        b, [last + timedelta(hours=h) for h in (1, 30, 60)]).collect()]
    assert got == ["pass", "warn", "error"]


def test_volume_spike_and_drop(spark):
    stg = catalog.models(spark, "/root/testdata/sf0.01").stg
    day = stg.agg(F.max("event_date")).first()[0]
    from datetime import timedelta
    spike_day = day - timedelta(days=5)
    rows = stg.where(F.col("event_date") == spike_day)
    spiked = quality.volume_anomalies(stg.unionByName(rows).unionByName(rows))
    flagged = {r["day"]: r["direction"] for r in spiked.where("is_anomaly").collect()}
    assert flagged.get(spike_day) == "spike"
    thinned = stg.where((F.col("event_date") != spike_day) | (F.col("actor_id") % 10 == 0))
    dropped = {r["day"]: r["direction"] for r in
               quality.volume_anomalies(thinned).where("is_anomaly").collect()}
    assert dropped.get(spike_day) == "drop"


def test_schema_drift(spark):
    stg = catalog.models(spark, SF_SMALL).stg
    drifted = stg.withColumn("actor_id", F.col("actor_id").cast("string")) \
        .drop("payload_action").withColumn("extra", F.lit(1))
    got = {r["column_name"]: r["change"] for r in quality.schema_changes(drifted, stg.schema).collect()}
    assert got == {"actor_id": "type_changed", "payload_action": "column_removed",
                   "extra": "column_added"}
    assert quality.schema_changes(stg, stg.schema).count() == 0


def test_run_checks_pass_on_clean_build_except_source_nulls(spark):
    res = quality.run_checks(catalog.models(spark, SF_SMALL).as_dict())
    failing = {(r["check_name"], r["model"], r["column_name"]) for r in res.where("status = 'fail'").collect()}
    assert failing == {("not_null", "raw.gh_events", "event_id")}


def test_freshness_at_hour_boundary_and_status(spark):
    b = bronze_rows(spark, [event("1", loaded="2024-01-31 23:59:00")])
    row = health.sla_status(health.freshness(b, datetime(2024, 2, 1, 0, 1))).first()
    assert row["hours_since_load"] == 1 and row["sla"] == "Fresh" and row["batches"] == 1


def test_ledger_rules_and_kpis(spark):
    path = scratch_path(spark, "t-ledger")
    run_ledger.append_runs(path, run_ledger.run_record(
        spark, "r1", "raw.gh_events", "2024-01-15-05:00", "failure", 0, 2.0, "x" * 5000,
        datetime(2024, 1, 15, 6)))
    run_ledger.append_runs(path, run_ledger.run_record(
        spark, "r2", "dbt_build", None, "success", None, 4.0, "", datetime(2024, 1, 15, 7)))
    runs = run_ledger.read_runs(spark, path)
    errs = {r["run_id"]: r["error"] for r in runs.collect()}
    assert len(errs["r1"]) == 2000 and errs["r2"] is None
    k = health.run_kpis(runs).first()
    assert (k["total_runs"], k["failures"], k["successes"], k["total_rows"]) == (2, 1, 1, 0)
    assert k["success_pct"] == 50.0 and k["avg_duration_s"] == 3.0
    st = health.overall_status(runs, bronze_rows(spark, [event("1", loaded="2024-01-15 06:00:00")]),
                               datetime(2024, 1, 15, 8)).first()
    assert st["status"] == "failed"
    assert health.has_run_metadata(spark, path)
    assert not health.has_run_metadata(spark, path + "-missing")
