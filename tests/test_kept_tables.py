"""Tables that loads merge into: count cube, dimensions, spliced changes; checks in one pass."""

from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL, bronze_rows, event
from tidemark import catalog
from tidemark.operators import cube, gold, members, quality, serving, silver
from tidemark.plans import medallion
from tidemark.session import scratch_path


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def stored(spark, df, name):
    path = scratch_path(spark, name)
    medallion.write_model(df, path)
    return spark.read.parquet(path)


events_ = st.lists(st.tuples(st.integers(1, 8), st.integers(1, 3), st.integers(-2, 70_000), st.integers(0, 5),
                             st.integers(0, 1), st.sampled_from(["PushEvent", "ForkEvent"])), min_size=1, max_size=14)


def staged(spark, drawn):
    """One staged row per event id, the last one drawn."""
    last = {e[0]: e for e in drawn}
    return silver.stg_events(bronze_rows(spark, [
        event(str(i), kind, actor, f"u{actor % 7}", repo, f"o/r{repo}{day % 2}",
              f"2024-01-{10 + day:02d} 05:0{minute}:00") for i, repo, actor, day, minute, kind in last.values()]))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(early=events_, late=events_)
def test_merged_tables_equal_a_rebuild(spark, early, late):
    before, batch = staged(spark, early), staged(spark, late)
    after = before.join(batch, "event_id", "left_anti").select(*batch.columns).unionByName(batch)
    before, after = stored(spark, before, "t-before"), stored(spark, after, "t-after")
    days = stored(spark, members.touched_days(
        batch.withColumnRenamed("created_at_utc", "created_at"), before), "t-days")
    again = after.join(days, "event_date", "left_semi")
    for of, rebuilt in ((members.REPO, gold.dim_repo(after)), (members.ACTOR, gold.dim_actor(after))):
        facts, sets = members.day_facts(before, of), members.day_members(before, of)
        merged = members.merge_dimension(members.dimension(facts, sets, of), facts, sets, members.day_facts(again, of),
                                         members.day_members(again, of), days, of)
        assert rows(merged) == rows(rebuilt)
    old = gold.repo_momentum(gold.repo_daily_activity(before))
    new = gold.score_momentum(gold.repo_daily_activity(again))
    assert rows(members.splice_change(old, new, days)) == rows(gold.repo_momentum(gold.repo_daily_activity(after)))
    assert rows(cube.replace_days(cube.minute_cube(before), after, days)) == rows(cube.minute_cube(after))


def test_splice_carries_the_score_before_and_stops_after_the_next_day(spark):
    schema = "repo_id long, event_date date, momentum_score double, momentum_score_dod_change double"
    day = [date(2024, 1, d) for d in range(1, 8)]
    old = spark.createDataFrame([(1, day[0], 5.0, None), (1, day[2], 7.0, 2.0), (1, day[4], 1.0, -99.0),
                                 (2, day[0], 3.0, -99.0)], schema)
    new = spark.createDataFrame([(1, day[1], 6.0)], "repo_id long, event_date date, momentum_score double")
    days = spark.createDataFrame([(day[1],)], "event_date date")
    got = {(r[0], r[1].day): r[3] for r in members.splice_change(old, new, days).collect()}
    # Rows behind the next observed day, and other repositories, keep what they had.
    assert got == {(1, 1): None, (1, 2): 1.0, (1, 3): 1.0, (1, 5): -99.0, (2, 1): -99.0}


def test_bitmaps_count_any_ids(spark):
    ids = [0, 1, -1, 32767, 32768, 32769, -32768, 1 << 40, 1 << 40, (1 << 62) + 5]
    stg = spark.createDataFrame([(7, date(2024, 1, i % 3 + 1), i_, datetime(2024, 1, 1), "n") for i, i_ in enumerate(ids)],
                                "repo_id long, event_date date, actor_id long, created_at_utc timestamp_ntz, repo_name string")
    dim = members.dimension(members.day_facts(stg, members.REPO), members.day_members(stg, members.REPO), members.REPO)
    assert dim.first()["distinct_actors"] == len(set(ids))


def test_member_sets_are_words_in_hash_aggregates(spark):
    """a set of a few ids is a few bytes, and no task sorts sets."""
    stg = spark.range(500).select(F.col("id").alias("repo_id"), F.lit(date(2024, 1, 1)).alias("event_date"),
                                  (F.col("id") * 1000 - 250_000).alias("actor_id"))
    sets = members.day_members(stg.unionByName(stg), members.REPO)
    assert dict(sets.dtypes)["bits"] == "bigint" and "Sort" not in plan_of(sets)
    ids = sets.select("repo_id", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i"), "bucket", "bits") \
        .where("(shiftright(bits, i) & 1) = 1").selectExpr("repo_id", "64 * bucket + i as actor_id")
    assert rows(ids) == rows(stg.select("repo_id", "actor_id"))


@pytest.mark.parametrize("view", ["headline_metrics", "per_minute_by_type", "per_minute_total", "composition_by_minute", "peak_minute"])
def test_cube_views_equal_the_fact_views_without_reading_it(spark, view):
    m = catalog.models(spark, SF_SMALL)
    kept = stored(spark, cube.minute_cube(m.fact), "t-cube")
    dims = [stored(spark, d, "t-dim") for d in (m.dim_repo, m.dim_actor, m.quarantine)] if view == "headline_metrics" else []
    got = getattr(cube, view)(kept, *dims)
    assert rows(got) == rows(getattr(serving, view)(m.fact, *dims))
    assert "t-cube" in plan_of(got) and "events.parquet" not in plan_of(got)


def test_empty_cube(spark):
    m = catalog.models(spark, SF_SMALL)
    none = cube.minute_cube(m.fact.where("false"))
    assert cube.per_minute_total(none).count() == 0
    row = cube.headline_metrics(none, m.dim_repo, m.dim_actor, m.quarantine).first()
    assert (row["events"], row["event_types"], row["peak_minute"]) == (0, 0, None)


def test_checks_read_each_stored_model_once(spark):
    m = medallion.materialize(spark, catalog.bronze(spark, SF_SMALL), scratch_path(spark, "t-checked"))
    checks = quality.run_checks(m.as_dict())
    plan = plan_of(checks)
    assert plan.count("\nLocation:") <= len(quality.RULES)
    assert checks.count() == 27 and checks.where("failures <> 0").count() == 0


def test_every_check_fails_on_its_defect(spark):
    m = catalog.models(spark, SF_SMALL).as_dict()
    first = m["stg"].orderBy("event_id").limit(1)
    broken = {
        **m, "bronze": m["bronze"].unionByName(m["bronze"].where("event_id is not null").limit(2)),
        "stg": m["stg"].withColumn("repo_id", F.when(F.col("event_id") == first.first()["event_id"], None).otherwise(F.col("repo_id"))),
        "dim_repo": m["dim_repo"].where("repo_id % 5 <> 0"),
        "momentum": m["momentum"].unionByName(m["momentum"].where("repo_id % 7 = 0"))}
    got = {(r.check_name, r.model, r.column_name): r.failures for r in quality.run_checks(broken).where("failures > 0").collect()}
    orphans = m["fact"].where("repo_id % 5 = 0").count()
    again = m["momentum"].where("repo_id % 7 = 0").count()
    assert got == {
        ("unique", "raw.gh_events", "event_id"): 2, ("not_null", "stg_events", "repo_id"): 1,
        ("not_null", "raw.gh_events", "event_id"): m["bronze"].where("event_id is null").count(),
        ("relationships", "fact_events", "repo_sk"): orphans,
        ("assert_momentum_grain_unique", "agg_daily_repo_momentum", None): again,
        ("assert_bronze_reconciliation", "raw.gh_events", None): 1}


def test_empty_models_pass_but_do_not_reconcile(spark):
    m = catalog.models(spark, SF_SMALL).as_dict()
    none = {k: v.where("false") for k, v in m.items()}
    assert quality.run_checks(none).where("failures <> 0").count() == 0
    lost = quality.run_checks({**none, "stg": m["stg"].limit(3)}).where("failures <> 0").collect()
    assert [r.check_name for r in lost] == ["assert_bronze_reconciliation"]


def test_observed_checks_equal_those_that_read(spark):
    metrics: dict = {}
    m = medallion.materialize(spark, catalog.bronze(spark, SF_SMALL), scratch_path(spark, "t-observed"), metrics=metrics)
    seen = quality.observed_checks(spark, metrics)
    read = quality.run_checks(m.as_dict()).where("check_name in ('not_null', 'assert_bronze_reconciliation')")
    assert rows(seen) == rows(read) and metrics["stg"]["rows"] == m.stg.count()


def test_hour_range_is_dealt_and_survives_a_stray_date(spark):
    from tidemark.sources import hours

    bounds = spark.createDataFrame([(datetime(1970, 1, 1), datetime(2024, 1, 1, 5, 59)), ], "lo timestamp_ntz, hi timestamp_ntz")
    found = hours.hour_range(bounds, "lo", "hi")
    assert found.rdd.getNumPartitions() > 1
    assert found.count() == (datetime(2024, 1, 1, 5) - datetime(1970, 1, 1)) // timedelta(hours=1) + 1
    assert hours.hour_range(bounds.where("false"), "lo", "hi").count() == 0
