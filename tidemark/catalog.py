"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query starts from the driver's ``events`` table, derives the landing
rows and bronze table through the binding, and runs the operators over the
whole of it. Parameters are the dashboard defaults; the repository of the
drill-down queries is the first entry of ``repo_options``, as the dashboard
preselects it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cube, gold, health, members, merge, quality, serving, silver
from tidemark.plans import medallion
from tidemark.session import configure, scratch_path
from tidemark.sources import binding, hours

# Fixed parameters of the registered queries.
AS_OF = datetime(2024, 2, 1, 0, 0, 0)
WINDOW_START = datetime(2024, 1, 10, 0, 0, 0)
WINDOW_END = datetime(2024, 1, 20, 0, 0, 0)
LEADERBOARD_MIN_ACTORS = 2
LEADERBOARD_LIMIT = 20

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return run

    return deco


def queries() -> dict[str, Query]:
    # Modules that register file-backed queries.
    from tidemark.plans import file_queries  # noqa: F401

    return dict(_REGISTRY)


# ------------------------------------------------------------------ helpers

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.read_table(spark, sf_dir, "events")


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.landing(events(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.bronze(events(spark, sf_dir))


def models(spark: SparkSession, sf_dir: str) -> medallion.Models:
    return medallion.build(bronze(spark, sf_dir))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.runs(bronze(spark, sf_dir))


# ----------------------------------------------------------- bronze, silver

@register("bronze_merge")
def q_bronze_merge(spark, sf_dir):
    """Landing rows merged on event_id (later load wins)."""
    return bronze(spark, sf_dir)


@register("typed_events")
def q_typed_events(spark, sf_dir):
    """P1 + P2: typed bronze with the data-quality verdict."""
    return silver.base_events(bronze(spark, sf_dir))


@register("stg_events")
def q_stg_events(spark, sf_dir):
    return models(spark, sf_dir).stg


@register("quarantine_events")
def q_quarantine_events(spark, sf_dir):
    return models(spark, sf_dir).quarantine


@register("quarantine_summary")
def q_quarantine_summary(spark, sf_dir):
    return silver.quarantine_summary(models(spark, sf_dir).quarantine)


# --------------------------------------------------------------------- gold

@register("repo_daily_activity")
def q_repo_daily_activity(spark, sf_dir):
    return models(spark, sf_dir).daily


@register("repo_momentum")
def q_repo_momentum(spark, sf_dir):
    return models(spark, sf_dir).momentum


@register("momentum_leaderboard")
def q_momentum_leaderboard(spark, sf_dir):
    """V4 with the dashboard defaults: at least 2 actors, top 20."""
    return serving.momentum_leaderboard(models(spark, sf_dir).momentum,
                                        LEADERBOARD_MIN_ACTORS, LEADERBOARD_LIMIT)


@register("momentum_leaderboard_all")
def q_momentum_leaderboard_all(spark, sf_dir):
    """V4 with the function defaults: at least 1 actor, top 20."""
    return serving.momentum_leaderboard(models(spark, sf_dir).momentum, 1, 20)


@register("dim_repo")
def q_dim_repo(spark, sf_dir):
    return models(spark, sf_dir).dim_repo


@register("dim_actor")
def q_dim_actor(spark, sf_dir):
    return models(spark, sf_dir).dim_actor


@register("fact_events")
def q_fact_events(spark, sf_dir):
    return models(spark, sf_dir).fact


@register("repo_latest_name")
def q_repo_latest_name(spark, sf_dir):
    """A2 with the opt-in name rule: the name on the repo's latest event."""
    m = models(spark, sf_dir)
    return gold.dim_repo(m.stg, name_rule="latest").select("repo_id", "repo_name")


# ------------------------------------------------------------------ serving

@register("headline_metrics")
def q_headline(spark, sf_dir):
    m = models(spark, sf_dir)
    return serving.headline_metrics(m.fact, m.dim_repo, m.dim_actor, m.quarantine)


@register("peak_minute")
def q_peak_minute(spark, sf_dir):
    return serving.peak_minute(models(spark, sf_dir).fact)


@register("bot_events")
def q_bot_events(spark, sf_dir):
    m = models(spark, sf_dir)
    return serving.bot_events(m.fact, m.dim_actor)


@register("per_minute_by_type")
def q_per_minute_by_type(spark, sf_dir):
    return serving.per_minute_by_type(models(spark, sf_dir).fact)


@register("per_minute_total")
def q_per_minute_total(spark, sf_dir):
    return serving.per_minute_total(models(spark, sf_dir).fact)


@register("composition_by_minute")
def q_composition(spark, sf_dir):
    return serving.composition_by_minute(models(spark, sf_dir).fact)


@register("window_breakdown")
def q_window_breakdown(spark, sf_dir):
    return serving.window_breakdown(models(spark, sf_dir).fact, WINDOW_START, WINDOW_END)


@register("event_type_mix")
def q_event_type_mix(spark, sf_dir):
    return serving.event_type_mix(models(spark, sf_dir).fact)


@register("event_type_share")
def q_event_type_share(spark, sf_dir):
    return serving.event_type_share(models(spark, sf_dir).fact)


@register("repo_event_distribution")
def q_repo_event_distribution(spark, sf_dir):
    return serving.repo_event_distribution(models(spark, sf_dir).dim_repo)


@register("repo_options")
def q_repo_options(spark, sf_dir):
    return serving.repo_options(models(spark, sf_dir).dim_repo)


def _top_name(m: medallion.Models):
    return serving.top_repo_name(m.dim_repo)


@register("repo_summary")
def q_repo_summary(spark, sf_dir):
    m = models(spark, sf_dir)
    return serving.repo_summary(m.dim_repo, _top_name(m))


@register("repo_by_type")
def q_repo_by_type(spark, sf_dir):
    m = models(spark, sf_dir)
    return serving.repo_by_type(m.stg, _top_name(m))


@register("repo_timeline")
def q_repo_timeline(spark, sf_dir):
    m = models(spark, sf_dir)
    return serving.repo_timeline(m.stg, _top_name(m))


@register("repo_top_actors")
def q_repo_top_actors(spark, sf_dir):
    m = models(spark, sf_dir)
    return serving.repo_top_actors(m.stg, _top_name(m))


@register("repo_actor_ratio")
def q_repo_actor_ratio(spark, sf_dir):
    m = models(spark, sf_dir)
    return serving.repo_actor_ratio(m.stg, _top_name(m))


@register("top_contributors")
def q_top_contributors(spark, sf_dir):
    return serving.top_contributors(models(spark, sf_dir).dim_actor, exclude_bots=True)


@register("top_contributors_with_bots")
def q_top_contributors_with_bots(spark, sf_dir):
    return serving.top_contributors(models(spark, sf_dir).dim_actor, exclude_bots=False)


@register("contributor_split")
def q_contributor_split(spark, sf_dir):
    return serving.contributor_split(models(spark, sf_dir).dim_actor)


@register("contributor_share")
def q_contributor_share(spark, sf_dir):
    return serving.contributor_share(models(spark, sf_dir).dim_actor)


# ---------------------------------------------------------- hour partitions

@register("partition_rows")
def q_partition_rows(spark, sf_dir):
    return hours.partition_rows(bronze(spark, sf_dir))


@register("hour_partitions")
def q_hour_partitions(spark, sf_dir):
    """S7 over the span of the loaded event times."""
    return hours.loaded_hours(bronze(spark, sf_dir))


@register("missing_partitions")
def q_missing_partitions(spark, sf_dir):
    """S8 over the backfill range: first event day up to the fixed instant."""
    b = bronze(spark, sf_dir)
    return hours.missing_partitions(hours.backfill_hours(b, AS_OF), b)


# ---------------------------------------------------------------- quality

@register("unique_violations")
def q_unique_violations(spark, sf_dir):
    """Q1 on the landing rows, which still hold every redelivery."""
    return quality.check_unique(landing(spark, sf_dir), "event_id")


@register("null_counts")
def q_null_counts(spark, sf_dir):
    """Q2 on bronze's contract columns."""
    return quality.check_not_null(
        bronze(spark, sf_dir), ["event_id", "event_type", "repo_id", "actor_id", "created_at"])


@register("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    """Q3: facts against a repo dimension not refreshed for the last day."""
    m = models(spark, sf_dir)
    last_day = m.stg.agg(F.max("event_date")).scalar()
    stale = gold.dim_repo(m.stg.where(F.col("event_date") < last_day))
    return quality.check_relationship(m.fact, stale, "repo_sk")


@register("reconciliation")
def q_reconciliation(spark, sf_dir):
    """Q4 with the unmerged landing rows standing in for bronze."""
    m = models(spark, sf_dir)
    return quality.check_reconciliation(landing(spark, sf_dir), m.stg, m.quarantine)


@register("grain_violations")
def q_grain_violations(spark, sf_dir):
    """Q5 on momentum with every repo's first day loaded twice."""
    mom = models(spark, sf_dir).momentum
    doubled = mom.unionByName(mom.where(F.col("momentum_score_dod_change").isNull()))
    return quality.check_grain(doubled, ["repo_id", "event_date"])


@register("source_freshness")
def q_source_freshness(spark, sf_dir):
    """Q6 at the fixed instant and 30 h / 60 h after the last load."""
    b = bronze(spark, sf_dir)
    last = b.agg(F.max("_loaded_at")).scalar()
    return quality.check_freshness(
        b, [F.lit(AS_OF), last + F.expr("INTERVAL 30 HOURS"), last + F.expr("INTERVAL 60 HOURS")])


@register("volume_anomalies")
def q_volume_anomalies(spark, sf_dir):
    """Q7 on staged rows with one day loaded three times (a spike)."""
    stg = models(spark, sf_dir).stg
    spike_day = F.date_sub(stg.agg(F.max("event_date")).scalar(), 7)
    day_rows = stg.where(F.col("event_date") == spike_day)
    return quality.volume_anomalies(stg.unionByName(day_rows).unionByName(day_rows))


@register("check_results")
def q_check_results(spark, sf_dir):
    """Q9: every test of the build in one table."""
    return quality.run_checks(models(spark, sf_dir).as_dict())


# ----------------------------------------------------------------- health

@register("recent_runs")
def q_recent_runs(spark, sf_dir):
    return health.recent_runs(runs(spark, sf_dir), 100)


@register("run_kpis")
def q_run_kpis(spark, sf_dir):
    return health.run_kpis(runs(spark, sf_dir))


@register("run_kpis_page")
def q_run_kpis_page(spark, sf_dir):
    """M6 over the health page's window of the latest 200 runs."""
    return health.run_kpis(runs(spark, sf_dir), 200)


@register("run_outcomes")
def q_run_outcomes(spark, sf_dir):
    return health.run_outcomes(runs(spark, sf_dir))


@register("ingest_by_partition")
def q_ingest_by_partition(spark, sf_dir):
    return health.ingest_by_partition(runs(spark, sf_dir))


@register("run_durations")
def q_run_durations(spark, sf_dir):
    return health.run_durations(runs(spark, sf_dir))


@register("freshness")
def q_freshness(spark, sf_dir):
    return health.freshness(bronze(spark, sf_dir), AS_OF)


@register("sla_status")
def q_sla_status(spark, sf_dir):
    return health.sla_status(health.freshness(bronze(spark, sf_dir), AS_OF))


@register("overall_status")
def q_overall_status(spark, sf_dir):
    b = bronze(spark, sf_dir)
    return health.overall_status(binding.runs(b), b, AS_OF)


# -------------------------------------------- tables that a load merges into

LAST_LOADS = datetime(2024, 1, 21)  # the loads from here on are the last batch


class _LastBatch:
    """Stored tables as the last load batch finds them, and what it brings."""

    def __init__(self, spark, sf_dir):
        def stored(name, df):
            medallion.write_model(df, f"{self.root}/{name}")
            return spark.read.parquet(f"{self.root}/{name}")

        self.root, self.stored = scratch_path(spark, "last-batch"), stored
        rows, late = landing(spark, sf_dir), F.col("_loaded_at") >= F.lit(LAST_LOADS).cast("timestamp_ntz")
        self.stg = stored("stg", silver.stg_events(merge.merge_bronze(None, rows)))
        self.before = stored("before", silver.stg_events(merge.merge_bronze(None, rows.where(~late))))
        self.days = stored("days", members.touched_days(rows.where(late), self.before))

    def again(self):
        """Staged rows of the touched days, the batch applied."""
        return self.stg.join(self.days, "event_date", "left_semi")

    def dimension(self, of):
        facts, sets = members.day_facts(self.before, of), members.day_members(self.before, of)
        facts, sets = self.stored("facts", facts), self.stored("sets", sets)
        return members.merge_dimension(
            members.dimension(facts, sets, of), facts, sets,
            members.day_facts(self.again(), of), members.day_members(self.again(), of), self.days, of)

    def cube(self):
        """The stored cube after the batch."""
        old = self.stored("cube", cube.minute_cube(self.before))
        medallion.write_model(cube.replace_days(old, self.stg, self.days), f"{self.root}/cube-after", partition_by="event_date")
        return self.before.sparkSession.read.parquet(f"{self.root}/cube-after")


@register("dim_repo_merged")
def q_dim_repo_merged(spark, sf_dir):
    """A2 after the last batch, merged into the dimension of the loads before."""
    return _LastBatch(spark, sf_dir).dimension(members.REPO)


@register("dim_actor_merged")
def q_dim_actor_merged(spark, sf_dir):
    """A3 after the last batch, merged into the dimension of the loads before."""
    return _LastBatch(spark, sf_dir).dimension(members.ACTOR)


@register("repo_momentum_spliced")
def q_repo_momentum_spliced(spark, sf_dir):
    """W1 after the last batch, spliced into the momentum of the loads before."""
    last = _LastBatch(spark, sf_dir)
    old = last.stored("momentum", gold.repo_momentum(gold.repo_daily_activity(last.before)))
    new = gold.score_momentum(gold.repo_daily_activity(last.again()))
    return members.splice_change(old, new, last.days)


@register("cube_headline_metrics")
def q_cube_headline_metrics(spark, sf_dir):
    """V1 from a count cube kept by load, and the dimensions."""
    last, m = _LastBatch(spark, sf_dir), models(spark, sf_dir)
    return cube.headline_metrics(last.cube(), m.dim_repo, m.dim_actor, m.quarantine)


@register("cube_per_minute_by_type")
def q_cube_per_minute_by_type(spark, sf_dir):
    return cube.per_minute_by_type(_LastBatch(spark, sf_dir).cube())


@register("cube_per_minute_total")
def q_cube_per_minute_total(spark, sf_dir):
    return cube.per_minute_total(_LastBatch(spark, sf_dir).cube())


@register("cube_composition_by_minute")
def q_cube_composition(spark, sf_dir):
    return cube.composition_by_minute(_LastBatch(spark, sf_dir).cube())


@register("cube_peak_minute")
def q_cube_peak_minute(spark, sf_dir):
    return cube.peak_minute(_LastBatch(spark, sf_dir).cube())
