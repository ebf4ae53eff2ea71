"""Gold layer: daily activity, momentum, dimensions and the fact.

Plans (checked with ``explain``):

* ``repo_daily_activity``/``dim_*``: an exact distinct count next to plain
  counts and a max name. Counts go through two hash aggregates, first keyed
  by (group keys, member) and then by the group keys, each with a map-side
  partial step: a repository with a third of all events spreads over its
  actors in the first shuffle, and only one row per (repository, day,
  actor) reaches the second. The max name comes from distinct
  (keys, name) rows and is joined back on keys that both sides are already
  hash-partitioned by, so no raw event goes through a sort-based aggregate.
* ``repo_momentum``: the ``lag`` window runs after the daily rollup, one row
  per (repository, day), so its shuffle by ``repo_id`` moves aggregated rows only.
* ``fact_events``: surrogate keys are computed from the ids, so building
  the fact needs no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ACTIVITY_COLUMNS, momentum_score, surrogate_key
from tidemark.schemas import FACT_COLUMNS


NAME_RULES = ("max", "latest")


def named_latest(counts: DataFrame, stg: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``counts`` with the name on each group's most recent event instead of
    the lexicographic maximum; of events at the same instant the one with the
    greatest event id counts.

    A plain equi-join on the group keys, which are never null in the silver
    table (its contract rejects null ids and times); both sides come out of
    aggregations hash-partitioned on exactly these keys.
    """
    names = stg.groupBy(*keys).agg(
        F.max_by(column, F.struct("created_at_utc", "event_id")).alias("__name"))
    return counts.join(names, keys).withColumn(column, F.col("__name")).select(*counts.columns)


def _rule(name_rule: str) -> bool:
    """Whether names need the silver table."""
    if name_rule not in NAME_RULES:
        raise ValueError(f"unknown name rule {name_rule!r}")
    return name_rule == "latest"


ROLLUP_KEYS = ["repo_id", "event_date", "actor_id", "repo_name", "actor_login"]


def activity_rollup(stg: DataFrame) -> DataFrame:
    """One row per (repo, day, actor, repo name, actor login): the base that
    daily activity and both dimensions are derived from. It is smaller than
    silver only as far as actors repeat in a repository on a day.

    A single hash aggregate over the raw events (names are keys, every buffer
    is fixed-width), with a map-side partial step, so silver is scanned and
    shuffled once for all three models. A hot repository spreads over its
    actors; a hot actor collapses inside each map task. The rollup is
    day-partitionable: a day's rows depend only on that day's events.
    """
    return stg.groupBy(*ROLLUP_KEYS).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("event_type") == F.lit(t)).alias(c) for c, t in ACTIVITY_COLUMNS],
        F.min("created_at_utc").alias("first_seen_at"),
        F.max("created_at_utc").alias("last_seen_at"),
    )


def _named(column: str) -> Column:
    """Name maximum over rollup rows. It reads the row count (always
    positive) so that the optimizer cannot fold it back onto the raw rows,
    which it would do for a duplicate-agnostic ``max`` over a pure distinct."""
    return F.max(F.when(F.col("n") > 0, F.col(column)))


def daily_from_rollup(rollup: DataFrame) -> DataFrame:
    """A1 from the rollup: per (repo, day) counts, distinct actors, names.

    One pass over the rollup: per (repo, day, actor) and then per
    (repo, day), the name maximum carried along. The string maximum makes
    both steps sort-based, but they run on rollup rows, never raw events,
    and no second pass or join is needed for the name.
    """
    keys = ["repo_id", "event_date"]
    kinds = [c for c, _ in ACTIVITY_COLUMNS]
    per_actor = rollup.groupBy(*keys, "actor_id").agg(
        F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in kinds],
        _named("repo_name").alias("repo_name"))
    return per_actor.groupBy(*keys).agg(
        F.max("repo_name").alias("repo_name"),
        F.sum("n").cast("bigint").alias("total_events"),
        F.count("actor_id").alias("active_actors"),
        *[F.sum(c).cast("bigint").alias(c) for c in kinds],
    ).select(
        "repo_id", "repo_name", "event_date", "total_events", "active_actors", *kinds,
    )


def repo_daily_activity(stg: DataFrame, name_rule: str = "max",
                        rollup: DataFrame | None = None) -> DataFrame:
    """A1: per (repo, UTC day) event counts, distinct actors, six type counts."""
    daily = daily_from_rollup(activity_rollup(stg) if rollup is None else rollup)
    return named_latest(daily, stg, ["repo_id", "event_date"], "repo_name") if _rule(name_rule) else daily


def score_momentum(daily: DataFrame) -> DataFrame:
    """Weighted momentum score (double)."""
    return daily.withColumn("momentum_score", momentum_score())


def repo_momentum(daily: DataFrame) -> DataFrame:
    """Score and change against the repo's previous observed day.

    Days without events are not filled in; the first day gets null.
    """
    w = Window.partitionBy("repo_id").orderBy("event_date")
    scored = score_momentum(daily)
    return scored.withColumn(
        "momentum_score_dod_change",
        F.col("momentum_score") - F.lag("momentum_score").over(w),
    )


def dimension_from_rollup(rollup: DataFrame, key: str, name: str, member: str,
                          members_as: str) -> DataFrame:
    """A2/A3 from the rollup: exact, since sums, min/max, the name maximum and
    the distinct member count all combine over (key, member) rows across
    days. One pass, the name carried along as in ``daily_from_rollup``."""
    per_member = rollup.groupBy(key, member).agg(
        F.sum("n").alias("n"),
        F.min("first_seen_at").alias("lo"),
        F.max("last_seen_at").alias("hi"),
        _named(name).alias(name),
    )
    return per_member.groupBy(key).agg(
        F.max(name).alias(name),
        F.min("lo").alias("first_seen_at"),
        F.max("hi").alias("last_seen_at"),
        F.sum("n").cast("bigint").alias("total_events"),
        F.count(member).alias(members_as),
    )


def _dimension(stg: DataFrame | None, key: str, name: str, member: str, members_as: str,
               name_rule: str, rollup: DataFrame | None) -> DataFrame:
    rows = activity_rollup(stg) if rollup is None else rollup
    base = dimension_from_rollup(rows, key, name, member, members_as)
    return named_latest(base, stg, [key], name) if _rule(name_rule) else base


def dim_repo(stg: DataFrame | None, name_rule: str = "max", rollup: DataFrame | None = None) -> DataFrame:
    """A2: one row per repository. The rule chooses the name only; all other
    columns come from the rollup."""
    base = _dimension(stg, "repo_id", "repo_name", "actor_id", "distinct_actors", name_rule, rollup)
    return base.select(
        surrogate_key("repo_id").alias("repo_sk"), "repo_id", "repo_name",
        "first_seen_at", "last_seen_at", "total_events", "distinct_actors",
    )


def dim_actor(stg: DataFrame | None, name_rule: str = "max", rollup: DataFrame | None = None) -> DataFrame:
    """A3: one row per actor."""
    base = _dimension(stg, "actor_id", "actor_login", "repo_id", "distinct_repos", name_rule, rollup)
    return base.select(
        surrogate_key("actor_id").alias("actor_sk"), "actor_id", "actor_login",
        "first_seen_at", "last_seen_at", "total_events", "distinct_repos",
    )


def fact_events(stg: DataFrame) -> DataFrame:
    """Event-grain fact with surrogate keys computed, not joined."""
    return stg.select(
        "event_id",
        surrogate_key("repo_id").alias("repo_sk"),
        surrogate_key("actor_id").alias("actor_sk"),
        "repo_id", "actor_id", "event_type", "payload_action",
        "created_at_utc", "event_date", "_loaded_at",
    ).select(*FACT_COLUMNS)
