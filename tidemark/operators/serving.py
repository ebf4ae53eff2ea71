"""Serving queries over the gold tables.

Conventions:

* Every top-k orders by its metric and then by the natural key, so ties are
  resolved the same way on every run (``TakeOrderedAndProject``: each task
  keeps its own top k, one task merges k x tasks rows).
* The headline numbers come from scalar subqueries (``DataFrame.scalar()``).
  Catalyst merges sibling scalar subqueries over the same table into one scan,
  and nothing is cross-joined. Shares and ratios to a maximum are windows over
  the few rows that their aggregate or top-k leaves.
* Per-minute rollups key on the naive UTC minute; a hot minute collapses in
  the map-side partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import event_bucket, is_bot, minute_of, safe_ratio


#: Ids (8 bytes each) that may be broadcast: 8 MB.
BROADCAST_IDS = 1_000_000


def _name_filter(name: str | Column) -> Column:
    value = F.lit(name) if isinstance(name, str) else name
    return F.col("repo_name") == value


# --------------------------------------------------------------- V1, A6, J1

def peak_minute(fact: DataFrame) -> DataFrame:
    """The busiest minute's event count (aggregate of an aggregate)."""
    per_minute = fact.groupBy(minute_of("created_at_utc").alias("minute")).agg(
        F.count("*").alias("n"))
    return per_minute.agg(F.max("n").alias("peak_minute"))


def bot_events(fact: DataFrame, dim_actor: DataFrame) -> DataFrame:
    """Events whose actor is a bot (``actor_id IN (bot actors)``).

    Left-semi join on the bot actor ids. They are counted first: up to
    ``BROADCAST_IDS`` of them the fact is not shuffled at all; beyond it the
    join is a shuffled one, with skew splitting for a hot actor.
    """
    bots = dim_actor.where(is_bot("actor_login")).select("actor_id")
    if bots.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        bots = F.broadcast(bots)
    return fact.join(bots, "actor_id", "left_semi").select(*fact.columns)


def headline_metrics(fact: DataFrame, dim_repo: DataFrame, dim_actor: DataFrame,
                     quarantine: DataFrame) -> DataFrame:
    """V1: one row of headline numbers.

    ``bot_events`` is read off the actor dimension: every fact row has a
    non-null actor that occurs in ``dim_actor`` with ``total_events`` fact
    rows, so the sum over bot actors equals the semi-join count of J1
    without joining the fact at all.
    """
    base = fact.agg(
        F.count("*").alias("events"),
        F.count_distinct("event_type").alias("event_types"),
    )
    repos = dim_repo.agg(F.count("*")).scalar()
    actors = dim_actor.agg(F.count("*")).scalar()
    bots = dim_actor.agg(
        F.coalesce(F.sum(F.when(is_bot("actor_login"), F.col("total_events"))), F.lit(0))
        .cast("bigint")).scalar()
    quarantined = quarantine.agg(F.count("*")).scalar()
    peak = peak_minute(fact).scalar()
    row = base.select(
        "events",
        repos.alias("repos"),
        actors.alias("actors"),
        quarantined.alias("quarantined"),
        "event_types",
        bots.alias("bot_events"),
        peak.alias("peak_minute"),
    )
    return row.select(
        "*",
        safe_ratio(F.col("events"), F.col("repos")).alias("avg_events_per_repo"),
        safe_ratio(F.col("bot_events"), F.col("events"), 100.0).alias("bot_share_pct"),
        safe_ratio(F.col("quarantined"), F.col("events") + F.col("quarantined"), 100.0)
        .alias("quarantine_rate_pct"),
    )


# ------------------------------------------------------- time series V2, V13-V15

def per_minute_by_type(fact: DataFrame) -> DataFrame:
    """V2: events per (minute, type), ordered by minute."""
    return (
        fact.groupBy(minute_of("created_at_utc").alias("minute"), "event_type")
        .agg(F.count("*").alias("events"))
        .orderBy("minute", "event_type")
    )


def per_minute_total(fact: DataFrame) -> DataFrame:
    """Events per minute, ordered by minute."""
    return (
        fact.groupBy(minute_of("created_at_utc").alias("minute"))
        .agg(F.count("*").alias("events"))
        .orderBy("minute")
    )


def window_breakdown(fact: DataFrame, start, end) -> DataFrame:
    """Event-type counts for events in ``[start, end)``.

    The range is on the raw event time, so it reaches the Parquet scan as a
    pushed filter; the same range on the day partition leaves other days' files
    unopened.
    """
    lo = F.lit(start).cast("timestamp_ntz")
    hi = F.lit(end).cast("timestamp_ntz")
    return (
        fact.where(F.col("event_date").between(F.to_date(lo), F.to_date(hi)))
        .where((F.col("created_at_utc") >= lo) & (F.col("created_at_utc") < hi))
        .groupBy("event_type").agg(F.count("*").alias("events"))
        .orderBy(F.desc("events"), "event_type")
    )


def composition_by_minute(fact: DataFrame) -> DataFrame:
    """Share of each type within its minute.

    The window partitions by minute over the already aggregated
    (minute, type) rows, a handful per minute.
    """
    counts = fact.groupBy(minute_of("created_at_utc").alias("minute"), "event_type").agg(
        F.count("*").alias("events"))
    w = Window.partitionBy("minute")
    return counts.select(
        "minute", "event_type", "events",
        (F.col("events").cast("double") / F.sum("events").over(w).cast("double")).alias("share"),
    ).orderBy("minute", "event_type")


# ----------------------------------------------------------------- mixes V3, W3

def event_type_mix(fact: DataFrame) -> DataFrame:
    """V3: events per type, most frequent first."""
    return (
        fact.groupBy("event_type").agg(F.count("*").alias("events"))
        .orderBy(F.desc("events"), "event_type")
    )


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """``value / sum(value)``. ``df`` is a mix of a few rows (one per type or
    kind), so the total is a window over them and the input runs once."""
    total = F.sum(value).over(Window.partitionBy()).cast("double")
    return df.withColumn(name, safe_ratio(F.col(value), total))


def ratio_to_max(df: DataFrame, value: str, name: str = "ratio_to_max") -> DataFrame:
    """``value / max(value)``, for a top-k's rows: one window over them."""
    top = F.max(value).over(Window.partitionBy()).cast("double")
    return df.withColumn(name, safe_ratio(F.col(value), top))


def event_type_share(fact: DataFrame) -> DataFrame:
    return share_of_total(event_type_mix(fact), "events")


# ------------------------------------------------------------- repositories

def momentum_leaderboard(momentum: DataFrame, min_actors: int = 1, limit: int = 20) -> DataFrame:
    """V4: top (repo, day) rows by score among those with enough actors.

    Every day counts, so a repo can appear once per day.
    """
    return (
        momentum.where(F.col("active_actors") >= int(min_actors))
        .orderBy(F.desc("momentum_score"), "repo_id", "event_date")
        .limit(int(limit))
        .select("repo_name", "momentum_score", "total_events", "active_actors",
                "push_events", "pr_events", "issue_events", "star_events",
                "fork_events", "review_events")
    )


def repo_event_distribution(dim_repo: DataFrame) -> DataFrame:
    """V5: repositories per events-per-repo bucket; empty buckets absent."""
    label, ordinal = event_bucket("total_events")
    return (
        dim_repo.groupBy(label.alias("bucket"), ordinal.alias("ord"))
        .agg(F.count("*").alias("repos"))
        .orderBy("ord")
    )


def repo_options(dim_repo: DataFrame, limit: int = 300) -> DataFrame:
    """V6: the most active repository names."""
    return (
        dim_repo.orderBy(F.desc("total_events"), "repo_id")
        .limit(int(limit)).select("repo_name")
    )


def top_repo_name(dim_repo: DataFrame) -> Column:
    """The first entry of ``repo_options`` as a scalar subquery."""
    return repo_options(dim_repo, 1).scalar()


def repo_summary(dim_repo: DataFrame, name: str | Column) -> DataFrame:
    """V7: the dimension row(s) whose max name equals ``name``."""
    return dim_repo.where(_name_filter(name)).select(
        "repo_name", "total_events", "distinct_actors", "first_seen_at", "last_seen_at")


def repo_by_type(stg: DataFrame, name: str | Column) -> DataFrame:
    """V8: a repository's events per type (per-event name matches)."""
    return (
        stg.where(_name_filter(name)).groupBy("event_type")
        .agg(F.count("*").alias("events"))
        .orderBy(F.desc("events"), "event_type")
    )


def repo_timeline(stg: DataFrame, name: str | Column) -> DataFrame:
    """V9: a repository's events per minute."""
    return (
        stg.where(_name_filter(name))
        .groupBy(minute_of("created_at_utc").alias("minute"))
        .agg(F.count("*").alias("events"))
        .orderBy("minute")
    )


def repo_top_actors(stg: DataFrame, name: str | Column, limit: int = 10) -> DataFrame:
    """A repository's top contributors by login."""
    return (
        stg.where(_name_filter(name)).groupBy("actor_login")
        .agg(F.count("*").alias("events"))
        .orderBy(F.desc("events"), F.asc_nulls_last("actor_login"))
        .limit(int(limit))
    )


def repo_actor_ratio(stg: DataFrame, name: str | Column, limit: int = 10) -> DataFrame:
    """W4 on V10: each top contributor's events relative to the first."""
    return ratio_to_max(repo_top_actors(stg, name, limit), "events")


# --------------------------------------------------------------- contributors

def top_contributors(dim_actor: DataFrame, exclude_bots: bool = True, limit: int = 20) -> DataFrame:
    """Actors by events; with bots excluded, null logins drop out too."""
    df = dim_actor.where(~is_bot("actor_login")) if exclude_bots else dim_actor
    return (
        df.orderBy(F.desc("total_events"), "actor_id")
        .limit(int(limit))
        .select("actor_login", "total_events", "distinct_repos")
    )


def contributor_split(dim_actor: DataFrame) -> DataFrame:
    """Actors and events per kind; a null login counts as Human."""
    kind = F.when(is_bot("actor_login"), F.lit("Bot")).otherwise(F.lit("Human"))
    return dim_actor.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("actors"),
        F.sum("total_events").cast("bigint").alias("events"),
    )


def contributor_share(dim_actor: DataFrame) -> DataFrame:
    """W3 on V12: each kind's share of events."""
    return share_of_total(contributor_split(dim_actor), "events", "event_share")
