"""Dimensions that a load merges into, with exact distinct counts (A2, A3), and
the day-over-day change spliced at the days that it touches (W1).

A distinct count does not merge, the set behind it does. Per (entity, day) the
member ids are kept as bitmaps, one 64-bit word for every 64 consecutive ids
that occur, so that a set is no larger than its members as plain rows; counts, times and names of an (entity, day) are a row beside them. Both
depend on that day's events alone, so a load replaces the days it touches. A
dimension row then follows from its entity's days: bitmaps are or-ed and
counted, the rest is summed. Only entities that stand in a touched day, before
or after, are computed again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import surrogate_key


@dataclass(frozen=True)
class Entity:
    """What a dimension is about: its key, name and member columns in silver,
    and the names of its surrogate key and member count."""
    key: str
    name: str
    member: str
    surrogate: str
    members_as: str

    def columns(self) -> list[str]:
        return [self.surrogate, self.key, self.name, "first_seen_at", "last_seen_at", "total_events", self.members_as]


REPO = Entity("repo_id", "repo_name", "actor_id", "repo_sk", "distinct_actors")
ACTOR = Entity("actor_id", "actor_login", "repo_id", "actor_sk", "distinct_repos")


def day_facts(stg: DataFrame, of: Entity) -> DataFrame:
    """``key, event_date, n, lo, hi, name`` of every (entity, day). Names are
    grouped first, so that event-sized rows meet fixed-width counters only."""
    named = stg.groupBy(of.key, "event_date", of.name).agg(
        F.count("*").alias("n"), F.min("created_at_utc").alias("lo"), F.max("created_at_utc").alias("hi"))
    return named.groupBy(of.key, "event_date").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max(of.name).alias(of.name))


def day_members(stg: DataFrame, of: Entity) -> DataFrame:
    """``key, event_date, bucket, bits``: the members of every (entity, day),
    member ``64 * bucket + i`` as bit i. Words are fixed-width, so members meet
    in one hash aggregate, map-side first."""
    member = F.col(of.member).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), member.bitwiseAND(F.lit(63)).cast("int"))
    return stg.groupBy(of.key, "event_date", F.shiftright(member, 6).alias("bucket")).agg(
        F.coalesce(F.bit_or(bit), F.lit(0).cast("long")).alias("bits"))


def dimension(facts: DataFrame, members: DataFrame, of: Entity) -> DataFrame:
    """The dimension rows of all entities in ``facts`` and ``members``."""
    sets = members.groupBy(of.key, "bucket").agg(F.bit_or("bits").alias("bits"))
    sizes = sets.groupBy(of.key).agg(F.sum(F.bit_count("bits").cast("long")).alias(of.members_as))
    whole = facts.groupBy(of.key).agg(
        F.max(of.name).alias(of.name), F.min("lo").alias("first_seen_at"), F.max("hi").alias("last_seen_at"),
        F.sum("n").cast("bigint").alias("total_events"))
    return whole.join(sizes, of.key).withColumn(of.surrogate, surrogate_key(of.key)).select(*of.columns())


def replace_days(table: DataFrame, days: DataFrame, again: DataFrame) -> DataFrame:
    """A day table with the rows of ``days`` (distinct ``event_date``) replaced by ``again``."""
    return table.join(days, "event_date", "left_anti").select(*table.columns).unionByName(again.select(*table.columns))


def touched_days(batch: DataFrame, held: DataFrame) -> DataFrame:
    """Distinct days of the batch's staged rows and of the held rows with one of
    its ids (a corrected event may leave its old day). ``batch``: landed rows."""
    ids = batch.select("event_id").where("event_id is not null").distinct()
    left = held.join(ids, "event_id", "left_semi").select("event_date")
    return left.unionByName(batch.select(F.to_date("created_at").alias("event_date"))).where("event_date is not null").distinct()


def merge_dimension(old: DataFrame, facts: DataFrame, members: DataFrame, new_facts: DataFrame, new_members: DataFrame,
                    days: DataFrame, of: Entity) -> DataFrame:
    """The dimension after a load. ``facts`` and ``members`` are the day tables
    before it, ``new_facts`` and ``new_members`` the touched ``days`` after it."""
    before = facts.join(days, "event_date", "left_semi").select(of.key)
    entities = before.unionByName(new_facts.select(of.key)).distinct()
    mine = [replace_days(table.join(entities, of.key, "left_semi"), days, new)
            for table, new in ((facts, new_facts), (members, new_members))]
    return old.join(entities, of.key, "left_anti").select(*of.columns()).unionByName(dimension(*mine, of))


def splice_change(old: DataFrame, new: DataFrame, days: DataFrame, value: str = "momentum_score",
                  change: str = "momentum_score_dod_change") -> DataFrame:
    """W1 after a load: ``old`` holds scored (repo, day) rows with their change,
    ``new`` the scored rows of the touched ``days`` as they are now.

    Of a touched repository the rows from its first touched day to the first
    observed day after its last one are computed again, with the score observed
    before them carried in; all other rows keep their change.
    """
    kept = old.join(days, "event_date", "left_anti").select(*old.columns)
    gone = old.join(days, "event_date", "left_semi").select("repo_id", "event_date")
    span = gone.unionByName(new.select("repo_id", "event_date")).groupBy("repo_id").agg(
        F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    near = kept.join(span, "repo_id").groupBy("repo_id").agg(
        F.max(F.when(F.col("event_date") < F.col("lo"), F.col("event_date"))).alias("carry"),
        F.min(F.when(F.col("event_date") > F.col("hi"), F.col("event_date"))).alias("next"))
    bounds = span.join(near, "repo_id", "left")
    day = F.col("event_date")
    inside = (day >= F.col("lo")) & (day <= F.coalesce("next", "hi"))
    base = [c for c in old.columns if c != change]
    tagged = kept.join(bounds, "repo_id", "left")
    untouched = tagged.where("lo is null").select(*old.columns)
    outside = tagged.where(F.col("lo").isNotNull() & ~inside).select(*old.columns)
    rows = tagged.where(inside | (day == F.col("carry"))).select(*base, "lo")
    rows = rows.unionByName(new.select(*base).join(span.select("repo_id", "lo"), "repo_id").select(*base, "lo"))
    lagged = rows.withColumn(change, F.col(value) - F.lag(value).over(Window.partitionBy("repo_id").orderBy("event_date")))
    return untouched.unionByName(outside).unionByName(lagged.where(day >= F.col("lo")).select(*old.columns))
