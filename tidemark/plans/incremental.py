"""Incremental refresh (I1-I3) over the versioned table store.

Selection is by batch, not by the load-time watermark: each call processes
exactly the rows it is given, and the store marks the batch id. A
batch stamped earlier but committed later is therefore never skipped, and
replaying a batch changes nothing. ``new_rows`` keeps the watermark rule
for parity.

Per batch (a refresh or a stream's micro-batch):

1. bronze <- merge of the batch into the current bronze (later load wins,
   order-independent);
2. the winning rows of the batch's keys, kept from that merge, are typed and
   tagged; their keys are deleted from *both* silver tables (a repaired row leaves
   quarantine) and from the fact, and the rows are inserted where they now
   belong; without silver tables they are built from all of bronze;
3. the activity rollup and daily activity are recomputed for the touched days,
   momentum and the dimensions from them;
4. all versions become visible in one commit.

Event-grain tables are day-partitioned in the store and upserted day by
day: a batch rewrites the days it lands in and the days that held its keys,
nothing else.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import EPOCH_FLOOR
from tidemark.operators import gold, silver
from tidemark.operators.merge import merge_parts, upsert
from tidemark.schemas import BRONZE_COLUMNS, FACT_COLUMNS, QUARANTINE_COLUMNS, STG_COLUMNS
from tidemark.sources.run_ledger import recorded
from tidemark.sources.tables import Conflict, Entry, TableStore, day_values, days_with_ids


def watermark(target: DataFrame | None) -> Column:
    """``coalesce(max(_loaded_at), 1900-01-01)`` of the target, as a scalar."""
    floor = F.lit(datetime.fromisoformat(EPOCH_FLOOR)).cast("timestamp_ntz")
    if target is None:
        return floor
    return target.agg(F.coalesce(F.max("_loaded_at"), floor)).scalar()


def new_rows(source: DataFrame, target: DataFrame | None, eager: bool = True) -> DataFrame:
    """Source rows loaded strictly after the target's latest load.

    ``eager`` reads the watermark first (one scalar) so that the filter is a
    literal and reaches the Parquet scan as a pushed filter.
    """
    wm = watermark(target)
    if eager and target is not None:
        value = target.agg(F.max("_loaded_at").alias("w")).collect()[0]["w"]
        wm = F.lit(value or datetime.fromisoformat(EPOCH_FLOOR)).cast("timestamp_ntz")
    return source.where(F.col("_loaded_at") > wm)


# Day partition of each event-grain table (null days share one partition).
DAY = {
    "bronze": lambda: F.to_date("created_at"),
    "stg": lambda: F.col("event_date"),
    "quarantine": lambda: F.to_date("created_at_tz"),
    "fact": lambda: F.col("event_date"),
}
#: Times that a batch starts again when another writer commits first.
MAX_TRIES = 5


def batch_keys(batch: DataFrame) -> DataFrame:
    return batch.where(F.col("event_id").isNotNull()).select("event_id").distinct()


def touched_days(store: TableStore, current: dict[str, Entry], batch: DataFrame,
                 keys: DataFrame) -> set[str] | None:
    """Days of the batch's own rows, and days on which bronze holds one of its
    keys (a row whose day changed must leave its old day). Null: all days, as
    there is no bronze yet.

    The id range of each day rules days out first; only the key column of the
    others is read. Where ids rise with time, as the feed's do, those are the
    days around the batch.
    """
    if "bronze" not in current:
        return None
    day = DAY["bronze"]()
    number = F.col("event_id").try_cast("bigint")
    b = batch.where("event_id is not null").agg(
        F.min(number).alias("lo"), F.max(number).alias("hi"), F.count_if(number.isNull()).alias("odd")).first()
    entry = current["bronze"]
    may = days_with_ids(entry, *((None, None) if b["odd"] else (b["lo"] if b["lo"] is not None else 1,
                                                              b["hi"] if b["hi"] is not None else 0)))
    held = store.read("bronze", current, days=may).select("event_id", day.alias("d"))
    hit = held.join(keys, "event_id", "left_semi").select("d")
    return day_values(hit.unionByName(batch.select(day.alias("d"))), F.col("d"))


def refresh(store: TableStore, batch: DataFrame, batch_id: str, name_rule: str = "max",
            ledger: str | None = None) -> bool:
    """Apply one batch of landed rows. Returns False for a replayed batch.

    If another writer commits first, the batch is applied again to the state
    that writer left. With a ``ledger`` path the hours that the batch loads and
    the build are recorded there as runs, also if it fails.
    """
    if store.processed(batch_id):
        return False
    # The batch feeds the merge and the key set of every upsert; keep it
    # instead of re-deriving it for each (lost blocks recompute from lineage).
    batch = batch.select(*BRONZE_COLUMNS).persist()
    try:
        with recorded(batch, ledger, f"refresh:{batch_id}"):
            try:
                _commit(store, batch, batch_id, name_rule)
            except BaseException:
                batch.unpersist()  # the ledger reads the batch's hours only, past a column that fails
                raise
    finally:
        batch.unpersist()
    return True


def _commit(store: TableStore, batch: DataFrame, batch_id: str, name_rule: str) -> None:
    for left in reversed(range(MAX_TRIES)):
        base, current = store.snapshot()
        try:
            return store.commit(_apply(store, batch, current, name_rule), batch_id, base, current)
        except Conflict:
            if not left:
                raise


def _apply(store: TableStore, batch: DataFrame, current: dict[str, Entry],
           name_rule: str) -> dict[str, Entry]:
    """Stage every table with the batch applied."""
    keys = batch_keys(batch)
    days = touched_days(store, current, batch, keys)
    staged: dict[str, Entry] = {}
    old = store.read("bronze", current, days=days)
    untouched, winners = merge_parts(old, batch, keys=keys)
    winners.persist()  # batch-sized, feeds four tables
    try:
        staged["bronze"] = store.stage_parts(
            "bronze", winners if untouched is None else untouched.unionByName(winners),
            DAY["bronze"](), days, current, "event_id")
        rows = winners
        if "stg" not in current:  # no silver yet: build it from all of bronze
            days, rows = None, store.read("bronze", staged)
        _stage_silver(store, current, staged, days, rows, keys)
    finally:
        winners.unpersist()
    _stage_gold(store, current, staged, days, name_rule)
    return staged


def _together(jobs: dict[str, Callable[[], Entry]]) -> dict[str, Entry]:
    """Stage tables that do not depend on each other at the same time, so that
    one's last tasks and its commit leave no cores idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {table: pool.submit(job) for table, job in jobs.items()}
    return {table: r.result() for table, r in running.items()}


def _stage_silver(store: TableStore, current: dict[str, Entry], staged: dict[str, Entry],
                  days: set[str] | None, rows: DataFrame, keys: DataFrame) -> None:
    """Silver tables and the fact after a bronze merge.

    A row's day is the UTC date of its event time in every event-grain table,
    so the days that bronze touched cover every day they can change on.
    ``rows`` are the winners of the batch's keys and all rows without a key.
    """
    tagged = silver.base_events(rows)
    clean = tagged.where(F.col("dq_reason").isNull()).select(*STG_COLUMNS)
    rejected = tagged.where(F.col("dq_reason").isNotNull()).select(*QUARANTINE_COLUMNS)

    def stage(table: str, new: DataFrame) -> Entry:
        # Keys leave both silver tables, so a repaired row leaves quarantine.
        if days is not None:
            new = upsert(store.read(table, current, days=days).select(*new.columns), new,
                         delete_keys=keys, replace_null_keys=True)
        return store.stage_parts(table, new, DAY[table](), days, current)

    staged.update(_together({"stg": lambda: stage("stg", clean), "quarantine": lambda: stage("quarantine", rejected),
                             "fact": lambda: stage("fact", gold.fact_events(clean))}))


def _stage_gold(store: TableStore, current: dict[str, Entry], staged: dict[str, Entry],
                days: set[str] | None, name_rule: str) -> None:
    """Gold after a silver upsert.

    The activity rollup is day-partitioned and recomputed for the touched days
    (a day's rows depend only on that day's events), whatever the name rule.
    Daily activity, momentum and the dimensions derive from it; the ``latest``
    rule takes their names from silver.
    """
    if "rollup" not in current:
        days = None
    day = F.col("event_date")
    staged["rollup"] = store.stage_parts(
        "rollup", gold.activity_rollup(store.read("stg", staged, days=days)), day, days, current)
    stg, rollup = store.read("stg", staged), store.read("rollup", staged)

    def stage_daily() -> Entry:
        if name_rule == "max" and "daily" in current and days is not None:
            daily = gold.daily_from_rollup(store.read("rollup", staged, days=days))
            return store.stage_parts("daily", daily, day, days, current)
        return store.stage_parts("daily", gold.repo_daily_activity(stg, name_rule, rollup), day, None, current)

    def stage_momentum() -> Entry:
        staged["daily"] = stage_daily()
        return store.stage("momentum", gold.repo_momentum(store.read("daily", staged)))

    staged.update(_together({"momentum": stage_momentum,
                             "dim_repo": lambda: store.stage("dim_repo", gold.dim_repo(stg, name_rule, rollup)),
                             "dim_actor": lambda: store.stage("dim_actor", gold.dim_actor(stg, name_rule, rollup))}))


def read_model(store: TableStore, name: str, columns: list[str] | None = None) -> DataFrame:
    df = store.read(name)
    if df is None:
        raise LookupError(f"no committed version of {name}")
    return df.select(*columns) if columns else df
