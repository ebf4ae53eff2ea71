"""Key-based merge operators: keep the winning row per key.

The winner per ``event_id`` is the row with the greatest
(``_loaded_at``, instant of the hour that ``_source_file`` names), whatever
order batches arrive in. Remaining columns break exact ties so the result is
deterministic.

Plan shape: ``max(struct(order..., row...))`` grouped by key. That is a
partial (map-side) aggregate followed by one shuffle on the key, so even a
single key holding a large share of the rows collapses inside each map task
instead of landing whole in one reducer, which a ``row_number`` window would
do.

Rows without a key cannot be told apart by it. They are matched on all other
columns but ``_loaded_at``: what one load delivers several times stays so often,
and the same hour delivered again under a later load adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import EPOCH_FLOOR, file_instant


def _order_key() -> list[Column]:
    floor = F.lit(EPOCH_FLOOR).cast("timestamp_ntz")
    return [
        F.col("_loaded_at").alias("__o1"),
        F.coalesce(file_instant("_source_file"), floor).alias("__o2"),
    ]


def once_per_load(rows: DataFrame) -> DataFrame:
    """Rows without a key, as often as the load that holds most copies of them,
    under the latest load's stamp, however often their hour was loaded."""
    others = [c for c in rows.columns if c != "_loaded_at"]
    return (rows.groupBy(*rows.columns).agg(F.count("*").alias("__n"))
            .groupBy(*others).agg(F.max("_loaded_at").alias("_loaded_at"), F.max("__n").alias("__n"))
            .withColumn("__n", F.explode(F.sequence(F.lit(1), "__n"))).select(*rows.columns))


def latest_per_key(df: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per non-null ``key``: the latest by (_loaded_at, file instant);
    rows without a key once per load (``once_per_load``)."""
    cols = df.columns
    others = [c for c in cols if c != key]
    packed = F.struct(*_order_key(), *[F.col(c) for c in others]).alias("__w")
    winners = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(packed).alias("__w"))
        .select(key, *[F.col(f"__w.{c}").alias(c) for c in others])
        .select(*cols)
    )
    return winners.unionByName(once_per_load(df.where(F.col(key).isNull())))


def merge_bronze(target: DataFrame | None, batch: DataFrame,
                 key: str = "event_id") -> DataFrame:
    """Upsert ``batch`` into ``target`` on ``key``; order-independent.

    Only target rows whose key occurs in the batch, and those without a key,
    take part in the winner selection; all other target rows pass through
    untouched.
    """
    untouched, winners = merge_parts(target, batch, key)
    return winners if untouched is None else untouched.unionByName(winners)


def merge_parts(target: DataFrame | None, batch: DataFrame, key: str = "event_id",
                keys: DataFrame | None = None) -> tuple[DataFrame | None, DataFrame]:
    """The two parts of ``merge_bronze``: target rows that pass through, and
    the winners of the batch's keys with all rows without a key. ``keys`` are
    the batch's distinct keys, if they are at hand."""
    batch = batch.select(*(target.columns if target is not None else batch.columns))
    if target is None:
        return None, latest_per_key(batch, key)
    if keys is None:
        keys = batch.where(F.col(key).isNotNull()).select(key).distinct()
    known = target.where(F.col(key).isNotNull())
    untouched = known.join(keys, key, "left_anti")
    touched = known.join(keys, key, "left_semi").unionByName(target.where(F.col(key).isNull()))
    return untouched, latest_per_key(touched.unionByName(batch), key)


def upsert(target: DataFrame, batch: DataFrame, key: str = "event_id",
           delete_keys: DataFrame | None = None, replace_null_keys: bool = False) -> DataFrame:
    """``delete+insert`` on ``key``: drop target rows whose key is in the
    batch (or in ``delete_keys``, distinct ones), then append the batch.

    Null keys never match a delete, so batch rows with a null key are appended;
    with ``replace_null_keys`` the target's rows without a key go as well,
    because the batch holds all that belong there.
    """
    keys = (delete_keys if delete_keys is not None else batch).where(F.col(key).isNotNull()).select(key)
    if delete_keys is None:
        keys = keys.distinct()
    if replace_null_keys:
        target = target.where(F.col(key).isNotNull())
    kept = target.join(keys, key, "left_anti")
    return kept.unionByName(batch.select(*target.columns))
