"""The model DAG: bronze -> silver -> gold, as DataFrame composition.

``build`` returns lazily planned DataFrames; nothing runs until a caller
writes or reads one. ``materialize`` writes each model to the shared folder
in DAG order and re-reads it, so downstream models scan Parquet (pruned,
with pushed filters) and the lineage of a long refresh stays short.

Partitioning of the written tables: event-grain tables by ``event_date``
(quarantined rows with no date go to the default partition); dimensions and
rollups unpartitioned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from tidemark.operators import gold, quality, silver


@dataclass
class Models:
    bronze: DataFrame
    stg: DataFrame
    quarantine: DataFrame
    daily: DataFrame
    momentum: DataFrame
    dim_repo: DataFrame
    dim_actor: DataFrame
    fact: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return dict(self.__dict__)


def gold_models(stg: DataFrame, rollup: DataFrame | None, name_rule: str = "max") -> dict:
    """Daily activity, momentum and both dimensions, all from the shared
    activity rollup (silver scanned and shuffled once); the ``latest`` rule
    reads silver for the names on top."""
    rollup = gold.activity_rollup(stg) if rollup is None else rollup
    daily = gold.repo_daily_activity(stg, name_rule, rollup)
    return {"daily": daily, "momentum": gold.repo_momentum(daily),
            "dim_repo": gold.dim_repo(stg, name_rule, rollup),
            "dim_actor": gold.dim_actor(stg, name_rule, rollup)}


def build(bronze: DataFrame, name_rule: str = "max") -> Models:
    stg = silver.stg_events(bronze)
    return Models(
        bronze=bronze,
        stg=stg,
        quarantine=silver.quarantine_events(bronze),
        fact=gold.fact_events(stg),
        **gold_models(stg, None, name_rule),
    )


PARTITION_BY = {
    "bronze": None,
    "stg": "event_date",
    "quarantine": None,
    "daily": None,
    "momentum": None,
    "dim_repo": None,
    "dim_actor": None,
    "fact": "event_date",
}


def write_model(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: str | None = None, metrics: list[Column] | None = None) -> dict[str, int]:
    """Materialise a model as Parquet.

    A partitioned write is preceded by a ``rebalance`` on the partition
    column: AQE hashes rows by partition value and splits any value larger
    than the advisory size, so each day becomes a few right-sized files
    instead of one file per (task, day), and a huge day is still written by
    many tasks. ``metrics`` are aggregates observed on the rows as they pass;
    their values are returned.
    """
    observation = Observation()
    if metrics:
        df = df.observe(observation, *metrics)
    if partition_by:
        df = df.hint("rebalance", partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return observation.get if metrics else {}


def materialize(spark: SparkSession, bronze: DataFrame, root: str, name_rule: str = "max",
                metrics: dict[str, dict[str, int]] | None = None) -> Models:
    """Write bronze, silver and gold under ``root`` in DAG order; return the
    models re-read from their files. ``metrics`` receives what was observed of
    each model while it was written (``quality.write_metrics``)."""
    seen = write_model(bronze, f"{root}/bronze", metrics=None if metrics is None else quality.write_metrics("bronze"))
    if metrics is not None:
        metrics["bronze"] = seen
    return materialize_from_bronze(spark, root, name_rule, metrics)


def materialize_from_bronze(spark: SparkSession, root: str, name_rule: str = "max",
                            metrics: dict[str, dict[str, int]] | None = None) -> Models:
    """Silver and gold from the bronze table already written under ``root``."""
    def write(name: str, df: DataFrame) -> None:
        observed = metrics is not None and name in quality.RULES
        seen = write_model(df, f"{root}/{name}", partition_by=PARTITION_BY[name],
                           metrics=quality.write_metrics(name) if observed else None)
        if observed:
            metrics[name] = seen

    b = spark.read.parquet(f"{root}/bronze")
    stg_path = f"{root}/stg"
    write("stg", silver.stg_events(b))
    write("quarantine", silver.quarantine_events(b))
    stg = spark.read.parquet(stg_path)
    write_model(gold.activity_rollup(stg), f"{root}/rollup", partition_by="event_date")
    rollup = spark.read.parquet(f"{root}/rollup")
    models = gold_models(stg, rollup, name_rule)
    out = {
        "momentum": models["momentum"],
        "dim_repo": models["dim_repo"],
        "dim_actor": models["dim_actor"],
        "fact": gold.fact_events(stg),
    }
    for name, df in out.items():
        write(name, df)
    return read_models(spark, root, name_rule)


def read_models(spark: SparkSession, root: str, name_rule: str = "max") -> Models:
    """The models of a materialized build, read from their files."""
    read = {n: spark.read.parquet(f"{root}/{n}")
            for n in ("bronze", "stg", "quarantine", "momentum", "dim_repo", "dim_actor", "fact")}
    daily = gold.repo_daily_activity(read["stg"], name_rule, spark.read.parquet(f"{root}/rollup"))
    return Models(daily=daily, **read)
