"""Data-quality checks (Q1-Q9). A check returns its failing rows, so an empty
result means it passes. Each is one declarative plan; no rows are collected.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import SLA_ERROR_HOURS, SLA_WARN_HOURS

# Volume-anomaly parameters (fixed choices, see SURVEY §2.11):
# baseline = previous 14 observed days, at least 7 needed, anomaly when
# |z| > 3; a zero-spread baseline flags any count that differs from its mean.
ANOMALY_LOOKBACK_DAYS = 14
ANOMALY_MIN_DAYS = 7
ANOMALY_Z = 3.0


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Q1: values of ``column`` occurring more than once (nulls ignored)."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column)
        .agg(F.count("*").alias("n")).where(F.col("n") > 1)
    )


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q2: null count per column, all columns in one pass; failing ones only."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], columns, "column_name", "null_rows")
    return long.where(F.col("null_rows") > 0)


def check_relationship(child: DataFrame, parent: DataFrame, key: str,
                       parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    pk = parent_key or key
    parents = parent.select(F.col(pk).alias(key)).where(F.col(key).isNotNull())
    return child.where(F.col(key).isNotNull()).join(parents, key, "left_anti")


def check_reconciliation(bronze: DataFrame, stg: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Q4: the counts row when bronze != staged + quarantined (J4 via scalars)."""
    counts = bronze.agg(F.count("*").alias("raw_count")).select(
        "raw_count",
        stg.agg(F.count("*")).scalar().alias("stg_count"),
        quarantine.agg(F.count("*")).scalar().alias("quarantine_count"),
    )
    return counts.where(F.col("raw_count") != F.col("stg_count") + F.col("quarantine_count"))


def check_grain(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q5 / A10: key combinations with more than one row (HAVING n > 1)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def check_freshness(bronze: DataFrame, as_of: list | Column | datetime | str,
                    warn_hours: int = SLA_WARN_HOURS, error_hours: int = SLA_ERROR_HOURS) -> DataFrame:
    """Q6: source freshness of max ``_loaded_at`` at one or more instants.

    Status is ``error`` past ``error_hours``, ``warn`` past ``warn_hours``,
    else ``pass``; no loads at all is ``error``.
    """
    if not isinstance(as_of, list):
        as_of = [as_of]
    instants = [a if isinstance(a, Column) else F.lit(a) for a in as_of]
    latest = bronze.agg(F.max("_loaded_at").alias("max_loaded_at"))
    points = latest.select(
        "max_loaded_at",
        F.explode(F.array(*[i.cast("timestamp_ntz") for i in instants])).alias("snapshotted_at"),
    )
    age = (F.unix_micros(F.col("snapshotted_at").cast("timestamp"))
           - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(1_000_000.0)
    return points.select(
        "max_loaded_at", "snapshotted_at",
        age.cast("double").alias("age_seconds"),
    ).withColumn(
        "status",
        F.when(F.col("age_seconds").isNull(), F.lit("error"))
        .when(F.col("age_seconds") > error_hours * 3600.0, F.lit("error"))
        .when(F.col("age_seconds") > warn_hours * 3600.0, F.lit("warn"))
        .otherwise(F.lit("pass")),
    )


def daily_volume(df: DataFrame, time_column: str = "created_at_utc") -> DataFrame:
    return df.groupBy(F.to_date(time_column).alias("day")).agg(F.count("*").alias("events"))


def volume_anomalies(df: DataFrame, time_column: str = "created_at_utc",
                     lookback: int = ANOMALY_LOOKBACK_DAYS, min_days: int = ANOMALY_MIN_DAYS,
                     z_limit: float = ANOMALY_Z) -> DataFrame:
    """Q7: daily event counts against the trailing baseline of observed days.

    The rollup leaves one row per day, so the baseline window, which spans
    all days in date order, runs over a few thousand rows at most.
    """
    daily = daily_volume(df, time_column)
    w = Window.orderBy("day").rowsBetween(-lookback, -1)
    stats = daily.select(
        "day", "events",
        F.count("events").over(w).alias("baseline_days"),
        F.avg(F.col("events").cast("double")).over(w).alias("mean"),
        F.stddev_samp(F.col("events").cast("double")).over(w).alias("sd"),
    )
    z = F.when(F.col("sd") > 0, (F.col("events") - F.col("mean")) / F.col("sd"))
    enough = F.col("baseline_days") >= min_days
    anomaly = enough & F.when(
        F.col("sd") > 0, F.abs(F.round(z, 6)) > z_limit
    ).otherwise(F.col("events").cast("double") != F.col("mean"))
    return stats.select(
        "day", "events", "baseline_days",
        F.round("mean", 6).alias("baseline_mean"),
        F.round("sd", 6).alias("baseline_stddev"),
        F.round(z, 6).alias("z_score"),
        anomaly.alias("is_anomaly"),
        F.when(anomaly & (F.col("events") > F.col("mean")), F.lit("spike"))
        .when(anomaly, F.lit("drop")).alias("direction"),
    )


def schema_rows(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def schema_changes(df: DataFrame, snapshot: DataFrame | T.StructType) -> DataFrame:
    """Q8: columns added, removed or retyped against a stored schema snapshot.

    Schemas are metadata, a few rows each; the comparison is a full outer
    join of the two (column, type) lists.
    """
    spark = df.sparkSession
    if isinstance(snapshot, T.StructType):
        snapshot = spark.createDataFrame(schema_rows(snapshot), "column_name string, data_type string")
    current = spark.createDataFrame(schema_rows(df.schema), "column_name string, data_type string")
    j = snapshot.alias("o").join(current.alias("n"), "column_name", "full_outer")
    change = (
        F.when(F.col("o.data_type").isNull(), F.lit("column_added"))
        .when(F.col("n.data_type").isNull(), F.lit("column_removed"))
        .when(F.col("o.data_type") != F.col("n.data_type"), F.lit("type_changed"))
    )
    return j.select(
        "column_name",
        F.col("o.data_type").alias("previous_type"),
        F.col("n.data_type").alias("current_type"),
        change.alias("change"),
    ).where(F.col("change").isNotNull())


# --------------------------------------------------------------------- Q9

def _check_row(name: str, model: str, column: str | None, failures: Column) -> list[Column]:
    return [
        F.lit(name).alias("check_name"),
        F.lit(model).alias("model"),
        F.lit(column).cast("string").alias("column_name"),
        failures.cast("bigint").alias("failures"),
    ]


#: What the build asserts of each model: (columns never null, columns without
#: repeated values, key of the model's grain).
RULES: dict[str, tuple[list[str], list[str], list[str]]] = {
    "bronze": (["event_id"], ["event_id"], []),
    "stg": (["event_id", "event_type", "repo_id", "actor_id", "created_at_utc", "event_date"], ["event_id"], []),
    "quarantine": (["dq_reason"], [], []),
    "dim_repo": (["repo_sk", "repo_id"], ["repo_sk", "repo_id"], []),
    "dim_actor": (["actor_sk", "actor_id"], ["actor_sk", "actor_id"], []),
    "fact": (["event_id", "repo_sk", "actor_sk"], ["event_id"], []),
    "momentum": (["momentum_score"], [], ["repo_id", "event_date"]),
}
#: Foreign keys: (child, column, parent that must hold it).
REFERENCES = [("fact", "repo_sk", "dim_repo"), ("fact", "actor_sk", "dim_actor")]
_NULLS = [f"n{i}" for i in range(max(len(r[0]) for r in RULES.values()))]


def check_keys(model: str, df: DataFrame) -> DataFrame:
    """One model's share of the long check table, from one scan: ``space, key,
    held, wanted, n0 ..``.

    A row per unique or grain key says that the model holds the key once, a row
    per foreign key that it wants it from the parent's key space; one more row
    without a key carries the null flags of the model's columns. All counters
    are sums, so rows of one key collapse map-side.
    """
    not_null, unique, grain = RULES[model]

    def row(space: str, key: Column, held: int, wanted: int, nulls: tuple[Column, ...] = ()) -> Column:
        counts = [*nulls, *[F.lit(0)] * (len(_NULLS) - len(nulls))]
        return F.struct(F.lit(space).alias("space"), key.cast("string").alias("key"),
                        F.lit(held).cast("long").alias("held"), F.lit(wanted).cast("long").alias("wanted"),
                        *[c.cast("long").alias(n) for n, c in zip(_NULLS, counts)])

    rows = [row(f"rows:{model}", F.lit(None), 1, 0, tuple(F.col(c).isNull().cast("int") for c in not_null))]
    rows += [row(f"unique:{model}.{c}", F.col(c), 1, 0) for c in unique]
    if grain:
        rows.append(row(f"grain:{model}", F.to_json(F.struct(*grain), {"ignoreNullFields": "false"}), 1, 0))
    rows += [row(f"unique:{parent}.{c}", F.col(c), 0, 1) for child, c, parent in REFERENCES if child == model]
    return df.select(F.inline(F.array(*rows))).where("key is not null or space like 'rows:%'")


def check_spaces(tables: dict[str, DataFrame]) -> DataFrame:
    """``space, rows, repeated, orphans, n0 ..``: the counters behind every check.
    All models' keys meet in one shuffle; a row per key space is left."""
    spark = tables["bronze"].sparkSession
    # An empty model still has its row of counters.
    long = spark.range(1).select(F.explode(F.array(*[F.lit(f"rows:{m}") for m in RULES])).alias("space"),
                                 F.lit(None).cast("string").alias("key"),
                                 *[F.lit(0).cast("long").alias(c) for c in ("held", "wanted", *_NULLS)])
    for model in RULES:
        long = long.unionByName(check_keys(model, tables[model]))
    per_key = long.groupBy("space", "key").agg(*[F.sum(c).alias(c) for c in ("held", "wanted", *_NULLS)])
    return per_key.groupBy("space").agg(
        F.sum("held").alias("rows"), F.count_if(F.col("key").isNotNull() & (F.col("held") > 1)).alias("repeated"),
        F.coalesce(F.sum(F.when(F.col("held") == 0, F.col("wanted"))), F.lit(0)).alias("orphans"),
        *[F.sum(n).alias(n) for n in _NULLS])


def run_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Q9: every generic and singular test as one result table.

    ``tables`` holds ``bronze, stg, quarantine, dim_repo, dim_actor, fact,
    momentum``. ``failures`` is the number of failing rows (for ``unique`` and
    the grain, repeated keys); ``status`` is ``pass`` when it is zero. Each
    model is scanned once, and all unique, grain and foreign keys share one
    shuffle.
    """
    spark = tables["bronze"].sparkSession
    spec = []  # space, measure, then the check's name, model and column
    for model, (not_null, unique, grain) in RULES.items():
        spec += [(f"rows:{model}", n, "not_null", MODELS[model], c) for n, c in zip(_NULLS, not_null)]
        spec += [(f"unique:{model}.{c}", "repeated", "unique", MODELS[model], c) for c in unique]
        if grain:
            spec.append((f"grain:{model}", "repeated", "assert_momentum_grain_unique", MODELS[model], None))
    spec += [(f"unique:{parent}.{c}", "orphans", "relationships", MODELS[child], c) for child, c, parent in REFERENCES]
    spec.append(("rows:bronze", "unreconciled", "assert_bronze_reconciliation", MODELS["bronze"], None))
    checks = spark.createDataFrame(spec, "space string, measure string, check_name string, model string, column_name string")
    whole = Window.partitionBy()  # over one row per key space

    def rows_of(model: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("space") == f"rows:{model}", F.col("rows"))).over(whole), F.lit(0))

    spaces = check_spaces(tables).withColumn("unreconciled", (
        rows_of("bronze") != rows_of("stg") + rows_of("quarantine")).cast("long"))
    measures = spaces.select("space", F.create_map(*[x for m in ("repeated", "orphans", "unreconciled", *_NULLS)
                                                     for x in (F.lit(m), F.col(m))]).alias("measures"))
    return checks.join(measures, "space", "left").select(
        "check_name", "model", "column_name",
        F.coalesce(F.element_at("measures", F.col("measure")), F.lit(0)).cast("bigint").alias("failures")) \
        .withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))


def write_metrics(model: str) -> list[Column]:
    """Aggregates to observe while ``model`` is written: its rows, and the nulls
    of each column that must have none."""
    return [F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"nulls.{c}") for c in RULES[model][0]]]


def observed_checks(spark: SparkSession, metrics: dict[str, dict[str, int]]) -> DataFrame:
    """``not_null`` and reconciliation from what was observed while the models
    were written (``write_metrics``), without reading them again."""
    rows = [("not_null", MODELS[model], c, metrics[model][f"nulls.{c}"])
            for model in RULES if model in metrics for c in RULES[model][0]]
    if {"bronze", "stg", "quarantine"} <= set(metrics):
        n = {m: metrics[m]["rows"] for m in ("bronze", "stg", "quarantine")}
        rows.append(("assert_bronze_reconciliation", MODELS["bronze"], None,
                     int(n["bronze"] != n["stg"] + n["quarantine"])))
    results = spark.createDataFrame(rows, "check_name string, model string, column_name string, failures long")
    return results.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))


def monitor_checks(tables: dict[str, DataFrame], as_of) -> DataFrame:
    """Freshness of the source and daily volume of the staged events, in the
    form of ``run_checks``; a freshness warning is a status of its own."""
    fresh = check_freshness(tables["bronze"], as_of).select(
        *_check_row("source_freshness", "raw.gh_events", "_loaded_at", F.col("status") == "error"),
        F.when(F.col("status") == "error", F.lit("fail")).otherwise(F.col("status")).alias("status"))
    volume = volume_anomalies(tables["stg"]).agg(F.count_if("is_anomaly").alias("x")).select(
        *_check_row("volume_anomaly", "stg_events", "event_date", F.col("x")),
        F.when(F.col("x") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"))
    return fresh.unionByName(volume)


MODELS = {"bronze": "raw.gh_events", "stg": "stg_events", "quarantine": "quarantine_events",
          "dim_repo": "dim_repo", "dim_actor": "dim_actor", "fact": "fact_events",
          "momentum": "agg_daily_repo_momentum"}


def schema_checks(tables: dict[str, DataFrame], snapshot: DataFrame | None) -> DataFrame:
    """Schema changes of each model against a snapshot ``model, column_name,
    data_type``; a model without one passes."""
    spark = tables["bronze"].sparkSession
    known: dict[str, T.StructType] = {}
    for r in snapshot.collect() if snapshot is not None else []:  # one row per column
        known.setdefault(r["model"], []).append((r["column_name"], r["data_type"]))
    rows = []
    for name, model in MODELS.items():
        now, then = set(schema_rows(tables[name].schema)), set(known.get(model, []))
        changed = {c for c, _ in now ^ then} if then else set()
        rows.append(("schema_changes", model, None, len(changed), "fail" if changed else "pass"))
    return spark.createDataFrame(
        rows, "check_name string, model string, column_name string, failures long, status string")


def log_checks(path: str, tables: dict[str, DataFrame], run_id: str, as_of) -> DataFrame:
    """Q6-Q9: run every check, append the results under ``path`` with the run's
    id and time, store the schemas for the next run, and return this run's rows."""
    from tidemark.sources.tables import path_exists

    spark = tables["bronze"].sparkSession
    when = F.lit(as_of).cast("timestamp_ntz")
    results, schemas = f"{path}/results", f"{path}/schemas"
    snapshot = None
    if path_exists(spark, schemas):
        stored = spark.read.parquet(schemas)
        newest = F.struct("checked_at", "run_id")
        snapshot = stored.where(newest == stored.agg(F.max(newest)).scalar())
    rows = run_checks(tables).unionByName(monitor_checks(tables, as_of)) \
        .unionByName(schema_checks(tables, snapshot)) \
        .select(F.lit(run_id).alias("run_id"), when.alias("checked_at"), "*")
    rows.coalesce(1).write.mode("append").parquet(results)
    columns = [(m, c, t) for n, m in MODELS.items() for c, t in schema_rows(tables[n].schema)]
    spark.createDataFrame(columns, "model string, column_name string, data_type string") \
        .select(F.lit(run_id).alias("run_id"), when.alias("checked_at"), "*") \
        .coalesce(1).write.mode("append").parquet(schemas)
    return spark.read.parquet(results).where(F.col("run_id") == run_id)
