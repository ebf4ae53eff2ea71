"""Schema drift of the feed, found in its records (Q8).

Every reader forces a declared schema on the raw lines, so a field that the
feed adds, drops or retypes shows nowhere in a table. Here the lines are parsed
as VARIANT, which keeps each record's own shape, and ``schema_of_variant_agg``
merges the shapes of a load. Only these merged shapes, one short text per load
in a log, are looked at further: distinct ones are taken apart into fields, and every
load's fields are compared with those of the load before.

Types are those of VARIANT: ``BIGINT``, ``STRING``, ``ARRAY<...>``; records of
one load that disagree give ``VARIANT``, a field that is null throughout
``VOID``. A null field says nothing about its type, so ``VOID`` is no change.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELD_SCHEMA = "schema string, field string, type string"


def raw_records(spark: SparkSession, paths: str | list[str], load: Column) -> DataFrame:
    """``load, record``: the raw JSON lines under ``paths`` as VARIANT. ``load``
    may use the scan's ``_metadata``; a line that is no JSON has a null record."""
    lines = spark.read.text(paths).select("value", load.alias("load")).where("trim(value) <> ''")
    return lines.select("load", F.try_parse_json("value").alias("record"))


def load_shapes(records: DataFrame) -> DataFrame:
    """``load, records, malformed, schema``: the merged shape of every load's
    records. Shapes merge map-side, so one load may hold most records."""
    return records.groupBy("load").agg(
        F.count("record").alias("records"),
        F.count_if(F.col("record").isNull()).alias("malformed"),
        F.schema_of_variant_agg("record").alias("schema"))


def log_shapes(path: str, records: DataFrame) -> None:
    """Append the shapes of newly landed loads to the shape log, which all
    comparisons read: lines of earlier loads are never read again."""
    load_shapes(records).write.mode("append").parquet(path)


def _flatten(kind: T.DataType, path: str = "") -> list[tuple[str, str]]:
    if not isinstance(kind, T.StructType):
        return [(path, "VOID" if isinstance(kind, T.NullType) else kind.simpleString().upper())]
    # An object that is empty throughout is a field, too.
    own = [(path, "OBJECT")] if path else []
    return own + [f for field in kind.fields
                  for f in _flatten(field.dataType, f"{path}.{field.name}" if path else field.name)]


def fields_of(schema: str) -> list[tuple[str, str]]:
    """Dotted path and type of every field of a VARIANT schema text; objects
    are listed with their members, arrays with their element type."""
    return [f for f in _flatten(T.StructType.fromDDL(f"record {re.sub(r'OBJECT(?=<)', 'STRUCT', schema)}")["record"].dataType)
            if f[0]]


def load_fields(shapes: DataFrame) -> DataFrame:
    """``load, field, type`` of every field of every load.

    The driver takes apart distinct schema texts only; loads of one shape, as
    nearly all are, share one.
    """
    spark = shapes.sparkSession
    texts = [r["schema"] for r in shapes.select("schema").where("schema is not null").distinct().collect()]
    fields = spark.createDataFrame([(t, f, k) for t in texts for f, k in fields_of(t)], FIELD_SCHEMA)
    return shapes.join(fields, "schema").select("load", "field", "type")


def schema_drift(shapes: DataFrame) -> DataFrame:
    """``load, field, change, previous_type, current_type``: what each load
    changed against the load before it (loads in the order of their values).

    ``field_added`` and ``field_dropped`` go by presence; ``type_changed``
    compares with the last type that the field had, whatever loads in between
    were null. The first load has nothing to differ from. An empty load (no
    record that parses) is passed over.
    """
    filled = shapes.where("records > 0").select("load", "schema")
    # Both windows run over one row per load and field, not over records.
    by_load = filled.withColumn("next_load", F.lead("load").over(Window.orderBy("load"))).select("load", "next_load")
    fields = load_fields(filled)
    typed = F.when(F.col("type") != "VOID", F.col("type"))
    known = Window.partitionBy("field").orderBy("load")
    fields = fields.select("load", "field", typed.alias("type"), F.last(typed, ignorenulls=True).over(
        known.rowsBetween(Window.unboundedPreceding, -1)).alias("before"), F.last(typed, ignorenulls=True).over(
        known.rowsBetween(Window.unboundedPreceding, 0)).alias("held"))
    previous = fields.join(by_load.where("next_load is not null"), "load").select(
        F.col("next_load").alias("load"), "field", F.col("held").alias("held_before"))
    first = filled.agg(F.min("load")).scalar()
    both = fields.withColumn("here", F.lit(True)).join(previous.withColumn("there", F.lit(True)), ["load", "field"], "full_outer")
    change = (F.when(F.col("there").isNull(), F.lit("field_added"))
              .when(F.col("here").isNull(), F.lit("field_dropped"))
              .when(F.col("type") != F.col("before"), F.lit("type_changed")))
    return both.where(F.col("load") > first).select(
        "load", "field", change.alias("change"),
        F.when(F.col("there").isNotNull(), F.coalesce("held_before", F.lit("VOID"))).alias("previous_type"),
        F.when(F.col("here").isNotNull(), F.coalesce("type", F.lit("VOID"))).alias("current_type"),
    ).where("change is not null")


def contract_violations(shapes: DataFrame, contract: T.StructType) -> DataFrame:
    """``load, field, change, declared_type, current_type``: fields that a
    reader of ``contract`` cannot take as declared, by load: missing ones, and
    those of another kind (``BIGINT`` fits any integer, ``STRING`` text)."""
    present = shapes.where("records > 0").select("load", "schema")
    seen = load_fields(present)
    declared = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(k).alias("declared_type")) for f, k in _flatten(contract) if f])
    wanted = present.select("load", F.inline(declared))
    change = (F.when(F.col("type").isNull(), F.lit("field_missing"))
              .when((F.col("type") != "VOID") & (F.col("type") != F.col("declared_type")), F.lit("type_mismatch")))
    return wanted.join(seen, ["load", "field"], "left").select(
        "load", "field", change.alias("change"), "declared_type", F.col("type").alias("current_type")) \
        .where("change is not null")
