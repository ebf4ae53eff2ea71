"""Schema drift found in the feed's own records."""

import json
import os

from pyspark.sql import functions as F

from tidemark.operators import drift
from tidemark.schemas import RAW_EVENT
from tidemark.session import scratch_path


def shapes(spark, name, loads):
    """Logged shapes of lines per load (dicts, or raw text)."""
    root = scratch_path(spark, name).replace("file:", "")
    for load, lines in loads.items():
        os.makedirs(f"{root}/{load}")
        with open(f"{root}/{load}/2024-01-15-5.json", "w") as f:
            f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    log = scratch_path(spark, f"{name}-log")
    for load in loads:  # one load at a time, as they land
        records = drift.raw_records(spark, f"{root}/{load}", F.element_at(F.split("_metadata.file_path", "/"), -2))
        drift.log_shapes(log, records)
    return spark.read.parquet(log)


def changes(found):
    return sorted((r.load, r.field, r.change, r.previous_type, r.current_type) for r in found.collect())


def test_added_dropped_and_retyped_fields(spark):
    logged = shapes(spark, "drift", {
        "1": [{"id": "a", "n": 1, "o": {"x": 1, "y": True}, "l": [1]}, {"id": None, "n": 2, "o": {}}],
        "2": [{"id": "b", "n": 2.5, "o": {"x": "1"}, "new": {"deep": {"er": "z"}}, "l": ["a"]}],
        "3": [{"id": "c", "n": 2.5, "o": {"x": "1"}, "l": ["a"]}]})
    got = changes(drift.schema_drift(logged))
    assert [g[:3] for g in got] == [
        ("2", "l", "type_changed"), ("2", "n", "type_changed"), ("2", "new", "field_added"), ("2", "new.deep", "field_added"),
        ("2", "new.deep.er", "field_added"), ("2", "o.x", "type_changed"), ("2", "o.y", "field_dropped"),
        ("3", "new", "field_dropped"), ("3", "new.deep", "field_dropped"), ("3", "new.deep.er", "field_dropped")]
    assert ("2", "o.x", "type_changed", "BIGINT", "STRING") in got
    assert ("3", "new.deep.er", "field_dropped", "STRING", None) in got


def test_nulls_say_nothing_about_a_type(spark):
    logged = shapes(spark, "drift-null", {
        "1": [{"a": 1, "b": "x"}], "2": [{"a": None, "b": "x"}], "3": [{"a": 2, "b": "x"}], "4": [{"a": "t", "b": "x"}]})
    assert changes(drift.schema_drift(logged)) == [("4", "a", "type_changed", "BIGINT", "STRING")]


def test_a_field_that_comes_back_and_records_that_disagree(spark):
    logged = shapes(spark, "drift-back", {
        "1": [{"a": 1, "b": "x"}], "2": [{"b": "x"}], "3": [{"a": 1, "b": "x"}, {"a": 2, "b": 3}]})
    assert changes(drift.schema_drift(logged)) == [
        ("2", "a", "field_dropped", "BIGINT", None), ("3", "a", "field_added", None, "BIGINT"),
        ("3", "b", "type_changed", "STRING", "VARIANT")]


def test_malformed_lines_and_empty_loads(spark):
    logged = shapes(spark, "drift-odd", {"1": [{"a": 1}], "2": ["{broken", " "], "3": [{"a": 1}, "[", {"a b": 1, "c.d": "x"}]})
    assert {r.load: (r.records, r.malformed) for r in logged.collect()} == {"1": (1, 0), "2": (0, 1), "3": (2, 1)}
    assert [c[:3] for c in changes(drift.schema_drift(logged))] == [("3", "a b", "field_added"), ("3", "c.d", "field_added")]


def test_one_load_has_nothing_to_differ_from(spark):
    assert changes(drift.schema_drift(shapes(spark, "drift-one", {"1": [{"a": 1}]}))) == []


def test_contract(spark):
    event = {"id": "1", "type": "PushEvent", "actor": {"id": 1, "login": "a"}, "repo": {"id": 2, "name": "o/r"},
             "payload": {"action": "x"}, "created_at": "2024-01-15T05:00:00Z", "public": True}
    logged = shapes(spark, "drift-contract", {
        "1": [event], "2": [{**event, "actor": {"id": "1", "login": None}, "payload": {}}]})
    got = sorted((r.load, r.field, r.change, r.declared_type, r.current_type)
                 for r in drift.contract_violations(logged, RAW_EVENT).collect())
    assert got == [("2", "actor.id", "type_mismatch", "BIGINT", "STRING"),
                   ("2", "payload.action", "field_missing", "STRING", None)]
