import gzip
import json
import os

import pytest

from tidemark import catalog
from tidemark.session import scratch_path
from tidemark.sources import events_csv, events_json, hours
from tidemark.sources.tables import TableStore
from tidemark.streaming.ingest import stream_ingest
from conftest import SF_SMALL, bronze_rows, event, ts


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def _write_gz(folder, name, lines):
    os.makedirs(_local(folder), exist_ok=True)
    with gzip.open(os.path.join(_local(folder), name), "wt") as fh:
        for line in lines:
            fh.write(line if isinstance(line, str) else json.dumps(line))
            fh.write("\n")


def test_reader_flattens_and_tolerates_missing_parts(spark):
    d = scratch_path(spark, "t-json")
    _write_gz(d, "2024-01-15-5.json.gz", [
        {"id": "1", "type": "PushEvent", "actor": {"id": 7, "login": "a", "extra": 1},
         "repo": {"id": 9, "name": "o/r"}, "payload": {"action": "opened", "big": "x" * 1000},
         "created_at": "2024-01-15T05:00:00Z", "unknown": [1, 2]},
        {"id": "2", "type": "WatchEvent", "actor": None, "created_at": "2024-01-15T10:30:00+05:30"},
    ])
    _write_gz(d, "2024-01-15-6.json.gz", [])
    df = events_json.read_event_files(spark, d, loaded_at=ts("2024-01-15 07:00:00"))
    got = {r["event_id"]: r for r in df.collect()}
    assert got["1"]["actor_login"] == "a" and got["1"]["payload_action"] == "opened"
    assert got["1"]["_source_file"] == "2024-01-15-5.json.gz"
    assert got["2"]["actor_id"] is None and got["2"]["repo_name"] is None
    assert got["2"]["created_at"] == ts("2024-01-15 05:00:00")
    assert {r["_loaded_at"] for r in got.values()} == {ts("2024-01-15 07:00:00")}


def test_malformed_line_fails_the_load(spark):
    d = scratch_path(spark, "t-json-bad")
    _write_gz(d, "2024-01-15-5.json.gz", [{"id": "1"}, '{"id": "2"'])
    with pytest.raises(Exception):
        events_json.read_event_files(spark, d).count()
    assert events_json.read_event_files(spark, d, mode="PERMISSIVE").count() == 2


def test_row_cap_keeps_first_lines_per_file(spark):
    d = scratch_path(spark, "t-json-cap")
    for h in (5, 10):
        _write_gz(d, f"2024-01-15-{h}.json.gz",
                  [{"id": f"{h}-{i}", "type": "PushEvent"} for i in range(50)])
    df = events_json.read_event_files(spark, d, max_events=3)
    got = sorted(r["event_id"] for r in df.collect())
    assert got == sorted([f"{h}-{i}" for h in (5, 10) for i in range(3)])
    assert events_json.read_event_files(spark, d, max_events=0).count() == 100


def test_csv_sample_with_offsets(spark):
    d = scratch_path(spark, "t-csv")
    os.makedirs(_local(d), exist_ok=True)
    with open(os.path.join(_local(d), "s.csv"), "w") as fh:
        fh.write("event_id,event_type,actor_id,actor_login,repo_id,repo_name,created_at,"
                 "payload_action,_source_file\n")
        fh.write("1,PushEvent,7,a,9,o/r,2024-01-15 20:30:00+05:30,,2024-01-15-15.json.gz\n")
    row = events_csv.read_event_csv(spark, d).first()
    assert row["created_at"] == ts("2024-01-15 15:00:00")
    assert row["payload_action"] is None and row["actor_id"] == 7


def test_hour_keys_and_gaps(spark):
    hrs = hours.hour_partitions(spark, ts("2024-01-15 04:30:00"), ts("2024-01-15 11:00:00"))
    got = {r["partition_key"]: r["file_name"] for r in hrs.collect()}
    assert len(got) == 8 and got["2024-01-15-05:00"] == "2024-01-15-5.json.gz"
    assert got["2024-01-15-10:00"] == "2024-01-15-10.json.gz"
    b = bronze_rows(spark, [event("1", source="2024-01-15-5.json.gz")])
    missing = hours.missing_partitions(hrs, b)
    assert missing.count() == 7


def test_stream_equals_batch_and_restart_adds_nothing(spark):
    landing_rows = catalog.landing(spark, SF_SMALL)
    root = scratch_path(spark, "t-landing")
    events_json.write_hour_files(landing_rows, root)
    store = TableStore(spark, scratch_path(spark, "t-stream-store"))
    ckpt = scratch_path(spark, "t-stream-ckpt")
    n1 = stream_ingest(spark, f"{root}/*/*.json.gz", store, ckpt, max_files_per_trigger=100)
    n2 = stream_ingest(spark, f"{root}/*/*.json.gz", store, ckpt, max_files_per_trigger=100)
    assert n1 > 1 and n2 == 0
    cols = catalog.bronze(spark, SF_SMALL).columns
    got = sorted(map(tuple, store.read("bronze").select(*cols).collect()), key=str)
    want = sorted(map(tuple, catalog.bronze(spark, SF_SMALL).collect()), key=str)
    assert got == want
    batch = events_json.read_event_files(spark, f"{root}/*/*.json.gz", loaded_at="file_time")
    assert batch.count() == landing_rows.count()


def test_stream_file_order_does_not_decide_the_winner(spark):
    # Hazard C: same event in two hour files, one file per micro-batch, equal
    # load times; the later hour (10, which sorts before 5 as text) must win.
    root = scratch_path(spark, "t-hazard-c")
    folder = _local(root) + "/d1"
    for h in (10, 5):
        _write_gz(folder, f"2024-01-15-{h}.json.gz",
                  [{"id": "42", "type": "PushEvent", "actor": {"id": 1, "login": "a"},
                    "repo": {"id": 2, "name": "o/r"}, "payload": {"action": f"h{h}"},
                    "created_at": "2024-01-15T05:00:00Z"}])
        os.utime(os.path.join(folder, f"2024-01-15-{h}.json.gz"), (1705300000, 1705300000))
    store = TableStore(spark, scratch_path(spark, "t-hazard-c-store"))
    n = stream_ingest(spark, f"{root}/*/*.json.gz", store, scratch_path(spark, "t-hazard-c-ckpt"),
                      max_files_per_trigger=1)
    rows = store.read("bronze").collect()
    assert n == 2 and len(rows) == 1 and rows[0]["payload_action"] == "h10"
