import hashlib

from pyspark.sql import functions as F

from tidemark.functions import (event_bucket, file_hour, hour_boundaries, is_bot, sla_class,
                                surrogate_key)
from conftest import ts


def test_bucket_edges(spark):
    values = [0, 1, 2, 3, 4, 10, 11, 50, 51, 200, 201, None]
    df = spark.createDataFrame([(v,) for v in values], "n bigint")
    label, ordinal = event_bucket("n")
    got = {r["n"]: (r["b"], r["o"]) for r in df.select("n", label.alias("b"), ordinal.alias("o")).collect()}
    assert got[1] == ("1", 1)
    assert got[2] == ("2-3", 2) and got[3] == ("2-3", 2)
    assert got[4] == ("4-10", 3) and got[10] == ("4-10", 3)
    assert got[11] == ("11-50", 4) and got[50] == ("11-50", 4)
    assert got[51] == ("51-200", 5) and got[200] == ("51-200", 5)
    # the else branch takes everything else, including 0 and null
    assert got[201] == ("200+", 6) and got[0] == ("200+", 6) and got[None] == ("200+", 6)


def test_hour_boundaries_counts_crossings(spark):
    df = spark.createDataFrame(
        [(ts("2024-01-01 00:59:00"), ts("2024-01-01 01:01:00")),
         (ts("2024-01-01 01:00:00"), ts("2024-01-01 01:59:59")),
         (ts("2024-01-01 00:00:00"), ts("2024-01-02 00:00:00"))],
        "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(hour_boundaries(F.col("a"), F.col("b"))).collect()]
    assert got == [1, 0, 24]


def test_sla_classes(spark):
    df = spark.createDataFrame([(23,), (24,), (47,), (48,), (None,)], "h bigint")
    got = [r[0] for r in df.select(sla_class(F.col("h"))).collect()]
    assert got == ["Fresh", "Stale (warn)", "Stale (warn)", "Breached", "Unknown"]


def test_is_bot_truth_table(spark):
    df = spark.createDataFrame([("dependabot[bot]",), ("X[BOT]",), ("bot",), ("[bo]t",), (None,)], "l string")
    got = [r[0] for r in df.select(is_bot("l")).collect()]
    assert got == [True, True, False, False, None]


def test_surrogate_key_is_md5_of_text(spark):
    df = spark.createDataFrame([(12,)], "id bigint")
    assert df.select(surrogate_key("id")).first()[0] == hashlib.md5(b"12").hexdigest()


def test_file_hour_is_numeric(spark):
    df = spark.createDataFrame([("2024-01-15-5.json.gz",), ("2024-01-15-10.json.gz",), ("x",)], "f string")
    assert [r[0] for r in df.select(file_hour("f")).collect()] == [5, 10, None]
