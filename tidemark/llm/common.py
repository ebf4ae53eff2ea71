"""Helpers shared by the operators: tables, scratch storage, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure, scratch_path

#: Text bytes that one step inside a task holds as words at a time.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows that Spark hands to a task's Python at a time: with texts of some
#: kilobytes, a few megabytes.
BATCH_ROWS = 2000


#: Size up to which a side of a join is broadcast at run time. Small, so that
#: plans at small and large scale are alike and executors hold little.
BROADCAST_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(BROADCAST_BYTES))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage: later stages, and retries after a lost executor,
    read the files and recompute nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Setting that deletes shuffle files when the statement ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def alone(spark: SparkSession, action):
    """Run an action whose result is stored or collected: its shuffle files are
    deleted once it has ended, as nothing reads them again."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        return action()
    finally:
        spark.conf.set(CLEANUP, before)


def doc_key(text: Column) -> Column:
    """64-bit digest of a text; with ``doc_id`` it identifies a document row
    up to repeated rows, which get equal results (null text: digest of '')."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def text_slices(batch: pa.RecordBatch, column: str = "text",
                budget: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a record batch into slices of about ``budget`` text bytes (one row
    at least), so that memory is bounded by that and by the longest text. What
    the work on a slice leaves in Arrow's pool goes back before the next: Spark
    keeps a worker for later tasks, and the pool would stay with it."""
    sizes = np.asarray(
        pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    group = (np.cumsum(sizes) - sizes) // budget
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(sizes) else []
    for i, start in enumerate(starts):
        end = starts[i + 1] if i + 1 < len(starts) else len(sizes)
        yield batch.slice(start, end - start)
        pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words of each text: runs without ASCII white space (null: none).

    Returns the code of every word of all texts, the distinct words by code
    (an unused empty one may be among them), and the number of words per text.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:  # stands where a text begins or ends with white space
        kept = codes != empty
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[kept], minlength=len(sizes))
        codes = codes[kept]
    return codes, coded.dictionary, sizes


def hashes(words: pa.Array, seed: int) -> np.ndarray:
    """XXH64 of each word."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit integer over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: Buckets of the broadcast prefilter below; this bounds what is broadcast.
FILTER_BUCKETS = 1 << 18


def split_by_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` that may have a key in ``keys``, and rows that have none.

    Only the numbers of occupied hash buckets are broadcast, at most
    ``FILTER_BUCKETS`` of them, so this never loses a key and costs the same at
    any size; it saves shuffling rows without a partner where keys are few.
    """
    def bucket() -> Column:
        return F.pmod(F.xxhash64(*on), F.lit(FILTER_BUCKETS))

    used = F.broadcast(keys.select(bucket().alias("_bucket")).distinct())
    tagged = df.withColumn("_bucket", bucket())
    return (tagged.join(used, "_bucket", "left_semi").drop("_bucket"),
            tagged.join(used, "_bucket", "left_anti").drop("_bucket"))


#: Parts that the rows of one key are dealt into by ``salted_join``.
SALTS = 8


def salted_join(rows: DataFrame, few: DataFrame, on: list[str], by: list[str], how: str = "inner") -> DataFrame:
    """Join ``rows``, of which one key may hold very many, with ``few``, which
    has a row per key: each key's rows go to ``SALTS`` tasks, dealt by the
    columns ``by``."""
    salt = F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")
    spread = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", salt).join(spread, [*on, "_salt"], how).drop("_salt")


class RangeHash:
    """Hashes of any range of a sequence of 64-bit values, from prefix sums of
    a polynomial; equal ranges have equal hashes wherever they stand."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, values: np.ndarray):
        n = len(values)
        power = np.full(n + 1, self.BASE, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * power[:n], out=self.sums[1:])
        inverse = np.full(n + 1, pow(self.BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self.inverse = np.multiply.accumulate(inverse)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(value + (end - start).astype(np.uint64))


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All integers of the ranges ``start .. start + count - 1``, in order."""
    count = np.asarray(count, np.int64)
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(np.asarray(start, np.int64) - (ends - count), count)
