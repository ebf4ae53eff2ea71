"""Benchmark passages in training documents, found by winnowing.

A text's fingerprints are the smallest k-gram hash of every window of w
consecutive k-grams. Any shared span of ``w + k - 1`` words therefore shares a
fingerprint. Here such a span is exactly one item window of ``SPAN`` words
(k = 5, w = 6), so the guarantee holds for every one of them. Items with fewer
words are one window each, with k equal to their length.

Documents keep a window only if its fingerprint is in a bitmap of the
benchmark's fingerprints. The bitmap has a fixed size: with a large benchmark
it lets more through, and the result stays the same. What is left is joined
with the benchmark on the fingerprint, and a hit counts only if it extends to
the whole window, word for word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import (doc_key, hashes, mix, ranges, signed, split_by_keys, split_words, stored,
                                 text_bytes, text_slices)

#: Words of an item window, and of the k-grams of its fingerprint.
SPAN = 10
GRAM = 5
#: Bits of the bitmap of benchmark fingerprints (one megabyte).
BITMAP_BITS = 1 << 23
#: Stands for a null doc_id in joins.
NO_ID = -(1 << 63)

# A-Z is lower-cased, 0-9, a-z and every byte of a non-ASCII
# character belong to words, the other ASCII characters separate them.
_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))

_HIT = pa.struct([("start", pa.int32()), ("n", pa.int32()), ("h", pa.int64()), ("win", pa.string())])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k-gram at each position that has one."""
    n = max(0, len(words) - k + 1)
    value = np.zeros(n, np.uint64)
    for j in range(k):
        value = value * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n]
    return mix(value + np.uint64(k))


def fingerprints(words: np.ndarray, span: int, n: int) -> np.ndarray:
    """Fingerprint of the window of ``n`` words at each position that has one:
    its smallest k-gram hash."""
    k = GRAM if n == span else n
    grams = gram_hashes(words, min(k, n))
    count = max(0, len(words) - n + 1)
    least = grams[:count].copy()
    for j in range(1, len(grams) - count + 1):
        np.minimum(least, grams[j:j + count], out=least)
    return least


def _hits(texts: list[bytes], span: int, lengths: list[int], keep):
    """Words per text, and the windows that ``keep(fingerprints)`` selects, as
    (text, start, n, fingerprint, words)."""
    codes, distinct, sizes = split_words(pa.array([t.translate(_TO_WORDS) for t in texts], pa.binary())
                                         .cast(pa.string()))
    begin = np.cumsum(sizes) - sizes
    seq = hashes(distinct, 3)[codes]
    out = []
    for n in lengths:
        starts = ranges(begin, np.maximum(sizes - n + 1, 0))
        if not len(starts):
            continue
        prints = fingerprints(seq, span, n)[starts]
        at = np.flatnonzero(keep(prints))
        owner = np.searchsorted(begin, starts[at], "right") - 1
        # Empty texts share a begin with the text after them.
        wanted = starts[at][:, None] + np.arange(n)
        spelled = distinct.take(pa.array(codes[wanted].reshape(-1))).to_pylist()
        out += [(int(d), int(s - begin[d]), n, int(p), " ".join(spelled[i * n:i * n + n]))
                for i, (d, s, p) in enumerate(zip(owner, starts[at].tolist(), signed(prints[at])))]
    return sizes, out


def item_windows(items: DataFrame, span: int = SPAN) -> DataFrame:
    """``n, h, win, item_id``: every distinct window of every item with its
    fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                rows = set()
                ids = part.column("item_id").to_pylist()
                for item, text in zip(ids, text_bytes(part.column("text"))):
                    n = min(span, len(words_of(text)))
                    if n:
                        _, found = _hits([text], span, [n], lambda p: np.ones(len(p), bool))
                        rows.update((n, h, win, item) for _, _, _, h, win in found)
                cols = list(zip(*rows)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())],
                    ["n", "h", "win", "item_id"])

    return items.selectExpr("cast(item_id as string) item_id", "text").mapInArrow(
        run, "n int, h long, win string, item_id string")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """Bitmap of the fingerprints; Spark sets the bits, the driver receives at
    most ``BITMAP_BITS / 64`` numbers."""
    bit = F.pmod("h", F.lit(BITMAP_BITS))
    rows = windows.select(F.shiftright(bit, 6).alias("word"),
                          F.expr(f"shiftleft(1L, cast(pmod(h, {BITMAP_BITS}) & 63 as int))").alias("bits")) \
        .groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()
    out = np.zeros(BITMAP_BITS // 64, np.int64)
    for r in rows:
        out[r.word] = r.bits
    return out.view(np.uint64)


def _scan(docs: DataFrame, span: int, lengths: list[int], bitmap) -> DataFrame:
    """``id, tk, n_words, hits`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value

        def known(prints: np.ndarray) -> np.ndarray:
            at = prints & np.uint64(BITMAP_BITS - 1)
            return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

        for batch in batches:
            for part in text_slices(batch):
                sizes, found = _hits(text_bytes(part.column("text")), span, lengths, known)
                found.sort(key=lambda f: f[0])
                offsets = np.searchsorted([f[0] for f in found], np.arange(len(sizes) + 1))
                hit = pa.StructArray.from_arrays(
                    [pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.int32()),
                     pa.array([f[3] for f in found], pa.int64()),
                     pa.array([f[4] for f in found], pa.string())], fields=list(_HIT))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("id"), part.column("tk"), pa.array(sizes),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), hit)],
                    ["doc_id", "id", "tk", "n_words", "hits"])

    return docs.select("doc_id", "id", "tk", "text").mapInArrow(
        run, "doc_id long, id long, tk long, n_words long, "
             "hits array<struct<start:int,n:int,h:long,win:string>>")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                             "tk": doc_key(F.col("text"))})


def benchmark_hits(docs: DataFrame, items: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (``doc_id, id, tk, n_words``), the windows in them that occur
    in an item (``id, tk, start, n``), and their items (``id, tk, item_id``)."""
    spark = docs.sparkSession
    windows = stored(item_windows(items.select("item_id", "text"), span), "item-windows")
    lengths = sorted(r.n for r in windows.select("n").distinct().collect())  # at most span numbers
    bitmap = spark.sparkContext.broadcast(_bitmap(windows))
    scanned = stored(_scan(_keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")),
                           span, lengths, bitmap), "winnowed")
    kept = scanned.where("size(hits) > 0").select("id", "tk", F.explode("hits").alias("x")) \
        .select("id", "tk", "x.*")
    distinct = windows.select("n", "h", "win").distinct()
    hits = stored(kept.join(distinct, ["h", "n", "win"], "left_semi"), "benchmark-hits")
    items_hit = (hits.select("id", "tk", "h", "n", "win").distinct()
                 .join(windows, ["h", "n", "win"]).select("id", "tk", "item_id").distinct())
    return scanned.drop("hits"), hits.select("id", "tk", "start", "n").distinct(), items_hit


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids`` of every document: words inside any
    occurrence of an item window, and the items (as strings, sorted).

    Null and empty texts have no words and no hits; repeated rows get equal
    results; a null doc_id is a document like any other; an empty benchmark
    hits nothing; an item without words has no window, and one without an id
    marks words but is not listed. Other columns are not read.
    """
    rows, hits, items_hit = benchmark_hits(docs, items, span)
    seen = Window.partitionBy("id", "tk").orderBy("start", "n")
    covered = F.max(F.col("start") + F.col("n")).over(seen.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("start") + F.col("n") - F.greatest("start", F.coalesce(covered, F.lit(0)))
    n_hit = hits.withColumn("fresh", F.greatest(fresh, F.lit(0))) \
        .groupBy("id", "tk").agg(F.sum("fresh").cast("long").alias("n_hit"))
    listed = items_hit.groupBy("id", "tk").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    return (rows.join(n_hit, ["id", "tk"], "left").join(listed, ["id", "tk"], "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids")))


def drop_contaminated(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """Rows of ``docs``, all columns, whose text has no item window."""
    _, hits, _ = benchmark_hits(docs, items, span)
    bad = stored(hits.select("id", "tk").distinct(), "contaminated")
    keyed = docs.select(F.struct(*docs.columns).alias("doc"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                        doc_key(F.col("text")).alias("tk"))
    hit, miss = split_by_keys(keyed, bad, ["id", "tk"])
    return hit.join(bad, ["id", "tk"], "left_anti").select("doc.*").union(miss.select("doc.*"))
