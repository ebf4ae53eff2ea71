"""Near-duplicate documents by SimHash, linked through Golay-code keys.

A 64-bit fingerprint is cut into three segments of at most 23 bits. The binary
Golay code (23, 12) is perfect: every 23-bit word lies within three bits of
exactly one codeword, so if x and y differ in at most one bit, the codeword of
x lies within four bits of y, and y finds it among one to six codewords.

Three differing bits fall on the segments in one of two ways (pigeonhole).
Either each has one: the codewords of all three segments make a key of 36 bits.
Or one segment has two or more, so of the other two one is equal and one has at
most one: the equal segment itself and the other's codeword make a key of 33 or
34 bits, for each ordered pair of segments. A fingerprint offers the seven keys
of its own codewords and looks up those of the codewords near it. An equi-join
on the keys finds every link; the bit distance verifies it. Keys are wide, so
unrelated fingerprints meet rarely.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import doc_key, salted_join, split_by_keys, stored, text_bytes, text_slices
from tidemark.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
#: Stands for a null doc_id, which sorts after every other.
NO_ID = (1 << 63) - 1
#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the (23, 12) Golay code.
GOLAY = 0b101011100011


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of a text: a bit is 1 if set in over half of the shingles'
    hashes; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(g, HASH_SEED) for g in grams], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):  # bounded memory for very long texts
        part = h[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, tk, fp``: digest of the text and fingerprint (its 64 bits as a
    signed long) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                fps = np.array([fingerprint(t, shingle) for t in text_bytes(part.column("text"))], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tk"), pa.array(fps.view(np.int64))],
                    ["doc_id", "tk", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_key(F.col("text")).alias("tk"), "text") \
        .mapInArrow(run, "doc_id long, tk long, fp long")


class Golay:
    """Codeword indices near 23-bit words (an index is the 12-bit message)."""

    def __init__(self):
        messages = np.arange(1 << 12, dtype=np.int64)
        words = np.zeros(1 << 12, np.int64)
        for bit in range(12):
            words ^= np.where(messages >> bit & 1, GOLAY << bit, 0)
        self.index = np.zeros(1 << 23, np.int16)  # of the codeword within three bits
        self.leader = np.zeros(1 << 23, np.int16)  # number of the error pattern
        errors = [0] + [sum(1 << b for b in bits) for n in (1, 2, 3) for bits in combinations(range(23), n)]
        # Codewords other than 0 within four bits of each error pattern.
        heavy = words[np.bitwise_count(words) == 7]
        at = {int(w): i for i, w in enumerate(words)}
        near = np.full((len(errors), 6), -1, np.int16)
        near[:, 0] = 0
        for i, e in enumerate(errors):
            self.index[words ^ e] = messages
            self.leader[words ^ e] = i
            close = [at[int(w)] for w in heavy[np.bitwise_count(heavy ^ e) <= 4]]
            near[i, 1:1 + len(close)] = close
        self.near = near

    def own(self, words: np.ndarray) -> np.ndarray:
        return self.index[words].astype(np.int64)

    def within_four(self, words: np.ndarray) -> np.ndarray:
        """Six columns of indices; -1 where there are fewer."""
        offsets = self.near[self.leader[words]].astype(np.int64)
        return np.where(offsets < 0, -1, offsets ^ self.own(words)[:, None])


def golay_keys(fps: DataFrame) -> DataFrame:
    """``fp, own, near``: key arrays that a fingerprint offers and looks up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = None
        for batch in batches:
            code = code or Golay()
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            segments = [((fp >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
            own = [code.own(s) for s in segments]
            near = [code.within_four(s) for s in segments]
            # A key is numbered by its kind, so that kinds never meet.
            offered = [own[0] << 24 | own[1] << 12 | own[2]]
            a, b, c = near[0][:, :, None, None], near[1][:, None, :, None], near[2][:, None, None, :]
            wanted = [np.where((a < 0) | (b < 0) | (c < 0), -1, a << 24 | b << 12 | c).reshape(len(fp), -1)]
            for kind, (equal, other) in enumerate(permutations(range(len(SEGMENTS)), 2), 1):
                base = kind << 40 | segments[equal] << 12
                offered.append(base | own[other])
                wanted.append(np.where(near[other] < 0, -1, base[:, None] | near[other]))
            wanted = np.concatenate(wanted, axis=1)
            kept = wanted >= 0
            offsets = np.r_[0, np.cumsum(kept.sum(1))].astype(np.int32)
            width = len(offered)
            yield pa.RecordBatch.from_arrays([
                batch.column("fp"),
                pa.ListArray.from_arrays(np.arange(0, width * len(fp) + 1, width, dtype=np.int32),
                                         np.stack(offered, axis=1).reshape(-1)),
                pa.ListArray.from_arrays(offsets, wanted[kept]),
            ], ["fp", "own", "near"])

    return fps.select("fp").mapInArrow(run, "fp long, own array<long>, near array<long>")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``u, v``: pairs of distinct fingerprints at ``max_bits`` or fewer
    differing bits, each once (``fps``: distinct ``fp``)."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the segments guarantee links of up to three bits")
    keys = golay_keys(fps)
    # Estimates do not see how many keys an array holds, so a broadcast is ruled out.
    offers = keys.select(F.col("fp").alias("u"), F.explode("own").alias("key")).hint("merge")
    wants = keys.select(F.col("fp").alias("v"), F.explode("near").alias("key")).hint("merge")
    close = (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits) & (F.col("u") < F.col("v"))
    return offers.join(wants, (offers.key == wants.key) & close).select("u", "v").distinct()


def _components(docs: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and ``fp, first, root``: each distinct
    fingerprint with its smallest doc_id and its component.

    Equal fingerprints are merged before the join, so a group of copies costs
    one key set however large it is; links are found between different
    fingerprints only.
    """
    rows = stored(fingerprints(docs, shingle), "simhash")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = connected_components(links(nodes, max_bits))
    return rows, nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document row.

    Words are runs without ASCII white space, A-Z lower-cased. Fewer words
    than a shingle make one shingle; null and empty texts have fingerprint
    zero, which links like any other. ``component_id`` is the smallest doc_id
    reachable over links (null only if no document of the component has an
    id). Repeated rows each get a row, an empty table gives none, and other
    columns are not read.
    """
    rows, member = _components(docs, shingle, max_bits)
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    component = member.join(smallest, "root").select("fp", "component_id")
    return rows.join(component, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``docs``, all columns: of every component the document with the
    smallest doc_id (null last; then by a digest of the text), once."""
    rows, member = _components(docs, shingle, max_bits)
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))
    placed = stored(rows.join(member.select("fp", "root"), "fp").select("id", "tk", "root"), "members")
    best = placed.groupBy("root").agg(F.min(F.struct("id", "tk")).alias("best"), F.count("*").alias("n")) \
        .where("n > 1")
    losers = stored(salted_join(placed, best, ["root"], ["id", "tk"]).where(F.struct("id", "tk") != F.col("best"))
                    .select("id", "tk").distinct(), "losers")
    repeated = placed.groupBy("id", "tk").agg(F.count("*").alias("n")).where("n > 1").select("id", "tk")
    keyed = docs.select(F.struct(*docs.columns).alias("doc"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                        doc_key(F.col("text")).alias("tk"))
    touched, others = split_by_keys(keyed, losers.union(repeated), ["id", "tk"])
    kept = touched.join(losers, ["id", "tk"], "left_anti").dropDuplicates(["id", "tk"])
    return kept.select("doc.*").union(others.select("doc.*"))
