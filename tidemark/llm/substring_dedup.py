"""Removal of long word sequences that a smaller document already has.

Recompression names text bottom-up. In each round, maximal runs of a symbol
get a name, then symbols are split into left and right ones by a hash, and
every left symbol followed by a right one is replaced by the name of the pair.
A name is a digest of what it stands for, so all tasks name equal runs and
pairs alike without exchanging a dictionary. Whether a symbol occurs depends
only on a known range of words around it (its extent). So equal windows hold
equal interior symbols, wherever they stand, and both choose the same anchor:
the symbol inside with the longest expansion, ties by hash, then leftmost.

One pass parses each text and keeps its anchors with the range of windows that
chose them (about one anchor for 17 words). Spark then finds symbols that
different documents share. Anchors whose whole surroundings are equal are
settled by one digest; the windows of the others are compared one by one, by a
128-bit digest. Windows without an interior symbol (long repetitions) are
their own anchors.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (RangeHash, doc_key, hashes, mix, ranges, salted_join, signed, split_by_keys,
                                 split_words, stored, text_bytes, text_slices)

WINDOW = 50
#: Rounds of run and pair naming: symbols of about six words, four or five of
#: them inside a window of 50 words.
ROUNDS = 6
#: Text bytes parsed at a time; parsing needs some fifty times as much memory.
SLICE_BYTES = 2 << 20
#: Stands for a null doc_id, which sorts after every other.
NO_ID = sys.maxsize

_U = np.uint64
_FAR = 1 << 40


def _name_runs(sym, s, el, er, words, number):
    """Name maximal runs; a symbol's extent grows until it shows that its
    neighbours differ from it."""
    n, end = len(sym), len(words)
    start = np.flatnonzero(np.r_[True, sym[1:] != sym[:-1]])
    count = np.diff(np.r_[start, n])
    last = start + count - 1
    e = np.r_[s[1:], end]
    first_word, last_word = words[s], words[e - 1]
    left, right = np.maximum(start - 1, 0), np.minimum(last + 1, n - 1)
    by_word = last_word[left] != last_word[start]
    new_el = np.minimum(el[start], np.where(by_word, s[start] - 1, el[left]))
    new_el[0] = -_FAR
    by_word = first_word[right] != first_word[start]
    new_er = np.maximum(er[last], np.where(by_word, e[last] + 1, er[right]))
    new_er[-1] = _FAR
    name = sym[start]
    runs = np.flatnonzero(count > 1)
    name[runs] = mix(name[runs] * _U(0x9E3779B97F4A7C15) + count[runs].astype(np.uint64) + _U(2 * number))
    return name, s[start], new_el, new_er


def _name_pairs(sym, s, el, er, number):
    """Name each left symbol with the right symbol after it."""
    n = len(sym)
    is_left = (mix(sym + _U(0x51ED270B * number)) & _U(1)).astype(bool)
    pair = np.zeros(n, bool)
    pair[:-1] = is_left[:-1] & ~is_left[1:]
    second = np.r_[False, pair[:-1]]
    # A left symbol stays alone because the next is left too; likewise right.
    new_er = np.where(is_left, np.r_[er[1:], _FAR], er)
    new_el = np.where(is_left, el, np.r_[-_FAR, el[:-1]])
    pairs = np.flatnonzero(pair)
    new_el[pairs] = el[pairs]
    new_er[pairs] = er[pairs + 1]
    name = sym.copy()
    name[pairs] = mix(sym[pairs] * _U(3) + mix(sym[pairs + 1]) * _U(0x9E3779B97F4A7C15) + _U(2 * number + 1))
    keep = ~second
    return name[keep], s[keep], new_el[keep], new_er[keep]


def recompress(words: np.ndarray, rounds: int = ROUNDS):
    """Symbols of a word sequence: name, first word, and extent ``[el, er)``;
    the extents rise from symbol to symbol."""
    sym, s = words.copy(), np.arange(len(words))
    el, er = s.copy(), s + 1
    for number in range(1, rounds + 1):
        sym, s, el, er = _name_runs(sym, s, el, er, words, number)
        sym, s, el, er = _name_pairs(sym, s, el, er, number)
    return sym, s, el, er


def _leftmost_least(value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the least value in each range (leftmost of equal ones)."""
    size = hi - lo
    level = np.zeros(len(size), np.int64)
    for k in range(1, int(size.max()).bit_length()):
        level[size >= 1 << k] = k
    best = np.arange(len(value))
    out = np.empty(len(lo), np.int64)
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            a, b = best[:-half], best[half:]
            best = np.r_[np.where(value[a] <= value[b], a, b), best[-half:]]
        at = np.flatnonzero(level == k)
        a, b = best[lo[at]], best[hi[at] - (1 << k)]
        out[at] = np.where(value[a] <= value[b], a, b)
    return out


def anchors(words: np.ndarray, starts: np.ndarray, window: int, rounds: int = ROUNDS):
    """Anchors of the windows that begin at ``starts`` (rising): symbol, digest
    of all words that its windows cover, first and last window start."""
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, none, starts, starts
    sym, s, el, er = recompress(words, rounds)
    n = len(words)
    inner = (el >= 0) & (er <= n)
    sym, s, el, er, length = sym[inner], s[inner], el[inner], er[inner], np.diff(np.r_[s, n])[inner]
    lo = np.cumsum(np.bincount(el + 1, minlength=n + 2))[starts]  # extents that begin before a window
    hi = np.cumsum(np.bincount(er, minlength=n + 2))[starts + window]  # that end inside or before it
    order = (_U(63) - np.minimum(length, 63).astype(np.uint64)) << _U(58) | mix(sym + _U(17)) >> _U(6)

    held = hi > lo
    change = np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
    block = np.flatnonzero(change & held)
    chosen = np.full(len(starts), -1, np.int64)
    if len(block):
        chosen[block] = _leftmost_least(order, lo[block], hi[block])
        chosen = chosen[np.maximum.accumulate(np.where(change, np.arange(len(starts)), 0))]
    chosen[~held] = -1
    new = np.r_[True, (chosen[1:] != chosen[:-1]) | (chosen[1:] < 0) | (starts[1:] != starts[:-1] + 1)]
    at = np.flatnonzero(new)
    first = starts[at]
    last = starts[np.r_[at[1:], len(starts)] - 1]
    digest = RangeHash(mix(words + _U(29))).of(first, last + window)
    chosen = chosen[at]
    symbol = np.where(chosen >= 0, sym[np.maximum(chosen, 0)] if len(sym) else _U(0), mix(digest + _U(31)))
    return symbol, digest, first, last


_ANCHOR = pa.struct([("sym", pa.int64()), ("ctx", pa.int64()), ("len", pa.int32()),
                     ("at", pa.int32()), ("more", pa.list_(pa.int32()))])


def _sequence(texts: pa.Array, seeds: tuple[int, ...]):
    """Hash sequences of all words of the texts, with a separator of its own
    before each text and after the last, and the place of each text's words."""
    codes, distinct, sizes = split_words(texts)
    begin = np.cumsum(sizes) - sizes + np.arange(1, len(sizes) + 1)
    total = int(sizes.sum()) + len(sizes) + 1
    is_word = np.ones(total, bool)
    is_word[begin - 1] = False
    is_word[-1] = False
    out = []
    for seed in seeds:
        seq = np.empty(total, np.uint64)
        seq[is_word] = hashes(distinct, seed)[codes]
        seq[~is_word] = mix(np.arange(len(sizes) + 1, dtype=np.uint64) + _U(0xABCDEF0123456789))
        out.append(seq)
    return out, begin, sizes


def parse(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, tk, anchors``: each document's anchors; equal ones of a document
    are one entry (``at`` first start, ``more`` the others)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, budget=SLICE_BYTES):
                (seq,), begin, sizes = _sequence(part.column("text"), (7,))
                count = np.maximum(sizes - window + 1, 0)
                symbol, digest, first, last = anchors(seq, ranges(begin, count), window)
                doc = np.searchsorted(begin, first, "right") - 1
                order = np.lexsort((first, digest, symbol, doc))
                doc, symbol, digest = doc[order], symbol[order], digest[order]
                at = (first - begin[np.searchsorted(begin, first, "right") - 1])[order].astype(np.int32)
                length = (last - first)[order].astype(np.int32)
                new = np.r_[True, (doc[1:] != doc[:-1]) | (symbol[1:] != symbol[:-1])
                            | (digest[1:] != digest[:-1])] if len(doc) else np.zeros(0, bool)
                head = np.flatnonzero(new)
                others = np.diff(np.r_[head, len(doc)]) - 1
                more = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(others)].astype(np.int32)), pa.array(at[~new]),
                    mask=pa.array(others == 0))
                entries = pa.StructArray.from_arrays(
                    [pa.array(signed(symbol[head])), pa.array(signed(digest[head])),
                     pa.array(length[head]), pa.array(at[head]), more], fields=list(_ANCHOR))
                offsets = np.searchsorted(doc[head], np.arange(len(sizes) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("tk"),
                     pa.ListArray.from_arrays(pa.array(offsets), entries)], ["id", "tk", "anchors"])

    return docs.select("id", "tk", "text").mapInArrow(
        run, "id long, tk long, anchors array<struct<sym:long,ctx:long,len:int,at:int,more:array<int>>>")


def _window_digests(docs: DataFrame, window: int) -> DataFrame:
    """``w1, w2, id, tk, at, more``: windows of the listed ranges ``segs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, budget=SLICE_BYTES):
                (one, two), begin, _ = _sequence(part.column("text"), (7, 11))
                doc, at, length, more = [], [], [], []
                for i, segs in enumerate(part.column("segs").to_pylist()):
                    for g in segs:
                        doc.append(i)
                        at.append(g["at"])
                        length.append(g["len"])
                        more.append(g["more"])
                doc, at, count = np.array(doc), np.array(at), np.array(length) + 1
                start = ranges(begin[doc] + at, count)
                owner = np.repeat(doc, count)
                step = start - np.repeat(begin[doc] + at, count)
                source = np.repeat(np.arange(len(doc)), count)
                others = [None if more[j] is None else [x + k for x in more[j]]
                          for j, k in zip(source.tolist(), step.tolist())]
                digest = [RangeHash(mix(x + _U(37))).of(start, start + window) for x in (one, two)]
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(digest[0])), pa.array(signed(digest[1])),
                     part.column("id").take(take), part.column("tk").take(take),
                     pa.array((start - begin[owner]).astype(np.int32)),
                     pa.array(others, pa.list_(pa.int32()))], ["w1", "w2", "id", "tk", "at", "more"])

    return docs.select("id", "tk", "text", "segs").mapInArrow(
        run, "w1 long, w2 long, id long, tk long, at int, more array<int>")


def repeated_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, tk, cuts``: windows to remove, as arrays of (at, len, more): the
    windows that start at ``at .. at + len``, and likewise at each of ``more``."""
    parsed = stored(parse(docs, window), "recompressed")
    found = parsed.select("id", "tk", F.explode("anchors").alias("a")).select("id", "tk", "a.*")
    shared = found.groupBy("sym").agg(F.min("id").alias("lo"), F.max("id").alias("hi")) \
        .where("lo < hi").select("sym")
    found = stored(salted_join(found, shared, ["sym"], ["id", "tk"]), "shared-anchors")
    contexts = found.groupBy("sym", "ctx").agg(F.min("id").alias("least"))
    several = contexts.groupBy("sym").agg(F.count("*").alias("n")).where("n > 1").select("sym", "n")
    contexts = salted_join(contexts, several, ["sym"], ["ctx"], "left")
    judged = stored(
        found.join(contexts, ["sym", "ctx"]).where("id > least or n is not null")
        .select("id", "tk", "len", "at", "more", (F.col("id") > F.col("least")).alias("gone")), "judged-anchors")

    cut = F.struct("at", "len", "more")
    asked = stored(judged.where("not gone").groupBy("id", "tk").agg(F.collect_list(cut).alias("segs")), "asked")
    texts, _ = split_by_keys(docs, asked, ["id", "tk"])
    # Repeated rows ask the same, so one of them answers.
    texts = texts.join(asked, ["id", "tk"]).dropDuplicates(["id", "tk"])
    windows = stored(_window_digests(texts, window), "windows")
    least = windows.groupBy("w1", "w2").agg(F.min("id").alias("least"), F.max("id").alias("most")) \
        .where("least < most").select("w1", "w2", "least")
    late = windows.join(least, ["w1", "w2"]).where("id > least") \
        .select("id", "tk", "at", F.lit(0).alias("len"), "more")
    gone = judged.where("gone").select("id", "tk", "at", "len", "more")
    return gone.union(late).groupBy("id", "tk").agg(F.collect_list(cut).alias("cuts"))


def _covered(n: int, cuts, window: int) -> np.ndarray:
    """Which of ``n`` words the windows of ``cuts`` cover."""
    step = np.zeros(n + 1, np.int64)
    for c in cuts or ():
        for at in (c["at"], *(c["more"] or ())):
            step[at] += 1
            step[at + c["len"] + window] -= 1
    return np.cumsum(step[:n]) > 0


def _keep_words(docs: DataFrame, window: int, columns: list[str]) -> DataFrame:
    """``columns`` and ``n_words, n_removed, kept`` of every document; ``kept``
    is null where nothing goes and ``columns`` hold the text."""
    whole = "text" in columns
    fields = [docs.schema[c] for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                total, removed, kept = [], [], []
                texts = text_bytes(part.column("text"))
                for text, cuts in zip(texts, part.column("cuts").to_pylist()):
                    words = text.split()
                    covered = _covered(len(words), cuts, window)
                    total.append(len(words))
                    removed.append(int(covered.sum()))
                    kept.append(b" ".join(w for w, c in zip(words, covered.tolist()) if not c) if cuts
                                else None if whole else b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in columns), pa.array(total, pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    [*columns, "n_words", "n_removed", "kept"])

    return docs.select(*dict.fromkeys([*columns, "text", "cuts"])).mapInArrow(run, T.StructType(fields + [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept", T.StringType())]))


def _with_cuts(docs: DataFrame, window: int) -> DataFrame:
    """Rows ``doc_id, text, ...`` with the array ``cuts`` (null: nothing goes)."""
    docs = docs.withColumns({"id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                             "tk": doc_key(F.col("text"))})
    cuts = stored(repeated_ranges(docs.select("id", "tk", "text"), window), "cuts")
    hit, miss = split_by_keys(docs, cuts, ["id", "tk"])
    return hit.join(cuts, ["id", "tk"], "left").unionByName(miss, allowMissingColumns=True)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: every document without the words
    that lie in a window of ``window`` words whose sequence also starts in a
    document with a smaller doc_id. ``kept`` holds the other words, joined by
    one space.

    Words are runs without ASCII white space. Windows are judged on the input.
    Null and empty texts have no words; a null doc_id counts as larger than
    every other; rows with the same doc_id do not remove from each other, and
    repeated rows get equal results; an empty table gives no rows. Other
    columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _keep_words(_with_cuts(docs, window), window, ["doc_id"])


def strip_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of ``docs``, all columns, with the kept words as text where words
    go (and ``n_chars``, if there, set to its length); other texts unchanged."""
    others = F.struct(*[c for c in docs.columns if c != "text"])
    rows = docs.select("doc_id", "text", others.alias("doc"))
    judged = _keep_words(_with_cuts(rows, window), window, ["doc", "text"])
    columns = {c: F.col("doc")[c] for c in docs.columns if c != "text"}
    columns["text"] = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType)) \
            .otherwise(columns["n_chars"])
    return judged.select(*[columns[c].alias(c) for c in docs.columns])
