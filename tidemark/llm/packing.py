"""Packing tokenized documents into sequences of fixed capacity.

Lengths are binned. Patterns of up to three bins that fill a sequence exactly
are enumerated, and non-negative least squares fits how often each pattern
repeats to the histogram of lengths. The rounded patterns are filled with
documents of their bins; what is left over is packed best-fit, longest first,
into the gaps and into new sequences. All planning works on the histogram of
lengths, so it takes the same time for any number of documents; Spark then
ranks the documents of each length and looks their place up in the plan.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import ranges, split_words, stored, text_slices

CAPACITY = 4096
END_ID = 1
#: Bins of the pattern fit, and most documents in a pattern.
BINS = 128
PATTERN_DOCS = 3
#: Documents of one length that one task ranks.
RANK_ROWS = 4096
#: Punctuation that the tokenizer splits from a word of letters as one piece.
_PUNCTUATION = '.,!?;:|*#%&$")('


# ---------------------------------------------------------------- tokenizing

class WordEncoder:
    """Token ids of texts, each distinct piece encoded once per task.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words. A word of Latin-1 letters with punctuation behind
    it is two pieces. Pieces of such letters go straight to the tokenizer's
    model (for them, normalizing is lower-casing, and there is nothing to
    split); all others take the tokenizer's whole way.
    """

    #: Pieces remembered at a time.
    MOST_PIECES = 1_500_000
    LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        # The byte-level alphabet. Printable Latin-1 bytes stand
        # for themselves, the others for the characters from U+0100 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.alphabet = {b: chr(256 + i) for i, b in enumerate(rest)}
        self.row: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.row = {"": 0}  # of a piece in the arrays below
        self.begin = self.count = np.zeros(1, np.int64)
        self.table = np.zeros(0, np.uint32)  # ids of all pieces, one after the other

    def _rows(self, pieces: pa.Array) -> np.ndarray:
        """Rows of the pieces, which are learned where new."""
        coded = pieces.dictionary_encode()
        texts = coded.dictionary.to_pylist()
        new = [t for t in texts if t not in self.row]
        if new:
            letters = pc.match_substring_regex(pa.array(new), f"^[{self.LETTERS}]+$").to_pylist()
            whole = iter(self.tokenizer.encode_batch_fast(
                [t for t, plain in zip(new, letters) if not plain], add_special_tokens=False))
            tokenize, alphabet = self.model.tokenize, self.alphabet
            ids: list[int] = []
            counts: list[int] = []
            for text, plain in zip(new, letters):
                if plain:
                    text = text.lower()
                    if not text.isascii():
                        text = text.encode().decode("latin-1").translate(alphabet)
                    ids += [t.id for t in tokenize(text)]
                else:
                    ids += next(whole).ids
                counts.append(len(ids))
            count = np.diff(np.array([0, *counts]))
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
            self.begin = np.r_[self.begin, len(self.table) + np.cumsum(count) - count]
            self.count = np.r_[self.count, count]
            self.table = np.r_[self.table, np.array(ids, np.uint32)]
        rows = np.fromiter(map(self.row.__getitem__, texts), np.int64, len(texts))
        return rows[coded.indices.to_numpy(zero_copy_only=False)]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        if len(self.row) > self.MOST_PIECES:
            self._forget()
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            # The tokenizer lower-cases; doing it here makes fewer pieces. The
            # names of special tokens are the exception.
            texts = pc.ascii_lower(texts)
        codes, words, sizes = split_words(texts)
        core = pc.ascii_rtrim(words, characters=_PUNCTUATION)
        plain = pc.match_substring_regex(core, f"^[{self.LETTERS}]+$")
        tail = pc.replace_substring_regex(words, f"^[{self.LETTERS}]+", "")
        rows = np.stack([self._rows(pc.if_else(plain, core, words)),
                         self._rows(pc.if_else(plain, tail, ""))], axis=1)
        table = self.table[ranges(self.begin[rows].reshape(-1), self.count[rows].reshape(-1))]
        count = self.count[rows].sum(axis=1)
        begin = np.cumsum(count) - count
        out = table[ranges(begin[codes], count[codes])]
        ends = np.r_[0, np.cumsum(count[codes])]
        stops = np.cumsum(sizes)
        return out, ends[stops] - ends[stops - sizes]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                 end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids``: each document's ids and the end
    id, cut into pieces of ``capacity`` only where longer. ``ids`` is binary,
    little-endian unsigned 32-bit. Null texts count as empty."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or WordEncoder(tokenizer.value)
            for part in text_slices(batch):
                ids, count = encoder.ids(part.column("text"))
                total = count + 1
                ends = np.cumsum(total)
                flat = np.full(int(ends[-1]), end_id, "<u4")
                is_end = np.zeros(len(flat), bool)
                is_end[ends - 1] = True
                flat[~is_end] = ids
                pieces = -(-total // capacity)
                doc = np.repeat(np.arange(len(total)), pieces)
                piece = ranges(np.zeros(len(total), np.int64), pieces)
                start = piece * capacity
                length = np.minimum(total[doc] - start, capacity)
                offsets = np.r_[0, np.cumsum(length)] * 4
                data = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(length),
                    [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()),
                     pa.array(start), pa.array(length), data.cast(pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary")


# ------------------------------------------------------------------ planning

def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Non-negative least squares by an active set."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    scale = max(1.0, float(np.abs(b).max()))
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= 1e-9 * scale:
            break
        active[best] = True
        while True:
            on = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if (z > 1e-12).all():
                break
            low = z <= 1e-12
            step = np.min(x[on][low] / np.maximum(x[on][low] - z[low], 1e-300))
            x[on] += step * (z - x[on])
            x[on[low & (x[on] <= 1e-9 * scale)]] = 0
            keep = x[on] > 0
            if keep.all():  # no progress: drop the least
                keep[np.argmin(np.where(low, z, np.inf))] = False
                x[on[~keep]] = 0
            active[on[~keep]] = False
        x[:] = 0
        x[on] = z
    return x


def patterns(bins: int = BINS, most: int = PATTERN_DOCS) -> list[tuple[int, ...]]:
    """Multisets of up to ``most`` bin numbers 1..bins whose sum is ``bins``."""
    def grow(left: int, least: int, slots: int) -> Iterator[tuple[int, ...]]:
        if slots >= 1 and left >= least:
            yield (left,)
        if slots > 1:
            for b in range(least, left // 2 + 1):
                for rest in grow(left - b, b, slots - 1):
                    yield (b, *rest)
    return list(grow(bins, 1, most))


@dataclass
class Plan:
    """Rows (length, first rank, documents, first sequence, offset, documents
    per sequence); groups of equal sequences by the room left in them."""
    capacity: int
    rows: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    used: dict[int, int] = field(default_factory=dict)
    open: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    gaps: list[int] = field(default_factory=list)

    def leave(self, gap: int, first: int, count: int) -> None:
        if count and gap:
            if gap not in self.open:
                self.open[gap] = []
                bisect.insort(self.gaps, gap)
            self.open[gap].append((first, count))

    def take(self, gap: int) -> tuple[int, int]:
        group = self.open[gap].pop()
        if not self.open[gap]:
            del self.open[gap]
            self.gaps.remove(gap)
        return group

    def put(self, length: int, first: int, count: int, gap: int, each: int) -> None:
        """``each`` documents of a length into each of ``count`` sequences."""
        if count and each:
            rank = self.used.get(length, 0)
            self.rows.append((length, rank, count * each, first, self.capacity - gap, each))
            self.used[length] = rank + count * each

    def best_fit(self, length: int, n: int) -> None:
        """``n`` more documents of a length, each where least room stays."""
        while n:
            at = bisect.bisect_left(self.gaps, length)
            if at < len(self.gaps):
                gap = self.gaps[at]
                first, count = self.take(gap)
            else:
                gap, first = self.capacity, self.sequences
                count = -(-n // (gap // length))
                self.sequences += count
            each = gap // length
            full = min(count, n // each)
            self.put(length, first, full, gap, each)
            self.leave(gap - each * length, first, full)
            n -= full * each
            first, count = first + full, count - full
            if count and n:
                rest = min(n, each)
                self.put(length, first, 1, gap, rest)
                self.leave(gap - rest * length, first, 1)
                n -= rest
                first, count = first + 1, count - 1
            self.leave(gap, first, count)


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, bins: int = BINS) -> Plan:
    """A place for every document of a histogram of lengths 1..capacity."""
    plan = Plan(capacity)
    bins = min(bins, capacity)
    width = capacity / bins
    left = {length: n for length, n in histogram.items() if n}
    lengths = sorted(left)

    def bin_of(length: int) -> int:
        return min(bins, max(1, round(length / width)))

    members: dict[int, list[int]] = {}  # lengths of each bin, longest last
    counts = np.zeros(bins)
    for length in lengths:
        members.setdefault(bin_of(length), []).append(length)
        counts[bin_of(length) - 1] += left[length]
    shapes = patterns(bins)
    matrix = np.zeros((bins, len(shapes)))
    for j, shape in enumerate(shapes):
        for b in shape:
            matrix[b - 1, j] += 1
    repeats = np.floor(nnls(matrix, counts) + 1e-6).astype(np.int64)

    def longest(among: list[int], room: int) -> int | None:
        """The longest length that is left and fits; used up ones go."""
        at = bisect.bisect_right(among, room) - 1
        while at >= 0 and not left[among[at]]:
            at -= 1
        return among[at] if at >= 0 else None

    for j in np.flatnonzero(repeats):
        *head, _ = sorted(shapes[j], reverse=True)
        todo = int(repeats[j])
        while todo > 0:
            # One run: every slot takes documents of one length; the last slot
            # takes the length that fills the sequence best.
            picks: list[int] = []
            room = capacity
            for b in [*head, None]:
                x = longest(lengths if b is None else members.get(b, []), room)
                if x is None:
                    break
                picks.append(x)
                left[x] -= 1
                room -= x
            for x in picks:
                left[x] += 1
            if len(picks) <= len(head) or room > width:
                break
            run = min(todo, *(left[x] // picks.count(x) for x in picks))
            first, gap = plan.sequences, capacity
            plan.sequences += run
            for x in picks:
                plan.put(x, first, run, gap, 1)
                gap -= x
                left[x] -= run
            plan.leave(gap, first, run)
            todo -= run
            lengths[:] = [x for x in lengths if left[x]]
    for length in sorted(left, reverse=True):
        plan.best_fit(length, left[length])
    return plan


# ------------------------------------------------------------------- placing

def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``doc_id, piece, length``
    (1 to ``capacity``; read twice, so pass a stored table).

    Offsets count from 0 without gaps in each sequence. The driver sees the
    histogram of lengths and the plan; both are bounded by ``capacity``. A
    length that many rows share is ranked in parts of about ``RANK_ROWS`` rows.
    """
    spark = pieces.sparkSession
    sizes = pieces.groupBy("length").agg(F.count("*").alias("n"))
    plan = plan_packing({r.length: r.n for r in sizes.collect()}, capacity)
    table = np.array(sorted(plan.rows), np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast(table)

    rows = pieces.select("doc_id", "piece", "length", F.struct(*pieces.columns).alias("whole"))
    share = rows.join(F.broadcast(sizes), "length").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "piece"), F.ceil(F.col("n") / RANK_ROWS))).drop("n")
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = share.groupBy("length", "part").agg(F.count("*").alias("n")).select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = share.withColumn("within", within).join(starts, ["length", "part"]) \
        .select("whole", "length", (F.col("before") + F.col("within") - 1).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            # Rows are sorted by length and first rank; documents never number 2**50.
            at = np.searchsorted((plan[:, 0] << 50) + plan[:, 1], (length << 50) + rank, "right") - 1
            _, first, _, sequence, offset, each = plan[at].T
            nth = rank - first
            yield pa.RecordBatch.from_arrays(
                [batch.column("whole"), pa.array(sequence + nth // each), pa.array(offset + nth % each * length)],
                ["whole", "sequence_id", "offset"])

    placed = ranked.mapInArrow(place, T.StructType([
        ranked.schema["whole"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    return placed.select("whole.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                   end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset`` and, if asked for, ``ids``.

    Null and empty texts are one piece that holds the end id alone. Repeated
    rows are packed each, an empty table gives no rows, and other columns are
    not read.
    """
    cut = token_pieces(docs, tokenizer_path, capacity, end_id) \
        .withColumn("ids_crc32", F.crc32("ids"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return pack(stored(cut.select(*columns), "pieces"), capacity)
