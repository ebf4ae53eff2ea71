"""Language-model scores by a hashed maximum-entropy model.

A token's probability is that of its class given the words before it, times
that of its group in the class given the same words, times its share of the
group. Class and group are softmax factors over hashed n-gram and skip
features, so no normalizer runs over the vocabulary; both are trained by rounds
of distributed gradient steps: each task starts from the shared weights, takes
steps over its documents, and returns the change; Spark sums the changes and
the driver averages them. The last factor has one feature per token, for which
the maximum-entropy solution is known: its smoothed share of its cell (class
and group), from exact counts over the whole corpus.

A word's type is a hash of its ending. The types are clustered into classes by
the types that stand beside them in the corpus, so words never seen have a
class too. A word's group is a hash of the word: a frequent word dominates its
cell, so the group factor tells frequent words of a class apart by their
contexts, and the rare ones by hashed parts of the class.

Texts are kept as chunks: the token numbers of many documents with the distinct
words they refer to. Counts reach a chunk as one row per distinct word: word
counts are summed by Spark, joined with the words of every chunk, and handed to
the chunk; the rows between them grow with the corpus, not with its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import alone, hashes, mix, ranges, split_words, stored, text_slices

#: Text bytes per chunk (one document at least).
CHUNK = 6 << 20
#: Word types; type 0 is the end token.
TYPES = 256
#: Classes; class 0 is the end token, alone in it.
CLASSES = 32
#: Hashed groups of the words of a class.
GROUPS = 32
#: Hash buckets, for a small corpus, of the previous word, the previous two
#: words, and the word before the previous one (a skip).
BUCKETS = (8192, 16384, 8192)
#: The buckets double with every ``GROWTH`` times this many tokens, up to
#: ``MOST_BUCKETS``: the table of weights is broadcast and every task returns one.
SMALL_CORPUS, GROWTH, MOST_BUCKETS = 1 << 22, 8, 1 << 16
#: Rounds of training; each takes another share of the texts.
ROUNDS = 3
BATCH = 8192
#: Rows of a feature that are added up without ``reduceat``. Up to so many both
#: add in one order, so the sums are equal to the last bit.
SHORT = 8
RATE = 0.3
#: Where the sum of squared gradients starts: rare features move little.
FIRST_SQUARES = 10.0
#: Bound of the summed weights of one outcome; each kind of feature has an equal part.
LIMIT = 30.0
#: Tokens that one step of a task works on.
SPAN = 1 << 18
#: Pieces that the weights are summed in, and partial sums per piece.
SLICES = 16
PARTIALS = 64
#: Bytes of stored chunks that one training task starts from.
TASK_BYTES = 48 << 20

_U = np.uint64
#: Stand for the end token and for what precedes a text.
_END, _PAD = _U(0x6A09E667F3BCC909), _U(0xBB67AE8584CAA73B)
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b".,;:!?)(\"'|*#%&$-")] = True


def buckets_for(tokens: int) -> tuple[int, ...]:
    """Hash buckets of each kind of feature for a corpus of so many tokens."""
    doublings = 0
    while tokens >= SMALL_CORPUS * GROWTH ** (doublings + 1):
        doublings += 1
    return tuple(min(MOST_BUCKETS, b << doublings) for b in BUCKETS)


def word_types(words: pa.Array) -> np.ndarray:
    """Type 1..TYPES-1 of each word: a hash of its last three bytes, trailing
    punctuation (two bytes at most) aside."""
    if not len(words):
        return np.zeros(0, np.uint8)
    offsets = np.frombuffer(words.buffers()[1], np.int32).astype(np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] else np.zeros(1, np.uint8)
    begin, end = offsets[:-1], offsets[1:].copy()
    for _ in range(2):
        long = end - begin > 1
        end[long & _PUNCTUATION[data[np.maximum(end - 1, 0)]]] -= 1
    code = np.zeros(len(words), np.uint64)
    for back in (1, 2, 3):
        has = end - back >= begin
        code = code * _U(257) + np.where(has, data[np.maximum(end - back, 0)].astype(np.uint64) + _U(1), _U(0))
    return (mix(code + _U(5)) % _U(TYPES - 1)).astype(np.uint8) + np.uint8(1)


def _chunk_row(number: int, docs, held, parts) -> dict:
    """One chunk from slices of (sizes, codes, word hashes, types)."""
    sizes = np.concatenate([p[0] for p in parts])
    words, first, back = np.unique(np.concatenate([p[2] for p in parts]), return_index=True, return_inverse=True)
    types = np.concatenate([p[3] for p in parts])[first]
    base = np.cumsum([0] + [len(p[2]) for p in parts])
    ids = np.concatenate([back[base[i]:][p[1]] for i, p in enumerate(parts)]).astype(np.uint32)
    train = np.repeat(~np.array(held, bool), sizes)
    counts = np.bincount(ids[train], minlength=len(words)).astype(np.uint32)
    # Neighbouring types in training texts.
    t = types[ids].astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    follows = np.ones(len(t), bool)
    follows[begins] = False
    at = np.flatnonzero(follows & train)
    cells = np.bincount(t[at - 1] * TYPES + t[at], minlength=TYPES * TYPES)
    used = np.flatnonzero(cells)
    squeeze = lambda a: pa.compress(a.tobytes(), codec="zstd", asbytes=True)
    return {"chunk": number, "doc_ids": docs, "held": held, "sizes": sizes.tolist(),
            "ids": squeeze(ids), "n_ids": len(ids), "words": words.tobytes(), "types": types.tobytes(),
            "counts": counts.tobytes(), "cells": used.astype(np.int32).tobytes(),
            "cell_n": cells[used].astype(np.int64).tobytes()}


_CHUNK = pa.schema([("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                    ("sizes", pa.list_(pa.int64())), ("ids", pa.binary()), ("n_ids", pa.int64()),
                    ("words", pa.binary()), ("types", pa.binary()), ("counts", pa.binary()),
                    ("cells", pa.binary()), ("cell_n", pa.binary())])
_CHUNK_SQL = ("chunk long, doc_ids array<long>, held array<boolean>, sizes array<long>, ids binary, n_ids long, "
              "words binary, types binary, counts binary, cells binary, cell_n binary")


def chunks(docs: DataFrame) -> DataFrame:
    """Chunks of the documents ``doc_id, text, held``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, held, parts, size = [], [], [], 0

        def flush():
            return pa.RecordBatch.from_pylist([_chunk_row(number, ids, held, parts)], schema=_CHUNK)

        for batch in batches:
            for part in text_slices(batch):
                token_codes, distinct, sizes = split_words(pc.ascii_lower(part.column("text")))
                # The end token is the last entry of a slice's words.
                words = np.r_[hashes(distinct, 5), _END]
                types = np.r_[word_types(distinct), np.uint8(0)]
                codes = np.full(int((sizes + 1).sum()), len(distinct), np.int64)
                is_word = np.ones(len(codes), bool)
                is_word[np.cumsum(sizes + 1) - 1] = False
                codes[is_word] = token_codes
                ids += part.column("doc_id").to_pylist()
                held += part.column("held").to_pylist()
                parts.append((sizes + 1, codes, words, types))
                size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if size >= CHUNK:
                    yield flush()
                    ids, held, parts, size = [], [], [], 0
                    number += 1
        if parts:
            yield flush()

    return docs.select("doc_id", "text", "held").mapInArrow(run, _CHUNK_SQL)


def _array(row: dict, name: str, kind) -> np.ndarray:
    return np.frombuffer(row[name], kind)


def _tokens(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of a chunk, and the number of tokens of each document."""
    raw = pa.decompress(row["ids"], decompressed_size=row["n_ids"] * 4, codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.uint32).astype(np.int64), np.array(row["sizes"], np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time; a chunk's columns are large, and so is what their
    work leaves in Arrow's pool."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
            pa.default_memory_pool().release_unused()


def _one_by_one(spark, action):
    """Run an action on chunks or slices of weights: Python gets them one at a
    time. A row holds megabytes, and a batch of all that a task reads would
    stand in the JVM and in Python while the task works."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        return action()
    finally:
        spark.conf.set(name, before)


def _spans(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about ``SPAN`` tokens (one document at least)."""
    group = (np.cumsum(sizes) - sizes) // SPAN
    at = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(sizes)]
    return zip(at[:-1].tolist(), at[1:].tolist())


def contexts(words: np.ndarray, types: np.ndarray, ids: np.ndarray, sizes: np.ndarray,
             buckets: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray]:
    """What precedes every position: the hashes of the word before, the two
    before and the skipped one, reduced to buckets, and the type of the word
    before."""
    begins = np.cumsum(sizes) - sizes
    since = np.arange(len(ids)) - np.repeat(begins, sizes)

    def back(values: np.ndarray, k: int, empty):
        out = np.full(len(ids), empty, values.dtype)
        out[k:] = values[ids[:-k]] if k < len(ids) else out[k:]
        out[since < k] = empty
        return out

    one, two = back(words, 1, _PAD), back(words, 2, _PAD)
    hashed = (mix(one + _U(1)), mix(one * _U(0x9E3779B97F4A7C15) + mix(two)), mix(two + _U(2)))
    return ([(h & _U(n - 1)).astype(np.uint16) for h, n in zip(hashed, buckets)],
            back(types, 1, np.uint8(0)).astype(np.uint16))


def class_features(hashed: list[np.ndarray], before: np.ndarray) -> list[np.ndarray]:
    """Feature numbers of every position by kind, for the class factor, from
    its ``contexts``. The last kind is the constant."""
    return [*hashed, before, np.zeros(len(before), np.uint16)]


def group_features(hashed: list[np.ndarray], mine: np.ndarray, buckets: tuple[int, ...]) -> list[np.ndarray]:
    """The same for the group factor: every n-gram and skip together with the
    class that was drawn (``mine``), and the class alone."""
    # Multiplying by an odd number permutes the buckets in another way for each class.
    mixed = [(h * (mine * np.uint16(0x9E3B) | np.uint16(1)) + mine * np.uint16(0x6D2B)) & np.uint16(n - 1)
             for h, n in zip(hashed, buckets)]
    return [*mixed, mine]


def scores(weights: list[np.ndarray], features: list[np.ndarray]) -> np.ndarray:
    """Exponentials of every outcome's summed weights for a batch of positions;
    weights are held so small that no sum exceeds ``LIMIT``."""
    z = np.take(weights[0], features[0], axis=0, mode="clip")
    other = np.empty_like(z)
    for w, f in zip(weights[1:], features[1:]):
        z += w if len(w) == 1 else np.take(w, f, axis=0, mode="clip", out=other)
    return np.exp(z, out=z)


def probabilities(weights: list[np.ndarray], features: list[np.ndarray]) -> np.ndarray:
    """Probability of every outcome for a batch of positions: a softmax of the
    summed weights of their features."""
    z = scores(weights, features)
    z /= z.sum(axis=1, keepdims=True)
    return z


def feature_sums(g: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a batch and, for each, the sum of its rows of ``g``.

    Of many short runs of rows ``reduceat`` makes a call per run and column. So
    runs go by falling length, and runs of up to ``SHORT`` rows are added up row
    by row for all of them at once; the sums are those of ``reduceat``.
    """
    order = np.argsort(f, kind="stable")  # a radix sort: features are 16-bit numbers
    f = f[order]
    start = np.flatnonzero(np.r_[True, f[1:] != f[:-1]])
    size = np.diff(start, append=len(f))
    by_size = np.argsort(-size.astype(np.int16), kind="stable")
    start, size = start[by_size], size[by_size]
    total = np.empty((len(start), g.shape[1]), g.dtype)
    # Runs with more than k rows are the first longer[k].
    longer = len(size) - np.searchsorted(size[::-1], np.arange(SHORT + 1), side="right")
    long = int(longer[SHORT])
    if long:
        begin = np.cumsum(size[:long]) - size[:long]
        rows = np.take(g, order[ranges(start[:long], size[:long])], axis=0, mode="clip")
        np.add.reduceat(rows, begin, axis=0, out=total[:long])
    np.take(g, order[start[long:]], axis=0, mode="clip", out=total[long:])
    if longer[1] > long:
        rest = np.take(g, order[start[long:longer[1]] + 1], axis=0, mode="clip")
        for k in range(2, SHORT):
            if longer[k] <= long:
                break
            rest[:longer[k] - long] += np.take(g, order[start[long:longer[k]] + k], axis=0, mode="clip")
        total[long:longer[1]] += rest
    return f[start], total


def gradient_steps(weights: list[np.ndarray], squares: list[np.ndarray], features: list[np.ndarray],
                   target: np.ndarray) -> None:
    """Adagrad steps over batches of positions, in place."""
    bound = np.float32(LIMIT / len(weights))
    for i in range(0, len(target), BATCH):
        part, y = [f[i:i + BATCH] for f in features], target[i:i + BATCH]
        g = probabilities(weights, part)
        g[np.arange(len(y)), y] -= 1
        for w, s, f in zip(weights, squares, part):
            if len(w) == 1:
                row, total = np.zeros(1, np.int64), g.sum(axis=0, keepdims=True)
            else:
                row, total = feature_sums(g, f)
            sums = s[row] + np.einsum("ij,ij->i", total, total) / np.float32(w.shape[1])
            s[row] = sums
            total *= (np.float32(RATE) / np.sqrt(sums))[:, None]
            now = np.take(w, row, axis=0, mode="clip")
            now -= total
            w[row] = np.clip(now, -bound, bound, out=now)


def word_groups(words: np.ndarray) -> np.ndarray:
    """Group of each word, from its hash."""
    return (mix(words ^ _U(0x517CC1B727220A95)) % _U(GROUPS)).astype(np.uint8)


def type_classes(cells: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Class of each type: weighted k-means of the types by their neighbours."""
    before, after = cells.T.astype(float), cells.astype(float)
    weight = before.sum(1) + after.sum(1)
    profile = np.concatenate([before, after], axis=1)
    profile = np.sqrt(profile / np.maximum(profile.sum(1, keepdims=True), 1))
    out = np.arange(len(cells)) % (classes - 1) + 1
    out[0] = 0
    live = np.flatnonzero(weight > 0)
    live = live[live != 0]
    if len(live) <= classes - 1:
        out[live] = np.arange(len(live)) + 1
        return out
    x, w = profile[live], weight[live]
    centre = [int(np.argmax(w))]
    far = ((x - x[centre[0]]) ** 2).sum(1)
    while len(centre) < classes - 1:
        centre.append(int(np.argmax(far * w)))
        far = np.minimum(far, ((x - x[centre[-1]]) ** 2).sum(1))
    c = x[centre]
    for _ in range(30):
        label = ((x[:, None, :] - c[None]) ** 2).sum(2).argmin(1)
        for k in range(len(c)):
            mine = label == k
            if mine.any():
                c[k] = (x[mine] * w[mine, None]).sum(0) / w[mine].sum()
    out[live] = label + 1
    return out


def _sum_changes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sum the vectors of each key as they stream by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}
        for batch in batches:
            for slice_, group, n, vector in zip(*(batch.column(c).to_pylist() for c in ("slice", "grp", "n", "vector"))):
                v = np.frombuffer(vector, np.float32)
                have = sums.setdefault((slice_, group), [0, np.zeros(len(v), np.float64)])
                have[0] += n
                have[1] += v
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
                 pa.array([v[0] for v in sums.values()], pa.int64()),
                 pa.array([v[1].astype(np.float32).tobytes() for v in sums.values()], pa.binary())],
                ["slice", "grp", "n", "vector"])

    return rows.repartition(*keys).mapInArrow(run, "slice int, grp int, n long, vector binary")


def _factors(model: dict, row: dict, ids: np.ndarray, sizes: np.ndarray):
    """For both factors: weights, features and outcomes of the positions ``ids``
    of a chunk, and the positions meant (the end token has no group)."""
    words, types = _array(row, "words", np.uint64), _array(row, "types", np.uint8)
    hashed, before = contexts(words, types, ids, sizes, model["buckets"])
    kinds = types[ids]
    outcome = model["classes"][kinds]
    yield model["class_weights"], class_features(hashed, before), outcome, slice(None)
    drawn = np.flatnonzero(kinds != 0)
    features = group_features([h[drawn] for h in hashed], outcome[drawn].astype(np.uint16), model["buckets"])
    yield model["group_weights"], features, word_groups(words)[ids[drawn]], drawn


def _kinds(buckets: tuple[int, ...]) -> list[tuple[int, int]]:
    """Features and outcomes of every kind, first of the class factor, then of the group factor."""
    return [(n, CLASSES) for n in (*buckets, TYPES, 1)] + [(n, GROUPS) for n in (*buckets, CLASSES)]


def _split(flat: np.ndarray, buckets: tuple[int, ...]) -> dict:
    """The tables of both factors as views of one vector."""
    tables, at = [], 0
    for n, outcomes in _kinds(buckets):
        tables.append(flat[at:at + n * outcomes].reshape(n, outcomes))
        at += n * outcomes
    return {"class_weights": tables[:len(buckets) + 2], "group_weights": tables[len(buckets) + 2:]}


def train(table: DataFrame, classes: np.ndarray, buckets: tuple[int, ...], tasks: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of both factors, trained on the training texts of a chunk table by ``tasks`` tasks a round."""
    spark = table.sparkSession
    weights = np.zeros(sum(n * outcomes for n, outcomes in _kinds(buckets)), np.float32)
    for number in range(rounds):
        shared = spark.sparkContext.broadcast((weights, classes))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            start, class_of = shared.value
            now, n = start.copy(), 0
            model = {"classes": class_of, "buckets": buckets, **_split(now, buckets)}
            squares = [[np.full(len(w), FIRST_SQUARES, np.float32) for w in model[k]]
                       for k in ("class_weights", "group_weights")]
            for row in _rows(batches):
                ids, sizes = _tokens(row)
                begins = np.cumsum(sizes) - sizes
                mine = np.flatnonzero(~np.array(row["held"], bool) & (np.arange(len(sizes)) % rounds == number))
                for a, b in _spans(sizes[mine]):
                    some = mine[a:b]
                    part = ids[ranges(begins[some], sizes[some])]
                    for s, (w, features, target, _) in zip(squares, _factors(model, row, part, sizes[some])):
                        gradient_steps(w, s, features, target)
                    n += len(part)
            if n:
                change = (now - start) * np.float32(n)
                cut = np.linspace(0, len(change), SLICES + 1).astype(int)
                group = TaskContext.get().partitionId() % PARTIALS
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(SLICES), pa.int32()), pa.array([group] * SLICES, pa.int32()),
                     pa.array([n] * SLICES, pa.int64()),
                     pa.array([change[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())],
                    ["slice", "grp", "n", "vector"])

        changes = table.select("held", "sizes", "ids", "n_ids", "words", "types").coalesce(tasks) \
            .mapInArrow(run, "slice int, grp int, n long, vector binary")
        partial = _sum_changes(changes, ["slice", "grp"]).withColumn("grp", F.lit(0))
        total = _one_by_one(spark, lambda: alone(spark, _sum_changes(partial, ["slice"]).orderBy("slice").collect))
        if total:
            change = np.concatenate([np.frombuffer(r.vector, np.float32) for r in total])
            weights = weights + change / np.float32(total[0].n)
        shared.unpersist()
    return weights


def word_counts(table: DataFrame) -> DataFrame:
    """``word, type, n``: training tokens of every word that has any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            n = _array(row, "counts", np.uint32)
            at = np.flatnonzero(n)
            for i in range(0, len(at), 1 << 16):
                some = at[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_array(row, "words", np.int64)[some]), pa.array(_array(row, "types", np.uint8)[some].astype(np.int16)),
                     pa.array(n[some].astype(np.int64))], ["word", "type", "n"])

    return table.select("words", "types", "counts").mapInArrow(run, "word long, type short, n long") \
        .groupBy("word").agg(F.max("type").alias("type"), F.sum("n").alias("n"))


def cell_totals(counts: DataFrame, classes: np.ndarray) -> dict:
    """Training tokens and known words of every cell (class and group)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, TYPES * GROUPS), np.int64)
        for batch in batches:
            cell = batch.column("type").to_numpy().astype(np.int64) * GROUPS + \
                word_groups(batch.column("word").to_numpy().view(np.uint64))
            total[0] += np.bincount(cell, batch.column("n").to_numpy(), minlength=total.shape[1]).astype(np.int64)
            total[1] += np.bincount(cell, minlength=total.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.shape[1])), pa.array(total[0]), pa.array(total[1])],
                                         ["cell", "n", "v"])

    n, v = np.zeros((CLASSES, GROUPS), np.int64), np.zeros((CLASSES, GROUPS), np.int64)
    for r in counts.mapInArrow(run, "cell long, n long, v long").groupBy("cell") \
            .agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        at = classes[r.cell // GROUPS], r.cell % GROUPS
        n[at] += r.n
        v[at] += r.v
    # The end token is alone in its class, so it has no group.
    n[0], v[0] = n[0].sum(), v[0].sum()
    return {"cell_n": n, "cell_v": v, "n": int(n[1:].sum() + n[0, 0]), "v": int(v[1:].sum() + v[0, 0])}


def chunk_counts(table: DataFrame, counts: DataFrame) -> DataFrame:
    """``chunk, word, n``: the count of every known word of every chunk. A
    common word has a row for each chunk, on the side of the join that may be
    split; the other side has one row per word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words = _array(row, "words", np.int64)
            for i in range(0, len(words), 1 << 16):
                some = words[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), row["chunk"])), pa.array(some)], ["chunk", "word"])

    wanted = table.select("chunk", "words").mapInArrow(run, "chunk long, word long")
    return wanted.join(counts.select("word", "n"), "word").select("chunk", "word", "n")


def _cells(table: DataFrame) -> np.ndarray:
    """Counts of neighbouring types over all training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TYPES * TYPES, np.int64)
        for row in _rows(batches):
            total[_array(row, "cells", np.int32)] += _array(row, "cell_n", np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["cell", "n"])

    out = np.zeros(TYPES * TYPES, np.int64)
    summed = table.select("cells", "cell_n").mapInArrow(run, "cell int, n long") \
        .groupBy("cell").agg(F.sum("n").alias("n"))
    for r in _one_by_one(table.sparkSession, summed.collect):
        out[r.cell] = r.n
    return out.reshape(TYPES, TYPES)


def learn(table: DataFrame, counts: DataFrame) -> dict:
    """The model of a chunk table's training texts: a dict of arrays."""
    tokens, size = table.agg(F.coalesce(F.sum("n_ids"), F.lit(0)),
                             F.coalesce(F.sum(F.octet_length("ids") + F.octet_length("words")), F.lit(0))).first()
    classes, buckets = type_classes(_cells(table)), buckets_for(tokens)
    weights = train(table, classes, buckets, max(1, -(-size // TASK_BYTES)))
    return {"classes": classes, "buckets": buckets, "weights": weights, **cell_totals(counts, classes)}


def token_scores(model: dict, row: dict, ids: np.ndarray, sizes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """log10 probability of every position of a chunk; ``count``: of its words."""
    words, types = _array(row, "words", np.uint64), _array(row, "types", np.uint8)
    cell = model["classes"][types], word_groups(words)
    out = np.log10((count + 1) / (model["cell_n"] + model["cell_v"] + 1)[cell])[ids]
    ends = np.cumsum(sizes)
    for a, b in _spans(sizes):
        lo, hi = ends[a] - sizes[a], ends[b - 1]
        for weights, features, outcome, meant in _factors(model, row, ids[lo:hi], sizes[a:b]):
            p = np.empty(len(outcome))
            for i in range(0, len(outcome), BATCH):
                y = outcome[i:i + BATCH]
                z = scores(weights, [f[i:i + BATCH] for f in features])
                p[i:i + BATCH] = z[np.arange(len(y)), y] / z.sum(axis=1)
            out[lo:hi][meant] += np.log10(p)
    return out


def score_chunks(table: DataFrame, counts: DataFrame, model: dict) -> DataFrame:
    """Every document's numbers; ``counts`` as of ``chunk_counts``."""
    shared = table.sparkSession.sparkContext.broadcast(model)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model = shared.value | _split(shared.value["weights"], shared.value["buckets"])
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        known, n = right.column("word").to_numpy().view(np.uint64), right.column("n").to_numpy()
        out = []
        for row in _rows(left.to_batches()):
            ids, sizes = _tokens(row)
            words = _array(row, "words", np.uint64)  # in ascending order
            count = np.zeros(len(words), np.int64)
            count[np.searchsorted(words, known)] = n
            base = np.log10((count + 1) / (model["n"] + model["v"] + 1))
            doc = np.repeat(np.arange(len(sizes)), sizes)
            total = lambda v: np.bincount(doc, v, minlength=len(sizes))
            out.append(pa.Table.from_arrays(
                [pa.array(row["doc_ids"], kinds[0]), pa.array(row["held"], kinds[1]), pa.array(sizes),
                 pa.array(total((count > 0).astype(float)[ids]).astype(np.int64)), pa.array(total(base[ids])),
                 pa.array(total(token_scores(model, row, ids, sizes, count)))], names))
        return pa.concat_tables(out) if out else pa.Table.from_arrays([pa.array([], k) for k in kinds], names)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return table.select("chunk", "doc_ids", "held", "sizes", "ids", "n_ids", "words", "types").groupBy("chunk") \
        .cogroup(counts.groupBy("chunk")).applyInArrow(run, schema)


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    of every document, learned from those that ``held_out`` does not name.

    Tokens are words without ASCII white space, A-Z lower-cased, and one end
    token. ``base_score`` is the add-one unigram log10 probability, ``score``
    the model's. Null and empty texts are one end token; repeated rows count
    and score each; a null ``held_out`` is training; without training texts
    counts are zero; an empty table gives no rows. Only ``doc_id`` and ``text``
    are read. Words are told apart by a 64-bit hash.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(held_out, F.lit(False)).alias("held"))
    table = stored(chunks(rows), "chunks")
    counts = _one_by_one(spark, lambda: alone(spark, lambda: stored(word_counts(table), "word-counts")))
    model = learn(table, counts)
    found = _one_by_one(spark, lambda: alone(spark, lambda: stored(chunk_counts(table, counts), "chunk-counts")))
    return score_chunks(table, found, model).withColumn("train_tokens", F.lit(model["n"]).cast("long"))
