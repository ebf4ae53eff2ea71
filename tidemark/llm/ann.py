"""Approximate nearest neighbours over learned partitions.

A bounded sample gives a neighbour graph, which is cut into balanced parts by
recursive spectral bisection with swaps. A small network learns to name the
parts that hold a vector's neighbours. It puts every row of the table into its
most probable part and sends each query to several; the rows found there are
ranked by their exact inner product. The number of parts a query visits is the
smallest that reaches the wanted recall on a part of the sample that the
network has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored

NEIGHBOURS = 20
#: Rows that the partition is fitted on, at most.
SAMPLE = 8192
#: Sample rows per part, which sets the number of parts; and most parts.
PART_ROWS = 128
MOST_PARTS = 64
#: Edges per vector in the graph, and hidden units of the network.
GRAPH_DEGREE = 10
HIDDEN = 128
EPOCHS = 30
#: Recall that the number of visited parts must reach on held-out sample rows.
WANTED_RECALL = 0.95
#: Vectors in a block of the index, and queries in a block of queries.
BLOCK_ROWS = 2048
QUERY_ROWS = 512


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` largest scores of each row, in any order."""
    k = min(k, scores.shape[1])
    return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` other rows with the largest inner product, for each row."""
    return _nearest(x, 0, k)


def _nearest(x: np.ndarray, first: int, k: int) -> np.ndarray:
    """The ``k`` other rows with the largest inner product, for the rows from
    ``first`` on, in blocks of bounded memory."""
    out = []
    for i in range(first, len(x), 256):
        s = x[i:i + 256] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out.append(_top(s, k))
    return np.concatenate(out)


def _bisect(edges: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Balanced halves of a graph: a median cut of its second eigenvector,
    then swaps of the pairs of vertices that gain most."""
    u, v = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
    degree = np.bincount(u, minlength=n) + 1e-9
    root = np.sqrt(degree)
    trivial = root / np.linalg.norm(root)
    x = rng.standard_normal(n)
    for _ in range(80):
        x -= trivial * (trivial @ x)
        x = x + np.bincount(u, x[v] / (root[u] * root[v]), minlength=n)
        x /= np.linalg.norm(x) + 1e-300
    side = np.zeros(n, bool)
    side[np.argsort(x / root, kind="stable")[n // 2:]] = True
    for _ in range(10):
        away = np.bincount(u, side[u] != side[v], minlength=n)
        gain = 2 * away - degree
        a, b = np.flatnonzero(~side), np.flatnonzero(side)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        swaps = int((gain[a[:m]] + gain[b[:m]] > 0).sum()) // 2
        if not swaps:
            break
        side[a[:swaps]], side[b[:swaps]] = True, False
        if (np.bincount(u, side[u] != side[v], minlength=n)).sum() >= away.sum():
            side[a[:swaps]], side[b[:swaps]] = False, True
            break
    return side


def balanced_partition(graph: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Part of every vertex; ``parts`` is a power of two, sizes differ by few."""
    n = len(graph)
    label = np.zeros(n, np.int64)
    edges = np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.reshape(-1)], axis=1)
    rng = np.random.default_rng(seed)
    count = 1
    while count < parts:
        for p in range(count):
            mine = np.flatnonzero(label == p)
            at = np.full(n, -1)
            at[mine] = np.arange(len(mine))
            inner = at[edges]
            side = _bisect(inner[(inner >= 0).all(1)], len(mine), rng)
            label[mine[side]] += count
        count *= 2
    return label


@dataclass
class Router:
    """Two-layer network from a vector to part probabilities, and the number
    of parts that a query visits."""
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    visits: int = 1

    @property
    def parts(self) -> int:
        return self.w2.shape[1]

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train_router(x: np.ndarray, target: np.ndarray, seed: int = 0) -> Router:
    """Fit part probabilities to ``target`` rows by Adam on cross-entropy."""
    rng = np.random.default_rng(seed)
    d, m = x.shape[1], target.shape[1]
    net = Router(rng.standard_normal((d, HIDDEN)) * np.sqrt(2.0), np.zeros(HIDDEN),
                 rng.standard_normal((HIDDEN, m)) * np.sqrt(1.0 / HIDDEN), np.zeros(m))
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    weights = [net.w1, net.b1, net.w2, net.b2]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step, batch = 0, 128
    total = EPOCHS * -(-len(x) // batch)
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            rows = order[i:i + batch]
            h = np.maximum(unit[rows] @ net.w1 + net.b1, 0)
            z = h @ net.w2 + net.b2
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            dz = (p - target[rows]) / len(rows)
            dh = (dz @ net.w2.T) * (h > 0)
            grads = [unit[rows].T @ dh, dh.sum(0), h.T @ dz, dz.sum(0)]
            step += 1
            rate = 0.004 * (1 - step / (total + 1))
            for w, g, a, b in zip(weights, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return net


def fit(sample: np.ndarray, k: int = NEIGHBOURS) -> Router:
    """Partition the neighbour graph of a sample and learn to route to it."""
    x = np.unique(sample, axis=0)
    rng = np.random.default_rng(1)
    x = x[rng.permutation(len(x))]
    parts = min(MOST_PARTS, 1 << max(0, (len(x) // PART_ROWS)).bit_length() >> 1)
    parts = max(1, parts)
    if parts == 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbour_graph(x, min(GRAPH_DEGREE, len(x) - 1))
    label = balanced_partition(graph, parts)
    # A vector's target: the parts of its neighbours and its own.
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].reshape(-1)), 1.0)
    target[np.arange(len(x)), label] += graph.shape[1] / 2
    target /= target.sum(1, keepdims=True)
    seen = len(x) * 7 // 8
    trial = train_router(x[:seen], target[:seen])
    net = train_router(x, target)
    net.visits = _visits(trial, x, seen, k)
    return net


def _visits(net: Router, x: np.ndarray, seen: int, k: int) -> int:
    """Parts to visit so that rows after ``seen`` find the wanted share of
    their nearest rows."""
    home = net.logits(x).argmax(1)
    near = _nearest(x, seen, min(k, len(x) - 1))
    place = np.empty((len(near), net.parts), np.int64)
    order = np.argsort(-net.logits(x[seen:]), axis=1, kind="stable")
    np.put_along_axis(place, order, np.arange(net.parts)[None, :], axis=1)
    wanted = np.sort(place[np.arange(len(near))[:, None], home[near]].reshape(-1))
    return int(wanted[min(len(wanted) - 1, int(np.ceil(WANTED_RECALL * len(wanted))))]) + 1


def usable_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, e``: one vector of doubles per id. Rows without an id, null
    and zero vectors, and vectors with null or non-finite components take no
    part; of different vectors with one id the smallest counts."""
    e = F.col(column).cast("array<double>")
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e"))
            .where("vec_id is not null and e is not null").where(fine)
            .where(F.exists("e", lambda x: x != 0))
            .groupBy("vec_id").agg(F.min("e").alias("e")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an array column, shorter ones padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dim))
    out[np.arange(dim)[None, :] < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _packed(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(x, np.float64)], pa.binary())


def _assign(rows: DataFrame, router, dim: int) -> DataFrame:
    """``vec_id, vec, part``: every vector in its most probable part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("e"), dim)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), _packed(x),
                 pa.array(Router(*router.value).logits(x).argmax(1).astype(np.int32))], ["vec_id", "vec", "part"])

    return rows.mapInArrow(run, "vec_id long, vec binary, part int")


def _route(queries: DataFrame, router, dim: int, sizes: np.ndarray, k: int) -> DataFrame:
    """``vec_id, vec, parts``: the parts that each query visits, enough of them
    to hold ``k`` rows besides the query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Router(*router.value)
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("vec").to_pylist()), np.float64).reshape(-1, dim)
            order = np.argsort(-net.logits(x), axis=1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            visits = np.maximum((held < k + 1).sum(1) + 1, net.visits)
            parts = [o[:v][sizes[o[:v]] > 0].tolist() for o, v in zip(order, visits)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vec"), pa.array(parts, pa.list_(pa.int32()))],
                ["vec_id", "vec", "parts"])

    return queries.select("vec_id", "vec").mapInArrow(run, "vec_id long, vec binary, parts array<int>")


def _rank_blocks(pairs: DataFrame, dim: int, k: int) -> DataFrame:
    """The ``k`` best rows of a block for every query of a query block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read(scalar):
            rows = scalar.values
            ids = rows.field("vec_id").to_numpy(zero_copy_only=False)
            return ids, np.frombuffer(b"".join(rows.field("vec").to_pylist()), np.float64).reshape(-1, dim)

        for batch in batches:
            for i in range(batch.num_rows):
                ids, base = read(batch.column("base")[i])
                asked, q = read(batch.column("queries")[i])
                order = np.argsort(ids, kind="stable")  # ties go to the smaller id
                ids, base = ids[order], base[order]
                s = q @ base.T
                s[asked[:, None] == ids[None, :]] = -np.inf
                best = np.argsort(-s, axis=1, kind="stable")[:, :k]
                value = np.take_along_axis(s, best, axis=1)
                kept = value > -np.inf
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(asked, best.shape[1])[kept.reshape(-1)]),
                     pa.array(ids[best][kept]), pa.array(value[kept])], ["query_id", "vec_id", "score"])

    return pairs.select("base", "queries").mapInArrow(run, "query_id long, vec_id long, score double")


def search(vectors: DataFrame, query_condition: str, k: int = NEIGHBOURS,
           sample_rows: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that meets
    ``query_condition`` (on ``vec_id``), the ``k`` nearest rows found, by
    inner product, ties to the smaller id, the query itself left out.

    Every usable row is indexed (see ``usable_vectors``); shorter vectors count
    as padded with zeros; repeated rows count once; with ``k`` or fewer
    candidates all are returned; an empty table gives no rows. Only ``vec_id``
    and ``embedding`` are read. A crowded part is held in blocks of about
    ``BLOCK_ROWS`` rows, and its queries in blocks too, so no task holds a
    whole part.
    """
    spark = vectors.sparkSession
    rows = stored(usable_vectors(vectors), "vectors")
    dim = rows.agg(F.max(F.size("e"))).first()[0] or 1
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("e").toArrow()
    sample = _matrix(chosen.column("e"), dim) if chosen.num_rows else np.zeros((1, dim))
    net = fit(sample, k)
    # Plain arrays: what is broadcast must not need this package on executors.
    router = spark.sparkContext.broadcast((net.w1, net.b1, net.w2, net.b2, net.visits))
    index = stored(_assign(rows, router, dim), "index")
    sizes = np.zeros(net.parts, np.int64)
    for r in index.groupBy("part").agg(F.count("*").alias("n")).collect():
        sizes[r.part] = r.n

    def per_part(values: np.ndarray):
        return F.get(F.array(*[F.lit(int(v)) for v in values]), F.col("part"))

    row = F.struct("vec_id", "vec")
    blocks = np.maximum(1, -(-sizes // BLOCK_ROWS))
    base = index.groupBy("part", F.pmod(F.xxhash64("vec_id"), per_part(blocks)).cast("int").alias("block")) \
        .agg(F.collect_list(row).alias("base"))
    routed = stored(_route(index.where(query_condition), router, dim, sizes, k)
                    .select("vec_id", "vec", F.explode("parts").alias("part")), "routed")
    asked = np.zeros(net.parts, np.int64)
    for r in routed.groupBy("part").agg(F.count("*").alias("n")).collect():
        asked[r.part] = r.n
    groups = np.maximum(1, -(-asked // QUERY_ROWS))
    queries = routed.groupBy("part", F.pmod(F.xxhash64("vec_id", F.lit(3)), per_part(groups)).alias("group")) \
        .agg(F.collect_list(row).alias("queries")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), (per_part(blocks) - 1).cast("int"))))
    found = _rank_blocks(base.join(queries, ["part", "block"]), dim, k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
