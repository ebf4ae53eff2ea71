"""K-d tree partitioning of documents into shards of near-equal bytes.

Every document is a point in metadata space (source, language, character
count, byte size). A node that must hold k shards is cut at the weighted
quantile floor(k/2)/k of its widest dimension; the cut is found from
histograms that Spark computes for all nodes of a level at once, refined until
the cut is exact to a small part of a shard. Equal texts share one point, so a
group of copies stays in one shard unless it is too large for that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import stored

#: Bytes that every document costs besides its text.
OVERHEAD = 16
#: Histogram bins per node and refinement round.
BINS = 1024
#: A cut is good enough when it misses its goal by this part of a shard.
TOLERANCE = 0.001
#: A group of equal texts larger than a shard is dealt out in pieces of this part of one.
PIECE_PART = 0.05
#: Rows of one shard that one task numbers.
SLOT_ROWS = 50_000
DIMS = ("source", "lang", "n_chars", "size")


@dataclass
class Node:
    """A tree node, numbered as in a heap: the children of n are 2n and 2n + 1."""
    id: int
    first: int  # shards first .. first + count - 1
    count: int
    dim: int = -1  # not cut yet
    cut: int = 0  # keys up to cut go left


def _points(docs: DataFrame) -> DataFrame:
    """One row per document without its text; coordinates in 0..65535."""
    def cat(name: str) -> Column:
        return F.coalesce(F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(65536)),
                          F.lit(0)) if name in docs.columns else F.lit(0).cast("bigint")

    def log(x: Column) -> Column:
        return F.least(F.lit(65535), F.floor(F.log2(F.greatest(x, F.lit(0)) + 1) * 1024)).cast("bigint")

    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    chars = F.col("n_chars") if "n_chars" in docs.columns else F.length("text")
    return docs.select(
        "doc_id", (F.octet_length(raw) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.unhex(F.md5(raw)).alias("grp"),
        cat("source").alias("c0"), cat("lang").alias("c1"),
        log(F.coalesce(chars.cast("bigint"), F.lit(0))).alias("c2"),
        log(F.octet_length(raw)).alias("c3"))


def _key(dim: int) -> Column:
    """Total order of a dimension: coordinate, then the point's hash."""
    return F.shiftleft(F.col(f"c{dim}"), 32) + F.col("tie")


def _lookup(values: dict[int, int], default: int, node: Column) -> Column:
    """The value of a node, from a literal array indexed by node number."""
    size = max(values, default=0) + 1
    listed = F.expr("array(" + ",".join(f"{values.get(i, default)}L" for i in range(size)) + ")")
    return F.coalesce(F.get(listed, node.cast("int")), F.lit(default))


def _place(tree: dict[int, Node]) -> Column:
    """Number of the deepest node on a row's way down the tree."""
    dims = {n.id: n.dim for n in tree.values()}
    cuts = {n.id: n.cut for n in tree.values()}
    keys = F.array(*[_key(d) for d in range(len(DIMS))])

    def step(node: Column, _level: Column) -> Column:
        dim = _lookup(dims, -1, node)
        right = F.get(keys, dim.cast("int")) > _lookup(cuts, 0, node)
        return F.when(dim < 0, node).otherwise(node * 2 + right.cast("bigint"))

    depth = max(tree).bit_length()
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1).cast("bigint"), step)


def _cut_level(units: DataFrame, tree: dict[int, Node], level: list[Node], tolerance: float) -> None:
    """Choose dimension and cut of every node of one level."""
    rows = units.select("*", _place(tree).alias("node"))
    spans = {r.node: r for r in rows.groupBy("node").agg(
        F.sum("w").alias("w"), *[f(f"c{d}").alias(f"{n}{d}") for d in range(len(DIMS))
                                 for n, f in (("lo", F.min), ("hi", F.max))]).collect()}
    # Node: dimension, low key, high key, weight below low, goal.
    open_: dict[int, tuple[int, int, int, int, float]] = {}
    found: dict[int, tuple[int, int]] = {n.id: (0, 0) for n in level}
    for n in level:
        if s := spans.get(n.id):
            dim = max(range(len(DIMS)), key=lambda d: (s[f"hi{d}"] - s[f"lo{d}"], -d))
            open_[n.id] = (dim, s[f"lo{dim}"] << 32, (s[f"hi{dim}"] << 32) + 2**32 - 1, 0,
                           s.w * (n.count // 2) / n.count)
    keys = F.array(*[_key(d) for d in range(len(DIMS))])
    while open_:
        node = F.col("node")
        width = {k: (hi - lo) // BINS + 1 for k, (_, lo, hi, _, _) in open_.items()}
        hist: dict[int, list[tuple[int, int]]] = {}
        counted = (
            rows.where(node.isin(list(open_)))
            .select("node", "w", F.get(keys, _lookup({k: v[0] for k, v in open_.items()}, 0, node)
                                       .cast("int")).alias("key"),
                    _lookup({k: v[1] for k, v in open_.items()}, 0, node).alias("low"),
                    _lookup({k: v[2] for k, v in open_.items()}, 0, node).alias("high"),
                    _lookup(width, 1, node).alias("width"))
            .where("key between low and high")
            .groupBy("node", F.expr("(key - low) div width").alias("bin")).agg(F.sum("w").alias("w")))
        for r in counted.collect():
            hist.setdefault(r.node, []).append((r.bin, r.w))
        for k in list(open_):
            dim, lo, hi, below, goal = open_.pop(k)
            for b, w in sorted(hist[k]):
                if below + w >= goal:
                    left, right = goal - below, below + w - goal
                    start, end = lo + b * width[k], lo + (b + 1) * width[k] - 1
                    if min(left, right) <= tolerance or width[k] == 1:
                        found[k] = (dim, start - 1 if left <= right else end)
                    else:
                        open_[k] = (dim, start, min(hi, end), below, goal)
                    break
                below += w
    for n in level:
        n.dim, n.cut = found[n.id]


def kd_shards(docs: DataFrame, shards: int | None = None,
              target_bytes: int | None = None) -> DataFrame:
    """Place every document: ``doc_id, size, text_crc32, shard, slot``.

    Give the number of shards, or the target bytes of one (then the total
    decides the number). Size is the UTF-8 length of the text (null: 0) plus
    ``OVERHEAD``. Shards hold near-equal bytes; slots count from 0 without gaps
    in each. Equal texts take the coordinates of one point and so share a
    shard, unless the group exceeds a whole shard: it is then dealt out by
    document id. Null or missing metadata sits at coordinate 0, repeated
    rows each get a slot, ties are ordered by a hash, an empty table gives no
    rows, and other columns are ignored.

    The driver holds the tree and, per level, one histogram of ``BINS`` bins
    for each node; both are bounded by the number of shards.
    """
    rows = stored(_points(docs), "kd-rows")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if shards is None:
        shards = max(1, -(-total[0] // target_bytes))
    leaf = max(1.0, total[0] / shards)
    pieces = F.when(F.col("w") <= leaf, 1).otherwise(F.ceil(F.col("w") / F.lit(max(1.0, leaf * PIECE_PART)))).cast("int")
    groups = rows.groupBy("grp").agg(F.sum("size").alias("w"), *[F.min(f"c{d}").alias(f"c{d}") for d in range(len(DIMS))]) \
        .select("grp", pieces.alias("pieces"), "c0", "c1", "c2", "c3")
    placed = rows.select("doc_id", "size", "text_crc32", "grp").join(groups, "grp")
    piece = F.when(F.col("pieces") == 1, F.lit(0)).otherwise(
        F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.col("pieces")))
    placed = stored(placed.select(
        "doc_id", "size", "text_crc32", "c0", "c1", "c2", "c3",
        F.shiftrightunsigned(F.xxhash64("grp", piece), 32).alias("tie")), "kd-points")
    units = stored(placed.groupBy("c0", "c1", "c2", "c3", "tie").agg(F.sum("size").alias("w")), "kd-units")

    tree = {1: Node(1, 0, shards)}
    level = [tree[1]] if shards > 1 and total[1] else []
    while level:
        _cut_level(units, tree, level, TOLERANCE * leaf)
        below = []
        for n in level:
            half = n.count // 2
            below += [Node(2 * n.id, n.first, half), Node(2 * n.id + 1, n.first + half, n.count - half)]
        tree.update((n.id, n) for n in below)
        level = [n for n in below if n.count > 1]
    shard = _lookup({n.id: n.first for n in tree.values()}, 0, F.col("leaf")).cast("int")
    cells = max(1, -(-total[1] // (shards * SLOT_ROWS)))
    out = (placed.select("doc_id", "size", "text_crc32", _place(tree).alias("leaf"),
                         F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(cells)).alias("cell"))
           .withColumn("shard", shard).drop("leaf"))
    counts = out.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32"))
    return (out.withColumn("rank", rank).join(starts, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("start") + F.col("rank") - 1).alias("slot")))


def shard_report(placed: DataFrame) -> DataFrame:
    """Rows and bytes of every shard."""
    return placed.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))


def law_columns(placed: DataFrame) -> DataFrame:
    """Add the law (near-equal bytes) and the shard in a grown set, which this
    law leaves open."""
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast(T.IntegerType()).alias("grown_shard"))
