"""Merkle manifest of a dataset: one digest that vouches for every row.

Rows become leaves, leaves of a group (say a language) a tree of fixed arity,
and the groups' subroots one more tree. Every level is one table of nodes
``tree, idx, n, h``: the tree, the place in the level from 0, the number of
nodes that the tree has in the level, the digest. A level is climbed by a
sibling-shift self-join: each node computes the indices of its siblings, the
node at ``idx`` shifted by 1 .. arity-1 slots in its run of ``arity`` nodes
(an XOR with 1 where the arity is 2), and fetches their digests by an equi-join
on tree and index. Every node then knows what stands left and right of it in
its run, which is its part of a proof, and the nodes in slot zero emit their
parents, the next level. Levels shrink by the arity, so the rounds are
logarithmic and the first one dominates.

Proofs go the other way: parents hand their path to their children, joined by
tree and parent index. No row, run or tree is ever collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored

ARITY = 8
#: Columns of ``documents`` that make a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, ``:`` and the value,
    so that no two different rows have the same concatenation."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return digest(*[framed(f) for f in fields])


def tree_key(group: Column) -> Column:
    """Sortable key of a group that is never null: null sorts first, then the
    values by their UTF-8 bytes."""
    text = group.cast("string")
    return F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), text))


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``idx``, the place of each row in its ``tree`` from 0, and ``n``, the
    tree's rows.

    Rows are dealt into ranges of (tree, order); a row's place is the number of
    rows in its tree's earlier ranges plus its place in its own. So one tree may
    hold all rows without being sorted in one task; windows see a range, or one
    count for each range.
    """
    rows = stored(rows, "merkle-rows")  # the ranges are sampled first, which would make every row twice
    dealt = stored(rows.repartitionByRange("tree", *order).withColumn("range", F.spark_partition_id()), "merkle-ranges")
    counts = dealt.groupBy("tree", "range").agg(F.count("*").alias("size"))
    before = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("tree", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
                           F.sum("size").over(Window.partitionBy("tree")).alias("n"))
    place = F.row_number().over(Window.partitionBy("tree", "range").orderBy(*order))
    return dealt.withColumn("place", place).join(starts, ["tree", "range"]) \
        .withColumn("idx", F.col("start") + F.col("place") - 1).drop("range", "place", "start")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``tree, idx, n, h, left, right``: the digests that stand before and after
    each node in its run, concatenated. ``nodes``: ``tree, idx, n, h``."""
    idx, shift, node = F.col("idx"), F.col("shift"), F.col("node")
    sibling = idx.bitwiseXOR(shift) if arity == 2 else idx - idx % arity + (idx + shift) % arity
    wants = nodes.select("tree", "idx", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(arity - 1).cast("long"))).alias("shift")) \
        .select("tree", idx.alias("node"), sibling.alias("idx"), "n").where("idx < n")
    runs = wants.join(nodes.select("tree", "idx", "h"), ["tree", "idx"]).groupBy("tree", "node").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("idx", "h"))).alias("run"))

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("run", keep), lambda x: x.h), "")

    return runs.select("tree", node.alias("idx"), "n", F.filter("run", lambda x: x.idx == node)[0].h.alias("h"),
                       joined(lambda x: x.idx < node).alias("left"), joined(lambda x: x.idx > node).alias("right"))


@dataclass
class Forest:
    """Levels of a forest from the leaves up, and the root of every tree.

    ``levels[i]`` holds ``tree, idx, n, h, left, right`` of trees with several
    nodes in level i; ``roots`` holds ``tree, h, height`` (levels below it).
    """
    levels: list[DataFrame]
    roots: DataFrame
    arity: int

    def climb(self, leaves: DataFrame, base: DataFrame) -> DataFrame:
        """``leaves`` (``tree, idx, n`` and others) with the other columns of
        ``base`` (``tree, height, path`` and others, a row per tree) and
        ``path``: the siblings on the way from the leaf to the root, nearest
        first, followed by the tree's path in ``base``."""
        def up(level: DataFrame) -> DataFrame:
            return level.withColumn("up", F.floor(F.col("idx") / F.lit(self.arity)))

        root = base.withColumn("idx", F.lit(0).cast("long"))
        above = root.where(F.col("height") == len(self.levels))
        for i in range(len(self.levels) - 1, -1, -1):
            level = self.levels[i].select("tree", "idx", F.array(F.struct("left", "right")).alias("step"))
            if i == 0:
                level = leaves.where("n > 1").join(level, ["tree", "idx"])
            parents = above.withColumnRenamed("idx", "up").withColumnRenamed("path", "rest")
            above = up(level).join(parents, ["tree", "up"]).withColumn("path", F.concat("step", "rest")) \
                .drop("step", "rest", "up")
            if i > 0:
                above = above.unionByName(root.where(F.col("height") == i))
        single = leaves.where("n = 1").join(base, "tree")
        return above.unionByName(single) if self.levels else single


def grow(nodes: DataFrame, arity: int = ARITY) -> Forest:
    """Build every tree of ``nodes`` (``tree, idx, n, h``) up to its root; a
    tree of one node is its own root."""
    if arity < 2:
        raise ValueError("a run has two nodes at least")

    def finished(level: DataFrame, height: int) -> DataFrame:
        return level.where("n = 1").select("tree", "h", F.lit(height).alias("height"))

    roots, levels, most = finished(nodes, 0), [], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        level = stored(with_siblings(nodes.where("n > 1"), arity), "merkle-level")
        nodes = level.where(F.col("idx") % arity == 0).select(
            "tree", F.floor(F.col("idx") / F.lit(arity)).alias("idx"), F.ceil(F.col("n") / F.lit(arity)).alias("n"),
            digest(F.col("left"), F.col("h"), F.col("right")).alias("h"))
        levels.append(level)
        roots = roots.union(finished(nodes, len(levels)))
        most = -(-most // arity)
    return Forest(levels, roots, arity)


def manifest(rows: DataFrame, arity: int = ARITY) -> DataFrame:
    """Prove every row of ``rows`` (``tree, ord, leaf`` and others): adds
    ``subroot``, ``root`` and ``path``, an array of (left, right) digests from
    the leaf's run up to the root of roots.

    Leaves of a tree stand in the order of ``ord`` (null first), then by digest;
    repeated rows are leaves of their own. Trees stand in the order of their
    keys. An empty table gives no rows.
    """
    leaves = stored(numbered(rows, [F.col("ord").asc_nulls_first(), F.col("leaf").asc()]), "merkle-leaves")
    forest = grow(leaves.withColumnRenamed("leaf", "h").select("tree", "idx", "n", "h"), arity)
    subroots = stored(forest.roots, "merkle-subroots")
    tops = stored(numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "h", "height"),
                           [F.col("key").asc()]), "merkle-tops")
    crown = grow(tops.select("tree", "idx", "n", "h"), arity)
    base = crown.roots.withColumnRenamed("h", "root").withColumn(
        "path", F.expr("cast(array() as array<struct<left: string, right: string>>)"))
    climbed = crown.climb(tops.withColumnRenamed("height", "below"), base)
    trees = stored(climbed.select(F.col("key").alias("tree"), F.col("below").alias("height"), F.col("h").alias("subroot"),
                                  "root", "path"), "merkle-trees")
    return forest.climb(leaves, trees).drop("height")


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and its proof."""
    return F.aggregate(path, leaf, lambda h, step: digest(step.left, h, step.right))


def proof_digest(path: Column) -> Column:
    """One digest over all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s.left, s.right)), ""), 256)


def document_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id",
                      arity: int = ARITY) -> DataFrame:
    """``tree, ord, leaf, subroot, root, path`` of every document: leaves are
    digests of ``fields`` in one tree per ``group``, in the order of ``order``.

    Null fields, empty and very long texts are framed apart from each other.
    Documents without an id come first in their tree; equal ids are ordered by
    digest; repeated rows stay. Columns beyond ``fields`` are not read. An
    empty table gives no rows.
    """
    rows = docs.select(tree_key(F.col(group)).alias("tree"), F.col(order).alias("ord"),
                       leaf_digest([F.col(f) for f in fields]).alias("leaf"))
    return manifest(rows, arity)


def check_tampering(docs: DataFrame, changed: Column, text: Column, arity: int = ARITY) -> DataFrame:
    """Fold the leaf of every document up its proof, after ``text`` took the
    place of the text where ``changed`` holds (null: does not hold).

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.
    Rules for odd rows are those of ``document_manifest``.
    """
    fields = [F.col(f) for f in FIELDS]
    altered = [F.when(F.coalesce(changed, F.lit(False)), text).otherwise(F.col("text")) if f == "text" else F.col(f)
               for f in FIELDS]
    rows = docs.select(tree_key(F.col("lang")).alias("tree"), F.col("doc_id").alias("ord"),
                       leaf_digest(fields).alias("leaf"), leaf_digest(altered).alias("shown"))
    folded = fold(F.col("shown"), F.col("path"))
    return manifest(rows, arity).select(
        F.col("ord").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
