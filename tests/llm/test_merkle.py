import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.llm import merkle
from tidemark.llm.common import table

from .conftest import doc_frame

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(digests, arity):
    levels = [digests]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([sha("".join(level[i:i + arity])) for i in range(0, len(level), arity)])
    return levels


def path_of(levels, i, arity):
    path = []
    for level in levels[:-1]:
        first = i // arity * arity
        path.append(("".join(level[first:i]), "".join(level[i + 1:first + arity])))
        i //= arity
    return path


def plain(rows, arity=merkle.ARITY):
    """The expected rows, from (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for doc_id, source, lang, n_chars, text in rows:
        def leaf(t):
            return sha("".join(map(framed, (doc_id, source, lang, n_chars, t))))
        low = None if text is None else text.translate(str.maketrans(UPPER, UPPER.lower()))
        changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        groups.setdefault(lang, []).append((doc_id, leaf(text), leaf(low if changed else text)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {g: levels_of([r[1] for r in groups[g]], arity) for g in order}
    crown = levels_of([trees[g][-1][0] for g in order], arity)
    out = []
    for number, g in enumerate(order):
        for i, (doc_id, leaf, shown) in enumerate(groups[g]):
            path = path_of(trees[g], i, arity) + path_of(crown, number, arity)
            h = shown
            for left, right in path:
                h = sha(left + h + right)
            out.append((doc_id, leaf, trees[g][-1][0], crown[-1][0],
                        sha("".join(left + right for left, right in path)), h, h == crown[-1][0]))
    return Counter(out)


def found(docs, arity=merkle.ARITY):
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    out = merkle.check_tampering(docs, changed, F.translate("text", UPPER, UPPER.lower()), arity)
    return Counter(tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                                "verified").collect())


def fields(docs):
    return [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_equals_plain_version_on_odd_rows(spark, odd_docs, arity):
    docs = doc_frame(spark, [(i, None if t is None else t.replace("w1", "W1")) for i, t in odd_docs])
    by_id = F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") == 21, "zz").otherwise(F.col("lang"))
    docs = docs.withColumn("lang", by_id)
    assert found(docs, arity) == plain(fields(docs), arity)


def test_many_trees_in_the_order_of_bytes(spark):
    langs = [None, "", "a", "Z", "é", "ￗ", "𐀀", "aa", "+", "-", "b"]
    rows = [(i, "s", langs[i % len(langs)], i, f"Text {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(docs) == plain(rows)


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65, 73])
def test_sizes_around_the_arity(spark, n):
    rows = [(i, None, "en", None, f"Text {i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(docs) == plain(rows)


def test_every_change_shows(spark):
    """Nothing but the original row folds to the root."""
    docs = table(spark, SF_SMALL, "documents")
    out = merkle.check_tampering(docs, F.lit(True), F.concat("text", F.lit(" ")))
    assert out.where("verified").count() == 0
    assert merkle.check_tampering(docs, F.lit(None).cast("boolean"), F.lit("x")).where("not verified").count() == 0
    assert out.select("root").distinct().count() == 1


def test_empty_table(spark):
    docs = table(spark, SF_SMALL, "documents").where("false")
    assert found(docs) == Counter()


def test_document_manifest_folds_to_the_root(spark):
    docs = table(spark, SF_SMALL, "documents")
    proofs = merkle.document_manifest(docs, fields=("doc_id", "text"), group="source")
    assert proofs.count() == docs.count()
    assert proofs.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
