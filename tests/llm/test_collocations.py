import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from tidemark.llm import collocations
from tidemark.llm.common import table

from .conftest import doc_frame

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def plain(rows, longest=5, least=100, best=2000, covered=100):
    """The expected rows, from (lang, text), with integers of any size."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(str.maketrans(UPPER, UPPER.lower()))):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            f.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = {}
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    held[p[i:i + size]] = max(a, held.get(p[i:i + size], 0))
        scored = []
        for p, a in candidates.items():
            if p in held and 100 * held[p] >= covered * a:
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def found(docs, **options):
    columns = ("grp", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r) for r in collocations.collocations(docs, **options).select(*columns).collect())


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)] + ["É", "of", "The", "a" * 300]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 80)):
            parts.append(rng.choice(["red hot chili pepper sauce", "New York city", "new York",
                                     " ".join(rng.choices(words, k=rng.randrange(1, 9)))]))
            parts.append(rng.choice([" ", ", ", ". ", "\n", "\t", ";", "\x0b", " \x1c ", " ", "  "]))
        rows.append(([None, "und", "en", "de"][i % 4], "".join(parts)))
    return rows + [("en", None), (None, ""), ("fr", " .\n"), ("de", rows[3][1]), ("de", rows[3][1])]


@pytest.mark.parametrize("options", [{"least": 5}, {"least": 2, "longest": 3, "best": 7}, {"least": 3, "covered": 60},
                                     {"least": 5, "buckets": 64}])
def test_equals_plain_version(spark, prose, options):
    docs = spark.createDataFrame(prose, "lang string, text string")
    expected = plain(prose, **{k: v for k, v in options.items() if k != "buckets"})
    assert expected and found(docs, **options) == expected


def test_odd_rows_and_clashing_columns(spark, odd_docs):
    docs = doc_frame(spark, odd_docs)
    assert found(docs) == plain([("en", t) for _, t in odd_docs])


def test_given_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    assert found(docs, least=20) == plain([tuple(r) for r in docs.select("lang", "text").collect()], least=20)


def test_scores_beyond_64_bits(spark):
    """Counts of a corpus far larger than can be built here."""
    a, n, l, r = 9_000_000_011, 12_345_678_901_234, 9_000_000_017, 9_100_000_123
    row = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    assert row.select(collocations._score()).first()[0] == 1000 * a * n // (l * r)


def test_empty_table(spark):
    assert found(table(spark, SF_SMALL, "documents").where("false")) == []


def test_words_of_a_slice():
    texts = pa.array(["skipped", "One two\tthree. four", None, "", "é.É x\n\ny"]).slice(1)
    codes, piece, words, text = collocations.pieces_of(texts)
    assert [words[c].as_py() for c in codes] == ["one", "two", "three", "four", "é", "É", "x", "y"]
    assert np.array_equal(piece == piece[0], [True, True, True] + [False] * 5)
    assert text.tolist() == [0, 0, 0, 0, 3, 3, 3, 3]
