import random

import numpy as np
import pyarrow as pa

from tidemark.llm.decontaminate import contamination, drop_contaminated, fingerprints, gram_hashes, words_of
from tidemark.llm.common import hashes

from .conftest import doc_frame


def brute(docs, items, span=10):
    windows = {}
    for item, text in items:
        w = words_of((text or "").encode())
        n = min(span, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s:s + n]), set()).add(item)
    out = []
    for i, text in docs:
        w = words_of((text or "").encode())
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        out.append((i, len(w), len(hit), sorted(str(f) for f in found)))
    return sorted(out, key=str)


def frame(spark, items):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in items],
                                 "item_id long, text string, win string, h string")


def test_equal_windows_share_their_fingerprint():
    rng = np.random.default_rng(1)
    words = hashes(pa.array([str(i) for i in range(4)]), 3)[rng.integers(0, 4, 500)]
    prints = fingerprints(words, 10, 10)
    grams = gram_hashes(words, 5)
    assert len(prints) == 491
    assert all(prints[i] == grams[i:i + 6].min() for i in range(491))


def test_equals_brute_force(spark, odd_docs):
    rng = random.Random(8)
    few = [f"q{i}" for i in range(6)]
    items = [(1, " ".join(rng.choices(few, k=40))), (2, "Alpha, beta! GAMMA"), (3, "été-neuf"), (4, None), (5, ""), (6, "..."),
             (7, " ".join(f"w{i}" for i in range(5, 60))), (8, " ".join(f"w{i}" for i in range(30, 70)))]
    docs = [d for d in odd_docs if len(d[1] or "") < 10_000]
    docs += [(100 + i, " ".join(rng.choices(few, k=60))) for i in range(10)]
    docs += [(200, "x alpha BETA; gamma y"), (201, "alpha beta gammas"), (202, "ÉTÉ neuf"), (203, "été neuf"),
             (204, items[0][1]), (205, "pre " + items[6][1] + " " + items[7][1])]
    got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in
           contamination(doc_frame(spark, docs), frame(spark, items)).collect()]
    assert sorted(got, key=str) == brute(docs, items)
    kept = drop_contaminated(doc_frame(spark, docs), frame(spark, items))
    assert kept.columns == doc_frame(spark, docs).columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(str(g[0]) for g in brute(docs, items) if not g[2])


def test_long_texts_and_empty_tables(spark, odd_docs):
    items = [(1, odd_docs[-2][1][-200:])]
    rows = {r.doc_id: r.n_hit for r in contamination(doc_frame(spark, odd_docs), frame(spark, items)).collect()}
    assert rows[30] > 20 and sum(1 for v in rows.values() if v) == 1
    assert contamination(doc_frame(spark, []), frame(spark, items)).collect() == []
    assert {r.n_hit for r in contamination(doc_frame(spark, odd_docs), frame(spark, [])).collect()} == {0}
