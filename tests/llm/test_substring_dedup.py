import random

import numpy as np
import pyarrow as pa

from tidemark.llm.common import ranges
from tidemark.llm.substring_dedup import _sequence, anchors, remove_repeats, strip_repeats

from .conftest import doc_frame


def brute(rows, window=50):
    first = {}
    for i, text in rows:
        w = (text or "").encode().split()
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            first[key] = min(first.get(key, 1 << 62), 1 << 62 if i is None else i)
    out = []
    for i, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (1 << 62 if i is None else i):
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def test_equal_windows_choose_equal_anchors():
    random.seed(5)
    for _ in range(60):
        alphabet, window = random.choice([1, 2, 3, 5, 50]), random.choice([10, 20, 50])
        texts = []
        for _ in range(6):
            t = [str(random.randrange(alphabet)) for _ in range(random.randrange(0, 200))]
            if texts and random.random() < .6:
                o = random.choice(texts).split()
                a, b = random.randrange(len(o) + 1), random.randrange(len(t) + 1)
                t[b:b] = o[a:a + 90]
            texts.append(" ".join(t))
        (seq,), begin, n = _sequence(pa.array(texts), (7,))
        starts = ranges(begin, np.maximum(n - window + 1, 0))
        symbols, _, first, last = anchors(seq, starts, window)
        assert (last - first + 1).sum() == len(starts)
        chosen = {}
        for symbol, a, b in zip(symbols, first, last):
            for s in range(a, b + 1):
                assert chosen.setdefault(seq[s:s + window].tobytes(), symbol) == symbol


def test_equals_brute_force(spark, odd_docs):
    rng = random.Random(6)
    rows = [d for d in odd_docs if len(d[1] or "") < 100_000]
    for i in range(40):
        words = [f"{rng.randrange(rng.choice([2, 5, 400]))}" for _ in range(rng.randrange(150))]
        if rng.random() < .7:
            source = (rng.choice(rows)[1] or "").split()
            a = rng.randrange(len(source) + 1)
            b = rng.randrange(len(words) + 1)
            words[b:b] = source[a:a + rng.randrange(40, 90)]
        rows.append((100 + i, "  ".join(words)))
    rng.shuffle(rows)
    got = [tuple(r) for r in remove_repeats(doc_frame(spark, rows)).collect()]
    wanted = brute(rows)
    assert sorted(got, key=str) == wanted
    assert sum(w[2] > 0 for w in wanted) >= 10


def test_rows_keep_their_columns(spark, odd_docs):
    docs = doc_frame(spark, odd_docs)
    out = strip_repeats(docs)
    assert out.columns == docs.columns
    wanted = {w[0]: w for w in brute(odd_docs)}
    texts = dict(odd_docs)
    for r in out.collect():
        if r.doc_id is not None:
            expected = wanted[r.doc_id][3] if wanted[r.doc_id][2] else texts[r.doc_id]
            assert r.text == expected
            assert r.n_chars == (None if expected is None else len(expected))
    assert strip_repeats(docs.limit(0)).collect() == []
    assert remove_repeats(docs.limit(0)).collect() == []


def test_other_windows(spark):
    rows = [(1, "a b c d e"), (2, "x a b c y"), (3, "a b"), (4, "b c d")]
    assert sorted(tuple(r) for r in remove_repeats(doc_frame(spark, rows), window=3).collect()) == brute(rows, 3)
