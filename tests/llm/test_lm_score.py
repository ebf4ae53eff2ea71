import math
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import lm_score as L

from .conftest import doc_frame

def fold():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def check_counts(rows, out):
    counts = Counter(w for i, t in rows if not is_held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    wanted = sorted(((i, is_held(i), len(w), sum(x in counts for x in w),
                      round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6))
                     for i, w in ((i, tokens(t)) for i, t in rows)), key=str)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out), key=str) == wanted
    assert {r.train_tokens for r in out} == {n}
    assert all(r.score < 0 for r in out)


def test_counts_equal_brute_force_on_odd_rows(spark, odd_docs):
    rows = odd_docs + [(50 + i, f"New{i} UPPER upper Été") for i in range(12)]
    check_counts(rows, L.score(doc_frame(spark, rows), fold()).collect())


def test_small_chunks_give_the_same(spark, odd_docs, monkeypatch):
    rows = [d for d in odd_docs if len(d[1] or "") < 10_000]
    whole = sorted(map(tuple, L.score(doc_frame(spark, rows), fold()).select("doc_id", "base_score", "n_known").collect()), key=str)
    monkeypatch.setattr(L, "CHUNK", 500)
    cut = sorted(map(tuple, L.score(doc_frame(spark, rows), fold()).select("doc_id", "base_score", "n_known").collect()), key=str)
    assert [(a[0], round(a[1], 6), a[2]) for a in whole] == [(a[0], round(a[1], 6), a[2]) for a in cut]


def test_context_helps_on_held_out_texts(spark):
    rng = random.Random(9)
    kinds = [[f"{a}{b}ing" for a in "bcdfg" for b in "aeiou"], [f"{a}{b}ado" for a in "lmnpr" for b in "aeiou"]]
    rows = [(i, " ".join(rng.choices(kinds[i % 2], k=80))) for i in range(300)]
    out = [r for r in L.score(doc_frame(spark, rows), fold()).collect() if r.held_out]
    assert len(out) > 20
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 5 * len(out)


def test_a_context_tells_words_of_one_class_apart(spark):
    # All words have one type, so one class; each is followed by the next.
    ring = [f"{a}{b}ing" for a in "bcdfglmnpr" for b in "aeiou"]
    rng = random.Random(4)
    rows = [(i, " ".join((ring * 3)[k:k + 60])) for i in range(200) for k in [rng.randrange(50)]]
    out = [r for r in L.score(doc_frame(spark, rows), fold()).collect() if r.held_out]
    assert len(out) > 10
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + sum(r.n_tokens for r in out)


def plain_model(model, L=L):
    """log10 probability of a token after its predecessors, one token at a time."""
    split = L._split(model["weights"], model["buckets"])
    mask = (1 << 64) - 1

    def h(x):
        return int(L.mix(np.array([x & mask], np.uint64))[0])

    def kind_of(word):
        return int(L.word_types(pa.array([word.decode()]))[0]) if word else 0

    def name_of(word):
        return int(L.hashes(pa.array([word.decode()]), 5)[0]) if word else int(L._END)

    def softmax(tables, features):
        z = sum(t[f].astype(float) for t, f in zip(tables, features))
        assert np.abs(z).max() <= L.LIMIT
        e = np.exp(z)
        return e / e.sum()

    def log_p(before, word, count):
        one, two = [name_of(before[-k]) if len(before) >= k else int(L._PAD) for k in (1, 2)]
        hashed = [h(one + 1), h(one * 0x9E3779B97F4A7C15 + h(two)), h(two + 2)]
        hashed = [x & (n - 1) & 0xFFFF for x, n in zip(hashed, model["buckets"])]
        kinds = [kind_of(before[-1]) if before else 0]
        c, g = int(model["classes"][kind_of(word)]), h(name_of(word) ^ 0x517CC1B727220A95) % L.GROUPS
        p = softmax(split["class_weights"], [*hashed, *kinds, 0])[c]
        if word:
            mixed = [(x * ((c * 0x9E3B | 1) & 0xFFFF) + c * 0x6D2B) & 0xFFFF & (n - 1) for x, n in zip(hashed, model["buckets"])]
            p *= softmax(split["group_weights"], [*mixed, c])[g]
        return math.log10(p * (count + 1) / (model["cell_n"][c, g] + model["cell_v"][c, g] + 1))

    return log_p


def learned(spark, rows):
    held = F.coalesce(fold(), F.lit(False))
    table = L.stored(L.chunks(doc_frame(spark, rows).withColumn("held", held)), "test-chunks")
    counts = L.stored(L.word_counts(table), "test-counts")
    return table, counts, L.learn(table, counts)


def test_scores_equal_the_model_token_by_token(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(L, "CHUNK", 2000)
    rows = [d for d in odd_docs if len(d[1] or "") < 3000] + [(50 + i, f"New{i} upper Été, upper") for i in range(9)]
    table, counts, model = learned(spark, rows)
    assert table.count() > 3 and np.abs(model["weights"]).max() > 0
    known = Counter(w for i, t in rows if not is_held(i) for w in tokens(t))
    log_p = plain_model(model)
    wanted = []
    for i, t in rows:
        w = tokens(t)
        wanted.append((i, sum(log_p(w[:k], x, known[x]) for k, x in enumerate(w))))
    out = L.score_chunks(table, L.chunk_counts(table, counts), model).select("doc_id", "score").collect()
    got = sorted(map(tuple, out), key=str)
    for (i, a), (j, b) in zip(sorted(got, key=lambda r: (str(r[0]), r[1])), sorted(wanted, key=lambda r: (str(r[0]), r[1]))):
        assert i == j and math.isclose(a, b, rel_tol=1e-4), (i, a, b)


def test_the_model_is_a_distribution(spark):
    """Over the known words and one unknown word for each cell, probabilities sum to one."""
    words = [f"{a}{b}{c}" for a in "bcdf" for b in "aeiou" for c in ("ing", "ado", "s")]
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(words, k=40))) for i in range(60)]
    table, counts, model = learned(spark, rows)
    known = Counter(w for i, t in rows if not is_held(i) for w in tokens(t))
    log_p = plain_model(model)
    for before in ([], [b"being"], [b"fos", b"bado"], [b"never", b"seen"]):
        split = L._split(model["weights"], model["buckets"])
        total = sum(10 ** log_p(before, w, n) for w, n in known.items())
        # What is left belongs to unknown words: one share of every cell, empty cells whole.
        classes = {int(model["classes"][L.word_types(pa.array([w.decode()]))[0]]) for w in known if w}
        assert 0 < total < 1
        assert len(classes) > 1 and len(split["class_weights"]) == len(model["buckets"]) + 2
    rng = np.random.default_rng(2)
    tables = [rng.standard_normal((9, 5)).astype(np.float32) for _ in range(3)]
    features = [rng.integers(0, 9, 50).astype(np.uint16) for _ in range(3)]
    assert np.allclose(L.probabilities(tables, features).sum(axis=1), 1, atol=1e-5)


def test_gradient_steps_raise_the_likelihood():
    rng = np.random.default_rng(1)
    features = [rng.integers(0, 7, 5000).astype(np.uint16), np.zeros(5000, np.uint16)]
    target = (features[0] % 3).astype(np.int64)
    weights = [np.zeros((7, 4), np.float32), np.zeros((1, 4), np.float32)]
    squares = [np.full(7, L.FIRST_SQUARES, np.float32), np.full(1, L.FIRST_SQUARES, np.float32)]
    at = np.arange(len(target))
    likelihood = [np.log(L.probabilities(weights, features)[at, target]).mean()]
    for _ in range(5):
        L.gradient_steps(weights, squares, features, target)
        likelihood.append(np.log(L.probabilities(weights, features)[at, target]).mean())
    assert all(a < b for a, b in zip(likelihood, likelihood[1:]))


def test_sums_of_a_feature_equal_reduceat_to_the_last_bit():
    rng = np.random.default_rng(7)
    for n, kinds in ((1, 1), (5, 9), (8, 1), (9, 1), (3000, 2000), (3000, 300), (3000, 3)):
        f, g = rng.integers(0, kinds, n).astype(np.uint16), rng.standard_normal((n, 32)).astype(np.float32)
        order = np.argsort(f, kind="stable")
        row, start = np.unique(f[order], return_index=True)
        wanted = np.add.reduceat(g[order], start, axis=0)
        got_row, got = L.feature_sums(g, f)
        back = np.argsort(got_row)
        assert np.array_equal(got_row[back], row) and np.array_equal(got[back], wanted), (n, kinds)


def test_reduceat_gets_long_runs_only(monkeypatch):
    runs = []

    class Add:
        @staticmethod
        def reduceat(values, start, **more):
            runs.append((len(start), len(values)))
            return np.add.reduceat(values, start, **more)

    monkeypatch.setattr(L, "np", SimpleNamespace(**{**vars(np), "add": Add}))
    rng = np.random.default_rng(5)
    features = [np.r_[rng.integers(0, 4000, 5000), np.zeros(100)].astype(np.uint16)]
    L.gradient_steps([np.zeros((4000, 4), np.float32)], [np.full(4000, L.FIRST_SQUARES, np.float32)],
                     features, rng.integers(0, 4, 5100))
    assert runs and all(n * 8 < size for n, size in runs)


def test_chunks_and_slices_reach_python_one_at_a_time(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    seen, alone = [], L.alone

    def noted(session, action):
        seen.append(session.conf.get(name))
        return alone(session, action)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    before = spark.conf.get(name)
    monkeypatch.setattr(L, "alone", noted)
    assert L.score(doc_frame(spark, [(i, f"a b{i} c") for i in range(20)]), fold()).count() == 20
    assert seen == ["1"] * (L.ROUNDS + 2) and spark.conf.get(name) == before
    few = spark.range(0, 5, 1, 1).mapInArrow(sizes, "n long")
    assert [r.n for r in L._one_by_one(spark, few.collect)] == [1] * 5


def test_buckets_grow_with_the_corpus():
    sizes = [L.buckets_for(n) for n in (0, 1 << 20, 1 << 25, 1 << 28, 1 << 31, 1 << 60)]
    assert sizes[0] == sizes[1] == L.BUCKETS and sizes[2] == tuple(2 * b for b in L.BUCKETS)
    assert all(a <= b for x, y in zip(sizes, sizes[1:]) for a, b in zip(x, y)) and max(sizes[-1]) == L.MOST_BUCKETS


def test_contexts_stop_at_the_start_of_a_text():
    words = np.arange(1, 7, dtype=np.uint64)
    types = np.arange(1, 7, dtype=np.uint8)
    hashed, before = L.contexts(words, types, np.array([0, 1, 2, 0, 1, 2]), np.array([3, 3]), L.BUCKETS)
    assert all((h[:3] == h[3:]).all() for h in [*hashed, before])
    assert before[:3].tolist() == [0, 1, 2]


def test_word_types_ignore_trailing_punctuation():
    a, b, c = L.word_types(pa.array(["running", "running.", "jogging,"]))
    assert a == b == c and 1 <= a < L.TYPES
    assert len(L.word_types(pa.array(["", ".", "é", "..."]))) == 4


def test_empty_table_and_no_training_texts(spark):
    assert L.score(doc_frame(spark, []), fold()).collect() == []
    held = [i for i in range(100) if is_held(i)][:3]
    out = L.score(doc_frame(spark, [(i, "a b") for i in held]), fold()).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in out] == [(0, 0, 0.0)] * 3
