import numpy as np

from tidemark.llm import ann


def frame(spark, x, ids=None, extra=()):
    rows = [(int(i), [float(c) for c in v], 0, 1.0, 0) for i, v in zip(ids if ids is not None else range(len(x)), x)]
    return spark.createDataFrame(rows + list(extra), "vec_id long, embedding array<float>, part int, score double, block int")


def exact(x, ids, q, k):
    s = x @ x[q]
    order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
    return [int(ids[i]) for i in order]


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 16))
    x = (centres[rng.integers(0, 12, 3000)] + 0.6 * rng.standard_normal((3000, 16))).astype(np.float32)
    x[:600] = x[0]  # a vector with very many copies
    rows = ann.search(frame(spark, x), "vec_id % 20 = 0", sample_rows=2048).collect()
    x = x.astype(float)
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r)
        assert abs(r.score - x[r.query_id] @ x[r.vec_id]) < 1e-9
    assert set(found) == set(range(0, 3000, 20))
    ids = np.arange(3000)
    near = total = 0
    for q, got in found.items():
        assert [r["rank"] for r in got] == list(range(1, 21))
        keys = [(-r.score, r.vec_id) for r in got]
        assert keys == sorted(keys) and q not in [r.vec_id for r in got]
        least = x[exact(x, ids, q, 20)[-1]] @ x[q]
        near += sum(r.score >= least - 1e-9 for r in got)
        total += 20
    assert near / total >= 0.9


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(5)
    x = np.repeat(np.eye(8), 64, axis=0) + 0.05 * rng.standard_normal((512, 8))
    graph = ann.neighbour_graph(x, 8)
    label = ann.balanced_partition(graph, 8)
    assert np.bincount(label, minlength=8).min() >= 60
    assert (label[graph] == label[:, None]).mean() > 0.8


def test_unusable_vectors_take_no_part(spark):
    bad = [(100, None, 0, 1.0, 0), (120, [], 0, 1.0, 0), (140, [0.0, 0.0], 0, 1.0, 0), (160, [1.0, None], 0, 1.0, 0),
           (180, [float("nan"), 1.0], 0, 1.0, 0), (200, [float("inf"), 1.0], 0, 1.0, 0), (None, [1.0, 1.0], 0, 1.0, 0)]
    x = np.array([[1, 0], [0.5, 0.5], [0.5, 0.5], [-1, 0]])
    rows = ann.search(frame(spark, x, [0, 1, 2, 3], bad + [(0, [1.0, 0.0], 9, 2.0, 1)]), "vec_id % 20 = 0").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(rows, key=lambda r: r["rank"])] == [
        (0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 3, -1.0)]


def test_small_and_empty_tables(spark):
    assert ann.search(frame(spark, np.zeros((0, 2))), "vec_id % 20 = 0").collect() == []
    assert ann.search(frame(spark, np.ones((1, 2))), "vec_id % 20 = 0").collect() == []
    # A shorter vector counts as padded with zeros.
    one = frame(spark, [[1.0, 2.0, 3.0]], [0]).union(frame(spark, [[1.0]], [1]))
    assert [(r.vec_id, r.score) for r in ann.search(one, "vec_id % 20 = 0").collect()] == [(1, 1.0)]
