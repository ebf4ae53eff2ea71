import numpy as np
import xxhash

from tidemark.llm.simhash import Golay, fingerprint, fingerprints, golay_keys, keep_one, links, near_duplicates

from .conftest import doc_frame


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for (i, _), g in zip(rows, group):
        best.setdefault(g, []).append(i)
    return fps, [min((x for x in best[g] if x is not None), default=None) for g in group]


def test_every_word_is_near_one_codeword_and_near_words_share_one():
    code = Golay()
    words = np.random.default_rng(1).integers(0, 1 << 23, 4000)
    for flip in [0, *(1 << b for b in range(23))]:
        near = code.within_four(words ^ flip)
        assert (near == code.own(words)[:, None]).any(axis=1).all()


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 60, dtype=np.int64)
    fps = set(base.tolist())
    for x in base.tolist():
        for n in (1, 2, 3, 4, 5):
            y = x
            for b in rng.choice(64, n, replace=False).tolist():
                y ^= 1 << b
            fps.add(y - (1 << 64) if y >= 1 << 63 else y)
    fps = sorted(fps)
    wanted = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:]
              if bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {tuple(r) for r in links(frame).collect()}
    assert got == wanted and len(wanted) > 100
    assert max(len(r.near) for r in golay_keys(frame).collect()) <= 252


def test_components_equal_brute_force_on_odd_rows(spark, odd_docs):
    rows = odd_docs + [(100 + i, " ".join(f"t{j}" for j in range(400) if j != i * 7)) for i in range(8)]
    fps, wanted = slow_components(rows)
    got = sorted(map(tuple, near_duplicates(doc_frame(spark, rows)).collect()), key=str)
    assert got == sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, wanted)), key=str)


def test_keep_one_keeps_the_smallest_of_each_component(spark, odd_docs):
    docs = doc_frame(spark, odd_docs)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    _, component = slow_components(odd_docs)
    assert sorted(i for i in ids if i is not None) == sorted({c for c in component if c is not None})
    assert keep_one(docs.limit(0)).collect() == []


def test_no_documents(spark):
    assert near_duplicates(doc_frame(spark, [])).collect() == []
    assert fingerprint(b"") == 0 and fingerprints(doc_frame(spark, [(1, None)])).first().fp == 0
