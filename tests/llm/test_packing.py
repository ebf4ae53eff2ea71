import random
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import common
from tidemark.llm import packing as P
from tidemark.llm.registry import tokenizer_path

from .conftest import doc_frame


def check_packed(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_equal_the_tokenizer(spark, odd_docs):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = odd_docs + [(60, "It's 3 o'clock, SHE'LL say naïve “quotes” — ÀÉß ½ µ ª ĀB ǅ İstanbul ΣΑΣ 日本語 áb   x​y z"),
                       (61, "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b ..!! end.<"), (62, "tab\tvt\x0bff\x0ccr\rnl\nsep\x1cunit\x1f"),
                       (63, "(hello) \"quoted\" word... $5 a.b,c don't, can't. l'été."), (64, "KK Å ﬁ ﷺ 👩‍👩‍👧 \U0001f600!")]
    got = {}
    for r in P.pack_documents(doc_frame(spark, rows), tokenizer_path(), with_ids=True).collect():
        got.setdefault((r.doc_id, r.piece), []).append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    wanted = {}
    for i, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for s in range(0, len(ids), 4096):
            wanted.setdefault((i, s // 4096), []).append((s, ids[s:s + 4096].tobytes()))
    assert {k: sorted((r.start, bytes(r.ids)) for r in v) for k, v in got.items()} == {k: sorted(v) for k, v in wanted.items()}
    check_packed([r for v in got.values() for r in v], 4096)


def test_few_sequences(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("word" for _ in range(int(rng.lognormvariate(5, 1))))) for i in range(600)]
    out = P.pack_documents(doc_frame(spark, rows), tokenizer_path()).collect()
    least = -(-sum(r.length for r in out) // 4096)
    assert check_packed(out, 4096) <= least * 1.02 + 1


def test_hot_length_is_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(P, "RANK_ROWS", 16)
    pieces = spark.createDataFrame([(i, 0, 7, "x") for i in range(500)] + [(i, 1, 90, "x") for i in range(40)],
                                   "doc_id long, piece int, length long, n string")
    out = P.pack(pieces, capacity=100).collect()
    assert len(out) == 540 and out[0].n == "x"
    assert check_packed(out, 100) <= 40 + -(-460 // 14) + 1


def test_empty_table(spark):
    assert P.pack_documents(doc_frame(spark, []), tokenizer_path()).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=20), st.sampled_from([8, 16, 64]))
def test_plans_place_everything_once(histogram, bins):
    plan = P.plan_packing(histogram, capacity=64, bins=bins)
    fill = {}
    for length, rank, n, first, offset, each in sorted(plan.rows, key=lambda r: (r[3], r[4])):
        for k in range(n):
            fill.setdefault(first + k // each, []).append((offset + k % each * length, length))
    assert {k: v for k, v in plan.used.items()} == {k: v for k, v in histogram.items() if v}
    ranks = {}
    for length, rank, n, *_ in sorted(plan.rows):
        assert rank == ranks.get(length, 0)
        ranks[length] = rank + n
    for members in fill.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 64
    assert len(fill) == plan.sequences


def test_nnls_finds_the_least_squares_solution():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = rng.random((12, 30)), rng.standard_normal(12)
        x = P.nnls(a, b)
        gradient = a.T @ (b - a @ x)
        assert (x >= 0).all() and gradient.max() < 1e-6 and np.abs(gradient[x > 0]).max(initial=0) < 1e-6


def test_unknown_tokenizer_fails(spark):
    with pytest.raises(OSError):
        P.pack_documents(doc_frame(spark, [(1, "a")]), "/nowhere.json")


def test_slices_give_arrow_memory_back(monkeypatch):
    released = []
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: released.append(1)))
    batch = pa.RecordBatch.from_arrays([pa.array(["one", None, "three", "four"])], ["text"])
    slices = list(common.text_slices(batch, budget=4))
    assert [x for s in slices for x in s.column("text").to_pylist()] == ["one", None, "three", "four"]
    assert len(released) == len(slices) > 1
