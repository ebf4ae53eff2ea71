"""The five stages one after another against plain Python versions."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import toxicity
from tidemark.llm.common import stored
from tidemark.llm.registry import tokenizer_path

from .test_decontaminate import brute as plain_hits
from .test_simhash import slow_components, slow_fingerprint
from .test_substring_dedup import brute as plain_cuts

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(spark, odd_docs, root):
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in "bdfklm" for b in "aeiou" for c in ("r", "n", "st", "")]

    def prose(n):
        return " ".join(rng.choices(words, k=n))

    rows = [d for d in odd_docs if len(d[1] or "") < 100_000]
    rows += [(100 + i, prose(rng.randrange(5, 120))) for i in range(260)]
    labels = []
    for i in range(0, 120, 3):  # toxic examples, some of them held out
        rows[-260 + i] = (100 + i, f"{rows[-260 + i][1]} you zorgled {rng.choice(words)} you zorgling {rng.choice(words)}")
    labels += [(100 + i, 1, int(i % 3 == 0 and i < 120)) for i in range(260)]
    passage = prose(70)
    rows += [(400 + i, f"{prose(20)} {passage} {prose(9)}") for i in range(4)]
    long = prose(400)
    near = long.split()
    near[200] = "changed"
    rows += [(410, long), (411, long), (412, " ".join(near)), (413, prose(9000))]
    items = [(1, prose(14)), (2, prose(12)), (3, "only three words"), (4, None), (5, "")]
    rows += [(420, f"{prose(8)} {items[0][1].upper()}! {prose(5)}"), (421, f"a only, three: words b")]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], COLUMNS)
    tables = {"documents": docs, "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
              "benchmark": spark.createDataFrame(items, "item_id long, text string")}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}.parquet")
    return rows, items


def pairs(docs):
    return sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=repr)


def plain_toxic(rows, model):
    """Scores text by text, clause by clause."""
    kept = []
    for i, text in rows:
        weights, _ = toxicity.pattern_weights(pa.array([text], pa.string()), toxicity.Lexicon(model.arcs))
        z = float(toxicity._design(weights)[0] @ model.beta)
        if 1 / (1 + np.exp(-z)) < toxicity.THRESHOLD:
            kept.append((i, text))
    return kept


def plain_keep_one(rows):
    _, component = slow_components(rows)
    fps = [slow_fingerprint(t) for _, t in rows]
    kept, seen = [], set()
    by_component: dict = {}
    for (i, t), c, fp in zip(rows, component, fps):
        by_component.setdefault(("id", c) if c is not None else ("fp", fp), []).append((i, t))
    for members in by_component.values():
        best = min(members, key=lambda r: (r[0] is None, r[0] or 0))
        if best not in seen:
            seen.add(best)
            kept.append(best)
    return kept


def test_every_stage_equals_a_plain_version(spark, odd_docs, tmp_path):
    root = str(tmp_path)
    rows, items = fixture(spark, odd_docs, root)
    docs = spark.read.parquet(f"{root}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)

    model = toxicity.learn(docs, spark.read.parquet(f"{root}/labels.parquet"), ~toxicity.held_out(F.col("doc_id")))
    clean = stored(stage["toxicity"](spark, docs, root), "t-toxicity")
    expected = plain_toxic(rows, model)
    assert pairs(clean) == sorted(expected, key=repr) and 30 <= len(rows) - len(expected) <= 45

    single = stored(stage["simhash_near_dedup"](spark, clean, root), "t-simhash")
    # Of rows without an id in one group any may stay; here they differ in text.
    wanted, got = plain_keep_one(expected), pairs(single)
    assert sorted((r for r in got if r[0] is not None), key=repr) == sorted((r for r in wanted if r[0] is not None), key=repr)
    assert len(got) == len(wanted) < len(expected)

    cut = stored(stage["substring_dedup"](spark, single, root), "t-substring")
    judged = {(i, n): (gone, kept) for i, n, gone, kept in plain_cuts(got)}
    expected = []
    for i, t in got:
        gone, kept = judged[i, len((t or "").encode().split())]
        expected.append((i, kept if gone else t))
    assert pairs(cut) == sorted(expected, key=repr) and sum(g > 0 for g, _ in judged.values()) >= 3
    assert all(r.n_chars == len(r.text) for r in cut.where("text is not null").collect())

    fair = stored(stage["benchmark_decontamination"](spark, cut, root), "t-benchmark")
    hits = {(i, n): hit for i, n, hit, _ in plain_hits(expected, items)}
    from tidemark.llm.decontaminate import words_of
    expected = [(i, t) for i, t in expected if not hits[i, len(words_of((t or "").encode()))]]
    assert pairs(fair) == sorted(expected, key=repr)
    assert not {420, 421} & {i for i, _ in expected}

    packed = stage["best_fit_packing"](spark, fair, root).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    lengths = sorted(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in expected)
    whole: dict = {}
    sequences: dict = {}
    for r in packed:
        whole.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sum(r.length for r in rs) for i, rs in whole.items() if i is not None) == sorted(
        len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in expected if i is not None)
    assert sum(r.length for r in packed) == sum(lengths)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) == -(-sum(lengths) // 4096) or len(sequences) <= -(-sum(lengths) // 4096) + 1

    run = corpus_pipeline.run(spark, root)
    assert run.count() == len(packed) and run.columns == stage["best_fit_packing"](spark, fair, root).columns


def test_stages_on_an_empty_table(spark, tmp_path):
    for name, columns in (("documents", COLUMNS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
