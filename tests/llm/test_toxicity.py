import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import toxicity as X

from .conftest import doc_frame


def patterns(text):
    weights, matched = X.pattern_weights(pa.array([text]), X.Lexicon(X._seed_arcs()))
    return [X.PATTERNS[i] for i in range(6) if weights[0, i]], int(matched[0])


def test_clauses_decide_the_pattern():
    assert patterns("what an idiot") == (["insult"], 1)
    assert patterns("you are an Idiot!") == (["insult at target"], 1)
    assert patterns("this is not stupid") == (["negated"], 1)
    assert patterns("she said idiot") == (["reported"], 1)
    assert patterns("I will kill you, moron") == (["insult", "threat at target"], 2)
    assert patterns("no way, this is so very very trash") == (["insult"], 1)
    assert patterns("nothing here") == ([], 0)
    assert patterns("idiot idiot, idiot")[1] == 2


def test_a_repeated_word_counts_once_per_pattern():
    once, _ = X.pattern_weights(pa.array(["idiot a b c"]), X.Lexicon(X._seed_arcs()))
    often, _ = X.pattern_weights(pa.array(["idiot. idiot. idiot."]), X.Lexicon(X._seed_arcs()))
    assert once[0, 0] == often[0, 0]


def labelled(spark, n=600):
    rng = random.Random(4)
    plain = [f"{a}{b}" for a in ("ba", "du", "ke", "lo", "mi") for b in ("ra", "su", "ti", "vo", "na", "pe")]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randrange(20, 60))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = "zorg" + rng.choice(plain)
        rows.append((i, " ".join(words)))
        if i % 3 != 1:
            labels.append((i, 1, int(toxic), "x"))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_learns_word_beginnings_and_finds_held_out_documents(spark, odd_docs):
    rows, labels = labelled(spark)
    docs = doc_frame(spark, rows + [(10_000 + k, t) for k, (_, t) in enumerate(odd_docs)])
    model = X.learn(docs, labels, ~X.held_out(F.col("doc_id")))
    assert any(a.startswith("zorg") and a.endswith("*") for a in model.arcs)
    got = {r.doc_id: r for r in X.score(docs, model).collect()}
    for i, _ in rows:
        assert got[i].predicted == int(i % 6 == 0), i
        assert 0 <= got[i].score <= 1
    assert all(got[10_000 + k].predicted == 0 for k in range(len(odd_docs)))
    kept = X.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_without_labels_the_seed_words_decide(spark, odd_docs):
    docs = doc_frame(spark, odd_docs + [(500, "you stupid worthless idiot, you are trash")])
    none = spark.createDataFrame([(None, 1, None)], "doc_id long, quality int, toxic int")
    model = X.learn(docs, none, ~X.held_out(F.col("doc_id")))
    rows = X.score(docs, model).collect()
    assert len(rows) == len(odd_docs) + 1
    assert [r.doc_id for r in rows if r.predicted] == [500]
    assert X.score(docs.limit(0), model).collect() == []


def test_sample_bounds_hold(spark):
    rows, labels = labelled(spark)
    model = X.learn(doc_frame(spark, rows), labels, ~X.held_out(F.col("doc_id")), toxic_sample=20, clean_sample=30)
    assert model.beta.shape == (10,)


def plain_arcs(rows, kinds, halves, candidates):
    """The arcs of some halves, candidate by candidate."""
    toxic, clean = (sum(kinds[k][h] for h in halves) for k in (1, 0))
    counts = {f: (sum(r[h] for h in halves), sum(r[2 + h] for h in halves)) for f, r in rows.items()}
    arcs = dict(X._seed_arcs())
    for f, (t, c) in counts.items():
        odds = math.log((t + .5) / (toxic + 1)) - math.log((c + .5) / (clean + 1))
        own = X._seed_arcs().get(f)
        if own:
            if own[0] in (X.INSULT, X.THREAT):
                arcs[f] = (own[0], max(0.0, odds))
            continue
        if not t or t < X.LEAST_DOCS or odds <= X.LEAST_ODDS:
            continue
        share, rate = t / (t + c), toxic / (toxic + clean)
        ratio = 2 * (t * math.log(share / rate) + (c * math.log((1 - share) / (1 - rate)) if c else 0))
        words = [n[0] for g, n in counts.items() if f.endswith("*") and not g.endswith("*") and g.startswith(f[:-1])]
        if share > rate and ratio > 2 * math.log(candidates) and max(words, default=0) <= X.MOST_OF_ONE_WORD * t:
            arcs[f] = (X.INSULT, odds)
    return arcs


def test_arcs_equal_a_plain_version(spark):
    rng = random.Random(8)
    rows = {}
    for i in range(400):
        word = "".join(rng.choices("abcd", k=rng.randrange(3, 8)))
        rows[word] = [rng.choice([0, 0, 1, 5, 30]) for _ in range(2)] + [rng.choice([0, 1, 4, 40]) for _ in range(2)]
    for word in list(rows):
        for f in X.features_of(word)[1:]:
            old = rows.get(f, [0] * 4)
            rows[f] = [min(100, a + b) for a, b in zip(old, rows[word])]
    rows["idiot"], rows["kill"], rows["you"] = [9, 4, 1, 0], [1, 1, 50, 60], [9, 9, 9, 9]
    rows = {f: r for f, r in rows.items() if r[0] + r[1] >= X.LEAST_DOCS}
    kinds = [[300, 280], [110, 120]]
    counted = spark.createDataFrame([(f, *r) for f, r in rows.items()], "feature string, t0 long, t1 long, c0 long, c1 long")
    got = X._judge(counted, kinds, len(rows))
    for arcs, halves in zip(got, ((1,), (0,), (0, 1))):
        wanted = plain_arcs(rows, kinds, halves, len(rows))
        assert arcs.keys() == wanted.keys() and len(arcs) > len(X._seed_arcs())
        assert all(arcs[f][0] == c and math.isclose(arcs[f][1], w) for f, (c, w) in wanted.items())


def test_without_one_kind_in_a_half_the_seeds_decide(spark):
    counted = spark.createDataFrame([("zorg", 5, 0, 0, 0)], "feature string, t0 long, t1 long, c0 long, c1 long")
    first, second, whole = X._judge(counted, [[50, 50], [10, 0]], 2)
    assert first == X._seed_arcs() and whole["zorg"][0] == X.INSULT


def test_counts_of_candidates_equal_a_plain_version_in_little_memory():
    rng = random.Random(8)
    words = [f"{a}{b}{i:x}{c}" for i in range(6000) for a in "bd" for b in ("ö", "u") for c in ("", ".", "*", "ing")]
    texts = [" ".join(rng.choices(words, k=700)) for _ in range(300)]
    texts += [None, "", " a  ab abc *abc* abcd* ABC İstanbul ß \x1c\x1cx a*b*c ***", "abc abc\tabcd"]
    kinds = np.array([rng.randrange(4) for _ in texts])
    wanted = Counter()
    for kind, text in zip(kinds.tolist(), texts):
        forms = {X.normal_form(w) for w in (text or "").encode().split()}
        wanted.update((f, kind) for f in {a for f in forms for a in X.features_of(f)})
    column = pa.array(texts, pa.string())
    tracemalloc.start()
    arcs, of_kind, n = X.document_counts(column, kinds)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(arcs) == len(wanted) and dict(zip(zip(arcs.to_pylist(), of_kind.tolist()), n.tolist())) == wanted
    assert most < 20 * column.nbytes  # a counter of (arc, kind) takes about 40 times as much


def test_the_lexicon_remembers_a_bounded_number_of_words(monkeypatch):
    monkeypatch.setattr(X.Lexicon, "MOST_SEEN", 10)
    lexicon = X.Lexicon({"idiot": (X.INSULT, 2.0)})
    for i in range(100):
        assert lexicon(b"idiot!") == (X.INSULT, 2.0) and lexicon(b"w%d" % i)[0] == X.OTHER
    assert len(lexicon.seen) <= 12
