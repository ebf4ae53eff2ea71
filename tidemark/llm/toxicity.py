"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer rewrites every word to a class (insult, threat, target,
negation, report, other) with a weight; its arcs are words and word beginnings.
A clause transducer, composed with it, reads the classes of a clause and
outputs a pattern for each insult or threat: plain, aimed at a target, negated,
or reported. Only patterns have weight, so a word counts by the clause it
stands in. A logistic model over the weights of a document's patterns gives
the score.

Arcs and model are learned from a bounded sample of labelled documents; the
sample's size is a parameter. Every document is scored over its whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import split_words, stored, text_slices

THRESHOLD = 0.3
#: Labelled documents that the grammar is learned from, at most.
TOXIC_SAMPLE = 4000
CLEAN_SAMPLE = 8000
#: Lengths of word beginnings that may become arcs.
PREFIXES = (3, 4, 5, 6, 7, 8)
#: A beginning becomes an arc only if no single word makes up more of its documents.
MOST_OF_ONE_WORD = 0.6
#: Toxic documents and log odds that an arc needs. (Arcs are features of the
#: sample, so its bounds bound them.)
LEAST_DOCS = 3
LEAST_ODDS = 1.0

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
PATTERNS = ("insult", "insult at target", "threat", "threat at target", "negated", "reported")

# ---------------------------------------------------------------------------
# Seed words of the classes, in four languages. A seed's weight
# gives way to the learned one where the sample has the word.
SEED_WEIGHT = 2.0
SEEDS = {
    INSULT: "idiot idiots moron morons stupid dumb loser losers scum trash pathetic worthless "
            "disgusting clown imbecile jerk bastard filth vermin "
            "dummkopf trottel abschaum widerlich arschloch "
            "imbécile crétin connard salaud ordure "
            "estúpido imbécil idiota basura asqueroso",
    THREAT: "kill murder strangle behead slaughter hurt "
            "umbringen töten abstechen tuer tuerai étrangler matar mataré matarte",
    TARGET: "you your yours yourself u he she they him them his their "
            "du dich dir dein deine euch ihr tu toi vous votre ton ta "
            "tú usted ustedes vosotros",
    NEGATION: "not no never neither nor without isn't aren't don't doesn't won't "
              "nicht kein keine keinen nie niemals pas jamais aucun sin nunca jamás tampoco",
    REPORT: "said says say told wrote writes called according quoted quote reported claims claimed "
            "sagte sagt schrieb laut angeblich selon écrit déclaré según dijo escribió",
}
# ---------------------------------------------------------------------------

_STRIP = "\"'.,;:!?()[]{}<>*#%&$|…„“”«»¡¿-_"
_BREAK_SET = frozenset((b".", b",", b";", b":", b"!", b"?"))

#: State of the clause transducer: bits for a seen target and a report, then
#: the words that a negation still governs.
_SCOPE = 4


def clause_patterns(classes: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """Run the clause transducer over one clause: (position, class, weight) of
    its words other than ``OTHER``; returns (position, pattern, weight) of each
    match.

    A target anywhere in the clause is the target of its insults; a negation
    governs the next ``_SCOPE`` words, a report all words after it.
    """
    target = any(c == TARGET for _, c, _ in classes)
    reported, negated_until = False, -1
    out = []
    for at, c, w in classes:
        if c == NEGATION:
            negated_until = at + _SCOPE
        elif c == REPORT:
            reported = True
        elif c in (INSULT, THREAT):
            if at <= negated_until:
                pattern = 4
            elif reported:
                pattern = 5
            else:
                pattern = 2 * (c == THREAT) + target
            out.append((at, pattern, w))
    return out


def normal_form(word: bytes) -> str:
    return word.decode("utf-8", "replace").lower().strip(_STRIP)


def features_of(word: str) -> list[str]:
    """Candidate arcs of a word: itself and its beginnings (marked ``*``)."""
    if len(word) < 3:
        return []
    return [word] + [word[:n] + "*" for n in PREFIXES if len(word) >= n]


def document_counts(texts: pa.Array, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Candidate arcs, kinds, and how many texts of the kind have the arc.

    The arcs are those of ``features_of``, held as columns: a text has far more
    of them than words.
    """
    codes, distinct, sizes = split_words(texts)
    forms = pa.array([normal_form(w) for w in distinct.cast(pa.binary()).to_pylist()], pa.string())
    length = pc.utf8_length(forms).to_numpy(zero_copy_only=False)
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    text_of, word_of = np.divmod(np.unique(text_of * max(1, len(distinct)) + codes), max(1, len(distinct)))
    arcs, of_kind, counts = [], [], []
    for n in (None, *PREFIXES):  # arcs of different lengths are different
        has = np.flatnonzero(length >= (n or 3))
        names = forms.take(pa.array(has))
        if n:
            names = pc.binary_join_element_wise(pc.utf8_slice_codeunits(names, 0, n), "*", "")
        coded = names.dictionary_encode()
        arc = np.full(len(forms), -1, np.int64)
        arc[has] = coded.indices.to_numpy(zero_copy_only=False)
        mine = arc[word_of]
        pairs = np.unique(text_of[mine >= 0] * max(1, len(coded.dictionary)) + mine[mine >= 0])
        text, arc = np.divmod(pairs, max(1, len(coded.dictionary)))
        found, count = np.unique(arc * 4 + kinds[text], return_counts=True)
        arcs.append(coded.dictionary.take(pa.array(found // 4)))
        of_kind.append(found % 4)
        counts.append(count)
    return pa.concat_arrays(arcs), np.concatenate(of_kind), np.concatenate(counts)


class Lexicon:
    """The lexical transducer; remembers the distinct words it has seen."""

    #: Words remembered at a time.
    MOST_SEEN = 250_000

    def __init__(self, arcs: dict[str, tuple[int, float]]):
        self.arcs = arcs
        self.lengths = sorted({len(a) - 1 for a in arcs if a.endswith("*")})
        self.seen: dict[bytes, tuple[int, float]] = {}

    def __call__(self, word: bytes) -> tuple[int, float]:
        hit = self.seen.get(word)
        if hit is None:
            form = normal_form(word)
            hit = self.arcs.get(form, (OTHER, 0.0))
            if hit[0] in (OTHER, INSULT):
                for n in self.lengths:
                    if len(form) >= n:
                        c, w = self.arcs.get(form[:n] + "*", (OTHER, 0.0))
                        if c != OTHER and w > hit[1]:
                            hit = (c, w)
            if len(self.seen) > self.MOST_SEEN:
                self.seen.clear()
            self.seen[word] = hit
        return hit


def pattern_weights(texts: pa.Array, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Summed weight of each pattern in each text, a word form that repeats in
    a pattern counting once, and, as the last column, the
    number of words; and the number of matched clauses."""
    codes, distinct, sizes = split_words(texts)
    distinct = distinct.cast(pa.binary()).to_pylist()
    weights = np.zeros((len(texts), len(PATTERNS) + 1))
    weights[:, -1] = sizes
    matched = np.zeros(len(texts), np.int64)
    if not len(codes):
        return weights, matched
    known = [lexicon(w) for w in distinct]
    cls = np.array([k[0] for k in known], np.int8)
    ends = np.array([w[-1:] in _BREAK_SET for w in distinct])
    text_of = np.repeat(np.arange(len(texts)), sizes)
    last = np.cumsum(sizes)[text_of] - 1 == np.arange(len(codes))
    clause = np.r_[0, np.cumsum(ends[codes] | last)[:-1]]
    word_class = cls[codes]
    active = np.zeros(int(clause[-1]) + 1, bool)
    active[clause[(word_class == INSULT) | (word_class == THREAT)]] = True
    places = np.flatnonzero((word_class != OTHER) & active[clause])
    groups: dict[int, list] = {}
    for i in places.tolist():
        groups.setdefault(int(clause[i]), []).append((i, int(word_class[i]), known[codes[i]][1]))
    counted = set()
    for words in groups.values():
        doc = text_of[words[0][0]]
        found = clause_patterns(words)
        matched[doc] += bool(found)
        for at, pattern, w in found:
            if (doc, pattern, codes[at]) not in counted:
                counted.add((doc, pattern, codes[at]))
                weights[doc, pattern] += w
    return weights, matched


def _design(weights: np.ndarray) -> np.ndarray:
    """Model inputs: a constant, the damped weight of each pattern, the damped
    weight of all direct ones in a hundred words, and whether there are any."""
    direct = weights[:, :4].sum(1)
    dense = np.log1p(100 * direct / (weights[:, -1] + 20))
    return np.column_stack([np.ones(len(weights)), np.log1p(weights[:, :-1]), np.log1p(direct), dense, direct > 0])


def _fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> np.ndarray:
    """Newton's method with a small ridge penalty (none on the constant)."""
    beta = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + np.diag(ridge),
                               x.T @ (y - p) - ridge * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass
class Model:
    arcs: dict[str, tuple[int, float]]
    beta: np.ndarray

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(weights) @ self.beta, -30, 30)))


def _seed_arcs() -> dict[str, tuple[int, float]]:
    return {w: (c, SEED_WEIGHT if c in (INSULT, THREAT) else 0.0)
            for c, words in SEEDS.items() for w in words.split()}


def _judge(counted: DataFrame, kinds: list[list[int]], candidates: int) -> list[dict[str, tuple[int, float]]]:
    """Arcs from the document counts of the candidates: for the rows of either
    half, learned from the other, and for all other texts, learned from both.

    A candidate becomes an insult arc if the log-likelihood ratio of its counts
    exceeds what the best of ``candidates`` random ones would reach, and no one
    word makes up most of a beginning's toxic documents; its weight is the
    smoothed log odds. Spark judges all candidates; the driver gets those that
    pass, and the counts of the seeds apart from them.
    """
    sets = {"first": (1,), "second": (0,), "all": (0, 1)}
    seeds = _seed_arcs()
    bar = 2 * math.log(max(2, candidates))

    def summed(kind: str, halves: tuple[int, ...]) -> Column:
        return sum((F.col(f"{kind}{h}") for h in halves[1:]), F.col(f"{kind}{halves[0]}"))

    word = F.col("feature")
    is_word = ~word.endswith("*")
    begins = F.array(*[F.concat(F.substring(word, 1, n), F.lit("*")) for n in PREFIXES])
    tops = counted.where(is_word).select(F.explode(F.array_distinct(begins)).alias("feature"), *[
        summed("t", halves).alias(f"top_{name}") for name, halves in sets.items()]) \
        .groupBy("feature").agg(*[F.max(f"top_{name}").alias(f"top_{name}") for name in sets])
    judged, odds_of = counted.join(tops, "feature", "left"), {}
    for name, halves in sets.items():
        toxic, clean = (sum(kinds[k][h] for h in halves) for k in (1, 0))
        t, c = summed("t", halves), summed("c", halves)
        if not toxic or not clean:
            judged = judged.withColumn(f"odds_{name}", F.lit(None).cast("double")).withColumn(f"arc_{name}", F.lit(False))
            continue
        rate = toxic / (toxic + clean)
        odds = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
        share = t / F.greatest(t + c, F.lit(1))
        ratio = 2 * (t * F.log(share / rate) + F.when(c > 0, c * F.log((1 - share) / (1 - rate))).otherwise(0.0))
        arc = (t >= LEAST_DOCS) & (share > rate) & (ratio > bar) & (odds > LEAST_ODDS) \
            & (F.coalesce(f"top_{name}", F.lit(0)) <= MOST_OF_ONE_WORD * t)
        judged = judged.withColumn(f"odds_{name}", odds).withColumn(f"arc_{name}", arc)
    seeded = word.isin(list(seeds))
    passed = judged.where(seeded | F.col("arc_first") | F.col("arc_second") | F.col("arc_all")) \
        .select("feature", *[f"{x}_{name}" for name in sets for x in ("odds", "arc")]).collect()
    out = []
    for name in sets:
        arcs = dict(seeds)
        for r in passed:
            odds, own = r[f"odds_{name}"], seeds.get(r["feature"])
            if own:
                if own[0] in (INSULT, THREAT) and odds is not None:
                    arcs[r["feature"]] = (own[0], max(0.0, odds))
            elif r[f"arc_{name}"]:
                arcs[r["feature"]] = (INSULT, odds)
        out.append(arcs)
    return out


def _count_features(sample: DataFrame) -> DataFrame:
    """``feature, t0, t1, c0, c1``: toxic and clean documents of either half of
    the sample that have a candidate, if ``LEAST_DOCS`` toxic ones do."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                kinds = 2 * part.column("toxic").to_numpy() + part.column("half").to_numpy()
                arcs, kind, n = document_counts(part.column("text"), kinds)
                yield pa.RecordBatch.from_arrays([arcs, pa.array(kind, pa.int32()), pa.array(n, pa.int64())],
                                                 ["feature", "kind", "n"])

    rows = sample.select("toxic", "half", "text").mapInArrow(run, "feature string, kind int, n long")
    return rows.groupBy("feature").agg(*[
        F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(c)
        for k, c in enumerate(("c0", "c1", "t0", "t1"))]).where(F.col("t0") + F.col("t1") >= LEAST_DOCS)


def _weights_of(docs: DataFrame, arcs: list[dict], columns: list[str], schema: str) -> DataFrame:
    """Pattern weights under the arcs that column ``half`` chooses."""
    shared = docs.sparkSession.sparkContext.broadcast(arcs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicons = [Lexicon(a) for a in shared.value]
        for batch in batches:
            for part in text_slices(batch):
                half = part.column("half").to_numpy(zero_copy_only=False)
                texts = part.column("text")
                weights = np.zeros((len(texts), len(PATTERNS) + 1))
                for h, lexicon in enumerate(lexicons):
                    mine = np.flatnonzero(half == h)
                    weights[mine] = pattern_weights(texts.take(pa.array(mine)), lexicon)[0]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in columns),
                     pa.ListArray.from_arrays(
                         pa.array(np.arange(0, weights.size + 1, weights.shape[1], dtype=np.int32)),
                         pa.array(weights.reshape(-1)))], [*columns, "weights"])

    return docs.select("half", "text", *[c for c in columns if c not in ("half", "text")]) \
        .mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, train: Column, toxic_sample: int = TOXIC_SAMPLE,
          clean_sample: int = CLEAN_SAMPLE) -> Model:
    """Learn arcs and model from labelled rows that ``train`` (a condition on
    ``doc_id``) admits.

    The sample holds at most ``toxic_sample`` toxic and ``clean_sample`` clean
    documents, those with the smallest hash of their id. The model is fitted
    to patterns under arcs learned from the other half of the sample, so it
    sees weights as they are on unseen text. Without labels of both kinds the
    seed words and a fixed model are used.
    """
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")) \
        .where("doc_id is not null and toxic is not null").where(train) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(1))
    chosen = labels.where("toxic = 1").orderBy(order, "doc_id").limit(toxic_sample) \
        .union(labels.where("toxic <> 1").orderBy(order, "doc_id").limit(clean_sample))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text is not null")
    # Copies of a text are one example.
    sample = stored(sample.groupBy(F.md5("text").alias("digest")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("text", "toxic", F.pmod(F.crc32("digest"), F.lit(2)).cast("int").alias("half")), "labelled")
    totals = {(r.toxic, r.half): r.n for r in sample.groupBy("toxic", "half").agg(F.count("*").alias("n")).collect()}
    kinds = [[totals.get((t, h), 0) for h in (0, 1)] for t in (0, 1)]
    fixed = Model(_seed_arcs(), np.array([-4.0, 0.5, 1, 1, 2, 0, 0, 1, 0, 2]))
    if not sum(kinds[0]) or not sum(kinds[1]):
        return fixed
    counted = stored(_count_features(sample), "features")
    candidates = counted.count()
    first, second, whole = _judge(counted, kinds, candidates)
    seen = _weights_of(sample, [first, second], ["toxic"], "toxic int, weights array<double>").collect()
    weights = np.array([r.weights for r in seen])
    return Model(whole, _fit_logistic(_design(weights), np.array([float(r.toxic) for r in seen])))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted, clauses`` of every document: the model's
    probability of toxic, whether it reaches ``threshold``, and the clauses
    with an insult or threat.

    Null and empty texts get the score of a text without patterns; repeated
    rows get equal scores; an empty table gives no rows. Only ``doc_id`` and
    ``text`` are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.arcs, model.beta))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        lexicon = Lexicon(model.arcs)
        for batch in batches:
            for part in text_slices(batch):
                weights, matched = pattern_weights(part.column("text"), lexicon)
                scores = model.scores(weights)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32)),
                     pa.array(matched)], ["doc_id", "score", "predicted", "clauses"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(
        run, "doc_id long, score double, predicted int, clauses long")


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, all columns, that score below ``threshold``; no shuffle.

    Null and empty texts score like a text without patterns, so they stay;
    repeated rows stay or go together; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.arcs, model.beta))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        lexicon = Lexicon(model.arcs)
        for batch in batches:
            for part in text_slices(batch):
                weights, _ = pattern_weights(part.column("text"), lexicon)
                yield part.filter(pa.array(model.scores(weights) < threshold))

    return docs.mapInArrow(run, docs.schema)
