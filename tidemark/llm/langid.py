"""Language identification by nearest centroids.

A text becomes a vector of hashed byte n-grams of its lower-cased letters:
log counts times inverse document frequencies, scaled to length one. Every
language has a few centroids, found by clustering its vectors on the sphere,
so that different kinds of text (long prose, word lists, code-like lines) need
not share one mean. A text takes the language of the centroid with the largest
cosine; where it lies farther from that centroid than nearly all texts that the
centroid was learned from, it is marked as rejected.

Document frequencies are summed over all texts learned from. Centroids are
fitted on a bounded sample of each language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import doc_key, salted_join, split_by_keys, stored, text_slices

#: Lengths of the byte n-grams.
GRAMS = (1, 2, 3, 4)
#: Hash buckets of n-grams, the width of a vector.
BUCKETS = 1 << 13
#: Centroids of a language, and documents of it that they are fitted on.
CENTROIDS = 3
SAMPLE_DOCS = 800
ROUNDS = 12
#: Part of a centroid's own texts that lie within its radius, and the slack beyond it.
WITHIN, SLACK = 0.99, 0.05
#: Language of texts without a letter.
NO_LANGUAGE = "und"
#: Vectors that a task holds at a time, and bytes whose n-grams it hashes at a time.
ROWS, SPAN = 256, 1 << 20
#: ASCII other than letters separates; upper case is folded.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def gram_counts(texts: pa.Array, buckets: int = BUCKETS) -> np.ndarray:
    """Matrix of n-gram counts, a row per text (null: none). Runs of bytes that
    are not letters count as one separator; texts are framed by separators."""
    lowered = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.binary()).to_pylist()
    counts = np.zeros((len(lowered), buckets))
    for row, text in enumerate(lowered):
        whole = np.frombuffer(b" " + text.translate(_BYTES) + b" ", np.uint8)
        blank = whole == 32
        whole = whole[~(blank & np.r_[False, blank[:-1]])]
        if len(whole) <= 1:
            continue
        for start in range(0, len(whole), SPAN):
            part = whole[start:start + SPAN + max(GRAMS) - 1].astype(np.uint32)
            for n in GRAMS:
                packed = np.zeros(max(0, min(SPAN, len(part) - n + 1)), np.uint32)
                for lead in range(n):
                    packed = packed << np.uint32(8) | part[lead:lead + len(packed)]
                hashed = (packed ^ np.uint32(n * 0x1000193)) * np.uint32(0x9E3779B1)
                counts[row] += np.bincount(hashed >> np.uint32(32 - (buckets - 1).bit_length()), minlength=buckets)
    return counts


def vectors(texts: pa.Array, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length one (zero for a text without letters)."""
    weighted = np.log1p(gram_counts(texts, len(idf)).astype(np.float32)) * idf.astype(np.float32)
    length = np.sqrt((weighted * weighted).sum(axis=1, keepdims=True))
    return weighted / np.where(length > 0, length, 1)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            for i in range(0, part.num_rows, ROWS):
                yield part.slice(i, ROWS)


def document_frequencies(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Inverse document frequency of every bucket, over all of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(buckets, np.int64), 0
        for part in _parts(batches):
            found += (gram_counts(part.column("text"), buckets) > 0).sum(axis=0)
            n += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, buckets, dtype=np.int32)), pa.array(np.r_[n, found])],
                                         ["bucket", "n"])

    summed = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets + 1)
    for row in summed.collect():  # a row per bucket
        counts[row.bucket + 1] = row.n
    return np.log((counts[0] + 1) / (counts[1:] + 1)) + 1


def sphere_means(x: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length one and the radius (largest distance, but for the
    outermost part) of each. The first centroid starts at the mean, each other
    one at the vector farthest from those before."""
    def unit(v: np.ndarray) -> np.ndarray:
        return v / max(float(np.sqrt((v * v).sum())), 1e-12)

    centroids = [unit(x.mean(axis=0))]
    while len(centroids) < k:
        centroids.append(x[int((x @ np.stack(centroids).T).max(axis=1).argmin())])
    c = np.stack(centroids)
    for _ in range(rounds):
        nearest = (x @ c.T).argmax(axis=1)
        c = np.stack([unit(x[nearest == i].mean(axis=0)) if (nearest == i).any() else c[i] for i in range(k)])
    cosines = x @ c.T
    nearest = cosines.argmax(axis=1)
    distance = 1 - cosines.max(axis=1)
    radius = np.array([np.quantile(distance[nearest == i], WITHIN) if (nearest == i).any() else distance.max()
                       for i in range(k)])
    return c, np.minimum(1.0, radius + SLACK)


def _sample(docs: DataFrame, most: int) -> DataFrame:
    """At most ``most`` documents of each language, those with the smallest
    hashes of id and text; repeated rows count once. (Of a language with many
    more, a few less than ``most`` with a chance of one in a million.)"""
    h = F.xxhash64("doc_id", "tk").alias("h")
    keys = docs.select("lang", h).distinct()
    # Hashes are even, so those below a share of their range leave about a quarter more than wanted.
    share = F.shiftrightunsigned("h", 1) / F.lit(2.0 ** 63)
    few = salted_join(keys, keys.groupBy("lang").agg(F.count("*").alias("all")), ["lang"], ["h"]) \
        .where(share * F.col("all") < 1.25 * most)
    ranked = few.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 1), "h")))
    keys = ranked.where(F.col("r") <= most)
    keys = stored(keys.select("lang", "h"), "langid-keys")
    likely, _ = split_by_keys(docs.select("lang", h, "text"), keys, ["lang", "h"])
    return likely.join(keys, ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"])


def learn(docs: DataFrame, learns: Column, sample_docs: int = SAMPLE_DOCS, centroids: int = CENTROIDS) -> dict:
    """Model from ``text`` and non-null ``lang`` of the rows where ``learns``
    holds: a dict of the languages of the centroids, centroids, radii and idf.

    Texts without a letter teach nothing. A language with few documents has
    fewer centroids; no document gives a model without languages. The driver
    holds ``centroids`` vectors of ``BUCKETS`` numbers for each language.
    """
    # Text digests tell rows with one id apart.
    known = docs.where(learns & F.col("lang").isNotNull() & has_letter(F.col("text"))) \
        .select("doc_id", F.col("lang").cast("string").alias("lang"), "text", doc_key(F.col("text")).alias("tk"))
    idf = document_frequencies(known)
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    sample = stored(_sample(known, sample_docs).select("lang", "h", "text"), "langid-sample")

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("h").combine_chunks()
        parts = [vectors(part.column("text"), shared.value) for part in _parts(iter(table.to_batches()))]
        x = np.concatenate(parts)
        c, radius = sphere_means(x, max(1, min(centroids, len(x) // 20)))
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(c)),
                         "centroid": pa.array([v.astype(np.float32).tobytes() for v in c], pa.binary()),
                         "radius": pa.array(radius.astype(np.float64))})

    rows = sorted(sample.groupBy("lang").applyInArrow(fit, "lang string, centroid binary, radius double").collect(),
                  key=lambda r: (r.lang, r.centroid))
    return {"langs": [r.lang for r in rows], "idf": idf, "radius": np.array([r.radius for r in rows]),
            "centroids": np.array([np.frombuffer(bytes(r.centroid), np.float32) for r in rows])}


def has_letter(text: Column) -> Column:
    """Whether the text has a letter of any script; false for null."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """All columns of ``docs`` but ``text``, with ``lang_pred`` (that of the
    nearest centroid; ``und`` where the text is null or has no letter or the
    model knows no language), ``score`` (the cosine, 0 to 1; ``und``: 0) and
    ``rejected`` (beyond the centroid's radius; ``und``: true).

    Ties go to the first language in order of its name. Repeated rows get equal
    results, very long texts are counted in spans, an empty table gives no rows.
    Columns named like a result give way to it.
    """
    results = ("lang_pred", "score", "rejected")
    kept = [c for c in docs.columns if c != "text" and c not in results]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        langs = pa.array([*m["langs"], NO_LANGUAGE], pa.string())
        for part in _parts(batches):
            known = part.column("letter").to_numpy(zero_copy_only=False) & bool(m["langs"])
            best, score, far = np.full(len(known), len(langs) - 1), np.zeros(len(known)), np.ones(len(known), bool)
            if known.any():
                x = vectors(part.column("text").filter(pa.array(known)), m["idf"])
                cosines = x @ m["centroids"].T
                nearest = cosines.argmax(axis=1)
                top = cosines[np.arange(len(x)), nearest].astype(np.float64)
                best[known], score[known], far[known] = nearest, np.clip(top, 0, 1), 1 - top > m["radius"][nearest]
            yield pa.RecordBatch.from_arrays(
                [part.column("kept"), langs.take(pa.array(best)), pa.array(score), pa.array(far)], ["kept", *results])

    rows = docs.select(F.struct(*kept).alias("kept"), "text", has_letter(F.col("text")).alias("letter"))
    schema = T.StructType([rows.schema["kept"], *T.StructType.fromDDL("lang_pred string, score double, rejected boolean")])
    return rows.mapInArrow(run, schema).select("kept.*", *results)
