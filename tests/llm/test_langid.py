import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.llm import langid
from tidemark.llm.common import table

from .conftest import doc_frame

HELD = "pmod(crc32(cast(doc_id as string)), 5) = 0"


def plain_counts(text, buckets=langid.BUCKETS):
    """n-gram counts, one n-gram at a time."""
    raw = b" " + bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32
                       for b in (text or "").lower().encode()) + b" "
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    counts = np.zeros(buckets)
    if raw.strip(b" "):
        for n in langid.GRAMS:
            for i in range(len(raw) - n + 1):
                h = (int.from_bytes(raw[i:i + n], "big") ^ n * 0x1000193) * 0x9E3779B1 & 0xFFFFFFFF
                counts[h >> 32 - (buckets - 1).bit_length()] += 1
    return counts


def test_counts_equal_plain_version(monkeypatch):
    texts = ["A", "Ab, cd!", "été ÉTÉ 12 ß", "", None, " \n1 ", "long " * 50, "日本語 text"]
    expected = np.stack([plain_counts(t) for t in texts])
    assert np.array_equal(langid.gram_counts(pa.array(texts)), expected)
    monkeypatch.setattr(langid, "SPAN", 7)  # counted in spans, nothing is lost or counted twice
    assert np.array_equal(langid.gram_counts(pa.array(texts)), expected)


def test_document_frequencies(spark):
    texts = ["one two", "two", "zwei zwei", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    df = np.stack([plain_counts(t) for t in texts]) > 0
    assert np.allclose(langid.document_frequencies(docs), np.log((4 + 1) / (df.sum(axis=0) + 1)) + 1)


def test_held_out_accuracy(spark):
    docs = table(spark, SF_SMALL, "documents")
    out = langid.predict(docs, langid.learn(docs, F.expr(f"not ({HELD})"))).cache()
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "lang_pred", "score", "rejected"]
    held = out.where(F.expr(HELD) & F.col("lang").isNotNull())
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count()
    assert out.where("score between 0 and 1 and score is not null").count() == docs.count()
    assert out.where("rejected").count() <= 0.1 * docs.count()


def test_prediction_equals_plain_cosines(spark):
    docs = table(spark, SF_SMALL, "documents")
    model = langid.learn(docs, F.expr(f"not ({HELD})"), sample_docs=30, centroids=2)
    assert len(model["langs"]) == len(model["centroids"]) and set(model["langs"]) <= {"de", "en", "es", "fr"}
    rows = docs.orderBy("doc_id").limit(25).collect()
    found = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for row in rows:
        v = np.log1p(plain_counts(row.text)) * model["idf"]
        cosines = model["centroids"] @ (v / np.linalg.norm(v))
        best = int(cosines.argmax())
        assert found[row.doc_id].lang_pred == model["langs"][best]
        assert abs(found[row.doc_id].score - cosines[best]) < 1e-5
        assert found[row.doc_id].rejected == bool(1 - cosines[best] > model["radius"][best])


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = table(spark, SF_SMALL, "documents")
    spoiled = docs.withColumn("lang", F.when(F.expr(HELD), F.lit("xx")).otherwise(F.col("lang")))
    a = langid.predict(docs, langid.learn(docs, F.expr(f"not ({HELD})"))).select("doc_id", "lang_pred", "score")
    b = langid.predict(spoiled, langid.learn(spoiled, F.expr(f"not ({HELD})"))).select("doc_id", "lang_pred", "score")
    assert a.exceptAll(b).count() == 0


def test_another_script_is_rejected(spark):
    docs = table(spark, SF_SMALL, "documents")
    model = langid.learn(docs, F.expr(f"not ({HELD})"))
    other = spark.createDataFrame([(1, "съешь ещё этих мягких французских булок " * 5)], "doc_id long, text string")
    row = langid.predict(other, model).first()
    assert row.rejected and row.lang_pred in model["langs"]


def test_odd_rows(spark, odd_docs):
    docs = doc_frame(spark, odd_docs + [(40, "123 !?"), (41, "日本"), (42, "ª")])
    model = langid.learn(docs, F.lit(True))
    out = langid.predict(docs, model)
    assert out.count() == len(odd_docs) + 3 and model["langs"] and set(model["langs"]) == {"en"}
    undecided = sorted(r.doc_id or -1 for r in out.where("lang_pred = 'und'").collect())
    assert undecided == [-1, 24, 25, 26, 40]
    assert out.where("lang_pred = 'und' and (score <> 0 or not rejected)").count() == 0


def test_nothing_to_learn_from(spark):
    docs = table(spark, SF_SMALL, "documents")
    model = langid.learn(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert langid.predict(docs, model).where("lang_pred <> 'und' or score <> 0").count() == 0
    model = langid.learn(docs, F.lit(True))
    assert langid.predict(docs.where("false"), model).count() == 0


def test_sample_is_bounded(spark):
    rows = [(i, "en" if i % 3 else "de", f"text {'abcdefgh'[i % 8]}") for i in range(300)] + [(7, "en", "text h")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumn("tk", F.xxhash64("text"))
    sizes = {r.lang: r["count"] for r in langid._sample(docs, 40).groupBy("lang").count().collect()}
    assert sizes == {"en": 40, "de": 40}
