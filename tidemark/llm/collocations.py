"""Phrase collocations by marginalising the longest windows.

At every word position one window is counted: the word and its followers by
lead columns, up to the longest phrase, padded with null where the piece ends.
Only these longest windows are counted; a Spark ROLLUP over their columns sums
the successively shorter prefixes, so the shorter phrases need no explosion of
their own, and the group's subtotal is its number of words.

A window may also end early where that loses no phrase: behind a pair of words
that is too rare to lie in a phrase of the least frequency. Which pairs those
are is told by counts of hashed pairs in a table of fixed size; a bucket's
count is never less than that of a pair in it, so what it rules out is ruled
out exactly, and an unlucky pair only costs work. The tasks hold that table as
a bitmap of ``PAIR_BUCKETS`` bits, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import alone, hashes, mix, salted_join, stored, text_slices

LONGEST = 5
LEAST = 100
BEST = 2000
#: A phrase is dropped when a longer one around it has this percentage of its count.
COVERED = 100
NO_GROUP = "und"
#: Buckets of hashed pairs: 2 MB as a bitmap.
PAIR_BUCKETS = 1 << 24
#: Buckets in one row of a stored bitmap (the size of Spark's bitmaps).
_PART_BITS = 8 * 4096
#: Text bytes whose windows are counted together in a task.
SPAN_BYTES = 5 << 20
#: Parts that a group's phrases are ranked in before the last ranking.
RANK_PARTS = 64
#: Every byte of a text becomes its lower case, a space (between words) or a line feed (between pieces).
_BYTES = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b
               for b in range(256))


def pieces_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Words of all texts in order: code of each, number of its piece, the
    distinct words by code, and the text of each word. Null texts have none."""
    raw = pc.fill_null(texts, "").cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = raw.buffers()[2].slice(ends[0], ends[-1] - ends[0]).to_pybytes() if len(raw) and raw.buffers()[2] else b""
    plain = pa.Array.from_buffers(pa.large_utf8(), len(raw), [
        None, pa.py_buffer((ends - ends[0]).tobytes() if len(raw) else bytes(8)), pa.py_buffer(data.translate(_BYTES))])
    lists = pc.split_pattern(plain, "\n")
    pieces = lists.flatten()
    text_of = np.repeat(np.arange(len(plain)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    words = pc.split_pattern(pieces, " ")
    piece_of = np.repeat(np.arange(len(pieces)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    coded = words.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:
        kept = codes != blank
        codes, piece_of = codes[kept], piece_of[kept]
    return codes, piece_of, coded.dictionary, text_of[piece_of]


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined up to about ``SPAN_BYTES`` of text; a longer text is a span of its own."""
    held, size = [], 0
    for batch in batches:
        for part in text_slices(batch, budget=SPAN_BYTES):
            part_size = part.column("text").nbytes
            if held and size + part_size > SPAN_BYTES:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(part)
            size += part_size
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _positions(span: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, pa.Array]:
    """Word codes, piece numbers, words, group codes and groups of a span."""
    codes, piece, words, text = pieces_of(span.column("text"))
    groups = span.column("grp").dictionary_encode()
    group = groups.indices.to_numpy(zero_copy_only=False)[text]
    return codes, piece, words, group, groups.dictionary


def _pair_buckets(codes: np.ndarray, words: pa.Array, group: np.ndarray, groups: pa.Array, buckets: int) -> np.ndarray:
    """Bucket of the pair that begins at each position but the last."""
    word = hashes(words, 1)[codes]
    seed = hashes(groups, 2)[group]
    return (mix(mix(word[:-1] ^ seed[:-1]) + word[1:]) & np.uint64(buckets - 1)).astype(np.int64)


def _texts(docs: DataFrame, group: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(group).cast("string"), F.lit(NO_GROUP)).alias("grp"), "text").where("text is not null")


def frequent_pairs(texts: DataFrame, least: int, buckets: int) -> bytes:
    """Bitmap of the buckets whose pairs occur ``least`` times or more together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for span in _spans(batches):
            codes, piece, words, group, groups = _positions(span)
            bucket = _pair_buckets(codes, words, group, groups, buckets)[piece[1:] == piece[:-1]]
            found, n = np.unique(bucket, return_counts=True)
            for i in range(0, len(found), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(found[i:i + (1 << 16)].astype(np.int32)),
                                                  pa.array(n[i:i + (1 << 16)].astype(np.int32))], ["bucket", "n"])
            pa.default_memory_pool().release_unused()

    counted = texts.mapInArrow(run, "bucket int, n int").groupBy("bucket").agg(F.sum("n").alias("n"))
    part = F.floor(F.col("bucket") / F.lit(_PART_BITS))
    maps = counted.where(F.col("n") >= least).groupBy(part.alias("part")).agg(
        F.bitmap_construct_agg(F.col("bucket").cast("long") % _PART_BITS).alias("bits"))
    bits = np.zeros(-(-buckets // _PART_BITS) * _PART_BITS // 8, np.uint8)
    for row in alone(texts.sparkSession, maps.collect):  # one row for every _PART_BITS buckets
        bits[row.part * _PART_BITS // 8:(row.part + 1) * _PART_BITS // 8] = np.frombuffer(bytes(row.bits), np.uint8)
    return bits.tobytes()


def windows(texts: DataFrame, longest: int, bitmap, buckets: int) -> DataFrame:
    """``grp, w1 .. w<longest>, n``: how often each longest window occurs, null
    where it is padded; counts of one window may come in several rows."""
    names = [f"w{i + 1}" for i in range(longest)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        for span in _spans(batches):
            codes, piece, words, group, groups = _positions(span)
            if not len(codes):
                continue
            bucket = _pair_buckets(codes, words, group, groups, buckets)
            goes_on = (bits[bucket >> 3] >> (bucket & 7).astype(np.uint8) & 1).astype(bool) & (piece[1:] == piece[:-1])
            columns, open_ = [codes], np.ones(len(codes), bool)
            for lead in range(1, longest):
                open_ = open_[:-1] & goes_on[lead - 1:]
                column = np.full(len(codes), -1, np.int32)
                column[:len(open_)][open_] = codes[lead:][open_]
                columns.append(column)
            table = pa.table([pa.array(group), *map(pa.array, columns)], ["grp", *names])
            del columns, column, bucket, goes_on, open_, piece
            counted = table.group_by(["grp", *names]).aggregate([([], "count_all")])
            del table
            for part in counted.to_batches(max_chunksize=1 << 15):
                def words_of(name):
                    code = part.column(name)
                    return words.take(pc.if_else(pc.greater_equal(code, 0), code, pa.scalar(None, pa.int32()))).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [groups.take(part.column("grp")), *map(words_of, names), part.column("count_all")],
                    ["grp", *names, "n"])
            del counted
            pa.default_memory_pool().release_unused()

    schema = "grp string, " + ", ".join(f"{w} string" for w in names) + ", n long"
    return texts.mapInArrow(run, schema)


def phrase_counts(docs: DataFrame, group: str = "lang", longest: int = LONGEST, least: int = LEAST,
                  buckets: int = PAIR_BUCKETS) -> tuple[DataFrame, DataFrame]:
    """``grp, k, words, f`` of every phrase of 1 to ``longest`` words that
    occurs ``least`` times or more in its group, and ``grp, n``: words of a group."""
    spark = docs.sparkSession
    texts = _texts(docs, group)
    bitmap = spark.sparkContext.broadcast(frequent_pairs(texts, least, buckets))
    names = [f"w{i + 1}" for i in range(longest)]
    counted = alone(spark, lambda: stored(
        windows(texts, longest, bitmap, buckets).groupBy("grp", *names).agg(F.sum("n").alias("n")), "windows"))
    # Prefixes are made from distinct longest windows, which are the top order themselves. A level that
    # cuts a window inside its padding repeats the shorter phrase, so it does not count.
    top = counted.where((F.col("n") >= least) & F.col(names[-1]).isNotNull()).select(
        "grp", F.lit(longest).alias("k"), F.array(*names).alias("words"), F.col("n").alias("f"))
    prefix = names[:-1]
    shorter = counted.rollup("grp", *prefix).agg(F.sum("n").alias("f"), F.grouping_id().alias("open"))
    k = F.lit(longest - 1) - F.length(F.regexp_replace(F.bin("open"), "0", ""))
    last = F.expr("case k " + " ".join(f"when {i + 1} then {w}" for i, w in enumerate(prefix)) + " end")
    totals = F.col("k") == 0
    summed = shorter.withColumn("k", k).where((F.col("k") >= 0) & F.col("grp").isNotNull()
                                              & (totals | (F.lit(least) <= F.col("f")) & last.isNotNull()))
    summed = summed.select("grp", "k", F.when(~totals, F.slice(F.array(*prefix), F.lit(1), F.greatest("k", F.lit(1)))).alias("words"), "f")
    kept = alone(spark, lambda: stored(summed.unionByName(top), "phrases"))
    return kept.where("k > 0"), kept.where("k = 0").select("grp", F.col("f").alias("n"))


def collocations(docs: DataFrame, group: str = "lang", longest: int = LONGEST, least: int = LEAST, best: int = BEST,
                 covered: int = COVERED, buckets: int = PAIR_BUCKETS) -> DataFrame:
    """``grp, rank, phrase, a, l, r, n, score``: the ``best`` phrases of 2 to
    ``longest`` words of each group (null: ``und``) by score.

    A-Z are lower-cased; pieces end at ``. , ; : ! ?`` and line breaks, words at
    spaces and tabs. Candidates occur ``a >= least`` times. A cut after the first
    k words has the score floor(1000 a n / (l r)), l and r being the counts of
    its parts and n the group's words; the worst cut counts, the first of equal
    ones. A candidate goes if a longer one that holds it has ``covered`` percent
    of its count. Equal scores are ordered by a, then by the phrase's bytes.

    Null and empty texts hold no words; repeated rows count again; a very long
    text is one span of a task; an empty table gives no rows; other columns are
    not read.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    phrases, totals = phrase_counts(docs, group, longest, least, buckets)
    cuts = phrases.where("k > 1").select(
        "grp", "k", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    part = phrases.select("grp", "words", "f")
    first, rest = part.toDF("grp", "first", "l"), part.toDF("grp", "rest", "r")
    cuts = cuts.withColumn("first", F.slice("words", F.lit(1), F.col("cut"))) \
        .withColumn("rest", F.slice("words", F.col("cut") + 1, F.col("k") - F.col("cut"))) \
        .join(first, ["grp", "first"]).join(rest, ["grp", "rest"])
    cuts = salted_join(cuts, totals, ["grp"], ["words"]).withColumn("score", _score())
    scored = cuts.groupBy("grp", "words").agg(
        F.min(F.struct("score", "cut", "k", "a", "l", "r", "n")).alias("worst")).select("grp", "words", "worst.*")
    inner = phrases.where("k > 2").select(
        "grp", "f", F.explode(F.flatten(F.transform(
            F.sequence(F.lit(2), F.col("k") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("k") - size + 1),
                                     lambda start: F.slice("words", start, size))))).alias("words"))
    longer = inner.groupBy("grp", "words").agg(F.max("f").alias("f"))
    kept = scored.join(longer.withColumnRenamed("f", "outer"), ["grp", "words"], "left") \
        .where(F.expr(f"outer is null or 100 * outer < {int(covered)} * a"))
    found = kept.select("grp", F.array_join("words", " ").alias("phrase"), "a", "l", "r", "n", "score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    dealt = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    ahead = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("grp", "part").orderBy(*order))) \
        .where(F.col("rank") <= best)
    return ahead.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(*order))) \
        .where(F.col("rank") <= best).select("grp", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _score() -> Column:
    """floor(1000 a n / (l r)) in whole numbers of up to 38 digits."""
    def wide(name: str) -> str:
        return f"cast({name} as decimal(19, 0))"
    return F.expr(f"(1000BD * ({wide('a')} * {wide('n')})) div ({wide('l')} * {wide('r')})")
