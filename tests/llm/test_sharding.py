import zlib

from conftest import SF_SMALL
from tidemark.llm.sharding import kd_shards, shard_report

from .conftest import doc_frame


def test_sizes_slots_and_equal_bytes(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = kd_shards(docs, shards=7).collect()
    assert sorted(r.doc_id for r in rows) == sorted(text)
    per = {}
    for r in rows:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        per.setdefault(r.shard, []).append(r)
    assert set(per) == set(range(7))
    goal = sum(r.size for r in rows) / 7
    largest = max(r.size for r in rows)
    for members in per.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert abs(sum(r.size for r in members) - goal) <= largest + 0.01 * goal


def test_equal_texts_share_a_shard_unless_too_many(spark):
    rows = [(i, f"text {i} " * 20) for i in range(400)]
    rows += [(1000 + i, "pair " * 30) for i in range(2)]
    rows += [(2000 + i, "hot copy " * 20) for i in range(300)]
    placed = kd_shards(doc_frame(spark, rows), shards=4)
    by_doc = {r.doc_id: r.shard for r in placed.collect()}
    assert by_doc[1000] == by_doc[1001]
    assert len({by_doc[2000 + i] for i in range(300)}) > 1
    report = [r.bytes for r in shard_report(placed).collect()]
    assert max(report) < 1.1 * min(report)


def test_target_bytes_decide_the_number(spark, odd_docs):
    placed = kd_shards(doc_frame(spark, odd_docs), target_bytes=100_000).collect()
    total = sum(r.size for r in placed)
    assert len(placed) == len(odd_docs)
    assert {r.shard for r in placed} <= set(range(-(-total // 100_000)))


def test_odd_rows_and_few_documents(spark, odd_docs):
    rows = kd_shards(doc_frame(spark, odd_docs), shards=40).collect()
    assert len(rows) == len(odd_docs)
    assert {r.size for r in rows if r.doc_id == 24} == {16}
    assert len(kd_shards(doc_frame(spark, [(1, "a")]), shards=3).collect()) == 1
    assert kd_shards(doc_frame(spark, odd_docs).limit(0), shards=3).collect() == []
