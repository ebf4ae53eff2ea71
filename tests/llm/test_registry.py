import os

import pytest

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from oracle_compare import compare, duck
from tidemark.llm import registry
from tidemark.llm.common import stored, table

COLUMNS = {
    "op1_toxicity": ["doc_id:bigint", "held_out:boolean", "score:double", "predicted:int"],
    "op2_decontaminate": ["doc_id:bigint", "n_words:bigint", "n_hit:bigint", "n_items:bigint",
                          "items_sha256:string", "contaminated:boolean"],
    "op3_substring_dedup": ["doc_id:bigint", "n_words:bigint", "n_removed:bigint", "kept_sha256:string"],
    "op4_html_text": ["page_id:bigint", "text:string"],
    "op5_ann": ["query_id:bigint", "rank:int", "vec_id:bigint", "score:double"],
    "op6_kd_shards": ["doc_id:bigint", "size:bigint", "text_crc32:bigint", "law:string", "shard:int", "slot:bigint",
                      "grown_shard:int"],
    "op7_url_filter": ["page_id:bigint", "host:string", "path:string", "rule:string", "verdict:string"],
    "op8_lm_score": ["doc_id:bigint", "held_out:boolean", "n_tokens:bigint", "n_known:bigint", "base_score:double",
                     "score:double", "train_tokens:bigint"],
    "op9_simhash": ["doc_id:bigint", "fingerprint:string", "component_id:bigint"],
    "op10_pack": ["doc_id:bigint", "piece:int", "start:bigint", "length:bigint", "ids_crc32:bigint",
                  "sequence_id:bigint", "offset:bigint"],
    "op11_merkle_manifest": ["doc_id:bigint", "leaf:string", "subroot:string", "root:string", "proof_sha256:string",
                             "folded_root:string", "verified:boolean"],
    "op12_collocations": ["lang:string", "rank:bigint", "phrase:string", "a:bigint", "l:bigint", "r:bigint", "n:bigint",
                          "score:bigint"],
    "op13_language_id": ["doc_id:bigint", "held_out:boolean", "lang_pred:string", "score:double"],
}
INPUT = {"op4_html_text": "pages", "op7_url_filter": "pages", "op5_ann": None, "op10_pack": None,
         "op12_collocations": None}


def test_entry_has_them_all():
    assert set(COLUMNS) | {"pipeline"} <= set(E.queries())
    assert set(registry.oracle_sql()) <= set(COLUMNS) and set(registry.oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    out = registry.queries()[name](spark, SF_SMALL)
    kinds = dict(out.dtypes)
    assert [f"{c.split(':')[0]}:{kinds.get(c.split(':')[0])}" for c in COLUMNS[name]] == COLUMNS[name]
    source = INPUT.get(name, "documents")
    if source:
        assert out.count() == table(spark, SF_SMALL, source).count()
    else:
        assert out.count() > 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, name):
    ok, message = compare(spark, duck(SF_SMALL), name, SF_SMALL, registry.queries()[name], registry.oracle_sql()[name])
    assert ok, message


def test_pipeline_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns, kept = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, SF_SMALL), f"test-{name}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
            assert docs.count() <= kept
            kept = docs.count()
    assert docs.select("doc_id").distinct().count() == kept
    assert corpus_pipeline.run(spark, SF_SMALL).count() == docs.count()


def test_the_subpackage_stands_alone():
    """Nothing else in the library imports it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "tidemark")):
        for name in names:
            if name.endswith(".py") and os.sep + "llm" not in folder:
                with open(os.path.join(folder, name)) as f:
                    assert "tidemark.llm" not in f.read(), name
