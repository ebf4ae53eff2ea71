"""Registered queries of the operators, and their SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    ann, collocations, decontaminate, html_text, langid, lm_score, merkle, packing, sharding, simhash, substring_dedup,
    toxicity, url_filter)
from tidemark.llm.common import prepare, table

#: Rules of the URL query.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
SHARDS = 40
#: Vocabulary of the packing query.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    fold = toxicity.held_out(F.col("doc_id"))
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~fold)
    return toxicity.score(docs, model).select("doc_id", fold.alias("held_out"), "score", "predicted", "clauses")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated 50-word windows, as a digest."""
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every 20th vector."""
    return ann.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of near-equal bytes."""
    return sharding.law_columns(sharding.kd_shards(table(spark, sf_dir, "documents"), SHARDS))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"),
                                 url_filter.rule_table(spark, URL_RULES))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document; learned outside the held-out fold."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    return lm_score.score(table(spark, sf_dir, "documents"), fold)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces and their places in packed sequences."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof; a third of them with lower-cased text, which must not verify."""
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.check_tampering(table(spark, sf_dir, "documents"), changed,
                                  F.translate(F.col("text"), UPPER, UPPER.lower()))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two to five words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents")).withColumnRenamed("grp", "lang")


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = langid.learn(docs, ~fold)
    return langid.predict(docs.select("doc_id", fold.alias("held_out"), "text"), model)


_QUERIES = [op1_toxicity, op2_decontaminate, op3_substring_dedup, op4_html_text, op5_ann, op6_kd_shards, op7_url_filter, op8_lm_score, op9_simhash, op10_pack,
            op11_merkle_manifest, op12_collocations, op13_language_id]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def prepared(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        return run
    return {fn.__name__: prepared(fn) for fn in _QUERIES}


_OP7_SQL = """
with parts as (
  select page_id, case when position('://' in url) > 0
                       then substr(url, position('://' in url) + 3) else '' end as rest
  from pages),
urls as (
  select page_id,
         translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
  from parts),
rules(verdict, rhost, rpath) as (
  values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
judged as (
  select host, path, arg_max(rhost || rpath, length(rhost || rpath)) as rule,
         arg_max(verdict, length(rhost || rpath)) as verdict
  from (select distinct host, path from urls) u join rules
    on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
  group by host, path)
select u.page_id, u.host, u.path, j.rule, coalesce(j.verdict, 'allow') as verdict
from urls u left join judged j on u.host = j.host and u.path = j.path
"""


_OP2_SQL = r"""
with words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
items as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
item_windows as (
  select distinct item_id, n, array_to_string(w[s : s + n - 1], ' ') as win
  from (select item_id, w, least(10, len(w)) as n,
               unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s
        from items where len(w) > 0)),
sizes as (select distinct n from item_windows),
doc_windows as (
  select doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s
        from words, sizes where len(w) >= n)),
hits as (select doc_id, s, n, item_id from doc_windows join item_windows using (n, win)),
places as (select distinct doc_id, unnest(range(s, s + n)) as p from (select distinct doc_id, s, n from hits)),
counted as (select doc_id, count(*) as n_hit from places group by doc_id),
listed as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select words.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from words left join counted using (doc_id) left join listed using (doc_id)
"""


_OP3_SQL = r"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, s, md5(array_to_string(w[s : s + 49], ' ')) as win
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as s from texts where len(w) >= 50)),
firsts as (select win, min(doc_id) as first_doc from windows group by win),
gone as (
  select distinct doc_id, unnest(range(s, s + 50)) as p
  from windows join firsts using (win) where first_doc < doc_id),
removed as (select doc_id, count(*) as n from gone group by doc_id),
placed as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from texts),
kept as (
  select doc_id, string_agg(word, ' ' order by p) as text
  from placed anti join gone using (doc_id, p) group by doc_id)
select texts.doc_id, cast(len(w) as bigint) as n_words, coalesce(removed.n, 0) as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from texts left join removed using (doc_id) left join kept using (doc_id)
"""


_OP11_SQL = """
with recursive docs as (
  select doc_id, lang, coalesce('+' || lang, '') as tree, text,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low,
         coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head
  from documents),
hashed as (
  select doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
         sha256(head || coalesce(strlen(low) || ':' || low, '-')) as low_leaf
  from docs),
-- CRC-32 of the decimal id, digit by digit, by its polynomial.
digits as (select doc_id, doc_id::varchar as s, 1 as i, 4294967295::ubigint as c from hashed
  union all
  select doc_id, s, i + 1,
         xor(c >> 8, list_reduce([xor(c, ascii(s[i])::ubigint) & 255] || range(8),
                                 lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384::ubigint)
                                                   else x >> 1 end))
  from digits where i <= len(s)),
shown as (select doc_id from digits where i = len(s) + 1 and xor(c, 4294967295::ubigint) % 3 = 0),
leaves as (
  select h.doc_id, tree, leaf,
         case when s.doc_id is null then leaf else low_leaf end as shown,
         row_number() over (partition by tree order by h.doc_id nulls first, leaf) - 1 as idx,
         count(*) over (partition by tree) as n
  from hashed h left join shown s on h.doc_id = s.doc_id),
nodes(tree, level, idx, n, h) as (
  select tree, 0, idx, n, leaf from leaves
  union all
  select tree, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' order by idx))
  from nodes where n > 1 group by tree, level, n, idx // 8),
subroots as (select tree, level as height, h from nodes where n = 1),
tops as (select tree, height, h, row_number() over (order by tree) - 1 as idx, count(*) over () as n from subroots),
crown(level, idx, n, h) as (
  select 0, idx, n, h from tops
  union all
  select level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' order by idx))
  from crown where n > 1 group by level, n, idx // 8),
low_sides as (
  select tree, level, idx,
         coalesce(string_agg(h, '') over (run rows between unbounded preceding and 1 preceding), '') as l,
         coalesce(string_agg(h, '') over (run rows between 1 following and unbounded following), '') as r
  from nodes where n > 1 window run as (partition by tree, level, idx // 8 order by idx)),
top_sides as (
  select level, idx,
         coalesce(string_agg(h, '') over (run rows between unbounded preceding and 1 preceding), '') as l,
         coalesce(string_agg(h, '') over (run rows between 1 following and unbounded following), '') as r
  from crown where n > 1 window run as (partition by level, idx // 8 order by idx)),
sides as (
  select l.tree, l.leaf, l.idx as pos, s.level, s.l, s.r
  from leaves l join low_sides s on s.tree = l.tree and s.idx = l.idx // (8 ** s.level)::bigint
  union all
  select l.tree, l.leaf, l.idx, t.height + s.level, s.l, s.r
  from leaves l join tops t on t.tree = l.tree join top_sides s on s.idx = t.idx // (8 ** s.level)::bigint),
paths as (
  select tree, pos, list({l: l, r: r} order by level) as path, string_agg(l || r, '' order by level) as proof
  from sides group by tree, pos),
folded as (
  select l.doc_id, l.tree, l.leaf, l.shown, coalesce(p.proof, '') as proof,
         coalesce(p.path, []) as path, 1 as i, l.shown as h, l.idx as pos
  from leaves l left join paths p on p.tree = l.tree and p.pos = l.idx
  union all
  select doc_id, tree, leaf, shown, proof, path, i + 1, sha256(path[i].l || h || path[i].r), pos
  from folded where i <= len(path))
select f.doc_id, f.leaf, t.h as subroot, (select h from crown where n = 1) as root,
       sha256(f.proof) as proof_sha256, f.h as folded_root,
       f.h = (select h from crown where n = 1) as verified
from folded f join tops t on t.tree = f.tree where f.i = len(f.path) + 1
"""


_OP12_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
listed as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, k, array_to_string(w[s : s + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as s
        from (select lang, w, unnest(range(1, 6)) as k from listed) where len(w) >= k)),
counts as (select lang, phrase, k, count(*) as f from grams group by all having count(*) >= 100),
totals as (select lang, sum(len(w)) as n from listed group by lang),
candidates as (select lang, phrase, k, f as a, string_split(phrase, ' ') as w from counts where k > 1),
cuts as (
  select lang, phrase, a, cut, array_to_string(w[1 : cut], ' ') as head, array_to_string(w[cut + 1 :], ' ') as tail
  from (select *, unnest(range(1, k)) as cut from candidates)),
scored as (
  select c.lang, c.phrase, c.a, c.cut, l.f as l, r.f as r, n,
         (1000::hugeint * c.a * n) // (l.f::hugeint * r.f) as score
  from cuts c join totals using (lang)
  join counts l on l.lang = c.lang and l.phrase = c.head
  join counts r on r.lang = c.lang and r.phrase = c.tail),
worst as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inside as (
  select lang, array_to_string(w[s : s + m - 1], ' ') as phrase, max(a) as outer_a
  from (select *, unnest(range(1, k - m + 2)) as s
        from (select lang, w, k, a, unnest(range(2, k)) as m from candidates))
  group by all)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
       a, l, r, n::bigint as n, score::bigint as score
from worst left join inside using (lang, phrase)
where outer_a is null or 100 * outer_a < 100 * a
qualify rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": _OP2_SQL, "op3_substring_dedup": _OP3_SQL, "op7_url_filter": _OP7_SQL,
            "op11_merkle_manifest": _OP11_SQL, "op12_collocations": _OP12_SQL}
