"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, fim, html_text, licenses, pii, pseudo, search, shard, simhash, suffix_dedup, topk, toxicity
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode(table(spark, sf_dir, "documents"), word_bpe_path(), keep=["doc_id"], decoded="decoded")
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    ids = F.array_join(F.array_sort("items"), ",")
    return found.select("doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), keep=["page_id"])


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.assign(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated(table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo.word_score(table(spark, sf_dir, "documents"))


#: A production run takes its key from a secret store; this one only makes the queries' results repeatable.
PII_KEY = "demonstration key"


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    places = licenses.base_places()
    return found.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        F.array_join(licenses.labels(only_base=True), ",").alias("base_labels"), F.array_join(licenses.labels(), ",").alias("labels"), licenses.score().alias("score"),
    )


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"), keep=["doc_id"], restored="restored")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe": op2_bpe,
    "op3_decontaminate": op3_decontaminate,
    "op4_html_text": op4_html_text,
    "op5_simhash": op5_simhash,
    "op6_topk": op6_topk,
    "op7_shard": op7_shard,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_pseudo_likelihood": op9_pseudo_likelihood,
    "op10_pii": op10_pii,
    "op11_licenses": op11_licenses,
    "op12_search": op12_search,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _descend_sql(node: shard.Node) -> str:
    if not node.children:
        return str(node.shard)
    if len(node.children) == 1:
        return _descend_sql(node.children[0])
    draws = ", ".join(f"{{'d': -ln((('0x' || substr(md5(doc_id || '|{c.name}'), 1, 13))::bigint + 0.5) / 4503599627370496.0) / {c.weight}, 'i': {i}}}" for i, c in enumerate(node.children))
    return f"case list_sort([{draws}])[1].i " + " ".join(f"when {i} then {_descend_sql(c)}" for i, c in enumerate(node.children)) + " end"


ORACLE_SQL: dict[str, str] = {
    "op6_topk": """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
           where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
r as (select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from s)
select * from r where rank <= 20""",
    "op7_shard": f"""
with bits as (select n, list_reduce([n] || range(8), lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256) t(n)),
crc as (select list(c order by n) as tab from bits),
d as (select doc_id, (octet_length(encode(coalesce(text, ''))) + 8)::bigint as size,
             regexp_extract_all(hex(encode(coalesce(text, ''))), '..') as x from documents),
s as (select doc_id, size, xor(list_reduce([4294967295] || list_transform(x, lambda h: ('0x' || h)::bigint), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) as text_crc32,
             ({_descend_sql(shard.tree(24))})::int as shard, ({_descend_sql(shard.tree(25))})::int as grown_shard from d, crc)
select doc_id, size, text_crc32, 'key' as law, shard, row_number() over (partition by shard order by doc_id, text_crc32, size) - 1 as slot, grown_shard from s""",
    "op3_decontaminate": f"""
with d as (select doc_id, {_WORDS} as w from documents),
i as (select item_id, {_WORDS} as w from benchmark),
iw as (select item_id, w, least(len(w), 13) as s, unnest(range(1, len(w) - least(len(w), 13) + 2)) as p from i where len(w) > 0),
win as (select distinct item_id, s, array_to_string(w[p:p + s - 1], ' ') as k from iw),
dp as (select doc_id, s, p, array_to_string(w[p:p + s - 1], ' ') as k
       from (select doc_id, w, s, unnest(range(1, len(w) - s + 2)) as p from d, (select distinct s from win))),
m as (select doc_id, item_id, p, s from dp join win using (s, k)),
hits as (select doc_id, count(distinct q) as n from (select doc_id, unnest(range(p, p + s)) as q from m) group by 1),
its as (select doc_id, count(*) as c, sha256(string_agg(item_id, ',' order by item_id)) as h
        from (select distinct doc_id, item_id::varchar as item_id from m) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_hit, coalesce(c, 0)::bigint as n_items,
       coalesce(h, sha256('')) as items_sha256, coalesce(n, 0) > 0 and 20 * coalesce(n, 0) >= len(w) as contaminated
from d left join hits using (doc_id) left join its using (doc_id)""",
    "op8_suffix_dedup": """
with d as materialized (select doc_id, row_number() over () as r, hex(encode(coalesce(text, ''))) as x from documents),
c as materialized (select r, i, substr(x, 2 * i + 1, 2398) as p, length(x) // 2 as n from (select r, x, unnest(range(0, length(x) // 2 - 199, 1000)) as i from d)),
w as materialized (select r, i + j as s, md5_number(substr(p, 2 * j + 1, 400)) as k from (select r, i, p, unnest(range(0, least(1000, n - 199 - i))) as j from c)),
g as (select k from w group by k having count(*) > 1),
s as materialized (select r, s from w semi join g using (k)),
m as (select r, s, case when s <= lag(s) over (partition by r order by s) + 200 then 0 else 1 end as new from s),
i as (select r, s, sum(new) over (partition by r order by s rows unbounded preceding) as island from m),
e as materialized (select r, island, min(s) as a, max(s) + 200 as b from i group by r, island),
k as (select r, a, lag(b, 1, 0) over (partition by r order by a) as from_, a as to_ from e union all select r, null, max(b), null from e group by r),
p as (select d.r, string_agg(substr(x, 2 * from_ + 1, 2 * (coalesce(to_, length(x) // 2) - from_)), '' order by from_) as kept from d join k using (r) group by d.r),
t as (select r, sum(b - a)::bigint as n_removed, count(*) as n_spans from e group by r)
select doc_id, (length(x) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(kept, x))) as kept_sha256
from d left join t using (r) left join p using (r)""",
    "op12_search": r"""
with dt as (select row_number() over () as r, doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as w from documents),
low as (select r, doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w from dt),
it as (select distinct item_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w
       from (select item_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as w from benchmark)),
len as (select r, count(*) as n from low group by r),
tot as (select count(*) as nn, sum(n)::bigint as l from len),
tf as (select r, any_value(doc_id) as doc_id, w, count(*) as tf from low where w in (select w from it) group by r, w),
wt as (select w, floor(1000 * ln((2 * any_value(nn) + 2)::double / (2 * count(*) + 1)))::bigint as weight from tf, tot group by w),
sc as (select item_id, r, any_value(doc_id) as doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l))))::bigint as score
       from it join tf using (w) join wt using (w) join len using (r), tot group by item_id, r),
rk as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from sc where score > 0)
select * from rk where rank <= 10""",
    "op13_fill_in_middle": """
with d as (select doc_id, coalesce(text, '') as t, length(coalesce(text, ''))::bigint as n, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
k as (select *, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
f as (select *, least(h1 % (n + 1), h2 % (n + 1)) as i, greatest(h1 % (n + 1), h2 % (n + 1)) as j,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from k),
c as (select *, substring(t, 1, i) as p, substring(t, i + 1, j - i) as m, substring(t, j + 1) as s from f)
select doc_id, n, form, case when form <> 'plain' then i end as prefix_chars, case when form <> 'plain' then j - i end as middle_chars,
       sha256(case form when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else t end) as output_sha256, sha256(t) as restored_sha256
from c""",
}
