"""The registered queries of this package: name -> query, name -> reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann_tree, bpe_chunks, cross_tokens, dac, decontaminate, exact_dedup, hyperminhash, importance, language_hd, license_scan, packing, url_boost, warc
from .common import table
from .url_boost import LOWER, UPPER

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: A word of ASCII letters and digits and whatever is beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def query(name: str, sql: str | None = None):
    """Registers a query; ``sql`` is its equivalent over the same tables."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_ann_tree")
def op1_ann_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op2_bpe_chunks")
def op2_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_chunks.round_trip(table(spark, sf_dir, "documents"))


@query("op3_language_hd")
def op3_language_hd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_hd.predictions(table(spark, sf_dir, "documents"))


@query("op4_pack_tiers")
def op4_pack_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op5_dac_files")
def op5_dac_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.round_trip(table(spark, sf_dir, "documents"))


@query(
    "op6_hyperminhash",
    f"""
    with recursive w as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^ \\t-\\r]+') as ws from documents),
    s as (select doc_id, case when len(ws) < 2 then ws else list_distinct([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]) end as sh from w),
    e as (select doc_id, len(sh) as n, unnest(sh) as x from s),
    pair as (select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as k from e a join e b on a.x = b.x and a.doc_id < b.doc_id group by all),
    link as (select a, b from pair where 100 * k >= 80 * (na + nb - k)),
    sym as (select a, b from link union select b, a from link),
    reach(a, b) as (select doc_id, doc_id from documents union select reach.a, sym.b from reach join sym on sym.a = reach.b),
    least as (select a, min(b) as component_id from reach group by a)
    select s.doc_id, cast(len(sh) as bigint) as n_shingles, component_id, s.doc_id = component_id as kept from s join least on least.a = s.doc_id
    """,
)
def op6_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.groups(table(spark, sf_dir, "documents"), words_each=2, percent=80)


@query(
    "op7_warc_chunks",
    """
    with p as (select page_id, coalesce(html, '') as body from pages),
    h as (select page_id, strlen(body) as payload_bytes, sha1(body) as hex, max(page_id) over (partition by body) as keeper from p),
    b as (select *, array_to_string([substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * instr('0123456789abcdef', c) - 3, 4) for c in string_split(hex, '')], '') as bits from h)
    select page_id, cast(payload_bytes as bigint) as payload_bytes,
      array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum([cast(substr(bits, 5 * i + j, 1) as int) * (32 >> j) for j in range(1, 6)])::int, 1) for i in range(0, 32)], '') as payload_digest,
      case when page_id = keeper then 'response' else 'revisit' end as record_type, case when page_id <> keeper then keeper end as refers_to
    from b
    """,
)
def op7_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.matches(table(spark, sf_dir, "documents"))


@query(
    "op9_bloom_dedup",
    """
    with d as (select doc_id, regexp_replace(coalesce(text, ''), '[ \\t-\\r]+', ' ', 'g') as t from documents)
    select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
           doc_id = min(doc_id) over same as kept, sha256(t) as text_sha256
    from d window same as (partition by t)
    """,
)
def op9_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


@query("op10_url_boost")
def op10_url_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_boost.judged(table(spark, sf_dir, "pages"))


@query("op11_merge_path")
def op11_merge_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokens.judged(table(spark, sf_dir, "documents"))


@query(
    "op12_suffix_automaton",
    f"""
    with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as ws from documents),
    b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as ws from benchmark),
    bw as (select item_id, least(10, len(ws)) as w, unnest(list_transform(range(1, len(ws) - least(10, len(ws)) + 2), lambda i: array_to_string(ws[i : i + least(10, len(ws)) - 1], ' '))) as g
           from b where len(ws) > 0),
    win as (select distinct item_id, w, g from bw),
    sizes as (select distinct w from win),
    dg as (select doc_id, w, unnest(list_transform(range(1, len(ws) - w + 2), lambda i: {{'i': i, 'g': array_to_string(ws[i : i + w - 1], ' ')}})) as s from d, sizes where len(ws) >= w),
    occ as (select doc_id, s.i as i, dg.w as w, item_id from dg join win on dg.w = win.w and dg.s.g = win.g),
    hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + w)) as p from occ) group by doc_id),
    its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from occ where item_id is not null) group by doc_id)
    select d.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join hit on hit.doc_id = d.doc_id left join its on its.doc_id = d.doc_id
    """,
)
def op12_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op13_position_crc",
    f"""
    with tab as materialized (select list(list_reduce([i] || list_transform(range(8), lambda z: 0), lambda a, b: case when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end) order by i) as t from range(256) r(i)),
    w as (select 0 as side, doc_id as id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as ws from documents
      union all select 1, item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') from benchmark),
    f as (select side, id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]), list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) as x from w),
    c as (select side, id, x, count(*) as n from f group by all),
    u as (select x, list_transform(range(0, len(hex(x)) // 2), lambda i: (instr('0123456789ABCDEF', hex(x)[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', hex(x)[2 * i + 2]) - 1) as b from (select distinct x from c)),
    h as (select x, xor(list_reduce([4294967295] || b, lambda a, y: xor(a // 256, t[1 + xor(a, y) % 256])), 4294967295) % 10000 as bucket from u, tab),
    k as (select bucket, coalesce(sum(n) filter (side = 0), 0) as s, coalesce(sum(n) filter (side = 1), 0) as t from c join h using (x) group by bucket),
    whole as (select sum(s)::double as s, sum(t)::double as t from k),
    g as (select bucket, floor(1000 * ln((k.t::double + 1) * (whole.s + 10000) / ((k.s::double + 1) * (whole.t + 10000))))::bigint as gain from k, whole),
    d as (select id, sum(n) as n_features, sum(n * gain) as weight from c join h using (x) join g using (bucket) where side = 0 group by id),
    r as (select id as doc_id, len(ws) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
        coalesce(weight, 0)::bigint + floor(-1000.0::double * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::bigint + 0.5::double) / 4294967296.0::double)))::bigint as score from w left join d using (id) where side = 0),
    o as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from r where n_words >= 20)
    select doc_id, n_features, weight, score, case when place <= n * 5 // 100 then place end as rank, n_words from r left join o using (doc_id)
    """,
)
def op13_position_crc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
