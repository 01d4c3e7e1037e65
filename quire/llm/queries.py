"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The tokenizer's file: QUIRE_TOKENIZER if set, else the installed public one."""
    if at := os.environ.get("QUIRE_TOKENIZER"):
        return at
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_lstm import extract_pages

    return extract_pages(spark, table(spark, sf_dir, "pages"))


def op2_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_tools import format_chat

    return format_chat(spark, table(spark, sf_dir, "conversations"))


def op3_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bit_sliced import top_k

    return top_k(spark, table(spark, sf_dir, "embeddings"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(spark, table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_knn import score_quality

    return score_quality(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import license_scan

    return license_scan(spark, table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(spark, table(spark, sf_dir, "documents"), tokenizer_path())


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity_fst import score_toxicity

    return score_toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import merkle_fingerprints

    return merkle_fingerprints(table(spark, sf_dir, "documents"))


def op10_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_join import near_join

    return near_join(spark, table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_html_lstm, op2_chat_tools, op3_bit_sliced, op4_mixing, op5_quality, op6_license_scan, op7_packing, op8_toxicity, op9_merkle, op10_near_join, pipeline)}


#: Paragraphs of op9, as in merkle.py.
_PARAGRAPH = r"[^.!?\n]*[.!?\n][.!? \t\n\r\f]*|[^.!?\n]+"


def _license_sql() -> str:
    from .license_scan import GAP, PHRASES, SHARE, TEMPLATES, WHOLE

    known = ", ".join(f"({k}, '{label}', '{text}', {str(k < len(PHRASES)).lower()})" for k, (text, label) in enumerate([*PHRASES, *[(t, x) for x, t in TEMPLATES]]))
    return rf"""with d as (select row_number() over () as rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
t as (select template, label, base, string_split(text, ' ') as tw from (values {known}) v(template, label, text, base)),
p as (select template, label, base, len(tw) - 1 as pairs, unnest(range(1, len(tw))) as i, tw from t), tp as (select template, label, base, pairs, i - 1 as k, tw[i] as a, tw[i + 1] as b from p),
r as (select rid, unnest(range(1, len(w))) as i, w from d), rp as (select rid, i - 1 as pos, w[i] as a, w[i + 1] as b from r),
h as (select distinct rid, template, label, base, pairs, k, pos - k as diagonal from rp join tp using (a, b)),
g as (select rid, template, label, base, pairs, diagonal, count(*) as own from h group by all),
v as (select g.rid, g.template, g.label, g.base, g.pairs, g.diagonal, g.own, count(distinct h.k) as votes from g join h on h.rid = g.rid and h.template = g.template and h.diagonal between g.diagonal and g.diagonal + {GAP} group by all),
m as (select rid, label, base and own = pairs as is_base, not base and votes >= greatest({SHARE} * pairs, least(pairs, {WHOLE})) as is_own, diagonal, votes / pairs as share from v)
select doc_id, len(w)::bigint as n_words, (select count(*) from m where m.rid = d.rid and is_base)::bigint as n_base, (select min(diagonal) from m where m.rid = d.rid and is_base)::bigint as first_word,
(select max(diagonal) from m where m.rid = d.rid and is_base)::bigint as last_word, coalesce((select string_agg(distinct label, ',' order by label) from m where m.rid = d.rid and is_base), '') as base_labels,
coalesce((select string_agg(distinct label, ',' order by label) from m where m.rid = d.rid and (is_base or is_own)), '') as labels,
case when exists (select 1 from m where m.rid = d.rid and is_base) then 1.0 else coalesce((select round(max(share), 12) from m where m.rid = d.rid and is_own), 0.0) end::double as score from d"""


def _merkle_sql() -> str:
    """Trees, roots and fingerprints; likeness by bags of sections, leaves and neighbours."""
    space = "' ' || chr(9) || chr(10) || chr(13) || chr(12)"

    def tree(x: str) -> str:
        leaves = f"list_transform(regexp_extract_all({x}, '{_PARAGRAPH}'), lambda p: md5(rtrim(p, {space})))"
        return f"list_filter(string_split(regexp_replace(array_to_string({leaves}, ','), '([0-9a-f]{{31}}[08]),', '\\1;', 'g'), ';'), lambda s: s <> '')"

    def spacing(x: str) -> str:
        return f"array_to_string(list_transform(regexp_extract_all({x}, '{_PARAGRAPH}'), lambda p: substr(p, length(rtrim(p, {space})) + 1)), ',')"

    def printed(t: str, s: str) -> str:
        digests = f"list_transform({t}, lambda s: sha256(s))"
        return (
            f"sha256(coalesce(array_to_string({digests}, '.'), '') || '/' || sha256(coalesce({s}, ''))) || '/' || coalesce(array_to_string(list_transform({digests}, lambda x: substr(x, 1, 16)), '.'), '') || ':' || "
            f"regexp_replace(coalesce(array_to_string({t}, ';'), ''), '([0-9a-f]{{8}})[0-9a-f]{{24}}', '\\1', 'g')"
        )

    def counted(x: str) -> str:
        return f"list_transform(range(1, len({x}) + 1), lambda i: ({x})[i] || '#' || len(list_filter(({x})[1:i], lambda y: y = ({x})[i])))"

    def rest(x: str, y: str) -> str:
        return f"flatten(list_transform(list_filter({counted(x)}, lambda z: not list_contains({counted(y)}, z)), lambda z: string_split(string_split(z, '#')[1], ',')))"

    def near(a: str, b: str) -> str:
        return f"""case when string_split({a}, '/')[1] = string_split({b}, '/')[1] then 1.0 when len(l{a}) = 0 or len(l{b}) = 0 then 0.0 else round(
(len(l{a}) - len(r{a}{b}) + len(list_intersect({counted(f"r{a}{b}")}, {counted(f"r{b}{a}")}))) / (len(l{a}) + len(l{b}))::double + len(list_intersect({counted(f"q{a}")}, {counted(f"q{b}")})) / (len(l{a}) + len(l{b}) + 2)::double, 12) end::double"""

    sections = lambda f: f"list_filter(string_split(string_split({f}, ':')[2], ';'), lambda s: s <> '')"
    pairs = lambda v: f"list_transform(range(1, len({v}) + 2), lambda i: (list_concat(['^'], {v}))[i] || (list_concat({v}, ['$']))[i])"
    return f"""with o as (select doc_id, coalesce(text, '') as t, coalesce(lead(coalesce(text, '')) over (order by doc_id desc), first_value(coalesce(text, '')) over (order by doc_id desc)) as n from documents),
e as (select *, substr(t, 1, length(t) - length(t) // 2) || substr(n, 1, length(t) // 2) as x from o),
p as (select doc_id, length(t) as n_chars, sha256(x) as edited_sha256, {tree('t')} as st, {spacing('t')} as wt, {tree('x')} as sx, {spacing('x')} as wx, {tree('n')} as sn, {spacing('n')} as wn from e),
f as (select doc_id, n_chars, edited_sha256, {printed('st', 'wt')} as a, {printed('sx', 'wx')} as b, {printed('sn', 'wn')} as c from p),
s as (select *, {sections('a')} as sa, {sections('b')} as sb, {sections('c')} as sc from f),
l as (select *, flatten(list_transform(sa, lambda s: string_split(s, ','))) as la, flatten(list_transform(sb, lambda s: string_split(s, ','))) as lb, flatten(list_transform(sc, lambda s: string_split(s, ','))) as lc from s),
r as (select *, {rest('sa', 'sb')} as rab, {rest('sb', 'sa')} as rba, {rest('sa', 'sc')} as rac, {rest('sc', 'sa')} as rca, {pairs('la')} as qa, {pairs('lb')} as qb, {pairs('lc')} as qc from l)
select doc_id, n_chars::bigint as n_chars, edited_sha256, a as fingerprint, b as edited_fingerprint, {near('a', 'b')} as near_edited, {near('a', 'c')} as near_next from r"""


_TOP_SQL = """with v as (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as x from embeddings
where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (select q.r, q.vec_id as query_id, c.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i]))::bigint as score from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.x) = len(c.x)),
k as (select *, row_number() over (partition by r order by score desc, vec_id) as n from s)
select query_id, n::integer as rank, vec_id, score from k where n <= 5"""

#: Sets of shingles as texts, links by counted joins, components by reachability.
_NEAR_SQL = r"""with recursive d as (select row_number() over () as rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
g as (select rid, doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as sh from d),
s as (select rid, len(sh) as n, unnest(sh) as x from g),
p as (select a.rid as a, b.rid as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as c from s a join s b on a.x = b.x and a.rid <> b.rid group by 1, 2),
e as (select a, b from p where 100 * c >= 75 * (na + nb - c)),
r as (select rid, rid as to_ from d union select r.rid, e.b from r join e on r.to_ = e.a),
m as (select r.rid, min(d.doc_id) as component_id from r join d on d.rid = r.to_ group by 1)
select doc_id, len(sh)::bigint as n_shingles, component_id from g join m using (rid)"""

#: For conversations without calls, schemas and results, as the given ones are: every message is plain content.
_CHAT_SQL = """select conv_id, turn, role, '{"content":' || coalesce(to_json(text)::varchar, 'null') || ',"role":' || coalesce(to_json(role)::varchar, 'null') || '}' as json, 0::bigint as n_calls, 0::bigint as n_linked, 0::bigint as n_valid, 0::bigint as n_cyclic from conversations"""


def oracle_sql() -> dict[str, str]:
    """Learned models, tokenizers and seeded hashes are beyond SQL: the others' results are here."""
    return {"op2_chat_tools": _CHAT_SQL, "op3_bit_sliced": _TOP_SQL, "op6_license_scan": _license_sql(), "op9_merkle": _merkle_sql(), "op10_near_join": _NEAR_SQL}
