"""Queries of crosswalks, exports and scalar functions, added to the catalogue's registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import lookups
from ..sources import crosswalks as C
from .catalogue import Tables, query


def _works(spark, d):
    p = Tables(spark, d).part
    parts = lambda *xs: F.struct(F.array(F.array(*xs)).alias("date-parts"))
    size = F.col("p_size")
    return p.select(
        F.concat(F.lit("10.1000/p"), "p_partkey").alias("DOI"), F.concat(F.lit("http://h.example/"), "p_partkey").alias("URL"), F.when(size % 5 == 0, "journal-issue").when(size % 5 == 1, "book-chapter").otherwise("journal-article").alias("type"),
        F.array("p_name").alias("title"), F.array("p_type").alias("subtitle"), F.array("p_brand").alias("container-title"), F.when(size % 7 == 0, "test").otherwise(F.col("p_brand")).alias("publisher"),
        F.concat_ws("-", size, size + 3).alias("page"), F.lpad(size.cast("string"), 4, "0").alias("volume"), F.lit("00").alias("issue"), F.lit("").alias("language"), F.lit(None).cast("string").alias("abstract"),
        *[F.array().cast("array<string>").alias(c) for c in ("ISSN", "ISBN", "subject")], F.array(F.struct(F.lit(" A#na ").alias("given"), F.lit("B&NA;e").alias("family"))).alias("author"),
        F.lit(None).cast("struct<`date-parts`:array<array<int>>>").alias("published-print"), parts(1990 + size % 40, F.when(size % 11 == 0, 13).otherwise(2)).alias("issued"), parts(F.lit(2000)).alias("created"), parts(F.lit(2001)).alias("deposited"),
    )


_NOW = "2025-01-01"
_WORKS = """select 'ai-49-' || rtrim(translate(to_base64(encode('10.1000/p' || p_partkey)), '+/', '-_'), '=') as id, '10.1000/p' || p_partkey as doi,
case when p_size % 5 = 1 then p_brand || ': ' else '' end || case when contains(p_name, p_type) or contains(p_name, ':') then p_name else p_name || ' : ' || p_type end as title,
ltrim(p_size::varchar, '0') as volume, case when p_size > 0 then '4' end as page_count, case when p_size % 7 = 0 then 'test' else p_brand end || ' (CrossRef)' as collection,
case when p_size % 11 = 0 then '2000-01-01' else (1990 + p_size % 40) || '-02-01' end as day, 'Be, Ana' as author,
case when p_size % 11 <> 0 and make_date(1990 + p_size % 40, 2, 1) > date '2027-01-01' then 'TOO_FUTURISTIC' when p_size % 5 = 0 then 'JOURNAL_ISSUE' when p_size % 7 = 0 then 'BLACKLISTED_COLLECTION' end as skip_reason from part"""


@query(_WORKS)
def c01_works(spark, d):
    w = C.FORMATS["works"](_works(spark, d), F.lit(_NOW).cast("timestamp"))
    a = F.get("authors", F.lit(0))
    return w.select("id", "doi", "title", "volume", "page_count", F.get("collections", F.lit(0)).alias("collection"), F.col("date").cast("string").alias("day"), S.author_name(a["name"], a["last"], a["first"], F.lit(None)).alias("author"), "skip_reason")


def _dc(spark, d):
    p = Tables(spark, d).pages
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    resolved = F.concat(F.lit("http://dx.doi.org/10.1000/"), "page_id")
    return p.select(
        F.concat(F.lit("oai:"), "page_id").alias("identifier"), F.array(title).alias("title"), F.array(F.concat("url", F.lit(" ,"))).alias("creator"), F.array(F.col("url"), resolved, F.lit("x")).alias("links"),
        F.when(F.col("page_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("Press"))).alias("publisher"), F.array(F.lit("s")).alias("subject"), F.array(F.lit("eng")).alias("language"), F.array(F.lit("a"), F.lit("b")).alias("description"),
        F.array(F.when(F.col("page_id") % 4 == 0, "199").when(F.col("page_id") % 4 == 1, "").otherwise("1993-05-06 00:00:00.0")).alias("date"),
    )


@query("""select 'oai:' || page_id as record_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, '10.1000/' || page_id as doi, case when page_id % 3 = 0 then 'HighWire' else 'Press (HighWire)' end as collection,
case when page_id % 4 > 1 then '1993-05-06' end as day, case when page_id % 4 <= 1 then 'NO_DATE' end as skip_reason from pages""")
def c17_dc_journals(spark, d):
    r = C.FORMATS["dc-journals"](_dc(spark, d))
    return r.select("record_id", "title", "doi", F.get("collections", F.lit(0)).alias("collection"), F.col("date").cast("string").alias("day"), "skip_reason")


@query("""select 'ai-12502-' || page_id as id, case when page_id % 4 > 1 then '1993-01-01' end as day, case page_id % 4 when 0 then 'SHORT_DATE' when 1 then 'EMPTY_DATE' end as skip_reason from pages""")
def c19_dc_archive(spark, d):
    return C.FORMATS["dc-archive"](_dc(spark, d)).select("id", F.col("date").cast("string").alias("day"), "skip_reason")


@query("select regexp_extract(html, '<title>([^<]*)</title>', 1) as title from pages")
def c26_titles(spark, d):
    return C.FORMATS["titles"](_dc(spark, d).select(F.get("title", F.lit(0)).alias("title"))).select("title")


@query("select d.doc_id, case when source = 'src3' then false when source = 'src1' then true else coalesce(l.q, case when lang = 'en' then true end, false) end as open_access from documents d left join (select doc_id, max(quality) = 1 as q from labels group by doc_id) l on d.doc_id = l.doc_id")
def x04_open_access(spark, d):
    t = Tables(spark, d)
    free = t.labels.groupBy("doc_id").agg((F.max("quality") == 1).alias("free"))
    docs = t.documents.select("doc_id", "lang", F.col("source").alias("source_id"), F.lit(None).cast("boolean").alias("open_access")).join(free, "doc_id", "left")
    return C.flag_open_access(docs, ["src1"], ["src3"], F.col("lang") == "en", F.col("free")).select("doc_id", "open_access")


@query("select p_partkey, p_size::varchar as n from part")
def f27_roman(spark, d):
    tens = F.element_at(F.array(*[F.lit(x) for x in ("", "X", "XX", "XXX", "XL", "L")]), (F.floor(F.col("p_size") / 10) + 1).cast("int"))
    ones = F.element_at(F.array(*[F.lit(x) for x in ("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX")]), (F.col("p_size") % 10 + 1).cast("int"))
    return Tables(spark, d).part.select("p_partkey", S.roman(F.concat(tens, ones)).alias("n"))


@query("select p_partkey, regexp_replace(p_type, 'STEEL|TIN', '', 'g') as kind from part")
def f18_remove_all(spark, d):
    return Tables(spark, d).part.select("p_partkey", S.remove_all(F.col("p_type"), ["STEEL", "TIN"]).alias("kind"))


@query("select o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as day from orders")
def f24_date_parts(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", S.date_of_parts(F.array(F.year("o_orderdate"), F.month("o_orderdate"))).cast("string").alias("day"))


@query("select c_custkey, c_mktsegment || case when c_custkey % 2 = 0 then ' : ' else ' : ' || c_name || ', ' end || (1900 + c_custkey % 100) as imprint from customer")
def f12_imprint(spark, d):
    k = F.col("c_custkey")
    return Tables(spark, d).customer.select("c_custkey", S.imprint(F.col("c_mktsegment"), F.when(k % 2 == 1, F.col("c_name")), (1900 + k % 100)).alias("imprint"))


@query("select p_partkey, lower(p_brand) || '|' || p_type as parts from part")
def f37_split_trim(spark, d):
    joined = F.concat(F.lit(" ;"), F.lower("p_brand"), F.lit(" ; ;"), "p_type", F.lit(";"))
    return Tables(spark, d).part.select("p_partkey", F.array_join(S.split_trim(joined, ";"), "|").alias("parts"))


@query("select user_id, string_agg(event_type, ',' order by event_type) filter (event_type <> 'click') as types from events group by user_id having count(*) filter (event_type <> 'click') > 0")
def t05_remove_each(spark, d):
    per = Tables(spark, d).events.groupBy("user_id").agg(F.array_sort(F.collect_list("event_type")).alias("t"))
    return per.select("user_id", F.array_join(S.remove_each(F.col("t"), F.array(F.lit("click"))), ",").alias("types")).filter("types <> ''")


@query("select event_id, json_extract_string(props, '$.k') as k, md5(props) as hash from events where json_valid(props)")
def p02_tabular(spark, d):
    return Tables(spark, d).events.filter(F.try_parse_json("props").isNotNull()).select("event_id", F.get_json_object("props", "$.k").alias("k"), F.md5("props").alias("hash"))


@query("select o_orderkey from orders where year(o_orderdate) between 1993 and 1995")
def p23_year_range(spark, d):
    """The bounds reach the scan as dates."""
    at = F.col("o_orderdate")
    return Tables(spark, d).orders.filter((at >= F.lit("1993-01-01").cast("timestamp_ntz")) & (at < F.lit("1996-01-01").cast("timestamp_ntz"))).select("o_orderkey")


@query("select o_orderkey, l_partkey from orders left join (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) k from lineitem) on o_orderkey = l_orderkey and k = 1")
def j06_first_match(spark, d):
    t = Tables(spark, d)
    files = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("pos"))
    return lookups.first_match_join(t.orders.select("o_orderkey"), files, "o_orderkey", "l_partkey", "pos")


@query("""select c_custkey, true as matched from customer where c_acctbal <= 0 or c_custkey in (select o_custkey from orders)
union all select c_custkey, false from customer where c_acctbal > 0 and c_custkey not in (select o_custkey from orders)""")
def j08_conditional_join(spark, d):
    t = Tables(spark, d)
    keys = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return lookups.conditional_match(t.customer.select("c_custkey", "c_acctbal"), keys, "c_custkey", F.col("c_acctbal") > 0).select("c_custkey", "matched")


@query("select doc_id, coalesce(nullif(list_position(['src3', 'src1'], source), 0) - 1, 9999)::bigint as place from documents")
def o11_preference(spark, d):
    return Tables(spark, d).documents.select("doc_id", lookups.preference(F.col("source"), ["src3", "src1"]).alias("place"))
