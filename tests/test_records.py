import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.functions import scalars as S
from quire.functions import text as X
from quire.operators import lookups
from quire.sources import crosswalks as C
from quire.sources import exports

WORKS = """DOI string, URL string, type string, publisher string, volume string, issue string, page string, language string, abstract string, title array<string>, subtitle array<string>,
`container-title` array<string>, ISSN array<string>, ISBN array<string>, subject array<string>, author array<struct<given string, family string>>, `published-print` struct<`date-parts` array<array<int>>>,
issued struct<`date-parts` array<array<int>>>, created struct<`date-parts` array<array<int>>>, deposited struct<`date-parts` array<array<int>>>"""
NAMES = ["DOI", "URL", "type", "publisher", "volume", "issue", "page", "language", "abstract", "title", "subtitle", "container-title", "ISSN", "ISBN", "subject", "author", "published-print", "issued", "created", "deposited"]


def work(**kw):
    plain = {"DOI": "10.1/a", "URL": "http://x", "type": "journal-article", "publisher": "P", "title": ["T"], "container-title": ["J"], "issued": ([[2001, 2]],)}
    return tuple((plain | {k.replace("_", "-"): v for k, v in kw.items()}).get(n) for n in NAMES)


@pytest.mark.parametrize(
    "changes,reason",
    [
        ({}, None), ({"issued": None}, "NO_DATE"), ({"issued": ([[2001, 13]],)}, "NO_DATE"), ({"URL": ""}, "NO_URL"), ({"URL": None}, "NO_URL"), ({"DOI": "x" * 300}, "ID_TOO_LONG"), ({"issued": ([[2030]],)}, "TOO_FUTURISTIC"),
        ({"type": "journal-issue"}, "JOURNAL_ISSUE"), ({"title": []}, "NO_ATITLE"), ({"title": None}, "NO_ATITLE"), ({"title": ["Titelei"]}, "BLOCKED_ATITLE"), ({"title": ["x" * 2401]}, "TOO_LONG_TITLE"),
        ({"container_title": None}, "NO_JTITLE"), ({"publisher": "test"}, "BLACKLISTED_COLLECTION"),
    ],
)
def test_works_skips(spark, changes, reason):
    r = C.FORMATS["works"](spark.createDataFrame([work(**changes)], WORKS), F.lit("2025-01-01").cast("timestamp")).first()
    assert r.skip_reason == reason


def test_works_fields(spark):
    df = spark.createDataFrame([work(subtitle=["of it"], page="3-7", volume="007", author=[(" A#na ", "B&NA;e")], publisher=None, type="book-chapter"), work(page="x-7")], WORKS)
    a, b = C.FORMATS["works"](df, F.lit("2025-01-01").cast("timestamp")).collect()
    assert (a.title, a.page_count, a.volume, a.collections, a.authors[0]["last"], a.date) == ("J: T : of it", "5", "7", ["X-U (CrossRef)"], "Be", dt.date(2001, 2, 1))
    assert (b.start_page, b.end_page, b.page_count, b.languages) == (None, None, None, ["und"])


def test_search_documents(spark):
    kept, rejected = C.split(C.FORMATS["works"](spark.createDataFrame([work(), work(URL="https://doi.org/10.1/a"), work(URL="")], WORKS), F.lit("2025-01-01").cast("timestamp")))
    rows = exports.search_documents(kept.withColumn("source_id", F.when(F.size("urls") > 0, F.lit("48")))).collect()
    assert rejected.count() == 1 and [r.url for r in rows] == [["http://x", "https://doi.org/10.1/a"], ["https://doi.org/10.1/a"]]
    assert rows[0].publisher == [] and rows[0].language == [] and rows[0].issn_str_mv == [] and rows[0].fullrecord.startswith("blob:ai-49-")
    full = exports.EXPORTERS["search-full"](kept).first().fullrecord
    assert '"doi":"10.1/a"' in full and len(exports.SITES) == 14


def test_open_access(spark):
    df = spark.createDataFrame([("a", False, None, False), ("b", True, False, True), ("c", False, False, True), ("c", False, None, True), ("c", True, None, False)], "source_id string, open_access boolean, free boolean, covered boolean")
    got = C.flag_open_access(df, ["a"], ["b"], F.col("covered"), F.col("free"))
    assert [r.open_access for r in got.collect()] == [True, True, False, True, True]


@pytest.mark.parametrize("text,want", [("XIV", "14"), ("mcmxcix", "1999"), ("IIX", "IIX"), ("12", "12"), ("", ""), (None, None)])
def test_roman(spark, text, want):
    assert spark.createDataFrame([(text,)], "x string").select(S.roman(F.col("x"))).first()[0] == want


@pytest.mark.parametrize("parts,want", [([2008], "2008-01-01"), ([2008, 2, 31], None), ([2008, 13], None), ([], None), ([1, 2, 3, 4], None), (None, None)])
def test_date_of_parts(spark, parts, want):
    got = spark.createDataFrame([(parts,)], "x array<int>").select(S.date_of_parts(F.col("x"))).first()[0]
    assert (got and str(got)) == want


def test_imprint(spark):
    rows = [("a", "b", 7), ("a", None, 7), (None, "b", 7), ("", "", 7), ("a", "b", None), (None, None, None)]
    df = spark.createDataFrame(rows, "p string, q string, y int")
    assert [r[0] for r in df.select(S.imprint(F.col("p"), F.col("q"), F.col("y"))).collect()] == ["a : b, 7", "a : 7", "b, 7", "7", "a : b", ""]


def test_record_fields(spark):
    fields = "array<struct<_tag string, subfield array<struct<_code string, _VALUE string>>>>"
    m = spark.createDataFrame([([("245", [("a", "T"), ("b", "U")]), ("245", [("a", "V")]), ("100", [("a", "W")])],)], f"f {fields}")
    assert m.select(S.subfields(F.col("f"), "245", "a")).first()[0] == ["T", "V"]
    q = spark.createDataFrame([([("dc", "date", "issued", "1"), ("dc", "date", None, "2")],)], "f array<struct<_mdschema string, _element string, _qualifier string, _VALUE string>>")
    assert q.select(S.qualified(F.col("f"), "dc", "date"), S.qualified(F.col("f"), "dc", "date", "issued")).first()[:] == (["2"], ["1"])


def test_lists(spark):
    df = spark.createDataFrame([(" a;;b ;a", ["a", "b", "a", "c"])], "s string, t array<string>")
    got = df.select(S.split_trim(F.col("s"), ";"), S.remove_each(F.col("t"), F.array(F.lit("b"))), lookups.preference(F.lit("q"), ["p", "q"]), lookups.preference(F.lit("z"), ["p"])).first()
    assert got[:] == (["a", "b", "a"], ["a", "a", "c"], 1, 9999)


def differences(spark, name, path):
    """What a query gives beyond its SQL, and the SQL beyond it, over pages at the path."""
    import duckdb

    from quire.plans import catalogue, more  # noqa: F401

    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{path}/pages.parquet/*.parquet'")
    got, want = (Counter(map(tuple, rows)) for rows in (catalogue.QUERIES[name](spark, str(path)).collect(), db.execute(catalogue.ORACLES[name]).fetchall()))
    return [*(got - want).elements()], [*(want - got).elements()]


ODD_TITLES = ["A &amp; b", " outer ", "x" * 51 + "&amp;", "x" * 55 + " ", "", " ", "line\nbreak", "a</title><title>b", "é\U0001f600" * 28]


def test_pages_as_in_sql(spark, tmp_path):
    """Titles keep references and outer spaces; other tags than plain ones are no titles; each row counts, ids or not."""
    made = [f'<html lang="de"><title>{t}</title>' for t in ODD_TITLES] + ["<TITLE>a</TITLE>", '<title id="x">a</title>', '<html class="x" lang="fr"><title>a</title>', '<HTML LANG="EN">', '<html lang="x-y">', "", None]
    rows = [(i, f"http://{i}", h) for i, h in enumerate(made)] + [(0, "http://again", made[0]), (None, None, made[1]), (None, "u", made[1])]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert differences(spark, "c_html_crosswalk", tmp_path) == ([], [])
    (tidy,) = C.FORMATS["pages"](spark.createDataFrame([("1", "u", '<HTML a lang="de"><Title x> a &amp; b </Title>')], "identifier string, url string, html string")).collect()
    assert (tidy.title, tidy.languages) == ("a & b", ["de"])


def test_headings_as_in_sql(spark, tmp_path):
    """Only ampersands' references are replaced, before tags go; all kinds of spaces are trimmed; lines end at \\n only."""
    inner = ["A &amp; b", "&quot;a&quot; &lt;b&gt; &#39;", "&amp;lt;i&amp;gt;", "<b>a</b>&a<i>mp;", "<a\nb>", "a\rb\u2028c\x85d", "a\nb", " \xa0\u3000a\u2009 ", "\ta\t", "\u200b", "", "a</h1><h1>b", "<a", "\U0001f600 "]
    rows = [(i, f"<p><h1>{x}</h1>") for i, x in enumerate(inner)] + [(99, None), (99, ""), (None, "<H1>a</H1>"), (None, '<h1 id="x">a</h1>'), (0, "<h1>A</h1>")]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert differences(spark, "f15_clean_html", tmp_path) == ([], [])
    assert spark.createDataFrame([("<p>&lt;b&gt; &quot;</p>",)], "x string").select(X.clean_html(F.col("x"))).first()[0] == '<b> "'
