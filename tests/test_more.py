import datetime as dt
import io as bytes_io
import json
import sqlite3
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import coverage, dedup, facets, filters, labels, lookups, reports
from quire.operators.filters import Tree
from quire.sources import crosswalks as C
from quire.sources import exports, formats, harvest, io

NOW = "2001-01-01"
ENTRY = "holdings string, serial string, first_date string, first_volume string, first_issue string, last_date string, last_volume string, last_issue string, embargo string"


def texts(spark, f, rows):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], "x string").select(f(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "entry,record,ok",
    [
        (("2000", "3", "21", "", "", "", ""), ("2000", "3", "20"), False), (("2000", "3", "21", "", "", "", ""), ("2000", "3", "21"), True), (("2000", "6", "", "", "", "", ""), ("2001-05-05", "4", ""), True),
        (("2001-04-01", "6", "", "", "", "", ""), ("2001-05-05", "4", ""), False), (("2001-04-01", "v. 4", "", "", "", "", ""), ("2001-05-05", "4", ""), True), (("", "", "", "2001", "6", "3", ""), ("2001-05-05", "6", "4"), False),
        (("", "", "", "2001", "6", "3", ""), ("2000-05-05", "7", "4"), True), (("", "", "", "", "", "", ""), ("06066-12-01T00:00:00Z", "", ""), False), (("2000", "", "", "2008-06", "", "", ""), ("2008-06-30T00:00:00Z", "", ""), True),
        (("2000", "", "", "2008-06", "", "", ""), ("2008-06-30T10:00:00Z", "", ""), False), (("x", "", "", "y", "", "", ""), ("2008", "", ""), True), (("", "", "", "", "", "", "P12M"), ("2000-01-02", "", ""), True),
        (("", "", "", "", "", "", "P12M"), ("2000-01-03", "", ""), False), (("", "", "", "", "", "", "R10Y;P30D"), ("2000-12-31", "", ""), True),
    ],
)
def test_coverage_with_issues(spark, entry, record, ok):
    e = spark.createDataFrame([("H", "1", *entry)], ENTRY)
    r = spark.createDataFrame([("r", ["1"], *record)], "record_id string, serials array<string>, date string, volume string, issue string")
    assert (coverage.covered(r, e, F.lit(NOW).cast("timestamp")).count() == 1) == ok


def test_holdings_rows(spark, tmp_path):
    (tmp_path / "k.tsv").write_text("publication_title\tprint_identifier\tall_issns\tdate_first_issue_online\textra\nT\t1234567x\t1990-0104;1990-009x\t2000\tz\nU\tx\n")
    k = io.kbart(spark, str(tmp_path / "k.tsv"))
    assert len(k.columns) == 34 and k.count() == 2 and k.filter("all_issns = ''").count() == 1
    assert [r.serial for r in coverage.index_by_serial(k).orderBy("serial").collect()] == ["1234-567X", "1990-009x", "1990-0104"]
    e = coverage.entries_of(k, F.lit("H"))
    assert {(r.holdings, r.first_date) for r in e.collect()} == {("H", "2000")}


RECORD = "id string, source_id string, collections array<string>, packages array<string>, subjects array<string>, doi string, issn array<string>, eissn array<string>, isbn array<string>, date string, volume string, issue string, title string"


def test_leaves_and_files(spark, tmp_path):
    (tmp_path / "issn.txt").write_text("1234-567x is here\n\nnothing\n")
    (tmp_path / "isbn.txt").write_text("ISBN 978 3\n")
    rows = [("a", "1", ["C"], None, ["S"], "10.1/a", ["1234-567X"], None, ["ISBN 978 3"], "2000", "", "", "T"), ("b", "2", None, ["P"], None, None, None, ["9999-9999"], None, None, None, None, None)]
    df = spark.createDataFrame(rows, RECORD)
    at = lambda n: f"file://{tmp_path}/{n}"
    trees = {
        "issn": Tree({"issn": {"url": at("issn.txt")}}), "eissn": Tree.issn("9999-9999"), "lower": Tree.issn("1234-567x"), "isbn": Tree({"isbn": {"file": at("isbn.txt")}}), "doi": Tree.doi("10.1/a"), "package": Tree.package("P"),
        "subject": ~Tree.subject("S"), "none": Tree({"not": Tree.any()}), "collection": Tree.collection("C", "D"),
    }
    got = filters.tag(filters.prepare(spark, df, list(trees.values())), trees)
    assert {r.id: r.labels for r in got.collect()} == {"a": ["collection", "doi", "isbn", "issn"], "b": ["eissn", "package", "subject"]}
    again = filters.tag(df.withColumn("labels", F.array(F.lit("old"))), {"x": Tree.any()})
    assert again.first().labels == ["old", "x"]


def test_tree_json():
    tree = Tree.one_of(Tree.source("55") & Tree.collection("A"), ~Tree.holdings("http://h/x", "/f", by_title=True))
    assert Tree.from_json(tree.to_json()) == tree
    assert tree.to_json() == '{"or":[{"and":[{"source":["55"]},{"collection":["A"]}]},{"not":{"holdings":{"compare-by-title":true,"files":["/f"],"urls":["http://h/x"]}}}]}'
    assert filters.config_json({"B": Tree.any(), "A": Tree.any()}) == '{"A":{"any":{}},"B":{"any":{}}}'
    for bad in ('{"any":{},"or":[]}', "{}", '{"unknown":[]}', '{"not":{"a":1}}'):
        with pytest.raises(ValueError):
            Tree.from_json(bad)


def test_config_of_collections(spark):
    schema = "id string, collectionId string, selectedBy array<string>, contentFiles array<string>, solrMegaCollections array<string>, filteredBy array<struct<label:string,isil:string,filterFiles:array<struct<label:string,fileId:string>>>>"
    rows = [
        ("1", "sid-49-col-x", ["A", "B"], None, ["M"], [("ISSN list", "A", [("f", "1")]), ("EZB", "B", [("g", "2")])]), ("2", "sid-50-col", ["A"], ["http://c"], ["N"], None), ("3", "col", ["A"], None, None, None), ("4", "sid-7-col", ["C"], None, ["O"], None),
        ("5", "sid-8-col", ["D"], None, None, None),
    ]
    got = filters.config_of(spark.createDataFrame(rows, schema), "http://files")
    assert got["A"] == {"or": [{"and": [{"source": ["49"]}, {"issn": {"url": "http://files/1"}}]}, {"and": [{"source": ["50"]}, {"holdings": {"urls": ["http://c"]}}]}]}
    assert got["B"] == {"and": [{"source": ["49"]}, {"holdings": {"urls": ["http://files/2"]}}]} and got["C"] == {"and": [{"source": ["7"]}, {"collection": ["O"]}]} and got["D"] == {"source": ["8"]}


def test_drop_labels(spark):
    index = spark.createDataFrame([("i1", "10.1/a", "s1", ["X"]), ("r1", "10.1/a", "s1", ["Y"]), ("i2", "", "s1", ["X"])], "id string, doi string, source_id string, institution array<string>")
    records = spark.createDataFrame([("r1", " 10.1/a ", "s2", ["Y", "X"]), ("r2", "10.1/a", "s0", ["X"]), ("r3", None, "s2", ["X"])], "id string, doi string, source_id string, labels array<string>")
    got = {r.id: r.labels for r in labels.drop_labels(records, index, ["s0", "s1"]).collect()}
    assert got == {"r1": ["Y"], "r2": ["X"], "r3": ["X"]}
    assert {r.id: r.labels for r in labels.drop_labels(records, index, ["s0", "s1"], ignore_same_id=False, drop_unlabelled=True).collect()} == {"r2": ["X"], "r3": ["X"]}


@pytest.mark.parametrize("text,want", [("10.1234/a(b)", "10.1234/a(b)"), ("10.1234/abc)", "10.1234/abc"), ("10.1/x])", "10.1/x"), ("10.1/x]", "10.1/x"), ("10.1/[x]", "10.1/[x]"), ("10.1/x/epdf", "10.1/x"), ("10.1/x'", "10.1/x"), (" 10.1/x” ", "10.1/x")])
def test_clean_doi(spark, text, want):
    assert texts(spark, X.clean_doi, [text]) == [want]


def test_sniffing(spark):
    doc = lambda d: spark.createDataFrame([(d,)], "m map<string,string>")
    run = lambda d, *ignored: doc(d).select(X.sniff_map(F.col("m"), [*ignored])).first()[0]
    assert run({"a": "b"}) == [] and run({"a": "some value: 10.5617/osla.8504 and 10.5617/osla.8503"}) == ["10.5617/osla.8504"]
    assert run({"a": "10.5617/osla.8504"}, "a") == [] and run({"b": "10.1234/zzz", "a": "10.1234/aaa."}) == ["10.1234/aaa", "10.1234/zzz"]
    lists = spark.createDataFrame([({"a": ["x 10.5617/osla.8504", "10.5617/osla.8504"]},)], "m map<string,array<string>>")
    assert lists.select(X.sniff_lists(F.col("m"))).first()[0] == ["10.5617/osla.8504"]


def test_texts(spark):
    assert texts(spark, X.unescape, ["a &amp; b &#252;&#x20AC; &bogus; &#xD800; &", None]) == ["a & b ü€ &bogus; &#xD800; &", None]
    assert texts(spark, X.language_code, ["German", "de", "ger", "serbo-croatian", "Albanian", "Deutsch", "de_DE"]) == ["deu", "deu", "deu", "hbs", "sqi", None, None]
    assert texts(spark, X.detect_language, ["", "indivisible, with liberty and justice for all", "uomo di cultura e appassionato di astronomia"]) == [None, "eng", "ita"]
    assert [str(x) for x in texts(spark, X.embargo_until, ["Der Volltext unterliegt einer Embargofrist bis zum 18. Okt. 2018.", "x 99. Okt. 2018", None])] == ["2018-10-18", "None", "None"]


def test_nested_text(spark):
    kind = "struct<name:string,loc:struct<lon:double>,at:timestamp,also:array<string>,n:int,camps:array<struct<lon:double>>,none:string,empty:string>"
    df = spark.createDataFrame([(("B\\\n'A \\", (38.916667,), dt.datetime(2000, 1, 2), ["x", "y\rz"], 1, [(1.5,), (2.0,)], None, ""),)], f"r {kind}")
    want = "{ name: 'B\\\\\\n\\'A \\\\', loc { lon: 38.916667,  } at: '2000-01-02T00:00:00Z', also: 'x', also: 'y z', n: 1, camps { lon: 1.500000,  } camps { lon: 2.000000,  }  }"
    assert df.select(X.formeta(F.col("r"), df.schema["r"].dataType)).first()[0] == want


def test_relative_dates():
    now = dt.datetime(2026, 3, 31, 12, tzinfo=dt.timezone.utc)
    ago = lambda **kw: now - dt.timedelta(**kw)
    for text, want in {"now": now, "1.day.ago": ago(days=1), "2.days.ago": ago(days=2), "3.hours.ago": ago(hours=3), "1 week ago": ago(weeks=1), "today": now.replace(hour=0), "yesterday": now.replace(day=30, hour=0)}.items():
        assert X.relative_date(text, now) == want
    assert X.relative_date("1 month ago", now).date() == dt.date(2026, 3, 3) and X.relative_date("2 years ago", now).year == 2024
    assert X.relative_date("2026-01-01", now).date() == dt.date(2026, 1, 1)
    for bad in ("", "not-a-date", "-1.days.ago", "1 fortnight ago"):
        with pytest.raises(ValueError):
            X.relative_date(bad, now)


@pytest.mark.parametrize("unit,a,b,n", [("minute", "2000-01-01 10:30", "2000-01-01 12:00", 90), ("hour", "2000-01-01 10:00", "2000-01-01 12:00", 2), ("day", "2000-01-01", "2000-01-01", 0), ("day", "2000-01-01", "1999-01-01", 0), ("week", "2000-01-01", "2001-01-01", 54), ("biweek", "2000-01-01", "2000-01-20", 2), ("month", "2000-01-15", "2000-03-01", 2)])
def test_intervals(spark, unit, a, b, n):
    df = spark.createDataFrame([(a, b)], "a string, b string").select(F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b"))
    rows = reports.intervals(df, "a", "b", unit).orderBy("begin").collect()
    assert len(rows) == n and (not n or str(rows[0].begin)[:16] == (a + " 00:00")[:16])
    assert all(x.until + dt.timedelta(seconds=1) == y.begin for x, y in zip(rows, rows[1:]))


def test_lookups(spark):
    left = spark.createDataFrame([("a", True), ("b", True), ("c", None)], "k string, need boolean")
    joined, missing = lookups.needed_partners(left, spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), "k", F.col("need"))
    assert sorted((r.k, r.v) for r in joined.collect() if r.v) == [("a", 1), ("a", 2)] and joined.count() == 3 and [r.k for r in missing.collect()] == ["b"]
    flags = spark.createDataFrame([("r", "1", ["f", "t"], False), ("s", "1", ["f"], True), ("t", "1", None, True)], "id string, sid string, cs array<string>, oa boolean")
    known = spark.createDataFrame([("1:t", True), ("1:f", False)], "key string, free boolean")
    assert {r.id: r.flag for r in lookups.fold_flags(flags, known, "id", "sid", "cs", F.col("oa")).collect()} == {"r": True, "s": False, "t": True}


def test_compact_json(spark):
    rows = spark.createDataFrame([('{"id":1,"v":2}',), ('{"id":"1","v":1}',), ('{"id":1,"v":10}',)], "value string")
    assert sorted(r.value for r in dedup.compact_by_json(rows, "$.id", "$.v").collect()) == ['{"id":"1","v":1}', '{"id":1,"v":10}']
    with pytest.raises(Exception, match="no \\$.id"):
        dedup.compact_by_json(spark.createDataFrame([("{}",)], "value string"), "$.id").collect()
    assert [r.batch for r in dedup.batches(spark.range(7), [F.col("id")], 3).orderBy("id").collect()] == [0, 0, 0, 1, 1, 1, 2]


def test_review(spark):
    df = spark.createDataFrame([("a", ["x"]), ("b", ["x", "y"]), ("b", None)], "k string, xs array<string>")
    rules = [("r1", "allowed-keys", "true", "k", ["a"], None), ("r2", "equal-size-total", "k = 'a'", "k", ["a"], None), ("r3", "min-ratio", "true", "k", ["b"], 67), ("r4", "min-count", "true", "xs", ["x"], 2), ("r5", "allowed-keys", "k = 'z'", "k", ["a"], None), ("r6", "equal-size-non-zero", "true", "k", ["a", "z"], None)]
    assert {r.rule: (r.ok, r.got) for r in facets.review(df, rules).collect()} == {"r1": (False, 1), "r2": (True, 1), "r3": (False, 2), "r4": (True, 2), "r5": (True, 0), "r6": (False, 1)}
    assert [r.ok for r in facets.review(df, [rules[4]], fail_on_empty=True).collect()] == [False]
    with pytest.raises(ValueError):
        facets.review(df, [("r", "other", "true", "k", [], None)])


class Web:
    """Answers by the start of the URL, each once; an exception is raised."""

    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def __call__(self, url, headers=None, data=None):
        self.asked.append((url, headers, data))
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return (answer if isinstance(answer, bytes) else json.dumps(answer).encode()), {"x-okapi-token": "t"}


def page(items, total, cursor):
    return {"status": "ok", "message": {"items": items, "total-results": total, "next-cursor": cursor}}


def test_harvest(spark):
    web = Web(page([1, 2], 3, "c"), OSError("reset"), page([3], 3, "d"))
    assert list(harvest.cursor_pages("http://h", {"rows": "2"}, web)) == [1, 2, 3] and "cursor=c" in web.asked[2][0]
    assert list(harvest.cursor_pages("http://h", {}, Web(page([*range(95)], 100, "c"), page([], 100, "d")))) == [*range(95)]
    with pytest.raises(RuntimeError, match="no more messages"):
        list(harvest.cursor_pages("http://h", {}, Web(page([1], 100, "c"), page([], 100, "d"))))
    with pytest.raises(OSError):
        list(harvest.cursor_pages("http://h", {}, Web(*[OSError()] * 5)))
    assert list(harvest.offset_pages("http://h", {}, 2, Web(page([1, 2], 3, None), page([3], 3, None)))) == [1, 2, 3]
    assert [len(harvest.windows(dt.date(2000, 1, 1), dt.date(2000, 1, 31), n)) for n in (1, 7, 31, 60)] == [31, 5, 1, 1]
    parts = harvest.WindowedReader({"from": "2000-01-01", "until": "2000-01-03"}).partitions()
    assert [p.value[0] for p in parts] == ["2000-01-01", "2000-01-02", "2000-01-03"] and harvest.Windowed.name() == "windowed-rest"


def test_config_client(spark):
    found = {"fincConfigMetadataCollections": [{"id": "1", "collectionId": "sid-1-x", "selectedBy": ["A"], "filteredBy": [{"isil": "A", "label": "l", "filterFiles": [{"label": "f", "fileId": "9"}]}]}]}
    web = Web(b"", found, b"data")
    client = harvest.ConfigClient("http://h/", "ten", web)
    client.login("u", "p")
    assert client.token == "t" and filters.config_of(client.collections(spark, "q"), "http://f")["A"]["and"][1] == {"holdings": {"urls": ["http://f/9"]}}
    assert client.file("a/b") == b"data" and web.asked[2][0] == "http://h/finc-config/files/a/b"
    lists = harvest.attachment_lists(spark, "http://h", Web([{"a": 1, "b": None}], [], [{"c": "x"}], []))
    assert [tuple(r) for r in lists["metadata_usage"].collect()] == [("1", None)] and lists["holdings_file_concat"].count() == 0


def test_files_and_sinks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("2.txt", "b\n")
        z.writestr("1.txt", "a\n")
    assert open(io.plain_file(str(tmp_path / "a.zip"), str(tmp_path))).read() == "a\nb\n"
    (tmp_path / "p.txt").write_text("x")
    assert io.plain_file(str(tmp_path / "p.txt"), str(tmp_path)) == str(tmp_path / "p.txt")
    with pytest.raises(RuntimeError), io.atomic(str(tmp_path / "out")) as out:
        out.write(b"half")
        raise RuntimeError
    assert not (tmp_path / "out").exists() and not list(tmp_path.glob(".out*"))
    calls = []
    fetch = lambda p: (calls.append(p), open(p, "w").close())
    for force in (False, False, True):
        io.cached(str(tmp_path / "c"), fetch, force=force)
    assert len(calls) == 2
    df = spark.createDataFrame([("a", 1, 7.25), ("b", None, -1.0)], "k string, n int, pct double").orderBy("k")
    assert io.write_sqlite(df, str(tmp_path / "t.db"), "t", ["k"]) == 2
    assert sqlite3.connect(tmp_path / "t.db").execute("select n from t where k = 'a'").fetchall() == [("1",)]
    assert io.aligned(df).splitlines()[1] == "a  1  7.25" and io.textile(df, "pct").splitlines()[1:] == ["| a | 1 | *7.25* |", "| b |  | -1.00 |"]


def test_shipments(spark, tmp_path):
    files = {
        "x/dataset.xml": "<dataset><dataset-content><journal-issue><journal-issue-unique-ids><pii>I1</pii></journal-issue-unique-ids><journal-issue-properties><collection-title>J</collection-title></journal-issue-properties></journal-issue></dataset-content></dataset>",
        "x/I1/issue.xml": "<serial-issue><issue-info><pii>I1</pii><issn>1234-5678</issn></issue-info><issue-body><issue-sec><include-item><pii>A1</pii></include-item><include-item><pii>A9</pii></include-item></issue-sec></issue-body></serial-issue>",
        "x/A1/main.xml": '<article><item-info><pii>A1</pii><doi>10.1/a</doi><copyright year="1999">c</copyright></item-info><simple-head><title>T</title></simple-head></article>',
    }
    with tarfile.open(tmp_path / "s.tar", "w") as tar:
        for name, text in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(text)
            tar.addfile(info, bytes_io.BytesIO(text.encode()))
    rows = C.FORMATS["shipment"](*io.shipments(spark, str(tmp_path / "s.tar"))).collect()
    assert [(r.doi, r.title, r.journal, str(r.date)) for r in rows] == [("10.1/a", "T", "J", "1999-01-01")]


def test_every_crosswalk_has_the_columns(spark):
    for name, schema in formats.SCHEMAS.items():
        if not name.startswith("shipment-") and name in C.FORMATS:
            out = C.FORMATS[name](spark.createDataFrame([], schema))
            assert out.columns == list(C.COLUMNS) and out.count() == 0, name
    xml = spark.createDataFrame([("<document/>",)], "value string")
    assert C.FORMATS["scores"](xml).first().skip_reason == "NO_ID"


def test_xml_files(spark, tmp_path):
    (tmp_path / "a.xml").write_bytes("<records><Article><UniqueID>1</UniqueID><ArticleTitle>Köln</ArticleTitle><PublicationYear>1999</PublicationYear></Article></records>".encode("latin-1"))
    df = io.xml_records(spark, str(tmp_path / "a.xml"), "Article", formats.SCHEMAS["bilingual"], "ISO-8859-1")
    assert [(r.id, r.title) for r in C.FORMATS["bilingual"](df).collect()] == [("ai-53-1", "Köln")]


def test_late_versions(spark, tmp_path):
    from quire.streaming import latest

    schema = "k string, v long, p string"
    for n, rows in enumerate([[("a", 2, "new"), ("b", 1, "x")], [("a", 1, "old"), ("c", 1, "y")], [("b", 5, "z")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / f"in/{n}"))
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in/*"))
        latest.merge_latest(stream, str(tmp_path / "table"), ["k"], "v", "p", str(tmp_path / "checkpoint"), parts=4).awaitTermination()
    assert sorted((r.k, r.p) for r in latest.current(spark, str(tmp_path / "table")).collect()) == [("a", "new"), ("b", "z"), ("c", "y")]


def test_export_lines(spark):
    df = spark.createDataFrame([("a", "", [], ["x"])], "id string, e string, n array<string>, l array<string>")
    assert exports.lines(df).first().value == '{"id":"a","l":["x"]}'
