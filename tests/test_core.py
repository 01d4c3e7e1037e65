import datetime as dt

import pytest
from pyspark.sql import functions as F

from quire.functions import scalars as S
from quire.operators import coverage, dedup, facets, filters, lookups
from quire.sources import io


def values(spark, f, rows):
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    return [r[0] for r in df.select(f(F.col("x"))).collect()]


def test_scalars(spark):
    assert values(spark, S.serial, [" 1234567x", "1234-5678"]) == ["1234-567X", "1234-5678"]
    assert values(spark, S.first_int, ["-5", "v12b", "x", ""]) == [-5, 12, 0, 0]
    assert values(spark, S.embargo_hours, ["P1Y", "R10Y;P30D", "P12M", "", "RaY"]) == [8760, 87600, 8760, 0, None]
    assert values(spark, lambda x: S.truncate_dots(x, 3), ["ab", "abc"]) == ["ab", "abc..."]
    assert values(spark, S.page_count, ["3-7", "7-3", "x"]) == [5, None, None]
    assert values(spark, lambda x: S.truncate_dots(x, 3), ["äö", "éab"]) == ["ä\ufffd...", "éa..."]
    assert values(spark, S.truthy, ["Ja ", "T", "true", "1", "no"]) == [True, False, True, True, False]
    assert values(spark, lambda x: S.record_id(F.lit("49"), x), ["a" * 70])[0].startswith("ai-49-YWFh")


@pytest.mark.parametrize("text,day", [("2008", "2008-01-01"), ("2008-xx-xx", "2008-01-01"), ("2008-6", "2008-06-01"), ("200806", "2008-06-01"), ("2008-Jun", "2008-06-01"), ("2008-6-1", "2008-06-01"), ("20080601", "2008-06-01"), ("06066-12-01", None), ("", None), ("2008-02-31", None)])
def test_dates(spark, text, day):
    got = values(spark, S.parse_date, [text])[0]
    assert (got and got.strftime("%Y-%m-%d")) == day


@pytest.mark.parametrize(
    "entry,record,ok",
    [
        (("2000", "2008", None, None, ""), ("2008-06", None), True),
        (("2000", "2008", None, None, ""), ("2009-01", None), False),
        (("2000", "2008-06", None, None, ""), ("2008-06-15", None), True),
        (("2000", "2008-06", None, None, ""), ("2008-07-01", None), False),
        (("2001-05-05", "", None, None, ""), ("2001-05", None), True),
        (("2000", "", 3, None, ""), ("2000", 2), False),
        (("2000", "", 6, None, ""), ("2001-05-05", 4), True),
        (("", "", None, None, "P1D"), ("2001-01-01", None), False),
        (("", "", None, None, "R1Y"), ("2000-01-03", None), True),
        (("", "", None, None, "RaY"), ("2000-01-03", None), False),
        (("", "", None, None, ""), ("", None), False),
    ],
)
def test_coverage(spark, entry, record, ok):
    e = spark.createDataFrame([("H", "1", *entry)], "holdings string, serial string, first_date string, last_date string, first_volume int, last_volume int, embargo string")
    r = spark.createDataFrame([("r", ["1", "1", "2"], *record)], "record_id string, serials array<string>, date string, volume int")
    assert (coverage.covered(r, e, F.lit("2001-01-01").cast("timestamp")).count() == 1) == ok


def test_filters(spark):
    df = spark.createDataFrame([("a", ["x"]), (None, None)], "s string, t array<string>")
    tree = {"in": {"field": "s", "list": ["a"]}}
    assert df.filter(filters.compile_tree({"not": tree})).count() == 1
    assert df.filter(filters.compile_tree({"not": {"not": tree}})).count() == 1
    assert df.filter(filters.compile_tree({"and": []})).count() == 2 and df.filter(filters.compile_tree({"or": []})).count() == 0
    with pytest.raises(ValueError):
        filters.compile_tree({"any": {}, "or": []})
    with pytest.raises(ValueError):
        filters.compile_tree({"unknown": {}})


def test_dedup_and_labels(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("", 9, "z"), (None, 9, "z")], "k string, v int, p string")
    assert [tuple(r) for r in dedup.keep_latest(df, ["k"], "v", [F.col("p")]).collect()] == [("a", 3, "y")]
    new = spark.createDataFrame([("a", "L", 1), ("a", None, 2)], "k string, new string, pos int")
    got = lookups.update_labels(df.filter("k = 'a'"), new, "k", "p").select("p").collect()
    assert [r[0] for r in got] == [None, None]


def test_compare_is_antisymmetric(spark):
    a, b = spark.createDataFrame([("x",), ("x",), ("y",)], "k string"), spark.createDataFrame([("y",), ("z",)], "k string")
    d = {r.k: r["diff"] for r in facets.compare(a, b, ["k"]).collect()}
    assert d == {r.k: -r["diff"] for r in facets.compare(b, a, ["k"]).collect()} == {"x": -2, "y": 0, "z": 1}


def test_freeze(tmp_path):
    url = "http://h.example/a?x=1&y=2"
    io.freeze({"L": {"file": url}}, {url: b"1234-5678\n"}, str(tmp_path / "z.zip"))
    got = io.unfreeze(str(tmp_path / "z.zip"), str(tmp_path / "out"))
    assert got["L"]["file"].startswith("file://")


def test_sources(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('a\tb\n1\t"x\n\t2\n')
    assert [tuple(r) for r in io.tsv(spark, str(tmp_path / "t.tsv")).collect()] == [("1", '"x'), (None, "2")]
    (tmp_path / "j.json").write_text('{"k": 1, "z": 2}\n{bad\n')
    assert io.ndjson(spark, str(tmp_path / "j.json"), "k int", "DROPMALFORMED").count() == 1


def test_registry_has_sql():
    from quire.plans import catalogue

    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES) and len(catalogue.QUERIES) > 50


def test_import_needs_no_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 100"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parents[1])
