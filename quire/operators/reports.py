"""Reports over an index by name, calendar intervals, and text projections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from . import facets

REPORTS: dict[str, Callable[..., DataFrame]] = {}
#: Calendar units; weeks start on Sunday.
UNITS = ("minute", "hour", "day", "week", "biweek", "month")


def report(name: str):
    def add(f):
        REPORTS[name] = f
        return f

    return add


@report("collections")
def collections(index: DataFrame) -> DataFrame:
    return facets.collections_by_source(index, "source_id", "mega_collection")


@report("recent")
def recent(index: DataFrame, rows: int = 10) -> DataFrame:
    return index.orderBy(F.desc("last_indexed"), "id").limit(rows)


@report("serials")
def serials(index: DataFrame) -> DataFrame:
    """source_id, collection, issn, size and counts by date."""
    each = index.select("source_id", F.explode("mega_collection").alias("collection"), "issn", F.col("publishDate").alias("dates"))
    each = each.select("source_id", "collection", F.explode("issn").alias("issn"), F.explode_outer("dates").alias("date"))
    return facets.nested_pivot(each, ["source_id", "collection", "issn"], "date")


def _start_of(t: Column, unit: str) -> Column:
    if unit in ("week", "biweek"):
        return F.date_trunc("day", t) - F.make_dt_interval(days=F.dayofweek(t) - 1)
    return F.date_trunc(unit, t)


def _next(t: Column, unit: str) -> Column:
    """The start of the unit after the one (for two weeks: after the pair) that holds t."""
    if unit == "month":
        return F.add_months(F.date_trunc("month", t), 1).cast("timestamp")
    if unit == "biweek":
        return _start_of(t + F.expr("interval 8 days"), "week") + F.expr("interval 7 days")
    return _start_of(t, unit) + F.expr({"minute": "interval 1 minute", "hour": "interval 1 hour", "day": "interval 1 day", "week": "interval 7 days"}[unit])


def intervals(df: DataFrame, start: str, end: str, unit: str) -> DataFrame:
    """Rows of timestamps start, end as intervals (begin, until): calendar units that cover [start, end); the first begins at
    start itself, each ends a second before the next begins. No rows where end is not after start."""
    if unit not in UNITS:
        raise ValueError(f"unknown unit: {unit}")
    step = {"minute": "interval 1 minute", "hour": "interval 1 hour", "day": "interval 1 day", "week": "interval 7 days", "biweek": "interval 14 days", "month": "interval 1 month"}[unit]
    a, last = F.col(start), F.col(end) - F.expr("interval 1 second")
    second = _next(a, unit)
    rest = F.when(second <= last, F.sequence(second, last, F.expr(step)))
    begins = F.when(F.col(end) > a, F.concat(F.array(a), F.coalesce(rest, F.array().cast("array<timestamp>"))))
    return df.withColumn("begin", F.explode(begins)).withColumn("until", _next(F.col("begin"), unit) - F.expr("interval 1 second"))


def comma_rows(df: DataFrame, columns: list[str], lists: list[str]) -> DataFrame:
    """`value`: plain columns and the elements of lists, joined by commas; nulls are empty."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns] + [F.when(F.size(c) > 0, F.array_join(c, ",")) for c in lists]
    return df.select(F.concat_ws(",", *cells).alias("value"))


def tabular(lines: DataFrame) -> DataFrame:
    """doi, created, deposited, indexed, member, hash of works as JSON lines (`value`); lines that are no JSON go."""
    get = lambda path: F.get_json_object("value", path)
    day = lambda name: F.substring(get(f"$.{name}.date-time"), 1, 10).alias(name)
    return lines.filter(F.try_parse_json("value").isNotNull()).select(get("$.DOI").alias("doi"), day("created"), day("deposited"), day("indexed"), get("$.member").alias("member"), F.md5("value").alias("hash"))


def mapped(df: DataFrame, transform: Callable, schema: str, batch_bytes: int = 8 << 20) -> DataFrame:
    """Rows of `value` through a Python function of a text, in Arrow batches: what it gives is a row, None none. For
    transformations that columns cannot express."""
    import pyarrow as pa

    name = schema.split()[0]

    def run(batches):
        for batch in batches:
            out, size = [], 0
            for x in batch.column("value").to_pylist():
                y = transform(x)
                if y is not None:
                    out.append(y)
                    size += len(y)
                if size > batch_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=[name])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=[name])

    return df.select("value").mapInArrow(run, schema)
