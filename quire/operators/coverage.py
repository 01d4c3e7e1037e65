"""Licence coverage: records and entries that share a serial number (or title), where date, embargo, volume and issue allow.

Entries: holdings, serial, first_date, last_date, first_volume, last_volume, first_issue, last_issue, embargo (texts; those
that are missing are empty). Records: record_id, serials, date, volume, issue, title. All that depends on one side is computed
on that side, so that the residual of the join is comparisons only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import embargo_hours, first_int, granularity, parse_date, serial, serials_in

#: Shapes of links to databases: fixed values.
DATABASE_LINKS = [r"https://www.wiso-net.de/toc_list/([A-Z]{3,4})", r"https://www.wiso-net.de/.*dbShortcut=:2:2:([A-Z]{3,4})", r"https://www.wiso-net.de/.*dbShortcut=([A-Z]{3,4})"]
FIRST, LAST, FAR = "0001-01-01", "2364-01-01", "9999-12-31"


#: What a missing number is compared as: less or more than any.
LEAST, MOST = -(1 << 62), 1 << 62


def _number(df: DataFrame, name: str, default: int) -> Column:
    """The first integer of a text; the default where the column is missing, null or empty."""
    if name not in df.columns:
        return F.lit(default).cast("bigint")
    x = F.col(name).cast("string")
    return F.coalesce(F.when(x != "", first_int(x)), F.lit(default).cast("bigint"))


def prepare_entries(entries: DataFrame, now: Column, key: str = "serial") -> DataFrame:
    """holdings, key, begin, end, their years, numbers and walls of entries, with a value where there is no bound. Entries of
    a bad embargo cover nothing and go."""
    first, last = parse_date(F.col("first_date")), parse_date(F.col("last_date"))
    unit = granularity(F.col("last_date"))
    whole = F.when(unit == "year", F.date_trunc("year", last) + F.expr("interval 1 year") - F.expr("interval 1 day")).when(unit == "month", F.date_trunc("month", last) + F.expr("interval 1 month") - F.expr("interval 1 day")).otherwise(last)
    begin, end = F.coalesce(first, F.lit(FIRST).cast("timestamp")), F.coalesce(whole, F.lit(LAST).cast("timestamp"))
    e = entries.withColumn("begin", begin).withColumn("end", end)
    embargo = F.trim(F.coalesce(F.col("embargo"), F.lit(""))) if "embargo" in entries.columns else F.lit("")
    hours = embargo_hours(embargo)
    wall = now - F.make_dt_interval(hours=hours.cast("int"))
    numbers = {"first_volume": LEAST, "last_volume": MOST, "first_issue": LEAST, "last_issue": MOST}
    out = e.filter(hours.isNotNull()).select(
        "holdings", key, "begin", "end", F.year("begin").alias("begin_year"), F.year("end").alias("end_year"), *[_number(entries, n, d).alias(n) for n, d in numbers.items()],
        F.when(embargo.startswith("R"), wall).otherwise(F.lit(FIRST).cast("timestamp")).alias("not_before"), F.when(embargo.startswith("P"), wall).otherwise(F.lit(FAR).cast("timestamp")).alias("not_after"),
    )
    return out.distinct() if key != "serial" else out


def _residual() -> Column:
    """A bound at the granularity of a record: it begins before what the record's date names ends, and ends no earlier than that
    begins. Volume and issue count in the years of the bounds only. All are plain comparisons."""
    t, y = F.col("t"), F.col("y")
    inside = (F.col("begin") <= F.col("until")) & (t <= F.col("end")) & (t >= F.col("not_before")) & (t <= F.col("not_after"))
    low = (F.col("begin_year") != y) | ((F.col("volume") >= F.col("first_volume")) & (F.col("issue") >= F.col("first_issue")))
    high = (F.col("end_year") != y) | ((F.col("volume_") <= F.col("last_volume")) & (F.col("issue_") <= F.col("last_issue")))
    return inside & low & high


def _dated(records: DataFrame) -> DataFrame:
    """record_id, keys, t (where the date begins), until (its last moment), y, and volume and issue as compared from below and
    (with an underscore) from above."""
    kept = [c for c in ("serials", "title") if c in records.columns]
    numbers = [_number(records, n, d).alias(a) for n, d, a in (("volume", MOST, "volume"), ("issue", MOST, "issue"), ("volume", LEAST, "volume_"), ("issue", LEAST, "issue_"))]
    d = records.select("record_id", *kept, "date", granularity(F.col("date")).alias("g"), *numbers)
    d = d.select("record_id", *kept, parse_date(F.col("date"), F.col("g")).alias("t"), "g", "volume", "issue", "volume_", "issue_")
    moment = F.expr("interval 1 microsecond")
    until = F.when(F.col("g") == "day", F.col("t")).when(F.col("g") == "month", F.col("t") + F.expr("interval 1 month") - moment).otherwise(F.col("t") + F.expr("interval 1 year") - moment)
    return d.withColumn("until", until).withColumn("y", F.year("t")).drop("g")  # a record without a date fails every comparison


def _keyed(records: DataFrame, keys: Column, key: str) -> DataFrame:
    """A row of each record for each key. What dates and numbers are parsed to goes through the generator, as nothing is pushed
    below it: tests for nulls, which the join brings along, would parse them again otherwise."""
    d = _dated(records)
    parsed = ("t", "until", "y", "volume", "issue", "volume_", "issue_")
    return d.select("record_id", F.explode(F.transform(keys, lambda k: F.struct(k.alias(key), *parsed))).alias("z")).select("record_id", "z.*")


def covered(records: DataFrame, entries: DataFrame, now: Column) -> DataFrame:
    """(record_id, holdings) of records that an entry covers. An equi-join on the serial number with ranges as its
    residual; only keys are shuffled, and distinct pairs combined map-side."""
    r = _keyed(records, F.array_distinct("serials"), "serial")
    return r.join(prepare_entries(entries, now), "serial").filter(_residual()).select("record_id", "holdings").distinct()


def covered_by_title(records: DataFrame, entries: DataFrame, now: Column) -> DataFrame:
    """(record_id, holdings) where the title of a record is the publication title (publication_title) of an entry that
    covers it; empty titles match nothing."""
    e = prepare_entries(entries.withColumn("title", F.col("publication_title")).filter("title <> ''"), now, "title")
    return _keyed(records, F.array("title"), "title").join(e, "title").filter(_residual()).select("record_id", "holdings").distinct()


def serial_list(entries: DataFrame) -> Column:
    """Serial numbers of a holdings row, sorted: print and online identifiers where they are such, and all of all_issns."""
    own = F.array(*[serial(F.col(c)) for c in ("print_identifier", "online_identifier")])
    valid = F.filter(own, lambda x: x.rlike("[0-9]{4}-[0-9]{3}[0-9xX]"))
    return F.array_sort(F.array_distinct(F.concat(F.coalesce(valid, F.array().cast("array<string>")), F.coalesce(serials_in(F.col("all_issns")), F.array().cast("array<string>")))))


def index_by_serial(entries: DataFrame) -> DataFrame:
    """A row for each holdings row and serial number of it: the build side of the coverage join."""
    return entries.distinct().withColumn("serial", F.explode(serial_list(entries)))


def index_by_database(entries: DataFrame) -> DataFrame:
    """A row for each database that a holdings row's link names, in any of the shapes that match."""
    found = F.array_distinct(F.filter(F.array(*[F.regexp_extract("title_url", p, 1) for p in DATABASE_LINKS]), lambda x: x != ""))
    return entries.distinct().withColumn("database", F.explode(found))


def index_by_title(entries: DataFrame) -> DataFrame:
    """Distinct holdings rows with a title, which is the key of the title join."""
    return entries.filter("publication_title <> ''").distinct().withColumn("title", F.col("publication_title"))


def entries_of(kbart: DataFrame, holdings: Column) -> DataFrame:
    """Entries of the coverage join from holdings rows."""
    names = {"first_date": "date_first_issue_online", "last_date": "date_last_issue_online", "first_volume": "num_first_vol_online", "last_volume": "num_last_vol_online", "first_issue": "num_first_issue_online", "last_issue": "num_last_issue_online", "embargo": "embargo_info"}
    e = index_by_serial(kbart)
    return e.select(holdings.alias("holdings"), "serial", *[F.coalesce(F.col(v), F.lit("")).alias(k) for k, v in names.items()])
