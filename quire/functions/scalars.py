"""Column expressions for identifiers, serials, dates, embargoes, text and DOIs. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Hours of an embargo unit: fixed values.
UNIT_HOURS = {"Y": 8760, "M": 730, "D": 24}


def record_id(source: Column, raw: Column) -> Column:
    """`ai-{source}-{url-safe base64 without padding}`."""
    encoded = F.translate(F.base64(F.encode(raw, "utf-8")), "+/\r\n=", "-_")
    return F.concat(F.lit("ai-"), source, F.lit("-"), encoded)


def serial(x: Column) -> Column:
    """A serial number: trimmed, upper case, with its dash."""
    s = F.upper(F.trim(x))
    return F.when(F.octet_length(s) == 8, F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 4))).otherwise(s)


def serials_in(x: Column, strict: bool = False) -> Column:
    """All serial numbers in a text; strict: with an upper-case check digit only."""
    if strict:
        return F.regexp_extract_all(x, F.lit("[0-9]{4}-[0-9]{3}[0-9X]"), F.lit(0))
    return F.regexp_extract_all(x, F.lit("[0-9]{4}-[0-9]{3}[0-9xX]"), F.lit(0))


def first_int(x: Column) -> Column:
    return F.coalesce(x.try_cast("bigint"), F.regexp_extract(x, "[0-9]+", 0).try_cast("int").cast("bigint"), F.lit(0).cast("bigint"))


def _whole_day(x: Column) -> Column:
    """The date of a yyyy-MM-dd text, the bulk of dates, without a pattern; else null."""
    shaped = (F.length(x) == 10) & (F.substring(x, 5, 1) == "-") & (F.substring(x, 8, 1) == "-")
    return F.when(shaped, x.try_cast("date"))


_MONTHS = "january february march april may june july august september october november december".split()


def granularity(x: Column) -> Column:
    """year, month, day or null of a date text. The bulk, whole days, is told first."""
    return (
        F.when(_whole_day(x).isNotNull(), "day")
        .when(x.rlike(r"^\d{4}(-|-x{1,2}(-x{1,2})?)?$"), "year")
        .when(x.rlike(r"^\d{4}(-\d{1,2}|-[A-Za-z]{3,9}|\d{2})$"), "month")
        .when(x.rlike(r"^(\d{4}-(\d{1,2}|[A-Za-z]{3,9})-\d{1,2}|\d{8}|\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2}Z?|T\d{2}:\d{2}:\d{2}Z))$"), "day")
    )


def parse_date(x: Column, unit: Column | None = None) -> Column:
    """The start of what a date text names, as a timestamp; null if it names no date. All layouts are brought to the one
    that a cast reads, so that the expression stays small enough to be compiled. unit: the granularity, where it is known."""
    numbers = F.create_map(*[F.lit(v) for k, m in enumerate(_MONTHS) for name in dict.fromkeys((m, m[:3])) for v in (name, f"{k + 1:02d}")])
    name = F.lower(F.regexp_extract(x, "^.{5}([A-Za-z]{3,9})", 1))
    cut = lambda at, n: F.substring(x, at, n)
    named = F.concat(cut(1, 5), F.element_at(numbers, name), F.substr(x, F.length(name) + 6))
    compact = F.concat_ws("-", cut(1, 4), cut(5, 2), F.nullif(cut(7, 2), F.lit("")))
    unit = granularity(x) if unit is None else unit
    text = F.when(unit == "year", cut(1, 4)).when(name != "", named).when(cut(5, 1) != "-", compact).otherwise(F.translate(x, "TZ", " "))
    return F.when(_whole_day(x).isNotNull(), _whole_day(x).cast("timestamp")).when(unit.isNotNull(), text.try_cast("timestamp"))


def embargo_hours(x: Column) -> Column:
    """Hours of an embargo text; 0 for an empty one, null for a bad one."""
    hit = r"([PR])([0-9]+)([YMD])"
    unit = F.regexp_extract(x, hit, 3)
    hours = F.create_map(*[F.lit(v) for kv in UNIT_HOURS.items() for v in kv])
    return F.when(F.trim(x) == "", F.lit(0).cast("bigint")).when(unit != "", F.regexp_extract(x, hit, 2).try_cast("bigint") * F.element_at(hours, unit))


def embargo_allows(x: Column, t: Column, now: Column) -> Column:
    """R: nothing before the wall; P: nothing behind it; a bad text allows nothing."""
    wall = now - F.make_dt_interval(hours=embargo_hours(x).cast("int"))
    s = F.trim(x)
    return F.coalesce(F.when(s == "", F.lit(True)).when(embargo_hours(x).isNull(), F.lit(False)).when(s.startswith("R"), t >= wall).when(s.startswith("P"), t <= wall).otherwise(F.lit(True)), F.lit(False))


def truncate_dots(x: Column, n: int) -> Column:
    """Texts of n bytes or more are cut to n bytes; a character that is cut through is replaced, as decoders do."""
    cut = F.make_valid_utf8(F.substring(F.encode(x, "utf-8"), 1, n).cast("string"))
    return F.when(F.octet_length(x) < n, x).otherwise(F.concat(F.when(F.octet_length(x) == F.length(x), F.left(x, F.lit(n))).otherwise(cut), F.lit("...")))


def trim_zeros(x: Column) -> Column:
    return F.ltrim(x, F.lit("0"))


def strip_tags(x: Column) -> Column:
    return F.regexp_replace(x, "<[^>]*>", "")


def title_with_subtitle(title: Column, subtitle: Column) -> Column:
    joined = F.concat(title, F.lit(" : "), subtitle)
    return F.when((F.coalesce(subtitle, F.lit("")) == "") | title.contains(":") | title.contains(subtitle), title).otherwise(joined)


def page_count(x: Column, inclusive: bool = True) -> Column:
    """Pages of `a-b`; null unless both are numbers in order."""
    a, b = (F.try_element_at(F.split(x, "-"), F.lit(i)).try_cast("bigint") for i in (1, 2))
    return F.when(b >= a, b - a + int(inclusive))


def percent_change(before: Column, after: Column) -> Column:
    return F.when((before == 0) & (after == 0), 0.0).when(before == 0, 100.0).otherwise(F.round((after - before) / before * 100, 4) + 0.0)


def author_name(name: Column, last: Column, first: Column, ident: Column) -> Column:
    full = F.concat(F.nullif(last, F.lit("")), F.lit(", "), F.nullif(first, F.lit("")))
    return F.coalesce(F.nullif(name, F.lit("")), full, F.nullif(last, F.lit("")), ident)


def truthy(x: Column) -> Column:
    return F.lower(F.trim(x)).isin("ja", "yes", "ok", "1", "true")


def lookup(x: Column, known: dict[str, str], default: str) -> Column:
    """A value of a small table, or the default."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in known.items() for v in kv]), x), F.lit(default))


def first_match(x: Column, patterns: list[tuple[str, str]], default: str) -> Column:
    """The value of the first pattern, in order, that x matches."""
    return F.coalesce(*[F.when(x.rlike(p), F.lit(v)) for p, v in patterns], F.lit(default))


def _roman_value(s: Column) -> Column:
    """Letters count with their values; a smaller letter before a larger one counts twice less."""
    letters = {"M": 1000, "D": 500, "C": 100, "L": 50, "X": 10, "V": 5, "I": 1}
    less = {"CM": 200, "CD": 200, "XC": 20, "XL": 20, "IX": 2, "IV": 2}
    total = sum((F.length(s) - F.length(F.replace(s, F.lit(k), F.lit("")))) * v for k, v in letters.items())
    return total - sum(F.when(s.contains(k), v).otherwise(0) for k, v in less.items())


def roman(x: Column) -> Column:
    """Roman numerals as decimal text; any other text as it is."""
    s = F.upper(F.trim(x))
    whole = s.rlike("^M*(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$") & (s != "")
    return F.when(whole, _roman_value(s).cast("string")).otherwise(x)


def remove_all(x: Column, parts: list[str]) -> Column:
    """Without the parts, in one pass; at a place the part listed first counts."""
    return F.regexp_replace(x, "|".join("\\Q" + p + "\\E" for p in parts), "")


def split_trim(x: Column, separator: str) -> Column:
    """Trimmed parts of a separated list, empty ones left out."""
    parts = F.split(x, "\\Q" + separator + "\\E")
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def remove_each(xs: Column, drop: Column) -> Column:
    """The elements that drop hasn't; repeats and order stay."""
    return F.filter(xs, lambda v: ~F.array_contains(drop, v))


def clean_slashes(x: Column) -> Column:
    return F.replace(x, F.lit("\\/"), F.lit("/"))


def without_tabs(x: Column) -> Column:
    return F.translate(x, "\t", " ")


def date_of_parts(parts: Column) -> Column:
    """A date of one to three numbers (year, month, day); null for others and for days that don't exist."""
    at = [F.coalesce(F.get(parts, F.lit(k)), F.lit(1)) for k in range(3)]
    text = F.concat_ws("-", F.lpad(at[0].cast("string"), 4, "0"), *[F.lpad(a.cast("string"), 2, "0") for a in at[1:]])
    return F.when(F.size(parts).between(1, 3), F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))))


def imprint(place: Column, publisher: Column, year: Column) -> Column:
    """`place : publisher, year`, without what is empty or null."""
    head = F.concat_ws(" : ", F.nullif(place, F.lit("")), F.nullif(publisher, F.lit("")))
    mark = F.when(F.coalesce(publisher, F.lit("")) != "", ", ").otherwise(" : ")
    return F.when(year.isNull(), head).when(head == "", year.cast("string")).otherwise(F.concat(head, mark, year.cast("string")))


def all_text(*columns: Column) -> Column:
    """Words of all texts and lists, joined by one space."""
    return F.trim(F.regexp_replace(F.concat_ws(" ", *columns), r"\s+", " "))


def collection_name(publisher: Column, suffix: str, default: str) -> Column:
    clean = F.trim(F.translate(publisher, "\n", " "))
    return F.when(F.coalesce(publisher, F.lit("")) == "", default).otherwise(F.concat(clean, F.lit(f" ({suffix})")))


def subfields(fields: Column, tag: str, code: str) -> Column:
    """All values of `tag` and `code` in MARC data fields (array of structs _tag, subfield of structs _code, _VALUE)."""
    own = F.filter(fields, lambda f: f["_tag"] == tag)
    return F.flatten(F.transform(own, lambda f: F.transform(F.filter(f["subfield"], lambda s: s["_code"] == code), lambda s: s["_VALUE"])))


def qualified(fields: Column, schema: str, element: str, qualifier: str | None = None) -> Column:
    """All values of DIM fields (array of structs _mdschema, _element, _qualifier, _VALUE)."""
    return F.transform(F.filter(fields, lambda f: (f["_mdschema"] == schema) & (f["_element"] == element) & f["_qualifier"].eqNullSafe(F.lit(qualifier))), lambda f: f["_VALUE"])
