"""Expressions over texts: character references, languages, years and localised dates, identifiers, nested text output."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F, types as T

from .scalars import author_name, strip_tags

#: Identifier pattern: a fixed value.
DOI = r"10[.][0-9]{2,6}/[^ \"\x1f\x1e]{3,}"
#: Space separators of Unicode.
SPACES = " \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
#: Languages by ISO 639-3 code: what names them besides the code. Pass others as `known`.
LANGUAGES = {
    "ara": ["ar", "arabic"], "bul": ["bg", "bulgarian"], "cat": ["ca", "catalan"], "ces": ["cs", "cze", "czech"], "dan": ["da", "danish"], "deu": ["de", "ger", "german"], "ell": ["el", "gre", "greek"],
    "eng": ["en", "english"], "epo": ["eo", "esperanto"], "est": ["et", "estonian"], "fas": ["fa", "per", "persian"], "fin": ["fi", "finnish"], "fra": ["fr", "fre", "french"], "hbs": ["sh", "serbo-croatian"],
    "heb": ["he", "hebrew"], "hrv": ["hr", "croatian"], "hun": ["hu", "hungarian"], "ita": ["it", "italian"], "jpn": ["ja", "japanese"], "kor": ["ko", "korean"], "lat": ["la", "latin"], "lit": ["lt", "lithuanian"],
    "nld": ["nl", "dut", "dutch"], "nor": ["no", "norwegian"], "pol": ["pl", "polish"], "por": ["pt", "portuguese"], "ron": ["ro", "rum", "romanian"], "rus": ["ru", "russian"], "slk": ["sk", "slo", "slovak"],
    "slv": ["sl", "slovenian"], "spa": ["es", "spanish"], "sqi": ["sq", "alb", "albanian"], "srp": ["sr", "serbian"], "swe": ["sv", "swedish"], "tur": ["tr", "turkish"], "ukr": ["uk", "ukrainian"], "zho": ["zh", "chi", "chinese"],
}
#: Frequent words by language, for detection.
COMMON = {
    "deu": "der die das und ist nicht ein eine einer den dem des mit von zu im auf für sich auch als wird bei oder nach aus über zum zur werden sind durch darinnen",
    "eng": "the of and to in is that for it was on are as with his they at be this from have or by one had not but what all were when we there can an on for with",
    "fra": "le la les des et est une dans pour que qui sur au aux avec son ses par plus ne pas du un ce cette sont elle il nous vous où",
    "ita": "il lo gli di che è per una con non del della sono nel alla dei delle anche come più un da e al si",
    "spa": "el los las de que y en un una por con no para su es se del al lo como más sus pero",
}
#: Months of embargo notes, German and English, by their first three letters.
MONTHS = {"jan": 1, "feb": 2, "mär": 3, "mar": 3, "apr": 4, "mai": 5, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "okt": 10, "oct": 10, "nov": 11, "dez": 12, "dec": 12}


def _map(known: dict) -> Column:
    return F.create_map(*[F.lit(v) for kv in known.items() for v in kv])


def _code_point(n: Column) -> Column:
    ok = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    return F.when(ok, F.decode(F.unhex(F.lpad(F.hex(F.when(ok, n)), 8, "0")), "UTF-32"))


def unescape(x: Column) -> Column:
    """Named and numeric character references replaced; unknown ones stay."""
    names = _map({k: chr(v) for k, v in name2codepoint.items()} | {"apos": "'"})

    def one(part: Column) -> Column:
        ref = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        number = F.when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, 3, 6), 16, 10).try_cast("bigint")).when(ref.startswith("#"), F.substring(ref, 2, 7).try_cast("bigint"))
        char = F.when(ref == "", F.lit(None)).when(ref.startswith("#"), _code_point(number)).otherwise(F.element_at(names, ref))
        return F.coalesce(F.concat(char, F.substr(part, F.length(ref) + 2)), F.concat(F.lit("&"), part))

    parts = F.split(x, "&")
    whole = F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), one), ""))
    return F.when(x.contains("&"), whole).otherwise(x)


def unescape_trim(x: Column) -> Column:
    return F.trim(unescape(x))


def clean_html(x: Column) -> Column:
    """Without tags, references replaced, trimmed."""
    return F.trim(unescape(strip_tags(x)))


def clean_html_amp(x: Column) -> Column:
    """Ampersands' references replaced (others stay), then without tags and the spaces of any kind around."""
    return F.trim(strip_tags(F.replace(x, F.lit("&amp;"), F.lit("&"))), F.lit(SPACES))


def language_code(x: Column, known: dict[str, list[str]] | None = None) -> Column:
    """The three-letter code of a code or English name of a language; null for others."""
    table = {alias: code for code, names in (known or LANGUAGES).items() for alias in [code, *names]}
    return F.element_at(_map(table), F.lower(F.trim(x)))


def detect_language(x: Column, accepted: list[str] | None = None, least: int = 20) -> Column:
    """The language whose frequent words make up most of a text; null for short texts, no hits and ties."""
    words = F.split(F.lower(x), r"[^\p{L}]+")

    def hits(own: str) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(*own.split())))

    counts = F.array(*[F.struct(hits(own).alias("n"), F.lit(code).alias("code")) for code, own in COMMON.items()])
    ranked = F.sort_array(counts, asc=False)
    best, second = F.get(ranked, F.lit(0)), F.get(ranked, F.lit(1))
    code = F.when((best["n"] > 0) & (best["n"] > second["n"]), best["code"])
    return F.when((F.length(x) >= least) & code.isin(accepted or list(COMMON)), code)


def find_year(x: Column, pattern: str = "[12][0-9]{3}") -> Column:
    """The first year in a text; null if none."""
    return F.nullif(F.regexp_extract(x, pattern, 0), F.lit("")).try_cast("int")


def year_start(year: Column) -> Column:
    return F.to_date(F.try_to_timestamp(F.lpad(year.cast("string"), 4, "0"), F.lit("yyyy")))


def clamped_date(year: Column, month: Column, day: Column) -> Column:
    """A date of texts: months by number or first three letters, what is out of range becomes 1; null without a year."""
    letters = F.element_at(_map(MONTHS), F.lower(F.substring(F.trim(month), 1, 3)))
    m = F.coalesce(F.when(F.substring(month, 1, 3).try_cast("int").isNotNull(), F.when(F.substring(month, 1, 3).try_cast("int").between(1, 12), F.substring(month, 1, 3).try_cast("int")).otherwise(1)), letters, F.when(F.coalesce(month, F.lit("")) == "", 1))
    d = F.coalesce(F.when(day.try_cast("int").between(1, 31), day.try_cast("int")), F.lit(1))
    text = F.concat_ws("-", F.lpad(year.try_cast("int").cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))
    return F.when(year.try_cast("int").isNotNull() & m.isNotNull(), F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))))


def embargo_until(note: Column) -> Column:
    """The day named by an embargo note such as `… Embargofrist bis zum 18. Okt. 2018.`, in German or English; else null."""
    hit = r"Embargofrist bis zum ([0-9]{2})\. (\p{L}{3})\p{L}*\.? ([0-9]{4})\.?"
    day, month, year = (F.regexp_extract(note, hit, k) for k in (1, 2, 3))
    text = F.concat_ws("-", year, F.lpad(F.element_at(_map(MONTHS), F.lower(month)).cast("string"), 2, "0"), day)
    return F.when(day != "", F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))))


def clean_doi(x: Column) -> Column:
    """Without what closes a sentence or an enclosing bracket; balanced brackets stay. One end is taken off."""
    s = F.trim(x)
    cut = lambda n: F.left(s, F.length(s) - n)
    ends = reduce(lambda a, b: a | b, [s.endswith(e) for e in (".", ",", ":", "*", "”", "'")])
    return (
        F.when(s.endswith("])"), cut(2)).when(s.endswith("/epdf"), cut(5)).when(s.endswith(")") & ~s.contains("("), cut(1)).when(s.endswith("]") & ~s.contains("["), cut(1)).when(ends, cut(1)).otherwise(s)
    )


def sniff_map(fields: Column, ignored: list[str] | None = None, pattern: str = DOI, clean=clean_doi) -> Column:
    """Identifiers in a map of texts or lists of texts (map<string,string> or map<string,array<string>>): the first of each
    text, distinct and sorted; keys that match an ignored pattern are left out."""
    kept = F.map_filter(fields, lambda k, v: ~reduce(lambda a, b: a | b, [k.rlike(p) for p in ignored or []], F.lit(False)))
    return sniff_list(F.map_values(kept), pattern, clean)


def sniff_lists(fields: Column, ignored: list[str] | None = None, pattern: str = DOI, clean=clean_doi) -> Column:
    """As sniff_map, for map<string,array<string>>."""
    kept = F.map_filter(fields, lambda k, v: ~reduce(lambda a, b: a | b, [k.rlike(p) for p in ignored or []], F.lit(False)))
    return sniff_list(F.flatten(F.map_values(kept)), pattern, clean)


def sniff_list(texts: Column, pattern: str = DOI, clean=clean_doi) -> Column:
    found = F.transform(texts, lambda t: F.regexp_extract(t, pattern, 0))
    return F.array_sort(F.array_distinct(F.transform(F.filter(found, lambda t: t != ""), clean)))


def update_key(present: Column, found: Column, overwrite: bool = False) -> Column:
    """What a record's identifier list becomes: the found ones where it has none (null or empty), or if they overwrite."""
    empty = F.coalesce(F.size(present), F.lit(0)) <= 0
    return F.when((F.size(found) > 0) & (empty | F.lit(overwrite)), found).otherwise(present)


def sortable_title(book: Column, article: Column) -> Column:
    title = F.when(F.coalesce(book, F.lit("")) != "", book).otherwise(F.coalesce(article, F.lit("")))
    return clean_html(F.lower(title))


def sortable_author(authors: Column, book: Column, article: Column) -> Column:
    """All author names in lower case, and the sortable title behind them."""
    people = F.transform(authors, lambda a: F.lower(F.coalesce(author_name(a["name"], a["last"], a["first"], F.lit(None).cast("string")), F.lit(""))))
    return F.concat(F.array_join(F.coalesce(people, F.array().cast("array<string>")), ""), sortable_title(book, article))


def relative_date(text: str, now: dt.datetime) -> dt.datetime:
    """now, today, yesterday, `N.units.ago`, `N units ago`, or a date in a common layout, in UTC; ValueError for others."""
    s = text.strip().lower()
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0)
    named = {"now": now, "today": midnight, "yesterday": midnight - dt.timedelta(days=1)}
    if s in named:
        return named[s]
    parts = [p for p in re.split(r"[. ]+", s) if p]
    if len(parts) == 3 and parts[2] == "ago" and re.fullmatch(r"\+?[0-9]+", parts[0]):
        n, unit = int(parts[0]), parts[1].removesuffix("s")
        if unit in ("second", "minute", "hour", "day", "week"):
            return now - dt.timedelta(**{unit + "s": n})
        if unit in ("month", "year"):
            months = now.year * 12 + now.month - 1 - n * (12 if unit == "year" else 1)
            first = now.replace(year=months // 12, month=months % 12 + 1, day=1)
            return first + dt.timedelta(days=now.day - 1)  # as calendars normalise: February 31 is in March
    for layout in (None, "%Y/%m/%d", "%Y%m%d", "%d.%m.%Y", "%m/%d/%Y", "%B %d, %Y", "%b %d, %Y", "%d %b %Y", "%d %B %Y", "%Y-%m", "%Y"):
        try:
            t = dt.datetime.fromisoformat(text.strip()) if layout is None else dt.datetime.strptime(text.strip(), layout)
        except ValueError:
            continue
        return t.astimezone(dt.timezone.utc).replace(tzinfo=now.tzinfo) if t.tzinfo else t.replace(tzinfo=now.tzinfo)
    raise ValueError(f"no date: {text!r}")


def _escaped(x: Column) -> Column:
    """Backslashes and quotes escaped, line ends as \\n, lone carriage returns as spaces."""
    for old, new in (("\\", "\\\\"), ("\r\n", "\\n"), ("\n", "\\n"), ("'", "\\'"), ("\r", " ")):
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def nested_text(x: Column, kind: T.DataType, key: str = "") -> Column:
    """A struct as nested text, `key { name: 'value', inner { … } }`; lists repeat their key, nulls and empty texts go."""
    none = F.lit("")
    if isinstance(kind, T.StructType):
        inner = [nested_text(x.getField(f.name), f.dataType, f.name) for f in kind.fields]
        return F.when(x.isNull(), none).otherwise(F.concat(F.lit(f"{key} {{ "), *inner, F.lit(" } ")))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.array_join(F.transform(x, lambda v: nested_text(v, kind.elementType, key)), ""), none)
    if isinstance(kind, T.StringType):
        return F.when(F.coalesce(x, none) == "", none).otherwise(F.concat(F.lit(f"{key}: '"), _escaped(x), F.lit("', ")))
    if isinstance(kind, T.IntegralType):
        value = x.cast("string")
    elif isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        value = F.format_string("%.6f", x.cast("double"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.concat(F.lit("'"), F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("'"))
    else:
        value = F.concat(F.lit("'"), x.cast("string"), F.lit("'"))
    return F.coalesce(F.concat(F.lit(f"{key}: "), value, F.lit(", ")), none)


def formeta(row: Column, kind: T.StructType) -> Column:
    """A whole record as nested text."""
    return F.trim(nested_text(row, kind))
