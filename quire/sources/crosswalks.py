"""Crosswalks: source records to intermediate records, as projections by name.

Each takes records and gives the same columns (COLUMNS). skip_reason is null for records to keep; `split` parts both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scalars as S
from ..functions import text as X

COLUMNS = {
    "id": "string", "record_id": "string", "source_id": "string", "format": "string", "genre": "string", "ref_type": "string", "title": "string", "subtitle": "string", "journal": "string",
    "collections": "array<string>", "authors": "array<struct<name:string,last:string,first:string>>", "issn": "array<string>", "isbn": "array<string>", "volume": "string", "issue": "string",
    "start_page": "string", "end_page": "string", "pages": "string", "page_count": "string", "publishers": "array<string>", "languages": "array<string>", "subjects": "array<string>",
    "urls": "array<string>", "doi": "string", "date": "date", "abstract": "string", "open_access": "boolean", "skip_reason": "string", "eissn": "array<string>", "eisbn": "array<string>", "book_title": "string",
    "series": "string", "places": "array<string>", "headings": "array<string>", "packages": "array<string>", "fulltext": "string", "edition": "string", "short_title": "string", "footnotes": "array<string>", "labels": "array<string>",
}
FORMATS: dict[str, Callable[..., DataFrame]] = {}
# Author noise, blocked titles, test publishers, the longest id and title.
NOISE = ["#", "--", "*", "|", "&NA;", "&"]
BLOCKED = ["Titelei", "Front Matter", "Advertisement", "Advertisement:"]
TESTERS = ["Crossref Testing", "test", "crossref-test"]
ID_LIMIT, TITLE_LIMIT = 250, 2400


def crosswalk(name: str):
    def add(f):
        FORMATS[name] = f
        return f

    return add


def intermediate(df: DataFrame, **values: Column) -> DataFrame:
    """The given columns, and null for the others."""
    return df.select(*[values.get(k, F.lit(None)).cast(t).alias(k) for k, t in COLUMNS.items()])


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept and rejected records."""
    return df.filter("skip_reason is null").drop("skip_reason"), df.filter("skip_reason is not null")


def names(xs: Column) -> Column:
    empty = F.lit(None).cast("string")
    return F.transform(xs, lambda x: F.struct(x.alias("name"), empty.alias("last"), empty.alias("first")))


def _joined(xs: Column) -> Column:
    return F.trim(F.array_join(xs, " "))


@crosswalk("works")
def works(df: DataFrame, now: Column, types: dict[str, tuple[str, str, str]] | None = None) -> DataFrame:
    """Registry works. types: format, genre and reference type of a type. A record without any date or URL, an error at
    the source, is skipped by its own reason. `now` bounds dates: two years later is too late."""
    types = types or {"journal-article": ("ElectronicArticle", "article", "EJOUR")}
    kind = lambda k, default: S.lookup(F.col("type"), {t: v[k] for t, v in types.items()}, default)
    date = F.coalesce(*[S.date_of_parts(F.get(F.col(f"`{f}`.`date-parts`"), F.lit(0))) for f in ("published-print", "issued", "created", "deposited")])
    head, tail = _joined(F.col("title")), _joined(F.col("subtitle"))
    has_tail = F.coalesce(F.size("subtitle"), F.lit(0)) > 0
    with_tail = has_tail & ~F.coalesce(head.contains(F.get("subtitle", F.lit(0))), F.lit(False)) & ~head.contains(":")
    whole = F.when(F.coalesce(F.size("title"), F.lit(0)) > 0, F.when(with_tail, F.concat(head, F.lit(" : "), tail)).otherwise(head)).when(has_tail, tail).otherwise("")
    journal = X.unescape_trim(F.get("container-title", F.lit(0)))
    bare = F.regexp_replace(whole, "[?]{6,}", "")
    title = F.when(F.col("type").startswith("book-"), F.concat(journal, F.lit(": "), bare)).otherwise(bare)
    ident = S.record_id(F.lit("49"), F.col("DOI"))
    skip = (
        F.when(date.isNull(), "NO_DATE").when(F.coalesce("URL", F.lit("")) == "", "NO_URL").when(F.length(ident) > ID_LIMIT, "ID_TOO_LONG")
        .when(date > F.to_date(now + F.expr("interval 730 days")), "TOO_FUTURISTIC").when(F.col("type") == "journal-issue", "JOURNAL_ISSUE").when(whole == "", "NO_ATITLE")
        .when(whole.isin(BLOCKED), "BLOCKED_ATITLE").when(F.octet_length(bare) > TITLE_LIMIT, "TOO_LONG_TITLE").when(journal.isNull(), "NO_JTITLE").when(F.col("publisher").isin(TESTERS), "BLACKLISTED_COLLECTION")
    )
    cells = F.split("page", "-")
    first, last = (F.when(F.size(cells) == 2, F.get(cells, F.lit(k)).try_cast("int")) for k in (0, 1))
    last = F.when(first.isNotNull(), last)
    count = F.when((first != 0) & (last != 0) & (last >= first), last - first + 1)
    people = F.transform("author", lambda a: F.struct(F.lit(None).cast("string").alias("name"), S.remove_all(X.unescape_trim(a["family"]), NOISE).alias("last"), S.remove_all(X.unescape_trim(a["given"]), NOISE).alias("first")))
    return intermediate(
        df, id=ident, record_id=F.col("DOI"), source_id=F.lit("49"), format=kind(0, "ElectronicArticle"), genre=kind(1, "unknown"), ref_type=kind(2, "GEN"), title=title, subtitle=X.unescape_trim(F.get("subtitle", F.lit(0))),
        journal=journal, collections=F.array(S.collection_name(F.col("publisher"), "CrossRef", "X-U (CrossRef)")), authors=people, issn=F.col("ISSN"), isbn=F.col("ISBN"), volume=S.trim_zeros(F.col("volume")),
        issue=S.trim_zeros(F.col("issue")), start_page=F.when(first != 0, first), end_page=F.when(last != 0, last), pages=F.col("page"), page_count=count, publishers=F.array("publisher"), subjects=F.col("subject"),
        languages=F.array(F.coalesce(X.language_code(F.col("language")), F.lit("und"))), urls=F.array("URL"), doi=F.col("DOI"), date=date, abstract=F.col("abstract"), skip_reason=skip,
    )


def _dublin(df: DataFrame, source: str, ident: Column, date: Column, skip: Column, **more: Column) -> DataFrame:
    """Fields common to Dublin Core records: identifier (of the header), and lists of dc elements."""
    links = F.filter("links", lambda x: x.startswith("http"))
    common = {"id": ident, "record_id": F.col("identifier"), "source_id": F.lit(source), "genre": F.lit("article"), "ref_type": F.lit("EJOUR"), "urls": links, "publishers": F.col("publisher"), "subjects": F.col("subject"), "date": date}
    return intermediate(df, **(common | {"title": F.get("title", F.lit(0)), "authors": names(F.transform("creator", lambda x: F.rtrim(F.trim(x), F.lit(",")))), "skip_reason": skip} | more))


@crosswalk("dc-journals")
def dc_journals(df: DataFrame) -> DataFrame:
    """Journal articles in Dublin Core: a full date is needed, DOIs stand among the links."""
    date = F.to_date(F.try_to_timestamp(F.substring(F.get("date", F.lit(0)), 1, 10), F.lit("yyyy-MM-dd")))
    resolver = "http://dx.doi.org/"
    doi = F.get(F.transform(F.filter("links", lambda x: x.startswith(resolver)), lambda x: F.replace(x, F.lit(resolver), F.lit(""))), F.lit(-1) + F.size(F.filter("links", lambda x: x.startswith(resolver))))
    maker = F.get("publisher", F.lit(0))
    collection = F.when(maker.isNull(), "HighWire").otherwise(F.concat(maker, F.lit(" (HighWire)")))
    return _dublin(df, "200", S.record_id(F.lit("200"), F.col("identifier")), date, F.when(date.isNull(), "NO_DATE"), doi=doi, collections=F.array(collection), languages=F.col("language"), abstract=F.array_join("description", "\n"))


@crosswalk("dc-archive")
def dc_archive(df: DataFrame) -> DataFrame:
    """Archive items in Dublin Core: the id follows the colon, only the year of the date counts."""
    year = F.substring(F.get("date", F.lit(0)), 1, 4)
    tail = F.get(F.split("identifier", ":"), F.lit(1))
    date = F.to_date(F.try_to_timestamp(year, F.lit("yyyy")))
    raw = F.coalesce(F.get("date", F.lit(0)), F.lit(""))
    skip = F.when(tail.isNull(), "BAD_ID").when(raw == "", "EMPTY_DATE").when(F.length(raw) < 4, "SHORT_DATE").when(date.isNull(), "BAD_DATE")
    return _dublin(df, "12502", F.concat(F.lit("ai-12502-"), tail), date, skip, collections=F.array(F.lit("Olms")), languages=F.array(F.lit("und")))


@crosswalk("titles")
def titles(df: DataFrame) -> DataFrame:
    """Only a title."""
    return intermediate(df, title=F.col("title"))


@crosswalk("pages")
def pages(df: DataFrame, longest: int = TITLE_LIMIT, raw: bool = False) -> DataFrame:
    """Web pages (identifier, url, html): the title, the language that the page states. raw: from plain lower-case tags only,
    and the title as it stands there, with its references and outer spaces."""
    if raw:
        title, lang = F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.regexp_extract("html", '<html lang="([a-z]+)"', 1)
    else:
        title = X.unescape_trim(F.regexp_extract("html", "(?is)<title[^>]*>([^<]*)</title>", 1))
        lang = F.regexp_extract("html", '(?i)<html[^>]* lang="([a-z]+)"', 1)
    title, lang = F.nullif(title, F.lit("")), F.nullif(lang, F.lit(""))
    skip = F.when(title.isNull(), "NO_TITLE").when(F.length(title) > longest, "TOO_LONG_TITLE")
    return intermediate(df, record_id=F.col("identifier"), title=title, languages=F.array_compact(F.array(lang)), urls=F.array("url"), skip_reason=skip)


def flag_open_access(records: DataFrame, always: list[str], excluded: list[str], covered: Column, free: Column) -> DataFrame:
    """Records of excluded sources stay as they are; those of others are open if their source always is, else as the free
    list says where it knows them, else if holdings cover them, else as before."""
    own = F.coalesce("open_access", F.lit(False))
    found = F.when(F.col("source_id").isin(always), True).otherwise(F.coalesce(free, F.when(covered, True), own))
    return records.withColumn("open_access", F.when(F.col("source_id").isin(excluded), own).otherwise(found))
