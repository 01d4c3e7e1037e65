"""Crosswalks of XML articles, library records, directory entries, press documents and shipments to intermediate records.

Each takes a DataFrame of the records' own shape (SCHEMAS, as the XML or JSON reader gives it) and gives the columns of
crosswalks.COLUMNS. Tables of languages, classes and the like are parameters. What the source cannot date or identify has a
skip_reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scalars as S
from ..functions import text as X
from .crosswalks import ID_LIMIT, crosswalk, intermediate, names

_MARC = "leader string, controlfield array<struct<_tag:string,_VALUE:string>>, datafield array<struct<_tag:string,_ind1:string,_ind2:string,subfield:array<struct<_code:string,_VALUE:string>>>>"
_PUB_DATE = "array<struct<`_pub-type`:string,day:string,month:string,year:string>>"
_NAME = "struct<surname:string,`given-names`:string>"
_BIB = """struct<abstract:string,author:array<struct<name:string>>,end_page:string,identifier:array<struct<id:string,type:string>>,journal:struct<issns:array<string>,language:array<string>,publisher:string,
title:string,volume:string,number:string>,link:array<struct<type:string,url:string>>,month:string,start_page:string,subject:array<struct<code:string,scheme:string,term:string>>,title:string,year:string>"""
_PEOPLE = "array<struct<`given-name`:string,surname:string>>"
SCHEMAS = {
    "directory": f"id string, created_date string, bibjson {_BIB}",
    "directory-legacy": f"_id string, _source struct<id:string,bibjson:{_BIB},index:struct<date:string,issn:array<string>,language:array<string>,schema_code:array<string>>>",
    "directory-oai": "header struct<identifier:string>, metadata struct<dc:struct<title:string,source:string,date:string,creator:array<string>,identifier:array<string>,language:array<string>,subject:array<struct<_type:string,_VALUE:string>>>>",
    "press": """_ID string, _DB string, Abstract string, Authors struct<Author:array<string>>, Descriptors struct<Descriptor:string>, Date string, Issue string, ISSN string, `Publication-Title` string, Source string, Title string,
Text string, Volume string, Year string, Persistent_Link string, Modules struct<Module:array<string>>, `X-Package` string, available string""",
    "articles": f"""`_article-type` string, front struct<`journal-meta`:struct<issn:array<struct<`_pub-type`:string,_VALUE:string>>,`journal-title-group`:struct<`journal-title`:string,`abbrev-journal-title`:string>,
`abbrev-journal-title`:string,publisher:struct<`publisher-name`:string>>,`article-meta`:struct<`article-id`:array<struct<`_pub-id-type`:string,_VALUE:string>>,`title-group`:struct<`article-title`:string,subtitle:string>,
`contrib-group`:struct<contrib:array<struct<`_contrib-type`:string,name:{_NAME},`string-name`:{_NAME}>>>,`article-categories`:struct<`subj-group`:array<struct<`_subj-group-type`:string,subject:array<string>>>>,
`pub-date`:{_PUB_DATE},volume:string,issue:string,fpage:string,lpage:string,product:array<struct<source:string,`string-name`:string>>,abstract:string,`self-uri`:struct<_href:string>,
`custom-meta-group`:struct<`custom-meta`:array<struct<`meta-name`:string,`meta-value`:string>>>>>, body string""",
    "publisher-records": f"""metadata struct<article:array<struct<_lang:string,front:struct<`journal-meta`:struct<issn:array<struct<`_pub-type`:string,_VALUE:string>>,`journal-title-group`:struct<`journal-title`:string>,
publisher:struct<`publisher-name`:string>>,`article-meta`:struct<`article-id`:struct<`_pub-id-type`:string,_VALUE:string>,`title-group`:struct<`article-title`:string>,`contrib-group`:struct<contrib:array<struct<name:{_NAME}>>>,
`article-categories`:struct<`subj-group`:struct<subject:string>>,`pub-date`:struct<day:string,month:string,year:string>,volume:string,issue:string,fpage:string,lpage:string,abstract:string>>>>>""",
    "publications": """title string, publicationinfo struct<issn:array<struct<_mediatype:string,_VALUE:string>>,isbn:array<struct<_VALUE:string>>,publicationtype:string,publicationsubtype:string,packagememberset:struct<packagemember:array<string>>>,
volume struct<volumeinfo:struct<volumenum:string>,article:struct<title:string,articleinfo:struct<abstract:string,amsid:string,articledoi:string,issuenum:string,articlelicense:string,
artpagenums:struct<_startpage:string,_endpage:string>,authorgroup:struct<author:array<struct<firstname:string,surname:string>>>,date:array<struct<_datetype:string,year:string,month:string,day:string>>,
keywordset:struct<keyword:array<struct<keywordterm:string>>>>>>""",
    "bilingual": """UniqueID string, ISSN string, eISSN string, PublicationTitle string, PublicationTitleEnglish string, ArticleTitle string, ArticleTitleEnglish string, IsOpenAccess string, PublicationYear string, Volume string,
Issue string, StartPage string, EndPage string, PageCount string, ArticleURL string, Authors struct<Author:array<string>>, Languages struct<Language:array<string>>, SubjectTerms struct<SubjectTerm:array<string>>, Publisher string,
PublisherEnglish string, Description string""",
    "marc-books": _MARC,
    "marc-archive": f"header struct<identifier:string>, metadata struct<record:struct<{_MARC.replace('leader string', 'leader:string').replace(', controlfield ', ',controlfield:').replace(', datafield ', ',datafield:')}>>",
    "bibliography": "_key string, author array<string>, title string, year string, volume string, number string, publisher string, url string, ee array<string>",
    "dc-gender": "header struct<identifier:string>, metadata struct<dc:struct<title:string,creator:array<string>,identifier:array<string>,source:string,publisher:array<string>,date:string,subject:array<string>,language:string>>",
    "dc-manuscripts": "header struct<identifier:string>, metadata struct<dc:struct<creator:string,title:string,date:string,identifier:array<string>,language:array<string>,type:string,ispartof:array<string>,subject:array<string>,spatial:array<string>,temporal:array<string>,alternative:string>>",
    "dim": "header struct<identifier:string>, metadata struct<dim:struct<field:array<struct<_mdschema:string,_element:string,_qualifier:string,_VALUE:string>>>>",
    "mets-archive": "header struct<identifier:string>, metadata struct<mets:struct<dmdSec:array<struct<mdWrap:struct<xmlData:struct<mods:struct<language:struct<languageTerm:string>>>>>>>>",
    "dc-prints": "header struct<identifier:string>, metadata struct<dc:struct<title:array<string>,creator:array<string>,source:array<string>,publisher:array<string>,subject:array<string>,language:array<string>>>",
    "mets-prints": """header struct<identifier:string>, metadata struct<mets:struct<dmdSec:struct<mdWrap:struct<xmlData:struct<mods:struct<titleInfo:struct<title:string,subTitle:string>,identifier:array<struct<_type:string,_VALUE:string>>,
originInfo:array<struct<publisher:array<string>,dateIssued:array<string>>>,language:array<struct<languageTerm:string>>>>>>>>""",
    "shipment-article": f"`item-info` struct<pii:string,doi:string,copyright:struct<_year:string>>, head struct<title:string,`author-group`:struct<author:{_PEOPLE}>,`date-received`:struct<_day:string,_month:string,_year:string>,abstract:array<string>>, `simple-head` struct<title:string,`author-group`:struct<author:{_PEOPLE}>>",
    "shipment-issue": "`issue-info` struct<pii:string,issn:string,`volume-issue-number`:struct<`vol-first`:string,`iss-first`:string>>, `issue-body` struct<`issue-sec`:array<struct<`include-item`:array<struct<pii:string,doi:string,pages:struct<`first-page`:string,`last-page`:string>>>>>>",
    "shipment-dataset": "`dataset-content` struct<`journal-issue`:array<struct<`journal-issue-unique-ids`:struct<pii:string>,`journal-issue-properties`:struct<`collection-title`:string>>>>",
}
#: Notes of roles behind names, and names that are none: fixed values.
ROLES = ["[Hrsg.]", "[Adr.]", "[Bearb.]", "[Ill.]", "[Übers.]", "[Vorr.]", "[Mitarb.]", "[Red.]", "[Komm.]", "[Samml.]", "[Komment.]", "[Korres.]", "[Begr.]", "[Verstorb.]", "[Vorredn.]", "[Komp.]"]
NO_AUTHORS = ["No Author Specified", "Miscellaneous, Miscellaneous", "Anonymous, Anonymous", "Various, Authors", "TOL, TOL"]
PRESS_CLUES = ["www.", "http:", "&quot", "part 1 of", "part 2 of", "Copyright", "(c)", "All rights reserved", "he said"]
PRESS_PACKAGES = {
    "fachzeitschriften": "sid-48-col-wisofachzs", "literaturnachweise_psychologie": "sid-48-col-wisopsych", "ebooks_recht": "sid-48-col-wisorecht", "literaturnachweise_sozialwissenschaften": "sid-48-col-wisosozial",
    "ebooks_technik": "sid-48-col-wisotechnik", "ebooks_wiwi": "sid-48-col-wisowirtschaft",
}
BLOCKED_TITLES = r"(?i)((front|back)\s*matter|table\s*of\s*content[s]?)"
SUPPRESSED = ["misc", "other", "front-matter", "back-matter", "announcement", "font-matter", "fm", "fornt-matter"]
REVIEWS = ["book-review", "book-reviews", "Book Review"]
UNASSIGNED = "not assigned"


def _first(x) -> Column:
    return F.get(F.col(x) if isinstance(x, str) else x, F.lit(0))


def _some(x: Column) -> Column:
    """Null where empty."""
    return F.nullif(x, F.lit(""))


def _blank(x: Column) -> Column:
    return F.coalesce(x, F.lit("")) == ""


def _strings(x: Column) -> Column:
    return F.coalesce(x, F.array().cast("array<string>"))


def _range(first: Column, last: Column) -> Column:
    return F.when(~_blank(first) | ~_blank(last), F.concat(F.coalesce(first, F.lit("")), F.lit("-"), F.coalesce(last, F.lit(""))))


def _minus(first: Column, last: Column, plus: int = 0) -> Column:
    return (last.try_cast("int") - first.try_cast("int") + plus).cast("string")


def _people(xs: Column, last: str, first: str) -> Column:
    return F.transform(xs, lambda a: F.struct(F.lit(None).cast("string").alias("name"), a[last].alias("last"), a[first].alias("first")))


def _long(ident: Column) -> Column:
    return F.octet_length(ident) > ID_LIMIT


def _day(x: Column) -> Column:
    return F.to_date(F.try_to_timestamp(x, F.lit("yyyy-MM-dd")))


# --- directory of journals


def _directory(df: DataFrame, b: Column, ident: Column, stamp: Column, issn: Column, codes: Column, spoken: Column, classes: list[tuple[str, str]], record: Column | None, **more) -> DataFrame:
    year, month = b["year"].try_cast("int"), b["month"].try_cast("int")
    own = F.when(year.isNotNull(), _day(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(F.when(month.between(1, 12), month).otherwise(1).cast("string"), 2, "0"), F.lit("01"))))
    date = F.when(_blank(stamp), own).otherwise(F.to_date(F.try_to_timestamp(F.regexp_extract(stamp, r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})Z$", 1), F.lit("yyyy-MM-dd'T'HH:mm:ss"))))
    raw = F.trim(_first(F.filter(b["identifier"], lambda i: i["type"] == "doi"))["id"])
    doi = _some(F.when(raw.contains("http"), F.regexp_extract(raw, r"10[.][a-zA-Z0-9]+/[\S]*$", 0)).otherwise(raw))
    links = F.transform(b["link"], lambda x: x["url"])
    urls = F.when(doi.isNotNull(), F.array(F.concat(F.lit("http://doi.org/"), doi))).when(F.coalesce(F.size(links), F.lit(0)) > 0, links).otherwise(F.array(F.concat(F.lit("https://doaj.org/article/"), ident)))
    found = F.array_sort(F.array_distinct(F.filter(F.transform(codes, lambda c: S.first_match(c, classes, UNASSIGNED)), lambda c: c != UNASSIGNED)))
    tongues = F.array_sort(F.array_distinct(F.transform(spoken, lambda v: F.coalesce(X.language_code(v), F.lit("und")))))
    first, last = b["start_page"], b["end_page"]
    whole = F.concat(F.lit("ai-28-"), ident)
    return intermediate(
        df, id=whole, record_id=F.coalesce(doi, ident) if record is None else record, source_id=F.lit("28"), format=F.lit("ElectronicArticle"), genre=F.lit("article"), ref_type=F.lit("EJOUR"), title=b["title"], journal=b["journal"]["title"],
        collections=F.array(F.lit("DOAJ Directory of Open Access Journals")), authors=names(F.transform(b["author"], lambda a: X.unescape(a["name"]))), issn=issn, volume=b["journal"]["volume"], start_page=first, end_page=last,
        pages=F.when(_minus(first, last).isNotNull(), F.concat_ws("-", first.try_cast("int"), last.try_cast("int"))), page_count=_minus(first, last), publishers=F.when(~_blank(F.trim(b["journal"]["publisher"])), F.array(F.trim(b["journal"]["publisher"]))),
        languages=tongues, subjects=F.when(F.coalesce(F.size(found), F.lit(0)) > 0, found).otherwise(F.array(F.lit(UNASSIGNED))), urls=urls, doi=doi, date=date,
        skip_reason=F.when(date.isNull(), "NO_DATE").when(_blank(ident), "NO_ID").when(_long(whole), "ID_TOO_LONG"), **more,
    )


@crosswalk("directory")
def directory(df: DataFrame, classes: list[tuple[str, str]] | None = None) -> DataFrame:
    """Articles of a journal directory; all of them are open. classes: patterns of subject codes, in order, and classes."""
    b = F.col("bibjson")
    return _directory(df, b, F.col("id"), F.col("created_date"), b["journal"]["issns"], F.transform(b["subject"], lambda s: s["code"]), b["journal"]["language"], classes or [], F.col("id"), open_access=F.lit(True))


@crosswalk("directory-legacy")
def directory_legacy(df: DataFrame, classes: list[tuple[str, str]] | None = None) -> DataFrame:
    """Search responses of the directory, as they were: serials, languages and codes stand in the index part."""
    s = F.col("_source")
    i = s["index"]
    return _directory(df, s["bibjson"], s["id"], i["date"], i["issn"], F.transform(i["schema_code"], lambda c: F.replace(c, F.lit("LCC:"), F.lit(""))), i["language"], classes or [], None)


@crosswalk("directory-oai")
def directory_oai(df: DataFrame, classes: list[tuple[str, str]] | None = None) -> DataFrame:
    """Dublin Core of the directory: volume, issue and pages stand in the source text."""
    dc = F.col("metadata")["dc"]
    home = "https://doaj.org/article/"
    ident = F.replace(_first(F.filter(dc["identifier"], lambda x: x.startswith(home))), F.lit(home), F.lit(""))
    dois = F.filter(dc["identifier"], lambda x: x.startswith("10."))
    serial = F.transform(dc["identifier"], lambda x: F.when(F.octet_length(F.trim(x)) == 8, F.concat(F.substring(F.trim(x), 1, 4), F.lit("-"), F.substring(F.trim(x), 5, 4))).otherwise(F.trim(x)))
    source = dc["source"]
    part = lambda p: _some(F.trim(F.regexp_extract(source, rf"(?i){p} ([0-9]*)", 1)))
    first, last = (_some(F.regexp_extract(source, "([0-9]{1,5})-([0-9]{1,5})", k)) for k in (1, 2))
    count = F.when(_minus(first, last).try_cast("int") > 0, _minus(first, last))
    codes = F.transform(F.filter(dc["subject"], lambda s: (s["_type"] == "dcterms:LCSH") & ((F.octet_length(s["_VALUE"]) <= 1) | s["_VALUE"].contains("-"))), lambda s: s["_VALUE"])
    found = F.filter(F.transform(codes, lambda c: S.first_match(c, classes or [], UNASSIGNED)), lambda c: c != UNASSIGNED)
    date = F.coalesce(F.to_date(F.try_to_timestamp(F.substring(dc["date"], 1, 10), F.lit("yyyy-MM-dd"))), X.year_start(X.find_year(F.regexp_extract(dc["date"], r"^\d{4}$", 0))))
    return intermediate(
        df, id=F.concat(F.lit("ai-28-"), ident), record_id=ident, source_id=F.lit("28"), format=F.lit("ElectronicArticle"), genre=F.lit("article"), ref_type=F.lit("EJOUR"), title=dc["title"], journal=F.trim(_first(F.split(source, ","))),
        collections=F.array(F.lit("DOAJ Directory of Open Access Journals")), authors=names(dc["creator"]), issn=F.filter(serial, lambda x: x.rlike("^[0-9]{4}-[0-9xX]{4}$")), volume=part("vol"), issue=part("iss"), start_page=first, end_page=last,
        pages=_range(first, last), page_count=count, languages=F.array_distinct(F.transform(dc["language"], lambda v: F.coalesce(X.language_code(v), F.lit("und")))), subjects=F.array_sort(F.array_distinct(found)), doi=_first(dois), date=date,
        urls=F.when(F.size(dois) > 0, F.transform(dois, lambda x: F.concat(F.lit("https://doi.org/"), x))).otherwise(F.filter(dc["identifier"], lambda x: x.startswith(home))), skip_reason=F.when(date.isNull(), "NO_DATE").when(_blank(ident), "NO_ID"),
    )


# --- press


@crosswalk("press")
def press(df: DataFrame) -> DataFrame:
    """Press documents. The year counts before the date; `n.n.` is nothing; packages come from modules, database and file."""
    none = lambda x: F.lower(F.trim(F.coalesce(x, F.lit("")))).isin("n.n.", "")
    plain = lambda x: F.trim(F.regexp_replace(x, '["\\n\\t]', ""))
    year, raw = plain(F.col("Year")), F.substring(plain(F.col("Date")), 1, 8)
    has_year = F.coalesce(year.rlike("[12][0-9]{3}"), F.lit(False))
    date = F.when(has_year, F.when(year.rlike(r"^\d{4}$"), X.year_start(year.try_cast("int")))).otherwise(F.when(raw.rlike(r"^\d{8}$"), F.to_date(F.try_to_timestamp(raw, F.lit("yyyyMMdd")))))

    def parts(s: Column) -> Column:
        return F.when(F.octet_length(s) > 60, F.split(s, "[;/,]+")).otherwise(F.split(s, "[;/]+"))

    people = F.transform(F.flatten(F.transform(F.col("Authors")["Author"], parts)), lambda x: F.trim(x))
    clue = "|".join("\\Q" + c + "\\E" for c in PRESS_CLUES)
    people = F.filter(people, lambda x: ~none(x) & (F.octet_length(x) >= 4) & (F.octet_length(x) < 200) & ~x.rlike(clue))
    words = F.col("Descriptors")["Descriptor"]
    filled = lambda pattern: F.filter(F.split(words, pattern), lambda x: x != "")
    headings = F.transform(F.when(F.size(filled("[;/]")) == 1, filled(",")).otherwise(filled("[;/]")), lambda x: F.trim(x))
    modules = _strings(F.col("Modules")["Module"])
    packages = F.filter(F.concat(modules, F.array("_DB", "X-Package")), lambda x: x.isNotNull())
    known = F.create_map(*[F.lit(v) for kv in PRESS_PACKAGES.items() for v in kv])
    coded = F.array_compact(F.transform(F.array_distinct(packages), lambda p: F.element_at(known, p)))
    where = F.concat(F.trim("Source"), F.lit("__"), F.trim("_ID"))
    ident, title = S.record_id(F.lit("48"), where), F.trim("Title")
    tongues = F.array_distinct(F.array_compact(F.array(*[X.detect_language(F.col(c), ["deu", "eng"]) for c in ("Title", "Text")])))
    return intermediate(
        df, id=ident, record_id=F.col("_ID"), source_id=F.lit("48"), format=F.lit("ElectronicArticle"), genre=F.lit("article"), ref_type=F.lit("EJOUR"), title=title, journal=F.replace(F.trim("Publication-Title"), F.lit("\n"), F.lit(" ")),
        collections=F.array(F.when(F.size(modules) > 0, F.get(modules, F.lit(0))).otherwise("Genios")), authors=names(people), issn=F.array_distinct(S.serials_in(F.col("ISSN"), strict=True)), volume=F.when(~none(F.col("Volume")), F.trim("Volume")),
        issue=F.when(~none(F.col("Issue")), F.trim("Issue")), languages=tongues, subjects=headings, urls=F.array(F.coalesce(_some(F.trim("Persistent_Link")), F.concat(F.lit("https://www.wiso-net.de/document/"), where))), date=date,
        abstract=F.when(~none(F.col("Abstract")), S.truncate_dots(F.trim("Abstract"), 150)), packages=F.concat(packages, coded), open_access=F.coalesce(F.col("available").startswith("Open Access"), F.lit(False)),
        skip_reason=F.when(date.isNull(), "NO_DATE").when(F.octet_length(title) > 2048, "TOO_LONG_TITLE").when(_long(ident), "ID_TOO_LONG"),
    )


# --- XML articles


def _article_date(dates: Column) -> Column:
    """Of the printed publication (the last of its kind) if there are several dates, else the first."""
    printed = F.filter(dates, lambda d: d["_pub-type"] == "ppub")
    d = F.when((F.size(dates) > 1) & (F.size(printed) > 0), F.element_at(F.when(F.size(printed) > 0, printed), -1)).otherwise(F.get(dates, F.lit(0)))
    text = F.when(_blank(d["day"]), F.when(_blank(d["month"]), d["year"]).otherwise(F.concat_ws("-", d["year"], d["month"]))).otherwise(F.concat_ws("-", d["year"], d["month"], d["day"]))
    text = F.regexp_replace(text, r"^(\d{4})(-x{1,2}){1,2}$", "$1")
    return F.when(~text.rlike(r"^\d{6}$|^\d{8}$"), F.to_date(S.parse_date(text)))


def _articles(df: DataFrame, accepted: tuple[str, ...] = ("deu", "eng", "fra", "ita", "spa")) -> dict[str, Column]:
    j, a = F.col("front")["journal-meta"], F.col("front")["article-meta"]
    head, tail = a["title-group"]["article-title"], a["title-group"]["subtitle"]
    product = _first(F.filter(F.transform(a["product"], lambda p: p["source"]), lambda p: ~_blank(p)))
    title = F.when(~_blank(head), F.when(~_blank(tail), F.concat(head, F.lit(" : "), tail)).otherwise(head)).when(~_blank(tail), tail).otherwise(F.coalesce(product, F.lit("")))
    full, abstract = X.clean_html(F.col("body")), F.trim(a["abstract"])
    first, last = a["fpage"], a["lpage"]
    count = F.when(_minus(first, last).try_cast("int") > 0, _minus(first, last))
    groups = a["article-categories"]["subj-group"]
    of_kind = lambda heading: F.flatten(F.transform(F.filter(groups, lambda g: F.coalesce(g["_subj-group-type"] == "heading", F.lit(False)) == heading), lambda g: g["subject"]))
    group = j["journal-title-group"]
    tongues = F.array_distinct(F.array_compact(F.array(*[X.detect_language(x, list(accepted)) for x in (a["abstract"], F.col("body"))])))
    return {
        "genre": F.lit("article"), "ref_type": F.lit("EJOUR"), "format": F.lit("ElectronicArticle"), "title": X.clean_html(title), "journal": F.coalesce(_some(group["journal-title"]), _some(group["abbrev-journal-title"]), j["abbrev-journal-title"]),
        "authors": _people(F.transform(F.filter(a["contrib-group"]["contrib"], lambda c: c["_contrib-type"] == "author"), lambda c: c["name"]), "surname", "given-names"), "issn": F.transform(j["issn"], lambda i: i["_VALUE"]),
        "volume": a["volume"], "issue": a["issue"], "start_page": first, "end_page": last, "pages": _range(first, last), "page_count": count, "publishers": F.array(j["publisher"]["publisher-name"]), "subjects": of_kind(False),
        "headings": of_kind(True), "languages": tongues, "fulltext": full, "abstract": F.when(_blank(abstract) & ~_blank(full), S.truncate_dots(full, 200)).otherwise(abstract), "date": _article_date(a["pub-date"]),
    }


def _doi_of() -> Column:
    return _first(F.filter(F.col("front")["article-meta"]["article-id"], lambda i: i["_pub-id-type"] == "doi"))["_VALUE"]


def _custom_languages() -> Column:
    meta = F.filter(F.col("front")["article-meta"]["custom-meta-group"]["custom-meta"], lambda m: m["meta-name"] == "lang")
    return F.array_distinct(F.array_compact(F.transform(meta, lambda m: X.language_code(m["meta-value"]))))


def _dashed(issn: Column) -> Column:
    """Serials given without a dash get one; those that have one are left out, as this source's records want it."""
    return F.transform(F.filter(issn, lambda i: (F.octet_length(i) == 8) & ~i.contains("-")), lambda i: F.concat(F.substring(i, 1, 4), F.lit("-"), F.substring(i, 5, 4)))


@crosswalk("articles")
def articles(df: DataFrame) -> DataFrame:
    """XML articles of no source in particular."""
    return intermediate(df, **_articles(df))


def _archived(df: DataFrame, source: str, ident: Column, doi: Column, url: Column, collections: list[str], title: Column | None, more_skips) -> DataFrame:
    a = _articles(df)
    people = F.transform(F.col("front")["article-meta"]["contrib-group"]["contrib"], lambda c: c["string-name"])
    whole = S.record_id(F.lit(source), ident)
    plain = a["title"]
    skip = F.when(_blank(ident), "NO_ID").when(_long(whole), "ID_TOO_LONG").when(a["date"].isNull(), "NO_DATE").when(plain.rlike(BLOCKED_TITLES), "BLOCKED_TITLE")
    a |= {
        "id": whole, "record_id": doi, "doi": doi, "urls": F.array(url), "source_id": F.lit(source), "collections": F.array(*map(F.lit, collections)), "languages": _custom_languages(), "issn": _dashed(a["issn"]),
        "authors": _people(people, "surname", "given-names"), "title": plain if title is None else title, "skip_reason": more_skips(skip),
    }
    return intermediate(df, **a)


@crosswalk("articles-archive")
def articles_archive(df: DataFrame) -> DataFrame:
    """Identified by their own link, of which the DOI is a part; reviews are named after what they review."""
    link = F.col("front")["article-meta"]["self-uri"]["_href"]
    product = _first(F.col("front")["article-meta"]["product"])
    reviewed = F.coalesce(_some(X.clean_html(product["source"])), X.clean_html(product["string-name"]), F.lit(""))
    kind = F.col("_article-type")
    title = F.when(kind.isin(REVIEWS), F.concat(F.lit("Review: "), reviewed)).otherwise(_articles(df)["title"])
    return _archived(df, "55", link, F.regexp_extract(link, r"10\.[0-9]+/\S+", 0), link, ["JSTOR"], title, lambda s: s.when(kind.isin(SUPPRESSED), "SUPPRESSED_TYPE"))


@crosswalk("articles-press")
def articles_press(df: DataFrame) -> DataFrame:
    """Identified by their DOI."""
    return _archived(df, "219", _doi_of(), _doi_of(), F.concat(F.lit("https://doi.org/"), _doi_of()), ["IOS-Press Zeitschriften", "sid-219-col-ios"], None, lambda s: F.when(_blank(_doi_of()), "NO_DOI").otherwise(s))


@crosswalk("articles-humanities")
def articles_humanities(df: DataFrame) -> DataFrame:
    """Identified by the link of their DOI."""
    link = F.concat(F.lit("http://dx.doi.org/"), _doi_of())
    whole = S.record_id(F.lit("50"), link)
    own = {"id": whole, "record_id": _doi_of(), "doi": _doi_of(), "urls": F.array(link), "source_id": F.lit("50"), "collections": F.array(F.lit("De Gruyter Journals / Social Sciences and Humanities"), F.lit("sid-50-col-degruyterssh"))}
    return intermediate(df, **(_articles(df) | own), skip_reason=F.when(_blank(_doi_of()), "NO_DOI").when(_long(whole), "ID_TOO_LONG"))


@crosswalk("publisher-records")
def publisher_records(df: DataFrame, publishers: dict[str, str] | None = None) -> DataFrame:
    """Articles wrapped in harvested records. publishers: names to write in one way."""
    a = _first(F.col("metadata")["article"])
    j, m = a["front"]["journal-meta"], a["front"]["article-meta"]
    d = m["pub-date"]
    month, day = (F.when(x == "0", "01").otherwise(_some(x)) for x in (d["month"], d["day"]))
    date = F.when(~_blank(d["year"]), _day(F.concat_ws("-", F.lpad(d["year"], 4, "0"), F.lpad(F.coalesce(month, F.lit("01")), 2, "0"), F.lpad(F.when(month.isNotNull(), F.coalesce(day, F.lit("01"))).otherwise("01"), 2, "0"))))
    raw = F.replace(j["publisher"]["publisher-name"], F.lit("\n"), F.lit(" "))
    publisher = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in (publishers or {"": ""}).items() for v in kv]), raw), raw)
    kinds = F.transform(j["issn"], lambda i: i["_pub-type"])
    doi = F.when(m["article-id"]["_pub-id-type"] == "doi", m["article-id"]["_VALUE"])
    subject = F.trim(m["article-categories"]["subj-group"]["subject"])
    of = lambda kind: F.transform(F.filter(j["issn"], lambda i: i["_pub-type"] == kind), lambda i: i["_VALUE"])
    skip = F.when(a.isNull(), "NO_ARTICLE").when(date.isNull(), "NO_DATE").when(_blank(publisher), "NO_PUBLISHER").when(F.exists(kinds, lambda k: ~F.coalesce(k.isin("print", "e-issn"), F.lit(False))), "BAD_SERIAL_KIND").when(doi.isNull(), "NO_DOI")
    return intermediate(
        df, id=S.record_id(F.lit("60"), doi), record_id=doi, source_id=F.lit("60"), format=F.lit("ElectronicArticle"), genre=F.lit("article"), ref_type=F.lit("EJOUR"), title=m["title-group"]["article-title"], journal=j["journal-title-group"]["journal-title"],
        collections=F.array(F.lit("Thieme Journals"), F.lit("sid-60-col-thiemejournals")), authors=_people(F.transform(m["contrib-group"]["contrib"], lambda c: c["name"]), "surname", "given-names"), issn=of("print"), eissn=of("e-issn"),
        volume=m["volume"], issue=m["issue"], start_page=m["fpage"], end_page=m["lpage"], publishers=F.array(publisher), subjects=F.when(~_blank(subject), F.array(subject)), abstract=X.clean_html(m["abstract"]), doi=doi, date=date,
        languages=F.when(~_blank(a["_lang"]), F.array(F.coalesce(X.language_code(a["_lang"]), F.lit("und")))), skip_reason=skip,
    )


@crosswalk("publications")
def publications(df: DataFrame) -> DataFrame:
    """Articles of an engineering library; those whose title begins with a bracket are extras."""
    a, p = F.col("volume")["article"], F.col("publicationinfo")
    i = a["articleinfo"]
    d = F.coalesce(_first(F.filter(i["date"], lambda x: x["_datetype"] == "OriginalPub")), _first(i["date"]))
    date = X.clamped_date(d["year"], F.coalesce(d["month"], F.lit("")), F.coalesce(d["day"], F.lit("")))
    of = lambda kind: F.transform(F.filter(p["issn"], lambda x: F.lower(x["_mediatype"]) == kind), lambda x: x["_VALUE"])
    ident, doi = _some(i["amsid"]), _some(i["articledoi"])
    first, last = i["artpagenums"]["_startpage"], i["artpagenums"]["_endpage"]
    short = F.octet_length(F.coalesce(i["abstract"], F.lit(""))) < 100
    terms = F.transform(i["keywordset"]["keyword"], lambda k: F.trim(k["keywordterm"]))
    return intermediate(
        df, id=S.record_id(F.lit("89"), ident), record_id=ident, source_id=F.lit("89"), format=F.lit("ElectronicArticle"), genre=F.lit("article"), ref_type=F.lit("EJOUR"), title=a["title"], journal=F.col("title"),
        collections=F.array(F.lit("IEEE Xplore Library"), F.lit("sid-89-col-ieee")), authors=_people(i["authorgroup"]["author"], "surname", "firstname"), issn=of("paper"), eissn=of("online"), isbn=F.transform(p["isbn"], lambda x: x["_VALUE"]),
        volume=F.col("volume")["volumeinfo"]["volumenum"], issue=i["issuenum"], start_page=first, end_page=last, pages=_range(first, last), page_count=_minus(first, last, 1), publishers=F.array(F.lit("IEEE")),
        subjects=F.filter(terms, lambda t: t != ""), abstract=i["abstract"], doi=doi, date=date, packages=F.concat(F.array(p["publicationtype"], p["publicationsubtype"]), _strings(p["packagememberset"]["packagemember"])),
        urls=F.array_compact(F.array(F.concat(F.lit("http://ieeexplore.ieee.org/stamp/stamp.jsp?arnumber="), ident), F.concat(F.lit("http://doi.org/"), doi))), open_access=i["articlelicense"] == "CCBY",
        languages=F.when(short, F.array(F.lit("eng"))).otherwise(F.array_compact(F.array(X.detect_language(i["abstract"])))), skip_reason=F.when(a["title"].startswith("["), "EXTRA").when(date.isNull(), "NO_DATE").when(ident.isNull(), "NO_ID"),
    )


@crosswalk("bilingual")
def bilingual(df: DataFrame) -> DataFrame:
    """Articles with titles in two languages: the English one follows in brackets where it differs."""

    def both(own: str, english: str) -> Column:
        x, y = F.trim(own), F.trim(english)
        return F.when(_blank(y) | (F.lower(x) == F.lower(y)), x).otherwise(F.concat(x, F.lit(" ["), y, F.lit("]")))

    year = _day(F.concat("PublicationYear", F.lit("-01-01")))
    people = F.filter(F.transform(F.col("Authors")["Author"], lambda a: F.trim(a)), lambda a: (F.octet_length(a) >= 4) & ~a.rlike("^(" + "|".join(f"\\Q{n}\\E" for n in NO_AUTHORS) + ")"))
    second = F.when(~_blank(F.col("PublisherEnglish")) & (F.col("PublisherEnglish") != F.coalesce("Publisher", F.lit(""))), F.col("PublisherEnglish"))
    return intermediate(
        df, id=F.concat(F.lit("ai-53-"), "UniqueID"), record_id=F.col("UniqueID"), source_id=F.lit("53"), format=F.lit("ElectronicArticle"), genre=F.lit("article"), ref_type=F.lit("EJOUR"), title=both("ArticleTitle", "ArticleTitleEnglish"),
        journal=both("PublicationTitle", "PublicationTitleEnglish"), collections=F.array(F.lit("CEEOL Central and Eastern European Online Library"), F.lit("sid-53-col-ceeol")), authors=names(people), issn=F.array("ISSN"), eissn=F.array("eISSN"),
        volume=S.roman(F.col("Volume")), issue=F.col("Issue"), start_page=F.col("StartPage"), end_page=F.col("EndPage"), page_count=F.col("PageCount"), publishers=F.array_compact(F.array(F.col("Publisher"), second)),
        languages=F.array_compact(F.transform(F.col("Languages")["Language"], lambda v: X.language_code(v))), subjects=F.col("SubjectTerms")["SubjectTerm"], urls=F.array("ArticleURL"), date=year, abstract=F.col("Description"),
        open_access=F.coalesce(F.col("IsOpenAccess") != "0", F.lit(True)), skip_reason=F.when(year.isNull(), "NO_DATE"),
    )


# --- library records


def _field(fields: Column, spec: str) -> Column:
    return _strings(S.subfields(fields, *spec.split(".")))


@crosswalk("marc-books")
def marc_books(df: DataFrame) -> DataFrame:
    """Library records of books and articles; the id hides in the link, volume and issue in a note."""
    f = F.col("datafield")
    one = lambda spec: F.coalesce(_first(_field(f, spec)), F.lit(""))
    ident = _first(F.filter(F.transform(_field(f, "856.u"), lambda u: F.regexp_extract(u, r"id=([0-9]+)", 1)), lambda u: u != ""))
    tail = F.trim(one("245.b"))
    title = F.when(tail == "", F.trim(one("245.a"))).otherwise(F.concat(F.trim(one("245.a")), F.lit(": "), tail))
    book = (F.size(_field(f, "022.a")) == 0) & (F.size(_field(f, "020.a")) > 0)
    date = _day(F.concat(one("260.c"), F.lit("-01-01")))
    numbered = r"(?i)Vol\. ([^,]+), no\. ([^ ]+) \(([0-9]{4})\)"
    part = lambda k: _some(S.roman(F.regexp_extract(one("362.a"), numbered, k)))
    tongues = F.flatten(F.transform(_field(f, "041.a"), lambda v: F.when(F.length(v) == 3, F.array(v)).otherwise(F.transform(F.split(v, "/"), lambda p: F.when(F.length(p) == 3, p).otherwise(X.language_code(p))))))
    return intermediate(
        df, id=F.concat(F.lit("ai-53-"), ident), record_id=ident, source_id=F.lit("53"), format=F.when(book, "Book").otherwise("ElectronicArticle"), genre=F.when(book, "book").otherwise("article"), ref_type=F.when(book, "EBOOK").otherwise("EJOUR"),
        title=F.when(~book, title), book_title=F.when(book, title), collections=F.array(F.lit("CEEOL Central and Eastern European Online Library"), F.lit("sid-53-col-ceeol")), authors=names(F.concat(_field(f, "100.a"), _field(f, "700.a"))),
        issn=_field(f, "022.a"), isbn=_field(f, "020.a"), volume=part(1), issue=part(2), publishers=_field(f, "260.b"), languages=F.array_compact(tongues), subjects=_field(f, "650.a"), urls=_field(f, "856.u"), date=date,
        places=F.transform(_field(f, "260.a"), lambda p: F.trim(F.replace(p, F.lit("[1] :"), F.lit("")))), abstract=F.array_join(_field(f, "520.a"), "\n"), skip_reason=F.when(ident.isNull(), "NO_ID").when(date.isNull(), "NO_DATE"),
    )


@crosswalk("marc-archive")
def marc_archive(df: DataFrame, today: Column | None = None) -> DataFrame:
    """Harvested library records of an open archive; those under an embargo today are skipped."""
    r = F.col("metadata")["record"]
    f, parts = r["datafield"], F.split(F.col("header")["identifier"], "/")
    one = lambda spec: F.coalesce(_first(_field(f, spec)), F.lit(""))
    ident = F.when(F.size(parts) == 2, F.trim(F.get(parts, F.lit(1))))
    notes = _field(f, "500.a")
    until = F.array_max(F.transform(notes, lambda n: X.embargo_until(n)))
    leader = F.coalesce(r["leader"], F.lit(""))
    book = (F.substring(leader, 8, 1) == "m") | F.substring(leader, 20, 1).isin(" ", "b")
    title = F.concat(one("245.a"), F.when(F.trim(one("245.b")) != "", F.concat(F.lit(": "), F.trim(one("245.b")))).otherwise(""))
    given, noted = F.trim(one("264.c")), _first(F.filter(F.transform(notes, lambda n: F.regexp_extract(n, r"[12][6789012]\d\d", 0)), lambda n: n != ""))
    raw = F.when(given == "o.J.", "2010-01-01").when(F.length(given) == 4, F.concat(given, F.lit("-01-01"))).otherwise(F.concat(F.coalesce(noted, F.lit("1970")), F.lit("-01-01")))
    date = _day(raw)
    # pages: one or two numbers of the extent, else the first note's range
    numbers = F.regexp_extract_all(one("300.a"), F.lit("([1-9][0-9]*)"), F.lit(1))
    span = r"([1-9][0-9]{0,3})-([1-9][0-9]{0,3})"
    first = F.when(F.size(numbers).between(1, 2), F.get(numbers, F.lit(0))).otherwise(_some(F.regexp_extract(_first(notes), span, 1)))
    last = F.when(F.size(numbers) == 1, F.get(numbers, F.lit(0))).when(F.size(numbers) == 2, F.get(numbers, F.lit(1))).otherwise(_some(F.regexp_extract(_first(notes), span, 2)))
    count = F.when(F.size(numbers) == 1, "1").otherwise(_minus(first, last))
    # the parent's title stands in a note that begins with "In:"
    note = _first(F.filter(notes, lambda n: n.startswith("In:")))
    bare, cells = F.substr(note, F.lit(5)), F.split(note, ";")
    colons, upto = F.split(bare, ":"), lambda x: _first(F.split(x, r"\."))
    alone = (
        F.when(F.size(colons) == 1, upto(bare)).when(F.size(colons) == 2, upto(F.get(colons, F.lit(1)))).when(F.size(colons) == 3, F.concat(F.get(colons, F.lit(1)), F.lit(": "), upto(F.get(colons, F.lit(2))))).otherwise(note)
    )
    journal = F.when(F.size(cells) == 1, alone).when(F.size(cells).between(2, 4), F.trim(F.substr(_first(cells), F.lit(5))))
    held = F.coalesce(until > (today if today is not None else F.current_date()), F.lit(False))
    return intermediate(
        df, id=F.concat(F.lit("ai-30-"), ident), record_id=ident, source_id=F.lit("30"), format=F.when(book, "eBook").otherwise("ElectronicArticle"), genre=F.when(book, "book").otherwise("article"), ref_type=F.when(book, "EBOOK").otherwise("EJOUR"),
        title=F.when(~book, title), book_title=F.when(book, title), journal=journal, collections=F.array(F.lit("SSOAR Social Science Open Access Repository")), authors=names(F.concat(_field(f, "100.a"), _field(f, "700.a"))),
        isbn=_field(f, "020.a"), start_page=first, end_page=last, page_count=count, publishers=F.when(one("264.b") != "", F.array(one("264.b"))), places=F.filter(_field(f, "264.a"), lambda p: p != ""), languages=_field(f, "041.a"),
        subjects=_field(f, "650.a"), series=_some(one("490.a")), urls=_field(f, "856.u"), abstract=one("520.a"), date=date, skip_reason=F.when(ident.isNull(), "NO_ID").when(held, "EMBARGO").when(date.isNull(), "NO_DATE"),
    )


@crosswalk("bibliography")
def bibliography(df: DataFrame) -> DataFrame:
    """Entries of a computer science bibliography: the link tells which title is given."""
    date = F.when(F.col("year").rlike(r"^\d{4}$"), X.year_start(F.col("year").try_cast("int")))
    url, home = F.col("url"), F.lit("https://dblp.org/")
    article = url.rlike("^(http|db/journals|db/conf)")
    links = F.when(url.startswith("http"), F.array(url)).when(url.rlike("^db/(journals|conf|books)"), F.array(F.concat(home, url))).otherwise(F.array().cast("array<string>"))
    return intermediate(
        df, id=S.record_id(F.lit("210"), F.col("_key")), record_id=F.col("_key"), source_id=F.lit("210"), genre=F.lit("article"), ref_type=F.lit("EJOUR"), title=F.when(article, F.col("title")), book_title=F.when(url.startswith("db/books"), F.col("title")),
        collections=F.array(F.lit("DBLP"), F.lit("sid-210-coll-dblp")), authors=names(F.col("author")), volume=F.col("volume"), issue=F.col("number"), publishers=F.when(~_blank(F.col("publisher")), F.array("publisher")),
        languages=F.array(F.lit("eng")), urls=F.concat(F.coalesce(links, F.array().cast("array<string>")), F.filter(_strings(F.col("ee")), lambda x: x.startswith("http"))), date=date, skip_reason=F.when(date.isNull(), "NO_DATE"),
    )


# --- Dublin Core, DIM and METS


@crosswalk("dc-gender")
def dc_gender(df: DataFrame) -> DataFrame:
    """Open articles and chapters: a chapter's book stands behind the colon of its source."""
    dc, ident = F.col("metadata")["dc"], F.col("header")["identifier"]
    source = F.replace(F.coalesce(dc["source"], F.lit("")), F.lit("\n"), F.lit(" "))
    serials = F.transform(F.filter(dc["identifier"], lambda x: x.startswith("urn:ISSN:")), lambda x: F.substr(x, F.lit(10)))
    dois = F.transform(F.filter(dc["identifier"], lambda x: x.startswith("http://dx.doi.org/")), lambda x: F.replace(x, F.lit("http://dx.doi.org/"), F.lit("")))
    in_journal = F.lower(dc["title"]).isin("zeitschrift", "journal") | (F.coalesce(F.size(serials), F.lit(0)) > 0)
    inner = F.regexp_extract(source, r"([^:]*):([^\(]*)", 2)
    first, last = (_some(F.regexp_extract(dc["source"], "([1-9][0-9]*)-([1-9][0-9]*)", k)) for k in (1, 2))
    date = F.when(F.octet_length(dc["date"]) >= 4, X.year_start(F.substring(dc["date"], 1, 4).try_cast("int")))
    raw = F.coalesce(dc["date"], F.lit(""))
    return intermediate(
        df, id=S.record_id(F.lit("162"), ident), record_id=F.substr(S.record_id(F.lit("162"), ident), F.lit(8)), source_id=F.lit("162"), format=F.lit("ElectronicArticle"), genre=F.lit("article"), ref_type=F.lit("EJOUR"), title=dc["title"],
        journal=F.when(in_journal, dc["source"]), book_title=F.when(~F.coalesce(in_journal, F.lit(False)), F.when(source.contains(":"), F.trim(inner)).otherwise(source)), collections=F.array(F.lit("Gender Open")), authors=names(dc["creator"]),
        issn=serials, doi=F.element_at(F.when(F.size(dois) > 0, dois), -1), urls=F.filter(dc["identifier"], lambda x: x.startswith("http")), publishers=dc["publisher"], subjects=dc["subject"], start_page=first, end_page=last,
        page_count=_minus(first, last), languages=F.array(F.coalesce(_some(dc["language"]), F.lit("und"))), open_access=F.lit(True), date=date,
        skip_reason=F.when(raw == "", "EMPTY_DATE").when(F.octet_length(raw) < 4, "SHORT_DATE").when(date.isNull(), "BAD_DATE"),
    )


@crosswalk("dc-manuscripts")
def dc_manuscripts(df: DataFrame, formats: dict[str, str] | None = None, genres: dict[str, str] | None = None, ref_types: dict[str, str] | None = None) -> DataFrame:
    """Digitised manuscripts and prints. formats: by what a record is part of; genres, ref_types: by its type."""
    dc, ident = F.col("metadata")["dc"], F.col("header")["identifier"]
    date = X.year_start(X.find_year(dc["date"], "[012][0-9]{3}"))
    people = F.transform(F.filter(F.transform(F.split(dc["creator"], ";"), lambda c: F.trim(c)), lambda c: c != ""), lambda c: S.remove_all(c, ROLES))
    filled = lambda xs: F.filter(F.transform(_strings(xs), lambda x: F.trim(x)), lambda x: x != "")
    home = "http://digi.ub.uni-heidelberg.de/diglit"
    own = lambda x: F.array_compact(F.array(F.when(x.startswith("http"), x), F.when(x.startswith("urn:nbn:"), F.concat(F.lit("http://nbn-resolving.de/"), x)), F.when(x.startswith(home), F.concat(F.lit("https://digi.ub.uni-heidelberg.de/diglit/iiif/"), F.element_at(F.split(x, "/"), -1), F.lit("/manifest.json")))))
    known = lambda x, table, default: S.lookup(x, table or {"": default}, default)
    return intermediate(
        df, id=S.record_id(F.lit("107"), ident), record_id=ident, source_id=F.lit("107"), format=F.when(F.coalesce(F.size(dc["ispartof"]), F.lit(0)) > 0, known(_first(dc["ispartof"]), formats, "Manuscript")),
        genre=known(dc["type"], genres, "unknown"), ref_type=known(dc["type"], ref_types, "GEN"), title=dc["title"], collections=F.array(F.lit("sid-107-col-heidelberg")), authors=names(people),
        subjects=F.array_distinct(F.concat(F.filter(filled(dc["subject"]), lambda s: ~s.contains(";")), filled(dc["temporal"]))), abstract=dc["alternative"], urls=F.flatten(F.transform(dc["identifier"], own)), publishers=dc["spatial"],
        languages=F.array_compact(F.transform(dc["language"], lambda v: X.language_code(v))), open_access=F.lit(True), date=date, skip_reason=F.when(date.isNull(), "NO_DATE"),
    )


@crosswalk("dim")
def dim(df: DataFrame) -> DataFrame:
    """Records of qualified fields."""
    f, ident = F.col("metadata")["dim"]["field"], F.col("header")["identifier"]
    every = lambda schema, element, qualifier=None: _strings(S.qualified(f, schema, element, qualifier))
    one = lambda *q: F.coalesce(_first(every(*q)), F.lit(""))
    issued = one("dc", "date", "issued")
    date = F.when(issued.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"), F.to_date(S.parse_date(issued)))
    first, last = one("local", "source", "spage"), one("local", "source", "epage")
    count = F.when(_minus(first, last).try_cast("int") >= 0, _minus(first, last))
    return intermediate(
        df, id=S.record_id(F.lit("170"), ident), record_id=ident, source_id=F.lit("170"), genre=F.lit("article"), ref_type=F.lit("EJOUR"), title=one("dc", "title"), collections=F.array(F.lit("sid-170-col-mediarep")),
        authors=names(F.concat(every("dc", "creator"), every("dc", "contributor"))), subjects=every("dc", "subject"), publishers=every("dc", "publisher"), languages=every("dc", "language"), isbn=every("dc", "identifier", "isbn"),
        issn=every("dc", "identifier", "issn"), urls=every("dc", "identifier", "uri"), issue=one("local", "source", "issue"), volume=one("local", "source", "volume"), start_page=first, end_page=last, page_count=count, date=date,
        skip_reason=F.when(date.isNull(), "NO_DATE"),
    )


@crosswalk("mets-archive")
def mets_archive(df: DataFrame) -> DataFrame:
    """Only identifiers and languages are given."""
    ident = F.col("header")["identifier"]
    parts = F.split(ident, ":")
    spoken = F.filter(F.transform(F.col("metadata")["mets"]["dmdSec"], lambda s: s["mdWrap"]["xmlData"]["mods"]["language"]["languageTerm"]), lambda x: ~_blank(x))
    return intermediate(
        df, id=F.concat(F.lit("ai-12502-"), F.get(parts, F.lit(1))), record_id=ident, source_id=F.lit("12502"), genre=F.lit("article"), ref_type=F.lit("EJOUR"), collections=F.array(F.lit("Olms")),
        languages=F.when(F.coalesce(F.size(spoken), F.lit(0)) > 0, spoken).otherwise(F.array(F.lit("und"))), skip_reason=F.when(F.size(parts) != 2, "BAD_ID"),
    )


@crosswalk("dc-prints")
def dc_prints(df: DataFrame) -> DataFrame:
    """Digitised prints, identified by their URN; they have no dates."""
    dc = F.col("metadata")["dc"]
    urn = F.replace(F.col("header")["identifier"], F.lit("oai:www.zvdd.de:"), F.lit(""))
    spoken = F.array_compact(F.transform(dc["language"], lambda v: X.language_code(v)))
    return intermediate(
        df, id=S.record_id(F.lit("93"), urn), record_id=urn, source_id=F.lit("93"), format=F.lit("ElectronicArticle"), genre=F.lit("article"), ref_type=F.lit("EJOUR"), title=_first(dc["title"]), collections=F.array(F.lit("ZVDD")),
        authors=names(F.transform(dc["creator"], lambda x: F.rtrim(F.trim(x), F.lit(",")))), abstract=F.array_join(_strings(dc["source"]), "\n"), publishers=dc["publisher"], subjects=dc["subject"],
        urls=F.array(F.concat(F.lit("http://nbn-resolving.de/"), urn)), languages=F.when(F.coalesce(F.size(spoken), F.lit(0)) > 0, spoken).otherwise(F.array(F.lit("und"))),
    )


def _printed_date(v: Column) -> Column:
    """Whole days in two orders, months, and years that stand alone or in a text."""
    return F.coalesce(
        F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}$"), _day(v)), F.when(v.rlike(r"^\d{2}\.\d{2}\.\d{4}$"), F.to_date(F.try_to_timestamp(v, F.lit("dd.MM.yyyy")))), F.when(v.rlike(r"^\d{1,2}\.\d{4}$"), F.to_date(F.try_to_timestamp(v, F.lit("M.yyyy")))),
        F.when(v.rlike(r"^(\[?\d{4}\]?|\d{4}\.|um \d{4})$"), X.year_start(F.regexp_extract(v, r"\d{4}", 0).try_cast("int"))), X.year_start(X.find_year(v)),
    )


@crosswalk("mets-prints")
def mets_prints(df: DataFrame) -> DataFrame:
    """Digitised prints; the earliest of their dates counts."""
    m, ident = F.col("metadata")["mets"]["dmdSec"]["mdWrap"]["xmlData"]["mods"], F.col("header")["identifier"]
    of = lambda kind: _first(F.filter(m["identifier"], lambda i: F.lower(i["_type"]) == kind))["_VALUE"]
    dates = F.array_sort(F.flatten(F.transform(m["originInfo"], lambda o: _strings(o["dateIssued"]))))
    date = _printed_date(_first(dates))
    title = m["titleInfo"]["title"]
    spoken = F.transform(m["language"], lambda v: F.when(F.length(v["languageTerm"]) == 3, v["languageTerm"]).otherwise(F.coalesce(X.detect_language(title), F.lit("eng"))))
    return intermediate(
        df, id=S.record_id(F.lit("93"), ident), record_id=ident, source_id=F.lit("93"), format=F.lit("ElectronicArticle"), genre=F.lit("document"), ref_type=F.lit("EJOUR"), title=title, subtitle=m["titleInfo"]["subTitle"],
        collections=F.array(F.lit("ZVDD")), doi=of("doi"), urls=F.array_compact(F.array(F.concat(F.lit("http://nbn-resolving.de/"), of("urn")))), publishers=F.flatten(F.transform(m["originInfo"], lambda o: _strings(o["publisher"]))),
        languages=spoken, date=date, skip_reason=F.when((F.coalesce(F.size(dates), F.lit(0)) > 0) & date.isNull(), "BAD_DATE"),
    )


@crosswalk("scores")
def scores(df: DataFrame) -> DataFrame:
    """Music scores: one whole XML text in each row (`value`), read by XPath."""
    texts = lambda path: F.xpath(F.col("value"), F.lit(path))
    ident = F.element_at(F.when(F.size(texts("//var/recordId/text()")) > 0, texts("//var/recordId/text()")), -1)
    title = texts("//var[@name='Work Title']/string/text()")
    return intermediate(
        df, id=S.record_id(F.lit("15"), ident), record_id=ident, source_id=F.lit("15"), genre=F.lit("document"), ref_type=F.lit("MUSIC"), title=F.element_at(F.when(F.size(title) > 0, title), -1), collections=F.array(F.lit("IMSLP")),
        urls=texts("//var[@name='permlink']/string/text()"), authors=names(texts("//var[@name='composer']/string/text()")), languages=F.array(F.lit("und")), skip_reason=F.when(ident.isNull(), "NO_ID"),
    )


# --- shipments


@crosswalk("shipment")
def shipment(datasets: DataFrame, issues: DataFrame, articles_: DataFrame) -> DataFrame:
    """Items of the issues that a shipment's dataset lists, with the article each refers to. All three carry `shipment`;
    references are resolved by two joins within it, and what refers to a missing issue or article is left out."""
    ji = datasets.select("shipment", F.explode(F.col("dataset-content")["journal-issue"]).alias("ji")).select("shipment", F.col("ji")["journal-issue-unique-ids"]["pii"].alias("issue_pii"), F.col("ji")["journal-issue-properties"]["collection-title"].alias("journal_title"))
    i = issues.select("shipment", F.col("issue-info").alias("info"), F.explode(F.flatten(F.transform(F.col("issue-body")["issue-sec"], lambda s: s["include-item"]))).alias("item")).withColumn("issue_pii", F.col("info")["pii"]).withColumn("pii", F.col("item")["pii"])
    a = articles_.withColumn("pii", F.col("item-info")["pii"])
    df = ji.join(i, ["shipment", "issue_pii"]).join(a, ["shipment", "pii"])
    doi, received = F.col("item-info")["doi"], F.col("head")["date-received"]
    bare = lambda x: _some(F.ltrim(x, F.lit("0")))
    year = F.coalesce(bare(received["_year"]), _some(F.col("item-info")["copyright"]["_year"]))
    date = F.to_date(F.try_to_timestamp(F.concat_ws("-", year, F.coalesce(bare(received["_month"]), F.lit("1")), F.coalesce(bare(received["_day"]), F.lit("1"))), F.lit("yyyy-M-d")))
    people = F.col("head")["author-group"]["author"]
    people = F.when(F.coalesce(F.size(people), F.lit(0)) > 0, people).otherwise(F.col("simple-head")["author-group"]["author"])
    people = F.transform(people, lambda x: F.struct(F.concat_ws(" ", x["given-name"], x["surname"]).alias("name"), x["surname"].alias("last"), x["given-name"].alias("first")))
    pages, numbers = F.col("item")["pages"], F.col("info")["volume-issue-number"]
    return intermediate(
        df, id=S.record_id(F.lit("85"), doi), record_id=doi, source_id=F.lit("85"), format=F.lit("ElectronicArticle"), genre=F.lit("article"), ref_type=F.lit("EJOUR"), title=F.coalesce(_some(F.col("head")["title"]), F.col("simple-head")["title"]),
        journal=F.col("journal_title"), collections=F.array(F.lit("Elsevier Journals")), authors=people, issn=F.array(F.col("info")["issn"]), volume=numbers["vol-first"], issue=numbers["iss-first"], start_page=pages["first-page"],
        end_page=pages["last-page"], pages=_minus(pages["first-page"], pages["last-page"]), languages=F.array(F.lit("eng")), urls=F.array(F.concat(F.lit("http://doi.org/"), doi)), doi=doi, date=date,
        abstract=F.array_join(F.transform(F.col("head")["abstract"], lambda x: X.clean_html(x)), ""), skip_reason=F.when(date.isNull() | year.isNull(), "NO_DATE"),
    )
