"""Exports of intermediate records: search documents, nested text; registry by name; and all steps of a source in one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scalars as S
from ..functions import text as X
from ..operators import filters
from .crosswalks import FORMATS, NOISE

EXPORTERS: dict[str, Callable[..., DataFrame]] = {}
#: Sites with formats of their own, as suffixes of the field.
SITES = ["de105", "de14", "de15", "de520", "de540", "dech1", "ded117", "degla1", "del152", "del189", "dezi4", "dezwi2", "finc", "nrw"]


def exporter(name: str):
    def add(f):
        EXPORTERS[name] = f
        return f

    return add


def _strings(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


@exporter("search")
def search_documents(records: DataFrame, languages: dict[str, str] | None = None, classes: dict[str, list[str]] | None = None, sites: dict[str, dict[str, str]] | None = None, full_record: bool = False) -> DataFrame:
    """Documents of a search index, one for each record. languages: display names by code (else the code); classes: by
    subject; sites: formats by site suffix and format (else empty). With full_record the record itself goes along as JSON.

    Collections that begin with `sid-` go to their own field; a DOI adds its link unless a URL has `doi` in it; subtitles
    count above 20 bytes; source 48 gives no serials, languages, publishers and full text. Records without a date have no
    year."""
    urls, doi = _strings("urls"), F.nullif("doi", F.lit(""))
    link = F.when(doi.isNotNull() & ~F.exists(urls, lambda u: u.contains("doi")), F.array(F.concat(F.lit("https://doi.org/"), doi)))
    nothing = F.array().cast("array<string>")
    plain = F.transform("authors", lambda a: S.author_name(a["name"], a["last"], a["first"], F.lit(None).cast("string")))
    people = F.filter(F.transform(F.coalesce(plain, nothing), lambda n: S.remove_all(n, NOISE)), lambda n: F.coalesce(n, F.lit("")) != "")
    serials, books = F.array_distinct(F.concat(_strings("issn"), _strings("eissn"))), F.array_distinct(F.concat(_strings("isbn"), _strings("eisbn")))
    title = X.clean_html(F.when(F.coalesce("title", F.lit("")) == "", F.coalesce("book_title", F.lit(""))).otherwise(F.col("title")))
    year, press = F.year("date"), F.coalesce(F.col("source_id") == "48", F.lit(False))
    imprint = S.imprint(F.array_join(_strings("places"), " ; "), F.get("publishers", F.lit(0)), year)
    known = {s: [c] if isinstance(c, str) else c for s, c in (classes or {}).items()}
    table = F.create_map(*[x for s, cs in known.items() for x in (F.lit(s), F.array(*map(F.lit, cs)))]) if known else F.lit(None).cast("map<string,array<string>>")
    found = F.array_sort(F.array_distinct(F.flatten(F.transform(_strings("subjects"), lambda s: F.coalesce(F.element_at(table, s), nothing)))))
    spoken = F.transform(_strings("languages"), lambda v: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in languages.items() for x in kv]), v), v) if languages else v)
    words = S.all_text(
        F.coalesce(plain, nothing), _strings("eisbn"), _strings("eissn"), _strings("isbn"), _strings("issn"), _strings("places"), _strings("publishers"), _strings("subjects"), urls,
        *[F.col(c) for c in ("abstract", "subtitle", "title", "book_title", "edition", "fulltext", "journal", "series", "short_title")],
    )
    unless = lambda x: F.when(~press, x).otherwise(nothing)
    fields = {
        "id": F.col("id"), "record_id": F.col("record_id"), "source_id": F.col("source_id"), "record_format": F.lit("is"), "allfields": words, "format": F.array("format"), "fulltext": F.when(press, "").otherwise(F.col("fulltext")),
        "fullrecord": F.to_json(F.struct(*records.columns)) if full_record else F.concat(F.lit("blob:"), "id"), "imprint": imprint, "imprint_str_mv": F.array(imprint), "issn": unless(serials), "issn_str_mv": serials, "isbn": books,
        "isbn_str_mv": books, "edition": F.col("edition"), "collection": F.filter(_strings("collections"), lambda c: c.startswith("sid-")), "mega_collection": F.filter(_strings("collections"), lambda c: ~c.startswith("sid-")),
        "publishDateSort": year.cast("string"), "publishDate": F.array_compact(F.array(F.lpad(year.cast("string"), 4, "0"))), "publisher": unless(_strings("publishers")), "topic": _strings("subjects"), "institution": _strings("labels"),
        "footnote": _strings("footnotes"), "series": F.filter(F.array("journal", "series"), lambda x: F.coalesce(x, F.lit("")) != ""), "title_sub": F.when(F.octet_length("subtitle") > 20, F.col("subtitle")),
        "title_sort": X.sortable_title(F.col("book_title"), F.col("title")), "url": F.concat(urls, F.coalesce(link, nothing)), "doi_str_mv": F.array_compact(F.array(doi)), "finc_class_facet": found, "title": title, "title_full": title,
        "title_short": title, "language": unless(spoken), "author": people, "author_facet": people, "author_sort": F.lower(F.get(people, F.lit(0))), "container_volume": F.col("volume"), "container_issue": F.col("issue"),
        "container_start_page": F.col("start_page"), "container_title": F.col("journal"), "description": X.clean_html(F.col("abstract")), "physical": F.array(F.coalesce("pages", F.lit(""))), "match_str": F.lit(""), "match_str_mv": nothing,
        "facet_avail": F.when(F.coalesce("open_access", F.lit(False)), F.array(F.lit("Online"), F.lit("Free"))).otherwise(F.array(F.lit("Online"))),
    }
    for site in SITES:
        fields[f"format_{site}"] = F.array(S.lookup(F.col("format"), (sites or {}).get(site) or {"": ""}, ""))
    return records.select(*[v.alias(k) for k, v in fields.items()])


@exporter("search-full")
def search_documents_full(records: DataFrame, **options) -> DataFrame:
    return search_documents(records, full_record=True, **options)


@exporter("formeta")
def formeta(records: DataFrame) -> DataFrame:
    """`value`: each record as nested text."""
    row = F.struct(*records.columns)
    return records.select(X.formeta(row, records.schema).alias("value"))


def lines(documents: DataFrame) -> DataFrame:
    """`value`: documents as JSON lines, without what is null or empty."""
    full = {}
    for name, kind in documents.dtypes:
        c = F.col(f"`{name}`")
        full[name] = F.when(F.size(c) > 0, c) if kind.startswith("array") else F.nullif(c, F.lit("")) if kind == "string" else c
    return documents.select(F.to_json(F.struct(*[v.alias(k) for k, v in full.items()])).alias("value"))


def through(df: DataFrame, source: str, config: dict[str, dict], export: str = "search", crosswalk_options: dict | None = None, prepared=None) -> DataFrame:
    """Crosswalk, skips, labels and export of a source's records at once: one pass over them, as none of the steps shuffles.
    Trees that name files want `prepared`: a function from the kept records to `filters.prepare` of them."""
    kept = FORMATS[source](df, **(crosswalk_options or {})).filter("skip_reason is null").drop("skip_reason")
    if prepared is not None:
        kept = prepared(kept)
    tagged = filters.tag(kept, config, drop_unlabelled=True)
    return EXPORTERS[export](tagged)
