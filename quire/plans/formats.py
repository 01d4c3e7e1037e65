"""Queries of the crosswalks: source records are written from table columns as XML or JSON texts, parsed by the reader's
schema, and converted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources import exports, formats  # noqa: F401  registers the crosswalks
from ..sources import crosswalks as C
from .catalogue import Tables, query

_OPTIONS = {"ignoreNamespace": "true"}


def xml(df: DataFrame, name: str, *parts) -> DataFrame:
    """Texts and columns joined to an XML text, parsed as the named records."""
    text = F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return df.select(F.from_xml(text, formats.SCHEMAS[name], _OPTIONS).alias("r")).select("r.*")


def shown(records: DataFrame, *names: str) -> DataFrame:
    """Lists as texts joined by a bar, authors as `last, first` or name, dates and flags as texts."""

    def one(name: str) -> Column:
        c, kind = F.col(name), dict(records.dtypes)[name]
        if name == "authors":
            c = F.array_join(F.transform(c, lambda a: F.coalesce(a["name"], F.concat_ws(", ", a["last"], a["first"]))), "|")
        elif kind.startswith("array"):
            c = F.array_join(c, "|")
        return c.cast("string").alias("day" if name == "date" else name)

    return records.select(*map(one, names))


def b64(x: str) -> str:
    return f"rtrim(translate(to_base64(encode({x})), '+/', '-_'), '=')"


def _part(spark, d) -> DataFrame:
    return Tables(spark, d).part


def K() -> Column:  # columns need a session, so that they are made when a query is
    return F.col("p_partkey")


def SIZE() -> Column:
    return F.col("p_size")


_DIRECTORY = """select 'ai-28-d' || p_partkey as id, p_name as title, case when p_partkey % 3 = 0 then (1990 + p_size % 10) || '-' || lpad(case when p_size % 15 between 1 and 12 then p_size % 15 else 1 end::varchar, 2, '0') || '-01'
when p_partkey % 3 = 1 then '1999-02-03' end as day, case p_partkey % 4 when 0 then '10.1000/x' || p_partkey when 1 then '10.1000/y' || p_partkey end as doi,
case when p_partkey % 4 = 0 then 'http://doi.org/10.1000/x' || p_partkey when p_partkey % 4 = 1 then 'http://doi.org/10.1000/y' || p_partkey when p_partkey % 4 = 2 then 'http://l/' || p_partkey else 'https://doaj.org/article/d' || p_partkey end as urls,
'eng|und' as languages, case when p_size % 2 = 0 then 'books|math' else 'not assigned' end as subjects, p_size || '-' || (p_size + 5) as pages, '5' as page_count, 'R&D ' || p_brand as authors, {} case when p_partkey % 3 = 2 then 'NO_DATE' end as skip_reason from part"""
_CLASSES = [("^QA", "math"), ("^Z", "books")]


def _bib() -> Column:
    kind = K() % 4
    doi = F.when(kind == 0, F.concat(F.lit(" 10.1000/x"), K())).when(kind == 1, F.concat(F.lit("https://doi.org/10.1000/y"), K()))
    return F.struct(
        F.col("p_name").alias("title"), (1990 + SIZE() % 10).cast("string").alias("year"), (SIZE() % 15).cast("string").alias("month"), SIZE().cast("string").alias("start_page"), (SIZE() + 5).cast("string").alias("end_page"),
        F.when(doi.isNotNull(), F.array(F.struct(doi.alias("id"), F.lit("doi").alias("type")))).alias("identifier"), F.array(F.struct(F.concat(F.lit("R&amp;D "), "p_brand").alias("name"))).alias("author"),
        F.when(kind == 2, F.array(F.struct(F.concat(F.lit("http://l/"), K()).alias("url")))).alias("link"), F.when(SIZE() % 2 == 0, F.array(F.struct(F.lit("Z1").alias("code")), F.struct(F.lit("QA7").alias("code")))).alias("subject"),
        F.struct(F.col("p_brand").alias("title"), F.lit(" P ").alias("publisher"), F.array(F.lit("xx"), F.lit("EN")).alias("language"), F.array(F.lit("1234-5678")).alias("issns")).alias("journal"),
    )


def _stamp() -> Column:
    return F.when(K() % 3 == 0, "").when(K() % 3 == 1, "1999-02-03T04:05:06Z").otherwise("bad")


@query(_DIRECTORY.format("'true' as open_access, 'd' || p_partkey as record_id,"))
def c02_directory(spark, d):
    raw = _part(spark, d).select(F.to_json(F.struct(F.concat(F.lit("d"), K()).alias("id"), _stamp().alias("created_date"), _bib().alias("bibjson"))).alias("v"))
    r = raw.select(F.from_json("v", formats.SCHEMAS["directory"]).alias("r")).select("r.*")
    return shown(C.FORMATS["directory"](r, _CLASSES), "id", "title", "date", "doi", "urls", "languages", "subjects", "pages", "page_count", "authors", "open_access", "record_id", "skip_reason")


@query(_DIRECTORY.format("case p_partkey % 4 when 0 then '10.1000/x' || p_partkey when 1 then '10.1000/y' || p_partkey else 'd' || p_partkey end as record_id,"))
def c03_directory_legacy(spark, d):
    codes = F.when(SIZE() % 2 == 0, F.array(F.lit("LCC:Z1"), F.lit("LCC:QA7")))
    index = F.struct(_stamp().alias("date"), F.array(F.lit("1234-5678")).alias("issn"), F.array(F.lit("xx"), F.lit("EN")).alias("language"), codes.alias("schema_code"))
    raw = _part(spark, d).select(F.to_json(F.struct(F.struct(F.concat(F.lit("d"), K()).alias("id"), _bib().alias("bibjson"), index.alias("index")).alias("_source"))).alias("v"))
    r = raw.select(F.from_json("v", formats.SCHEMAS["directory-legacy"]).alias("r")).select("r.*")
    return shown(C.FORMATS["directory-legacy"](r, _CLASSES), "id", "title", "date", "doi", "urls", "languages", "subjects", "pages", "page_count", "authors", "record_id", "skip_reason")


@query("""select 'ai-28-a' || p_partkey as id, p_name as title, p_brand as journal, p_size::varchar as volume, '3' as issue, case when p_partkey % 2 = 0 then p_size || '-' || (p_size + p_partkey % 5) end as pages,
case when p_partkey % 2 = 0 and p_partkey % 5 > 0 then (p_partkey % 5)::varchar end as page_count, '1234-567X' as issn, case when p_partkey % 3 = 0 then 'https://doi.org/10.1/' || p_partkey else 'https://doaj.org/article/a' || p_partkey end as urls,
'math' as subjects, 'deu|und' as languages, case when p_partkey % 4 > 0 then '2017-05-01' end as day, case when p_partkey % 4 = 0 then 'NO_DATE' end as skip_reason from part""")
def c04_directory_oai(spark, d):
    pages_ = F.when(K() % 2 == 0, F.concat(F.lit(", Pp "), SIZE(), F.lit("-"), SIZE() + K() % 5)).otherwise("")
    r = xml(
        _part(spark, d), "directory-oai", '<record><header><identifier>x</identifier></header><metadata><dc:dc xmlns:dc="urn:dc"><dc:title>', F.col("p_name"), "</dc:title><dc:source>", F.col("p_brand"), ", Vol ", SIZE(), ", Iss 3", pages_,
        " (2017)</dc:source><dc:date>", F.when(K() % 4 > 0, "2017-05-01T00:00:00Z").otherwise(""), "</dc:date><dc:identifier>https://doaj.org/article/a", K(), "</dc:identifier><dc:identifier>1234567X</dc:identifier>",
        F.when(K() % 3 == 0, F.concat(F.lit("<dc:identifier>10.1/"), K(), F.lit("</dc:identifier>"))).otherwise(""), '<dc:language>DE</dc:language><dc:language>qq</dc:language><dc:subject type="dcterms:LCSH">QA1-939</dc:subject>',
        '<dc:subject type="dcterms:LCSH">QA1</dc:subject><dc:subject type="x">Z-1</dc:subject></dc:dc></metadata></record>',
    )
    return shown(C.FORMATS["directory-oai"](r, _CLASSES), "id", "title", "journal", "volume", "issue", "pages", "page_count", "issn", "urls", "subjects", "languages", "date", "skip_reason")


@query(f"""select 'ai-48-' || {b64("'SRC__' || p_partkey")} as id, p_name as title, case when p_size % 3 = 0 then (1950 + p_size) || '-01-01' when p_size % 3 = 1 then '2005-03-09' end as day,
case when p_size % 2 = 0 then 'Ann Bee|' || p_brand else '' end as authors, case when p_partkey % 2 = 0 then 'fachzeitschriften' else 'Genios' end as collections,
case when p_partkey % 2 = 0 then 'fachzeitschriften|DB|ebooks_recht|sid-48-col-wisofachzs|sid-48-col-wisorecht' else 'DB|ebooks_recht|sid-48-col-wisorecht' end as packages, 'one|two' as subjects, '1861-1303' as issn,
case when p_size % 5 > 0 then (p_size % 5)::varchar end as volume, 'https://www.wiso-net.de/document/SRC__' || p_partkey as urls, (p_partkey % 7 = 0)::varchar as open_access, case when p_size % 3 = 2 then 'NO_DATE' end as skip_reason from part""")
def c05_press(spark, d):
    year = F.when(SIZE() % 3 == 0, (1950 + SIZE()).cast("string")).otherwise("n.n.")
    date = F.when(SIZE() % 3 == 1, "20050309").otherwise("x")
    people = F.when(SIZE() % 2 == 0, F.concat(F.lit("<Author>Ann Bee; N.N./abc</Author><Author>"), "p_brand", F.lit(" ;www.x.org</Author>"))).otherwise("<Author>n.n.</Author>")
    modules = F.when(K() % 2 == 0, "<Modules><Module>fachzeitschriften</Module></Modules>").otherwise("")
    r = xml(
        _part(spark, d), "press", '<Document ID="', K(), '" DB="DB"><Source>SRC </Source><Title> ', F.col("p_name"), "</Title><Year>", year, "</Year><Date>", date, "</Date><Authors>", people, "</Authors>", modules,
        "<X-Package>ebooks_recht</X-Package><Descriptors><Descriptor>one, two</Descriptor></Descriptors><ISSN>1861-1303, 1861-1303</ISSN><Volume>", F.when(SIZE() % 5 > 0, (SIZE() % 5).cast("string")).otherwise("N.n."), "</Volume><available>",
        F.when(K() % 7 == 0, "Open Access now").otherwise("n.n."), "</available></Document>",
    )
    return shown(C.FORMATS["press"](r), "id", "title", "date", "authors", "collections", "packages", "subjects", "issn", "volume", "urls", "open_access", "skip_reason")


def _article(spark, d) -> DataFrame:
    dates = F.when(K() % 3 == 0, '<pub-date pub-type="epub"><year>1990</year></pub-date><pub-date pub-type="ppub"><day>7</day><month>Jun</month><year>1991</year></pub-date>').when(K() % 3 == 1, "<pub-date><month>2</month><year>1995</year></pub-date>").otherwise("")
    title = F.when(SIZE() % 10 == 0, "Front Matter").otherwise(F.concat(F.lit("<italic>A</italic> &amp;amp; "), "p_name"))
    kind = F.when(SIZE() % 7 == 0, "book-review").when(SIZE() % 7 == 1, "misc").otherwise("research-article")
    return xml(
        _part(spark, d), "articles", '<article article-type="', kind, '" xmlns:xlink="urn:x"><front><journal-meta><issn pub-type="ppub">12345678</issn><issn>8765-4321</issn><journal-title-group><abbrev-journal-title>',
        F.col("p_brand"), "</abbrev-journal-title></journal-title-group><publisher><publisher-name>Press</publisher-name></publisher></journal-meta><article-meta>",
        F.when(SIZE() % 4 > 0, F.concat(F.lit('<article-id pub-id-type="doi">10.2/'), K(), F.lit("</article-id>"))).otherwise(""), "<title-group><article-title>", title, "</article-title><subtitle>S</subtitle></title-group><contrib-group>",
        '<contrib contrib-type="author"><name><surname>Bee</surname><given-names>Ann</given-names></name><string-name><surname>Cee</surname><given-names>Dan</given-names></string-name></contrib>',
        '<contrib contrib-type="editor"><name><surname>Eve</surname><given-names>F</given-names></name><string-name><surname>Gee</surname><given-names>H</given-names></string-name></contrib></contrib-group>',
        '<article-categories><subj-group subj-group-type="heading"><subject>H1</subject></subj-group><subj-group><subject>S1</subject><subject>S2</subject></subj-group></article-categories>', dates, "<volume>", SIZE(), "</volume><fpage>10</fpage><lpage>",
        10 + SIZE() % 4, "</lpage><product><source>The <bold>", F.col("p_type"), '</bold></source></product><self-uri xlink:href="http://h.example/10.2/s', K(),
        '"/><custom-meta-group><custom-meta><meta-name>lang</meta-name><meta-value>en</meta-value></custom-meta></custom-meta-group></article-meta></front><body>The text of the article is ', F.col("p_name"), " and it is in the body</body></article>",
    )


_TITLE = "case when p_size % 10 = 0 then 'Front Matter : S' else 'A & ' || p_name || ' : S' end"
_DATED = "case p_partkey % 3 when 0 then '1991-06-07' when 1 then '1995-02-01' end"
_PAGES = "case when p_size % 4 > 0 then (p_size % 4)::varchar end as page_count"


@query(f"""select {_TITLE} as title, p_brand as journal, {_DATED} as day, 'Bee, Ann' as authors, '12345678|8765-4321' as issn, p_size::varchar as volume, '10-' || (10 + p_size % 4) as pages, {_PAGES}, 'H1' as headings, 'S1|S2' as subjects,
'eng' as languages, 'The text of the article is ' || p_name || ' and it is in the body' as abstract from part""")
def c06_articles(spark, d):
    return shown(C.FORMATS["articles"](_article(spark, d)), "title", "journal", "date", "authors", "issn", "volume", "pages", "page_count", "headings", "subjects", "languages", "abstract")


_LINK = "'http://h.example/10.2/s' || p_partkey"


@query(f"""select 'ai-55-' || {b64(_LINK)} as id, '10.2/s' || p_partkey as doi, {_LINK} as urls, case when p_size % 7 = 0 then 'Review: The ' || p_type else {_TITLE} end as title, 'Cee, Dan|Gee, H' as authors, '1234-5678' as issn, 'eng' as languages,
{_DATED} as day, case when p_partkey % 3 = 2 then 'NO_DATE' when p_size % 10 = 0 then 'BLOCKED_TITLE' when p_size % 7 = 1 then 'SUPPRESSED_TYPE' end as skip_reason from part""")
def c07_articles_archive(spark, d):
    return shown(C.FORMATS["articles-archive"](_article(spark, d)), "id", "doi", "urls", "title", "authors", "issn", "languages", "date", "skip_reason")


@query(f"""select 'ai-50-' || {b64("'http://dx.doi.org/10.2/' || p_partkey")} as id, 'http://dx.doi.org/10.2/' || p_partkey as urls, {_TITLE} as title, 'Bee, Ann' as authors,
'De Gruyter Journals / Social Sciences and Humanities|sid-50-col-degruyterssh' as collections from part where p_size % 4 > 0""")
def c08_articles_humanities(spark, d):
    return shown(C.FORMATS["articles-humanities"](_article(spark, d)).filter("skip_reason is null"), "id", "urls", "title", "authors", "collections")


@query(f"""select case when p_size % 4 > 0 then 'ai-219-' || {b64("'10.2/' || p_partkey")} end as id, case when p_size % 4 > 0 then 'https://doi.org/10.2/' || p_partkey else '' end as urls, {_TITLE} as title, '1234-5678' as issn,
case when p_size % 4 = 0 then 'NO_DOI' when p_partkey % 3 = 2 then 'NO_DATE' when p_size % 10 = 0 then 'BLOCKED_TITLE' end as skip_reason from part""")
def c09_articles_press(spark, d):
    return shown(C.FORMATS["articles-press"](_article(spark, d)), "id", "urls", "title", "issn", "skip_reason")


@query(f"""select 'ai-60-' || {b64("'10.3/' || p_partkey")} as id, p_name as title, case when p_size % 2 = 0 then 'Thieme' else p_brand end as publishers, '1111-1111' as issn, '2222-2222' as eissn, 'deu' as languages, 'Bee, Ann' as authors,
case p_partkey % 3 when 0 then '1999-01-01' when 1 then '1999-02-03' end as day, case when p_partkey % 3 = 2 then 'NO_DATE' when p_size % 9 = 0 then 'BAD_SERIAL_KIND' end as skip_reason from part""")
def c10_publisher_records(spark, d):
    date = F.when(K() % 3 == 0, "<year>1999</year><month>0</month><day>0</day>").when(K() % 3 == 1, "<year>1999</year><month>2</month><day>3</day>").otherwise("<month>2</month>")
    r = xml(
        _part(spark, d), "publisher-records", '<record><metadata><article xml:lang="de" lang="de"><front><journal-meta><issn pub-type="print">1111-1111</issn><issn pub-type="', F.when(SIZE() % 9 == 0, "other").otherwise("e-issn"),
        '">2222-2222</issn><publisher><publisher-name>', F.when(SIZE() % 2 == 0, "Thieme KG").otherwise(F.col("p_brand")), '</publisher-name></publisher></journal-meta><article-meta><article-id pub-id-type="doi">10.3/', K(),
        "</article-id><title-group><article-title>", F.col("p_name"), "</article-title></title-group><contrib-group><contrib><name><surname>Bee</surname><given-names>Ann</given-names></name></contrib></contrib-group><pub-date>", date,
        "</pub-date></article-meta></front></article></metadata></record>",
    )
    out = C.FORMATS["publisher-records"](r, {"Thieme KG": "Thieme"})
    return shown(out.withColumn("eissn", F.when(F.size("eissn") > 0, F.col("eissn")).otherwise(F.array(F.lit("2222-2222")))), "id", "title", "publishers", "issn", "eissn", "languages", "authors", "date", "skip_reason")


@query(f"""select case when p_size % 6 > 0 then 'ai-89-' || {b64("p_partkey::varchar")} end as id, case when p_size % 8 = 0 then '[' else '' end || p_name as title, p_brand as journal, case p_partkey % 4 when 0 then '1998-02-01' when 1 then '1998-01-09' when 2 then '1998-03-01' end as day,
'11-' || (11 + p_size) as pages, (p_size + 1)::varchar as page_count, (p_size % 2 = 0)::varchar as open_access, 'eng' as languages, '1111-1111' as issn, '2222-2222' as eissn, 'fuzzy' as subjects, 'J|S|M1' as packages,
case when p_size % 6 > 0 then 'http://ieeexplore.ieee.org/stamp/stamp.jsp?arnumber=' || p_partkey || '|' else '' end || 'http://doi.org/10.4/' || p_partkey as urls,
case when p_size % 8 = 0 then 'EXTRA' when p_partkey % 4 = 3 then 'NO_DATE' when p_size % 6 = 0 then 'NO_ID' end as skip_reason from part""")
def c11_publications(spark, d):
    date = (
        F.when(K() % 4 == 0, '<date datetype="ePub"><year>1990</year></date><date datetype="OriginalPub"><year>1998</year><month>February</month><day>40</day></date>').when(K() % 4 == 1, "<date><year>1998</year><month>13</month><day>9</day></date>")
        .when(K() % 4 == 2, "<date><year>1998</year><month>3</month></date>").otherwise("<date><year>x</year></date>")
    )
    r = xml(
        _part(spark, d), "publications", "<publication><title>", F.col("p_brand"), '</title><publicationinfo><issn mediatype="Paper">1111-1111</issn><issn mediatype="online">2222-2222</issn><publicationtype>J</publicationtype>',
        "<publicationsubtype>S</publicationsubtype><packagememberset><packagemember>M1</packagemember></packagememberset></publicationinfo><volume><volumeinfo><volumenum>7</volumenum></volumeinfo><article><title>",
        F.when(SIZE() % 8 == 0, "[").otherwise(""), F.col("p_name"), "</title><articleinfo><abstract>short</abstract>", F.when(SIZE() % 6 > 0, F.concat(F.lit("<amsid>"), K(), F.lit("</amsid>"))).otherwise(""), "<articledoi>10.4/", K(),
        "</articledoi><articlelicense>", F.when(SIZE() % 2 == 0, "CCBY").otherwise("OAPA"), '</articlelicense><artpagenums startpage="11" endpage="', 11 + SIZE(), '"/>', date,
        "<keywordset><keyword><keywordterm> fuzzy </keywordterm></keyword><keyword><keywordterm> </keywordterm></keyword></keywordset></articleinfo></article></volume></publication>",
    )
    return shown(C.FORMATS["publications"](r), "id", "title", "journal", "date", "pages", "page_count", "open_access", "languages", "issn", "eissn", "subjects", "packages", "urls", "skip_reason")


@query("""select 'ai-53-' || p_partkey as id, case when p_size % 3 = 0 then p_name || ' [' || p_type || ']' else p_name end as title, case p_size % 4 when 0 then '14' when 1 then 'x1' when 2 then '1999' else '12' end as volume, 'Ann Bee' as authors,
case when p_partkey % 2 = 0 then p_brand || '|E' else p_brand end as publishers, 'eng|deu' as languages, (p_size % 5 > 0)::varchar as open_access, (1980 + p_size % 30) || '-01-01' as day from part""")
def c12_bilingual(spark, d):
    english = F.when(SIZE() % 3 == 0, F.col("p_type")).when(SIZE() % 3 == 1, F.upper("p_name")).otherwise(" ")
    volume = F.when(SIZE() % 4 == 0, "XIV").when(SIZE() % 4 == 1, "x1").when(SIZE() % 4 == 2, "MCMXCIX").otherwise("12")
    r = xml(
        _part(spark, d), "bilingual", "<Article><UniqueID>", K(), "</UniqueID><ArticleTitle> ", F.col("p_name"), "</ArticleTitle><ArticleTitleEnglish>", english, "</ArticleTitleEnglish><Volume>", volume,
        "</Volume><Authors><Author>Ann Bee </Author><Author>TOL, TOL</Author><Author>ab</Author></Authors><Publisher>", F.col("p_brand"), "</Publisher><PublisherEnglish>", F.when(K() % 2 == 0, "E").otherwise(F.col("p_brand")),
        "</PublisherEnglish><Languages><Language>English</Language><Language>Deutsch</Language><Language>German</Language></Languages><IsOpenAccess>", SIZE() % 5, "</IsOpenAccess><PublicationYear>", 1980 + SIZE() % 30, "</PublicationYear></Article>",
    )
    return shown(C.FORMATS["bilingual"](r), "id", "title", "volume", "authors", "publishers", "languages", "open_access", "date")


def _datafield(tag: str, *subfields) -> list:
    out = [f'<datafield tag="{tag}" ind1=" " ind2=" ">']
    for code, value in subfields:
        out += [f'<subfield code="{code}">', value, "</subfield>"]
    return [*out, "</datafield>"]


def _optional(when: Column, parts: list) -> Column:
    return F.when(when, F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])).otherwise("")


@query("""select case when p_size % 6 > 0 then 'ai-53-' || p_partkey end as id, case when p_size % 2 = 1 then p_name || ': ' || p_type end as title, case when p_size % 2 = 0 then p_name || ': ' || p_type end as book_title,
case when p_size % 2 = 0 then 'EBOOK' else 'EJOUR' end as ref_type, '6' as volume, '4' as issue, 'Ann Bee|Dan Cee' as authors, 'eng|deu|rus' as languages, 'Riga' as places, (1980 + p_size % 30) || '-01-01' as day,
case when p_size % 6 = 0 then 'NO_ID' end as skip_reason from part""")
def c13_marc_books(spark, d):
    fields = [
        *_datafield("245", ("a", F.concat(F.col("p_name"), F.lit(" "))), ("b", F.col("p_type"))), _optional(SIZE() % 2 == 0, _datafield("020", ("a", "978-1"))), _optional(SIZE() % 2 == 1, _datafield("022", ("a", "1234-5678"))),
        _optional(SIZE() % 6 > 0, _datafield("856", ("u", "http://h.example/x"), ("u", F.concat(F.lit("http://h.example/search?id="), K())))), *_datafield("362", ("a", "Vol. VI, no. 4 (2014)-")), *_datafield("100", ("a", "Ann Bee")),
        *_datafield("700", ("a", "Dan Cee")), *_datafield("041", ("a", "eng"), ("a", "de/rus")), *_datafield("260", ("a", "Riga [1] :"), ("c", (1980 + SIZE() % 30).cast("string"))),
    ]
    r = xml(_part(spark, d), "marc-books", "<record><leader>00000nam</leader>", *fields, "</record>")
    return shown(C.FORMATS["marc-books"](r), "id", "title", "book_title", "ref_type", "volume", "issue", "authors", "languages", "places", "date", "skip_reason")


@query(f"""select 'ai-210-' || {b64("'journals/x/' || p_partkey")} as id, case when p_size % 4 < 3 then p_name end as title, case when p_size % 4 = 3 then p_name end as book_title,
case p_size % 4 when 0 then 'http://h.example/' || p_partkey when 1 then 'https://dblp.org/db/journals/' || p_partkey when 2 then 'https://dblp.org/db/conf/' || p_partkey else 'https://dblp.org/db/books/' || p_partkey end || '|https://e.example' as urls,
case when p_partkey % 5 > 0 then (1980 + p_size % 30) || '-01-01' end as day, case when p_partkey % 5 = 0 then 'NO_DATE' end as skip_reason from part""")
def c14_bibliography(spark, d):
    start = F.when(SIZE() % 4 == 0, "http://h.example/").when(SIZE() % 4 == 1, "db/journals/").when(SIZE() % 4 == 2, "db/conf/").otherwise("db/books/")
    r = xml(
        _part(spark, d), "bibliography", '<article key="journals/x/', K(), '"><author>Ann Bee</author><title>', F.col("p_name"), "</title><year>", F.when(K() % 5 > 0, (1980 + SIZE() % 30).cast("string")).otherwise("o.J."), "</year><url>", start, K(),
        "</url><ee>https://e.example</ee><ee>db/x</ee></article>",
    )
    return shown(C.FORMATS["bibliography"](r), "id", "title", "book_title", "urls", "date", "skip_reason")


@query(f"""select 'ai-162-' || {b64("'oai:g:' || p_partkey")} as id, p_name as title, case when p_size % 2 = 0 then p_brand || ': 12-20' end as journal, case when p_size % 2 = 1 then '12-20' end as book_title, '8' as page_count,
case when p_size % 2 = 0 then '1234-5678' else '' end as issn, '10.5/' || p_partkey as doi, case p_partkey % 4 when 0 then '2003-01-01' when 1 then null end as day,
case p_partkey % 4 when 1 then 'SHORT_DATE' when 2 then 'EMPTY_DATE' when 3 then 'BAD_DATE' end as skip_reason from part""")
def c15_dc_gender(spark, d):
    date = F.when(K() % 4 == 0, "2003-05").when(K() % 4 == 1, "200").when(K() % 4 == 2, "").otherwise("n. d.")
    r = xml(
        _part(spark, d), "dc-gender", "<record><header><identifier>oai:g:", K(), "</identifier></header><metadata><dc><title>", F.col("p_name"), "</title><source>", F.col("p_brand"), ": 12-20</source><identifier>http://dx.doi.org/10.5/", K(), "</identifier>",
        F.when(SIZE() % 2 == 0, "<identifier>urn:ISSN:1234-5678</identifier>").otherwise(""), "<date>", date, "</date></dc></metadata></record>",
    )
    return shown(C.FORMATS["dc-gender"](r), "id", "title", "journal", "book_title", "page_count", "issn", "doi", "date", "skip_reason")


@query(f"""select 'ai-107-' || {b64("'oai:h:' || p_partkey")} as id, 'Ann |Dan' as authors, 's1|t1' as subjects, case when p_size % 2 = 0 then 'Print' else 'Manuscript' end as format, case when p_size % 3 = 0 then 'book' else 'unknown' end as genre,
'http://digi.ub.uni-heidelberg.de/diglit/x' || p_partkey || '|https://digi.ub.uni-heidelberg.de/diglit/iiif/x' || p_partkey || '/manifest.json|http://nbn-resolving.de/urn:nbn:de:' || p_partkey as urls, 'deu|lat' as languages,
case when p_partkey % 3 > 0 then (1500 + p_size) || '-01-01' end as day, case when p_partkey % 3 = 0 then 'NO_DATE' end as skip_reason from part""")
def c16_dc_manuscripts(spark, d):
    r = xml(
        _part(spark, d), "dc-manuscripts", "<record><header><identifier>oai:h:", K(), "</identifier></header><metadata><dc><creator>Ann [Hrsg.]; ; Dan</creator><date>", F.when(K() % 3 > 0, F.concat(F.lit("[um "), 1500 + SIZE(), F.lit("] VD16"))).otherwise("o.J."),
        "</date><identifier>http://digi.ub.uni-heidelberg.de/diglit/x", K(), "</identifier><identifier>urn:nbn:de:", K(), "</identifier><language>de</language><language>x-unknown</language><language>la</language><type>", F.when(SIZE() % 3 == 0, "Monograph").otherwise("Volume"),
        "</type><ispartof>", F.when(SIZE() % 2 == 0, "Druckschriften").otherwise("x"), "</ispartof><subject>s1</subject><subject>a; b</subject><temporal> t1</temporal></dc></metadata></record>",
    )
    return shown(C.FORMATS["dc-manuscripts"](r, {"Druckschriften": "Print"}, {"Monograph": "book"}), "id", "authors", "subjects", "format", "genre", "urls", "languages", "date", "skip_reason")


@query(f"""select 'ai-170-' || {b64("'oai:m:' || p_partkey")} as id, p_name as title, 'Ann|Dan' as authors, case when p_size % 7 >= 3 then (p_size % 7 - 3)::varchar end as page_count, '978-1' as isbn, 'http://h.example/' || p_partkey as urls,
case p_partkey % 4 when 0 then '2001-01-01' when 1 then '2001-05-01' when 2 then '2001-05-06' end as day, case when p_partkey % 4 = 3 then 'NO_DATE' end as skip_reason from part""")
def c18_dim(spark, d):
    field = lambda schema, element, qualifier, v: [f'<field mdschema="{schema}" element="{element}"' + (f' qualifier="{qualifier}"' if qualifier else "") + ">", v, "</field>"]
    date = F.when(K() % 4 == 0, "2001").when(K() % 4 == 1, "2001-05").when(K() % 4 == 2, "2001-05-06").otherwise("May 2001")
    fields = [
        *field("dc", "title", None, F.col("p_name")), *field("dc", "creator", None, "Ann"), *field("dc", "contributor", None, "Dan"), *field("local", "source", "spage", "3"), *field("local", "source", "epage", (SIZE() % 7).cast("string")),
        *field("dc", "identifier", "isbn", "978-1"), *field("dc", "identifier", "uri", F.concat(F.lit("http://h.example/"), K())), *field("dc", "date", "issued", date), *field("dc", "date", "available", "1999"),
    ]
    r = xml(_part(spark, d), "dim", "<record><header><identifier>oai:m:", K(), "</identifier></header><metadata><dim>", *fields, "</dim></metadata></record>")
    return shown(C.FORMATS["dim"](r), "id", "title", "authors", "page_count", "isbn", "urls", "date", "skip_reason")


@query("""select case when p_size % 5 > 0 then 'ai-12502-' || p_partkey end as id, case when p_size % 2 = 0 then 'ger|lat' else 'und' end as languages, case when p_size % 5 = 0 then 'BAD_ID' end as skip_reason from part""")
def c20_mets_archive(spark, d):
    section = lambda lang: f"<dmdSec><mdWrap><xmlData><mods><language><languageTerm>{lang}</languageTerm></language></mods></xmlData></mdWrap></dmdSec>"
    bare = "<dmdSec><mdWrap><xmlData><mods/></xmlData></mdWrap></dmdSec>"
    r = xml(
        _part(spark, d), "mets-archive", "<record><header><identifier>", F.when(SIZE() % 5 > 0, "oai:").otherwise(""), K(), "</identifier></header><metadata><mets>", F.when(SIZE() % 2 == 0, section("ger") + bare + section("lat")).otherwise(bare),
        "</mets></metadata></record>",
    )
    return shown(C.FORMATS["mets-archive"](r), "id", "languages", "skip_reason")


@query("""select 'ai-30-' || p_partkey as id, case when p_size % 2 = 1 then p_name end as title, case when p_size % 2 = 0 then p_name end as book_title, 'Some Journal' as journal, case when p_size % 3 = 0 then '7' else '87' end as start_page,
case when p_size % 3 = 0 then '7' else '101' end as end_page, case when p_size % 3 = 0 then '1' else '14' end as page_count, case p_partkey % 3 when 0 then '2011-01-01' when 1 then '2010-01-01' else '2005-01-01' end as day,
case when p_partkey % 5 = 0 then 'EMBARGO' end as skip_reason from part""")
def c21_marc_archive(spark, d):
    until = _optional(K() % 5 < 2, _datafield("500", ("a", F.concat(F.lit("Der Volltext unterliegt einer Embargofrist bis zum 18. Okt. "), F.when(K() % 5 == 0, "2028").otherwise("2018"), F.lit(".")))))
    given = F.when(K() % 3 == 0, "2011").when(K() % 3 == 1, "o.J.").otherwise("")
    fields = [
        *_datafield("245", ("a", F.col("p_name"))), *_datafield("500", ("a", "In: Some Journal ; 19 (2005) 1 ; 87-101")), until, _optional(SIZE() % 3 == 0, _datafield("300", ("a", "S. 7"))), *_datafield("264", ("c", given), ("a", "Köln"), ("b", "Press")),
    ]
    leader = F.when(SIZE() % 2 == 0, "00000nam a2200000 uu4500").otherwise("00000naa a2200000 uu4500")
    r = xml(_part(spark, d), "marc-archive", "<record><header><identifier>oai:x:document/", K(), "</identifier></header><metadata><record><leader>", leader, "</leader>", *fields, "</record></metadata></record>")
    out = C.FORMATS["marc-archive"](r, F.lit("2025-01-01").cast("date"))
    return shown(out, "id", "title", "book_title", "journal", "start_page", "end_page", "page_count", "date", "skip_reason")


@query(f"""select 'ai-93-' || {b64("'urn:nbn:' || p_partkey")} as id, 'urn:nbn:' || p_partkey as record_id, p_name as title, 'Bee, Ann' as authors, 'http://nbn-resolving.de/urn:nbn:' || p_partkey as urls, case when p_size % 2 = 0 then 'deu' else 'und' end as languages from part""")
def c22_dc_prints(spark, d):
    r = xml(
        _part(spark, d), "dc-prints", "<record><header><identifier>oai:www.zvdd.de:urn:nbn:", K(), "</identifier></header><metadata><dc><title>", F.col("p_name"), "</title><title>x</title><creator> Bee, Ann,</creator><language>",
        F.when(SIZE() % 2 == 0, "ger").otherwise("zz"), "</language></dc></metadata></record>",
    )
    return shown(C.FORMATS["dc-prints"](r), "id", "record_id", "title", "authors", "urls", "languages")


@query(f"""select 'ai-93-' || {b64("'oai:z:' || p_partkey")} as id, p_name as title, '10.6/' || p_partkey as doi, 'http://nbn-resolving.de/urn:x' as urls, 'ger|eng' as languages, 'A|B' as publishers,
case p_size % 5 when 0 then '1701-01-01' when 1 then '1702-01-01' when 2 then '1703-03-04' when 3 then '1704-05-01' end as day, case when p_size % 5 = 4 then 'BAD_DATE' end as skip_reason from part""")
def c23_mets_prints(spark, d):
    date = F.when(SIZE() % 5 == 0, "1701").when(SIZE() % 5 == 1, "[1702]").when(SIZE() % 5 == 2, "04.03.1703").when(SIZE() % 5 == 3, "5.1704").otherwise("-")
    r = xml(
        _part(spark, d), "mets-prints", "<record><header><identifier>oai:z:", K(), "</identifier></header><metadata><mets><dmdSec><mdWrap><xmlData><mods><titleInfo><title>", F.col("p_name"),
        '</title></titleInfo><identifier type="DOI">10.6/', K(), '</identifier><identifier type="urn">urn:x</identifier><originInfo><publisher>A</publisher><dateIssued>zzz</dateIssued></originInfo><originInfo><publisher>B</publisher><dateIssued>', date,
        "</dateIssued></originInfo><language><languageTerm>ger</languageTerm></language><language><languageTerm>en</languageTerm></language></mods></xmlData></mdWrap></dmdSec></mets></metadata></record>",
    )
    return shown(C.FORMATS["mets-prints"](r), "id", "title", "doi", "urls", "languages", "publishers", "date", "skip_reason")


@query(f"""select 'ai-15-' || {b64("'w' || p_partkey")} as id, p_name as title, 'http://h.example/' || p_partkey as urls, 'Ann' as authors, 'MUSIC' as ref_type from part""")
def c24_scores(spark, d):
    text = F.concat(
        F.lit("<document><var><recordId>w"), K(), F.lit("</recordId></var><var name='Work Title'><string>"), "p_name", F.lit("</string></var><var name='permlink'><string>http://h.example/"), K(),
        F.lit("</string></var><var name='composer'><string>Ann</string></var></document>"),
    )
    return shown(C.FORMATS["scores"](_part(spark, d).select(text.alias("value"))), "id", "title", "urls", "authors", "ref_type")


@query(f"""select 'ai-85-' || {b64("'10.7/' || p_partkey")} as id, case when p_size % 2 = 0 then p_name else p_type end as title, 'J' || (p_partkey % 100) as journal, (p_partkey % 100)::varchar as volume, (5 + p_size)::varchar as end_page, p_size::varchar as pages,
'Ann Bee' as authors, case when p_size % 3 = 0 then '2001-02-03' else '1999-01-01' end as day, 'some text' as abstract from part where p_partkey % 100 < 90 and p_size % 10 > 0""")
def c25_shipment(spark, d):
    p = _part(spark, d)
    where = F.lit("s1").alias("shipment")
    with_ = lambda df, kind, *parts: xml(df, f"shipment-{kind}", *parts).withColumn("shipment", where)
    listed = p.select((K() % 100).alias("i")).distinct()
    i = F.col("i")
    datasets = with_(listed, "dataset", "<dataset><dataset-content><journal-issue><journal-issue-unique-ids><pii>I", i, "</pii></journal-issue-unique-ids><journal-issue-properties><collection-title>J", i, "</collection-title></journal-issue-properties></journal-issue></dataset-content></dataset>")
    item = F.concat(F.lit("<include-item><pii>A"), K(), F.lit("</pii><pages><first-page>5</first-page><last-page>"), 5 + SIZE(), F.lit("</last-page></pages></include-item>"))
    items = p.filter(K() % 100 < 90).groupBy((K() % 100).alias("i")).agg(F.array_join(F.array_sort(F.collect_list(item)), "").alias("items"))
    issues = with_(items, "issue", "<serial-issue><issue-info><pii>I", i, "</pii><issn>1234-5678</issn><volume-issue-number><vol-first>", i, "</vol-first></volume-issue-number></issue-info><issue-body><issue-sec>", F.col("items"), "</issue-sec></issue-body></serial-issue>")
    author = "<author-group><author><given-name>Ann</given-name><surname>Bee</surname></author></author-group>"
    head = F.when(SIZE() % 2 == 0, F.concat(F.lit("<head><title>"), "p_name", F.lit(f"</title>{author}"))).otherwise("<head>")
    simple = F.when(SIZE() % 2 == 1, F.concat(F.lit("<simple-head><title>"), "p_type", F.lit(f"</title>{author}</simple-head>"))).otherwise("")
    received = F.when(SIZE() % 3 == 0, '<date-received day="03" month="02" year="2001"/>').otherwise("")
    articles = with_(p.filter(SIZE() % 10 > 0), "article", "<article><item-info><pii>A", K(), "</pii><doi>10.7/", K(), '</doi><copyright year="1999">x</copyright></item-info>', head, received, "<abstract><p>some text</p></abstract></head>", simple, "</article>")
    return shown(C.FORMATS["shipment"](datasets, issues, articles), "id", "title", "journal", "volume", "end_page", "pages", "authors", "date", "abstract")
