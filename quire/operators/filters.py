"""Boolean filter trees over records: {"and": [...]}, {"or": [...]}, {"not": ...} over registered leaves.

Leaves of a list are columns. Leaves that name files (serial numbers, book numbers, DOIs, holdings) need one
join for all of them before: `prepare` adds what each record meets as an array, and the leaves look there.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import serials_in
from . import coverage

LEAVES: dict[str, Callable[..., Column]] = {}
#: Arrays that `prepare` adds: files whose lists a record meets, and holdings that cover it.
MET, HELD = "_met_lists", "_held_by"
#: Book numbers as they stand in files: a fixed value.
ISBN = r"(?i)(?:ISBN)?[\d\s\-]+X?"


def leaf(name: str):
    def add(f):
        LEAVES[name] = f
        return f

    return add


def _array(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


@leaf("any")
def _any(_) -> Column:
    return F.lit(True)


@leaf("in")
def _in(x: dict) -> Column:
    """{"field": name, "list": values}: the value is in the list."""
    return F.col(x["field"]).isin(*x["list"])


@leaf("overlaps")
def _overlaps(x: dict) -> Column:
    """{"field": name, "list": values}: the array shares a value with the list."""
    return F.arrays_overlap(F.col(x["field"]), F.array(*map(F.lit, x["list"])))


@leaf("between")
def _between(x: dict) -> Column:
    return F.col(x["field"]).between(x["least"], x["most"])


@leaf("source")
def _source(x: list[str]) -> Column:
    return F.col("source_id").isin(*x)


def _shares(field: str) -> Callable[[list[str]], Column]:
    return lambda x: F.arrays_overlap(_array(field), F.array(*map(F.lit, x)).cast("array<string>"))


for _name, _field in (("collection", "collections"), ("package", "packages"), ("subject", "subjects")):
    leaf(_name)(_shares(_field))


def _file(x: dict) -> str | None:
    return x.get("file") or x.get("url")


def _listed(kind: str, values: Column, x: dict) -> Column:
    own = F.arrays_overlap(values, F.array(*map(F.lit, x.get("list") or [])).cast("array<string>"))
    return own if not _file(x) else F.coalesce(own, F.lit(False)) | F.array_contains(F.col(MET), f"{kind}:{_file(x)}")


@leaf("doi")
def _doi(x: dict) -> Column:
    """{"list": values, "file": path}"""
    return _listed("doi", F.array("doi"), x)


@leaf("issn")
def _issn(x: dict) -> Column:
    """{"list": values, "file": path, "url": path}: a print or electronic serial number is in the list as it is, or among
    those found in the lines of the file."""
    return _listed("issn", F.concat(_array("issn"), _array("eissn")), x)


@leaf("isbn")
def _isbn(x: dict) -> Column:
    return _listed("isbn", _array("isbn"), x)


def _names(x: dict) -> list[str]:
    return [n for n in [*(x.get("files") or []), x.get("file"), *(x.get("urls") or [])] if n]


@leaf("holdings")
def _holdings(x: dict) -> Column:
    """{"file": path, "files": paths, "urls": paths, "compare-by-title": flag}: one of the holdings covers the record."""
    ways = [n for n in _names(x)] + ([f"title:{n}" for n in _names(x)] if x.get("compare-by-title") else [])
    return F.arrays_overlap(F.col(HELD), F.array(*map(F.lit, ways)).cast("array<string>"))


def _only(tree: dict) -> tuple[str, object]:
    if not isinstance(tree, dict) or len(tree) != 1:
        raise ValueError("a filter has exactly one name")
    return next(iter(tree.items()))


def compile_tree(tree: dict) -> Column:
    """A two-valued column: a leaf that is null is false, so that `not` loses no row."""
    name, arg = _only(tree)
    if name == "and":
        return reduce(lambda a, b: a & b, map(compile_tree, arg), F.lit(True))
    if name == "or":
        return reduce(lambda a, b: a | b, map(compile_tree, arg), F.lit(False))
    if name == "not":
        return ~compile_tree(arg)
    if name not in LEAVES:
        raise ValueError(f"unknown filter: {name}")
    return F.coalesce(LEAVES[name](arg), F.lit(False))


def leaves_of(tree: dict) -> Iterator[tuple[str, object]]:
    name, arg = _only(tree)
    if name in ("and", "or"):
        for child in arg:
            yield from leaves_of(child)
    elif name == "not":
        yield from leaves_of(arg)
    else:
        yield name, arg


def read_list(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """`value` of the lines of a file: serial and book numbers are found in the upper-case line, DOIs are whole lines."""
    lines = spark.read.text(path).select(F.trim("value").alias("line")).filter("line <> ''")
    if kind == "doi":
        return lines.select(F.col("line").alias("value")).distinct()
    found = serials_in(F.upper("line"), strict=True) if kind == "issn" else F.regexp_extract_all(F.upper("line"), F.lit(ISBN), F.lit(0))
    return lines.select(F.explode(found).alias("value")).distinct()


def prepare(spark: SparkSession, df: DataFrame, trees: list[dict], now: Column | None = None, entries: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Adds the lists that a record meets and the holdings that cover it, as the trees' leaves need them: one join for
    all lists of a kind, one for all holdings. Records that are the same in what is looked at are joined once.

    entries: gives the entries (see coverage) of a holdings name; a KBART file of that name by default."""
    needed = [x for t in trees for x in leaves_of(t)]
    files = sorted({(k, _file(x)) for k, x in needed if k in ("doi", "issn", "isbn") and _file(x)})
    held = sorted({n for k, x in needed if k == "holdings" for n in _names(x)})
    titled = sorted({n for k, x in needed if k == "holdings" and x.get("compare-by-title") for n in _names(x)})
    kinds = {"doi": lambda: F.array("doi"), "issn": lambda: F.concat(_array("issn"), _array("eissn")), "isbn": lambda: _array("isbn")}
    out = df
    none = F.array().cast("array<string>")
    if files:
        known = reduce(DataFrame.union, [read_list(spark, k, path).select("value", F.lit(f"{k}:{path}").alias("of")) for k, path in files])
        used = sorted({k for k, _ in files})
        keyed = reduce(DataFrame.unionByName, [df.select(F.explode(kinds[k]()).alias("value"), F.lit(k).alias("kind")).filter("value is not null").distinct() for k in used])
        hits = keyed.join(known, (keyed.value == known.value) & F.col("of").startswith(F.concat("kind", F.lit(":")))).select(keyed.value, "of").distinct()
        per = hits.groupBy("value").agg(F.collect_set("of").alias("ofs"))
        own = F.array_distinct(F.concat(*[kinds[k]() for k in used]))
        row = F.xxhash64(F.to_json(F.struct(own.alias("v")))).alias("_lists_key")
        values = df.select(row, own.alias("v")).distinct().select("_lists_key", F.explode("v").alias("value"))
        met = values.join(per, "value").groupBy("_lists_key").agg(F.array_distinct(F.flatten(F.collect_set("ofs"))).alias(MET))
        out = out.withColumn("_lists_key", row).join(met, "_lists_key", "left").drop("_lists_key").withColumn(MET, F.coalesce(MET, none))
    if held:
        entries = entries or (lambda name: coverage.entries_of(_kbart(spark, name), F.lit(name)))
        fields = [F.concat(_array("issn"), _array("eissn")).alias("serials"), F.col("date").cast("string").alias("date"), *[F.col(c).cast("string").alias(c) for c in ("volume", "issue", "title")]]
        key = F.sha2(F.to_json(F.struct(*fields)), 256).alias("record_id")
        records = df.select(key, *fields).distinct()
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [entries(n) for n in held])
        hits = coverage.covered(records, every, now if now is not None else F.current_timestamp())
        if titled:
            by_title = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [_by_title(spark, n, entries) for n in titled])
            found = coverage.covered_by_title(records, by_title, now if now is not None else F.current_timestamp())
            hits = hits.unionByName(found.withColumn("holdings", F.concat(F.lit("title:"), "holdings")))
        per = hits.groupBy("record_id").agg(F.collect_set("holdings").alias(HELD)).withColumnRenamed("record_id", "_held_key")
        out = out.withColumn("_held_key", key).join(per, "_held_key", "left").drop("_held_key").withColumn(HELD, F.coalesce(HELD, none))
    return out


def _kbart(spark: SparkSession, path: str) -> DataFrame:
    from ..sources.io import kbart

    return kbart(spark, path)


def _by_title(spark: SparkSession, name: str, entries) -> DataFrame:
    own = entries(name)
    if "publication_title" in own.columns:
        return own
    names = {"first_date": "date_first_issue_online", "last_date": "date_last_issue_online", "first_volume": "num_first_vol_online", "last_volume": "num_last_vol_online", "first_issue": "num_first_issue_online", "last_issue": "num_last_issue_online", "embargo": "embargo_info"}
    return coverage.index_by_title(_kbart(spark, name)).select(F.lit(name).alias("holdings"), "publication_title", *[F.coalesce(F.col(v), F.lit("")).alias(k) for k, v in names.items()])


def expand(config: dict[str, dict], groups: dict[str, list[str]]) -> dict[str, dict]:
    """Labels of groups get the group's tree; the group itself goes."""
    out = {k: v for k, v in config.items() if k not in groups}
    for group, labels in groups.items():
        if group in config:
            out |= {label: config[group] for label in labels}
    return out


def labels(config: dict[str, dict]) -> Column:
    """The sorted labels whose trees hold."""
    each = [F.when(compile_tree(t), F.lit(k)) for k, t in sorted(config.items())]
    return F.array_sort(F.array_compact(F.array(*each)))


def tag(df: DataFrame, config: dict[str, dict], column: str = "labels", drop_unlabelled: bool = False) -> DataFrame:
    """With the labels of each record; labels it has stay. Trees with files want `prepare` before."""
    own = labels(config)
    if column in df.columns:
        own = F.array_distinct(F.concat(F.coalesce(F.col(column), F.array().cast("array<string>")), own))
    out = df.withColumn(column, own)
    return out.filter(F.size(column) > 0) if drop_unlabelled else out


class Tree(dict):
    """A filter built in code: `Tree.source("1") & ~Tree.any()`; it is the dictionary that compile_tree takes."""

    def __and__(self, other: "Tree") -> "Tree":
        return Tree({"and": [self, other]})

    def __or__(self, other: "Tree") -> "Tree":
        return Tree({"or": [self, other]})

    def __invert__(self) -> "Tree":
        return Tree({"not": self})

    @staticmethod
    def any() -> "Tree":
        return Tree({"any": {}})

    @staticmethod
    def all_of(*trees: "Tree") -> "Tree":
        return Tree({"and": [*trees]})

    @staticmethod
    def one_of(*trees: "Tree") -> "Tree":
        return Tree({"or": [*trees]})

    @staticmethod
    def holdings(*names: str, by_title: bool = False) -> "Tree":
        urls = [n for n in names if n.startswith(("http://", "https://"))]
        files = [n for n in names if n not in urls]
        return Tree({"holdings": {k: v for k, v in (("files", files), ("urls", urls), ("compare-by-title", by_title)) if v}})

    def to_json(self) -> str:
        """Canonical: keys in order, no space."""
        return json.dumps(self, sort_keys=True, separators=(",", ":"), ensure_ascii=False)

    @staticmethod
    def from_json(text: str) -> "Tree":
        """Checks names on the way."""

        def read(x) -> "Tree":
            name, arg = _only(x)
            if name in ("and", "or"):
                return Tree({name: [read(c) for c in arg]})
            if name == "not":
                return Tree({name: read(arg)})
            if name not in LEAVES:
                raise ValueError(f"unknown filter: {name}")
            return Tree({name: arg})

        return read(json.loads(text))


def _constructor(name: str, listed: bool):
    def make(*values: str) -> Tree:
        return Tree({name: {"list": [*values]} if listed else [*values]})

    return staticmethod(make)


for _name in ("source", "collection", "package", "subject"):
    setattr(Tree, _name, _constructor(_name, False))
for _name in ("doi", "issn", "isbn"):
    setattr(Tree, _name, _constructor(_name, True))


def config_json(config: dict[str, Tree]) -> str:
    return json.dumps(config, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def config_rows(collections: DataFrame) -> DataFrame:
    """isil, source and the collection's columns: a row for each site that selects a collection; collections without a
    source number (sid-N-…) go."""
    source = F.regexp_extract("collectionId", r"^sid-(\d+)-", 1)
    return collections.withColumn("source", source).filter("source <> ''").withColumn("isil", F.explode("selectedBy"))


def config_of(collections: DataFrame, files_at: str) -> dict[str, Tree]:
    """Filter trees by site, from collections (id, collectionId, selectedBy, contentFiles, solrMegaCollections,
    filteredBy): any of its collections, each by source, by content files and the site's own filter files, or by
    names where there are none. The configuration is small and lives on the driver."""
    empty = F.array().cast("array<string>")
    rows = config_rows(collections).select("isil", "id", "source", F.coalesce("contentFiles", empty).alias("files"), F.coalesce("solrMegaCollections", empty).alias("names"), F.filter("filteredBy", lambda f: f["isil"] == F.col("isil")).alias("filters"))
    out: dict[str, list[Tree]] = {}
    for r in rows.orderBy("isil", "id").toLocalIterator():
        parts = [Tree({"source": [r.source]})]
        if r["files"]:
            parts.append(Tree({"holdings": {"urls": list(r["files"])}}))
        for f in r["filters"] or []:
            for x in f["filterFiles"] or []:
                url, label = f"{files_at}/{x['fileId']}", (f["label"] or "").lower()
                serials = "issn" in label and "holdings" not in label and "ezb" not in label
                parts.append(Tree({"issn": {"url": url}}) if serials else Tree({"holdings": {"urls": [url]}}))
        if len(parts) == 1 and r["names"]:
            parts.append(Tree({"collection": list(r["names"])}))
        out.setdefault(r.isil, []).append(parts[0] if len(parts) == 1 else Tree.all_of(*parts))
    return {isil: trees[0] if len(trees) == 1 else Tree.one_of(*trees) for isil, trees in out.items()}
