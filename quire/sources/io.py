"""Readers and writers. Schemas are always given; compression follows the suffix."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir). Only a local session, as in tests, gets one of its own."""
    import re
    import tempfile

    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return at or "file://" + tempfile.mkdtemp(prefix="quire-shared-")


def ndjson(spark: SparkSession, paths, schema: T.StructType | str, mode: str = "PERMISSIVE") -> DataFrame:
    """Only the fields of the schema are parsed. mode: FAILFAST, DROPMALFORMED or PERMISSIVE."""
    return spark.read.schema(schema).option("mode", mode).json(paths)


def tsv(spark: SparkSession, paths, separator: str = "\t", comment: str | None = None) -> DataFrame:
    reader = spark.read.option("sep", separator).option("header", True).option("quote", "")
    return (reader.option("comment", comment) if comment else reader).csv(paths)


def csv(spark: SparkSession, paths) -> DataFrame:
    return spark.read.option("header", True).csv(paths)


def xml(spark: SparkSession, paths, row: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row).option("ignoreNamespace", True).schema(schema).load(paths)


def lines(spark: SparkSession, paths) -> DataFrame:
    """Distinct trimmed lines that are not empty."""
    return spark.read.text(paths).select(F.trim("value").alias("value")).filter("value <> ''").distinct()


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.option("ignoreNullFields", True).option("compression", "gzip").json(path)


def write_tsv(df: DataFrame, path: str, separator: str = "\t") -> None:
    df.select(F.concat_ws(separator, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])).write.text(path)


def freeze(config: dict, files: dict[str, bytes], to: str) -> None:
    """A configuration and the files it names by URL, in one archive."""
    import hashlib
    import json

    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        names = {url: "files/" + hashlib.sha1(url.encode()).hexdigest() for url in files}
        z.writestr("blob", json.dumps(config))
        z.writestr("mapping.json", json.dumps(names))
        for url, data in files.items():
            z.writestr(names[url], data)


def unfreeze(archive: str, folder: str) -> dict:
    """The configuration, URLs replaced by files of the folder."""
    import json

    with zipfile.ZipFile(archive) as z:
        z.extractall(folder)
        mapping = json.loads(z.read("mapping.json"))
        config = json.loads(z.read("blob"))

    def swap(x):
        if isinstance(x, dict):
            return {k: swap(v) for k, v in x.items()}
        if isinstance(x, list):
            return [swap(v) for v in x]
        return (Path(folder) / mapping[x]).as_uri() if isinstance(x, str) and x in mapping else x

    return swap(config)


#: Columns of a holdings file: fixed values.
KBART = """publication_title print_identifier online_identifier date_first_issue_online num_first_vol_online num_first_issue_online date_last_issue_online num_last_vol_online num_last_issue_online title_url
first_author title_id embargo_info coverage_depth coverage_notes publisher_name own_anchor package:collection il_relevance il_nationwide il_electronic_transmission il_comment all_issns zdb_id location title_notes
staff_notes vendor_id oclc_collection_name oclc_collection_id oclc_entry_id oclc_link_scheme oclc_number ACTION""".split()


def by_header(df: DataFrame, columns: dict[str, str] | list[str]) -> DataFrame:
    """The named columns as texts, null where the header lacks them; others go. A dictionary gives names by header; two names
    may share one."""
    wanted = columns if isinstance(columns, dict) else {c: c for c in columns}
    return df.select(*[(F.col(f"`{h}`").cast("string") if h in df.columns else F.lit(None).cast("string")).alias(n) for n, h in wanted.items()])


def kbart(spark: SparkSession, paths) -> DataFrame:
    """Holdings rows: tab separated, with a header, all texts; empty where a column is missing."""
    rows = by_header(tsv(spark, paths), KBART)
    return rows.select(*[F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in KBART])


def xml_records(spark: SparkSession, paths, row: str, schema: T.StructType | str, charset: str = "UTF-8") -> DataFrame:
    """As xml(), for other character sets; malformed records are left out. The XML reader splits files of UTF-8; files of
    other character sets are decoded whole, and their records (which do not nest) parsed each."""
    options = {"rowTag": row, "ignoreNamespace": "true", "mode": "DROPMALFORMED"}
    if charset.upper().replace("-", "") == "UTF8":
        return spark.read.format("xml").options(**options).schema(schema).load(paths)
    content = spark.read.format("binaryFile").load(paths).select(F.decode("content", charset).alias("text"))
    records = content.select(F.explode(F.regexp_extract_all("text", F.lit(rf"(?s)<(?:\w+:)?{row}(?:\s[^>]*)?>.*?</(?:\w+:)?{row}\s*>"), F.lit(0))).alias("value"))
    return records.select(F.from_xml("value", schema, {"ignoreNamespace": "true"}).alias("r")).filter("r is not null").select("r.*")


def whole_texts(spark: SparkSession, paths) -> DataFrame:
    """`value`: a row for each file."""
    return spark.read.text(paths, wholetext=True)


def concatenated(spark: SparkSession, paths: list[str], read) -> DataFrame:
    """All inputs as one: read(spark, path) of each, by name."""
    from functools import reduce

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [read(spark, p) for p in paths])


def plain_file(path: str, folder: str) -> str:
    """The path of what a file holds: the parts of a zip archive joined in `folder`, or the file as it is."""
    if not zipfile.is_zipfile(path):
        return path
    to = Path(folder) / (Path(path).stem + ".txt")
    with zipfile.ZipFile(path) as z, atomic(str(to)) as out:
        for name in sorted(z.namelist()):
            if not name.endswith("/"):
                with z.open(name) as part:
                    import shutil

                    shutil.copyfileobj(part, out)
    return str(to)


def atomic(path: str):
    """A binary file that is there only when it is whole: written beside and renamed at the end."""
    import contextlib
    import os
    import tempfile

    @contextlib.contextmanager
    def opened():
        handle, beside = tempfile.mkstemp(dir=os.path.dirname(path) or ".", prefix="." + os.path.basename(path))
        try:
            with os.fdopen(handle, "wb") as out:
                yield out
            os.replace(beside, path)
        except BaseException:
            with contextlib.suppress(OSError):
                os.remove(beside)
            raise

    return opened()


def cached(path: str, fetch, ttl_seconds: float = 0, force: bool = False) -> str:
    """`path`, written by fetch(path) unless it is there and young enough (any age without a time to live)."""
    import os
    import time

    fresh = os.path.exists(path) and (ttl_seconds <= 0 or time.time() - os.path.getmtime(path) < ttl_seconds)
    if force or not fresh:
        fetch(path)
    return path


def tar_members(spark: SparkSession, paths, ends: dict[str, str]) -> DataFrame:
    """shipment (the archive's path), kind, value: the members of tar archives whose names end in `ends[kind]`. An archive is
    read by one task, member by member."""
    return members_of(spark.read.format("binaryFile").load(paths).select("path", "content"), ends)


def members_of(files: DataFrame, ends: dict[str, str]) -> DataFrame:
    """As tar_members, of archives as rows (path, content)."""
    import io as bytes_io
    import tarfile

    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with tarfile.open(fileobj=bytes_io.BytesIO(content.as_buffer())) as tar:
                    for member in tar:
                        kind = next((k for k, e in ends.items() if member.isfile() and member.name.endswith(e)), None)
                        if kind:
                            text = tar.extractfile(member).read().decode("utf-8", "replace")
                            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([kind]), pa.array([text])], names=["shipment", "kind", "value"])

    return files.mapInArrow(run, "shipment string, kind string, value string")


def shipments(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Datasets, issues and articles of tar shipments, for the crosswalk `shipment`."""
    from .formats import SCHEMAS

    members = tar_members(spark, paths, {"article": "main.xml", "issue": "issue.xml", "dataset": "dataset.xml"})
    parsed = lambda kind: members.filter(F.col("kind") == kind).select("shipment", F.from_xml("value", SCHEMAS[f"shipment-{kind}"], {"ignoreNamespace": "true"}).alias("x")).select("shipment", "x.*")
    return parsed("dataset"), parsed("issue"), parsed("article")


def page(df: DataFrame, query=None, order: list | None = None, offset: int = 0, rows: int = 10, fields: list[str] | None = None) -> DataFrame:
    """A page of a search: filtered, ordered, from offset on, the given fields."""
    out = df if query is None else df.filter(query)
    out = out.orderBy(*order) if order else out
    out = out.offset(offset).limit(rows)
    return out.select(*fields) if fields else out


def write_sqlite(df: DataFrame, path: str, table: str, indexed: list[str], batch: int = 10_000) -> int:
    """Rows to a table of a new SQLite file with an index on each of the columns, in one transaction; gives their number.
    For small results: rows go through the driver, partition by partition."""
    import os
    import sqlite3

    quote = lambda name: '"' + name.replace('"', '""') + '"'
    beside, n = path + ".part", 0
    if os.path.exists(beside):
        os.remove(beside)
    with sqlite3.connect(beside) as db:
        db.execute(f"create table {quote(table)} ({', '.join(f'{quote(c)} text' for c in df.columns)})")
        rows = []
        for row in df.select(*[F.col(f"`{c}`").cast("string") for c in df.columns]).toLocalIterator():
            rows.append(tuple(row))
            n += 1
            if len(rows) >= batch:
                db.executemany(f"insert into {quote(table)} values ({', '.join('?' * len(df.columns))})", rows)
                rows = []
        if rows:
            db.executemany(f"insert into {quote(table)} values ({', '.join('?' * len(df.columns))})", rows)
        for c in indexed:
            db.execute(f"create index {quote(table + '_' + c)} on {quote(table)} ({quote(c)})")
    db.close()
    os.replace(beside, path)
    return n


def aligned(df: DataFrame, gap: int = 2) -> str:
    """A small result as columns of equal width."""
    rows = [df.columns, *[["" if v is None else str(v) for v in r] for r in df.collect()]]
    widths = [max(len(r[i]) for r in rows) for i in range(len(df.columns))]
    return "\n".join((" " * gap).join(v.ljust(w) for v, w in zip(r, widths, strict=True)).rstrip() for r in rows) + "\n"


def textile(df: DataFrame, percent: str | None = None, most: float = 5.0) -> str:
    """A small result as a Textile table; shares of the `percent` column beyond `most` are set bold."""

    def cell(name, v) -> str:
        if name == percent and v is not None:
            return f"*{v:.2f}*" if abs(v) > most else f"{v:.2f}"
        return "" if v is None else str(v)

    head = "|" + "".join(f"_. {c} |" for c in df.columns)
    return "\n".join([head, *["| " + " | ".join(cell(c, r[c]) for c in df.columns) + " |" for r in df.collect()]]) + "\n"


def write_counts(counts: DataFrame, path: str) -> None:
    """An aggregate to compare with later."""
    counts.write.mode("overwrite").parquet(path)


def counts_of(spark: SparkSession, path: str, count) -> DataFrame:
    """Counts as written before, or count(records) of a file of JSON lines: told by what the path holds."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    dumped = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))
    return spark.read.parquet(path) if dumped else count(path)
