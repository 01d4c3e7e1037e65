"""Harvest sources: paged interfaces as Spark data sources, one partition for each date window, and small configuration
clients on the driver. What fetches a URL is a function, so that tests need no network."""

from __future__ import annotations

import datetime as dt
import json
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Messages that may be missing at the end of a window, as a share of all: a fixed value.
MISSING = 0.1


def get(url: str, headers: dict[str, str] | None = None, data: bytes | None = None) -> tuple[bytes, dict[str, str]]:
    with urllib.request.urlopen(urllib.request.Request(url, data=data, headers=headers or {}), timeout=60) as r:
        return r.read(), dict(r.headers)


def windows(start: dt.date, end: dt.date, days: int = 1) -> list[tuple[dt.date, dt.date]]:
    """Windows of whole days from start up to end, both included."""
    out = []
    while start <= end:
        last = min(end, start + dt.timedelta(days=days - 1))
        out.append((start, last))
        start = last + dt.timedelta(days=1)
    return out


def cursor_pages(base: str, query: dict[str, str], fetch: Callable = get, retries: int = 3) -> Iterator[dict]:
    """Items of all pages of a cursor interface. A page that fails is asked for again; an empty page ends the window if at
    most MISSING of all items are missing, else it is an error."""
    seen, failed, vs = 0, 0, dict(query) | {"cursor": "*"}
    while True:
        try:
            body = json.loads(fetch(f"{base}?{urllib.parse.urlencode(vs)}")[0])
        except (OSError, ValueError):
            failed += 1
            if failed > retries:
                raise
            continue
        if body.get("status") != "ok":
            raise RuntimeError(f"interface failed: {body.get('status')}")
        message = body["message"]
        items, total = message.get("items") or [], message.get("total-results", 0)
        seen, failed = seen + len(items), 0
        yield from items
        vs = {k: v for k, v in vs.items() if k == "mailto"} | {"cursor": message.get("next-cursor") or ""}
        if seen >= total or not vs["cursor"]:
            return
        if not items:
            if total - seen < MISSING * total:
                return
            raise RuntimeError(f"no more messages; total: {total}, seen: {seen}")


def offset_pages(base: str, query: dict[str, str], rows: int = 1000, fetch: Callable = get) -> Iterator[dict]:
    """Items of all pages of an offset interface."""
    offset = 0
    while True:
        body = json.loads(fetch(f"{base}?{urllib.parse.urlencode(query | {'offset': offset, 'rows': rows})}")[0])
        items = body["message"].get("items") or []
        yield from items
        offset += len(items)
        if not items or offset >= body["message"].get("total-results", 0):
            return


class _Window(InputPartition):
    def __init__(self, start: str, end: str):
        super().__init__((start, end))


class WindowedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self):
        o = self.options
        return [_Window(a.isoformat(), b.isoformat()) for a, b in windows(dt.date.fromisoformat(o["from"]), dt.date.fromisoformat(o["until"]), int(o.get("days", 1)))]

    def read(self, partition):
        start, end = partition.value
        o = self.options
        name = o.get("filter", "index")
        query = {"filter": f"from-{name}-date:{start},until-{name}-date:{end}", "rows": o.get("rows", "1000")}
        if o.get("mailto"):
            query["mailto"] = o["mailto"]
        for item in cursor_pages(o["url"], query):
            yield start, json.dumps(item, ensure_ascii=False, separators=(",", ":"))


class Windowed(DataSource):
    """`spark.read.format("windowed-rest").options(url=…, **{"from": …, "until": …})`: window, value (an item as JSON). A
    window is a partition; one that is lost is fetched again."""

    @classmethod
    def name(cls) -> str:
        return "windowed-rest"

    def schema(self) -> str:
        return "window string, value string"

    def reader(self, schema) -> DataSourceReader:
        return WindowedReader(dict(self.options))


def progress(items: DataFrame, totals: DataFrame) -> DataFrame:
    """window, seen, total of harvested items, with what the interface said (window, total)."""
    from pyspark.sql import functions as F

    return totals.join(items.groupBy("window").agg(F.count("*").alias("seen")), "window", "left").select("window", F.coalesce("seen", F.lit(0)).alias("seen"), "total")


class ConfigClient:
    """Collections and files of a configuration interface with a token."""

    def __init__(self, base: str, tenant: str, fetch: Callable = get):
        self.base, self.tenant, self.fetch, self.token = base.rstrip("/"), tenant, fetch, ""

    def login(self, user: str, password: str) -> None:
        body = json.dumps({"username": user, "password": password}).encode()
        _, headers = self.fetch(f"{self.base}/bl-users/login", {"Accept": "application/json", "Content-Type": "application/json", "X-Okapi-Tenant": self.tenant}, body)
        self.token = {k.lower(): v for k, v in headers.items()}.get("x-okapi-token", "")
        if not self.token:
            raise PermissionError("no token")

    def _get(self, path: str) -> bytes:
        return self.fetch(f"{self.base}{path}", {"Accept": "application/json", "X-Okapi-Tenant": self.tenant, "X-Okapi-Token": self.token})[0]

    def collections(self, spark: SparkSession, query: str, limit: int = 100_000) -> DataFrame:
        """id, label, collectionId, contentFiles, solrMegaCollections, selectedBy, filteredBy."""
        schema = "id string, label string, collectionId string, contentFiles array<string>, solrMegaCollections array<string>, selectedBy array<string>, filteredBy array<struct<id:string,label:string,type:string,isil:string,filterFiles:array<struct<label:string,fileId:string>>>>"
        names = [p.strip().split(" ")[0] for p in "id, label, collectionId, contentFiles, solrMegaCollections, selectedBy, filteredBy".split(",")]
        got = json.loads(self._get("/finc-config/metadata-collections?" + urllib.parse.urlencode({"query": query, "limit": limit, "includeFilteredBy": "true"})))["fincConfigMetadataCollections"]

        def shaped(c: dict) -> tuple:
            filters = [(f.get("id"), f.get("label"), f.get("type"), f.get("isil"), [(x.get("label"), x.get("fileId")) for x in f.get("filterFiles") or []]) for f in c.get("filteredBy") or []]
            return (*[c.get(n) for n in names[:-1]], filters)

        return spark.createDataFrame([shaped(c) for c in got], schema)

    def file(self, file_id: str) -> bytes:
        return self._get(f"/finc-config/files/{urllib.parse.quote(file_id)}")


#: Kinds of lists of the attachment interface: fixed values.
KINDS = ["metadata_usage", "holdings_file_concat", "holdingsfiles", "contentfiles"]


def attachment_lists(spark: SparkSession, base: str, fetch: Callable = get) -> dict[str, DataFrame]:
    """The four lists as DataFrames of texts, by kind."""
    out = {}
    for kind in KINDS:
        rows = json.loads(fetch(f"{base}/outboundservices/list?do={kind}")[0])
        names = sorted({k for r in rows for k in r}) or ["value"]
        out[kind] = spark.createDataFrame([tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in rows], ", ".join(f"`{n}` string" for n in names))
    return out
