"""Incremental runs: keep-latest tables, stateless maps and ingest by file. Every run takes what is new and stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.dedup import keep_latest

#: Parts of a keep-latest table: a batch rewrites those that its keys fall into.
PARTS = 64


def merge_latest(stream: DataFrame, table: str, keys: list[str], version: str, tie: str, checkpoint: str, parts: int = PARTS):
    """Run over what is new and stop. The table is dealt into parts by a hash of the keys; a batch writes new states of the
    parts it touches, a part's last state counts, and the state before it is kept for a batch that runs again; older ones
    go. An older version that comes late replaces nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
        new = batch.withColumn("part", part).persist()
        touched = [r.part for r in new.select("part").distinct().collect()]  # `parts` rows at most
        if touched:
            old = _states(spark, table, touched, below=number)
            rows = new if old is None else old.unionByName(new)
            kept = keep_latest(rows, keys, version, [F.col(tie).desc()])
            kept.repartition(len(touched), "part").write.mode("overwrite").partitionBy("part").parquet(f"{table}/state={number:012d}")
            _expire(spark, table, number)
        new.unpersist()

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _parts(spark: SparkSession, table: str) -> dict[int, list[str]]:
    """Folders of the whole states of each part, from old to new."""
    fs, at = _fs(spark, table)
    out: dict[int, list[str]] = {}
    for s in sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []:
        if s.startswith("state=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{s}/_SUCCESS")):
            for x in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{s}")):
                if x.getPath().getName().startswith("part="):
                    out.setdefault(int(x.getPath().getName()[5:]), []).append(f"{table}/{s}/{x.getPath().getName()}")
    return out


def _number(folder: str) -> int:
    return int(folder.split("state=")[-1].split("/")[0])


def _states(spark: SparkSession, table: str, wanted: list[int] | None = None, below: int | None = None) -> DataFrame | None:
    every = _parts(spark, table)
    last = {p: [s for s in ss if below is None or _number(s) < below] for p, ss in every.items() if wanted is None or p in wanted}
    paths = [(p, ss[-1]) for p, ss in last.items() if ss]
    if not paths:
        return None
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/part=(\d+)/", 1).cast("int")
    df = spark.read.parquet(*[s for _, s in paths])
    return df.withColumn("part", number)


def _expire(spark: SparkSession, table: str, number: int) -> None:
    """Deletes a part's states but the last two."""
    fs, _ = _fs(spark, table)
    for states in _parts(spark, table).values():
        for s in states[:-2]:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(s), True)


def current(spark: SparkSession, table: str) -> DataFrame | None:
    """The last state of each part."""
    df = _states(spark, table)
    return None if df is None else df.drop("part")


def map_stream(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], to: str, checkpoint: str, form: str = "parquet"):
    """A stateless map over new files: the same transformation as on a table; appends and stops."""
    return transform(stream).writeStream.format(form).option("path", to).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def ingest_by_file(spark: SparkSession, schema, path: str, to: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None):
    """What each new file gives, written once under its name and size (`file`, `bytes`): a file that was taken is not read
    again."""
    stream = spark.readStream.schema(schema).json(path)
    named = stream.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return map_stream(named, transform or (lambda df: df), to, checkpoint)


def windowed_counts(events: DataFrame, at: str, window: str, late: str, keys: list[str] | None = None) -> DataFrame:
    """Counts by tumbling windows of event time, with a watermark; an extension, for streams and tables."""
    df = events.withWatermark(at, late) if events.isStreaming else events
    return df.groupBy(F.window(at, window), *(keys or [])).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *(keys or []), "n")
