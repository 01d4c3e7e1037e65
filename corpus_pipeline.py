"""Corpus pipeline: quality, toxicity, near duplicates, mixing by source, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
documents (and any further ones, whatever their names). Rows are never sampled or capped. Stages are written as Parquet and
read again.

In every stage: null and empty texts are texts without words and stay, as long as a label-free score keeps them; very long
texts are read whole; rows that are the same are rows each, but for near duplicates, which keep one; null doc_ids and
sources are values like others; ties are broken by doc_id and text, so that reruns agree; an empty table gives an empty
table.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quire.llm.common import pieces, shingle_sets, stash, table
from quire.llm.mixing import mix_sources
from quire.llm.near_join import _fingerprint, groups
from quire.llm.packing import pack
from quire.llm.quality_knn import score_quality
from quire.llm.queries import tokenizer_path
from quire.llm.toxicity_fst import score_toxicity


def _free(name: str, docs: DataFrame) -> str:
    """A name that no column has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as 1. Without labels of both kinds all stay."""
    return score_quality(spark, docs, table(spark, sf_dir, "labels"), keep=1)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar predicts as 0. Texts without words stay."""
    return score_toxicity(spark, docs, table(spark, sf_dir, "labels"), keep=0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that of the smallest doc_id (null is last), then of the smallest set of shingles and text.
    Rows without words are groups of their own; of those that are the same in doc_id and text one stays, all if it is null."""
    node, place = _free("node", docs), _free("place", docs)
    bare = F.trim(F.translate(F.coalesce("text", F.lit("")), "\t\n\x0b\x0c\r", "     ")) == ""
    alone = docs.filter(bare & F.col("doc_id").isNull())
    repeated = docs.filter(bare & F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "text"])
    written = docs.filter(~bare)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("first")
    kept = stash(spark, groups(spark, written.select("doc_id", "text")).groupBy("root").agg(first).select("first.doc_id", "first.node"), "kept")
    marked = written.mapInArrow(_with_node(node), StructType([*written.schema.fields, StructField(node, LongType())])).alias("m")
    k = kept.alias("k")
    own = marked.join(k, F.col("m.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col(f"m.{node}") == F.col("k.node")), "left_semi")
    rank = F.row_number().over(W.partitionBy("doc_id", node).orderBy(F.xxhash64("text"), "text"))
    own = own.withColumn(place, rank).filter(F.col(place) == 1)
    return own.select(*docs.columns).unionByName(repeated).unionByName(alone)


def _with_node(name: str):
    """The rows with the value of their set of shingles."""

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                node = pa.array([_fingerprint(s) for s in shingle_sets(part.column("text"))], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, node], names=[*part.schema.names, name])

    return run


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: whole, or its first words; n_chars follows the text. Documents without words
    stay once. Rows that are the same in all columns are taken together: what the mix takes of them is given as one row's
    repeats."""
    whole = docs.select("doc_id", "source", "text", F.xxhash64(*docs.columns).alias("row"), F.struct(*docs.columns).alias("d"))
    taken = mix_sources(spark, whole, carry=["row"]).groupBy("row").agg(F.sum("taken").alias("taken"), F.count("*").alias("copies"), F.max("size").alias("words"))
    d = whole.select("row", "d").dropDuplicates(["row"]).join(taken, "row")
    laps = F.ceil(F.col("taken") / F.greatest("words", F.lit(1))).cast("int")
    count = F.when(F.col("words") == 0, F.col("copies").cast("int")).otherwise(laps)
    d = d.withColumn("lap", F.explode(F.when(count > 0, F.sequence(F.lit(1), count))))
    part = F.least(F.col("words"), F.col("taken") - (F.col("lap") - 1) * F.col("words")).cast("int")
    words = F.split(F.trim(F.translate(F.col("d.text"), "\t\n\x0b\x0c\r", "     ")), " +")
    text = F.when((F.col("words") == 0) | (F.col("words") == part), F.col("d.text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.greatest(part, F.lit(1))), " "))
    d = d.select("d", text.alias("t"))
    n_chars = F.when(F.col("d.n_chars").isNotNull(), F.length("t").cast("long"))
    return d.select(*[F.col("t").alias(c) if c == "text" else n_chars.alias(c) if c == "n_chars" else F.col("d")[c].alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in windows."""
    return pack(spark, docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("mixing", mix),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(spark, docs, "stage-" + name.replace(" ", "-"))
    return docs


#: Learned classifiers and tokenizers are beyond SQL.
ORACLE_SQL = None
