"""Labels of records against an index."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .lookups import preference


def droppable(records: DataFrame, index: DataFrame, preferred: list[str], ignore_same_id: bool = True) -> DataFrame:
    """(id, doi, source_id, label) of labels that a document of the index with the same DOI has from a source that is
    preferred at least as much. records: id, doi, source_id, labels; index: id, doi, source_id, institution. A semi-join by
    (doi, label); records without a DOI drop nothing."""
    doi = F.trim("doi")
    r = records.filter(doi != "").select("id", doi.alias("doi"), "source_id", F.explode(F.array_distinct("labels")).alias("label"), preference(F.col("source_id"), preferred).alias("place"))
    i = index.filter(doi != "").select(F.col("id").alias("other"), doi.alias("i_doi"), F.explode(F.array_distinct("institution")).alias("i_label"), preference(F.col("source_id"), preferred).alias("i_place"))
    met = (r.doi == i.i_doi) & (r.label == i.i_label) & (r.place >= i.i_place)
    return r.join(i, met & ~r.id.eqNullSafe(i.other) if ignore_same_id else met, "left_semi").select("id", "doi", "source_id", "label").distinct()


def drop_labels(records: DataFrame, index: DataFrame, preferred: list[str], ignore_same_id: bool = True, drop_unlabelled: bool = False) -> DataFrame:
    """Records without the labels that can be dropped; what is left keeps its order."""
    gone = droppable(records, index, preferred, ignore_same_id).groupBy("id", F.col("doi").alias("_doi"), F.col("source_id").alias("_sid")).agg(F.collect_set("label").alias("_gone")).withColumnRenamed("id", "_id")
    same = records.id.eqNullSafe(gone["_id"]) & (F.trim(records.doi) == gone["_doi"]) & records.source_id.eqNullSafe(gone["_sid"])
    out = records.join(gone, same, "left").withColumn("labels", F.when(F.col("_gone").isNull(), F.col("labels")).otherwise(F.filter("labels", lambda x: ~F.array_contains("_gone", x)))).select(*records.columns)
    return out.filter(F.size("labels") > 0) if drop_unlabelled else out
