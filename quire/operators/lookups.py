"""Lookup joins: label updates, flags, list membership, references."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def update_labels(records: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """A matched record takes the update's value, also if that is empty; of several updates the last one (pos) counts."""
    last = updates.groupBy(key).agg(F.max_by("new", "pos").alias("new"), F.lit(True).alias("matched"))
    return records.join(last, key, "left").withColumn(column, F.when(F.col("matched"), F.col("new")).otherwise(F.col(column))).drop("new", "matched")


def members(df: DataFrame, column: str, separator: str, to: str) -> DataFrame:
    """One row for each trimmed, not empty part of a separated list."""
    parts = F.filter(F.transform(F.split(column, separator), lambda x: F.trim(x)), lambda x: x != "")
    return df.withColumn(to, F.explode(parts))


def flag(records: DataFrame, known: DataFrame, key: str, value: str, default: bool = False) -> DataFrame:
    return records.join(known, key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def first_match_join(left: DataFrame, right: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """Each left row with the value of the first right row (least pos) of its key, else null. The right side is
    aggregated before the join, so that a frequent key is one row."""
    first = right.groupBy(key).agg(F.min_by(value, pos).alias(value))
    return left.join(first, key, "left")


def conditional_match(left: DataFrame, right: DataFrame, key: str, needed) -> DataFrame:
    """`matched`: whether a row that needs a partner has one; rows that need none pass."""
    found = right.select(key).distinct().withColumn("found", F.lit(True))
    return left.join(found, key, "left").withColumn("matched", ~F.coalesce(needed, F.lit(False)) | F.col("found").isNotNull()).drop("found")


def preference(x, order: list[str], unknown: int = 9999):
    """The place of a value in a list, from 0."""
    at = F.array_position(F.array(*[F.lit(v) for v in order]), x)
    return F.when(at > 0, at - 1).otherwise(F.lit(unknown)).cast("bigint")


def last_match_join(left: DataFrame, right: DataFrame, keys: list[str], values: list[str], pos: str, flag: str = "matched") -> DataFrame:
    """Each left row with the values of the last right row (greatest pos) of its keys, and whether there is one."""
    last = right.groupBy(*keys).agg(F.max_by(F.struct(*values), pos).alias("_last"))
    out = left.join(last, keys, "left").withColumn(flag, F.col("_last").isNotNull())
    return out.select("*", *[F.col("_last")[v].alias(v) for v in values]).drop("_last")


def needed_partners(left: DataFrame, right: DataFrame, key: str, needed) -> tuple[DataFrame, DataFrame]:
    """Left rows joined with each partner where they need one (once, with nulls, where they do not), and those that need a
    partner and have none."""
    wants = F.coalesce(needed, F.lit(False))
    empty = [F.lit(None).cast(t).alias(n) for n, t in right.dtypes if n != key]
    joined = left.filter(wants).join(right, key).unionByName(left.filter(~wants).select("*", *empty))
    return joined, left.filter(wants).join(right.select(key).distinct(), key, "left_anti")


def fold_flags(records: DataFrame, known: DataFrame, ident: str, source: str, collections: str, start) -> DataFrame:
    """ident and `flag`: each record's flag after its collections in order: true ends it, false replaces what was there,
    an unknown collection leaves it. known: key (`source:collection`), free. start: the flag before."""
    keyed = records.select(ident, F.col(source).alias("_s"), start.alias("_start"), F.posexplode_outer(collections).alias("_at", "_c")).withColumn("key", F.concat_ws(":", "_s", "_c"))
    seen = keyed.join(known, "key", "left")
    first_true = F.max(F.coalesce(F.col("free"), F.lit(False)))
    any_known = F.count("free") > 0
    return seen.groupBy(ident).agg(F.when(first_true, True).when(any_known, False).otherwise(F.first("_start")).alias("flag"))


def classes_of(xs, table: dict[str, list[str]]):
    """All values that a one-to-many table has for the elements of a list, sorted."""
    known = F.create_map(*[v for k, vs in table.items() for v in (F.lit(k), F.array(*map(F.lit, vs)))])
    return F.array_sort(F.array_distinct(F.flatten(F.transform(xs, lambda x: F.coalesce(F.element_at(known, x), F.array().cast("array<string>"))))))
