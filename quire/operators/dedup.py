"""Keep one row of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def keep_latest(df: DataFrame, keys: list[str], version: str, ties: list[Column]) -> DataFrame:
    """The row of the greatest version of each key (not null, not empty); ties by order. A group limit runs before the
    shuffle, so that a task sends one row of a key."""
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    w = W.partitionBy(*keys).orderBy(F.col(version).desc_nulls_last(), *ties)
    return df.filter(ok).withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def compact(df: DataFrame, keys: list[str], by: list[Column]) -> DataFrame:
    """The first row of each key in an order: first, last, min and max are orders of input position or value."""
    return df.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(*by))).filter("_k = 1").drop("_k")


def exclude(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    return df.join(ids, on, "left_anti")


def priority_drop(df: DataFrame, key: str, ranked: str, preferred: list, ident: str) -> DataFrame:
    """Of rows with one key, the one whose value comes first in the preferred list; unknown values come last."""
    at = F.array_position(F.array(*map(F.lit, preferred)), F.col(ranked))
    rank = F.when(at > 0, at).otherwise(F.lit(9999))
    return compact(df.withColumn("_rank", rank), [key], [F.col("_rank"), F.col(ident)]).drop("_rank")


def compact_random(df: DataFrame, keys: list[str], ident: list[str], seed: int = 1) -> DataFrame:
    """One row of each key, chosen by a seeded hash of what identifies it: the same in every run."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ident]))
    return compact(df, keys, [order, *[F.col(c) for c in ident]])


def compact_by_json(lines: DataFrame, key: str, by: str | None = None, largest: bool = True) -> DataFrame:
    """`value`: one JSON line of each raw key (so that 1 and "1" are two), by the greatest or least of another path, ties to
    the smaller text. Lines without the key or path are errors."""
    raw = lambda path: F.to_json(F.try_variant_get(F.try_parse_json("value"), path, "variant"))
    checked = lambda path: F.coalesce(raw(path), F.raise_error(F.concat(F.lit(f"no {path}: "), F.col("value"))).cast("string"))
    df = lines.withColumn("_key", checked(key))
    order = [F.col("value")]
    if by:
        value = checked(by)
        number = value.try_cast("double")
        order = [(number.desc_nulls_last() if largest else number.asc_nulls_last()), (value.desc() if largest else value.asc()), *order]
    return compact(df, ["_key"], order).select("value")


def batches(df: DataFrame, order: list[Column], size: int) -> DataFrame:
    """With `batch`: numbers of runs of `size` rows in an order, the last one shorter. For lists of keys that go to a service,
    which one task can number."""
    return df.withColumn("batch", F.floor((F.row_number().over(W.orderBy(*order)) - 1) / size))


def sample_of(df: DataFrame, condition: Column, ident: str, n: int = 1, seed: int = 1) -> DataFrame:
    """n rows that meet a condition, by a seeded hash of their id."""
    return df.filter(condition).orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(ident).cast("string"))), ident).limit(n)
