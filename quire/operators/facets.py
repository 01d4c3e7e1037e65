"""Counts by value, pivots, comparisons, ratios and quality rules over records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import percent_change


def build_query(equal: dict | None = None, at_least: dict | None = None, at_most: dict | None = None, raw: str | None = None) -> Column:
    """A conjunction of equalities and ranges; raw SQL takes precedence; nothing matches all."""
    if raw:
        return F.expr(raw)
    parts = [F.col(k) == v for k, v in (equal or {}).items()]
    parts += [F.col(k) >= v for k, v in (at_least or {}).items()] + [F.col(k) <= v for k, v in (at_most or {}).items()]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def facet(df: DataFrame, field: str, query: Column | None = None, least: int = 1) -> DataFrame:
    """value, n of a field's values, exploded if it is an array; with least: HAVING."""
    df = df if query is None else df.filter(query)
    many = dict(df.dtypes)[field].startswith("array")
    values = df.select((F.explode(field) if many else F.col(field)).alias("value"))
    counts = values.groupBy("value").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= least) if least > 1 else counts


def top_facet(counts: DataFrame, k: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), "value").limit(k)


def nested_pivot(df: DataFrame, keys: list[str], inner: str) -> DataFrame:
    """keys, size and a map inner value -> count, as sorted entries: two aggregations, the first one combined map-side."""
    fine = df.groupBy(*keys, inner).agg(F.count("*").alias("n"))
    return fine.groupBy(*keys).agg(F.sum("n").alias("size"), F.sort_array(F.collect_list(F.struct(F.col(inner).alias("k"), F.col("n").alias("v")))).alias("entries"))


def compare(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_before, n_after, diff, pct of two sets of records, where either has some."""
    a = before.groupBy(*keys).agg(F.count("*").alias("n_before"))
    b = after.groupBy(*keys).agg(F.count("*").alias("n_after"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    both = a.join(b, keys, "full_outer").select(*keys, zero("n_before"), zero("n_after"))
    return both.withColumn("diff", F.col("n_after") - F.col("n_before")).withColumn("pct", percent_change(F.col("n_before"), F.col("n_after")))


def compare_indexes(live: DataFrame, other: DataFrame) -> DataFrame:
    """institution, source_id, n_before (live), n_after, diff, pct of two indexes (institution: array, source_id), for
    institutions and sources that the other index has; blank institutions are left out."""
    each = lambda df: df.select(F.explode(F.array_distinct("institution")).alias("institution"), "source_id")
    blank = F.trim(F.translate("institution", '"', " ")) == ""
    a, b = each(live).filter(~blank), each(other).filter(~blank)
    pairs = compare(a, b, ["institution", "source_id"])
    return pairs.join(b.select("institution").distinct(), "institution", "left_semi").join(other.select("source_id").distinct(), "source_id", "left_semi")


def compare_file(records: DataFrame, index: DataFrame, every: bool = False, empty: bool = False, source: str | None = None) -> DataFrame:
    """institution, n_index, n_file, diff, pct by institution (an array in both) of a file's records against an index (of one
    source only, if given). every: also institutions that only the index has; empty: also those with no records in both."""
    index = index if source is None else index.filter(F.col("source_id") == source)
    count = lambda df, name: df.select(F.explode("institution").alias("institution")).filter(F.trim("institution") != "").groupBy("institution").agg(F.count("*").alias(name))
    both = count(records, "n_file").join(count(index, "n_index"), "institution", "full_outer" if every else "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = both.select("institution", zero("n_index"), zero("n_file"))
    out = out if empty else out.filter("n_index + n_file > 0")
    return out.withColumn("diff", F.col("n_file") - F.col("n_index")).withColumn("pct", percent_change(F.col("n_index"), F.col("n_file")))


def distinct_values(df: DataFrame, field: str) -> DataFrame:
    """value: distinct values of a field, exploded if it is an array."""
    return facet(df, field).select("value")


def collections_by_source(df: DataFrame, source: str, collections: str) -> DataFrame:
    """Sources and their collections, once each, in order; collections may be an array."""
    many = dict(df.dtypes)[collections].startswith("array")
    return df.select(source, (F.explode(collections) if many else F.col(collections)).alias("collection")).distinct().orderBy(source, "collection")


def pivot_counts(df: DataFrame, keys: list[str], column: Column, values: list, prefix: str = "") -> DataFrame:
    """keys and a count for each of the given values of a column, 0 where there is none."""
    named = df.withColumn("_pivot", F.concat(F.lit(prefix), column.cast("string")))
    return named.groupBy(*keys).pivot("_pivot", [f"{prefix}{v}" for v in values]).agg(F.count(F.lit(1))).na.fill(0)


def value_sets(df: DataFrame, key: str, value: str) -> DataFrame:
    """key and the sorted distinct values that go with it."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("values"))


def has_and_missing(df: DataFrame, field: str, query: Column | None = None) -> DataFrame:
    """has, missing: rows (that a query keeps, if given) with and without a value in a text or array field."""
    df = df if query is None else df.filter(query)
    c = F.col(field)
    has = F.coalesce(F.size(c) > 0 if dict(df.dtypes)[field].startswith("array") else c.isNotNull() & (c.cast("string") != ""), F.lit(False))
    return df.agg(F.count_if(has).alias("has"), F.count_if(~has).alias("missing"))


def coverage_ratio(held: DataFrame, indexed: DataFrame, key: str) -> DataFrame:
    """Sizes of two key sets, of their intersection and difference, and the share covered: one pass over their union."""
    h = held.select(key, F.lit(1).alias("h"), F.lit(0).alias("i"))
    i = indexed.select(key, F.lit(0).alias("h"), F.lit(1).alias("i"))
    per = h.union(i).groupBy(key).agg(F.max("h").alias("h"), F.max("i").alias("i"))
    s = per.agg(F.sum("h").alias("held"), F.sum("i").alias("indexed"), F.sum(F.col("h") * F.col("i")).alias("both"), F.sum(F.col("h") * (1 - F.col("i"))).alias("missing"))
    return s.withColumn("ratio", F.round(F.col("both") / F.col("held"), 4))


def review(df: DataFrame, rules: list[tuple], fail_on_empty: bool = False) -> DataFrame:
    """rule, ok, got of quality rules (name, kind, condition, field, values, threshold) over one scan: each row is given once
    for each rule it meets, and counted by (rule, value). fail_on_empty: rules whose condition keeps nothing fail."""
    kinds = {"allowed-keys", "equal-size-non-zero", "equal-size-total", "min-ratio", "min-count"}
    if bad := [r[1] for r in rules if r[1] not in kinds]:
        raise ValueError(f"unknown rule: {bad[0]}")
    many = {n for n, t in df.dtypes if t.startswith("array")}
    met = [F.when(F.expr(cond), F.struct(F.lit(k).alias("k"), (F.col(field) if field in many else F.array(F.col(field).cast("string"))).alias("values"))) for k, (_, _, cond, field, _, _) in enumerate(rules)]
    rows = df.select(F.explode(F.array_compact(F.array(*met))).alias("m"))
    counts = rows.select("m.k", F.explode("m.values").alias("value")).groupBy("k", "value").agg(F.count("*").alias("n"))
    parts = []
    for k, (_, kind, _, _, values, threshold) in enumerate(rules):
        mine = F.col("k") == k
        total = F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0))
        of = [F.coalesce(F.max(F.when(mine & (F.col("value") == str(v)), F.col("n"))), F.lit(0)) for v in values]
        seen = reduce(lambda a, b: a & b, [F.max(F.when(mine & (F.col("value") == str(v)), F.lit(1))).isNotNull() for v in values], F.lit(True))
        same = reduce(lambda a, b: a & b, [x == of[0] for x in of], F.lit(True)) if of else F.lit(True)
        got = of[0] if of else F.lit(0)
        if kind == "allowed-keys":
            got = F.coalesce(F.sum(F.when(mine & ~F.col("value").isin(*map(str, values)), F.lit(1))), F.lit(0))
            ok = got == 0
        elif kind == "equal-size-non-zero":
            ok = seen & same
        elif kind == "equal-size-total":
            ok = seen & same & (of[0] == total)
        elif kind == "min-ratio":
            ok = seen & (100 * of[0] >= threshold * total)
        else:
            ok = seen & (of[0] >= threshold)
        if fail_on_empty:
            ok = ok & (total > 0)
        parts.append(F.struct(F.lit(rules[k][0]).alias("rule"), F.coalesce(ok, F.lit(False)).alias("ok"), got.cast("long").alias("got")))
    return counts.agg(F.array(*parts).alias("r")).select(F.explode("r").alias("r")).select("r.rule", "r.ok", "r.got")
