"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources get targets by weight, capped at ``most`` times their own size; the excess is shared anew by weight until none is
above (the level is found in closed form, from the sources in order of cap / weight). Blocks of ``block`` words are
given to sources, and then within a source to its shards, by highest quotients v / (2a - 1). A shard takes its quota
from its documents in seeded order, all of them once before any is taken again.

Sizes are counts of `[^\\x20\\x09-\\x0D]+`; null and empty texts have size 0 and take 0. A null source is a source, the
last one. Repeated rows count each. An empty table gives no rows; further columns are ignored, and with total size 0
targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import stash

#: Weights of the sources in order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)


def word_count(text: str) -> Column:
    """Runs of characters that are not ASCII white space: an ASCII space ends each after white space is levelled."""
    spaced = F.trim(F.regexp_replace(F.translate(F.coalesce(F.col(text), F.lit("")), "\t\n\x0b\x0c\r", "     "), "  +", " "))
    return F.when(spaced == "", F.lit(0)).otherwise(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, rows -> and target. One row per source: windows over them are small."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("k", F.row_number().over(order) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", most * F.col("source_size"))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "k")
    below = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    here = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    every = W.partitionBy()
    s = s.withColumn("level", (share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(below), F.lit(0.0))) / F.sum("weight").over(here))
    # the level that holds is the first at which the source in its place is not capped
    s = s.withColumn("open", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")))
    s = s.withColumn("level", F.first("open", ignorenulls=True).over(by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight")))
    return s.select("source", "source_size", "rows", target.alias("target"))


def apportion(parties: DataFrame, group: list[str], votes: str, seats: str, order: str) -> DataFrame:
    """Sainte-Lague within each group: adds `won`, of the group's `seats`, to each party by highest quotients.

    With n parties, K seats and V votes, a party of v votes wins round(v / D) for some divisor D. Rounding moves each by half a
    seat at most, and up to twice the value, so D lies between V / (K + n / 2) and the smaller of 2V / K and
    V / (K - n / 2). Only quotients that this leaves open are ranked: a few for each party, whatever K is.
    """
    own = W.partitionBy(*group)
    p = parties.withColumn("n", F.count("*").over(own)).withColumn("all", F.sum(votes).over(own))
    share = F.when(F.col("all") > 0, F.col(seats) * F.col(votes) / F.col("all")).otherwise(F.lit(0.0))
    half = F.when(F.col(seats) > 0, F.col("n") / (2 * F.col(seats))).otherwise(F.lit(0.0))  # n / 2K
    p = p.withColumn("share", share)
    p = p.withColumn("sure", F.greatest(F.floor(F.col("share") * F.greatest(1 - half, F.lit(0.5)) - 0.5 - 1e-6), F.lit(0)).cast("long"))
    p = p.withColumn("limit", F.least(F.col(seats), F.ceil(F.col("share") * (1 + half) + 0.5 + 1e-6)).cast("long"))
    p = p.withColumn("given", F.sum("sure").over(own))
    q = p.select("*", F.explode_outer(F.when(F.col("limit") > F.col("sure"), F.sequence(F.col("sure") + 1, F.col("limit")))).alias("a"))
    q = q.withColumn("quotient", F.col(votes) / (2 * F.col("a") - 1))
    q = q.withColumn("rank", F.row_number().over(own.orderBy(F.desc_nulls_last("quotient"), order, "a")))
    more = F.sum(F.when(F.col("a").isNotNull() & (F.col("rank") + F.col("given") <= F.col(seats)), 1).otherwise(0))
    return q.groupBy(*parties.columns, "sure").agg(more.alias("more")).withColumn("won", F.col("sure") + F.col("more")).drop("sure", "more")


def mix_sources(spark: SparkSession, docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, block: int = 2, shard_rows: int = 1024, seed: int = 7, carry: list[str] | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document, and the columns to carry.

    block: words of a block, so few that small sources get theirs. shard_rows: documents of a shard, about; shards grow with
    the square root of a source beyond its square. Documents are dealt by id and text, so that null and repeated ids spread.
    """
    carry = carry or []
    sized = stash(spark, docs.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("th"), *carry), "sizes")  # texts are read once
    sized = sized.select("*", F.xxhash64(F.lit(seed), "doc_id", "th").alias("h"), F.xxhash64(F.lit(seed + 1), "doc_id", "th").alias("deal"))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    goal = targets(sources, weights, share, most)
    shards = F.ceil(F.col("rows") / F.greatest(F.lit(float(shard_rows)), F.sqrt("rows"))).cast("long")
    # blocks of equal tokens: whole blocks of a source's target
    goal = goal.withColumn("shards", shards).withColumn("one", F.lit(1))
    goal = goal.withColumn("seats_all", F.round(F.sum("target").over(W.partitionBy()) / block).cast("long"))
    goal = apportion(goal, ["one"], "target", "seats_all", "source").withColumnRenamed("won", "blocks").drop("one", "seats_all")

    d, g = sized.alias("d"), goal.alias("g")
    dealt = d.join(g, F.col("d.source").eqNullSafe(F.col("g.source"))).select("d.doc_id", "d.source", "d.size", "d.h", "d.th", *[f"d.{c}" for c in carry], F.pmod("d.deal", "g.shards").alias("shard"), "g.source_size", "g.target", "g.blocks")
    per_shard = dealt.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.max("blocks").alias("blocks"))
    quota = apportion(per_shard, ["source"], "shard_size", "blocks", "shard").select("source", "shard", "shard_size", (F.col("won") * block).alias("quota"))
    k, q = dealt.alias("k"), quota.alias("q")
    rows = k.join(q, F.col("k.source").eqNullSafe(F.col("q.source")) & (F.col("k.shard") == F.col("q.shard"))).select("k.*", "q.shard_size", "q.quota")
    before = W.partitionBy("source", "shard").orderBy("h", "doc_id", "th").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    taken = sum(F.greatest(F.lit(0), F.least(F.col("size"), F.col("quota") - lap * F.col("shard_size") - F.col("before"))) for lap in range(int(most)))
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), *carry)
