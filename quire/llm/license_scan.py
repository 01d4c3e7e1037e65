"""License scan by diagonal voting.

The words of a text (A-Z lowered) and of license templates are cut into rolling pairs. Hashes of the pairs are joined with
the templates' positions, and a hit counts if the two words are the template's; it votes for the offset diagonal (position in
the text less position in the template). Neighbouring diagonals, up to GAP apart, are merged into a band, so that inserted or
dropped words do not break a span; a band is as narrow however many diagonals follow each other, so the places of a span lie
within the template's length and GAP. A band is a license if SHARE of the template's positions at least have a vote in it,
each counted once, and WHOLE of them (or all of a shorter one). Phrases are templates all pairs of which stand on one diagonal.

Null and empty texts have no words and no labels, and score 0. Rows that are the same in doc_id and text count once in
the votes and are returned each. Very long texts are read whole, pair by pair. An empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

# Phrases of the base labels.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Own templates of the method: label and the words of a typical notice.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2.0", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("public-domain", "this work is dedicated to the public domain"),
]
GAP, SHARE, WHOLE = 3, 0.6, 6
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


#: Only A-Z are lowered.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def templates(spark: SparkSession) -> DataFrame:
    """pair, template, label, at, pairs, base, first, second: one row per rolling pair of a template; -1 marks every document."""
    rows = [(k, label, text, k < len(PHRASES)) for k, (text, label) in enumerate([*PHRASES, *[(t, x) for x, t in TEMPLATES]])]
    t = spark.createDataFrame(rows, "template int, label string, text string, base boolean").withColumn("w", F.split("text", " "))
    pairs = F.transform(F.sequence(F.lit(0), F.size("w") - 2), lambda i: F.struct(i.alias("at"), F.get("w", i).alias("first"), F.get("w", i + 1).alias("second")))
    t = t.select("template", "label", "base", (F.size("w") - 1).alias("pairs"), F.explode(pairs).alias("p"))
    t = t.select(F.xxhash64("p.first", "p.second").alias("pair"), "template", "label", "p.at", "pairs", "base", "p.first", "p.second")
    marker = spark.createDataFrame([(0, -1, None, 0, 0, False, None, None)], t.schema)
    return t.unionByName(marker)


def license_scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    text = F.coalesce("text", F.lit(""))
    words = docs.select("doc_id", F.xxhash64(text).alias("th"), F.array_remove(F.split(F.translate(text, UPPER, LOWER), SPLIT), "").alias("w"))
    words = words.withColumn("n_words", F.size("w").cast("long"))
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    # a first element that every document has keeps those without a hit, in one pass
    rolled = words.select("doc_id", "th", "n_words", "w", F.posexplode(F.concat(F.array(F.lit(0).cast("long")), pairs)).alias("pos", "pair"))
    hits = rolled.join(F.broadcast(templates(spark)), "pair")  # the templates are a fixed list
    marker = F.col("template") == -1
    hits = hits.filter(F.when(F.col("pos") == 0, marker).otherwise((F.get("w", F.col("pos") - 1) == F.col("first")) & (F.get("w", F.col("pos")) == F.col("second"))))
    key = ["doc_id", "th", "n_words"]
    votes = hits.select(*key, "template", "label", "base", "pairs", "at", F.when(marker, 0).otherwise(F.col("pos") - 1 - F.col("at")).alias("diagonal"), marker.cast("int").alias("marker"))
    votes = votes.groupBy(*key, "template", "label", "base", "pairs", "diagonal").agg(F.collect_set("at").alias("ats"), F.sum("marker").alias("copies"))
    band = W.partitionBy(*key, "template").orderBy("diagonal").rangeBetween(0, GAP)
    votes = votes.withColumn("votes", F.size(F.array_distinct(F.flatten(F.collect_list("ats").over(band)))))
    place = F.col("base") & (F.size("ats") == F.col("pairs"))
    enough = F.col("votes") >= F.greatest(SHARE * F.col("pairs"), F.least("pairs", F.lit(WHOLE)))
    own = F.when((F.col("template") >= 0) & ~F.col("base") & enough, F.col("votes") / F.col("pairs"))
    at = F.when(place, F.col("diagonal").cast("long"))
    per_doc = votes.groupBy(*key).agg(
        F.count(at).alias("n_base"),
        F.min(at).alias("first_word"),
        F.max(at).alias("last_word"),
        F.collect_set(F.when(place, F.col("label"))).alias("base"),
        F.collect_set(F.when(own.isNotNull(), F.col("label"))).alias("own"),
        F.coalesce(F.max(own), F.lit(0.0)).alias("best"),
        F.max("copies").cast("int").alias("copies"),
    )
    out = per_doc.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "own")), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.round("best", 12)).alias("score"),
        "copies",
    )
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copy", "copies")
