"""Document fingerprints: a Merkle tree over paragraphs and sections, of built-in functions only.

A text is cut behind line ends and sentence ends into paragraphs that together are the whole text; a section is a run of
paragraphs that ends where a paragraph's hash divides by SECTION (so that an edit moves no far boundary). A leaf is the hash
of a paragraph without the white space behind it, a section's hash is that of its leaves' hashes, and the root's that of the
sections' and of one more branch, the white space between paragraphs: roots are equal where texts are. The fingerprint is `root/section.section...:leaf,leaf;leaf...`: leaves of a section are joined by
commas, sections by semicolons.

Likeness walks two trees from the root: equal roots give 1. Else sections that both have (as often as both have them) are the
same in all their leaves, and only the leaves of the others are compared. The share of the same leaves, counted as often as
they are there, is averaged with the share of the same neighbours, so that the order of paragraphs counts too.
`with_differences` gives the paragraphs at which two texts differ, by the same walk.

Null text is empty text: its tree is a root alone. Rows with equal doc_id follow each other in the order of a hash of
their text; a null doc_id comes last. The next document of the last row is the first. An empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: One paragraph in so many ends a section (a hash's last digit is 0 or 8). Digits of a leaf and of a section in fingerprints.
SECTION, LEAF_DIGITS, SECTION_DIGITS = 8, 8, 16
SPACE = " \t\n\r\f"
PARAGRAPH = r"[^.!?\n]*[.!?\n][.!? \t\n\r\f]*|[^.!?\n]+"
#: Bytes of texts in a range of document ids, about, and the most ranges (their bounds are literals of the plan).
RANGE_BYTES, RANGES = 64 << 20, 1 << 14


def paragraphs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))


def _bare(paragraph: Column) -> Column:
    return F.rtrim(paragraph, F.lit(SPACE))


def spacing(own: Column) -> Column:
    """The white space behind each of the paragraphs, joined by commas."""
    return F.array_join(F.transform(own, lambda p: F.substr(p, F.length(_bare(p)) + 1)), ",")


def tree(own: Column) -> Column:
    """Sections of paragraphs, each as its leaves' hashes (whole digests) joined by commas."""
    joined = F.array_join(F.transform(own, lambda p: F.md5(_bare(p))), ",")
    return F.filter(F.split(F.regexp_replace(joined, "([08]),", "$1;"), ";"), lambda s: s != "")


def digests(sections: Column) -> Column:
    return F.transform(sections, lambda s: F.sha2(s, 256))


def with_prints(df: DataFrame, **texts: str) -> DataFrame:
    """df with the fingerprints of the named texts. Each step is a column of its own and worked out once."""
    kept = df.columns
    df = df.withColumns({f"_p_{k}": paragraphs(F.col(c)) for k, c in texts.items()})
    df = df.withColumns({f"_t_{k}": tree(F.col(f"_p_{k}")) for k in texts} | {f"_s_{k}": F.sha2(spacing(F.col(f"_p_{k}")), 256) for k in texts})
    df = df.withColumns({f"_d_{k}": digests(F.col(f"_t_{k}")) for k in texts})

    def printed(k: str) -> Column:
        root = F.sha2(F.concat(F.array_join(f"_d_{k}", "."), F.lit("/"), f"_s_{k}"), 256)
        above = F.array_join(F.transform(F.col(f"_d_{k}"), lambda d: F.substring(d, 1, SECTION_DIGITS)), ".")
        leaves = F.regexp_replace(F.array_join(f"_t_{k}", ";"), rf"([0-9a-f]{{{LEAF_DIGITS}}})[0-9a-f]{{{32 - LEAF_DIGITS}}}", "$1")
        return F.concat(root, F.lit("/"), above, F.lit(":"), leaves)

    return df.select(*kept, *[printed(k).alias(k) for k in texts])


def _counted(df: DataFrame, **lists: str) -> DataFrame:
    """With columns of the lists' elements, repeated ones with their number: bags as sets, in linear time. Lists without
    repeats stay as they are. Each step is a column of its own, so that nothing is worked out again for each element."""
    repeats = lambda x: F.size(F.array_distinct(x)) < F.size(x)
    df = df.withColumns({f"_v_{k}": F.when(repeats(F.col(c)), F.array_sort(F.col(c))) for k, c in lists.items()})

    def starts(v: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(v) - 1), lambda i: (i == 0) | (F.get(v, i) != F.get(v, i - 1)))

    df = df.withColumns({f"_a_{k}": F.when(F.col(f"_v_{k}").isNotNull(), starts(F.col(f"_v_{k}"))) for k in lists})

    def numbered(x: Column, v: Column, at: Column) -> Column:
        ends = F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(F.size(v)))
        runs = F.zip_with(at, ends, lambda a, b: F.struct((b - a).alias("n"), F.get(v, a).alias("x")))
        each = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), r["n"]), lambda k: F.when(k == 1, r["x"]).otherwise(F.concat(r["x"], F.lit("#"), k.cast("string"))))))
        return F.when(v.isNull(), x).otherwise(each)

    df = df.withColumns({k: numbered(F.col(c), F.col(f"_v_{k}"), F.col(f"_a_{k}")) for k, c in lists.items()})
    return df.drop(*[f"_{x}_{k}" for x in "va" for k in lists])


def _rest(own: Column, other: Column) -> Column:
    """Leaves of the counted sections that the other has not, or not as often."""
    return F.flatten(F.transform(F.array_except(own, other), lambda s: F.split(F.substring_index(s, "#", 1), ",")))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """df with the likeness of two fingerprints, 0 to 1."""
    kept = df.columns
    sections = lambda c: F.filter(F.split(F.substring_index(F.col(c), ":", -1), ";"), lambda s: s != "")
    df = df.withColumns({"_sx": sections(a), "_sy": sections(b)})
    df = _counted(df, _cx="_sx", _cy="_sy")
    leaves = lambda c: F.flatten(F.transform(F.col(c), lambda s: F.split(s, ",")))
    df = df.withColumns({"_rx": _rest(F.col("_cx"), F.col("_cy")), "_ry": _rest(F.col("_cy"), F.col("_cx")), "_lx": leaves("_sx"), "_ly": leaves("_sy")})
    pairs = lambda c: F.zip_with(F.concat(F.array(F.lit("^")), F.col(c)), F.concat(F.col(c), F.array(F.lit("$"))), lambda p, q: F.concat(p, q))
    df = _counted(df.withColumns({"_px": pairs("_lx"), "_py": pairs("_ly")}), _ex="_rx", _ey="_ry", _qx="_px", _qy="_py")
    same = F.size("_lx") - F.size("_rx") + F.size(F.array_intersect("_ex", "_ey"))
    total = F.size("_lx") + F.size("_ly")
    share = same / total + F.size(F.array_intersect("_qx", "_qy")) / (total + 2)
    root_of = lambda c: F.substring_index(F.col(c), "/", 1)
    found = F.when(root_of(a) == root_of(b), F.lit(1.0)).when((F.size("_lx") == 0) | (F.size("_ly") == 0), F.lit(0.0)).otherwise(F.round(share, 12))
    return df.withColumn(name, found).select(*kept, name)


def with_differences(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """df with the paragraphs of text a, as (at, paragraph), that stand in sections which text b has not and are not among the
    other's paragraphs there: where a differs. Empty if the roots are equal."""
    kept = df.columns
    df = _counted(df.withColumns({"_own": paragraphs(F.col(a)), "_other": paragraphs(F.col(b))}).withColumns({"_sx": tree(F.col("_own")), "_sy": tree(F.col("_other"))}), _cx="_sx", _cy="_sy")
    df = df.withColumns({"_rx": _rest(F.col("_cx"), F.col("_cy")), "_ry": _rest(F.col("_cy"), F.col("_cx"))}).withColumn("_lost", F.array_except("_rx", "_ry"))
    numbered = F.transform("_own", lambda p, i: F.struct(i.alias("at"), p.alias("paragraph"), F.md5(_bare(p)).alias("h")))
    found = F.filter(numbered, lambda n: F.array_contains("_lost", n["h"]))
    return df.withColumn(name, F.transform(found, lambda n: F.struct(n["at"].alias("at"), n["paragraph"].alias("paragraph")))).select(*kept, name)


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint, next_text, next_print: those of the next document in descending doc_id, cyclic.

    Documents are dealt to ranges of doc_id, as many as their bytes need, bounded by approximate quantiles; null ids to
    ranges of a hash of the text. The first document of a range is dealt to the range before as well, as its end, so that
    no range needs another one.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n"), F.count("doc_id").alias("ids")).first()
    rows = with_prints(rows, fingerprint="text")
    if not size.n:
        return rows.select("doc_id", "text", "fingerprint", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    ranges = max(2, min(RANGES, max(256, -(-size.bytes // RANGE_BYTES)), size.n))
    own = max(2, round(ranges * size.ids / size.n))
    nulls = max(1, ranges - own)
    cuts = rows.agg(F.percentile_approx("doc_id", [i / own for i in range(1, own)], max(4000, 10 * own)).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))
    # how many cuts are below an id: first among every step-th, then in the run behind it
    step = max(1, round(len(cuts) ** 0.5))
    coarse, runs = cuts[step - 1 :: step], [cuts[i : i + step] for i in range(0, max(1, len(cuts)), step)]
    below = lambda xs: F.size(F.filter(xs, lambda c: c < F.col("doc_id")))
    literal = lambda xs: F.lit(xs).cast("array<bigint>") if xs else F.array().cast("array<bigint>")
    at = below(literal(coarse))
    under = at * step + F.coalesce(below(F.get(F.array(*map(literal, runs)), at)), F.lit(0)) if cuts else F.lit(0)
    # range 0 holds the largest ids; null ids come behind, in the order of their texts' hashes
    of_null = len(cuts) + 1 + F.floor((F.shiftrightunsigned(F.col("th"), 32).cast("long") + F.lit(1 << 31)) % F.lit(1 << 32) * nulls / F.lit(1 << 32))
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), of_null).otherwise(len(cuts) - under).cast("int"))
    first = rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).alias("f")
    heads = rows.drop("fingerprint").join(F.broadcast(first), "bucket").filter(F.col("doc_id").eqNullSafe(F.col("f.top"))).groupBy("bucket", "f.top").agg(F.min("th").alias("least"))  # a row for each range, RANGES at most
    order = W.orderBy("bucket")
    last = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    heads = heads.select(F.col("bucket").alias("own"), "top", "least", F.coalesce(F.lag("bucket").over(order), F.last("bucket").over(last)).alias("before"))
    dealt = rows.join(F.broadcast(heads), rows.bucket == F.col("own"))
    is_head = F.col("doc_id").eqNullSafe(F.col("top")) & (F.col("th") == F.col("least"))
    here = F.struct(F.col("bucket").alias("at"), F.lit(False).alias("end"))
    copies = F.when(is_head, F.array(here, F.struct(F.col("before").alias("at"), F.lit(True).alias("end")))).otherwise(F.array(here))
    dealt = dealt.select("doc_id", "text", "fingerprint", "th", F.explode(copies).alias("c")).select("doc_id", "text", "fingerprint", "th", "c.at", "c.end")
    w = W.partitionBy("at").orderBy("end", F.desc_nulls_last("doc_id"), "th")
    both = dealt.withColumn("next_text", F.lead("text").over(w)).withColumn("next_print", F.lead("fingerprint").over(w))
    return both.filter(~F.col("end")).select("doc_id", "text", "fingerprint", "next_text", "next_print")


def merkle_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = in_order(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("next_text"), F.lit(1), half))
    rows = with_prints(rows.withColumn("edited", edited), edited_fingerprint="edited")
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "next_print")
    rows = with_likeness(with_likeness(rows, "fingerprint", "edited_fingerprint", "near_edited"), "fingerprint", "next_print", "near_next")
    return rows.drop("next_print")
