"""Exact top-k by a bit-sliced index.

Each attribute of a vector is floor(256 * x), less the smallest of its block, in binary: slice j of attribute d is the
bitmap of the rows whose value has bit j. A query's score is the sum of q_d times the attributes; slices of the same weight
are added with carry-save adders, 64 rows to a word, into slices of the score. (A negative q_d adds complemented
slices and a constant.) Slices of low weight are left out at first: what they can add is bounded. The top rows are selected
from the most significant slice downward, and all rows that the bound cannot tell from the k-th (boundary rows) are scored
exactly; ties go to the smaller vec_id.

Rows are dealt to blocks of bounded size, queries to chunks; each cell gives its k best, and the best of these are the
answer. Attributes are indexed in two bands, up to 2^20 and up to what 64-bit sums hold; rows and queries beyond are scored
in integers of any length where a bound on the error of floating point cannot tell them apart. A score of the answer that
64 bits do not hold is an error, not another score.

Vectors that are null, empty, or hold null or non-finite components take no part; a query
meets vectors of its own length. Repeated vec_ids are rows each, but a query never meets its own vec_id; rows without
vec_id take no part. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import FloatType

BLOCK_ROWS, CHUNK_QUERIES = 16_384, 2048
LEFT_OUT = 1 / 160  # of the score's range that left-out slices may add
NARROW = 1 << 20  # attributes of the first band, at most


class BitSlicedIndex:
    """Slices of the rows of an integer matrix: bits[d, j] is a bitmap."""

    def __init__(self, x: np.ndarray):
        self.x, self.n = x, len(x)
        self.low = x.min(axis=0)
        u = (x - self.low).astype(np.uint64)
        self.width = np.array([int(v).bit_length() for v in u.max(axis=0)])
        words = -(-self.n // 64)
        most = max(1, int(self.width.max()))
        pad = np.zeros((words * 64, x.shape[1]), dtype=np.uint64)
        pad[: self.n] = u
        self.bits = np.empty((x.shape[1], most, words), dtype=np.uint64)
        for j in range(most):
            plane = ((pad >> np.uint64(j)) & np.uint64(1)).astype(np.uint8)
            self.bits[:, j] = np.packbits(plane, axis=0, bitorder="little").T.copy().view("<u8").reshape(x.shape[1], words)
        self.flip = ~self.bits
        self.all = np.packbits((np.arange(words * 64) < self.n).astype(np.uint8), bitorder="little").view("<u8")

    def _columns(self, q: np.ndarray) -> tuple[dict[int, list[np.ndarray]], int]:
        """Bitmaps to be added by weight, and the least weight: those below are left out."""
        size = np.abs(q)
        spread = int((size * ((1 << self.width) - 1)).sum())
        take: dict[int, list[tuple[int, int]]] = {}
        for d in np.flatnonzero((size > 0) & (self.width > 0)):
            v = int(size[d])
            for i in range(v.bit_length()):
                if v >> i & 1:
                    for j in range(self.width[d]):
                        take.setdefault(i + j, []).append((d, j))
        floor, lost = 0, 0
        for w in sorted(take):
            lost += len(take[w]) << w
            if lost > spread * LEFT_OUT:
                break
            floor = w + 1
        out = {}
        for w, pairs in take.items():
            if w >= floor:
                d, j = np.array(pairs).T
                plus = q[d] > 0
                out[w] = [self.bits[d[plus], j[plus]], self.flip[d[~plus], j[~plus]]]
        return out, floor

    @staticmethod
    def _add(columns: dict[int, list[np.ndarray]]) -> tuple[list[np.ndarray], int]:
        """Carry-save addition of all bitmaps: slices of the sum, from the least weight on."""
        if not columns:
            return [], 0
        w, least, slices = min(columns), min(columns), []
        while w in columns or any(k > w for k in columns):
            stack = np.concatenate(columns.pop(w)) if w in columns else None
            carries = []
            while stack is not None and len(stack) > 1:
                m = len(stack) // 3
                if m:
                    a, b, c = stack[:m], stack[m : 2 * m], stack[2 * m : 3 * m]
                    half = a ^ b
                    carries.append((a & b) | (half & c))
                    stack = np.concatenate([half ^ c, stack[3 * m :]])
                else:
                    carries.append(stack[:1] & stack[1:])
                    stack = stack[:1] ^ stack[1:]
            slices.append(stack[0] if stack is not None and len(stack) else None)
            if carries:
                columns.setdefault(w + 1, []).extend(carries)
            w += 1
        return slices, least

    def top(self, q: np.ndarray, k: int, ids: np.ndarray, own: int) -> list[tuple[int, int]]:
        """The k best (score, row) by score, ties to the smaller id; rows with the query's own id take no part."""
        columns, floor = self._columns(q)
        lost = 0
        for d in range(len(q)):
            v = abs(int(q[d]))
            for i in range(v.bit_length()):
                if v >> i & 1:
                    j = max(0, min(int(self.width[d]), floor - i))
                    lost += ((1 << j) - 1) << i
        slices, least = self._add(columns)
        live = self.all.copy()
        for r in np.flatnonzero(ids == own):
            live[r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
        k = min(k, int(np.bitwise_count(live).sum()))
        if not k:
            return []
        # from the top slice down: the k-th largest known part, and the rows that reach it
        sure, open_, need, kth = np.zeros_like(live), live.copy(), k, 0
        for w in range(len(slices) - 1, -1, -1):
            kth <<= 1
            if slices[w] is None:
                continue
            with_ = open_ & slices[w]
            c = int(np.bitwise_count(with_).sum())
            if c >= need:
                open_, kth = with_, kth | 1
            else:
                sure |= with_
                need -= c
                open_ &= ~slices[w]
        # boundary rows: known part >= kth - lost
        bound = kth - (-(-lost >> least) if lost else 0)
        near = sure | open_
        if lost:
            equal, above = live.copy(), np.zeros_like(live)
            if bound <= 0:
                above = live
            else:
                for w in range(max(len(slices), bound.bit_length()) - 1, -1, -1):
                    s = slices[w] if w < len(slices) and slices[w] is not None else None
                    if bound >> w & 1:
                        equal = equal & s if s is not None else np.zeros_like(live)
                    elif s is not None:
                        above |= equal & s
                        equal = equal & ~s
                near = above | equal
            near &= live
        rows = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little")[: self.n])
        scores = self.x[rows] @ q
        order = np.lexsort((ids[rows], -scores))[:k]
        return [(int(scores[i]), int(rows[i])) for i in order]


class ExactRows:
    """Rows of attributes of any size, as whole floats: those that may be among the best are scored in Python's integers."""

    def __init__(self, raw: np.ndarray, scale: int):
        self.raw, self.scale = raw, scale
        self.x = attributes(raw, scale)
        self.size = np.abs(self.x)

    def _whole(self, row: np.ndarray) -> list[int]:
        return [int(v) * self.scale if abs(v) >= 2.0**53 else math.floor(v * self.scale) for v in row.tolist()]

    def top(self, raw: np.ndarray, k: int, ids: np.ndarray, own: int) -> list[tuple[int, int]]:
        live = np.flatnonzero(ids != own)
        if len(live) > k:
            q = attributes(raw, self.scale)
            with np.errstate(over="ignore", invalid="ignore"):
                about = self.x[live] @ q
                off = (self.size[live] @ np.abs(q)) * (2 * len(q) + 4) * 2.0**-52
                low = about - off
                if np.isfinite(low).all():
                    live = live[about + off >= np.partition(low, -k)[-k]]
        whole = self._whole(raw)
        scored = [(sum(a * b for a, b in zip(self._whole(self.raw[r]), whole, strict=True)), int(r)) for r in live]
        return sorted(scored, key=lambda x: (-x[0], ids[x[1]]))[:k]


def attributes(raw: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(raw.astype(np.float64) * scale)


def best_of(raw: np.ndarray, ids: np.ndarray, asked: np.ndarray, asking: np.ndarray, k: int, scale: int):
    """(query id, row's id, score) of the k best rows for each query; all vectors are of one length."""
    wide = math.isqrt((1 << 59) // raw.shape[1])  # sums of products up to this fit in 64 bits
    ends = (min(NARROW, wide), wide)
    x, q = attributes(raw, scale), attributes(asked, scale)
    most, needs = np.abs(x).max(axis=1), np.abs(q).max(axis=1)
    bands = [np.flatnonzero(most <= ends[0]), np.flatnonzero((most > ends[0]) & (most <= ends[1]))]
    bands = [(BitSlicedIndex(x[at].astype(np.int64)), at) for at in bands if len(at)]
    rest = np.flatnonzero(most > ends[1])
    beyond = ExactRows(raw[rest], scale) if len(rest) else None
    every = ExactRows(raw, scale) if (needs > ends[1]).any() else None
    for i, own in enumerate(asking.tolist()):
        if needs[i] > ends[1]:
            found = every.top(asked[i], k, ids, own)
        else:
            found = [(s, int(at[r])) for index, at in bands for s, r in index.top(q[i].astype(np.int64), k, ids[at], own)]
            if beyond is not None:
                found += [(s, int(rest[r])) for s, r in beyond.top(asked[i], k, ids[rest], own)]
        for s, r in sorted(found, key=lambda x: (-x[0], ids[x[1]]))[:k]:
            yield own, int(ids[r]), s


def sortable(score: int) -> tuple[int, int, bytes]:
    """Three columns in the order of scores: a score beyond 64 bits has a size other than 0, and bytes in place of the long."""
    if -(1 << 63) <= score < 1 << 63:
        return 0, score, b""
    n = score.bit_length()
    return (n, 0, score.to_bytes(n // 8 + 1, "big")) if score > 0 else (-n, 0, (score + (1 << n)).to_bytes(n // 8 + 1, "big"))


def top_k(spark: SparkSession, vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row whose vec_id is divisible by `every`."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ~bad)
    single = vectors.schema["embedding"].dataType.elementType == FloatType()
    rows = rows.select("vec_id", F.col("embedding").cast("array<float>" if single else "array<double>").alias("x"))
    queries = rows.filter(F.col("vec_id") % every == 0)
    n, m = rows.count(), queries.count()
    cores = spark.sparkContext.defaultParallelism
    blocks = max(1, -(-n // BLOCK_ROWS), min(cores, n // 2048))
    chunks = max(1, -(-m // CHUNK_QUERIES))

    def dealt(df: DataFrame, own: int, name: str, other: int) -> DataFrame:
        at = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(own)).cast("int")
        return df.select("vec_id", "x", at.alias(name)).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(other - 1))))

    cells = dealt(rows, blocks, "block", chunks).select("vec_id", "x", F.col("block") * chunks + F.col("other"), F.lit(False))
    asked = dealt(queries, chunks, "chunk", blocks).select("vec_id", "x", F.col("other") * chunks + F.col("chunk"), F.lit(True))
    both = cells.toDF("vec_id", "x", "cell", "asks").union(asked.toDF("vec_id", "x", "cell", "asks"))

    def cell(got: pa.Table) -> pa.Table:
        lens = np.diff(np.asarray(got.column("x").combine_chunks().offsets))
        asks = got.column("asks").to_numpy().astype(bool)
        ids = got.column("vec_id").to_numpy()
        out: list[tuple] = []
        for size in np.unique(lens):
            own, ask = np.flatnonzero((lens == size) & ~asks), np.flatnonzero((lens == size) & asks)
            if not len(own) or not len(ask):
                continue
            values = lambda at: np.asarray(got.column("x").take(pa.array(at)).combine_chunks().flatten()).reshape(-1, size)
            out += [(q, r, *sortable(s)) for q, r, s in best_of(values(own), ids[own], values(ask), ids[ask], k, scale)]
        cols = list(zip(*out, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        return pa.table({name: pa.array(c, t) for name, c, t in zip(("query_id", "vec_id", "size", "score", "digits"), cols, kinds, strict=True)})

    best = both.groupBy("cell").applyInArrow(cell, "query_id long, vec_id long, size int, score long, digits binary")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("size"), F.desc("score"), F.desc("digits"), "vec_id"))
    score = F.when(F.col("size") != 0, F.raise_error(F.lit("a score of the answer is beyond 64 bits")).cast("long")).otherwise(F.col("score")).alias("score")
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", score)
