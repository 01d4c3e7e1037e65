"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is a vector of terms: hashed words, the shapes of its words (letter case, digits, symbols) and bins of how much it
repeats itself. Latent-semantic axes come from the term-document matrix of a bounded sample of labelled documents; the
same documents, projected, are the voters (BOUND for each label at most, broadcast). For every document, all cosines with
the voters are computed in blocks, and the NEIGHBOURS nearest vote with their label, weighted by the eighth power of the
similarity; all that are as near as the last of them vote as well, so that ties have no order.

Labels are read of rows whose crc32(doc_id as text) mod 5 is not 0 only. Null text is empty text; it has only the bins
and is scored like any other. Repeated rows are scored each. Without labels of both kinds every score is 0.5. An empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import ascii_words, pieces, small_batches

WORDS, SHAPES, BINS = 768, 256, 24
TERMS = WORDS + SHAPES + BINS
#: Voters for each label, at most.
BOUND = 2048
AXES, NEIGHBOURS, FOLDS = 48, 25, 5

_SHAPE = str.maketrans("0123456789", "9" * 10)


def _shape(word: str) -> str:
    s = re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "Aa" if m[0][0].isupper() else "a", word)
    return re.sub(r"(.)\1+", r"\1", s.translate(_SHAPE))[:12]


class Terms:
    """Term vectors of texts; what is known of a word is kept up to a bound."""

    def __init__(self, most: int = 500_000):
        self.known: dict[str, tuple[int, int]] = {}
        self.most = most

    def _of(self, word: str) -> tuple[int, int]:
        core = re.sub(r"[\W\d_]+", "", word).lower() or word[:24]
        x = xxhash.xxh3_64_intdigest(core) % WORDS, WORDS + xxhash.xxh3_64_intdigest(_shape(word[:200])) % SHAPES
        self.known[word] = x
        return x

    def matrix(self, text: pa.Array) -> np.ndarray:
        """One row of TERMS for each text, of unit length in each part."""
        offsets, flat = ascii_words(text)
        rows = len(offsets) - 1
        coded = pc.dictionary_encode(flat)
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        pairs = np.array([known.get(w) or self._of(w) for w in coded.dictionary.to_pylist()], dtype=np.int64).reshape(-1, 2)
        codes = np.asarray(coded.indices).astype(np.int64) if len(flat) else np.zeros(0, dtype=np.int64)
        n = np.diff(offsets)
        doc = np.repeat(np.arange(rows), n)
        x = np.zeros((rows, TERMS), dtype=np.float32)
        for k in (0, 1):
            at = doc * TERMS + (pairs[codes, k] if len(codes) else codes)
            x += np.bincount(at, minlength=rows * TERMS).reshape(rows, TERMS)
        same = np.zeros(len(codes))
        if len(codes) > 1:
            same[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
        repeats = np.bincount(doc, weights=same, minlength=rows) / np.maximum(n, 1)
        words, shapes = x[:, :WORDS], x[:, WORDS : WORDS + SHAPES]
        top = words.max(axis=1) / np.maximum(n, 1)
        size = np.log2(n + 1)
        chars = np.asarray(pc.fill_null(pc.binary_length(text), 0), dtype=np.float64) / np.maximum(n, 1)
        at = WORDS + SHAPES
        for value, width, bins in ((repeats * 5, 1, 6), (top * 12, 1, 6), (size / 3, 1, 6), (chars / 3, 1, 6)):
            x[np.arange(rows), at + np.minimum(value / width, bins - 1).astype(int)] = 1
            at += bins
        np.log1p(words, out=words)
        np.log1p(shapes, out=shapes)
        return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class Space:
    """Inverse document weights, latent axes and voters."""

    def __init__(self, x: np.ndarray, labels: np.ndarray):
        self.idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 0.3).astype(np.float32)
        self.idf[:WORDS] *= 0.35  # style tells more than subject
        self.idf[WORDS + SHAPES :] *= 1.5
        y = self._weigh(x)
        _, axes = np.linalg.eigh(y.T @ y)
        self.axes = np.ascontiguousarray(axes[:, ::-1][:, :AXES], dtype=np.float32)
        self.labels = labels.astype(np.float32)
        self.voters = _unit(y @ self.axes).astype(np.float32)

    def _weigh(self, x: np.ndarray) -> np.ndarray:
        return _unit(x * self.idf)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Share of the label 1 in the votes; cosines are exact, in blocks of rows."""
        z = _unit(self._weigh(x) @ self.axes)
        out = np.empty(len(z))
        k = min(NEIGHBOURS, len(self.voters))
        for at in range(0, len(z), 512):
            sim = z[at : at + 512] @ self.voters.T
            least = -np.partition(-sim, k - 1, axis=1)[:, k - 1 : k]
            w = np.where(sim >= least, np.maximum(sim, 1e-3), 0)
            for _ in range(3):
                w *= w
            out[at : at + 512] = (w @ self.labels) / w.sum(axis=1)
        return np.clip(out, 0, 1)


def held_out(doc_id: str = "doc_id", folds: int = FOLDS, fold: int = 0):
    return F.coalesce(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == fold, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, bounds: tuple[int, int], folds: int, fold: int) -> DataFrame:
    """doc_id, text, label of at most bounds[y] labelled training documents of label y, taken in the order of a hash."""
    train = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out("doc_id", folds, fold)).select("doc_id", F.col(label).cast("int").alias("label"))
    order = [F.xxhash64(F.lit(11), "doc_id"), "doc_id"]
    of = [train.filter(F.col("label") == y).orderBy(*order).limit(bounds[y]) for y in (0, 1)]
    chosen = of[0].union(of[1]).groupBy("doc_id").agg(F.max("label").alias("label"))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # sum(bounds) rows are broadcast


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int = BOUND) -> Space | None:
    def vectors(batches):
        terms = Terms()
        for batch in batches:
            for part in pieces(batch, "text", 4 << 20):
                x = terms.matrix(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array([r.astype("<f2").tobytes() for r in x], pa.binary())], names=["doc_id", "label", "x"])

    rows = sample(docs, labels, "quality", (bound, bound), FOLDS, 0).mapInArrow(vectors, "doc_id long, label int, x binary")
    got = rows.orderBy("doc_id", "x").limit(2 * bound).toArrow()
    y = np.asarray(got.column("label"))
    if len(set(y.tolist())) < 2:
        return None
    return Space(np.stack([np.frombuffer(r, "<f2") for r in got.column("x").to_pylist()]).astype(np.float32), y)


def score_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int = BOUND, keep: int | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. With keep: the rows of docs that are predicted so."""
    small_batches(spark, 2000)
    sent = spark.sparkContext.broadcast(fit(spark, docs, labels, bound))  # of fixed size: axes and 2 * bound voters

    def run(batches):
        terms, space = Terms(), sent.value
        for batch in batches:
            for part in pieces(batch, "text", 4 << 20):
                s = np.full(part.num_rows, 0.5) if space is None else space.score(terms.matrix(part.column("text")))
                if keep is not None:
                    yield part.filter(pa.array((s >= 0.3) == bool(keep)))
                    continue
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s, pa.float64())], names=["doc_id", "score"])

    if keep is not None:
        return docs.mapInArrow(run, docs.schema)
    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
