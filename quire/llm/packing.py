"""Hierarchical multi-length packing of token ids.

Each task packs the documents of its own input split, so that nothing is shuffled: a document of T = 4096 ids or more
gives whole windows, what is left of it goes to the tier of the smallest window that holds it. Tiers are packed from
long to short; the gap of a long window is filled with whole remainders of shorter tiers, the largest that fits first,
and closed with a piece cut from the next one. What a buffer leaves open at its end is cut into windows of powers of
two, so that no window needs padding. The windows of a buffer are dealt to step groups of about equal tokens.

Null text is empty text: the end id alone. Rows with equal or null doc_id are packed each for itself. An empty table
gives no rows; further columns are ignored. Window ids hold the split's number, hence a rerun of a lost task over the
same split gives the same rows.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import ascii_words, pieces, small_batches

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window long, step_group long"
END = 2


class WordIds:
    """Ids of words, kept up to a bound. White space ends every pre-token of the tokenizer, a letter ends before a full
    stop or comma, and all is lowered by it: so words are encoded alone, in lower case and without these."""

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.full(1 << 16, END, dtype=np.uint32)
        self.starts, self.lens = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int32)
        self.lens[0], self.used, self.known = 1, 1, 1  # entry 0 is the end of a text

    def _add(self, words: list[str]) -> None:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lens = np.fromiter(map(len, got), dtype=np.int32, count=len(got))
        total, n = int(lens.sum()), len(got)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.known + n > len(self.lens):
            self.starts, self.lens = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lens))
        self.flat[self.used : self.used + total] = np.fromiter((i for ids in got for i in ids), dtype=np.uint32, count=total)
        self.lens[self.known : self.known + n] = lens
        self.starts[self.known : self.known + n] = self.used + np.cumsum(lens) - lens
        self.index.update(zip(words, range(self.known, self.known + n), strict=True))
        self.used, self.known = self.used + total, self.known + n

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): ids of all texts, each ended by END; those of text i are ids[bounds[i]:bounds[i + 1]]."""
        text = pc.fill_null(text, "")
        if not pc.any(pc.match_substring(text, "<|")).as_py():  # special tokens are matched in their own case
            text = pc.replace_substring_regex(pc.ascii_lower(text), "([a-z])([.,])", "\\1 \\2")
        offsets, flat = ascii_words(text)
        coded = pc.dictionary_encode(flat)
        words = coded.dictionary.to_pylist()
        if len(self.index) > self.most:
            self._clear()
        new = [w for w in words if w not in self.index]
        for at in range(0, len(new), 4096):
            self._add(new[at : at + 4096])
        entry = np.fromiter(map(self.index.__getitem__, words), dtype=np.int32, count=len(words))
        codes = entry[np.asarray(coded.indices)] if len(flat) else entry
        codes = np.insert(codes, offsets[1:], 0)  # the end id behind each text's words
        n = self.lens[codes]
        ends = np.cumsum(n, dtype=np.int64)
        source = np.repeat((self.starts[codes] - ends + n).astype(np.int32), n)
        source += np.arange(len(source), dtype=np.int32)
        return self.flat[source], np.concatenate([[0], ends[offsets[1:] + np.arange(len(offsets) - 1)]])


_kept: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One for each worker process, kept from task to task."""
    if path not in _kept:
        _kept[path] = WordIds(path)
    return _kept[path]


def plan(sizes: list[int], longest: int = 4096, tiers: tuple[int, ...] = (512, 1024, 2048, 4096)) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows (size, [(item, start, length), ...]) that hold all of the items; each is full, and its size is longest
    or another power of two."""
    windows: list[tuple[int, list[tuple[int, int, int]]]] = []
    pool: list[tuple[int, int, int]] = []  # (length, item, start), sorted
    for i, n in enumerate(sizes):
        whole = n // longest
        windows += [(longest, [(i, k * longest, longest)]) for k in range(whole)]
        if n % longest:
            pool.append((n % longest, i, whole * longest))
    pool.sort()
    while pool:
        n, item, start = pool.pop()
        size = next(t for t in tiers if t >= n)
        row, gap = [(item, start, n)], size - n
        while gap and pool:
            k = bisect.bisect_right(pool, (gap, 1 << 62, 0)) - 1
            if k >= 0:
                n, item, start = pool.pop(k)
            else:  # all are longer than the gap: cut the shortest
                length, item, start = pool.pop(0)
                n = gap
                bisect.insort(pool, (length - n, item, start + n))
            row.append((item, start, n))
            gap -= n
        if not gap:
            windows.append((size, row))
            continue
        left = size - gap  # nothing is left to fill it: windows of powers of two
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            own, need = [], size
            while need:
                item, start, n = row.pop(0)
                use = min(n, need)
                own.append((item, start, use))
                if n > use:
                    row.insert(0, (item, start + use, n - use))
                need -= use
            windows.append((size, own))
    return windows


def step_groups(windows: list[int], tokens: int = 1 << 18) -> list[int]:
    """A group for each window, groups of about equal tokens: the longest windows are dealt first, there and back."""
    groups = max(1, round(sum(windows) / tokens))
    out = [0] * len(windows)
    for k, i in enumerate(sorted(range(len(windows)), key=lambda i: -windows[i])):
        lap, at = divmod(k, groups)
        out[i] = at if lap % 2 == 0 else groups - 1 - at
    return out


def _packed(path: str, longest: int, buffer_tokens: int):
    def run(batches):
        words, made, stepped = word_ids(path), 0, 0
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        doc_ids: list = []
        held: list[np.ndarray] = []

        def flush():
            nonlocal made, stepped
            windows = plan([len(x) for x in held], longest)
            steps = step_groups([size for size, _ in windows])
            cols: list[list] = [[] for _ in range(9)]
            for (size, row), step in zip(windows, steps, strict=True):
                offset = 0
                for item, start, n in row:
                    x = held[item]
                    for c, v in zip(cols, (doc_ids[item], start, n, zlib.crc32(x[start : start + n].tobytes()), len(x), base + made, offset, size, base + stepped + step), strict=True):
                        c.append(v)
                    offset += n
                made += 1
            stepped += max(steps, default=-1) + 1
            doc_ids.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[f.split()[0] for f in SCHEMA.split(", ")])

        tokens = 0
        for batch in batches:
            for part in pieces(batch, "text", 8 << 20):
                ids, bounds = words.encode(part.column("text"))
                for i, d in enumerate(part.column("doc_id").to_pylist()):
                    doc_ids.append(d)
                    held.append(ids[bounds[i] : bounds[i + 1]])
                tokens += len(ids)
                if tokens >= buffer_tokens:
                    yield flush()
                    tokens = 0
        if held:
            yield flush()

    return run


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, longest: int = 4096, buffer_tokens: int = 4 << 20) -> DataFrame:
    """One row per piece of a document: SCHEMA."""
    small_batches(spark, 2000)
    return docs.select("doc_id", "text").mapInArrow(_packed(tokenizer, longest, buffer_tokens), SCHEMA)
