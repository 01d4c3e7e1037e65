"""N-gram Jaccard join by a count-vector R-tree.

Documents are sets of hashed five-word shingles. Equal sets form one node. A node's shingles are hashed into groups and
the group counts form its point: the sum over groups of the smaller count bounds the overlap of two sets from above,
and the largest counts of a tree node's bounding box bound the overlap with all points in it.

The tree's directory is by coordinate: nodes that share a shingle among the first ``n - ceil(t * n) + 1`` of both (two sets
that link always do; boxes over unlike texts bound nothing) stand in one bucket; shingles of common passages,
counted over all texts, come last in that order, and the bucket of a frequent one is dealt by its nodes. Below a bucket are
tiles of like set sizes, of bounded weight, and below these boxes down to leaves. Pairs of boxes are followed down
from the top as long as their summed minima reach the overlap needed.

Large groups of near copies are never expanded into all pairs. First each node proposes links to the PROPOSALS candidates of
the highest bound among the first and the preceding node of its buckets; verified ones give components. Then the R-tree join
runs over the buckets that hold several components. A cell gives a spanning forest of the pairs that the
bound leaves: a pair whose components are joined already, in the cell or before, is not given. Forests are verified on the whole
sets. Where a pair of a forest is refuted, what it joined is open again: those cells alone are run once more, with
the sets in place of the points, so that every pair they give is a link. So no link between components is lost, and each
cell gives fewer pairs than it has nodes.

Null and empty texts have an empty set and link with nothing. Repeated rows and equal texts fall into one component. A
null doc_id takes part; component_id is the smallest doc_id that is not null (else null). An empty table gives no rows.
Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import MIX_A, U64, Scratch, mix, pieces, shingle_sets, small_batches

#: Nodes of a tile, and shingles of them, about: larger buckets are tiled.
CELL, WEIGHT = 2048, 1 << 21
LEAF, FAN = 32, 8
#: Shingles are counted in so many cells, to take those of common passages last.
CELL_BITS, SLICES = 20, 64
CELLS = 1 << CELL_BITS
#: Buckets of cells with more texts than this are dealt by node.
FREQUENT = 8192
#: Links that a node proposes at first.
PROPOSALS = 3
#: Candidates of a node whose points are compared for that: those with the most buckets in common.
TRIED = 4
#: So many signatures of a node before the one of a bucket tell whether an earlier bucket has a pair.
EARLIER, NONE = 4, -(1 << 63)
#: Bits of a Bloom filter for each key, and their most: 32 MB are broadcast at most; a full filter only lets more through.
BLOOM_SHARE, BLOOM_MOST, CHUNK = 16, 1 << 28, 1 << 15


def _fingerprint(s: np.ndarray) -> int:
    """A 64-bit value of a sorted set."""
    with np.errstate(over="ignore"):
        x = mix(s * MIX_A).sum(dtype=U64) + U64(len(s)) * MIX_A
    return int(mix(np.array([x], dtype=U64))[0].view(np.int64))


def point(s: np.ndarray) -> bytes:
    """Counts of a set by group. There are as many groups as shingles, a power of two and 64 at least, so that points of
    similar sets can be folded. A level is a bitmap of which groups of the level before hold one more: 2 bits a shingle."""
    log = max(6, max(0, len(s) - 1).bit_length())
    counts = np.bincount((s & U64((1 << log) - 1)).astype(np.int64), minlength=1 << log)
    out = [bytes([log])]
    while (more := counts > 0).any():
        out.append(np.packbits(more).tobytes())
        counts = counts[more] - 1
    return b"".join(out)


def counts_of(p: bytes) -> np.ndarray:
    """The counts of a point; folded ones fit as well."""
    g = 1 << p[0]
    counts = np.zeros(g, dtype=np.uint16 if g < 1 << 22 else np.uint32)
    bits, at, left = np.frombuffer(p, np.uint8), 1, np.arange(g)
    while at < len(bits):
        size = -(-len(left) // 8)
        left = left[np.unpackbits(bits[at : at + size], count=len(left)).astype(bool)]
        counts[left] += 1
        at += size
    return counts


class Kept(dict):
    """Arrays by key, up to a number of elements."""

    def __init__(self, make, most: int = 1 << 23):
        self.make, self.most, self.size = make, most, 0

    def __missing__(self, key):
        if self.size > self.most:
            self.clear()
            self.size = 0
        x = self[key] = self.make(key)
        self.size += x.size
        return x


def fold(v: np.ndarray, g: int) -> np.ndarray:
    """Counts over fewer groups: groups are low bits of the hash, so that halves add up."""
    while v.shape[-1] > g:
        half = v.shape[-1] // 2
        v = v[..., :half] + v[..., half:]
    return v


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The smallest overlap of sets of n and m shingles with 100 * overlap >= percent * union."""
    return -(-(percent * (n + m)) // (100 + percent))


def _nodes(batches):
    """A row for each document, and at the end of a task rows of its sketch (slice, counts): how many texts hold a
    shingle of each cell."""
    names = ["doc_id", "node", "n", "point"]
    sketch = np.zeros(CELLS, dtype="<u4")
    for batch in batches:
        for part in pieces(batch, "text"):
            sets = shingle_sets(part.column("text"))
            nodes = [_fingerprint(s) for s in sets]
            once = {x: s for x, s in zip(nodes, sets, strict=True)}
            sketch += np.bincount((np.concatenate(list(once.values())) >> U64(64 - CELL_BITS)).astype(np.int64), minlength=CELLS).astype("<u4")
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(nodes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([point(s) if len(s) else None for s in sets], pa.binary())], names=names)
    slices = sketch.reshape(SLICES, -1)
    used = np.flatnonzero(slices.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.nulls(len(used), pa.int64()), pa.array(used, pa.int64()), pa.array(np.full(len(used), -1), pa.int64()), pa.array([slices[i].tobytes() for i in used], pa.binary())], names=names)


def _cells(members: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Which cells of shingles are common, counted over all texts: far above the mean; and into how many parts the buckets
    of each are dealt. The slices of the tasks' sketches are added by slice; the driver gets CELLS counts."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(counts, "<u4").astype(np.int64)
                sums[i] = sums[i] + x if i in sums else x
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["at", "counts"])

    slices = members.filter("n = -1").select(F.col("node").alias("at"), F.col("point").alias("counts"))
    total = np.zeros((SLICES, CELLS // SLICES), dtype=np.int64)
    for at, counts in slices.repartition(SLICES, "at").mapInArrow(add, "at long, counts binary").toLocalIterator():  # SLICES rows
        total[at] = np.frombuffer(counts, dtype=np.int64)
    mean, total = total.sum() / CELLS, total.ravel()
    return total > mean + 6 * mean**0.5 + 24, np.minimum(-(-total // FREQUENT), 1 << 30).astype(np.int32)


def _rare_first(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The order that prefixes are taken in, the same for all sets: shingles of common cells last."""
    last = common[(s >> U64(64 - CELL_BITS)).astype(np.int64)]
    return np.concatenate([s[~last], s[last]])


def _prefixes(percent: int, cells):
    """Of each set, once in a task: its node and the first shingles, with the part (-1: the only one) of their buckets."""

    def run(batches):
        seen: set[int] = set()
        common, dealt = cells.value
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = shingle_sets(part.column("text"))
                sigs, nodes, parts = [], [], []
                if len(seen) > 500_000:
                    seen.clear()
                for s in sets:
                    if not len(s):
                        continue
                    node = _fingerprint(s)
                    if node in seen:
                        continue
                    seen.add(node)
                    p = len(s) - (percent * len(s) + 99) // 100 + 1
                    sigs.append(_rare_first(s, common)[:p])
                    nodes.append(np.full(p, node, dtype=np.int64))
                    of = dealt[(sigs[-1] >> U64(64 - CELL_BITS)).astype(np.int64)]
                    parts.append(np.where(of > 1, (node >> 33) % np.maximum(of, 1), -1).astype(np.int32))
                if sigs:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(parts)), pa.array(np.concatenate(nodes))], names=["sig", "part", "node"])

    return run


def _buckets(batches):
    """Rows sorted by (sig, part, node), one bucket's rows together: those of buckets with two nodes at least or dealt in
    parts, each with the first and the preceding node of its bucket. Only the last row is kept from batch to batch."""
    last = None  # sig, part, first, node, whether it was given
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, part, node = (np.asarray(batch.column(i)) for i in range(3))
        keep = np.ones(len(sig), dtype=bool)
        keep[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        if last and (sig[0], node[0]) == (last[0], last[3]):
            keep[0] = False
        sig, part, node = sig[keep], part[keep], node[keep]
        if not len(sig):
            continue
        new = np.ones(len(sig), dtype=bool)
        new[1:] = (sig[1:] != sig[:-1]) | (part[1:] != part[:-1])
        starts = np.flatnonzero(new)
        first = node[starts][np.cumsum(new) - 1]
        before = np.concatenate([node[:1], node[:-1]])
        carried = last is not None and (sig[0], part[0]) == last[:2]
        follows = ~new
        if carried:
            first[: starts[1] if len(starts) > 1 else len(sig)] = last[2]
            before[0], follows[0] = last[3], True
        lead = np.zeros(len(sig), dtype=bool)  # a bucket's first row is given once a second one is there
        lead[:-1] = new[:-1] & ~new[1:]
        if carried:
            lead[0] = False
        alone = ~follows
        before[alone] = node[alone]
        use = follows | lead | (part >= 0)
        cols = [x[use] for x in (sig, node, first, before)]
        if carried and not last[4]:
            cols = [np.concatenate([[x], c]) for x, c in zip((last[0], last[2], last[2], last[2]), cols, strict=True)]
        last = (sig[-1], part[-1], first[-1], node[-1], bool(use[-1]))
        if len(cols[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["sig", "node", "first", "before"])


def _bounded(percent: int):
    """Pairs (a, b, na, nb, pa, pb): those that the bound leaves, with the bound's share of what is needed."""

    def run(batches):
        for batch in batches:
            a, b, na, nb = (np.asarray(batch.column(i)) for i in range(4))
            va, vb = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            need = least_overlap(na, nb, percent)
            fits = np.minimum(na, nb) >= need
            score = np.zeros(len(a))
            for i in np.flatnonzero(fits):
                x, y = counts_of(va[i]), counts_of(vb[i])
                g = min(len(x), len(y))
                score[i] = np.minimum(fold(x, g), fold(y, g)).sum() / need[i]
            ok = fits & (score >= 1)
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok]), pa.array(score[ok])], names=["a", "b", "score"])

    return run


def _met(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether two nodes share one of the signatures before this one: then an earlier bucket has the pair."""
    out = np.zeros(np.broadcast_shapes(p.shape[:-1], q.shape[:-1]), dtype=bool)
    for a in range(p.shape[-1]):
        for b in range(q.shape[-1]):
            out |= (p[..., a] == q[..., b]) & (p[..., a] != NONE)
    return out


def _blocks(k: int, size: int) -> list[np.ndarray]:
    return [np.arange(i, min(i + size, k)) for i in range(0, k, size)]


class RTree:
    """Points of one cell: leaves of LEAF, and above them nodes of FAN, up to one root. A box has the largest counts, the
    range of set sizes, and the component if it is one for all. With sides, only points of both sides are joined."""

    def __init__(self, n: np.ndarray, comp: np.ndarray, points: list[np.ndarray], before: np.ndarray, side: np.ndarray | None = None):
        self.n, self.comp, self.points, self.before = n, comp, points, before
        self.side = side if side is not None and side.any() else None
        self.g = min(512, min(len(p) for p in points))
        low = np.stack([fold(p, self.g) for p in points]).astype(np.uint32)
        order = np.lexsort((n, comp, np.floor(np.log(np.maximum(n, 1)) / np.log(4 / 3))))
        self.leaves = [order[x] for x in _blocks(len(order), LEAF)]
        self.low = [low[x] for x in self.leaves]
        one = lambda x: comp[x[0]] if (comp[x] == comp[x[0]]).all() else NONE
        box = (np.stack([x.max(axis=0) for x in self.low]), np.array([n[x].min() for x in self.leaves]), np.array([n[x].max() for x in self.leaves]), np.array([one(x) for x in self.leaves]))
        self.levels, self.below = [box], []
        while len(box[0]) > 1:
            own = _blocks(len(box[0]), FAN)
            box = (np.stack([box[0][x].max(axis=0) for x in own]), np.array([box[1][x].min() for x in own]), np.array([box[2][x].max() for x in own]), np.array([box[3][x[0]] if (box[3][x] == box[3][x[0]]).all() else NONE for x in own]))
            self.levels.append(box)
            self.below.append(own)

    def leaf_pairs(self, percent: int):
        """Pairs (i >= j) of leaves whose boxes, and those above them, leave a pair possible: from the root downward."""
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            k, i, j = stack.pop()
            if not k:
                yield i, j
                continue
            top, least, most, one = self.levels[k - 1]
            for a in self.below[k - 1][i]:
                others = self.below[k - 1][j]
                others = others[others <= a] if i == j else others
                need = least_overlap(least[a], least[others], percent)
                ok = (most[others] * 100 >= percent * least[a]) & (most[a] * 100 >= percent * least[others])
                ok &= (one[a] == NONE) | (one[others] != one[a])
                ok &= np.minimum(top[a], top[others]).sum(axis=1) >= need
                stack += [(k - 1, a, b) for b in others[ok]]

    def forest(self, percent: int, overlap=None):
        """Pairs (i, j) that join all components which the bound (or overlap(i, j), where given) leaves joined."""
        label, n = np.unique(self.comp, return_inverse=True)[1], self.n

        def folded(leaf: int) -> np.ndarray:
            own = [self.points[i] for i in self.leaves[leaf]]
            return np.stack([fold(p, min(map(len, own))) for p in own])

        sharp = Kept(folded)

        for a, b in self.leaf_pairs(percent):
            x, y = self.leaves[a], self.leaves[b]
            need = least_overlap(n[x][:, None], n[y][None, :], percent)
            ok = (label[x][:, None] != label[y][None, :]) & (np.minimum(n[x][:, None], n[y][None, :]) >= need)
            if self.side is not None:
                ok &= self.side[x][:, None] != self.side[y][None, :]
            if a == b:
                ok &= np.tri(len(x), len(y), -1, dtype=bool)
            if not ok.any():
                continue
            ok &= ~_met(self.before[x][:, None, :], self.before[y][None, :, :])
            for i in np.flatnonzero(ok.any(axis=1)):
                at = np.flatnonzero(ok[i])
                ok[i, at] = np.minimum(self.low[a][i], self.low[b][at]).sum(axis=1) >= need[i, at]
            if not ok.any():
                continue
            g = min(min(len(self.points[i]) for i in x), min(len(self.points[i]) for i in y))
            p, q = fold(sharp[a], g), fold(sharp[b], g)
            for i in np.flatnonzero(ok.any(axis=1)):
                at = np.flatnonzero(ok[i] & (label[y] != label[x[i]]))
                if not len(at):
                    continue
                bound = np.minimum(p[i], q[at]).sum(axis=1)
                hits = at[bound >= need[i, at]]
                for j in hits[np.argsort(-bound[bound >= need[i, at]] / need[i, hits], kind="stable")]:
                    u, v = x[i], y[j]
                    if label[u] != label[v] and (overlap is None or overlap(u, v) >= need[i, j]):
                        label[label == label[u]] = label[v]
                        yield u, v


def _few(sig, cell, node, comp, n, before, points, percent: int, overlap):
    """Forests (x, y) of the cells that one leaf holds, without a tree: row i with the rows behind it in its cell."""
    pairs: list[np.ndarray] = []
    for d in range(1, LEAF):
        same = (sig[d:] == sig[:-d]) & (cell[d:] == cell[:-d])
        if not same.any():
            break
        i = np.flatnonzero(same & (comp[d:] != comp[:-d]))
        i = i[(np.minimum(n[i], n[i + d]) >= least_overlap(n[i], n[i + d], percent)) & ~_met(before[i], before[i + d])]
        pairs.append(np.stack([i, i + d], axis=1))
    if not pairs:
        return
    all_ = np.concatenate(pairs)
    linked: dict[tuple[int, int], bool] = {}
    at, root = None, {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for x, y in all_[np.argsort(all_[:, 0], kind="stable")].tolist():
        if at != (sig[x], cell[x]):
            at, root = (sig[x], cell[x]), {}
        u, v = find(comp[x]), find(comp[y])
        if u == v:
            continue
        key = (node[x], node[y]) if node[x] < node[y] else (node[y], node[x])
        if key not in linked:
            p, q = points(x), points(y)
            g, need = min(len(p), len(q)), least_overlap(n[x], n[y], percent)
            linked[key] = np.minimum(fold(p, g), fold(q, g)).sum() >= need and (overlap is None or overlap(x, y) >= need)
        if linked[key]:
            root[u] = v
            yield x, y


def _tree_join(percent: int, exact: bool):
    """Rows (sig, cell, side, node, comp, n, point or members, earlier signatures) sorted by (sig, cell, node): the forest
    (sig, cell, a, b) of each cell. Cells of the same nodes are joined once. What is kept from batch to batch is the last
    cell, of bounded size. exact: rows have whole sets, and pairs are links."""

    def joined(rows: pa.Table) -> pa.RecordBatch:
        sig, cell, side, node, comp, n = (rows.column(i).to_numpy() for i in range(6))
        before = np.stack([rows.column(7 + k).to_numpy() for k in range(EARLIER)], axis=1)
        held = rows.column(6)
        new = np.ones(len(sig), dtype=bool)
        new[1:] = (sig[1:] != sig[:-1]) | (cell[1:] != cell[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(sig)))
        found: list[tuple[int, int]] = []
        members = Kept(lambda i: np.frombuffer(held[int(i)].as_py(), U64))
        points = Kept(lambda i: counts_of(point(members[i]) if exact else held[int(i)].as_py()))
        overlap = (lambda i, j: len(np.intersect1d(members[i], members[j], assume_unique=True))) if exact else None
        rest = np.flatnonzero(np.repeat(sizes <= LEAF, sizes))
        if len(rest):
            exactly = (lambda i, j: overlap(rest[i], rest[j])) if exact else None
            found += [(rest[x], rest[y]) for x, y in _few(*(c[rest] for c in (sig, cell, node, comp, n, before)), lambda i: points[rest[i]], percent, exactly)]
        for k in np.flatnonzero(sizes > LEAF):
            x, base = slice(starts[k], starts[k] + sizes[k]), starts[k]
            if (comp[x] == comp[base]).all():
                continue
            tree = RTree(n[x], comp[x], [points.make(i) for i in range(base, base + sizes[k])], before[x], side[x])
            found += [(base + i, base + j) for i, j in tree.forest(percent, (lambda i, j: overlap(base + i, base + j)) if exact else None)]  # noqa: B023
        i, j = (np.array([p[k] for p in found], dtype=np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (sig[i], cell[i], np.minimum(node[i], node[j]), np.maximum(node[i], node[j]))], names=["sig", "cell", "a", "b"])

    return _by_cell(joined)


def _by_cell(work):
    """work(rows) of whole cells, of rows sorted by (sig, cell)."""

    def run(batches):
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, cell = (batch.column(i).to_numpy() for i in (0, 1))
            last = np.flatnonzero((sig != sig[-1]) | (cell != cell[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if kept and (sig[0], cell[0]) != (kept[-1].column(0)[-1].as_py(), kept[-1].column(1)[-1].as_py()):
                yield work(pa.Table.from_batches(kept))
                kept = []
            if cut:
                yield work(pa.Table.from_batches([*kept, batch.slice(0, cut)]))
                kept = []
            kept.append(batch.slice(cut))
        if kept:
            yield work(pa.Table.from_batches(kept))

    return run


def _with_partners(percent: int):
    """The rows (sig, cell, side, node, comp, n, earlier signatures) that have a partner in their cell: of another component, a
    size that fits, and no earlier bucket in common. Points go only with these."""

    def partners(sig, cell, side, comp, n, before) -> np.ndarray:
        keep = np.zeros(len(sig), dtype=bool)
        new = np.ones(len(sig), dtype=bool)
        new[1:] = (sig[1:] != sig[:-1]) | (cell[1:] != cell[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(sig)))
        for d in range(1, LEAF):
            i = np.flatnonzero((sig[d:] == sig[:-d]) & (cell[d:] == cell[:-d]) & (comp[d:] != comp[:-d]))
            i = i[(np.minimum(n[i], n[i + d]) >= least_overlap(n[i], n[i + d], percent)) & ~_met(before[i], before[i + d])]
            keep[i] = keep[i + d] = True
        for k in np.flatnonzero(sizes > LEAF):
            x = np.arange(starts[k], starts[k] + sizes[k])
            split = side[x].any()
            for at in range(0, len(x), 128):
                y = x[at : at + 128][:, None]
                ok = (comp[y] != comp[x]) & (np.minimum(n[y], n[x]) >= least_overlap(n[y], n[x], percent))
                if split:
                    ok &= side[y] != side[x]
                if ok.any():
                    ok &= ~_met(before[y], before[x][None, :, :])
                keep[y[:, 0]] |= ok.any(axis=1)
        return keep

    def kept(rows: pa.Table) -> pa.Table:
        sig, cell, side, comp, n = (rows.column(i).to_numpy() for i in (0, 1, 2, 4, 5))
        before = np.stack([rows.column(6 + k).to_numpy() for k in range(EARLIER)], axis=1)
        return rows.filter(pa.array(partners(sig, cell, side, comp, n, before)))

    def run(batches):
        for out in _by_cell(kept)(batches):
            yield from out.to_batches()

    return run


def _bloom(own: Scratch, keys: DataFrame):
    """(filter as bytes, broadcast; its bits; column of a key's bit) of a one-column table."""
    n, name = keys.count(), keys.columns[0]
    bits = min(BLOOM_MOST, max(CHUNK, 1 << (BLOOM_SHARE * n).bit_length()))

    def fill(batches):
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            bit = np.unique(np.asarray(batch.column(0)))
            for x in np.split(bit, np.flatnonzero(np.diff(bit // CHUNK)) + 1) if len(bit) else []:
                own = maps.setdefault(int(x[0]) // CHUNK, np.zeros(CHUNK, dtype=np.uint8))
                own[x % CHUNK] = 1
        yield pa.RecordBatch.from_arrays([pa.array(list(maps), pa.int64()), pa.array([np.packbits(m, bitorder="little").tobytes() for m in maps.values()], pa.binary())], names=["at", "map"])

    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    chunks = keys.select(bit(name).alias("bit")).repartition((F.col("bit") / CHUNK).cast("long")).mapInArrow(fill, "at long, map binary")
    out = np.zeros(bits // 8, dtype=np.uint8)
    for at, part in chunks.toLocalIterator():  # bits / CHUNK rows of 4 KB at most
        out[at * CHUNK // 8 : (at + 1) * CHUNK // 8] = np.frombuffer(part, np.uint8)
    return own.broadcast(out), bit


def _in(batch: pa.RecordBatch, bloom) -> pa.RecordBatch:
    at = np.asarray(batch.column("bit"))
    return batch.filter(pa.array((bloom.value[at >> 3] >> (at & 7)) & 1 == 1))


def _sets(own: Scratch, texts: DataFrame, nodes: DataFrame, needed: DataFrame) -> DataFrame:
    """node and members of the needed nodes, each once. A Bloom filter leaves other texts out before they are cut into
    shingles."""
    of_doc, doc_bit = _bloom(own, needed.join(nodes, "node").select("doc_id"))

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for part in pieces(_in(batch, of_doc), "text"):
                sets = {_fingerprint(s): s for s in shingle_sets(part.column("text")) if len(s)}
                sets = {k: s for k, s in sets.items() if k not in seen}
                if len(seen) > 500_000:
                    seen.clear()
                seen.update(sets)
                yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), pa.array([s.tobytes() for s in sets.values()], pa.binary())], names=["node", "members"])

    found = texts.withColumn("bit", doc_bit("doc_id")).mapInArrow(run, "node long, members binary")
    return found.dropDuplicates(["node"])


def _verified(percent: int):
    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
            ok = []
            for i, (p, q) in enumerate(zip(x, y, strict=True)):
                p, q = np.frombuffer(p, U64), np.frombuffer(q, U64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= percent * (len(p) + len(q) - both):
                    ok.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in ok], pa.int64()), pa.array([b[i] for i in ok], pa.int64())], names=["a", "b"])

    return run


def _verify(own: Scratch, texts: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets link."""
    sets = _sets(own, texts, nodes, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("members").alias("y")), "b").select("a", "b", "x", "y")
    return both.mapInArrow(_verified(percent), "a long, b long")


def components(own: Scratch, edges: DataFrame) -> DataFrame:
    """(node, comp) of every node in edges (a, b): comp is the smallest node that links reach. Labels spread along
    edges and jump to their label's label, until none changes; each round is a written table."""
    both = own.table(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = own.table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("comp").alias("near"))
        spread = labels.join(near, labels.node == near.a, "left").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        new = own.table(spread.join(jump, "comp", "left").select("node", "was", F.least("comp", "root").alias("comp")), "labels")
        if not new.filter("comp <> was").limit(1).count():
            return new.select("node", "comp")
        labels = new.select("node", "comp")


def near_join(spark: SparkSession, docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id of every document; documents link when 100 * overlap >= percent * union."""
    return groups(spark, docs, percent).select("doc_id", "n_shingles", "component_id")


def groups(spark: SparkSession, docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, node, n_shingles, root, component_id of every document: node stands for its set, root for its component
    (rows without shingles are components each, whatever their root). The result is a written table; what was written on
    the way is deleted."""
    small_batches(spark, 2000)
    own = Scratch(spark)
    texts = docs.select("doc_id", "text")
    every = own.table(texts.mapInArrow(_nodes, "doc_id long, node long, n long, point binary"), "members")
    members = every.filter("n >= 0").select("doc_id", "node", "n")
    cells = own.broadcast(_cells(every))  # CELLS booleans and counts
    prefixes = texts.mapInArrow(_prefixes(percent, cells), "sig long, part int, node long")
    rows = prefixes.repartition("sig", "part").sortWithinPartitions("sig", "part", "node").mapInArrow(_buckets, "sig long, node long, first long, before long")
    rows = own.table(rows, "buckets")
    nodes = own.table(members.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(rows.select("node").distinct(), "node", "left_semi"), "nodes")
    points = every.filter("n > 0").join(nodes.select("node"), "node", "left_semi").select("node", "n", "point")
    points = own.table(points.dropDuplicates(["node"]), "points")

    near = rows.select(F.col("node").alias("b"), F.explode(F.array("first", "before")).alias("a")).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = own.table(_verify(own, texts, nodes, own.table(_proposed(near, points, percent), "near"), percent), "found")
    comp = components(own, links)

    names = [f"e{k}" for k in range(1, EARLIER + 1)]
    at = _open(rows, comp, points.select("node", "n"), percent).select("sig", "cell", "side", "node", "comp", "n", *names)
    at = at.repartition("sig", "cell").sortWithinPartitions("sig", "cell", "node").mapInArrow(_with_partners(percent), at.schema)
    at = own.table(at.select("sig", "cell", "side", "node", *names), "open")
    pairs = own.table(_joined(_with_points(at, comp, points, "point"), percent, exact=False), "pairs")
    told = own.table(pairs.select("a", "b").distinct(), "told")
    late = own.table(_verify(own, texts, nodes, told, percent), "found")
    links = links.union(late)
    again = pairs.join(told.join(late, ["a", "b"], "left_anti"), ["a", "b"], "left_semi").select("sig", "cell").distinct()
    again = own.table(again, "again")
    if again.limit(1).count():
        links = own.table(links, "found")
        comp = components(own, links)
        redo = own.table(at.join(again, ["sig", "cell"], "left_semi"), "redo")
        whole = _sets(own, texts, nodes, redo.select("node").distinct()).join(points.select("node", "n"), "node")
        links = links.union(own.table(_joined(_with_points(redo, comp, whole, "members"), percent, exact=True).select("a", "b").distinct(), "found"))
    final = components(own, links).withColumnRenamed("comp", "root")

    labelled = members.join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = labelled.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    full = labelled.join(smallest, "root", "left")
    out = full.select("doc_id", "node", F.col("n").alias("n_shingles"), "root", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    out = own.table(out, "groups", keep=True)
    own.close()
    return out


def _open(rows: DataFrame, comp: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """sig, cell, side, node, comp, n, earlier signatures: rows of buckets that hold several components, in cells. A bucket
    beyond CELL nodes or WEIGHT shingles is cut into tiles of like sizes and components, and a cell is a pair of tiles that may
    hold a pair: of near sizes, not of one and the same component. Nothing is ordered or gathered by bucket."""
    at = rows.select("sig", "node").join(sizes, "node").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    most = F.ceil(F.greatest(F.count("*") / CELL, F.sum("n") / WEIGHT)).cast("int")
    buckets = at.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"), most.alias("t"), F.bit_xor(F.xxhash64("node")).alias("who")).filter("lo <> hi")
    buckets = buckets.groupBy("who", "m").agg(F.min("sig").alias("sig"), F.first("t").alias("t"))  # those of the same nodes are joined once
    order = W.partitionBy("node").orderBy("sig")
    earlier = [F.coalesce(F.lag("sig", k).over(order), F.lit(NONE)).alias(f"e{k}") for k in range(1, EARLIER + 1)]
    at = at.join(buckets.select("sig", "t"), "sig").select("*", *earlier)
    names = [f"e{k}" for k in range(1, EARLIER + 1)]
    whole = at.filter("t = 1").select("sig", F.lit(0).cast("long").alias("cell"), F.lit(0).alias("side"), "node", "comp", "n", *names)
    large = at.filter("t > 1").withColumn("size", F.floor(F.log(F.col("n").cast("double")) / math.log(100 / min(percent, 99))).cast("int")).withColumn("own", F.pmod(F.xxhash64("comp"), F.col("t")).cast("int"))
    parts = large.groupBy("sig", "size", "own").agg(most.alias("parts"))
    large = large.join(parts, ["sig", "size", "own"]).withColumn("tile", F.xxhash64("size", "own", F.pmod(F.xxhash64("node"), F.col("parts"))))
    tiles = large.groupBy("sig", "tile", "size").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    x, y = tiles.alias("x"), tiles.alias("y")
    near = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.tile") <= F.col("y.tile")) & (F.abs(F.col("x.size") - F.col("y.size")) <= 1)
    apart = ~((F.col("x.lo") == F.col("x.hi")) & (F.col("y.lo") == F.col("y.hi")) & (F.col("x.lo") == F.col("y.lo")))
    met = x.join(y, near & apart).select(F.col("x.sig").alias("sig"), F.col("x.tile").alias("p"), F.col("y.tile").alias("q")).withColumn("cell", F.xxhash64("p", "q"))
    sides = met.select("sig", "cell", F.explode(F.when(F.col("p") == F.col("q"), F.array(F.struct(F.col("p").alias("tile"), F.lit(0).alias("side")))).otherwise(F.array(F.struct(F.col("p").alias("tile"), F.lit(0).alias("side")), F.struct(F.col("q").alias("tile"), F.lit(1).alias("side"))))).alias("s")).select("sig", "cell", "s.*")
    return whole.unionByName(large.join(sides, ["sig", "tile"]).select("sig", "cell", "side", "node", "comp", "n", *names))


def _with_points(at: DataFrame, comp: DataFrame, sets: DataFrame, held: str) -> DataFrame:
    full = at.join(sets.select("node", "n", held), "node").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    return full.select("sig", "cell", "side", "node", "comp", "n", held, *[f"e{k}" for k in range(1, EARLIER + 1)])


def _joined(rows: DataFrame, percent: int, exact: bool) -> DataFrame:
    return rows.repartition("sig", "cell").sortWithinPartitions("sig", "cell", "node").mapInArrow(_tree_join(percent, exact), "sig long, cell long, a long, b long")


def _proposed(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) to verify early, of candidates given once a bucket: per b, of the TRIED that fit in size and meet in most
    buckets, the PROPOSALS of the highest bound. Points go with few pairs so; what is passed over here, the R-tree
    join finds."""
    sizes = points.select("node", "n")
    met = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"))
    met = met.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
    met = met.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    tried = met.withColumn("k", F.row_number().over(W.partitionBy("b").orderBy(F.desc("shared"), "a"))).filter(F.col("k") <= TRIED).select("a", "b")
    x = points.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    y = points.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))
    best = tried.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "pa", "pb").mapInArrow(_bounded(percent), "a long, b long, score double")
    return best.withColumn("k", F.row_number().over(W.partitionBy("b").orderBy(F.desc("score"), "a"))).filter(F.col("k") <= PROPOSALS).select("a", "b")
