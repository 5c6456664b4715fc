"""Embedding near-duplicates by cross-polytope hashing after fast Hadamard rotations.

A vector, scaled to length one and padded to a power of two, is turned by three rounds
of random signs and a fast Hadamard transform; its hash is the axis it lies closest to,
with its sign. A table joins ``hashes`` such axes to one bucket. Every vector is stored
in one bucket a table and looks itself up there and in the next likely buckets
(multiprobe: the second-best axes, by how much they lose), so a pair may meet in either
direction. Pairs that meet are verified by their cosine in double precision.

Equal vectors become one node first, so copies are neither hashed nor paired again;
they count as links of each other and of what links with one of them.

Nodes travel as packed records (name, copies, components, axes in one table), a few tables
or a share of one table at a time, so that no pass holds much more than the vectors
themselves; its shuffle files go before the next. Buckets that begin with the same axes
meet in one task. First components travel as single bytes, whose cosine bounds the true
one: nodes that meet none which may reach the threshold link with nothing. The others
travel whole: a task verifies the pairs that meet there and counts a pair where it meets
first (earlier tables are hashed again, for pairs that are near). What leaves a task is
a row for each node it found links of, however many they are. A task holds the nodes of
its buckets: more axes are taken while a group of buckets is large, but one bucket is
never split.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import connected_components, materialise

TABLES, HASHES, PROBES = 16, 3, 8
SEED = 20240502
PASS_BYTES, PASS_SHARE = 256 << 20, 2.2  # a pass may hold so many bytes, or so many times the vectors'
PART_BYTES = 32 << 20                    # of records that a task of a pass reads, if they spread evenly
GROUP = 400_000                          # records of buckets that begin alike, beyond which another axis is taken
DENSE = 1 << 14                          # pairs of a bucket from which they are compared as a matrix
TILE = 1024                              # rows and columns of such a matrix at once
PAIRS = 1 << 14                          # pairs of 64 components compared at once elsewhere
HASHED = 1024                            # vectors hashed at once


def hadamard(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """Normalised fast Hadamard transform of each column (a power of two long); ``x`` and ``spare`` are written over."""
    d, n = x.shape
    h = 1
    while h < d:
        old, new = x.reshape(d // (2 * h), 2, h, n), spare.reshape(d // (2 * h), 2, h, n)
        np.add(old[:, 0], old[:, 1], out=new[:, 0])
        np.subtract(old[:, 0], old[:, 1], out=new[:, 1])
        x, spare = spare, x
        h *= 2
    x /= np.sqrt(d).astype(x.dtype)
    return x


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Columns of ``x`` after rounds of signs and transforms, as rows."""
    a, b = np.empty_like(x), np.empty_like(x)
    for s in signs:
        np.multiply(x, s[:, None].astype(x.dtype), out=a)
        x = hadamard(a, b)
        a, b = (b, a) if x is a else (a, b)
    return np.ascontiguousarray(x.T)


def padded(size: int) -> int:
    """Length that vectors of ``size`` components are padded to."""
    return 1 << max(1, int(np.ceil(np.log2(size))))


def changes(hashes: int, ranks: int) -> list[tuple[tuple[int, int], ...]]:
    """What the other buckets of a table change: one axis to a lesser rank, or two to the second."""
    return ([((j, r),) for j in range(hashes) for r in range(1, ranks)]
            + [((j, 1), (k, 1)) for j in range(hashes) for k in range(j + 1, hashes)])


def nearest_axes(x: np.ndarray, table: int, seed: int, hashes: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """(axes, chosen) of each column in a table: the axes of each hash, best first, and which
    ``changes`` make its other buckets: ``probes`` of them, least loss of length first."""
    d, n = x.shape
    rng = np.random.default_rng([seed, table, d])
    ranks, at = min(3, d), np.arange(n)
    axes, losses = np.empty((n, hashes, ranks), np.int64), np.empty((n, hashes, ranks), x.dtype)
    for j in range(hashes):
        y = rotate(x, rng.integers(0, 2, (3, d)) * 2.0 - 1.0)
        size = np.abs(y)
        for r in range(ranks):
            top = size.argmax(axis=1)
            axes[:, j, r] = top * 2 + (y[at, top] < 0)
            losses[:, j, r] = size[at, top]
            size[at, top] = -1.0
    losses = losses[:, :, :1] - losses
    made = changes(hashes, ranks)
    cost = np.stack([sum(losses[:, j, r] ** 2 for j, r in change) for change in made], 1)
    chosen = np.zeros((n, len(made)), bool)
    np.put_along_axis(chosen, np.argsort(cost, axis=1, kind="stable")[:, :probes], True, axis=1)
    return axes, chosen


def bucket_codes(axes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Codes of each row's buckets in a table: its own first, then those of all ``changes``."""
    n, hashes, ranks = axes.shape
    axes = axes.astype(weights.dtype)
    other = (axes - axes[:, :, :1]) * weights[:, None]
    codes = np.empty((n, 1 + len(changes(hashes, ranks))), weights.dtype)
    codes[:, 0] = axes[:, :, 0] @ weights
    for c, change in enumerate(changes(hashes, ranks), 1):
        codes[:, c] = codes[:, 0]
        for j, r in change:
            codes[:, c] += other[:, j, r]
    return codes


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision; the largest component first, against overflow."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None] + 0.0


class Layout:
    """Packed records of vectors of ``size`` components of type ``kind``, and where their buckets lie."""

    def __init__(self, size: int, kind: str, hashes: int, probes: int, seed: int):
        self.size, self.probes, self.seed, self.d = size, probes, seed, padded(size)
        bits = int(np.log2(self.d)) + 1
        self.hashes, self.ranks = min(hashes, 60 // bits), min(3, self.d)
        self.others = len(changes(self.hashes, self.ranks))
        self.weights = np.array([(2 * self.d) ** k for k in range(self.hashes)], np.int32 if bits * self.hashes < 31 else np.int64)
        axis = next(t for t in ("<u1", "<u2", "<u4", "<u8") if bits <= 8 * int(t[2]))
        self.table = np.dtype([("axes", axis, (self.hashes, self.ranks)), ("chosen", "u1", (-(-self.others // 8),))])
        self.record = np.dtype([("node", "<u8", (2,)), ("copies", "<i8"), ("vector", kind, (size,))])
        self.whole = np.dtype([("record", self.record), ("table", self.table)])
        self.sketch = np.dtype([("node", "<u8", (2,)), ("vector", "i1", (size,)), ("table", self.table)])

    def packed(self, node: bytes, copies: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), self.record)
        out["node"], out["copies"], out["vector"] = np.frombuffer(node, "<u8").reshape(-1, 2), copies, x
        return out

    def dealt(self, rec: np.ndarray, table: np.ndarray, at: np.ndarray, whole: bool) -> np.ndarray:
        """Records as they travel, ``whole`` or as sketches: components in 127ths of the largest."""
        out = np.empty(len(at), self.whole if whole else self.sketch)
        out["table"] = table[at]
        if whole:
            out["record"] = rec[at]
        else:
            out["node"] = rec["node"][at]
            x = rec["vector"] / np.abs(rec["vector"]).max(axis=1, keepdims=True)
            out["vector"] = np.rint(x * 127).astype(np.int8)[at]
        return out

    def hashed(self, x: np.ndarray, table: int) -> np.ndarray:
        """Axes of the vectors' buckets in a table."""
        out = np.empty(len(x), self.table)
        for k in range(0, len(x), HASHED):
            part = x[k:k + HASHED]
            columns = np.zeros((self.d, len(part)), np.float32)  # of any length: hashes depend on the direction
            columns[:self.size] = (part / np.abs(part).max(axis=1, keepdims=True)).T
            axes, chosen = nearest_axes(columns, table, self.seed, self.hashes, self.probes)
            out["axes"][k:k + HASHED], out["chosen"][k:k + HASHED] = axes, np.packbits(chosen, axis=1)
        return out

    def own(self, table: np.ndarray) -> np.ndarray:
        """Codes of the buckets where records are stored."""
        return table["axes"][:, :, 0].astype(self.weights.dtype) @ self.weights

    def buckets(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, kept): codes of records' buckets, own first, and which of them are looked up."""
        kept = np.ones((len(table), 1 + self.others), bool)
        kept[:, 1:] = np.unpackbits(table["chosen"], axis=1, count=self.others)
        return bucket_codes(table["axes"], self.weights), kept

    def places(self, codes: np.ndarray, table: int, depth: int, cells: int) -> np.ndarray:
        """Number below ``cells``, the same for buckets whose first ``depth`` axes are."""
        starts = (2 * self.d) ** min(depth, self.hashes)
        start, shift = codes & (starts - 1), xxhash.xxh64_intdigest(f"{table}:{self.size}") % cells
        return ((np.arange(starts) + shift) % cells)[start] if starts <= 1 << 16 else (start.astype(np.int64) + shift) % cells


def _binary(x: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values: bytes of ``x`` up to each of ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x).view(np.uint8))])


class Meeting:
    """Records that meet in buckets of one table."""

    def __init__(self, vectors: np.ndarray, layout: Layout, threshold: float, dense: int, tile: int):
        self.layout, self.threshold, self.dense, self.tile = layout, threshold, dense, tile
        # What single precision may be off by, rounding of the components included.
        self.margin = (layout.size + 8) * 2.0 ** -23
        self.pairs = max(1, PAIRS * 64 // max(64, layout.size))
        self.unit = np.empty((len(vectors), layout.size), np.float32)
        for k in range(0, len(vectors), self.pairs):
            x = vectors[k:k + self.pairs].astype(np.result_type(vectors, np.float32))
            x = (x / np.abs(x).max(axis=1, keepdims=True)).astype(np.float32)
            self.unit[k:k + self.pairs] = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]

    def find(self, here: np.ndarray, codes: np.ndarray) -> None:
        """Compare what is stored in a bucket with what looks itself up there; ``here`` says in which."""
        own = np.flatnonzero(here[:, 0])
        own = own[np.argsort(codes[own, 0], kind="stable")]
        keys, starts, counts = np.unique(codes[own, 0], return_index=True, return_counts=True)
        if not len(keys):
            return
        seen, which = np.nonzero(here)
        wanted = codes[seen, which]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = np.flatnonzero((keys[at] == wanted) & ((which > 0) | (counts[at] > 1)))
        seen, probe, at = seen[hit], which[hit] > 0, at[hit]
        dense = (np.bincount(at, minlength=len(keys)) * counts)[at] >= self.dense
        many = np.flatnonzero(dense)
        many = many[np.argsort(at[many], kind="stable")]
        for of_bucket in np.split(many, np.flatnonzero(np.diff(at[many])) + 1) if len(many) else []:
            b = at[of_bucket[0]]
            stored = own[starts[b]:starts[b] + counts[b]]
            self.matrix(stored, stored, False)
            self.matrix(stored, seen[of_bucket[probe[of_bucket]]], True)
        seen, probe, at = seen[~dense], probe[~dense], at[~dense]
        ends = np.cumsum(counts[at])
        lo = 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + self.pairs, "right")))
            n = counts[at[lo:hi]]
            y, p = np.repeat(seen[lo:hi], n), np.repeat(probe[lo:hi], n)
            x = own[np.repeat(starts[at[lo:hi]] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            once = np.flatnonzero((p | (x < y)) & self.wanted(x, y))  # two that are stored in a bucket look each other up
            x, y, p = x[once], y[once], p[once]
            self.settle(x, y, p, np.einsum("ij,ij->i", self.unit[x], self.unit[y]))
            lo = hi


class Marks(Meeting):
    """Which records may link with one that they meet, as far as sketches tell."""

    def __init__(self, dealt: np.ndarray, layout: Layout, threshold: float, dense: int, tile: int):
        super().__init__(dealt["vector"], layout, threshold, dense, tile)
        self.marked = np.zeros(len(dealt), bool)
        length = np.sqrt((dealt["vector"].astype(np.float32) ** 2).sum(axis=1))
        # A component is rounded by half at most: a sketch is turned by no more than this angle.
        off = 0.501 * np.sqrt(layout.size) / length
        self.turned = np.where(off < 1, np.arcsin(np.minimum(off, 1)), np.pi)
        self.angle = np.arccos(np.clip(threshold, -1, 1))
        self.least = np.cos(np.minimum(np.pi, self.angle + 2 * self.turned.max(initial=0))) - self.margin

    def wanted(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return ~(self.marked[x] & self.marked[y])

    def matrix(self, stored: np.ndarray, seen: np.ndarray, probe: bool) -> None:
        self.compare(stored[:1], seen)
        for a in range(0, len(stored), self.tile):
            for b in range(0 if probe else a, len(seen), self.tile):
                x, y = stored[a:a + self.tile], seen[b:b + self.tile]
                self.compare(x[~self.marked[x]], y)
                self.compare(x, y[~self.marked[y]])

    def compare(self, x: np.ndarray, y: np.ndarray) -> None:
        least = np.cos(np.minimum(np.pi, self.angle + self.turned[x][:, None] + self.turned[y].max(initial=0)))
        near = (self.unit[x] @ self.unit[y].T >= least - self.margin) & (x[:, None] != y[None, :])
        self.marked[x[near.any(axis=1)]] = True
        self.marked[y[near.any(axis=0)]] = True

    def settle(self, x: np.ndarray, y: np.ndarray, probe: np.ndarray, cosine: np.ndarray) -> None:
        near = np.flatnonzero(cosine >= self.least)
        x, y, cosine = x[near], y[near], cosine[near]
        near = cosine >= np.cos(np.minimum(np.pi, self.angle + self.turned[x] + self.turned[y])) - self.margin
        self.marked[x[near]] = True
        self.marked[y[near]] = True


class Links(Meeting):
    """Links between records that meet: sums of copies, and roots, by record."""

    def __init__(self, dealt: np.ndarray, layout: Layout, table: int, threshold: float, dense: int, tile: int):
        self.rec, self.table = dealt["record"], table
        super().__init__(self.rec["vector"], layout, threshold, dense, tile)
        self.tables = {table: (dealt["table"], np.ones(len(dealt), bool))}
        self.copies = np.ascontiguousarray(self.rec["copies"])
        self.others, self.parent = np.zeros(len(dealt), np.int64), np.arange(len(dealt))

    def wanted(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.ones(len(x), bool)

    def axes_in(self, table: int, rows: np.ndarray) -> np.ndarray:
        """Axes of some records in a table, hashed when first asked for."""
        if table not in self.tables:
            self.tables[table] = np.empty(len(self.rec), self.layout.table), np.zeros(len(self.rec), bool)
        axes, known = self.tables[table]
        new = np.unique(rows[~known[rows]])
        if len(new):
            axes[new], known[new] = self.layout.hashed(self.rec["vector"][new], table), True
        return axes[rows]

    def matrix(self, stored: np.ndarray, seen: np.ndarray, probe: bool) -> None:
        for a in range(0, len(stored), self.tile):
            for b in range(0 if probe else a, len(seen), self.tile):
                x, y = stored[a:a + self.tile], seen[b:b + self.tile]
                cosine = self.unit[x] @ self.unit[y].T
                near = cosine >= self.threshold - self.margin
                if not probe and a == b:
                    near = np.triu(near, 1)
                if not probe and self.table == 0:
                    self.settle_all(x, y, near, cosine)
                    continue
                for t in range(self.table):  # most that are near have met in an earlier table
                    if np.count_nonzero(near) < self.tile:
                        break
                    near &= self.layout.own(self.axes_in(t, x))[:, None] != self.layout.own(self.axes_in(t, y))[None, :]
                i, j = np.nonzero(near)
                for k in range(0, len(i), self.pairs):
                    u, v = i[k:k + self.pairs], j[k:k + self.pairs]
                    self.settle(x[u], y[v], np.full(len(u), probe), cosine[u, v])

    def settle_all(self, x: np.ndarray, y: np.ndarray, near: np.ndarray, cosine: np.ndarray) -> None:
        """``settle`` for what is stored in a bucket of the first table: no pair has met before."""
        i, j = np.nonzero(near & (cosine <= self.threshold + self.margin))
        for k in range(0, len(i), self.pairs):
            u, v = i[k:k + self.pairs], j[k:k + self.pairs]
            near[u, v] = self.exact(x[u], y[v]) >= self.threshold
        many = near.astype(np.float64)  # sums below 2 ** 53 are exact
        np.add.at(self.others, x, (many @ self.copies[y].astype(np.float64)).astype(np.int64))
        np.add.at(self.others, y, (self.copies[x].astype(np.float64) @ many).astype(np.int64))
        first = near.argmax(axis=1)
        some = near[np.arange(len(x)), first]
        self.unite(x[some], y[first[some]])
        i, j = np.nonzero(near & (self.parent[x][:, None] != self.parent[y][None, :]))
        self.unite(x[i], y[j])

    def exact(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", unit_rows(self.rec["vector"][x]), unit_rows(self.rec["vector"][y]))

    def settle(self, x: np.ndarray, y: np.ndarray, probe: np.ndarray, cosine: np.ndarray) -> None:
        """Count pairs that reach the threshold and meet here first; ``probe``: y looks itself up where x is stored."""
        near = np.flatnonzero(cosine >= self.threshold - self.margin)
        sure = cosine[near] > self.threshold + self.margin
        close = near[~sure]
        sure[~sure] = self.exact(x[close], y[close]) >= self.threshold
        near = near[sure]
        x, y, probe = x[near], y[near], probe[near]
        for t in range(self.table):
            if not len(x):
                return
            mine, theirs = self.axes_in(t, x), self.axes_in(t, y)
            fresh = ~(self.holds(mine, theirs) | self.holds(theirs, mine))
            x, y, probe = x[fresh], y[fresh], probe[fresh]
        # Where each is stored where the other looks, the lesser one counts.
        more = np.flatnonzero(probe)
        name_x, name_y = self.rec["node"][x[more]], self.rec["node"][y[more]]
        more = more[(name_x[:, 0] > name_y[:, 0]) | ((name_x[:, 0] == name_y[:, 0]) & (name_x[:, 1] > name_y[:, 1]))]
        more = more[self.holds(self.axes_in(self.table, x[more]), self.axes_in(self.table, y[more]))]
        x, y = np.delete(x, more), np.delete(y, more)
        np.add.at(self.others, x, self.copies[y])
        np.add.at(self.others, y, self.copies[x])
        self.unite(x, y)

    def holds(self, looks: np.ndarray, stored: np.ndarray) -> np.ndarray:
        """Whether the first looks itself up where the second is stored, in one table."""
        codes, kept = self.layout.buckets(looks)
        return (kept & (codes == self.layout.own(stored)[:, None])).any(axis=1)

    def unite(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            x, y = self.parent[x], self.parent[y]
            apart = x != y
            if not apart.any():
                return
            x, y = x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))
            while (self.parent[self.parent] != self.parent).any():
                self.parent = self.parent[self.parent]


def _named(pending: list[tuple[bytes, bytes, int]], size: int, kind: str):
    """(names, vectors, copies) of the rows of one length among ``pending``."""
    rows = [r for r in pending if len(r[1]) == size * np.dtype(kind).itemsize]
    x = np.frombuffer(b"".join(r[1] for r in rows), kind).reshape(len(rows), size)
    return b"".join(r[0] for r in rows), x, np.array([r[2] for r in rows], np.int64)


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9,
                 tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(rows, ties): rows of vec_id, node; ties of node, root, others.

    ``node`` names a distinct vector, null for those that link with nothing: null, empty
    and zero vectors and those with null, NaN or infinite components. Vectors of different
    length are never compared. Repeated rows are copies. Other columns are ignored.
    A node may have several ties: the sum of ``others`` is the number of rows of other
    nodes that it links with (a cosine of at least ``threshold``), each link counted once;
    roots are nodes, and the nodes that ties connect are those that links connect."""
    spark, pass_bytes, pass_share, part_bytes = vectors.sparkSession, PASS_BYTES, PASS_SHARE, PART_BYTES
    group, dense, tile = GROUP, DENSE, TILE
    given = vectors.select(F.col(f"`{vector_col}`").alias("v")).schema["v"].dataType.elementType.typeName()
    kind = "<f4" if given in ("float", "byte", "short") else "<f8"  # both hold the components as they are
    source = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                            F.col(f"`{vector_col}`").cast("array<float>" if kind == "<f4" else "array<double>").alias("v"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            lengths = pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False)
            values = v.flatten().to_numpy(zero_copy_only=False).astype(kind)  # nulls are NaN
            starts = np.cumsum(lengths) - lengths
            nodes, raw = [None] * len(v), [None] * len(v)
            for size in np.unique(lengths[lengths > 0]):
                at = np.flatnonzero(lengths == size)
                x = values[starts[at][:, None] + np.arange(size)]
                good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
                for i, full, unit in zip(at[good], x[good], unit_rows(x[good])):
                    nodes[i], raw[i] = hashlib.blake2b(unit.tobytes(), digest_size=16).digest(), full.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(nodes, pa.binary()), pa.array(raw, pa.binary())],
                                             ["vec_id", "node", "raw"])

    named = source.mapInArrow(read, "vec_id long, node binary, raw binary")
    distinct = named.filter("node is not null").groupBy("node").agg(F.first("raw").alias("raw"), F.count("*").alias("copies"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pending = list(zip(*(batch.column(c).to_pylist() for c in ("node", "raw", "copies"))))
            for size in sorted({len(r[1]) // np.dtype(kind).itemsize for r in pending}):
                layout = Layout(size, kind, hashes, probes, seed)
                node, x, copies = _named(pending, size, kind)
                rec = layout.packed(node, copies, x)
                yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([len(rec)], pa.int64()), pa.array([rec.tobytes()], pa.binary())],
                                                 ["size", "n", "block"])

    nodes = materialise(distinct.mapInArrow(pack, "size int, n long, block binary"), drop_shuffles=True)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Layout, np.ndarray]]:
        """Records of one length together, up to some ``part_bytes``."""
        held, amount = defaultdict(list), 0
        for batch in batches:
            for size, block in zip(batch.column("size").to_pylist(), batch.column("block").to_pylist()):
                held[size].append(block)
                amount += len(block)
                if amount >= part_bytes:
                    for s, them in held.items():
                        yield (layout := Layout(s, kind, hashes, probes, seed)), np.frombuffer(b"".join(them), layout.record)
                    held, amount = defaultdict(list), 0
        for s, them in held.items():
            yield (layout := Layout(s, kind, hashes, probes, seed)), np.frombuffer(b"".join(them), layout.record)

    def starts(nodes: DataFrame, depth: int) -> DataFrame:
        """How many nodes are looked up in the buckets that begin with the same axes, in two
        tables: turned at random, the others are much alike, and only sizes depend on it."""
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for layout, rec in blocks(batches):
                for t in range(min(2, tables)):
                    codes, kept = layout.buckets(layout.hashed(rec["vector"], t))
                    begin = np.where(kept, codes & ((2 * layout.d) ** min(depth, layout.hashes) - 1), -1).astype(np.int64)
                    begin.sort(axis=1)
                    first = begin >= 0
                    first[:, 1:] &= begin[:, 1:] != begin[:, :-1]
                    begin, n = np.unique(begin[first], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), v)) for v in (layout.size, t)] + [pa.array(begin), pa.array(n)], ["size", "t", "begin", "n"])

        return nodes.mapInArrow(count, "size long, t long, begin long, n long").groupBy("size", "t", "begin").agg(F.sum("n").alias("n"))

    def passes(nodes: DataFrame, whole: bool) -> DataFrame:
        """What the nodes' meetings give, over all tables: ties, or nodes that may have some."""
        n, weight, records = (x or 0 for x in nodes.agg(F.sum("n"), F.sum(F.col("n") * F.col("size")) * np.dtype(kind).itemsize, F.sum(F.length("block"))).first())
        depth, most, largest = 1, 3, n
        while largest > group and depth < hashes:
            largest = starts(nodes, depth).agg(F.max("n")).first()[0]
            if largest > group:
                depth, most = depth + 1, min(probes + 1, most + 3 * depth)
        records *= tables * most
        moved = records if whole else records * np.dtype("i1").itemsize / np.dtype(kind).itemsize + n * 16 * tables * most
        wanted = max(1, int(np.ceil(moved / max(pass_bytes, pass_share * weight))))
        shares, together = -(-wanted // tables), max(1, tables // wanted)
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(np.ceil(records * together / tables / shares / part_bytes)))
        found = None
        for t in range(0, tables, together):
            for share in range(shares):
                made = one_pass(nodes, range(t, min(t + together, tables)), share, shares, parts, depth, whole)
                found = made if found is None else found.unionByName(made)
        return found

    def one_pass(nodes: DataFrame, wanted: range, share: int, shares: int, parts: int, depth: int, whole: bool) -> DataFrame:
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for layout, rec in blocks(batches):
                for t in wanted:
                    table = layout.hashed(rec["vector"], t)
                    codes, kept = layout.buckets(table)
                    place = layout.places(codes, t, depth, shares * parts)
                    part = np.where(kept & (place % shares == share), place // shares, parts)
                    part.sort(axis=1)
                    first = part < parts
                    first[:, 1:] &= part[:, 1:] != part[:, :-1]
                    at, k = np.nonzero(first)
                    part = part[at, k]
                    out = layout.dealt(rec, table, at[np.argsort(part, kind="stable")], whole)
                    to, n = np.unique(part, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(to.astype(np.int32)), pa.array(np.full(len(to), t, np.int32)), pa.array(np.full(len(to), layout.size, np.int32)),
                         _binary(out, np.cumsum(n) * out.itemsize)], ["part", "t", "size", "block"])

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = defaultdict(list)
            for batch in batches:
                for part, t, size, block in zip(*(batch.column(c).to_pylist() for c in ("part", "t", "size", "block"))):
                    held[part, t, size].append(block)
            for part, t, size in sorted(held):
                layout = Layout(size, kind, hashes, probes, seed)
                dealt = np.frombuffer(b"".join(held.pop((part, t, size))), layout.whole if whole else layout.sketch)
                codes, kept = layout.buckets(dealt["table"])
                here = kept & (layout.places(codes, t, depth, shares * parts) == part * shares + share)
                names = np.ascontiguousarray(dealt["record"]["node"] if whole else dealt["node"])
                found = Links(dealt, layout, t, threshold, dense, tile) if whole else Marks(dealt, layout, threshold, dense, tile)
                found.find(here, codes)
                at = np.flatnonzero(found.others if whole else found.marked)
                ends = 16 * np.arange(1, len(at) + 1)
                more = [_binary(names[found.parent[at]], ends), pa.array(found.others[at])] if whole else []
                yield pa.RecordBatch.from_arrays([_binary(names[at], ends), *more], ["node", "root", "others"] if whole else ["node"])

        dealt = nodes.mapInArrow(deal, "part int, t int, size int, block binary").repartitionById(parts, F.col("part"))
        met = dealt.mapInArrow(meet, "node binary, root binary, others long" if whole else "node binary")
        return materialise(met if whole else met.distinct(), drop_shuffles=True)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for layout, rec in blocks(batches):
            n = np.arange(1, len(rec) + 1)
            yield pa.RecordBatch.from_arrays([_binary(np.ascontiguousarray(rec["node"]), n * 16), _binary(x := np.ascontiguousarray(rec["vector"]), n * layout.size * x.itemsize),
                                              pa.array(np.ascontiguousarray(rec["copies"]))], ["node", "raw", "copies"])

    marked = materialise(passes(nodes, False).distinct(), drop_shuffles=True)
    if 2 * marked.count() < (nodes.agg(F.sum("n")).first()[0] or 0):
        whole = nodes.mapInArrow(unpack, "node binary, raw binary, copies long").join(marked, "node", "left_semi")
        nodes = materialise(whole.select("node", "raw", "copies").mapInArrow(pack, "size int, n long, block binary"), drop_shuffles=True)
    ties = passes(nodes, True)
    return named.select("vec_id", "node"), ties


def components(vectors: DataFrame, **options) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows linked directly, copies included; ``component_id``
    is the smallest vec_id reachable (a null id counts as larger than any other); a vector
    that links with nothing is its own component. An empty table gives no row; other
    columns, of any name, are ignored."""
    rows, ties = near_vectors(vectors, **options)
    rows = materialise(rows)
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the passes' partitions add up
    ties = materialise(ties.coalesce(parts))
    copies = materialise(rows.filter("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low")), drop_shuffles=True)
    degree = ties.groupBy("node").agg(F.sum("others").alias("others"))
    roots = connected_components(ties.select(F.col("node").alias("a"), F.col("root").alias("b")))
    node = (copies.join(degree, "node", "left").join(roots, "node", "left")
            .select("node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                    F.coalesce("root", "node").alias("root"), "low"))
    lowest = node.groupBy("root").agg(F.min("low").alias("component_id"))
    node = node.join(lowest, "root").select("node", "n_links", "component_id")
    # Rows without a node link with nothing: they take no part in the join.
    linked = rows.filter("node is not null").join(node, "node").select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id")
    alone = rows.filter("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
