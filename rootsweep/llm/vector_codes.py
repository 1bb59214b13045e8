"""Operator 12: vector code compression by dual-tree Lloyd rounds.

Vectors become integers, cut into equal consecutive parts; each part position has a
codebook. The rows are written once as blocks, with a tree over each part position: its
leaves hold bounding boxes and cached sums. A round walks the pairs of a point node and
a node of the tree over the codebook's entries, both trees at once. Bounds on the
distances between two boxes drop entry nodes that cannot hold the nearest entry; where
one entry is left, the whole point node goes to it with its cached sum. Leaves that are
still uncertain compare their parts with the entries left, in integers. Tasks send back
a sum and a count per entry; the driver holds the codebooks only.

Cases: vectors that are null, empty, of another than the most frequent length, or that
hold null, non-finite or too large components (2**62 after scaling) are left out; a
length that the parts do not divide is filled up with zeros; equal distances go to the
lower index; repeated rows count each; with fewer kept vectors than entries the
codebooks are as short; ids in the start are ascending, nulls last, rows of one id in
the order of their bytes; blocks with components of 2**26 or more are compared one by
one in unbounded integers, and errors beyond 64 bits are null; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootsweep.llm.common import stored
from rootsweep.llm.vectors import common_length, exact, from_bytes, points, to_bytes

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Rows in a leaf of a point tree: from LEAF to twice as many.
LEAF = 16
#: Rows and bytes of a block.
BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 21
#: Components below this are compared in 64-bit integers.
NARROW = 1 << 26
#: A label held by so many rows is joined by broadcast (there are at most rows / HOT).
HOT = 100_000
FAR = np.iinfo(np.int64).max


# ---- trees -----------------------------------------------------------------------------
def cuts(n: int, level: int) -> np.ndarray:
    """Bounds of the nodes of a level: 2**level equal runs of n rows."""
    return (n * np.arange((1 << level) + 1)) >> level


def grow(x: np.ndarray, leaf: int) -> np.ndarray:
    """Order of the rows in a tree: each node is halved along its widest axis."""
    n = len(x)
    order = np.arange(n)
    for level in range(depth_of(n, leaf)):
        now, mid = cuts(n, level), cuts(n, level + 1)[1::2]
        for a, m, b in zip(now[:-1], mid, now[1:], strict=True):
            part = x[order[a:b]]
            axis = int((part.max(0) - part.min(0)).argmax())
            order[a:b] = order[a:b][np.argpartition(part[:, axis], m - a)]
    return order


def depth_of(n: int, leaf: int) -> int:
    return max(0, (n // leaf).bit_length() - 1)


class Boxes(NamedTuple):
    """Per level (root first): lower and upper corners, and sums, of the nodes."""

    n: int
    lo: list[np.ndarray]
    hi: list[np.ndarray]
    total: list[np.ndarray]

    @property
    def depth(self) -> int:
        return len(self.lo) - 1


def leaves(x: np.ndarray, leaf: int) -> np.ndarray:
    """(3, leaves, axes): corners and sums of the leaves of rows in tree order."""
    at = cuts(len(x), depth_of(len(x), leaf))[:-1]
    return np.stack([f.reduceat(x, at) for f in (np.minimum, np.maximum, np.add)])


def boxes(n: int, leaf: np.ndarray) -> Boxes:
    out = [[leaf[i]] for i in range(3)]
    while len(out[0][0]) > 1:
        for level, f in zip(out, (np.minimum, np.maximum, np.add), strict=True):
            level.insert(0, f(level[0][0::2], level[0][1::2]))
    return Boxes(n, *out)


def assign(x: np.ndarray, tree: Boxes, entries: np.ndarray) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Nearest entries of the rows of ``x`` (in tree order): whole nodes as (level,
    nodes, entries), and rows with their entries for what only integers decide."""
    order = grow(entries, 1)
    entry = boxes(len(entries), leaves(entries[order], 1))
    sizes = np.diff(cuts(len(entries), entry.depth))
    first = cuts(len(entries), entry.depth)[:-1]
    node, other = np.zeros(1, np.int64), np.zeros(1, np.int64)
    level = at = 0
    whole = []
    while True:
        plo, phi = tree.lo[level][node], tree.hi[level][node]
        elo, ehi = entry.lo[at][other], entry.hi[at][other]
        near = np.square(np.maximum(0, np.maximum(elo - phi, plo - ehi))).sum(1)
        far = np.square(np.maximum(ehi - plo, phi - elo)).sum(1)
        best = np.full(1 << level, FAR)
        np.minimum.at(best, node, far)
        kept = near <= best[node]
        node, other = node[kept], other[kept]
        if at == entry.depth:
            left = np.bincount(node, sizes[other], 1 << level)
            one = left[node] == 1
            whole.append((level, node[one], order[first[other[one]]]))
            node, other = node[~one], other[~one]
            if level == tree.depth or not len(node):
                break
        if at < entry.depth:
            node, other, at = np.repeat(node, 2), (2 * other[:, None] + [0, 1]).ravel(), at + 1
        if level < tree.depth:
            node, other, level = (2 * node[:, None] + [0, 1]).ravel(), np.repeat(other, 2), level + 1
    if not len(node):
        return whole, np.zeros(0, np.int64), np.zeros(0, np.int64)
    open_ = np.zeros((1 << level, len(entries)), bool)
    for step in range(int(sizes.max())):
        more = step < sizes[other]
        open_[node[more], order[first[other[more]] + step]] = True
    of = np.repeat(np.arange(1 << level), np.diff(cuts(tree.n, level)))
    rows = np.flatnonzero(open_.any(1)[of])
    d = np.square(x[rows, None, :] - entries[None]).sum(2)
    d[~open_[of[rows]]] = FAR
    return whole, rows, d.argmin(1)


def nearest(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Nearest entries one by one, in unbounded integers."""
    wide = entries.astype(object)
    return np.array([min(range(len(wide)), key=lambda e: (int(np.square(wide[e] - r).sum()), e)) for r in x.astype(object)], np.int64)


# ---- blocks ------------------------------------------------------------------------------
BLOCK = "rows int, x binary, orders binary, leaves binary"


def _blocks(kept: DataFrame, length: int, parts: int) -> DataFrame:
    """Rows in blocks with their trees: (id array, label array, rows, x, orders, leaves)."""
    width = -(-length // parts)
    most = max(4 * LEAF, min(BLOCK_ROWS, BLOCK_BYTES // (8 * parts * width)))
    kinds = dict(kept.dtypes)

    def lists(column: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, most):
                cut = batch.slice(i, most)
                x = from_bytes(cut.column("x").to_pylist(), length)
                x = np.hstack([x, np.zeros((len(x), parts * width - length), np.int64)])
                orders, boxed = [], []
                if np.abs(x).max() < NARROW:
                    for p in range(parts):
                        part = x[:, p * width:(p + 1) * width]
                        orders.append(grow(part, LEAF))
                        boxed.append(leaves(part[orders[-1]], LEAF))
                ids, labels = (lists(pa.concat_arrays([cut.column(c)])) for c in ("id", "label"))
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([len(x)], pa.int32()), to_bytes(x.reshape(1, -1)),
                     pa.array([np.array(orders, "<i4").tobytes()], pa.binary()), pa.array([np.array(boxed, "<i8").tobytes()], pa.binary())],
                    ["id", "label", *[c.split()[0] for c in BLOCK.split(", ")]])

    return kept.mapInArrow(run, f"id array<{kinds['id']}>, label array<{kinds['label']}>, {BLOCK}")


def _parts(rows: int, raw: bytes, orders: bytes, boxed: bytes, parts: int, books: np.ndarray) -> Iterator[tuple]:
    """Per part: (part of the rows, order, tree or None)."""
    width = books.shape[2]
    x = from_bytes([raw], rows * parts * width).reshape(rows, parts, width)
    narrow = bool(orders) and max(abs(int(books.max())), abs(int(books.min()))) < NARROW
    if narrow:
        places = np.frombuffer(orders, "<i4").reshape(parts, rows)
        leaf = np.frombuffer(boxed, "<i8").reshape(parts, 3, -1, width)
    for p in range(parts):
        if narrow:
            yield x[:, p][places[p]], places[p], boxes(rows, leaf[p])
        else:
            yield x[:, p], np.arange(rows), None


def _sums(blocks: DataFrame, books: np.ndarray) -> dict[int, int]:
    """Per part, entry and position the sum, and per part and entry the count, of the
    parts nearest to the entry: one pass over the blocks."""
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, k, width + 1), object)
        for batch in batches:
            for rows, raw, orders, boxed in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                for p, (x, _, tree) in enumerate(_parts(rows, raw, orders, boxed, parts, books)):
                    if tree is None:
                        whole, at, codes = [], np.arange(rows), nearest(x, books[p])
                        x = x.astype(object)
                    else:
                        whole, at, codes = assign(x, tree, books[p])
                    for level, nodes, entry in whole:
                        sizes = np.diff(cuts(rows, level))
                        for e in np.unique(entry):
                            mine = nodes[entry == e]
                            total[p, e, :width] += tree.total[level][mine].sum(0)
                            total[p, e, width] += int(sizes[mine].sum())
                    for e in np.unique(codes):
                        mine = at[codes == e]
                        total[p, e, :width] += x[mine].sum(0)
                        total[p, e, width] += len(mine)
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), exact(list(flat))], ["i", "v"])

    got = (blocks.select("rows", "x", "orders", "leaves").mapInArrow(run, "i int, v decimal(38,0)")
           .groupBy("i").agg(F.sum("v").alias("v")).collect())
    return {r["i"]: int(r["v"]) for r in got}


def lloyd(blocks: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position) after ``rounds`` rounds; unused entries stay."""
    parts, k, width = books.shape
    for _ in range(rounds):
        got, new = _sums(blocks, books), books.copy()
        for i in range(parts * k):
            if n := got.get(i * (width + 1) + width, 0):
                new[i // k, i % k] = [got[i * (width + 1) + w] // n for w in range(width)]
        books = new
    return books


def _encoded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error) of every row."""
    parts, _, _ = books.shape
    kinds = {c: t[len("array<"):-1] for c, t in blocks.dtypes if c in ("id", "label")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, raw, orders, boxed = (batch.column(c)[i].as_py() for c in ("rows", "x", "orders", "leaves"))
                codes, error = np.zeros((rows, parts), np.uint8), 0
                for p, (x, order, tree) in enumerate(_parts(rows, raw, orders, boxed, parts, books)):
                    if tree is None:
                        mine, x, entries = nearest(x, books[p]), x.astype(object), books[p].astype(object)
                    else:
                        mine, entries = np.zeros(rows, np.int64), books[p]
                        whole, at, exactly = assign(x, tree, entries)
                        for level, nodes, entry in whole:
                            here = np.full(1 << level, -1)
                            here[nodes] = entry
                            here = np.repeat(here, np.diff(cuts(rows, level)))
                            mine = np.where(here >= 0, here, mine)
                        mine[at] = exactly
                    codes[order, p] = mine
                    d = np.zeros(rows, object if tree is None else np.int64)
                    d[order] = np.square(x - entries[mine]).sum(1)
                    error = error + d.astype(object)
                code = [r.tobytes().hex() for r in codes]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(i, 1).flatten(), batch.column("label").slice(i, 1).flatten(), pa.array(code),
                     exact(list(error))], ["id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error decimal(38,0)")


def vector_codes(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE,
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector."""
    kind = dict(vectors.dtypes)[vec_id]
    length = common_length(vectors, vector)
    kept = points(vectors, vector, max(1, length), scale, id=vec_id, label=label)
    start = kept.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect() if length else []
    if not start:
        return vectors.sparkSession.createDataFrame(
            [], f"{vec_id} {kind}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    width = -(-length // parts)
    first = from_bytes([bytes(r["x"]) for r in start], length)
    first = np.hstack([first, np.zeros((len(first), parts * width - length), np.int64)])
    blocks = stored(_blocks(kept, length, parts), "vector-blocks")
    books = lloyd(blocks, first.reshape(len(first), parts, width).transpose(1, 0, 2).copy(), rounds)
    digest = hashlib.sha256(",".join(str(v) for v in books.ravel()).encode()).hexdigest()

    coded = stored(_encoded(blocks, books), "vector-codes")
    sums = stored(coded.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("error").alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "of")
    same = F.col("label").eqNullSafe(F.col("of"))
    hot = sums.where(F.col("n") >= HOT).select("of", "label_error")
    by_hot = coded.join(F.broadcast(hot), same)
    by_rest = coded.join(F.broadcast(hot), same, "left_anti").join(sums.where(F.col("n") < HOT).select("of", "label_error"), same)
    return by_hot.unionAll(by_rest).select(
        F.col("id").alias(vec_id), "code", F.expr("try_cast(error AS bigint)").alias("error"),
        F.expr("try_cast(label_error AS bigint)").alias("label_error"), F.lit(digest).alias("codebooks_sha256"))
