"""Operator 7: embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= c lie within epsilon = sqrt(2 - 2 c). They are rotated onto
their principal axes (which keeps distances), sorted by the grid cells of width epsilon
on the leading axes, and cut into blocks of a fixed number of rows with bounding boxes.
Pairs of blocks whose boxes may come within epsilon are joined, recursively: both
intervals are halved until they are small or their boxes are provably too far apart.
What remains is compared by cosine in double precision.

Equal vectors are one node with a number of copies. A pair of blocks yields counts per
vector and a spanning forest of its links, never the links themselves, so a group of
any number of near copies stays linear in its vectors.

Cases: a vector that is null, empty, zero, or holds a null or a non-finite component
links with nothing (n_links 0, its own component, kept); shorter vectors count as
padded with zeros; equal rows link with each other; rows without id take part, the
component is the smallest id that is not null; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rootsweep.llm.common import components, own_columns, stored

COSINE = 0.95
BLOCK, LEAF, AXES = 4096, 256, 6


def _unit(values: list) -> bytes | None:
    """Unit vector in doubles, or None if it links with nothing."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, float)
    top = np.abs(x).max()
    if not np.isfinite(top) or top == 0:
        return None
    x = x / top
    return (x / np.sqrt(x @ x)).tobytes()


def _nodes(vectors: DataFrame, kind: str) -> DataFrame:
    """(id, node, unit): node is a hash of the vector's components (null: links with nothing)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            unit = [_unit(v) for v in raw]
            node = [None if u is None else xxhash.xxh64_intdigest(np.array(v, float).tobytes()) - (1 << 63) for u, v in zip(unit, raw, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node, pa.int64()), pa.array(unit, pa.binary())], ["id", "node", "unit"])

    return vectors.mapInArrow(run, f"id {kind}, node bigint, unit binary")


def _matrix(units: list[bytes], d: int) -> np.ndarray:
    out = np.zeros((len(units), d))
    for i, u in enumerate(units):
        x = np.frombuffer(u)
        out[i, :len(x)] = x
    return out


def _axes(nodes: DataFrame, d: int) -> np.ndarray:
    """Principal axes, strongest first, from sums over all vectors (d * d numbers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d + 1))
        for batch in batches:
            x = np.hstack([_matrix(batch.column(0).to_pylist(), d), np.ones((batch.num_rows, 1))])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "v"])

    got = nodes.select("unit").mapInArrow(run, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((d + 1) ** 2)
    for r in got:
        total[r.i] = r.v
    total = total.reshape(d + 1, d + 1)
    n = max(1.0, total[d, d])
    mean = total[d, :d] / n
    _, vec = np.linalg.eigh(total[:d, :d] / n - np.outer(mean, mean))
    return vec[:, ::-1].copy()


def _blocks(nodes: DataFrame, axes: np.ndarray, eps: float, block: int) -> DataFrame:
    """Nodes in epsilon grid order, cut into blocks: (block, lo, hi, nodes, copies, points)."""
    d, lead = len(axes), min(AXES, len(axes))
    shared = nodes.sparkSession.sparkContext.broadcast(axes)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("unit").to_pylist(), d) @ shared.value
            cell = np.floor(x[:, :lead] / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("copies"), *[pa.array(cell[:, k]) for k in range(lead)],
                 pa.array([r.tobytes() for r in x], pa.binary())], ["node", "copies", *[f"c{k}" for k in range(lead)], "point"])

    grid = [f"c{k}" for k in range(lead)]
    placed = nodes.mapInArrow(cells, "node bigint, copies bigint, " + ", ".join(f"{c} int" for c in grid) + ", point binary")
    placed = placed.repartitionByRange(*grid, "node").sortWithinPartitions(*grid, "node")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(b.num_rows, part, np.int32)), pa.array(np.arange(seq, seq + b.num_rows)),
                 b.column("node"), b.column("copies"), b.column("point")], ["part", "seq", "node", "copies", "point"])
            seq += b.num_rows

    placed = stored(placed.mapInArrow(number, "part int, seq bigint, node bigint, copies bigint, point binary"), "vectors")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = placed.join(offsets, "part").select(((F.col("offset") + F.col("seq")) / block).cast("bigint").alias("block"), "node", "copies", "point")

    def cut(rows: pa.Table) -> pa.Table:
        """One block: ``block`` consecutive vectors of the order."""
        x = np.stack([np.frombuffer(p) for p in rows.column("point").to_pylist()])
        cols = [rows.column("block")[:1], [x.min(0).tolist()], [x.max(0).tolist()], [rows.column("node").to_numpy().tobytes()],
                [rows.column("copies").to_numpy().tobytes()], [x.tobytes()]]
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                        names=["block", "lo", "hi", "nodes", "copies", "points"])

    return ranked.groupBy("block").applyInArrow(
        cut, "block bigint, lo array<double>, hi array<double>, nodes binary, copies binary, points binary")


def _pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs of blocks whose boxes come within epsilon. They meet on the cells of the first
    two axes that a block covers (widened by one), so blocks far apart there never meet."""
    box = blocks.select("block", "lo", "hi")
    span = lambda k, wide: F.sequence(
        (F.floor(F.col("lo")[k] / eps) - wide).cast("int"), (F.floor(F.col("hi")[k] / eps) + wide).cast("int"))
    two = len(blocks.select("lo").head(1)[0].lo) > 1 if blocks.head(1) else False
    left, right = box.withColumn("c0", F.explode(span(0, 0))), box.withColumn("c0", F.explode(span(0, 1)))
    by = ["c0"]
    if two:
        left, right, by = left.withColumn("c1", F.explode(span(1, 0))), right.withColumn("c1", F.explode(span(1, 1))), ["c0", "c1"]
    met = left.join(right.select(*by, F.col("block").alias("b"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2")), by).where("block <= b")
    gap = F.aggregate(F.zip_with(F.zip_with("lo", "hi2", lambda x, y: x - y), F.zip_with("lo2", "hi", lambda x, y: x - y),
                                 lambda x, y: F.pow(F.greatest(x, y, F.lit(0.0)), F.lit(2))), F.lit(0.0), lambda s, x: s + x)
    return met.where(gap <= eps * eps * (1 + 1e-9)).select(F.col("block").alias("a"), "b").distinct()


class _Pair(NamedTuple):
    """Two blocks: their numbers, and the nodes, copies and points of each."""
    a: int
    b: int
    an: bytes
    ac: bytes
    ap: bytes
    bn: bytes
    bc: bytes
    bp: bytes


class _Links:
    """Links of one pair of blocks: weighted counts and a forest."""

    def __init__(self, n: int):
        self.count = np.zeros(n, np.int64)
        self.root = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray, copies: np.ndarray) -> None:
        np.add.at(self.count, i, copies[j])
        np.add.at(self.count, j, copies[i])
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            np.minimum.at(self.root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while (self.root != (up := self.root[self.root])).any():
                self.root = up


def _recurse(x: np.ndarray, a: tuple[int, int], b: tuple[int, int], eps: float, cosine: float, copies: np.ndarray, links: _Links, boxes: dict) -> None:
    """Join the sequence intervals a and b of x."""
    for s in (a, b):
        if s not in boxes:
            boxes[s] = (x[s[0]:s[1]].min(0), x[s[0]:s[1]].max(0))
    (lo, hi), (lo2, hi2) = boxes[a], boxes[b]
    if (np.maximum(np.maximum(lo - hi2, lo2 - hi), 0) ** 2).sum() > eps * eps * (1 + 1e-9):
        return
    wide_a, wide_b = a[1] - a[0] > LEAF, b[1] - b[0] > LEAF
    if not wide_a and not wide_b:
        i, j = np.nonzero(x[a[0]:a[1]] @ x[b[0]:b[1]].T >= cosine)
        i, j = i + a[0], j + b[0]
        if a == b:
            i, j = i[i < j], j[i < j]
        if len(i):
            links.add(i, j, copies)
        return
    halves = lambda s, cut: [(s[0], (s[0] + s[1]) // 2), ((s[0] + s[1]) // 2, s[1])] if cut else [s]
    for p in halves(a, wide_a):
        for q in halves(b, wide_b):
            if a != b or p <= q:
                _recurse(x, p, q, eps, cosine, copies, links, boxes)


def _join(blocks: DataFrame, pairs: DataFrame, eps: float, cosine: float, d: int) -> DataFrame:
    """Per pair of blocks and vector with links: (node, links, root)."""
    data = blocks.select("block", "nodes", "copies", "points")
    rows = pairs.join(data.toDF("a", "an", "ac", "ap"), "a").join(data.toDF("b", "bn", "bc", "bp"), "b").select(
        "a", "b", "an", "ac", "ap", "bn", "bc", "bp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = _Pair(*(batch.column(i)[k].as_py() for i in range(8)))
                x, nodes, copies = np.frombuffer(r.ap).reshape(-1, d), np.frombuffer(r.an, np.int64), np.frombuffer(r.ac, np.int64)
                a = b = (0, len(x))
                if r.a != r.b:
                    x = np.vstack([x, np.frombuffer(r.bp).reshape(-1, d)])
                    nodes, copies = np.concatenate([nodes, np.frombuffer(r.bn, np.int64)]), np.concatenate([copies, np.frombuffer(r.bc, np.int64)])
                    b = (a[1], len(x))
                links = _Links(len(x))
                _recurse(x, a, b, eps, cosine, copies, links, {})
                k = np.flatnonzero(links.count)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[k]), pa.array(links.count[k]), pa.array(nodes[links.root[k]])],
                                                 ["node", "links", "root"])

    return rows.mapInArrow(run, "node bigint, links bigint, root bigint")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK,
                    id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per vector: id, n_links, component_id, kept (id = component_id)."""
    src = own_columns(vectors, id_col, vec_col).toDF("id", "vec")
    kind = src.schema["id"].dataType.simpleString()
    rows = stored(_nodes(src, kind), "vectors")
    nodes = stored(rows.where("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("unit").alias("unit")), "vectors")
    d = (nodes.agg(F.max(F.octet_length("unit"))).first()[0] or 0) // 8
    alone = rows.where("node is null").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    if d:
        eps = float(np.sqrt(2 - 2 * cosine)) + 1e-9
        blocks = stored(_blocks(nodes, _axes(nodes, d), eps, block), "vectors")
        found = stored(_join(blocks, stored(_pairs(blocks, eps), "vectors"), eps, cosine, d), "vectors")
        counts = found.groupBy("node").agg(F.sum("links").alias("links"))
        label = components(found.select("node", "root"))
        info = nodes.select("node", "copies").join(counts, "node", "left").join(label, "node", "left").select(
            "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("label"))
        named = stored(rows.where("node is not null").select("id", "node").join(info, "node").select("id", "n_links", "label"), "vectors")
        lowest = named.groupBy("label").agg(F.min("id").alias("component_id"))
        alone = alone.unionByName(named.join(lowest, "label").select("id", "n_links", "component_id"))
    return alone.select(F.col("id").alias(id_col), "n_links", "component_id",
                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
