"""Operator 8, frequent classes: nodes of a class compared by pairs of blocks.

The nodes that have a frequent class in their short prefix are dealt to blocks of
bounded size, and a group per two blocks holds the sets of both. Within it two nodes are
candidates if they share a combination: the class twice, or the class and another
frequent one of both longer prefixes. A pair that meets under several classes is
compared in the smallest of them only. Overlaps are matrix products over the classes
that both blocks have, a run of columns at a time. Rows are a node per block of its
class, never a pair of nodes; only a forest of the links comes out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootsweep.llm.common import unpack, unpack_sorted

#: Shingles of one block; a node counts as NODE of them at least.
BLOCK, NODE = 1 << 20, 1024
#: Columns of one matrix product.
COLUMNS = 4096
_EMPTY = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})


def blocks_of(n: str, member: str):
    """Aggregate: the number of blocks for the rows where ``member`` holds."""
    load = F.sum(F.when(F.expr(member), F.greatest(F.col(n), F.lit(NODE))))
    return F.ceil(F.coalesce(load, F.lit(0)) / BLOCK).cast("int")


def overlaps(xs: list[np.ndarray], weights: list[np.ndarray] | None, ys: list[np.ndarray]) -> np.ndarray:
    """Weight of the common values of every x and every y (each of distinct values)."""
    out = np.zeros((len(xs), len(ys)))
    x, y = (np.concatenate(v) if v else np.zeros(0, np.uint64) for v in (xs, ys))
    cols = np.intersect1d(x, y)
    if not len(cols):
        return out
    w = np.ones(len(x)) if weights is None else np.concatenate(weights).astype(float)

    def entries(lists: list[np.ndarray], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(lists)), [len(v) for v in lists])
        k = np.minimum(np.searchsorted(cols, flat), len(cols) - 1)
        at = np.flatnonzero(cols[k] == flat)
        at = at[np.argsort(k[at], kind="stable")]
        return rows[at], k[at], at

    xr, xk, at = entries(xs, x)
    w = w[at]
    yr, yk, _ = entries(ys, y)
    for s in range(0, len(cols), COLUMNS):
        width = min(COLUMNS, len(cols) - s)
        left, right = np.zeros((len(xs), width)), np.zeros((len(ys), width))
        i, j = np.searchsorted(xk, (s, s + width))
        left[xr[i:j], xk[i:j] - s] = w[i:j]
        i, j = np.searchsorted(yk, (s, s + width))
        right[yr[i:j], yk[i:j] - s] = 1
        out += left @ right.T
    return out


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Places of links (a, b) between n components that connect all that the links do."""
    root, kept = np.arange(n), [np.zeros(0, np.int64)]
    while True:
        x, y = root[a], root[b]
        apart = np.flatnonzero(x != y)
        if not len(apart):
            return np.concatenate(kept)
        high, one = np.unique(np.maximum(x, y)[apart], return_index=True)
        kept.append(apart[one])
        root[high] = np.minimum(x, y)[apart[one]]
        while (root != (up := root[root])).any():
            root = up


def _compare(table: pa.Table, percent: int) -> pa.Table:
    """Links between the nodes of two blocks of one class (or within one block)."""
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    block = table.column("block").to_numpy()
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    if not len(left) or not len(right):
        return _EMPTY
    cls, twice = table.column("class")[0].as_py(), table.column("twice")[0].as_py()
    node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
    part = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
    lists = {c: [np.array(v, np.int64) for v in table.column(c).to_pylist()] for c in ("short", "more")}
    pick = lambda values, at: [values[k] for k in at]

    x, y = n[left][:, None], n[right][None, :]
    open_ = (part[left][:, None] != part[right][None, :]) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
    if low == high:
        open_ = np.triu(open_, 1)
    below = [v[v < cls] for v in lists["short"]]
    open_ &= overlaps(pick(below, left), None, pick(below, right)) == 0
    if not twice:
        open_ &= overlaps(pick(lists["more"], left), None, pick(lists["more"], right)) >= 2
    i, j = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
    if not len(i):
        return _EMPTY
    sets, weights = table.column("classes"), table.column("weights")
    xs = [unpack_sorted(sets[int(k)].as_py()) for k in left[i]]
    ws = [unpack(weights[int(k)].as_py()) for k in left[i]]
    ys = [unpack_sorted(sets[int(k)].as_py()) for k in right[j]]
    common = overlaps(xs, ws, ys).astype(np.int64)
    a, b = np.nonzero(open_[np.ix_(i, j)] & (100 * common >= percent * (n[left[i]][:, None] + n[right[j]][None, :] - common)))
    a, b = left[i[a]], right[j[b]]
    keep = forest(part[a], part[b], len(node))
    return pa.table({"a": pa.array(node[a[keep]], pa.int64()), "b": pa.array(node[b[keep]], pa.int64())})


def block_links(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components of nodes that share a combination with a frequent
    class. ``left``: (class, blocks, twice, node, component), a row per node and class."""
    frequent = "transform(filter(prefix, p -> p.frequent{}), p -> p.class)"
    texts = sets.select("node", "n", "classes", "weights", F.expr(frequent.format(" and p.short")).alias("short"),
                        F.expr(frequent.format("")).alias("more"))
    rows = left.select("class", "blocks", "twice", "node", "component", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"))
    rows = rows.join(texts, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    return rows.drop("blocks", "other").groupBy("class", "low", "high").applyInArrow(
        lambda table: _compare(table, percent), "a bigint, b bigint")
