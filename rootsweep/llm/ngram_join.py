"""Operator 8: Jaccard self-join on word shingles with token-combination prefixes.

A text's set is its distinct 5-word shingles. Equal sets are one node. Shingles that
occur in exactly the same nodes form a class, which counts as often as it has shingles.
Classes are ordered by document frequency, rarest first. Two similar sets share a
shingle in their prefixes (the first |x| - ceil(t |x|) + 1 shingles), and two shingles
in prefixes one longer. So rare classes are indexed alone; a class that is frequent
needs a combination of two shingles: with itself if it has two, else with each later
class of the longer prefix. A position filter drops pairs of which too few shingles are
left from the first common class on. Candidates are verified by their exact overlap.

Steps: (1) an inverted index: each task sends its texts' shingles, packed, by shingle
range; only shingles in two nodes or more go on, so most texts end here. (2) Sets of
nodes that can still reach the threshold, as classes. (3) Every class in a short prefix
pairs its nodes with a centre, the first in one of a few random orders; these pairs, a
few per node, are verified and give first components. (4) Only for classes whose nodes are
then in several components, nodes of different components are compared: a rare class
gives pairs (it has at most ``FREQUENT`` nodes), a frequent one pairs of blocks of nodes
(``ngram_blocks``), in which the combinations are formed and verified. Pairs within a
component would change nothing, so a group of any number of near copies costs a few
pairs per copy.

Cases: null, empty or wordless texts have no shingle and link with nothing; a text of
1 to 4 words has its whole sequence as the one shingle; texts are read whole; repeated
rows are copies of each other; a null id takes part, the component id is the smallest
id that is not null; an empty table gives an empty result; other columns are ignored.
Shingles are compared by 48-bit hashes, nodes and classes by 64-bit hashes of the whole
set of shingles, or of nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootsweep.llm.common import (
    SPACE,
    components,
    mix,
    ngram_hashes,
    own_columns,
    pack,
    pack_sorted,
    stored,
    unpack,
    unpack_sorted,
    word_steps,
)
from rootsweep.llm.ngram_blocks import block_links, blocks_of

WORDS = 5
PERCENT = 75
#: A shingle in more nodes than this is of the frequent class.
FREQUENT = 32
#: Orders of nodes from which the centres of classes are taken.
CENTRES = 8
#: Bytes of text for one partition of the index; shingles a task holds before it sends them.
PART_BYTES = 16 << 20
HELD = 1_000_000
_BITS = np.uint64(48)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """Distinct shingles of each text, ascending 48-bit hashes."""
    gaps = tuple(range(1, words))
    for i, j, h, b in word_steps(texts, SPACE):
        grams = ngram_hashes(h, gaps) >> np.uint64(16)
        for k in range(j - i):
            s, e = b[k], b[k + 1]
            if e - s >= words:
                yield np.unique(grams[s:e - words + 1])
            elif e > s:
                x = np.uint64(e - s)
                for v in h[s:e]:
                    x = mix(np.array([x * np.uint64(0xD6E8FEB86659FD93) + v]))[0]
                yield np.array([x >> np.uint64(16)])
            else:
                yield np.zeros(0, np.uint64)


def node_key(s: np.ndarray) -> int:
    """64-bit hash of a whole set, as a signed number."""
    return int(mix(mix(s ^ np.uint64(0xA0761D6478BD642F)).sum(keepdims=True) + np.uint64(len(s))).view(np.int64)[0])


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap that a set of n can have with any similar one: ceil(t n)."""
    return -(-n * percent // 100)


def _keys(docs: DataFrame, words: int, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(node_key(s) if len(s) else 0, len(s)) for s in shingle_sets(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([k for k, _ in sets], pa.int64()), pa.array([n for _, n in sets], pa.int64())],
                ["id", "node", "n"])

    return docs.mapInArrow(run, f"id {kind}, node bigint, n bigint")


# ---- inverted index -------------------------------------------------------------------
_POST = pa.schema([("part", pa.int32()), ("tokens", pa.binary()), ("refs", pa.binary()), ("nodes", pa.binary()), ("sizes", pa.binary())])


def _postings(docs: DataFrame, words: int, parts: int) -> DataFrame:
    """Shingles of a task's distinct sets by range of hashes: tokens (ascending), the node
    of each as a place in ``nodes`` (ascending)."""
    def send(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        keys = np.array(sorted(held), np.int64)
        sets = [held[int(k)] for k in keys]
        sizes = np.array([len(s) for s in sets], np.uint64)
        tokens, refs = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
        order = np.argsort(tokens, kind="stable")
        tokens, refs = tokens[order], refs[order]
        part = _part(tokens, parts)
        edges = np.searchsorted(part, np.arange(parts + 1))
        out = []
        for p in range(parts):
            s, e = edges[p], edges[p + 1]
            if s < e:
                used, place = np.unique(refs[s:e], return_inverse=True)
                out.append((p, pack_sorted(tokens[s:e]), pack(place), pack(np.diff(keys[used], prepend=np.int64(0)).astype(np.uint64)), pack(sizes[used])))
        cols = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _POST, strict=True)], schema=_POST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            for s in shingle_sets(batch.column(0), words):
                if len(s):
                    k = node_key(s)
                    if k not in held:
                        held[k] = s
                        size += len(s)
                        if size >= HELD:
                            yield send(held)
                            held, size = {}, 0
        if held:
            yield send(held)

    return docs.select("text").mapInArrow(run, "part int, tokens binary, refs binary, nodes binary, sizes binary")


def _part(tokens: np.ndarray, parts: int) -> np.ndarray:
    return ((tokens >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


_SHARED = pa.schema([("home", pa.int32()), ("nodes", pa.binary()), ("sizes", pa.binary()), ("lengths", pa.binary()),
                     ("places", pa.binary()), ("weights", pa.binary()), ("classes", pa.binary()), ("df", pa.binary())])


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    new[:1] = True
    return np.flatnonzero(new)


def _shared(postings: DataFrame, parts: int) -> DataFrame:
    """Per range of shingles: classes of those in two nodes or more, by the nodes' home
    partition, with how many of the range's shingles a class has."""
    def run(table: pa.Table) -> pa.Table:
        got = []
        for t, r, k, z in zip(*(table.column(c).to_pylist() for c in ("tokens", "refs", "nodes", "sizes")), strict=True):
            place = unpack(r).astype(np.int64)
            got.append((unpack_sorted(t), unpack_sorted(k).view(np.int64)[place], unpack(z)[place]))
        rows = [np.concatenate([g[i] for g in got]) for i in range(3)]
        del got
        for cut in (lambda t, k: np.lexsort((k, t)), _edges):  # sorted, then without repeats
            at = cut(rows[0], rows[1])
            for i in range(3):  # one column at a time, so that only one is held twice
                rows[i] = rows[i][at]
        tokens, nodes, sizes = rows
        del rows, at
        first = _edges(tokens)
        df = np.diff(np.append(first, len(tokens)))
        same = mix(np.add.reduceat(mix(nodes.view(np.uint64)), first) + df.astype(np.uint64)) if len(first) else tokens
        many = np.repeat(df > 1, df)
        same, df = np.repeat(same, df)[many], np.repeat(df, df)[many]
        nodes, sizes = nodes[many], sizes[many]
        home = (nodes.view(np.uint64) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((same, nodes, home))
        home, nodes, sizes, same, df = home[order], nodes[order], sizes[order], same[order], df[order]
        new = _edges(nodes, same)
        weights = np.diff(np.append(new, len(nodes)))
        home, nodes, sizes, same, df = home[new], nodes[new], sizes[new], same[new], df[new]
        edges = np.searchsorted(home, np.arange(parts + 1))
        out = []
        for p in range(parts):
            s, e = edges[p], edges[p + 1]
            if s < e:
                at = _edges(nodes[s:e])
                own = nodes[s:e][at]
                classes, one, place = np.unique(same[s:e], return_index=True, return_inverse=True)
                out.append((p, pack(np.diff(own, prepend=np.int64(0)).astype(np.uint64)), pack(sizes[s:e][at]),
                            pack(np.diff(np.append(at, e - s))), pack(place), pack(weights[s:e]), pack_sorted(classes), pack(df[s:e][one])))
        cols = list(zip(*out, strict=True)) or [()] * len(_SHARED)
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, _SHARED, strict=True)], schema=_SHARED)

    return postings.groupBy("part").applyInArrow(
        run, "home int, nodes binary, sizes binary, lengths binary, places binary, weights binary, classes binary, df binary")


_PREFIX = "array<struct<class: bigint, at: bigint, short: boolean, frequent: boolean, twice: boolean>>"


def _node_sets(shared: DataFrame, percent: int) -> DataFrame:
    """Nodes that can reach the threshold: size, classes (ascending) and weights, packed, and
    the classes of the longer prefix in order: where each begins among the node's shingles,
    whether in the short prefix, whether frequent, whether of two shingles or more."""
    def run(table: pa.Table) -> pa.Table:
        got = []
        for row in table.to_pylist():
            lengths, place = unpack(row["lengths"]).astype(np.int64), unpack(row["places"]).astype(np.int64)
            got.append((np.repeat(unpack_sorted(row["nodes"]).view(np.int64), lengths), np.repeat(unpack(row["sizes"]).astype(np.int64), lengths),
                        unpack_sorted(row["classes"])[place], unpack(row["weights"]).astype(np.int64), unpack(row["df"]).astype(np.int64)[place]))
        nodes, sizes, same, weights, df = (np.concatenate([g[i] for g in got]) for i in range(5))
        del got
        order = np.lexsort((same, nodes))
        nodes, sizes, same, weights, df = nodes[order], sizes[order], same[order], weights[order], df[order]
        new = _edges(nodes, same)
        weights = np.add.reduceat(weights, new) if len(new) else weights
        nodes, sizes, same, df = nodes[new], sizes[new], same[new], df[new]
        edges = np.append(_edges(nodes), len(nodes))
        out = []
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            n, total = int(sizes[s]), int(weights[s:e].sum())
            need = int(least_overlap(np.int64(n), percent))
            if total < need:
                continue  # too few shingles that any other set has
            c, w, d = same[s:e], weights[s:e], df[s:e]
            order = np.lexsort((c, d))
            at = n - total + np.cumsum(w[order]) - w[order]  # the shingles of this node alone come first
            order, at = order[at <= n - need + 1], at[at <= n - need + 1]
            prefix = [{"class": int(k), "at": int(p), "short": bool(p <= n - need), "frequent": bool(f), "twice": bool(t)}
                      for k, p, f, t in zip(c[order].view(np.int64), at, d[order] > FREQUENT, w[order] > 1, strict=True)]
            out.append((int(nodes[s]), n, pack_sorted(c), pack(w), prefix))
        entry = pa.struct([("class", pa.int64()), ("at", pa.int64()), ("short", pa.bool_()), ("frequent", pa.bool_()), ("twice", pa.bool_())])
        schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("classes", pa.binary()), ("weights", pa.binary()), ("prefix", pa.list_(entry))])
        cols = list(zip(*out, strict=True)) or [()] * len(schema)
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return shared.groupBy("home").applyInArrow(run, f"node bigint, n bigint, classes binary, weights binary, prefix {_PREFIX}")


# ---- candidates ------------------------------------------------------------------------
def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the threshold."""
    s = sets.select("node", "n", "classes", "weights")
    rows = pairs.join(s.toDF("b", "bn", "bc", "bw"), "b").join(s.drop("weights").toDF("a", "an", "ac"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last = [], (None, None)
            for i, (a, an, bn, ac, bc, bw) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "an", "bn", "ac", "bc", "bw")), strict=True)):
                if last[0] != a:
                    last = (a, unpack_sorted(ac))
                x, y = last[1], unpack_sorted(bc)
                k = np.minimum(np.searchsorted(x, y), len(x) - 1)
                common = int(unpack(bw)[x[k] == y].sum())
                if 100 * common >= percent * (an + bn - common):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return rows.select("a", "b", "an", "bn", "ac", "bc", "bw").mapInArrow(run, "a bigint, b bigint")


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect every two nodes that a chain of similar pairs connects."""
    index = stored(sets.select("node", "n", F.explode("prefix").alias("p")).select("node", "n", "p.*"), "ngram")
    # sizes that can be similar, and enough shingles left from the common class on
    fits = ((F.col("n") * 100 >= F.col("m") * percent) & (F.col("m") * 100 >= F.col("n") * percent)
            & (F.least(F.col("n") - F.col("at"), F.col("m") - F.col("at2")) * (100 + percent) >= (F.col("n") + F.col("m")) * percent))
    short = index.where("short").select("class", "node", "n", "at")
    order = F.xxhash64("node", F.pmod(F.col("class"), F.lit(CENTRES)))
    centre = short.groupBy("class").agg(F.min(F.struct(order.alias("order"), "node", "n", "at")).alias("c")).select(
        "class", F.col("c.node").alias("c"), F.col("c.n").alias("m"), F.col("c.at").alias("at2"))
    stars = short.join(centre, "class").where((F.col("node") != F.col("c")) & fits).select(
        F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()
    stars = stored(stars, "ngram")
    first = stored(verify(stars, sets, percent), "ngram")

    named = index.join(components(first), "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stored(named, "ngram")
    several = named.groupBy("class").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                         blocks_of("n", "short and frequent").alias("blocks")).where("lo <> hi").select("class", "blocks")
    left = stored(named.join(several, "class"), "ngram")

    rare = left.where("short and not frequent").select("class", "node", "n", "at", "component")
    other = rare.select("class", F.col("node").alias("b"), F.col("n").alias("m"), F.col("at").alias("at2"), F.col("component").alias("d"))
    more = rare.join(other, "class").where((F.col("node") < F.col("b")) & (F.col("component") != F.col("d")) & fits).select(
        F.col("node").alias("a"), "b")
    more = stored(more.distinct(), "ngram")  # written first, or the anti join would run before the distinct
    more = more.join(stars, ["a", "b"], "left_anti")
    found = first.unionByName(stored(verify(more, sets, percent), "ngram"))
    return found.unionByName(stored(block_links(left.where("short and frequent"), sets, percent), "ngram"))


def ngram_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, part_bytes: int = PART_BYTES,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_shingles, component_id (smallest id reachable by links)."""
    src = own_columns(docs, id_col, text_col).toDF("id", "text")
    kind = src.schema["id"].dataType.simpleString()
    size = src.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]
    parts = max(2, -(-size // part_bytes))
    rows = stored(_keys(src, words, kind), "ngram")
    sets = stored(_node_sets(_shared(_postings(src, words, parts), parts), percent), "ngram")
    label = components(_links(sets, percent))
    named = rows.where("n > 0").join(label, "node", "left").select("id", "n", F.coalesce("component", "node").alias("label"))
    named = stored(named, "ngram")
    lowest = named.groupBy("label").agg(F.min("id").alias("component_id"))
    out = named.join(lowest, "label").select("id", "n", "component_id").unionByName(
        rows.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
