"""Operator 3: packing token sequences by non-negative least squares.

Each document's ids (with an end id) are cut into full windows and a tail. The tails'
lengths, in bins of ``BIN`` tokens, form a histogram (at most window / BIN counts).
All combinations of up to ``DEPTH`` bins that fill a window are enumerated; non-negative
least squares finds how often to repeat each so that together they match the
histogram; the counts are rounded down and kept within the histogram. Tails get their
place by rank within their bin. What is left over is packed greedily: in order, cut
where a window is full, the very last window into powers of two, so without padding.

Scale: one tokenising pass, written once. Ranks and offsets come from counts per input
chunk and small prefix sums, so no bin, chunk or window is ever gathered whole; the
driver sees the histogram and the plan only, and broadcasts the plan (bounded by the
number of bins). Ids move again only for the tails that a window boundary cuts.

Cases: a null or empty text is the end id alone; a text of any length is cut into
pieces; repeated rows are packed each; a null id stays null; an empty table gives no
piece; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rootsweep.llm.common import own_columns, scratch, stored

WINDOW = 4096
BIN, DEPTH = 16, 3
#: Cut tails that are broadcast to find their ids; more are found by a shuffle.
MAX_BROADCAST = 200_000
#: Distinct pieces a worker remembers before it starts over (or those of one step, where
#: they are more); characters encoded together.
CACHE, STEP_CHARS = 1_000_000, 4 << 20


# ---- tokens ------------------------------------------------------------------------
#: The tokenizer's split pattern for lower-case Latin-1 text.
_L, _N = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECE = re.compile(f"[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_N}]|[^\t-\r \x85\xa0{_L}{_N}]+")


class PieceIds(dict):
    """Piece of text that the tokenizer never merges across -> its ids, little-endian.

    Texts are split into pieces, and only pieces not met before go to the tokenizer, many
    at a time: each piece ends with a token that ends a word, which tells them apart. This
    holds for Latin-1 texts (which NFC leaves alone and where lower case is by character)
    without special strings; others are encoded as a whole."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.kind = "<u2" if max(vocab.values()) < 1 << 16 else "<u4"
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True

    def _encode(self, *texts: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return np.array([i for e in found for i in e.ids], self.kind)

    def _learn(self, pieces: list[str]) -> None:
        ids = self._encode(*(" ".join(pieces[i:i + 200]) for i in range(0, len(pieces), 200)))
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(pieces):  # never seen; then one by one
            self.update((p, self._encode(p).tobytes()) for p in pieces)
            return
        raw, width = ids.tobytes(), ids.itemsize
        at = [0, *(width * cuts).tolist()]
        self.update(zip(pieces, map(raw.__getitem__, map(slice, at, at[1:])), strict=False))

    def texts(self, texts: list[str]) -> list[bytes]:
        pieces: list[list[str] | None] = []
        for t in texts:
            try:
                t.encode("latin-1")
                pieces.append(None if "<|" in t else _PIECE.findall(t.lower()))
            except UnicodeEncodeError:
                pieces.append(None)
        used = set().union(*(p for p in pieces if p))
        new = used.difference(self)
        if len(self) + len(new) > CACHE:  # start over; a step's own pieces always stay
            self.clear()
            new = used
        if new:
            self._learn(list(new))
        near = {p: self[p] for p in used}.__getitem__  # a small table is faster to look up
        return [self._encode(t).tobytes() if p is None else b"".join(map(near, p)) for t, p in zip(texts, pieces, strict=True)]


@lru_cache(maxsize=2)
def _piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


_TOKENS = ("chunk int, row bigint, id {}, n bigint, full_before bigint, bin int, rank bigint, crcs array<bigint>, ids binary")


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Rows of about STEP_CHARS characters together."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= STEP_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _tokenise(docs: DataFrame, tokenizer: str, end_id: int, kind: str) -> DataFrame:
    """Ids of each document, with what planning needs: its place in its chunk, the CRC of
    each full window and of the tail, and the tail's rank in its bin within the chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _piece_ids(tokenizer)
        end, width = np.array([end_id], pieces.kind).tobytes(), np.dtype(pieces.kind).itemsize
        chunk, row, full, ranks = TaskContext.get().partitionId(), 0, 0, np.zeros(WINDOW // BIN + 1, np.int64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, stop in _runs(texts):
                out = []
                for raw in pieces.texts([t or "" for t in texts[start:stop]]):
                    raw += end
                    n, view = len(raw) // width, memoryview(np.frombuffer(raw, pieces.kind).astype("<u4").tobytes())
                    b = -(-(n % WINDOW) // BIN)
                    crcs = [zlib.crc32(view[i:i + 4 * WINDOW]) for i in range(0, 4 * n, 4 * WINDOW)]
                    out.append((row, n, full, b, ranks[b], crcs, raw))
                    ranks[b] += 1
                    row += 1
                    full += n // WINDOW
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(out), pa.int32()), pa.array(cols[0], pa.int64()), batch.column(0).slice(start, stop - start),
                     pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32()),
                     pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.list_(pa.int64())), pa.array(cols[6], pa.binary())],
                    ["chunk", "row", "id", "n", "full_before", "bin", "rank", "crcs", "ids"])

    return docs.mapInArrow(run, _TOKENS.format(kind))


# ---- plan ----------------------------------------------------------------------------
def nnls(a: np.ndarray, y: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """min |a x - y| with x >= 0, by active sets: bring in the column with the steepest
    gradient, solve on the chosen columns, step back where a value would turn negative."""
    m, n = a.shape
    x, chosen = np.zeros(n), np.zeros(n, bool)
    for _ in range(rounds or 3 * m):
        gradient = a.T @ (y - a @ x)
        gradient[chosen] = -np.inf
        k = int(np.argmax(gradient))
        if gradient[k] <= 1e-9 * max(1.0, np.abs(y).max()):
            break
        chosen[k] = True
        while True:
            idx = np.flatnonzero(chosen)
            s = np.linalg.lstsq(a[:, idx], y, rcond=None)[0]
            if s.min() > 0:
                x[:] = 0
                x[idx] = s
                break
            low = s <= 0
            step = np.min(x[idx][low] / np.maximum(x[idx][low] - s[low], 1e-300))
            x[idx] += step * (s - x[idx])
            chosen[idx[low & (x[idx] <= 1e-12)]] = False
            x[~chosen] = 0
            if not chosen.any():
                break
    return x


def shallow_combinations(bins: int, depth: int) -> list[tuple[int, ...]]:
    """Bins (1 to ``bins``) of up to ``depth`` tails that together fill a window."""
    out = [(bins,)]
    for d in range(2, depth + 1):
        for head in combinations_with_replacement(range(1, bins), d - 1):
            last = bins - sum(head)
            if last >= head[-1]:
                out.append((*head, last))
    return out


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """Combinations and how often each is repeated; never more tails than there are.
    ``histogram[b]``: tails in bin b (0: none)."""
    bins = len(histogram) - 1
    combos = shallow_combinations(bins, depth)
    if not histogram[1:].any():
        return []
    a = np.zeros((bins, len(combos)))
    for k, c in enumerate(combos):
        for b in c:
            a[b - 1, k] += 1
    x = nnls(a, histogram[1:].astype(float))
    left, out = histogram.astype(np.int64).copy(), []
    for k in np.argsort(-x, kind="stable"):
        need = a[:, k]
        used = np.flatnonzero(need)
        times = int(min(np.floor(x[k] + 1e-6), np.min(left[used + 1] // need[used])))
        if times > 0:
            left[used + 1] -= (times * need[used]).astype(np.int64)
            out.append((combos[k], times))
    return out


# ---- packing ---------------------------------------------------------------------------
def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    src = own_columns(docs, id_col, text_col)
    kind = src.schema[0].dataType.simpleString()
    tokens = _tokenise(src, tokenizer, end_id, kind)
    path = scratch(spark, "packing")
    tokens.write.option("compression", "zstd").parquet(path)
    tokens = spark.read.schema(tokens.schema).parquet(path)
    meta = tokens.drop("ids").withColumn("tail", F.col("n") % WINDOW).withColumn("full", F.expr(f"n div {WINDOW}"))

    # numbers per chunk and bin -> where each chunk begins (one row per chunk, or chunk and bin)
    counts = meta.groupBy("chunk", "bin").agg(F.count(F.lit(1)).alias("tails"), F.sum("full").alias("full"))
    counts = stored(counts, "packing")
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = counts.groupBy("chunk").agg(F.sum("full").alias("full")).select(
        "chunk", F.coalesce(F.sum("full").over(before), F.lit(0)).alias("chunk_full"))
    ranks = counts.select("chunk", "bin", F.coalesce(F.sum("tails").over(
        Window.partitionBy("bin").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("bin_before"))
    histogram, n_full = np.zeros(WINDOW // BIN + 1, np.int64), 0
    for r in counts.groupBy("bin").agg(F.sum("tails").alias("tails"), F.sum("full").alias("full")).collect():
        histogram[r.bin], n_full = r.tails, n_full + r.full
    histogram[0] = 0  # these end with a full window

    slots, seq, used = [], n_full, np.zeros(len(histogram), np.int64)
    for combo, times in plan(histogram):
        for k, b in enumerate(combo):
            slots.append((b, int(used[b]), int(used[b]) + times, seq, k))
            used[b] += times
        seq += times
    slots = spark.createDataFrame(slots, "bin int, lo bigint, hi bigint, seq bigint, slot int")

    # full windows: one sequence each
    full = meta.where("full > 0").join(chunks, "chunk").select(
        "id", "n", F.posexplode(F.slice("crcs", F.lit(1), F.col("full").cast("int"))).alias("i", "ids_crc32"),
        (F.col("chunk_full") + F.col("full_before")).alias("seq0"))
    full = full.select("id", (F.col("i").cast("bigint") * WINDOW).alias("start"), F.lit(WINDOW).cast("bigint").alias("length"),
                       "ids_crc32", "n", (F.col("seq0") + F.col("i")).alias("seq"), F.lit(0).cast("bigint").alias("offset"))

    # tails: placed by rank in their bin, or left over
    tails = meta.where("tail > 0").join(ranks, ["chunk", "bin"]).withColumn("rank", F.col("rank") + F.col("bin_before"))
    tails = tails.select("chunk", "row", "id", "n", "tail", "bin", "rank", F.element_at("crcs", -1).alias("ids_crc32"))
    s = F.broadcast(slots.toDF("slot_bin", "lo", "hi", "seq", "slot"))  # at most bins * DEPTH rows
    placed = tails.join(s, (F.col("bin") == F.col("slot_bin")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")), "left")
    placed = stored(placed.withColumn("seq", F.col("seq") + F.col("rank") - F.col("lo")).drop("slot_bin", "lo", "hi", "rank"), "packing")
    in_seq = Window.partitionBy("seq").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # at most DEPTH rows
    combined = placed.where("seq is not null").select(
        "id", (F.col("n") - F.col("tail")).alias("start"), F.col("tail").alias("length"), "ids_crc32", "n", "seq",
        F.coalesce(F.sum("tail").over(in_seq), F.lit(0)).alias("offset"))

    # the rest: a stream of tokens, cut where a window is full
    rest = placed.where("seq is null")
    sums = stored(rest.groupBy("chunk").agg(F.sum("tail").alias("total")), "packing")
    total = sums.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    ends, at = [], total - total % WINDOW
    for p in range(WINDOW.bit_length() - 1, -1, -1):  # the last window: powers of two
        if (total % WINDOW) >> p & 1:
            ends.append((at, at + (1 << p), seq + total // WINDOW + len(ends)))
            at += 1 << p
    last = ", ".join(f"named_struct('lo', {a}L, 'hi', {b}L, 'seq', {c}L)" for a, b, c in ends)
    sums = sums.select("chunk", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("chunk_before"))
    whole = total // WINDOW
    in_chunk = Window.partitionBy("chunk").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rest = rest.withColumn("at", F.coalesce(F.sum("tail").over(in_chunk), F.lit(0))).join(sums, "chunk").withColumn(
        "at", F.col("at") + F.col("chunk_before"))
    windows = (f"transform(filter(sequence(at div {WINDOW}, (at + tail - 1) div {WINDOW}), k -> k < {whole}L), "
               f"k -> named_struct('lo', k * {WINDOW}L, 'hi', (k + 1) * {WINDOW}L, 'seq', {seq}L + k))")
    if ends:
        windows = f"filter(concat({windows}, array({last})), w -> w.lo < at + tail and w.hi > at)"
    rest = rest.withColumn("w", F.explode(F.expr(windows))).select(
        "chunk", "row", "id", "n", "tail", "ids_crc32",
        (F.col("n") - F.col("tail") + F.greatest(F.col("w.lo") - F.col("at"), F.lit(0))).alias("start"),
        (F.least(F.col("w.hi"), F.col("at") + F.col("tail")) - F.greatest("w.lo", "at")).alias("length"),
        F.col("w.seq").alias("seq"), F.greatest(F.col("at") - F.col("w.lo"), F.lit(0)).alias("offset"))
    rest = stored(rest, "packing")
    names = ("id", "start", "length", "ids_crc32", "n", "seq", "offset")
    out = full.select(*names).unionByName(combined.select(*names)).unionByName(rest.where("length = tail").select(*names))
    out = out.unionByName(_cut(tokens, rest.where("length < tail"), kind).select(*names))
    return out.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", F.col("n").alias("doc_tokens"),
                      F.col("seq").alias("sequence_id"), "offset")


def _cut(tokens: DataFrame, pieces: DataFrame, kind: str) -> DataFrame:
    """CRCs of the pieces of tails that a window boundary cuts: only these documents' ids move."""
    by_doc = pieces.groupBy("chunk", "row").agg(F.collect_list(F.struct("start", "length", "seq", "offset")).alias("pieces"))
    by_doc = stored(by_doc, "packing")  # at most one tail per window boundary
    few = by_doc.count() <= MAX_BROADCAST
    rows = tokens.select("chunk", "row", "id", "n", "ids").join(F.broadcast(by_doc) if few else by_doc, ["chunk", "row"]).select("id", "n", "ids", "pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for i, (n, ids, parts) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)):
                ids = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                for p in parts:
                    at.append(i)
                    out.append((p["start"], p["length"], zlib.crc32(ids[p["start"]:p["start"] + p["length"]].tobytes()),
                                n, p["seq"], p["offset"]))
            cols = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in cols)],
                                             ["id", "start", "length", "ids_crc32", "n", "seq", "offset"])

    return rows.mapInArrow(run, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, n bigint, seq bigint, offset bigint")
