"""Operator 9: Katz backoff language model of order 2 (word bigrams).

Counts of words and bigrams come from all learning texts. Good-Turing discounts apply
to counts up to ``GT_MAX`` (from the counts of counts); what they free goes to the next
lower order with a weight per history, normalised exactly over the words seen after
it. A word unknown to the learning texts has the unigram mass that is left.
A token's probability is looked up recursively: bigram, else weight times unigram.

Tables are partitioned: word counts by word, bigrams by history (those of a very
frequent history by both words, so none is hot). Texts are dealt to chunks; a chunk
asks the partitions for its distinct words, then for its distinct bigrams, and gets
counts and backoff weights back, as compressed integer columns. So what is shuffled
grows with the corpus, no table is broadcast, and a task holds one chunk or one
partition, both of bounded size: their number follows the bytes of text.

Cases: a null or empty text is the end token alone; words of any text count, however
long it is; repeated rows count and are scored each; a null id is learned from (its
remainder is not the held-out one) and scored; with nothing to learn from, base_score
uses N = V = 0 and score is the same number; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootsweep.llm.common import (
    SPACE,
    mix,
    own_columns,
    pack,
    pack_sorted,
    stored,
    unpack,
    unpack_sorted,
    word_steps,
)

GT_MAX = 5
#: Bytes of text in a chunk; histories that occur more often are spread over partitions.
CHUNK_BYTES = 16 << 20
HOT_HISTORY = 200_000
#: Word hashes are kept to 48 bits; two stand for the end token and for the start of a text.
_KEEP = np.uint64(16)
END, START = np.uint64(0xFFFFFFFFFFFF), np.uint64(0xFFFFFFFFFFFE)


class Discounts(NamedTuple):
    """What a count is worth: ``ratio[min(c, GT_MAX + 1)]`` * c."""
    ratio: np.ndarray

    def of(self, counts: np.ndarray) -> np.ndarray:
        return counts * self.ratio[np.minimum(counts, GT_MAX + 1).astype(np.int64)]


def good_turing(of_counts: dict[int, int]) -> Discounts:
    """Katz's discounts from counts of counts. Where the raw ones do not give ratios
    between 0 and 1, a line through their logarithms stands in for them (as in simple
    Good-Turing); where that fails too (very small corpora), r / (r + 1/2)."""
    r = np.arange(1, GT_MAX + 1)
    raw = np.array([of_counts.get(k, 0) for k in range(1, GT_MAX + 2)], float)
    tries = [raw] if raw.all() else []
    k = np.flatnonzero(raw)
    if len(k) > 1:
        slope, _ = np.polyfit(np.log(k + 1), np.log(raw[k]), 1)
        tries.append(np.arange(1, GT_MAX + 2) ** slope)
    ratio = np.ones(GT_MAX + 2)
    for n in tries:
        shared = (GT_MAX + 1) * n[-1] / n[0]
        got = ((r + 1) * n[1:] / n[:-1] / r - shared) / (1 - shared) if shared < 1 else np.zeros(1)
        if ((got > 0) & (got < 1)).all():
            ratio[1:GT_MAX + 1] = got
            return Discounts(ratio)
    ratio[1:GT_MAX + 1] = r / (r + 0.5)
    return Discounts(ratio)


def _words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """48-bit word hashes with the end token after each text."""
    for i, j, h, b in word_steps(texts, SPACE):
        yield i, j, np.insert(h >> _KEEP, b[1:], END), b + np.arange(len(b))


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


# ---- the texts in chunks ---------------------------------------------------------------
_BUNDLE = pa.schema([("chunk", pa.int32()), ("texts", pa.binary())])


def _bundles(docs: DataFrame) -> DataFrame:
    """Texts dealt to chunks, compressed: (chunk, bundle of rows). ``docs``: chunk, row, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            chunk, out = batch.column(0).to_numpy(), []
            for c in np.unique(chunk):
                part = batch.take(pa.array(np.flatnonzero(chunk == c)))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as w:
                    w.write_batch(part)
                out.append((int(c), squeeze.compress(sink.getvalue())))
            yield _rows(_BUNDLE, out)

    return docs.mapInArrow(run, "chunk int, texts binary")


def _unbundle(texts: pa.ChunkedArray) -> Iterator[pa.RecordBatch]:
    for blob in texts.to_pylist():
        if blob is not None:
            yield from pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob))


# ---- words --------------------------------------------------------------------------------
_ASK_WORDS = "part int, chunk int, words binary, counts binary"


def _ask_words(docs: DataFrame, parts: int) -> DataFrame:
    """Distinct words of each batch and chunk with their learning counts, by partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])
        held: dict[int, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            out = []
            for c, pieces in held.items():
                w = np.concatenate([p[0] for p in pieces] + [np.array([START])])
                n = np.concatenate([p[1] for p in pieces] + [np.zeros(1, np.uint64)])
                w, n = _summed(w, n)
                part = w % np.uint64(parts)
                for p in np.unique(part):
                    k = part == p
                    out.append((int(p), c, pack_sorted(w[k]), pack(n[k])))
            held.clear()
            return _rows(schema, out)

        for batch in batches:
            chunk, learn = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, h, b in _words(batch.column(2)):
                of = np.repeat(np.arange(i, j), np.diff(b))
                for c in np.unique(chunk[i:j]):
                    k = chunk[of] == c
                    held.setdefault(int(c), []).append(_summed(h[k], learn[of[k]].astype(np.uint64)))
                size += len(h)
            if size > 6_000_000:
                yield flush()
                size = 0
        if held:
            yield flush()

    return docs.select("chunk", "learn", "text").mapInArrow(run, _ASK_WORDS)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sum of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first)


_LEXICA = pa.schema([("chunk", pa.int32()), ("part", pa.int32()), ("words", pa.binary()), ("numbers", pa.binary()), ("counts", pa.binary())])


def _answer_words(asked: DataFrame) -> DataFrame:
    """Per partition: total counts. Rows for each chunk: its words, their numbers (rank by
    count in the partition, so frequent words have small ones) and counts; in one row
    (chunk -1) the counts of counts."""
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        words = [unpack_sorted(b) for b in table.column("words").to_pylist()]
        w, n = _summed(np.concatenate(words), np.concatenate([unpack(b) for b in table.column("counts").to_pylist()]))
        number = np.empty(len(w), np.uint64)
        number[np.argsort(-n.astype(np.int64), kind="stable")] = np.arange(len(w), dtype=np.uint64)
        chunk, out = table.column("chunk").to_numpy(), []
        for c in np.unique(chunk):
            own = np.unique(np.concatenate([words[i] for i in np.flatnonzero(chunk == c)]))
            at = np.searchsorted(w, own)
            out.append((int(c), part, pack_sorted(own), pack(number[at]), pack(n[at])))
        out.append((-1, part, b"", *_counts_of(n)))
        return pa.Table.from_batches([_rows(_LEXICA, out)])

    return asked.groupBy("part").applyInArrow(run, "chunk int, part int, words binary, numbers binary, counts binary")


def _counts_of(n: np.ndarray) -> tuple[bytes, bytes]:
    """How many have each count; all over GT_MAX + 1 by their number (0) and sum (-1)."""
    n = n[n > 0]
    r, k = np.unique(n[n <= GT_MAX + 1], return_counts=True)
    large = n[n > GT_MAX + 1]
    return (pack(np.concatenate((r, np.array([0, GT_MAX + 2], np.uint64)))),
            pack(np.concatenate((k.astype(np.uint64), np.array([len(large), large.sum()], np.uint64)))))


def _histogram(rows: DataFrame, kinds: str, sums: str) -> dict[int, int]:
    """Counts of counts over all partitions (GT_MAX + 3 numbers): 0 and GT_MAX + 2 hold the
    number and the sum of the larger counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(unpack(a).astype(np.int64)), pa.array(unpack(b).astype(np.int64))], ["r", "k"])

    got = rows.select(kinds, sums).mapInArrow(run, "r bigint, k bigint").groupBy("r").agg(F.sum("k").alias("k")).collect()
    return {r.r: r.k for r in got}


class Lexicon(NamedTuple):
    """A chunk's words: hashes (ascending), corpus-wide numbers, learning counts."""
    words: np.ndarray
    numbers: np.ndarray
    counts: np.ndarray
    order: np.ndarray  # by number

    def at_number(self, numbers: np.ndarray) -> np.ndarray:
        return self.order[np.searchsorted(self.numbers, numbers, sorter=self.order)]


def _lexicon(rows: list[dict], parts: int) -> Lexicon:
    w = np.concatenate([unpack_sorted(r["a"]) for r in rows])
    k = np.concatenate([unpack(r["b"]) * np.uint64(parts) + np.uint64(r["part"]) for r in rows])
    n = np.concatenate([unpack(r["c"]) for r in rows]).astype(np.int64)
    order = np.argsort(w)
    return Lexicon(w[order], k[order], n[order], np.argsort(k[order]))


# ---- bigrams --------------------------------------------------------------------------------
class _Tokens(NamedTuple):
    """A chunk's tokens in order: place in the lexicon of the word and of the history
    before it; of each row: id, whether it is learned from, first token."""
    words: np.ndarray
    before: np.ndarray
    ids: pa.Array
    learn: np.ndarray
    starts: np.ndarray


def _tokens(texts: pa.ChunkedArray, lexicon: Lexicon) -> _Tokens:
    words, starts, ids, learn, total = [], [], [], [], 0
    for batch in _unbundle(texts):
        for _, _, h, b in _words(batch.column("text")):
            words.append(np.searchsorted(lexicon.words, h).astype(np.int32))
            starts.append(b[:-1] + total)
            total += len(h)
        ids.append(batch.column("id"))
        learn.append(batch.column("learn").to_numpy(zero_copy_only=False))
    w, s = np.concatenate(words), np.concatenate(starts)
    before = np.concatenate((w[:1], w[:-1]))
    before[s] = np.searchsorted(lexicon.words, START)
    return _Tokens(w, before, pa.chunked_array(ids).combine_chunks(), np.concatenate(learn), s)


class _Pairs(NamedTuple):
    """Distinct bigrams (history in the high, word in the low 32 bits), ascending, how
    often learned, the partition to ask, and of each token the bigram's place."""
    pairs: np.ndarray
    learned: np.ndarray
    part: np.ndarray
    of_token: np.ndarray


def _pairs(t: _Tokens, lexicon: Lexicon, hot_from: int, parts: int) -> _Pairs:
    """A bigram's partition follows its history, or both words where the history is hot."""
    all_pairs = lexicon.numbers[t.before] << np.uint64(32) | lexicon.numbers[t.words]
    order = np.argsort(all_pairs)
    ranked = all_pairs[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    of_token = np.empty(len(order), np.int32)
    of_token[order] = np.cumsum(new) - 1
    pairs = ranked[new]
    row_tokens = np.diff(np.append(t.starts, len(t.words)))
    learned = np.bincount(of_token, np.repeat(t.learn, row_tokens), len(pairs)).astype(np.uint64)
    h = lexicon.at_number(pairs >> np.uint64(32))
    hot = (lexicon.counts[h] >= hot_from) | (lexicon.words[h] == START)
    part = (mix(np.where(hot, pairs, pairs >> np.uint64(32))) % np.uint64(parts)).astype(np.int64)
    return _Pairs(pairs, learned, part, of_token)


def _ask_pairs(bundles: DataFrame, lexica: DataFrame, parts: int, hot_from: int) -> DataFrame:
    """Each chunk's distinct bigrams by partition, with learning counts and the word's count."""
    schema = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("pairs", pa.binary()), ("learned", pa.binary()), ("words", pa.binary())])

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        if not len(texts):
            return pa.Table.from_batches([_rows(schema, [])])
        lexicon = _lexicon(words.to_pylist(), parts)
        c = _pairs(_tokens(texts.column("texts"), lexicon), lexicon, hot_from, parts)
        w = lexicon.counts[lexicon.at_number(c.pairs & np.uint64(0xFFFFFFFF))]
        chunk, out = texts.column("chunk")[0].as_py(), []
        order = np.argsort(c.part, kind="stable")  # by partition, then number
        edges = np.searchsorted(c.part[order], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(edges)):
            k = order[edges[p]:edges[p + 1]]
            out.append((int(p), chunk, pack_sorted(c.pairs[k]), pack(c.learned[k]), pack(w[k])))
        return pa.Table.from_batches([_rows(schema, out)])

    return bundles.groupBy("chunk").cogroup(lexica.groupBy("chunk")).applyInArrow(
        run, "part int, chunk int, pairs binary, learned binary, words binary")


_FOUND = pa.schema([("kind", pa.string()), ("chunk", pa.int32()), ("part", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_FOUND_DDL = "kind string, chunk int, part int, a binary, b binary, c binary"


def _count_pairs(asked: DataFrame, words: Discounts, total: float, parts: int) -> DataFrame:
    """Per partition: each bigram's count. Rows ``pairs``: the counts that a chunk asked for;
    ``sums``: for the partition of each history's word, of every history: how many words
    follow it 1, 2, ... GT_MAX times, the sum of larger counts, and the unigram mass of all;
    ``counts``: counts of counts."""
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        asks = [unpack_sorted(b) for b in table.column("pairs").to_pylist()]
        pairs, first = np.unique(np.concatenate(asks), return_index=True)
        mass = words.of(np.concatenate([unpack(b) for b in table.column("words").to_pylist()])[first]) / total
        counts = np.zeros(len(pairs), np.uint64)
        for a, b in zip(asks, table.column("learned").to_pylist(), strict=True):
            counts[np.searchsorted(pairs, a)] += unpack(b)
        out = [("pairs", int(c), part, pack(counts[np.searchsorted(pairs, a)]), b"", b"")
               for c, a in zip(table.column("chunk").to_pylist(), asks, strict=True)]
        seen = counts > 0
        h, n, mass = pairs[seen] >> np.uint64(32), counts[seen], mass[seen]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        if len(h):
            parts_of = [np.add.reduceat((n == r).astype(np.uint64), first) for r in range(1, GT_MAX + 1)]
            parts_of.append(np.add.reduceat(np.where(n > GT_MAX, n, np.uint64(0)), first))
            sums, mass, h = np.stack(parts_of), np.add.reduceat(mass, first), h[first]
            home = h % np.uint64(parts)
            for p in np.unique(home):
                k = home == p
                out.append(("sums", -1, int(p), pack_sorted(h[k]), pack(sums[:, k].ravel()), mass[k].tobytes()))
        out.append(("counts", -1, part, *_counts_of(n), b""))
        return pa.Table.from_batches([_rows(_FOUND, out)])

    return asked.groupBy("part").applyInArrow(run, _FOUND_DDL)


def backoff_weight(worth: np.ndarray, count: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A history's count (one more where discounts free nothing) and backoff weight."""
    n = np.where(count - worth > 1e-9 * count, count, count + 1).astype(float)
    return n, (1 - worth / n) / np.maximum(1e-300, 1 - mass)


def _answer_weights(sums: DataFrame, lexica: DataFrame, pairs: Discounts, parts: int) -> DataFrame:
    """Per partition of words, for each chunk: count and backoff weight of its words as histories."""
    def run(found: pa.Table, asked: pa.Table) -> pa.Table:
        out, known = [], np.zeros(0, np.uint64)
        rows = found.to_pylist()
        if rows:
            h = np.concatenate([unpack_sorted(r["a"]) for r in rows])
            tallies = np.concatenate([unpack(r["b"]).reshape(GT_MAX + 1, -1) for r in rows], 1).astype(float)
            mass = np.concatenate([np.frombuffer(r["c"]) for r in rows])
            known, at = np.unique(h, return_inverse=True)
            tallies = np.stack([np.bincount(at, t, len(known)) for t in tallies])
            r = np.arange(1, GT_MAX + 1)
            count = r @ tallies[:-1] + tallies[-1]
            worth = (r * pairs.ratio[1:GT_MAX + 1]) @ tallies[:-1] + tallies[-1]
            n, weight = backoff_weight(worth, count, np.bincount(at, mass, len(known)))
        for row in asked.to_pylist():
            number = unpack(row["b"]) * np.uint64(parts) + np.uint64(row["part"])
            own_n, own_weight = np.ones(len(number)), np.ones(len(number))  # never a history: weight 1
            if len(known):
                k = np.minimum(np.searchsorted(known, number), len(known) - 1)
                ok = known[k] == number
                own_n[ok], own_weight[ok] = n[k[ok]], weight[k[ok]]
            out.append(("weights", row["chunk"], row["part"], pack(own_n.astype(np.uint64)), own_weight.tobytes(), b""))
        return pa.Table.from_batches([_rows(_FOUND, out)])

    return sums.groupBy("part").cogroup(lexica.groupBy("part")).applyInArrow(run, _FOUND_DDL)


# ---- scores -----------------------------------------------------------------------------------
class Unigrams(NamedTuple):
    discounts: Discounts
    tokens: int        # N
    distinct: int      # V
    total: float       # N, or N + 1 where discounts free nothing
    unknown: float     # mass of all unknown words


def _unigrams(histogram: dict[int, int]) -> Unigrams:
    small = {r: histogram.get(r, 0) for r in range(1, GT_MAX + 2)}
    tokens = sum(r * k for r, k in small.items()) + histogram.get(GT_MAX + 2, 0)
    d = good_turing(small)
    freed = sum((r * k) * (1 - d.ratio[r]) for r, k in small.items())
    total = float(tokens if freed > 1e-9 * max(1, tokens) else tokens + 1)
    return Unigrams(d, tokens, sum(small.values()) + histogram.get(0, 0), total, 1 - (tokens - freed) / total)


def _score(bundles: DataFrame, found: DataFrame, uni: Unigrams, pairs: Discounts, hot_from: int, parts: int, kind: str) -> DataFrame:
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        rows = answers.to_pylist()
        ask = sorted((r for r in rows if r["kind"] == "words"), key=lambda r: r["part"])
        lexicon = _lexicon(ask, parts)
        back = {r["part"]: r for r in rows if r["kind"] == "weights"}
        words = np.concatenate([unpack_sorted(r["a"]) for r in ask])
        order = np.argsort(words)
        n = np.concatenate([unpack(back[r["part"]]["a"]) for r in ask])[order].astype(float)
        weight = np.concatenate([np.frombuffer(back[r["part"]]["b"]) for r in ask])[order]
        t = _tokens(texts.column("texts"), lexicon)
        c = _pairs(t, lexicon, hot_from, parts)
        counts = np.empty(len(c.pairs), np.int64)
        counts[np.argsort(c.part, kind="stable")] = np.concatenate(
            [unpack(r["a"]) for r in sorted((r for r in rows if r["kind"] == "pairs"), key=lambda r: r["part"])])
        first = np.where(lexicon.counts > 0, uni.discounts.of(lexicon.counts) / uni.total, uni.unknown)
        base = np.log10((lexicon.counts + 1) / (uni.tokens + uni.distinct + 1))
        h, w = lexicon.at_number(c.pairs >> np.uint64(32)), lexicon.at_number(c.pairs & np.uint64(0xFFFFFFFF))
        p = np.log10(np.where(counts > 0, pairs.of(counts) / n[h], weight[h] * first[w]))  # of each distinct bigram
        each = [np.ones(len(t.words), np.int64), (lexicon.counts > 0).astype(np.int64)[t.words], base[t.words], p[c.of_token]]
        return pa.table([t.ids, *(pa.array(np.add.reduceat(x, t.starts)) for x in each)],  # no text is without a token
                        names=["id", "n_tokens", "n_known", "base_score", "score"])

    return bundles.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        run, f"id {kind}, n_tokens bigint, n_known bigint, base_score double, score double")


def katz_scores(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, held_out (crc32(id) mod 7 is 2), n_tokens, n_known, train_tokens,
    base_score, score."""
    src = own_columns(docs, id_col, text_col).toDF("id", "text")
    kind = src.schema["id"].dataType.simpleString()
    size = src.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]
    parts = max(2, -(-size // chunk_bytes))
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % 7 == 2, F.lit(False))
    src = src.select(F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("chunk"), (~held).alias("learn"), "text", "id")
    lexica = stored(_answer_words(_ask_words(src, parts)), "katz")
    uni = _unigrams(_histogram(lexica.where("chunk = -1"), "numbers", "counts"))
    lexica = lexica.where("chunk >= 0").toDF("chunk", "part", "a", "b", "c")
    bundles = _bundles(src)
    found = stored(_count_pairs(_ask_pairs(bundles, lexica, parts, HOT_HISTORY), uni.discounts, uni.total, parts), "katz")
    pairs = good_turing(_histogram(found.where("kind = 'counts'"), "a", "b"))
    weights = _answer_weights(found.where("kind = 'sums'"), lexica, pairs, parts)
    answers = found.where("kind = 'pairs'").unionByName(weights).unionByName(
        lexica.withColumn("kind", F.lit("words")).select(*weights.columns))
    out = _score(bundles, answers, uni, pairs, HOT_HISTORY, parts, kind)
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % 7 == 2, F.lit(False))
    return out.select(F.col("id").alias(id_col), held.alias("held_out"), "n_tokens", "n_known",
                      F.lit(uni.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
