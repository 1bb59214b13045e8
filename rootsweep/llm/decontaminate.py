"""Operator 2: benchmark decontamination with an Aho-Corasick automaton.

Texts are normalised to lower-case words joined by single spaces; every window of
13 consecutive item words (or the whole item, if shorter) is a pattern between
spaces. A document is scanned once; a match's place in the normalised text is
mapped to word numbers and to character offsets of the original text.

The automaton is built in the tasks from a broadcast of items. Its size is bounded:
items are dealt to blocks of at most about ``block_bytes`` of text, one automaton
each, and the documents pass one block after the other (written out in between),
carrying what was hit so far. One block serves any usual benchmark.

Cases: a null or empty text has no words and no hits; null items have no windows;
an item id that occurs in several rows is one item (all its rows' windows count),
windows of a null id hit words but are no item; equal windows of several items
count for each; repeated documents are judged each; an empty benchmark hits
nothing; other columns are ignored. Without items, items_sha256 is that of "".
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootsweep.llm.common import stored

WINDOW = 13
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_STATE = ["text", "n_words", "words", "items", "spans"]
_DDL = "text string, n_words bigint, words array<int>, items array<string>, spans array<int>"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_FOLD).split()


def automaton(items: list[tuple[str | None, str]], window: int) -> ahocorasick.Automaton | None:
    """Patterns -> (number of words, ids of the items that have this window).
    UTF-8 bytes stand as Latin-1 characters, so offsets are byte offsets."""
    found: dict[str, tuple[int, set]] = {}
    for item, text in items:
        words = words_of(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            key = (b" " + b" ".join(words[i:i + n]) + b" ").decode("latin-1")
            found.setdefault(key, (n, set()))[1].add(item)
    if not found:
        return None
    out = ahocorasick.Automaton()
    for key, (n, ids) in found.items():
        out.add_word(key, (n, len(key), tuple(i for i in ids if i is not None)))
    out.make_automaton()
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def scan(machine: ahocorasick.Automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
    """Merged spans of hit words (first, end) and the items found."""
    line = (b" " + b" ".join(words) + b" ")
    starts, spans, items = None, [], set()
    for end, (n, size, ids) in machine.iter(line.decode("latin-1")):
        if starts is None:
            starts = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        k = int(np.searchsorted(starts, end - size + 1))
        spans.append((k, k + n))
        items.update(ids)
    return _merged(spans), items


def original_spans(raw: bytes, spans: list[tuple[int, int]]) -> list[int]:
    """Character offsets [start, end, ...] in the original text of word spans."""
    inside = np.frombuffer(raw.translate(_FOLD), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [int(x) for s, e in spans for x in (chars[first[s]], chars[last[e - 1]])]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20,
                  block_bytes: int = 100_000, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", carry: bool = False) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated
    (n_hit > 0 and share * n_hit >= n_words), spans (hit character ranges of the
    original text). With ``carry`` all columns of the input and contaminated instead.
    Narrow passes over the documents, no shuffle."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"),
                             F.col(f"`{item_text}`").alias("text")).where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    names = docs.columns if carry else [id_col]
    own = [f"c{i}" for i in range(len(names))]
    none = F.array().cast("array<int>")
    state = docs.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(names, own, strict=True)], F.col(f"`{text_col}`").alias("text"),
                        F.lit(0).cast("bigint").alias("n_words"), none.alias("words"),
                        F.array().cast("array<string>").alias("items"), none.alias("spans"))
    for b in range(blocks):
        part = [(r.item, r.text) for r in items.where(F.col("block") == b).select("item", "text").collect()]
        state = _pass(state, spark.sparkContext.broadcast(part), window, last=b == blocks - 1)
        if b < blocks - 1:
            state = stored(state, "decontaminate")
    hit = F.expr("aggregate(sequence(0, size(words) - 1, 2), 0L, (s, i) -> s + words[i + 1] - words[i])")
    ids = F.array_sort(F.array_distinct("items"))
    out = state.select(*own, "n_words", F.when(F.size("words") > 0, hit).otherwise(F.lit(0)).cast("bigint").alias("n_hit"),
                       F.size(ids).cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), "spans")
    out = out.select(*own, "n_words", "n_hit", "n_items", "items_sha256",
                     ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "spans")
    if carry:
        return out.select(*own, "contaminated").toDF(*names, "contaminated")
    return out.withColumnRenamed(own[0], id_col)


def _pass(state: DataFrame, items, window: int, last: bool) -> DataFrame:
    """One scan of all documents with one block's automaton; other columns are carried."""
    carried = [f for f in state.schema if f.name not in _STATE]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in carried] + [_DDL])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(items.value, window)
        for batch in batches:
            text_col = batch.column("text")
            n_words, spans, found, chars = [], [], [], []
            for text, had, ids in zip(*(batch.column(c).to_pylist() for c in ("text", "words", "items")), strict=True):
                raw = (text or "").encode("utf-8")
                words = raw.translate(_FOLD).split()
                n_words.append(len(words))
                hits = list(zip(had[::2], had[1::2], strict=True))
                if machine is not None and words:
                    new, more = scan(machine, words)
                    if new:
                        hits, ids = _merged(hits + new), [*ids, *more]
                spans.append([x for pair in hits for x in pair])
                found.append(ids)
                chars.append(original_spans(raw, hits) if last and hits else [])
            kept = pa.nulls(len(text_col), pa.string()) if last else text_col
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in carried), kept, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int32())),
                 pa.array(found, pa.list_(pa.string())), pa.array(chars, pa.list_(pa.int32()))],
                [*(f.name for f in carried), *_STATE])

    return state.mapInArrow(run, schema)
