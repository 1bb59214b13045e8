"""Operator 1: token counts by byte-pair merging.

A word starts as one symbol per byte. The adjacent pairs that have a rank wait in
a heap; the lowest is popped and merged in a linked list until none is left. The
count is the initial symbols minus the merges; identifiers are never made.

Cases: a null text counts as empty (0 bytes, 0 tokens); texts of any length are
counted whole; repeated rows are counted each; an empty table gives an empty
result; other columns of the input are ignored. A special string inside a text
(``added_tokens`` of the file) is one token, as the library takes it by default.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootsweep.llm.common import own_columns

#: Chunks whose counts a worker remembers before it starts over.
CACHE = 400_000
#: White space as \s has it, and the split pattern of byte-level BPE.
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Parts of a text that the split pattern never crosses.
_CHUNK = re.compile(rf" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]")
_SPLIT = regex.compile(_PATTERN)
#: The same pattern for texts below U+0180, where classes are short enough to write out.
_L, _N = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPLIT_LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_WS}{_L}{_N}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


def _byte_symbols() -> list[str]:
    """The character that stands for each byte in the vocabulary file: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, more = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else more))
        more += b not in shown
    return out


class MergeCounter(dict):
    """Chunk of text -> number of tokens; counted when first asked for."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.symbol = [vocab[c] for c in _byte_symbols()]
        self.rank = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.rank.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        specials = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None

    def word(self, raw: bytes) -> int:
        """Tokens of one word by heap and linked list."""
        size = len(raw)
        if size < 2:
            return size
        sym = [self.symbol[b] for b in raw]
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        rank, heap, merges = self.rank, [], 0
        for i in range(size - 1):
            found = rank.get((sym[i], sym[i + 1]))
            if found:
                heap.append((found[0], i, sym[i], sym[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= size or sym[j] != b:
                continue  # one side has been merged meanwhile
            sym[i], sym[j] = merged, -1
            k = after[i] = after[j]
            merges += 1
            if k < size:
                before[k] = i
                found = rank.get((merged, sym[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, merged, sym[k], found[1]))
            h = before[i]
            if h >= 0:
                found = rank.get((sym[h], merged))
                if found:
                    heapq.heappush(heap, (found[0], h, sym[h], merged, found[1]))
        return size - merges

    def __missing__(self, chunk: str) -> int:
        split = _SPLIT_LATIN if max(chunk) < "\u0180" else _SPLIT
        n = sum(self.word(w.encode("utf-8")) for w in split.findall(chunk))
        if len(self) >= CACHE:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = n
        return n

    def text(self, text: str) -> int:
        """Tokens of a whole text; each special string in it is one."""
        if self.special is not None and "<" in text:
            parts = self.special.split(text)
            if len(parts) > 1:
                return len(parts) - 1 + sum(self.text(p) for p in parts)
        return sum(map(self.__getitem__, _CHUNK.findall(text)))


@lru_cache(maxsize=2)
def _counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    ``tokenizer`` is the path of a byte-level BPE ``tokenizer.json`` that every
    executor can open. One narrow pass, no shuffle; a worker holds one Arrow batch,
    the merge table and a bounded cache.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            text = batch.column(1)
            n = pa.array([0 if t is None else counter.text(t) for t in text.to_pylist()], pa.int64())
            size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, n], ["id", "n_bytes", "n_tokens"])

    src = own_columns(docs, id_col, text_col)
    kind = src.schema[0].dataType.simpleString()
    out = src.mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
