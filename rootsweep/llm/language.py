"""Operator 6: language identification with a string kernel.

Kernel: blended spectrum over presence of character n-grams, n = 1 to 4: for each n
the share of common n-grams (cosine of presence vectors), averaged over n. Landmarks
(a bounded set of learning texts) give Nystroem features; one-versus-rest kernel
ridge regression on them gives a weight per landmark and language. Scoring is a
product of a batch of presence vectors with the landmarks' presence matrix, then of
the kernel values with the weights. Letters are lower-cased, everything that is no
letter is one space.

Learning takes a sample: ``LANDMARKS`` landmarks and ``ROWS`` rows, an equal number for
each language, those with the smallest hash of the id; languages are counted over all
rows and every one is learned. With many languages the sample grows with their number:
at least ``LEAST_ROWS`` rows and ``LEAST_LANDMARKS`` landmarks for each.

Cases: a null text, or one without letters, gives lang_pred ``und`` and score 0;
texts of any length are read whole; a null lang is never learned from; repeated rows
are predicted each; with nothing to learn from, every text gives ``und``; columns
other than id, text and (when learning) lang are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rootsweep.llm.common import own_columns, stored

ORDERS = (1, 2, 3, 4)
#: Hash bits of the n-grams of each order.
ORDER_BITS = (12, 15, 16, 16)
LANDMARKS, ROWS = 96, 1_200
LEAST_LANDMARKS, LEAST_ROWS = 1, 18
RIDGE = 0.01
#: Characters hashed at a time.
STEP = 1 << 18
UNKNOWN = "und"


class Model(NamedTuple):
    """Columns: hashed n-gram -> place among the landmarks' n-grams, or -1."""
    langs: list[str]
    place: np.ndarray
    order: np.ndarray      # of each place
    presence: np.ndarray   # places x landmarks
    sizes: np.ndarray      # orders x landmarks: root of the number of n-grams
    weights: np.ndarray    # landmarks x languages
    base: np.ndarray


_START = np.concatenate(([0], np.cumsum([1 << b for b in ORDER_BITS])))


def _fold(text: str) -> np.ndarray:
    """Code points of the lower-cased text between spaces; other than letters: one space."""
    t = text.lower()
    c = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = (c >= 97) & (c <= 122) | (c >= 0xC0) & (c != 0xD7) & (c != 0xF7) & (c < 0x2000)
    for k in np.unique(c[c >= 0x2000]):  # beyond the alphabets that are told by range
        if chr(k).isalpha():
            letter |= c == k
    c = np.where(letter, c, 32)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    return np.concatenate(([32], c[keep], [32])).astype(np.uint64)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def grams(text: str) -> np.ndarray:
    """Distinct hashed n-grams of all orders, ascending."""
    c = _fold(text)
    seen = np.zeros(int(_START[-1]), bool)
    for at in range(0, len(c), STEP):
        part = c[at:at + STEP + max(ORDERS) - 1]
        h = np.zeros(len(part), np.uint64)
        for k, n in enumerate(ORDERS):
            h = h[:len(part) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1:] + np.uint64(1)
            x = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            seen[(x >> np.uint64(64 - ORDER_BITS[k])).astype(np.int64) + _START[k]] = True
    return np.flatnonzero(seen).astype(np.int32)


def _sizes(g: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(1, np.diff(np.searchsorted(g, _START))))


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """One task: landmarks and learning rows -> weight of each landmark and language."""
    rows = rows.sort_values(["rank", "lang", "order"], kind="stable").reset_index(drop=True)
    sets = [np.frombuffer(b, np.int32) for b in rows["grams"]]
    langs = sorted(set(rows["lang"]))
    m = min(max(LANDMARKS, LEAST_LANDMARKS * len(langs)), len(sets))
    model = _with_landmarks(langs, sets[:m])
    k = np.concatenate([kernel(model, sets[i:i + 64]) for i in range(0, len(sets), 64)])
    y = np.where(rows["lang"].to_numpy()[:, None] == np.array(langs)[None, :], 1.0, 0.0)
    val, vec = np.linalg.eigh(k[:m])
    root = vec / np.sqrt(np.maximum(val, 1e-6))          # Nystroem: k(x, landmarks) @ root
    phi = k @ root
    base = y.mean(axis=0)
    a = phi.T @ phi + RIDGE * len(sets) * np.eye(m) / m
    w = root @ np.linalg.solve(a, phi.T @ (y - base))
    return pd.DataFrame({"lang": langs, "base": base, "weights": [w[:, i].tobytes() for i in range(len(langs))],
                         "landmarks": [[s.tobytes() for s in sets[:m]]] + [[] for _ in langs[1:]]})


def _with_landmarks(langs: list[str], sets: list[np.ndarray]) -> Model:
    known = np.unique(np.concatenate(sets))
    place = np.full(int(_START[-1]), -1, np.int32)
    place[known] = np.arange(len(known))
    presence = np.zeros((len(known), len(sets)), np.float32)
    for i, s in enumerate(sets):
        presence[place[s], i] = 1
    order = np.searchsorted(_START, known, "right") - 1
    return Model(langs, place, order, presence, np.stack([_sizes(s) for s in sets], 1), np.zeros(0), np.zeros(0))


def kernel(model: Model, sets: list[np.ndarray]) -> np.ndarray:
    """Kernel values of a batch of texts with all landmarks."""
    own = np.stack([_sizes(s) for s in sets])
    out = np.zeros((len(sets), model.presence.shape[1]))
    x = np.zeros((len(sets), len(model.presence)), np.float32)
    for i, s in enumerate(sets):
        p = model.place[s]
        x[i, p[p >= 0]] = 1
    for k in range(len(ORDERS)):
        a, b = np.searchsorted(model.order, [k, k + 1])
        out += (x[:, a:b] @ model.presence[a:b]) / own[:, k, None] / model.sizes[k]
    return out / len(ORDERS)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows: int = ROWS) -> Model | None:
    """Model learned from rows whose crc32(id) mod 4 is not 2 and whose lang is known."""
    src = own_columns(docs, id_col, lang_col, text_col).toDF("id", "lang", "text").where(
        "lang is not null and text is not null and id is not null and crc32(cast(id as string)) % 4 <> 2")
    # rows that repeat an id are one row of the sample
    counted = src.groupBy("lang").agg(F.greatest(F.lit(1), F.approx_count_distinct("id")).alias("count")).collect()
    if not counted:
        return None
    each = max(LEAST_ROWS, rows // len(counted))
    # the smallest hashes of each language: a share of the hash range that holds about
    # twice as many rows as wanted (all, if there are few), so that a few rows are ranked
    top = docs.sparkSession.createDataFrame(
        [(r["lang"], min(2**63 - 1, -2**63 + 2**64 * 2 * (each + 32) // r["count"])) for r in counted], "lang string, top bigint")
    ids = src.select("id", "lang", F.xxhash64("id").alias("order")).join(F.broadcast(top), "lang")
    ids = ids.where(F.col("order") <= F.col("top")).select("id", "lang", "order").distinct()
    w = Window.partitionBy("lang").orderBy("order")
    ids = ids.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= each).select("id", "lang", "order", "rank")
    ids = stored(ids, "language")  # about ``rows`` short rows, or LEAST_ROWS for each language
    picked = own_columns(docs, id_col, text_col).toDF("id", "text").join(F.broadcast(ids), "id").where("text is not null")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = pa.array([grams(t).tobytes() for t in b.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("order"), b.column("rank"), g],
                                             ["lang", "order", "rank", "grams"])

    found = picked.select("text", "lang", "order", "rank").mapInArrow(
        featurise, "lang string, order bigint, rank int, grams binary")
    found = found.groupBy("lang", "order").agg(F.min("rank").alias("rank"), F.min("grams").alias("grams"))
    fitted = found.groupBy().applyInPandas(
        _fit, "lang string, base double, weights binary, landmarks array<binary>").collect()
    if not fitted:
        return None
    fitted = sorted(fitted, key=lambda r: r.lang)
    sets = [np.frombuffer(b, np.int32) for r in fitted for b in r.landmarks]
    model = _with_landmarks([r.lang for r in fitted], sets)
    return model._replace(weights=np.stack([np.frombuffer(r.weights) for r in fitted], 1),
                          base=np.array([r.base for r in fitted]))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, lang_pred, score (the winner's share of the positive outputs)."""
    src = own_columns(docs, id_col, text_col).toDF("id", "text")
    kind = src.schema["id"].dataType.simpleString()
    if model is None:
        return src.select(F.col("id").alias(id_col), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = src.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            langs, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            for at in range(0, batch.num_rows, 128):
                texts = batch.column(1).slice(at, 128).to_pylist()
                rows = [i for i, t in enumerate(texts) if has_letter(t)]
                if not rows:
                    continue
                out = np.clip(kernel(m, [grams(texts[i]) for i in rows]) @ m.weights + m.base, 1e-6, None)
                best = out.argmax(axis=1)
                share = out.max(axis=1) / out.sum(axis=1)
                for i, b, s in zip(rows, best, share, strict=True):
                    langs[at + i], scores[at + i] = m.langs[b], s
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs), pa.array(scores)], ["id", "lang_pred", "score"])

    return src.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: id, held_out (crc32(id) mod 4 is 2), lang_pred, score."""
    out = identify(docs, train(docs, id_col, text_col, lang_col), id_col, text_col)
    held = F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 4 == 2, F.lit(False))
    return out.select(F.col(f"`{id_col}`"), held.alias("held_out"), "lang_pred", "score")
