"""Operator 5: toxicity by FTRL-proximal logistic regression.

A text's features are its distinct hashed word unigrams, bigrams and skip-grams
(one word left out). The model learns per coordinate, with L1, so that few weights
stay; these are broadcast (at most ``2**BITS`` of them, 12 bytes each).

Learning takes a bounded sample: at most ``max_rows`` labelled rows, those with the
smallest hash of the id, toxic and clean ones alike. Everything else covers all
rows and whole texts.

Cases: a null or empty text has no feature but the bias and still gets a score;
labels that are null are ignored, of several labels of one id the largest counts;
repeated rows are scored each; a document without id is never learned from; empty
tables, or no label to learn from, give the score 0 for every document; columns
other than id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootsweep.llm.common import NO_WORD, ngram_hashes, own_columns, stored, word_steps

BITS = 18
MAX_ROWS = 16_000
THRESHOLD = 0.3
#: FTRL-proximal: step size, smoothing, L1, L2, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 1.0, 1.0, 4.0, 0.1, 3


def features(h: np.ndarray) -> np.ndarray:
    """Distinct hashed features of a text's word hashes, the bias (0) first."""
    grams = [h, ngram_hashes(h, (1,)), ngram_hashes(h, (2,)) ^ np.uint64(0x5851F42D4C957F2D)]
    idx = np.concatenate(grams) >> np.uint64(64 - BITS)
    out = np.unique(idx.astype(np.int32))
    return np.concatenate((np.zeros(1, np.int32), out[out > 0]))


class Ftrl:
    """FTRL-proximal with one step size per coordinate."""

    def __init__(self) -> None:
        self.z = np.zeros(1 << BITS)
        self.n = np.zeros(1 << BITS)

    def weights(self, idx: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        pull = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
        return -pull / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, idx: np.ndarray, label: int) -> None:
        w = self.weights(idx)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[idx]
        self.z[idx] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[idx] = n + g * g


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """One task: the bounded sample in hash order -> non-zero weights."""
    rows = rows.sort_values(["order", "id"], kind="stable")
    sets = [np.frombuffer(b, np.int32) for b in rows["features"]]
    labels = rows["label"].to_numpy()
    model = Ftrl()
    for turn in range(PASSES):
        for k in np.random.default_rng(turn).permutation(len(sets)):
            model.learn(sets[k], labels[k])
    w = model.weights(slice(None))
    keep = np.flatnonzero(w)
    return pd.DataFrame({"feature": keep.astype(np.int32), "weight": w[keep]})


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> list[tuple[int, float]]:
    """Non-zero weights, learned from labels of rows whose crc32(id) mod 4 is not 2."""
    known = (own_columns(labels, id_col, label_col).toDF("id", "label")
             .where("id is not null and label is not null and crc32(cast(id as string)) % 4 <> 2")
             .groupBy("id").agg((F.max("label") > 0).cast("int").alias("label"))
             .withColumn("order", F.xxhash64("id")))
    picked = stored(known.orderBy("order", "id").limit(max_rows), "toxicity")  # bounded: max_rows short rows
    text = own_columns(docs, id_col, text_col).toDF("id", "text")
    rows = text.join(F.broadcast(picked), "id")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, j, h, b in word_steps(batch.column(0), NO_WORD):
                out += [features(h[b[k]:b[k + 1]]).tobytes() for k in range(j - i)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), batch.column(3), pa.array(out, pa.binary())],
                                             ["id", "label", "order", "features"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.select("text", "id", "label", "order").mapInArrow(
        featurise, f"id {kind}, label int, order bigint, features binary")
    # copies of an id in documents count once, so the sample keeps its bound
    found = found.groupBy("id").agg(*[F.min(c).alias(c) for c in ("label", "order", "features")])
    fitted = found.groupBy().applyInPandas(_fit, "feature int, weight double")
    return [(r.feature, r.weight) for r in fitted.collect()]


def score(docs: DataFrame, weights: list[tuple[int, float]], threshold: float = THRESHOLD,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All input columns plus score (0 to 1) and predicted (1 if score >= threshold).
    One narrow pass; ids and all columns but the text are only carried along."""
    dense = np.zeros(1 << BITS)
    for i, w in weights:
        dense[i] = w
    model = docs.sparkSession.sparkContext.broadcast(dense)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            total = np.zeros(batch.num_rows)
            for i, j, h, b in word_steps(batch.column("text"), NO_WORD):
                hits, owner = _hits(w, h, b)
                pair = np.unique(owner.astype(np.int64) << BITS | hits)
                total[i:j] = w[0] + np.bincount(pair >> BITS, w[pair & ((1 << BITS) - 1)], j - i)
            s = 1.0 / (1.0 + np.exp(-np.clip(total, -500, 500))) if w.any() else np.zeros(len(total))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], [*batch.schema.names, "score"])

    names = [f.name for f in docs.schema]
    at = names.index(text_col)
    inner = ["text" if i == at else f"c{i}" for i in range(len(names))]
    ddl = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(inner, docs.schema, strict=True))
    out = docs.toDF(*inner).mapInArrow(run, f"{ddl}, score double")
    return out.toDF(*names, "score").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _hits(w: np.ndarray, h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features with a weight in a run of texts, and the text that each is in."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    shift = np.uint64(64 - BITS)
    found = []
    for gap, salt in ((0, 0), (1, 0), (2, 0x5851F42D4C957F2D)):
        g = h if gap == 0 else ngram_hashes(h, (gap,)) ^ np.uint64(salt)
        idx = (g >> shift).astype(np.int64)
        ok = (w[idx] != 0) & (idx > 0)
        if gap:
            ok &= owner[:len(idx)] == owner[gap:]
        found.append((idx[ok], owner[:len(idx)][ok]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD,
             id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per document: id, held_out (crc32(id) mod 4 is 2), score, predicted."""
    weights = train(docs, labels, max_rows, id_col, text_col, label_col)
    out = score(own_columns(docs, id_col, text_col), weights, threshold, id_col, text_col)
    held = F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 4 == 2, F.lit(False))
    return out.select(F.col(f"`{id_col}`"), held.alias("held_out"), "score", "predicted")
