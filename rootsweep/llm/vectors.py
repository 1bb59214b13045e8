"""Vectors as exact integers: ``floor(scale * component)`` per component, as bytes."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Scaled components from this size on are not held as integers (the vector is dropped).
LARGEST = float(1 << 62)
#: Exact sums of integers cross Spark as this type.
EXACT = pa.decimal128(38, 0)


def own(name: str):
    """The column of exactly this name."""
    return F.col(f"`{name}`")


def common_length(table: DataFrame, vector: str) -> int:
    """The most frequent length of a vector (of equally frequent ones the longest); 0 if
    there is none."""
    found = (table.select(F.size(own(vector)).alias("d")).where("d > 0").groupBy("d").count()
             .orderBy(F.desc("count"), F.desc("d")).first())
    return 0 if found is None else found["d"]


def integers(vectors: pa.Array, length: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, matrix): which vectors have this length and only finite components, and
    their scaled components rounded down."""
    at = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(vectors), length), False).to_numpy(zero_copy_only=False))
    flat = vectors.take(pa.array(at)).flatten()
    raw = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(raw * scale).reshape(-1, length)
        good = (np.abs(x) < LARGEST).all(1)  # false for what is not a number
    return at[good], x[good].astype(np.int64)


def to_bytes(x: np.ndarray) -> pa.Array:
    """One binary a row: 4 bytes a component where all fit, else 8, so that equal
    vectors are equal bytes."""
    narrow = (np.abs(x) < 1 << 31).all(1) if x.size else np.zeros(len(x), bool)
    small = x.astype("<i4")
    return pa.array([(small[i] if ok else x[i]).tobytes() for i, ok in enumerate(narrow)], pa.binary())


def from_bytes(rows: list[bytes], length: int) -> np.ndarray:
    raw = b"".join(rows)
    if len(raw) == 4 * length * len(rows):
        return np.frombuffer(raw, "<i4").reshape(-1, length).astype(np.int64)
    return np.stack([np.frombuffer(r, "<i4" if len(r) == 4 * length else "<i8").astype(np.int64) for r in rows])


def points(table: DataFrame, vector: str, length: int, scale: int, **carry: str) -> DataFrame:
    """The usable vectors as integers (column x), with the columns ``carry`` (new name =
    old name) as they are."""
    chosen = table.select(*[own(c).alias(name) for name, c in carry.items()], own(vector).cast("array<double>").alias("v"))
    names = list(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = integers(batch.column("v"), length, scale)
            kept = pa.array(at)
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(kept) for c in names], to_bytes(x)], [*names, "x"])

    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema.fields}
    return chosen.mapInArrow(run, ", ".join([*[f"{c} {kinds[c]}" for c in names], "x binary"]))


def exact(values: list[int]) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], EXACT)
