"""Shared helpers: scratch tables, word hashing over Arrow text, packed integer
blobs, and connected components written as DataFrame rounds."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootsweep.session import shared_folder

#: Bytes of text that one vectorised step works on.
STEP_BYTES = 1 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver found it, as
    ``--py-files`` would; once per Spark context."""
    sc = spark.sparkContext
    if not getattr(sc, "_rootsweep_shipped", False):
        root = Path(__file__).resolve().parents[1]
        out = Path(tempfile.mkdtemp(prefix="rootsweep-")) / "rootsweep.zip"
        with zipfile.ZipFile(out, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(out))
        sc._rootsweep_shipped = True


# ---- scratch tables -----------------------------------------------------------
def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``."""
    return shared_folder(spark, f"llm/{name}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a scratch folder and read it back: cuts lineage,
    and a lost executor costs no recomputation of what came before."""
    spark, schema, path = df.sparkSession, df.schema, scratch(df.sparkSession, name)
    df.write.parquet(path)
    del df
    # Shuffle files of finished steps go when the driver collects its garbage, by
    # default every 30 minutes: ask for it, or they pile up on the executors' disks.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns never clash with ours."""
    return df.select(*[F.col(f"`{n}`") for n in names])


# ---- words as 64-bit hashes ----------------------------------------------------
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INV = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Separators: space and \t to \r; or every ASCII byte that is no digit or letter.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
NO_WORD = np.zeros(256, bool)
NO_WORD[:128] = [not chr(i).isalnum() for i in range(128)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, STEP_BYTES + 1024)
        for k, base in enumerate((_BASE, _INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (an invertible finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(data: np.ndarray, bounds: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the texts ``data[bounds[i]:bounds[i+1]]`` (UTF-8 bytes): their 64-bit
    hashes in order, with A-Z as a-z, and the n+1 word offsets of the texts."""
    size = len(data)
    inside = np.empty(size + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~sep[data]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < size)]
    first[edges] = inside[edges + 1]  # a text's end also ends a word
    last[edges - 1] = inside[edges]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(size + 1)
    total = np.zeros(size + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:size], out=total[1:])
    h = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
    return h, np.searchsorted(s, bounds)


def text_steps(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow string array into runs of rows of about STEP_BYTES: (first row,
    end row, bytes, bounds). Null texts are empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + STEP_BYTES, "right")) - 1)
        j = min(j, n)
        yield i, j, raw[at[i]:at[j]], at[i:j + 1] - at[i]
        i = j


def word_steps(texts: pa.Array, sep: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As text_steps, with (word hashes, word bounds) in place of the bytes. A text
    much longer than a step is hashed piece by piece, cut at separators."""
    for i, j, data, bounds in text_steps(texts):
        if len(data) <= 2 * STEP_BYTES:
            h, b = hash_words(data, bounds, sep)
        else:  # one very long text
            parts, p = [], 0
            while p < len(data):
                q = min(p + STEP_BYTES, len(data))
                while q < len(data) and not sep[data[q]]:
                    q += 1
                parts.append(hash_words(data[p:q], np.array([0, q - p]), sep)[0])
                p = q
            h = np.concatenate(parts)
            b = np.array([0, len(h)])
        yield i, j, h, b


def ngram_hashes(h: np.ndarray, gaps: tuple[int, ...]) -> np.ndarray:
    """Hash of the words at offsets 0 and ``gaps`` from each position."""
    n = len(h) - gaps[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for k in gaps:
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + h[k:k + n])
    return out


# ---- packed integers ------------------------------------------------------------
def pack(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed; ascending ones should come as differences."""
    v = np.ascontiguousarray(values, dtype="<u8")
    return zstandard.ZstdCompressor(level=1).compress(v.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


# ---- connected components ---------------------------------------------------------
def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every node with a link: (node, component).

    ``edges`` has two columns (a, b) of one orderable type, in any direction, with
    repeats, self links and nulls allowed (the latter two are ignored). Alternates
    large-star and small-star rounds: each is a minimum per node (partial
    aggregates, so a hot node is one row per task) and an equality join, and each
    round is written out. Only counts and a checksum reach the driver.
    """
    e = edges.toDF("a", "b").where("a is not null and b is not null and a <> b")
    e = stored(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    seen = None
    while True:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        star = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = star.groupBy("a").agg(F.min("b").alias("m"))
        small = star.join(low, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        e = stored(small.where("a <> b").distinct(), "cc")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(now) == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = tuple(now)
