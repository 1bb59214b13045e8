"""Checks around a move: count gate, content fingerprint, archive collisions,
orphans left behind, schema agreement."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .joins import DEFAULT_MAX_BROADCAST_BYTES, Keys, flag, quoted, semi


#: Partition columns of the archive's folders; no table may have a column of these names.
RUN, PART = "__rs_run", "__rs_part"
PRIVATE = (RUN, PART)


class ArchivalError(RuntimeError):
    """Base class of the run's own failures (carries a SQLSTATE like MySQL)."""

    sqlstate = "45000"

    def getCondition(self) -> str:  # same shape as PySparkException
        return type(self).__name__

    def getSqlState(self) -> str:
        return self.sqlstate


class CountMismatch(ArchivalError):
    def __init__(self, table: str, copied: int, deleted: int, detail: str = ""):
        self.table, self.copied, self.deleted = table, copied, deleted
        extra = f"; {detail}" if detail else ""
        super().__init__(f"Count mismatch: copied {copied}, deleted {deleted}{extra}")


class KeyViolation(ArchivalError):
    def __init__(self, keyset: str, sample: list):
        self.keyset = keyset
        super().__init__(f"key set {keyset!r} is not unique/non-null, e.g. {sample}")


class ArchiveCollision(ArchivalError):
    def __init__(self, table: str, sample: list):
        super().__init__(f"archive of {table!r} already holds keys {sample}")


class SchemaMismatch(ArchivalError):
    def __init__(self, table: str, main: StructType, archive: StructType):
        super().__init__(f"schema of {table!r} differs from its archive: "
                         f"main {main.simpleString()} vs archive {archive.simpleString()}")


class FingerprintMismatch(ArchivalError):
    def __init__(self, table: str, source, split):
        super().__init__(f"content fingerprint of {table!r} changed: source {source} vs "
                         f"archived+retained {split}")


@dataclass(frozen=True)
class MoveCounts:
    """Counts of one move, each from its own source so they check each other.

    * ``rows_before``: rows of the files that hold archived rows (counted by itself);
    * ``rows_in_main``: rows of the source matching the key set, observed during
      the single split pass;
    * ``rows_copied``: rows read back from the written archived part;
    * ``rows_deleted``: ``rows_before`` minus rows read back from the retained part.
    """

    table: str
    rows_before: int | None  # None: not measured (empty key set, nothing read)
    rows_in_main: int
    rows_copied: int
    rows_deleted: int
    notes: tuple[str, ...] = ()  # what the move wrote, for the log's note

    @property
    def ok(self) -> bool:
        return self.rows_copied == self.rows_deleted == self.rows_in_main


def check_counts(c: MoveCounts) -> None:
    """The reference's gate ``IF copied <> deleted THEN SIGNAL 'Count mismatch'``,
    extended by ``rows_in_main`` (measured, not copied over)."""
    if c.rows_copied != c.rows_deleted:
        raise CountMismatch(c.table, c.rows_copied, c.rows_deleted)
    if c.rows_in_main != c.rows_copied:
        raise CountMismatch(c.table, c.rows_copied, c.rows_deleted,
                            f"rows matching the key set {c.rows_in_main}")


def check_schema(table: str, main: StructType, archive: StructType | None) -> None:
    """Archive and main must agree on names, types and order (a positional
    ``INSERT ... SELECT t.*`` would swap same-typed columns silently). A table with
    a column of the archive's own private names is refused."""
    if any(f.name in PRIVATE for f in main.fields):
        raise SchemaMismatch(table, main, StructType())
    if archive is None:
        return
    strip = [(f.name, f.dataType) for f in archive.fields if f.name not in PRIVATE]
    if [(f.name, f.dataType) for f in main.fields] != strip:
        raise SchemaMismatch(table, main, archive)


#: Up to so many new keys are looked up by value.
LISTED = 1000


def collisions(archived: DataFrame, pk: str, existing: DataFrame | None,
               archived_size: int | None = None,
               max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame | None:
    """Keys about to be archived that the archive already holds. Few new keys are a
    literal list, which Parquet checks against the Bloom filters and ranges that every
    run writes with its key column: row groups of past runs that cannot hold one are not
    read. Many are a semi join of the row groups within their range."""
    if existing is None:
        return None
    new, old = archived.select(quoted(pk).alias("id")), existing.select(quoted(pk).alias("id"))
    some = [r["id"] for r in new.where("id is not null").limit(LISTED + 1).collect()]
    if len(some) <= LISTED:
        return old.where(F.col("id").isin(some))
    low, high = new.agg(F.min("id"), F.max("id")).first()
    return semi(old.where(F.col("id").between(low, high)), "id", Keys("new", new, size=archived_size), max_bytes)


def _content(df: DataFrame) -> Column:
    """A row's integer and string columns as 32 bits of their MD5 (the same in any engine)."""
    exact = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("int", "bigint", "string")]
    text = F.concat_ws("|", *[F.coalesce(quoted(n).cast("string"), F.lit("~")) for n in exact])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _bucket(key: str, buckets: int) -> Column:
    text = F.coalesce(quoted(key).cast("string"), F.lit("~"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("bigint"), F.lit(buckets))


def bucket_fingerprints(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Order-free content sums per bucket of ``key`` values: ``(bucket, rows, content)``.
    Their totals are the table's fingerprint, so two tables are compared top down: totals,
    then buckets, then the rows of the buckets that differ (``locate_changes``). Partial
    sums; a hot key is one row per task."""
    return (df.select(_bucket(key, buckets).alias("bucket"), _content(df).alias("c")).groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("c").alias("content")))


def locate_changes(before: DataFrame, after: DataFrame, key: str, buckets: int = 256) -> DataFrame | None:
    """Rows that only one of two tables holds (column ``side``: ``before`` or ``after``, with
    how many more, ``n``); None if all buckets agree. Only rows of buckets that differ are
    compared; at most ``buckets`` sums reach the driver."""
    a, b = (bucket_fingerprints(t, key, buckets) for t in (before, after))
    differ = [r["bucket"] for r in a.join(b.withColumnsRenamed({"rows": "rows2", "content": "content2"}), "bucket", "full").where(
        "not (rows <=> rows2 and content <=> content2)").select("bucket").collect()]
    if not differ:
        return None
    mine, theirs = (t.where(_bucket(key, buckets).isin(differ)) for t in (before, after))
    names = [quoted(c) for c in before.columns]
    counted = mine.withColumn("__rs_n", F.lit(1)).unionByName(theirs.withColumn("__rs_n", F.lit(-1))).groupBy(*names).agg(F.sum("__rs_n").alias("__rs_n"))
    return counted.where("__rs_n <> 0").select(*names, F.when(F.col("__rs_n") > 0, "before").otherwise("after").alias("side"), F.abs("__rs_n").alias("n"))


def orphans(child: DataFrame, edges: list[tuple[str, Keys]],
            max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Retained child rows whose parent was archived, for all edges of a child table in
    one scan (FK checks were off in the reference; here the outcome is audited):
    ``(child_col, orphan_rows)``. ``edges``: (child column, archived parent keys). Only
    row groups of the child within the range of some edge's keys are read, if known."""
    within = [quoted(c).between(k.low, k.high) for c, k in edges if k.low is not None]
    if len(within) == len(edges):
        child = child.where(reduce(Column.__or__, within))
    flags = child.select(*[quoted(c).alias(f"v{i}") for i, (c, _) in enumerate(edges)])
    for i, (_, keys) in enumerate(edges):
        flags = flag(flags, f"v{i}", keys, max_bytes, name=f"f{i}")
    counts = flags.agg(*[F.count_if(F.col(f"f{i}")).alias(f"n{i}") for i in range(len(edges))])
    rows = F.array(*[F.struct(F.lit(c).alias("child_col"), F.col(f"n{i}").alias("orphan_rows")) for i, (c, _) in enumerate(edges)])
    return counts.select(F.inline(rows))
