"""Key-set closure over foreign keys (down to children, up to parents) and the
key assertion that replaces the reference's ``ADD PRIMARY KEY``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.manifest import KeySet, Manifest
from .joins import DEFAULT_MAX_BROADCAST_BYTES, Keys, anti, semi
from .select import select_roots

TableReader = Callable[[str], DataFrame]


def ref_column(manifest: Manifest, ks: KeySet) -> str:
    """Column of the parent's *table* that names the up key set's key."""
    par = manifest.keyset(ks.parent)
    for col, alias in par.carry:
        if alias == ks.ref:
            return col
    return ks.ref


def parent_refs(manifest: Manifest, ks: KeySet, tables: TableReader, parent: Keys,
                max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Distinct non-null values that the selected parents hold in the ref column.
    Distinct first: map-side partial aggregation collapses a hot value before the
    shuffle, so a client shared by a third of all rows costs one row per task."""
    if ks.ref in parent.df.columns:
        refs = parent.df.select(F.col(ks.ref).alias("__rs_ref"))
    else:
        par = manifest.keyset(ks.parent)
        refs = semi(tables(par.table), par.key, parent, max_bytes).select(
            F.col(ref_column(manifest, ks)).alias("__rs_ref"))
    return refs.filter(F.col("__rs_ref").isNotNull()).distinct()


def live_refs(manifest: Manifest, ks: KeySet, tables: TableReader, parent: Keys,
              max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Distinct ref values held by parents that are *not* selected (still live)."""
    par = manifest.keyset(ks.parent)
    return (anti(tables(par.table), par.key, parent, max_bytes)
            .select(F.col(ref_column(manifest, ks)).alias("__rs_ref"))
            .filter(F.col("__rs_ref").isNotNull()).distinct())


def derive(manifest: Manifest, ks: KeySet, tables: TableReader, known: dict[str, Keys],
           csv: str | None, collation: str | None = None, up_mode: str = "any",
           max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, carry_root: bool = False) -> DataFrame:
    """Plan of one key set from its parent (not materialised).

    * root: ``SELECT id, name, <carried> FROM root WHERE FIND_IN_SET(name, csv)``
    * down: ``SELECT c.key FROM child c WHERE c.fk IN parent``  (left semi)
    * up:   ``SELECT DISTINCT p.key FROM parent_table p WHERE p.key IN refs``;
      with ``up_mode="exclusive"`` parents still named by a live child stay.
    """
    if ks.kind == "root":
        roots = select_roots(tables(ks.table), ks, csv, collation)
        return roots.withColumn("root_id", F.col("id")) if carry_root else roots
    parent = known[ks.parent]
    if ks.kind == "down":
        if carry_root and "root_id" in parent.df.columns:
            # an inner join on the parent's ids (asserted unique) is the semi
            # join that also carries each key's root
            side = parent.df.select(F.col("id").alias("__rs_pid"), "root_id")
            side = F.broadcast(side) if parent.small(max_bytes) else side
            return (tables(ks.table).join(side, F.col(ks.fk) == F.col("__rs_pid"), "inner")
                    .select(F.col(ks.key).alias("id"), "root_id"))
        return semi(tables(ks.table), ks.fk, parent, max_bytes).select(F.col(ks.key).alias("id"))
    refs = parent_refs(manifest, ks, tables, parent, max_bytes)
    small = parent.small(max_bytes)  # refs are at most as many as the parents
    cands = tables(ks.table).join(F.broadcast(refs) if small else refs,
                                  F.col(ks.key) == F.col("__rs_ref"), "left_semi")
    if up_mode == "exclusive":
        cands = cands.join(live_refs(manifest, ks, tables, parent, max_bytes),
                           F.col(ks.key) == F.col("__rs_ref"), "left_anti")
    elif up_mode != "any":
        raise ValueError(f"up_mode must be 'any' or 'exclusive', not {up_mode!r}")
    return cands.select(F.col(ks.key).alias("id"))


def close_lazy(manifest: Manifest, tables: TableReader, csv: str | None,
               collation: str | None = None, up_mode: str = "any",
               max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> dict[str, Keys]:
    """All key sets as lazy plans (for queries and dry runs). Catalyst sees the
    whole chain and may fuse it; sizes are left to its estimates and AQE."""
    known: dict[str, Keys] = {}
    for ks in manifest.keysets:
        df = derive(manifest, ks, tables, known, csv, collation, up_mode, max_bytes)
        known[ks.name] = Keys(ks.name, df)
    return known


def key_violations(df: DataFrame, column: str = "id") -> DataFrame:
    """Ids that break a primary key: NULL, or present more than once.
    ``(id, n)``; empty when the key holds. Partial aggregation makes a hot id
    cost one row per map task before the shuffle."""
    return (df.groupBy(F.col(column).alias("id"))
            .agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") > 1) | F.col("id").isNull()))


def dedup_for_write(df: DataFrame) -> DataFrame:
    """Key set prepared for materialisation: one row per id with its
    multiplicity ``__rs_n`` (so the key assertion reads the written set instead
    of a second pass over the source). Carried columns keep one value."""
    extra = [c for c in df.columns if c != "id"]
    return df.groupBy("id").agg(F.count(F.lit(1)).alias("__rs_n"),
                                *[F.first(c).alias(c) for c in extra])
