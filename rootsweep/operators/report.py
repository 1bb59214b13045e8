"""Reports: shared parents, dry-run counts (per table and per root)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.manifest import KeySet, Manifest
from .closure import TableReader, parent_refs, ref_column
from .joins import DEFAULT_MAX_BROADCAST_BYTES, Keys, anti, semi


def shared_parents(manifest: Manifest, ks: KeySet, tables: TableReader, parent: Keys,
                   max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Parents in an up key set that a live (unselected) child still names:
    ``(id, live_children)``. Archiving them leaves those children orphaned."""
    if ks.kind != "up":
        raise ValueError(f"{ks.name!r} is not an upward key set")
    par = manifest.keyset(ks.parent)
    chosen = parent_refs(manifest, ks, tables, parent, max_bytes)
    # Count live children per ref: aggregate first (partial agg absorbs hot refs),
    # then keep the chosen ones.
    live = (anti(tables(par.table), par.key, parent, max_bytes)
            .select(F.col(ref_column(manifest, ks)).alias("id"))
            .filter(F.col("id").isNotNull())
            .groupBy("id").agg(F.count(F.lit(1)).alias("live_children")))
    return live.join(chosen, F.col("id") == F.col("__rs_ref"), "left_semi")


def dry_run_counts(manifest: Manifest, tables: TableReader, keys: dict[str, Keys],
                   max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows each move would archive, in manifest order:
    ``(step, table_name, rows_to_move)``. Nothing is written."""
    parts = []
    for i, mv in enumerate(manifest.moves, start=1):
        hit = semi(tables(mv.table), mv.column, keys[mv.keyset], max_bytes)
        parts.append(hit.agg(F.count(F.lit(1)).alias("rows_to_move"))
                     .select(F.lit(i).alias("step"), F.lit(mv.table).alias("table_name"),
                             "rows_to_move"))
    return reduce(DataFrame.unionByName, parts)


def keys_by_root(manifest: Manifest, tables: TableReader, keys: dict[str, Keys],
                 keyset: str) -> DataFrame:
    """``(id, root_id)``: the roots that each key hangs from, one row for each. Down a
    foreign key a child has its parent's roots; up, a parent has those of all children
    that name it (distinct pairs, combined before the shuffle), so a shared parent counts
    for each. A hot root is just a value, not a partition."""
    ks = manifest.keyset(keyset)
    if ks.kind == "root":
        return keys[keyset].df.select("id", F.col("id").alias("root_id"))
    up = keys_by_root(manifest, tables, keys, ks.parent).select(
        F.col("id").alias("__rs_pid"), "root_id")
    if ks.kind == "up":
        par = manifest.keyset(ks.parent)
        named = tables(par.table).select(F.col(par.key).alias("__rs_id"), F.col(ref_column(manifest, ks)).alias("id"))
        pairs = named.join(up, F.col("__rs_id") == F.col("__rs_pid")).where("id is not null").select("id", "root_id").distinct()
        return pairs.join(tables(ks.table).select(F.col(ks.key).alias("__rs_key")), F.col("id") == F.col("__rs_key"), "left_semi")
    child = tables(ks.table).select(F.col(ks.key).alias("id"), F.col(ks.fk).alias("__rs_fk"))
    return child.join(up, F.col("__rs_fk") == F.col("__rs_pid"), "inner").select("id", "root_id")


def dry_run_by_roots(manifest: Manifest, tables: TableReader, keys: dict[str, Keys]) -> DataFrame:
    """Rows of every moved table that a run would archive, per root, in manifest order:
    ``(step, table_name, root_id, root_name, rows_to_move)``. Rows of a shared parent
    count for each of its roots. A table is counted per key value before the join."""
    roots = keys[manifest.root.name].df.select(F.col("id").alias("root_id"), F.col("name").alias("root_name"))
    parts = []
    for i, mv in enumerate(manifest.moves, start=1):
        by_root = keys_by_root(manifest, tables, keys, mv.keyset).select(F.col("id").alias("__rs_kid"), "root_id")
        if (ks := manifest.keyset(mv.keyset)).table == mv.table and ks.key == mv.column:
            hits = by_root.select("root_id", F.lit(1).alias("n"))  # the key set is the table's own: its pairs are the rows
        else:
            per = tables(mv.table).select(F.col(mv.column).alias("__rs_col")).where("__rs_col is not null").groupBy("__rs_col").agg(F.count(F.lit(1)).alias("n"))
            hits = per.join(by_root, F.col("__rs_col") == F.col("__rs_kid")).select("root_id", "n")
        parts.append(hits.groupBy("root_id").agg(F.sum("n").alias("rows_to_move"))
                     .select(F.lit(i).alias("step"), F.lit(mv.table).alias("table_name"), "root_id", "rows_to_move"))
    return (reduce(DataFrame.unionByName, parts).join(roots, "root_id")
            .select("step", "table_name", "root_id", "root_name", "rows_to_move"))


def dry_run_by_root(manifest: Manifest, tables: TableReader, keys: dict[str, Keys],
                    table: str) -> DataFrame:
    """Rows of ``table`` a run would archive, per root:
    ``(root_id, root_name, table_name, rows_to_move)``."""
    mv = manifest.move(table)
    by_root = keys_by_root(manifest, tables, keys, mv.keyset).select(
        F.col("id").alias("__rs_kid"), "root_id")
    counts = (tables(table).select(F.col(mv.column).alias("__rs_col"))
              .join(by_root, F.col("__rs_col") == F.col("__rs_kid"), "inner")
              .groupBy("root_id").agg(F.count(F.lit(1)).alias("rows_to_move")))
    roots = keys[manifest.root.name].df.select(F.col("id").alias("root_id"),
                                               F.col("name").alias("root_name"))
    return (counts.join(roots, "root_id", "inner")
            .select("root_id", "root_name", F.lit(table).alias("table_name"), "rows_to_move"))
