"""Foreign-key graph: edges as a DataFrame and reachability from a root table.

The reference lists base tables and FK edges from the catalogue, meant to
derive its step list; here the manifest holds the edges (a catalogue read via
JDBC can feed the same DataFrame), and reachability tells which tables hang
under a root and how deep, to check that a manifest covers all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .manifest import Edge

EDGE_DDL = "child_table string, child_col string, parent_table string, parent_col string"


def edges_frame(spark: SparkSession, edges: list[Edge]) -> DataFrame:
    """The manifest's edges (catalogue metadata, a few rows per table)."""
    return spark.createDataFrame(
        [(e.child_table, e.child_col, e.parent_table, e.parent_col) for e in edges], EDGE_DDL)


def fk_reach(spark: SparkSession, edges: DataFrame, root: str) -> DataFrame:
    """Tables reachable from ``root`` by walking FK edges from parent to child:
    ``(table_name, depth, in_cycle)``. ``depth`` is the longest chain from the root, on
    which the tables of a common cycle stand once each, one after the other; ``in_cycle``
    tells tables on a cycle (one that references itself is), where chains never end.

    Edges are catalogue metadata, a few rows per table, walked level by level: a level
    holds each table once, with what it could not have met before."""
    pairs = sorted({(r["parent_table"], r["child_table"]) for r in edges.select("parent_table", "child_table").collect()})
    below: dict[str, list[str]] = {}
    for parent, child in pairs:
        below.setdefault(parent, []).append(child)

    def reached(start: str) -> set[str]:
        seen, todo = set(), [start]
        while todo:
            for child in below.get(todo.pop(), []):
                if child not in seen:
                    seen.add(child)
                    todo.append(child)
        return seen

    under = reached(root) | {root}
    beyond = {t: reached(t) for t in under}
    group = {t: min({u for u in beyond[t] if t in beyond[u]} | {t}) for t in under}  # tables on common cycles
    size = {g: sum(1 for t in under if group[t] == g) for g in group.values()}
    depth = {group[root]: size[group[root]] - 1}
    # groups in an order in which each comes after all that reach it
    for g in sorted(set(group.values()), key=lambda g: -len(beyond[g] | {g})):
        for parent, child in pairs:
            if parent in under and group[parent] == g and group[child] != g and g in depth:
                depth[group[child]] = max(depth.get(group[child], 0), depth[g] + size[group[child]])
    rows = [(t, 0 if t == root else depth[group[t]], t in beyond[t]) for t in sorted(under)]
    return spark.createDataFrame(rows, "table_name string, depth int, in_cycle boolean")


def coverage(spark: SparkSession, edges: DataFrame, root: str, moved: list[str]) -> DataFrame:
    """Tables under ``root`` with their depth and whether the manifest moves
    them: ``(table_name, depth, moved)``. A row with ``moved = false`` is a
    table a run would leave behind with dangling keys."""
    listed = spark.createDataFrame([(t,) for t in moved], "table_name string")
    flagged = listed.select("table_name", F.lit(True).alias("moved"))
    return (fk_reach(spark, edges, root)
            .join(F.broadcast(flagged), "table_name", "left")
            .select("table_name", "depth", F.coalesce(F.col("moved"), F.lit(False)).alias("moved")))
