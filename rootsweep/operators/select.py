"""Root selection by a csv list of names (``FIND_IN_SET``) and unmatched names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import csv_items
from ..plans.manifest import KeySet


def _root_columns(ks: KeySet):
    return [F.col(ks.key).alias("id"), F.col(ks.name_col).alias("name"),
            *[F.col(c).alias(a) for c, a in ks.carry]]


def _names_frame(spark: SparkSession, csv: str | None) -> DataFrame:
    """The csv items as a one-column DataFrame (``position``, ``name``),
    built on the executors from the literal (no driver-side row list)."""
    if not csv_items(csv):
        return spark.range(0).select(F.lit(0).alias("position"), F.lit("").alias("name"))
    return (spark.range(1)
            .select(F.posexplode(F.split(F.lit(csv), ",", -1)).alias("p", "name"))
            .select((F.col("p") + 1).alias("position"), "name"))


def select_roots(df: DataFrame, ks: KeySet, csv: str | None, collation: str | None = None) -> DataFrame:
    """Rows of the root table named in ``csv``: ``(id, name, <carried>)``.

    A broadcast semi join on the split list (driver-side text, so its size is
    known); an item list that is empty or NULL selects nothing."""
    names = _names_frame(df.sparkSession, csv).select(F.col("name").alias("__rs_name")).distinct()
    left, right = F.col(ks.name_col), F.col("__rs_name")
    if collation:
        left, right = F.collate(left, collation), F.collate(right, collation)
    return df.join(F.broadcast(names), left == right, "left_semi").select(*_root_columns(ks))


def unmatched_names(df: DataFrame, name_col: str, csv: str | None,
                    collation: str | None = None) -> DataFrame:
    """csv items that name no row: ``(position, name)``. Shows the effect of
    untrimmed spaces and letter case (``'A, B'`` leaves ``' B'`` unmatched)."""
    names = _names_frame(df.sparkSession, csv)

    def eq(a: str, b: str):
        x, y = F.col(a), F.col(b)
        if collation:
            x, y = F.collate(x, collation), F.collate(y, collation)
        return x == y

    # The list is tiny and its size known: filter the (possibly large) root
    # table by a broadcast of it, then anti join the list against the hits
    # (under a collation every spelling is a hit, so these are not broadcast).
    listed = F.broadcast(names.select(F.col("name").alias("__rs_item")).distinct())
    hits = (df.select(F.col(name_col).alias("__rs_name"))
            .join(listed, eq("__rs_name", "__rs_item"), "left_semi").distinct())
    return names.join(hits, eq("name", "__rs_name"), "left_anti")
