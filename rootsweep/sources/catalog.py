"""Catalogue reads: datasets under a folder, FK edges from a database's
``information_schema`` over JDBC (optional), and the session probe.

The JDBC reads take credentials from environment variables named by the
caller; nothing secret is stored or logged. No JDBC driver ships with this
repository, so they are untested here."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fs

TABLES_SQL = ("SELECT table_name FROM information_schema.tables "
              "WHERE table_schema = DATABASE() AND table_type = 'BASE TABLE'")

# The child column is part of every edge (a graph without it cannot drive a join).
EDGES_SQL = ("SELECT table_name AS child_table, column_name AS child_col, "
             "referenced_table_name AS parent_table, referenced_column_name AS parent_col "
             "FROM information_schema.key_column_usage "
             "WHERE referenced_table_schema = DATABASE() AND referenced_table_name IS NOT NULL")


def list_tables(spark: SparkSession, root: str) -> DataFrame:
    """Datasets directly under ``root`` (``<t>.parquet`` files or ``<t>/``
    folders): ``(table_name, path)``. A metadata listing, no data read."""
    rows = []
    for name in fs.children(spark, root):
        if name.startswith(("_", ".")):
            continue
        table = name[: -len(".parquet")] if name.endswith(".parquet") else name
        rows.append((table, fs.join(root, name)))
    return spark.createDataFrame(rows, "table_name string, path string")


def _jdbc(spark: SparkSession, url: str, query: str, user_env: str, password_env: str) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    user, password = os.environ.get(user_env), os.environ.get(password_env)
    if user:
        reader = reader.option("user", user)
    if password:
        reader = reader.option("password", password)
    return reader.load()


def jdbc_tables(spark: SparkSession, url: str, user_env: str = "ROOTSWEEP_JDBC_USER",
                password_env: str = "ROOTSWEEP_JDBC_PASSWORD") -> DataFrame:
    """Base tables of the connection's current database."""
    return _jdbc(spark, url, TABLES_SQL, user_env, password_env)


def jdbc_fk_edges(spark: SparkSession, url: str, user_env: str = "ROOTSWEEP_JDBC_USER",
                  password_env: str = "ROOTSWEEP_JDBC_PASSWORD") -> DataFrame:
    """FK edges of the current database, in the shape of ``graph.edges_frame``."""
    return _jdbc(spark, url, EDGES_SQL, user_env, password_env).select(
        *[F.col(c).cast("string").alias(c) for c in ("child_table", "child_col", "parent_table",
                                                      "parent_col")])


def session_info(spark: SparkSession) -> DataFrame:
    """``(current_database, current_user)`` of the session."""
    return spark.sql("SELECT current_database() AS current_database, current_user() AS current_user")
