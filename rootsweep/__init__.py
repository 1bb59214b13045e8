"""rootsweep: cascade archival of relational data on Spark.

Given root names, follow a declared foreign-key graph to the affected key sets,
split every dependent table into archived and retained rows with semi / anti
(or one flagged outer) joins, check counts and content, publish all tables of a
run together or none, and keep an audit trail.
"""

from .operators.joins import Keys, anti, flag, semi
from .plans.manifest import DOCS, MANIFESTS, REFERENCE, TPCH, Edge, KeySet, Manifest, Move
from .plans.run import Archiver, Hooks, RunResult, archive
from .sources.tables import TableStore

__all__ = [
    "DOCS", "MANIFESTS", "REFERENCE", "TPCH",
    "Archiver", "Edge", "Hooks", "KeySet", "Keys", "Manifest", "Move", "RunResult", "TableStore",
    "anti", "archive", "flag", "semi",
]
