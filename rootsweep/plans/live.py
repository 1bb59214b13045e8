"""Queries over runs that really happen: each scenario runs the archiver over whole
tables into a fresh shared folder (once per session and input), and the queries read
back what was published and what the audit tables say.

* ``stacked``: a run for ``NATION_1``, then one for ``NATION_7``, content verified;
* ``failed``:  a run whose fifth step raises after four tables were split;
* ``purged``:  two runs over documents and labels, the first then purged.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import RUN, bucket_fingerprints
from ..session import shared_folder
from ..sources.tables import TableStore
from .manifest import DOCS, TPCH
from .run import Archiver, Hooks

RUNS = ("NATION_1", "NATION_7")
DOC_RUNS = ("src0", "src7")
FAILING, FAILURE = "customer", "injected"
BUCKETS = 16

_DONE: dict[tuple[str, str, str], str] = {}
_LOCK = threading.Lock()


def _stacked(spark: SparkSession, d: str, out: str) -> None:
    for csv in RUNS:
        Archiver(spark, TPCH, d, out, verify="content").run(csv)


def _failed(spark: SparkSession, d: str, out: str) -> None:
    def raise_at(table: str) -> None:
        if table == FAILING:
            raise RuntimeError(FAILURE)

    try:
        Archiver(spark, TPCH, d, out, parallelism=1, hooks=Hooks(before_move=raise_at)).run(RUNS[0])
    except RuntimeError as exc:
        if str(exc) != FAILURE:
            raise


def _purged(spark: SparkSession, d: str, out: str) -> None:
    for csv in DOC_RUNS:
        Archiver(spark, DOCS, d, out).run(csv)
    TableStore(spark, d, out).audit.purge([1])


def store(spark: SparkSession, d: str, scenario: Callable[[SparkSession, str, str], None]) -> TableStore:
    """The scenario's published tables; it runs when first asked for."""
    key = (spark.sparkContext.applicationId, d, scenario.__name__)
    with _LOCK:
        if key not in _DONE:
            out = shared_folder(spark, f"runs{scenario.__name__}")
            scenario(spark, d, out)
            _DONE[key] = out
    return TableStore(spark, d, _DONE[key])


# ---- what runs published -------------------------------------------------------
def _main(table: str):
    return lambda spark, d: store(spark, d, _stacked).main(table)


def _archive(table: str):
    def q(spark, d):
        s = store(spark, d, _stacked)
        found = s.archive(table)
        if found is None:  # nothing of it was ever archived
            found = s.read_input(table).limit(0).withColumn(RUN, F.lit(0))
        return found.withColumn("run_id", F.col(RUN).cast("bigint")).drop(RUN)
    return q


def run_fingerprint_buckets(spark, d):
    """Per moved table and bucket of its rows: rows and content sum of main and archive
    together, as published. A bucket that differs from the source's holds the change."""
    s = store(spark, d, _stacked)
    parts = []
    for mv in TPCH.moves:
        both = s.main(mv.table)
        if (gone := s.archive(mv.table)) is not None:
            both = both.unionByName(gone.drop(RUN))
        parts.append(bucket_fingerprints(both, mv.column, BUCKETS).select(F.lit(mv.table).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


# ---- what the audit tables say ---------------------------------------------------
def run_audit_runs(spark, d):
    """Per run its state, whether it has ended, and what its log lines add up to."""
    a = store(spark, d, _stacked).audit
    lines = a.log().groupBy("run_id").agg(F.count(F.lit(1)).alias("tables_moved"), F.sum("rows_copied").alias("rows_moved"))
    return a.runs().join(lines, "run_id", "left").select(
        "run_id", "project_list", "status", "error_message", (F.col("ended_at") >= F.col("started_at")).alias("ended"),
        F.coalesce("tables_moved", F.lit(0)).alias("tables_moved"), F.coalesce("rows_moved", F.lit(0)).alias("rows_moved"))


def run_audit_log(spark, d):
    return store(spark, d, _stacked).audit.log().select(
        "id", "run_id", "table_name", "status", "rows_in_main", "rows_copied", "rows_deleted")


def run_failed(spark, d):
    """Per moved table after a run that failed: the run's state and error, log lines,
    and the rows that main and archive hold."""
    s = store(spark, d, _failed)
    state = s.audit.runs().join(s.audit.log().groupBy("run_id").agg(F.count(F.lit(1)).alias("lines")), "run_id", "left").select(
        "status", "error_message", F.coalesce("lines", F.lit(0)).alias("log_lines"))
    published = s.published()
    counts = [s.main(mv.table).agg(F.count(F.lit(1)).alias("main_rows")).select(
        F.lit(mv.table).alias("table_name"), "main_rows", F.lit(len(published.get(mv.table, []))).alias("archived_parts")) for mv in TPCH.moves]
    return reduce(DataFrame.unionByName, counts).crossJoin(F.broadcast(state))  # one row of state


def run_failed_main_lineitem(spark, d):
    """A failed run had split lineitem already: main is the source all the same."""
    return store(spark, d, _failed).main("lineitem")


def run_purged(spark, d):
    """Runs with their log lines once run 1 is purged: neither is shown."""
    return store(spark, d, _purged).audit.trail().select("run_id", "project_list", "status", "table_name", "rows_in_main", "rows_copied", "rows_deleted")


def run_purged_archive_documents(spark, d):
    """Purging a run's history leaves what it archived where it is."""
    return store(spark, d, _purged).archive("documents").withColumn("run_id", F.col(RUN).cast("bigint")).drop(RUN)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    tables = [mv.table for mv in TPCH.moves]
    return {f"run_main_{t}": _main(t) for t in tables} | {f"run_archive_{t}": _archive(t) for t in tables} | {
        f.__name__: f for f in (run_fingerprint_buckets, run_audit_runs, run_audit_log, run_failed, run_failed_main_lineitem,
                                run_purged, run_purged_archive_documents)}
