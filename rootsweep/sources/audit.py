"""Audit trail: ``archival_run`` (one header per run) and ``archival_log`` (one
line per moved table), stored as append-only Parquet under ``<root>/audit``.

* A run's state changes are appended rows; the final state per ``run_id`` wins
  (RUNNING < SUCCESS < FAILED).
* Log lines of a run are written in one batch, before the run's SUCCESS row;
  the SUCCESS row is the act that publishes the run (see ``sources.tables``).
* Purging a run appends a tombstone; audit views hide the run and its lines
  (the reference's ``ON DELETE CASCADE``). Version resolution of data tables
  reads the raw records, so purging history never un-archives data.

Run ids are claimed: ``max + 1`` is taken by creating ``claims/<id>``, which the file
system lets only one opener do. One run at a time per output root.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from . import fs

# Audit table columns and the status values they allow.
RUN_SCHEMA = StructType([
    StructField("run_id", LongType(), False),
    StructField("project_list", StringType(), False),
    StructField("started_at", TimestampType(), False),
    StructField("ended_at", TimestampType(), True),
    StructField("status", StringType(), False),
    StructField("error_message", StringType(), True),
])

LOG_SCHEMA = StructType([
    StructField("id", LongType(), False),
    StructField("run_id", LongType(), False),
    StructField("project_id", LongType(), True),
    StructField("project_name", StringType(), True),
    StructField("table_name", StringType(), False),
    StructField("rows_in_main", LongType(), False),
    StructField("rows_copied", LongType(), False),
    StructField("rows_deleted", LongType(), False),
    StructField("status", StringType(), False),
    StructField("note", StringType(), True),
    StructField("created_at", TimestampType(), False),
    StructField("updated_at", TimestampType(), True),
])

PURGE_SCHEMA = StructType([
    StructField("run_id", LongType(), False),
    StructField("purged_at", TimestampType(), False),
])

RUN_STATUSES = ("RUNNING", "SUCCESS", "FAILED")
LOG_STATUSES = ("PENDING", "COPIED", "VALIDATED", "DELETED", "FAILED", "SUCCESS")


class ConcurrentRun(RuntimeError):
    """Another run on the same output root has not finished."""


class RunAbandoned(RuntimeError):
    """This run was declared FAILED meanwhile; nothing of it is published."""


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Audit:
    def __init__(self, spark: SparkSession, output_root: str):
        self.spark = spark
        self.root = fs.join(output_root, "audit")
        self.run_path = fs.join(self.root, "archival_run")
        self.log_path = fs.join(self.root, "archival_log")
        self.project_log_path = fs.join(self.root, "archival_log_by_project")
        self.purge_path = fs.join(self.root, "purged_runs")
        self.claims_path = fs.join(self.root, "claims")

    # ---- A5: create if absent ---------------------------------------------
    def ensure(self) -> None:
        """Create each audit table if absent (``mode("ignore")`` leaves one untouched that
        another writer creates meanwhile)."""
        def create(path: str, schema: StructType) -> None:
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(path)

        with ThreadPoolExecutor(3, thread_name_prefix="rootsweep-audit") as pool:
            for f in [pool.submit(create, p, sc) for p, sc in (
                    (self.run_path, RUN_SCHEMA), (self.log_path, LOG_SCHEMA),
                    (self.purge_path, PURGE_SCHEMA)) if not fs.present(self.spark, p)]:
                f.result()

    def _read(self, path: str, schema: StructType) -> DataFrame:
        df = fs.try_parquet(self.spark, path, schema)
        return df if df is not None else self.spark.createDataFrame([], schema)

    # ---- raw records (used for version resolution) -------------------------
    def runs_raw(self) -> DataFrame:
        """Latest state per run, purged runs included."""
        states = self._read(self.run_path, RUN_SCHEMA)
        # RUNNING < SUCCESS < FAILED: a run another writer already declared
        # abandoned stays unpublished even if it later writes SUCCESS
        rank = (F.when(F.col("status") == "RUNNING", 0)
                .when(F.col("status") == "SUCCESS", 1).otherwise(2))
        latest = states.groupBy("run_id").agg(
            F.max_by(F.struct(*[F.col(c) for c in RUN_SCHEMA.names]), rank).alias("s"))
        return latest.select("s.*")

    def log_raw(self) -> DataFrame:
        return self._read(self.log_path, LOG_SCHEMA)

    def purged(self) -> DataFrame:
        return self._read(self.purge_path, PURGE_SCHEMA)

    # ---- audit views --------------------------------------------------------
    def runs(self) -> DataFrame:
        return self.runs_raw().join(self.purged(), "run_id", "left_anti")

    def log(self) -> DataFrame:
        """Log lines of published (SUCCESS, not purged) runs."""
        ok = self.runs().filter(F.col("status") == "SUCCESS").select("run_id")
        return self.log_raw().join(ok, "run_id", "left_semi")

    def trail(self) -> DataFrame:
        """Runs with the log lines of those that published, one row per line (or per run
        without lines); purged runs and their lines are left out, in one query."""
        state = self.runs()
        shown = F.when(F.col("status") == "SUCCESS", F.col("run_id"))
        lines = self.log_raw().select(F.col("run_id").alias("of"), "id", "table_name", "rows_in_main", "rows_copied", "rows_deleted", "note")
        return state.join(lines, shown == F.col("of"), "left").drop("of")

    # ---- A6/A7/A8/A9: run lifecycle -----------------------------------------
    def _next(self, path: str, schema: StructType, col: str) -> int:
        top = self._read(path, schema).agg(F.max(col).alias("m")).first()["m"]
        return int(top or 0) + 1

    def _append(self, rows: list[tuple], schema: StructType, path: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    def open_run(self, project_list: str | None) -> tuple[int, datetime]:
        """Claim ``max + 1`` and append the RUNNING row.

        One writer per output root: a run still RUNNING blocks the new one
        (``ConcurrentRun``), however long ago it began, and so does an id that another
        opener has claimed but not yet recorded. Whether its driver is lost only an
        operator can tell: ``abandon(run_id)`` says so."""
        info = self.runs_raw().agg(
            F.max("run_id").alias("top"),
            F.collect_list(F.when(F.col("status") == "RUNNING",
                                  F.struct("run_id", "project_list", "started_at"))).alias("open"),
        ).first()
        now = _now()
        for r in info["open"] or []:
            raise ConcurrentRun(f"run {r['run_id']} started at {r['started_at']} is still RUNNING; one "
                                "writer per output root (if its driver is gone, abandon it by its id)")
        run_id = int(info["top"] or 0) + 1
        if not fs.claim(self.spark, fs.join(self.claims_path, str(run_id)), now.isoformat()):
            raise ConcurrentRun(f"run {run_id} is being opened by another writer (if its driver is gone, abandon it by its id)")
        self._append([(run_id, project_list if project_list is not None else "", now, None,
                       "RUNNING", None)], RUN_SCHEMA, self.run_path)
        return run_id, now

    def state(self, run_id: int) -> str | None:
        """The run's state as readers see it (FAILED outranks SUCCESS)."""
        row = self.runs_raw().where(F.col("run_id") == run_id).select("status").first()
        return row["status"] if row else None

    def abandon(self, run_id: int) -> None:
        """Declare a RUNNING run FAILED (its driver is lost). Its files were never
        published, so nothing needs undoing; should it still be alive, it finds
        this row before or after its own SUCCESS and raises ``RunAbandoned``."""
        row = self.runs_raw().where(F.col("run_id") == run_id).first()
        if row is None and fs.present(self.spark, fs.join(self.claims_path, str(run_id))):
            row = {"status": "RUNNING", "project_list": None, "started_at": _now()}  # claimed, never recorded
        if row is None or row["status"] != "RUNNING":
            raise ValueError(f"run {run_id} is {row['status'] if row else 'unknown'}, not RUNNING")
        self.close_run(run_id, row["project_list"], row["started_at"], "FAILED",
                       "abandoned: the run ended without a final state")

    def close_run(self, run_id: int, project_list: str | None, started: datetime,
                  status: str, error_message: str | None = None) -> None:
        if status not in RUN_STATUSES[1:]:
            raise ValueError(f"final run status must be SUCCESS or FAILED, not {status!r}")
        self._append([(run_id, project_list if project_list is not None else "", started,
                       _now(), status, error_message)], RUN_SCHEMA, self.run_path)

    # ---- A10: log lines, one write per run -----------------------------------
    def next_log_id(self) -> int:
        return self._next(self.log_path, LOG_SCHEMA, "id")

    def write_log(self, run_id: int, lines: list[dict], first_id: int | None = None) -> None:
        """All table lines of a run in one write (one per moved table); ids from
        ``first_id`` (read earlier by the single writer) or ``max + 1``."""
        if not lines:
            return
        first = first_id if first_id is not None else self.next_log_id()
        now = _now()
        rows = []
        for i, ln in enumerate(lines):
            status = ln.get("status", "SUCCESS")
            if status not in LOG_STATUSES:
                raise ValueError(f"log status {status!r} not in {LOG_STATUSES}")
            rows.append((first + i, run_id, ln.get("project_id"), ln.get("project_name"),
                         ln["table_name"], int(ln["rows_in_main"]), int(ln["rows_copied"]),
                         int(ln["rows_deleted"]), status, ln.get("note"), now, None))
        self._append(rows, LOG_SCHEMA, self.log_path)

    def write_project_log(self, run_id: int, lines: DataFrame, first_id: int) -> None:
        """Lines per table and root, written by the executors to a table of their own:
        ``lines`` has table_name, root_id, root_name, rows. There may be as many as
        roots, so none passes the driver; ids only need to be unique."""
        now = F.lit(_now()).cast("timestamp")
        (lines.select(
            (F.lit(first_id) + F.monotonically_increasing_id()).alias("id"), F.lit(run_id).cast("bigint").alias("run_id"),
            F.col("root_id").cast("string").alias("project_id"), F.col("root_name").cast("string").alias("project_name"),
            "table_name", F.col("rows").alias("rows_in_main"), F.col("rows").alias("rows_copied"),
            F.col("rows").alias("rows_deleted"), F.lit("SUCCESS").alias("status"), F.lit("by project").alias("note"),
            now.alias("created_at")).write.mode("append").parquet(self.project_log_path))

    def project_log(self) -> DataFrame | None:
        """Per-project lines of published runs; None if none was ever written."""
        df = fs.try_parquet(self.spark, self.project_log_path)
        ok = self.runs().filter(F.col("status") == "SUCCESS").select("run_id")
        return None if df is None else df.join(ok, "run_id", "left_semi")

    # ---- A11: delete a run with its log lines --------------------------------
    def purge(self, run_ids: list[int]) -> None:
        now = _now()
        self._append([(int(r), now) for r in run_ids], PURGE_SCHEMA, self.purge_path)
