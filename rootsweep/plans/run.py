"""One archival run: select roots, close over foreign keys, split every table
into archived / retained rows, validate, publish all or nothing, audit.

Stages (the reference's procedure, re-planned for Spark):

1. open run: a RUNNING row in ``archival_run``, and only then
2. pin one version of every table (one snapshot for closure and split);
3. key sets: each derived from its parent, written once to the run folder and
   read back (cuts lineage, gives exact sizes for broadcast decisions), then
   asserted unique and non-null;
4. moves: per table, find the files that hold rows of the key set (a pass over its
   FK column only, which also counts the rows), then open those files alone and split
   them in a single pass (a left join to the key set, ``partitionBy`` on the outcome),
   several in flight at once; other files stay as they are, tables whose key set is
   empty or without hits are skipped, and a table of one file is split right away;
5. counts from independent sources are compared (the count gate), optionally
   the content fingerprint, the archive-collision and schema guards; retained rows
   whose parent was archived are counted (the orphan audit);
6. publish: log lines, then the SUCCESS row, between two looks at the run's own
   state and at the versions it is based on. Any failure writes FAILED with the
   table in the message and re-raises; the run's files stay unreferenced.
"""

from __future__ import annotations

import dataclasses
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import error_text, fingerprint_aggs
from ..operators.closure import dedup_for_write, derive
from ..operators.joins import DEFAULT_MAX_BROADCAST_BYTES, Keys, anti, flag, heavy_values, quoted, semi
from ..operators.validate import (
    PART,
    ArchiveCollision,
    CountMismatch,
    FingerprintMismatch,
    KeyViolation,
    MoveCounts,
    check_counts,
    check_schema,
    collisions,
    orphans,
)
from ..sources import fs
from ..sources.catalog import session_info
from ..sources.audit import RunAbandoned
from ..sources.tables import FILE, NOTE_COMPACTED, NOTE_EMPTIED, TableStore, Version
from .manifest import Manifest, Move


# Shuffle sizing for joins that cannot broadcast: ~256 MB of Parquet input per
# initial partition (AQE coalesces small shuffles).
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass
class Hooks:
    """Test seams: ``before_move(table)`` may raise (failure injection);
    ``counts(c) -> c`` may alter measured counts (mismatch injection);
    ``split(table, df) -> df`` may wrap the split plan (task-failure injection)."""

    before_move: Callable[[str], None] | None = None
    counts: Callable[[MoveCounts], MoveCounts] | None = None
    split: Callable[[str, DataFrame], DataFrame] | None = None  # wraps a table's split plan


@dataclass
class RunResult:
    run_id: int
    status: str
    keys: dict[str, int] = field(default_factory=dict)
    counts: list[MoveCounts] = field(default_factory=list)
    error: str | None = None
    seconds: dict[str, float] = field(default_factory=dict)  # "keys:<set>", "move:<table>", "run"
    orphans: dict[tuple[str, str], int] = field(default_factory=dict)  # (table, column) -> retained rows

    def log_lines(self, log_empty: bool = False, stamp: str | None = None) -> list[dict]:
        """One line per moved table (the gate's counts), with its orphans in the note."""
        out = []
        for c in self.counts:
            if c.rows_copied > 0 or log_empty:
                left = [f"{n} rows orphaned by {col}" for (t, col), n in sorted(self.orphans.items()) if t == c.table and n]
                note = "; ".join([*c.notes, *left, *([stamp] if stamp else [])]) or None
                out.append(dict(table_name=c.table, rows_in_main=c.rows_in_main,
                                rows_copied=c.rows_copied, rows_deleted=c.rows_deleted,
                                status="SUCCESS", note=note))
        return out


class _MoveError(Exception):
    def __init__(self, table: str, cause: BaseException):
        super().__init__(str(cause))
        self.table, self.cause = table, cause


class Archiver:
    """Runs archival over ``input_root`` into ``output_root`` with a manifest.

    Options:
      * ``collation``: name comparison for root selection (``"UTF8_LCASE"``);
      * ``clients``: ``"any"`` (faithful: a parent of a chosen root moves even if
        other live roots still use it) or ``"exclusive"``;
      * ``log_empty``: also log tables that moved no rows;
      * ``verify``: ``"counts"`` (the gate) or ``"content"`` (gate + fingerprint
        of source vs. archived + retained, one extra read of the written data);
      * ``parallelism``: moves in flight at once (independent Spark jobs);
      * ``max_broadcast_bytes``: key sets up to this size in memory are broadcast,
        all moves in flight together;
      * ``stamp_session``: write ``database=..; user=..`` of the session into each
        log line's ``note``;
      * ``log_by_project``: key sets under the root carry their root id, and a line
        per table and project is written to a table of its own (shared parents
        excepted);
      * ``check_orphans``: count retained rows whose parent was archived, per edge;
      * ``check_collisions``: the archive-collision guard (the new archived keys are
        looked up in the key column of the table's archive, through its Bloom filters
        and ranges);
      * ``target_file_bytes``, ``compact_min_files``: an archived part written as
        at least ``compact_min_files`` files averaging under half the target is
        compacted to about ``bytes / target_file_bytes`` files before publishing.
    """

    def __init__(self, spark: SparkSession, manifest: Manifest, input_root: str, output_root: str,
                 *, collation: str | None = None, clients: str = "any", log_empty: bool = False,
                 verify: str = "counts", parallelism: int = 4,
                 max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, hooks: Hooks | None = None,
                 target_file_bytes: int = 128 * 1024 * 1024, compact_min_files: int = 64,
                 stamp_session: bool = False, input_layout: str = "auto",
                 log_by_project: bool = False, check_collisions: bool = True,
                 check_orphans: bool = True):
        manifest.check()
        if verify not in ("counts", "content"):
            raise ValueError("verify must be 'counts' or 'content'")
        self.spark = spark
        self.manifest = manifest
        self.store = TableStore(spark, input_root, output_root, input_layout)
        self.audit = self.store.audit
        self.collation, self.clients, self.log_empty = collation, clients, log_empty
        self.verify, self.parallelism = verify, max(1, parallelism)
        self.max_bytes = max_broadcast_bytes // self.parallelism
        self.hooks = hooks or Hooks()
        self.check_orphans = check_orphans
        self.target_file_bytes, self.compact_min_files = target_file_bytes, compact_min_files
        self.stamp_session = stamp_session
        self.log_by_project = log_by_project
        self.check_collisions = check_collisions
        self._sized = False
        self._lock = threading.Lock()
        self._seconds: dict[str, float] = {}
        self._replaced: dict[str, list] = {}  # table -> files that this run replaces
        self._result: RunResult | None = None

    # ---- stage 3: key sets ----------------------------------------------------
    def _levels(self) -> list[list]:
        """Key sets grouped by depth: each level depends only on earlier ones,
        so the sets of one level are built as concurrent Spark jobs."""
        depth: dict[str, int] = {}
        for ks in self.manifest.keysets:
            depth[ks.name] = 0 if ks.parent is None else depth[ks.parent] + 1
        levels: list[list] = [[] for _ in range(max(depth.values()) + 1)]
        for ks in self.manifest.keysets:
            levels[depth[ks.name]].append(ks)
        return levels

    def _timed(self, label: str, fn, *args):
        t0 = time.perf_counter()
        try:
            return fn(*args)
        finally:
            with self._lock:
                self._seconds[label] = round(time.perf_counter() - t0, 3)

    def build_key(self, run_id: int, ks, read: Callable[[str], DataFrame], known: dict[str, Keys],
                  csv: str | None) -> Keys:
        return self._timed(f"keys:{ks.name}", self._build_key, run_id, ks, read, known, csv)

    def _build_key(self, run_id: int, ks, read: Callable[[str], DataFrame], known: dict[str, Keys],
                   csv: str | None) -> Keys:
        """Derive one key set, write it once (deduplicated, with multiplicity),
        and assert the key while writing: row count and violations are observed
        on the write itself, so no second job runs unless something is wrong."""
        plan = derive(self.manifest, ks, read, known, csv, self.collation, self.clients,
                      self.max_bytes, carry_root=self.log_by_project)
        path = self.store.keys_dir(run_id, ks.name)
        bad_cond = (F.col("__rs_n") > 1) | F.col("id").isNull()
        obs = Observation(f"keys_{ks.name}_{run_id}")
        ranged = dict(plan.dtypes)["id"] in ("int", "bigint", "string")
        (dedup_for_write(plan)
         .observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(bad_cond).alias("bad"),
                  F.sum(F.octet_length(F.col("id").cast("string"))).alias("chars"),
                  *([F.min("id").alias("low"), F.max("id").alias("high")] if ranged else []))
         .write.mode("errorifexists").parquet(path))
        written = self.spark.read.parquet(path)
        rows, bad = int(obs.get["rows"]), int(obs.get["bad"])
        if bad:
            # confirm on the written files (metrics of a re-run stage can repeat)
            sample = written.filter(bad_cond).select("id", "__rs_n").limit(3).collect()
            if sample:
                raise KeyViolation(ks.name, [(r["id"], r["__rs_n"]) for r in sample])
            rows = written.count()
        size = 32 * rows + int(obs.get["chars"] or 0)  # of a hashed relation: a row's frame and its id
        return Keys(ks.name, written.drop("__rs_n"), rows=rows, distinct=True, size=size,
                    low=obs.get.get("low"), high=obs.get.get("high"))

    def build_keys(self, run_id: int, read: Callable[[str], DataFrame], csv: str | None,
                   known: dict[str, Keys] | None = None,
                   on_level: Callable[[set[str]], None] | None = None) -> dict[str, Keys]:
        """All key sets, level by level (sets of one level concurrently);
        ``on_level(names)`` is called as soon as a level is written."""
        known = {} if known is None else known
        for level in self._levels():
            if len(level) == 1 or self.parallelism == 1:
                for ks in level:
                    known[ks.name] = self.build_key(run_id, ks, read, known, csv)
            else:
                with ThreadPoolExecutor(min(self.parallelism, len(level)),
                                        thread_name_prefix="rootsweep-keys") as pool:
                    futures = {ks.name: pool.submit(self.build_key, run_id, ks, read, dict(known), csv)
                               for ks in level}
                    errors = []
                    for name, fut in futures.items():  # manifest order
                        try:
                            known[name] = fut.result()
                        except BaseException as exc:
                            errors.append(exc)
                    if errors:
                        raise errors[0]
            if on_level:
                on_level({ks.name for ks in level})
        return known

    # ---- stage 4/5: one move ----------------------------------------------------
    def move(self, run_id: int, mv: Move, v: Version, keys: Keys,
             published: dict[str, list[int]]) -> MoveCounts:
        return self._timed(f"move:{mv.table}", self._move, run_id, mv, v, keys, published)

    def _move(self, run_id: int, mv: Move, v: Version, keys: Keys,
              published: dict[str, list[int]]) -> MoveCounts:
        spark = self.spark
        if self.hooks.before_move:
            self.hooks.before_move(mv.table)
        if keys.rows == 0:
            return MoveCounts(mv.table, None, 0, 0, 0)
        check_schema(mv.table, v.schema, self.store.archive_schema(mv.table, published))

        whole = self.store.read_version(v, with_file=True)
        if not keys.small(self.max_bytes):
            keys = dataclasses.replace(keys, heavy=heavy_values(whole, mv.column))
        touched = None
        if self.store.one_file(v):
            source = whole  # nothing to choose from
        else:
            # files with rows to archive, by a pass over the FK column alone; the split
            # opens these and no other
            slim = whole.select(quoted(mv.column), FILE)
            if keys.low is not None:  # row groups beyond the keys' range are not read
                slim = slim.where(quoted(mv.column).between(keys.low, keys.high))
            touched = (semi(slim, mv.column, keys, self.max_bytes)
                       .groupBy(FILE).agg(F.count(F.lit(1)).alias("n")).select(f"{FILE}.*", "n").collect())
            if not touched:
                return MoveCounts(mv.table, 0, 0, 0, 0)
            source = self.store.read_version(v, files=[r["name"] for r in touched])
        obs = Observation(f"split_{mv.table}_{run_id}")
        hit_task = F.when(F.col(PART) == "archived", F.spark_partition_id())
        aggs = [F.count(F.lit(1)).alias("n"), F.count_if(F.col(PART) == "archived").alias("hits"),
                F.min(hit_task).alias("task_lo"), F.max(hit_task).alias("task_hi")]
        if self.verify == "content":
            aggs += fingerprint_aggs(v.schema, prefix="src_")
        split = flag(source, mv.column, keys, self.max_bytes, name=PART).withColumn(
            PART, F.when(F.col(PART), "archived").otherwise("retained"))
        if self.hooks.split:
            split = self.hooks.split(mv.table, split)
        if touched is None:  # the one file, as the scan saw it
            aggs += [F.max(f"{FILE}.{c}").alias(f"file_{c}") for c in ("name", "length", "modified")]
        split = split.observe(obs, *aggs).drop(FILE)
        out = self.store.table_dir(mv.table, run_id)
        with ThreadPoolExecutor(1, thread_name_prefix="rootsweep-count") as side:
            # the row count of the files to be replaced (from their footers) runs as its
            # own small job while the split is written
            before = side.submit(source.drop(FILE).count)
            writer = split.write.mode("errorifexists").partitionBy(PART)  # see _writers()
            if self.check_collisions and mv.pk:  # later runs look their new keys up here
                writer = writer.option(f"parquet.bloom.filter.enabled#{mv.pk}", "true")
            writer.parquet(out)
            rows_before = before.result()

        # Read back what was written: both parts in one job over the run folder.
        written: dict[str, int] = {}
        if rows_before:
            written = {r["part"]: int(r["n"]) for r in
                       spark.read.parquet(out).groupBy(F.col(PART).alias("part"))
                       .agg(F.count(F.lit(1)).alias("n")).collect()}
        copied, retained = written.get("archived", 0), written.get("retained", 0)
        m = obs.get
        in_main = int(m["hits"]) if touched is None else sum(r["n"] for r in touched)
        if touched is None and (in_main != copied or int(m["n"]) != rows_before):
            # Observed metrics can double count when a stage is re-run after an
            # executor loss; recount independently before judging.
            in_main = semi(whole, mv.column, keys, self.max_bytes).count()
        counts = MoveCounts(mv.table, rows_before, in_main, copied, rows_before - retained)
        if self.hooks.counts:
            counts = self.hooks.counts(counts)
        check_counts(counts)
        if touched is None:
            touched = [{c: m[f"file_{c}"] for c in ("name", "length", "modified")}]
        if copied:
            with self._lock:
                self._replaced[mv.table] = touched

        # archived files <= write tasks holding archived rows <= task id span
        span = 0 if m["task_hi"] is None else int(m["task_hi"]) - int(m["task_lo"]) + 1
        compacted = (copied > 0 and span >= self.compact_min_files
                     and self._compact_archived(mv.table, run_id, copied))
        moved_path = (self.store.compact_dir(mv.table, run_id) if compacted
                      else self.store.split_part_dir(mv.table, run_id, True))
        notes = tuple(n for n, on in ((NOTE_COMPACTED, compacted), (NOTE_EMPTIED, retained == 0))
                      if on)
        counts = dataclasses.replace(counts, notes=notes)

        if self.verify == "content" and copied > 0:
            parts = [spark.read.parquet(moved_path)]
            if retained:
                parts.append(spark.read.parquet(self.store.split_part_dir(mv.table, run_id, False)))
            both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
            got = both.agg(*fingerprint_aggs(v.schema)).first()
            src = (int(m["src_rows"]), m["src_fingerprint"])
            if (int(got["rows"]), got["fingerprint"]) != src:
                # observed metrics may repeat after a re-run stage: recompute
                again = source.drop(FILE).agg(*fingerprint_aggs(v.schema)).first()
                src = (int(again["rows"]), again["fingerprint"])
            if (int(got["rows"]), got["fingerprint"]) != src:
                raise FingerprintMismatch(mv.table, src, (got["rows"], got["fingerprint"]))

        if self.check_collisions and mv.pk and copied > 0:
            moved = spark.read.parquet(moved_path)
            hit = collisions(moved, mv.pk, self.store.archive(mv.table, published), None, self.max_bytes)
            sample = [r["id"] for r in hit.limit(3).collect()] if hit is not None else []
            if sample:
                raise ArchiveCollision(mv.table, sample)
        return counts

    def _compact_archived(self, table: str, run_id: int, copied: int) -> bool:
        """Sparse hits leave one small archived file per split task (hundreds of
        thousands on a large table). Rewrite the archived part into files of
        about ``target_file_bytes`` before the run is published; the cost is a
        read of the archived rows only. ``coalesce`` merges tasks without a
        shuffle; the compacted copy is read back and must hold the same rows."""
        src = self.store.split_part_dir(table, run_id, True)
        n_files, n_bytes = fs.files(self.spark, src)
        if n_files < self.compact_min_files or n_bytes >= n_files * self.target_file_bytes // 2:
            return False
        target = max(1, -(-n_bytes // self.target_file_bytes))
        (self.spark.read.parquet(src).coalesce(target)
         .write.mode("errorifexists").parquet(self.store.compact_dir(table, run_id)))
        written = self.spark.read.parquet(self.store.compact_dir(table, run_id)).count()
        if written != copied:
            raise CountMismatch(table, written, copied, "archived part changed while compacting")
        return True

    # ---- the run ---------------------------------------------------------------
    def _size_if_needed(self, versions: dict[str, Version], keys: dict[str, Keys]) -> None:
        """Shuffle sizing only matters once a key set is too big to broadcast
        (its joins then shuffle whole tables); until then nothing is listed."""
        if not self._sized and any(k.rows is not None and not k.small(self.max_bytes)
                                   for k in keys.values()):
            self._sized = True
            self._size_shuffles(versions)

    def _size_shuffles(self, versions: dict[str, Version]) -> None:
        """A join that cannot broadcast shuffles its table; with AQE the shuffle
        starts at ``initialPartitionNum`` partitions and is coalesced down, never
        split up (except skew). Raise that start to about one partition per
        ``SHUFFLE_PARTITION_BYTES`` of the largest input (file sizes, metadata
        only); never lower a cluster's own setting."""
        conf = self.spark.conf
        if conf.get("spark.sql.adaptive.enabled", "true").lower() != "true":
            return
        sizes = fs.total_bytes(self.spark, [p for v in versions.values() for p in v.paths])
        largest = max((sum(sizes[p] for p in v.paths) for v in versions.values()), default=0)
        need = -(-largest // SHUFFLE_PARTITION_BYTES)
        current = conf.get(INITIAL_PARTITIONS, None) or conf.get("spark.sql.shuffle.partitions", "200")
        if need > int(current):
            conf.set(INITIAL_PARTITIONS, str(need))

    def _writers(self) -> None:
        """A split writes two partition values per task. With concurrent output
        writers Spark keeps both files open instead of sorting every task's rows
        by ``archived`` first (a sort that spills on large partitions). Only set
        when the session leaves it at its default (0)."""
        if self.spark.conf.get(WRITERS, "0") == "0":
            self.spark.conf.set(WRITERS, "2")

    def run(self, csv: str | None) -> RunResult:
        t_run = time.perf_counter()
        self._seconds = {}
        self._session = {k: self.spark.conf.get(k, None) for k in (INITIAL_PARTITIONS, WRITERS)}
        try:
            return self._run(csv)
        finally:
            for key, value in self._session.items():  # the caller's settings come back
                self.spark.conf.set(key, value) if value is not None else self.spark.conf.unset(key)
            self._seconds["run"] = round(time.perf_counter() - t_run, 3)
            if self._result is not None:
                self._result.seconds = dict(self._seconds)

    def _run(self, csv: str | None) -> RunResult:
        self._result = None
        self._writers()
        self.audit.ensure()  # audit tables exist before anything reads them
        # The RUNNING row first: what is published is looked up only once no other
        # run can open, so no version of a run declared failed is ever pinned.
        run_id, started = self.audit.open_run(csv)
        stage = "Temp ID Set Creation"
        result = self._result = RunResult(run_id, "RUNNING")
        try:
            with ThreadPoolExecutor(2, thread_name_prefix="rootsweep-open") as pool:
                f_pub, f_log = pool.submit(self.store.published), pool.submit(self.audit.next_log_id)
                published, first_log_id = f_pub.result(), f_log.result()
            versions = self.store.snapshot(self.manifest.tables(), published)
            self._sized = False
            self._replaced = {}
            keys, result.counts, result.orphans = self._keys_and_moves(run_id, versions, csv, published)
            result.keys = {k: v.rows for k, v in keys.items()}
            stage = "Finalizing"
            stamp = None
            if self.stamp_session:
                info = session_info(self.spark).first()
                stamp = f"database={info['current_database']}; user={info['current_user']}"
            with ThreadPoolExecutor(1, thread_name_prefix="rootsweep-replaced") as side:
                listed = side.submit(self.store.write_replaced, run_id, self._replaced)
                if self.log_by_project:
                    self._log_by_project(result, keys, first_log_id)
                self._still_valid(run_id, "RUNNING", published)
                self.audit.write_log(run_id, result.log_lines(self.log_empty, stamp), first_log_id)
                listed.result()
            self.audit.close_run(run_id, csv, started, "SUCCESS")
            self._still_valid(run_id, "SUCCESS", published)
            result.status = "SUCCESS"
            return result
        except BaseException as exc:  # record, then re-raise (the caller must see it)
            table, cause = (exc.table, exc.cause) if isinstance(exc, _MoveError) else (stage, exc)
            result.status, result.error = "FAILED", error_text(cause, table)
            try:
                if not isinstance(exc, RunAbandoned):  # there the FAILED row exists
                    self.audit.close_run(run_id, csv, started, "FAILED", result.error)
            finally:
                if isinstance(exc, _MoveError):
                    raise cause from None
                raise

    def _still_valid(self, run_id: int, state: str, published: dict[str, list[int]]) -> None:
        """This run's state is as it should be, and all runs it builds on are published."""
        with ThreadPoolExecutor(2, thread_name_prefix="rootsweep-valid") as pool:
            f_state, f_now = pool.submit(self.audit.state, run_id), pool.submit(self.store.published)
            found, now = f_state.result(), f_now.result()
        if found != state:
            raise RunAbandoned(f"run {run_id} was declared FAILED by another command; nothing is published")
        for table, runs in published.items():
            if not set(runs) <= set(now.get(table, [])):
                raise CountMismatch(table, 0, 0, "a version this run builds on is no longer published")

    def _orphans(self, versions: dict[str, Version], keys: dict[str, Keys]) -> dict[tuple[str, str], int]:
        """Retained rows whose parent row was archived, per child column: one pass over
        each child table with an edge besides the one it is split by."""
        out: dict[tuple[str, str], int] = {}
        home = {ks.table: ks for ks in self.manifest.keysets}
        by_child: dict[str, list] = {}
        for e in self.manifest.edges():
            parent = home.get(e.parent_table)
            if parent is not None and parent.key == e.parent_col and keys[parent.name].rows and e.child_table in versions:
                by_child.setdefault(e.child_table, []).append((e.child_col, keys[parent.name]))
        moved = {mv.table: mv for mv in self.manifest.moves}
        for table, edges in by_child.items():
            mv, rows = moved.get(table), self.store.read_version(versions[table])
            if mv is not None:
                edges = [(c, k) for c, k in edges if (c, k.name) != (mv.column, mv.keyset)]
                if keys[mv.keyset].rows:
                    rows = anti(rows, mv.column, keys[mv.keyset], self.max_bytes)
            if edges:  # the range filter of orphans() passes the anti join down to the scan
                for r in orphans(rows, edges, self.max_bytes).collect():  # one row per edge
                    out[(table, r["child_col"])] = int(r["orphan_rows"])
        return out

    def _log_by_project(self, result: RunResult, keys: dict[str, Keys], first_id: int) -> None:
        """Archived rows per root of every moved table, written by the executors: a join
        of the (small) archived part with the key set that carries each key's root."""
        root = keys[self.manifest.root.name].df.select(F.col("id").alias("root_id"), F.col("name").alias("root_name"))
        parts = []
        for mv in self.manifest.moves:
            c = next((c for c in result.counts if c.table == mv.table), None)
            k = keys[mv.keyset]
            if c is None or not c.rows_copied or "root_id" not in k.df.columns:
                continue
            path = (self.store.compact_dir if NOTE_COMPACTED in c.notes else
                    lambda t, r: self.store.split_part_dir(t, r, True))(mv.table, result.run_id)
            side = k.df.select(F.col("id").alias("__rs_kid"), "root_id")
            parts.append(self.spark.read.parquet(path).select(quoted(mv.column).alias("__rs_col"))
                         .join(F.broadcast(side) if k.small(self.max_bytes) else side, F.col("__rs_col") == F.col("__rs_kid"))
                         .groupBy("root_id").agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit(mv.table).alias("table_name"), "root_id", "rows"))
        if parts:
            lines = reduce(DataFrame.unionByName, parts).join(root, "root_id")
            self.audit.write_project_log(result.run_id, lines, first_id)

    def _keys_and_moves(self, run_id: int, versions: dict[str, Version], csv: str | None,
                        published: dict[str, list[int]]) -> tuple[dict[str, Keys], list[MoveCounts], dict[tuple[str, str], int]]:
        """Key sets, then moves, and beside them the orphan audit (it needs the key sets
        and the pinned snapshot only). In parallel mode a table's move starts as soon
        as its own key set is written (moves only read the pinned snapshot and
        write run-scoped folders, so the selection cannot be disturbed); deeper
        key sets keep building meanwhile. Serial mode keeps the strict order."""
        read = self.store.reader(versions)
        moves = list(self.manifest.moves)
        keys: dict[str, Keys] = {}
        errors: list[_MoveError] = []
        stop = threading.Event()
        lock = threading.Lock()

        def one(mv: Move) -> MoveCounts | None:
            if stop.is_set():
                return None  # a step already failed: start nothing new
            try:
                return self.move(run_id, mv, versions[mv.table], keys[mv.keyset], published)
            except BaseException as exc:
                err = _MoveError(mv.table, exc)
                with lock:
                    errors.append(err)
                stop.set()
                raise err

        out: list[MoveCounts | None] = []
        left: dict[tuple[str, str], int] = {}
        if self.parallelism == 1:
            self.build_keys(run_id, read, csv, keys,
                            on_level=lambda names: self._size_if_needed(versions, keys))
            for mv in moves:
                try:
                    out.append(one(mv))
                except _MoveError:
                    break
            if self.check_orphans and not errors:
                left = self._timed("orphans", self._orphans, versions, keys)
        else:
            futures, audit = {}, None
            with ThreadPoolExecutor(self.parallelism, thread_name_prefix="rootsweep-move") as pool:
                def release(names: set[str]) -> None:
                    if stop.is_set():
                        raise errors[0]  # abandon the remaining key sets
                    self._size_if_needed(versions, keys)
                    for mv in moves:
                        if mv.keyset in names:
                            futures[mv.table] = pool.submit(one, mv)

                try:
                    self.build_keys(run_id, read, csv, keys, on_level=release)
                    if self.check_orphans:
                        audit = pool.submit(self._timed, "orphans", self._orphans, versions, keys)
                except BaseException:
                    stop.set()
                    raise  # leaving the block first waits for moves in flight
            for mv in moves:
                try:
                    out.append(futures[mv.table].result())
                except _MoveError:
                    out.append(None)
        if errors:
            # report the failing step that comes first in manifest order
            order = {mv.table: i for i, mv in enumerate(moves)}
            raise min(errors, key=lambda e: order[e.table])
        if self.parallelism > 1 and audit is not None:
            left = audit.result()
        return keys, [c for c in out if c is not None], left


def archive(spark: SparkSession, manifest: Manifest, csv: str | None, input_root: str,
            output_root: str, **options) -> RunResult:
    """``CALL archive_project(csv)``: one run over ``manifest``."""
    return Archiver(spark, manifest, input_root, output_root, **options).run(csv)
