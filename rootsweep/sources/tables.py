"""Versioned main and archive tables on Parquet folders.

Layout under ``output_root``::

    keys/run_id=<r>/<key set>/                       materialised key sets (evidence)
    tables/<t>/__rs_run=<r>/__rs_part=archived/       rows archived by run r
    tables/<t>/__rs_run=<r>/__rs_part=retained/       other rows of the files that held them
    replaced/__rs_run=<r>/table=<t>/                  list of those files (see below)
    tables/<t>/compacted/__rs_run=<r>/                archived part in fewer files (layout only)
    audit/...                                         see ``sources.audit``

One split write fills both parts. Only runs whose latest state is SUCCESS are
read, so a failed run's files are never looked at (all or nothing without a
transaction):

* **main** of ``t`` = the input table and the retained parts of all published runs,
  without the files that a published run has replaced. A run thus rewrites only
  files that hold archived rows. A replaced file is known by its path below the input
  or output root, its length and its modification time, so a version is the same
  through another mount, scheme or link; one that is missing or changed raises
  ``StaleBase``. Reads leave replaced files out by a literal filter on the file name,
  which Spark applies to its listing: they are never opened;
* **archive** of ``t`` = the archived parts of every published run, with the run
  as column ``__rs_run``.

Where the catalogue offers row-level ``DELETE`` (a table format), the same
plan can issue it instead.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import quoted
from ..operators.validate import PART, RUN, ArchivalError
from . import fs
from .audit import Audit


def file_of_row() -> Column:
    return F.struct(F.col(NAME).alias("name"), F.col("_metadata.file_size").alias("length"),
                    F.unix_millis("_metadata.file_modification_time").alias("modified")).alias(FILE)


class StaleBase(ArchivalError):
    """A file that a published run replaced is missing or changed: the input is not the
    one that the run worked on."""


@dataclass(frozen=True)
class Version:
    """One pinned version of a main table: where to read it, its schema, the runs whose
    retained parts make it up, and the names of the files that they replaced."""

    table: str
    paths: tuple[str, ...]
    schema: StructType
    runs: tuple[int, ...] = ()  # () = the input table as it is
    gone: tuple[str, ...] = field(default=(), repr=False)
    frame: DataFrame | None = field(default=None, compare=False, repr=False)

    @property
    def run_id(self) -> int | None:
        return self.runs[-1] if self.runs else None


#: Flags a run records in its log line's ``note`` about what it wrote, so that
#: readers never probe for folders that may be absent.
NOTE_COMPACTED = "archived part compacted"
NOTE_EMPTIED = "nothing retained"
#: Column with the file of each row (name, length, modified), where a run asks for it.
FILE = "__rs_file"
NAME = "_metadata.file_path"
REPLACED = "base string, path string, length bigint, modified bigint"


class TableStore:
    """``input_layout``: ``"file"`` (``<root>/<t>.parquet``), ``"folder"``
    (``<root>/<t>/``) or ``"auto"`` (try the file form, then the folder).
    ``check_times=False`` accepts replaced files with another modification time (an
    input that was copied without keeping them); path and length must agree all the same."""

    def __init__(self, spark: SparkSession, input_root: str, output_root: str | None = None,
                 input_layout: str = "auto", check_times: bool = True):
        if input_layout not in ("auto", "file", "folder"):
            raise ValueError("input_layout must be 'auto', 'file' or 'folder'")
        self.spark = spark
        self.input_root = input_root
        self.output_root = output_root
        self.input_layout = input_layout
        self.check_times = check_times
        self._bases: dict[str, str] = {}
        self.audit = Audit(spark, output_root) if output_root else None
        self._notes: dict[tuple[str, int], str] | None = None  # filled by published()

    # ---- input tables ------------------------------------------------------
    def _open_input(self, table: str) -> tuple[str, DataFrame | None]:
        """``<root>/<t>.parquet`` (a file or folder), else ``<root>/<t>/``;
        opened by reading, so a large folder is listed once."""
        single = fs.join(self.input_root, f"{table}.parquet")
        folder = fs.join(self.input_root, table)
        if self.input_layout == "file":
            return single, fs.try_parquet(self.spark, single)
        if self.input_layout == "folder":
            return folder, fs.try_parquet(self.spark, folder)
        df = fs.try_parquet(self.spark, single)
        if df is not None:
            return single, df
        return folder, fs.try_parquet(self.spark, folder)

    def input_path(self, table: str) -> str:
        return self._open_input(table)[0]

    def read_input(self, table: str) -> DataFrame:
        path, df = self._open_input(table)
        if df is None:
            raise FileNotFoundError(f"input table {table!r} not found at {path}")
        return df

    # ---- folders of the output ---------------------------------------------
    def table_dir(self, table: str, run_id: int) -> str:
        return fs.join(self.output_root, "tables", table, f"{RUN}={run_id}")

    def replaced_dir(self, table: str, run_id: int) -> str:
        return fs.join(self.output_root, "replaced", f"{RUN}={run_id}", f"table={table}")

    def note(self, table: str, run_id: int) -> str:
        if self._notes is None:
            self.published()
        return (self._notes or {}).get((table, run_id)) or ""

    def part_dir(self, table: str, run_id: int, archived: bool) -> str:
        """Folder of one part of a published run's split. An archived part
        compacted before publishing (flagged in the log) is the compacted copy."""
        if archived and NOTE_COMPACTED in self.note(table, run_id):
            return self.compact_dir(table, run_id)
        return self.split_part_dir(table, run_id, archived)

    def split_part_dir(self, table: str, run_id: int, archived: bool) -> str:
        return fs.join(self.table_dir(table, run_id), f"{PART}={'archived' if archived else 'retained'}")

    def compact_dir(self, table: str, run_id: int) -> str:
        return fs.join(self.output_root, "tables", table, "compacted", f"{RUN}={run_id}")

    def keys_dir(self, run_id: int, keyset: str) -> str:
        return fs.join(self.output_root, "keys", f"run_id={run_id}", keyset)

    # ---- published versions --------------------------------------------------
    def published(self) -> dict[str, list[int]]:
        """Table -> runs that moved rows of it and were published (ascending).

        Reads two small audit tables (one row per run / per run and moved table;
        lines per project are in a table of their own)."""
        if self.audit is None:
            return {}
        ok = self.audit.runs_raw().filter(F.col("status") == "SUCCESS").select("run_id")
        rows = (self.audit.log_raw().filter(F.col("rows_copied") > 0)
                .join(ok, "run_id", "left_semi")
                .select("table_name", "run_id", "note").collect())
        out: dict[str, set[int]] = {}
        notes: dict[tuple[str, int], str] = {}
        for r in rows:
            out.setdefault(r["table_name"], set()).add(int(r["run_id"]))
            notes[(r["table_name"], int(r["run_id"]))] = r["note"] or ""
        self._notes = notes
        return {t: sorted(v) for t, v in out.items()}

    def version(self, table: str, published: dict[str, list[int]] | None = None) -> Version:
        runs = tuple((published if published is not None else self.published()).get(table, []))
        path, df = self._open_input(table)
        if df is None:
            raise FileNotFoundError(f"input table {table!r} not found at {path}")
        kept = tuple(self.split_part_dir(table, r, False) for r in runs if NOTE_EMPTIED not in self.note(table, r))
        gone = self._gone(table, runs, [path, *kept]) if runs else ()
        return Version(table, (path, *kept), df.schema, runs, gone, df)

    # ---- replaced files --------------------------------------------------------
    def _base(self, kind: str) -> str:
        if kind not in self._bases:
            self._bases[kind] = fs.base_path(self.spark, self.input_root if kind == "input" else self.output_root)
        return self._bases[kind]

    def place(self, name: str) -> tuple[str, str]:
        """(base, path below it) of a file: the same for every spelling of the roots."""
        for kind in ("output", "input"):
            path = fs.below(self._base(kind), name)
            if path is not None:
                return kind, path
        raise ValueError(f"{name} is neither below {self.input_root} nor {self.output_root}")

    def write_replaced(self, run_id: int, files: dict[str, list]) -> None:
        """Per table the files (name, length, modified) that a run replaces: one write."""
        rows = [(t, *self.place(f["name"]), f["length"], f["modified"]) for t, found in files.items() for f in found]
        if rows:
            (self.spark.createDataFrame(rows, f"table string, {REPLACED}").coalesce(1).write.mode("errorifexists")
             .partitionBy("table").parquet(fs.join(self.output_root, "replaced", f"{RUN}={run_id}")))

    def _gone(self, table: str, runs: tuple[int, ...], paths: list[str]) -> tuple[str, ...]:
        """Names, as scans of ``paths`` spell them, of the files that ``runs`` replaced;
        each must be there as it was. (The driver lists these files in any case.)"""
        dirs = [self.replaced_dir(table, r) for r in runs]
        want = {(r["base"], r["path"]): r for r in self.spark.read.schema(REPLACED).parquet(*dirs).collect()}
        have = {self.place(f["name"]): f for f in fs.file_rows(self.spark, paths)}
        for key, was in want.items():
            now = have.get(key)
            if now is None or now["length"] != was["length"] or (self.check_times and now["modified"] != was["modified"]):
                raise StaleBase(f"file {key[1]!r} of {table!r}, replaced by an earlier run, is "
                                f"{'missing' if now is None else 'changed'} below the {key[0]} root")
        return tuple(sorted(have[key]["name"] for key in want))

    def snapshot(self, tables: list[str], published: dict[str, list[int]] | None = None) -> dict[str, Version]:
        """Pin one version per table for a whole run (closure and split read the
        same data, unlike key sets built before the reference's transaction)."""
        pub = published if published is not None else self.published()
        if len(tables) <= 1:
            return {t: self.version(t, pub) for t in tables}
        # footer reads of independent tables, overlapped
        with ThreadPoolExecutor(min(8, len(tables)), thread_name_prefix="rootsweep-snap") as pool:
            futures = {t: pool.submit(self.version, t, pub) for t in tables}
            return {t: f.result() for t, f in futures.items()}

    def read_version(self, v: Version, with_file: bool = False, files: list[str] | None = None) -> DataFrame:
        """The rows of a version, optionally with the file that each is in (``FILE``), or
        only those of the named ``files``."""
        parts = [v.frame if v.frame is not None else self.spark.read.schema(v.schema).parquet(v.paths[0])]
        if len(v.paths) > 1:
            parts.append(self.spark.read.schema(v.schema).parquet(*v.paths[1:]))
        names = [quoted(c) for c in v.schema.names]
        out = None
        for part in parts:
            if files is not None:
                part = part.where(F.col(NAME).isin(files))
            elif v.gone:
                part = part.where(~F.col(NAME).isin(list(v.gone)))
            part = part.select(*names, file_of_row()) if with_file else part.select(*names)
            out = part if out is None else out.unionByName(part)
        return out

    def one_file(self, v: Version) -> bool:
        """Whether the version is a single file (from the listing that its frame holds)."""
        return not v.runs and v.frame is not None and len(v.frame._jdf.inputFiles()) == 1

    def main(self, table: str) -> DataFrame:
        return self.read_version(self.version(table))

    def archive(self, table: str, published: dict[str, list[int]] | None = None) -> DataFrame | None:
        """Every archived row of ``table`` with its run (``__rs_run``); None if never archived."""
        runs = (published if published is not None else self.published()).get(table, [])
        if not runs:
            return None
        # Two path-list reads (plain split parts, compacted parts); partition
        # discovery supplies the run, so the plan stays two scans for any number of runs.
        base = fs.join(self.output_root, "tables", table)
        compacted = {r for r in runs if NOTE_COMPACTED in self.note(table, r)}
        reads = []
        plain = [self.split_part_dir(table, r, True) for r in runs if r not in compacted]
        if plain:
            reads.append(self.spark.read.option("basePath", base).parquet(*plain).drop(PART))
        if compacted:
            reads.append(self.spark.read.option("basePath", fs.join(base, "compacted"))
                         .parquet(*[self.compact_dir(table, r) for r in sorted(compacted)]))
        return reads[0] if len(reads) == 1 else reads[0].unionByName(reads[1])

    def archive_schema(self, table: str, published: dict[str, list[int]] | None = None) -> StructType | None:
        runs = (published if published is not None else self.published()).get(table, [])
        if not runs:
            return None
        return self.spark.read.parquet(self.part_dir(table, runs[-1], True)).schema

    def reader(self, versions: dict[str, Version] | None = None):
        """``table -> DataFrame`` over pinned versions (or the input tables)."""
        if versions is None:
            return self.read_input

        def read(table: str) -> DataFrame:
            if table not in versions:
                raise KeyError(f"table {table!r} is not pinned in this run")
            return self.read_version(versions[table])

        return read
