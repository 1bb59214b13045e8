"""Read-only queries over the driver's tables, one per operator of the
inventory. Each builds a lazy DataFrame over whole tables; nothing is written.

The role mapping is the ``TPCH`` manifest's (nation = project, region = client,
customer = encounter, supplier = configuration, orders = document, events and
lineitem = children); the ``DOCS`` manifest roots documents by ``source``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.closure import close_lazy, key_violations
from ..operators.joins import Keys, anti, flag, semi
from ..operators.report import dry_run_by_root, dry_run_by_roots, dry_run_counts, shared_parents
from ..operators.select import unmatched_names
from ..operators.validate import orphans
from ..sources import fs
from ..sources.tables import TableStore
from . import live
from .graph import edges_frame, fk_reach
from .manifest import DOCS, TPCH, Manifest

# Fixed parameters of the checked queries (FIXTURES.md §1).
CSV = "NATION_1,NATION_7"
CSV2 = "NATION_1,NATION_3,NATION_8,NATION_13,NATION_18,NATION_23"
CSV_UNMATCHED = "NATION_1, NATION_7,NOPE,nation_2"
CSV_PRIOR = "NATION_1"
DOC_SOURCES = "src0,src7"

MOVED = [mv.table for mv in TPCH.moves]


class Ctx:
    """Tables of one sf folder (each read once per query) and lazy key sets."""

    def __init__(self, spark: SparkSession, sf_dir: str, manifest: Manifest = TPCH,
                 csv: str = CSV, up_mode: str = "any"):
        self.spark, self.sf_dir, self.manifest = spark, sf_dir, manifest
        self.store = TableStore(spark, sf_dir)
        self._tables: dict[str, DataFrame] = {}
        self.keys = close_lazy(manifest, self.table, csv, up_mode=up_mode)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.store.read_input(name)
        return self._tables[name]

    def move_parts(self, table: str) -> tuple[DataFrame, DataFrame]:
        mv = self.manifest.move(table)
        k = self.keys[mv.keyset]
        return semi(self.table(table), mv.column, k), anti(self.table(table), mv.column, k)


def _ids(df: DataFrame) -> DataFrame:
    return df.select("id")


# ---- key sets ---------------------------------------------------------------
def select_projects(spark, d):
    return Ctx(spark, d).keys["projects"].df


def keys_clients(spark, d):
    return _ids(Ctx(spark, d).keys["clients"].df)


def keys_encounters(spark, d):
    return _ids(Ctx(spark, d).keys["encounters"].df)


def keys_documents(spark, d):
    return _ids(Ctx(spark, d).keys["documents"].df)


def keys_configurations(spark, d):
    return _ids(Ctx(spark, d).keys["configurations"].df)


def keys_events(spark, d):
    c = Ctx(spark, d)
    return semi(c.table("events"), "user_id", c.keys["encounters"]).select(F.col("event_id").alias("id"))


def keys_codes(spark, d):
    c = Ctx(spark, d)
    return (semi(c.table("lineitem"), "l_orderkey", c.keys["documents"])
            .select(F.col("l_orderkey").alias("id")).distinct())


# ---- moves: archived and retained parts, single-pass split ------------------
def _archive(table):
    return lambda spark, d: Ctx(spark, d).move_parts(table)[0]


def _retain(table):
    return lambda spark, d: Ctx(spark, d).move_parts(table)[1]


def split_lineitem(spark, d):
    c = Ctx(spark, d)
    return flag(c.table("lineitem"), "l_orderkey", c.keys["documents"])


def split_events(spark, d):
    c = Ctx(spark, d)
    return flag(c.table("events"), "user_id", c.keys["encounters"])


def _docs_move(table, part):
    def q(spark, d):
        c = Ctx(spark, d, manifest=DOCS, csv=DOC_SOURCES)
        return c.move_parts(table)[part]
    return q


# ---- counts, gate, audit shape ------------------------------------------------
def validate_counts(spark, d):
    """Per moved table: rows of the table, rows matching the key set, rows archived and
    rows removed, and the gate. A table is one aggregate by foreign-key value; its values
    are joined twice to the key set, and each count has its own join and condition. The
    rows of the table are counted without a join (from file footers), so a join that loses
    or multiplies rows shows."""
    c = Ctx(spark, d)
    parts = []
    for i, mv in enumerate(TPCH.moves, start=1):
        k = c.keys[mv.keyset]
        per = c.table(mv.table).groupBy(F.col(mv.column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        both = flag(flag(per, "v", k, name="copied"), "v", k, name="matched")
        total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
        sums = both.agg(total(F.col("matched")).alias("rows_in_main"), total(F.col("copied")).alias("rows_copied"),
                        total(~F.col("matched")).alias("rows_retained"))
        before = c.table(mv.table).agg(F.count(F.lit(1)).alias("rows_before"))
        parts.append(before.crossJoin(F.broadcast(sums)).select(  # one row each
            F.lit(i).alias("step"), F.lit(mv.table).alias("table_name"), "*"))
    m = reduce(DataFrame.unionByName, parts)
    return m.select(
        "step", "table_name", "rows_before", "rows_in_main", "rows_copied",
        (F.col("rows_before") - F.col("rows_retained")).alias("rows_deleted"),
        ((F.col("rows_copied") == F.col("rows_before") - F.col("rows_retained"))
         & (F.col("rows_in_main") == F.col("rows_copied"))).alias("ok"))


def audit_log(spark, d):
    """The log lines a run writes: moved tables with hits, manifest order."""
    return (validate_counts(spark, d).filter(F.col("rows_copied") > 0)
            .select("step", "table_name", F.lit("SUCCESS").alias("status"),
                    "rows_in_main", "rows_copied", "rows_deleted"))


def audit_run(spark, d):
    v = validate_counts(spark, d)
    return v.agg(F.bool_and("ok").alias("all_ok")).select(
        F.lit(CSV).alias("project_list"),
        F.when(F.col("all_ok"), F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"))


# ---- guards and reports -------------------------------------------------------
def orphans_region(spark, d):
    """Live nations whose region (client) is archived (shared-client effect)."""
    c = Ctx(spark, d)
    kept = c.move_parts("nation")[1]
    return semi(kept, "n_regionkey", c.keys["clients"])


def orphans_supplier_lineitem(spark, d):
    """Retained line items pointing at an archived supplier."""
    c = Ctx(spark, d)
    kept = c.move_parts("lineitem")[1]
    return semi(kept, "l_suppkey", c.keys["configurations"])


def key_violations_lineitem(spark, d):
    return key_violations(Ctx(spark, d).table("lineitem"), "l_orderkey")


def _shared(csv):
    def q(spark, d):
        c = Ctx(spark, d, csv=csv)
        return shared_parents(TPCH, TPCH.keyset("clients"), c.table, c.keys["projects"])
    return q


def _exclusive(csv):
    def q(spark, d):
        c = Ctx(spark, d, csv=csv, up_mode="exclusive")
        return _ids(c.keys["clients"].df)
    return q


def unmatched(spark, d):
    return unmatched_names(Ctx(spark, d).table("nation"), "n_name", CSV_UNMATCHED)


def dry_run(spark, d):
    c = Ctx(spark, d)
    return dry_run_counts(TPCH, c.table, c.keys)


def _by_project(table):
    def q(spark, d):
        c = Ctx(spark, d)
        return dry_run_by_root(TPCH, c.table, c.keys, table)
    return q


def dry_run_by_project_all(spark, d):
    """Rows of all moved tables per root, shared regions for each of theirs."""
    c = Ctx(spark, d)
    return dry_run_by_roots(TPCH, c.table, c.keys)


def archive_collisions(spark, d):
    """Keys of this run's customer archive that an earlier run (csv
    ``NATION_1``) already archived: the collision guard's finding."""
    now = Ctx(spark, d)
    prior = Ctx(spark, d, csv=CSV_PRIOR).move_parts("customer")[0]
    new = Keys("new", now.move_parts("customer")[0].select(F.col("c_custkey").alias("id")))
    return semi(prior.select(F.col("c_custkey").alias("id")), "id", new)


def fk_edges(spark, d):
    """Every manifest edge with its child row count and orphan count (non-null child
    values with no parent row). Per edge one column of the child, as rows per value
    (a hot value is one row), anti-joined to the parent's key column; row counts come
    from file footers."""
    c, parts = Ctx(spark, d), []
    for e in TPCH.edges():
        child = c.table(e.child_table).select(F.col(e.child_col).alias("v"))
        parent = c.table(e.parent_table).select(F.col(e.parent_col).alias("p"))
        lost = (child.where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
                .join(parent, F.col("v") == F.col("p"), "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))
        for what, counted in (("child_rows", child.agg(F.count(F.lit(1)).alias("n"))), ("orphan_rows", lost)):
            parts.append(counted.select(*[F.lit(x).alias(n) for n, x in (
                ("child_table", e.child_table), ("child_col", e.child_col), ("parent_table", e.parent_table), ("parent_col", e.parent_col),
                ("what", what))], "n"))
    return reduce(DataFrame.unionByName, parts).groupBy("child_table", "child_col", "parent_table", "parent_col").agg(
        *[F.max(F.when(F.col("what") == w, F.col("n"))).alias(w) for w in ("child_rows", "orphan_rows")])


def orphan_audit(spark, d):
    """Every manifest edge whose parent table has a key set: child rows that stay though
    their parent is archived."""
    c = Ctx(spark, d)
    home = {ks.table: ks.name for ks in TPCH.keysets}
    parts = []
    for table in dict.fromkeys(e.child_table for e in TPCH.edges()):
        edges = [e for e in TPCH.edges() if e.child_table == table and e.parent_table in home]
        kept = c.move_parts(table)[1]
        found = orphans(kept, [(e.child_col, c.keys[home[e.parent_table]]) for e in edges])
        parts.append(found.select(F.lit(table).alias("child_table"), "child_col", "orphan_rows"))
    return reduce(DataFrame.unionByName, parts)


def _table_counts(c: Ctx, tables: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        c.table(t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
        for t in tables])


def list_tables(spark, d):
    """Datasets in the input folder with their row counts."""
    c = Ctx(spark, d)
    names = sorted({n[: -len(".parquet")] if n.endswith(".parquet") else n
                    for n in fs.children(spark, d) if not n.startswith(("_", "."))})
    return _table_counts(c, names)


def fk_reach_nation(spark, d):
    """Tables under ``nation`` along the manifest's FK edges with their depth
    (longest chain) and current row count."""
    c = Ctx(spark, d)
    reach = fk_reach(spark, edges_frame(spark, TPCH.edges()), "nation")
    tables = sorted({t for e in TPCH.edges() for t in (e.child_table, e.parent_table)})
    counts = _table_counts(c, tables)
    return reach.join(counts, "table_name", "inner").select("table_name", "depth", "rows")


def fingerprint_moves(spark, d):
    """Per moved table: rows and content sums of the archived and the retained part of
    the split (one scan). The content of a row is the first 32 bits of the MD5 of its
    integer and string columns."""
    c = Ctx(spark, d)
    parts = []
    for mv in TPCH.moves:
        t = flag(c.table(mv.table), mv.column, c.keys[mv.keyset])
        exact = [f.name for f in t.schema.fields if f.dataType.simpleString() in ("int", "bigint", "string")]
        text = F.concat_ws("|", *[F.coalesce(F.col(n).cast("string"), F.lit("~")) for n in exact])
        value = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        both = t.select("archived", value.alias("value"))
        side = lambda cond, x: F.coalesce(F.sum(F.when(cond, x)), F.lit(0))
        gone = F.col("archived")
        parts.append(both.agg(
            F.count(F.lit(1)).alias("rows"), side(gone, F.lit(1)).alias("archived_rows"),
            side(~gone, F.lit(1)).alias("retained_rows"), side(gone, F.col("value")).alias("archived_sum"),
            side(~gone, F.col("value")).alias("retained_sum")).select(F.lit(mv.table).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "select_projects": select_projects,
        "keys_clients": keys_clients,
        "keys_encounters": keys_encounters,
        "keys_configurations": keys_configurations,
        "keys_documents": keys_documents,
        "keys_events": keys_events,
        "keys_codes": keys_codes,
    }
    for t in MOVED:
        q[f"archive_{t}"] = _archive(t)
        q[f"retain_{t}"] = _retain(t)
    q.update({
        "split_lineitem": split_lineitem,
        "split_events": split_events,
        "archive_labels": _docs_move("labels", 0),
        "retain_labels": _docs_move("labels", 1),
        "archive_documents": _docs_move("documents", 0),
        "retain_documents": _docs_move("documents", 1),
        "validate_counts": validate_counts,
        "audit_log": audit_log,
        "audit_run": audit_run,
        "orphans_region": orphans_region,
        "orphans_supplier_lineitem": orphans_supplier_lineitem,
        "key_violations": key_violations_lineitem,
        "shared_clients": _shared(CSV),
        "shared_clients_csv2": _shared(CSV2),
        "exclusive_clients": _exclusive(CSV),
        "exclusive_clients_csv2": _exclusive(CSV2),
        "unmatched_names": unmatched,
        "dry_run_counts": dry_run,
        "dry_run_by_project": _by_project("customer"),
        "dry_run_by_project_lineitem": _by_project("lineitem"),
        "dry_run_by_project_all": dry_run_by_project_all,
        "archive_collisions": archive_collisions,
        "fk_edges": fk_edges,
        "orphan_audit": orphan_audit,
        "fk_reach": fk_reach_nation,
        "list_tables": list_tables,
        "fingerprint": fingerprint_moves,
    })
    return q | live.registry()
