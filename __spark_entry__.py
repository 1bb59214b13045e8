"""

``entry(spark)``   flagship query on sf0.001: the line items (document children)
                   that belong to projects NATION_1 and NATION_7 (a 4-hop semi
                   join chain nation -> customer -> orders -> lineitem).
``queries()``      one read-only query per operator (see rootsweep.plans.queries).
``oracle_sql()``   the same questions in DuckDB SQL over the same parquet views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rootsweep.plans import live
from rootsweep.plans.manifest import TPCH
from rootsweep.plans.queries import (
    CSV,
    CSV2,
    CSV_PRIOR,
    CSV_UNMATCHED,
    DOC_SOURCES,
    registry,
)

try:
    from rootsweep.llm.queries import ORACLE_SQL as _LLM_SQL
    from rootsweep.llm.queries import QUERIES as _LLM
except ImportError:  # the subpackage, or a library that only it needs, is not there
    _LLM, _LLM_SQL = {}, {}

SF_SMOKE = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return queries()["archive_lineitem"](spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return registry() | _LLM


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB). Key sets as CTEs, written the way the reference
# procedure builds them (IN-subqueries); deletes as NOT EXISTS.
# ---------------------------------------------------------------------------
def _keysets(csv: str, p: str = "") -> str:
    return f"""
{p}projects AS (SELECT n_nationkey AS id, n_name AS name, n_regionkey AS client_id FROM nation
             WHERE list_contains(string_split('{csv}', ','), n_name)),
{p}clients AS (SELECT r_regionkey AS id FROM region WHERE r_regionkey IN (SELECT client_id FROM {p}projects)),
{p}encounters AS (SELECT c_custkey AS id FROM customer WHERE c_nationkey IN (SELECT id FROM {p}projects)),
{p}configurations AS (SELECT s_suppkey AS id FROM supplier WHERE s_nationkey IN (SELECT id FROM {p}projects)),
{p}documents AS (SELECT o_orderkey AS id FROM orders WHERE o_custkey IN (SELECT id FROM {p}encounters))"""


def _with(csv: str = CSV, extra: str = "") -> str:
    return "WITH " + _keysets(csv) + (",\n" + extra if extra else "") + "\n"


_MOVES = [(mv.table, mv.column, mv.keyset) for mv in TPCH.moves]
_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
           "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _archived(t: str, col: str, ks: str) -> str:
    return f"SELECT * FROM {t} WHERE {col} IN (SELECT id FROM {ks})"


def _retained(t: str, col: str, ks: str, alias: str = "t") -> str:
    return (f"SELECT * FROM {t} {alias} WHERE NOT EXISTS "
            f"(SELECT 1 FROM {ks} k WHERE k.id = {alias}.{col})")


def _validate_cte() -> str:
    parts = []
    for i, (t, col, ks) in enumerate(_MOVES, start=1):
        parts.append(
            f"SELECT {i} AS step, '{t}' AS table_name, "
            f"(SELECT count(*) FROM {t}) AS rows_before, "
            f"(SELECT count(*) FROM {t} WHERE {col} IN (SELECT id FROM {ks})) AS rows_in_main, "
            f"(SELECT count(*) FROM ({_archived(t, col, ks)})) AS rows_copied, "
            f"(SELECT count(*) FROM ({_retained(t, col, ks, 'r')})) AS rows_retained")
    raw = "\nUNION ALL ".join(parts)
    return (f"raw AS ({raw}),\nvalidate AS (SELECT step, table_name, rows_before, rows_in_main, "
            "rows_copied, rows_before - rows_retained AS rows_deleted, "
            "(rows_copied = rows_before - rows_retained AND rows_in_main = rows_copied) AS ok FROM raw)")


def _fk_edges_sql() -> str:
    parts = []
    for e in TPCH.edges():
        parts.append(
            f"SELECT '{e.child_table}' AS child_table, '{e.child_col}' AS child_col, "
            f"'{e.parent_table}' AS parent_table, '{e.parent_col}' AS parent_col, "
            f"count(*) AS child_rows, count(*) FILTER (WHERE c.{e.child_col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {e.parent_table} p WHERE p.{e.parent_col} = c.{e.child_col})) AS orphan_rows "
            f"FROM {e.child_table} c")
    return "\nUNION ALL ".join(parts)


def _counts_sql(tables: list[str]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in tables)


def _fk_reach_sql() -> str:
    edges = TPCH.edges()
    values = ", ".join(f"('{e.child_table}', '{e.parent_table}')" for e in edges)
    tables = sorted({t for e in edges for t in (e.child_table, e.parent_table)})
    return f"""
WITH RECURSIVE edges(child_table, parent_table) AS (VALUES {values}),
reach(table_name, depth) AS (
    SELECT 'nation', 0
    UNION ALL
    SELECT e.child_table, r.depth + 1 FROM reach r JOIN edges e ON e.parent_table = r.table_name
    WHERE r.depth < {len(edges)}),
counts AS ({_counts_sql(tables)})
SELECT r.table_name, max(r.depth) AS depth, c.rows FROM reach r JOIN counts c ON c.table_name = r.table_name
GROUP BY r.table_name, c.rows"""


def _live_nations() -> str:
    return ("SELECT * FROM nation t WHERE NOT EXISTS "
            "(SELECT 1 FROM projects p WHERE p.id = t.n_nationkey)")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {
        "select_projects": _with() + "SELECT id, name, client_id FROM projects",
        "keys_clients": _with() + "SELECT id FROM clients",
        "keys_encounters": _with() + "SELECT id FROM encounters",
        "keys_configurations": _with() + "SELECT id FROM configurations",
        "keys_documents": _with() + "SELECT id FROM documents",
        "keys_events": _with() + "SELECT event_id AS id FROM events WHERE user_id IN (SELECT id FROM encounters)",
        "keys_codes": _with() + "SELECT DISTINCT l_orderkey AS id FROM lineitem "
                                "WHERE l_orderkey IN (SELECT id FROM documents)",
    }
    for t, col, ks in _MOVES:
        q[f"archive_{t}"] = _with() + _archived(t, col, ks)
        q[f"retain_{t}"] = _with() + _retained(t, col, ks)
    q["split_lineitem"] = _with() + (
        "SELECT t.*, EXISTS (SELECT 1 FROM documents k WHERE k.id = t.l_orderkey) AS archived "
        "FROM lineitem t")
    q["split_events"] = _with() + (
        "SELECT t.*, EXISTS (SELECT 1 FROM encounters k WHERE k.id = t.user_id) AS archived "
        "FROM events t")
    docs = (f"WITH docs AS (SELECT doc_id AS id FROM documents "
            f"WHERE list_contains(string_split('{DOC_SOURCES}', ','), source))\n")
    q["archive_labels"] = docs + _archived("labels", "doc_id", "docs")
    q["retain_labels"] = docs + _retained("labels", "doc_id", "docs")
    q["archive_documents"] = docs + _archived("documents", "doc_id", "docs")
    q["retain_documents"] = docs + _retained("documents", "doc_id", "docs")

    q["validate_counts"] = _with(extra=_validate_cte()) + "SELECT * FROM validate"
    q["audit_log"] = _with(extra=_validate_cte()) + (
        "SELECT step, table_name, 'SUCCESS' AS status, rows_in_main, rows_copied, rows_deleted "
        "FROM validate WHERE rows_copied > 0")
    q["audit_run"] = _with(extra=_validate_cte()) + (
        f"SELECT '{CSV}' AS project_list, "
        "CASE WHEN bool_and(ok) THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM validate")

    q["orphans_region"] = _with() + (
        _live_nations() + " AND t.n_regionkey IN (SELECT id FROM clients)")
    q["orphans_supplier_lineitem"] = _with() + (
        _retained("lineitem", "l_orderkey", "documents")
        + " AND t.l_suppkey IN (SELECT id FROM configurations)")
    q["key_violations"] = ("SELECT l_orderkey AS id, count(*) AS n FROM lineitem GROUP BY l_orderkey "
                           "HAVING count(*) > 1 OR l_orderkey IS NULL")
    for name, csv in (("shared_clients", CSV), ("shared_clients_csv2", CSV2)):
        q[name] = _with(csv, f"live AS ({_live_nations()})") + (
            "SELECT n_regionkey AS id, count(*) AS live_children FROM live "
            "WHERE n_regionkey IS NOT NULL AND n_regionkey IN (SELECT client_id FROM projects) "
            "GROUP BY n_regionkey")
    for name, csv in (("exclusive_clients", CSV), ("exclusive_clients_csv2", CSV2)):
        q[name] = _with(csv, f"live AS ({_live_nations()})") + (
            "SELECT r_regionkey AS id FROM region WHERE r_regionkey IN (SELECT client_id FROM projects) "
            "AND r_regionkey NOT IN (SELECT n_regionkey FROM live WHERE n_regionkey IS NOT NULL)")
    q["unmatched_names"] = (
        f"WITH l AS (SELECT string_split('{CSV_UNMATCHED}', ',') AS l),\n"
        "items AS (SELECT CAST(generate_subscripts(l, 1) AS INTEGER) AS position, unnest(l) AS name FROM l)\n"
        "SELECT position, name FROM items WHERE name NOT IN "
        "(SELECT n_name FROM nation WHERE n_name IS NOT NULL)")
    q["dry_run_counts"] = _with() + "\nUNION ALL ".join(
        f"SELECT {i} AS step, '{t}' AS table_name, "
        f"(SELECT count(*) FROM {t} WHERE {col} IN (SELECT id FROM {ks})) AS rows_to_move"
        for i, (t, col, ks) in enumerate(_MOVES, start=1))
    q["dry_run_by_project"] = _with() + (
        "SELECT p.id AS root_id, p.name AS root_name, 'customer' AS table_name, count(*) AS rows_to_move "
        "FROM customer c JOIN projects p ON c.c_nationkey = p.id GROUP BY p.id, p.name")
    q["dry_run_by_project_lineitem"] = _with() + (
        "SELECT p.id AS root_id, p.name AS root_name, 'lineitem' AS table_name, count(*) AS rows_to_move "
        "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
        "JOIN customer c ON o.o_custkey = c.c_custkey JOIN projects p ON c.c_nationkey = p.id "
        "GROUP BY p.id, p.name")
    q["archive_collisions"] = _with() + (
        "SELECT c_custkey AS id FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation "
        f"WHERE list_contains(string_split('{CSV_PRIOR}', ','), n_name)) "
        "AND c_custkey IN (SELECT id FROM encounters)")
    q["fk_edges"] = _fk_edges_sql()
    q["orphan_audit"] = _with() + _orphan_audit_sql()
    q["fk_reach"] = _fk_reach_sql()
    q["list_tables"] = _counts_sql(_TABLES)
    q["fingerprint"] = _with() + _fingerprint_sql()
    q["dry_run_by_project_all"] = _with(extra=(
        "pairs AS (SELECT 'projects' AS ks, id AS kid, id AS root_id FROM projects "
        "UNION ALL SELECT DISTINCT 'clients', client_id, id FROM projects WHERE client_id IN (SELECT r_regionkey FROM region) "
        "UNION ALL SELECT 'encounters', c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT id FROM projects) "
        "UNION ALL SELECT 'configurations', s_suppkey, s_nationkey FROM supplier WHERE s_nationkey IN (SELECT id FROM projects) "
        "UNION ALL SELECT 'documents', o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey "
        "WHERE c_nationkey IN (SELECT id FROM projects))")) + "\nUNION ALL ".join(
        f"SELECT {i} AS step, '{t}' AS table_name, p.root_id, r.name AS root_name, count(*) AS rows_to_move FROM {t} t "
        f"JOIN pairs p ON p.ks = '{ks}' AND p.kid = t.{col} JOIN projects r ON r.id = p.root_id GROUP BY ALL"
        for i, (t, col, ks) in enumerate(_MOVES, start=1))
    return q | _live_sql() | _LLM_SQL


# ---- the same facts as the published results of real runs (plans.live) -----------
def _run_of(col: str, ks: str) -> str:
    """Which of the two stacked runs archives a row (of those that one does)."""
    return f"CAST(CASE WHEN {col} IN (SELECT id FROM p_{ks}) THEN 1 ELSE 2 END AS BIGINT)"


def _live_sql() -> dict[str, str]:
    stacked = "WITH " + _keysets(",".join(live.RUNS)) + "," + _keysets(live.RUNS[0], "p_")
    lines = ",\nlines AS (" + "\nUNION ALL ".join(
        f"SELECT {_run_of(col, ks)} AS run_id, {i} AS step, '{t}' AS table_name, count(*) AS n FROM {t} "
        f"WHERE {col} IN (SELECT id FROM {ks}) GROUP BY ALL" for i, (t, col, ks) in enumerate(_MOVES, start=1)) + ")\n"
    q = {}
    for t, col, ks in _MOVES:
        q[f"run_main_{t}"] = _with(",".join(live.RUNS)) + _retained(t, col, ks)
        q[f"run_archive_{t}"] = stacked + f"\nSELECT *, {_run_of(col, ks)} AS run_id FROM {t} WHERE {col} IN (SELECT id FROM {ks})"
    q["run_fingerprint_buckets"] = "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST('0x' || substr(md5(coalesce(CAST({col} AS VARCHAR), '~')), 1, 4) AS BIGINT) % {live.BUCKETS} AS bucket, "
        f"count(*) AS rows, CAST(sum({_content(t)}) AS BIGINT) AS content FROM {t} GROUP BY ALL" for t, col, _ in _MOVES)
    runs = ", ".join(f"({i}, '{csv}')" for i, csv in enumerate(live.RUNS, start=1))
    q["run_audit_runs"] = stacked + lines + (
        "SELECT CAST(r.run_id AS BIGINT) AS run_id, project_list, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message, true AS ended, "
        f"count(l.n) AS tables_moved, CAST(coalesce(sum(l.n), 0) AS BIGINT) AS rows_moved FROM (VALUES {runs}) r(run_id, project_list) "
        "LEFT JOIN lines l ON l.run_id = r.run_id GROUP BY ALL")
    q["run_audit_log"] = stacked + lines + (
        "SELECT row_number() OVER (ORDER BY run_id, step) AS id, run_id, table_name, 'SUCCESS' AS status, n AS rows_in_main, "
        "n AS rows_copied, n AS rows_deleted FROM lines")
    q["run_failed"] = "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS main_rows, 0 AS archived_parts, 'FAILED' AS status, "
        f"'ERROR RuntimeError (HY000) processing table `{live.FAILING}`: {live.FAILURE}' AS error_message, CAST(0 AS BIGINT) AS log_lines FROM {t}"
        for t, _, _ in _MOVES)
    q["run_failed_main_lineitem"] = "SELECT * FROM lineitem"
    first, second = live.DOC_RUNS
    hits = {t: f"SELECT count(*) AS n FROM {t} WHERE doc_id IN (SELECT doc_id FROM documents WHERE source = '{second}')" for t in ("labels", "documents")}
    q["run_purged"] = "\nUNION ALL ".join(
        f"SELECT CAST(2 AS BIGINT) AS run_id, '{second}' AS project_list, 'SUCCESS' AS status, '{t}' AS table_name, "
        f"n AS rows_in_main, n AS rows_copied, n AS rows_deleted FROM ({sql}) WHERE n > 0" for t, sql in hits.items())
    q["run_purged_archive_documents"] = (
        f"SELECT *, CAST(CASE source WHEN '{first}' THEN 1 ELSE 2 END AS BIGINT) AS run_id FROM documents WHERE source IN ('{first}', '{second}')")
    return q


#: Integer and string columns of the moved tables, in order.
_EXACT = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"],
    "events": ["event_id", "user_id", "event_type", "props"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
}


def _content(t: str) -> str:
    text = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in _EXACT[t]) + ")"
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _fingerprint_sql() -> str:
    """Rows and content sums of both parts of each split."""
    parts = []
    for t, col, ks in _MOVES:
        value = _content(t)
        a, r = _archived(t, col, ks), _retained(t, col, ks, "r")
        parts.append(
            f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows, "
            f"(SELECT count(*) FROM ({a})) AS archived_rows, (SELECT count(*) FROM ({r})) AS retained_rows, "
            f"CAST((SELECT coalesce(sum({value}), 0) FROM ({a})) AS BIGINT) AS archived_sum, "
            f"CAST((SELECT coalesce(sum({value}), 0) FROM ({r})) AS BIGINT) AS retained_sum")
    return "\nUNION ALL ".join(parts)


def _orphan_audit_sql() -> str:
    home = {ks.table: ks.name for ks in TPCH.keysets}
    moves = {t: (col, ks) for t, col, ks in _MOVES}
    parts = []
    for e in TPCH.edges():
        if e.parent_table in home:
            parts.append(
                f"SELECT '{e.child_table}' AS child_table, '{e.child_col}' AS child_col, (SELECT count(*) FROM "
                f"({_retained(e.child_table, *moves[e.child_table])}) x WHERE x.{e.child_col} IN "
                f"(SELECT id FROM {home[e.parent_table]})) AS orphan_rows")
    return "\nUNION ALL ".join(parts)
