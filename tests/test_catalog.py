"""Catalogue helpers, audit schemas, manifest coverage."""

from __future__ import annotations

from conftest import SF001

from rootsweep import TPCH
from rootsweep.plans.graph import coverage, edges_frame
from rootsweep.sources.audit import LOG_SCHEMA, RUN_SCHEMA, Audit
from rootsweep.sources.catalog import EDGES_SQL, list_tables, session_info


def test_list_tables(spark):
    names = {r["table_name"] for r in list_tables(spark, SF001).collect()}
    assert {"lineitem", "orders", "nation", "region", "labels"} <= names


def test_session_info(spark):
    (row,) = session_info(spark).collect()
    assert row["current_database"] == "default" and row["current_user"]


def test_edges_query_names_the_child_column():
    assert "column_name AS child_col" in EDGES_SQL


def test_audit_tables_created_empty(spark, scratch):
    a = Audit(spark, scratch)
    a.ensure()
    assert a.runs_raw().count() == 0 and a.log_raw().count() == 0
    assert spark.read.parquet(a.run_path).schema.names == RUN_SCHEMA.names
    assert spark.read.parquet(a.log_path).schema.names == LOG_SCHEMA.names


def test_manifest_coverage(spark):
    cov = {r["table_name"]: (r["depth"], r["moved"]) for r in
           coverage(spark, edges_frame(spark, TPCH.edges()), "nation",
                    [m.table for m in TPCH.moves]).collect()}
    assert all(moved for _, moved in cov.values())
    partial = {r["table_name"]: r["moved"] for r in
               coverage(spark, edges_frame(spark, TPCH.edges()), "nation", ["nation"]).collect()}
    assert partial["lineitem"] is False and partial["nation"] is True


def test_session_stamped_in_note(spark, scratch):
    from conftest import MICRO, base_rows, write_tables

    from rootsweep import TableStore, archive

    inp = write_tables(spark, f"{scratch}/in", base_rows())
    archive(spark, MICRO, "A", inp, f"{scratch}/out", stamp_session=True)
    notes = {r["note"] for r in TableStore(spark, inp, f"{scratch}/out").audit.log().collect()}
    assert len(notes) == 1 and notes.pop().startswith("database=default; user=")


def test_command_line(spark, scratch, capsys):
    import json

    from rootsweep.__main__ import main

    out = f"{scratch}/cli"
    assert main(["archive", "--csv", "NATION_1,NATION_7", "--input", SF001, "--output", out],
                spark=spark) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["status"] == "SUCCESS" and res["moved"]["lineitem"] == 319
    assert res["seconds"]["run"] > 0 and "move:lineitem" in res["seconds"]
    assert "keys:documents" in res["seconds"]
    assert main(["dry-run", "--csv", "NATION_1,NATION_7", "--input", SF001, "--output", out],
                spark=spark) == 0
    assert main(["runs", "--output", out], spark=spark) == 0
    assert main(["reach", "--root", "nation"], spark=spark) == 0
    assert main(["purge", "--output", out, "--runs", "1"], spark=spark) == 0
    assert Audit(spark, out).runs().count() == 0
