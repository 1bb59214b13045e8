"""The reference schema's 73-step manifest: shape, and a run over generated
key-only tables (FIXTURES.md §3); reachability with a self-referencing edge."""

from __future__ import annotations

from collections import Counter

from rootsweep import REFERENCE, TPCH, TableStore, archive
from rootsweep.plans.graph import edges_frame, fk_reach
from rootsweep.plans.manifest import DOCS, Edge


def test_reference_manifest_shape():
    REFERENCE.check()
    assert len(REFERENCE.moves) == 73
    assert len(REFERENCE.keysets) == 13
    assert len({m.table for m in REFERENCE.moves}) == 73
    per_set = Counter(m.keyset for m in REFERENCE.moves)
    assert per_set == {"encounters": 15, "documents": 11, "cm_codes": 11, "projects": 10,
                       "document_codes": 7, "encounter_dos": 6, "clients": 4, "discussions": 2,
                       "claim_details": 2, "compliance_gaps": 2, "document_evidence": 1,
                       "document_dos": 1, "configurations": 1}
    # the four roots come last, in this order
    assert [m.table for m in REFERENCE.moves[-4:]] == ["document_mst", "encounter_mst",
                                                      "client_mst", "project_mst"]
    # every key set's own table is moved
    moved = {m.table for m in REFERENCE.moves}
    assert all(ks.table in moved for ks in REFERENCE.keysets)


def test_driver_manifests_check():
    TPCH.check()
    DOCS.check()
    assert len(TPCH.edges()) == 8


def _generated_tables(spark, root: str):
    """Two projects, one client each, 3 children per parent row, for all 73."""
    ent: dict[str, list[tuple]] = {}
    next_id = [1]

    def new_id():
        next_id[0] += 1
        return next_id[0]

    clients = [(new_id(),), (new_id(),)]
    projects = [(new_id(), f"P{i}", clients[i][0]) for i in range(2)]
    ent["client_mst"] = clients
    ent["project_mst"] = projects
    cols = {"client_mst": "id bigint", "project_mst": "id bigint, name string, client_id bigint"}
    # entity ids per key set name, to hang children from
    by_set = {"projects": [p[0] for p in projects], "clients": [c[0] for c in clients]}
    for ks in REFERENCE.keysets:
        if ks.kind != "down":
            continue
        rows = [(new_id(), pid) for pid in by_set[ks.parent] for _ in range(3)]
        ent[ks.table] = rows
        cols[ks.table] = f"id bigint, {ks.fk} bigint"
        by_set[ks.name] = [r[0] for r in rows]
    for mv in REFERENCE.moves:
        if mv.table in ent:
            continue
        ent[mv.table] = [(new_id(), pid) for pid in by_set[mv.keyset] for _ in range(3)]
        cols[mv.table] = f"id bigint, {mv.column} bigint"
    for t, rows in ent.items():
        spark.createDataFrame(rows, cols[t]).coalesce(1).write.parquet(f"{root}/{t}")
    return ent


def test_reference_manifest_runs_on_generated_tables(spark, scratch):
    inp, out = f"{scratch}/in", f"{scratch}/out"
    ent = _generated_tables(spark, inp)
    r = archive(spark, REFERENCE, "P0", inp, out, parallelism=8)
    assert r.status == "SUCCESS"
    log = TableStore(spark, inp, out).audit.log().orderBy("id").collect()
    assert [x["table_name"] for x in log] == [m.table for m in REFERENCE.moves]
    for x in log:
        assert x["rows_copied"] * 2 == len(ent[x["table_name"]]), x["table_name"]
        assert x["rows_copied"] == x["rows_deleted"] == x["rows_in_main"]


def test_fk_reach_depths(spark):
    reach = {r["table_name"]: r["depth"]
             for r in fk_reach(spark, edges_frame(spark, TPCH.edges()), "nation").collect()}
    assert reach == {"nation": 0, "customer": 1, "supplier": 1, "orders": 2, "events": 2, "lineitem": 3}


def test_fk_reach_with_cycles(spark):
    """A self-edge does not deepen anything; a table on a cycle is reported as such."""
    ddl = "child_table string, child_col string, parent_table string, parent_col string"
    rows = [("emp", "boss", "emp", "id")] + [(f"t{i}", "e", "emp", "id") for i in range(120)]
    reach = {r["table_name"]: (r["depth"], r["in_cycle"]) for r in fk_reach(spark, spark.createDataFrame(rows, ddl), "emp").collect()}
    assert reach["emp"] == (0, True) and len(reach) == 121
    assert all(v == (1, False) for k, v in reach.items() if k != "emp")
    loop = [("b", "x", "a", "id"), ("a", "y", "b", "id"), ("c", "z", "b", "id")]
    reach = {r["table_name"]: (r["depth"], r["in_cycle"]) for r in fk_reach(spark, spark.createDataFrame(loop, ddl), "a").collect()}
    assert reach == {"a": (0, True), "b": (1, True), "c": (2, False)}


def test_docs_family_run_moves_whole_texts(spark, scratch):
    from pyspark.sql import functions as F

    from conftest import SF001

    out = f"{scratch}/docs"
    r = archive(spark, DOCS, "src0,src7", SF001, out, verify="content")
    assert r.status == "SUCCESS"
    s = TableStore(spark, SF001, out)
    src = spark.read.parquet(f"{SF001}/documents.parquet")
    chosen = src.filter(F.col("source").isin("src0", "src7"))
    moved = s.archive("documents").drop("__rs_run")
    assert moved.exceptAll(chosen).count() == 0 and chosen.exceptAll(moved).count() == 0
    assert s.main("documents").count() + moved.count() == src.count()
    assert {x["table_name"] for x in s.audit.log().collect()} == {"labels", "documents"}
