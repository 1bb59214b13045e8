"""The archival run on hand-made micro tables (FIXTURES.md §2, cases M1-M19)."""

from __future__ import annotations

import pytest
from conftest import MICRO, ids
from pyspark.sql import functions as F

from rootsweep import Archiver, Hooks, TableStore, archive
from rootsweep.operators.select import unmatched_names
from rootsweep.operators.validate import CountMismatch, KeyViolation


def run(spark, inp, out, csv, **kw):
    return archive(spark, MICRO, csv, inp, out, parallelism=kw.pop("parallelism", 4),
                   input_layout="folder", **kw)


def store(spark, inp, out):
    return TableStore(spark, inp, out, input_layout="folder")


def test_m1_one_of_two_projects(spark, micro, scratch):
    inp, out = micro(), f"{scratch}/out"
    r = run(spark, inp, out, "A", verify="content")
    assert r.status == "SUCCESS"
    s = store(spark, inp, out)
    assert ids(s.main("project")) == {2}
    assert ids(s.archive("project")) == {1}
    assert ids(s.main("encounter")) == {200}
    assert ids(s.archive("encounter")) == {100, 101}
    assert ids(s.main("code_map")) == {8000}
    assert ids(s.archive("client")) == {10}
    assert ids(s.archive("client_cfg")) == {900}
    log = s.audit.log().orderBy("id").collect()
    assert [x["table_name"] for x in log] == [m.table for m in MICRO.moves]
    assert all(x["rows_copied"] == x["rows_deleted"] == x["rows_in_main"] for x in log)


def test_m2_null_fk_is_retained(spark, micro, scratch):
    inp, out = micro(encounter=[(100, 1), (101, 1), (200, 2), (9, None)]), f"{scratch}/out"
    run(spark, inp, out, "A")
    assert 9 in ids(store(spark, inp, out).main("encounter"))


def test_m3_same_name_twice_both_move(spark, micro, scratch):
    inp = micro(project=[(1, "A", 10), (2, "B", 20), (3, "A", 10)])
    out = f"{scratch}/out"
    r = run(spark, inp, out, "A")
    assert r.keys["projects"] == 2
    assert ids(store(spark, inp, out).archive("project")) == {1, 3}


def test_m4_space_after_comma(spark, micro, scratch):
    inp, out = micro(), f"{scratch}/out"
    r = run(spark, inp, out, "A, B")
    assert r.keys["projects"] == 1
    project = spark.read.parquet(f"{inp}/project")
    assert [x["name"] for x in unmatched_names(project, "name", "A, B").collect()] == [" B"]


def test_m5_name_holding_a_comma(spark, micro, scratch):
    inp = micro(project=[(1, "A,B", 10), (2, "B", 20)])
    r = run(spark, inp, f"{scratch}/out", "A,B")
    assert r.keys["projects"] == 1  # only 'B'; 'A,B' can never match


def test_m6_letter_case(spark, micro, scratch):
    inp = micro(project=[(1, "a", 10), (2, "B", 20)])
    assert run(spark, inp, f"{scratch}/o1", "A").keys["projects"] == 0
    assert run(spark, inp, f"{scratch}/o2", "A", collation="UTF8_LCASE").keys["projects"] == 1


@pytest.mark.parametrize("csv", ["", None])
def test_m7_empty_or_null_list(spark, micro, scratch, csv):
    inp = micro(project=[(1, "", 10), (2, None, 20)])
    r = run(spark, inp, f"{scratch}/out", csv)
    assert r.status == "SUCCESS" and r.keys["projects"] == 0


def test_m8_no_match(spark, micro, scratch):
    inp, out = micro(), f"{scratch}/out"
    r = run(spark, inp, out, "ZZZ")
    s = store(spark, inp, out)
    assert r.status == "SUCCESS"
    assert s.audit.log().count() == 0
    assert s.main("project").count() == 2 and s.archive("project") is None


def test_m9_shared_client(spark, micro, scratch):
    inp = micro(project=[(1, "A", 7), (2, "B", 7)], client=[(7,)], client_cfg=[(900, 7)])
    s1 = store(spark, inp, f"{scratch}/any")
    run(spark, inp, f"{scratch}/any", "A")
    assert ids(s1.archive("client")) == {7} and ids(s1.archive("client_cfg")) == {900}
    # B is left pointing at an archived client: the orphan report finds it
    (line,) = s1.audit.log().where("table_name = 'project'").collect()
    assert line["note"] == "1 rows orphaned by client_id"
    # exclusive mode keeps a client that still owns live projects
    s2 = store(spark, inp, f"{scratch}/excl")
    r = run(spark, inp, f"{scratch}/excl", "A", clients="exclusive")
    assert r.keys["clients"] == 0 and s2.archive("client") is None
    assert ids(s2.main("client_cfg")) == {900}


def test_m10_null_client(spark, micro, scratch):
    inp, out = micro(project=[(1, "A", 10), (4, "D", None)]), f"{scratch}/out"
    r = run(spark, inp, out, "D")
    assert r.keys == {**r.keys, "projects": 1, "clients": 0}
    assert ids(store(spark, inp, out).archive("project")) == {4}


def test_m11_deep_chain_all_levels(spark, micro, scratch):
    inp, out = micro(), f"{scratch}/out"
    run(spark, inp, out, "B")
    s = store(spark, inp, out)
    for t, want in [("project", {2}), ("encounter", {200}), ("document", {2000}),
                    ("code", {6000}), ("code_map", {8000})]:
        assert ids(s.archive(t)) == want, t


def test_m12_second_run_moves_nothing(spark, micro, scratch):
    inp, out = micro(), f"{scratch}/out"
    run(spark, inp, out, "A")
    before = store(spark, inp, out).audit.log().count()
    r = run(spark, inp, out, "A")
    assert r.status == "SUCCESS" and all(c.rows_copied == 0 for c in r.counts)
    assert store(spark, inp, out).audit.log().count() == before


def test_m13_duplicate_key_fails(spark, micro, scratch):
    inp = micro(document=[(1000, 100), (1000, 101), (2000, 200)])
    out = f"{scratch}/out"
    with pytest.raises(KeyViolation):
        run(spark, inp, out, "A")
    runs = store(spark, inp, out).audit.runs().collect()
    assert runs[0]["status"] == "FAILED" and "documents" in runs[0]["error_message"]


@pytest.mark.parametrize("k", [0, 3, 6])
def test_m14_failure_in_step_k_leaves_everything(spark, micro, scratch, k):
    inp, out = micro(), f"{scratch}/out"
    bad = MICRO.moves[k].table

    def boom(table):
        if table == bad:
            raise RuntimeError("injected")

    with pytest.raises(RuntimeError, match="injected"):
        run(spark, inp, out, "A", hooks=Hooks(before_move=boom))
    s = store(spark, inp, out)
    (row,) = s.audit.runs().collect()
    assert row["status"] == "FAILED"
    assert f"processing table `{bad}`" in row["error_message"]
    assert s.audit.log().count() == 0
    for mv in MICRO.moves:
        assert s.archive(mv.table) is None
        assert s.main(mv.table).count() == spark.read.parquet(f"{inp}/{mv.table}").count()


def test_m15_count_mismatch_fails(spark, micro, scratch):
    inp, out = micro(), f"{scratch}/out"

    def tamper(c):
        if c.table == "document":
            from dataclasses import replace
            return replace(c, rows_deleted=c.rows_deleted + 1)
        return c

    with pytest.raises(CountMismatch, match="Count mismatch"):
        run(spark, inp, out, "A", hooks=Hooks(counts=tamper))
    (row,) = store(spark, inp, out).audit.runs().collect()
    assert row["status"] == "FAILED" and "Count mismatch" in row["error_message"]
    assert "`document`" in row["error_message"]


def test_m16_archive_collision(spark, micro, scratch):
    inp, out = micro(), f"{scratch}/out"
    run(spark, inp, out, "A")
    # someone restores project 1 into main by hand: its id is still archived
    s = store(spark, inp, out)
    v = s.version("project")
    restored = f"{scratch}/restored"
    (s.main("project").unionByName(s.archive("project").drop("__rs_run"))
     .write.parquet(restored))
    inp2 = f"{scratch}/in2"
    for t in ("client", "encounter", "document", "code", "code_map", "client_cfg"):
        s.main(t).write.parquet(f"{inp2}/{t}")
    spark.read.parquet(restored).write.parquet(f"{inp2}/project")
    # point a fresh run at the same output (archive) but the restored input
    arch = Archiver(spark, MICRO, inp2, out, input_layout="folder")
    arch.store.snapshot = lambda tables, published=None: {t: arch.store.version(t, {}) for t in tables}
    with pytest.raises(Exception, match="already holds"):
        arch.run("A")
    assert v.run_id == 1


def test_m17_schema_differs(spark, micro, scratch):
    inp, out = micro(), f"{scratch}/out"
    run(spark, inp, out, "A")
    inp2 = f"{scratch}/in2"
    s = store(spark, inp, out)
    for t in ("client", "project", "encounter", "document", "code", "client_cfg"):
        s.main(t).write.parquet(f"{inp2}/{t}")
    s.main("code_map").select("code_id", "id").write.parquet(f"{inp2}/code_map")  # swapped
    arch = Archiver(spark, MICRO, inp2, out, input_layout="folder")
    arch.store.snapshot = lambda tables, published=None: {t: arch.store.version(t, {}) for t in tables}
    with pytest.raises(Exception, match="differs from its archive"):
        arch.run("B")
    runs = {r["run_id"]: r for r in s.audit.runs().collect()}
    assert runs[2]["status"] == "FAILED" and "code_map" in runs[2]["error_message"]


def test_m18_all_rows_move(spark, micro, scratch):
    inp, out = micro(), f"{scratch}/out"
    run(spark, inp, out, "A,B")
    s = store(spark, inp, out)
    main = s.main("encounter")
    assert main.count() == 0
    assert main.schema == spark.read.parquet(f"{inp}/encounter").schema


def test_m19_purge_run_drops_its_log(spark, micro, scratch):
    inp, out = micro(), f"{scratch}/out"
    run(spark, inp, out, "A")
    run(spark, inp, out, "B")
    s = store(spark, inp, out)
    assert {r["run_id"] for r in s.audit.log().collect()} == {1, 2}
    s.audit.purge([1])
    assert {r["run_id"] for r in s.audit.runs().collect()} == {2}
    assert {r["run_id"] for r in s.audit.log().collect()} == {2}
    # purging history does not un-archive data
    assert ids(s.archive("project")) == {1, 2}


def test_sequential_runs_equal_one_batched_run(spark, micro, scratch):
    inp = micro()
    run(spark, inp, f"{scratch}/seq", "A")
    run(spark, inp, f"{scratch}/seq", "B")
    run(spark, inp, f"{scratch}/one", "A,B")
    a, b = store(spark, inp, f"{scratch}/seq"), store(spark, inp, f"{scratch}/one")
    for mv in MICRO.moves:
        assert ids(a.archive(mv.table)) == ids(b.archive(mv.table)), mv.table
        assert a.main(mv.table).count() == b.main(mv.table).count() == 0


def test_log_empty_option(spark, micro, scratch):
    inp, out = micro(client=[(10,), (20,)], client_cfg=[(901, 20)]), f"{scratch}/out"
    run(spark, inp, out, "A", log_empty=True)
    log = {r["table_name"]: r["rows_copied"] for r in store(spark, inp, out).audit.log().collect()}
    assert log["client_cfg"] == 0 and len(log) == len(MICRO.moves)


def test_serial_and_parallel_agree(spark, micro, scratch):
    inp = micro()
    r1 = run(spark, inp, f"{scratch}/p1", "A", parallelism=1)
    r8 = run(spark, inp, f"{scratch}/p8", "A", parallelism=8)
    assert [(c.table, c.rows_copied) for c in r1.counts] == [(c.table, c.rows_copied) for c in r8.counts]


def test_key_sets_are_kept_as_evidence(spark, micro, scratch):
    inp, out = micro(), f"{scratch}/out"
    r = run(spark, inp, out, "A")
    s = store(spark, inp, out)
    got = spark.read.parquet(s.keys_dir(r.run_id, "documents")).select("id")
    assert ids(got) == {1000, 1001}
    assert got.filter(F.col("id").isNull()).count() == 0


def test_abandoned_only_by_command(spark, micro, scratch):
    inp, out = micro(), f"{scratch}/out"
    s = store(spark, inp, out)
    rid, _ = s.audit.open_run("A")  # a driver that died right after opening

    from rootsweep.sources.audit import ConcurrentRun
    with pytest.raises(ConcurrentRun):  # however old it is
        run(spark, inp, out, "A")
    s.audit.abandon(rid)
    with pytest.raises(ValueError, match="not RUNNING"):
        s.audit.abandon(rid)
    run(spark, inp, out, "A")
    runs = {r["run_id"]: r for r in s.audit.runs().collect()}
    assert runs[rid]["status"] == "FAILED" and "abandoned" in runs[rid]["error_message"]
    assert runs[rid + 1]["status"] == "SUCCESS"


def test_abandoned_run_that_lives_publishes_nothing_and_loses_no_row(spark, micro, scratch):
    """Run 1 is abandoned while it works, run 2 archives B meanwhile; run 1 then
    ends: it raises, and every row is either in main or in the archive."""
    from rootsweep.sources.audit import RunAbandoned

    inp, out = micro(), f"{scratch}/out"
    s = store(spark, inp, out)

    def meanwhile(table):
        if table == "code_map":
            s.audit.abandon(1)
            run(spark, inp, out, "B", parallelism=1)

    with pytest.raises(RunAbandoned):
        run(spark, inp, out, "A", parallelism=1, hooks=Hooks(before_move=meanwhile))
    s = store(spark, inp, out)
    assert {r["run_id"]: r["status"] for r in s.audit.runs().collect()} == {1: "FAILED", 2: "SUCCESS"}
    assert ids(s.main("project")) == {1} and ids(s.archive("project")) == {2}
    assert ids(s.main("code_map")) == {7000, 7001} and ids(s.archive("code_map")) == {8000}


def test_late_success_of_an_abandoned_run_raises(spark, micro, scratch):
    """Abandoned between its last look and its SUCCESS row: found right after."""
    from rootsweep.sources.audit import RunAbandoned

    inp, out = micro(), f"{scratch}/out"
    arch = Archiver(spark, MICRO, inp, out, input_layout="folder")
    close = arch.audit.close_run

    def late(run_id, *rest):
        arch.audit.close_run = close
        arch.audit.abandon(run_id)
        close(run_id, *rest)

    arch.audit.close_run = late
    with pytest.raises(RunAbandoned):
        arch.run("A")
    s = store(spark, inp, out)
    assert s.archive("project") is None and ids(s.main("project")) == {1, 2}


def test_columns_named_like_ours(spark, scratch):
    """Columns run_id, archived and one with a dot pass unchanged; only the archive's
    private names are refused."""
    from rootsweep.operators.validate import SchemaMismatch
    from rootsweep.plans.manifest import KeySet, Manifest, Move

    m = Manifest(name="odd", keysets=(KeySet("roots", "root", name_col="name"),),
                 moves=(Move("child", "root_id", "roots", pk="a.b"), Move("root", "id", "roots", pk="id")))
    inp = f"{scratch}/in"
    spark.createDataFrame([(1, "A"), (2, "B")], "id bigint, name string").write.parquet(f"{inp}/root")
    rows = [(1, 111, True, 5, {"k": 1}), (2, 222, False, 6, {"k": 2}), (1, 333, None, 7, None)]
    spark.createDataFrame(rows, "root_id bigint, run_id bigint, archived boolean, `a.b` bigint, m map<string,int>").write.parquet(f"{inp}/child")
    for csv in ("A", "B"):
        archive(spark, m, csv, inp, f"{scratch}/out", input_layout="folder", verify="content")
    s = store(spark, inp, f"{scratch}/out")
    got = {(r["root_id"], r["run_id"], r["archived"], r["a.b"], r["__rs_run"]) for r in s.archive("child").collect()}
    assert got == {(1, 111, True, 5, 1), (1, 333, None, 7, 1), (2, 222, False, 6, 2)}
    assert s.main("child").count() == 0
    bad = f"{scratch}/bad"
    spark.createDataFrame([(1, "A")], "id bigint, name string").write.parquet(f"{bad}/root")
    spark.createDataFrame([(1, 9)], "root_id bigint, __rs_part bigint").write.parquet(f"{bad}/child")
    with pytest.raises(SchemaMismatch):
        archive(spark, Manifest(name="bad", keysets=m.keysets, moves=(Move("child", "root_id", "roots"), m.moves[1])),
                "A", bad, f"{scratch}/out2", input_layout="folder")


def test_only_files_with_hits_are_rewritten(spark, micro, scratch):
    """Hits in one of four files: the others stay where they are, twice in a row."""
    inp, out = f"{scratch}/in", f"{scratch}/out"
    from conftest import base_rows, write_tables
    rows = base_rows()
    rows.pop("code_map")
    write_tables(spark, inp, rows)
    all_ids = set()
    for k in range(4):
        part = [(7000 + 10 * k + i, [5000, 6000, 9999, 9999][k]) for i in range(5)]
        all_ids |= {p[0] for p in part}
        extra = [(7900 + k, 9999)]
        all_ids.add(7900 + k)
        spark.createDataFrame(part + extra, "id bigint, code_id bigint").coalesce(1).write.mode("append").parquet(f"{inp}/code_map")
    s = store(spark, inp, out)
    run(spark, inp, out, "A", verify="content")
    assert spark.read.parquet(s.replaced_dir("code_map", 1)).count() == 1
    assert ids(spark.read.parquet(s.split_part_dir("code_map", 1, False))) == {7900}
    gone = ids(s.archive("code_map"))
    assert gone == {7000 + i for i in range(5)} and ids(s.main("code_map")) == all_ids - gone
    run(spark, inp, out, "B", verify="content")
    s = store(spark, inp, out)
    assert spark.read.parquet(s.replaced_dir("code_map", 2)).count() == 1
    gone = ids(s.archive("code_map"))
    assert len(gone) == 10 and ids(s.main("code_map")) == all_ids - gone
    assert s.main("code_map").count() == len(all_ids) - 10


def test_missing_input_table_names_it(spark, micro, scratch):
    from conftest import base_rows, write_tables
    rows = base_rows()
    rows.pop("code_map")
    inp = write_tables(spark, f"{scratch}/partial", rows)
    with pytest.raises(FileNotFoundError, match="code_map"):
        run(spark, inp, f"{scratch}/out", "A")
    (row,) = store(spark, inp, f"{scratch}/out").audit.runs().collect()
    assert row["status"] == "FAILED" and "code_map" in row["error_message"]


def test_failed_outranks_a_late_success(spark, micro, scratch):
    """A run written off as abandoned that later closes SUCCESS stays unpublished."""
    inp, out = micro(), f"{scratch}/out"
    s = store(spark, inp, out)
    s.audit.ensure()
    rid, started = s.audit.open_run("A")
    s.audit.close_run(rid, "A", started, "FAILED", "abandoned")
    s.audit.close_run(rid, "A", started, "SUCCESS")
    (row,) = s.audit.runs().collect()
    assert row["status"] == "FAILED"
