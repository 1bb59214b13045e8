"""Guards that read little: collisions by Bloom filter, orphans by range, changes by
bucket; dry runs by root; the audit trail as one query."""

from __future__ import annotations

from conftest import MICRO, ids, write_tables
from pyspark.sql import functions as F
from test_versions import files_read

from rootsweep import Archiver, TableStore
from rootsweep.operators.closure import close_lazy
from rootsweep.operators.joins import Keys
from rootsweep.operators.report import dry_run_by_roots
from rootsweep.operators.validate import LISTED, bucket_fingerprints, collisions, locate_changes, orphans


def rows_read(df) -> int:
    df.collect()
    leaves, n = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        n += leaves.apply(i).metrics().get("numOutputRows").get().value()
    return n


def test_collision_guard_reads_row_groups_that_may_hold_a_new_key(spark, scratch):
    """Two past runs with interleaved keys: a range alone prunes nothing."""
    for run in range(2):
        (spark.range(20_000).select((F.col("id") * 4 + run).alias("id"), F.lit("x").alias("v")).coalesce(1).write
         .option("parquet.bloom.filter.enabled#id", "true").parquet(f"{scratch}/archive/__rs_run={run + 1}"))
    old = spark.read.parquet(f"{scratch}/archive")
    absent = spark.createDataFrame([(4 * i + 2,) for i in (10, 5000, 19_990)], "id bigint")
    found = collisions(absent, "id", old)
    assert rows_read(found) == 0  # no row group can hold one
    one = collisions(absent.union(spark.createDataFrame([(41,)], "id bigint")), "id", old)
    assert rows_read(one) == 20_000 and ids(one) == {41}  # that of run 2 only
    many = spark.range(100_000, 100_000 + LISTED + 5)
    found = collisions(many, "id", old)
    assert found.count() == 0 and "GreaterThanOrEqual(id,100000)" in found._jdf.queryExecution().executedPlan().toString()
    want = {i for i in range(LISTED + 5) if i % 4 in (0, 1)}
    assert ids(collisions(spark.range(LISTED + 5), "id", old)) == want
    assert collisions(absent, "id", None) is None and collisions(absent.limit(0), "id", old).count() == 0


def test_orphans_read_the_range_of_new_parents(spark, scratch):
    for f in range(4):
        spark.range(100 * f, 100 * f + 100).select("id", F.col("id").alias("p"), F.lit(None).cast("bigint").alias("q")).coalesce(1).write.mode("append").parquet(f"{scratch}/child")
    child = spark.read.parquet(f"{scratch}/child")
    keys = Keys("k", spark.createDataFrame([(110,), (120,)], "id bigint"), rows=2, distinct=True, size=80, low=110, high=120)
    out = orphans(child, [("p", keys)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(p,110), LessThanOrEqual(p,120)" in plan
    assert {r["child_col"]: r["orphan_rows"] for r in out.collect()} == {"p": 2}
    both = orphans(child, [("p", keys), ("q", Keys("k2", keys.df, rows=2, distinct=True, size=80, low=110, high=120))])
    assert {r["child_col"]: r["orphan_rows"] for r in both.collect()} == {"p": 2, "q": 0}


def test_no_child_is_read_whose_parents_archived_nothing(spark, micro, scratch):
    inp = micro()
    arch = Archiver(spark, MICRO, inp, f"{scratch}/out", input_layout="folder")
    versions = arch.store.snapshot(MICRO.tables(), {})
    read = []
    real = arch.store.read_version
    none = {ks.name: Keys(ks.name, spark.createDataFrame([], "id bigint"), rows=0, distinct=True, size=0) for ks in MICRO.keysets}
    arch.store.read_version = lambda v, *a, **k: read.append(v.table) or real(v, *a, **k)
    assert arch._orphans(versions, none) == {} and read == []
    some = none | {"clients": Keys("clients", spark.createDataFrame([(10,)], "id bigint"), rows=1, distinct=True, size=40, low=10, high=10)}
    assert arch._orphans(versions, some) == {("project", "client_id"): 1} and "code" not in read


def test_one_changed_value_is_found_in_its_bucket(spark):
    before = spark.range(5000).select("id", (F.col("id") % 7).alias("v"), F.lit(1.5).alias("d"))
    after = before.withColumn("v", F.when(F.col("id") == 1234, 99).otherwise(F.col("v")))
    a, b = ({r["bucket"]: tuple(r) for r in bucket_fingerprints(t, "id", 64).collect()} for t in (before, after))
    assert len(a) == 64 and sum(a[k] != b[k] for k in a) == 1
    got = {(r["side"], r["id"], r["v"], r["n"]) for r in locate_changes(before, after, "id", 64).collect()}
    assert got == {("before", 1234, 1234 % 7, 1), ("after", 1234, 99, 1)}
    assert locate_changes(before, before, "id") is None
    twice = before.union(before.where("id = 5"))
    assert [(r["side"], r["id"], r["n"]) for r in locate_changes(before, twice, "id").collect()] == [("after", 5, 1)]
    lost = {(r["side"], r["id"]) for r in locate_changes(before, before.where("id <> 77"), "id").collect()}
    assert lost == {("before", 77)}


def test_dry_run_by_roots_counts_shared_parents_for_each(spark, scratch):
    rows = {"client": [(7,), (8,)], "project": [(1, "A", 7), (2, "B", 7), (3, "C", None)],
            "encounter": [(100, 1), (101, 1), (200, 2), (300, None)], "document": [(1000, 100), (2000, 200)], "code": [(5000, 1000)],
            "code_map": [(7000, 5000), (7001, 5000), (7002, None)], "client_cfg": [(900, 7), (901, 8)]}
    read = lambda t: spark.read.parquet(f"{write_root}/{t}")
    write_root = write_tables(spark, f"{scratch}/in", rows)
    got = {(r["table_name"], r["root_name"]): r["rows_to_move"] for r in dry_run_by_roots(MICRO, read, close_lazy(MICRO, read, "A,B,C")).collect()}
    assert got == {("code_map", "A"): 2, ("code", "A"): 1, ("document", "A"): 1, ("document", "B"): 1, ("encounter", "A"): 2, ("encounter", "B"): 1,
                   ("client_cfg", "A"): 1, ("client_cfg", "B"): 1, ("client", "A"): 1, ("client", "B"): 1,
                   ("project", "A"): 1, ("project", "B"): 1, ("project", "C"): 1}


def test_trail_hides_purged_runs_and_keeps_runs_without_lines(spark, scratch):
    audit = TableStore(spark, scratch, f"{scratch}/out").audit
    audit.ensure()
    line = dict(rows_in_main=2, rows_copied=2, rows_deleted=2)
    for csv, status, tables in (("A", "SUCCESS", ["t", "u"]), ("B", "SUCCESS", ["t"]), ("C", "FAILED", ["t"]), ("D", "SUCCESS", [])):
        rid, started = audit.open_run(csv)
        audit.write_log(rid, [dict(table_name=t, **line) for t in tables])
        audit.close_run(rid, csv, started, status, "why" if status == "FAILED" else None)
    audit.purge([1])
    got = {(r["run_id"], r["status"], r["table_name"], r["error_message"]) for r in audit.trail().collect()}
    assert got == {(2, "SUCCESS", "t", None), (3, "FAILED", None, "why"), (4, "SUCCESS", None, None)}


def test_files_read_counts(spark, scratch):
    spark.range(10).repartition(3).write.parquet(f"{scratch}/t")
    assert files_read(spark.read.parquet(f"{scratch}/t")) == 3
