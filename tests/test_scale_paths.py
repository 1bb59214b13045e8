"""The paths a large cluster takes: key sets above the broadcast bound (shuffle
joins) and a hot foreign-key value holding a third of all rows."""

from __future__ import annotations

import contextlib

from conftest import SF001
from pyspark.sql import functions as F

from rootsweep import TPCH, TableStore, archive
from rootsweep.operators.joins import Keys, anti, flag, semi


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
SKEW = {
    **NO_BROADCAST,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
}


def test_shuffle_path_run_equals_broadcast_run(spark, scratch):
    csv = "NATION_1,NATION_7"
    a = archive(spark, TPCH, csv, SF001, f"{scratch}/bc")
    with conf(spark, **NO_BROADCAST):
        b = archive(spark, TPCH, csv, SF001, f"{scratch}/sh", max_broadcast_bytes=0)
    assert [(c.table, c.rows_copied, c.rows_deleted) for c in a.counts] == \
           [(c.table, c.rows_copied, c.rows_deleted) for c in b.counts]
    sa, sb = TableStore(spark, SF001, f"{scratch}/bc"), TableStore(spark, SF001, f"{scratch}/sh")
    for mv in TPCH.moves:
        assert sa.main(mv.table).exceptAll(sb.main(mv.table)).count() == 0


def _skewed(spark, root):
    n = 90_000
    big = spark.range(n).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 3000).alias("doc_id"),
        (F.col("id") * 3).alias("payload"))
    big.write.parquet(f"{root}/big")
    spark.range(0, 3000, 2).write.parquet(f"{root}/keys")
    return spark.read.parquet(f"{root}/big"), spark.read.parquet(f"{root}/keys")


def test_hot_key_is_split_by_aqe_and_results_are_exact(spark, scratch):
    big, keys = _skewed(spark, scratch)
    k = Keys("docs", keys, rows=1500, distinct=True, size=48_000)
    with conf(spark, **SKEW):
        df = flag(big, "doc_id", k, max_bytes=0).groupBy("archived").count()
        got = {r["archived"]: r["count"] for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan().toString()
        s, a = semi(big, "doc_id", k, 0).count(), anti(big, "doc_id", k, 0).count()
    # ids 0,2,...: even doc ids are keys; doc 7 (a third of all rows) is not
    want_true = big.filter((F.col("doc_id") % 2 == 0)).count()
    assert got == {True: want_true, False: 90_000 - want_true}
    assert (s, a) == (want_true, 90_000 - want_true)
    assert "skew=true" in plan


def test_broadcast_only_with_known_small_count(spark):
    small = Keys("k", spark.range(10), rows=10, size=320)
    unknown = Keys("k", spark.range(10))
    big = Keys("k", spark.range(10), rows=10, size=320)
    t = spark.range(100).select(F.col("id").alias("fk"))
    with conf(spark, **NO_BROADCAST):
        assert "BroadcastHashJoin" in semi(t, "fk", small)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in semi(t, "fk", unknown)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in semi(t, "fk", big, max_bytes=50)._jdf.queryExecution().executedPlan().toString()


def test_sparse_hits_archived_part_is_compacted(spark, scratch):
    """Many split tasks with few hits each: the archived part is rewritten into
    one file before publishing; counts and content are unchanged."""
    from rootsweep import Archiver

    inp = f"{scratch}/in"
    for t in ("nation", "region", "customer", "supplier", "orders", "events"):
        spark.read.parquet(f"{SF001}/{t}.parquet").write.parquet(f"{inp}/{t}")
    spark.read.parquet(f"{SF001}/lineitem.parquet").repartition(16).write.parquet(f"{inp}/lineitem")
    out = f"{scratch}/out"
    arch = Archiver(spark, TPCH, inp, out, compact_min_files=4, verify="content")
    r = arch.run("NATION_1,NATION_7")
    s = TableStore(spark, inp, out)
    cdir = s.compact_dir("lineitem", r.run_id)
    assert s.part_dir("lineitem", r.run_id, True) == cdir
    from rootsweep.sources import fs
    assert fs.files(spark, cdir)[0] == 1
    assert s.archive("lineitem").count() == 319
    plain = spark.read.parquet(s.split_part_dir("lineitem", r.run_id, True))
    assert s.archive("lineitem").drop("__rs_run").exceptAll(plain).count() == 0


def test_shuffle_start_is_raised_for_large_inputs(spark, scratch):
    from rootsweep import Archiver
    from rootsweep.plans import run as runmod

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with conf(spark, **{key: "8"}):
        old = runmod.SHUFFLE_PARTITION_BYTES
        runmod.SHUFFLE_PARTITION_BYTES = 1024  # pretend the inputs are large
        try:
            arch = Archiver(spark, TPCH, SF001, f"{scratch}/o")
            arch._size_shuffles(arch.store.snapshot(TPCH.tables(), {}))
            assert int(spark.conf.get(key)) > 8
        finally:
            runmod.SHUFFLE_PARTITION_BYTES = old


def test_log_by_project_lines_add_up(spark, scratch):
    """Per-project log lines: down key sets carry their root; for each moved
    table the project lines sum to the table line; shared parents (region) get
    the table line only; compaction flags survive next to project lines."""
    from rootsweep import Archiver

    inp = f"{scratch}/in"
    for t in ("nation", "region", "customer", "supplier", "orders", "events"):
        spark.read.parquet(f"{SF001}/{t}.parquet").write.parquet(f"{inp}/{t}")
    spark.read.parquet(f"{SF001}/lineitem.parquet").repartition(16).write.parquet(f"{inp}/lineitem")
    out = f"{scratch}/out"
    r = Archiver(spark, TPCH, inp, out, log_by_project=True, compact_min_files=4,
                 input_layout="folder").run("NATION_1,NATION_7")
    s = TableStore(spark, inp, out, input_layout="folder")
    log = s.audit.log().collect()
    table_lines = {x["table_name"]: x["rows_copied"] for x in log}
    per = {}
    for x in s.audit.project_log().collect():
        per.setdefault(x["table_name"], {})[x["project_name"]] = x["rows_copied"]
    assert per["customer"] == {"NATION_1": 6, "NATION_7": 3}
    for t, n in table_lines.items():
        if t != "region":
            assert sum(per[t].values()) == n, t
    assert "region" not in per
    # the lineitem archive was compacted; readers still find it
    assert s.part_dir("lineitem", r.run_id, True) == s.compact_dir("lineitem", r.run_id)
    assert s.archive("lineitem").count() == table_lines["lineitem"] == 319
