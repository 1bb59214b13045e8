"""Published versions: the same through any spelling of the roots, never of a changed
input, opened file by file; run ids are claimed once."""

from __future__ import annotations

import os
import shutil
import threading

import pytest
from conftest import ids
from pyspark.sql import functions as F

from rootsweep import TableStore, archive
from rootsweep.operators.joins import Keys, flag
from rootsweep.plans.manifest import KeySet, Manifest, Move
from rootsweep.sources import fs
from rootsweep.sources.audit import Audit, ConcurrentRun
from rootsweep.sources.tables import StaleBase

M = Manifest(name="flat", keysets=(KeySet("roots", "root", name_col="name"),),
             moves=(Move("child", "root_id", "roots", pk="id"), Move("root", "id", "roots", pk="id")))


def tables(spark, inp: str) -> str:
    """64 children in 8 files; those of root 1 (A) fill files 0 and 1, half of file 2."""
    spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id bigint, name string").coalesce(1).write.parquet(f"{inp}/root")
    for f in range(8):
        rows = [(8 * f + i, 1 if 8 * f + i < 20 else 2 if f == 5 else 3) for i in range(8)]
        spark.createDataFrame(rows, "id bigint, root_id bigint").coalesce(1).write.mode("append").parquet(f"{inp}/child")
    return inp


def run(spark, inp, out, csv):
    return archive(spark, M, csv, inp, out, input_layout="folder", parallelism=2)


def files_read(df) -> int:
    """Files that the scans of an executed plan opened."""
    df.collect()
    leaves, n = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numFiles")
        n += metric.get().value() if metric.isDefined() else 0
    return n


def test_same_version_through_a_link_and_only_untouched_files_are_opened(spark, scratch):
    inp, out = tables(spark, f"{scratch}/a b"), f"{scratch}/out"
    assert run(spark, inp, out, "A").status == "SUCCESS"
    os.symlink(inp, f"{scratch}/alias")
    os.symlink(out, f"{scratch}/alias-out")
    for i, o in ((inp, out), (f"{scratch}/alias", out), (f"file://{scratch}/alias", f"{scratch}/alias-out"), (f"{scratch}/x/../alias", out)):
        s = TableStore(spark, i, o, "folder")
        assert ids(s.main("child")) == set(range(20, 64)) and s.main("child").count() == 44, i
    v = s.version("child")
    assert len(v.gone) == 3
    whole = s.read_version(v)
    # five files that were not replaced, and the retained part
    parts = len([n for n in os.listdir(s.split_part_dir("child", 1, False)) if n.endswith(".parquet")])
    assert files_read(whole) == 5 + parts
    # a run through the link finds nothing of A any more, and stacks for B
    r = run(spark, f"{scratch}/alias", out, "A,B")
    assert {c.table: c.rows_copied for c in r.counts} == {"child": 8, "root": 1}
    s = TableStore(spark, inp, out, "folder")
    assert ids(s.main("child")) == set(range(20, 64)) - set(range(40, 48)) and s.archive("child").count() == 28
    assert spark.read.parquet(s.replaced_dir("child", 2)).count() == 1


def test_split_opens_the_touched_files(spark, scratch):
    inp = tables(spark, f"{scratch}/in")
    s = TableStore(spark, inp, f"{scratch}/out", "folder")
    v = s.version("child")
    keys = Keys("k", spark.createDataFrame([(2,)], "id bigint"), rows=1, distinct=True, size=40)
    whole = s.read_version(v, with_file=True)
    names = [r[0] for r in whole.where("root_id = 2").select("__rs_file.name").distinct().collect()]
    assert len(names) == 1 and files_read(whole) == 8
    split = flag(s.read_version(v, files=names), "root_id", keys)
    assert files_read(s.read_version(v, files=names)) == 1 and split.where("archived").count() == 8


def test_missing_or_changed_base_raises(spark, scratch):
    inp, out = tables(spark, f"{scratch}/in"), f"{scratch}/out"
    run(spark, inp, out, "A")
    copy = shutil.copytree(inp, f"{scratch}/copy", copy_function=shutil.copyfile)  # new times
    for f in (p for p in os.listdir(f"{copy}/child") if p.endswith(".parquet")):
        os.utime(f"{copy}/child/{f}", (1, 1))
    with pytest.raises(StaleBase, match="changed"):
        TableStore(spark, copy, out, "folder").main("child")
    assert TableStore(spark, copy, out, "folder", check_times=False).main("child").count() == 44
    gone = spark.read.parquet(f"{out}/replaced/__rs_run=1/table=child").first()["path"]
    shutil.copyfile(f"{inp}/{gone}", f"{scratch}/kept")
    with open(f"{copy}/{gone}", "ab") as fh:
        fh.write(b"x")
    with pytest.raises(StaleBase, match="changed"):
        TableStore(spark, copy, out, "folder", check_times=False).main("child")
    fresh = f"{scratch}/fresh"
    shutil.copytree(inp, fresh, ignore=lambda d, names: [n for n in names if n in (os.path.basename(gone), f".{os.path.basename(gone)}.crc")])
    with pytest.raises(StaleBase, match="missing"):
        run(spark, fresh, out, "B")
    last = TableStore(spark, inp, out, "folder").audit.runs().orderBy(F.desc("run_id")).first()
    assert last["status"] == "FAILED" and "StaleBase" in last["error_message"]


def test_two_openers_at_once(spark, scratch):
    audit = Audit(spark, f"{scratch}/out")
    audit.ensure()
    gate, got = threading.Barrier(2), []
    seen = fs.claim

    def together(*args):
        gate.wait(60)  # both have looked, neither has written
        return seen(*args)

    def go():
        try:
            got.append(Audit(spark, f"{scratch}/out").open_run("A")[0])
        except ConcurrentRun as exc:
            got.append(str(exc))

    fs.claim = together
    try:
        threads = [threading.Thread(target=go) for _ in range(2)]
        [t.start() for t in threads]
        [t.join() for t in threads]
    finally:
        fs.claim = seen
    assert sorted(map(type, got), key=str) == [int, str] and 1 in got
    assert spark.read.parquet(audit.run_path).count() == 1
    audit.abandon(1)
    # a driver that died between its claim and its row blocks until it is abandoned
    assert fs.claim(spark, f"{audit.claims_path}/2", "lost")
    with pytest.raises(ConcurrentRun, match="being opened"):
        audit.open_run("A")
    audit.abandon(2)
    assert audit.open_run("A")[0] == 3
