"""A split task that dies on its first attempt (as on a lost executor) is
retried; the run still succeeds with exact counts and a clean archive. Runs in
its own process: task retries need a ``local[N,maxFailures]`` master."""

from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

SCRIPT = r'''
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from pyspark import TaskContext
from rootsweep import TPCH, Archiver, Hooks, TableStore

spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")

marker = sys.argv[3] + ".failed"


@F.udf("boolean")
def die_once(x):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        open(marker, "w").close()  # evidence that the attempt died
        raise RuntimeError("simulated executor loss")
    return True

def wrap(table, df):
    return df.filter(die_once(F.col(df.columns[0]))) if table == "lineitem" else df

sf, out = sys.argv[2], sys.argv[3]
r = Archiver(spark, TPCH, sf, out, hooks=Hooks(split=wrap), verify="content").run("NATION_1,NATION_7")
s = TableStore(spark, sf, out)
print(json.dumps({"status": r.status,
                  "lineitem": [(c.rows_before, c.rows_in_main, c.rows_copied, c.rows_deleted)
                               for c in r.counts if c.table == "lineitem"][0],
                  "archive": s.archive("lineitem").count(), "main": s.main("lineitem").count()}))
'''


def test_split_survives_a_failed_task_attempt(tmp_path):
    res = subprocess.run([sys.executable, "-c", SCRIPT, str(REPO), "/root/testdata/sf0.001",
                          str(tmp_path / "out")], capture_output=True, text=True, timeout=600)
    line = [x for x in res.stdout.splitlines() if x.startswith("{")]
    assert line, res.stderr[-3000:]
    got = json.loads(line[-1])
    assert got["status"] == "SUCCESS"
    assert got["lineitem"] == [6000, 319, 319, 319]
    assert got["archive"] == 319 and got["main"] == 5681
    assert (tmp_path / "out.failed").exists()  # the first attempt really failed
