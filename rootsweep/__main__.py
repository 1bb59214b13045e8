"""Command line: ``spark-submit -m rootsweep <command> ...`` or
``python -m rootsweep <command> ...`` (uses the session the launcher provides).

  archive  --manifest tpch --csv NATION_1,NATION_7 --input IN --output OUT [options]
  dry-run  --manifest tpch --csv ... --input IN [--output OUT]
  purge    --output OUT --runs 3,4
  runs     --output OUT            (audit: runs and log lines)
  abandon  --output OUT --run 5    (declare a RUNNING run FAILED: its driver is lost)
  reach    --manifest tpch --root nation
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .operators.closure import close_lazy
from .operators.report import dry_run_counts
from .plans.graph import coverage, edges_frame
from .plans.manifest import MANIFESTS
from .plans.run import Archiver
from .sources.audit import Audit
from .sources.tables import TableStore


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rootsweep")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("archive", help="one archival run")
    a.add_argument("--manifest", default="tpch", choices=sorted(MANIFESTS))
    a.add_argument("--csv", required=True, help="comma-separated root names (FIND_IN_SET rules)")
    a.add_argument("--input", required=True)
    a.add_argument("--output", required=True)
    a.add_argument("--clients", default="any", choices=["any", "exclusive"])
    a.add_argument("--collation", default=None, help="e.g. UTF8_LCASE")
    a.add_argument("--verify", default="counts", choices=["counts", "content"])
    a.add_argument("--parallelism", type=int, default=4)
    a.add_argument("--log-empty", action="store_true")
    a.add_argument("--max-broadcast-bytes", type=int, default=None)
    d = sub.add_parser("dry-run", help="rows each move would archive; nothing written")
    d.add_argument("--manifest", default="tpch", choices=sorted(MANIFESTS))
    d.add_argument("--csv", required=True)
    d.add_argument("--input", required=True)
    d.add_argument("--output", default=None, help="read current versions from this output root")
    u = sub.add_parser("purge", help="delete runs and their log lines from the audit views")
    u.add_argument("--output", required=True)
    u.add_argument("--runs", required=True, help="comma-separated run ids")
    r = sub.add_parser("runs", help="show the audit trail")
    r.add_argument("--output", required=True)
    v = sub.add_parser("abandon", help="declare a RUNNING run FAILED, as its driver is lost")
    v.add_argument("--output", required=True)
    v.add_argument("--run", required=True, type=int)
    g = sub.add_parser("reach", help="tables under a root, depth, moved or not")
    g.add_argument("--manifest", default="tpch", choices=sorted(MANIFESTS))
    g.add_argument("--root", required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("rootsweep").getOrCreate()
    if args.cmd == "archive":
        opts = dict(clients=args.clients, collation=args.collation, verify=args.verify,
                    parallelism=args.parallelism, log_empty=args.log_empty)
        if args.max_broadcast_bytes is not None:
            opts["max_broadcast_bytes"] = args.max_broadcast_bytes
        r = Archiver(spark, MANIFESTS[args.manifest], args.input, args.output, **opts).run(args.csv)
        print(json.dumps({"run_id": r.run_id, "status": r.status, "keys": r.keys,
                          "moved": {c.table: c.rows_copied for c in r.counts},
                          "seconds": r.seconds}))
    elif args.cmd == "dry-run":
        m = MANIFESTS[args.manifest]
        store = TableStore(spark, args.input, args.output)
        read = store.reader(store.snapshot(m.tables())) if args.output else store.read_input
        dry_run_counts(m, read, close_lazy(m, read, args.csv)).orderBy("step").show(len(m.moves), False)
    elif args.cmd == "purge":
        Audit(spark, args.output).purge([int(x) for x in args.runs.split(",") if x.strip()])
    elif args.cmd == "runs":
        a = Audit(spark, args.output)
        a.runs().orderBy("run_id").show(truncate=False)
        a.log().orderBy("id").show(truncate=False)
    elif args.cmd == "abandon":
        Audit(spark, args.output).abandon(args.run)
    elif args.cmd == "reach":
        m = MANIFESTS[args.manifest]
        coverage(spark, edges_frame(spark, m.edges()), args.root,
                 [mv.table for mv in m.moves]).orderBy("depth", "table_name").show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
