"""The physical plans the README promises, read from ``explain("formatted")``."""

from __future__ import annotations

import contextlib
import io

from conftest import SF01

from __spark_entry__ import queries


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_closure_scans_are_pruned_and_filtered(spark):
    p = plan(queries()["keys_documents"](spark, SF01))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in p
    assert "IsNotNull(o_custkey)" in p and "IsNotNull(c_nationkey)" in p
    assert "split(NATION_1,NATION_7" in p.replace(", ", ",") or "Generate" in p or "LocalTableScan" in p  # the list is data


def test_split_is_a_broadcast_outer_join_without_a_lineitem_shuffle(spark):
    p = plan(queries()["split_lineitem"](spark, SF01))
    assert "BroadcastHashJoin" in p and "LeftOuter" in p
    assert "hashpartitioning(l_orderkey" not in p  # the big side is never shuffled
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint" in p  # t.* of lineitem


def test_archive_chain_is_semi_joins(spark):
    p = plan(queries()["archive_lineitem"](spark, SF01))
    assert p.count("LeftSemi") >= 3
    assert "hashpartitioning(l_orderkey" not in p
