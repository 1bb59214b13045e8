"""Every registered query against its DuckDB oracle (sf0.001), plus the
expected row counts of the planning table and split invariants."""

from __future__ import annotations

import random

import pytest
from conftest import SF001
from oracle_check import compare, duck
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from rootsweep.functions.expr import fingerprint_aggs, row_hash
from rootsweep.operators.closure import close_lazy
from rootsweep.operators.joins import anti, flag, semi
from rootsweep.plans.manifest import TPCH
from rootsweep.plans.queries import registry
from rootsweep.sources.tables import TableStore

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, queries()[name], oracle_sql().get(name), SF001)
    assert r["ok"] is not False, r


def test_every_query_has_an_oracle():
    assert set(registry()) <= set(oracle_sql())  # of the reference's operators
    assert set(oracle_sql()) <= set(queries())


def test_entry_flagship(spark):
    df = entry(spark)
    assert df.count() == 319
    assert df.columns == spark.read.parquet(f"{SF001}/lineitem.parquet").columns


def test_expected_counts_sf0001(spark):
    q = queries()
    want = {"archive_customer": 9, "retain_customer": 141, "archive_orders": 80,
            "archive_lineitem": 319, "retain_lineitem": 5681, "archive_events": 0,
            "archive_supplier": 0, "archive_region": 2, "archive_nation": 2,
            "audit_log": 5, "orphans_region": 8, "archive_labels": 8, "key_violations": 1365}
    for name, n in want.items():
        assert q[name](spark, SF001).count() == n, name


def test_fingerprint_equal(spark):
    """Parts add up to the table's rows and content (the source read by itself)."""
    for r in queries()["fingerprint"](spark, SF001).collect():
        t = spark.read.parquet(f"{SF001}/{r['table_name']}.parquet")
        exact = [f.name for f in t.schema.fields if f.dataType.simpleString() in ("int", "bigint", "string")]
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in exact])
        whole = t.agg(F.count("*"), F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"))).first()
        assert (r["rows"], r["archived_sum"] + r["retained_sum"]) == tuple(whole)
        assert r["archived_rows"] + r["retained_rows"] == r["rows"]


def test_gate_fails_when_a_join_multiplies_rows(spark, monkeypatch):
    """The gate's counts come from independent joins: a flag join that repeats a row shows."""
    from rootsweep.plans import queries as Q

    good = Q.flag
    monkeypatch.setattr(Q, "flag", lambda *a, **k: good(*a, **k).unionAll(good(*a, **k)))
    rows = {r["table_name"]: r["ok"] for r in Q.validate_counts(spark, SF001).collect()}
    assert not rows["lineitem"] and not rows["customer"]


def test_gate_fails_when_a_join_drops_rows(spark, monkeypatch):
    """Rows of the table are counted without the joins: a row that both of them lose shows."""
    from rootsweep.plans import queries as Q

    good = Q.flag
    monkeypatch.setattr(Q, "flag", lambda df, column, *a, **k: good(df, column, *a, **k).where(f"{column} % 2 = 0"))
    rows = {r["table_name"]: r["ok"] for r in Q.validate_counts(spark, SF001).collect()}
    assert not rows["lineitem"] and not rows["customer"]


def test_fingerprint_is_the_sum_of_row_hashes(spark):
    """Put together from bigint sums (no decimal per row), null positions told apart."""
    rows = [(1, None), (None, 1), (5, 7), (5, 7), (-3, None), (None, None)]
    t = spark.createDataFrame(rows, "a bigint, b bigint")
    hashes = [r[0] for r in t.select(row_hash(t.schema)).collect()]
    found = t.agg(*fingerprint_aggs(t.schema))
    assert tuple(found.first()) == (6, sum(hashes)) and len(set(hashes)) == 5
    assert tuple(t.where("false").agg(*fingerprint_aggs(t.schema)).first()) == (0, 0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast(xxhash64" not in plan


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_invariants_random_lists(spark, seed):
    """archived + retained = source as multisets; archived all hit the key set;
    retained none; flag agrees with semi/anti."""
    rnd = random.Random(seed)
    names = [f"NATION_{i}" for i in rnd.sample(range(25), rnd.randint(1, 6))]
    csv = ",".join(names)
    store = TableStore(spark, SF001)
    keys = close_lazy(TPCH, store.read_input, csv)
    for mv in TPCH.moves:
        t = store.read_input(mv.table)
        k = keys[mv.keyset]
        a, r = semi(t, mv.column, k), anti(t, mv.column, k)
        src = t.agg(*fingerprint_aggs(t.schema)).first()
        both = a.unionByName(r).agg(*fingerprint_aggs(t.schema)).first()
        assert tuple(src) == tuple(both), mv.table
        assert anti(a, mv.column, k).count() == 0
        assert semi(r, mv.column, k).count() == 0
        f = flag(t, mv.column, k)
        assert f.filter("archived").count() == a.count()
