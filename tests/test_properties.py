"""Random small cascades against a brute-force Python oracle."""

from __future__ import annotations

from conftest import MICRO, MICRO_DDL
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rootsweep.operators.closure import close_lazy
from rootsweep.operators.joins import anti, semi
from rootsweep.operators.select import select_roots

NAMES = ["A", "B", "C", "a", "A,B", ""]


@st.composite
def cascades(draw):
    n_clients = draw(st.integers(1, 3))
    clients = list(range(10, 10 + n_clients))
    n_proj = draw(st.integers(1, 5))
    projects = [(i, draw(st.sampled_from(NAMES)), draw(st.sampled_from(clients + [None])))
                for i in range(1, n_proj + 1)]
    pids = [p[0] for p in projects] + [None, 99]

    def children(parent_ids, start, n):
        return [(start + i, draw(st.sampled_from(parent_ids))) for i in range(n)]

    enc = children(pids, 100, draw(st.integers(0, 8)))
    doc = children([e[0] for e in enc] + [None], 1000, draw(st.integers(0, 10)))
    code = children([d[0] for d in doc] + [None], 5000, draw(st.integers(0, 10)))
    cmap = children([c[0] for c in code] + [None], 7000, draw(st.integers(0, 10)))
    cfg = children(clients + [None], 900, draw(st.integers(0, 4)))
    csv = ",".join(draw(st.lists(st.sampled_from(["A", "B", "C", "Z", " B"]), max_size=3)))
    rows = {"client": [(c,) for c in clients], "project": projects, "encounter": enc,
            "document": doc, "code": code, "code_map": cmap, "client_cfg": cfg}
    return rows, csv


def oracle(rows, csv):
    items = csv.split(",") if csv else []
    proj = {p[0] for p in rows["project"] if p[1] is not None and "," not in p[1] and p[1] in items}
    clients = {p[2] for p in rows["project"] if p[0] in proj and p[2] is not None}
    enc = {e[0] for e in rows["encounter"] if e[1] in proj}
    doc = {d[0] for d in rows["document"] if d[1] in enc}
    code = {c[0] for c in rows["code"] if c[1] in doc}
    keysets = {"projects": proj, "clients": clients, "encounters": enc, "documents": doc, "codes": code}
    moved = {}
    for mv in MICRO.moves:
        idx = {"id": 0}.get(mv.column, 1)
        moved[mv.table] = {r[0] for r in rows[mv.table]
                           if r[idx] is not None and r[idx] in keysets[mv.keyset]}
    return keysets, moved


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(cascades())
def test_closure_and_split_match_brute_force(spark, case):
    rows, csv = case
    frames = {t: spark.createDataFrame(r, MICRO_DDL[t]) for t, r in rows.items()}
    keys = close_lazy(MICRO, frames.__getitem__, csv)
    want_keys, want_moved = oracle(rows, csv)
    for name, want in want_keys.items():
        assert {r["id"] for r in keys[name].df.collect()} == want, name
    for mv in MICRO.moves:
        t = frames[mv.table]
        got_a = {r["id"] for r in semi(t, mv.column, keys[mv.keyset]).collect()}
        got_r = {r["id"] for r in anti(t, mv.column, keys[mv.keyset]).collect()}
        assert got_a == want_moved[mv.table], mv.table
        assert got_r == {r[0] for r in rows[mv.table]} - want_moved[mv.table], mv.table


def test_long_name_list_uses_semi_join_with_same_result(spark):
    rows = [(i, f"P{i}", None) for i in range(200)]
    df = spark.createDataFrame(rows, MICRO_DDL["project"])
    ks = MICRO.keyset("projects")
    long_csv = ",".join([f"P{i}" for i in range(0, 200, 2)] + ["nope", "p4"])
    got = {r["id"] for r in select_roots(df, ks, long_csv).collect()}
    assert got == set(range(0, 200, 2))
    plan = select_roots(df, ks, long_csv)._jdf.queryExecution().executedPlan().toString()
    assert "find_in_set" not in plan
    short = {r["id"] for r in select_roots(df, ks, "P1,P3").collect()}
    assert short == {1, 3}
