"""N-gram join, vector join, line dedup and components against brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from llm_helpers import DOCS, SF001, docs, extra, none, rows, same, space_words, union_find  # noqa: F401
from pyspark.sql import functions as F

from rootsweep.llm import line_dedup as P
from rootsweep.llm import ngram_blocks as B
from rootsweep.llm import ngram_join as N
from rootsweep.llm import vector_join as V
from rootsweep.llm.common import components


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (5, 5), (None, 3), (300, None)]
    edges += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(70)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "x bigint, y bigint")).collect()}
    links = [(a, b) for a, b in edges if a is not None and b is not None]
    want = union_find({n for e in links for n in e}, links)
    assert got == {n: c for n, c in want.items() if n != c}
    assert components(spark.createDataFrame([], "x bigint, y bigint")).collect() == []


def _sets(rows):
    out = []
    for i, t in rows:
        w = space_words(t)
        out.append((i, {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())))
    return out


def brute_components(rows):
    sets = _sets(rows)
    links = []
    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            links.append((a, b))
    root = union_find(range(len(sets)), links)
    low: dict = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[root[k]] = min(low.get(root[k], i), i)
    return [(i, len(s), low.get(root[k]) if s else i) for k, (i, s) in enumerate(sets)]


def _copies(seed=2):
    """Groups of near copies of several degrees, with shared passages and frequent shingles."""
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, out = text(30), []
    for g in range(8):
        base = text(rng.choice([12, 40, 90]))
        for _ in range(rng.choice([1, 3, 25])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            out.append(w)
    big = text(60)
    for _ in range(60):  # one large group, its shingles of the frequent class
        w = list(big)
        w[rng.randrange(60)] = rng.choice(vocab)
        out.append(w)
    out += [passage + text(rng.choice([2, 8, 30])) for _ in range(50)] + [text(3), text(1), []] * 2
    rng.shuffle(out)
    return [(10 * k, " ".join(w)) for k, w in enumerate(out)]


@pytest.mark.parametrize(("frequent", "block"), [(2, 8 * B.NODE), (32, B.BLOCK)])
def test_ngram_components_equal_brute_force(spark, rows, frequent, block, monkeypatch):
    all_rows = _copies() + rows
    df = spark.createDataFrame(all_rows, DOCS)
    monkeypatch.setattr(N, "FREQUENT", frequent)
    monkeypatch.setattr(B, "BLOCK", block)
    got = N.ngram_components(extra(df), part_bytes=20_000)
    assert same(got.collect(), brute_components(all_rows))


def test_overlaps_and_forests_equal_plain_loops(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(B, "COLUMNS", 7)
    weight = rng.integers(1, 9, 60)
    xs, ys = ([np.sort(rng.choice(60, k, replace=False)).astype(np.uint64) for k in rng.integers(0, 40, m)] for m in (9, 12))
    got = B.overlaps(xs, [weight[x.astype(int)] for x in xs], ys)
    assert (got == [[sum(weight[int(v)] for v in set(x) & set(y)) for y in ys] for x in xs]).all()
    assert (B.overlaps(xs, None, ys) == [[len(set(x) & set(y)) for y in ys] for x in xs]).all()
    assert B.overlaps([xs[0][:0]], None, [ys[0][:0]]).tolist() == [[0]]
    a, b = rng.integers(0, 50, (2, 40))
    keep = B.forest(a, b, 50)
    links = list(zip(a.tolist(), b.tolist(), strict=True))
    assert union_find(range(50), [links[k] for k in keep]) == union_find(range(50), links)
    assert len(keep) == 50 - len(set(union_find(range(50), links).values()))


def test_ngram_components_of_nothing(none, spark):
    assert N.ngram_components(none).collect() == []
    assert same(N.ngram_components(spark.createDataFrame([(1, None), (2, " ")], DOCS)).collect(), [(1, 0, 1), (2, 0, 2)])


def brute_vectors(rows, cosine=0.95):
    unit = []
    for i, v in rows:
        ok = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.zeros(8)
        if ok:
            x[:len(v)] = np.array(v, float) / np.linalg.norm(np.array(v, float))
        unit.append(x if ok else None)
    links, count = [], [0] * len(rows)
    for a, b in itertools.combinations(range(len(rows)), 2):
        if unit[a] is not None and unit[b] is not None and unit[a] @ unit[b] >= cosine:
            links.append((a, b))
            count[a] += 1
            count[b] += 1
    root = union_find(range(len(rows)), links)
    low: dict = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root[k]] = min(low.get(root[k], i), i)
    return [(i, count[k], low.get(root[k]), i is None or low[root[k]] == i) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("block", [48, 4096])
def test_vector_join_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(V, "LEAF", 4)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    v = [list(map(float, np.float32(centres[k % 12] + rng.normal(size=8) * [0.02, 0.15, 0.4][k % 3]))) for k in range(160)]
    v += [v[0]] * 40 + [[2 * x for x in v[1]], [1e-30] * 8, None, [], [0.0] * 8, [1.0, None], [float("nan")] * 8, [float("inf")] + [0.0] * 7, [1.0, 0.5]]
    rows = [(3 * k, x) for k, x in enumerate(v)] + [(3, v[1]), (None, v[2])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("label", F.lit(1)).withColumn("node", F.lit("x"))
    stored = [(r.vec_id, r.embedding) for r in df.collect()]
    assert same(V.near_duplicates(df, block=block).collect(), brute_vectors(stored))


def test_vector_join_of_nothing(spark):
    ddl = "vec_id bigint, embedding array<float>"
    assert V.near_duplicates(spark.createDataFrame([], ddl)).collect() == []
    assert same(V.near_duplicates(spark.createDataFrame([(1, None), (2, [0.0])], ddl)).collect(), [(1, 0, 1, True), (2, 0, 2, True)])


def brute_lines(df, percent=75):
    """Lines that go, by comparing every two distinct lines' sets."""
    lines = [(r.doc_id, no, line) for r in df.collect() if r.text is not None for no, raw in enumerate(r.text.split("\n")) if (line := raw.strip(" ").lower())]
    lines = [(*x, s) for x, s in zip(lines, char_sets([x[2] for x in lines]), strict=True)]
    reps: dict = {}
    links = [(reps.setdefault(x[2], k), k) for k, x in enumerate(lines)]
    inv: dict = {}
    for k in reps.values():
        for s in lines[k][3]:
            inv.setdefault(s, []).append(k)
    for a, b in {p for v in inv.values() for p in itertools.combinations(v, 2)}:
        x, y = lines[a][3], lines[b][3]
        if 100 * len(x & y) >= percent * len(x | y):
            links.append((a, b))
    root = union_find(range(len(lines)), [(a, b) for a, b in links if a != b])
    first: dict = {}
    for k, x in enumerate(lines):
        first[root[k]] = min(first.get(root[k], x[:2]), x[:2])
    return {x[:2] for k, x in enumerate(lines) if first[root[k]] != x[:2]}, len(lines)


def test_line_dedup_recall_and_precision(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    gone, n = brute_lines(df)
    text = {r.doc_id: r.text for r in df.collect()}
    got = P.dedup_lines(df).collect()
    kept = {r.doc_id: r.text for r in got}
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in text.items()}
    assert sum(r.n_lines for r in got) == n
    assert sum(kept[i] != want[i] for i in text) <= len(text) * 0.02
    assert abs(sum(r.n_removed for r in got) - len(gone)) <= 0.02 * len(gone)


def test_line_dedup_cases(spark):
    a = "the quick brown fox jumps over the lazy dog and runs far away from here today"
    rows = [(1, f"{a}\n\nsomething wholly different stands here, of its own\n日本語のテキストが続く長い行"), (2, f"  {a.upper()}  \nunique words only in this second line of text"),
            (3, f"{a.replace('here', 'there')}\n{a}\n  "), (4, None), (5, ""), (6, "!!!"), (7, "!!!\n日本語のテキストが続く長い行。"), (None, a), (8, "x"), (8, "x")]
    df = spark.createDataFrame(rows, DOCS)
    got = {(r.doc_id, r.n_lines, r.n_removed, r.text) for r in P.dedup_lines(extra(df)).select("doc_id", "n_lines", "n_removed", "text").collect()}
    assert got == {(None, 1, 0, a), (1, 3, 1, rows[0][1].split("\n", 1)[1]), (2, 2, 1, rows[1][1].split("\n")[1]), (3, 2, 2, "  "),
                   (4, 0, 0, None), (5, 0, 0, ""), (6, 1, 0, "!!!"), (7, 2, 2, ""), (8, 1, 0, "x")}
    assert P.dedup_lines(df.where("false")).collect() == []
    assert set(P.dedup_lines(extra(df)).columns) == {*extra(df).columns, "n_lines", "n_removed"}
    plan = P.dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def char_sets(lines, width=8):
    """Shingles from every character, in plain Python."""
    return [frozenset(x[k:k + width] for k in range(max(1, len(x) - width + 1))) for x in lines]


def brute_dedup(lines, percent=75):
    """The distinct lines that stay, by comparing every two of them."""
    sets = char_sets(lines)
    links = [(a, b) for a, b in itertools.combinations(range(len(lines)), 2)
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = union_find(range(len(lines)), links)
    return [x for k, x in enumerate(lines) if k == min(j for j in root if root[j] == root[k])]


def test_line_shingles_cover_every_character(spark):
    lines = ["https://example.com/a", "a b", "tab\tseparated\tvalues 1", "日本語のテキストが続く長い行", "sm\U0001f600le \U0001f600\U0001f600 wörter über alles", "12345678", "123456789"]
    got = {r.line: set(r.set) for r in P._with_shingles(spark.createDataFrame([(x,) for x in lines], "line string"), P.SHINGLE).collect()}
    for x, want in zip(lines, char_sets(lines), strict=True):
        hashed = spark.createDataFrame([(s,) for s in want], "s string").select(F.xxhash64(F.encode("s", "UTF-32")))
        assert got[x] == {r[0] for r in hashed.collect()}


def test_lines_without_spaces_are_compared_whole(spark):
    rng = random.Random(10)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    lines = ["https://example.com/a", "https://another.org/b"] + [f"https://{word(12)}.com/{word(20)}" for _ in range(20)]
    lines += ["iVBORw0K" + word(60) for _ in range(10)] + [f"2024-01-{k:02d}\t{word(9)}\t{word(9)}" for k in range(10, 20)]
    lines += [x[:30] + "zz" + x[30:] for x in lines[22:32:3]]  # near copies, with the rest moved
    got = P.dedup_lines(spark.createDataFrame(list(enumerate(lines)), DOCS)).where("n_removed = 0").collect()
    assert sorted(r.text for r in got) == sorted(brute_dedup(lines))
    assert 42 <= len(got) < len(lines)


def test_similar_lines_between_dissimilar_ones_are_found(spark):
    """Lines of one template, pairwise below the threshold, with planted pairs above it."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    template = word(200)
    lines = [template + word(36) for _ in range(150)]
    lines += [x[:216] + word(20) for x in lines[:40]]
    got = P.dedup_lines(spark.createDataFrame(list(enumerate(lines)), DOCS)).where("n_removed = 0").collect()
    want = brute_dedup(lines)
    assert len(want) == 150
    assert len(want) <= len(got) <= len(want) + 1  # a pair in twenty near the threshold may share no band


def test_only_bands_with_unpaired_lines_go_to_blocks(spark, monkeypatch):
    """The first pairs settle bands of up to three lines; components are found twice at most."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    lines = [head + word(40) for head in (word(60) for _ in range(20)) for _ in range(3)]
    lines += [x + word(12) for x in lines[:12]]  # bands of four and more, in several components
    calls, sizes, blocks, found = [], [], P._by_blocks.__globals__["_block_links"], P.components
    monkeypatch.setattr(P, "components", lambda e: calls.append(1) or found(e))
    monkeypatch.setattr(P, "_block_links", lambda left, *a: sizes.extend(r["count"] for r in left.groupBy("band").count().collect()) or blocks(left, *a))
    got = P.dedup_lines(spark.createDataFrame(list(enumerate(lines)), DOCS)).where("n_removed = 0").collect()
    assert sorted(r.text for r in got) == sorted(brute_dedup(lines))
    assert sizes and min(sizes) > P.PAIRED == 3 and len(calls) <= 2


@pytest.mark.parametrize("block", [1, 7, 128])
def test_blocks_link_what_the_pairs_of_a_band_link(spark, monkeypatch, block):
    """All lines in two bands, each its own component: every similar pair once."""
    monkeypatch.setattr(P, "BLOCK", block)
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefghij klmnop") for _ in range(120))
    lines = [base[:100 - k] + "".join(rng.choice("xyzw") for _ in range(4)) for k in range(25)]
    left = spark.createDataFrame([(b, k, len(s), k) for k, s in enumerate(char_sets(lines)) for b in (10, 20)], "band bigint, key bigint, n int, component bigint")
    texts = spark.createDataFrame(list(enumerate(lines)), "key bigint, line string")
    sets = char_sets(lines)
    want = {(a, b) for a, b in itertools.combinations(range(25), 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    got = [tuple(r) for r in P._by_blocks(left, texts, 75, P.SHINGLE).collect()]
    assert len(got) == len(want) > 20 and set(got) == want
    assert P._by_blocks(left.withColumn("component", F.lit(1)), texts, 75, P.SHINGLE).count() == 0


@pytest.mark.parametrize("percent", [75, 90])
def test_marks_rule_out_only_lines_below_the_threshold(spark, percent):
    """Few pairs of one template are left for the sets, every similar pair among them."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghijk lmnopqrstuvwxyz") for _ in range(n))
    template = word(200)
    lines = [template + word(60) for _ in range(40)] + ["ab" * 90, "ab" * 90 + "c", "日本語のテキスト" * 3 + "が続く", "x", "12345678"]
    lines += [x[:k] + word(3) + x[k:] for x in lines[:8] for k in (30, 120, 240)]  # near copies
    lines += [x + x[:99] for x in lines[:4]]  # shingles that repeat
    sets = char_sets(lines)
    marked = P._marked(spark.createDataFrame(list(enumerate(lines)), "key bigint, line string"), P.SHINGLE)
    assert {r.key: r["size"] for r in marked.collect()} == {k: len(s) for k, s in enumerate(sets)}
    a, b = (marked.toDF(f"{x}_key", f"{x}_size", f"{x}_marks") for x in "ab")
    left = {tuple(r) for r in a.join(b, F.col("a_key") < F.col("b_key")).where(P._may_reach(percent, "a_", "b_")).select("a_key", "b_key").collect()}
    pairs = list(itertools.combinations(range(len(lines)), 2))
    want = {(x, y) for x, y in pairs if 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])}
    assert want <= left and len(want) > 10
    assert len(left - want) < len(pairs) / 20


def test_signatures_by_rows_are_the_smallest_hashes(spark):
    """Every line's bands, also where too few hashes are below the bound and no shuffle gathers them."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghijk lmnopqrstuvwxyz") for _ in range(n))
    lines = [word(n) + "z" for n in (*range(0, 45), 200, 400, 3000) for _ in range(3)]
    lines += ["x" * 500, "ab" * 300, "abc" * 200 + "d", (word(14) + "z") * 40, "日本語のテキストが続く" * 9 + "行", "\U0001f600" * 60, "ΑΣ wörter İ " * 12 + "ΟΔΟΣ"]
    rows = [(k, "\n\n".join(lines[k:k + 5])) for k in range(0, len(lines), 5)]
    df = spark.createDataFrame([*rows, rows[3], rows[3], (None, rows[-1][1]), (None, None), (900, " \n ")], DOCS)
    got = {(r.id, r.no): r.bands for r in P._signed(df, P.SHINGLE, P.KEEP, "doc_id", "text").collect()}
    flat = [(i, no, x.strip(" ").lower()) for i, t in {*rows, (None, rows[-1][1])} for no, x in enumerate(t.split("\n")) if x]
    low = P._with_shingles(spark.createDataFrame(flat, "id bigint, no int, line string"), P.SHINGLE).withColumn("low", F.slice("set", 1, P.KEEP))
    want = {(r.id, r.no): r.bands for r in low.withColumn("bands", F.expr(P._BANDS)).collect()}
    assert got == want and len(want) == len(lines) + len(rows[-1][1].split("\n\n"))
    assert want[(rows[-1][0], 0)] and P._signed(df.where("false"), P.SHINGLE, P.KEEP, "doc_id", "text").collect() == []
