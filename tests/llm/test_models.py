"""WARC round trips, packing and the Katz model against brute force; the pipeline."""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import DOCS, SF001, docs, extra, none, rows, same, space_words  # noqa: F401
from pyspark.sql import functions as F

from rootsweep.llm import katz as K
from rootsweep.llm import packing as P
from rootsweep.llm import warc as W

WORDS = public_tokenizers.path("word_bpe_49k.json")
PAGES = [(5, "http://a/x y\r\nWARC-Type: no", "<p>é</p>"), (3, "http://b/é", "<p>é</p>"), (9, None, "<p>é</p>"), (4, "u", None), (2, "u", ""),
         (7, "v", "a\r\n\r\nb\r\n\r\n"), (8, "v", "x" * 200_000), (3, "http://b", "<p>é</p>"), (None, "n", "only"), (1, "n", "only")]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_warc_round_trip(spark, min_bytes):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("size", F.lit(1)).withColumn("row", F.lit("r"))
    archive = W.write(pages.repartition(3), min_bytes)
    assert archive.payloads.count() == len({p[2] or "" for p in PAGES})
    got = W.parse(W.records(archive)).collect()
    want, first = [], {}
    for i, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        first.setdefault(html or "", i)
    seen = set()
    for i, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        b = (html or "").encode()
        again = len(b) >= min_bytes and html in seen if html else len(b) >= min_bytes and "" in seen
        seen.add(html or "")
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", first[html or ""] if again else None))
    assert same([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], want)
    full = Counter((r.page_id, bytes(r.payload).decode()) for r in W.originals(archive).collect())
    assert full == Counter((i, html or "") for i, _, html in PAGES)
    assert same(W.archived_pages(pages, min_bytes).drop("read_back").collect(), want)


def test_warc_bytes_and_damage(spark):
    pages = spark.createDataFrame([(1, "http://x", "body")], "page_id bigint, url string, html string")
    archive = W.write(pages)
    raw = bytes(W.records(archive).first().record)
    head, rest = raw.split(b"\r\n\r\n", 1)
    length = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")).split(b": ")[1])
    assert head.startswith(b"WARC/1.1\r\n") and rest[length:] == b"\r\n\r\n" and rest[:length].endswith(b"\r\n\r\nbody")
    bad = archive._replace(payloads=archive.payloads.withColumn("payload", F.lit("evil").cast("binary")))
    with pytest.raises(Exception, match="missing or damaged"):
        W.records(bad).collect()
    assert W.archived_pages(pages.where("false")).collect() == []


def _check_packing(got, texts, window=4096):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(WORDS).encode
    want = Counter()
    for i, t in texts:
        ids = np.array(encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want[(i, len(ids), zlib.crc32(ids.tobytes()))] += 1
    ids_of = {(i, n): np.array(encode(t or "", add_special_tokens=False).ids + [2], "<u4") for (i, t) in texts for n in [len(encode(t or "", add_special_tokens=False).ids) + 1]}
    by_seq, by_doc, padding, used = defaultdict(list), defaultdict(list), 0, 0
    for r in got:
        by_seq[r.sequence_id].append((r.offset, r.length))
        by_doc[(r.doc_id, r.doc_tokens)].append((r.start, r.length, r.ids_crc32))
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= window
        used += at
        padding += window - at if at & (at - 1) else 0
    many = Counter((i, n) for i, n, _ in want.elements())
    for k, pieces in by_doc.items():
        cover = Counter(x for s, n, _ in pieces for x in range(s, s + n))
        assert set(cover) == set(range(k[1])) and set(cover.values()) == {many[k]}
        for s, n, crc in pieces:
            assert crc == zlib.crc32(ids_of[k][s:s + n].tobytes())
    assert set(by_doc) == set(many)
    return padding / max(1, used)


def test_packing_places_every_id_once(docs, rows):
    assert _check_packing(P.pack_documents(extra(docs).repartition(5), WORDS).collect(), rows) < 0.05


def test_packing_of_short_and_equal_documents(spark, none):
    rows = [(k, "the cat sat on the mat " * 3) for k in range(900)] + [(k, None) for k in range(1000, 1040)] + [(7, "x " * 4095), (8, "x " * 9000), (9, "\x1c a\x1db 日本　x")]
    assert _check_packing(P.pack_documents(spark.createDataFrame(rows, DOCS).repartition(4), WORDS).collect(), rows) < 0.02
    assert P.pack_documents(none, WORDS).collect() == []


def test_nnls_and_plan():
    rng = np.random.default_rng(0)
    a = rng.random((12, 30))
    x = P.nnls(a, a @ np.maximum(0, rng.normal(size=30)))
    y = a @ np.maximum(0, x)
    assert (x >= 0).all() and (a.T @ (y - a @ x) < 1e-6).all()
    histogram = rng.integers(0, 50, 257)
    histogram[0] = 0
    used = Counter(b for combo, n in P.plan(histogram) for b in combo for _ in range(n))
    assert all(used[b] <= histogram[b] for b in used) and all(sum(c) == 256 for c, _ in P.plan(histogram))


def brute_katz(rows):
    tokens = [(i, [*space_words(t), "\0"]) for i, t in rows]
    learn = [w for i, w in tokens if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(x for w in learn for x in w)
    pairs = Counter(p for w in learn for p in zip(["\1", *w], w, strict=False))
    n, v = sum(c.values()), len(c)
    d1, d2 = (K.good_turing(Counter(x.values())) for x in (c, pairs))
    value = lambda d, k: float(d.of(np.array([k]))[0])
    total = n if sum(k - value(d1, k) for k in c.values()) > 1e-9 * max(1, n) else n + 1
    p1 = {w: value(d1, k) / total for w, k in c.items()}
    unknown = 1 - sum(p1.values())
    count, worth, mass = Counter(), Counter(), Counter()
    for (h, w), k in pairs.items():
        count[h] += k
        worth[h] += value(d2, k)
        mass[h] += p1[w]
    den = {h: count[h] if count[h] - worth[h] > 1e-9 * count[h] else count[h] + 1 for h in count}
    back = {h: (1 - worth[h] / den[h]) / (1 - mass[h]) for h in count}

    def prob(h, w):
        return value(d2, pairs[h, w]) / den[h] if (h, w) in pairs else back.get(h, 1) * p1.get(w, unknown)

    out = []
    for i, w in tokens:
        base = sum(math.log10((c.get(x, 0) + 1) / (n + v + 1)) for x in w)
        score = sum(math.log10(prob(h, x)) for h, x in zip(["\1", *w], w, strict=False))
        out.append((i, len(w), sum(x in c for x in w), n, base, score))
    return out, prob, [*c, "\2"], list(count)


@pytest.mark.parametrize("chunk", [3_000, 1 << 24])
def test_katz_equals_brute_force(docs, rows, chunk, monkeypatch):
    monkeypatch.setattr(K, "HOT_HISTORY", 50)
    want, prob, words, histories = brute_katz(rows)
    got = K.katz_scores(extra(docs), chunk_bytes=chunk * 10).drop("held_out").collect()
    short = lambda xs: sorted(((str(x[0]), *x[1:4], round(x[4], 6), round(x[5], 6)) for x in xs))
    assert short(got) == short(want)
    for h in histories[:20]:
        assert abs(sum(prob(h, w) for w in words) - 1) < 1e-9  # "\2" stands for all unknown words


def test_katz_of_little(spark, none):
    assert K.katz_scores(none).collect() == []
    lone = [(2, "a b"), (5, None)]
    got = {r.doc_id: r for r in K.katz_scores(spark.createDataFrame(lone, DOCS)).collect()}
    want = {w[0]: w for w in brute_katz(lone)[0]}
    assert all(abs(got[i].score - want[i][5]) < 1e-9 and got[i].train_tokens == want[i][3] for i in got)


def test_pipeline_stages(spark, tmp_path):
    """Each stage against its own operator on what it was given; decisions take effect."""
    import corpus_pipeline as C
    from test_joins import brute_components

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs
    assert [n for n, _ in C.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    for k, (name, stage) in enumerate(C.STAGES[:-1]):
        after = stage(spark, before, sf)
        after.write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        assert after.columns == columns and 0 < after.count() <= before.count()
        if name == "n-gram Jaccard join":
            got = {r.doc_id for r in after.collect()}
            given = [(r.doc_id, r.text) for r in before.collect()]
            assert got == {i for i, _, c in brute_components(given) if i == c}
        before = after
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = [i for i, t in labels.items() if t == 0]
    kept = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/0").select("doc_id").collect()}
    assert sum(i in kept for i in clean) / len(clean) > 0.97
    pieces = C.pack(spark, before, sf).collect()
    assert _check_packing(pieces, [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]) < 0.05


def test_pipeline_of_empty_and_odd_documents(spark, tmp_path):
    import corpus_pipeline as C

    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "one two three four five six seven", "en", "s", 1), (1, "one two three four five six seven", "en", "s", 1), (2, None, None, None, None),
            (3, "", "en", "s", 0), (None, "a null id with a text of its own", None, None, 3)]
    spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/documents.parquet")
    got = C.run(spark, str(tmp_path)).collect()
    length = Counter()
    for r in got:  # the last window is cut into powers of two
        length[str(r.doc_id), r.doc_tokens] += r.length
    assert sorted(i for i, _ in length) == ["1", "2", "3", "None"] and all(n == k[1] for k, n in length.items())
    spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/none/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{t}.parquet").write.parquet(f"{tmp_path}/none/{t}.parquet")
    assert C.run(spark, f"{tmp_path}/none").collect() == []
