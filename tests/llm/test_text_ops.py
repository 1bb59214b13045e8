"""Token counts, decontamination, toxicity, language: against the library, brute
force, and held-out rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import DOCS, SF001, docs, extra, lower, none, rows, same  # noqa: F401

from rootsweep.llm import decontaminate as D
from rootsweep.llm import language as L
from rootsweep.llm import token_count as T
from rootsweep.llm import toxicity as X

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def test_token_counts_equal_the_library(docs, rows, library):
    got = T.token_counts(docs, BPE).collect()
    want = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    assert same(got, want)
    assert same(T.token_counts(extra(docs), BPE).collect(), want)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(list(" \n\t\r'sStxé日٣²½ⅷ<|>🙂\u3000\x1c\x85.,!0aZ") + ["<|endoftext|>", "'ll", "  "]), max_size=40).map("".join))
def test_token_counts_of_odd_texts(library, text):
    assert T._counter(BPE).text(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_token_counts_of_nothing(none):
    assert T.token_counts(none, BPE).collect() == []


def _brute_decontaminate(rows, items, window=13):
    def words(t):
        return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    pats = []
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        pats += [(item, w[i:i + n]) for i in range(len(w) - n + 1) if n]
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, p in pats:
            for k in range(len(w) - len(p) + 1):
                if w[k:k + len(p)] == p:
                    hit.update(range(k, k + len(p)))
                    found.add(item)
        ids = sorted(str(f) for f in found if f is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def test_decontaminate_equals_brute_force(spark):
    rng = random.Random(3)
    vocab = ["a", "b", "Cc", "dé", "e1", "日本"]
    text = lambda n: rng.choice([" ", "  ", ", "]).join(rng.choice(vocab) for _ in range(n))
    items = [(k, text(rng.choice([1, 3, 13, 14, 20]))) for k in range(12)] + [(3, text(15)), (None, text(13)), (50, None), (51, ""), (52, "--")]
    items += [(60, items[4][1])]
    rows = [(k, text(rng.randint(0, 40))) for k in range(60)]
    rows += [(100 + k, f"{text(20)}. {items[k][1]}! {text(9)}") for k in range(12)] + [(200, None), (201, ""), (1, rows[1][1])]
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id bigint, text string")
    want = _brute_decontaminate(rows, items)
    got = D.decontaminate(docs, bench)
    assert same(got.drop("spans").collect(), want)
    assert same(D.decontaminate(extra(docs), bench, block_bytes=40).drop("spans").collect(), want)  # many blocks
    by = {i: t for i, t in rows}
    for r in got.where("n_hit > 0").collect():
        n = sum(len(re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(by[r.doc_id][s:e]))) for s, e in zip(r.spans[::2], r.spans[1::2], strict=True))
        assert n == r.n_hit
    carried = D.decontaminate(docs, bench, carry=True)
    assert carried.columns == ["doc_id", "text", "contaminated"]
    assert same(carried.select("doc_id", "contaminated").collect(), [(w[0], w[5]) for w in want])


def test_decontaminate_with_empty_tables(docs, rows, none, spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    got = D.decontaminate(docs, bench)
    assert not got.where("contaminated or n_hit > 0 or n_items > 0").count() and got.count() == len(rows)
    assert D.decontaminate(none, bench).collect() == []


def _toxic_rows(n=600):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        if bad:
            w[rng.randrange(len(w))] = "vile"
            w[rng.randrange(len(w))] = "scum,"
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = _toxic_rows()
    docs = spark.createDataFrame(rows + [(7001, None), (7002, ""), (None, "vile scum")], DOCS)
    lab = spark.createDataFrame([*labels, (5, 0, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = X.toxicity(extra(docs), lab).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    right = sum(r.predicted == truth[r.doc_id] for r in held) / len(held)
    assert len(held) > 100 and right > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got) and len(got) == len(rows) + 3
    # labels of held-out rows are never learned from
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    again = X.toxicity(docs, spark.createDataFrame(flipped, lab.schema)).collect()
    assert {(r.doc_id, r.score) for r in again} == {(r.doc_id, r.score) for r in got}


def test_toxicity_without_labels_or_rows(spark, none):
    lab = spark.createDataFrame([], "doc_id bigint, toxic int")
    got = X.toxicity(spark.createDataFrame([(1, "a"), (2, None)], DOCS), lab).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.0, 0)] * 2
    assert X.toxicity(none, lab).collect() == []


def test_language_on_held_out_rows(spark):
    src = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = [(900001, None, "en"), (900002, "", "fr"), (900003, "123 !?", "de"), (None, "the of and", None)]
    both = src.unionByName(spark.createDataFrame(odd, "doc_id bigint, text string, lang string"))
    got = {r.doc_id: r for r in L.language(both).collect()}
    truth = {r.doc_id: r.lang for r in src.collect()}
    held = [r for i, r in got.items() if i in truth and r.held_out]
    assert len(held) > 100 and sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900001, 900002, 900003))
    assert all(0 <= r.score <= 1 for r in got.values()) and set(r.lang_pred for r in got.values()) <= {"en", "fr", "de", "es", "und"}


def test_language_with_nothing_to_learn(spark, none):
    no = spark.createDataFrame([(1, "hello", None)], "doc_id bigint, text string, lang string")
    assert [r.lang_pred for r in L.language(no).collect()] == ["und"]
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert L.language(empty).collect() == []
    one = spark.createDataFrame([(k, "hello there", "en") for k in range(12)], "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in L.language(one).collect()} == {"en"}


def test_smallest_tables(spark):
    docs, lab = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    assert X.toxicity(docs, lab).count() == L.language(docs).count() == docs.count()


def test_language_learns_every_language(spark):
    rng = random.Random(6)
    vocab = {f"l{k:02d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(12)] for k in range(80)}
    table = [(i, " ".join(rng.choice(vocab[lang]) for _ in range(30)), lang) for i, lang in enumerate([*vocab] * 12)]
    df = spark.createDataFrame(table, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in L.language(df).where("held_out").collect()}
    right = sum(got[i] == lang for i, _, lang in table if i in got)
    assert right > 0.95 * len(got)
