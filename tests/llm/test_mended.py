"""Cases that once failed: more pieces than the cache, ids that are text, repeated ids,
documents with columns named like a stage's own."""

from __future__ import annotations

import public_tokenizers
import pytest
from llm_helpers import DOCS
from pyspark.sql import functions as F

import corpus_pipeline
from rootsweep.llm import language, packing, warc
from rootsweep.llm.common import ship


def test_more_pieces_than_the_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 50)
    ids = packing.PieceIds(public_tokenizers.path("word_bpe_49k.json"))
    first = " ".join(f"a{i}b" for i in range(30))
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)) + " a1b"
    for batch in ([first], [text], [first, text], [first], ["x", text]):
        want = [e.ids for e in ids.tokenizer.encode_batch(batch, add_special_tokens=False)]
        got = [list(memoryview(b).cast("H" if ids.kind == "<u2" else "I")) for b in ids.texts(batch)]
        assert got == want


def test_page_ids_of_text(spark):
    rows = [("b/1 é", "u", "<p>x</p>"), ("a\r\nWARC-Type: no", "u", "<p>x</p>"), ("", "u", "<p>x</p>"), (None, "u", "<p>x</p>"), ("(z)", "u", "other")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.archived_pages(pages).collect()}
    assert got == {"": ("response", None), "a\r\nWARC-Type: no": ("revisit", ""), "b/1 é": ("revisit", ""), None: ("revisit", ""), "(z)": ("response", None)}
    numbers = spark.createDataFrame([(2, "u", "x"), (1, "u", "x"), (None, "u", "x")], "page_id int, url string, html string")
    out = warc.archived_pages(numbers)
    assert dict(out.dtypes)["page_id"] == "int" and {(r.page_id, r.refers_to) for r in out.collect()} == {(1, None), (2, 1), (None, 1)}


def test_repeated_ids_are_one_row_of_the_sample(spark):
    ship(spark)
    texts = {"de": "der die das und ist nicht ein haus", "en": "the and is not a house with this"}
    rows = [(i % 3 if i < 400 else i, t + f" {i}", lang) for lang, t in texts.items() for i in range(500)]
    docs = spark.createDataFrame([(d * 2 + (lang == "en"), t, lang) for d, t, lang in rows], "doc_id bigint, text string, lang string")
    got = language.language(docs).collect()
    want = {(r.doc_id, r.lang) for r in docs.collect()}
    assert len(got) == 1000 and sum((r.doc_id, r.lang_pred) in want for r in got) > 950


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_stages_keep_columns_named_like_their_own(spark, tmp_path, k):
    ship(spark)
    base = spark.createDataFrame([(i, f"line {i} of a text\nsecond line {i * 7919} here and some more words {i}") for i in range(20)] + [(3, None)], DOCS)
    own = base.select(*[F.lit(f"mine {c}").alias(c) for c in ("score", "predicted", "n_lines", "n_removed", "contaminated")], "doc_id", "text",
                      F.lit(1).alias("many"), F.lit(2).alias("kept_id"), F.lit(3).alias("component_id"), F.lit(0).cast("bigint").alias("n_hit"))
    spark.createDataFrame([(i, 0, int(i % 5 == 0)) for i in range(20)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this is there")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.STAGES[k][1](spark, own, str(tmp_path))
    assert out.columns == own.columns and out.schema["score"].dataType == own.schema["score"].dataType
    got = out.collect()
    assert got and all(r.score == "mine score" and r.n_lines == "mine n_lines" and r.kept_id == 2 for r in got)
