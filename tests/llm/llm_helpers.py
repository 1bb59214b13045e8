from __future__ import annotations

import re

import pytest

SF001 = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"


def lower(text: str | None) -> str:
    """Only A-Z in lower case."""
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def space_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def union_find(nodes, links) -> dict:
    """node -> smallest node reachable."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of the smallest table, with odd ones: null, empty, blank, repeated, long."""
    base = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    some = base.orderBy("doc_id").limit(3).collect()
    odd = [(900001, None), (900002, ""), (900003, " \n\t "), (900004, some[0].text), (900004, some[0].text),
           (900005, (some[1].text or "x") * 300), (900006, "é" * 5000), (None, "a null id is one too"), (900007, "x y"), (900008, "X  y")]
    return base.unionByName(spark.createDataFrame(odd, DOCS)).cache()


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


def extra(df):
    """The same rows with further columns, some named like internal ones."""
    from pyspark.sql import functions as F

    return df.select(F.lit(1).alias("id"), F.lit("z").alias("n"), F.col("doc_id"), F.lit(None).cast("string").alias("node"),
                     F.col("text"), F.array(F.lit(1)).alias("component"), F.lit(2).alias("a.b"), F.lit(0).alias("key"))


def key(row):
    return tuple((x is None, str(x)) for x in row)


def same(a, b) -> bool:
    return sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)
