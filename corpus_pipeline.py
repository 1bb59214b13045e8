"""Corpus pipeline over ``documents``: toxicity, line dedup, near-duplicates,
benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns the columns of documents (the last: packed pieces); its result is written as
Parquet and read again as the next one's documents. Repeated rows: the first three
stages judge them alike, the third keeps one of them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootsweep.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from rootsweep.llm.common import stored


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _apart(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stage with the documents' other columns under names that it does not use."""
    inner = [c if c in ("doc_id", "text") else f"__column_{i}" for i, c in enumerate(docs.columns)]
    return stage(docs.toDF(*inner)).select(*inner).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go (predicted 1). Documents are long: where
    the session leaves Spark's default of 10,000 rows an Arrow batch, it is 1,000, which
    holds a tenth of the memory in both processes of a task."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, "1000")
    weights = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _apart(docs, lambda own: toxicity.score(own, weights).where("predicted = 0"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines the first stays; a document all of whose lines go is dropped."""
    kept = _apart(docs, lambda own: line_dedup.dedup_lines(own).where("n_removed = 0 or n_removed < n_lines"))
    return kept.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else kept


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays, once."""
    found = stored(ngram_join.ngram_components(docs), "pipeline")
    ids = found.where("doc_id <=> component_id").groupBy("doc_id").agg((F.count(F.lit(1)) > 1).alias("many"))
    ids = ids.withColumnRenamed("doc_id", "kept_id")
    def one_each(own: DataFrame) -> DataFrame:
        kept = own.join(ids, F.col("doc_id").eqNullSafe(F.col("kept_id")))
        once = kept.where("not many").select(*own.columns)
        return once.unionByName(kept.where("many").dropDuplicates(["doc_id", "text"]).select(*own.columns))

    return _apart(docs, one_each)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too many words in benchmark windows go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _apart(docs, lambda own: decontaminate.decontaminate(own, benchmark, carry=True).where("not contaminated"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

#: Learned scores, MinHash and tokenisers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
