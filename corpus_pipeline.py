"""A training-data pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns the columns of ``documents`` (the last one the mix).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontam, line_dedup, mixing, simhash, toxicity
from tidewell.llm.common import discard, mark, materialize, pick, release


def _as_documents(docs: DataFrame, out: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``out``, which begins with them; ``n_chars`` follows the text.

    By position: names may differ in case only.
    """
    flat = out.toDF(*[f"c{i}" for i in range(len(out.columns))])
    length = F.length(f"c{docs.columns.index('text')}")
    return flat.select(*[(length.cast(docs.schema[i].dataType) if n == "n_chars" else F.col(f"c{i}")).alias(n) for i, n in enumerate(docs.columns)])


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """Texts go to Python some 2,000 at a time, so buffers on either side stay small. ``run`` puts the setting back."""
    spark.conf.set(_BATCH, "2000")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (fitted on the labelled ones among them) finds toxic go."""
    _small_batches(spark)
    labels = toxicity.training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic")
    model = toxicity.fit(pick(docs, "doc_id", "text"), labels)
    return _as_documents(docs, toxicity.score(docs, model, keep=lambda p: p < 0.5))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least ten documents go; every document stays."""
    _small_batches(spark)
    return _as_documents(docs, line_dedup.drop_lines(docs, min_docs=10))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (five-word shingles, similarity 0.8) stays, the one with the smallest doc_id."""
    _small_batches(spark)
    return simhash.keep_one(docs, most=3, similarity=0.8)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whatever its numbers and names, go."""
    _small_batches(spark)
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix),
]

#: A kernel machine and 64-bit xxHash fingerprints are not for SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = spark.conf.get(_BATCH)
    try:
        for _, stage in STAGES[:-1]:
            since = mark()
            docs = materialize(stage(spark, docs, sf_dir))
            discard(spark, since, keep=1)  # what the stage wrote on its way
            release(spark)
    finally:
        spark.conf.set(_BATCH, before)
    return STAGES[-1][1](spark, docs, sf_dir)
