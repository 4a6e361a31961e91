"""From raw documents to packed sequences: five stages, each over all that the
one before kept, written as Parquet in the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlab.llm import exact, mixing, ngram_join, packing, quality
from cohortlab.llm.common import read, ship
from cohortlab.session import delete_folder, scratch, shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules.  Null and empty texts have no
    words and go; repeated rows stay or go together; an empty table stays empty."""
    ship(spark)
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts.  Null texts are equal to
    empty ones; null ids come last; of repeated rows one stays."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles at
    Jaccard 0.8.  Documents without words link with nothing and stay."""
    ship(spark)
    return ngram_join.one_per_component(docs, size=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; rows without a
    source are one source, the last."""
    return mixing.mixed_rows(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences.  Null and empty texts are
    one end token; null ids pass through."""
    ship(spark)
    return packing.pack(docs)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
          ("mixing sources", mix_sources), ("best-fit packing", best_fit_packing)]

# Compression ratios and tokens are beyond SQL; tests/llm compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage wrote on the way goes when it is done,
    and so does its own result once the next one has read it."""
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_dir(spark, "stage-" + name.replace(" ", "-"))
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            delete_folder(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
