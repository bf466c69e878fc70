"""A corpus from raw documents to token ids, in five stages.

Every stage takes what its predecessor kept, is written as Parquet and read again by the next.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, mixing, quality_net, simhash, suffix_dedup
from tidemark.llm.queries import TARGETS, domains, tokenizer
from tidemark.llm.text import small_batches
from tidemark.session import scratch_path
from tidemark.sources.tables import table


#: Of texts handed to Python at a time. An executor keeps the buffers and the Python workers of earlier stages.
BATCH_BYTES = "2m"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network does not take for low quality."""
    net = quality_net.fit(docs, table(spark, sf_dir, "labels"))
    marked = docs.select("*", docs["text"].alias("_text"))
    scored = quality_net.score(marked, net).where("predicted = 1")
    return scored.withColumnRenamed("_text", "text").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of four-word shingles, linked at four bits or fewer."""
    return simhash.one_of_each(docs, radius=4, words=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that a smaller doc_id has already."""
    return suffix_dedup.without_repeats(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of target shares takes them. The mix is larger than its input, so that what it wants
    more of is repeated rather than the rest dropped."""
    return mixing.mixed(docs, domains(table(spark, sf_dir, "labels")), TARGETS, growth=1.25)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids, with the text that the ids decode to."""
    model = tokenizer()
    return bpe.decode(bpe.encode(docs, model), model)


def _stage(work: Callable) -> Callable:
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark, BATCH_BYTES)
        return work(spark, docs, sf_dir)

    return run_stage


STAGES = [("quality classifier", _stage(quality)), ("near-duplicates", _stage(near_duplicates)),
          ("repeated passages", _stage(repeated_passages)), ("mixture", _stage(mixture)), ("tokens", _stage(tokens))]

#: The stages are not expressible in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
