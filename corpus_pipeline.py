"""A training corpus from raw documents: clean, unique, not contaminated, mixed, as token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is
written and read again before the next one. All but the last return the columns of
``documents``, extra ones included, whatever their names (but for those that begin with two underscores).

Null texts, empty ones and those of blanks go through all stages until mixing, which takes documents with tokens
only. A null doc_id is kept throughout. Repeated rows and rows of equal texts are one group of near copies, of which one row stays: of the smallest doc_id,
null last; of ties the first as read. The token files stay when the driver ends: in the folder that ``run`` is given, or in one of its own
below ``spark.checkpoint.dir``; the result's column ``folder`` names it. Of a text of any length the whole is read. Empty tables give empty results; without labels nothing
is toxic, and without benchmark items nothing is taken out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlake.llm import decontaminate, minhash, mixing, token_output, toxicity
from arborlake.llm.scratch import Scratch, shared_dir


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more as toxic go; the classifier learns from labelled rows of ``docs``. Empty texts score low and stay."""
    return toxicity.keep_clean(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8 or more). Texts without words are no copies of one another."""
    return minhash.keep_first(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go: ten words of an item in a row, or all of a shorter one. Null and empty items have none."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the target weights; one that two epochs take comes twice. Null languages and sources are values of their own."""
    return mixing.mix(docs, mixing.WEIGHTS).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, output: str | None = None) -> DataFrame:
    """Shards of token ids in the order of doc_id (null first, equal ids by a hash of their text) in the folder ``output``, and their digest as read back."""
    folder = output or f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    return token_output.token_output(docs, folder=folder).withColumn("folder", F.lit(folder))


STAGES = [("toxicity", clean), ("minhash", unique), ("decontamination", unseen), ("mixing", mixed), ("tokens", tokens)]

#: Learning, MinHash and the vocabulary are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, output: str | None = None) -> DataFrame:
    """Digest of the token files of the corpus (see ``tokens``), which lie in ``output``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, scratch.keep(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(before)
    return tokens(spark, docs, sf_dir, output)
