"""Corpus pipeline: language ID, quality rules, near duplicates, repeated passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sedimart.llm import jaccard, langid, packing, quality, suffixes
from sedimart.session import stage


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an identified language stay; those without letters, or of no clear language, go."""
    return langid.keep_identified(docs, langid.learn(docs))


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The table with a number for each row, under a name that is free: the same one whenever these files are read."""
    name = "__row"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs stay, each row by itself."""
    rows, row = numbered(docs)
    judged = quality.judge_quality(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=[row])
    return rows.join(judged.filter("not kept").select(row), row, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, of the smallest id (null ids last); rows without words stay."""
    rows, row = numbered(docs)
    groups = stage(jaccard.link_groups(rows, carry=[row], group=True), "groups").filter("group is not null")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    stays = groups.groupBy("group").agg(F.min(place)[row].alias("stays"))
    further = groups.join(stays, "group").filter(F.col(row) != F.col("stays")).select(row)
    return rows.join(further, row, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in the first document that has them; emptied documents go."""
    return suffixes.drop_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", identify),
    ("quality rules", judge),
    ("n-gram Jaccard join", deduplicate),
    ("suffix-array dedup", cut_repeats),
    ("best-fit packing", pack),
]

#: A trained network and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, "corpus")
    return docs
