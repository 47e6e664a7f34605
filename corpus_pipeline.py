"""Documents to packed training sequences, stage by stage.

Each stage works on all that its predecessor kept and returns the columns of documents; the last one
returns the pieces of the packed sequences. Between stages the rows are Parquet in the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ohmstead.llm import common, jaccard, mix, pack, pii, queries, rules


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules; those that the rules or their host's verdict reject go."""
    return rules.judge(docs).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.one_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by its kind."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks."""
    return mix.emit(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place."""
    return pack.pack(pack.cut(docs, public_tokenizers.path(queries.WORD_TOKENIZER), "words"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]

#: Tokenizing and best-fit packing cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; a stage's table goes once its successor's is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), ()
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
        common.dropped(*before)
        before = (docs,)
    return docs
