"""From raw documents to encoded training text, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedmill.llm.bpe import digests
from feedmill.llm.exact import drop_duplicates
from feedmill.llm.jaccard import drop_near_duplicates
from feedmill.llm.language import held_out, identify, train
from feedmill.llm.mixing import mixed_documents
from feedmill.operators.storage import materialised

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled documents have."""
    model = train(docs.where(~held_out()))
    prefix = "_" * (1 + max(map(len, docs.columns)))
    return identify(docs, model, prefix=prefix).where(F.col(f"{prefix}accepted")).select(*[F.col(f"`{c}`") for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: its id, the number of tokens, and the hashes of the ids and of the text decoded from them."""
    return digests(docs, VOCABULARY)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("bpe", bpe),
]
ORACLE_SQL = None  # a classifier, a mixture solved by iteration and an encoder are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
