"""Preparing a corpus: five stages, each one operator of ``tickloom.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the docs of the next one. All but the last return the columns of ``documents``.
Null texts have no letter and go in the first stage, as do empty ones; repeated rows are
near duplicates and one of them stays; an empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.bm25_wand import without_leaks
from tickloom.llm.byte_cnn import known_language
from tickloom.llm.common import read, ship, stored
from tickloom.llm.mixing import mixed_documents
from tickloom.llm.queries import tokenizer_path
from tickloom.llm.simhash_vptree import keep_one
from tickloom.llm.token_records import record_digest


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the labels of all documents teach the network."""
    ship(spark)
    return known_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose fingerprints link at 3 bits or fewer."""
    ship(spark)
    return keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item."""
    return without_leaks(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ship(spark)
    return mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records of the mix, as read back from their files."""
    ship(spark)
    return record_digest(docs, tokenizer_path())


STAGES = [
    ("language", identify_languages),
    ("near duplicates", drop_near_duplicates),
    ("leaks", drop_leaks),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]
#: A network, fingerprints and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
