"""From raw documents to packed training sequences.

Documents that the quality rules reject go; of near-duplicates one document stays;
sources are mixed so that small ones appear up to twice as often as the largest;
the mix is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import mixing, packing, quality, simhash
from clickloom.llm.frames import read
from clickloom.llm.queries import MIX, TOKENIZER
from clickloom.session import shared_dir, stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, size=3, distance=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, MIX)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, TOKENIZER)


STAGES = [("quality_rules", keep_good), ("simhash", keep_one), ("mixing", mix), ("packing", pack)]

# The tokenizer's ids cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result but the last written and read again."""
    shared_dir(spark)
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
