"""From raw documents to packed sequences of token ids, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again, and its decisions take effect. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridvoice.llm import decontaminate, kneser_ney, minhash, packing, queries, templates
from gridvoice.llm.common import kept, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the trusted texts accepts."""
    return kneser_ney.without_rejected(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines whose template recurs, and without identical lines of 50 words or more."""
    return templates.without_recurring(docs, templates.Settings(long_words=50))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words a shingle, similarity of 0.8 or more."""
    return minhash.without_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and offset."""
    return packing.pack(packing.pieces(docs, queries.content(queries.PACKING_VOCABULARY)))


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Tokenizers and the language model cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
