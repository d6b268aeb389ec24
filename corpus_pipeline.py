"""From raw documents to packed token sequences, in five stages.

Each stage reads what the stage before it wrote, over all of its rows; all but the last
return the columns of ``documents``. What a stage decides holds for all later ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import jaccard, langid, mixing, packing, toxicity
from skyledger.llm.common import read_table, stage


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, taught by ``labels``, does not reject."""
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in whose text a language that the corpus names is found."""
    return langid.with_language(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 80 %) the document of the smallest id."""
    return jaccard.without_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the budgets of their domain, language and source take them."""
    return mixing.cut_texts(mixing.mixture(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of fixed length."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("language", in_known_language),
    ("near_duplicates", one_of_each_group),
    ("mixing", mixed),
    ("packing", packed),
]

#: The classifiers, tokens and exact joins of the stages are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
