"""From raw documents to sharded training text: five stages, each of which works on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from morbidity.llm.common import importable, table
from morbidity.llm.decontaminate import find_hits, is_contaminated
from morbidity.llm.jaccard_join import jaccard_keepers
from morbidity.llm.lang_id import UNKNOWN, held_out, identify, learn
from morbidity.llm.mix import mix_documents
from morbidity.llm.shard import shard_documents
from morbidity.sources.writers import stage


def apart(docs: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with columns of the given names under others, so that an operator's own columns don't replace them, and what brings
    all columns back."""
    held = {c: f"__own_{c}" for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(held), [F.col(held.get(c, c)).alias(c) for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay; null texts and texts without a letter go.

    The profiles are learned from the documents that are not held out, as in the query of its own.
    """
    model = learn(docs.where(~held_out()))
    spared, back = apart(docs, "lang_pred", "score")
    return identify(spared, model).where(F.col("lang_pred") != UNKNOWN).select(back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents linked as in the operator's own query, the one with the smallest id stays."""
    return jaccard_keepers(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go, the others stay as they are."""
    spared, back = apart(docs, "n_words", "hits", "items")
    found = find_hits(spared, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.where(~is_contaminated()).select(back)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix_documents(docs, table(spark, sf_dir, "labels"))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its size, shard and place in the shard."""
    return shard_documents(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shards", shards),
]

#: Language identification and the Jaccard join can't be written in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. An empty table gives an empty one; null texts go at the first stage; of rows equal in id and text one is left after
    the second, which the mix may repeat; other columns stay as they are, but for ``size``, ``shard`` and ``slot``, which the last stage replaces."""
    importable(spark)
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
