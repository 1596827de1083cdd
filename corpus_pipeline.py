"""The corpus pipeline: the stages that turn ``documents`` into token digests.

Every stage takes any table with the columns of ``documents`` and works on all
of it; all but the last return those columns (and any further ones, untouched,
whatever their names). An empty table stays empty through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidesync.llm import bpe, mixing, pii, quality, simhash
from tidesync.llm.common import land, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of ``docs``, does not reject.

    Null and empty texts are scored like others (as texts without features);
    null ids have no label and are scored; rows that repeat are scored alike.
    Without labels of both kinds every document has the labels' share as its score.
    """
    return quality.keep_good(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays, the one with the least id.

    Null, empty and blank texts have one fingerprint and so are one group; of
    rows that repeat the least id one stays; rows without an id all stay.
    """
    return simhash.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced in their texts and ``n_chars`` to match.

    Null texts stay null, texts without any stay as they are; rows that repeat
    are treated alike; ids and sources play no part.
    """
    return pii.sanitise(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, whole: none, one or up to three times.

    Null sources are a source of their own, the last; null and empty texts have
    size 0 and come as often as their block; each row that repeats is counted.
    """
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document left.

    Null and empty texts have no ids; every row keeps its row, also one without an id.
    """
    return bpe.digests(docs, *bpe.byte_vocabulary())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("good_quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("without_personal_data", without_personal_data),
    ("mixed", mixed),
    ("tokens", tokens),
]

#: No SQL expresses the stages (a trained model, hashes of every shingle, a random mix).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
