"""From raw documents to packed training sequences, in five stages.

Each stage takes all that the one before kept and returns it in the columns of ``documents``; the
last one returns pieces of packed sequences. Between stages the rows are written and read again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from adsieve.llm import jaccard_join, line_quality, mixing, packing, suffix_dedup
from adsieve.llm.storage import end_scope, keep, new_scope

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def stage(function: Callable) -> Callable:
    """A stage begins by dropping the intermediate tables of the stage before, whose result has been written."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        new_scope(spark)
        try:
            return function(spark, docs, sf_dir)
        except BaseException:
            end_scope(spark)
            raise

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go; so do documents that break the base rules or lose too much.

    Null and empty texts break the base rules; repeated rows are judged each by itself; an empty table gives an
    empty one; other columns are carried along.
    """
    return line_quality.clean(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at 0.8 stays.

    The least doc_id of a group stays; rows with a null doc_id stay; of equal rows one stays; texts without a word
    are linked with nothing and stay; an empty table gives an empty one; other columns are carried along.
    """
    return jaccard_join.one_of_each(docs, percent=80, shingle=5)


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur twice go, wherever they occur; documents left without a word go too.

    A null text is empty, so it goes; repeated rows lose all that they share, in every copy; spans shrink to whole
    characters; an empty table gives an empty one; other columns are carried along, n_chars is counted anew.
    """
    return suffix_dedup.without_repeats(docs, size=200)


@stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents once at least; small sources repeat, up to one and a half times, towards an even mix.

    Rows are in the order of the mix, a file for each range of it; packing reads each file in its order.
    A null source is one of its own; a text without a word appears once; repeated rows count each by itself; an empty
    table gives an empty one; other columns are carried along.
    """
    return mixing.in_order(mixing.mix(docs, max_repeats=1.5, budget=None)).select(*docs.columns)


@stage
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed windows of 2048 ids.

    A null or empty text is its end id alone; null ids and repeated rows are packed as they are; an empty table
    gives no piece.
    """
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mixture),
    ("packing", sequences),
]

#: SQL cannot express the stages' tokenisation, packing and bisection; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES[:-1]:
        docs = keep(function(spark, docs, sf_dir), "stage", scoped=False)
    packed = STAGES[-1][1](spark, docs, sf_dir)
    end_scope(spark)  # what the last stage kept is still to be read
    return packed
