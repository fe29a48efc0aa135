"""A training corpus from ``documents``: filter, de-duplicate, clean, pack.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``. A stage's result is
to be written and read again for the next one: as a stage begins, tables that
earlier stages wrote for themselves go, unless its ``docs`` still read them.

Defined cases, for every stage: an empty table stays empty, extra columns are
kept as they are whatever their names, and no row is lost to a null in a column
that the stage doesn't read.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import ngram_join, packing, pii, quality_rules, substring_dedup
from slotwise.llm.common import discard, recording, remove_unread, table, written

TOKENIZER = "word_bpe_49k.json"

#: Near copies share 80 % of their 5-word shingles; op10's query keeps its own 4 words and 85 %.
NEAR_WORDS, NEAR_PERCENT = 5, 80

#: Folders that the stages so far have written for themselves.
_LEFT: list[str] = []


def _stage(work):
    """``work``, after removing what earlier stages left behind."""

    @wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _LEFT[:] = remove_unread(_LEFT, docs)
        with recording() as folders:
            try:
                return work(spark, docs, sf_dir)
            finally:
                _LEFT.extend(folders)

    return stage


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a stage that changes texts."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go; null and empty texts fail the base rules, repeated rows are judged alike."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


@_stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of smallest id stays, one row of each id; texts without words and rows without id stay."""
    return ngram_join.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


@_stage
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document of smaller id holds go; texts without any, null and empty ones stay byte for byte."""
    return _recounted(substring_dedup.without_repeats(docs))


@_stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become ``[KIND]``; null texts stay null."""
    return _recounted(pii.mask(docs))


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and offset; a null text packs as an empty one."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality),
    ("ngram_join", near_copies),
    ("substring_dedup", repeats),
    ("pii", personal_data),
    ("best_fit_packing", packed),
]

#: The certified cutoffs need binomial tails that the oracle's SQL has not;
#: tests/llm/test_pipeline.py holds every stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; a stage's input goes when its result is written."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES[:-1]):
        done = written(stage(spark, docs, sf_dir), name)
        if n:
            discard(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
