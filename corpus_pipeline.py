"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.

1. language_id: documents without a letter, or whose language is not
   recognised, go.
2. near_dedup: one document of each group of near-duplicates stays.
3. substring_dedup: words covered by a run of 20 words that occurs earlier are
   cut out of the texts; documents that lose all their words go.
4. mixing: documents are repeated or left out so that the sources come near
   their targets; a document taken twice is two rows.
5. packing: every piece of every document gets its place in a sequence of 2048
   tokens.

SQL cannot express stages 1, 2 and 5, so there is no ``ORACLE_SQL``. The
operators of stages 2 to 5 are tested against brute force or SQL, stage 1 by
held-out accuracy; the pipeline's own test looks at its sums and at empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import lang_id, minhash, mixing, packing, substring_dedup
from lakeloom.llm.common import written
from lakeloom.llm.tokens import known_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lang_id.identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_copies(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, known_path("word_bpe_49k.json"), limit=2048, end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substrings),
    ("mixing", mixing_sources),
    ("packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
