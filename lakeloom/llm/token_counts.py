"""Exact length histogram of the encoded documents.

Every task encodes its texts and sends only (length, documents) pairs; the
histogram of the corpus is their sum. Suffix sums over the distinct lengths
then answer, for every context limit, how many tokens there are, how many a
truncation keeps and how many documents are longer; quantiles come from the
same sums. The histogram has at most as many rows as there are different
lengths, and its running sums are taken in ranges, never in one task.

Null and empty texts have length 0. Empty tables give an empty histogram.
Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import prepare, range_buckets, regrouped, running_before, written
from lakeloom.llm.tokens import encoder


def length_histogram(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``n_tokens, n_docs`` of all rows of ``docs``."""
    prepare(docs.sparkSession)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for table in regrouped(batches, "t"):
            _, offs = encoder(tokenizer).encode(table["t"])
            own = np.bincount(np.diff(offs))
            if len(own) < len(total):
                own, total = total, own
            own[:len(total)] += total
            total = own
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"n_tokens": seen.astype(np.int64),
                                          "n_docs": total[seen].astype(np.int64)})

    return docs.select(F.col(text).alias("t")) \
        .mapInArrow(lengths, "n_tokens long, n_docs long") \
        .groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as a context limit:
    ``docs_longer``, ``tokens_longer`` (of the longer documents),
    ``docs_within``, ``tokens_within``, ``tokens_truncated`` (kept when each
    document is cut at the limit) and ``quantile`` (share of documents no
    longer than it)."""
    h = range_buckets(histogram.withColumn("_tokens", F.col("n_tokens") * F.col("n_docs")),
                      [F.col("n_tokens")], "lengths")
    down = h.withColumn("_bucket", -F.col("_bucket"))
    longer = running_before(down, [], [F.col("n_tokens").desc()], "n_docs", "docs_longer")
    longer = running_before(longer, [], [F.col("n_tokens").desc()], "_tokens", "tokens_longer")
    total = h.agg(F.sum("n_docs").alias("_all_docs"), F.sum("_tokens").alias("_all_tokens"))
    return longer.join(F.broadcast(total)).select(
        "n_tokens", "n_docs", "docs_longer", "tokens_longer",
        (F.col("_all_docs") - F.col("docs_longer")).alias("docs_within"),
        (F.col("_all_tokens") - F.col("tokens_longer")).alias("tokens_within"),
        (F.col("_all_tokens") - F.col("tokens_longer")
         + F.col("n_tokens") * F.col("docs_longer")).alias("tokens_truncated"),
        ((F.col("_all_docs") - F.col("docs_longer")) / F.col("_all_docs")).alias("quantile"))


def token_counts(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Histogram and limit table of ``docs`` in one."""
    return limit_table(written(length_histogram(docs, tokenizer, text), "histogram"))


def quantile_lengths(table: DataFrame, shares: list[float]) -> DataFrame:
    """Smallest length that at least each share of the documents does not
    exceed: ``share, n_tokens``."""
    return table.agg(*[F.min(F.when(F.col("quantile") >= s, F.col("n_tokens"))).alias(str(i))
                       for i, s in enumerate(shares)]) \
        .select(F.explode(F.array(*[F.struct(F.lit(float(s)).alias("share"),
                                             F.col(f"`{i}`").alias("n_tokens"))
                                    for i, s in enumerate(shares)])).alias("r")).select("r.*")


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """Tokens kept, and documents cut, at each of the given limits."""
    return histogram.agg(*[F.struct(
        F.lit(int(n)).alias("limit"),
        F.coalesce(F.sum(F.least("n_tokens", F.lit(int(n))) * F.col("n_docs")), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(F.col("n_tokens") > int(n), F.col("n_docs"))), F.lit(0)).alias("docs_cut"))
        .alias(str(n)) for n in limits]) \
        .select(F.explode(F.array(*[F.col(f"`{n}`") for n in limits])).alias("r")).select("r.*")
