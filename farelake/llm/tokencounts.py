"""Token counts: an exact histogram of encoded lengths, and suffix sums over it.

The histogram has a row per distinct length. With the documents and tokens at or above each length,
totals, quantiles and the tokens left after truncation follow for every context limit without another look
at the texts. Null and empty texts have length 0. Without documents the histogram is empty.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelake.llm.encoding import ENCODE_CHARS, Encoder, slices

#: Lengths that one window of the suffix sums covers.
SPAN = 4096


def lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens) of each row's whole text."""

    def run(batches):
        encoder = Encoder.at(tokenizer)
        for batch in batches:
            for part in slices(batch, chars=ENCODE_CHARS):
                counts = encoder.encode(part.column(1))[1]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint")


def histogram(counts: DataFrame) -> DataFrame:
    """(n_tokens, docs) from one row per document."""
    return counts.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Per length, the documents and tokens at it, above it, below it, and the total when cut to that length.

    Spans of lengths are summed first; windows run inside a span and over one row per span.
    """
    rows = hist.withColumns({"tokens": F.col("n_tokens") * F.col("docs"), "_span": F.floor(F.col("n_tokens") / SPAN)})
    later = Window.orderBy(F.desc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy("_span").agg(F.sum("docs").alias("_d"), F.sum("tokens").alias("_t")).select(
        "_span", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in ("_d", "_t")],
        *[F.sum(c).over(Window.partitionBy()).alias(f"{c}_all") for c in ("_d", "_t")],
    )
    inside = Window.partitionBy("_span").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    above = lambda c: F.coalesce(F.sum(c).over(inside), F.lit(0))
    scanned = rows.withColumns({"_da": above("docs"), "_ta": above("tokens")}).join(spans, "_span")
    longer, longer_tokens = F.col("_da") + F.col("_d_later"), F.col("_ta") + F.col("_t_later")
    return scanned.select(
        "n_tokens", "docs", "tokens", longer.alias("docs_longer"), longer_tokens.alias("tokens_longer"),
        (F.col("_d_all") - longer).alias("docs_upto"),
        (F.col("_t_all") - longer_tokens + longer * F.col("n_tokens")).alias("truncated_total"),
    )


def truncated(sums: DataFrame, limit: int) -> Column:
    """Aggregate over ``suffix_sums``: tokens kept if every document is cut to ``limit``."""
    return F.coalesce(F.sum(F.col("docs") * F.least(F.col("n_tokens"), F.lit(limit))), F.lit(0))


def quantile(share: float) -> Column:
    """Aggregate over ``suffix_sums``: the least length that at least ``share`` of the documents do not exceed."""
    total = F.col("docs_upto") + F.col("docs_longer")
    return F.min(F.when(F.col("docs_upto") >= F.lit(share) * total, F.col("n_tokens")))
