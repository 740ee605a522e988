"""Exact token-length histogram and what every context limit gets of it.

Documents are aggregated by their encoded length; the histogram has at most as many rows as there are distinct lengths.
Suffix sums over it answer, for each length L taken as a context limit: the documents and tokens in all, those of
documents of at least L tokens, the tokens left when every document is cut at L, and the share of documents
that fit. Quantiles are read off the same sums. The sums run in two steps so that no task gets the whole histogram
however many lengths there are: blocks of ``BLOCK`` lengths are summed first, the running total of the few block
sums is joined back, and the rest runs inside each block.

Defined results: null texts are empty (length zero); repeated rows count each; an empty table gives an empty
histogram. Null ids count like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from comparo.llm.common import materialize

BLOCK = 64


def histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """(length, n_docs) of a column of lengths."""
    return (lengths.groupBy(F.col(column).cast("long").alias("length"))
            .agg(F.count(F.lit(1)).alias("n_docs")))


def context_limits(hist: DataFrame) -> DataFrame:
    """For each length L of the histogram: length, n_docs, docs_at_least and tokens_at_least (documents of L or
    more tokens), docs_fit (documents of L or fewer), total_docs, total_tokens, truncated_tokens (all documents cut at
    L tokens) and quantile (docs_fit / total_docs)."""
    hist = materialize(hist, "lengths")  # is read twice; the lengths are only worked out once
    rows = hist.withColumn("tokens", F.col("length") * F.col("n_docs")).withColumn(
        "block", F.floor(F.col("length") / BLOCK))
    # one row per block of lengths: (longest document / BLOCK) rows at most
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("tokens"))
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select("block", F.coalesce(F.sum("docs").over(above), F.lit(0)).alias("docs_above"),
                           F.coalesce(F.sum("tokens").over(above), F.lit(0)).alias("tokens_above"),
                           F.sum("docs").over(everything).alias("total_docs"),
                           F.sum("tokens").over(everything).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy(F.col("length").desc())
    out = (rows.join(blocks, "block")
           .withColumn("docs_at_least", F.col("docs_above") + F.sum("n_docs").over(inside))
           .withColumn("tokens_at_least", F.col("tokens_above") + F.sum("tokens").over(inside)))
    docs_fit = F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")
    truncated = (F.col("total_tokens") - F.col("tokens_at_least")) + F.col("docs_at_least") * F.col("length")
    return out.select("length", "n_docs", "docs_at_least", "tokens_at_least", docs_fit.alias("docs_fit"), "total_docs",
                      "total_tokens", truncated.alias("truncated_tokens"),
                      (docs_fit / F.col("total_docs")).alias("quantile"))


def quantiles(limits: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the least length that at least this share of the documents does not exceed."""
    least = [F.min(F.when(F.col("quantile") >= float(x), F.col("length"))).alias(f"q{i}")
             for i, x in enumerate(shares)]
    pairs = F.array(*[F.struct(F.lit(float(x)).alias("share"), F.col(f"q{i}").alias("length"))
                      for i, x in enumerate(shares)])
    return limits.agg(*least).select(F.inline(pairs))


def truncated_total(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, truncated_tokens) for limits that need not be lengths of the histogram: one pass, one sum each."""
    sums = [F.sum(F.least(F.col("length"), F.lit(int(x))) * F.col("n_docs")).alias(f"l{i}")
            for i, x in enumerate(limits)]
    pairs = F.array(*[F.struct(F.lit(int(x)).cast("long").alias("limit"),
                               F.coalesce(F.col(f"l{i}"), F.lit(0)).alias("truncated_tokens"))
                      for i, x in enumerate(limits)])
    return hist.agg(*sums).select(F.inline(pairs))
