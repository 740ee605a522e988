"""Corpus profile (E5: A1-A8, A11, W6). Each report is one aggregation over the corpus; all are
mergeable (partial aggregation map-side), so none of them moves rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from comparo import config

SMALL_CORPUS = 100


def totals(corpus: DataFrame) -> DataFrame:
    """Documents, distinct domains (a missing domain counts as ''), empty / small flags."""
    n = F.count(F.lit(1))
    return corpus.agg(n.alias("total_documents"),
                      F.countDistinct(F.coalesce(F.col("domain"), F.lit(""))).alias("unique_domains")) \
        .withColumn("is_empty", F.col("total_documents") == 0) \
        .withColumn("small_corpus", F.col("total_documents") < SMALL_CORPUS)


def top_values(corpus: DataFrame, col: str, n: int, missing: str = "unknown") -> DataFrame:
    """A3/A4: the ``n`` most frequent values (missing -> ``missing``); ties by value. Adds ``rank``."""
    counts = (corpus.groupBy(F.coalesce(F.col(col), F.lit(missing)).alias("value"))
              .agg(F.count(F.lit(1)).alias("documents")))
    # the grouped result has one row per distinct value; a global top-n keeps only n per task
    top = counts.orderBy(F.desc("documents"), F.asc("value")).limit(n)
    w = Window.orderBy(F.desc("documents"), F.asc("value"))
    return top.withColumn("rank", F.row_number().over(w))


def tld_distribution(corpus: DataFrame, n: int = 15) -> DataFrame:
    return top_values(corpus, "tld", n)


def category_distribution(corpus: DataFrame, n: int = 10) -> DataFrame:
    return top_values(corpus, "primary_category", n)


def price_stats(corpus: DataFrame) -> DataFrame:
    """A5: min / max / avg / sum of positive prices, per document (NaN never counts as positive)."""
    p = F.col("price")
    pos = F.when((p > 0) & ~F.isnan(p), p)
    return corpus.agg(F.min(pos).alias("min_price"), F.max(pos).alias("max_price"),
                      F.avg(pos).alias("avg_price"), F.sum(pos).alias("total_price"),
                      F.count(pos).alias("priced_documents"))


def date_range(corpus: DataFrame, col: str = "sale_date") -> DataFrame:
    """Earliest / latest sale by text order over non-empty values."""
    d = F.when(F.col(col) != "", F.col(col))
    return corpus.agg(F.min(d).alias("earliest_sale"), F.max(d).alias("latest_sale"))


def length_histogram(corpus: DataFrame) -> DataFrame:
    """One row per length bucket (0 and missing lengths fall in none)."""
    length = F.coalesce(F.col("length"), F.lit(0))
    aggs = []
    for label, lo, hi in config.LENGTH_BUCKETS:
        cond = (length >= lo) if hi is None else length.between(lo, hi)
        aggs.append(F.count_if(cond).alias(label))
    wide = corpus.agg(*aggs)
    labels = [b[0] for b in config.LENGTH_BUCKETS]
    return wide.select(F.inline(F.array(*[F.struct(F.lit(i).alias("bucket_order"), F.lit(lab).alias("bucket"),
                                                   F.col(f"`{lab}`").alias("documents"))
                                          for i, lab in enumerate(labels)])))


def numeric_split(corpus: DataFrame) -> DataFrame:
    """Documents with / without digits in the name (a missing flag counts as without)."""
    has = F.coalesce(F.col("has_numbers"), F.lit(False))
    return corpus.agg(F.count_if(has).alias("with_numbers"), F.count_if(~has).alias("without_numbers"))


def sample_domains(corpus: DataFrame, first_rows: int = 30, n: int = 10, order_col: str = "id") -> DataFrame:
    """Among the first ``first_rows`` rows (by ``order_col``), the first row of each domain,
    the first ``n`` such domains; with a ``sample_rank``. Bounded: at most ``first_rows`` rows move."""
    head = corpus.orderBy(order_col).limit(first_rows)
    w_dom = Window.partitionBy(F.coalesce(F.col("domain"), F.lit("unknown"))).orderBy(order_col)
    firsts = head.withColumn("__rn", F.row_number().over(w_dom)).where(F.col("__rn") == 1).drop("__rn")
    w = Window.orderBy(order_col)
    return firsts.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= n)


def summary(corpus: DataFrame) -> DataFrame:
    """A1, A2, A5-A8, A11 in one aggregation: one scan of the corpus for every scalar statistic."""
    p = F.col("price")
    pos = F.when((p > 0) & ~F.isnan(p), p)
    d = F.when(F.col("sale_date") != "", F.col("sale_date"))
    length = F.coalesce(F.col("length"), F.lit(0))
    has = F.coalesce(F.col("has_numbers"), F.lit(False))
    buckets = []
    for label, lo, hi in config.LENGTH_BUCKETS:
        cond = (length >= lo) if hi is None else length.between(lo, hi)
        buckets.append(F.count_if(cond).alias("len_" + label.split(" ")[0].replace("-", "_").replace("+", "_up")))
    out = corpus.agg(
        F.count(F.lit(1)).alias("total_documents"),
        F.countDistinct(F.coalesce(F.col("domain"), F.lit(""))).alias("unique_domains"),
        F.min(pos).alias("min_price"), F.max(pos).alias("max_price"), F.avg(pos).alias("avg_price"),
        F.sum(pos).alias("total_price"), F.min(d).alias("earliest_sale"), F.max(d).alias("latest_sale"),
        *buckets,
        F.count_if(has).alias("with_numbers"), F.count_if(~has).alias("without_numbers"))
    return (out.withColumn("is_empty", F.col("total_documents") == 0)
            .withColumn("small_corpus", F.col("total_documents") < SMALL_CORPUS))


def report(corpus: DataFrame) -> dict[str, DataFrame]:
    """E5: every profile report of the corpus, keyed by name."""
    return {"summary": summary(corpus), "tld": tld_distribution(corpus), "category": category_distribution(corpus),
            "length": length_histogram(corpus), "sample": sample_domains(corpus)}
