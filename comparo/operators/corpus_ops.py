"""Corpus-building operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comparo.functions.scoring import clean_price
from comparo.functions.text import strip_ws
from comparo.operators.suffix import parse_domain
from comparo.session import materialize

# Stored corpus layout (the sale date is kept as text, as delivered).
CORPUS_COLUMNS = ["id", "document", "domain", "tld", "length", "price", "platform", "sale_date", "primary_category",
                  "secondary_category", "desc_index", "has_numbers"]


def clean_sales(raw: DataFrame) -> DataFrame:
    """P4 + P5: drop rows whose domain is NULL or blank after stripping; strip the domain; clean the price."""
    domain = strip_ws(F.col("domain"))
    return (raw.where(domain.isNotNull() & (domain != ""))
            .withColumn("domain", domain)
            .withColumn("price", clean_price(F.col("price"))))


def _description(column: str, null_as_text: bool) -> Column:
    c = F.col(column)
    return strip_ws(F.coalesce(c, F.lit("nan")) if null_as_text else c)


def _exploded(sales: DataFrame, texts: list[Column]) -> DataFrame:
    """A row for each text that is neither NULL nor blank, with desc_index, description and id."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), t.alias("t")) for i, t in enumerate(texts, 1)])
    kept = F.filter(pairs, lambda p: p["t"].isNotNull() & (p["t"] != ""))
    out = sales.select("*", F.explode(kept).alias("__d"))
    return (out.withColumn("desc_index", F.col("__d.i").cast("int"))
            .withColumn("description", F.col("__d.t"))
            .withColumn("id", F.concat(F.col("domain"), F.lit("__desc"), F.col("desc_index").cast("string")))
            .drop("__d"))


def explode_descriptions(sales: DataFrame, null_as_text: bool = False) -> DataFrame:
    """P6 + P7: one row per non-blank description, ``desc_index`` 1 or 2 by column (kept when
    description_1 is blank), id ``{domain}__desc{i}``; a domain without any description yields no row.

    ``null_as_text=True`` turns a missing description into the text ``"nan"`` (what a pandas read
    followed by ``str()`` produces); by default a missing description is no description.
    """
    return _exploded(sales, [_description(c, null_as_text) for c in ("description_1", "description_2")])


def first_descriptions(sales: DataFrame, order_col: str = "line_no", null_as_text: bool = False) -> DataFrame:
    """:func:`explode_descriptions` and :func:`dedup_ids` in one: of each domain the first row (by ``order_col``) with a first
    description and the first with a second one.

    An id is a domain and an index, so one aggregate over (domain, order, two flags) names all winners before anything is
    unpivoted. The keys that are beaten in their domain are written out, so that the planner knows how many they are: rows with
    their texts move for many of them only."""
    texts = [_description(c, null_as_text) for c in ("description_1", "description_2")]
    order = F.col(order_col)
    keys = sales.select("domain", order.alias("__order"), *[(t.isNotNull() & (t != "")).alias(f"__has{i}")
                                                             for i, t in enumerate(texts, 1)])
    keys = materialize(keys.where("domain IS NOT NULL AND (__has1 OR __has2)"), "sales_keys", compression="zstd")
    firsts = keys.groupBy("domain").agg(*[F.min(F.when(F.col(f"__has{i}"), F.col("__order"))).alias(f"__first{i}") for i in (1, 2)])
    lost = [F.col(f"__has{i}") & F.col(f"__first{i}").isNotNull() & ~F.col("__order").eqNullSafe(F.col(f"__first{i}"))
            for i in (1, 2)]
    beaten = (keys.join(firsts, "domain").where(lost[0] | lost[1]).groupBy(F.col("domain").alias("__domain"), "__order")
              .agg(*[F.max(x).alias(f"__lost{i}") for i, x in enumerate(lost, 1)]))
    beaten = materialize(beaten, "beaten_keys", compression="zstd")
    rows = sales.where(F.col("domain").isNotNull()).join(
        beaten, (F.col("domain") == F.col("__domain")) & order.eqNullSafe(F.col("__order")), "left")
    won = [~F.coalesce(F.col(f"__lost{i}"), F.lit(False)) for i in (1, 2)]
    rows = _exploded(rows, [F.when(w, t) for w, t in zip(won, texts)])
    return rows.drop("__domain", "__order", "__lost1", "__lost2")


def document_text(df: DataFrame) -> DataFrame:
    """``Domain: {d}. Category: {p}, {s}. Description: {t}``; a missing category reads ``Unknown``."""
    def cat(c):
        return F.coalesce(F.col(c), F.lit("Unknown"))
    return df.withColumn("document", F.concat(
        F.lit("Domain: "), F.col("domain"), F.lit(". Category: "), cat("primary_category"), F.lit(", "),
        cat("secondary_category"), F.lit(". Description: "), F.col("description")))


def with_metadata(df: DataFrame) -> DataFrame:
    """P3 (+ J3 on the stored name): tld (default '.com'), length and has_numbers of the parsed SLD."""
    return parse_domain(df, "domain").drop("sld", "is_multi_word", "numeric_percentage")


def dedup_ids(rows: DataFrame, order_col: str = "line_no") -> DataFrame:
    """The first row (by ``order_col``, then description index) of every id wins.

    The winner is found on the keys alone, with partial minima before the shuffle, so an id repeated across many files
    never gathers its copies in one task; the rows with their texts then meet the winning keys in one semi join.
    ``order_col`` orders rows uniquely (a line number, or ``file_order`` of the sales reader)."""
    order = F.struct(F.col(order_col), F.col("desc_index"))
    winners = rows.groupBy("id").agg(F.min(order).alias("__first")).select(
        F.col("id").alias("__id"), F.col(f"__first.{order_col}").alias("__order"))
    return rows.join(winners, (rows["id"] == F.col("__id")) & rows[order_col].eqNullSafe(F.col("__order")), "left_semi")


def incremental_new(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows whose id is not stored yet (one anti join instead of a lookup per row)."""
    return rows.join(existing.select("id"), "id", "left_anti")


def upsert(existing: DataFrame, new: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Rows of ``new`` replace stored rows with the same id; other stored rows stay. ``on`` names the id and columns that
    follow from it, if both sides are dealt to tasks by those already."""
    on = on or ["id"]
    return existing.join(new.select(*on), on, "left_anti").unionByName(new, allowMissingColumns=True)


def backfill_metadata(corpus: DataFrame, strict: bool = True) -> DataFrame:
    """Where ``length`` is NULL, fill length, tld ('' when no suffix is known) and has_numbers
    from the stored domain name. ``strict=False`` also fills rows that only lack tld or has_numbers.
    Adds ``backfilled`` (true for changed rows). Row by row: no join, no shuffle.
    """
    need = F.col("length").isNull()
    if not strict:
        need = need | F.col("tld").isNull() | F.col("has_numbers").isNull()
    parsed = parse_domain(corpus, "domain", default_tld="", prefix="__p_")
    fill = F.col("backfilled")  # fixed before any column is overwritten
    out = (parsed.withColumn("backfilled", need)
           .withColumn("length", F.when(fill, F.col("__p_length")).otherwise(F.col("length")))
           .withColumn("tld", F.when(fill, F.col("__p_tld")).otherwise(F.col("tld")))
           .withColumn("has_numbers", F.when(fill, F.col("__p_has_numbers")).otherwise(F.col("has_numbers"))))
    return out.drop(*[c for c in out.columns if c.startswith("__p_")])
