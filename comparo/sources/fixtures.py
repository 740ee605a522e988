"""Comparable-sales shaped data derived from the driver tables.

The driver tables carry no domain sales, so a corpus of sold domains is derived from them, from whole tables:

* Every ``part`` row is sold as one domain, or as several when there are more documents or vectors than two for
  each part, so that every row of every table read has its place at any size. Price and platform are the part's.
* The whole key is part of the name, so names and ids are unique at any size.
* The sale date is the first, middle or last order date of the part's line items.
* Each domain has two descriptions, numbered through: description ``r`` has the text of document ``r`` and vector ``r``,
  both counted round when there are fewer.

The same derivation is written in SQL in ``comparo.oracle`` for the DuckDB check.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comparo import config
from comparo.functions.domains import has_numbers
from comparo.sources.tables import read_table

# Fixed values of the derivation (also in the SQL form).
TLD_CYCLE = [".com", ".com", ".net", ".org", ".io", ".ai", ".co.uk", ".zz"]


def _pick(values: list[str], idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sold domain: dk, domain, sld, tld, length, price, sale_date, categories, platform."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    n_parts = part.count()
    rows = max(read_table(spark, sf_dir, t).count() for t in ("documents", "embeddings"))
    copies = max(1, math.ceil(rows / (2 * max(n_parts, 1))))
    day = F.col("o_orderdate").cast("date")
    sold = (read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
            .join(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"),
                  F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("l_partkey").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")))
    middle = F.date_add("first_day", F.floor(F.datediff("last_day", "first_day") / 2).cast("int"))
    dk = F.col("dk")
    d = (part.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left")
         .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
         .withColumn("dk", F.col("p_partkey") + F.col("copy") * F.lit(n_parts).cast("bigint")))
    # the key in letters (no z among them) after a z, or in digits: the name gives the key back
    letters = F.concat(F.lit("z"), F.translate(dk.cast("string"), "0123456789", "abcdefghij"))
    sld = F.concat(F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)),
                   F.when(dk % 5 == 0, (F.lit(10000) + dk).cast("string")).otherwise(letters))
    cats = config.CATEGORIES
    return d.select(
        dk,
        F.concat(sld, _pick(TLD_CYCLE, dk % 8)).alias("domain"),
        sld.alias("sld"),
        _pick(TLD_CYCLE, dk % 8).alias("tld"),
        F.length(sld).cast("int").alias("length"),
        F.col("p_retailprice").alias("price"),
        F.when(dk % 3 == 0, F.col("last_day")).when(dk % 3 == 1, F.col("first_day")).otherwise(middle)
        .cast("string").alias("sale_date"),
        _pick(cats, dk % 11).alias("primary_category"),
        _pick(cats, (dk % 11 + 1 + dk % 3) % 11).alias("secondary_category"),
        F.col("p_brand").alias("platform"),
    )


def _counted(table: DataFrame, key: str, value: str, alias: str, row) -> tuple[DataFrame, F.Column]:
    """(lookup, its key of description ``row``): the rows of a table, counted round."""
    lookup = table.select(F.col(key).alias(f"{alias}_key"), F.col(value).alias(alias))
    return lookup, row % F.lit(max(table.count(), 1)).cast("bigint")


def _described(d: DataFrame, spark: SparkSession, sf_dir: str, vectors: bool) -> DataFrame:
    """The two descriptions of each domain: desc_index, text and, with ``vectors``, embedding. Texts come last, since rows
    that have them already would be moved whole to meet their vectors."""
    rows = d.withColumn("desc_index", F.explode(F.array(F.lit(1), F.lit(2))))
    row = F.col("dk") * 2 + F.col("desc_index") - 1
    if vectors:
        vecs, vec_key = _counted(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "embedding", row)
        rows = rows.withColumn("embedding_key", vec_key).join(vecs, "embedding_key", "left").drop("embedding_key")
    texts, text_key = _counted(read_table(spark, sf_dir, "documents"), "doc_id", "text", "text", row)
    return rows.withColumn("text_key", text_key).join(texts, "text_key", "left").drop("text_key")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (domain, description): id, metadata columns, document text, embedding."""
    joined = _described(domains(spark, sf_dir), spark, sf_dir, vectors=True)
    document = F.concat(
        F.lit("Domain: "), F.col("domain"), F.lit(". Category: "), F.col("primary_category"), F.lit(", "),
        F.col("secondary_category"), F.lit(". Description: "), F.coalesce(F.col("text"), F.lit("")))
    return joined.select(
        F.concat(F.col("domain"), F.lit("__desc"), F.col("desc_index").cast("string")).alias("id"),
        "dk", "domain", "sld", "tld", "length", "price", "sale_date", "primary_category", "secondary_category",
        "platform", "desc_index", has_numbers(F.col("sld")).alias("has_numbers"), document.alias("document"),
        "embedding",
    )


def queries_in(spark: SparkSession, sf_dir: str, corpus_df: DataFrame | None = None) -> DataFrame:
    """Search inputs: every sold domain searches for its comparables, one query per stored vector.

    The input is also in the corpus and is not excluded from its own results.
    """
    c = corpus_df if corpus_df is not None else corpus(spark, sf_dir)
    return c.select(
        F.col("dk").alias("input_id"), F.col("desc_index").alias("query_index"),
        F.col("domain").alias("input_domain"), "sld", "tld", "length", "primary_category", "secondary_category",
        has_numbers(F.col("sld")).alias("has_numbers"), *[x for x in ("embedding",) if x in c.columns],
    )


def inputs_in(spark: SparkSession, sf_dir: str, corpus_df: DataFrame | None = None) -> DataFrame:
    """The search inputs as one row each, with their two descriptions (the document texts) in order."""
    c = corpus_df if corpus_df is not None else corpus(spark, sf_dir)
    text = F.struct("desc_index", F.regexp_extract("document", r"(?s)\. Description: (.*)$", 1).alias("text"))
    # moved once, as the results will meet them
    c = c.withColumnRenamed("dk", "input_id").withColumnRenamed("domain", "input_domain").repartition("input_id")
    return c.groupBy("input_id", "input_domain", "sld", "tld", "length", "primary_category", "secondary_category").agg(
        F.transform(F.array_sort(F.collect_list(text)), lambda x: x["text"]).alias("descriptions"))


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sales-file shape, with nulls, blanks, padding and bad prices."""
    docs = read_table(spark, sf_dir, "documents")
    dk = F.col("dk")
    t1, k1 = _counted(docs, "doc_id", "text", "t1", dk * 2)
    t2, k2 = _counted(docs, "doc_id", "text", "t2", dk * 2 + 1)
    j = (domains(spark, sf_dir).withColumn("t1_key", k1).withColumn("t2_key", k2)
         .join(t1, "t1_key", "left").join(t2, "t2_key", "left"))
    domain = (F.when(dk % 17 == 0, F.lit(None).cast("string")).when(dk % 19 == 0, F.lit("   "))
              .when(dk % 7 == 0, F.concat(F.lit(" "), F.col("domain"), F.lit(" "))).otherwise(F.col("domain")))
    price = (F.when(dk % 11 == 0, F.lit(None).cast("string")).when(dk % 13 == 0, F.lit("n/a"))
             .otherwise(F.concat(F.lit("$1,"), (F.lit(100) + dk % 900).cast("string"), F.lit(".50"))))
    d1 = F.when(dk % 23 == 0, F.lit("")).otherwise(F.col("t1"))
    d2 = (F.when(dk % 3 == 0, F.lit(None).cast("string")).when(dk % 5 == 0, F.lit(" "))
          .otherwise(F.col("t2")))
    return j.select(
        dk.alias("line_no"), domain.alias("domain"), price.alias("price"), d1.alias("description_1"),
        d2.alias("description_2"), "primary_category", "secondary_category", "platform",
        F.col("sale_date").alias("date"),
    )


def pairs(spark: SparkSession, sf_dir: str, corpus_df: DataFrame | None = None) -> DataFrame:
    """Scoring pairs: each corpus row (the input side, ``a``) with the row of the next domain that has
    the same description index (the candidate side, ``b``)."""
    c = corpus_df if corpus_df is not None else corpus(spark, sf_dir)
    a = c.select(F.col("dk").alias("a_dk"), F.col("id").alias("id_a"), F.col("desc_index").alias("a_desc"),
                 F.col("tld").alias("in_tld"), F.col("length").alias("in_length"),
                 F.col("primary_category").alias("in_primary"),
                 F.col("secondary_category").alias("in_secondary"), F.col("embedding").alias("emb_a"))
    b = c.select(F.col("dk").alias("b_dk"), F.col("id").alias("id_b"), F.col("desc_index").alias("b_desc"),
                 F.col("tld").alias("cand_tld"), F.col("length").alias("cand_length"),
                 F.col("primary_category").alias("cand_primary"),
                 F.col("secondary_category").alias("cand_secondary"), F.col("sale_date"),
                 F.col("embedding").alias("emb_b"))
    return a.join(b, (F.col("b_dk") == F.col("a_dk") + 1) & (F.col("b_desc") == F.col("a_desc")))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored provider responses, one per sold domain, some of them malformed on purpose."""
    d = domains(spark, sf_dir)
    dk = F.col("dk")
    head = F.concat(F.lit('{"domain": "'), F.col("domain"), F.lit('", "primary_category": "'))
    prim = F.when(dk % 19 == 0, F.lit("Premium")).otherwise(F.col("primary_category"))
    sec = F.col("secondary_category")

    def obj(second, tail):
        return F.concat(head, prim, F.lit('", "secondary_category": "'), second, F.lit('"'), tail, F.lit("}"))
    good_desc = F.concat(F.lit(', "descriptions": ["A '), F.lower(prim), F.lit(" name for "), F.col("sld"),
                         F.lit('.", "Used by '), F.col("platform"), F.lit(' buyers."'),
                         F.when(dk % 3 == 0, F.lit(', "A third idea."')).otherwise(F.lit("")), F.lit("]"))
    resp = (F.when(dk % 13 == 0, F.concat(F.lit('{"domain": "'), F.col("domain"), F.lit('", "primary_category": ')))
            .when(dk % 17 == 0, F.lit("[1, 2]"))
            .when(dk % 11 == 0, obj(sec, F.lit("")))
            .when(dk % 9 == 0, obj(prim, good_desc))
            .when(dk % 7 == 0, obj(sec, F.lit(', "descriptions": []')))
            .when(dk % 23 == 0, obj(sec, F.lit(', "descriptions": ["  ", ""]')))
            .when(dk % 5 == 0, obj(sec, F.lit(', "descriptions": "not a list"')))
            .otherwise(obj(sec, good_desc)))
    return d.select(dk.alias("input_id"), "domain", resp.alias("response"))


def repeated_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored responses with a broken second answer for every sixth domain, whose text sorts before the good one."""
    r = responses(spark, sf_dir).select("domain", "response", "input_id")
    broken = r.where(F.col("input_id") % 6 == 0).withColumn("response", F.lit("[bad"))
    return r.unionByName(broken).drop("input_id")


def corpus_with_gaps(spark: SparkSession, sf_dir: str, corpus_df: DataFrame | None = None) -> DataFrame:
    """The corpus as stored before the metadata backfill: every fourth domain lacks length, tld and
    has_numbers (one in eight lacks only has_numbers)."""
    c = corpus_df if corpus_df is not None else corpus(spark, sf_dir)
    dk = F.col("dk")
    gap = dk % 4 == 0
    return (c.withColumn("length", F.when(gap, F.lit(None).cast("int")).otherwise(F.col("length")))
            .withColumn("tld", F.when(gap, F.lit(None).cast("string")).otherwise(F.col("tld")))
            .withColumn("has_numbers", F.when(gap | (dk % 8 == 1), F.lit(None).cast("boolean"))
                        .otherwise(F.col("has_numbers"))))
