"""Public-suffix split (J3), TLD families (J2) and domain parsing.

A host is matched against its last 1..K labels (K = most labels of any
suffix) and the longest match wins. The built-in list (family TLDs plus a
few multi-label suffixes) is a literal inside the expression. A user list
such as the full public suffix list (some 10k rules) is counted: up to
``LOOKED_UP`` rules become one broadcast table that every host looks its
suffixes up in, shortest first, in one pass over Arrow batches without any
join, whatever K is. More rules are a table joined once per label count.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comparo import config
from comparo.functions import domains as D

LOOKED_UP = 200_000  # rules of a broadcast table, some 20 MB in a worker
KINDS = {"normal": 1, "wildcard": 2, "exception": 4}


def suffix_table(spark: SparkSession, suffixes: list[str] | None = None) -> DataFrame:
    """Suffix rules as a table (``suffix``, ``kind``). Lines follow the public suffix list format:
    ``co.uk`` (normal), ``*.ck`` (wildcard: any label under ``ck``), ``!www.ck`` (exception)."""
    rows = set()
    for line in (suffixes or config.suffix_rows()):
        line = line.strip().lower()
        if not line or line.startswith("//"):
            continue
        if line.startswith("!"):
            rows.add((line[1:], "exception"))
        elif line.startswith("*."):
            rows.add((line[2:], "wildcard"))
        else:
            rows.add((line, "normal"))
    return spark.createDataFrame(sorted(rows), "suffix string, kind string")


def _most_labels(suffixes: DataFrame) -> int:
    """Most labels that a rule covers; a wildcard rule covers one more than it names."""
    extra = F.when(F.col("kind") == "wildcard", 1).otherwise(0)
    return int(suffixes.agg(F.max(F.size(F.split("suffix", r"\.")) + extra)).first()[0] or 1)


def longest_suffix(host: str | None, rules: Mapping[str, int], most: int) -> str:
    """Public suffix of ``host`` by ``rules`` (lower-case suffix -> sum of its ``KINDS``), in the host's letter case; '' if no
    rule matches. An exception rule wins: the suffix is the rule without its leftmost label. Else the longest match."""
    if host is None:
        return ""
    labels = host.split(".")
    best, exception, below = "", None, 0
    for k in range(1, min(most, len(labels)) + 1):
        own = ".".join(labels[-k:])
        kinds = rules.get(own.lower(), 0)
        if kinds & KINDS["exception"]:
            exception = ".".join(labels[1 - k:]) if k > 1 else ""
        # "*.ck" names one label and covers two; the covered label must exist
        if kinds & KINDS["normal"] or below & KINDS["wildcard"] and own:
            best = own
        below = kinds
    return best if exception is None else exception


def _looked_up(host: F.Column, table: DataFrame, most: int) -> F.Column:
    kinds = F.sum(F.when(F.col("kind") == "normal", KINDS["normal"]).when(F.col("kind") == "wildcard", KINDS["wildcard"])
                  .when(F.col("kind") == "exception", KINDS["exception"]))
    rows = table.select("suffix", "kind").distinct().groupBy("suffix").agg(kinds.alias("kinds")).collect()
    shared = table.sparkSession.sparkContext.broadcast({r.suffix: r.kinds or 0 for r in rows})

    @F.pandas_udf("string")
    def suffix(hosts: pd.Series) -> pd.Series:
        rules = shared.value
        return pd.Series([longest_suffix(h, rules, most) for h in hosts], dtype=object)

    return suffix(host)


def _sql_str(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _known_suffix(cand: F.Column, suffixes: list[str]) -> F.Column:
    # one parsed literal instead of one JVM call per entry
    return F.array_contains(F.expr("array(" + ", ".join(_sql_str(x) for x in suffixes) + ")"), cand)


def split_suffix(df: DataFrame, host_col: str, suffixes: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """Add ``{prefix}suffix`` (longest known suffix, '' if none) and ``{prefix}sld``.

    SLD = the label just before the suffix; with no known suffix it is the
    last label. Lookup is case-insensitive, output keeps the input case.
    The built-in suffix list (~80 entries) is a literal in the expression;
    a user list (e.g. the full public suffix list, with ``*.`` wildcard and
    ``!`` exception rules) is a broadcast table, or joined once per label
    count if it has more than ``LOOKED_UP`` rules.
    """
    host = F.col(host_col)
    out = df
    hits: dict[int, F.Column] = {}
    looked_up = None
    if suffixes is not None:
        table = suffixes if "kind" in suffixes.columns else suffixes.withColumn("kind", F.lit("normal"))
        k_max = _most_labels(table)
        if table.count() <= LOOKED_UP:
            looked_up = _looked_up(host, table, k_max)
    if looked_up is not None:
        pass
    elif suffixes is None:
        known = sorted({x.lower() for x in config.suffix_rows()})
        k_max = max(x.count(".") + 1 for x in known)
        for k in range(1, k_max + 1):
            hits[k] = _known_suffix(F.lower(D.last_labels(host, k)), known)
    else:
        kinds = [F.max(F.col("kind") == kind).alias(kind) for kind in ("normal", "wildcard", "exception")]
        rules = table.groupBy("suffix").agg(*kinds)
        found: dict[int, dict[str, F.Column]] = {}
        for k in range(1, k_max + 1):  # rules of k labels; no hint: the planner knows or measures the table's size
            lookup = rules.select(F.col("suffix").alias(f"__rule{k}"),
                                  *[F.col(kind).alias(f"__{kind}{k}") for kind in ("normal", "wildcard", "exception")])
            out = out.withColumn(f"__rule{k}", F.lower(D.last_labels(host, k))).join(lookup, f"__rule{k}", "left")
            found[k] = {kind: F.coalesce(F.col(f"__{kind}{k}"), F.lit(False))
                        for kind in ("normal", "wildcard", "exception")}
        for k in range(1, k_max + 1):
            hits[k] = found[k]["normal"]
            if k > 1:  # "*.ck" names one label and covers two; the covered label must exist
                hits[k] = hits[k] | (found[k - 1]["wildcard"] & (D.last_labels(host, k) != ""))
        exceptions = {k: found[k]["exception"] for k in found}
        # an exception rule wins: the suffix is the rule without its leftmost label
        exc_suffix = F.lit(None).cast("string")
        for k in sorted(exceptions):
            exc_suffix = F.when(exceptions[k], D.last_labels(host, k - 1) if k > 1 else F.lit("")).otherwise(
                exc_suffix)
    suffix_expr = F.lit("")
    for k in sorted(hits):  # longest match wins: later (longer) checks override
        suffix_expr = F.when(hits[k], D.last_labels(host, k)).otherwise(suffix_expr)
    if looked_up is not None:
        suffix_expr = looked_up
    elif suffixes is not None:
        suffix_expr = F.coalesce(exc_suffix, suffix_expr)
    out = out.withColumn(f"{prefix}suffix", suffix_expr)
    sfx = F.col(f"{prefix}suffix")
    rest = F.when(sfx == "", host).otherwise(F.left(host, F.greatest(F.length(host) - F.length(sfx) - 1, F.lit(0))))
    out = out.withColumn(f"{prefix}sld", D.last_labels(rest, 1))
    if suffixes is not None:
        out = out.drop(*[c for c in out.columns
                         if c.startswith(("__rule", "__normal", "__wildcard", "__exception"))])
    return out


def parse_domain(df: DataFrame, name_col: str = "domain", suffixes: DataFrame | None = None,
                 default_tld: str = ".com", prefix: str = "") -> DataFrame:
    """Add sld, tld, length, is_multi_word, has_numbers, numeric_percentage (names get ``prefix``).

    ``default_tld`` is used when no suffix is known ('.com' on the query and
    CSV paths, '' on the metadata backfill path). Row-preserving. No shuffle, but for a
    user list of more than ``LOOKED_UP`` rules, which is joined.
    """
    out = df.withColumn("__host", D.host_of(F.col(name_col)))
    out = split_suffix(out, "__host", suffixes, prefix="__")
    sld = F.col("__sld")
    out = (
        out.withColumn(f"{prefix}sld", sld)
        .withColumn(f"{prefix}tld", F.when(F.col("__suffix") == "", F.lit(default_tld)).otherwise(
            F.concat(F.lit("."), F.col("__suffix"))))
        .withColumn(f"{prefix}length", F.length(sld).cast("int"))
        .withColumn(f"{prefix}is_multi_word", D.is_multi_word(sld))
        .withColumn(f"{prefix}has_numbers", D.has_numbers(sld))
        .withColumn(f"{prefix}numeric_percentage", D.numeric_percentage(sld))
    )
    return out.drop("__host", "__suffix", "__sld")


def tld_family(tld: F.Column) -> F.Column:
    """J2 as an expression: family of a TLD, 'other' when unknown (the fixed table is a literal map)."""
    literal = "map(" + ", ".join(f"{_sql_str(t)}, {_sql_str(fam)}" for t, fam in config.family_rows()) + ")"
    return F.coalesce(F.try_element_at(F.expr(literal), tld), F.lit("other"))


def tld_key(tld: F.Column) -> F.Column:
    """Blocking key of the TLD filter (P10): the family when known, else the TLD itself."""
    fam = tld_family(tld)
    return F.when(fam == "other", tld).otherwise(fam)


def with_tld_family(df: DataFrame, tld_col: str = "tld", out_col: str = "tld_family") -> DataFrame:
    return df.withColumn(out_col, tld_family(F.col(tld_col)))


def with_tld_key(df: DataFrame, tld_col: str = "tld", out_col: str = "tld_key") -> DataFrame:
    return df.withColumn(out_col, tld_key(F.col(tld_col)))
