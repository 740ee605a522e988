"""Scoring column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from comparo import config
from comparo.config import Settings
from comparo.functions.text import strip_ws


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def category_match(cand_primary, cand_secondary, in_primary, in_secondary) -> Column:
    """1.0 same primary; 0.7 crossed primary/secondary; 0.5 compatible primaries; else 0.0.

    Equality is null-safe, as Python ``==`` treats two missing values as equal.
    """
    cp, cs, ip, isec = (_c(x) for x in (cand_primary, cand_secondary, in_primary, in_secondary))
    compatible = F.lit(False)
    for a, b in config.COMPATIBLE_CATEGORY_PAIRS:
        compatible = compatible | ((cp == a) & (ip == b)) | ((cp == b) & (ip == a))
    return (
        F.when(cp.eqNullSafe(ip), F.lit(1.0))
        .when(cs.eqNullSafe(ip) | cp.eqNullSafe(isec), F.lit(0.7))
        .when(F.coalesce(compatible, F.lit(False)), F.lit(0.5))
        .otherwise(F.lit(0.0))
    )


def tld_match(cand_tld, in_tld, cand_family, in_family) -> Column:
    """1.0 same TLD; 0.7 same known family ('other' never matches); else 0.0.

    The families come from ``operators.suffix.with_tld_family``. The ".com vs
    other" branch of the original compares a family name with a TLD and can
    never fire, so it is not written out.
    """
    ct, it, cf, inf = (_c(x) for x in (cand_tld, in_tld, cand_family, in_family))
    return (
        F.when(ct.eqNullSafe(it), F.lit(1.0))
        .when((cf == inf) & (cf != "other"), F.lit(0.7))
        .otherwise(F.lit(0.0))
    )


ISO_DATE_PREFIX = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def sale_timestamp(date_text: Column | str) -> Column:
    """ISO date/time text -> wall-clock TIMESTAMP_NTZ; NULL when it does not start with YYYY-MM-DD or is
    invalid. A trailing offset or ``Z`` is read and the time shown in the session time zone."""
    d = _c(date_text)
    return F.when(d.rlike(ISO_DATE_PREFIX), F.try_to_timestamp(d).cast("timestamp_ntz"))


def age_days(date_text: Column | str, as_of: Column) -> Column:
    """Whole days elapsed (floored) from the sale to ``as_of``, on wall-clock time (independent of daylight
    saving changes in the session time zone)."""
    ts = sale_timestamp(date_text)
    micros = F.timestamp_diff("MICROSECOND", ts, as_of.cast("timestamp_ntz"))
    return F.floor(micros / F.lit(86_400_000_000))


def recency_weight(date_text: Column | str, as_of: Column, settings: Settings = config.DEFAULT) -> Column:
    """Age bands, or the constant 0.5 when ``settings.recency == 'constant'``."""
    if settings.recency == "constant":
        return F.lit(config.RECENCY_UNPARSABLE)
    days = age_days(date_text, as_of)
    expr = F.when(days.isNull(), F.lit(config.RECENCY_UNPARSABLE))
    for limit, weight in config.RECENCY_BANDS:
        expr = expr.when(days < limit, F.lit(weight))
    return expr.otherwise(F.lit(config.RECENCY_OLDEST))


def semantic_similarity(distance: Column | str) -> Column:
    """C4: 1/(1+d) for d >= 0; 0.5 for negative or NaN; a missing distance counts as 0."""
    d = F.coalesce(_c(distance).cast("double"), F.lit(0.0))
    return F.when(F.isnan(d) | (d < 0), F.lit(0.5)).otherwise(F.lit(1.0) / (F.lit(1.0) + d))


def composite_score(sem: Column, cat: Column, rec: Column, settings: Settings = config.DEFAULT) -> Column:
    """Weighted sum over the unrounded parts."""
    return (F.lit(settings.weight_semantic) * sem + F.lit(settings.weight_category) * cat
            + F.lit(settings.weight_recency) * rec)


NUMERIC_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def clean_price(price_text: Column | str) -> Column:
    """Drop '$' and ',', parse as DOUBLE; anything unparsable, NULL or NaN -> 0.0."""
    t = F.regexp_replace(_c(price_text), r"[$,]", "")
    v = F.when(t.rlike(NUMERIC_TEXT), strip_ws(t).try_cast("double"))
    return F.coalesce(v, F.lit(0.0))
