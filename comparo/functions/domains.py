"""Domain-name column expressions (P1 scalar parts, C10, C11, P15, P16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def host_of(name: Column | str) -> Column:
    """Host part of a domain or URL.

    Every ``http://`` and ``https://`` is removed, the text is cut at the
    first ``/``; then query, fragment, user info and port are dropped and
    trailing dots removed. Case is kept.
    """
    x = F.replace(F.replace(_c(name), F.lit("http://"), F.lit("")), F.lit("https://"), F.lit(""))
    h = F.split_part(x, F.lit("/"), F.lit(1))
    h = F.regexp_replace(h, r"[?#].*$", "")
    h = F.regexp_replace(h, r"^.*@", "")
    h = F.regexp_replace(h, r":.*$", "")
    return F.regexp_replace(h, r"\.+$", "")


def last_labels(host: Column | str, k: int) -> Column:
    """The last ``k`` dot-separated labels of ``host``; '' when it has fewer."""
    return F.regexp_extract(_c(host), last_labels_pattern(k), 1)


def last_labels_pattern(k: int) -> str:
    if k == 1:
        return r"([^.]*)$"
    return r"(?:^|\.)([^.]*(?:\.[^.]*){" + str(k - 1) + r"})$"


def digit_count(s: Column | str) -> Column:
    return F.length(F.regexp_replace(_c(s), r"[^0-9]", ""))


def has_numbers(sld: Column | str) -> Column:
    """True when the SLD contains an ASCII digit."""
    return F.coalesce(_c(sld).rlike(r"[0-9]"), F.lit(False))


def numeric_percentage(sld: Column | str) -> Column:
    """Share of ASCII digits in the SLD; 0.0 for an empty SLD."""
    s = _c(sld)
    n = F.length(s)
    return F.when(F.coalesce(n, F.lit(0)) == 0, F.lit(0.0)).otherwise(digit_count(s).cast("double") / n)


def is_multi_word(sld: Column | str) -> Column:
    """Hyphen, or a lower-case letter followed by an upper-case one."""
    s = _c(sld)
    return F.coalesce(s.contains("-") | s.rlike(r"[a-z][A-Z]"), F.lit(False))
