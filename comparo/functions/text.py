"""String helpers as Column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip() removes (str.isspace).
_WS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                        0x202F, 0x205F, 0x3000]))


def strip_ws(c: Column | str) -> Column:
    """Remove leading and trailing whitespace (Spark ``trim`` alone removes spaces only). Looks at the ends of a text, where a
    regular expression walks over all of it."""
    c = F.col(c) if isinstance(c, str) else c
    return F.btrim(c, F.lit(_WS))


def extract_description(document: Column | str) -> Column:
    """Description text of a corpus document.

    Text after the first ``"Description: "``; if absent, after the first
    ``"Description:"``; else, from the part after the first ``"Category:"``,
    the text after its first ``"Description"`` with leading ``": ."``
    characters removed. Stripped; empty when nothing matches or the document
    is null.
    """
    d = F.col(document) if isinstance(document, str) else document
    p1 = F.instr(d, "Description: ")
    p2 = F.instr(d, "Description:")
    after1 = F.substring(d, p1 + F.lit(len("Description: ")), 1 << 30)
    after2 = F.substring(d, p2 + F.lit(len("Description:")), 1 << 30)
    # Fallback path: first "Category:" segment, then first "Description" in the rest.
    seg = F.split(d, "Category:", -1)
    remaining = F.get(seg, 1)
    p3 = F.instr(remaining, "Description")
    after3 = F.substring(remaining, p3 + F.lit(len("Description")), 1 << 30)
    fallback = strip_ws(F.regexp_replace(after3, r"^[: .]+", ""))
    primary = F.when(p1 > 0, strip_ws(after1)).when(p2 > 0, strip_ws(after2))
    has_fb = (F.size(seg) > 1) & (p3 > 0)
    out = F.when(primary.isNotNull() & (primary != ""), primary).when(has_fb, fallback)
    return F.coalesce(out, F.lit(""))
