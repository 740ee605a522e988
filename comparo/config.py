"""Settings for comparable-sales search.

Every value that has to equal the behaviour being reproduced is listed once,
below, under "Fixed values". Everything else in the package reads from a
``Settings`` instance so callers can override limits and weights per run.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must stay as written for matching results)
# ---------------------------------------------------------------------------

# Category names, in their published order.
CATEGORIES = [
    "Acronym",
    "Brandable",
    "Combination",
    "Descriptive",
    "Exact match",
    "Geo-specific",
    "Generic",
    "Service-based",
    "Niche",
    "Keyword",
    "Product-based",
]

# TLD families: family name -> member TLDs. No TLD belongs to two families.
TLD_FAMILIES = {
    "legacy_gold": [".com"],
    "legacy_standard": [".net", ".org", ".info"],
    "tech_modern": [".ai", ".io", ".co", ".app", ".dev", ".tech", ".cloud", ".software"],
    "corporate_id": [".inc", ".llc", ".ltd", ".biz", ".company", ".corp", ".holdings"],
    "ecommerce": [".shop", ".store", ".market", ".buy", ".deals", ".solutions", ".services"],
    "niche_premium": [".bet", ".gg", ".game", ".tv", ".casino", ".poker"],
    "creative": [".design", ".art", ".media", ".studio", ".agency", ".photography", ".news"],
    "finance_web3": [".finance", ".money", ".pay", ".crypto", ".cash", ".bank"],
    "geo_tier1": [".de", ".uk", ".ca", ".au", ".fr", ".nl", ".jp", ".us", ".eu"],
    "geo_tier2": [".in", ".cn", ".br", ".me", ".sg", ".hk", ".kr", ".it", ".es", ".ch"],
    "generic_modern": [".xyz", ".online", ".site", ".website", ".space", ".fun", ".life", ".world", ".live",
                       ".digital"],
}

# Unordered category pairs that count as compatible (score 0.5).
COMPATIBLE_CATEGORY_PAIRS = [
    ("Brandable", "Generic"),
    ("Descriptive", "Keyword"),
    ("Service-based", "Product-based"),
    ("Niche", "Generic"),
]

# Recency bands: (age in days strictly below, weight); older than the last band -> 0.3.
RECENCY_BANDS = [(90, 1.0), (180, 0.9), (365, 0.8), (730, 0.6)]
RECENCY_OLDEST = 0.3
RECENCY_UNPARSABLE = 0.5

# Multi-label public suffixes shipped beside the family TLDs (users may pass a full list).
EXTRA_SUFFIXES = ["co.uk", "com.au", "co.jp", "com.br", "co.in"]

# Fallback enrichment used when a provider response is invalid.
FALLBACK_PRIMARY = "Brandable"
FALLBACK_SECONDARY = "Service-based"
FALLBACK_DESCRIPTION_1 = "{domain} is a premium domain suitable for branding purposes in various industries."
FALLBACK_DESCRIPTION_2 = ("This domain could be used for a company providing services in technology, healthcare, "
                          "or business sectors.")
FALLBACK_ERROR_PREFIX = "Enrichment failed (using mock data): "
FALLBACK_WARNING = "Used mock data due to API issues"

# Profile length histogram: (label, low, high) inclusive; high None = open.
LENGTH_BUCKETS = [("1-3 chars", 1, 3), ("4-6 chars", 4, 6), ("7-10 chars", 7, 10), ("11-15 chars", 11, 15),
                  ("16+ chars", 16, None)]

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """Tunable limits and weights. Defaults reproduce the reference behaviour."""

    max_length_diff: int = 2
    results_per_query: int = 50
    final_top_k: int = 10
    min_score: float = 0.4
    min_results_for_no_fallback: int = 10
    tld_fallback: bool = True
    numeric_filter: bool = True
    numeric_threshold: float = 0.3
    weight_semantic: float = 0.6
    weight_category: float = 0.2
    weight_recency: float = 0.2
    # "bands" = documented age bands; "constant" = 0.5 for every row (what the
    # reference returns in practice, because its date lookup always fails).
    recency: str = "bands"
    high_confidence_min: int = 5
    # kNN tiling: mean corpus rows and query rows of one group. Corpus rows are copied once per query tile of their
    # block and queries once per corpus tile; a task works on a slice of the queries at a time.
    knn_tile_rows: int = 65536
    knn_query_tile_rows: int = 65536
    # extra candidates re-ranked with exact distances after the matmul pre-rank.
    knn_rerank_margin: int = 16
    # cells with bounds for blocks of several tiles: "auto" (when a sample shows that they pay), "always", "never"
    knn_prune: str = "auto"


DEFAULT = Settings()


def family_rows() -> list[tuple[str, str]]:
    """(tld, family) rows of the family table."""
    return [(t, fam) for fam, tlds in TLD_FAMILIES.items() for t in tlds]


def suffix_rows() -> list[str]:
    """Known public suffixes without the leading dot."""
    return [t[1:] for t, _ in family_rows()] + list(EXTRA_SUFFIXES)
