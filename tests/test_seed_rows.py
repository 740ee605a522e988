"""The nine seed rows that stood in for tests in the original service (S11), as a unit fixture.

Stored lengths are kept as given (the first row says 25 for a 26-letter name), one platform name has a
Cyrillic letter, and no row has ``has_numbers``.
"""

from pyspark.sql import functions as F

from comparo.operators import corpus_ops as C
from comparo.operators import profile as PR

SEED = [  # id, domain, tld, stored length, primary, secondary, price, date, platform
    ("domain_0", "communityservicefoundation.com", ".com", 25, "Exact match", "Service-based", 45000.0, "2024-01-15",
     "GoDaddy"),
    ("domain_1", "wellnessfoundationinc.com", ".com", 21, "Combination", "Descriptive", 55000.0, "2024-02-20",
     "Namecheap"),
    ("domain_2", "socialimpactfoundation.com", ".com", 22, "Descriptive", "Service-based", 48000.0, "2024-03-01",
     "GoDaddy"),
    ("domain_3", "trust.ai", ".ai", 5, "Brandable", "Service-based", 150000.0, "2024-02-20", "Sedо"),
    ("domain_4", "techflow.io", ".io", 8, "Brandable", "Service-based", 125000.0, "2024-03-01", "GoDaddy"),
    ("domain_5", "peacehaven.org", ".org", 10, "Descriptive", "Service-based", 25000.0, "2024-01-15", "GoDaddy"),
    ("domain_6", "cloudsecure.com", ".com", 11, "Combination", "Product-based", 180000.0, "2024-01-30", "Sedо"),
    ("domain_7", "healthtech.com", ".com", 10, "Combination", "Service-based", 95000.0, "2024-02-10", "GoDaddy"),
    ("domain_8", "businesspro.com", ".com", 11, "Generic", "Service-based", 55000.0, "2023-12-01", "Namecheap"),
]


def seed_corpus(spark):
    return spark.createDataFrame(
        SEED, "id string, domain string, tld string, length int, primary_category string, "
              "secondary_category string, price double, sale_date string, platform string"
    ).withColumn("has_numbers", F.lit(None).cast("boolean")).withColumn("desc_index", F.lit(1))


def test_seed_profile(spark):
    corpus = seed_corpus(spark)
    s = PR.summary(corpus).first()
    assert (s.total_documents, s.unique_domains, s.small_corpus) == (9, 9, True)
    assert (s.min_price, s.max_price, s.total_price) == (25000.0, 180000.0, 778000.0)
    assert abs(s.avg_price - 778000.0 / 9) < 1e-9
    assert (s.earliest_sale, s.latest_sale) == ("2023-12-01", "2024-03-01")
    assert (s.len_1_3, s.len_4_6, s.len_7_10, s.len_11_15, s.len_16_up) == (0, 1, 3, 2, 3)
    assert (s.with_numbers, s.without_numbers) == (0, 9)
    tld = [(r.value, r.documents) for r in PR.tld_distribution(corpus).orderBy("rank").collect()]
    assert tld == [(".com", 6), (".ai", 1), (".io", 1), (".org", 1)]
    cat = [(r.value, r.documents) for r in PR.category_distribution(corpus).orderBy("rank").collect()]
    assert cat == [("Combination", 3), ("Brandable", 2), ("Descriptive", 2), ("Exact match", 1), ("Generic", 1)]
    assert PR.sample_domains(corpus).count() == 9


def test_seed_backfill_keeps_stored_lengths(spark):
    out = {r.id: (r.length, r.has_numbers, r.backfilled) for r in C.backfill_metadata(seed_corpus(spark)).collect()}
    # only a missing length triggers the backfill: the wrong stored 25 stays
    assert out["domain_0"] == (25, None, False)
    filled = {r.id: (r.has_numbers, r.backfilled)
              for r in C.backfill_metadata(seed_corpus(spark), strict=False).collect()}
    assert filled["domain_0"] == (False, True)
