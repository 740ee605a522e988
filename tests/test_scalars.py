"""Truth tables for the scalar functions, checked against plain-Python statements of each rule."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from comparo import config
from comparo.functions import scoring as S
from comparo.functions import vectors as V
from comparo.functions.domains import has_numbers, is_multi_word, numeric_percentage
from comparo.functions.text import extract_description, strip_ws


def expected_category(cp, cs, ip, isec):
    if cp == ip:
        return 1.0
    if cs == ip or cp == isec:
        return 0.7
    for a, b in config.COMPATIBLE_CATEGORY_PAIRS:
        if {cp, ip} <= {a, b}:
            return 0.5
    return 0.0


def test_category_match_all_combinations(spark):
    cats = config.CATEGORIES
    rows = list(itertools.product(cats, cats, cats, cats))
    df = spark.createDataFrame(rows, "cp string, cs string, ip string, isec string")
    got = df.select("*", S.category_match("cp", "cs", "ip", "isec").alias("m")).collect()
    assert len(got) == 11 ** 4
    bad = [r for r in got if r.m != expected_category(r.cp, r.cs, r.ip, r.isec)]
    assert not bad, bad[:5]


def test_recency_band_edges(spark):
    as_of = dt.datetime(2001, 8, 1)
    cases = []
    for days, w in [(0, 1.0), (89, 1.0), (90, 0.9), (179, 0.9), (180, 0.8), (364, 0.8), (365, 0.6), (729, 0.6),
                    (730, 0.3), (5000, 0.3), (-3, 1.0)]:
        cases.append(((as_of - dt.timedelta(days=days)).strftime("%Y-%m-%d"), w))
    cases += [(None, 0.5), ("", 0.5), ("nan", 0.5), ("2024", 0.5), ("2001-02-30", 0.5),
              ("2001-07-31T12:00:00Z", 1.0), ("2001-05-03T00:00:00+00:00", 0.9)]
    df = spark.createDataFrame(cases, "d string, w double")
    got = df.select("d", "w", S.recency_weight("d", F.lit("2001-08-01 00:00:00").cast("timestamp")).alias("r"))
    bad = [r for r in got.collect() if r.r != r.w]
    assert not bad, bad
    const = df.select(S.recency_weight("d", F.current_timestamp(), config.Settings(recency="constant")).alias("r"))
    assert {r.r for r in const.collect()} == {0.5}


def test_semantic_similarity_guards(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (-1.0,), (float("nan"),), (None,)], "d double")
    got = [r.s for r in df.select(S.semantic_similarity("d").alias("s")).collect()]
    assert got == [1.0, 0.5, 0.5, 0.5, 1.0]


def test_clean_price(spark):
    cases = [("$1,234.50", 1234.5), ("12", 12.0), (" 7 ", 7.0), ("n/a", 0.0), (None, 0.0), ("nan", 0.0),
             ("1e3", 1000.0), ("$", 0.0), ("1d", 0.0), ("-5", -5.0)]
    df = spark.createDataFrame(cases, "p string, want double")
    bad = [r for r in df.select("p", "want", S.clean_price("p").alias("got")).collect() if r.got != r.want]
    assert not bad, bad


def test_numeric_and_word_features(spark):
    df = spark.createDataFrame([("web3",), ("1234",), ("",), ("helloWorld",), ("a-b",), ("abc",)], "s string")
    got = df.select("s", has_numbers("s").alias("h"), numeric_percentage("s").alias("p"),
                    is_multi_word("s").alias("m")).collect()
    assert [(r.h, r.p, r.m) for r in got] == [(True, 0.25, False), (True, 1.0, False), (False, 0.0, False),
                                             (False, 0.0, True), (False, 0.0, True), (False, 0.0, False)]


def test_extract_description(spark):
    cases = [
        ("Domain: a.com. Category: X, Y. Description: Hello there ", "Hello there"),
        ("Domain: a.com.Category: X,Y Description:Tight", "Tight"),
        ("Domain: a.com. Category: X, Y. Description:first Description: second", "second"),
        ("Domain: a.com. Category: X, Y. Descriptions are . :missing", "s are . :missing"),
        ("Domain: a.com. Category: X, Y. Description -  dashed", "-  dashed"),
        ("no markers at all", ""),
        (None, ""),
        ("Domain: a.com. Category: X, Y. Description: ", ""),
    ]
    df = spark.createDataFrame(cases, "doc string, want string")
    got = df.select("doc", "want", extract_description("doc").alias("got")).collect()
    bad = [r for r in got if r.got != r.want]
    assert not bad, bad


def test_strip_ws_matches_python(spark):
    texts = ["  a  ", "\n\t b \r\n", " c　", "", "   ", "d"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.s for r in df.select(strip_ws("t").alias("s")).collect()]
    assert got == [t.strip() for t in texts]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, b array<float>")
    r = df.select(V.l2_distance("a", "b").alias("d"), V.normalize("a").alias("n"), V.normalize("b").alias("z"),
                  V.cosine_distance("a", "a").alias("c"), V.from_text(V.to_text("a")).alias("t")).first()
    assert r.d == 5.0
    assert [round(x, 6) for x in r.n] == [0.6, 0.8]
    assert r.z == [0.0, 0.0]
    assert abs(r.c) < 1e-12
    assert r.t == [3.0, 4.0]


def test_strip_looks_at_the_ends_only(spark):
    """As str.strip, also for characters of several bytes, and by no regular expression."""
    from comparo.functions.text import strip_ws
    space = [chr(x) for x in range(0x3001) if chr(x).isspace()]
    texts = ["", None, "a", " a b ", "\u200b x\u200b", "".join(space), "\u00e9 \u65e5\u3000", "\ud83d\ude00".encode("utf-16", "surrogatepass").decode("utf-16")]
    texts += [f"{s}x{s}y{s}\n" for s in space] + [f"{chr(x)}z{chr(x)}" for x in (0x08, 0x0E, 0x1B, 0x84, 0x180E, 0x200B, 0x2060, 0xFEFF)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip_ws("t").alias("s"))
    assert all(r.s == (None if r.t is None else r.t.strip()) for r in df.collect())
    assert "regexp" not in df._jdf.queryExecution().executedPlan().toString()
