import pytest
from pyspark.sql import functions as F

from tessella.functions import scalars as S
from tessella.functions import taxonomy, urls

TEXT = [
    ("sector", taxonomy.sector_of, "Finance | Fintech", "Finance"), ("sector", taxonomy.sector_of, "Finance|Fintech", None), ("sector", taxonomy.sector_of, "None", None), ("tag", taxonomy.tag_of, "Finance | Fintech", "Fintech"), ("small", S.small, "ISPARTA", "ısparta"),
    ("ascii", S.asciified, "çağdaş", "cagdas"), ("suffix", S.without_suffix, "Acme Teknoloji A.Ş.", "Acme"), ("suffix", S.without_suffix, "Acme", "Acme"), ("currency", S.currency_in, "INDUSTRY 5", "TRY"), ("currency", S.currency_in, "5", "Unknown"), ("sign", S.currency_by_sign, "₹5 USD", "INR"),
    ("sign", S.currency_by_sign, "5 chf", "CHF"), ("sign", S.currency_by_sign, "5", None), ("funding", S.funding_value, "83.000.000,00 USD", 83e6), ("funding", S.funding_value, "$5M", 5e6), ("funding", S.funding_value, "600000000 USD", None), ("funding", S.funding_value, "5B USD", 5e9),
    ("funding", S.funding_value, "Over $1.76B in funding across 411 rounds", 1.76e9), ("funding", S.funding_value, "Undisclosed", None), ("funding text", S.funding_text, "$5M", "5,000,000 USD"), ("amount", S.amount_of, "1.250.000,00 TRY", 1.25e6), ("amount", S.amount_of, "1.250.000 USD", 1.25e6), ("amount", S.amount_of, "5 milyar TL", 5e9),
    ("legacy", lambda c: S.amount_of(c, True), "5 milyar TL", 5e6), ("legacy", lambda c: S.amount_of(c, True), "1.250.000 USD", None), ("round", S.round_type, "seri a", "Series A"), ("round", S.round_type, " ", "NA"), ("round", S.round_type, "Bridge", "Bridge"), ("round", S.round_type, None, "NA"),
    ("place", S.place, "Istanbul", "İstanbul"), ("place", S.place, "Boston, USA", "Boston, United States"), ("place", S.place, "N/A", None), ("place", S.place, "Besiktas, Istanbul, Türkiye", "Besiktas, İstanbul, Turkey"), ("origin", S.origin, "Ankara", "Domestic"), ("origin", S.origin, "Paris", "International"), ("origin", S.origin, None, "Unknown"),
    ("terms", S.terms, "b, a, B ,a", "a, b"), ("terms", S.terms, "None", "None"), ("founders", S.founders, '["\\u00c7a", "B"]', "Ça, B"), ("founders", S.founders, "[]", "Unknown"), ("founders", S.founders, "A, B", "A, B"), ("company", S.company_fault, "Acme", None), ("company", S.company_fault, "ab", "short"),
    ("company", S.company_fault, "acme.com", "junk"), ("company", S.company_fault, "Acme haberleri", "scraped"), ("investor", S.investor_fault, "Minister of X", "political"), ("investor", S.investor_fault, "7 Ventures", "digit"), ("site", urls.is_own_site, "netflix.com", False), ("site", urls.is_own_site, None, True),
    ("spam", urls.is_spam, "https://a.bydfi.com/x", True), ("spam", urls.is_spam, "https://notbydfi.com/x", False), ("host", urls.host, "HTTP://A.b.com:80/x", "a.b.com"), ("news", S.news_score, "LLM three", -1), ("news", S.news_score, "llm funding", 3), ("year", S.first_year, "in 1999 and 2020", 1999), ("year", S.first_year, "x", None),
    ("model", S.business_model, "SaaS", "Product"), ("model", S.business_model, "x", "Unknown"), ("tokens", S.token_estimate, " a b  c ", 3), ("tokens", S.token_estimate, None, 0), ("slug", urls.slugged, "A & B!", "a-b"), ("cloud", S.cloud_signal, "runs on AWS", "positive"), ("cloud", S.cloud_signal, "on-premise", "negative"),
]


@pytest.mark.parametrize(("name", "f", "value", "want"), TEXT)
def test_values(spark, name, f, value, want):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(f(F.col("v")).alias("x")).first()["x"] == want


def test_confidence(spark):
    df = spark.createDataFrame([("s" * 400, None, 0, 104), ("coming soon " * 40, "c" * 500, 9, 0), (None, None, 0, 10_000)], "site string, ctx string, passes int, age int")
    got = [r[0] for r in df.select(S.confidence(F.col("site"), F.col("ctx"), F.lit(True), F.col("passes"), F.col("age"))).collect()]
    assert got == [53, 65, 0]


def test_first_confidence(spark):
    df = spark.createDataFrame([("d", "w", "c", None), ("unknown", "w", "c", "x"), (None, None, None, None)], "d string, w string, c string, f string")
    assert [r[0] for r in df.select(S.first_confidence([F.col("d"), F.col("w"), F.col("c")], [F.col("f")])).collect()] == [35, 35, 0]


def test_repaired_pairs(spark):
    df = spark.createDataFrame([("Finance", "Fintech"), ("Nope", "Fintech"), ("Health", "Nope"), ("x", "SaaS & Platforms"), (None, None)], "sector string, tag string")
    got = [tuple(r) for r in taxonomy.repaired(df, "sector", "tag").select("new_sector", "new_tag").collect()]
    assert sorted(got) == sorted([("Finance", "Fintech"), ("Finance", "Fintech"), ("Health", "Healthtech"), ("Technology", "Software Development"), ("General", "Uncategorized")])


@pytest.mark.parametrize("f", [S.terms, S.place, S.round_type, S.small, S.without_suffix])
def test_idempotent(spark, f):
    df = spark.createDataFrame([(v,) for v in ("b, a, B", "Istanbul, USA", "seri a", "ÇAĞ A.Ş.", "", None)], "v string")
    once = df.select(f(F.col("v")).alias("v"))
    assert [r[0] for r in once.collect()] == [r[0] for r in once.select(f(F.col("v"))).collect()]
