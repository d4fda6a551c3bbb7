import pytest

from tessella.operators import units as U

CASES = [
    ("$5M", None, None, 5_000_000, "USD"), ("1.250.000,00 TL", None, None, 1_250_000, "TRY"), ("100.000 usd", None, None, 100_000, "USD"), ("98000.0 usd", None, None, 98_000, "USD"), ("1,000,000", "eur", None, 1_000_000, "EUR"),
    ("CHF 100'000.–", None, None, 100_000, "CHF"), ("2 000 000 euro", None, None, 2_000_000, "EUR"), ("3464万円", None, None, 34_640_000, "JPY"), ("10 crore INR", None, None, 100_000_000, "INR"), ("13 lakh rupees", None, None, 1_300_000, "INR"),
    ("9 MİLYON TÜRK LİRASI", None, None, 9_000_000, "TRY"), ("86 BİN USD", None, None, 86_000, "USD"), ("99 bın Franken", None, None, 99_000, "CHF"), ("five million GBP", None, None, 5_000_000, "GBP"), ("yarım milyon $", None, None, 500_000, "USD"),
    ("on milyon lira", None, None, 10_000_000, "TRY"), ("70", "Unknown", "figures in thousands; amounts in USD", 70_000, "USD"), ("2 Euro", None, "milyon cinsinden", 2_000_000, "EUR"), ("~US$110 thousand", None, None, 110_000, "USD"),
    ("raised €1.5 million in new equity", None, None, 1_500_000, "EUR"), ("toplam 2,4 milyon sterlin yatırım", None, None, 2_400_000, "GBP"), ("1.7B JPY", None, None, 1_700_000_000, "JPY"), ("₺9MM", None, None, 9_000_000, "TRY"), ("EUR 83bin", None, None, 83_000, "EUR"),
    ("$1M-$2M", None, None, None, None), ("up to $1 million", None, None, None, None), ("over €3M", None, None, None, None), ("$<3M", None, None, None, None), ("1-4 milyon USD", None, None, None, None), ("5M", "Unknown", None, None, None), ("Undisclosed", "USD", None, None, None),
    ("12 USD", None, None, None, None), ("", "USD", None, None, None), (None, "USD", "amounts in USD", None, None), ("5M XYZ", None, None, None, None), ("1" * 100_000, "USD", None, None, None),
]
RATES = [("USD", 1.0), ("EUR", 1.0842), ("GBP", 1.2716), ("TRY", 0.0293), ("JPY", 0.0067), ("CHF", 1.1258), ("AED", 0.2723), ("INR", 0.0118)]


def run(spark, cases):
    df = spark.createDataFrame([(i, a, c, n, 1.0, "keep", "s") for i, (a, c, n, *_) in enumerate(cases)], "id int, amount string, code string, notes string, usd double, _a string, currency_code string")
    out = U.readings(df, "amount", "code", "notes", spark.createDataFrame(RATES, "currency_code string, usd_per_unit double"), "usd")
    assert out.columns == ["id", "amount", "code", "notes", "_a", "currency_code", "sum", "sum_currency", "usd", "n_readings", "residual"]
    return out.orderBy("id").collect()


def test_readings(spark):
    rate = dict(RATES)
    for case, r in zip(CASES, run(spark, CASES), strict=True):
        want, code = case[3:]
        assert (r["sum"], r.sum_currency) == (want, code), (case[:3], r)
        assert r["_a"] == "keep" and r.currency_code == "s"
        if want:
            assert r.usd == pytest.approx(want * rate[code]) and r.n_readings == 1


def test_evidence_is_only_reported(spark):
    a = run(spark, [("1,234 million USD", None, None)])[0]
    assert a["sum"] == 1_234_000 and a.n_readings == 2 and a.residual == pytest.approx(6.0913, abs=1e-3)


@pytest.mark.parametrize(("identity", "case", "all_of_them", "without"), [("beside", ("2 thousand USD", None, "in millions"), 2_000, 2_000_000), ("noted", ("1234 USD", None, "in thousands"), 1_234_000, 1_234), ("mark", ("250.000 USD", None, "in thousands"), 250_000_000, 250_000), ("least", ("500 USD", None, None), None, 500), ("cents", ("12345.678 USD", None, None), None, 12_345.678)])
def test_each_identity_counts(spark, identity, case, all_of_them, without):
    df = spark.createDataFrame([case], "amount string, code string, notes string")
    rates = spark.createDataFrame(RATES, "currency_code string, usd_per_unit double")
    read = lambda i: U.readings(df, "amount", "code", "notes", rates, identities=i).first()["sum"]
    assert read(U.IDENTITIES) == all_of_them
    assert read(tuple(x for x in U.IDENTITIES if x != identity)) == without


def test_long_texts(spark):
    long = ["the round of " + "very " * 400 + "5 million USD", "1 000" * 30_000, "1.000" * 30_000, "2 " * 50_000, "million " * 20_000, ("9" * 40 + " USD")]
    got = run(spark, [(t, None, None, None, None) for t in long])
    assert [r["sum"] for r in got][:5] == [5_000_000, None, None, None, None]


def test_empty(spark):
    assert run(spark, []) == []
