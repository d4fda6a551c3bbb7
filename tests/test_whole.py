"""Queries over every row, hot keys and marked letters too, against brute force."""

import __spark_entry__ as entry

Q = entry.queries()


def folder(spark, path, **tables):
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_fan_out_of_the_hot_startup(spark, tmp_path, rows):
    news = [(i, 1 if i % 2 else i % 7, "funding" if i % 3 else "award") for i in range(200)] + [(900, None, "funding"), (901, -1, "funding")]
    deals = [(1 if i % 2 else i % 9, i % 11 or None) for i in range(150)] + [(None, 3)]
    d = folder(spark, tmp_path, news_mentions=(news, "id long, startup_id long, event_type string"), investments=(deals, "startup_id long, investor_id long"))
    want = sorted(((i, v) for i, s, e in news if e == "funding" for t, v in set(deals) if v is not None and s is not None and s == t), key=repr)
    assert any(s == 1 for _, s, _ in news) and rows(Q["j15_fan_out"](spark, d), "id", "investor_id") == want


def test_same_city_of_every_year_and_letter(spark, tmp_path, rows):
    towns = ["İstanbul", "istanbul", "İSTANBUL", "ISTANBUL", "İZMİR", "izmir", "Iğdır", "ığdır", "Ankara", "ANKARA", "", None]
    startups = [(i, towns[i % len(towns)], 2015 if i % 5 == 0 else 2000 + i % 9) for i in range(90)]
    investors = [(i, towns[(i * 7) % len(towns)]) for i in range(50)]
    d = folder(spark, tmp_path, startups=(startups, "id long, city string, founded_year int"), investors=(investors, "investor_id long, location string"))
    low = lambda t: t.replace("İ", "i").lower()
    want = sorted(((i, v) for i, c, _ in startups for v, t in investors if c and t and low(c) == low(t)), key=repr)
    assert rows(Q["f12_same_city"](spark, d), "id", "investor_id") == want


def test_orphans_of_deals_dated_in_any_notation(spark, tmp_path, rows):
    dates = ["2023-11-05", "22/11/2023", "23 Nisan 2022", "Tue, 01 Nov 2022 17:03:00 +0300", "2022-11-01T01:00:00+03:00", "2024-05", "junk", None]
    d = folder(
        spark, tmp_path, startups=([(1, None)], "id long, first_seen string"), investors=([(1,)], "investor_id long"), news_mentions=([(7, 99, None, "2024-02-01T00:00:00Z")], "id long, startup_id long, investor_id long, scanned_at string"),
        investments=([(i, 1, 99, None, x) for i, x in enumerate(dates)], "id long, startup_id long, investor_id long, news_mention_id long, investment_date string"),
    )
    got = rows(Q["p5_report"](spark, d).filter("tab = 'investments'"), "period", "n_rows")
    assert got == sorted([("2023-11", 2), ("2022-04", 1), ("2022-11", 1), ("2022-10", 1), ("2024-05", 1), (None, 2)], key=repr)
    assert rows(Q["p5_report"](spark, d).filter("tab = 'news_mentions'"), "period", "n_rows") == [("2024-02", 1)]
