import pytest
from pyspark.sql import functions as F

from tessella.operators import timestamps as T

CASES = [
    ("2024-03-05", "2024-03-05"), (" 2024/3/5 ", "2024-03-05"), ("20240305", "2024-03-05"), ("5.3.2024", "2024-03-05"), ("05/03/24", "2024-03-05"), ("13/01/2024", "2024-01-13"), ("01/13/2024", "2024-01-13"), ("44267", "2021-03-12"),
    ("2021-W11-1", "2021-03-15"), ("5 Mart 2024", "2024-03-05"), ("05 AĞUSTOS 2024", "2024-08-05"), ("1 ARALIK 2023", "2023-12-01"), ("31st of March 2026", "2026-03-31"), ("Apr. 13, 2023", "2023-04-13"), ("Cuma, 10 Ekim 2025", "2025-10-10"),
    ("2024-07-05T10:00:00+03:00", "2024-07-05T07:00:00Z"), ("2024-07-05 10:00:00.123456-0500", "2024-07-05T15:00:00Z"), ("20240203T011344Z", "2024-02-03T01:13:44Z"), ("1675408066", "2023-02-03T07:07:46Z"), ("1675390787436", "2023-02-03T02:19:47Z"),
    ("Fri, 01 Aug 2025 11:19:59 +0300", "2025-08-01T08:19:59Z"), ("10 Apr 2023 17:17:06 BST", "2023-04-10T16:17:06Z"), ("2023-02-03T20:36Z", "2023-02-03T20:36:00Z"), ("2024-01-10 12:00:00 Europe/Paris", "2024-01-10T11:00:00Z"),
    ("10 Mart 2026 21:00", "2026-03-10T20:00:00Z"), ("10. April 2024, 08:48 Uhr", "2024-04-10T06:48:00Z"), ("10 février 2025 à 13h52", "2025-02-10T12:52:00Z"), ("4/9/2023 12:20:13 AM", "2023-09-03T22:20:13Z"), ("April 10, 2023 12:21 PM", "2023-04-10T10:21:00Z"),
    ("10.1.2025 - 12.15", "2025-01-10T11:15:00Z"),
    ("2024", None), ("2024-05", None), ("Q1 2024", None), ("geçen hafta", None), ("2024-13-01", None), ("2023-02-29", None), ("32.01.2024", None), ("2024-05-31T25:61:00Z", None), ("0000-00-00", None), ("Pazartesi, 10 Ekim 2025", None), ("", None), (None, None), ("x" * 100_000, None),
]


def run(spark, texts, zone="Europe/Berlin", order="DMY"):
    df = spark.createDataFrame([(i, t, "n", 7) for i, t in enumerate(texts)], "id int, text string, normal string, _t int")
    out = T.normalised(df, "text", F.lit(zone), F.lit(order))
    assert out.columns == ["id", "text", "_t", "normal", "status"]
    return [(r.normal, r.status) for r in out.orderBy("id").collect()]


def test_notations(spark):
    got = run(spark, [c[0] for c in CASES])
    for (text, want), (normal, status) in zip(CASES, got, strict=True):
        assert normal == want, (text and text[:40], normal, want)
        assert (status == "ok") == (want is not None)


def test_daylight_saving(spark):
    got = run(spark, ["2024-10-27 02:30:00", "2024-03-31 02:30:00", "2024-10-27 03:30:00", "2024-03-31 01:59:59"])
    assert got == [(None, "ambiguous"), (None, "nonexistent"), ("2024-10-27T02:30:00Z", "ok"), ("2024-03-31T00:59:59Z", "ok")]


def test_orders_and_missing_zones(spark):
    assert run(spark, ["02/03/2024"], order="MDY")[0][0] == "2024-02-03"
    assert run(spark, ["02/03/2024", "05/05/2024", "20/03/2024"], order=None) == [(None, "unread"), ("2024-05-05", "ok"), ("2024-03-20", "ok")]
    assert run(spark, ["2024-03-02 10:00"], zone=None) == [(None, "no_zone")]
    assert run(spark, ["2024-03-02 10:00"], zone="180") == [("2024-03-02T07:00:00Z", "ok")]


def test_against_zoneinfo(spark):
    from datetime import datetime, timedelta
    from zoneinfo import ZoneInfo

    zone = ZoneInfo("America/New_York")
    local = [datetime(2024, 3, 9) + timedelta(minutes=37 * i) for i in range(120)] + [datetime(2024, 11, 2) + timedelta(minutes=37 * i) for i in range(120)]
    want = []
    for t in local:
        ways = {(t.replace(tzinfo=zone, fold=f)).astimezone(ZoneInfo("UTC")) for f in (0, 1)}
        real = {w for w in ways if w.astimezone(zone).replace(tzinfo=None) == t}
        want.append(next(iter(real)).strftime("%Y-%m-%dT%H:%M:%SZ") if len(real) == 1 else None)
    got = run(spark, [t.strftime("%Y-%m-%dT%H:%M:%S") for t in local], zone="America/New_York")
    assert [g[0] for g in got] == want


def test_years_far_from_now(spark):
    from datetime import datetime
    from zoneinfo import ZoneInfo

    for zone in ("Europe/Berlin", "America/New_York", "Africa/Casablanca", "Asia/Kolkata", "Australia/Sydney"):
        texts = [f"{y:04d}-{m:02d}-15 10:00:00" for y in (1, 1700, 1893, 1916, 1945, 1985, 2037, 2045, 2099, 2190, 2191, 2192, 2193, 2200, 2400, 3001, 9999) for m in (2, 7)]
        utc = [datetime.fromisoformat(t).replace(tzinfo=ZoneInfo(zone)) for t in texts]
        want = [(u - u.utcoffset()).replace(tzinfo=None).strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0") if u.year > 1 or u.utcoffset().total_seconds() else None for u in utc]
        assert [g[0] for g in run(spark, texts, zone=zone)] == want


def test_blanks_and_fractions_of_any_length(spark):
    assert run(spark, ["2024-03-05" + " " * 500, " " * 300 + "5 Mart" + " " * 300 + "2024", "2024-07-05T10:00:00." + "1" * 300 + "Z"]) == [("2024-03-05", "ok"), ("2024-03-05", "ok"), ("2024-07-05T10:00:00Z", "ok")]


def test_empty(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("text", ["2024-03-05", "2024-07-05T07:00:00Z"])
def test_idempotent(spark, text):
    assert run(spark, [text])[0][0] == text
