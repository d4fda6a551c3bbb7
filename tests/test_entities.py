"""Flows over the domain tables against brute force, and the contracts, regions and searches."""

import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessella.functions import region, scalars
from tessella.operators import fuzzy, nearest, upsert
from tessella.plans import entities as E
from tessella.plans.scalars import asof
from tessella.sources import contracts, search


def test_report_lookup_against_all_pairs(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randrange(4, 8)))
    labels = [(i, f"{word()} {word()}", f"https://www.{word()}{i}.example/x" if i % 3 else None) for i in range(60)] + [(70, None, None), (71, "", "")]
    subjects = [(100 + k, " ".join(reversed(n.split())) + ("x" if k % 2 else ""), (w or "https://none.example").split("/")[2].removeprefix("www.") if k % 4 == 0 else "") for k, (_, n, w) in enumerate(labels[:40])] + [(900, None, None), (901, "", "")]
    got = {r.key: r.id for r in E.report_lookup(spark.createDataFrame(subjects, "key long, name string, host string"), spark.createDataFrame(labels, "id long, label string, website string")).collect()}
    want = {}
    for k, n, h in subjects:
        fits = [i for i, x, w in labels if (n and x and fuzzy.token_sort(n, x) >= 80) or (h and w and h in w)]
        if fits:
            want[k] = min(fits)
    assert got == want and len(want) > 30


def test_report_lookup_takes_hosts_at_any_place_and_of_any_length(spark):
    """Hosts behind 4,000 letters of an address, of less than four letters, and of more than are compared at a place."""
    far, long = "https://x.example/" + "p" * 5000 + "/", "h" * 73
    sites = [(1, far + "wanted.example"), (2, "https://a.b/x"), (3, f"https://{long}.example"), (4, f"https://{long}"), (5, far + long + ".org/wanted.example"), (6, None), (7, "")]
    hosts = [(10, "wanted.example"), (11, "a.b"), (12, long + ".org"), (13, long), (14, long + ".com"), (15, "b"), (16, ""), (17, None), (18, "é")]
    got = {r.key: r.id for r in E.report_lookup(spark.createDataFrame([(k, None, h) for k, h in hosts], "key long, name string, host string"), spark.createDataFrame([(i, None, w) for i, w in sites], "id long, label string, website string")).collect()}
    want = {k: min(fits) for k, h in hosts if h and (fits := [i for i, w in sites if w and h in w])}
    assert got == want == {10: 1, 11: 2, 12: 5, 13: 3, 15: 2}
    nobody = spark.createDataFrame([(1, None, None)], "key long, name string, host string")
    assert E.report_lookup(nobody, spark.createDataFrame(sites, "id long, website string").withColumn("label", F.lit("n"))).collect() == []


def test_similar_profiles_against_all_pairs(spark):
    rng = random.Random(4)
    words = ["data", "cloud", "crop", "route", "tax", "chat", "audit", "drone"]
    rows = [(i, f"n{i % 50}", " ".join(rng.choice(words) for _ in range(6))) for i in range(120)] + [(500, None, None), (501, "x", "short")]
    df = spark.createDataFrame(rows, "id long, name string, text string")
    q = [r for r in rows if r[0] % 20 == 0]
    for block in (2, 400):
        got = {}
        for r in E.similar(df.filter("id % 20 = 0"), df, 60, 10, block).collect():
            got.setdefault(r.id, []).append((-r.score, r.other))
        want = {}
        for i, n, t in q:
            if t and len(t) >= 10:
                best = sorted((-round(fuzzy.token_sort(t, u), 3), j) for j, m, u in rows if u and len(u) >= 10 and m != n and fuzzy.token_sort(t, u) >= 60)[:10]
                if best:
                    want[i] = best
        assert {k: sorted(v) for k, v in got.items()} == want


def test_similar_profiles_compare_only_rows_within_reach(spark):
    """Rows in several parts and blocks, among them ties at the k-th place and letters that share a number, against all pairs."""
    rng = random.Random(14)
    rows = [(i, f"n{i}", " ".join(rng.choice(["data", "ağaç", "crop", "🙂ute", "tax"]) for _ in range(5))) for i in range(90)] + [(300 + i, f"m{i}", "data crop tax data crop") for i in range(15)]
    df = spark.createDataFrame(rows, "id long, name string, text string")
    got = {}
    for r in E.similar(df.filter("id % 20 = 0"), df, 60, 10, 3, 20).collect():
        got.setdefault(r.id, []).append((-r.score, r.other))
    want = {i: sorted((-round(fuzzy.token_sort(t, u), 3), j) for j, m, u in rows if m != n and fuzzy.token_sort(t, u) >= 60)[:10] for i, n, t in rows if i % 20 == 0}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}


def test_nearest_compares_many_texts_at_once(monkeypatch):
    """Texts about the lengths at which a further word of bits begins, names that are missing and texts of several names, against all pairs; only long texts are compared one by one."""
    rng = random.Random(15)
    text = lambda n: "".join(rng.choice("abcdeş🙂 ") for _ in range(n))
    pool = [text(n) for n in (10, 30, 62, 63, 64, 65, 70, 126, 127, 128, 200, 600) for _ in range(3)]
    pool += [t[:-5] + text(6) for t in pool]
    name = lambda: rng.choice(["a", "b", None])
    held = {}
    for i in range(200):
        held.setdefault((name(), rng.choice(pool)), []).append(i)
    asked = sorted({(name(), t) for t in pool}, key=str)
    queries = pd.DataFrame([(str(i).encode(), *a) for i, a in enumerate(asked)], columns=["h", "name", "text"])
    rows = pd.DataFrame([(*a, np.array(ids[:3])) for a, ids in held.items()], columns=["name", "text", "ids"])
    one, seen = fuzzy._lcs, []
    monkeypatch.setattr(fuzzy, "_lcs", lambda m, n, b: seen.append(max(n, len(b))) or one(m, n, b))
    monkeypatch.setattr(nearest, "HELD", 50)
    got = {}
    for h, other, score in nearest.nearest(3, 60, queries, rows).itertuples(index=False):
        got.setdefault(h, []).append((-score, other))
    assert seen and min(seen) > nearest.LONG
    monkeypatch.undo()
    for h, n, t in queries.itertuples(index=False):
        want = sorted((-fuzzy.ratio(t, u), i) for (m, u), ids in held.items() if m != n for i in ids if fuzzy.ratio(t, u) >= 60)[:3]
        assert got.get(h, []) == want


def test_similar_profiles_written_alike(spark):
    """Records with the same name and text, more of them than are kept, and names that are missing."""
    rows = [(i, f"n{i % 2}" if i % 5 else None, "data crop tax route") for i in range(60)] + [(100 + i, "m", "data crop tax chat") for i in range(15)]
    df = spark.createDataFrame(rows, "id long, name string, text string")
    got = {}
    for r in E.similar(df.filter("id % 20 = 0 or id = 7"), df, 60, 4).collect():
        got.setdefault(r.id, []).append((-r.score, r.other))
    want = {i: sorted((-round(fuzzy.token_sort(t, u), 3), j) for j, m, u in rows if m != n)[:4] for i, n, t in rows if i % 20 == 0 or i == 7}
    assert {k: sorted(v) for k, v in got.items()} == want


def test_tags_corrected(spark, rows):
    index = spark.createDataFrame([("pay", "fraud", 3.0), ("farm", "crop", 2.0)], "tag string, keyword string, weight double")
    docs = spark.createDataFrame([(1, "crop yields", "pay"), (2, "fraud", "pay"), (3, "nothing", "pay"), (4, None, "pay")], "id long, description string, tag string")
    assert rows(E.tag_checked(docs, index)) == [(1, "farm", "replaced"), (2, "pay", "kept"), (3, "pay", "extractor"), (4, "pay", "kept")]


def test_repairs_by_the_names_in_news(spark, rows):
    known = spark.createDataFrame([(1, "Nova Merkur"), (2, "Befaya Turkenho"), (3, None)], "id long, label string")
    news = spark.createDataFrame([(10, "Yesterday Befaya Turkenho met Nova Merkur", "x"), (11, "nothing here", None), (12, None, "Nova Merkur grew"), (13, None, None)], "id long, headline string, summary string")
    deals = spark.createDataFrame([(100, 77, 10), (101, 77, 11), (102, 78, None), (103, 78, 12)], "id long, startup_id long, news_mention_id long")
    assert rows(E.orphan_deals(deals, news, known), "id", "startup_id") == [(100, 2), (101, -1), (102, -1), (103, 1)]
    found = E.rematched(E._texts_of(news), "id", "text", known)
    assert {(r.key, r.startup_id) for r in found.collect()} == {(10, 1), (10, 2), (12, 1)}


def test_names_in_news_of_any_length_and_with_errors(spark):
    """Links by tokens and by part of names shorter and longer than those that meet by places, against all pairs."""
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abdegiklmnorstuvyz") for _ in range(n)).title()
    long = word(fuzzy.PLACED)
    known = [(i, f"{word(6)} {word(8)}") for i in range(20)] + [(50, f"{long} {word(9)}"), (51, f"{word(fuzzy.PLACED - 8)} {word(7)}"), (52, "Ab Cd")]
    typo = lambda x, k: x[:k] + "x" + x[k + 1 :]
    news = [(100 + i, typo(n, 3) if i % 2 else f"{n}na", None) for i, n in known] + [(200, f"{long[:40]}{long[41:]} Xyz", None)]
    found = {(r.key, r.startup_id) for r in E.rematched(E._texts_of(spark.createDataFrame(news, "id long, headline string, summary string")), "id", "text", spark.createDataFrame(known, "id long, label string")).collect()}
    low = {i: n.lower() for i, n in known}
    for k, text, _ in news:
        scores = {i: fuzzy.token_sort(text.lower(), n) for i, n in low.items()}
        best = max(scores, key=lambda i: (scores[i], -i))
        want = {best} if scores[best] >= 88 else {i for i, n in low.items() if fuzzy.partial(text.lower(), n) >= 92 and i == min(j for j, m in low.items() if fuzzy.partial(text.lower(), m) >= 92)}
        assert {i for q, i in found if q == k} == want, text
    assert len(found) > 15
    assert {len(n) > fuzzy.PLACED for n in low.values()} == {False, True}


def test_scan_state_moves_on(spark, rows):
    state = spark.createDataFrame([("a", "2024-03-01"), ("b", None), ("c", "2024-03-01")], "source_name string, backfill_pointer string")
    page = spark.createDataFrame([("a", "2024-02-20"), ("a", "2024-02-10"), ("a", "2024-03-05"), ("c", "2024-03-01"), (None, "2020-01-01"), ("b", None)], "source_name string, day string")
    one = E.scan_state(state, page)
    assert rows(one) == [("a", 2, "2024-02-10"), ("b", 0, "2024-12-02"), ("c", 0, "2024-01-31")]
    assert rows(E.scan_state(one.drop("found"), page))[0] == ("a", 0, "2024-01-11")


def test_amounts_without_their_codes(spark):
    cases = [("500,000 GBP", 500_000, "GBP"), ("250000 GBP", 250_000, "GBP"), ("1.250.000,00 TRY", 1_250_000, "TRY"), ("4.5M USD", 4_500_000, "USD"), ("$5M", 5_000_000, "USD"), ("2 BİN TL", 2_000, "TRY"), ("3B EUR", 3e9, "EUR"), ("Unknown", None, None), (None, None, None), ("", None, None)]
    df = spark.createDataFrame([(i, a) for i, (a, *_) in enumerate(cases)], "id int, a string")
    got = df.orderBy("id").select(scalars.amount_of(F.col("a")), scalars.amount_code(F.col("a"))).collect()
    assert [(r[0], r[1]) for r in got] == [(v, c) for _, v, c in cases]


def test_rates_as_of(spark, rows):
    left = spark.createDataFrame([(1, "EUR", "2024-01-15"), (2, "EUR", "2019-01-01"), (3, "EUR", "2999-01-01"), (4, "XXX", "2024-01-01"), (5, None, None)], "id int, code string, d string").withColumn("day", F.to_date("d"))
    right = spark.createDataFrame([("EUR", "2024-02-01", 3.0), ("EUR", "2023-01-01", 1.0), ("EUR", "2024-01-10", 2.0)], "code string, d string, rate double").select("code", F.to_date("d").alias("since"), "rate")
    assert rows(asof(left, right, ["code"], "day", "since", "rate"), "id", "rate") == [(1, 2.0), (2, 1.0), (3, 3.0), (4, None), (5, None)]


def test_updates_with_several_changes_of_a_key(spark, rows):
    t = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    c = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (3, "w")], "id int, v string")
    assert rows(upsert.updated(t, c, ["id"])) == [(1, "y"), (2, "z")] and rows(upsert.updated(t, c, ["id"], keep_old=True)) == [(1, "a"), (2, "z")]


def test_contracts(spark):
    good = {"sector": "S", "tag": "T", "AI_Use_Case": "u", "business_model": "Product", "entity_type": "startup"}
    answers = [json.dumps(good), json.dumps({**good, "business_model": "Shop"}), json.dumps({k: v for k, v in good.items() if k != "tag"}), json.dumps({**good, "sector": 3}), "no", None, "[1]"]
    df = spark.createDataFrame([(i, a, i) for i, a in enumerate(answers)], "id int, answer string, tries int")
    got = {r.id: (list(r.issues), r.route) for r in contracts.routed(df, "answer", "classes", most=3).collect()}
    assert got[0] == ([], "accept") and got[1] == (["business_model not in list"], "retry") and got[2] == (["tag missing"], "retry") and got[3] == (["sector of another type"], "review")
    assert got[4] == got[5] == got[6] == (["no answer"], "review")
    news = spark.createDataFrame([(json.dumps({"headline": ["a"], "event_type": "x", "companies": "c"}),)], "a string")
    assert list(contracts.checked(news, "a", "news").first().issues) == ["companies of another type"]


def test_region(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"name": "Nordland", "domestic": ["nordstadt"], "searches": {"startup": ["{name} {year}"]}}))
    r = region.load(str(path))
    assert r.queries("startup", "Acme", 2024) == ["Acme 2024"] and r.queries("other", "Acme", 2024) == ["Acme"] and region.load().name == "Turkey"
    df = spark.createDataFrame([("Nordstadt, X",), ("Ankara",), (None,)], "p string")
    assert [x[0] for x in df.select(r.is_domestic(F.col("p"))).collect()] == [True, False, False]
    path.write_text('{"nme": 1}')
    with pytest.raises(ValueError):
        region.load(str(path))


def test_news_research_and_memo(spark, tmp_path, rows):
    path = tmp_path / "a.jsonl"
    hits = [{"title": "T", "url": "http://a.example/1", "published": "2024-05-20"}, {"title": "U", "url": "http://a.example/2", "published": "2023-01-01"}, {"title": "V", "url": "http://b.example/2024/3"}, {"title": "T again", "url": "http://a.example/1", "published": "2024-05-20"}]
    path.write_text("\n".join(json.dumps({"query": t.format(name="Acme"), "results": hits if b != "market" else hits[:1] + [{"url": "http://c.example"}]}) for b, t in search.BUCKETS.items()))
    r = search.search(spark, ["Acme news"], str(path))
    assert rows(search.news(r, "2024-05-31", 30), "pos", "url") == [(1, "http://a.example/1"), (2, "http://b.example/2024/3")]
    assert rows(search.news(r, "2024-05-31", hosts=["b.example"]), "url") == [("http://b.example/2024/3",)]
    assert rows(search.researched(spark, "Acme", str(path)), "bucket", "url") == [("about", "http://a.example/1"), ("about", "http://a.example/2"), ("about", "http://b.example/2024/3"), ("market", "http://c.example")]
    memo, calls = search.Memo(), []
    for _ in range(2):
        memo.get("k", lambda: calls.append(1) or spark.range(3)).count()
    memo.forget()
    assert calls == [1] and not memo.kept
