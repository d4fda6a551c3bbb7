from pyspark.sql import functions as F

from tessella.sources import pages, sinks


def test_html_and_json():
    assert pages.html_text("<p>A&amp;B<script>x</script><br>c</p>") == "A&B c"
    assert pages.html_text(None) is None and pages.html_text("<b>" + "x" * 9000, None) == "x" * 9000
    assert pages.json_in('Sure: ```json\n{"a": "}", "b": {"c": 1}}\n``` done') == {"a": "}", "b": {"c": 1}}
    assert pages.json_in("no") is None and pages.json_in("{bad} {\"a\": 1}") == {"a": 1}


def test_pages(spark, rows):
    df = spark.createDataFrame([(1, "<i>a</i> b"), (2, None)], "id long, html string")
    assert rows(pages.page_texts(df), "id", "page_text") == [(1, "a b"), (2, None)]
    dead = spark.createDataFrame([("This Domain is for sale",), ("© 2019 Acme",), ("© 2025 Acme",), (None,)], "h string")
    assert [r[0] for r in dead.select(pages.is_dead(F.col("h"))).collect()] == [True, True, False, False]


def test_search_results_and_cache(spark, rows):
    raw = spark.createDataFrame([("Title: T\nUrl: http://a\nSnippet: S\n\nTitle: no address\n\nUrl: http://b",)], "raw string")
    assert rows(pages.parse_results(raw)) == [("http://a", "T", "S"), ("http://b", "", "")]
    cache = spark.createDataFrame([("k", "2024-01-01 00:00:00", "old"), ("k", "2024-01-01 05:00:00", "new"), ("z", "2023-01-01 00:00:00", "x")], "key string, at string, value string").select("key", F.to_timestamp("at").alias("cached_at"), "value")
    assert rows(pages.fresh(cache, F.to_timestamp(F.lit("2024-01-01 06:00:00")), 6), "key", "value") == [("k", "new")]


def test_extractor_stub(spark, rows):
    df = spark.createDataFrame([(1, "headline"), (2, None)], "id long, text string")
    assert rows(pages.extracted(df, pages.Stub(), "id", "text", 2), "id", "headline") == [(1, "headline"), (2, "")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b"), (2, None)], "id long, v string")
    sinks.swapped(df, str(tmp_path / "t"), "1")
    sinks.swapped(df.limit(1), str(tmp_path / "t"), "2")
    assert sinks.current(spark, str(tmp_path / "t")).count() == 1 and sinks.exists(spark, str(tmp_path / "t/v=1"))
    assert sinks.js_constants({"X": df.orderBy("id")}) == 'const X = [{"id": 1, "v": "a|b"}, {"id": 2}];'
    assert "| 1 | a\\|b |" in sinks.markdown("R", {"s": df, "none": df.limit(0)})
    assert sinks.page("<p>{{n}}</p>{{constants}}", "c", {"n": 3}) == "<p>3</p>c"


def test_search_source(spark, tmp_path, rows):
    import json

    from tessella.sources import search as S

    path = tmp_path / "answers.jsonl"
    path.write_text("\n".join(json.dumps(a) for a in [{"query": "a", "results": [{"title": "T 2021", "url": "http://x/1"}, {"title": "U", "url": "http://x/2020/2", "published": "2019-05-01"}]}, {"query": "b", "results": []}, {"query": "c", "results": [{"url": "http://y"}]}]))
    got = rows(S.search(spark, ["a", "b", "zzz"], str(path)), "query", "pos", "url", "year")
    assert got == [("a", 1, "http://x/1", 2021), ("a", 2, "http://x/2020/2", 2019)]
    one = spark.createDataFrame([("u", "first")], "url string, text string")
    two = spark.createDataFrame([("u", "second"), ("v", "x" * 5000)], "url string, text string")
    assert [(u, len(t), c) for u, t, c in rows(S.gathered({"news": one, "web": two}), "url", "text", "channel")] == [("u", 5, "news"), ("v", 2000, "web")]
