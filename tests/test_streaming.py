from pyspark.sql import functions as F

from tessella.streaming import news

SCHEMA = "id long, url_hash string, event_category string, at timestamp"


def feed(spark, tmp_path, batches):
    src = str(tmp_path / "in")
    for i, b in enumerate(batches):
        spark.createDataFrame(b, "id long, url_hash string, event_category string, at string").withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(f"{src}/{i}")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)


def drained(q):
    q.processAllAvailable()
    q.stop()


BATCHES = [[(1, "a", "x", "2024-01-01 00:00:00"), (2, "a", "x", "2024-01-01 01:00:00")], [(3, "a", "y", "2024-01-01 02:00:00"), (4, "b", "x", "2024-01-09 00:00:00")], [(5, "c", "x", "2024-01-30 00:00:00")]]


def test_once_and_counts(spark, tmp_path, rows):
    s = feed(spark, tmp_path, BATCHES)
    drained(news.once(s).writeStream.format("memory").queryName("once").outputMode("append").start())
    assert {r.url_hash for r in spark.sql("select url_hash from once").collect()} == {"a", "b", "c"} and spark.table("once").count() == 3
    drained(news.counted(s).writeStream.format("memory").queryName("counts").outputMode("append").start())
    assert sum(r.n for r in spark.table("counts").collect()) == 4  # the last window is still open


def test_upserts_replay(spark, tmp_path):
    s = feed(spark, tmp_path, BATCHES)
    for i in (1, 2):
        q = news.upserting(s, str(tmp_path / "out"), str(tmp_path / f"cp{i}"))
        q.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 4, 5]


def test_articles_without_a_hash_replay(spark, tmp_path):
    s = feed(spark, tmp_path, [[(1, None, "x", "2024-01-01 00:00:00"), (2, None, "y", "2024-01-01 00:00:00"), (3, "a", "x", "2024-01-01 00:00:00")]])
    for i in (1, 2):
        news.upserting(s, str(tmp_path / "out"), str(tmp_path / f"cp{i}")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_failures(spark, tmp_path):
    src = str(tmp_path / "checks")
    for i, signals in enumerate([2, 2, 2, 0]):
        spark.createDataFrame([(1, signals), (2, 2)], "id long, signals int").coalesce(1).write.mode("append").parquet(f"{src}/{i}")
    s = spark.readStream.schema("id long, signals int").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)
    drained(news.failures(s).writeStream.format("memory").queryName("failures").outputMode("update").start())
    got = {(r.id, r.failures, r.status) for r in spark.table("failures").collect()}
    assert (2, 4, "Stale") in got and (1, 0, "Active") in got and (1, 3, "Stale") in got
