from pyspark.sql import functions as F

from tessella.llm import golden as G


def test_order_ties_and_hot_group(spark, rows):
    data = [(i, 1, 50, "2024-01-01T00:00:00Z") for i in range(100, 400)] + [(5, 1, 90, None), (6, 1, 90, "2024-05-01 10:00:00"), (7, 1, 90, "2024-05-01T12:59:00+03:00"), (8, 1, 250, "2025-01-01T00:00:00Z"), (9, 1, None, "2025-01-01T00:00:00Z"), (20, 2, None, ""), (21, 2, -1, "Unknown"), (30, None, 5, None)]
    df = spark.createDataFrame([(*r, "x", "y") for r in data], "id long, g long, conf int, upd string, status string, at2 string")
    x = G.with_instant(df, "upd", "at")
    got = rows(G.kept(x, "g", [G.trust(F.col("conf")).desc_nulls_last(), F.col("at").desc_nulls_last(), F.col("id").asc()], "id"), "g", "id")
    assert got == sorted([(1, 6), (2, 20), (None, 30)], key=repr)


def test_fractions_decide(spark, rows):
    df = spark.createDataFrame([(1, 1, "2024-01-01T00:00:00.2Z"), (2, 1, "2024-01-01T00:00:00.300000Z"), (3, 1, "2024-01-01T00:00:00Z")], "id long, g long, upd string")
    x = G.with_instant(df, "upd", "at")
    assert rows(G.kept(x, "g", [F.col("at").desc_nulls_last(), F.col("id").asc()], "id"), "id") == [(2,)]


def test_merged_field_by_field(spark, rows):
    df = spark.createDataFrame([(1, "A", None, 9), (1, "Unknown", "c", 5), (1, "B", "d", 1), (2, None, "nan", 3)], "g long, a string, b string, trust int")
    assert rows(G.merged(df, "g", ["a", "b"], -F.col("trust"))) == [(1, 3, "A", "c"), (2, 1, None, None)]


def test_empty(spark):
    df = spark.createDataFrame([], "id long, g long, upd string")
    assert G.kept(G.with_instant(df, "upd", "at"), "g", [F.col("id").asc()], "id").count() == 0


def test_named_zones_and_fractions(spark):
    df = spark.createDataFrame([(1, "2024-05-01 10:00 Europe/Istanbul"), (2, "2024-05-01T07:00:00.25Z"), (3, "1985-05-01 10:00:00 Europe/Berlin"), (4, None)], "id int, t string")
    assert [r["at"] for r in G.with_instant(df, "t", "at").orderBy("id").collect()] == ["2024-05-01T07:00:00.000000000", "2024-05-01T07:00:00.250000000", "1985-05-01T08:00:00.000000000", None]
