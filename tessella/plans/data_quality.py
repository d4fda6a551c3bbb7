"""Packed fields, orphans, timestamps and units over the domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import multivalue, orphans, timestamps, units
from ..session import table
from .registry import Registry

R = Registry()
LISTS = ["founders", "Investors", "Tech_Mentioned"]
KEYS = {"startups": "id", "investors": "investor_id", "investments": "id", "news_mentions": "id"}
FOREIGN_KEYS = [
    orphans.ForeignKey("news_mentions", "startup_id", "startups", "id", "scanned_at", "first_seen"),
    orphans.ForeignKey("news_mentions", "investor_id", "investors", "investor_id"),
    orphans.ForeignKey("investments", "startup_id", "startups", "id"),
    orphans.ForeignKey("investments", "investor_id", "investors", "investor_id"),
    orphans.ForeignKey("investments", "news_mention_id", "news_mentions", "id"),
]


@R.add("p4_found")
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "startups")
    return multivalue.items(multivalue.unpivoted(s, "id", LISTS)).filter("n >= 2").select("field", F.col("row_id").alias("startup_id"), "pos", "item")


@R.add("p4_delimiters")
def p4_delimiters(spark: SparkSession, d: str) -> DataFrame:
    """What the inference says of each candidate delimiter of each field."""
    v = multivalue.unpivoted(table(spark, d, "startups"), "id", LISTS)
    return multivalue.score(v.filter(~multivalue.is_missing(F.col("value"))).select("field", "value"))


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    t = {n: table(spark, d, n) for n in KEYS}
    periods = {"news_mentions": F.substring("scanned_at", 1, 7), "investments": F.nullif(F.regexp_extract("investment_date", "^(\\d{4}-\\d{2})", 1), F.lit(""))}
    return orphans.cascade(t, KEYS, FOREIGN_KEYS, periods)


P5 = """
SELECT 'news_mentions.startup_id' AS field, n.id AS row_id
FROM news_mentions n LEFT JOIN startups s ON n.startup_id = s.id
WHERE n.startup_id IS NOT NULL AND n.startup_id <> -1
  AND (s.id IS NULL OR CAST(s.first_seen AS TIMESTAMP) > CAST(n.scanned_at AS TIMESTAMP))
UNION ALL
SELECT 'investments.investor_id', i.id
FROM investments i LEFT JOIN investors v ON i.investor_id = v.investor_id
WHERE i.investor_id IS NOT NULL AND i.investor_id <> -1 AND v.investor_id IS NULL
"""


@R.add("p5_found", P5)
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    found = _orphans(spark, d).filter("kind = 'direct'").withColumn("field", F.concat_ws(".", "tab", "field"))
    return found.filter(F.col("field").isin("news_mentions.startup_id", "investments.investor_id")).select("field", "row_id").distinct()


@R.add("p5_report")
def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Direct and inherited orphans of every foreign key, per month; a deal's date is read in any notation, its month alone if it states no day."""
    t = {n: table(spark, d, n) for n in KEYS}
    month = F.nullif(F.regexp_extract("investment_date", "^(\\d{4}-(?:0[1-9]|1[0-2]))(?!\\d)", 1), F.lit(""))
    deals = timestamps.normalised(t["investments"].select("id", "investment_date"), "investment_date", F.lit("180"), F.lit("DMY"))
    deals = deals.select(F.lit("investments").alias("tab"), F.col("id").alias("row_id"), F.coalesce(F.substring("normal", 1, 7), month).alias("period"))
    news = t["news_mentions"].select(F.lit("news_mentions").alias("tab"), F.col("id").alias("row_id"), F.substring("scanned_at", 1, 7).alias("period"))
    found = orphans.cascade(t, KEYS, FOREIGN_KEYS).drop("period")
    return orphans.report(found.join(news.unionByName(deals), ["tab", "row_id"], "left"))


@R.add("p6_found")
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    sources = table(spark, d, "ref_sources").select(F.col("source_name").alias("sn"), "time_zone", "date_order").dropDuplicates(["sn"])
    news = table(spark, d, "news_mentions").select(F.lit("published_date").alias("field"), F.col("id").alias("row_id"), F.col("published_date").alias("text"), "source_name")
    # ref_sources is a list of fixed size
    news = news.join(F.broadcast(sources), F.col("source_name") == F.col("sn"), "left").select("field", "row_id", "text", F.col("time_zone").alias("zone"), F.col("date_order").alias("order"))
    deals = table(spark, d, "investments").select(F.lit("investment_date").alias("field"), F.col("id").alias("row_id"), F.col("investment_date").alias("text"), F.lit("180").alias("zone"), F.lit("DMY").alias("order"))
    written = F.col("text").rlike("^\\d{4}-\\d{2}-\\d{2}(T\\d{2}:\\d{2}:\\d{2}Z)?$")
    out = timestamps.normalised(news.unionByName(deals).filter(F.col("text").isNotNull() & ~written), "text", F.col("zone"), F.col("order"))
    return out.filter("status = 'ok'").select("field", "row_id", "normal")


@R.add("p7_found")
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "investments").select("id", "amount", "currency", "data_notes")
    out = units.readings(t, "amount", "currency", "data_notes", table(spark, d, "fx_rates"))
    return out.filter("usd is not null").select(F.col("id").alias("investment_id"), F.round(F.col("usd") * 100).cast("bigint").alias("usd_cents"))


@R.add("p7_contradictions")
def p7_contradictions(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose amount_usd differs from the sum they state, with the log10 of the ratio; notes whether the sum has one reading only."""
    t = table(spark, d, "investments").select("id", "amount", "currency", "data_notes", "amount_usd")
    out = units.readings(t, "amount", "currency", "data_notes", table(spark, d, "fx_rates"), "amount_usd")
    return out.filter(F.abs("residual") > 0.001).select(F.col("id").alias("investment_id"), F.round("usd", 2).alias("usd"), "amount_usd", F.round("residual", 4).alias("residual"), (F.col("n_readings") == 1).alias("unique_sum"))
