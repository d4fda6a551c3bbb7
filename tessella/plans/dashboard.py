"""The analytic queries of the dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..session import table
from .registry import Registry

R = Registry()
#: the report's day; a parameter, never the clock
AS_OF = "2026-05-31"
BASE = "ai_explanation IS NOT NULL AND ai_explanation <> ''"
DEAL = "regexp_matches(trim(investment_date), '^[0-9]{4}') AND trim(round_type) <> '' AND upper(trim(round_type)) <> 'NA'"
# Places that mark an investor as domestic, for the ranking of investors.
DOMESTIC = ["turkey", "türkiye", "istanbul", "ankara", "izmir", "bursa", "adana", "antalya", "besiktas", "beşiktaş", "cankaya", "çankaya", "eskisehir", "eskişehir", "kocaeli"]
PROXIMITY = [(90, "Core AI (90-100%)"), (70, "AI-Heavy (70-89%)"), (50, "AI-Enabled (50-69%)"), (30, "AI-Adjacent (30-49%)")]
CONFIDENCE = [(80, "High (80-100)"), (60, "Good (60-79)"), (40, "Medium (40-59)"), (20, "Low (20-39)")]


def base(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "startups").filter(A.filled(F.col("ai_explanation")))


def deals(spark: SparkSession, d: str) -> DataFrame:
    """Investments with a date that begins with a year and a named round."""
    t = table(spark, d, "investments")
    return t.filter(F.trim("investment_date").rlike("^[0-9]{4}") & (F.trim("round_type") != "") & (F.upper(F.trim("round_type")) != "NA"))


def _sector(c):
    return F.when(c.contains("|"), F.trim(F.substring_index(c, "|", 1))).otherwise(c)


def _sub(c):
    return F.when(c.contains("|"), F.trim(F.expr("substr(Category, instr(Category, '|') + 1)"))).otherwise("General")


@R.add("a01_sector_counts", f"""SELECT coalesce(nullif(CASE WHEN Category LIKE '%|%' THEN trim(substr(Category, 1, instr(Category, '|') - 1)) ELSE Category END, ''), 'General') AS sector, count(*) AS cnt
FROM startups WHERE {BASE} GROUP BY 1""")
def a01(spark, d):
    return A.counted(base(spark, d), F.coalesce(F.nullif(_sector(F.col("Category")), F.lit("")), F.lit("General")), "sector")


@R.add("a02_subcategory_top15", f"""SELECT CASE WHEN Category LIKE '%|%' THEN trim(substr(Category, instr(Category, '|') + 1)) ELSE 'General' END AS subcat, count(*) AS cnt
FROM startups WHERE {BASE} GROUP BY 1 ORDER BY cnt DESC, subcat LIMIT 15""")
def a02(spark, d):
    return A.top(A.counted(base(spark, d), _sub(F.col("Category")), "subcat"), "cnt", "subcat", 15)


@R.add("a03_city_top20", f"SELECT city, count(*) AS cnt FROM startups WHERE {BASE} AND city <> '' GROUP BY 1 ORDER BY cnt DESC, city LIMIT 20")
def a03(spark, d):
    return A.top(A.counted(base(spark, d).filter(A.filled(F.col("city"))), F.col("city"), "city"), "cnt", "city", 20)


@R.add("a04_founded_years", f"SELECT founded_year AS year, count(*) AS cnt FROM startups WHERE {BASE} AND founded_year IS NOT NULL GROUP BY 1")
def a04(spark, d):
    return A.counted(base(spark, d).filter("founded_year is not null"), F.col("founded_year"), "year")


@R.add("a04_founded_years_recent", f"SELECT founded_year AS year, count(*) AS cnt FROM startups WHERE {BASE} AND founded_year >= 2010 GROUP BY 1")
def a04_recent(spark, d):
    return A.counted(base(spark, d).filter("founded_year >= 2010"), F.col("founded_year"), "year")


@R.add("a05_business_models", f"SELECT coalesce(nullif(b, ''), 'Unknown') AS business_model, cnt FROM (SELECT business_model AS b, count(*) AS cnt FROM startups WHERE {BASE} GROUP BY 1)")
def a05(spark, d):
    raw = A.counted(base(spark, d), F.col("business_model"), "b")
    return raw.select(F.coalesce(F.nullif("b", F.lit("")), F.lit("Unknown")).alias("business_model"), "cnt")


def _bucket_sql(column: str, steps: list, rest: str, where: str = BASE) -> str:
    names = [n for _, n in steps] + [rest]
    case = " ".join(f"WHEN {column} >= {k} THEN '{n}'" for k, n in steps)
    values = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    return f"""WITH h AS (SELECT CASE {case} ELSE '{rest}' END AS bucket, count(*) AS n FROM startups WHERE {where} GROUP BY 1)
SELECT CAST(e.pos AS INTEGER) AS pos, e.bucket, coalesce(n, 0) AS cnt FROM (VALUES {values}) e(pos, bucket) LEFT JOIN h ON h.bucket = e.bucket"""


@R.add("a06_proximity_buckets", _bucket_sql("tech_proximity", PROXIMITY, "Low AI (<30%)"))
def a06(spark, d):
    return A.bucketed(base(spark, d), F.col("tech_proximity"), PROXIMITY, "Low AI (<30%)")


BANDS = [(81, "81-100"), (61, "61-80"), (41, "41-60"), (21, "21-40")]


@R.add("a07_proximity_bands", _bucket_sql("tech_proximity", BANDS, "0-20"))
def a07(spark, d):
    return A.bucketed(base(spark, d), F.col("tech_proximity"), BANDS, "0-20")


@R.add("a08_proximity_histogram", f"SELECT tech_proximity AS score, count(*) AS cnt FROM startups WHERE {BASE} GROUP BY 1")
def a08(spark, d):
    return A.counted(base(spark, d), F.col("tech_proximity"), "score")


@R.add("a09_cloud_labels", f"SELECT coalesce(cloud_relevance, 'Unclassified') AS label, count(*) AS cnt FROM startups WHERE {BASE} GROUP BY 1")
def a09(spark, d):
    return A.counted(base(spark, d), F.coalesce("cloud_relevance", F.lit("Unclassified")), "label")


@R.add("a10_confidence_buckets", _bucket_sql("data_confidence", CONFIDENCE, "Very Low (0-19)"))
def a10(spark, d):
    return A.bucketed(base(spark, d), F.col("data_confidence"), CONFIDENCE, "Very Low (0-19)")


@R.add("a11_confidence_bands", """SELECT CASE WHEN data_confidence IS NULL THEN 'NULL' WHEN data_confidence = 0 THEN '0' WHEN data_confidence BETWEEN 1 AND 39 THEN '1-39' WHEN data_confidence BETWEEN 40 AND 69 THEN '40-69'
WHEN data_confidence BETWEEN 70 AND 89 THEN '70-89' WHEN data_confidence BETWEEN 90 AND 100 THEN '90-100' ELSE 'other' END AS band, count(*) AS cnt FROM startups GROUP BY 1""")
def a11(spark, d):
    c = F.col("data_confidence")
    band = F.when(c.isNull(), "NULL").when(c == 0, "0").when(c.between(1, 39), "1-39").when(c.between(40, 69), "40-69").when(c.between(70, 89), "70-89").when(c.between(90, 100), "90-100").otherwise("other")
    return A.counted(table(spark, d, "startups"), band, "band")


HIT = " OR ".join(f"lower(coalesce(location, '')) LIKE '%{w}%'" for w in DOMESTIC)


@R.add("a12_top_investors", f"""SELECT i.investor_name, coalesce(nullif(i.investor_type, ''), 'N/A') AS investor_type, coalesce(nullif(i.location, ''), 'Unknown') AS location,
CAST(sum(CASE WHEN v.startup_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS deal_count FROM investors i LEFT JOIN investments v ON i.investor_id = v.investor_id
WHERE {HIT} GROUP BY i.investor_id, i.investor_name, i.investor_type, i.location""")
def a12(spark, d):
    """Domestic investors with their deals, none included; deals are counted per key before they meet the investors."""
    where = F.lower(F.coalesce("location", F.lit(""))).rlike("|".join(DOMESTIC))
    n = table(spark, d, "investments").groupBy("investor_id").agg(F.count("startup_id").alias("n"))
    i = table(spark, d, "investors").filter(where).join(n, "investor_id", "left")
    label = lambda c, other: F.coalesce(F.nullif(c, F.lit("")), F.lit(other)).alias(c)
    return i.select("investor_name", label("investor_type", "N/A"), label("location", "Unknown"), F.coalesce("n", F.lit(0)).alias("deal_count"))


@R.add("a13_top_investor_texts", f"SELECT Investors AS investors, count(*) AS cnt FROM startups WHERE {BASE} AND Investors <> '' GROUP BY 1 ORDER BY cnt DESC, investors LIMIT 20")
def a13(spark, d):
    return A.top(A.counted(base(spark, d).filter(A.filled(F.col("Investors"))), F.col("Investors"), "investors"), "cnt", "investors", 20)


@R.add("a14_round_types", f"SELECT round_type, count(*) AS cnt FROM investments WHERE {DEAL} GROUP BY 1")
def a14(spark, d):
    return A.counted(deals(spark, d), F.col("round_type"), "round_type")


@R.add("a15_deal_timeline", f"SELECT substr(trim(investment_date), 1, 4) AS year, count(*) AS cnt FROM investments WHERE {DEAL} GROUP BY 1")
def a15(spark, d):
    return A.counted(deals(spark, d), F.substring(F.trim("investment_date"), 1, 4), "year")


@R.add("a16_valid_deals", f"SELECT id FROM investments WHERE {DEAL}")
def a16(spark, d):
    return deals(spark, d).select("id")


@R.add("a17_tech_top15", f"""WITH t AS (SELECT trim(unnest(string_split(Tech_Mentioned, ','))) AS tech FROM startups WHERE {BASE} AND Tech_Mentioned NOT IN ('', 'None'))
SELECT tech, count(*) AS cnt FROM t WHERE tech NOT IN ('', 'None') GROUP BY 1 ORDER BY cnt DESC, tech LIMIT 15""")
def a17(spark, d):
    rows = base(spark, d).filter(~F.col("Tech_Mentioned").isin("", "None"))
    t = A.tokens(rows, ["Tech_Mentioned"], ",", "tech").filter("tech <> 'None'")
    return A.top(A.counted(t, F.col("tech"), "tech"), "cnt", "tech", 15)


@R.add("a18_tech_top30", f"""WITH t AS (SELECT trim(unnest(regexp_split_to_array(c, '[,;|]+'))) AS tech FROM (SELECT Tech_Mentioned AS c FROM startups WHERE {BASE} UNION ALL SELECT Tech_Assumed FROM startups WHERE {BASE}) WHERE c IS NOT NULL)
SELECT tech, count(*) AS cnt FROM t WHERE tech NOT IN ('', 'None') GROUP BY 1 ORDER BY cnt DESC, tech LIMIT 30""")
def a18(spark, d):
    t = A.tokens(base(spark, d), ["Tech_Mentioned", "Tech_Assumed"], "[,;|]+", "tech").filter("tech <> 'None'")
    return A.top(A.counted(t, F.col("tech"), "tech"), "cnt", "tech", 30)


@R.add("a19_kpis", f"""WITH s AS (SELECT * FROM startups WHERE {BASE}), v AS (SELECT * FROM investments WHERE {DEAL}),
c AS (SELECT city, count(*) AS n FROM s WHERE city <> '' GROUP BY 1 ORDER BY n DESC, city LIMIT 1)
SELECT count(*) AS total, round(avg(tech_proximity), 1) AS avg_ai, round(100.0 * count(*) FILTER (business_model = 'Product') / count(*), 1) AS product_pct, count(*) FILTER (tech_proximity >= 90) AS core_ai,
(SELECT count(DISTINCT investor_id) FROM v) AS investor_count, (SELECT count(*) FROM v) AS total_deals, count(DISTINCT nullif(city, '')) AS city_count, (SELECT city FROM c) AS top_city, round(100.0 * (SELECT n FROM c) / count(*), 0) AS top_city_pct,
count(*) FILTER (founded_year >= 2020) AS recent, round(100.0 * count(*) FILTER (founded_year >= 2020) / count(*), 0) AS recent_pct, round(avg(data_confidence), 1) AS avg_conf, (SELECT count(*) FROM investors) AS total_investors FROM s""")
def a19(spark, d):
    s, v = base(spark, d), deals(spark, d)
    n = F.count("*")
    one = s.agg(
        n.alias("total"), F.round(F.avg("tech_proximity"), 1).alias("avg_ai"), A.share(F.count_if(F.col("business_model") == "Product"), n).alias("product_pct"), F.count_if(F.col("tech_proximity") >= 90).alias("core_ai"),
        F.countDistinct(F.nullif("city", F.lit(""))).alias("city_count"), F.count_if(F.col("founded_year") >= 2020).alias("recent"), A.share(F.count_if(F.col("founded_year") >= 2020), n, 0).alias("recent_pct"), F.round(F.avg("data_confidence"), 1).alias("avg_conf"),
    )
    two = v.agg(F.countDistinct("investor_id").alias("investor_count"), F.count("*").alias("total_deals"))
    three = table(spark, d, "investors").agg(F.count("*").alias("total_investors"))
    four = A.top(A.counted(s.filter(A.filled(F.col("city"))), F.col("city"), "top_city", "top_n"), "top_n", "top_city", 1)
    # each side is a single row
    out = one.crossJoin(F.broadcast(two)).crossJoin(F.broadcast(three)).join(F.broadcast(four), F.lit(True), "left")
    return out.withColumn("top_city_pct", A.share(F.col("top_n"), F.col("total"), 0)).drop("top_n")


WEEK = f"substr(scanned_at, 1, 10) >= CAST(DATE '{AS_OF}' - INTERVAL 7 DAY AS DATE)::VARCHAR"


def week(df: DataFrame, column: str, as_of: str = AS_OF, days: int = 7) -> DataFrame:
    return df.filter(F.substring(column, 1, 10) >= F.date_sub(F.lit(as_of).cast("date"), days).cast("string"))


@R.add("a20_week_counters", f"""SELECT (SELECT count(*) FROM news_mentions WHERE {WEEK}) AS news_count,
(SELECT count(*) FROM startups WHERE {WEEK.replace('scanned_at', 'processed_at')} AND Status <> 'removed') AS new_startups""")
def a20(spark, d):
    n = week(table(spark, d, "news_mentions"), "scanned_at").agg(F.count("*").alias("news_count"))
    s = week(table(spark, d, "startups"), "processed_at").filter("Status <> 'removed'").agg(F.count("*").alias("new_startups"))
    return n.crossJoin(F.broadcast(s))  # one row each


@R.add("a20_week_categories", f"SELECT coalesce(nullif(event_category, ''), 'uncategorized') AS cat, cnt FROM (SELECT event_category, count(*) AS cnt FROM news_mentions WHERE {WEEK} GROUP BY 1 ORDER BY cnt DESC, event_category NULLS LAST LIMIT 5)")
def a20_categories(spark, d):
    c = A.top(A.counted(week(table(spark, d, "news_mentions"), "scanned_at"), F.col("event_category"), "c"), "cnt", "c", 5)
    return c.select(F.coalesce(F.nullif("c", F.lit("")), F.lit("uncategorized")).alias("cat"), "cnt")


@R.add("j03_week_headlines", f"""SELECT substr(n.headline, 1, 80) AS headline, coalesce(n.source_name, '') AS source, coalesce(n.event_category, '') AS category, coalesce(s.company_name, i.investor_name, '') AS entity, n.scanned_at
FROM news_mentions n LEFT JOIN startups s ON n.startup_id = s.id LEFT JOIN investors i ON n.investor_id = i.investor_id WHERE {WEEK.replace('scanned_at', 'n.scanned_at')} AND n.headline <> '' ORDER BY n.scanned_at DESC, n.id LIMIT 6""")
def j03(spark, d):
    """The six latest headlines with the names they belong to; cut to six before the names are joined."""
    n = week(table(spark, d, "news_mentions"), "scanned_at").filter(A.filled(F.col("headline"))).select("id", "headline", "source_name", "event_category", "startup_id", "investor_id", "scanned_at")
    n = n.orderBy(F.desc("scanned_at"), "id").limit(6)
    s = table(spark, d, "startups").select(F.col("id").alias("startup_id"), "company_name")
    i = table(spark, d, "investors").select("investor_id", "investor_name")
    x = F.broadcast(n)  # six rows
    x = s.join(x, "startup_id", "right")
    x = i.join(F.broadcast(x), "investor_id", "right")
    none = F.lit("")
    return x.select(F.substring("headline", 1, 80).alias("headline"), F.coalesce("source_name", none).alias("source"), F.coalesce("event_category", none).alias("category"), F.coalesce("company_name", "investor_name", none).alias("entity"), "scanned_at")


COLUMNS = ["id", "company_name", "website", "city", "founded_year", "tech_proximity", "Status", "data_confidence", "business_model", "Category", "cloud_relevance"]


@R.add("sc03_company_list", f"SELECT {', '.join(COLUMNS)} FROM startups WHERE {BASE}")
def sc03(spark, d):
    """The pruned, filtered list of companies; its order (proximity descending, then name) is the sink's."""
    return base(spark, d).select(*COLUMNS)
