"""Joins, integrity checks, quality reports and selections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import taxonomy, urls
from ..operators import aggregates as A
from ..operators import joins as J
from ..session import looked_up, table
from .registry import Registry

R = Registry()
# The kinds of investor that count as known.
INVESTOR_TYPES = [
    "VC", "CVC", "Angel", "Corporate", "Accelerator", "PE", "Government", "Family Office", "Unknown", "Not Investor", "Corporate (Overlap)", "Corporate VC", "Private", "Individual", "Private Investor", "Asset Management Company", "Hedge Fund",
    "Private Foundation", "Growth Equity", "Quant Hedge Fund", "Public Funds", "Foreign", "Journalist", "Public",
]
TYPES_SQL = ", ".join(f"'{t}'" for t in INVESTOR_TYPES)
SPAM_SQL = "regexp_matches(regexp_extract(lower(trim(website)), '^(?:[a-z][a-z0-9+.-]*://)?([^/:?#]*)', 1), '^(?:.+\\.)?(?:" + "|".join(s.replace(".", "\\.") for s in urls.SPAM) + ")$')"
CHANGES = "(SELECT event_id AS id, user_id AS entity_id, event_type AS field, value, ts FROM events)"


@R.add("j01_deals_with_names", "SELECT v.id, s.company_name, i.investor_name FROM investments v JOIN startups s ON v.startup_id = s.id JOIN investors i ON v.investor_id = i.investor_id")
def j01(spark, d):
    v = table(spark, d, "investments").select("id", "startup_id", "investor_id")
    s = table(spark, d, "startups").select(F.col("id").alias("startup_id"), "company_name")
    i = table(spark, d, "investors").select("investor_id", "investor_name")
    return v.join(s, "startup_id").join(i, "investor_id").select("id", "company_name", "investor_name")


@R.add("j02_news_per_startup", "SELECT s.id, count(n.id) AS n_news FROM startups s LEFT JOIN news_mentions n ON n.startup_id = s.id GROUP BY s.id")
def j02(spark, d):
    """Counts including zero; the many news of one startup are counted before the join."""
    n = table(spark, d, "news_mentions").groupBy("startup_id").agg(F.count("id").alias("n"))
    return table(spark, d, "startups").select("id").join(n, F.col("id") == F.col("startup_id"), "left").select("id", F.coalesce("n", F.lit(0)).alias("n_news"))


FKS = [("news_startup", "news_mentions", "startup_id", "startups", "id"), ("news_investor", "news_mentions", "investor_id", "investors", "investor_id"), ("deal_startup", "investments", "startup_id", "startups", "id"), ("deal_investor", "investments", "investor_id", "investors", "investor_id")]
for _n, _c, _f, _p, _k in FKS:

    def _orphans(spark, d, c=_c, f=_f, p=_p, k=_k):
        return J.orphans(table(spark, d, c).select("id", f), f, table(spark, d, p), k).select("id", f)

    R.add(f"j04_orphans_{_n}", f"SELECT c.id, c.{_f} FROM {_c} c LEFT JOIN {_p} p ON c.{_f} = p.{_k} WHERE c.{_f} IS NOT NULL AND p.{_k} IS NULL")(_orphans)


@R.add("sk11_nullified_news", "SELECT n.id, s.id AS startup_id FROM news_mentions n LEFT JOIN startups s ON n.startup_id = s.id")
def sk11(spark, d):
    return J.nullified(table(spark, d, "news_mentions").select("id", "startup_id"), "startup_id", table(spark, d, "startups"), "id")


@R.add("j05_startups_with_deals", "SELECT id FROM startups s WHERE EXISTS (SELECT 1 FROM investments v WHERE v.startup_id = s.id)")
def j05(spark, d):
    s = table(spark, d, "startups").select("id")
    return s.join(table(spark, d, "investments").select(F.col("startup_id").alias("id")), "id", "left_semi")


@R.add("j06_same_names", "SELECT s.id, i.investor_id FROM startups s JOIN investors i ON lower(s.company_name) = lower(i.investor_name)")
def j06(spark, d):
    s = table(spark, d, "startups").select("id", F.lower("company_name").alias("k"))
    return s.join(table(spark, d, "investors").select("investor_id", F.lower("investor_name").alias("k")), "k").select("id", "investor_id")


@R.add("j07_latest_news", "SELECT startup_id, arg_max(id, (scanned_at, id)) AS news_id, max(scanned_at) AS scanned_at FROM news_mentions WHERE startup_id IS NOT NULL GROUP BY 1")
def j07(spark, d):
    n = table(spark, d, "news_mentions").filter("startup_id is not null").select("startup_id", F.col("id").alias("news_id"), "scanned_at")
    return J.latest(n, ["startup_id"], F.struct("scanned_at", "news_id"), ["news_id", "scanned_at"])


@R.add("j08_any_news", "SELECT startup_id, min(id) AS news_id FROM news_mentions WHERE startup_id IS NOT NULL GROUP BY 1")
def j08(spark, d):
    return table(spark, d, "news_mentions").filter("startup_id is not null").groupBy("startup_id").agg(F.min("id").alias("news_id"))


@R.add("j15_fan_out", "SELECT n.id, x.investor_id FROM news_mentions n JOIN (SELECT DISTINCT startup_id, investor_id FROM investments WHERE investor_id IS NOT NULL) x ON n.startup_id = x.startup_id WHERE n.event_type = 'funding'")
def j15(spark, d):
    """The fan-out of every startup, the hot one too: the news of hot ones are spread over sub-keys, their investors repeated for each."""
    n = table(spark, d, "news_mentions").filter("event_type = 'funding' and startup_id is not null").select("id", "startup_id")
    x = table(spark, d, "investments").filter("investor_id is not null").select("startup_id", "investor_id").distinct()
    return looked_up(n, "id", x, ["startup_id"]).select("id", "investor_id")


@R.add("j18_news_of_company", "SELECT DISTINCT s.id, n.id AS news_id FROM startups s JOIN (SELECT id, startup_id FROM news_mentions UNION ALL SELECT news_mention_id, startup_id FROM investments WHERE news_mention_id IS NOT NULL) n ON n.startup_id = s.id")
def j18(spark, d):
    """News of a company directly or by a deal, each once."""
    one = table(spark, d, "news_mentions").select("startup_id", F.col("id").alias("news_id"))
    two = table(spark, d, "investments").filter("news_mention_id is not null").select("startup_id", F.col("news_mention_id").alias("news_id"))
    n = one.unionByName(two).distinct()
    return table(spark, d, "startups").select("id").join(n, F.col("id") == F.col("startup_id")).select("id", "news_id")


@R.add("a21_unstable_fields", f"SELECT entity_id, field, count(*) AS n FROM {CHANGES} GROUP BY 1, 2 HAVING count(*) > 2")
def a21(spark, d):
    return table(spark, d, "events").groupBy(F.col("user_id").alias("entity_id"), F.col("event_type").alias("field")).agg(F.count("*").alias("n")).filter("n > 2")


@R.add("a22_repeated_use_cases", "SELECT AI_Use_Case AS use_case, count(*) AS n FROM startups WHERE AI_Use_Case <> '' GROUP BY 1 HAVING count(*) >= 3")
def a22(spark, d):
    return table(spark, d, "startups").filter(A.filled(F.col("AI_Use_Case"))).groupBy(F.col("AI_Use_Case").alias("use_case")).agg(F.count("*").alias("n")).filter("n >= 3")


@R.add("r21_rows_of_repeated_use_cases", "SELECT id FROM startups WHERE AI_Use_Case IN (SELECT AI_Use_Case FROM startups WHERE AI_Use_Case <> '' GROUP BY 1 HAVING count(*) >= 3)")
def r21(spark, d):
    s = table(spark, d, "startups").select("id", "AI_Use_Case")
    return s.join(a22(spark, d).select(F.col("use_case").alias("AI_Use_Case")), "AI_Use_Case", "left_semi").select("id")


@R.add("a23_childless_short_names", "SELECT investor_id FROM investors i WHERE length(investor_name) <= 15 AND NOT EXISTS (SELECT 1 FROM investments v WHERE v.investor_id = i.investor_id)")
def a23(spark, d):
    i = table(spark, d, "investors").filter(F.length("investor_name") <= 15).select("investor_id")
    return i.join(table(spark, d, "investments").select("investor_id"), "investor_id", "left_anti")


@R.add("a24_sources_by_last_scan", "SELECT source_name, max(scanned_at) AS last_scan, count(*) AS n FROM news_mentions GROUP BY 1 ORDER BY last_scan DESC, source_name NULLS LAST LIMIT 5")
def a24(spark, d):
    return A.top(table(spark, d, "news_mentions").groupBy("source_name").agg(F.max("scanned_at").alias("last_scan"), F.count("*").alias("n")), "last_scan", "source_name", 5)


@R.add("a25_log_breakdown", "SELECT entity_type, lower(trim(action)) AS action, count(*) AS cnt FROM cleanup_log GROUP BY 1, 2")
def a25(spark, d):
    return table(spark, d, "cleanup_log").groupBy("entity_type", F.lower(F.trim("action")).alias("action")).agg(F.count("*").alias("cnt"))


@R.add("a26_status_counts", "SELECT e.Status, count(s.id) AS cnt FROM (VALUES ('Active'), ('Stale'), ('removed'), ('pending')) e(Status) LEFT JOIN startups s ON s.Status = e.Status GROUP BY 1")
def a26(spark, d):
    return A.over_list(table(spark, d, "startups"), "Status", ["Active", "Stale", "removed", "pending"])


@R.add("a27_tags_by_size", "SELECT Category AS category, count(*) AS n, round(avg(data_confidence), 1) AS avg_conf FROM startups WHERE Category IS NOT NULL GROUP BY 1 ORDER BY n DESC, category LIMIT 5")
def a27(spark, d):
    g = table(spark, d, "startups").filter("Category is not null").groupBy(F.col("Category").alias("category")).agg(F.count("*").alias("n"), F.round(F.avg("data_confidence"), 1).alias("avg_conf"))
    return A.top(g, "n", "category", 5)


FIELDS = ["website", "description", "city", "founders", "legal_business_name", "AI_Use_Case", "Investors", "Tech_Mentioned", "business_model", "Category"]


@R.add("a29_missing_fields", " UNION ALL ".join(f"SELECT '{f}' AS field, CAST(sum(CASE WHEN {f} IS NULL OR lower(trim({f})) IN ('', 'unknown', 'none', 'nan', 'n/a') THEN 1 ELSE 0 END) AS BIGINT) AS missing, count(*) AS total FROM startups" for f in FIELDS))
def a29(spark, d):
    """All fields in one pass, then one row each."""
    miss = lambda f: F.count_if(F.col(f).isNull() | F.lower(F.trim(f)).isin("", "unknown", "none", "nan", "n/a"))
    one = table(spark, d, "startups").agg(F.count("*").alias("total"), *(miss(f).alias(f) for f in FIELDS))
    return one.unpivot("total", FIELDS, "field", "missing").select("field", "missing", "total")


PAIRS_SQL = ", ".join(f"('{s}', '{t}')" for s, ts in taxonomy.PAIRS.items() for t in ts)
PARSED_SQL = "CASE WHEN contains(Category, ' | ') THEN trim(split_part(Category, ' | ', 1)) END AS sector, CASE WHEN contains(Category, ' | ') THEN trim(substr(Category, instr(Category, ' | ') + 3)) END AS tag"


@R.add("a30_invalid_pairs", f"SELECT sector, tag, count(*) AS n FROM (SELECT {PARSED_SQL} FROM startups) p WHERE sector IS NOT NULL AND (sector, tag) NOT IN (VALUES {PAIRS_SQL}) GROUP BY 1, 2")
def a30(spark, d):
    p = table(spark, d, "startups").select(taxonomy.sector_of(F.col("Category")).alias("sector"), taxonomy.tag_of(F.col("Category")).alias("tag")).filter("sector is not null")
    valid = taxonomy.taxonomy(spark)
    return p.join(F.broadcast(valid), (F.col("sector") == F.col("valid_sector")) & (F.col("tag") == F.col("valid_tag")), "left_anti").groupBy("sector", "tag").agg(F.count("*").alias("n"))


@R.add("a31_log_by_task", "SELECT task_id, count(*) AS n FROM cleanup_log GROUP BY 1")
def a31(spark, d):
    return table(spark, d, "cleanup_log").groupBy("task_id").agg(F.count("*").alias("n"))


@R.add("a32_investor_quality", "SELECT count(*) AS total, count(*) FILTER (coalesce(data_confidence, 0) = 0) AS no_confidence, count(*) FILTER (investor_type IS NULL OR investor_type IN ('', 'Unknown')) AS no_type, round(100.0 * count(*) FILTER (investor_type IS NULL OR investor_type IN ('', 'Unknown')) / count(*), 1) AS no_type_pct FROM investors")
def a32(spark, d):
    none = F.col("investor_type").isNull() | F.col("investor_type").isin("", "Unknown")
    return table(spark, d, "investors").agg(F.count("*").alias("total"), F.count_if(F.coalesce("data_confidence", F.lit(0)) == 0).alias("no_confidence"), F.count_if(none).alias("no_type"), A.share(F.count_if(none), F.count("*")).alias("no_type_pct"))


@R.add("a33_health", """SELECT (SELECT count(*) FROM startups) AS startups, (SELECT count(*) FROM investors WHERE status IS NULL OR status = 'active') AS active_investors, (SELECT count(*) FROM news_mentions) AS news,
(SELECT CAST(count(*) FILTER (startup_id IS NULL) * 100 // greatest(count(*), 1) AS BIGINT) FROM news_mentions) AS unlinked_pct, (SELECT count(*) FROM investments WHERE currency IS NULL OR currency IN ('', 'Unknown')) AS unknown_currency""")
def a33(spark, d):
    n = table(spark, d, "news_mentions").agg(F.count("*").alias("news"), F.floor(100 * F.count_if(F.col("startup_id").isNull()) / F.greatest(F.count("*"), F.lit(1))).cast("bigint").alias("unlinked_pct"))
    parts = [
        table(spark, d, "startups").agg(F.count("*").alias("startups")),
        table(spark, d, "investors").agg(F.count_if(F.col("status").isNull() | (F.col("status") == "active")).alias("active_investors")),
        n,
        table(spark, d, "investments").agg(F.count_if(F.col("currency").isNull() | F.col("currency").isin("", "Unknown")).alias("unknown_currency")),
    ]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)  # one row each


@R.add("a34_cleanup_summary", "SELECT entity_type, count(*) AS n, count(*) FILTER (lower(action) LIKE '%delet%') AS deleted, count(*) FILTER (details IS NULL OR details = '') AS bare FROM cleanup_log GROUP BY 1")
def a34(spark, d):
    return table(spark, d, "cleanup_log").groupBy("entity_type").agg(F.count("*").alias("n"), F.count_if(F.col("action").ilike("%delet%")).alias("deleted"), F.count_if(~A.filled(F.col("details"))).alias("bare"))


@R.add("a35_investment_counts", "SELECT i.investor_id, i.total_investments_count AS stored, count(v.id) AS counted FROM investors i LEFT JOIN investments v ON v.investor_id = i.investor_id GROUP BY 1, 2 HAVING i.total_investments_count IS DISTINCT FROM count(v.id)")
def a35(spark, d):
    """Recomputed, never incremented; only those that differ from what is stored."""
    n = table(spark, d, "investments").groupBy("investor_id").agg(F.count("*").alias("n"))
    x = table(spark, d, "investors").select("investor_id", F.col("total_investments_count").alias("stored")).join(n, "investor_id", "left")
    x = x.select("investor_id", "stored", F.coalesce("n", F.lit(0)).alias("counted"))
    return x.filter(~F.col("stored").eqNullSafe(F.col("counted")))


BAD = "investment_date IS NULL", "trim(investment_date) = ''", "lower(trim(investment_date)) IN ('unknown', 'none', 'n/a')", "regexp_matches(trim(investment_date), '^[0-9]{4}$')"


@R.add("a36_date_quality", f"SELECT count(*) AS total, count(*) FILTER ({BAD[0]}) AS nulls, count(*) FILTER ({BAD[1]}) AS blank, count(*) FILTER ({BAD[2]}) AS stand_ins, count(*) FILTER ({BAD[3]}) AS years_only, count(*) FILTER (NOT coalesce({' OR '.join(BAD)}, true)) AS valid FROM investments")
def a36(spark, d):
    c = F.trim("investment_date")
    bad = [c.isNull(), c == "", F.lower(c).isin("unknown", "none", "n/a"), c.rlike("^[0-9]{4}$")]
    return table(spark, d, "investments").agg(F.count("*").alias("total"), *(F.count_if(b).alias(n) for b, n in zip(bad, ["nulls", "blank", "stand_ins", "years_only"], strict=True)), F.count_if(~F.coalesce(reduce(lambda a, b: a | b, bad), F.lit(True))).alias("valid"))


def _check(name, value, threshold):
    return F.lit(name).alias("name"), value.cast("double").alias("value"), F.lit(float(threshold)).alias("threshold"), (value <= threshold).alias("passed")


CHECK = "SELECT '{n}' AS name, CAST(v AS DOUBLE) AS value, CAST({t} AS DOUBLE) AS threshold, v <= {t} AS passed FROM (SELECT {e} AS v FROM {f})"
PCT = "100.0 * count(*) FILTER ({w}) / count(*)"
ORPHANS_SQL = [CHECK.format(n=f"Q-0{i + 1}", t=0, e="count(*)", f=f"{c} c LEFT JOIN {p} p ON c.{f} = p.{k} WHERE c.{f} IS NOT NULL AND p.{k} IS NULL") for i, (_, c, f, p, k) in enumerate(FKS)]
REST_SQL = [
    CHECK.format(n="Q-05", t=5, e="count(DISTINCT investor_type)", f=f"investors WHERE (status IS NULL OR status = 'active') AND investor_type NOT IN ({TYPES_SQL})"),
    CHECK.format(n="Q-06", t=5, e=PCT.format(w="Category IS NULL OR Category = 'General | Uncategorized'"), f="startups"),
    CHECK.format(n="Q-07", t=0, e="count(*)", f=f"startups WHERE {SPAM_SQL}"),
    CHECK.format(n="Q-08", t=10, e=PCT.format(w="currency IS NULL OR currency IN ('', 'Unknown')"), f="investments"),
    CHECK.format(n="Q-09", t=5, e=PCT.format(w="summary IS NULL OR trim(summary) = ''"), f="news_mentions WHERE coalesce(is_relevant, 1) = 1"),
]


@R.add("q_checks", " UNION ALL ".join(ORPHANS_SQL + REST_SQL))
def q_checks(spark, d):
    """The nine assertions, one row each: name, value, threshold, passed."""
    pct = lambda c: 100.0 * F.count_if(c) / F.count("*")
    out = [J.orphans(table(spark, d, c).select("id", f), f, table(spark, d, p), k).agg(F.count("*").alias("v")).select(*_check(f"Q-0{i + 1}", F.col("v"), 0)) for i, (_, c, f, p, k) in enumerate(FKS)]
    s, v, n = table(spark, d, "startups"), table(spark, d, "investments"), table(spark, d, "news_mentions")
    out.append(table(spark, d, "investors").filter((F.col("status").isNull() | (F.col("status") == "active")) & ~F.col("investor_type").isin(*INVESTOR_TYPES)).agg(F.countDistinct("investor_type").alias("v")).select(*_check("Q-05", F.col("v"), 5)))
    out.append(s.agg(pct(F.col("Category").isNull() | (F.col("Category") == "General | Uncategorized")).alias("v")).select(*_check("Q-06", F.col("v"), 5)))
    out.append(s.filter(urls.is_spam(F.col("website"))).agg(F.count("*").alias("v")).select(*_check("Q-07", F.col("v"), 0)))
    out.append(v.agg(pct(F.col("currency").isNull() | F.col("currency").isin("", "Unknown")).alias("v")).select(*_check("Q-08", F.col("v"), 10)))
    out.append(n.filter(F.coalesce("is_relevant", F.lit(1)) == 1).agg(pct(F.col("summary").isNull() | (F.trim("summary") == "")).alias("v")).select(*_check("Q-09", F.col("v"), 5)))
    return reduce(lambda a, b: a.unionByName(b), out)


@R.add("w01_latest_change", f"SELECT entity_id, field, arg_max(value, id) AS value, max(id) AS id FROM {CHANGES} GROUP BY 1, 2")
def w01(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("entity_id"), F.col("event_type").alias("field"), "value")
    return J.latest(e, ["entity_id", "field"], F.col("id"), ["value", "id"])


@R.add("w02_freshness", "SELECT startup_id, max(scanned_at) AS newest FROM news_mentions GROUP BY 1")
def w02(spark, d):
    return table(spark, d, "news_mentions").groupBy("startup_id").agg(F.max("scanned_at").alias("newest"))


@R.add("w03_first_of_each_article", "SELECT min(id) AS id FROM news_mentions GROUP BY url_hash")
def w03(spark, d):
    """The first arrival of each article, by partial aggregation: a hot article costs one row a task."""
    return table(spark, d, "news_mentions").groupBy("url_hash").agg(F.min("id").alias("id")).select("id")


@R.add("w05_last_scan", "SELECT source_name, arg_max(id, (scanned_at, id)) AS id FROM news_mentions WHERE source_name IS NOT NULL GROUP BY 1")
def w05(spark, d):
    n = table(spark, d, "news_mentions").filter("source_name is not null")
    return J.latest(n.select("source_name", "id", "scanned_at"), ["source_name"], F.struct("scanned_at", "id"), ["id"])
