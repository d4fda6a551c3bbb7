"""Filters, orders, set operations and smaller dataflows over the domain tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import taxonomy
from ..functions.text import fold, squeeze
from ..operators import aggregates as A
from ..operators import fuzzy, keywords, units
from ..session import looked_up, table
from .registry import Registry

R = Registry()
AS_OF = "2026-05-31"


def _filter(name: str, t: str, key: str, sql: str, cond) -> None:
    R.add(name, f"SELECT {key} FROM {t} WHERE {sql}")(lambda spark, d: table(spark, d, t).filter(cond()).select(key))


_filter("f01_explained", "startups", "id", "ai_explanation IS NOT NULL AND ai_explanation <> ''", lambda: A.filled(F.col("ai_explanation")))
_filter("f02_not_stale", "startups", "id", "Status <> 'Stale'", lambda: F.col("Status") != "Stale")
_filter("f03_not_in_list", "startups", "id", "business_model NOT IN ('SaaS', 'Hybrid')", lambda: ~F.col("business_model").isin("SaaS", "Hybrid"))
_filter("f07_not_like", "startups", "id", "Category NOT ILIKE '%tech%'", lambda: ~F.col("Category").ilike("%tech%"))
_filter("f08_year_prefix", "investments", "id", "regexp_matches(investment_date, '^[0-9]{4}')", lambda: F.col("investment_date").rlike("^[0-9]{4}"))
_filter("f09_between", "startups", "id", "data_confidence BETWEEN 40 AND 69", lambda: F.col("data_confidence").between(40, 69))
_filter("f10_default_true", "news_mentions", "id", "coalesce(is_relevant, 1) = 1", lambda: F.coalesce("is_relevant", F.lit(1)) == 1)
_filter("f10_null_or_active", "investors", "investor_id", "status IS NULL OR status = 'active'", lambda: F.col("status").isNull() | (F.col("status") == "active"))
_filter("f13_later_than", "news_mentions", "id", "scanned_at >= '2025-01-01'", lambda: F.col("scanned_at") >= "2025-01-01")
_filter("f14_last_week", "news_mentions", "id", f"CAST(substr(scanned_at, 1, 10) AS DATE) >= DATE '{AS_OF}' - INTERVAL 7 DAY", lambda: F.try_to_date(F.substring("scanned_at", 1, 10)) >= F.date_sub(F.lit(AS_OF).cast("date"), 7))
_filter("r01_gate", "startups", "id", "coalesce(tech_proximity, 0) = 0 AND coalesce(data_confidence, 20) >= 20", lambda: (F.coalesce("tech_proximity", F.lit(0)) == 0) & (F.coalesce("data_confidence", F.lit(20)) >= 20))
_filter("r04_like_name", "investors", "investor_id", "investor_name ILIKE '%capital%'", lambda: F.col("investor_name").ilike("%capital%"))


@R.add("sc04_lookup", "SELECT id, company_name FROM startups WHERE id IN (SELECT startup_id FROM news_mentions WHERE event_type = 'award')")
def sc04(spark, d):
    """Many lookups by key as one semi-join."""
    keys = table(spark, d, "news_mentions").filter("event_type = 'award'").select(F.col("startup_id").alias("id"))
    return table(spark, d, "startups").select("id", "company_name").join(keys, "id", "left_semi")


@R.add("f11_null_safe_equal", "SELECT a.id, min(b.id) AS other FROM investments a JOIN investments b ON a.startup_id = b.startup_id AND a.investor_id = b.investor_id AND a.amount IS NOT DISTINCT FROM b.amount AND b.id > a.id GROUP BY a.id")
def f11(spark, d):
    """For each deal the next of the same parties with the same amount, missing ones alike, by a lead within the key."""
    v = table(spark, d, "investments").filter("startup_id is not null and investor_id is not null").select("id", "startup_id", "investor_id", "amount")
    w = Window.partitionBy("startup_id", "investor_id", "amount").orderBy("id")
    return v.withColumn("other", F.lead("id").over(w)).filter("other is not null").select("id", "other")


@R.add("f12_same_city", "SELECT s.id, i.investor_id FROM startups s JOIN investors i ON lower(translate(s.city, 'İ', 'i')) = lower(translate(i.location, 'İ', 'i')) WHERE s.city <> '' AND i.location <> ''")
def f12(spark, d):
    """Startups and investors of one city in any letter case; the dotted I is i in lower case, and the rows of a hot city are spread over sub-keys."""
    lower = lambda c: F.lower(F.translate(c, "İ", "i")).alias("k")
    s = table(spark, d, "startups").filter(A.filled(F.col("city"))).select("id", lower("city"))
    i = table(spark, d, "investors").filter(A.filled(F.col("location"))).select("investor_id", lower("location"))
    return looked_up(s, "id", i, ["k"]).select("id", "investor_id")


@R.add("f19_defaults", "SELECT id, coalesce(cloud_relevance, 'Unclassified') AS cloud, CASE WHEN city IS NULL OR city = '' THEN 'N/A' ELSE city END AS city FROM startups")
def f19(spark, d):
    return table(spark, d, "startups").select("id", F.coalesce("cloud_relevance", F.lit("Unclassified")).alias("cloud"), F.when(A.filled(F.col("city")), F.col("city")).otherwise("N/A").alias("city"))


@R.add("f21_size_labels", "SELECT id, CASE WHEN amount_usd >= 10000000 THEN 'large' WHEN amount_usd >= 1000000 THEN 'medium' WHEN amount_usd >= 0 THEN 'small' ELSE 'none' END AS size FROM investments")
def f21(spark, d):
    u = F.col("amount_usd")
    return table(spark, d, "investments").select("id", F.when(u >= 10_000_000, "large").when(u >= 1_000_000, "medium").when(u >= 0, "small").otherwise("none").alias("size"))


@R.add("f22_split_parts", "SELECT id, CASE WHEN contains(Category, '|') THEN substr(Category, 1, instr(Category, '|') - 1) END AS legacy, CASE WHEN contains(Category, '|') THEN trim(substr(Category, 1, instr(Category, '|') - 1)) END AS trimmed FROM startups")
def f22(spark, d):
    """The part before the bar, with the trailing blank that the older report keeps, and without."""
    first = F.when(F.col("Category").contains("|"), F.substring_index("Category", "|", 1))
    return table(spark, d, "startups").select("id", first.alias("legacy"), F.trim(first).alias("trimmed"))


@R.add("f23_distinct", "SELECT DISTINCT investor_type, status FROM investors")
def f23(spark, d):
    return table(spark, d, "investors").select("investor_type", "status").distinct()


def _top(name: str, t: str, key: str, order: str, k: int, by) -> None:
    R.add(name, f"SELECT {key} FROM {t} ORDER BY {order} LIMIT {k}")(lambda spark, d: table(spark, d, t).orderBy(*by()).limit(k).select(key))


_top("o01_two_keys", "startups", "id", "tech_proximity DESC NULLS LAST, company_name, id", 100, lambda: [F.desc_nulls_last("tech_proximity"), F.asc_nulls_last("company_name"), F.col("id")])
_top("o03_nulls_smallest", "startups", "id", "data_confidence ASC NULLS FIRST, id", 50, lambda: [F.asc_nulls_first("data_confidence"), F.col("id")])
_top("o04_default_in_order", "startups", "id", "coalesce(data_confidence, 0), id", 50, lambda: [F.coalesce("data_confidence", F.lit(0)), F.col("id")])
_top("o08_recent", "investments", "id", "coalesce(investment_date, '') DESC, id", 15, lambda: [F.desc(F.coalesce("investment_date", F.lit(""))), F.col("id")])
_top("o09_queue", "news_mentions", "id", "coalesce(ai_relevance, 0) DESC, scanned_at, id", 30, lambda: [F.desc(F.coalesce("ai_relevance", F.lit(0))), F.asc("scanned_at"), F.col("id")])
_top("r03_investor_batch", "investors", "investor_id", "coalesce(data_confidence, 0), last_enriched NULLS FIRST, investor_id", 25, lambda: [F.coalesce("data_confidence", F.lit(0)), F.asc_nulls_first("last_enriched"), F.col("investor_id")])


@R.add("o07_most_common", "SELECT tech, count(*) AS n FROM (SELECT trim(unnest(string_split(Tech_Mentioned, ','))) AS tech FROM startups) WHERE tech <> '' GROUP BY 1 ORDER BY n DESC, tech LIMIT 10")
def o07(spark, d):
    t = A.tokens(table(spark, d, "startups"), ["Tech_Mentioned"], ",", "tech")
    return A.top(A.counted(t, F.col("tech"), "tech", "n"), "n", "tech", 10)


@R.add("u01_list_union", "SELECT startup_id AS id FROM investments WHERE amount_usd > 5000000 AND startup_id IS NOT NULL UNION SELECT startup_id FROM news_mentions WHERE sentiment = 'positive' AND startup_id IS NOT NULL")
def u01(spark, d):
    a = table(spark, d, "investments").filter("amount_usd > 5000000 and startup_id is not null").select(F.col("startup_id").alias("id"))
    b = table(spark, d, "news_mentions").filter("sentiment = 'positive' and startup_id is not null").select(F.col("startup_id").alias("id"))
    return a.unionByName(b).dropDuplicates(["id"])


_WORDS = "list_filter(regexp_split_to_array(lower(coalesce({c}, '')), '\\s+'), lambda w: length(w) > 2)"


@R.add("u03_shared_words", f"SELECT id, len(list_intersect(list_distinct(a), list_distinct(b))) / greatest(len(list_distinct(a)), 1) AS overlap FROM (SELECT id, {_WORDS.format(c='description')} AS a, {_WORDS.format(c='ai_explanation')} AS b FROM startups)")
def u03(spark, d):
    """How many of a description's words its explanation repeats."""
    words = lambda c: F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), "\\s+"), lambda w: F.length(w) > 2)
    a, b = words("description"), words("ai_explanation")
    return table(spark, d, "startups").select("id", (F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_distinct(a)), F.lit(1))).alias("overlap"))


@R.add("u04_taxonomy", "SELECT * FROM (VALUES " + ", ".join(f"('{s}', '{t}')" for s, ts in taxonomy.PAIRS.items() for t in ts) + ") v(valid_sector, valid_tag)")
def u04(spark, d):
    return taxonomy.taxonomy(spark)


@R.add("a37_outcomes", "SELECT CASE WHEN round_type IS NULL OR trim(round_type) = '' THEN 'filled' WHEN round_type <> trim(round_type) THEN 'trimmed' ELSE 'same' END AS outcome, count(*) AS n FROM investments GROUP BY 1")
def a37(spark, d):
    c = F.col("round_type")
    out = F.when(c.isNull() | (F.trim(c) == ""), "filled").when(c != F.trim(c), "trimmed").otherwise("same")
    return A.counted(table(spark, d, "investments"), out, "outcome", "n")


@R.add("j09_headline_names")
def j09(spark, d):
    """Names in headlines, every run of two or three capitalised words wherever it stands, linked to the companies: exact, by tokens, by part."""
    two, three = ("(\\p{Lu}[\\p{L}\\p{N}]+" + " \\p{Lu}[\\p{L}\\p{N}]+" * n + ")" for n in (1, 2))
    runs = F.array_distinct(F.concat(*(F.regexp_extract_all("headline", F.lit(p), F.lit(1)) for p in (two, three))))
    n = table(spark, d, "news_mentions").select(F.explode(runs).alias("name"))
    known = table(spark, d, "startups").select("id", F.col("company_name").alias("label"))
    return fuzzy.matched(n, known).withColumn("score", F.round("score", 3))


@R.add("j11_source_names")
def j11(spark, d):
    """News sources linked to the reference list by tokens alone."""
    known = table(spark, d, "ref_sources").withColumn("id", F.xxhash64("source_name")).select("id", F.col("source_name").alias("label"))
    return fuzzy.matched(table(spark, d, "documents").select(F.col("source").alias("name")), known, 88, None).withColumn("score", F.round("score", 3))


@R.add("j16_keyword_hits", "SELECT n.id, k.kw FROM news_mentions n JOIN (VALUES ('funding'), ('yatırım'), ('grant'), ('hibe'), ('launch')) k(kw) ON contains(lower(n.headline), k.kw)")
def j16(spark, d):
    """Which of a few words stand in a headline: a filter over a literal array, not a join."""
    kws = F.array(*map(F.lit, ("funding", "yatırım", "grant", "hibe", "launch")))
    return table(spark, d, "news_mentions").select("id", F.explode(F.filter(kws, lambda k: F.contains(F.lower("headline"), k))).alias("kw"))


@R.add("j17_news_sites", "SELECT DISTINCT n.id FROM news_mentions n JOIN ref_sources r ON contains(n.source_url, r.host)")
def j17(spark, d):
    """Articles whose address holds the host of a listed source: a filter over one array of a list of fixed size."""
    hosts = table(spark, d, "ref_sources").filter("host <> ''").agg(F.collect_set("host").alias("hosts"))  # one row
    n = table(spark, d, "news_mentions").select("id", "source_url").crossJoin(F.broadcast(hosts))
    return n.filter(F.exists("hosts", lambda h: F.contains(F.col("source_url"), h))).select("id")


@R.add("s12_keyword_scores")
def s12(spark, d):
    from .flows import _index

    s = table(spark, d, "startups").select("id", "description", taxonomy.tag_of(F.col("Category")).alias("tag")).filter("tag is not null")
    return keywords.scored(s, _index(spark, d), "description", "tag").select("id", "tag", "score")


@R.add("s25_city_alias")
def s25(spark, d):
    """Cities by the first alias that stands in the text, the reference cities being the aliases."""
    ref = table(spark, d, "ref_cities").select("city_id", "city_name", fold(F.col("city_name")).alias("alias"))
    names = ref.agg(F.sort_array(F.collect_list(F.struct("city_id", "alias", "city_name"))).alias("list"))  # one row of a fixed list
    s = table(spark, d, "startups").select("id", "city", fold(squeeze(F.col("city"))).alias("c")).crossJoin(F.broadcast(names))
    hit = F.filter("list", lambda r: F.contains(F.col("c"), r["alias"]))
    return s.select("id", F.coalesce(F.try_element_at(hit, F.lit(1))["city_name"], F.col("city")).alias("city"))


@R.add("s28_prefix_repair", "SELECT investor_id, CASE WHEN len(p) > 1 AND p[1] = p[2] THEN array_to_string(p[2:], ', ') ELSE location END AS location FROM (SELECT *, string_split(location, ', ') AS p FROM investors)")
def s28(spark, d):
    """A place named twice in a row is named once."""
    return table(spark, d, "investors").select("investor_id", F.regexp_replace("location", "^([^,]+), \\1(, |$)", "$1$2").alias("location"))


@R.add("s45_trust_tiers", "SELECT id, CASE WHEN coalesce(data_confidence, 0) < 40 THEN 'A' WHEN data_confidence <= 70 THEN 'B' ELSE 'C' END AS tier FROM startups")
def s45(spark, d):
    c = F.coalesce("data_confidence", F.lit(0))
    return table(spark, d, "startups").select("id", F.when(c < 40, "A").when(c <= 70, "B").otherwise("C").alias("tier"))


@R.add("s51_slug_scores")
def s51(spark, d):
    """How well the slug of a profile address fits the company's name, 0-100."""
    s = table(spark, d, "startups").filter("crunchbase_url is not null")
    slug = F.translate(F.regexp_extract("crunchbase_url", "/organization/([^/?]+)", 1), "-_", "  ")
    x = s.select("id", slug.alias("slug"), F.lower("company_name").alias("name")).filter("slug <> ''")
    return x.select("id", F.round(fuzzy.token_sort_ratio("slug", "name"), 3).alias("score"))


@R.add("s08_similarity")
def s08(spark, d):
    """How alike a company's name and its registered name are, by sorted tokens and by part."""
    s = table(spark, d, "startups").filter("company_name <> '' and legal_business_name <> ''").select("id", S.small(F.col("company_name")).alias("a"), S.small(F.col("legal_business_name")).alias("b"))
    return s.select("id", F.round(fuzzy.token_sort_ratio("a", "b"), 3).alias("tokens"), F.round(fuzzy.partial_ratio("a", "b"), 3).alias("part"))


@R.add("s22_parsed_funding")
def s22(spark, d):
    """Total funding of a company as a number, its currency and dollars, in any notation."""
    s = table(spark, d, "startups").select("id", "Total_Funding_Formatted", F.lit(None).cast("string").alias("code"))
    out = units.readings(s, "Total_Funding_Formatted", "code", "code", table(spark, d, "fx_rates"))
    return out.filter("usd is not null").select("id", "sum", "sum_currency", F.round("usd", 2).alias("usd"))


@R.add("s55_language_codes", "SELECT doc_id, CASE WHEN lower(lang) IN ('tr', 'tur', 'turkish') THEN 'tr' WHEN lower(lang) IN ('en', 'eng', 'english') THEN 'en' WHEN lang IS NULL OR lower(lang) IN ('', 'und') THEN 'unknown' ELSE lower(substr(lang, 1, 2)) END AS lang FROM documents")
def s55(spark, d):
    low = F.lower("lang")
    return table(spark, d, "documents").select("doc_id", F.when(low.isin("tr", "tur", "turkish"), "tr").when(low.isin("en", "eng", "english"), "en").when(F.col("lang").isNull() | low.isin("", "und"), "unknown").otherwise(F.lower(F.substring("lang", 1, 2))).alias("lang"))


@R.add("s60_contacts", "SELECT doc_id, nullif(regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+[.][A-Za-z]{2,}'), '') AS email FROM documents WHERE contains(text, '@')")
def s60(spark, d):
    return table(spark, d, "documents").filter(F.col("text").contains("@")).select("doc_id", F.nullif(F.regexp_extract("text", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+[.][A-Za-z]{2,}", 0), F.lit("")).alias("email"))


TAGS = ["Fintech", "Healthtech", "Agritech", "EdTech", "Cybersecurity"]


@R.add("s61_known_tags", "SELECT investor_id, len(list_filter(list_transform(string_split(focus_areas, ','), lambda x: trim(x)), lambda x: x NOT IN (" + ", ".join(f"'{t}'" for t in TAGS) + "))) = 0 AS known FROM investors WHERE focus_areas IS NOT NULL")
def s61(spark, d):
    tags = F.transform(F.split("focus_areas", ","), lambda x: F.trim(x))
    return table(spark, d, "investors").filter("focus_areas is not null").select("investor_id", (F.size(F.filter(tags, lambda x: ~x.isin(*TAGS))) == 0).alias("known"))


@R.add("s62_bogus_funding", "SELECT id, CASE WHEN regexp_matches(Total_Funding_Formatted, '^(Over |Approximately |About |Undisclosed)|across [0-9]+ |in funding across') OR contains(Total_Funding_Formatted, '.000.000.000') THEN NULL ELSE Total_Funding_Formatted END AS funding FROM startups")
def s62(spark, d):
    c = F.col("Total_Funding_Formatted")
    bad = c.rlike("^(Over |Approximately |About |Undisclosed)|across [0-9]+ |in funding across") | c.contains(".000.000.000")
    return table(spark, d, "startups").select("id", F.when(~bad, c).alias("funding"))


@R.add("db_ingest", """WITH a AS (SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY id) AS k FROM news_mentions WHERE url_hash IS NOT NULL)
SELECT a.id, s.id AS startup_id, CASE WHEN a.ai_relevance < 20 THEN 'blacklisted' WHEN s.id IS NULL THEN 'unlinked' ELSE 'accepted' END AS decision FROM a LEFT JOIN startups s ON a.startup_id = s.id WHERE k = 1""")
def db(spark, d):
    """A batch of articles: each once, then passed over, linked or left unlinked; cheap tests come before the join."""
    n = table(spark, d, "news_mentions").filter("url_hash is not null").groupBy("url_hash").agg(F.min_by(F.struct("id", "startup_id", "ai_relevance"), "id").alias("a")).select("a.*")
    keys = table(spark, d, "startups").select(F.col("id").alias("key"))
    x = n.join(keys, F.col("startup_id") == F.col("key"), "left")
    decision = F.when(F.col("ai_relevance") < 20, "blacklisted").when(F.col("key").isNull(), "unlinked").otherwise("accepted")
    return x.select("id", F.col("key").alias("startup_id"), decision.alias("decision"))


@R.add("de_skeletons", """WITH n AS (SELECT DISTINCT trim(legal_business_name) AS name FROM startups WHERE trim(legal_business_name) <> ''), m AS (SELECT name FROM n WHERE lower(name) NOT IN (SELECT lower(trim(investor_name)) FROM investors WHERE investor_name IS NOT NULL))
SELECT (SELECT max(investor_id) FROM investors) + row_number() OVER (ORDER BY name) AS investor_id, name FROM m""")
def de(spark, d):
    """Records for names that nobody has yet, with ids above the largest. Ids are dense without one task seeing all rows:
    names are range-partitioned, each partition counts its rows, and the counts of the partitions before it are added."""
    s = table(spark, d, "startups").select(F.trim("legal_business_name").alias("name")).filter("name <> ''").distinct().withColumn("k", F.lower("name"))
    i = table(spark, d, "investors").filter("investor_name is not null").select(F.lower(F.trim("investor_name")).alias("k"))
    x = s.join(i, "k", "left_anti").select("name").repartitionByRange("name").sortWithinPartitions("name").withColumn("part", F.spark_partition_id()).withColumn("mono", F.monotonically_increasing_id())
    x = numbered(x)
    top = table(spark, d, "investors").agg(F.max("investor_id").alias("top"))
    return x.crossJoin(F.broadcast(top)).select((F.col("top") + F.col("seq")).alias("investor_id"), "name")  # one row


def numbered(x):
    """x(part, mono, ...) with seq, 1 to n in the order of partition and position."""
    from ..session import checkpointed

    x = checkpointed(x.withColumn("at", F.col("mono").bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = x.groupBy("part").agg((F.max("at") + 1).alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "before")
    return x.join(F.broadcast(before), "part").withColumn("seq", F.col("before") + F.col("at") + 1).drop("part", "mono", "at", "before")  # a row a partition


@R.add("dj_activities", """WITH a AS (SELECT id, startup_id, event_type, substr(scanned_at, 1, 10) AS day, url_hash FROM news_mentions WHERE startup_id IS NOT NULL AND url_hash IS NOT NULL),
h AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY url_hash ORDER BY id) = 1) SELECT id, startup_id, event_type, day FROM h QUALIFY row_number() OVER (PARTITION BY startup_id, event_type, day ORDER BY id) = 1""")
def dj(spark, d):
    """Activities of the news: once per article, then once per company, type and day."""
    a = table(spark, d, "news_mentions").filter("startup_id is not null and url_hash is not null").select("id", "startup_id", "event_type", F.substring("scanned_at", 1, 10).alias("day"), "url_hash")
    once = lambda x, keys: x.groupBy(*keys).agg(F.min_by(F.struct(*a.columns), "id").alias("r")).select("r.*")
    return once(once(a, ["url_hash"]), ["startup_id", "event_type", "day"]).drop("url_hash")


@R.add("dl_spam_reverted", "SELECT s.id, CASE WHEN regexp_matches(s.website, 'unknown|^$') THEN l.details ELSE s.website END AS website FROM startups s LEFT JOIN (SELECT entity_id, arg_max(details, id) AS details FROM cleanup_log WHERE entity_type = 'startup' GROUP BY 1) l ON s.id = l.entity_id WHERE s.website IS NOT NULL")
def dl(spark, d):
    """Bad addresses set back to what the log last says."""
    last = table(spark, d, "cleanup_log").filter("entity_type = 'startup'").groupBy(F.col("entity_id").alias("id")).agg(F.max_by("details", "id").alias("details"))
    s = table(spark, d, "startups").filter("website is not null").select("id", "website")
    return s.join(last, "id", "left").select("id", F.when(F.col("website").rlike("unknown|^$"), F.col("details")).otherwise(F.col("website")).alias("website"))


@R.add("dk_cleanup_audit", """SELECT 'short_name' AS task, 'investors' AS entity_type, investor_id AS entity_id, 'remove' AS action FROM investors WHERE length(trim(investor_name)) < 5
UNION ALL SELECT 'spam_url', 'startups', id, 'clear' FROM startups WHERE regexp_matches(website, 'tinyurl|goo[.]gl') UNION ALL SELECT 'no_currency', 'investments', id, 'repair' FROM investments WHERE amount IS NOT NULL AND (currency IS NULL OR currency IN ('', 'Unknown'))""")
def dk(spark, d):
    """What the cleanup tasks would change, as log rows; writing them is the caller's decision."""
    log = lambda df, task, kind, key, action: df.select(F.lit(task).alias("task"), F.lit(kind).alias("entity_type"), F.col(key).alias("entity_id"), F.lit(action).alias("action"))
    i, s, v = table(spark, d, "investors"), table(spark, d, "startups"), table(spark, d, "investments")
    parts = [
        log(i.filter(F.length(F.trim("investor_name")) < 5), "short_name", "investors", "investor_id", "remove"),
        log(s.filter(F.col("website").rlike("tinyurl|goo[.]gl")), "spam_url", "startups", "id", "clear"),
        log(v.filter(F.col("amount").isNotNull() & (F.col("currency").isNull() | F.col("currency").isin("", "Unknown"))), "no_currency", "investments", "id", "repair"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@R.add("di_scan_selection", "SELECT investor_id FROM (SELECT investor_id FROM investors ORDER BY coalesce(data_confidence, 0) DESC, investor_id LIMIT 30) UNION SELECT investor_id FROM investors WHERE last_enriched IS NULL AND investor_type = 'Accelerator'")
def di(spark, d):
    i = table(spark, d, "investors")
    a = i.orderBy(F.desc(F.coalesce("data_confidence", F.lit(0))), "investor_id").limit(30).select("investor_id")
    return a.unionByName(i.filter("last_enriched is null and investor_type = 'Accelerator'").select("investor_id")).distinct()


@R.add("r15_conditional_fill", "SELECT s.id, CASE WHEN (s.city IS NULL OR lower(trim(s.city)) IN ('nan', 'unknown', 'none', '')) AND i.loc IS NOT NULL THEN i.loc ELSE s.city END AS city FROM startups s LEFT JOIN (SELECT v.startup_id, min(i.location) AS loc FROM investments v JOIN investors i ON v.investor_id = i.investor_id WHERE i.location <> '' GROUP BY 1) i ON s.id = i.startup_id")
def r15(spark, d):
    """A missing city filled from the places of the company's investors."""
    i = table(spark, d, "investors").filter("location <> ''").select("investor_id", "location")
    loc = table(spark, d, "investments").select("startup_id", "investor_id").distinct().join(i, "investor_id").groupBy(F.col("startup_id").alias("id")).agg(F.min("location").alias("loc"))
    s = table(spark, d, "startups").select("id", "city").join(loc, "id", "left")
    return s.select("id", F.when(S.is_absent(F.col("city")) & F.col("loc").isNotNull(), F.col("loc")).otherwise(F.col("city")).alias("city"))


@R.add("sk24_run_log", "SELECT source_name AS module_name, min(scanned_at) AS scan_start, max(scanned_at) AS scan_end, count(*) AS items_found, count(startup_id) AS items_linked FROM news_mentions GROUP BY 1")
def sk24(spark, d):
    return table(spark, d, "news_mentions").groupBy(F.col("source_name").alias("module_name")).agg(F.min("scanned_at").alias("scan_start"), F.max("scanned_at").alias("scan_end"), F.count("*").alias("items_found"), F.count("startup_id").alias("items_linked"))

