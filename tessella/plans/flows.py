"""Upserts, fuzzy links, keywords, repairs and anomalies over the domain tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import taxonomy
from ..operators import aggregates as A
from ..operators import fuzzy, keywords, multivalue, timestamps, upsert
from ..operators import joins as J
from ..session import table
from .registry import Registry

R = Registry()


def _news(spark, d):
    return table(spark, d, "news_mentions").select("id", "startup_id", "url_hash", "headline", "scanned_at")


def _halves(df, key):
    """Two overlapping batches of one table, to write the second onto the first."""
    return df.filter(F.col(key) % 3 != 0), df.filter(F.col(key) % 3 != 1)


HALVES = "a AS (SELECT id, url_hash, headline FROM news_mentions WHERE id % 3 <> 0), b AS (SELECT id, url_hash, headline FROM news_mentions WHERE id % 3 <> 1)"


@R.add("sk02_insert_ignore", f"WITH {HALVES} SELECT * FROM a UNION ALL SELECT id, url_hash, headline FROM (SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY id) AS k FROM b WHERE url_hash NOT IN (SELECT url_hash FROM a WHERE url_hash IS NOT NULL)) WHERE k = 1")
def sk02(spark, d):
    a, b = _halves(_news(spark, d).select("id", "url_hash", "headline"), "id")
    return upsert.insert_ignore(a, b, ["url_hash"], F.col("id"))[0]


@R.add("sk03_insert_replace", f"WITH {HALVES}, n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY id DESC) AS k FROM b) WHERE k = 1) SELECT id, url_hash, headline FROM a WHERE url_hash NOT IN (SELECT url_hash FROM n) UNION ALL SELECT id, url_hash, NULL FROM n")
def sk03(spark, d):
    """The later batch names no headline, so the replaced rows have none."""
    a, b = _halves(_news(spark, d).select("id", "url_hash", "headline"), "id")
    return upsert.insert_replace(a, b.drop("headline"), ["url_hash"], F.col("id"))


@R.add("sk04_accumulate", """WITH k AS (SELECT event_type AS tag, user_id AS word FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2), h AS (SELECT event_type AS tag, user_id AS word, count(*) AS n FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2)
SELECT coalesce(k.tag, h.tag) AS tag, coalesce(k.word, h.word) AS word, CAST(round(CASE WHEN k.tag IS NULL THEN least(10.0, 0.5 + 0.3 * (n - 1)) WHEN n IS NULL THEN 0.5 ELSE least(10.0, 0.5 + 0.3 * n) END, 6) AS DOUBLE) AS weight FROM k FULL JOIN h ON k.tag = h.tag AND k.word = h.word""")
def sk04(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("event_type").alias("tag"), F.col("user_id").alias("word"))
    known = e.filter("event_id % 2 = 0").select("tag", "word").distinct().withColumn("weight", F.lit(0.5))
    return upsert.accumulated(known, e.filter("event_id % 2 = 1"), ["tag", "word"]).withColumn("weight", F.round("weight", 6))


CHANGED = "(SELECT startup_id AS id, max(scanned_at) AS last_updated FROM news_mentions WHERE startup_id IS NOT NULL GROUP BY 1)"


def _changes(spark, d):
    return table(spark, d, "news_mentions").filter("startup_id is not null").groupBy(F.col("startup_id").alias("id")).agg(F.max("scanned_at").alias("last_updated"))


@R.add("sk05_update_by_key", f"SELECT s.id, CASE WHEN c.id IS NOT NULL THEN c.last_updated ELSE s.last_updated END AS last_updated FROM startups s LEFT JOIN {CHANGED} c ON s.id = c.id")
def sk05(spark, d):
    return upsert.updated(table(spark, d, "startups").select("id", "last_updated"), _changes(spark, d), ["id"])


@R.add("sk07_keep_if_set", f"SELECT s.id, coalesce(s.last_updated, c.last_updated) AS last_updated FROM startups s LEFT JOIN {CHANGED} c ON s.id = c.id")
def sk07(spark, d):
    return upsert.updated(table(spark, d, "startups").select("id", "last_updated"), _changes(spark, d), ["id"], keep_old=True)


@R.add("sk06_dates_from_news", """SELECT v.id, coalesce(CASE WHEN v.investment_date IS NULL OR trim(v.investment_date) IN ('', 'Unknown', 'None', 'N/A', 'unknown') THEN substr(n.scanned_at, 1, 10) END, v.investment_date) AS investment_date
FROM investments v LEFT JOIN news_mentions n ON v.news_mention_id = n.id""")
def sk06(spark, d):
    """Missing dates set from the linked news, which is reduced to one row a key first."""
    v = table(spark, d, "investments").select("id", "news_mention_id", "investment_date")
    n = table(spark, d, "news_mentions").groupBy(F.col("id").alias("news_mention_id")).agg(F.min(F.substring("scanned_at", 1, 10)).alias("day"))
    bad = F.col("investment_date").isNull() | F.trim("investment_date").isin("", "Unknown", "None", "N/A", "unknown")
    return v.join(n, "news_mention_id", "left").select("id", F.coalesce(F.when(bad, F.col("day")), F.col("investment_date")).alias("investment_date"))


@R.add("sk08_noted", "SELECT id, coalesce(data_notes || '; ', '') || 'no amount' AS data_notes FROM investments WHERE amount IS NULL")
def sk08(spark, d):
    return table(spark, d, "investments").filter("amount is null").select("id", upsert.noted(F.col("data_notes"), F.lit("no amount")).alias("data_notes"))


@R.add("sk09_delete_cascade", "SELECT id FROM investments WHERE startup_id IS NULL OR startup_id NOT IN (SELECT id FROM startups WHERE Status = 'Stale')")
def sk09(spark, d):
    gone = table(spark, d, "startups").filter("Status = 'Stale'").select(F.col("id").alias("startup_id"))
    return upsert.without(table(spark, d, "investments").select("id", "startup_id"), gone, ["startup_id"]).select("id")


@R.add("sk10_soft_delete", "SELECT investor_id, CASE WHEN NOT EXISTS (SELECT 1 FROM investments v WHERE v.investor_id = i.investor_id) THEN 'removed' ELSE status END AS status FROM investors i")
def sk10(spark, d):
    used = table(spark, d, "investments").select("investor_id").distinct().withColumn("used", F.lit(True))
    return table(spark, d, "investors").join(used, "investor_id", "left").select("investor_id", F.when(F.col("used").isNull(), "removed").otherwise(F.col("status")).alias("status"))


@R.add("da_arbitrated_changes")
def da(spark, d):
    """Field changes of users that hold against a log of the first events."""
    e = table(spark, d, "events").select(F.col("user_id").alias("entity_id"), F.col("event_type").alias("field"), F.col("event_id").alias("seq"), F.col("props").alias("value"), F.floor("value").cast("int").alias("confidence"))
    return upsert.arbitrated(e.filter("seq % 10 = 0"), e.filter("seq % 10 <> 0"), ["entity_id", "field"])


@R.add("dc_deal_duplicates", """SELECT v.id, min(w.id) AS first_id FROM investments v JOIN investments w ON v.startup_id = w.startup_id AND v.investor_id = w.investor_id AND lower(trim(v.round_type)) = lower(trim(w.round_type))
AND substr(trim(v.investment_date), 1, 4) IS NOT DISTINCT FROM substr(trim(w.investment_date), 1, 4) AND w.id < v.id WHERE trim(v.round_type) <> '' AND upper(trim(v.round_type)) <> 'NA' GROUP BY v.id""")
def dc(spark, d):
    """Deals entered again: the same startup, investor, round and year (or no date); rounds that say nothing never match."""
    v = table(spark, d, "investments").filter((F.trim("round_type") != "") & (F.upper(F.trim("round_type")) != "NA") & F.col("startup_id").isNotNull() & F.col("investor_id").isNotNull())
    k = ["startup_id", "investor_id", "r", "y"]
    v = v.select("id", "startup_id", "investor_id", F.lower(F.trim("round_type")).alias("r"), F.coalesce(F.substring(F.trim("investment_date"), 1, 4), F.lit("none")).alias("y"))
    first = v.groupBy(*k).agg(F.min("id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")
    return v.join(first, k).filter("id > first_id").select("id", "first_id")


@R.add("dm_currency_repaired", """SELECT v.id, CASE WHEN v.currency IS NOT NULL AND v.currency NOT IN ('', 'Unknown') THEN v.currency ELSE coalesce(CASE WHEN contains(v.amount, '$') THEN 'USD' WHEN contains(v.amount, '€') THEN 'EUR' WHEN contains(v.amount, '₺') THEN 'TRY' WHEN contains(v.amount, '£') THEN 'GBP' WHEN contains(v.amount, '¥') THEN 'JPY' WHEN contains(v.amount, '₹') THEN 'INR'
WHEN contains(upper(v.amount), 'AED') THEN 'AED' WHEN contains(upper(v.amount), 'CHF') THEN 'CHF' WHEN contains(upper(v.amount), 'CNY') THEN 'CNY' WHEN contains(upper(v.amount), 'EUR') THEN 'EUR' WHEN contains(upper(v.amount), 'GBP') THEN 'GBP' WHEN contains(upper(v.amount), 'INR') THEN 'INR' WHEN contains(upper(v.amount), 'JPY') THEN 'JPY' WHEN contains(upper(v.amount), 'SAR') THEN 'SAR' WHEN contains(upper(v.amount), 'TRY') THEN 'TRY' WHEN contains(upper(v.amount), 'USD') THEN 'USD' END,
CASE WHEN s.city <> '' THEN 'USD' END, v.currency) END AS currency FROM investments v LEFT JOIN startups s ON v.startup_id = s.id""")
def dm(spark, d):
    v = table(spark, d, "investments").select("id", "startup_id", "amount", "currency")
    s = table(spark, d, "startups").select(F.col("id").alias("startup_id"), "city")
    known = F.col("currency").isNotNull() & ~F.col("currency").isin("", "Unknown")
    new = F.coalesce(S.currency_by_sign(F.col("amount")), F.when(F.col("city") != "", "USD"), F.col("currency"))
    return v.join(s, "startup_id", "left").select("id", F.when(known, F.col("currency")).otherwise(new).alias("currency"))


# Words that make an address suspicious; rounds that are early.
SUSPICIOUS = ["cheat", "hack", "casino", "bet", "porn", "forex", "crypto-bot"]
EARLY = ["Seed", "Pre-Seed", "Angel"]


@R.add("do_anomalies", f"""SELECT 'startup' AS kind, id AS entity_id, CAST(NULL AS BIGINT) AS other_id, 'spam_url' AS code, 90 AS priority FROM startups WHERE regexp_matches(lower(website), '{"|".join(SUSPICIOUS)}')
UNION ALL SELECT 'investment', id, startup_id, 'implausible_amount', 75 FROM investments WHERE round_type IN ('Seed', 'Pre-Seed', 'Angel') AND amount_usd > 20000000
UNION ALL SELECT 'startup', entity_id, NULL, 'unstable', 65 FROM cleanup_log WHERE lower(entity_type) LIKE 'startup%' GROUP BY entity_id HAVING count(*) > 2
UNION ALL SELECT 'startup', s.id, n.id, 'foreign_source', 55 FROM startups s JOIN (SELECT startup_id, arg_max(id, (scanned_at, id)) AS id, arg_max(source_language, (scanned_at, id)) AS lang, max(scanned_at) AS seen FROM news_mentions WHERE startup_id IS NOT NULL GROUP BY 1) n ON n.startup_id = s.id
WHERE n.seen >= '2026-05-01' AND n.lang <> 'tr' AND (s.city IS NULL OR lower(trim(s.city)) IN ('nan', 'unknown', 'none', ''))""")
def do(spark, d):
    """Four rules over the tables, in one shape with a priority: suspicious addresses, too much money too early (with both ids),
    records changed again and again, companies without a city whose latest news is foreign."""
    n, v, s, log = (table(spark, d, t) for t in ("news_mentions", "investments", "startups", "cleanup_log"))
    none = F.lit(None).cast("bigint")
    shape = lambda df, kind, key, other, code, pri: df.select(F.lit(kind).alias("kind"), F.col(key).alias("entity_id"), other.alias("other_id"), F.lit(code).alias("code"), F.lit(pri).alias("priority"))
    last = J.latest(n.filter("startup_id is not null").select(F.col("startup_id").alias("id"), F.col("id").alias("news_id"), "source_language", "scanned_at"), ["id"], F.struct("scanned_at", "news_id"), ["news_id", "source_language", "scanned_at"])
    foreign = s.filter(S.is_absent(F.col("city"))).select("id").join(last.filter("scanned_at >= '2026-05-01' and source_language <> 'tr'"), "id")
    return reduce(lambda a, b: a.unionByName(b), [
        shape(s.filter(F.lower("website").rlike("|".join(SUSPICIOUS))), "startup", "id", none, "spam_url", 90),
        shape(v.filter(F.col("round_type").isin(*EARLY) & (F.col("amount_usd") > 20_000_000)), "investment", "id", F.col("startup_id"), "implausible_amount", 75),
        shape(log.filter(F.lower("entity_type").startswith("startup")).groupBy("entity_id").agg(F.count("*").alias("c")).filter("c > 2"), "startup", "entity_id", none, "unstable", 65),
        shape(foreign, "startup", "id", F.col("news_id"), "foreign_source", 55),
    ])


@R.add("ds_company_report", """SELECT s.id, coalesce(n.n, 0) AS n_news, n.newest, coalesce(v.n, 0) AS n_deals, v.usd FROM startups s LEFT JOIN (SELECT startup_id, count(*) AS n, max(scanned_at) AS newest FROM news_mentions GROUP BY 1) n ON n.startup_id = s.id
LEFT JOIN (SELECT startup_id, count(*) AS n, round(sum(amount_usd), 2) AS usd FROM investments GROUP BY 1) v ON v.startup_id = s.id""")
def ds(spark, d):
    """What is known of each company; both sides are reduced before they meet it."""
    n = table(spark, d, "news_mentions").groupBy(F.col("startup_id").alias("id")).agg(F.count("*").alias("n_news"), F.max("scanned_at").alias("newest"))
    v = table(spark, d, "investments").groupBy(F.col("startup_id").alias("id")).agg(F.count("*").alias("n_deals"), F.round(F.sum("amount_usd"), 2).alias("usd"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return table(spark, d, "startups").select("id").join(n, "id", "left").join(v, "id", "left").select("id", zero("n_news"), "newest", zero("n_deals"), "usd")


@R.add("dn_dates_repaired")
def dn(spark, d):
    """Deal dates in three tiers: the date itself, else the day of its news, else null; with what was used."""
    v = table(spark, d, "investments").select("id", "news_mention_id", "investment_date")
    v = timestamps.normalised(v, "investment_date", F.lit("180"), F.lit("DMY"))
    n = table(spark, d, "news_mentions").groupBy(F.col("id").alias("news_mention_id")).agg(F.min(F.substring("scanned_at", 1, 10)).alias("seen"))
    own = F.substring("normal", 1, 10)
    return v.join(n, "news_mention_id", "left").select("id", F.coalesce(own, "seen").alias("day"), F.when(own.isNotNull(), "own").when(F.col("seen").isNotNull(), "news").otherwise("none").alias("tier"))


ROUND = "CASE WHEN round_type IS NULL OR trim(round_type) = '' THEN 'NA' " + " ".join(f"WHEN lower(replace(trim(round_type), 'İ', 'i' || chr(775))) = '{k}' THEN '{v}'" for k, v in S.ROUNDS.items()) + " ELSE trim(round_type) END"


@R.add("r12_normalised_audit", f"SELECT id, 'round_type' AS field, round_type AS old_value, {ROUND} AS new_value FROM investments WHERE round_type IS DISTINCT FROM {ROUND}")
def r12(spark, d):
    """A dry run of a normaliser: only the rows it would change, old and new."""
    return audited(table(spark, d, "investments"), "id", "round_type", S.round_type(F.col("round_type")))


def audited(df, key, field, new):
    x = df.select(F.col(key), F.lit(field).alias("field"), F.col(field).alias("old_value"), new.alias("new_value"))
    return x.filter(~F.col("old_value").eqNullSafe(F.col("new_value")))


@R.add("j10_investor_links")
def j10(spark, d):
    """Investor names of the startups' packed lists linked to the investors: exact, by tokens, by part."""
    items = multivalue.items(multivalue.unpivoted(table(spark, d, "startups"), "id", ["Investors"]))
    known = table(spark, d, "investors").select(F.col("investor_id").alias("id"), F.col("investor_name").alias("label"))
    return fuzzy.matched(items.select(F.col("item").alias("name")), known).withColumn("score", F.round("score", 3))


@R.add("j12_legal_names")
def j12(spark, d):
    """Registered names linked to company names from a token similarity of 80 on."""
    s = table(spark, d, "startups")
    return fuzzy.matched(s.select(F.col("legal_business_name").alias("name")), s.select("id", F.col("company_name").alias("label")), 80, None).withColumn("score", F.round("score", 3))


def _index(spark, d):
    """(tag, keyword, weight): words of the descriptions by tag."""
    s = table(spark, d, "startups").select(taxonomy.tag_of(F.col("Category")).alias("tag"), F.explode(keywords.learned(F.col("description"))).alias("keyword")).filter("tag is not null")
    return upsert.accumulated(s.limit(0).select("tag", "keyword").withColumn("weight", F.lit(0.0)), s, ["tag", "keyword"])


@R.add("s11_learned_keywords")
def s11(spark, d):
    return _index(spark, d).withColumn("weight", F.round("weight", 6))


@R.add("a28_tag_accuracy")
def a28(spark, d):
    """Per tag the share of companies whose description bears it out."""
    s = table(spark, d, "startups").select("id", "description", taxonomy.tag_of(F.col("Category")).alias("tag")).filter("tag is not null")
    x = keywords.scored(s, _index(spark, d), "description", "tag")
    g = x.groupBy("tag").agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("score") >= 0.15, 100.0).otherwise(0.0)), 1).alias("accuracy"))
    return g.withColumn("verdict", F.when(F.col("accuracy") >= 70, "OK").when(F.col("accuracy") >= 40, "LOW").otherwise("CRITICAL"))


@R.add("s13_best_tags")
def s13(spark, d):
    return keywords.best_tags(table(spark, d, "startups").select("id", "description"), _index(spark, d), "id", "description")


@R.add("w04_last_log_entry", "SELECT entity_type, entity_id, arg_max(action, id) AS action, max(id) AS id FROM cleanup_log GROUP BY 1, 2")
def w04(spark, d):
    return J.latest(table(spark, d, "cleanup_log").select("entity_type", "entity_id", "action", "id"), ["entity_type", "entity_id"], F.col("id"), ["action", "id"])


@R.add("u02_rules_of_suspects", """SELECT id, 'short' AS rule FROM startups WHERE length(trim(company_name)) < 5 UNION SELECT id, 'bare' FROM startups WHERE description IS NULL OR description = '' UNION SELECT id, 'old' FROM startups WHERE founded_year < 2008""")
def u02(spark, d):
    s = table(spark, d, "startups")
    rules = [(F.length(F.trim("company_name")) < 5, "short"), (~A.filled(F.col("description")), "bare"), (F.col("founded_year") < 2008, "old")]
    return s.select("id", F.explode(F.filter(F.array(*(F.when(c, n) for c, n in rules)), lambda x: x.isNotNull())).alias("rule"))


@R.add("o05_refresh_queue", "SELECT id FROM startups ORDER BY coalesce(data_confidence, 0) > 0, founders IS NOT NULL AND founders <> '', coalesce(data_confidence, 0), id LIMIT 50")
def o05(spark, d):
    c = F.coalesce("data_confidence", F.lit(0))
    return table(spark, d, "startups").orderBy(c > 0, F.coalesce(F.col("founders") != "", F.lit(False)), c, "id").limit(50).select("id")


@R.add("o02_nulls_first", "SELECT investor_id FROM investors ORDER BY last_enriched ASC NULLS FIRST, investor_id LIMIT 20")
def o02(spark, d):
    return table(spark, d, "investors").orderBy(F.asc_nulls_first("last_enriched"), "investor_id").limit(20).select("investor_id")


@R.add("r09_selection", "SELECT id FROM startups WHERE data_confidence BETWEEN 20 AND 60 AND description <> '' AND Category ILIKE '%tech%' AND Status <> 'Stale'")
def r09(spark, d):
    """A selection put together from optional conditions."""
    conds = [F.col("data_confidence").between(20, 60), F.col("description") != "", F.col("Category").ilike("%tech%"), F.col("Status") != "Stale"]
    return table(spark, d, "startups").filter(reduce(lambda a, b: a & b, conds)).select("id")


@R.add("f05_like_chain", "SELECT investor_id FROM investors WHERE location ILIKE '%turkey%' OR location ILIKE '%türkiye%' OR location ILIKE '%kale%'")
def f05(spark, d):
    return table(spark, d, "investors").filter(reduce(lambda a, b: a | b, (F.col("location").ilike(f"%{w}%") for w in ("turkey", "türkiye", "kale")))).select("investor_id")


@R.add("f16_two_subqueries", "SELECT id FROM startups WHERE id IN (SELECT startup_id FROM investments WHERE amount_usd > 1000000) OR id IN (SELECT startup_id FROM news_mentions WHERE event_type = 'funding')")
def f16(spark, d):
    a = table(spark, d, "investments").filter("amount_usd > 1000000").select(F.col("startup_id").alias("id"))
    b = table(spark, d, "news_mentions").filter("event_type = 'funding'").select(F.col("startup_id").alias("id"))
    return table(spark, d, "startups").select("id").join(a.unionByName(b).distinct(), "id", "left_semi")


@R.add("f24_word_count", "SELECT id FROM startups WHERE length(description) - length(replace(description, ' ', '')) >= 5")
def f24(spark, d):
    return table(spark, d, "startups").filter(F.length("description") - F.length(F.replace("description", F.lit(" "), F.lit(""))) >= 5).select("id")
