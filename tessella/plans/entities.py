"""Cloud labels, entity kinds, investor links, refresh and scan selections, the review queue and report lookups over the domain tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import taxonomy
from ..functions.text import fold, squeeze
from ..operators import aggregates as A
from ..operators import fuzzy, keywords, upsert
from ..operators.nearest import nearest
from ..session import checkpointed, looked_up, table
from .registry import Registry

R = Registry()
#: the day as of which rows are judged
AS_OF = "2026-05-31"


def _any(c: str, words: list[str]) -> str:
    return "coalesce(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ", false)"


def _in(c: str) -> str:
    return f"coalesce({c}, '')"


_T = "lower(coalesce(description, '') || ' ' || coalesce(Tech_Mentioned, ''))"
_CAT = "lower(coalesce(Category, ''))"
_SIGNAL = f"CASE WHEN {_any(_T, S.NO_CLOUD)} AND NOT {_any(_T, S.CLOUD)} THEN 'negative' WHEN {_any(_T, S.CLOUD)} AND NOT {_any(_T, S.NO_CLOUD)} THEN 'positive' ELSE 'ambiguous' END"
_LIST = "[" + ", ".join(f"'{w}'" for w in [*S.CLOUD, *S.NO_CLOUD]) + "]"


@R.add("s38_cloud_hits", f"SELECT id, array_to_string(list_filter({_LIST}, lambda w: contains({_T}, w)), ', ') AS hits FROM startups")
def s38(spark, d):
    """The words for and against the cloud that a company's texts hold."""
    return table(spark, d, "startups").select("id", F.array_join(S.cloud_hits(F.col("description"), F.col("Tech_Mentioned")), ", ").alias("hits"))


@R.add("s39_cloud_corrected", f"""SELECT id, CASE WHEN lower({_in('business_model')}) = 'product' AND cloud_relevance IN ('Non-Cloud', 'Cloud-Adjacent') AND {_any(_T, S.WEB_SIGNS)} THEN 'Cloud-Enabled'
WHEN {_any(_CAT, S.HARDWARE_TAGS)} AND cloud_relevance = 'Cloud-Adjacent' AND NOT {_any(_T, S.CLOUD_PROOF)} THEN 'Non-Cloud' WHEN {_any(_T, S.PRIVATE_SIGNS)} THEN 'Non-Cloud' ELSE cloud_relevance END AS label FROM startups""")
def s39(spark, d):
    return table(spark, d, "startups").select("id", S.cloud_corrected(*(F.col(c) for c in ("cloud_relevance", "description", "Tech_Mentioned", "business_model", "Category"))).alias("label"))


@R.add("s40_cloud_label", f"""SELECT id, CASE WHEN signal = 'positive' THEN CASE WHEN {_any('cat', S.NATIVE_TAGS)} THEN 'Cloud-Native' ELSE 'Cloud-Enabled' END WHEN signal = 'negative' THEN 'Non-Cloud' WHEN {_any('cat', S.ADJACENT_TAGS)} THEN 'Cloud-Adjacent' END AS label
FROM (SELECT id, {_SIGNAL} AS signal, {_CAT} AS cat FROM startups)""")
def s40(spark, d):
    return table(spark, d, "startups").select("id", S.cloud_label(F.col("description"), F.col("Tech_Mentioned"), F.col("Category")).alias("label"))


@R.add("s41_cloud_repaired", "SELECT id, CASE WHEN cloud_relevance IS NOT NULL THEN CASE " + " ".join(f"WHEN replace(lower(cloud_relevance), ' ', '-') = '{x.lower()}' THEN '{x}'" for x in S.CLOUD_LABELS) + " ELSE 'Cloud-Adjacent' END END AS label FROM startups")
def s41(spark, d):
    return table(spark, d, "startups").select("id", S.cloud_repaired(F.col("cloud_relevance")).alias("label"))


_TECHS = "lower(coalesce(Tech_Mentioned, '')) || ' ' || lower(coalesce(Tech_Assumed, ''))"
_EVERY = f"lower(coalesce(description, '')) || ' ' || lower(coalesce(AI_Use_Case, '')) || ' ' || {_TECHS}"
_PROXIMITY = f"CASE WHEN {_any(f'({_EVERY})', S.AI_WORDS)} THEN CASE WHEN {_any(f'({_EVERY})', S.AI_CENTRAL)} OR contains(lower({_in('AI_Use_Case')}), 'platform') THEN 100 ELSE 80 END WHEN {_TECHS} <> 'none' AND length({_TECHS}) > 5 THEN 30 ELSE 0 END"


def _proximity():
    return S.proximity(*(F.col(c) for c in ("description", "AI_Use_Case", "Tech_Mentioned", "Tech_Assumed")))


@R.add("s42_proximity", f"SELECT id, {_PROXIMITY} AS proximity FROM startups")
def s42(spark, d):
    return table(spark, d, "startups").select("id", _proximity().alias("proximity"))


_JUNK = "coalesce(lower(trim({c})) IN (" + ", ".join(f"'{w}'" for w in S.NO_ENTITY) + ") OR length(trim({c})) < 3 OR length(trim({c})) > 80 OR regexp_matches(trim({c}), '^[0-9]') OR " + "{any}, true)"
_KIND = "CASE " + " ".join(f"WHEN {_any('lower({c})', w)} THEN '{k}'" for k, w in S.ENTITY_KINDS.items()) + " END"


def _junk_sql(c: str) -> str:
    return _JUNK.format(c=c, any=_any(f"lower(trim({c}))", S.ENTITY_JUNK))


@R.add("s43_entity_kinds", f"SELECT investor_id, {_junk_sql('investor_name')} AS junk, {_KIND.replace('{c}', 'investor_name')} AS kind FROM investors")
def s43(spark, d):
    """Whether a name is none, and what kind of organisation its words say it is."""
    n = F.col("investor_name")
    return table(spark, d, "investors").select("investor_id", S.entity_junk(n).alias("junk"), S.entity_kind(n).alias("kind"))


@R.add("df_gatekeeper", f"""SELECT id, CASE WHEN {_junk_sql('company_name')} THEN 'blacklist' WHEN kind IS NOT NULL THEN 'move' WHEN lower(trim({_in('city')})) = 'foreign' THEN 'blacklist' WHEN proximity > 0 THEN 'commit' ELSE 'blacklist' END AS decision, kind, proximity
FROM (SELECT id, company_name, city, {_KIND.replace('{c}', 'company_name')} AS kind, {_PROXIMITY} AS proximity FROM startups WHERE coalesce(tech_proximity, 0) = 0 AND coalesce(data_confidence, 20) >= 20)""")
def df(spark, d):
    """One decision a record, from which each branch's write is a filter: names that are none and foreign ones go, other kinds of organisation move, those with technology stay."""
    s = table(spark, d, "startups").filter((F.coalesce("tech_proximity", F.lit(0)) == 0) & (F.coalesce("data_confidence", F.lit(20)) >= 20))
    x = s.select("id", "company_name", "city", S.entity_kind(F.col("company_name")).alias("kind"), _proximity().alias("proximity"))
    out = F.when(S.entity_junk(F.col("company_name")), "blacklist").when(F.col("kind").isNotNull(), "move").when(F.lower(F.trim(F.coalesce("city", F.lit("")))) == "foreign", "blacklist").when(F.col("proximity") > 0, "commit").otherwise("blacklist")
    return x.select("id", out.alias("decision"), "kind", "proximity")


_LISTED = """SELECT DISTINCT id AS startup_id, trim(x) AS name FROM (SELECT id, unnest(string_split(Investors, ',')) AS x FROM startups WHERE lower(trim(Investors)) NOT IN ('nan', 'unknown', 'none', '')) WHERE length(trim(x)) BETWEEN 3 AND 80"""


def _listed(spark, d):
    s = table(spark, d, "startups").filter(~F.lower(F.trim("Investors")).isin("nan", "unknown", "none", ""))
    x = s.select(F.col("id").alias("startup_id"), F.explode(F.split("Investors", ",")).alias("x")).select("startup_id", F.trim("x").alias("name"))
    return x.filter(F.length("name").between(3, 80)).distinct()


@R.add("dd_investor_links", f"""WITH l AS ({_LISTED}), k AS (SELECT investor_name AS name, min(investor_id) AS investor_id FROM investors GROUP BY 1), p AS (SELECT DISTINCT startup_id, investor_id FROM investments)
SELECT l.startup_id, l.name, k.investor_id, CASE WHEN k.investor_id IS NULL THEN 'create' WHEN p.startup_id IS NULL THEN 'link' ELSE 'update' END AS action FROM l LEFT JOIN k ON l.name = k.name LEFT JOIN p ON p.startup_id = l.startup_id AND p.investor_id = k.investor_id""")
def dd(spark, d):
    """The investors that a company lists, looked up by name: those to create, to link and to update, each pair once."""
    known = table(spark, d, "investors").groupBy(F.col("investor_name").alias("name")).agg(F.min("investor_id").alias("investor_id"))
    pairs = table(spark, d, "investments").select("startup_id", "investor_id").distinct().withColumn("linked", F.lit(True))
    x = _listed(spark, d).join(known, "name", "left").join(pairs, ["startup_id", "investor_id"], "left")
    return x.select("startup_id", "name", "investor_id", F.when(F.col("investor_id").isNull(), "create").when(F.col("linked").isNull(), "link").otherwise("update").alias("action"))


@R.add("dw_portfolio_records", f"WITH l AS ({_LISTED}) SELECT l.name, count(*) AS n_companies FROM l WHERE lower(l.name) NOT IN (SELECT lower(investor_name) FROM investors WHERE investor_name IS NOT NULL) GROUP BY 1")
def dw(spark, d):
    """Names that companies list and nobody has a record of, with how many list them."""
    known = table(spark, d, "investors").filter("investor_name is not null").select(F.lower("investor_name").alias("k")).distinct()
    return _listed(spark, d).withColumn("k", F.lower("name")).join(known, "k", "left_anti").groupBy("name").agg(F.count("*").alias("n_companies"))


def _stale(name: str, t: str, key: str, days: int, extra: str, cond) -> None:
    sql = f"SELECT {key}, last_updated FROM {t} WHERE (last_updated IS NULL OR last_updated < CAST(DATE '{AS_OF}' - INTERVAL {days} DAY AS DATE)::VARCHAR) AND (data_confidence IS NULL OR data_confidence >= 20){extra}"

    def run(spark, d):
        cut = F.date_sub(F.lit(AS_OF).cast("date"), days).cast("string")
        x = table(spark, d, t).filter((F.col("last_updated").isNull() | (F.col("last_updated") < cut)) & (F.col("data_confidence").isNull() | (F.col("data_confidence") >= 20)))
        return (x.filter(cond()) if cond else x).select(key, "last_updated")

    R.add(name, sql)(run)


_stale("r02_stale_startups", "startups", "id", 7, " AND Status <> 'Blacklisted'", lambda: F.col("Status") != "Blacklisted")
_stale("r02_stale_investors", "investors", "investor_id", 30, "", None)

_TIER = "CASE WHEN last_updated IS NULL OR last_updated < '2026-05-01' THEN 3 WHEN last_updated < '2026-05-17' THEN 2 ELSE 1 END"
_GAPS = ("website", "description", "city", "founders")
_MISSING = "list_filter([" + ", ".join(f"CASE WHEN {c} IS NULL OR lower(trim({c})) IN ('nan', 'unknown', 'none', '') THEN '{c}' END" for c in _GAPS) + "], lambda x: x IS NOT NULL)"


@R.add("dg_refresh_plan", f"SELECT id, {_TIER} AS tier, CASE WHEN {_TIER} = 1 THEN '' ELSE array_to_string({_MISSING}, ', ') END AS delta FROM startups WHERE Status <> 'Blacklisted' AND (last_updated IS NULL OR last_updated < '2026-05-24') AND (data_confidence IS NULL OR data_confidence >= 20)")
def dg(spark, d):
    """The tier of each stale record by age, and the fields that its refresh has to fill: none in the first tier, which only checks the site."""
    u = F.col("last_updated")
    s = table(spark, d, "startups").filter((F.col("Status") != "Blacklisted") & (u.isNull() | (u < "2026-05-24")) & (F.col("data_confidence").isNull() | (F.col("data_confidence") >= 20)))
    tier = F.when(u.isNull() | (u < "2026-05-01"), 3).when(u < "2026-05-17", 2).otherwise(1)
    return s.select("id", tier.alias("tier"), F.when(tier == 1, "").otherwise(F.array_join(S.absent_fields(list(_GAPS)), ", ")).alias("delta"))


@R.add("dh_investor_refresh", f"""WITH l AS ({_LISTED}), n AS (SELECT lower(name) AS k, count(*) AS n FROM l GROUP BY 1), v AS (SELECT investor_id, count(DISTINCT startup_id) AS n FROM investments GROUP BY 1)
SELECT i.investor_id, coalesce(n.n, 0) AS listed, coalesce(v.n, 0) AS linked FROM investors i LEFT JOIN n ON n.k = lower(i.investor_name) LEFT JOIN v ON v.investor_id = i.investor_id WHERE i.last_updated IS NULL OR i.last_updated < '2026-05-01'""")
def dh(spark, d):
    """Stale investors with the companies that list them and those they are linked with: what a refresh has to discover."""
    i = table(spark, d, "investors").filter(F.col("last_updated").isNull() | (F.col("last_updated") < "2026-05-01")).select("investor_id", F.lower("investor_name").alias("k"))
    n = _listed(spark, d).groupBy(F.lower("name").alias("k")).agg(F.count("*").alias("listed"))
    v = table(spark, d, "investments").groupBy("investor_id").agg(F.countDistinct("startup_id").alias("linked"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return i.join(n, "k", "left").join(v, "investor_id", "left").select("investor_id", zero("listed"), zero("linked"))


QUEUE = """SELECT 'startup' AS entity_type, id AS entity_id, 'classify' AS action, greatest(0, 100 - data_confidence) AS priority FROM startups WHERE data_confidence < 40
UNION ALL SELECT 'investor', investor_id, 'verify', 60 FROM investors WHERE investor_type IS NULL OR data_confidence = 0 UNION ALL SELECT 'news', id, 'review', 40 FROM news_mentions WHERE ai_relevance BETWEEN 30 AND 70 OR summary IS NULL OR summary = ''"""


def queue(spark, d):
    """(entity_type, entity_id, action, priority): what reviewers should look at; the less sure, the sooner."""
    row = lambda x, kind, key, action, priority: x.select(F.lit(kind).alias("entity_type"), F.col(key).alias("entity_id"), F.lit(action).alias("action"), priority.cast("int").alias("priority"))
    s = table(spark, d, "startups").filter("data_confidence < 40")
    i = table(spark, d, "investors").filter("investor_type is null or data_confidence = 0")
    n = table(spark, d, "news_mentions").filter("ai_relevance between 30 and 70 or summary is null or summary = ''")
    return row(s, "startup", "id", "classify", F.greatest(F.lit(0), 100 - F.col("data_confidence"))).unionByName(row(i, "investor", "investor_id", "verify", F.lit(60))).unionByName(row(n, "news", "id", "review", F.lit(40)))


@R.add("dp_queue", QUEUE)
def dp(spark, d):
    return queue(spark, d)


_RESOLVED = "SELECT DISTINCT regexp_replace(lower(entity_type), 's$', '') AS entity_type, entity_id FROM cleanup_log WHERE entity_id IS NOT NULL"


def _states(spark, d):
    done = table(spark, d, "cleanup_log").filter("entity_id is not null").select(F.regexp_replace(F.lower("entity_type"), "s$", "").alias("entity_type"), "entity_id").distinct().withColumn("done", F.lit(True))
    return queue(spark, d).join(done, ["entity_type", "entity_id"], "left").withColumn("status", F.when(F.col("done"), "resolved").otherwise("pending"))


@R.add("dp_queue_stats", f"SELECT q.entity_type, action, CASE WHEN r.entity_id IS NULL THEN 'pending' ELSE 'resolved' END AS status, count(*) AS cnt FROM ({QUEUE}) q LEFT JOIN ({_RESOLVED}) r ON q.entity_type = r.entity_type AND q.entity_id = r.entity_id GROUP BY ALL")
def dp_stats(spark, d):
    """The queue after what the log has dealt with, by kind, action and status."""
    return _states(spark, d).groupBy("entity_type", "action", "status").agg(F.count("*").alias("cnt"))


@R.add("dp_queue_next", f"SELECT q.entity_type, q.entity_id FROM ({QUEUE}) q LEFT JOIN ({_RESOLVED}) r ON q.entity_type = r.entity_type AND q.entity_id = r.entity_id WHERE r.entity_id IS NULL ORDER BY priority DESC, q.entity_type, q.entity_id LIMIT 20")
def dp_next(spark, d):
    return _states(spark, d).filter("status = 'pending'").orderBy(F.desc("priority"), "entity_type", "entity_id").limit(20).select("entity_type", "entity_id")


@R.add("r05_not_investor", f"SELECT investor_id, CASE WHEN k IS NOT NULL THEN 'Not Investor' ELSE investor_type END AS investor_type, CASE WHEN k IS NOT NULL THEN 5 ELSE data_confidence END AS data_confidence FROM (SELECT *, {_KIND.replace('{c}', 'investor_name')} AS k FROM investors)")
def r05(spark, d):
    i = table(spark, d, "investors").withColumn("_kind", S.entity_kind(F.col("investor_name")))
    return i.select("investor_id", F.when(F.col("_kind").isNotNull(), "Not Investor").otherwise(F.col("investor_type")).alias("investor_type"), F.when(F.col("_kind").isNotNull(), 5).otherwise(F.col("data_confidence")).alias("data_confidence"))


@R.add("r06_sparse", "SELECT investor_id FROM investors WHERE (data_confidence IS NULL OR data_confidence < 30) AND coalesce(investor_type, '') <> 'Media' ORDER BY coalesce(data_confidence, 0), investor_id LIMIT 20")
def r06(spark, d):
    i = table(spark, d, "investors").filter((F.col("data_confidence").isNull() | (F.col("data_confidence") < 30)) & (F.coalesce("investor_type", F.lit("")) != "Media"))
    return i.orderBy(F.coalesce("data_confidence", F.lit(0)), "investor_id").limit(20).select("investor_id")


@R.add("r07_marked_scanned", f"SELECT i.investor_id, CASE WHEN n.investor_id IS NULL THEN '{AS_OF}T00:00:00Z' ELSE i.last_enriched END AS last_enriched FROM investors i LEFT JOIN (SELECT DISTINCT investor_id FROM news_mentions WHERE investor_id IS NOT NULL) n ON i.investor_id = n.investor_id")
def r07(spark, d):
    """Investors without news count as scanned; others keep their time until they are enriched."""
    seen = table(spark, d, "news_mentions").filter("investor_id is not null").select("investor_id").distinct().withColumn("seen", F.lit(True))
    return table(spark, d, "investors").select("investor_id", "last_enriched").join(seen, "investor_id", "left").select("investor_id", F.when(F.col("seen").isNull(), f"{AS_OF}T00:00:00Z").otherwise(F.col("last_enriched")).alias("last_enriched"))


@R.add("r08_cloud_batch", "SELECT id FROM startups WHERE Status = 'Active' AND (cloud_relevance IS NULL OR cloud_relevance = '') ORDER BY data_confidence DESC NULLS LAST, id LIMIT 100")
def r08(spark, d):
    s = table(spark, d, "startups").filter((F.col("Status") == "Active") & ~A.filled(F.col("cloud_relevance")))
    return s.orderBy(F.desc_nulls_last("data_confidence"), "id").limit(100).select("id")


@R.add("r10_tiered_batch", "SELECT id FROM startups WHERE description <> '' AND description <> 'Unknown' ORDER BY coalesce(data_confidence, 0), id LIMIT 100")
def r10(spark, d):
    return table(spark, d, "startups").filter("description <> '' and description <> 'Unknown'").orderBy(F.coalesce("data_confidence", F.lit(0)), "id").limit(100).select("id")


@R.add("r11_single_pass_reset", "SELECT id, CASE WHEN tech_proximity > 0 AND Status <> 'Blacklisted' AND (business_model IS NULL OR business_model IN ('', 'Unknown')) THEN NULL ELSE last_updated END AS last_updated FROM startups")
def r11(spark, d):
    once = (F.col("tech_proximity") > 0) & (F.col("Status") != "Blacklisted") & (F.col("business_model").isNull() | F.col("business_model").isin("", "Unknown"))
    return table(spark, d, "startups").select("id", F.when(~F.coalesce(once, F.lit(False)), F.col("last_updated")).alias("last_updated"))


SENTINELS = ("unknown", "none", "null", "")
_MAP = ("investor_type", "website", "location", "focus_areas")


@R.add("r14_field_map", " UNION ALL ".join(f"SELECT investor_id AS entity_id, '{c}' AS field, {c} AS value FROM investors WHERE lower(trim({c})) NOT IN ('unknown', 'none', 'null', '')" for c in _MAP))
def r14(spark, d):
    """A record as one row a field, without stand-ins: what an arbitrated write takes as candidates."""
    return field_map(table(spark, d, "investors"), "investor_id", list(_MAP))


def field_map(records, key: str, fields: list[str]):
    """(entity_id, field, value) of the fields that say something."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))
    return records.select(F.col(key).alias("entity_id"), F.explode(pairs).alias("x")).select("entity_id", "x.*").filter(~F.lower(F.trim("value")).isin(*SENTINELS))


@R.add("r14_fields_written")
def r14_written(spark, d):
    """The field maps of investors written by confidence: what an investor's record says against the log of the more trusted half of the records."""
    i = table(spark, d, "investors").withColumn("conf", F.coalesce("data_confidence", F.lit(0)))
    m = field_map(i, "investor_id", list(_MAP)).join(i.select(F.col("investor_id").alias("entity_id"), F.col("conf").alias("confidence"), F.pmod("investor_id", F.lit(2)).alias("half")), "entity_id").withColumn("seq", F.col("entity_id")).withColumn("entity_id", F.floor(F.col("entity_id") / 2))
    return upsert.arbitrated(m.filter("half = 0").drop("half"), m.filter("half = 1").drop("half"), ["entity_id", "field"])


@R.add("r16_skeletons_added", "SELECT id, company_name FROM startups UNION ALL SELECT NULL, h FROM (SELECT DISTINCT trim(legal_business_name) AS h FROM startups WHERE trim(legal_business_name) <> '') WHERE h NOT IN (SELECT company_name FROM startups WHERE company_name IS NOT NULL)")
def r16(spark, d):
    """The table with a bare record for each registered name that no record has; ids are given on writing."""
    s = table(spark, d, "startups").select("id", "company_name")
    names = table(spark, d, "startups").select(F.trim("legal_business_name").alias("company_name")).filter("company_name <> ''").distinct()
    return s.unionByName(names.join(s.select("company_name"), "company_name", "left_anti"), allowMissingColumns=True)


_FIELDS = {"website": "official website", "city": "headquarters city", "founders": "founders", "description": "what does it do"}
_HOST = "regexp_extract(website, 'https?://(?:www\\.)?([^/]+)', 1)"


@R.add("r18_field_searches", " UNION ALL ".join(f"SELECT id, '{f}' AS field, '\"' || company_name || '\" {q}' || CASE WHEN {_HOST} <> '' THEN ' site:' || {_HOST} ELSE '' END AS query FROM startups WHERE company_name IS NOT NULL AND ({f} IS NULL OR lower(trim({f})) IN ('nan', 'unknown', 'none', ''))" for f, q in _FIELDS.items()))
def r18(spark, d):
    """A search for each field that is missing, tied to the company's site where it is known."""
    host = F.coalesce(F.regexp_extract("website", "https?://(?:www\\.)?([^/]+)", 1), F.lit(""))
    query = lambda q: F.concat(F.lit('"'), F.col("company_name"), F.lit(f'" {q}'), F.when(host != "", F.concat(F.lit(" site:"), host)).otherwise(""))
    wanted = F.filter(F.array(*(F.when(S.is_absent(F.col(f)), F.struct(F.lit(f).alias("field"), query(q).alias("query"))) for f, q in _FIELDS.items())), lambda x: x.isNotNull())
    return table(spark, d, "startups").filter("company_name is not null").select("id", F.explode(wanted).alias("x")).select("id", "x.*")


_SEEDS = ", ".join(f"('{t}', lower('{t}'))" for ts in taxonomy.PAIRS.values() for t in ts)


@R.add("r19_keyword_seeds", f"""WITH have AS (SELECT DISTINCT trim(substr(Category, instr(Category, ' | ') + 3)) AS tag, lower(AI_Use_Case) AS keyword FROM startups WHERE contains(Category, ' | ') AND AI_Use_Case <> ''), seed(tag, keyword) AS (VALUES {_SEEDS})
SELECT tag, keyword, 4.0::DOUBLE AS weight FROM have WHERE tag <> '' UNION ALL SELECT s.tag, s.keyword, 3.0 FROM seed s LEFT JOIN have h ON s.tag = h.tag AND s.keyword = h.keyword WHERE h.tag IS NULL""")
def r19(spark, d):
    """An index of keywords by tag: what is there overrides, and a seed goes in only where the pair is new."""
    have = table(spark, d, "startups").filter(F.col("Category").contains(" | ") & (F.col("AI_Use_Case") != "")).select(F.trim(F.split("Category", " \\| ", 2)[1]).alias("tag"), F.lower("AI_Use_Case").alias("keyword")).filter("tag <> ''").distinct().withColumn("weight", F.lit(4.0))
    seed = taxonomy.taxonomy(spark).select(F.col("valid_tag").alias("tag"), F.lower("valid_tag").alias("keyword"), F.lit(3.0).alias("weight"))
    return upsert.insert_ignore(have, seed, ["tag", "keyword"], F.col("weight"))[0]


@R.add("r13_keyword_stats", "SELECT tag, count(*) AS n FROM (SELECT DISTINCT trim(substr(Category, instr(Category, ' | ') + 3)) AS tag, lower(AI_Use_Case) AS keyword FROM startups WHERE contains(Category, ' | ') AND AI_Use_Case <> '') GROUP BY 1")
def r13(spark, d):
    s = table(spark, d, "startups").filter(F.col("Category").contains(" | ") & (F.col("AI_Use_Case") != ""))
    return s.groupBy(F.trim(F.split("Category", " \\| ", 2)[1]).alias("tag")).agg(F.countDistinct(F.lower("AI_Use_Case")).alias("n"))


#: a tag is doubted below the first, and the best candidate accepted from the second on
DOUBT, ACCEPT = 0.15, 0.45


@R.add("r20_tags_corrected")
def r20(spark, d):
    """The tag of each company after the keyword check: kept, replaced by the best candidate, or left for an extractor."""
    from .flows import _index

    index = checkpointed(_index(spark, d))
    s = table(spark, d, "startups").select("id", "description", taxonomy.tag_of(F.col("Category")).alias("tag")).filter("tag is not null")
    return tag_checked(s, index)


def tag_checked(rows, index):
    """(id, tag, verdict) of rows(id, description, tag)."""
    kept = keywords.scored(rows, index, "description", "tag")
    low = kept.filter((F.col("score") < DOUBT) & (F.col("description") != ""))
    top = keywords.best_tags(low, index, "id", "description", 1).select("id", F.col("tags")[0].alias("new"))
    new = keywords.scored(low.join(top.hint("merge"), "id").select("id", "description", F.col("new").alias("tag")), index, "description", "tag").select("id", F.col("tag").alias("new"), F.col("score").alias("new_score"))
    x = kept.join(new.hint("merge"), "id", "left")
    good = F.col("new_score") >= ACCEPT
    verdict = F.when(F.col("new_score").isNull(), "kept").when(good, "replaced").otherwise("extractor")
    return x.select("id", F.when(good, F.col("new")).otherwise(F.col("tag")).alias("tag"), verdict.alias("verdict"))


@R.add("r23_scan_phases", "SELECT id, CASE WHEN scanned_at >= '2026-05-01' THEN 1 ELSE 2 END AS phase, row_number() OVER (PARTITION BY source_name, scanned_at >= '2026-05-01' ORDER BY CASE WHEN scanned_at >= '2026-05-01' THEN scanned_at END, scanned_at DESC, id) AS seq FROM news_mentions WHERE scanned_at IS NOT NULL AND source_name IS NOT NULL")
def r23(spark, d):
    """Two phases a source: what is recent in order, then the backlog from its end."""
    from pyspark.sql import Window

    new = F.col("scanned_at") >= "2026-05-01"
    n = table(spark, d, "news_mentions").filter("scanned_at is not null and source_name is not null").withColumn("new", new)
    w = Window.partitionBy("source_name", "new").orderBy(F.asc_nulls_last(F.when(F.col("new"), F.col("scanned_at"))), F.desc("scanned_at"), "id")
    return n.select("id", F.when(F.col("new"), 1).otherwise(2).alias("phase"), F.row_number().over(w).alias("seq"))


_TEMPLATES = {"VC": "{n} portfolio companies investments", "Accelerator": "{n} program batch demo day", "Angel": "{n} angel investor deals"}


@R.add("r26_search_texts", "SELECT investor_id, replace(CASE " + " ".join(f"WHEN investor_type = '{k}' THEN '{t}'" for k, t in _TEMPLATES.items()) + " ELSE '{n} investor' END, '{n}', investor_name) AS query FROM investors")
def r26(spark, d):
    t = S.mapped(F.col("investor_type"), _TEMPLATES, F.lit("{n} investor"))
    return table(spark, d, "investors").select("investor_id", F.replace(t, F.lit("{n}"), F.col("investor_name")).alias("query"))


@R.add("t01_scan_state", """WITH q AS (SELECT source_name, coalesce(min(substr(scanned_at, 1, 10)) FILTER (scanned_at < '2025-01-01'), '') AS oldest, count(*) FILTER (scanned_at < '2025-01-01') AS found FROM news_mentions WHERE source_name IS NOT NULL GROUP BY 1)
SELECT r.source_name, coalesce(q.found, 0) AS found, CASE WHEN coalesce(q.found, 0) > 0 THEN q.oldest ELSE '2024-12-02' END AS backfill_pointer FROM (SELECT DISTINCT source_name FROM ref_sources) r LEFT JOIN q ON r.source_name = q.source_name""")
def t01(spark, d):
    """The state of each source's scan after one backfill: the pointer moves to the oldest article found before it, or by 30 days if the page was empty."""
    state = table(spark, d, "ref_sources").select("source_name").distinct()
    return scan_state(state.withColumn("backfill_pointer", F.lit(None).cast("string")), table(spark, d, "news_mentions").select("source_name", F.substring("scanned_at", 1, 10).alias("day")))


def scan_state(state, articles, first: str = "2025-01-01", back: int = 30):
    """(source_name, found, backfill_pointer): state(source_name, backfill_pointer) after a batch of articles(source_name, day). A source without a pointer begins at `first`."""
    s = state.select("source_name", F.coalesce("backfill_pointer", F.lit(first)).alias("pointer"))
    n = articles.filter("source_name is not null and day is not null").join(s.hint("merge"), "source_name").filter("day < pointer").groupBy("source_name").agg(F.count("*").alias("found"), F.min("day").alias("oldest"))
    x = s.join(n, "source_name", "left")
    return x.select("source_name", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("oldest", F.date_sub(F.col("pointer").cast("date"), back).cast("string")).alias("backfill_pointer"))


_RULES = [
    ("founders", "founders missing", "founders IS NULL", lambda: F.col("founders").isNull()),
    ("city", "city missing", "city IS NULL", lambda: F.col("city").isNull()),
    ("description", "description missing", "description IS NULL", lambda: F.col("description").isNull()),
    ("business_model", "business_model not in list", "business_model NOT IN ('Product', 'Consultancy', 'Hybrid', 'Unknown')", lambda: ~F.col("business_model").isin("Product", "Consultancy", "Hybrid", "Unknown")),
]


@R.add("s59_schema_issues", "SELECT id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {sql} THEN '{issue}' END" for _, issue, sql, _ in _RULES) + "], lambda x: x IS NOT NULL), '; ') AS issues FROM startups")
def s59(spark, d):
    """What a record breaks of its contract: required fields and closed lists."""
    return table(spark, d, "startups").select("id", F.array_join(F.filter(F.array(*(F.when(cond(), issue) for _, issue, _, cond in _RULES)), lambda x: x.isNotNull()), "; ").alias("issues"))


_Y = "nullif(regexp_extract({c}, '((?:19|20)[0-9]{{2}})', 1), '')"


@R.add("sc08_news_years", "SELECT id, CAST(coalesce(" + ", ".join(_Y.format(c=c) for c in ("published_date", "source_url", "headline || ' ' || coalesce(summary, '')")) + ") AS INTEGER) AS year FROM news_mentions")
def sc08(spark, d):
    """The year of an article: of its date, else of its address, else of its text."""
    text = F.concat(F.col("headline"), F.lit(" "), F.coalesce("summary", F.lit("")))
    return table(spark, d, "news_mentions").select("id", F.coalesce(S.first_year(F.col("published_date")), S.first_year(F.col("source_url")), S.first_year(text)).alias("year"))


@R.add("j19_source_articles", """WITH h AS (SELECT id AS startup_id, lower(substr(regexp_extract(website, 'https?://(?:www\\.)?([^/]+)', 1), 1, 20)) AS hint FROM startups),
n AS (SELECT n.startup_id, n.id, h.hint <> '' AND contains(lower(n.source_url), h.hint) AS hit FROM news_mentions n JOIN h ON n.startup_id = h.startup_id)
SELECT startup_id, coalesce(min(id) FILTER (hit), min(id)) AS news_id FROM n GROUP BY 1""")
def j19(spark, d):
    """The article of a company whose address holds the hint (its host, 20 letters at most), else its first; hot companies are reduced map-side."""
    h = table(spark, d, "startups").select(F.col("id").alias("startup_id"), F.lower(F.substring(F.regexp_extract("website", "https?://(?:www\\.)?([^/]+)", 1), 1, 20)).alias("hint"))
    n = looked_up(table(spark, d, "news_mentions").filter("startup_id is not null").select("startup_id", "id", "source_url"), "id", h, ["startup_id"])
    hit = (F.col("hint") != "") & F.contains(F.lower("source_url"), F.col("hint"))
    return n.groupBy("startup_id").agg(F.min(F.when(hit, F.col("id"))).alias("a"), F.min("id").alias("b")).select("startup_id", F.coalesce("a", "b").alias("news_id"))


@R.add("j13_report_lookup")
def j13(spark, d):
    """For each investor as a report subject the first company with a token similarity of 80 or more, or with its host in the address."""
    i = table(spark, d, "investors").select("investor_id", S.asciified(S.small(F.trim("investor_name"))).alias("name"), F.regexp_extract(F.lower("website"), "https?://(?:www\\.)?([^/]+)", 1).alias("host"))
    s = table(spark, d, "startups").select("id", S.asciified(S.small(F.trim("company_name"))).alias("label"), F.lower("website").alias("website"))
    return report_lookup(i, s).withColumnRenamed("key", "investor_id")


def report_lookup(subjects, companies):
    """(key, id): the smallest id that fits; subjects(key, name, host), companies(id, label, website). A host is found wherever it stands in an address (`held`)."""
    key = subjects.columns[0]
    names = subjects.filter("name <> ''").select(F.col(key).alias("key"), fuzzy.sorted_tokens(F.col("name")).alias("l"))
    labels = companies.filter("label <> ''").select("id", fuzzy.sorted_tokens(F.col("label")).alias("r"))
    near = fuzzy.candidates(names.select("l").distinct(), labels.select("r").distinct(), 80).withColumn("s", fuzzy.token_sort_ratio("l", "r")).filter("s >= 80")
    by_name = names.join(near.select("l", "r").hint("merge"), "l").join(labels.hint("merge"), "r").select("key", "id")
    hosts = subjects.filter("host <> ''").select(F.col(key).alias("key"), "host")
    return by_name.unionByName(hosts.join(held(hosts, companies).hint("merge"), "host").select("key", "id")).groupBy("key").agg(F.min("id").alias("id"))


#: letters that are compared at each place of an address; where a host has more, the whole address is looked at as well
PLACE = 64


def held(hosts, companies):
    """(host, id): the smallest id of companies(id, website) whose address holds the host, wherever it stands and however long or short it is."""
    sites = companies.filter("website <> ''").select("id", "website")
    hosts = hosts.select("host").distinct()
    about = hosts.agg(F.collect_set(F.least(F.length("host"), F.lit(4))).alias("sizes"), F.max(F.length("host")).alias("longest")).first()
    # an address from each of its letters on: the wanted host is one's beginning
    begin = sites.select("id", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("website")), lambda i: F.col("website").substr(i, F.lit(PLACE))))).alias("at"))
    begin = reduce(lambda a, b: a.unionByName(b), (begin.select("id", "at", F.substring("at", 1, n).alias("g")) for n in sorted(about.sizes) or [4]))
    found = hosts.select("host", F.substring("host", 1, 4).alias("g")).join(begin.hint("merge"), "g").filter(F.startswith("at", F.substring("host", 1, PLACE))).select("host", "id")
    if (about.longest or 0) > PLACE:
        long = found.filter(F.length("host") > PLACE).distinct().join(sites.hint("merge"), "id").filter(F.contains("website", "host")).select("host", "id")
        found = found.filter(F.length("host") <= PLACE).unionByName(long)
    return found.groupBy("host").agg(F.min("id").alias("id"))


def named(texts, key: str, text: str):
    """(key, pos, name): every run of two or three capitalised words of a text, in the order in which they begin, each once."""
    runs = lambda n: F.regexp_extract_all(text, F.lit("(\\p{Lu}[\\p{L}\\p{N}]+" + " \\p{Lu}[\\p{L}\\p{N}]+" * n + ")"), F.lit(1))
    names = F.array_distinct(F.concat(runs(2), runs(1)))
    x = texts.select(F.col(key).alias("key"), F.col(text).alias("_text"), F.explode(names).alias("name"))
    return x.select("key", F.instr("_text", F.col("name")).alias("pos"), "name")


def rematched(texts, key: str, text: str, companies):
    """(key, startup_id): the company of companies(id, label) that a text names first; names are linked exactly, by tokens and by part."""
    n = checkpointed(named(texts, key, text))
    links = fuzzy.matched(n.select("name"), companies).select("name", F.col("id").alias("startup_id"))
    return looked_up(n, "key", links, ["name"]).select("key", "pos", "name", "startup_id")


def _texts_of(news):
    return news.withColumn("text", F.concat_ws(". ", "headline", "summary"))


def _known(spark, d):
    return table(spark, d, "startups").filter(F.coalesce("Status", F.lit("")) != "Blacklisted").select("id", F.col("company_name").alias("label"))


def first_named(found):
    return found.groupBy("key").agg(F.min_by("startup_id", F.struct("pos", "name")).alias("startup_id"))


@R.add("dq_orphan_mentions")
def dq_mentions(spark, d):
    """News without a company, linked with the first that its headline or summary names."""
    n = _texts_of(table(spark, d, "news_mentions").filter("startup_id is null and summary <> ''"))
    return first_named(rematched(n, "id", "text", _known(spark, d))).withColumnRenamed("key", "id")


@R.add("dq_article_links")
def dq_articles(spark, d):
    """Further companies that an article names: pairs of article and company, without its own and those that its address has already."""
    n = table(spark, d, "news_mentions").filter("summary <> ''")
    found = checkpointed(rematched(_texts_of(n), "id", "text", _known(spark, d)).select(F.col("key").alias("id"), "startup_id").distinct())
    several = found.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id")
    own = table(spark, d, "news_mentions").filter("startup_id is not null").select("source_url", "startup_id").distinct()
    x = found.join(several.hint("merge"), "id", "left_semi").join(n.select("id", "source_url").hint("merge"), "id")
    return x.join(own.hint("merge"), ["source_url", "startup_id"], "left_anti").select("id", "startup_id")


@R.add("dq_orphan_investments")
def dq_investments(spark, d):
    """Deals of companies that do not exist: the first company that the deal's news names, else -1."""
    s = table(spark, d, "startups").select(F.col("id").alias("startup_id"))
    v = table(spark, d, "investments").filter("startup_id is not null").select("id", "startup_id", "news_mention_id").join(s.hint("merge"), "startup_id", "left_anti")
    return orphan_deals(v, table(spark, d, "news_mentions"), _known(spark, d))


def orphan_deals(deals, news, companies):
    n = _texts_of(news).join(deals.select(F.col("news_mention_id").alias("id")).distinct().hint("merge"), "id", "left_semi")
    new = first_named(rematched(n, "id", "text", companies)).select(F.col("key").alias("news_mention_id"), F.col("startup_id").alias("_new"))
    return deals.join(new.hint("merge"), "news_mention_id", "left").select("id", F.coalesce("_new", F.lit(-1)).cast("bigint").alias("startup_id"))


@R.add("sk09_cascade", """WITH gone AS (SELECT id FROM startups WHERE Status = 'Stale')
SELECT 'news_mentions' AS tab, id FROM news_mentions WHERE startup_id IS NULL OR startup_id NOT IN (SELECT id FROM gone) UNION ALL SELECT 'investments', id FROM investments WHERE startup_id IS NULL OR startup_id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'documents', doc_id FROM documents WHERE startup_id IS NULL OR startup_id NOT IN (SELECT id FROM gone)""")
def sk09(spark, d):
    """What is left of three child tables after the stale companies and their rows are deleted."""
    gone = table(spark, d, "startups").filter("Status = 'Stale'").select(F.col("id").alias("startup_id"))
    left = lambda t, k: upsert.without(table(spark, d, t).select(F.col(k).alias("id"), "startup_id"), gone, ["startup_id"]).select(F.lit(t).alias("tab"), "id")
    return reduce(lambda a, b: a.unionByName(b), [left("news_mentions", "id"), left("investments", "id"), left("documents", "doc_id")])


@R.add("sk15_audit_appended", f"""SELECT id, entity_type, entity_id, action FROM cleanup_log UNION ALL SELECT NULL, 'startup', id, 'url_cleared' FROM startups WHERE regexp_matches(lower(website), '{"|".join(("tinyurl", "goo[.]gl", "cutt[.]ly", "shorturl"))}')""")
def sk15(spark, d):
    """The log with a row for each change of a cleanup task."""
    spam = table(spark, d, "startups").filter(F.lower("website").rlike("tinyurl|goo[.]gl|cutt[.]ly|shorturl"))
    rows = spam.select(F.lit(None).cast("bigint").alias("id"), F.lit("startup").alias("entity_type"), F.col("id").alias("entity_id"), F.lit("url_cleared").alias("action"))
    return table(spark, d, "cleanup_log").select("id", "entity_type", "entity_id", "action").unionByName(rows)


@R.add("s47_failures_and_status", "SELECT id, f AS failures, CASE WHEN f >= 3 THEN 'Stale' ELSE Status END AS status FROM (SELECT id, Status, CASE WHEN (website IS NULL OR website = 'Unknown') AND (description IS NULL OR description = '') THEN coalesce(vitality_failures, 0) + 1 ELSE 0 END AS f FROM startups)")
def s47(spark, d):
    """Both signs of a dead company together add a failure, anything else ends the run; three make it Stale."""
    bad = (F.col("website").isNull() | (F.col("website") == "Unknown")) & ~A.filled(F.col("description"))
    n = F.when(bad, F.coalesce("vitality_failures", F.lit(0)) + 1).otherwise(0)
    return table(spark, d, "startups").select("id", n.alias("failures"), F.when(n >= 3, "Stale").otherwise(F.col("Status")).alias("status"))


_TEN = ("website", "description", "city", "founders", "Category", "AI_Use_Case", "Total_Funding_Formatted", "Investors", "Tech_Mentioned", "business_model")
_ABSENT = {c: ("Unknown", "") + (("nan",) if c == "website" else ()) + (("None",) if c == "AI_Use_Case" else ()) for c in _TEN} | {"business_model": ("Unknown",)}


@R.add("f17_ten_fields", "SELECT id, " + " + ".join(f"CASE WHEN {c} IS NULL OR {c} IN ({', '.join(map(repr, v))}) THEN 1 ELSE 0 END" for c, v in _ABSENT.items()) + " AS n_missing FROM startups WHERE Status = 'Active'")
def f17(spark, d):
    """How many of ten fields are missing, each with its own stand-ins, in one pass."""
    n = sum((F.when(F.col(c).isNull() | F.col(c).isin(*v), 1).otherwise(0) for c, v in _ABSENT.items()), F.lit(0))
    return table(spark, d, "startups").filter("Status = 'Active'").select("id", n.alias("n_missing"))


# Words for places of the home country.
HOME = ["turkey", "türkiye", "istanbul", "ankara", "izmir", "bursa", "adana", "antalya", "besiktas", "beşiktaş", "cankaya", "çankaya", "eskisehir", "eskişehir", "kocaeli"]


@R.add("f06_home_places", "SELECT investor_id FROM investors WHERE " + " OR ".join(f"contains(lower(coalesce(location, '')), '{w}')" for w in HOME))
def f06(spark, d):
    return table(spark, d, "investors").filter(S.has_any(F.lower(F.coalesce("location", F.lit(""))), HOME)).select("investor_id")


@R.add("s16_cleaned", """SELECT id, CASE WHEN website IS NULL OR website IN ('', 'Unknown') THEN website WHEN starts_with(website, 'http://') OR starts_with(website, 'https://') THEN website WHEN contains(website, '.') THEN 'https://' || website ELSE 'Unknown' END AS website,
CASE WHEN founded_year BETWEEN 1900 AND 2026 THEN founded_year END AS founded_year, substr(company_name, 1, 200) AS company_name, substr(founders, 1, 200) AS founders, CASE WHEN data_confidence IS NOT NULL THEN greatest(0, least(100, data_confidence)) END AS data_confidence,
array_to_string(list_filter([CASE WHEN website <> '' AND website <> 'Unknown' AND NOT contains(website, '.') AND NOT starts_with(website, 'http://') AND NOT starts_with(website, 'https://') THEN 'website invalid' END, CASE WHEN founded_year < 1900 OR founded_year > 2026 THEN 'founded_year out of range' END,
CASE WHEN length(founders) > 200 THEN 'founders truncated' END, CASE WHEN length(company_name) > 200 THEN 'company_name truncated' END, CASE WHEN founders <> 'Unknown' AND len(list_filter(string_split(founders, ','), lambda x: trim(x) <> '')) > 5 THEN 'founders too many' END], lambda x: x IS NOT NULL), '; ') AS warnings FROM startups""")
def s16(spark, d):
    """A record after validation, and what was wrong with it."""
    w, y, f, n, c = (F.col(x) for x in ("website", "founded_year", "founders", "company_name", "data_confidence"))
    given = (w != "") & (w != "Unknown")
    addressed = w.startswith("http://") | w.startswith("https://")
    many = F.size(F.filter(F.split(f, ","), lambda x: F.trim(x) != "")) > 5
    rules = [(given & ~w.contains(".") & ~addressed, "website invalid"), (~y.between(1900, 2026), "founded_year out of range"), (F.length(f) > 200, "founders truncated"), (F.length(n) > 200, "company_name truncated"), ((f != "Unknown") & many, "founders too many")]
    return table(spark, d, "startups").select(
        "id", F.when(~given | w.isNull() | addressed, w).when(w.contains("."), F.concat(F.lit("https://"), w)).otherwise("Unknown").alias("website"), F.when(y.between(1900, 2026), y).alias("founded_year"),
        F.substring(n, 1, 200).alias("company_name"), F.substring(f, 1, 200).alias("founders"), F.when(c.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(100), c))).alias("data_confidence"),
        F.array_join(F.filter(F.array(*(F.when(t, k) for t, k in rules)), lambda x: x.isNotNull()), "; ").alias("warnings"),
    )


@R.add("dc_deals_patched", """WITH v AS (SELECT id, startup_id, investor_id, lower(trim(round_type)) AS r, amount_usd, nullif(trim(investment_date), '') AS d FROM investments WHERE startup_id IS NOT NULL AND investor_id IS NOT NULL AND trim(round_type) <> '' AND upper(trim(round_type)) NOT IN ('NA', 'UNKNOWN', 'NONE')),
g AS (SELECT startup_id, investor_id, r, coalesce(substr(d, 1, 4), '') AS y, min(id) AS id, min(amount_usd) FILTER (amount_usd > 0) AS usd, min(d) AS d FROM v GROUP BY ALL)
SELECT g.id, CASE WHEN coalesce(v.amount_usd, 0) = 0 THEN coalesce(g.usd, v.amount_usd) ELSE v.amount_usd END AS amount_usd, coalesce(v.d, g.d) AS investment_date FROM g JOIN v ON g.id = v.id""")
def dc(spark, d):
    """One deal for each startup, investor, round and year: the first record, with what it lacks taken from the others; rounds that say nothing never match."""
    date = F.nullif(F.trim("investment_date"), F.lit(""))
    v = table(spark, d, "investments").filter("startup_id is not null and investor_id is not null").filter((F.trim("round_type") != "") & ~F.upper(F.trim("round_type")).isin("NA", "UNKNOWN", "NONE"))
    v = v.select("id", "startup_id", "investor_id", F.lower(F.trim("round_type")).alias("r"), "amount_usd", date.alias("d")).withColumn("y", F.coalesce(F.substring("d", 1, 4), F.lit("")))
    g = v.groupBy("startup_id", "investor_id", "r", "y").agg(F.min_by(F.struct("id", "amount_usd", "d"), "id").alias("f"), F.min(F.when(F.col("amount_usd") > 0, F.col("amount_usd"))).alias("usd"), F.min("d").alias("day"))
    mine = F.col("f.amount_usd")
    return g.select("f.id", F.when(F.coalesce(mine, F.lit(0.0)) == 0, F.coalesce("usd", mine)).otherwise(mine).alias("amount_usd"), F.coalesce("f.d", "day").alias("investment_date"))


@R.add("ds_company_360", """WITH n AS (SELECT startup_id, count(*) AS n_news, max(scanned_at) AS newest, arg_max(headline, (scanned_at, id)) AS headline, count(*) FILTER (sentiment = 'positive') AS n_positive FROM news_mentions WHERE startup_id IS NOT NULL GROUP BY 1),
v AS (SELECT v.startup_id, count(*) AS n_deals, round(sum(amount_usd), 2) AS usd, count(DISTINCT v.investor_id) AS n_investors, min(i.investor_name) AS first_investor FROM investments v LEFT JOIN investors i ON v.investor_id = i.investor_id GROUP BY 1),
c AS (SELECT entity_id, count(*) AS n_changes, arg_max(action, id) AS last_change FROM cleanup_log WHERE lower(entity_type) LIKE 'startup%' GROUP BY 1), t AS (SELECT startup_id, count(*) AS n_documents FROM documents GROUP BY 1)
SELECT s.id, s.company_name, n_news, newest, headline, n_positive, n_deals, usd, n_investors, first_investor, n_changes, last_change, n_documents FROM startups s LEFT JOIN n ON n.startup_id = s.id LEFT JOIN v ON v.startup_id = s.id LEFT JOIN c ON c.entity_id = s.id LEFT JOIN t ON t.startup_id = s.id""")
def ds(spark, d):
    """All that is known of each company: its news, deals with their investors, changes and documents; each side is reduced before it meets the companies."""
    n = table(spark, d, "news_mentions").filter("startup_id is not null").groupBy(F.col("startup_id").alias("id")).agg(F.count("*").alias("n_news"), F.max("scanned_at").alias("newest"), F.max_by("headline", F.struct("scanned_at", F.col("id"))).alias("headline"), F.count(F.when(F.col("sentiment") == "positive", 1)).alias("n_positive"))
    i = table(spark, d, "investors").select("investor_id", "investor_name")
    v = table(spark, d, "investments").select("startup_id", "investor_id", "amount_usd").join(i, "investor_id", "left")
    v = v.groupBy(F.col("startup_id").alias("id")).agg(F.count("*").alias("n_deals"), F.round(F.sum("amount_usd"), 2).alias("usd"), F.countDistinct("investor_id").alias("n_investors"), F.min("investor_name").alias("first_investor"))
    c = table(spark, d, "cleanup_log").filter(F.lower("entity_type").startswith("startup")).groupBy(F.col("entity_id")).agg(F.count("*").alias("n_changes"), F.max_by("action", F.col("id")).alias("last_change")).withColumnRenamed("entity_id", "id")
    t = table(spark, d, "documents").groupBy(F.col("startup_id").alias("id")).agg(F.count("*").alias("n_documents"))
    return reduce(lambda a, b: a.join(b, "id", "left"), [n, v, c, t], table(spark, d, "startups").select("id", "company_name"))


@R.add("j14_similar_profiles")
def j14(spark, d):
    """The ten companies most like each of those whose id is divisible by 20, from a similarity of 60 on."""
    text = lambda *cs: F.lower(squeeze(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in cs))))
    s = table(spark, d, "startups").select("id", S.small(F.trim("company_name")).alias("name"), text("AI_Use_Case", "description", "Category", "business_model").alias("asks"), text("AI_Use_Case", "description").alias("answers"))
    return similar(s.filter("id % 20 = 0").select("id", "name", F.col("asks").alias("text")), s.select("id", "name", F.col("answers").alias("text")))


def similar(queries, rows, least: float = 60, k: int = 10, block: int = 32768, part: int = 16384):
    """(id, other, score): the k rows most like each query, from `least` on, without rows of its own name; queries and rows(id, name, text).

    At so low a similarity no index helps, and the letters that two texts share tell little: every two texts are compared, many at once (`nearest`).
    Records with the same name and text are compared once, and of their ids the k smallest count. Queries go in blocks of about
    `block`, rows in parts of about `part`; each block meets each part in a task, which keeps the best k.
    """
    from pyspark.sql import Window

    def named(df):
        x = df.filter("length(text) >= 10").select("id", "name", fuzzy.sorted_tokens(F.col("text")).alias("text"))
        return x.withColumn("h", F.unhex(F.md5(F.concat_ws("\u0001", F.col("name").isNull().cast("string"), "name", "text"))))

    q = checkpointed(named(queries))
    asked = checkpointed(q.groupBy("h").agg(F.first("name").alias("name"), F.first("text").alias("text")))
    first = Window.partitionBy("h").orderBy("id")
    r = named(rows).withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    r = checkpointed(r.groupBy("h").agg(F.first("name").alias("name"), F.first("text").alias("text"), F.array_sort(F.collect_list("id")).alias("ids")))
    n, size = max(1, -(-asked.count() // block)), r.count()
    m = max(1, -(-size // part), min(-(-12 // n), size // 500))
    spread = lambda df, own, other, c: df.withColumn(own[0], F.pmod(F.xxhash64("text"), F.lit(own[1])).cast("int")).withColumn(other[0], F.explode(F.sequence(F.lit(0), F.lit(other[1] - 1)))).repartition(c, "block", "part")
    tasks = min(4 * n * m, 2000)  # more than there are blocks and parts, so that few meet in one
    a, b = spread(asked, ("block", n), ("part", m), tasks), spread(r.drop("h"), ("part", m), ("block", n), tasks)
    run = lambda x, y: nearest(k, least, x, y)
    found = a.groupBy("block", "part").cogroup(b.groupBy("block", "part")).applyInPandas(run, "h binary, other bigint, score double")
    w = Window.partitionBy("h").orderBy(F.desc("score"), "other")
    found = checkpointed(found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("h", "other", F.round("score", 3).alias("score")))
    return looked_up(q.select("id", "h"), "id", found, ["h"]).select("id", "other", "score")


__all__ = ["R", "fold"]
