"""Queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_missing
from ..plans.registry import Registry
from ..session import checkpointed, looked_up, table
from . import abuse, canonical, golden, leakage, names, tokens

R = Registry()

# Other ways to write the entries of ref_rounds.
ROUND_FORMS = {
    "Pre-Seed": ["preseed", "pre seed round", "preseed rnd", "on tohum", "on tohum yatirimi", "tohum oncesi tur"],
    "Seed": ["seed round", "seed funding", "seed rnd", "seed investment", "tohum turu", "tohum yatirimi", "cekirdek tohum", "cekirdek"],
    "Angel": ["angel round", "angel investment", "business angel", "melek yatirim", "melek yatirimi", "melek turu"],
    "Bridge": ["bridge round", "bridge financing", "bridge loan", "kopru turu", "kopru yatirimi"],
    "Convertible Note": ["conv note", "convertible", "convertible loan note", "convertible loan", "convertible debt"],
    "Grant": ["grants", "grant funding", "non dilutive grant", "hibe destegi"],
    "Debt Financing": ["debt", "venture debt", "loan debt", "loan", "debt round", "borc"],
    "Equity Crowdfunding": ["equity crowd funding", "crowdfunding", "ecf crowdfunding", "ecf", "kitle fonlamasi", "paya dayali kitle fonlama"],
    "Private Equity": ["private eq", "pe", "ozel sermaye yatirimi"],
    "IPO": ["i p o", "initial public offering", "halka arz"],
    "Secondary": ["secondary sale", "secondary market", "ikincil", "secondary round"],
}
# Words that any round may have.
GENERIC = "round|rnd|tur|turu|funding|financing|investment|yatirim|yatirimi"
SERIES_FORMS = ["series {x} round", "ser {x}", "{x} turu", "{x} serisi", "{x} round", "series{x}", "seri{x}", "{x} tur", "seri {x} turu"]
PRE_SERIES_FORMS = ["pre ser {x}", "pre seri {x}", "pre {x}", "{x} oncesi tur", "pre series {x} round", "{x} serisi oncesi", "pre series{x}"]


def _city_pieces(c):
    """The value as a whole and each of its words; short words only where they are all there is."""
    p = canonical.plain(c)
    words = F.filter(F.split(p, " "), lambda w: F.length(w) > 4)
    return F.concat(F.array(p), F.array(F.regexp_replace(p, " ", "")), words)


def _round_pieces(c):
    """The value without what stands in brackets, and with it."""
    bare = F.regexp_replace(c, "\\([^)]*\\)", " ")
    return F.array(_without_generic(canonical.plain(bare)), _without_generic(canonical.plain(c)))


def _without_generic(c):
    return F.trim(F.regexp_replace(F.regexp_replace(c, f"\\b({GENERIC})\\b", " "), " +", " "))


def _city_entries(ref: DataFrame) -> DataFrame:
    forms = F.array("city_name", "short_code", F.col("plate_no").cast("string"), "former_name")
    return ref.select(F.col("city_id").alias("ref_id"), F.explode(forms).alias("form")).filter("form is not null")


def _round_entries(ref: DataFrame) -> DataFrame:
    others = F.create_map(*(x for k, v in ROUND_FORMS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    letter = F.lower(F.regexp_extract("round_type", "Series ([A-Z])$", 1))
    series = lambda forms: F.array(*(F.replace(F.lit(f), F.lit("{x}"), letter) for f in forms))
    none = F.array().cast("array<string>")
    forms = F.concat(F.array("round_type", "local_name"), F.coalesce(F.try_element_at(others, F.col("round_type")), none), F.when(letter == "", none).when(F.col("round_type").startswith("Pre"), series(PRE_SERIES_FORMS)).otherwise(series(SERIES_FORMS)))
    return ref.select(F.col("round_id").alias("ref_id"), F.explode(F.transform(forms, lambda f: _without_generic(canonical.plain(f)))).alias("form")).filter("form <> ''")


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    """(field, row_id, value, ref_id, score) of every value that is neither missing nor written as its entry."""
    cities, rounds = table(spark, d, "ref_cities"), table(spark, d, "ref_rounds")
    rows = table(spark, d, "startups").select(F.lit("city").alias("field"), F.col("id").alias("row_id"), F.col("city").alias("value"))
    rows = rows.unionByName(table(spark, d, "investments").select(F.lit("round_type").alias("field"), F.col("id").alias("row_id"), F.col("round_type").alias("value")))
    written = cities.select(F.lit("city").alias("field"), F.col("city_name").alias("value")).unionByName(rounds.select(F.lit("round_type").alias("field"), F.col("round_type").alias("value")))
    rows = rows.filter(~is_missing(F.col("value"))).join(F.broadcast(written), ["field", "value"], "left_anti")  # reference lists of fixed size
    entries = _city_entries(cities).withColumn("field", F.lit("city")).unionByName(_round_entries(rounds).withColumn("field", F.lit("round_type")))
    pieces = F.when(F.col("field") == "city", _city_pieces(F.col("value"))).otherwise(_round_pieces(F.col("value")))
    m = checkpointed(canonical.assigned(rows, entries, pieces))
    # one row per distinct value; frequent values are hot keys, so the lookup is broadcast if it is small
    return rows.join(F.broadcast(m) if canonical.small_enough(m, 50_000) else m, ["field", "value"])


@R.add("p2_found")
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d).select("field", "row_id", "ref_id")


@R.add("p2_unmatched")
def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The values that fit no entry, with their frequency."""
    return _mapped(spark, d).filter("ref_id = 0").groupBy("field", "value").agg(F.count("*").alias("n_rows"))


def _entities(spark: SparkSession, d: str, tabs: tuple[str, ...] = ("startups", "investors")) -> DataFrame:
    null = F.lit(None).cast("string")
    out = None
    if "startups" in tabs:
        out = table(spark, d, "startups").select(F.lit("startups").alias("tab"), "id", F.col("company_name").alias("name"), F.col("legal_business_name").alias("legal"), "website", F.col("crunchbase_url").alias("crunchbase"), F.col("first_seen").alias("seen"))
    if "investors" in tabs:
        v = table(spark, d, "investors").select(F.lit("investors").alias("tab"), F.col("investor_id").alias("id"), F.col("investor_name").alias("name"), null.alias("legal"), "website", null.alias("crunchbase"), null.alias("seen"))
        out = v if out is None else out.unionByName(v)
    for c in ("legal", "website", "crunchbase", "seen"):
        out = out.withColumn(c, F.when(~is_missing(F.col(c)), F.col(c)))
    return names.linked(out)


#: rows of one entity from which its pairs are made in several tasks
PAIRED = 2_000


@R.add("p3_found")
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Every pair, as the definition asks: an entity of n rows gives n(n-1)/2, made in n / PAIRED tasks at once."""
    e = checkpointed(_entities(spark, d))
    many = e.groupBy("tab", "entity").agg(F.count("*").alias("n")).filter("n > 1").withColumn("salts", F.ceil(F.col("n") / PAIRED).cast("int")).select("tab", "entity", "salts")
    e = checkpointed(looked_up(e, "id", many, ["tab", "entity"]))
    a = e.select("tab", "entity", F.col("id").alias("id_a"), F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"))
    b = e.select("tab", "entity", F.col("id").alias("id_b"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return a.join(b.hint("merge"), ["tab", "entity", "salt"]).filter("id_a < id_b").select("tab", "id_a", "id_b")


@R.add("p3_entities")
def p3_entities(spark: SparkSession, d: str) -> DataFrame:
    """The entity of each row (its smallest profile's id) and how many rows share it."""
    e = checkpointed(_entities(spark, d))
    return looked_up(e, "id", e.groupBy("tab", "entity").agg(F.count("*").alias("n_rows")), ["tab", "entity"])


def _companies(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The columns of startups with group_id, the smallest id of the company's records; only companies with two or more."""
    e = checkpointed(_entities(spark, d, ("startups",)))
    groups = e.groupBy("entity").agg(F.min("id").alias("group_id"), F.count("*").alias("n")).filter("n > 1").select("entity", "group_id")
    return table(spark, d, "startups").select("id", *columns).join(looked_up(e, "id", groups, ["entity"]).select("id", "group_id").hint("merge"), "id")


@R.add("p1_found")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    rows = golden.with_instant(_companies(spark, d, "data_confidence", "last_updated"), "last_updated", "at")
    order = [golden.trust(F.col("data_confidence")).desc_nulls_last(), F.col("at").desc_nulls_last(), F.col("id").asc()]
    return golden.kept(rows, "group_id", order, "id").select("group_id", F.col("id").alias("kept_id"))


@R.add("p1_golden")
def p1_golden(spark: SparkSession, d: str) -> DataFrame:
    """One built record per company, each field from the most trusted, then most complete, then latest record that fills it."""
    fields = ["company_name", "legal_business_name", "website", "crunchbase_url", "description", "city", "founders", "founded_year", "Investors", "Tech_Mentioned", "business_model", "Category", "first_seen"]
    rows = golden.with_instant(_companies(spark, d, *fields, "data_confidence", "last_updated"), "last_updated", "at")
    second = F.unix_timestamp(F.try_to_timestamp(F.substring("at", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))).cast("decimal(20,9)") + F.substring("at", 20, 10).cast("decimal(20,9)")
    order = F.struct(-F.coalesce(golden.trust(F.col("data_confidence")), F.lit(-1)), -golden.completeness(fields), F.coalesce(-second, F.lit(1 << 40).cast("decimal(22,9)")), F.col("id"))
    return golden.merged(rows, "group_id", fields, order)


@R.add("p8_ids")
def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encoded(table(spark, d, "documents").select("doc_id", "text"))


# the same words and runs, compared one by one
P9 = """
WITH w AS (
  SELECT 0 AS side, doc_id AS id, regexp_extract_all(lower(strip_accents(replace(replace(text, 'ı', 'i'), 'İ', 'i'))), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT 1, item_id, regexp_extract_all(lower(strip_accents(replace(replace(text, 'ı', 'i'), 'İ', 'i'))), '[\\p{L}\\p{N}]+') FROM eval_items WHERE text IS NOT NULL),
g AS (SELECT side, id, unnest(list_transform(range(1, len(w) - 10), lambda i: hash(array_to_string(list_slice(w, i, i + 11), ' ')))) AS h FROM w WHERE len(w) >= 12)
SELECT DISTINCT a.id AS doc_id, b.id AS item_id FROM g a JOIN g b ON a.h = b.h WHERE a.side = 0 AND b.side = 1
"""


@R.add("p9_found", P9)
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return leakage.leaks(docs, table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


P9_ITEMS = P9.replace("SELECT DISTINCT a.id AS doc_id, b.id AS item_id FROM g a JOIN g b ON a.h = b.h WHERE a.side = 0 AND b.side = 1", "SELECT item_id, count(*) AS n_docs, CAST(max(n) AS INTEGER) AS most_runs FROM (SELECT a.id AS doc_id, b.id AS item_id, count(DISTINCT a.h) AS n FROM g a JOIN g b ON a.h = b.h WHERE a.side = 0 AND b.side = 1 GROUP BY 1, 2) GROUP BY 1")


@R.add("p9_items", P9_ITEMS)
def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Per item: how many documents give it away, how many of them by a run at most, and the longest share."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return leakage.leaks(docs, table(spark, d, "eval_items")).groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("n_runs").alias("most_runs"))


@R.add("p10_found")
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return abuse.scored(table(spark, d, "documents")).filter(F.col("score") >= abuse.THRESHOLD).select("doc_id")


@R.add("p10_rates")
def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    """Per source: documents, those reported, and their share."""
    docs = table(spark, d, "documents")
    bad = abuse.scored(docs).filter(F.col("score") >= abuse.THRESHOLD).select("doc_id", F.lit(1).alias("bad"))
    rows = docs.select("doc_id", "source").join(bad, "doc_id", "left")
    return rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.count("bad").alias("n_reported")).withColumn("share", F.round(F.col("n_reported") / F.col("n_docs"), 6))
