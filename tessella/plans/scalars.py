"""The row transforms over the domain tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import taxonomy, urls
from ..session import table
from .registry import Registry

R = Registry()
AS_OF = "2026-05-31"


def _of(query: str, t: str, key: str, sql: str | None, /, **columns) -> None:
    """A query of a key and computed columns of one table."""

    def run(spark, d):
        return table(spark, d, t).select(key, *(c().alias(k) for k, c in columns.items()))

    R.add(query, None if sql is None else f"SELECT {key}, {sql} FROM {t}")(run)


def _low(c: str) -> str:
    return f"lower(translate({c}, 'IİŞĞÜÖÇ', 'ıişğüöç'))"


def _any(c: str, words: list[str]) -> str:
    return "coalesce(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ", false)"


_of("s01_parse_category", "startups", "id", "CASE WHEN contains(Category, ' | ') THEN trim(split_part(Category, ' | ', 1)) END AS sector, CASE WHEN contains(Category, ' | ') THEN trim(substr(Category, instr(Category, ' | ') + 3)) END AS tag", sector=lambda: taxonomy.sector_of(F.col("Category")), tag=lambda: taxonomy.tag_of(F.col("Category")))
_of("s02_build_category", "startups", "id", "CASE WHEN trim(business_model) <> '' AND trim(Status) <> '' THEN trim(business_model) || ' | ' || trim(Status) END AS category", category=lambda: taxonomy.built(F.col("business_model"), F.col("Status")))
_of("s03_absent", "startups", "id", "coalesce(lower(trim(city)) IN ('nan', 'unknown', 'none', ''), true) AS absent", absent=lambda: S.is_absent(F.col("city")))
_of("s04_small_letters", "startups", "id", f"{_low('company_name')} AS name", name=lambda: S.small(F.col("company_name")))
_of("s05_ascii", "startups", "id", f"translate({_low('city')}, 'ışğüöç', 'isguoc') AS city", city=lambda: S.asciified(S.small(F.col("city"))))


def _nested(c: str, steps: list[str]) -> str:
    """The same as lateral subqueries would give, each step naming its input once or more by a struct field."""
    out = c
    for step in steps:
        out = f"list_transform([{out}], lambda x: {step})[1]"
    return out


_SUFFIX = [f"CASE WHEN ends_with(lower(x), '{s}') THEN trim(substr(x, 1, length(x) - {len(s)})) ELSE x END" for s in S.SUFFIXES]
_of("s07_without_suffix", "startups", "id", f"{_nested('company_name', _SUFFIX)} AS name", name=lambda: S.without_suffix(F.col("company_name")))
_of("s09_kind", "investors", "investor_id", "CASE " + " ".join(f"WHEN {_any('lower(concat_ws(chr(32), investor_name, focus_areas))', w)} THEN '{k}'" for k, w in S.KINDS.items()) + " END AS kind", kind=lambda: S.kind_of(F.col("investor_name"), F.col("focus_areas")))
_of("s17_currency", "investments", "id", "CASE WHEN contains(upper(amount), 'USD') OR contains(amount, '$') THEN 'USD' WHEN contains(upper(amount), 'EUR') OR contains(amount, '€') THEN 'EUR' WHEN contains(upper(amount), 'TRY') OR contains(upper(amount), ' TL') OR contains(amount, '₺') THEN 'TRY' ELSE 'Unknown' END AS code", code=lambda: S.currency_in(F.col("amount")))
_SIGNS = {"$": "USD", "€": "EUR", "₺": "TRY", "£": "GBP", "¥": "JPY", "₹": "INR"}
_CODES = sorted(["USD", "EUR", "TRY", "GBP", "CHF", "JPY", "CNY", "SAR", "AED", "INR"])
_of("s18_currency_by_sign", "investments", "id", "CASE " + " ".join(f"WHEN contains(amount, '{s}') THEN '{c}'" for s, c in _SIGNS.items()) + " " + " ".join(f"WHEN contains(upper(amount), '{c}') THEN '{c}'" for c in _CODES) + " END AS code", code=lambda: S.currency_by_sign(F.col("amount")))
_of("s19_funding", "startups", "id", None, value=lambda: S.funding_value(F.col("Total_Funding_Formatted")), text=lambda: S.funding_text(F.col("Total_Funding_Formatted")))
_U = "upper(amount)"
_BARE = "CASE " + " ".join(f"WHEN {' OR '.join(f'contains({_U}, {chr(39)}{w}{chr(39)})' for w in ws)} THEN replace(replace({_U}, '{ws[0]}', ''), '{ws[1]}', '')" for k, ws in S.AMOUNT_CODES.items() if k != "USD") + f" ELSE replace(replace({_U}, 'USD', ''), '$', '') END"
_DIGITS = "CASE WHEN contains(x, '.') AND contains(x, ',') THEN CASE WHEN instr(x, '.') < instr(x, ',') THEN replace(replace(x, '.', ''), ',', '.') ELSE replace(x, ',', '') END WHEN contains(x, ',') THEN CASE WHEN regexp_matches(x, '^[0-9]*,[0-9]{2}$') THEN replace(x, ',', '.') ELSE replace(x, ',', '') END{only} ELSE x END"
_NEW = _DIGITS.replace("{only}", " WHEN regexp_matches(x, '^[0-9]{1,3}([.][0-9]{3})+$') THEN replace(x, '.', '')")
_VALUE = lambda digits: "CASE WHEN regexp_matches(" + _nested("regexp_replace(bare, '[^0-9.,]', '', 'g')", [digits]) + ", '^[0-9]+[.]?[0-9]*$') THEN TRY_CAST(" + _nested("regexp_replace(bare, '[^0-9.,]', '', 'g')", [digits]) + " AS DOUBLE) END"
_UNIT = "WHEN contains(bare, 'M') THEN 1e6 WHEN contains(bare, 'K') OR contains(bare, 'BIN') OR contains(bare, 'BİN') THEN 1e3 WHEN contains(bare, 'B') THEN 1e9 ELSE 1.0 END"
R.add("s20_amount", f"SELECT id, {_VALUE(_NEW)} * CASE WHEN contains(bare, 'MILYAR') OR contains(bare, 'BILLION') THEN 1e9 {_UNIT} AS value, {_VALUE(_DIGITS.replace('{only}', ''))} * CASE {_UNIT} AS legacy FROM (SELECT id, {_BARE} AS bare FROM investments)")(
    lambda spark, d: table(spark, d, "investments").select("id", S.amount_of(F.col("amount")).alias("value"), S.amount_of(F.col("amount"), True).alias("legacy"))
)
_of("s20_amount_code", "investments", "id", "CASE WHEN amount IS NULL OR lower(trim(amount)) IN ('unknown', 'none', '') THEN NULL " + " ".join(f"WHEN {' OR '.join(f'contains({_U}, {chr(39)}{w}{chr(39)})' for w in ws)} THEN '{k}'" for k, ws in S.AMOUNT_CODES.items() if k != "USD") + " ELSE 'USD' END AS code", code=lambda: S.amount_code(F.col("amount")))
_of("s23_turkish_money", "investments", "id", "CASE WHEN amount_usd > 0 THEN translate(format('{:,.2f}', round(amount_usd, 2)), ',.', '.,') || ' USD' END AS text", text=lambda: S.turkish_money(F.round("amount_usd", 2), F.lit("USD")))
_ROUND = " ".join(f"WHEN lower(replace(trim(round_type), 'İ', 'i' || chr(775))) = '{k}' THEN '{v}'" for k, v in S.ROUNDS.items())
_of("s24_round_type", "investments", "id", f"CASE WHEN round_type IS NULL OR trim(round_type) = '' THEN 'NA' {_ROUND} ELSE trim(round_type) END AS round", round=lambda: S.round_type(F.col("round_type")))
_PLACE = [f"CASE WHEN contains(x, '{a}') AND NOT contains(x, '{b}') THEN replace(x, '{a}', '{b}') ELSE x END" for a, b in S.INSIDE] + [f"CASE WHEN ends_with(x, '{a}') THEN substr(x, 1, length(x) - {len(a)}) || '{b}' ELSE x END" for a, b in S.ENDINGS]
_of("s26_place", "investors", "investor_id", "CASE " + " ".join(f"WHEN trim(location) = '{k}' THEN " + ("NULL" if v is None else f"'{v}'") for k, v in S.PLACES.items()) + f" ELSE {_nested('trim(location)', _PLACE)} END AS place", place=lambda: S.place(F.col("location")))
_of("s27_origin", "investors", "investor_id", f"CASE WHEN location IS NULL OR lower(trim(location)) IN ('', 'unknown', 'n/a', 'none', 'global', 'europe') THEN 'Unknown' WHEN {_any('lower(location)', S.DOMESTIC)} THEN 'Domestic' ELSE 'International' END AS origin", origin=lambda: S.origin(F.col("location")))
_TERMS = "list_filter(list_transform(string_split(Tech_Mentioned, ','), lambda x: trim(x)), lambda x: x <> '')"
_of("s29_terms", "startups", "id", f"CASE WHEN Tech_Mentioned IS NULL OR lower(trim(Tech_Mentioned)) IN ('none', 'unknown', 'nan', '') THEN Tech_Mentioned ELSE array_to_string(list_sort(list_filter({_TERMS}, lambda x, i: list_position(list_transform({_TERMS}, lambda y: lower(y)), lower(x)) = i)), ', ') END AS terms", terms=lambda: S.terms(F.col("Tech_Mentioned")))
_F = "trim(founders)"
_NAMES = f"array_to_string(list_transform(list_filter(CAST({_F} AS JSON)::VARCHAR[], lambda x: x IS NOT NULL AND x <> ''), lambda x: trim(x)), ', ')"
_of("s30_founders", "startups", "id", f"CASE WHEN founders IS NULL OR lower({_F}) IN ('none', 'unknown', '') THEN founders WHEN {_F} LIKE '[%]' AND json_valid({_F}) THEN CASE WHEN {_NAMES} = '' THEN 'Unknown' ELSE {_NAMES} END ELSE founders END AS founders", founders=lambda: S.founders(F.col("founders")))
def _faults(c: str, rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {test.replace('{c}', c)} THEN '{name}'" for test, name in rules) + " END AS fault"


def _ascii_case(p: str) -> str:
    """A pattern whose ASCII letters match in either case and all others only as written, as Java reads (?i)."""
    out, i, inside = [], 0, False
    while i < len(p):
        ch = p[i]
        if ch == "\\":
            out.append(p[i : i + 2])
            i += 2
            continue
        inside = ch == "[" or inside and ch != "]"
        out.append((f"{ch.lower()}{ch.upper()}" if inside else f"[{ch.lower()}{ch.upper()}]") if ch.isascii() and ch.isalpha() else ch)
        i += 1
    return "".join(out)


_SCRAPED, _POLITICAL = _ascii_case(S.SCRAPED.removeprefix("(?i)")), _ascii_case(S.POLITICAL.removeprefix("(?i)"))
_LISTED = lambda names: ", ".join(f"'{n}'" for n in names)
_BLANKS = "length(trim({c})) - length(replace(trim({c}), ' ', '')) > 8"
_COMPANY = [("{c} IS NULL OR length(trim({c})) < 3", "short"), ("length(trim({c})) > 100", "long"), ("lower(trim({c})) IN (" + _LISTED(S.NO_COMPANY) + ")", "listed"), ("regexp_matches(trim({c}), '" + "|".join(S.JUNK) + "')", "junk"), ("regexp_matches(trim({c}), '" + _SCRAPED + "')", "scraped"), (_BLANKS, "sentence")]
_INVESTOR = [
    ("{c} IS NULL OR length(trim({c})) < 3", "short"), ("length(trim({c})) > 80", "long"), ("lower(trim({c})) IN (" + _LISTED(S.NO_INVESTOR) + ")", "listed"), ("contains(trim({c}), '@')", "email"), ("starts_with(trim({c}), 'http') OR contains(lower(trim({c})), '.com')", "url"),
    ("regexp_matches(trim({c}), '" + _POLITICAL + "')", "political"), ("regexp_matches(trim({c}), '" + _SCRAPED + "')", "scraped"), ("regexp_matches(trim({c}), '^[\\[{{]')".replace("{{", "{"), "bracket"), (_BLANKS, "sentence"), ("regexp_matches(trim({c}), '^[0-9]')", "digit"),
]
_of("s31_company_fault", "startups", "id", _faults("company_name", _COMPANY), fault=lambda: S.company_fault(F.col("company_name")))
_of("s32_investor_fault", "investors", "investor_id", _faults("investor_name", _INVESTOR), fault=lambda: S.investor_fault(F.col("investor_name")))
_of("s33_own_site", "startups", "id", "coalesce(lower(trim(website)) IN ('', 'unknown') OR NOT (" + " OR ".join(f"contains(lower(website), '{n}')" for n in urls.NEWS) + "), true) AS own", own=lambda: urls.is_own_site(F.col("website")))
_of("s34_host", "startups", "id", "regexp_extract(lower(trim(website)), '^(?:[a-z][a-z0-9+.-]*://)?([^/:?#]*)', 1) AS host", host=lambda: urls.host(F.col("website")))
_of("s35_bare_host", "startups", "id", "regexp_extract(website, 'https?://(?:www\\.)?([^/]+)', 1) AS host", host=lambda: urls.bare_host(F.col("website")))
_T = "lower(headline || ' ' || coalesce(summary, ''))"
_of("s36_news_score", "news_mentions", "id", f"CASE WHEN {_any(_T, S.NEWS_TECH)} THEN 2 ELSE 0 END + CASE WHEN {_any(_T, S.NEWS_ACTION)} THEN 1 ELSE 0 END - CASE WHEN {_any(_T, S.NEWS_NEGATIVE)} THEN 3 ELSE 0 END AS score", score=lambda: S.news_score(F.concat(F.col("headline"), F.lit(" "), F.coalesce("summary", F.lit("")))))
_of("s37_first_year", "investments", "id", "TRY_CAST(nullif(regexp_extract(investment_date, '((?:19|20)[0-9]{2})', 1), '') AS INTEGER) AS year", year=lambda: S.first_year(F.col("investment_date")))
_D = "lower(concat_ws(' ', description, Tech_Mentioned, business_model))"
_of("s38_cloud_signal", "startups", "id", f"CASE WHEN {_any(_D, S.NO_CLOUD)} AND NOT {_any(_D, S.CLOUD)} THEN 'negative' WHEN {_any(_D, S.CLOUD)} AND NOT {_any(_D, S.NO_CLOUD)} THEN 'positive' ELSE 'ambiguous' END AS signal", signal=lambda: S.cloud_signal(F.col("description"), F.col("Tech_Mentioned"), F.col("business_model")))
_of("s46_absent_fields", "startups", "id", "list_filter([" + ", ".join(f"CASE WHEN {c} IS NULL OR lower(trim({c})) IN ('nan', 'unknown', 'none', '') THEN '{c}' END" for c in ("website", "description", "city", "founders")) + "], lambda x: x IS NOT NULL) AS absent", absent=lambda: S.absent_fields(["website", "description", "city", "founders"]))
_W = [("website", 20), ("investor_type", 15), ("location", 15), ("focus_areas", 10)]
_of("s48_completeness", "investors", "investor_id", "CAST(least(100, " + " + ".join(f"CASE WHEN {c} IS NULL OR {c} IN ('', 'Unknown') THEN 0 ELSE {w} END" for c, w in _W) + ") AS INTEGER) AS score", score=lambda: S.weighted([(F.col(c), w) for c, w in _W]))
_of("s49_business_model", "startups", "id", "CASE WHEN lower(business_model) IN ('saas', 'platform', 'software') THEN 'Product' WHEN business_model IN ('Product', 'Consultancy', 'Hybrid', 'Unknown') THEN business_model ELSE 'Unknown' END AS model", model=lambda: S.business_model(F.col("business_model")))
_of("s50_keys", "news_mentions", "id", "md5(source_url) AS url_key, md5(concat_ws('__', source_url, startup_id)) AS pair_key", url_key=lambda: F.md5("source_url"), pair_key=lambda: F.md5(F.concat_ws("__", "source_url", F.col("startup_id").cast("string"))))
_of("s52_token_estimate", "documents", "doc_id", "coalesce(CAST(floor(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) * 1.3) AS BIGINT), 0) AS tokens", tokens=lambda: S.token_estimate(F.col("text")))
_of("s53_slug", "ref_sources", "source_name", "trim(regexp_replace(regexp_replace(lower(source_name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')) AS slug", slug=lambda: urls.slugged(F.col("source_name")))
_of("s54_turkish_letters", "documents", "doc_id", "coalesce(regexp_matches(text, '[ğüşıöç]'), false) AS turkish", turkish=lambda: F.coalesce(F.col("text").rlike("[ğüşıöç]"), F.lit(False)))
_of("s56_event_type", "news_mentions", "id", "CASE " + " ".join(f"WHEN event_category = '{k}' THEN '{v}'" for k, v in S.EVENT_TYPES.items()) + " ELSE coalesce(event_type, 'general') END AS type, CASE WHEN ai_relevance < 40 THEN NULL ELSE ai_snippet END AS snippet, CASE WHEN ai_relevance < 20 THEN 0 ELSE 1 END AS relevant", type=lambda: S.mapped(F.col("event_category"), S.EVENT_TYPES, F.coalesce("event_type", F.lit("general"))), snippet=lambda: F.when(~F.coalesce(F.col("ai_relevance") < 40, F.lit(False)), F.col("ai_snippet")), relevant=lambda: F.when(F.col("ai_relevance") < 20, 0).otherwise(1))
_of("s57_date_chain", "news_mentions", "id", "coalesce(nullif(regexp_extract(published_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}'), ''), substr(scanned_at, 1, 10)) AS day", day=lambda: F.coalesce(F.nullif(F.regexp_extract("published_date", "^[0-9]{4}-[0-9]{2}-[0-9]{2}", 0), F.lit("")), F.substring("scanned_at", 1, 10)))
_SITE, _CTX = "coalesce(description, '')", "coalesce(ai_explanation, '')"
_of("s14_confidence", "startups", "id", f"CAST(greatest(0, least(100, CASE WHEN {_any(f'lower({_SITE})', S.PARKED)} THEN 0 ELSE least(35, length({_SITE}) // 10) END + least(30, length({_CTX}) // 10) + CASE WHEN Total_Funding_Formatted IS NOT NULL THEN 20 ELSE 0 END + least(coalesce(vitality_failures, 0) * 5, 15) - CASE WHEN coalesce(tech_proximity, 0) * 10 > 90 THEN least((coalesce(tech_proximity, 0) * 10 - 90) // 7, 20) ELSE 0 END)) AS INTEGER) AS score", score=lambda: S.confidence(F.coalesce("description", F.lit("")), F.coalesce("ai_explanation", F.lit("")), F.col("Total_Funding_Formatted").isNotNull(), F.coalesce("vitality_failures", F.lit(0)), F.coalesce("tech_proximity", F.lit(0)) * 10))
_CORE, _MORE = ("description", "website", "Category"), ("founders", "city", "AI_Use_Case", "Tech_Mentioned")
_PTS = " + ".join(f"CASE WHEN {c} IS NULL OR lower({c}) IN ('unknown', 'none', '') THEN 0 ELSE {p} END" for c, p in zip(_CORE, (15, 10, 10), strict=True)) + " + " + " + ".join(f"CASE WHEN {c} IS NULL OR {c} IN ('Unknown', 'None', '') THEN 0 ELSE 5 END" for c in _MORE)
_of("s15_first_confidence", "startups", "id", f"CAST(least(100, CASE WHEN " + " AND ".join(f"coalesce({c}, '') <> ''" for c in _CORE) + f" THEN greatest({_PTS}, 35) ELSE {_PTS} END) AS INTEGER) AS score", score=lambda: S.first_confidence([F.col(c) for c in _CORE], [F.col(c) for c in _MORE]))
_AGE = f"date_diff('day', CAST(processed_at AS TIMESTAMP)::DATE, DATE '{AS_OF}')"
_of("s44_age_tier", "startups", "id", f"CASE WHEN {_AGE} >= 30 OR processed_at IS NULL THEN 3 WHEN {_AGE} >= 14 THEN 2 ELSE 1 END AS tier", tier=lambda: _tier())


def _tier():
    age = F.datediff(F.lit(AS_OF).cast("date"), F.substring("processed_at", 1, 10).cast("date"))
    return F.when(age.isNull() | (age >= 30), 3).when(age >= 14, 2).otherwise(1)


_N, _X = _low("company_name"), _low("text")
_BARE_OF = lambda c: f"regexp_replace({c}, '[^a-z0-9]', '', 'g')"
_ASC = lambda c: f"translate({c}, 'ışğüöç', 'isguoc')"
_FIRST = f"regexp_extract({_N}, '([\\p{{L}}\\p{{N}}_]+)', 1)"


@R.add("s06_relevant_names", f"""SELECT id, coalesce(company_name <> '' AND text <> '' AND (contains({_X}, {_N}) OR (length({_FIRST}) >= 3 AND contains({_X}, {_FIRST})) OR (length({_BARE_OF(_N)}) >= 3 AND contains({_BARE_OF(_X)}, {_BARE_OF(_N)})) OR contains({_ASC(_X)}, {_ASC(_N)})), false) AS relevant
FROM (SELECT n.id, concat_ws(' ', n.headline, n.summary) AS text, s.company_name FROM news_mentions n JOIN startups s ON n.startup_id = s.id)""")
def s06(spark, d):
    """News of a startup whose headline or summary names it."""
    n = table(spark, d, "news_mentions").filter("startup_id is not null").select("id", "startup_id", F.concat_ws(" ", "headline", "summary").alias("text"))
    s = table(spark, d, "startups").select(F.col("id").alias("startup_id"), "company_name")
    return n.join(s, "startup_id").select("id", S.is_relevant(F.col("company_name"), F.col("text")).alias("relevant"))


_P = ", ".join(f"('{s}', '{t}')" for s, ts in taxonomy.PAIRS.items() for t in ts)


@R.add("s10_repaired_pairs", f"""WITH t(vs, vt) AS (VALUES {_P}), p AS (SELECT id, business_model AS sector, CASE WHEN contains(Category, ' | ') THEN trim(substr(Category, instr(Category, ' | ') + 3)) END AS tag FROM startups),
f AS (SELECT vs, min(vt) AS vt FROM t GROUP BY 1)
SELECT p.id, CASE WHEN a.vt IS NOT NULL THEN a.vs WHEN f.vt IS NOT NULL THEN p.sector ELSE 'General' END AS new_sector, CASE WHEN a.vt IS NOT NULL THEN p.tag WHEN f.vt IS NOT NULL THEN f.vt ELSE 'Uncategorized' END AS new_tag
FROM p LEFT JOIN t a ON p.tag = a.vt LEFT JOIN f ON p.sector = f.vs""")
def s10(spark, d):
    p = table(spark, d, "startups").select("id", F.col("business_model").alias("sector"), taxonomy.tag_of(F.col("Category")).alias("tag"))
    return taxonomy.repaired(p, "sector", "tag").select("id", "new_sector", "new_tag")


FX_DAYS = "(SELECT c.code, DATE '2021-01-01' + CAST(i * 90 AS INTEGER) AS day, c.base + (i % 7) * 0.01 AS rate FROM range(25) t(i), (VALUES ('EUR', 1.05), ('GBP', 1.25), ('TRY', 0.03)) c(code, base))"


def _rates(spark):
    """(code, since, rate): a list of a few currencies and days, in dollars a unit."""
    codes = spark.createDataFrame([("EUR", 1.05), ("GBP", 1.25), ("TRY", 0.03)], "code string, base double")
    return spark.range(25).crossJoin(F.broadcast(codes)).select("code", F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") * 90).cast("int")).alias("since"), (F.col("base") + (F.col("id") % 7) * 0.01).alias("rate"))


@R.add("s21_as_of_rates", f"""WITH v AS (SELECT v.id, s.code, s.value, CASE WHEN regexp_matches(investment_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN coalesce(TRY_CAST(substr(investment_date, 1, 10) AS DATE), DATE '{AS_OF}') ELSE DATE '{AS_OF}' END AS day
FROM investments v JOIN (SELECT c.id, c.code, a.legacy AS value FROM ({R.sql['s20_amount_code']}) c JOIN ({R.sql['s20_amount']}) a ON a.id = c.id) s ON s.id = v.id),
r AS (SELECT v.id, coalesce(arg_max(f.rate, f.day) FILTER (f.day <= v.day), arg_min(f.rate, f.day)) AS rate FROM v JOIN {FX_DAYS} f ON f.code = v.code GROUP BY 1)
SELECT v.id, v.code, v.value, CASE WHEN v.code = 'USD' THEN v.value ELSE round(v.value * r.rate, 2) END AS usd FROM v LEFT JOIN r ON r.id = v.id WHERE v.code IS NOT NULL AND v.value IS NOT NULL""")
def s21(spark, d):
    """Every stated amount in dollars at the last rate known on the day of the deal, the first where none was known yet; deals without a readable day count as of today."""
    day = F.when(F.col("investment_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.try_to_date(F.substring("investment_date", 1, 10), "yyyy-MM-dd"))
    v = table(spark, d, "investments").select("id", S.amount_code(F.col("amount")).alias("code"), S.amount_of(F.col("amount"), True).alias("value"), F.coalesce(day, F.lit(AS_OF).cast("date")).alias("day")).filter("code is not null and value is not null")
    x = asof(v, _rates(spark), ["code"], "day", "since", "rate")
    return x.select("id", "code", "value", F.when(F.col("code") == "USD", F.col("value")).otherwise(F.round(F.col("value") * F.col("rate"), 2)).alias("usd"))


def asof(left, right, on, at, since, value):
    """left with the value of the last right row of its key whose `since` is not after `at`; before the first, the first; null for a key without rows.

    A key's right rows become one sorted array, and each left row looks its place up in it by the number of days not after
    its own, so no row is compared with another's. The right side, a calendar of rates, has one row a key and is broadcast if its checked size allows.
    """
    from ..session import small_enough

    spans = right.groupBy(*on).agg(F.array_sort(F.collect_list(F.struct(F.col(since).alias("s"), F.col(value).alias("v")))).alias("_spans"))
    x = left.join(F.broadcast(spans) if small_enough(spans, 10_000) else spans.hint("merge"), on, "left")
    n = F.size(F.filter("_spans", lambda r: r["s"] <= F.col(at)))
    return x.withColumn(value, F.get("_spans", F.greatest(n - 1, F.lit(0)))["v"]).drop("_spans")
