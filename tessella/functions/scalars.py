"""Row transforms as native Column expressions: text, money, places, guards and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Turkish capitals and their small letters; small letters and their ASCII forms.
CAPITALS, SMALL = "IİŞĞÜÖÇ", "ıişğüöç"
LETTERS, ASCII = "ışğüöç", "isguoc"
# Endings of company names, in the order in which they are tried.
SUFFIXES = [" a.ş.", " a.s.", " ltd.", " ltd.şti.", " ltd.sti.", " teknoloji", " yazılım", " yazilim", " holding", " bilişim", " bilisim", " danışmanlık", " danismanlik"]
# Words by which an organisation is known as media, technology park, accelerator or government, tried in this order.
KINDS = {
    "Media": ["webrazzi", "haber", "dergi", "blog", "magazine", "news", "media", "gazete", "yayın"],
    "Teknopark": ["teknokent", "teknopark", "technopark", "cyberpark", "teknoloji geliştirme bölgesi"],
    "Accelerator": ["accelerator", "incubator", "hızlandırıcı", "kuluçka"],
    "Government": ["bakanlık", "ministry", "tübitak", "kosgeb", "tubitak"],
}
# Signs of a page that only holds a domain.
PARKED = ["coming soon", "under construction", "domain for sale", "parked domain", "this domain is for sale", "buy this domain", "website coming soon", "site yapım aşamasında", "yakında", "satılık domain"]
# Canonical round types.
ROUNDS = {
    "seri a": "Series A", "seri b": "Series B", "seri c": "Series C", "seed": "Seed", "pre-seed": "Pre-Seed", "pre-series a": "Pre-Series A", "series a": "Series A", "series b": "Series B", "series c": "Series C", "series d": "Series D",
    "series e": "Series E", "angel": "Angel", "investment": "NA", "seed and series a": "Seed", "unknown": "NA",
}
# Markers of a domestic place.
DOMESTIC = ["turkey", "türkiye", "istanbul", "i̇stanbul", "ankara", "izmir", "i̇zmir", "antalya", "bursa", "konya", "adana", "gaziantep", "mersin", "kayseri", "eskişehir", "eskisehir", "trabzon", "samsun", "denizli", "malatya", "diyarbakır", "erzurum", "kocaeli", "sakarya", "tekirdağ", "gebze", "bolu", "düzce", "muğla", "aydın", "manisa", "çanakkale", "edirne"]
# Places and their canonical forms; country endings; spellings inside longer texts.
PLACES = {
    "Istanbul": "İstanbul", "Istanbul, Turkey": "İstanbul, Turkey", "Istanbul, Türkiye": "İstanbul, Turkey", "Izmir": "İzmir", "Izmir, Turkey": "İzmir, Turkey", "USA": "United States", "US": "United States", "UK": "United Kingdom", "Türkiye": "Turkey",
    "New York": "New York, United States", "New York, NY": "New York, United States", "New York City": "New York, United States", "London": "London, United Kingdom", "Berlin": "Berlin, Germany", "Amsterdam": "Amsterdam, Netherlands",
    "Silicon Valley": "San Francisco, United States", "San Francisco, CA": "San Francisco, United States", "Unknown": None, "N/A": None, "": None,
}
ENDINGS = [(", USA", ", United States"), (", US", ", United States"), (", UK", ", United Kingdom"), (", Türkiye", ", Turkey")]
INSIDE = [("Istanbul", "İstanbul"), ("Izmir", "İzmir")]
# Names and shapes of names that are none.
NO_COMPANY = ["unknown", "n/a", "none", "", "company", "startup", "various", "the company", "unnamed", "test", "null", "undefined"]
NO_INVESTOR = ["unknown", "n/a", "none", "", "investor", "investors", "various", "the investor", "unnamed", "test", "null", "undefined", "undisclosed", "undisclosed investors", "angel investor", "angel investors", "various investors"]
SCRAPED = "(?i)haberleri|haber|haberi|sayfası|sayfasi|için|değerlendirme|kurucusu|yatırım|şirket|ları$|leri$|teknoloji haberleri|başkan[ıi]|cumhurbaşkan[ıi]"
JUNK = ["^https?://", "@", "^\\[", "^\\d", "\\.\\w{2,4}$", "\\s{3,}", "[<>{}|\\\\]"]
POLITICAL = "(?i)cumhurbaşkan[ıi]|başbakan|bakan[ıi]|milletvekili|president\\s+of|prime\\s+minister|minister\\s+of|mayor\\s+of|governor\\s+of|senator|congressman|fransa|almanya|ingiltere"
# Words by which news is judged; each kind counts once.
NEWS_TECH = ["yapay zeka", "yapayzeka", "makine öğrenimi", "derin öğrenme", "üretken yapay zeka", "gen ai", "llm", "robotik", "otonom", "bilgisayarlı görü", "nlp", "computer vision", "deep learning"]
NEWS_ACTION = ["yatırım", "yatirim", "funding", "raised", "round", "seed", "series", "milyon", "milyar", "investment", "partnership", "ortaklık", "satın alma", "acquisition", "hibe", "grant", "support", "program", "accelerator", "incubator", "hızlandırıcı", "kuluçka", "demo day", "launch", "launched", "açıklad", "announcement", "announced", "etkinlik"]
NEWS_NEGATIVE = ["hr", "insan kaynakları", "iş ilanı", "kariyer", "personel"]
# Words for and against the cloud.
CLOUD = ["cloud", "aws", "azure", "gcp", "google cloud", "amazon web services", "saas", "paas", "iaas", "serverless", "lambda", "ec2", "s3", "kubernetes", "k8s", "docker", "containerized", "microservices", "cloud-native", "cloud-based", "multi-tenant", "elastic scaling", "hosted solution", "managed service", "web-based platform", "api-first", "restful api", "browser-based", "firebase", "heroku", "vercel", "netlify", "cloudflare", "openshift", "terraform", "ansible", "devops", "ci/cd", "bulut", "bulut bilişim", "bulut tabanlı", "bulut hizmeti", "bulut altyapısı", "servis olarak yazılım"]
NO_CLOUD = ["on-premise", "on-premises", "on-prem", "self-hosted", "private cloud", "private deployment", "air-gapped", "local deployment", "local data", "local processing", "edge computing", "edge-only", "offline-first", "data sovereignty", "data residency", "no cloud dependency", "runs locally", "embedded system", "firmware", "yerel sunucu", "yerinde kurulum", "özel bulut", "yerel veri", "gömülü sistem"]
# Signs by which a cloud label is corrected, and the labels.
WEB_SIGNS = ["api", "web", "dashboard", "platform", "saas", "online"]
HARDWARE_TAGS = ["robotics", "unmanned systems", "automotive", "adv. manufacturing"]
CLOUD_PROOF = ["cloud", "aws", "azure", "gcp", "saas", "web platform", "bulut"]
PRIVATE_SIGNS = ["on-premise", "on-prem", "self-hosted", "private cloud", "edge-only", "air-gapped", "no cloud", "yerinde kurulum", "özel bulut"]
NATIVE_TAGS = ["ai infrastructure", "developer tools"]
ADJACENT_TAGS = ["software development", "data & analytics", "fintech", "saas", "e-commerce", "marketing", "hr & recruitment", "edtech"]
CLOUD_LABELS = ["Cloud-Native", "Cloud-Enabled", "Cloud-Adjacent", "Non-Cloud"]
# Words that show work with artificial intelligence, and how central it is.
AI_WORDS = [" ai ", "artificial intelligence", "machine learning", " ml ", "deep learning", "nlp", "computer vision", "neural network", "llm", "generative ai"]
AI_CENTRAL = ["core", "driven"]
# Names and words that are no organisation, and words that tell its kind; the first kind that fits counts.
NO_ENTITY = ["unknown", "none", "n/a", "", "startup", "company", "the company"]
ENTITY_JUNK = ["companies", "investments", "portfolio", "stores", "restaurants", "channels", "stations", "dealerships", "acquired", "months"]
ENTITY_KINDS = {
    "Bank": ["bank", "bankası", "banka"],
    "University": ["university", "üniversite", "üniversitesi"],
    "Ministry": ["ministry", "bakanlık", "bakanlığı"],
    "Municipality": ["municipality", "belediye", "belediyesi"],
    "Research Lab": ["research lab", "araştırma merkezi", "research center", "research institute"],
    "Chamber": ["chamber", "odası", "oda"],
    "Association": ["association", "birliği", "birlik"],
    "Foundation": ["foundation", "vakfı", "vakıf"],
    "NGO": ["ngo", "non-profit", "derneği", "dernek"],
}
# Event categories and their types.
EVENT_TYPES = {"funding": "funding", "product": "product_launch", "partnership": "partnership", "corporate": "acquisition", "talent": "hiring", "ecosystem": "award", "expansion": "expansion", "technology": "product_launch"}
SPAN = 500_000_000


def let(c: Column, then) -> Column:
    """then(c) with c computed once, however often it is used."""
    return F.transform(F.array(c), then)[0]


def folded(c: Column, pairs: list[tuple[str, str]], step) -> Column:
    """The text after step(text, a, b) for each pair in order, as a fold over a literal array."""
    steps = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs))
    return F.aggregate(steps, c, lambda x, p: step(x, p["a"], p["b"]))


def mapped(c: Column, pairs: dict, other: Column | None = None) -> Column:
    m = F.try_element_at(F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)), c)
    return F.coalesce(m, other) if other is not None else m


def has_any(c: Column, words: list[str]) -> Column:
    """Any of the words stands somewhere in the text, letter for letter."""
    return F.coalesce(c.rlike("|".join(_literal(w) for w in words)), F.lit(False))


def _literal(w: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\/-" else ch for ch in w)


def small(c: Column) -> Column:
    return F.lower(F.translate(c, CAPITALS, SMALL))


def asciified(c: Column) -> Column:
    return F.translate(c, LETTERS, ASCII)


def is_absent(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c)).isin("nan", "unknown", "none", "")


def is_relevant(name: Column, text: Column) -> Column:
    """The name stands in the text: as it is, by its first word of three letters, by its letters and digits alone, or in ASCII."""
    n, t = small(name), small(text)
    first = F.regexp_extract(n, "([\\p{L}\\p{N}_]+)", 1)
    bare = lambda c: F.regexp_replace(c, "[^a-z0-9]", "")
    hit = t.contains(n) | ((F.length(first) >= 3) & t.contains(first)) | ((F.length(bare(n)) >= 3) & bare(t).contains(bare(n))) | asciified(t).contains(asciified(n))
    return F.coalesce((name != "") & (text != "") & hit, F.lit(False))


def without_suffix(c: Column) -> Column:
    """Company endings cut off, each at most once, in the order of the list."""
    cut = lambda x, s, _: F.when(F.endswith(F.lower(x), s), F.trim(x.substr(F.lit(1), F.length(x) - F.length(s)))).otherwise(x)
    return folded(c, [(s, "") for s in SUFFIXES], cut)


def kind_of(name: Column, text: Column) -> Column:
    both = F.lower(F.concat_ws(" ", name, text))
    out = F.lit(None).cast("string")
    for kind, words in reversed(KINDS.items()):
        out = F.when(has_any(both, words), kind).otherwise(out)
    return out


def confidence(site: Column, context: Column, funded: Column, passes: Column, age: Column) -> Column:
    """0-100: a point per ten characters of site (to 35, none if parked) and context (to 30), 20 for funding, 5 a pass (to 15), less a point a week after 90 days (to 20)."""
    zero = F.lit(0)
    of = lambda c, most: F.least(F.lit(most), F.floor(F.coalesce(F.length(c), zero) / 10))
    score = F.when(has_any(F.lower(site), PARKED), 0).otherwise(of(site, 35)) + of(context, 30) + F.when(funded, 20).otherwise(0) + F.least(passes * 5, F.lit(15))
    score = score - F.when(age > 90, F.least(F.floor((age - 90) / 7), F.lit(20))).otherwise(0)
    return F.greatest(zero, F.least(score, F.lit(100))).cast("int")


def first_confidence(core: list[Column], more: list[Column]) -> Column:
    """15, 10, 10 for the three core fields, 5 for each other; 35 at least if the three are there; 100 at most."""
    given = lambda c: F.when(c.isNull() | F.lower(c).isin("unknown", "none", ""), 0)
    score = sum((given(c).otherwise(p) for c, p in zip(core, (15, 10, 10), strict=True)), F.lit(0)) + sum((F.when(c.isNull() | c.isin("Unknown", "None", ""), 0).otherwise(5) for c in more), F.lit(0))
    all_three = reduce(lambda a, b: a & b, (F.coalesce(c, F.lit("")) != "" for c in core))
    return F.least(F.lit(100), F.when(all_three, F.greatest(score, F.lit(35))).otherwise(score)).cast("int")


def currency_in(c: Column) -> Column:
    u = F.upper(c)
    return F.when(u.contains("USD") | u.contains("$"), "USD").when(u.contains("EUR") | u.contains("€"), "EUR").when(u.contains("TRY") | u.contains(" TL") | u.contains("₺"), "TRY").otherwise("Unknown")


def currency_by_sign(c: Column) -> Column:
    """By sign, else by the first code in alphabetical order; null if none."""
    out = F.lit(None).cast("string")
    for code in reversed(sorted(["USD", "EUR", "TRY", "GBP", "CHF", "JPY", "CNY", "SAR", "AED", "INR"])):
        out = F.when(F.upper(c).contains(code), code).otherwise(out)
    for sign, code in reversed(list({"$": "USD", "€": "EUR", "₺": "TRY", "£": "GBP", "¥": "JPY", "₹": "INR"}.items())):
        out = F.when(c.contains(sign), code).otherwise(out)
    return out


def funding_value(c: Column) -> Column:
    """The number that a funding text states: shorthand (5M, 1.5 milyar), thousands marks of either kind; null if unreadable or beyond SPAN dollars, euros or pounds without shorthand."""
    story = "(?i)^(over|approximately|about|undisclosed|toplam|yaklaşık)\\s"
    told = "(?i)([$€₺]?\\s*\\d[\\d.,]*\\s*(?:billion|million|B|M|K|milyar|milyon)?)"
    short = "(?i)^([\\d.,]+)\\s*(milyon|million|milyar|billion|K|M|B)$"
    units = {"k": 1e3, "m": 1e6, "b": 1e9, "milyon": 1e6, "million": 1e6, "milyar": 1e9, "billion": 1e9}
    number = lambda s: F.when(s.rlike("^(\\d+\\.?\\d*|\\.\\d+)$"), s).cast("double")
    no = lambda s, ch: F.replace(s, F.lit(ch), F.lit(""))
    text = let(F.trim(c), lambda t: F.when(t.rlike(story), F.nullif(F.regexp_extract(t, told, 1), F.lit(""))).otherwise(t))
    bare = F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(text, "[$€£₺]", ""), "(?i)\\b(USD|TRY|TL|EUR|GBP)\\b", "")), ",+$", ""))
    marks = let(bare, lambda x: F.when(x.rlike("^\\d{1,3}(\\.\\d{3})+(,\\d{1,2})?$"), F.replace(no(x, "."), F.lit(","), F.lit("."))).otherwise(x))
    sane = lambda v: F.when((v > 0) & ~((currency_in(c) != "TRY") & (v > SPAN)), v)
    value = let(marks, lambda x: F.coalesce(number(no(F.regexp_extract(x, short, 1), ",")) * mapped(F.lower(F.regexp_extract(x, short, 2)), units), let(number(no(x, ",")), sane)))
    return F.when(~F.lower(F.trim(c)).isin("unknown", "n/a", "undisclosed", ""), value)


def funding_text(c: Column) -> Column:
    """`5,000,000 USD` of a funding text; the currency is USD where none is stated."""
    cur = currency_in(c)
    return let(cur, lambda u: F.concat(F.format_number(F.floor(funding_value(c)), 0), F.lit(" "), F.when(u == "Unknown", "USD").otherwise(u)))


def turkish_money(value: Column, code: Column) -> Column:
    """`1.250.000,00 USD`; null unless positive."""
    return F.when(value > 0, F.concat(F.translate(F.format_number(value, 2), ",.", ".,"), F.lit(" "), code))


# How an amount names its currency; the first that stands in it is taken out, dollars otherwise.
AMOUNT_CODES = {"TRY": ["TRY", "TL"], "EUR": ["EUR", "€"], "GBP": ["GBP", "£"], "USD": ["USD", "$"]}


def amount_code(c: Column) -> Column:
    """The currency of an amount: lira, euro or pound where it says so, else dollars; null without an amount."""
    u = F.upper(c)
    out = F.when(~F.lower(F.trim(c)).isin("unknown", "none", ""), "USD")
    for code in ("GBP", "EUR", "TRY"):
        out = F.when(out.isNotNull() & has_any(u, AMOUNT_CODES[code]), code).otherwise(out)
    return out


def amount_of(c: Column, legacy: bool = False) -> Column:
    """The number of an amount with a unit word, its currency taken out first; legacy keeps the old reading in which any M is a million and dots alone are decimal."""
    u = F.upper(c)
    bare = u
    for words in reversed(AMOUNT_CODES.values()):
        out = u
        for w in words:
            out = F.replace(out, F.lit(w), F.lit(""))
        bare = out if words is AMOUNT_CODES["USD"] else F.when(has_any(u, words), out).otherwise(bare)
    u = bare
    m, k, b = u.contains("M"), u.contains("K") | u.contains("BIN") | u.contains("BİN"), u.contains("B")
    billions = u.contains("MILYAR") | u.contains("BILLION")
    times = F.when(m, 1e6).when(k, 1e3).when(b, 1e9).otherwise(1.0) if legacy else F.when(billions, 1e9).when(m, 1e6).when(k, 1e3).when(b, 1e9).otherwise(1.0)
    no = lambda s, ch: F.replace(s, F.lit(ch), F.lit(""))

    def digits(d: Column) -> Column:
        dot, comma = F.instr(d, "."), F.instr(d, ",")
        both = F.when(dot < comma, F.replace(no(d, "."), F.lit(","), F.lit("."))).otherwise(no(d, ","))
        one = F.when(d.rlike("^[0-9]*,[0-9]{2}$"), F.replace(d, F.lit(","), F.lit("."))).otherwise(no(d, ","))
        only = d if legacy else F.when(d.rlike("^[0-9]{1,3}(\\.[0-9]{3})+$"), no(d, ".")).otherwise(d)
        return F.when((dot > 0) & (comma > 0), both).when(comma > 0, one).otherwise(only)

    n = let(F.regexp_replace(u, "[^0-9.,]", ""), digits)
    return let(n, lambda x: F.when(x.rlike("^[0-9]+\\.?[0-9]*$"), x).cast("double")) * times


def round_type(c: Column) -> Column:
    return F.when(c.isNull() | (F.trim(c) == ""), "NA").otherwise(mapped(F.lower(F.trim(c)), ROUNDS, F.trim(c)))


def place(c: Column) -> Column:
    """Whole places by the list (some mean nothing), else spellings inside and country endings."""
    t = F.trim(c)
    known = {k: v for k, v in PLACES.items() if v is not None}
    nothing = [k for k, v in PLACES.items() if v is None]
    x = folded(t, INSIDE, lambda x, a, b: F.when(F.contains(x, a) & ~F.contains(x, b), F.replace(x, a, b)).otherwise(x))
    x = folded(x, ENDINGS, lambda x, a, b: F.when(F.endswith(x, a), F.concat(x.substr(F.lit(1), F.length(x) - F.length(a)), b)).otherwise(x))
    return F.when(t.isin(*nothing), None).otherwise(mapped(t, known, x))


def origin(c: Column) -> Column:
    low = F.lower(c)
    return F.when(c.isNull() | F.lower(F.trim(c)).isin("", "unknown", "n/a", "none", "global", "europe"), "Unknown").when(has_any(low, DOMESTIC), "Domestic").otherwise("International")


def terms(c: Column) -> Column:
    """A comma list with each term once (letter case aside, the first spelling stays), sorted, joined with `, `; missing ones as they are."""
    items = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")
    once = let(items, lambda xs: let(F.transform(xs, lambda y: F.lower(y)), lambda low: F.filter(xs, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)))
    return F.when(c.isNull() | F.lower(F.trim(c)).isin("none", "unknown", "nan", ""), c).otherwise(F.array_join(F.array_sort(once), ", "))


def founders(c: Column) -> Column:
    """A JSON list as a comma text; an empty one is `Unknown`; anything else as it is."""
    t = F.trim(c)
    names = F.from_json(t, "array<string>")
    text = F.array_join(F.transform(F.filter(names, lambda x: x.isNotNull() & (x != "")), lambda x: F.trim(x)), ", ")
    return F.when(c.isNull() | F.lower(t).isin("none", "unknown", ""), c).when(t.startswith("[") & t.endswith("]") & names.isNotNull(), F.when(text == "", "Unknown").otherwise(text)).otherwise(c)


def _reason(rules: list[tuple[Column, str]]) -> Column:
    out = F.lit(None).cast("string")
    for test, name in reversed(rules):
        out = F.when(test, name).otherwise(out)
    return out


def company_fault(c: Column) -> Column:
    """Why a text is no company name; null for a name."""
    t = F.trim(c)
    blanks = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
    return _reason([(c.isNull() | (F.length(t) < 3), "short"), (F.length(t) > 100, "long"), (F.lower(t).isin(*NO_COMPANY), "listed"), (t.rlike("|".join(JUNK)), "junk"), (t.rlike(SCRAPED), "scraped"), (blanks > 8, "sentence")])


def investor_fault(c: Column) -> Column:
    t = F.trim(c)
    blanks = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
    return _reason([(c.isNull() | (F.length(t) < 3), "short"), (F.length(t) > 80, "long"), (F.lower(t).isin(*NO_INVESTOR), "listed"), (t.contains("@"), "email"), (t.startswith("http") | F.lower(t).contains(".com"), "url"), (t.rlike(POLITICAL), "political"), (t.rlike(SCRAPED), "scraped"), (t.rlike("^[\\[{]"), "bracket"), (blanks > 8, "sentence"), (t.rlike("^[0-9]"), "digit")])


def news_score(c: Column) -> Column:
    """Two for a technical word, one for an action word, three less for a negative one; news passes from two on."""
    t = F.lower(c)
    pts = lambda words, n: F.when(has_any(t, words), n).otherwise(0)
    return pts(NEWS_TECH, 2) + pts(NEWS_ACTION, 1) - pts(NEWS_NEGATIVE, 3)


def first_year(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "((?:19|20)[0-9]{2})", 1), F.lit("")).cast("int")


def hits(t: Column, words: list[str]) -> Column:
    """The words that stand in the text, in the order of the list."""
    return F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(t, w))


def cloud_text(*texts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *(F.coalesce(t, F.lit("")) for t in texts)))


def cloud_signal(*texts: Column) -> Column:
    t = cloud_text(*texts)
    yes, no = has_any(t, CLOUD), has_any(t, NO_CLOUD)
    return F.when(no & ~yes, "negative").when(yes & ~no, "positive").otherwise("ambiguous")


def cloud_hits(*texts: Column) -> Column:
    """The words that decide the signal: those against where there are no others, those for where there are no others, else both."""
    t = cloud_text(*texts)
    return F.concat(hits(t, CLOUD), hits(t, NO_CLOUD))


def cloud_label(description: Column, tech: Column, category: Column) -> Column:
    """A label by signal and category; null where neither tells."""
    signal, cat = cloud_signal(description, tech), F.lower(F.coalesce(category, F.lit("")))
    return F.when(signal == "positive", F.when(has_any(cat, NATIVE_TAGS), "Cloud-Native").otherwise("Cloud-Enabled")).when(signal == "negative", "Non-Cloud").when(has_any(cat, ADJACENT_TAGS), "Cloud-Adjacent")


def cloud_corrected(label: Column, description: Column, tech: Column, model: Column, category: Column) -> Column:
    """The label after three rules, the first that applies: products on the web, hardware without proof, emphasis on private."""
    t, cat = cloud_text(description, tech), F.lower(F.coalesce(category, F.lit("")))
    product = (F.lower(F.coalesce(model, F.lit(""))) == "product") & label.isin("Non-Cloud", "Cloud-Adjacent") & has_any(t, WEB_SIGNS)
    hardware = has_any(cat, HARDWARE_TAGS) & (label == "Cloud-Adjacent") & ~has_any(t, CLOUD_PROOF)
    return F.when(product, "Cloud-Enabled").when(hardware, "Non-Cloud").when(has_any(t, PRIVATE_SIGNS), "Non-Cloud").otherwise(label)


def cloud_repaired(label: Column) -> Column:
    """The valid label that differs in letter case or blanks only, else Cloud-Adjacent; null stays."""
    plain = F.replace(F.lower(label), F.lit(" "), F.lit("-"))
    return F.when(label.isNotNull(), mapped(plain, {x.lower(): x for x in CLOUD_LABELS}, F.lit("Cloud-Adjacent")))


def proximity(description: Column, use_case: Column, tech: Column, assumed: Column) -> Column:
    """0, 30 (some technology), 80 (words of artificial intelligence) or 100 (central to the company)."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    techs = F.concat_ws(" ", low(tech), low(assumed))
    every = F.concat_ws(" ", low(description), low(use_case), techs)
    ai = F.when(has_any(every, AI_CENTRAL) | F.contains(low(use_case), F.lit("platform")), 100).otherwise(80)
    return F.when(has_any(every, AI_WORDS), ai).when((techs != "none") & (F.length(techs) > 5), 30).otherwise(0)


def entity_junk(name: Column) -> Column:
    """The text is no organisation's name."""
    t = F.trim(name)
    return F.coalesce(F.lower(t).isin(*NO_ENTITY) | (F.length(t) < 3) | (F.length(t) > 80) | t.rlike("^[0-9]") | has_any(F.lower(t), ENTITY_JUNK), F.lit(True))


def entity_kind(name: Column) -> Column:
    """The first kind whose words stand in the name; null if none do."""
    out = F.lit(None).cast("string")
    for kind, words in reversed(ENTITY_KINDS.items()):
        out = F.when(has_any(F.lower(name), words), kind).otherwise(out)
    return out


def business_model(c: Column) -> Column:
    return F.when(F.lower(c).isin("saas", "platform", "software"), "Product").when(c.isin("Product", "Consultancy", "Hybrid", "Unknown"), c).otherwise("Unknown")


def weighted(parts: list[tuple[Column, int]]) -> Column:
    """The sum of the weights of the fields that are given, 100 at most."""
    return F.least(F.lit(100), sum((F.when(c.isNull() | c.isin("", "Unknown"), 0).otherwise(w) for c, w in parts), F.lit(0))).cast("int")


def token_estimate(c: Column) -> Column:
    words = F.filter(F.split(c, "\\s+"), lambda w: w != "")
    return F.coalesce(F.floor(F.size(words) * 1.3), F.lit(0)).cast("bigint")


def absent_fields(columns: list[str]) -> Column:
    return F.filter(F.array(*(F.when(is_absent(F.col(c)), c) for c in columns)), lambda x: x.isNotNull())
