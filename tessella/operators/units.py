"""Sums stated in different currencies, scales and notations, to one unit."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold, squeeze
from ..session import packed, unpacked

# How a currency is written, after folding.
CURRENCIES = {
    "USD": ["us dollars", "us dollar", "abd dolari", "amerikan dolari", "us$", "usd", "dollars", "dollar", "dolar", "$"],
    "EUR": ["euros", "euro", "eur", "avro", "€"],
    "GBP": ["british pounds", "pounds sterling", "pounds", "pound", "sterling", "sterlin", "gbp", "£"],
    "TRY": ["turk lirasi", "turkish lira", "lira", "try", "tl", "₺"],
    "JPY": ["japanese yen", "yen", "jpy", "円", "¥", "￥"],
    "CHF": ["isvicre frangi", "swiss francs", "schweizer franken", "franken", "chf", "sfr.", "sfr", "fr."],
    "AED": ["dirhams", "dirham", "dirhem", "aed"],
    "INR": ["indian rupees", "rupees", "rupee", "inr", "rs.", "rs", "₹"],
}
# Scale words after folding.
SCALES = {
    1_000: ["thousand", "thousands", "tausend", "mille", "tsd", "bin", "k"],
    10_000: ["万"],
    100_000: ["lakhs", "lakh", "lac"],
    1_000_000: ["millionen", "millions", "million", "milyon", "mio", "mln", "mn", "mm", "m"],
    10_000_000: ["crores", "crore", "cr"],
    100_000_000: ["億"],
    1_000_000_000: ["milliarden", "milliarde", "milliard", "milliards", "billions", "billion", "milyar", "mrd", "bn", "b"],
}
# Numbers in words, after folding.
WORDS = {
    0.5: "half yarim", 1: "one bir ein eine un une", 2: "two iki zwei deux", 3: "three uc drei trois", 4: "four dort vier quatre", 5: "five bes funf cinq", 6: "six alti sechs", 7: "seven yedi sieben sept",
    8: "eight sekiz acht huit", 9: "nine dokuz neun neuf", 10: "ten on zehn dix", 11: "eleven", 12: "twelve", 15: "fifteen", 20: "twenty yirmi zwanzig vingt", 25: "twenty-five", 30: "thirty otuz", 40: "forty kirk",
    50: "fifty elli", 60: "sixty altmis", 70: "seventy yetmis", 80: "eighty seksen", 90: "ninety doksan", 100: "hundred yuz hundert cent",
}
# Words and signs that make a figure a bound, after folding.
BOUNDS = "up to|over|at least|at most|more than|less than|under|below|above|minimum|maximum|between|en az|en fazla|en cok|uzerinde|altinda|fazla|kadar|mindestens|hochstens|bis zu|uber|unter|mehr als|weniger als|au moins|jusqu'a|plus de|moins de"
# How a note states the scale of the figures.
NOTED = {1_000: "bin cinsinden|in tsd|in thousands|figures in thousands|unit: k|en milliers|thousands", 1_000_000: "milyon cinsinden|in mio|in millions|given in millions|unit: m|en millions|millions"}
LEAST = 1_000  # no stated sum is below so many units of its currency


def _words(xs: list[str]) -> str:
    return "|".join(re.sub(r"([.$])", r"\\\1", x) for x in sorted(xs, key=len, reverse=True))


def currency(c: Column) -> Column:
    """The currency code that a folded text names, the first in it; null if none. Letters beside it must not continue the word."""
    every = _words([w for ws in CURRENCIES.values() for w in ws])
    codes = F.create_map(*(F.lit(x) for code, ws in CURRENCIES.items() for w in ws for x in (w, code)))
    return F.try_element_at(codes, F.regexp_extract(c, f"(?<![a-z])({every})(?![a-z])", 1))


def _scale(word: Column) -> Column:
    pairs = [F.lit(x) for k, ws in SCALES.items() for w in ws for x in (w, float(k))]
    return F.try_element_at(F.create_map(*pairs), word)


#: what the columns say of a sum; each is an identity whose log residual a combination of units must keep small
IDENTITIES = ("least", "cents", "beside", "noted", "mark")
#: weights: sums that cannot be stated, a scale written beside the figure, one in the note, the plain sense of a mark
IMPOSSIBLE, BESIDE, NOTED_WEIGHT, MARK = 1_000.0, 4.0, 2.0, 1.0


def readings(df: DataFrame, amount: str, code: str, notes: str, rates: DataFrame, evidence: str | None = None, identities: tuple[str, ...] = IDENTITIES) -> DataFrame:
    """df with (sum, sum_currency, usd, n_readings, residual).

    The units of a figure are unknown: its last mark may be a decimal point or a thousands mark, its scale that
    beside it, that of the note, or one. All combinations are candidates, and the one with the smallest sum of
    weighted log10 residuals against these identities is chosen:
    - least: sum >= LEAST units of its currency (residual log10(LEAST / sum));
    - cents: sum x rate is a whole number of cents;
    - beside, noted: sum = figure x the scale beside it, or x the scale of the note where none is beside it
      (residual |log10| of the scale used by the scale stated);
    - mark: figure = its plain reading: a decimal point where a scale is beside it, a thousands mark before three digits where not.
    A combination that breaks one of the first two is impossible. n_readings counts the sums that are possible with
    the scale as stated; more than one flags a sum that is not unique. residual is log10(usd / evidence), for
    reports only: the evidence column takes no part in the choice.

    Null, blank, undisclosed, ranges, bounds, several figures and unknown currencies give nulls. rates (currency_code,
    usd_per_unit) is a short reference list and is broadcast. Texts may have any length. Other columns stay, whatever their names;
    ones named like a result give way to it.
    """
    every = _words([w for ws in SCALES.values() for w in ws])
    numbers = _words([w for ws in WORDS.values() for w in ws.split()])
    x = packed(df, _a=fold(squeeze(F.col(amount))), _code=fold(squeeze(F.col(code))), _note=fold(squeeze(F.col(notes))), _evidence=F.col(evidence) if evidence else F.lit(None).cast("double"))
    figure = "\\d{1,3}(?:[ ']\\d{3})++(?:[.,]\\d{1,2})?(?!\\d)|\\d[\\d.,]*\\d|\\d"
    x = x.withColumn("_n", F.regexp_extract("_a", f"({figure})", 1))
    rest = F.regexp_replace("_a", f"^(.*?)(?:{figure})", "$1\u0001")
    x = x.withColumn("_rest", F.when(F.col("_n") != "", rest))
    said = F.regexp_extract("_a", f"(?<![a-z])({numbers}) (?:{every})(?![a-z])", 1)
    x = x.withColumn("_word", F.when(F.col("_n") == "", said))
    x = x.withColumn("_rest", F.when(F.coalesce("_word", F.lit("")) != "", F.regexp_replace("_a", f"(?<![a-z])({numbers}) (?=(?:{every})(?![a-z]))", "\u0001 ")).otherwise(F.col("_rest")))
    stated = F.col("_rest").isNotNull() & ~F.col("_rest").rlike("\\d") & ~F.col("_a").rlike(f"[<>≤≥]|(?<![a-z])({BOUNDS})(?![a-z])") & ~F.col("_a").rlike("\\d\\+")
    beside = F.regexp_extract("_rest", f"\x01 ?({every})(?:\\.(?![a-z])|(?![a-z]))", 1)
    x = x.withColumn("_beside", F.when(beside != "", _scale(beside)))
    note = F.col("_note")
    noted = F.lit(None).cast("double")
    for k, words in NOTED.items():
        noted = F.when(note.rlike(words), float(k)).otherwise(noted)
    x = x.withColumn("_noted", noted)
    spelled = F.regexp_replace("_rest", f"\x01 ?({every})\\.?(?![a-z])", "\u0001 ")
    x = x.withColumn("_cur", F.coalesce(currency(spelled), currency(F.col("_code")), currency(note)))
    n = F.regexp_replace("_n", "[ ']", "")
    dots, commas = F.length(F.regexp_replace(n, "[^.]", "")), F.length(F.regexp_replace(n, "[^,]", ""))
    last = F.regexp_extract(n, "([.,])\\d*$", 1)
    tail = F.length(F.regexp_extract(n, "[.,](\\d*)$", 1))
    plain = F.regexp_replace(n, "[.,]", "")
    both = (dots > 0) & (commas > 0)
    grouped = n.rlike("^\\d{1,3}(?:[.,]\\d{2,3})*+(?<=[.,]\\d{3})$")
    point = F.when(last == "", plain).otherwise(F.concat(F.regexp_replace(F.regexp_extract(n, "^(.*)[.,]\\d*$", 1), "[.,]", ""), F.lit("."), F.regexp_extract(n, "[.,](\\d*)$", 1)))
    once = (dots + commas) == 1
    as_point = F.when(F.col("_n") != "", F.when(both | once | (last == ""), F.when(point.rlike("^\\d+(\\.\\d*)?$"), point)).cast("double"))
    as_group = F.when((F.col("_n") != "") & ~both & grouped & (tail == 3), plain.cast("double"))
    words = F.try_element_at(F.create_map(*(F.lit(v) for k, ws in WORDS.items() for w in ws.split() for v in (w, float(k)))), F.col("_word"))
    x = x.withColumn("_figures", F.array_distinct(F.filter(F.array(words, as_point, as_group), lambda v: v.isNotNull())))
    x = x.withColumn("_scales", F.array_distinct(F.filter(F.array("_beside", "_noted", F.lit(1.0)), lambda v: v.isNotNull())))
    # the plain sense of a mark: a decimal point after a scale word, a thousands mark without one
    x = x.withColumn("_plain", F.coalesce(words, F.when(F.col("_beside").isNotNull(), F.coalesce(as_point, as_group)).otherwise(F.coalesce(as_group, as_point))))
    # a list of a few currencies: its size is fixed by definition
    rate = F.broadcast(rates.select(F.col("currency_code").alias("_cc"), F.col("usd_per_unit").alias("_rate")).dropDuplicates(["_cc"]))
    x = x.join(rate, F.col("_cur") == F.col("_cc"), "left")
    scale = F.coalesce("_beside", "_noted", F.lit(1.0))

    def candidate(f: Column, s: Column) -> Column:
        cents = f * s * F.col("_rate") * 100
        broken = F.lit(0.0)
        if "least" in identities:
            broken = broken + F.when(f * s < LEAST, IMPOSSIBLE + F.log10(LEAST / F.greatest(f * s, F.lit(1e-9)))).otherwise(0.0)
        if "cents" in identities:
            broken = broken + F.when(F.abs(cents - F.round(cents)) < 1e-3, 0.0).otherwise(IMPOSSIBLE)
        off = broken
        if "beside" in identities:
            off = off + F.coalesce(BESIDE * F.abs(F.log10(s / F.col("_beside"))), F.lit(0.0))
        if "noted" in identities:
            off = off + F.when(F.col("_beside").isNull() | F.lit("beside" not in identities), F.coalesce(NOTED_WEIGHT * F.abs(F.log10(s / F.col("_noted"))), F.lit(0.0))).otherwise(0.0)
        if "mark" in identities:
            off = off + MARK * F.abs(F.log10(F.greatest(f, F.lit(1e-9)) / F.greatest("_plain", F.lit(1e-9))))
        return F.struct(off.alias("off"), (f * s).alias("sum"), (broken < IMPOSSIBLE).alias("possible"), (s == scale).alias("as_stated"))

    every_pair = F.flatten(F.transform("_figures", lambda f: F.transform("_scales", lambda s: candidate(f, s))))
    x = x.withColumn("_units", F.when(stated & F.col("_rate").isNotNull(), F.filter(every_pair, lambda c: c["possible"])))
    if {"beside", "noted"} <= set(identities):  # a stated scale is never left out
        x = x.withColumn("_units", F.filter("_units", lambda c: c["as_stated"]))
    x = x.withColumn("_best", F.explode_outer(F.slice(F.array_sort("_units"), 1, 1)))  # a generator: filters on the outcome stay above it
    best = F.col("_best.sum")
    usd = best * F.col("_rate")
    several = F.size(F.array_distinct(F.transform(F.filter("_units", lambda c: c["as_stated"]), lambda c: c["sum"])))
    res = F.when((F.col("_evidence") > 0) & (usd > 0), F.log10(usd / F.col("_evidence")))
    return x.select(*unpacked(x, df, "sum", "sum_currency", "usd", "n_readings", "residual"), best.alias("sum"), F.when(best.isNotNull(), F.col("_cur")).alias("sum_currency"), usd.alias("usd"), F.when(best.isNotNull(), several).alias("n_readings"), res.alias("residual"))
