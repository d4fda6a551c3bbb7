"""A keyword index learned from descriptions, and scores by it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words that are never learned.
STOP = [
    "the", "a", "an", "and", "or", "is", "are", "was", "were", "in", "on", "at", "to", "for", "of", "with", "by", "from", "as", "it", "its", "that", "this", "be", "has", "have", "had", "not", "but", "if", "we", "our", "they", "their", "can", "will", "do", "does", "also", "such", "using", "based", "which", "into", "more", "than", "been", "being", "both", "each", "most", "some", "about", "company", "startup", "turkish", "turkey", "istanbul", "ankara", "provides", "offers", "solution", "solutions", "service", "services", "technology", "technologies", "innovative", "leverages", "cutting-edge", "leading", "various", "industries", "businesses", "users", "enable", "enables", "artificial", "intelligence", "machine", "learning", "powered", "driven", "utilizes", "help", "helps", "develop", "develops", "development", "specializes", "focus", "focused", "designed", "create", "creating",
]
TOP, HEAD = 60, 10


def learned(text: Column) -> Column:
    """The distinct words of more than three letters and pairs of neighbours of more than two, without stop words, in small letters."""
    words = F.regexp_extract_all(F.lower(text), F.lit("([\\p{L}\\p{N}_]+)"), F.lit(1))
    stop = F.array(*map(F.lit, STOP))
    fine = lambda w, n: (F.length(w) > n) & ~F.array_contains(stop, w)

    def pairs(ws: Column) -> Column:
        both = F.arrays_zip(F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))).alias("a"), F.slice(ws, 2, F.greatest(F.size(ws) - 1, F.lit(0))).alias("b"))
        return F.transform(F.filter(both, lambda p: fine(p["a"], 2) & fine(p["b"], 2)), lambda p: F.concat_ws(" ", p["a"], p["b"]))

    return F.transform(F.array(words), lambda ws: F.array_distinct(F.concat(F.filter(ws, lambda w: fine(w, 3)), pairs(ws))))[0]


def heads(index: DataFrame) -> DataFrame:
    """(tag, words, top): per tag its TOP heaviest keywords and the weight of its HEAD heaviest; index(tag, keyword, weight)."""
    order = Window.partitionBy("tag").orderBy(F.desc("weight"), "keyword")
    top = index.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    return top.groupBy("tag").agg(F.sort_array(F.collect_list(F.struct("rank", "keyword", "weight"))).alias("words"), F.sum(F.when(F.col("rank") <= HEAD, F.col("weight"))).alias("top"))


def scored(rows: DataFrame, index: DataFrame, text: str, tag: str) -> DataFrame:
    """rows with score: the weight of its tag's keywords that stand in the text, over the weight of the heaviest ten, at most 1; 0.5 for a tag without keywords, 0 for no text.

    A tag's keywords are one row of an array (there are a few dozen tags), so no keyword is joined to texts of other tags.
    """
    x = rows.join(F.broadcast(heads(index).withColumnRenamed("tag", "_tag")), F.col(tag) == F.col("_tag"), "left")
    hit = F.aggregate(F.filter("words", lambda w: F.contains(F.lower(F.col(text)), w["keyword"])), F.lit(0.0), lambda s, w: s + w["weight"])
    score = F.when(F.col(text).isNull() | (F.col(text) == "") | F.col(tag).isNull(), 0.0).when(F.col("words").isNull(), 0.5).otherwise(F.least(hit / F.greatest("top", F.lit(1.0)), F.lit(1.0)))
    return x.select(*(F.col(f"`{c}`") for c in rows.columns), F.round(score, 6).alias("score"))


def best_tags(rows: DataFrame, index: DataFrame, key: str, text: str, n: int = 5) -> DataFrame:
    """(key, tags): the n tags that fit each text best, equal ones by name."""
    tags = heads(index).agg(F.collect_list(F.struct("tag", "words", "top")).alias("tags"))  # one row of a few dozen tags
    hit = lambda t, x: F.aggregate(F.filter(t["words"], lambda w: F.contains(x, w["keyword"])), F.lit(0.0), lambda s, w: s + w["weight"])
    x = rows.filter(F.col(text) != "").crossJoin(F.broadcast(tags))
    low = F.lower(F.col(text))
    ranked = F.array_sort(F.transform("tags", lambda t: F.struct((-F.round(F.least(hit(t, low) / F.greatest(t["top"], F.lit(1.0)), F.lit(1.0)), 6)).alias("s"), t["tag"].alias("tag"))))
    return x.select(key, F.transform(F.slice(ranked, 1, n), lambda r: r["tag"]).alias("tags"))
