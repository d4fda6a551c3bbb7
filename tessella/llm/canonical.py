"""Free-entered values to entries of a canonical list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold, squeeze
from ..session import checkpointed, small_enough

#: accept the best entry of a piece from this score, and this lead over the next entry
THRESHOLD, MARGIN = 0.5, 0.03
#: candidates are the entries from this cosine on; the exact check after the scoring allows so many edits per letter
LEAST_COSINE, EDITS = 0.12, 0.41


def mended(c: Column) -> Column:
    """UTF-8 that was read as Latin-1 or Windows-1252 is read again."""
    broken = c.rlike("[\\u00c3-\\u00c5][\\u0080-\\u00bf]") & ~c.rlike("[^\\u0000-\\u00ff]")
    western = c.rlike("[\\u00c3-\\u00c5][\\u0152-\\u2122]") & ~c.rlike("[^\\u0000-\\u00ff\\u0152\\u0153\\u0160\\u0161\\u0178\\u017d\\u017e\\u0192\\u02c6\\u02dc\\u2013-\\u2122]")
    return F.when(broken, F.decode(F.encode(c, "ISO-8859-1"), "UTF-8")).when(western, F.decode(F.encode(c, "windows-1252"), "UTF-8")).otherwise(c)


def plain(c: Column) -> Column:
    """Folded words of letters and digits with single blanks; letters written apart come together, glued capitals part."""
    c = squeeze(mended(c))
    c = F.when(c.rlike("^(?:[\\p{L}][ .]){2,}[\\p{L}]\\.?$"), F.regexp_replace(c, "[ .]", "")).otherwise(c)
    c = F.regexp_replace(c, "(?<=\\p{Ll})(?=\\p{Lu})", " ")
    return F.trim(F.regexp_replace(fold(c), "[^\\p{L}\\p{N}]+", " "))


def grams(c: Column) -> Column:
    """Distinct features of a plain text: its 2- and 3-grams with word edges, and its single letters standing alone."""
    padded = F.concat(F.lit("_"), F.regexp_replace(c, " ", "_"), F.lit("_"))
    n = F.length(padded)
    of = lambda k: F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: padded.substr(i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    alone = F.transform(F.filter(F.split(c, " "), lambda w: F.length(w) == 1), lambda w: F.concat(F.lit("alone:"), w))
    return F.array_distinct(F.concat(of(2), of(3), alone))


def index(entries: DataFrame) -> DataFrame:
    """Inverted index (field, gram, form, ref_id, w, norm) over entries(field, ref_id, form): idf weights within a field, the norm of each form."""
    f = entries.select("field", "ref_id", plain(F.col("form")).alias("form")).filter("form <> ''").distinct()
    g = f.select("field", "ref_id", "form", F.explode(grams(F.col("form"))).alias("gram"))
    g = g.withColumn("df", F.count("*").over(Window.partitionBy("field", "gram")))
    forms = f.groupBy("field").agg(F.countDistinct("form").alias("n_forms"))
    # one row a field
    g = g.join(F.broadcast(forms), "field").withColumn("w", F.log(1 + F.col("n_forms") / F.col("df")) * F.when(F.col("gram").startswith("alone:"), 2.0).otherwise(1.0))
    return g.withColumn("norm", F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("field", "ref_id", "form")))).select("field", "gram", "form", "ref_id", "w", "norm")


def matched(pieces: DataFrame, idx: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """(field, piece, ref_id, form, score, lead) for the distinct pieces(field, piece) that an entry claims.

    Candidates are the forms that share a gram; a gram that no form has weighs as much as the rarest. The score is the
    mean of the weighted cosine and of the share of letters that stay as they are (two swapped letters, one edit here,
    spoil many grams of a short word). Forms of up to three letters must fit exactly, of four but for one edit. The best entry is
    accepted above the threshold and with a lead over the next entry. The index, one list of forms a field, is broadcast when its checked size allows.
    """
    small = small_enough(idx)
    hint = F.broadcast if small else (lambda x: x)
    g = pieces.select("field", "piece").distinct().select("field", "piece", F.explode(grams(F.col("piece"))).alias("gram"))
    # one lookup a gram: its weight and the forms that have it; a gram without forms keeps the field's largest weight
    by_gram = idx.groupBy("field", "gram").agg(F.max("w").alias("gw"), F.collect_list(F.struct("form", "ref_id", "norm")).alias("forms"))
    most = idx.groupBy("field").agg(F.max("w").alias("mw"))
    # one row a field
    g = g.join(hint(by_gram), ["field", "gram"], "left").join(F.broadcast(most), "field").withColumn("gw", F.coalesce("gw", "mw"))
    none = F.array(F.struct(F.lit(None).cast("string").alias("form"), F.lit(None).cast("bigint").alias("ref_id"), F.lit(None).cast("double").alias("norm")))
    hits = g.select("field", "piece", "gw", F.explode(F.concat(none, F.coalesce("forms", F.array().cast("array<struct<form:string,ref_id:bigint,norm:double>>")))).alias("f"))
    hits = hits.groupBy("field", "piece", "f").agg(F.sum(F.col("gw") * F.col("gw")).alias("dot"))
    # the row without a form holds the norm of the piece itself
    best = hits.groupBy("field", "piece").agg(F.sqrt(F.max(F.when(F.col("f.form").isNull(), F.col("dot")))).alias("pnorm"), F.collect_list(F.when(F.col("f.form").isNotNull(), F.struct("f.form", "f.ref_id", "f.norm", "dot"))).alias("c"))
    hits = best.select("field", "piece", "pnorm", F.explode("c").alias("c")).select("field", "piece", "c.form", "c.ref_id", (F.col("c.dot") / (F.col("c.norm") * F.col("pnorm"))).alias("cosine"))
    letters = lambda c: F.array_sort(F.split(c, ""))
    n = F.levenshtein("piece", "form")
    hits = hits.filter(F.col("cosine") >= LEAST_COSINE).withColumn("n", F.when((n == 2) & (letters(F.col("piece")) == letters(F.col("form"))), 1).otherwise(n))
    edits = F.col("n") / F.greatest(F.length("piece"), F.length("form"))
    size = F.length("form")
    sure = F.when(size <= 3, F.col("n") == 0).when(size == 4, F.col("n") <= 1).otherwise(edits <= EDITS)
    hits = hits.filter(sure).withColumn("score", (F.col("cosine") + 1 - edits) / 2)
    best = hits.groupBy("field", "piece", "ref_id").agg(F.max(F.struct("score", "form")).alias("b"))
    ranked = best.groupBy("field", "piece").agg(F.sort_array(F.collect_list(F.struct("b.score", (-F.col("ref_id")).alias("neg"), "b.form")), asc=False).alias("r"))
    ranked = ranked.select("field", "piece", (-F.col("r")[0]["neg"]).alias("ref_id"), F.col("r")[0]["form"].alias("form"), F.col("r")[0]["score"].alias("score"), (F.col("r")[0]["score"] - F.coalesce(F.try_element_at("r", F.lit(2))["score"], F.lit(0.0))).alias("lead"))
    return ranked.filter((F.col("score") >= threshold) & (F.col("lead") >= margin))


def assigned(values: DataFrame, entries: DataFrame, pieces: Column, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """(field, value, ref_id, score) for each distinct value of values(field, value); ref_id 0 where no entry is meant.

    entries(field, ref_id, form) are the ways to write the entries; pieces makes an array of plain pieces of the columns field
    and value. The best claimed piece decides, the smallest entry on ties; values whose pieces different entries claim equally
    well get 0. Each distinct value is worked on once, however many rows have it; nulls give 0, an empty list gives 0 for all.
    """
    idx = checkpointed(index(entries))
    v = checkpointed(values.select("field", "value").distinct())
    p = v.filter("value is not null").select("field", "value", F.explode(F.array_distinct(pieces)).alias("piece")).filter("piece <> ''")
    got = p.join(matched(p, idx, threshold, margin), ["field", "piece"]).groupBy("field", "value", "ref_id").agg(F.max("score").alias("score"))
    got = got.groupBy("field", "value").agg(F.sort_array(F.collect_list(F.struct("score", (-F.col("ref_id")).alias("neg"))), asc=False).alias("r"))
    clear = (F.size("r") < 2) | (F.col("r")[0]["score"] - F.try_element_at("r", F.lit(2))["score"] > 0.02)
    got = got.select("field", "value", F.when(clear, -F.col("r")[0]["neg"]).alias("ref_id"), F.col("r")[0]["score"].alias("score"))
    return v.join(got, ["field", "value"], "left").select("field", "value", F.coalesce("ref_id", F.lit(0)).cast("bigint").alias("ref_id"), "score")
