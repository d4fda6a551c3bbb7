"""One surviving record for each group of duplicate records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_missing
from ..operators import timestamps

SALTS = 16


def with_instant(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with the instant that a text states, as `YYYY-MM-DDThh:mm:ssZ` plus its fraction; without zone UTC; null if it states none."""
    out = timestamps.normalised(df, text, F.lit("0"), F.lit("DMY"))
    second = F.when(F.length("normal") == 10, F.concat("normal", F.lit("T00:00:00"))).otherwise(F.substring("normal", 1, 19))
    part = F.regexp_extract(text, "\\d{2}:\\d{2}:\\d{2}[.,](\\d+)", 1)
    return out.withColumn(name, F.concat(second, F.lit("."), F.rpad(part, 9, "0"))).drop("normal", "status")


def trust(c: Column) -> Column:
    """A confidence score of 0 to 100; null for anything else, which ranks last."""
    return F.when(c.between(0, 100), c)


def kept(df: DataFrame, group: str, order: list[Column], salt_by: str) -> DataFrame:
    """The first row of each group in the given total order.

    Rank twice: within sub-groups spread by a hash of salt_by, then among their winners, so that a group that holds a
    third of all rows never meets in one task. Rows whose order columns tie completely must not exist; the last order column should be a key.
    """
    x = df.withColumn("_golden_salt", F.pmod(F.xxhash64(salt_by), F.lit(SALTS)))
    x = x.withColumn("_golden_rank", F.row_number().over(Window.partitionBy(group, "_golden_salt").orderBy(*order))).filter("_golden_rank = 1").drop("_golden_salt")
    return x.withColumn("_golden_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter("_golden_rank = 1").drop("_golden_rank")


def completeness(columns: list[str]) -> Column:
    """How many of the columns hold more than a stand-in."""
    return sum((F.when(is_missing(F.col(c).cast("string")), 0).otherwise(1) for c in columns), F.lit(0))


def merged(df: DataFrame, group: str, fields: list[str], order: Column) -> DataFrame:
    """One record per group, each field from the best record that fills it; order: a comparable column, smaller is better.

    Aggregates map-side, so hot groups shrink before they are shuffled. A field no record fills is null.
    """
    return df.groupBy(group).agg(F.count("*").alias("n_records"), *(F.min_by(F.when(~is_missing(F.col(f).cast("string")), F.col(f)), F.when(~is_missing(F.col(f).cast("string")), order)).alias(f) for f in fields))
