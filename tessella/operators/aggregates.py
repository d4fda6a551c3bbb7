"""Grouped counts as the dashboards need them: top-k, zero-filled buckets, tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filled(c: Column) -> Column:
    """Neither null nor empty."""
    return c.isNotNull() & (c != "")


def counted(df: DataFrame, key: Column, name: str, count: str = "cnt") -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count("*").alias(count))


def top(df: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    """The k rows with the largest `by`; equal ones in ascending order of `tie`, nulls last."""
    return df.orderBy(F.desc(by), F.asc_nulls_last(tie)).limit(k)


def bucketed(df: DataFrame, value: Column, steps: list[tuple[float, str]], rest: str, count: str = "cnt") -> DataFrame:
    """(pos, bucket, count) for every bucket, empty ones with 0; steps: descending least values, rest: all others and nulls."""
    label = F.lit(rest)
    for least, name in sorted(steps):
        label = F.when(value >= least, name).otherwise(label)
    names = [n for _, n in steps] + [rest]
    have = df.groupBy(label.alias("bucket")).agg(F.count("*").alias("n"))
    every = df.sparkSession.createDataFrame(list(enumerate(names)), "pos int, bucket string")
    # a literal list of labels
    return every.join(F.broadcast(have), "bucket", "left").select("pos", "bucket", F.coalesce("n", F.lit(0)).cast("bigint").alias(count))


def over_list(df: DataFrame, key: str, names: list[str], count: str = "cnt") -> DataFrame:
    """(key, count) for each listed value of a column, 0 where none has it."""
    every = df.sparkSession.createDataFrame([(n,) for n in names], f"{key} string")
    have = df.filter(F.col(key).isin(*names)).groupBy(key).agg(F.count("*").alias("n"))  # at most a row a listed value
    return every.join(F.broadcast(have), key, "left").select(key, F.coalesce("n", F.lit(0)).cast("bigint").alias(count))


def tokens(df: DataFrame, columns: list[str], pattern: str, name: str = "token") -> DataFrame:
    """One row per non-empty trimmed piece of the columns."""
    pieces = F.concat(*(F.coalesce(F.split(F.col(c), pattern), F.array().cast("array<string>")) for c in columns))
    return df.select(F.explode(pieces).alias("x")).select(F.trim("x").alias(name)).filter(F.col(name) != "")


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    """Per cent of whole, 0 for nothing of nothing."""
    return F.round(F.when(whole == 0, 0.0).otherwise(100.0 * part / whole), digits)
