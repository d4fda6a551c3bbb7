"""Joins and reductions that need care: orphans, latest rows, scalar lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child whose fk is set and has no parent."""
    keys = parent.select(F.col(key).alias(fk)).filter(F.col(fk).isNotNull()).distinct()
    return child.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def nullified(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """child with fk null where it has no parent; NULL-safe, unlike NOT IN."""
    keys = parent.select(F.col(key).alias("_key")).filter("_key is not null").distinct().withColumn("_there", F.lit(True))
    x = child.join(keys, F.col(fk) == F.col("_key"), "left")
    return x.select(*(F.when(F.col("_there"), F.col(c)).alias(c) if c == fk else F.col(c) for c in child.columns))


def latest(df: DataFrame, by: list[str], order: Column, values: list[str]) -> DataFrame:
    """Per group the values of the row with the greatest order, by partial aggregation instead of a window."""
    return df.groupBy(*by).agg(F.max_by(F.struct(*values), order).alias("_v")).select(*by, *(F.col(f"_v.{v}").alias(v) for v in values))


def first_by(df: DataFrame, by: list[str], order: Column, values: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.min_by(F.struct(*values), order).alias("_v")).select(*by, *(F.col(f"_v.{v}").alias(v) for v in values))
