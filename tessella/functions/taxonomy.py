"""Sector and tag: parse, build and repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The valid pairs of sector and tag.
PAIRS = {
    "Manufacturing": ["Adv. Manufacturing", "Automotive & Mobility", "Textiles & Apparel", "Robotics & Automation"],
    "Defense": ["Unmanned Systems", "Cybersecurity"],
    "Finance": ["Fintech", "Banking & Insurtech", "Accounting & Tax"],
    "Health": ["Healthtech"],
    "Public Sector": ["GovTech", "EdTech", "Smart Cities"],
    "Agri-Food": ["Agritech"],
    "Services": ["Logistics & Supply Chain", "E-commerce & Retail", "HR & Recruitment", "Marketing & AdTech", "Legal & RegTech", "Media & Entertainment", "Hospitality & Travel", "Customer Experience", "Telecom & Connectivity", "Gaming & Esports"],
    "Technology": ["AI Infrastructure", "Data & Analytics", "Developer Tools", "Software Development"],
    "Energy": ["CleanTech & Energy"],
    "Real Estate": ["PropTech & Construction"],
    "General": ["Uncategorized"],
}
RETIRED = {"SaaS & Platforms": ("Technology", "Software Development")}
NOTHING = ("", "null", "none", "unknown")


def taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, t) for s, ts in PAIRS.items() for t in ts], "valid_sector string, valid_tag string")


def sector_of(c: Column) -> Column:
    """The part before the first ` | `; null without one and for stand-ins."""
    return _part(c, 0)


def tag_of(c: Column) -> Column:
    return _part(c, 1)


def _part(c: Column, i: int) -> Column:
    parts = F.split(c, " \\| ", 2)
    return F.when(~F.lower(F.trim(c)).isin(*NOTHING) & (F.size(parts) == 2), F.trim(parts[i]))


def built(sector: Column, tag: Column) -> Column:
    """`Sector | Tag`, null if either is blank."""
    return F.when((F.trim(sector) != "") & (F.trim(tag) != ""), F.concat_ws(" | ", F.trim(sector), F.trim(tag)))


def repaired(df: DataFrame, sector: str, tag: str) -> DataFrame:
    """df with (new_sector, new_tag): a retired tag moves; a valid pair stays; else by tag, else the first tag of the sector, else General."""
    t = F.col(tag)
    s2, t2 = F.col(sector), t
    for old, (s, n) in RETIRED.items():
        s2, t2 = F.when(t == old, s).otherwise(s2), F.when(t == old, n).otherwise(t2)
    pairs = taxonomy(df.sparkSession)
    by_tag = F.broadcast(pairs.select(F.col("valid_tag").alias("_tag"), F.col("valid_sector").alias("_by_tag")))
    by_sector = F.broadcast(pairs.groupBy(F.col("valid_sector").alias("_sector")).agg(F.min("valid_tag").alias("_by_sector")))
    x = df.withColumn("_s", s2).withColumn("_t", t2).join(by_tag, F.col("_t") == F.col("_tag"), "left").join(by_sector, F.col("_s") == F.col("_sector"), "left")
    new_sector = F.when(F.col("_by_tag").isNotNull(), F.col("_by_tag")).when(F.col("_by_sector").isNotNull(), F.col("_s")).otherwise("General")
    new_tag = F.when(F.col("_by_tag").isNotNull(), F.col("_t")).when(F.col("_by_sector").isNotNull(), F.col("_by_sector")).otherwise("Uncategorized")
    return x.select(*(F.col(f"`{c}`") for c in df.columns), new_sector.alias("new_sector"), new_tag.alias("new_tag"))


__all__ = ["PAIRS", "RETIRED", "built", "repaired", "sector_of", "tag_of", "taxonomy"]
