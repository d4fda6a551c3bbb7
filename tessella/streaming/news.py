"""The news feed as a stream: each article once, counts by window, runs of failures, upserts by batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import upsert


def once(articles: DataFrame, late: str = "2 days") -> DataFrame:
    """The first arrival of each url_hash within the watermark; state is one key an article."""
    return articles.withWatermark("at", late).dropDuplicatesWithinWatermark(["url_hash"])


def counted(articles: DataFrame, size: str = "7 days", slide: str | None = None, late: str = "2 days") -> DataFrame:
    """(start, event_category, n) per window, emitted once it is complete."""
    w = F.window("at", size, slide) if slide else F.window("at", size)
    g = articles.withWatermark("at", late).groupBy(w.alias("w"), "event_category").agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), "event_category", "n")


def failures(checks: DataFrame) -> DataFrame:
    """(id, failures, status) after each batch of checks(id, signals): both signals add one to the run of failures, anything else ends it; three make it Stale."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        (n,) = state.get if state.exists else (0,)
        for p in parts:
            for s in p["signals"]:
                n = n + 1 if s == 2 else 0
        state.update((n,))
        yield pd.DataFrame({"id": [key[0]], "failures": [n], "status": ["Stale" if n >= 3 else "Active"]})

    return checks.groupBy("id").applyInPandasWithState(step, "id long, failures int, status string", "n int", "update", "NoTimeout")


def upserting(articles: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to the Parquet folder at `path` only articles that it does not hold; batches may be replayed, and a replayed batch adds nothing.

    An article without url_hash is known by the hash of its other columns. Of the articles with one, a batch reads only that column of the folder.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        from ..sources.sinks import exists

        spark = batch.sparkSession
        have = spark.read.parquet(path) if exists(spark, path) else batch.limit(0)
        content = F.concat(F.lit("content "), F.md5(F.to_json(F.struct(*batch.columns))))
        known = have.filter("url_hash is not null").select(F.col("url_hash").alias("_key")).unionByName(have.filter("url_hash is null").select(content.alias("_key")))
        new = batch.withColumn("_key", F.coalesce("url_hash", content))
        upsert.insert_ignore(known, new, ["_key"], F.col("id"))[1].drop("_key").write.mode("append").parquet(path)

    return articles.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
