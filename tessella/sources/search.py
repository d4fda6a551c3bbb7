"""A search service as a Spark data source; offline it answers from a file of recorded answers."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "query string, pos int, title string, url string, snippet string, published string"


class _Query(InputPartition):
    def __init__(self, queries: list[str]) -> None:
        super().__init__(0)
        self.queries = queries


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.queries = json.loads(options["queries"])
        self.path = options["answers"]
        self.parallel = int(options.get("parallel", "4"))
        self.most = int(options.get("most", "10"))

    def partitions(self) -> list[_Query]:
        n = max(1, min(self.parallel, len(self.queries)))
        return [_Query(self.queries[i::n]) for i in range(n)]

    def read(self, partition: _Query) -> Iterator[tuple]:
        wanted = set(partition.queries)
        with open(self.path, encoding="utf-8") as f:
            for line in f:
                a = json.loads(line)
                if a.get("query") in wanted:
                    for i, r in enumerate(a.get("results", [])[: self.most]):
                        yield a["query"], i + 1, r.get("title"), r.get("url"), r.get("snippet"), r.get("published")


class SearchSource(DataSource):
    """format("search"): options queries (a JSON list), answers (a JSON-lines file of {query, results}), parallel (requests at a time), most (results a query)."""

    @classmethod
    def name(cls) -> str:
        return "search"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def search(spark: SparkSession, queries: list[str], answers: str, parallel: int = 4, most: int = 10) -> DataFrame:
    """Results of the queries with a year: the stated date, else a year in the address, else in the title."""
    spark.dataSource.register(SearchSource)
    r = spark.read.format("search").options(queries=json.dumps(queries), answers=answers, parallel=str(parallel), most=str(most)).load()
    year = lambda c: F.nullif(F.regexp_extract(c, "((?:19|20)[0-9]{2})", 1), F.lit(""))
    return r.withColumn("year", F.coalesce(year("published"), year("url"), year("title")).cast("int"))


def gathered(channels: dict[str, DataFrame], text: str = "text", most: int = 2000) -> DataFrame:
    """Articles of several channels in one frame: each address once, of the first channel that has it, texts cut to `most` characters as the extractor takes them."""
    out = None
    for i, (name, df) in enumerate(channels.items()):
        x = df.select("url", F.substring(text, 1, most).alias("text"), F.lit(name).alias("channel"), F.lit(i).alias("_order")).withColumn("url_hash", F.md5("url"))
        out = x if out is None else out.unionByName(x)
    return out.groupBy("url_hash").agg(F.min_by(F.struct("url", "text", "channel"), "_order").alias("r")).select("url_hash", "r.*")


def news(results: DataFrame, as_of: str, days: int | None = None, hosts: list[str] | None = None, most: int = 10) -> DataFrame:
    """Results of search() as news: those of the last `days` before as_of (undated ones stay, by their year), of the hosts if given, the first `most` of each query, each address once."""
    x = results
    if hosts:
        x = x.filter(F.regexp_extract(F.lower("url"), "https?://(?:www\\.)?([^/]+)", 1).isin(*hosts))
    if days is not None:
        day = F.try_to_date(F.substring("published", 1, 10), "yyyy-MM-dd")
        first = F.date_sub(F.lit(as_of).cast("date"), days)
        x = x.filter(F.when(day.isNotNull(), day >= first).otherwise(F.coalesce(F.col("year") >= F.year(first), F.lit(True))))
    x = x.groupBy("query", "url").agg(F.min_by(F.struct("pos", "title", "snippet", "published", "year"), "pos").alias("r")).select("query", "url", "r.*")
    w = Window.partitionBy("query").orderBy("pos", "url")
    return x.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= most)


# The parts of a research and what is asked for each.
BUCKETS = {"about": "{name} company", "funding": "{name} funding investment round", "news": "{name} news", "people": "{name} founders team", "market": "{name} competitors market"}


def researched(spark: SparkSession, name: str, answers: str, most: int = 5) -> DataFrame:
    """(bucket, query, pos, title, url, snippet, year): five searches about one subject, each address in the first bucket that found it."""
    asked = {b: t.format(name=name) for b, t in BUCKETS.items()}
    order = spark.createDataFrame([(q, b, i) for i, (b, q) in enumerate(asked.items())], "query string, bucket string, place int")
    r = search(spark, list(asked.values()), answers, most=most).join(F.broadcast(order), "query")  # five rows
    once = r.groupBy("url").agg(F.min_by(F.struct("bucket", "query", "pos", "title", "snippet", "year"), F.struct("place", "pos")).alias("r"))
    return once.select("r.bucket", "r.query", "r.pos", "r.title", "url", "r.snippet", "r.year")


class Memo:
    """Results kept for a session by a key, until forgotten: a second look is not computed again."""

    def __init__(self) -> None:
        self.kept: dict[str, DataFrame] = {}

    def get(self, key: str, make) -> DataFrame:
        if key not in self.kept:
            self.kept[key] = make().cache()
        return self.kept[key]

    def forget(self) -> None:
        for df in self.kept.values():
            df.unpersist()
        self.kept.clear()
