"""Fetched pages and search results as frames; fetching itself is behind a protocol with an offline stub."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKIPPED = {"script", "style", "noscript"}


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in SKIPPED
        self.out.append(" ")

    def handle_endtag(self, tag):
        self.depth = max(0, self.depth - (tag in SKIPPED))
        self.out.append(" ")

    def handle_data(self, data):
        if not self.depth:
            self.out.append(data)


def html_text(html: str | None, most: int | None = 3000) -> str | None:
    """The text of a page without scripts and styles, blanks collapsed, cut to `most` characters as the ingest wants it (None keeps all)."""
    if html is None:
        return None
    p = _Text()
    p.feed(html)
    p.close()
    return " ".join("".join(p.out).split())[:most]


def page_texts(pages: DataFrame, html: str = "html", most: int | None = None) -> DataFrame:
    """pages with a column `page_text`; null pages stay null."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield p.assign(page_text=[html_text(x, most) for x in p[html]])

    return pages.mapInPandas(run, _ddl(pages) + ", page_text string")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes)


def parse_results(raw: DataFrame, text: str = "raw") -> DataFrame:
    """(url, title, snippet) of each block of a search answer that has an address; blocks are parted by empty lines."""
    blocks = raw.select(F.explode(F.split(text, "\n\n")).alias("b"))
    line = lambda name: F.regexp_extract("b", f"(?m)^{name}: (.*)$", 1).alias(name.lower())
    return blocks.select(line("Url"), line("Title"), line("Snippet")).filter("url <> ''")


def is_dead(html: Column, year: int = 2026) -> Column:
    """A page that offers its domain for sale, or whose copyright is three years old or more."""
    low = F.lower(html)
    stated = F.nullif(F.regexp_extract(low, "(?:©|&copy;|copyright)\\s*(?:\\d{4}\\s*[-–]\\s*)?(20\\d{2})", 1), F.lit("")).cast("int")
    return F.coalesce(low.rlike("domain (?:is )?for sale|buy this domain|satılık domain"), F.lit(False)) | F.coalesce(stated <= year - 3, F.lit(False))


def fresh(cache: DataFrame, as_of: Column, hours: int) -> DataFrame:
    """Entries of a cache(key, cached_at, value) that are younger than `hours`, the newest of each key."""
    young = cache.filter(F.col("cached_at") >= as_of - F.make_dt_interval(hours=F.lit(hours)))
    return young.groupBy("key").agg(F.max_by("value", "cached_at").alias("value"), F.max("cached_at").alias("cached_at"))


def cache_key(prefix: str, *parts: Column) -> Column:
    return F.md5(F.concat_ws("::", F.lit(prefix), *parts))


class Extractor(Protocol):
    """What turns texts into structured facts: a model, a service, or a stub."""

    def extract(self, texts: Iterable[str]) -> list[dict]: ...


class Stub:
    """An offline extractor: the same empty facts for every text."""

    def extract(self, texts: Iterable[str]) -> list[dict]:
        return [{"headline": (t or "")[:80], "companies": [], "event_category": "general"} for t in texts]


def extracted(docs: DataFrame, extractor: Extractor, key: str, text: str, parallel: int) -> DataFrame:
    """(key, headline, companies, event_category) of each text, by an extractor in `parallel` tasks at a time; filter before this: it is the expensive step."""
    types = dict(docs.dtypes)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            facts = extractor.extract(p[text].tolist())
            yield pd.DataFrame({key: p[key].tolist(), "headline": [f.get("headline") for f in facts], "companies": [list(f.get("companies") or []) for f in facts], "event_category": [f.get("event_category") for f in facts]})

    return docs.select(key, text).repartition(parallel).mapInPandas(run, f"{key} {types[key]}, headline string, companies array<string>, event_category string")


def json_in(text: str) -> dict | None:
    """The first balanced object in an answer, code fences and chatter aside; None if there is none."""
    import json

    for i, ch in enumerate(text):
        if ch != "{":
            continue
        depth, quoted, skip = 0, False, False
        for j in range(i, len(text)):
            c = text[j]
            if skip:
                skip = False
            elif c == "\\":
                skip = quoted
            elif c == '"':
                quoted = not quoted
            elif not quoted:
                depth += (c == "{") - (c == "}")
                if depth == 0:
                    try:
                        return json.loads(text[i : j + 1])
                    except ValueError:
                        break
    return None
