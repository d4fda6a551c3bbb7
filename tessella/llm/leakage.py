"""Evaluation texts that stand in training documents."""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: consecutive words that make a leak
RUN = 12
#: words of a document's passage at most; passages overlap by RUN - 1 words, so each run lies in one of them
PASSAGE = 36
#: items a block
BLOCK = 16
K1, B = 1.2, 0.75
#: items of one index, which goes with every task; more items are indexed in shards, each of which reads the documents
SHARD = 50_000
#: cells (passage and block, or passage and item) that are scored at once
CELLS = 1 << 22
EPS = 1e-9


@cache
def _marks() -> re.Pattern:
    """All combining marks, as ranges."""
    spans: list[list[int]] = []
    for c in range(0x300, sys.maxunicode + 1):
        if unicodedata.combining(chr(c)):
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in spans) + "]+")


WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Unbroken runs of letters or digits; letter case, accents and the dot of i are ignored."""
    if not text:
        return []
    if text.isascii():
        return WORD.findall(text.lower())
    s = unicodedata.normalize("NFKD", text.replace("ı", "i").replace("İ", "i"))
    return WORD.findall(_marks().sub("", s).casefold())


@dataclass
class Index:
    """A BM25 inverted index of items: per term its items with scores, and its blocks of BLOCK items with their largest score.

    least is the least score of any run of an item, floor the least of these in a block. Postings of all terms lie one after
    the other, those of term t from start[t] to start[t + 1].
    """

    ids: list[int] = field(default_factory=list)
    terms: dict[str, int] = field(default_factory=dict)
    start: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    item: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    score: np.ndarray = field(default_factory=lambda: np.zeros(0))
    block_start: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    block: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    top: np.ndarray = field(default_factory=lambda: np.zeros(0))
    least: np.ndarray = field(default_factory=lambda: np.zeros(0))
    floor: np.ndarray = field(default_factory=lambda: np.zeros(0))
    runs: dict[int, set[tuple[int, ...]]] = field(default_factory=dict)


def build(items: list[tuple[int, str]], run: int = RUN) -> Index:
    """Items with fewer than `run` words can leak nothing and are left out."""
    ix = Index()
    docs = [(i, w) for i, t in sorted(items) if len(w := words(t)) >= run]
    if not docs:
        return ix
    mean = sum(len(w) for _, w in docs) / len(docs)
    df: dict[str, int] = defaultdict(int)
    for _, w in docs:
        for t in set(w):
            df[t] += 1
    n = len(docs)
    ix.terms = {t: k for k, t in enumerate(sorted(df))}
    postings: list[list[tuple[int, float]]] = [[] for _ in ix.terms]
    for k, (i, w) in enumerate(docs):
        tf: dict[str, int] = defaultdict(int)
        for t in w:
            tf[t] += 1
        score = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(w) / mean)) for t, c in tf.items()}
        for t, s in score.items():
            postings[ix.terms[t]].append((k, s))
        ix.ids.append(i)
        ix.runs[k] = {tuple(ix.terms[t] for t in w[j : j + run]) for j in range(len(w) - run + 1)}
        ix.least = np.append(ix.least, min(sum(score[t] for t in set(w[j : j + run])) for j in range(len(w) - run + 1)))
    blocks = []
    for p in postings:
        best: dict[int, float] = {}
        for k, s in p:
            best[k // BLOCK] = max(s, best.get(k // BLOCK, 0.0))
        blocks.append(sorted(best.items()))
    ix.start, ix.item, ix.score = _flat(postings)
    ix.block_start, ix.block, ix.top = _flat(blocks)
    ix.floor = np.minimum.reduceat(ix.least, np.arange(0, n, BLOCK))
    return ix


def _flat(lists: list[list[tuple[int, float]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.concatenate([[0], np.cumsum([len(x) for x in lists])]), np.array([k for x in lists for k, _ in x], np.int64), np.array([s for x in lists for _, s in x])


def _sums(query: np.ndarray, term: np.ndarray, n: int, start: np.ndarray, place: np.ndarray, value: np.ndarray, width: int, bar: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) of all sums of the terms' values per query and place that reach the bar of the place; queries 0 to n - 1 in order, in batches of CELLS."""
    out_q, out_p = [], []
    per = max(1, CELLS // max(width, 1))
    edges = np.searchsorted(query, np.arange(0, n + per, per))
    for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if lo == hi:
            continue
        q, t = query[lo:hi] - b * per, term[lo:hi]
        size = start[t + 1] - start[t]
        total = int(size.sum())
        at = np.repeat(start[t] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(total)
        rows = min(per, n - b * per)
        sums = np.bincount(np.repeat(q, size) * width + place[at], value[at], rows * width).reshape(rows, width)
        hit_q, hit_p = np.nonzero(sums >= bar - EPS)
        out_q.append(hit_q + b * per)
        out_p.append(hit_p)
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_q), np.concatenate(out_p)) if out_q else (none, none)


def search(ix: Index, query: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, item) of all items whose BM25 score for a query reaches their own least run score, by block-max WAND over a batch of queries.

    query, term: the words of queries 0 to n - 1, in order of the queries. First the block maxima of a query's words are summed per block of items;
    blocks whose bound stays below the least threshold of their items are passed over. Queries with a block left are
    scored in full. A passage that holds a run of an item holds all its words, so no leak scores less: nothing is lost.
    """
    q, _ = _sums(query, term, n, ix.block_start, ix.block, ix.top, len(ix.floor), ix.floor)  # repeated words only raise a bound
    left = np.unique(q)
    if not len(left):
        return left, left
    keep = np.isin(query, left)
    pairs = np.unique(np.searchsorted(left, query[keep]) * len(ix.terms) + term[keep])
    q, item = _sums(pairs // len(ix.terms), pairs % len(ix.terms), len(left), ix.start, ix.item, ix.score, len(ix.ids), ix.least)
    return left[q], item


def leaks_of(ix: Index, texts: list[str | None], run: int = RUN) -> list[tuple[int, int, int]]:
    """(place of the text, item id, number of its runs that the text holds) of each item that leaks. Every passage of every text is a query."""
    if not ix.ids:
        return []
    ids = [np.array([ix.terms.get(t, -1) for t in words(x)], np.int64) for x in texts]
    step = PASSAGE - run + 1
    starts = [np.arange(0, len(w) - run + 1, step) for w in ids]
    doc = np.repeat(np.arange(len(ids)), [len(s) for s in starts])
    if not len(doc):
        return []
    offset = np.concatenate([[0], np.cumsum([len(w) for w in ids])])
    every = np.concatenate(ids)
    begin = np.concatenate(starts) + offset[doc]
    size = np.minimum(begin + PASSAGE, offset[doc + 1]) - begin
    query = np.repeat(np.arange(len(doc)), size)
    term = every[np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))]
    known = term >= 0
    found: dict[tuple[int, int], set] = defaultdict(set)
    have, of = set(), -1
    for q, item in zip(*(x.tolist() for x in search(ix, query[known], term[known], len(doc))), strict=True):
        if q != of:
            passage = every[begin[q] : begin[q] + size[q]].tolist()
            have, of = {tuple(passage[i : i + run]) for i in range(len(passage) - run + 1)}, q
        if both := have & ix.runs[item]:
            found[int(doc[q]), item] |= both
    return [(d, ix.ids[k], len(r)) for (d, k), r in found.items()]


def leaks(docs: DataFrame, items: DataFrame, run: int = RUN, shard: int = SHARD) -> DataFrame:
    """(doc_id, item_id, n_runs): each document of docs(doc_id, text) with each item of items(item_id, text) of which it holds `run` consecutive words.

    n_runs counts the item's different runs that stand in the document. The items, a held-out list, are indexed in
    shards of some `shard` items by a hash of their id; a shard's index goes with the tasks, and each shard reads the documents once,
    without a shuffle. Null, empty and short texts leak nothing; whole texts are searched, however long; repeated rows
    give repeated results.
    """
    sc = docs.sparkSession.sparkContext
    shards = max(1, math.ceil(items.count() / shard))

    def found(part: int) -> DataFrame:
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == part).select("item_id", "text").collect()
        ix = sc.broadcast(build([(r.item_id, r.text) for r in rows], run))

        def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for whole in parts:
                for at in range(0, len(whole), 500):  # a bounded number of texts at a time
                    p = whole.iloc[at : at + 500]
                    out = leaks_of(ix.value, p["text"].tolist(), run)
                    ids = p["doc_id"].to_numpy()
                    yield pd.DataFrame({"doc_id": ids[[d for d, _, _ in out]], "item_id": [i for _, i, _ in out], "n_runs": [n for _, _, n in out]})

        return docs.select("doc_id", "text").mapInPandas(find, "doc_id bigint, item_id bigint, n_runs int")

    return reduce(DataFrame.unionByName, [found(k) for k in range(shards)])
