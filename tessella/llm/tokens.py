"""Encoding of a whole corpus with a public tokenizer, each content-defined chunk once."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, looked_up

FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: fixed value: the published split of text into pieces that are encoded one by one
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: a cut where the rolling hash of the last WINDOW characters ends in BITS zero bits, at the ends of words; from LONGEST on at any piece
WINDOW, BITS, LONGEST = 16, 4, 2048
BASE = np.uint64(0x9E3779B97F4A7C15)


@cache
def encoder(path: str):
    """The tokenizer of a file of ranks; once per worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


@cache
def _blanks() -> np.ndarray:
    return np.array([chr(c).isspace() for c in range(0x3001)])


POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the powers 0 to n - 1, and those of its inverse modulo 2 ** 64; kept for texts of up to a million characters."""
    if len(POWERS[0]) < n:
        size = max(n, 4096)
        bases = (int(BASE), pow(int(BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            made = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]), dtype=np.uint64) for b in bases]
        if size > 1_000_000:
            return made[0], made[1]
        POWERS[:] = made
    return POWERS[0], POWERS[1]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def rolling(text: str) -> np.ndarray:
    """The polynomial hash of the WINDOW characters that end at each place, as a difference of running sums."""
    c = codes(text).astype(np.uint64)
    n = len(c)
    up, down = _powers(n)
    with np.errstate(over="ignore"):
        sums = np.cumsum(c * down[:n], dtype=np.uint64)
        h = sums.copy()
        h[WINDOW:] -= sums[:-WINDOW]
        h *= up[:n]
    return h ^ (h >> np.uint64(29))


def cuts(text: str) -> list[int]:
    """Places to cut: at a blank after a non-blank where the hash says so, or at any such place or piece of a run beyond LONGEST."""
    n = len(text)
    if n < WINDOW:
        return []
    h = rolling(text)
    c = codes(text)
    blank = _blanks()[np.minimum(c, 0x3000)] & (c <= 0x3000)
    ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    chosen = ends[(h[ends - 1] & np.uint64((1 << BITS) - 1)) == 0].tolist()
    if n <= LONGEST:
        return chosen
    out, last = [], 0
    for at in [*chosen, n]:
        while at - last > LONGEST:
            i = int(np.searchsorted(ends, last + LONGEST, "right")) - 1
            if i >= 0 and ends[i] > last:
                nxt = int(ends[i])
            else:  # a run without blanks: the first piece that ends beyond
                nxt = next((m.end() for m in regex.finditer(PIECES, text, pos=last) if m.end() - last >= LONGEST), n)
            if nxt >= at:
                break
            out.append(nxt)
            last = nxt
        if at < n:
            out.append(at)
            last = at
    return out


@lru_cache(maxsize=20_000)
def _agrees(path: str, left: str, right: str) -> bool:
    e = encoder(path)
    return e.encode_ordinary(left + right) == e.encode_ordinary(left) + e.encode_ordinary(right)


def chunks(text: str, path: str) -> list[str]:
    """The text in chunks whose encodings, put together, are the encoding of the text.

    Each join is tried by encoding the words around it in one piece and apart; where that differs, the two chunks are
    encoded anew as one, until all joins agree.
    """
    out: list[str] = []
    last = 0
    for at in [*cuts(text), len(text)]:
        piece = text[last:at]
        last = at
        if not piece:
            continue
        if out:
            left = out[-1][-48:]
            left = left[left.rfind(" ") if left.rfind(" ") > 0 else 0 :]
            right = piece[:49]
            right = right[: right.find(" ", 1) if right.find(" ", 1) > 0 else len(right)]
            if not _agrees(path, left, right):
                out[-1] += piece
                continue
        out.append(piece)
    return out


def _few(parts: Iterator[pd.DataFrame], n: int) -> Iterator[pd.DataFrame]:
    """The rows n at a time: what a worker holds does not grow with the size of a batch."""
    for p in parts:
        for at in range(0, len(p), n):
            yield p.iloc[at : at + n]


def encoded(docs: DataFrame, path: str = f"{FOLDER}/{VOCABULARY}") -> DataFrame:
    """(doc_id, ids) for each row of docs(doc_id, text): the ids of the text without special tokens.

    Null and empty texts have an empty list; their strings of special tokens are ordinary text; a repeated row gives a
    repeated row. Chunks that several documents share are encoded once: of a thousand documents each chunk's text is
    shuffled once, and a chunk of very many documents is spread over sub-keys where it meets its places. Lone surrogates are encoded as U+FFFD.
    """
    # 128 bits: two documents never share a key
    key = F.when(F.length("text") > 0, F.unhex(F.md5(F.concat_ws("\u0001", F.col("doc_id").cast("string"), "text"))))
    keyed = docs.select("doc_id", key.alias("k"), "text")

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in _few(parts, 1000):
            known: dict[str, bytes] = {}
            hs, texts, ks, places = [], [], [], []
            for k, text in zip(p["k"], p["text"], strict=True):
                for pos, c in enumerate(chunks(text, path)):
                    h = known.get(c)
                    texts.append(None if h else c)
                    if not h:
                        h = known[c] = xxhash.xxh3_128_digest(c.encode("utf-8", "surrogatepass"))
                    hs.append(h)
                    ks.append(k)
                    places.append(pos)
            yield pd.DataFrame({"h": hs, "chunk": texts, "k": ks, "pos": np.array(places, np.int32)})

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(path)
        for p in _few(parts, 2000):
            yield pd.DataFrame({"h": p["h"], "ids": [np.array(e.encode_ordinary(c), dtype=np.int32) for c in p["chunk"]]})

    cut_up = checkpointed(keyed.filter("k is not null").select("k", "text").mapInPandas(cut, "h binary, chunk string, k binary, pos int"))
    once = cut_up.filter("chunk is not null").groupBy("h").agg(F.first("chunk").alias("chunk")).mapInPandas(encode, "h binary, ids array<int>")
    pieces = looked_up(cut_up.select("h", "k", "pos"), "k", once, ["h"]).select("k", F.struct("pos", "ids").alias("piece"))
    whole = pieces.groupBy("k").agg(F.flatten(F.transform(F.array_sort(F.array_distinct(F.collect_list("piece"))), lambda x: x["ids"])).alias("ids"))
    return keyed.select("doc_id", "k").join(whole.hint("merge"), "k", "left").select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
