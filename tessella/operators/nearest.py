"""The texts most like others at similarities so low that no index helps: every two are compared, many at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

from . import fuzzy

#: longer texts are compared one by one, if their lengths allow it
LONG = 512
#: texts that are compared with another at once, and words of bits for their letters at most
CHUNK, BITS = 8_192, 1 << 23
#: hits that wait until the best are chosen, and pairs of a query and a name that are sorted at once
HELD, SORTED = 1 << 17, 1 << 20
#: bits of a word, but the last, of a text; one more takes what an addition carries
WORD = 63


def _lcp(texts: list[str]) -> list[int]:
    """Letters that each text has in common with the one before it."""
    out = [0]
    for a, b in zip(texts, texts[1:], strict=False):
        n, most = 0, min(len(a), len(b))
        while n < most and a[n] == b[n]:
            n += 1
        out.append(n)
    return out[: len(texts)]


def _kept(lcp: list[int]) -> list[set[int]]:
    """For each text, in order, the depths behind its common part at which a later text goes on."""
    out: list[set[int]] = [set() for _ in lcp]
    ahead: list[int] = []
    for i in range(len(lcp) - 1, -1, -1):
        for v in reversed(ahead):
            if v <= lcp[i]:
                break
            out[i].add(v)
        while ahead and ahead[-1] >= lcp[i]:
            ahead.pop()
        ahead.append(lcp[i])
    return out


def _bits(texts: list[str], words: int) -> dict[str, np.ndarray]:
    """For each letter a row of bits a text, `words` of them, that tell where the letter stands."""
    every = sorted(set("".join(texts)))
    out = np.zeros((len(every), words, len(texts)), np.uint64)
    letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.searchsorted(np.array([ord(c) for c in every], np.uint32), letters)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.cumsum(size) - size
    for p in range(int(size.max())):
        on = np.flatnonzero(size > p)
        w = min(p // WORD, words - 1)
        out[code[start[on] + p], w, on] |= np.uint64(1 << (p - w * WORD))
    return dict(zip(every, out, strict=True))


def _common(queries: list[str], words: int, rows: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(row, lengths): for each row the length of the longest common subsequence with each query of up to WORD x words + 1 letters.

    Bits in parallel, as in `fuzzy._lcs`, for all queries at once. Rows go in alphabetical order, by their beginnings or their ends: what they have in common is done once.
    """
    at, back = _bits(queries, words), sorted(range(len(rows)), key=lambda i: rows[i][::-1])
    order, ends = sorted(range(len(rows)), key=rows.__getitem__), [rows[i][::-1] for i in back]
    lcp, other = _lcp([rows[i] for i in order]), _lcp(ends)
    texts = [rows[i] for i in order]
    if sum(other) > sum(lcp):
        lcp, order, texts, at = other, back, ends, _bits([q[::-1] for q in queries], words)
    kept, none = _kept(lcp), np.uint64((1 << WORD) - 1)
    s = np.full((words, len(queries)), none)
    s[-1] = np.iinfo(np.uint64).max
    u, x, carried = np.empty_like(s), np.empty_like(s), np.empty_like(s[0])
    saved, capacity, top, lower, steps = [(0, s.copy())], (words - 1) * WORD + 64, np.uint64(WORD), s[:-1], [(s[w - 1], s[w]) for w in range(1, words)]
    both, differ, add, either, shift = np.bitwise_and, np.bitwise_xor, np.add, np.bitwise_or, np.right_shift
    for row, text, begin, keep in zip(order, texts, lcp, kept, strict=True):
        while saved[-1][0] > begin:
            saved.pop()
        np.copyto(s, saved[-1][1])
        for d in range(saved[-1][0], len(text)):
            m = at.get(text[d])
            if m is not None:
                both(s, m, u)
                differ(s, u, x)
                add(s, u, s)
                for low, high in steps:
                    shift(low, top, carried)
                    add(high, carried, high)
                either(s, x, s)
                if steps:
                    both(lower, none, lower)
            if d + 1 in keep:
                saved.append((d + 1, s.copy()))
        yield row, capacity - np.bitwise_count(s).sum(axis=0, dtype=np.int64)


def _expanded(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, start[i] + 0 .. count[i] - 1) for each i."""
    return np.repeat(np.arange(len(count)), count), np.arange(count.sum()) + np.repeat(start - np.cumsum(count) + count, count)


def _first(x: np.ndarray) -> np.ndarray:
    """How many like it stand right before each of the ordered values."""
    return np.arange(len(x)) - np.searchsorted(x, x, "left")


class _Best:
    """The k best names of rows for each query: of texts that have been compared, those that no k others are better than."""

    def __init__(self, k: int, least: float, q_text: np.ndarray, q_name: np.ndarray, n: int, g_text: np.ndarray, g_name: np.ndarray, g_id: np.ndarray, m: int) -> None:
        """Queries by their text and name, of n texts; names of rows by theirs, of m texts, each with its smallest id. Both are in the order of their texts."""
        self.k, self.least, self.q_text, self.q_name, self.g_name, self.g_id = k, least, q_text, q_name, g_name, g_id
        at = lambda x, n: (np.searchsorted(x, np.arange(n), "left"), np.bincount(x, minlength=n))
        (self.q_start, self.q_count), (self.g_start, self.g_count) = at(q_text, n), at(g_text, m)
        self.score = np.full(n, float(least))  # what a text needs
        self.q, self.g, self.s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.hits, self.held = [], 0

    def add(self, texts: np.ndarray, row: int, s: np.ndarray) -> None:
        self.hits.append((texts, np.full(len(texts), row), s))
        self.held += len(texts)
        if self.held >= HELD:
            self.choose()

    def choose(self) -> None:
        if not self.hits:
            return
        t, r, s = map(np.concatenate, zip(*self.hits, strict=True))
        self.hits, self.held = [], 0
        order = np.argsort(-s, kind="stable")
        t, r, s = t[order], r[order], s[order]
        ends = np.cumsum(self.q_count[t] * self.g_count[r])
        a = 0
        while a < len(t):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SORTED, "right")))
            on = a + np.flatnonzero(s[a:b] >= self.score[t[a:b]])
            i, q = _expanded(self.q_start[t[on]], self.q_count[t[on]])
            j, g = _expanded(self.g_start[r[on]][i], self.g_count[r[on]][i])
            q, sq = q[j], s[on][i][j]
            other = self.q_name[q] != self.g_name[g]
            q, g, sq = (np.concatenate(x) for x in ((self.q, q[other]), (self.g, g[other]), (self.s, sq[other])))
            by = np.lexsort((self.g_id[g], -sq, q))
            q, g, sq = q[by], g[by], sq[by]
            rank = _first(q)
            last = rank == self.k - 1
            self.q, self.g, self.s = q[rank < self.k], g[rank < self.k], sq[rank < self.k]
            needs = np.full(len(self.q_text), float(self.least))
            needs[q[last]] = sq[last]
            self.score = np.full(len(self.score), np.inf)
            np.minimum.at(self.score, self.q_text, needs)
            a = b


def nearest(k: int, least: float, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """(h, other, score): the k rows most like each query, from `least` on, without those of its own name; ties go to the smallest id.

    queries(h, name, text), rows(name, text, ids): each name and text once, with its smallest ids, k at most, in order.
    """
    names = pd.factorize(pd.concat([queries["name"], rows["name"]]), use_na_sentinel=False)[0]
    (q_text, texts), (g_text, others) = pd.factorize(queries["text"]), pd.factorize(rows["text"])
    q_order = np.argsort(q_text, kind="stable")
    g_id = np.fromiter((x[0] for x in rows["ids"]), np.int64, len(rows))
    g_order = np.lexsort((g_id, g_text))
    g_order = g_order[_first(g_text[g_order]) <= k]  # of a text's names, k besides a query's own
    best = _Best(k, least, q_text[q_order], names[: len(queries)][q_order], len(texts), g_text[g_order], names[len(queries) :][g_order], g_id[g_order], len(others))
    sizes, other_sizes = (np.fromiter(map(len, x), np.int64, len(x)) for x in (texts, others))
    most = lambda i, j: 200.0 * np.minimum(i, j) / (i + j)
    words = np.where(sizes > LONG, 0, 1 + np.maximum(-(-(sizes - 64) // WORD), 0))
    by_size = np.argsort(sizes, kind="stable")
    for w in np.unique(words[words > 0]):
        own = by_size[words[by_size] == w]
        kinds = len(set("".join(texts[i] for i in own)))
        chunk = int(max(1, min(CHUNK, BITS // (kinds * w))))
        for a in range(0, len(own), chunk):
            some = own[a : a + chunk]
            n = sizes[some]
            near = np.clip(other_sizes, n[0], n[-1])  # the length among the queries' that fits best, at most
            fits = np.flatnonzero((most(near, other_sizes) >= least) & (other_sizes <= LONG))
            for i, lcs in _common([texts[x] for x in some], int(w), [others[x] for x in fits]):
                s = 200.0 * lcs / (n + other_sizes[fits[i]])
                on = np.flatnonzero(s >= best.score[some])
                if len(on):
                    best.add(some[on], fits[i], s[on])
    for i in range(len(texts)):
        fits = np.flatnonzero(((other_sizes > LONG) | (sizes[i] > LONG)) & (most(sizes[i], other_sizes) >= best.score[i]))
        masks = fuzzy._masks(texts[i]) if len(fits) else {}
        for j in fits:
            s = 200.0 * fuzzy._lcs(masks, int(sizes[i]), others[j]) / (sizes[i] + other_sizes[j])
            if s >= best.score[i]:
                best.add(np.array([i]), j, np.array([s]))
    best.choose()
    ids = [rows["ids"].iloc[x] for x in g_order[best.g]]
    count = np.fromiter(map(len, ids), np.int64, len(ids))
    q, s = np.repeat(best.q, count), np.repeat(best.s, count)
    other = np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64)
    by = np.lexsort((other, -s, q))
    by = by[_first(q[by]) < k]
    return pd.DataFrame({"h": queries["h"].to_numpy()[q_order[q[by]]], "other": other[by], "score": s[by]})
