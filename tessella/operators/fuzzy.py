"""Fuzzy name joins with lossless candidate search: token-sort and partial similarity."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from functools import partial as partial_of

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import small, without_suffix
from ..session import checkpointed


def _masks(a: str) -> dict[str, int]:
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    return at


def _lcs(at: dict[str, int], n: int, b: str) -> int:
    """Length of the longest common subsequence of a text of n characters, given by its masks, and b; bits in parallel."""
    full = s = (1 << n) - 1
    for ch in b:
        u = s & at.get(ch, 0)
        s = ((s + u) | (s - u)) & full
    return n - s.bit_count()


def lcs(a: str, b: str) -> int:
    return _lcs(_masks(a), len(a), b)


def ratio(a: str, b: str) -> float:
    """100 x 2 LCS / (lengths): 100 for two empty texts."""
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def partial(a: str, b: str) -> float:
    """The best ratio of the shorter text with a window of the longer, cut-off windows at its ends included."""
    if len(a) > len(b):
        a, b = b, a
    m = len(a)
    if not m:
        return 100.0 if not b else 0.0
    if a in b:
        return 100.0
    at, best = _masks(a), 0.0
    for i in range(1 - m, len(b)):
        w = b[max(0, i) : i + m]
        if 200.0 * min(m, len(w)) / (m + len(w)) > best and (w[0] in at or w[-1] in at):
            best = max(best, 200.0 * _lcs(at, m, w) / (m + len(w)))
    return best


@F.pandas_udf(T.DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """0-100; null if either is."""
    return pd.Series([None if x is None or y is None else token_sort(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else partial(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


#: what `str.split` takes for blanks
BLANKS = "[\\s\\x1c-\\x1f\\x85\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"


def sorted_tokens(c: Column) -> Column:
    """As `token_sort` sees it."""
    return F.array_join(F.array_sort(F.filter(F.split(c, BLANKS), lambda w: w != "")), " ")


#: letters of a piece at most, where it may stand anywhere
PIECE = 6
#: longer whole texts of up to so many letters meet by pieces at their places
PLACED = 64
#: similarity of whole texts below which pieces are so short that most texts share one: texts of any length are then compared without pieces
SHORT = 85
#: texts of a block at most; a table of SPREAD times FEW texts or more has SPREAD blocks at least
BLOCK, SPREAD, FEW = 32_768, 4, 4_096
#: pairs that a task holds at once, before they are filtered
CHUNK = 1 << 18
#: whole texts of up to so many letters are compared without pieces, each two by bits; longer ones have so many letters in common that pieces tell more
SCANNED = 48
#: from so many repeats of a letter on they are not told apart
REPEATS = 8
#: odd, so that the hash of a piece takes in all its letters
BASE = 0x9E3779B97F4A7C15


def _edits(n: int, m: int, t: float) -> int:
    """The most insertions and deletions between texts of n and m letters that are alike by t, -1 if no such texts are: as odd or even as the lengths' difference."""
    d = int((n + m) * (1 - t) + 1e-9)
    d -= (d - n + m) % 2
    return d if d >= abs(n - m) else -1


def _placed(t: float, cut: bool, alike: bool) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """(n, [(key, start, size)]): where a text of n letters has its pieces if it is the longer (cut), or those of a longer one may stand in it (not cut); alike: also of texts as long.

    The longer text is cut into one piece more than there are edits. Of the pieces there is a first one with fewer edits in it
    and before it than it and those before it are. It has none, the k pieces before it have k, and no more than the rest is behind it. So
    it moves by k places at most, by an odd number if k is odd, and the edits behind it make up for what is left of the difference in length.
    """
    out: dict[int, list[tuple[int, int, int]]] = {n: [] for n in range(1, PLACED + 1)}
    for n in range(1, PLACED + 1):
        for m in range(1, n + alike):
            d = _edits(n, m, t)
            for k in range(d + 1):
                key, start = (n * (PLACED + 1) + m) * (2 * PLACED + 1) + k, k * n // (d + 1)
                size = (k + 1) * n // (d + 1) - start
                if cut:
                    out[n].append((key, start, size))
                else:
                    out[m] += [(key, start + v, size) for v in range(-k, k + 1, 2) if abs(m - n - v) <= d - k and 0 <= start + v <= m - size]
    return list(out.items())


@cache
def _places(t: float) -> dict[tuple[int, int], list[tuple[int, int, list[int]]]]:
    """(n, m): [(start, size, starts)]: the pieces of a text of n letters, and where in one of m letters each may stand."""
    cut = {key: (n, start, size) for n, v in _placed(t, True, True) for key, start, size in v}
    out: dict[tuple[int, int], dict[int, tuple[int, int, list[int]]]] = {}
    for m, v in _placed(t, False, True):
        for key, p, _ in v:
            n, start, size = cut[key]
            out.setdefault((n, m), {}).setdefault(key, (start, size, []))[2].append(p)
    return {nm: list(v.values()) for nm, v in out.items()}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)


class _Texts:
    """Texts in the order of their lengths: all letters in one array, and bits that tell which letters (repeats told apart) and pairs of letters each has.

    A bit of `twos` stands for one hash, one of `ones` for what `_told` gives it to: of two texts, no more bits differ than letters or pairs do.
    """

    def __init__(self, texts: list[str]) -> None:
        x = sorted(texts, key=len)
        self.x, self.n = np.array(x, object), np.fromiter(map(len, x), np.int64, len(x))
        self.at = np.concatenate([[0], np.cumsum(self.n)])
        self.letters = np.frombuffer("".join(x).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths, first = np.unique(self.n, return_index=True)
        self.span = {int(n): (int(a), int(b)) for n, a, b in zip(lengths, first, [*first[1:], len(x)], strict=True)}
        self.ones, self.twos, self.hashes = np.zeros(len(x), np.uint64), np.zeros((4, len(x)), np.uint64), {}
        for n, (a, b) in self.span.items():
            w = self.of(n, self.letters).astype(np.uint64)
            for k in range(n - 1):
                h = _mixed(w[:, k] * np.uint64(BASE) + w[:, k + 1])
                for y in range(4):
                    self.twos[y, a:b] |= np.where(h & np.uint64(3) == y, np.uint64(1) << (h >> np.uint64(58)), np.uint64(0))

    def of(self, n: int, letters: np.ndarray) -> np.ndarray:
        """A row of letters for each text of n letters."""
        a, b = self.span[n]
        return letters[self.at[a] : self.at[b]].reshape(b - a, n)

    def pieces(self, n: int, p: int, q: int) -> np.ndarray:
        """Hashes of the q letters from p on of the texts of n letters."""
        if n not in self.hashes:
            w = self.of(n, self.letters).astype(np.uint64) + np.uint64(1)
            h = np.zeros((n + 1, len(w)), np.uint64)
            for k in range(n):
                h[k + 1] = h[k] * np.uint64(BASE) + w[:, k]
            self.hashes[n] = h
        h = self.hashes[n]
        return h[p + q] - h[p] * np.uint64(pow(BASE, q, 1 << 64))

    def lost(self, i: np.ndarray, other: _Texts, j: np.ndarray) -> np.ndarray:
        """How many pairs of letters of texts i the other texts j lack, at least."""
        return sum(np.bitwise_count(a[i] & ~b[j]) for a, b in zip(self.twos, other.twos, strict=True))


def _told(c: _Texts, s: _Texts) -> tuple[np.ndarray, np.ndarray]:
    """Sets the bits of the letters of both, and gives their letters as numbers below 64. The 63 most frequent letters are told apart; of letters and their repeats, those that part the most texts have bits of their own, all others share eight."""
    letters, count = np.unique(np.concatenate([c.letters, s.letters]), return_counts=True)
    code = np.full(len(letters), 63, np.uint8)
    often = np.argsort(-count, kind="stable")[:63]
    code[often] = np.arange(len(often))
    codes = tuple(code[np.searchsorted(letters, x.letters)] for x in (c, s))
    seen, keys = np.zeros(64 * REPEATS, np.int64), []
    for x, own in zip((c, s), codes, strict=True):
        for n, (a, b) in x.span.items():
            w, repeats = np.sort(x.of(n, own), axis=1), np.zeros((b - a, n), np.int64)
            for k in range(1, n):
                repeats[:, k] = np.where(w[:, k] == w[:, k - 1], np.minimum(repeats[:, k - 1] + 1, REPEATS - 1), 0)
            keys.append((x, a, b, w * np.int64(REPEATS) + repeats))
            seen += np.bincount(keys[-1][3].ravel(), minlength=len(seen))
    bit = np.arange(len(seen), dtype=np.uint64) % np.uint64(8)
    most = len(c.x) + len(s.x)
    bit[np.argsort(-seen * np.maximum(most - seen, 0), kind="stable")[:56]] = np.arange(8, 64, dtype=np.uint64)
    for x, a, b, v in keys:
        x.ones[a:b] = np.bitwise_or.reduce(np.uint64(1) << bit[v], axis=1)
    return codes


def _met(c: np.ndarray, s: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (i, j) with c[i] = s[j], some CHUNK at a time; s is in order."""
    first = np.searchsorted(s, c, "left")
    count = np.searchsorted(s, c, "right") - first
    some = np.flatnonzero(count)
    first, count = first[some], count[some]
    ends, a = np.cumsum(count), 0
    while a < len(some):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK, "right")))
        k = count[a:b]
        yield np.repeat(some[a:b], k), np.arange(k.sum()) + np.repeat(first[a:b] - np.cumsum(k) + k, k)
        a = b


class _Search:
    """The pairs of texts of c, which are cut, and of s, which hold a piece; alike: also of texts as long."""

    def __init__(self, c: _Texts, s: _Texts, codes: tuple[np.ndarray, np.ndarray], t: float, alike: bool) -> None:
        self.c, self.s, self.t, self.alike, self.indexed = c, s, t, alike, {}
        self.c_codes, self.s_codes = codes

    def _fit(self, n: int, i: np.ndarray, start: np.ndarray, length: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Which of the texts i of n letters, 64 at most, have a common subsequence of `least` letters with those from start on. Bits in parallel, as in `_lcs`; a pair is dropped as soon as the rest cannot make up for what is missing."""
        some, i = np.unique(i, return_inverse=True)
        w = self.c.of(n, self.c_codes)[some]
        masks = np.zeros(len(w) * 64, np.uint64)
        for k in range(n):
            masks[np.arange(len(w)) * 64 + w[:, k]] |= np.uint64(1 << k)
        full, out = np.uint64((1 << n) - 1), []
        for x in range(0, len(i), CHUNK):
            at = slice(x, x + CHUNK)
            kept, row, begin, size, need = np.arange(x, min(x + CHUNK, len(i))), i[at] * 64, start[at], length[at], least[at]
            s = np.full(len(kept), full)
            for k in range(int(size.max())):
                if k % 4 == 3:
                    on = n - np.bitwise_count(s).astype(np.int64) + np.maximum(size - k, 0) >= need
                    if np.count_nonzero(on) < 0.8 * len(on):
                        kept, row, begin, size, need, s = (v[on] for v in (kept, row, begin, size, need, s))
                u = s & np.where(k < size, masks[row + self.s_codes[np.where(k < size, begin + k, 0)]], np.uint64(0))
                s = ((s + u) | (s - u)) & full
            out.append(kept[n - np.bitwise_count(s).astype(np.int64) >= need])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def _near(self, n: int, m: int, d: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the texts i and j (numbers in all of c and s), of n and m letters, that d edits leave: by letters, then by pairs of letters, of which a lost letter spoils two and a new one spoils one."""
        on = np.bitwise_count(self.c.ones[i] ^ self.s.ones[j]) <= d
        i, j = i[on], j[on]
        on = self.c.lost(i, self.s, j) <= (3 * d + n - m) // 2
        return i[on], j[on]

    def _reach(self, n: int) -> list[tuple[int, int, int, int]]:
        """(m, first, last, edits) of the lengths m that texts of n letters or less have if they are alike."""
        every = ((m, e, f, _edits(n, m, self.t)) for m, (e, f) in self.s.span.items() if m < n or (m == n and self.alike))
        return [x for x in every if x[3] >= 0]

    def _scanned(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The texts of n letters and others of as many or less, each two compared by their bits of letters, some CHUNK at a time."""
        a, b = self.c.span[n]
        found, held, reach = [], 0, self._reach(n)
        if not reach:
            return
        e, f = reach[0][1], reach[-1][2]  # lengths within reach follow each other
        most = np.repeat(np.array([min(d, 64) for *_, d in reach], np.uint8), [last - first for _, first, last, _ in reach])
        rows = max(1, min(b - a, CHUNK // (f - e)))
        differ, count, on = np.empty((rows, f - e), np.uint64), np.empty((rows, f - e), np.uint8), np.zeros((rows, -(-(f - e) // 8) * 8), bool)
        for x in range(a, b, rows):
            k = min(rows, b - x)
            np.bitwise_xor(self.c.ones[x : x + k, None], self.s.ones[e:f], out=differ[:k])
            np.bitwise_count(differ[:k], out=count[:k])
            np.less_equal(count[:k], most, out=on[:k, : f - e])
            eight = np.flatnonzero(on[:k].view(np.uint64))  # few are near: eight at a time are passed over
            which, at = np.nonzero(on[:k].reshape(-1, 8)[eight])
            i, j = np.divmod(eight[which] * 8 + at, on.shape[1])
            found.append((x + i, e + j))
            held += len(i)
            if held >= CHUNK:
                yield tuple(map(np.concatenate, zip(*found, strict=True)))
                found, held = [], 0
        if found:
            yield tuple(map(np.concatenate, zip(*found, strict=True)))

    def whole(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Texts of n letters and others of as many or less, one by one."""
        a = self.c.span[n][0]
        for i, j in self._scanned(n):
            m = self.s.n[j]
            d = ((n + m) * (1 - self.t) + 1e-9).astype(np.int64)
            d -= (d - n + m) % 2
            on = self.c.lost(i, self.s, j) <= (3 * d + n - m) // 2
            i, j, m, d = i[on], j[on], m[on], d[on]
            if n <= 64 and len(i):
                on = self._fit(n, i - a, self.s.at[j], m, (n + m - d + 1) // 2)
                i, j = i[on], j[on]
            yield i, j

    def placed(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Texts of n letters and others of as many or less, by pieces at their places."""
        a = self.c.span[n][0]
        for m, e, f, d in self._reach(n):
            found = []
            for start, size, starts in _places(self.t).get((n, m), []):
                g = np.concatenate([self.s.pieces(m, p, size) for p in starts])
                order = np.argsort(g)
                for i, j in _met(self.c.pieces(n, start, size), g[order]):
                    i, j = self._near(n, m, d, a + i, e + order[j] % (f - e))
                    found.append((i - a) * (f - e) + j - e)
            i, j = np.divmod(np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64), f - e)
            if n <= 64 and len(i):
                on = self._fit(n, i, self.s.at[e + j], np.full(len(j), m), np.full(len(j), (n + m - d + 1) // 2))
                i, j = i[on], j[on]
            yield a + i, e + j

    def _pieces(self, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all pieces of q letters of s the hash, in order, the text and the place."""
        if q not in self.indexed:
            every = [(self.s.pieces(m, p, q), np.arange(e, f, dtype=np.int32), np.full(f - e, p, np.int32)) for m, (e, f) in self.s.span.items() for p in range(m - q + 1)]
            g, row, at = (np.concatenate(x) for x in zip(*every, strict=True)) if every else (np.zeros(0, k) for k in (np.uint64, np.int32, np.int32))
            order = np.argsort(g)
            self.indexed[q] = g[order], row[order], at[order]
        return self.indexed[q]

    def anywhere(self, n: int, whole: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Texts of n letters and others, of as many or less (whole) or more, that hold one of their pieces anywhere."""
        a = self.c.span[n][0]
        d = int(2 * n * (1 - self.t) + 1e-9)
        lost = int(n * (2 - 2 * self.t) / (2 - self.t) + 1e-9)  # letters of the shorter text that no window needs to have
        found = []
        for k in range(d + 1):
            start = k * n // (d + 1)
            size = min(PIECE, (k + 1) * n // (d + 1) - start)
            g, row, at = self._pieces(size)
            for i, j in _met(self.c.pieces(n, start, size), g):
                i, r, p = a + i, row[j].astype(np.int64), at[j] - start
                m = self.s.n[r]
                if whole:
                    most = np.floor((n + m) * (1 - self.t) + 1e-9)
                    on = ((m <= n) if self.alike else (m < n)) & (n - m <= most) & (np.bitwise_count(self.c.ones[i] ^ self.s.ones[r]) <= most)
                else:
                    on = ((m >= n) if self.alike else (m > n)) & (np.bitwise_count(self.c.ones[i] & ~self.s.ones[r]) <= lost)
                i, r, p = i[on], r[on], p[on]
                on = self.c.lost(i, self.s, r) <= (2 * d if whole else d + lost)
                found.append((i[on], r[on], p[on]))
        if not found:
            return
        i, r, moved = (np.concatenate(x) for x in zip(*found, strict=True))
        if n <= 64 and not whole and len(i):
            first, last = np.maximum(moved - d, 0), np.minimum(moved + n + d, self.s.n[r])  # the window lies about the piece
            on = self._fit(n, i - a, self.s.at[r] + first, last - first, np.full(len(i), n - lost))
            i, r = i[on], r[on]
        yield np.divmod(np.unique(i * len(self.s.x) + r), len(self.s.x))

    def found(self, whole: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for n in self.c.span:
            if not whole or (n > PLACED and 100 * self.t >= SHORT):
                yield from self.anywhere(n, whole)
            elif n > SCANNED and 100 * self.t >= SHORT:
                yield from self.placed(n)
            else:
                yield from self.whole(n)


def _pairs_of(l: _Texts, r: _Texts, least: float, whole: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of the texts l and r, all (i, j) that can reach the similarity."""
    codes = _told(l, r)
    # of texts of the same length the right one is the longer, and the left one the shorter
    yield from _Search(l, r, codes, least / 100.0, not whole).found(whole)
    for j, i in _Search(r, l, codes[::-1], least / 100.0, whole).found(whole):
        yield i, j


def _compared(least: float, whole: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ls, rs in zip(batch.column("ls"), batch.column("rs"), strict=True):
            l, r = _Texts(ls.as_py()), _Texts(rs.as_py())
            for i, j in _pairs_of(l, r, least, whole):
                yield pa.RecordBatch.from_arrays([pa.array(l.x[i], pa.string()), pa.array(r.x[j], pa.string())], ["l", "r"])


def candidates(left: DataFrame, right: DataFrame, least: float, whole: bool = True) -> DataFrame:
    """(l, r): distinct pairs of left(l) and right(r) texts that can reach the similarity.

    A similarity of t allows d = (a + b)(1 - t / 100) insertions and deletions, each of which spoils one piece of a text at
    most. So the longer text (whole), or the shorter (not whole), is cut into as many pieces as d can be, and one more: one of them stands in
    the other text as it is, and in whole texts of up to PLACED letters at its place (`_placed`). Pairs that share one are filtered by what d edits leave
    of the letters and of the pairs of letters, then by their longest common subsequence. Whole texts of up to SCANNED letters, and below SHORT all whole texts, are filtered like that without pieces: each two of lengths that fit.
    Either side is parted into blocks of bounded size; every two blocks are one row, and are compared as arrays in a task of their own.
    Texts so short, or a similarity so low, that pieces are empty meet all others: nothing is lost. Null and empty texts have no candidates.
    """

    def blocks(df: DataFrame, c: str) -> tuple[DataFrame, int]:
        v = checkpointed(df.select(F.col(c).alias("x")).filter("x <> ''").distinct())
        rows = v.count()
        n = max(1, -(-rows // BLOCK), min(SPREAD, rows // FEW))
        return v.groupBy(F.pmod(F.xxhash64("x"), F.lit(n)).cast("int").alias(f"{c}_block")).agg(F.collect_list("x").alias(f"{c}s")), n

    (a, n), (b, m) = blocks(left, "l"), blocks(right, "r")
    repeated = lambda df, c, k: df.withColumn(f"{c}_block", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    met = repeated(a, "r", m).join(repeated(b, "l", n).hint("merge"), ["l_block", "r_block"]).select("ls", "rs")
    return met.repartition(n * m).mapInArrow(partial_of(_compared, least, whole), "l string, r string")


def matched(names: DataFrame, known: DataFrame, whole: float = 88, part: float | None = 92) -> DataFrame:
    """(name, id, stage, score): the known(id, label) that each distinct names(name) means, if any.

    Stages: `exact` after small letters; `tokens`, the best token-sort similarity from `whole` on after company endings are cut;
    `partial`, for what is left with two tokens or more, the first id with partial similarity from `part` on.
    Ties go to the smallest id. Null and blank names match nothing.
    """
    n = checkpointed(names.select("name").distinct().filter(F.trim("name") != "").withColumn("low", F.trim(small(F.col("name")))))
    k = checkpointed(known.filter(F.trim("label") != "").select("id", F.trim(small(F.col("label"))).alias("low")))
    exact = n.join(k.groupBy("low").agg(F.min("id").alias("id")).hint("merge"), "low").select("name", "id", F.lit("exact").alias("stage"), F.lit(100.0).alias("score"))
    rest = checkpointed(n.join(exact.select("name").hint("merge"), "name", "left_anti").withColumn("l", sorted_tokens(without_suffix(F.col("low")))))
    kk = checkpointed(k.withColumn("r", sorted_tokens(without_suffix(F.col("low")))).groupBy("r").agg(F.min("id").alias("id")))
    pairs = candidates(rest.select("l"), kk.select("r"), whole).withColumn("score", token_sort_ratio("l", "r")).filter(F.col("score") >= whole)
    best = pairs.join(kk.hint("merge"), "r").groupBy("l").agg(F.max_by(F.struct("id", "score"), F.struct("score", -F.col("id"))).alias("b"))
    by_tokens = checkpointed(rest.join(best.hint("merge"), "l").select("name", "b.id", F.lit("tokens").alias("stage"), "b.score"))
    out = exact.unionByName(by_tokens)
    if part is not None:
        left = rest.join(by_tokens.select("name").hint("merge"), "name", "left_anti").withColumn("l", without_suffix(F.col("low"))).filter((F.size(F.split("l", "\\s+")) >= 2) & (F.length("l") >= 3))
        plain = checkpointed(k.withColumn("r", without_suffix(F.col("low"))).filter(F.length("r") >= 3).groupBy("r").agg(F.min("id").alias("id")))
        left = checkpointed(left.select("name", "l"))
        near = candidates(left.select("l"), plain.select("r"), part, False).withColumn("score", partial_ratio("l", "r")).filter(F.col("score") >= part)
        first = near.join(plain.hint("merge"), "r").groupBy("l").agg(F.min_by(F.struct("id", "score"), "id").alias("b"))
        out = out.unionByName(left.join(first.hint("merge"), "l").select("name", "b.id", F.lit("partial").alias("stage"), "b.score"))
    return out
