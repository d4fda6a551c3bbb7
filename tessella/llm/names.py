"""Variant spellings of organisations and persons: a symmetric-delete index on tokens, then token alignment."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, looked_up, released, small_enough

# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans("аеосрхуіѕјкмнтвАЕОСРХУІЅЈКМНТВαοιν", "aeocpxyisjkmhtbAEOCPXYISJKMHTBaoiv")
# Digits and signs that stand for letters.
LEET = str.maketrans("013457$@", "oleasts" + "a")
# Legal endings, titles and fillers, folded.
LEGAL = set("a s as ao anonim sirketi sirket ltd limited sti gmbh inc incorporated san sanayi ve tic ticaret llc llp lp plc corp corporation co company io ai com net org example test tr resmi official sn mr mrs ms miss dr prof doc av bay bayan sayin the and".split())
# Lines of business and ways to write them, folded.
LINES = {
    "egitim": "egitim education egt edu edutech edtech", "enerji": "enerji energy enj ene", "lojistik": "lojistik logistics logistic loj", "yazilim": "yazilim software yaz", "analitik": "analitik analytics anl ana",
    "tarim": "tarim agri agriculture tar trm", "guvenlik": "guvenlik security guv sec", "teknoloji": "teknoloji technology technologies tech tek tekn", "saglik": "saglik health healthcare sag", "bilisim": "bilisim informatics bil bls",
    "robotik": "robotik robotics rob", "finans": "finans finance financial fin",
}
# Words for a kind of investor, folded; they do not tell firms apart.
KINDS = set("capital kapital cap sermaye srm partners partner ortaklari ortaklar ptr yatirim yatirimlar investments investment invest yat yatirimi holding hold hld hldg serm ptnr ptnrs ptrs invs girisim grs gir ventures venture vent vc fund fon fonu fonlari cekirdek mgmt management yonetim group grup sermayesi".split())
# Short forms of given names, folded.
NICKNAMES = {
    "aleksander": "alex aleks sasha sander", "asuman": "asu", "aylin": "ayli", "cansu": "cans", "ceyda": "ceydo", "christopher": "chris kit topher", "elizabeth": "liz beth lizzie eliza betty lisa", "emre": "emo", "ersin": "erso",
    "hande": "hando", "harald": "harry hal", "hulya": "hulo", "huseyin": "huso huseyn", "katherine": "kate kathy katie kat", "kerem": "kero", "kivanc": "kivo", "korkut": "korko", "margaret": "maggie meg peggy greta", "melike": "melo meli",
    "murat": "muro", "mustafa": "mustu musti mustik", "selahattin": "selo selahi", "sophia": "sophie sofi", "stefan": "stef steve", "tarik": "taro", "theodore": "ted theo teddy", "tolga": "tolo", "tugba": "tugi tubis", "mehmet": "memo memet",
    "ahmet": "ahmo", "ibrahim": "ibo", "ismail": "iso", "fatma": "fato fatos", "suleyman": "sulo", "william": "bill will", "robert": "bob rob", "richard": "dick rick", "thomas": "tom", "michael": "mike", "james": "jim", "johannes": "hans",
}
FULL = {n: k for k, ns in NICKNAMES.items() for n in ns.split()}
ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "vii": "7", "viii": "8"}
LINE_OF = {w: k for k, ws in LINES.items() for w in ws.split()}


def fold(s: str) -> str:
    s = s.replace("ı", "i").replace("İ", "i")
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).lower()


def osa(a: str, b: str, most: int = 9) -> int:
    """Optimal string alignment distance: insertions, deletions, substitutions and swaps of neighbours; most + 1 if it is more.

    Only the band of `most` cells on either side of the diagonal is filled, so words of any length cost length x most.
    """
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    far = most + 1
    before: list[int] = []
    last = [j if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        now = [far] * (len(b) + 1)
        now[0] = min(i, far)
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            d = min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now[j] = min(d, far)
        if min(now) >= far and min(last) >= far:
            return far
        before, last = last, now
    return last[-1]


def parse(name: str | None, business: bool = True) -> tuple[list[str], str, str, str]:
    """(core tokens in written order, initials, line of business, fund number) of a written name.

    business: the name may hold a line of business; else it may be a person's, and short forms of given names become full.
    """
    if not name or not name.strip():
        return [], "", "", ""
    s = re.sub("[​-‍﻿⁠­]", "", unicodedata.normalize("NFKC", name)).translate(LOOKALIKES)
    s = re.sub(r"\([^)]*\)", " ", s)
    s = re.sub(r"\.(?:io|ai|com|net|org|co|tech|app)\b", " ", s)
    s = re.sub(r"\bgmbh\b", " ", s, flags=re.I)
    s = re.sub(r"(?<=[^\W\d_A-ZÇĞİÖŞÜ])(?=[A-ZÇĞİÖŞÜ])", " ", s)
    raw = re.findall(r"[a-z0-9$@]+", fold(s))
    # letters written apart belong together: A.Ş., L.P.
    core, initials, line, number = [], "", "", ""
    fund = any(t in ("fund", "fon", "fonu") for t in raw)
    for k, t in enumerate(raw):
        if fund and t in ROMAN and k and raw[k - 1] in ("fund", "fon", "fonu"):
            number = ROMAN[t]
        elif t.isdigit():
            if fund and len(t) < 3:
                number = t
        elif t in LEGAL and not (len(t) == 1 and len(raw) <= 2):
            continue
        elif t in KINDS:
            continue
        elif business and t in LINE_OF and any(len(x) >= 4 and x not in LINE_OF and x not in LEGAL for x in raw):
            line = line or LINE_OF[t]
        elif len(t) == 1:
            initials += t
        else:
            core.append(t.translate(LEET) if re.search(r"[0-9$@]", t) else t)
    if not business and len(core) == 2:
        core = [FULL.get(t, t) for t in core]
    if business and len(core) > 2 and not line:  # a misspelled line of business
        for t in core:
            near = [k for w, k in LINE_OF.items() if len(w) >= 5 and abs(len(w) - len(t)) <= 2 and osa(w, t, 2) <= (1 if len(w) < 7 else 2)]
            if near:
                line = near[0]
                core = [x for x in core if x is not t]
                break
    if len(core) > 2:  # a misspelled kind of investor
        rest = [t for t in core if not any(osa(w, t, 1) <= 1 for w in KINDS if len(w) >= 6)]
        core = rest if len(rest) >= 2 else core
    if len(raw) and not core and initials:
        core, initials = [initials], ""
    return core, initials, line, number


def slug(url: str | None) -> str:
    """The letters that stand for the name in an address; empty if there are none."""
    m = re.match(r"^\s*(?:https?://)?(?:www\.)?([a-z0-9-]+)\.[a-z.]+(?:/organization/([a-z0-9-]+))?(?:/.*)?$", (url or "").lower())
    return re.sub("[^a-z0-9]", "", m[2] or m[1]) if m else ""


def _limit(t: str) -> int:
    return 0 if len(t) <= 3 else 1 if len(t) <= 5 else 2


def aligned(a: list[str], b: list[str], ia: str = "", ib: str = "", sure: bool = False) -> str:
    """`same`, `initial` (alike up to an initial) or an empty text, by the best assignment of tokens.

    sure: something besides the names speaks for the pair, so one more edit a token is allowed, and abbreviations are.
    Without it, three edits in all need words that begin alike.
    Names may have any number of words: equal words are assigned to each other first, and no more than three may be left.
    """
    more = 1 if sure else 0
    if not a or not b:
        return ""
    if len(a) == 1 or len(b) == 1:
        if len(a) == len(b) and bool(ia) == bool(ib):
            return "same" if osa(a[0], b[0], 3) <= _limit(min(a[0], b[0], key=len)) + more and set(ia) == set(ib) else ""
        one, i, full = (a[0], ia, b) if len(a) == 1 else (b[0], ib, a)
        if i and len(full) == 2:
            for k in (0, 1):
                if full[1 - k][0] in i and osa(one, full[k], 2) <= min(1 + more, _limit(full[k]) + more):
                    return "initial"
            return ""
        return "same" if not i and len(one) >= 6 and min(osa(one, "".join(x), 4) for x in (full, full[::-1])) <= 2 + more else ""
    if len(a) == len(b):
        both = Counter(a) & Counter(b)
        s, t = list((Counter(a) - both).elements()), list((Counter(b) - both).elements())
        if len(s) <= 3 and any(sum(ds) <= (3 if sure or all(x[0] == y[0] for x, y in zip(s, p, strict=True)) else 2) for p in permutations(t) if (ds := _within_limits(s, p)) is not None):
            return "same"
    return "same" if sure and _sound(*((a, b) if len(a) <= len(b) else (b, a))) else ""


def _within_limits(s: list[str], p: tuple[str, ...]) -> list[int] | None:
    """The edits of each assigned pair of tokens; None if one has more than its length allows."""
    out = []
    for x, y in zip(s, p, strict=True):
        d = osa(x, y, 2)
        if d > _limit(min(x, y, key=len)):
            return None
        out.append(d)
    return out


def _sound(s: list[str], t: list[str]) -> bool:
    """All tokens of s, the shorter name, find one of t: one as good as right, each other at least half right or an abbreviation."""
    d = [[osa(x, y, int(0.6 * max(len(x), len(y))) + 1) for y in t] for x in s]

    def loose(i: int, j: int) -> bool:
        x, y = sorted((s[i], t[j]), key=len)
        return d[i][j] <= 0.6 * len(y) or y.startswith(x) or x[0] == y[0] and _within(x, y)

    def matched(i: int, j: int) -> bool:  # the rest by augmenting paths
        owner = {j: i}

        def place(k: int, tried: set[int]) -> bool:
            for c in range(len(t)):
                if c != j and c not in tried and loose(k, c):
                    tried.add(c)
                    if c not in owner or place(owner[c], tried):
                        owner[c] = k
                        return True
            return False

        return all(place(k, set()) for k in range(len(s)) if k != i)

    return any(d[i][j] <= 1 and matched(i, j) for i in range(len(s)) for j in range(len(t)))


def _within(x: str, y: str) -> bool:
    """The letters of x stand in y in the same order."""
    it = iter(y)
    return all(c in it for c in x)


PROFILE = "tab string, id bigint, core array<string>, initials string, sub string, slugs array<string>, legal string, seen string, legal_sub string"


def _profiles(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        out = []
        for r in p.itertuples(index=False):
            core, initials, line, number = parse(r.name, r.tab == "startups")
            legal, _, legal_line, _ = parse(r.legal)
            slugs = sorted({slug(r.website), slug(r.crunchbase)} - {""})
            sub = line or number
            joined = "".join(legal) if len(legal) == 2 else ""
            legal_sub = legal_line
            for s in slugs:  # an address may name the line or the number
                for k in LINES:
                    if not legal_sub and s.endswith(k) and len(s) > len(k) + 5:
                        legal_sub = k
            m = re.search(r"-(\d)\.", r.website or "")
            if m and not legal_sub:
                legal_sub = m[1]
            out.append((r.tab, r.id, core, initials, sub, slugs, joined, r.seen or "", legal_sub))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in PROFILE.split(", ")])


def spellings(c: Column, n: int) -> Column:
    """The word with up to n of its letters left out (n is 1 or 2)."""
    size = F.length(c)
    upto = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    part = lambda a, b: c.substr(a, b - a + 1)
    one = lambda i: F.concat(part(F.lit(1), i - 1), part(i + 1, size))
    out = F.concat(F.array(c), F.transform(upto(F.lit(1), size), one))
    if n == 2:
        two = lambda i: F.transform(upto(i + 1, size), lambda j: F.concat(part(F.lit(1), i - 1), part(i + 1, j - 1), part(j + 1, size)))
        out = F.concat(out, F.flatten(F.transform(upto(F.lit(1), size), two)))
    return F.array_distinct(out)


#: words up to so many letters are indexed by their deletions, from three letters less on by segments as well
LONG = 26
#: forms that hold a word, from which the word alone no longer is an index key
COMMON = 50


def word_keys(c: Column, n: int, always: bool = False) -> Column:
    """Hashed index keys of a word: two words within n edits (1 or 2) share one; within as many as _limit allows, if n is 2 and not always.

    A word of up to LONG letters has its symmetric-delete neighbourhood. Of longer words, n edits spoil at most 2 n of
    2 n + 1 segments, each moved by n places at most: the words share a segment at one of the places where it may stand.
    """
    size, many = F.length(c), 2 * n + 1
    part = lambda k, l: F.floor(k * l / many).cast("int")  # noqa: E731, E741
    span = F.sequence(F.lit(-n), F.lit(n))
    segment = lambda l, k, m: F.xxhash64(F.lit("segment"), l, k, c.substr(part(k, l) + 1 + m, part(k + 1, l) - part(k, l)))  # noqa: E731, E741
    segments = F.flatten(F.transform(span, lambda e: F.flatten(F.transform(F.sequence(F.lit(0), F.lit(many - 1)), lambda k: F.transform(span, lambda m: segment(size + e, k, m))))))
    none = F.array().cast("array<bigint>")
    hashed = lambda x: F.transform(x, lambda w: F.xxhash64(w))
    deleted = hashed(spellings(c, n)) if n == 1 or always else F.when(size >= 6, hashed(spellings(c, 2))).otherwise(hashed(spellings(c, 1)))
    return F.array_distinct(F.concat(F.when(size > LONG, none).otherwise(deleted), F.when(size > LONG - 4, segments).otherwise(none)))


def piece_keys(c: Column, n: int, sought: bool) -> Column:
    """Hashed keys of n + 1 pieces of a text; sought: of all pieces of another within n edits, wherever they may stand here.

    The pieces are a letter apart, so an edit, a swap too, spoils one of them at most: two texts within n edits share a key.
    Texts of less than 2 n + 1 letters have empty pieces, which all share.
    """
    size, span = F.length(c), F.sequence(F.lit(-n), F.lit(n))
    width = lambda l: F.greatest(F.floor((l - n) / (n + 1)), F.lit(0)).cast("int")  # noqa: E731, E741
    piece = lambda l, k, m: F.xxhash64(k, c.substr(k * (width(l) + 1) + 1 + m, width(l)))  # noqa: E731, E741
    each = lambda f: F.transform(F.sequence(F.lit(0), F.lit(n)), f)
    if not sought:
        return each(lambda k: piece(size, k, F.lit(0)))
    return F.array_distinct(F.flatten(F.transform(span, lambda e: F.flatten(each(lambda k: F.transform(span, lambda m: piece(size + e, k, m)))))))


def _near(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        p = p[[osa(t, u, 1) <= 1 for t, u in zip(p["t"], p["u"], strict=True)]]
        yield pd.DataFrame({"t": pd.concat([p["t"], p["u"]]), "u": pd.concat([p["u"], p["t"]])})


def neighbours(words: DataFrame) -> DataFrame:
    """(t, u): for each of the distinct words(t) itself and the words within one edit, by the symmetric-delete index."""
    k = words.select("t", F.explode(word_keys(F.col("t"), 1)).alias("key"))
    pairs = k.join(k.withColumnRenamed("t", "u").hint("merge"), "key").filter("t < u").select("t", "u").distinct()
    # an alignment with swaps is never more than twice as good as one without
    pairs = pairs.filter(F.levenshtein("t", "u", 2) >= 0)
    return pairs.mapInPandas(_near, "t string, u string").unionByName(words.select("t", F.col("t").alias("u")))


def _compared(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        hows = []
        for a, ia, sa, b, ib, sb in zip(p["core_a"], p["initials_a"], p["sub_a"], p["core_b"], p["initials_b"], p["sub_b"], strict=True):
            a, b = list(a), list(b)
            how = aligned(a, b, ia, ib)
            backed = bool(sa and sb and sa != sb and "".join(a) != "".join(b))  # another line or number: only with support
            if not how or backed:
                how = aligned(a, b, ia, ib, True)
                backed = True
            hows.append(f"{how} backed" if how and backed else how)
        p["how"] = hows
        yield p[p["how"] != ""][["tab", "a", "b", "how"]]


def components(edges: DataFrame) -> DataFrame:
    """(tab, node, root): the smallest node of each connected component of edges(tab, a, b).

    A round gives each node the smallest label among its own and its neighbours', then its label's label; rounds go on
    until one changes nothing. Each round is a reliable checkpoint; nothing but whether it changed anything reaches the
    driver. A node with a third of all edges is spread in the joins and reduced before the shuffle in the aggregation.
    """
    e = checkpointed(edges.select("tab", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("tab", "x.a", "x.b").filter("a <> b").distinct())
    n = e.count()
    label = checkpointed(e.groupBy("tab", F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        said = looked_up(e, "a", label.select("tab", F.col("node").alias("b"), "root"), ["tab", "b"], most=n).select("tab", F.col("a").alias("node"), "root", F.lit(None).cast("bigint").alias("old"))
        own = label.select("tab", "node", "root", F.col("root").alias("old"))
        new = checkpointed(own.unionByName(said).groupBy("tab", "node").agg(F.min("root").alias("root"), F.max("old").alias("old")))
        if new.filter("root <> old").isEmpty():
            return label
        up = new.select("tab", F.col("node").alias("root"), F.col("root").alias("up"))
        label = checkpointed(looked_up(new, "node", up, ["tab", "root"], "left", n).select("tab", "node", F.coalesce("up", "root").alias("root")))


def _rarest(forms: DataFrame, words: DataFrame) -> DataFrame:
    """(tab, fid, rare): the words of each form of three or more, the rarest first."""
    x = forms.filter("n >= 3").select("tab", "fid", F.explode("core").alias("t"))
    return looked_up(checkpointed(x), "fid", words, ["t"]).groupBy("tab", "fid").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "t"))), lambda s: s["t"]).alias("rare"))


def candidates(forms: DataFrame, shared: DataFrame) -> DataFrame:
    """(tab, a, b): the pairs of forms(tab, fid, core, initials, n) that the index of words brings together.

    Each word knows its neighbours among all words in use, those within one edit. Two forms meet
    - with two to four words each: of the two rarest words of one, one has a neighbour in the other, and the
      other word one within two edits. The neighbour is the key; where one of the two is COMMON, so that too many
      would meet, the key is the neighbour with each spelling of the other word that leaves out up to two letters;
    - with five words or more: at most three may differ, so they share one of the four rarest words;
    - with one word each, if these are within two edits and the initials are the same; an initial and a word meet two words;
    - with one word and several, if the one is within two edits of the others run together (`_run_together`);
    - by shared(tab, fid, key), what else the two have in common, and a word within one edit, an initial, or, where
      one of the two is a single word, three edits of the words run together.
    No pair that `aligned` takes is lost.
    """
    words = checkpointed(forms.select(F.explode(F.array_distinct("core")).alias("t")).groupBy("t").agg(F.count("*").alias("df")))
    near = checkpointed(neighbours(words.select("t")).join(words.select(F.col("t").alias("u"), F.col("df").alias("du")).hint("merge"), "u"))
    most = near.groupBy("t").agg(F.max("du").alias("most"), F.max(F.when(F.col("t") == F.col("u"), F.col("du"))).alias("dt"))
    near = near.join(most.hint("merge"), "t")
    forms = forms.join(_rarest(forms, words).hint("merge"), ["tab", "fid"], "left").withColumn("rare", F.coalesce("rare", "core"))
    tok = checkpointed(forms.select("tab", "fid", "n", "initials", "rare", F.posexplode("rare").alias("i", "t")))
    tok = checkpointed(looked_up(tok, "fid", near, ["t"]))
    released(forms.sparkSession)
    key = lambda *x: F.xxhash64(*(F.lit(y) if isinstance(y, str | int) else y for y in x), F.col("tab"))
    n, i, t, u, rare = (F.col(c) for c in ("n", "i", "t", "u", "rare"))
    letters = F.array_join(F.array_sort(F.array_distinct(F.split("initials", ""))), "")
    none, few = F.array().cast("array<bigint>"), (n >= 2) & (n <= 4)
    other = F.element_at("rare", F.when(i == 0, 2).otherwise(1))
    others = F.filter(rare, lambda x, k: k != i)
    spelled = lambda x, w: F.transform(word_keys(x, 2), lambda k: key("two", n, w, k))
    itself = tok.filter("t = u")
    each = lambda df, k, os=None: df.select("tab", "fid", os.alias("o") if os is not None else F.lit(None).cast("array<string>").alias("o"), F.explode(k).alias("key"))
    many = each(itself.filter("n >= 5 and i < 4"), F.array(key("many", n, t)))
    one = each(itself.filter("n = 1"), F.transform(word_keys(t, 2), lambda k: key("one", letters, k)))
    lone = tok.filter("n = 1 and initials <> ''")
    with_shared = lambda df: shared.withColumnRenamed("key", "what").join(df.hint("merge"), ["tab", "fid"])
    met, what = with_shared(tok.select("tab", "fid", "n", "initials", "rare", "i", "t", "u")), F.col("what")
    lefts = [
        each(tok.filter(few & (i < 2)), F.when(F.greatest("dt", "du") > COMMON, spelled(other, u)).otherwise(F.array(key("two", n, u))), F.array(other)), many, one,
        each(lone, F.transform(F.split("initials", ""), lambda x: key("initial", x, u))), each(met, F.array(key("shared", what, u))),
        each(met.filter("n = 1 and initials <> '' and t = u"), F.transform(F.split("initials", ""), lambda x: key("letter", what, x))),
    ]
    rights = [
        each(itself.filter(few), F.concat(F.when(F.col("dt") <= COMMON, F.array(key("two", n, t))).otherwise(none), F.when(F.col("most") > COMMON, F.flatten(F.transform(others, lambda o: spelled(o, t)))).otherwise(none)), others), many, one,
        each(itself.filter("n = 2"), F.array(key("initial", other.substr(1, 1), t))), each(met.filter("t = u"), F.array(key("shared", what, t))),
        each(met.filter("n = 2 and t = u"), F.array(key("letter", what, t.substr(1, 1)))),
    ]
    lefts, rights = reduce(DataFrame.unionByName, lefts), reduce(DataFrame.unionByName, rights)
    pairs = lefts.withColumnRenamed("fid", "x").join(rights.select("tab", "key", F.col("fid").alias("y"), F.col("o").alias("os")).hint("merge"), ["tab", "key"]).filter("x <> y")
    # where a word is a key, the other word must be near as well; swaps make an alignment at most twice as good
    size = lambda x, o: F.least(F.length(x), F.length(o))
    fits = lambda x, o: F.when(size(x, o) <= 3, x == o).when(size(x, o) <= 5, F.levenshtein(x, o, 2) >= 0).otherwise(F.levenshtein(x, o, 4) >= 0)
    pairs = pairs.filter(F.col("o").isNull() | F.exists("os", lambda o: fits(F.col("o")[0], o)))
    pairs = pairs.select("tab", "x", "y").unionByName(_run_together(forms.select("tab", "fid", "n", "core", letters.alias("letters")), shared))
    return pairs.select("tab", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _halves(df: DataFrame, least: Column, most: Column) -> DataFrame:
    """(tab, fid, w, rest, key): the halves of the words w, cut after `least` to `most` letters, by their spellings within one edit; rest: the other half."""
    w, p = F.col("w"), F.col("p")
    half = lambda side, x, rest: F.struct(F.lit(side).alias("side"), x.alias("half"), rest.alias("rest"))
    head, tail = w.substr(F.lit(1), p), w.substr(p + 1, F.length(w))
    x = df.select("tab", "fid", "w", F.explode(F.sequence(least.cast("int"), most.cast("int"))).alias("p")).select("tab", "fid", "w", F.explode(F.array(half("head", head, tail), half("tail", tail, head))).alias("x"))
    return x.select("tab", "fid", "w", "x.rest", F.explode(F.transform(word_keys(F.col("x.half"), 1), lambda k: F.xxhash64(F.col("x.side"), k))).alias("key"))


def _run_together(forms: DataFrame, shared: DataFrame) -> DataFrame:
    """(tab, x, y): of forms(tab, fid, n, core, letters) the single words x and the names y, of several words or with an initial, within reach once these are run together, forwards or backwards.

    Of two edits, one half of y takes one at most (a swap across the cut counts as one on either side): the key is that half with a letter
    left out. Where more than COMMON names have the key, the other half with two letters left out is part of it. With something in
    shared(tab, fid, key) three edits are allowed, between single words as well: these share a piece of four.
    """
    w = F.col("w")
    single = forms.filter("n = 1").select("tab", "fid", "letters", F.col("core")[0].alias("w"))
    whole = forms.filter("n > 1 or letters <> ''").select("tab", "fid", F.lit("").alias("letters"), F.explode(F.array_distinct(F.array(F.array_join("core", ""), F.array_join(F.reverse("core"), "")))).alias("w"))
    size = F.length(w)
    lefts = _halves(single.filter("letters = '' and length(w) >= 6"), F.floor((size - 2) / 2) - 1, F.floor((size + 2) / 2) + 1)
    rights = _halves(whole, F.floor(size / 2), F.floor(size / 2))
    hot = checkpointed(rights.groupBy("tab", "key").agg(F.count("*").alias("n")).filter(F.col("n") > COMMON).select("tab", "key", F.lit(True).alias("hot")))
    hot = F.broadcast(hot) if small_enough(hot) else hot.hint("merge")
    finer = F.when(F.col("hot"), F.transform(word_keys(F.col("rest"), 2, True), lambda k: F.xxhash64("key", k))).otherwise(F.array("key"))
    keyed = lambda df: df.join(hot, ["tab", "key"], "left").select("tab", "fid", "w", F.explode(finer).alias("key"))
    backed = lambda df, sought: shared.withColumnRenamed("key", "what").join(df.hint("merge"), ["tab", "fid"]).select("tab", "fid", "w", F.explode(F.transform(piece_keys(w, 3, sought), lambda k: F.xxhash64(F.lit("backed"), "what", "letters", k))).alias("key"))
    # swaps make an alignment at most twice as good
    lefts = keyed(lefts).withColumn("most", F.lit(4)).unionByName(backed(single, True).withColumn("most", F.lit(6)))
    rights = keyed(rights).unionByName(backed(single.unionByName(whole), False))
    pairs = lefts.withColumnRenamed("fid", "x").join(rights.select("tab", "key", F.col("fid").alias("y"), F.col("w").alias("v")).hint("merge"), ["tab", "key"]).filter("x <> y")
    return pairs.filter(F.levenshtein("w", "v") <= F.col("most")).select("tab", "x", "y")


def _keys(plain: bool) -> Column:
    """What a profile may have in common with another: first day, address or registered name; and, if wanted, plain keys of its kind."""
    some = lambda c, k: F.when(F.col(c) != "", F.array(F.concat(F.lit(k), F.col(c)))).otherwise(F.array().cast("array<string>"))
    t = F.transform(F.array_distinct(F.concat("slugs", F.when(F.col("legal") != "", F.array("legal")).otherwise(F.array().cast("array<string>")))), lambda x: F.concat(F.lit("T"), x))
    out = F.concat(some("seen", "D"), t, some("legal", "L"))
    return F.concat(out, F.when(F.size("slugs") == 0, F.array(F.lit("*"), F.lit("0"))).otherwise(F.array(F.lit("*")))) if plain else out


#: shared keys of a profile at most: a first day, two addresses, a registered name twice, and two of its kind
PER = 7


def links(uniq: DataFrame, checked: DataFrame, forms: DataFrame, n: int | None = None) -> DataFrame:
    """(tab, a, b): links between profiles with the same components as all pairs of profiles of one form or of linked forms that do not contradict each other.

    Two profiles contradict each other if they have different registered names; or, unless both have the same one, if
    both have addresses but none in common and their first days differ. So what links them is an equality: the same registered
    name; or, where one has none, the same address (an address may also be the other's registered name) or first day,
    or that one of them has no address. Forms that are alike only with support are linked by shared
    columns alone. For each form and each such key one profile, the smallest that contradicts none of the others among its
    own and its linked forms', is linked with all that have the key: a star instead of all pairs, and nothing is lost.
    """
    has = uniq.select("tab", "fid", "pid", "legal", F.explode(_keys(False)).alias("key"))
    has = checkpointed(has)
    free = F.when(F.col("legal") == "", F.col("pid"))
    group = checkpointed(has.groupBy("tab", "fid", "key").agg(F.min(free).alias("free"), F.min("pid").alias("any"), F.count("*").alias("n")))
    size = forms.select("tab", "fid", "profiles", "x0", "x1", "f", F.col("any").alias("one"))
    e = checked.filter("how in ('same', 'same backed')")
    side = lambda s: size.select("tab", F.col("fid").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("profiles", "x0", "x1", "f", "one")))
    e = checkpointed(e.join(side("a").hint("merge"), ["tab", "a"]).join(side("b").hint("merge"), ["tab", "b"]))
    both = F.array(*(F.struct(F.col(x).alias("fid"), *(F.col(f"{c}_{y}").alias(c) for c in ("x0", "x1", "f", "one")), *(F.col(f"{c}_{x}").alias(f"my_{c}") for c in ("x0", "x1"))) for x, y in (("a", "b"), ("b", "a"))))
    plain = e.filter("how = 'same'").select("tab", F.explode(both).alias("x")).select("tab", "x.*")
    edge = lambda df, a, b: df.select("tab", F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null and a <> b")
    out = edge(plain, "my_x0", "one").unionByName(edge(plain, "my_x1", "f"))
    # the profiles without address or registered name: of one's own form or of one alike
    best = size.select("tab", "fid", "x0", "x1", "f").unionByName(plain.select("tab", "fid", "x0", "x1", "f")).groupBy("tab", "fid").agg(*(F.min(c).alias(c) for c in ("x0", "x1", "f")))
    best = best.join(size.filter("profiles > 1").select("tab", "fid").unionByName(plain.select("tab", "fid")).distinct().hint("merge"), ["tab", "fid"], "left_semi")
    p = looked_up(uniq.select("tab", "fid", "pid", "legal", (F.size("slugs") == 0).alias("bare")), "pid", best, ["tab", "fid"], most=n)
    p = p.select("tab", "pid", F.explode(F.array("x0", F.when(F.col("legal") == "", F.col("x1")), F.when((F.col("legal") != "") & F.col("bare"), F.col("f")))).alias("c"))
    out = out.unionByName(edge(p, "c", "pid"))
    # what linked forms have in common: the keys of the smaller one, looked up in the larger
    less = F.col("profiles_a") <= F.col("profiles_b")
    ordered = e.select("tab", F.when(less, F.col("a")).otherwise(F.col("b")).alias("fid"), F.when(less, F.col("b")).otherwise(F.col("a")).alias("big"))
    s = group.select("tab", "fid", "key", F.col("free").alias("free_s"), F.col("any").alias("any_s"))
    m = looked_up(s, "key", ordered, ["tab", "fid"], most=n and PER * n).withColumnRenamed("fid", "small")
    m = checkpointed(m.join(group.select("tab", F.col("fid").alias("big"), "key", F.col("free").alias("free_b"), F.col("any").alias("any_b")).hint("merge"), ["tab", "big", "key"]))
    out = out.unionByName(edge(m, "free_s", "any_b")).unionByName(edge(m, "any_s", "free_b")).unionByName(edge(m.filter("key like 'L%'"), "any_s", "any_b"))
    centre = F.when(F.col("key").startswith("L"), F.col("any")).otherwise(F.col("free"))
    around = group.filter("n > 1").select("tab", "fid", "key", centre.alias("c"))
    around = around.unionByName(m.select("tab", F.col("small").alias("fid"), "key", F.col("free_b").alias("c")).filter("key not like 'L%'")).unionByName(m.select("tab", F.col("big").alias("fid"), "key", F.col("free_s").alias("c")).filter("key not like 'L%'"))
    around = around.groupBy("tab", "fid", "key").agg(F.min("c").alias("c")).filter("c is not null")
    return out.unionByName(edge(looked_up(has, "pid", around, ["tab", "fid", "key"], most=n and PER * n), "c", "pid"))


def initialled(uniq: DataFrame, checked: DataFrame, root: DataFrame, n: int | None = None) -> DataFrame:
    """(tab, pid, root): the cluster of each name with an initial: one that other columns support, or the only one whose full names fit and do not contradict.

    The full names' clusters are first reduced to their smallest and largest per form and key, so that neither many
    full names nor many with an initial are compared with each other one by one.
    """
    ini = checked.filter("how like 'initial%'").select("tab", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x"), "how").select("tab", F.col("x.a").alias("lone"), F.col("x.b").alias("fid"), (F.col("how") == "initial").alias("plain"))
    alone = uniq.filter("size(core) = 1 and initials <> ''")
    ini = checkpointed(ini.join(alone.select("tab", F.col("fid").alias("lone")).distinct().hint("merge"), ["tab", "lone"], "left_semi"))
    full = uniq.join(ini.select("tab", "fid").distinct().hint("merge"), ["tab", "fid"], "left_semi").select("tab", "fid", "pid", "legal", F.explode(_keys(True)).alias("key"))
    full = looked_up(checkpointed(full), "key", root.select("tab", F.col("node").alias("pid"), "root"), ["tab", "pid"], "left", n and PER * n).withColumn("root", F.coalesce("root", "pid"))
    free = F.when(F.col("legal") == "", F.col("root"))
    full = full.groupBy("tab", "fid", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min(free).alias("free_lo"), F.max(free).alias("free_hi"))
    kinds = F.concat(_keys(False), F.when(F.size("slugs") == 0, F.array(F.lit("*"))).otherwise(F.array(F.lit("0"))))
    mine = checkpointed(alone.select("tab", F.col("fid").alias("lone"), "pid", (F.col("legal") != "").alias("named"), F.explode(kinds).alias("key")))
    asked = mine.select("tab", "lone", "key").distinct().join(ini.hint("merge"), ["tab", "lone"]).filter("plain or key not in ('*', '0')")
    said = asked.join(full.hint("merge"), ["tab", "fid", "key"]).groupBy("tab", "lone", "key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("free_lo").alias("free_lo"), F.max("free_hi").alias("free_hi"))
    got = looked_up(mine, "pid", said, ["tab", "lone", "key"], most=n and PER * n)
    bound = F.col("named") & ~F.col("key").startswith("L")
    got = got.select("tab", "pid", F.col("key").isin("*", "0").alias("plain"), F.when(bound, F.col("free_lo")).otherwise(F.col("lo")).alias("lo"), F.when(bound, F.col("free_hi")).otherwise(F.col("hi")).alias("hi"))
    got = got.groupBy("tab", "pid").agg(F.min(F.when(~F.col("plain"), F.col("lo"))).alias("backed"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return got.select("tab", "pid", F.coalesce("backed", F.when(F.col("lo") == F.col("hi"), F.col("lo"))).alias("root")).filter("root is not null")


def linked(rows: DataFrame) -> DataFrame:
    """(tab, id, entity): one entity for all rows of a table whose names mean the same.

    rows(tab, id, name, legal, website, crunchbase, seen): the name decides; the rest may support or contradict it and
    may be null. Rows alike in all of these (a profile) are worked on once, and names written with the same words (a form) are
    compared once. The index finds pairs of forms, the alignment of their words confirms them, and profiles of one form or
    of confirmed pairs that do not contradict each other are linked: the clusters are those that comparing all pairs of profiles
    would give. Clusters are then parted by line of business or fund number. A name with an initial joins the one
    full name that fits. Null, blank and unreadable names are entities of their own. Names are compared as a whole,
    however long.
    """
    spark = rows.sparkSession
    prof = rows.select("tab", F.col("id").cast("bigint").alias("id"), *(F.col(c).cast("string").alias(c) for c in ("name", "legal", "website", "crunchbase", "seen"))).mapInPandas(_profiles, PROFILE)
    same = ["core", "initials", "sub", "slugs", "legal", "seen", "legal_sub"]
    text = lambda *c: F.unhex(F.md5(F.concat_ws("\u0001", *(F.array_join(x, " ") if x in ("core", "slugs") else F.col(x) for x in c))))
    prof = checkpointed(prof.withColumn("h", text("tab", *same)))
    n = prof.count()
    uniq = prof.filter(F.size("core") > 0).groupBy("tab", "h").agg(F.min("id").alias("pid"), F.count("*").alias("rows"), *(F.first(c).alias(c) for c in same))
    uniq = checkpointed(uniq.withColumn("fid", text("tab", "core", "initials", "sub")))
    bare, named = F.size("slugs") == 0, F.col("legal") != ""
    forms = uniq.groupBy("tab", "fid").agg(*(F.first(c).alias(c) for c in ("core", "initials", "sub")), F.count("*").alias("profiles"), F.min("pid").alias("any"), F.min(F.when(~named, F.col("pid"))).alias("f"), F.min(F.when(bare & ~named, F.col("pid"))).alias("x0"), F.min(F.when(bare & named, F.col("pid"))).alias("x1"))
    # in the index a form is a number, which takes a third of the room of its hash; the checkpoint fixes it
    forms = checkpointed(forms.withColumn("n", F.size("core")).withColumn("num", F.monotonically_increasing_id()))
    keys = uniq.select("tab", "fid", F.explode(_keys(False)).alias("key")).distinct()
    several = keys.groupBy("tab", "key").agg(F.count("*").alias("n")).filter("n > 1").select("tab", "key")
    shared = keys.join(several.hint("merge"), ["tab", "key"], "left_semi")
    shared = checkpointed(shared.join(forms.select("tab", "fid", "num").hint("merge"), ["tab", "fid"]).select("tab", F.col("num").alias("fid"), "key"))
    released(spark)
    numbered = forms.select("tab", F.col("num").alias("fid"), "core", "initials", "n")
    pairs = checkpointed(candidates(numbered, shared))
    released(spark)
    words = lambda s: forms.select("tab", F.col("num").alias(s), F.col("fid").alias(f"fid_{s}"), *(F.col(c).alias(f"{c}_{s}") for c in ("core", "initials", "sub")))
    pairs = pairs.join(words("a").hint("merge"), ["tab", "a"]).join(words("b").hint("merge"), ["tab", "b"]).drop("a", "b").withColumnsRenamed({"fid_a": "a", "fid_b": "b"})
    checked = checkpointed(pairs.mapInPandas(_compared, "tab string, a binary, b binary, how string"))
    released(spark)
    root = components(links(uniq, checked, forms, n))
    released(spark)
    ini = checkpointed(initialled(uniq, checked, root, n))
    # the members of clusters: those with a link, those with an initial (and the full names that only they name)
    member = root.withColumnRenamed("node", "pid").withColumn("rank", F.lit(1)).unionByName(ini.withColumn("rank", F.lit(0))).unionByName(ini.select("tab", F.col("root").alias("pid"), "root").distinct().withColumn("rank", F.lit(2)))
    member = member.groupBy("tab", "pid").agg(F.min_by("root", "rank").alias("root"))
    known = uniq.select("tab", "pid", "slugs", "seen", F.coalesce(F.nullif("sub", F.lit("")), F.nullif("legal_sub", F.lit(""))).alias("own"), "h").join(member.hint("merge"), ["tab", "pid"])
    known = checkpointed(known)
    # part clusters by line of business or fund number; where a name leaves it out, other columns or the only one there is say it
    told = known.filter("own is not null")
    only = checkpointed(told.groupBy("tab", "root").agg(F.min("own").alias("one"), F.max("own").alias("two")))
    parted = only.filter("one <> two").select("tab", "root")
    quiet = checkpointed(looked_up(known.filter("own is null"), "pid", only, ["tab", "root"], "left", n))
    told = looked_up(told, "pid", parted, ["tab", "root"], most=n)
    by_slug = told.select("tab", "root", F.explode("slugs").alias("slug"), "own").groupBy("tab", "root", "slug").agg(F.min("own").alias("s"))
    by_seen = told.filter("seen <> ''").groupBy("tab", "root", "seen").agg(F.min("own").alias("f"))
    asking = quiet.filter("one <> two").select("tab", "pid", "root", "seen", "slugs")
    via = looked_up(asking.select("tab", "pid", "root", F.explode("slugs").alias("slug")), "pid", by_slug, ["tab", "root", "slug"], most=PER * n).groupBy("tab", "pid").agg(F.min("s").alias("s"))
    day = looked_up(asking, "pid", by_seen, ["tab", "root", "seen"], most=n).select("tab", "pid", "f")
    full = quiet.select("tab", "pid", "root", "h", "one", "two").join(via.hint("merge"), ["tab", "pid"], "left").join(day.hint("merge"), ["tab", "pid"], "left")
    full = full.select("tab", "pid", "root", "h", F.coalesce("f", "s", F.when(F.col("one") == F.col("two"), F.col("one")), F.lit("")).alias("part"))
    full = checkpointed(full.unionByName(known.filter("own is not null").select("tab", "pid", "root", "h", F.col("own").alias("part"))))
    first = full.groupBy("tab", "root", "part").agg(F.min("pid").alias("entity"))
    entity = looked_up(full, "pid", first, ["tab", "root", "part"], most=n).select("tab", "h", "entity")
    # rows written alike: their smallest id, if their profile is in no cluster; all other rows stand for themselves
    alike = uniq.filter("rows > 1").select("tab", "h", F.col("pid").alias("entity"))
    entity = alike.withColumn("rank", F.lit(1)).unionByName(entity.withColumn("rank", F.lit(0))).groupBy("tab", "h").agg(F.min_by("entity", "rank").alias("entity"))
    return looked_up(prof.select("tab", "id", "h"), "id", entity, ["tab", "h"], "left", n).select("tab", "id", F.coalesce("entity", "id").alias("entity"))
