import random
from collections import Counter

from pyspark.sql import functions as F

from tessella.operators import aggregates as A
from tessella.operators import fuzzy, joins, keywords, upsert


def test_arbitrated_equals_a_sequential_model(spark, rows):
    rng = random.Random(11)
    log = [(k, f, s, rng.choice("abc"), rng.randrange(100)) for k in range(5) for f in "xy" for s in range(rng.randrange(3))]
    cand = [(rng.randrange(6), rng.choice("xy"), 100 + s, rng.choice(["a", "b", "c", None, "", "Unknown"]), rng.choice([10, 50, 60, 90, None])) for s in range(400)]
    schema = "id long, field string, seq long, value string, confidence int"
    want, state = [], {}
    for k, f, _, v, c in log:
        state[(k, f)] = (v, c)
    for k, f, s, v, c in cand:
        c = c or 0
        if v in (None, "", "Unknown"):
            continue
        old = state.get((k, f))
        if old and (c < old[1] or v == old[0]):
            continue
        want.append((k, f, s, old[0] if old else None, v, c))
        state[(k, f)] = (v, c)
    got = rows(upsert.arbitrated(spark.createDataFrame(log, schema), spark.createDataFrame(cand, schema), ["id", "field"]))
    assert got == sorted(want, key=repr)


def test_arbitration_is_no_running_maximum(spark, rows):
    schema = "id long, seq long, value string, confidence int"
    got = upsert.arbitrated(spark.createDataFrame([(1, 0, "A", 50)], schema), spark.createDataFrame([(1, 1, "A", 90), (1, 2, "B", 60)], schema), ["id"])
    assert rows(got, "new_value") == [("B",)]


def test_inserts(spark, rows):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, k string, v string")
    n = spark.createDataFrame([(3, "b", "z"), (4, "c", "p"), (5, "c", "q"), (6, None, "r")], "id long, k string, v string")
    out, added = upsert.insert_ignore(t, n, ["k"], F.col("id"))
    assert rows(added, "id") == [(4,), (6,)] and out.count() == 4
    assert upsert.insert_ignore(out, n.filter("k is not null"), ["k"], F.col("id"))[1].count() == 0
    assert rows(upsert.insert_replace(t, n.filter("k is not null").drop("v"), ["k"], F.col("id"))) == sorted([(1, "a", "x"), (3, "b", None), (5, "c", None)], key=repr)


def test_updates_notes_and_deletes(spark, rows):
    t = spark.createDataFrame([(1, "x", None), (2, None, "n")], "id long, v string, note string")
    c = spark.createDataFrame([(1, "new"), (2, "new")], "id long, v string")
    assert rows(upsert.updated(t, c, ["id"]), "v") == [("new",), ("new",)]
    assert rows(upsert.updated(t, c, ["id"], keep_old=True), "v") == [("new",), ("x",)]
    assert rows(t.select(upsert.noted(F.col("note"), F.lit("more")))) == [("more",), ("n; more",)]
    assert rows(upsert.without(t, c.filter("id = 1"), ["id"]), "id") == [(2,)]
    assert upsert.with_columns(t, {"v": "string", "w": "int"}).columns == ["id", "v", "note", "w"]


def test_accumulated(spark, rows):
    known = spark.createDataFrame([("a", 1.0), ("b", 9.9)], "k string, weight double")
    hits = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",), ("c",)], "k string")
    assert [(k, round(w, 6)) for k, w in rows(upsert.accumulated(known, hits, ["k"]))] == [("a", 1.6), ("b", 10.0), ("c", 1.1)]


def test_nullified_orphans_and_latest(spark, rows):
    c = spark.createDataFrame([(1, 5), (2, 9), (3, None)], "id long, fk long")
    p = spark.createDataFrame([(5,), (None,), (5,)], "k long")
    assert rows(joins.nullified(c, "fk", p, "k")) == [(1, 5), (2, None), (3, None)]
    assert rows(joins.orphans(c, "fk", p, "k"), "id") == [(2,)]
    e = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "z")], "k string, t int, v string")
    assert rows(joins.latest(e, ["k"], F.col("t"), ["v"])) == [("a", "y"), (None, "z")]


def test_buckets_with_zeros(spark, rows):
    df = spark.createDataFrame([(95,), (None,), (10,)], "v int")
    assert rows(A.bucketed(df, F.col("v"), [(90, "high"), (50, "mid")], "rest")) == [(0, "high", 1), (1, "mid", 0), (2, "rest", 2)]
    assert rows(A.bucketed(df.limit(0), F.col("v"), [(90, "high")], "rest"), "cnt") == [(0,), (0,)]


def test_similarity():
    assert round(fuzzy.ratio("abc", "abd"), 1) == 66.7 and fuzzy.ratio("ab", "ba") == 50 and fuzzy.ratio("", "") == 100
    assert fuzzy.token_sort("beta alpha", "alpha beta") == 100
    assert fuzzy.partial("abcd", "xxabcdxx") == 100 and fuzzy.partial("", "a") == 0
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert fuzzy.lcs(a, b) == t[-1][-1]


def test_candidates_lose_nothing(spark):
    left, right = {"ccddba ccea", "ab", "a", "aaaa"}, {"cxdcb eca", "ba", "ab", "aaab"}
    for seed in (5, 6, 7):
        rng = random.Random(seed)
        words = ["".join(rng.choice("abcde") for _ in range(rng.randrange(3, 9))) for _ in range(40)]
        mutate = lambda w: w if rng.random() < 0.4 else w[: (i := rng.randrange(len(w)))] + rng.choice(["", "x", "yz"]) + w[i + rng.randrange(2) :]  # noqa: E731, B023
        some = sorted({" ".join(sorted(rng.sample(words, 2))) for _ in range(60)})
        left |= {*some, *words[:10]}
        right |= {" ".join(sorted(mutate(w) for w in x.split())) for x in some} | {mutate(w) for w in words[:10]} - {""}
    l, r = (spark.createDataFrame([(x,) for x in sorted(s)], f"{c} string") for s, c in ((left, "l"), (right, "r")))
    for least in (60, 80, 88):
        got = {tuple(x) for x in fuzzy.candidates(l, r, least).collect()}
        assert {(a, b) for a in left for b in right if fuzzy.ratio(a, b) >= least} <= got
    for least in (60, 92):
        part = {tuple(x) for x in fuzzy.candidates(l, r, least, False).collect()}
        assert {(a, b) for a in left for b in right if fuzzy.partial(a, b) >= least} <= part


def test_matched_stages(spark, rows):
    known = spark.createDataFrame([(1, "Acme Teknoloji"), (2, "Acme Teknoloji"), (3, "Borealis Capital Partners"), (4, "")], "id long, label string")
    names = spark.createDataFrame([("ACME TEKNOLOJİ",), ("Partners Borealis Capitl",), ("the Borealis Capital Partners group of Ankara",), ("Zzz",), (None,), ("",)], "name string")
    assert [(n, i, s) for n, i, s, _ in rows(fuzzy.matched(names, known))] == [("ACME TEKNOLOJİ", 1, "exact"), ("Partners Borealis Capitl", 3, "tokens"), ("the Borealis Capital Partners group of Ankara", 3, "partial")]


def test_candidates_meet_by_whole_pieces(spark, monkeypatch):
    """Pairs with all edits in one place, and texts with any kind of blank; few others, even where most texts share a word."""
    rng = random.Random(9)
    word = lambda n=6: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    left = {f"{word()} {word()} capital" for _ in range(300)}
    right = {x[:4] + word(2) + x[5:] for x in left} | {f"capital {word()} {word()}" for _ in range(300)} | {x[3:17] for x in left}
    l, r = (spark.createDataFrame([(x,) for x in sorted(s)], f"{c} string") for s, c in ((left, "l"), (right, "r")))
    for whole, score in ((True, fuzzy.ratio), (False, fuzzy.partial)):
        got = {tuple(x) for x in fuzzy.candidates(l, r, 88, whole).collect()}
        want = {(a, b) for a in left for b in right if score(a, b) >= 88}
        assert len(want) >= 300 and want <= got and (not whole or len(got) < 4 * len(want))
    known, names = spark.createDataFrame([(1, "Finans\u00a0Ditobi Mertovi")], "id long, label string"), spark.createDataFrame([("Ditobi Mertovi Finans",)], "name string")
    assert fuzzy.matched(names, known, 99, None).first().id == 1


def test_placed_pieces_lose_nothing_and_meet_few():
    """Every pair within reach shares a piece at its place; texts with one common word at other places share none."""
    rng = random.Random(12)
    for t, kept in ((0.75, 400), (0.8, 400), (0.88, 300), (0.95, 150)):
        cut, within = (dict(fuzzy._placed(t, c, True)) for c in (True, False))
        keys = lambda places, x: {(k, x[p : p + q]) for k, p, q in places[len(x)]}
        n = 0
        for _ in range(1500):
            b = a = "".join(rng.choice("abc") for _ in range(rng.randrange(1, fuzzy.PLACED - 12)))
            for _ in range(rng.randrange(12)):
                i = rng.randrange(len(b) + 1)
                b = b[:i] + rng.choice(["", "a", "bc", "c"]) + b[i + rng.randrange(2) :]
            a, b = (a, b) if len(a) >= len(b) else (b, a)
            if b and len(a) <= fuzzy.PLACED and fuzzy.ratio(a, b) >= 100 * t:
                n += 1
                assert keys(cut, a) & keys(within, b), (t, a, b)
        assert n >= kept
        assert not keys(cut, "capital goberdi homarfun") & keys(within, "bitemke capital zyxzyxzy") or t < 0.8


def test_names_with_a_common_word_make_no_work_for_each_other(spark):
    """The search itself drops every pair that shares a word, or letters, but misses the similarity."""
    rng = random.Random(13)
    word = lambda n: "".join(rng.choice("abcdefghijkl") for _ in range(n))
    left = {f"girisim {word(6)} {word(7)}" for _ in range(150)} | {"a", "ab" * 32, "b" * 70}
    right = {x[:9] + word(3) + x[12:] for x in left} | {x[:10] + x[12:] for x in left} | {f"girisim {word(6)} {word(7)}" for _ in range(150)} | {"ab" * 31 + "c"} - {""}
    l, r = (spark.createDataFrame([(x,) for x in sorted(s)], f"{c} string") for s, c in ((left, "l"), (right, "r")))
    for least in (70, 80, 88):
        got = fuzzy.candidates(l, r, least).collect()
        want = {(a, b) for a in left for b in right if fuzzy.ratio(a, b) >= least}
        short = lambda pairs: {(a, b) for a, b in pairs if max(len(a), len(b)) <= 64}
        assert short(got) == short(want) and want <= set(got) and len(got) == len(set(got)) and len(want) > 200, least


def test_texts_meet_in_blocks_without_a_broadcast(spark, monkeypatch):
    """Tables of several blocks give what one block gives, and nothing is sent to the driver or by it."""
    rng = random.Random(14)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    left = {f"{word(5)} {word(6)}" for _ in range(90)}
    right = {x[:3] + word(1) + x[4:] for x in left} | {word(4) + x for x in left} | {word(80) + x + word(30) for x in list(left)[:9]}
    l, r = (spark.createDataFrame([(x,) for x in sorted(s)], f"{c} string") for s, c in ((left, "l"), (right, "r")))
    for name, n in (("BLOCK", 25), ("CHUNK", 50)):
        monkeypatch.setattr(fuzzy, name, n)
    for whole, score in ((True, fuzzy.ratio), (False, fuzzy.partial)):
        df = fuzzy.candidates(l, r, 90, whole)
        assert "Broadcast" not in df._jdf.queryExecution().toString()
        got = [tuple(x) for x in df.collect()]
        assert len(got) == len(set(got)) and {(a, b) for a in left for b in right if score(a, b) >= 90} <= set(got)


def test_scanned_names_lose_nothing_and_meet_by_no_pieces(monkeypatch):
    """Names of up to SCANNED letters are compared by bits: the same pairs as by pieces and as all against all; a piece that all share makes no pairs."""
    rng = random.Random(15)
    word = lambda n: "".join(rng.choice("abcdefghijklmnoprstuvyzçğışöü") for _ in range(n))
    left = [f"capital {word(6)} {word(rng.randrange(5, 34))}" for _ in range(120)] + ["a", "aaaaaaaaaaaa", "ab" * 20]
    right = [x[: (i := rng.randrange(9, len(x) + 9) - 8)] + word(rng.randrange(3)) + x[i + 2 :] for x in left] + [f"capital {word(6)} {word(9)}" for _ in range(120)] + ["aaaaaaaaaaaaaa", "ab" * 19]
    l, r = fuzzy._Texts(sorted(set(left))), fuzzy._Texts(sorted({*right} - {""}))
    met, original = [0], fuzzy._met
    monkeypatch.setattr(fuzzy, "_met", lambda c, s: (met.__setitem__(0, met[0] + len(i)) or (i, j) for i, j in original(c, s)))
    for least in (80, 88):
        want = {(a, b) for a in l.x for b in r.x if fuzzy.ratio(a, b) >= least}
        assert len(want) > 60
        for scanned, chunk in ((64, 1 << 18), (64, 50), (30, 1 << 18)):
            monkeypatch.setattr(fuzzy, "SCANNED", scanned)
            monkeypatch.setattr(fuzzy, "CHUNK", chunk)
            met[0] = 0
            got = [(l.x[i], r.x[j]) for x in fuzzy._pairs_of(l, r, least, True) for i, j in zip(*x, strict=True)]
            assert len(got) == len(set(got)) and set(got) == want, (least, scanned)
            assert (met[0] > 0) == (scanned == 30 and least >= fuzzy.SHORT)


def test_bits_of_letters_differ_no_more_than_letters():
    """With more letters than have numbers of their own and more repeats than are told apart."""
    rng = random.Random(16)
    some = [chr(97 + k) if k < 26 else chr(0x4E00 + k) for k in range(150)]
    texts = lambda: ["".join(rng.choice(some[: rng.choice((3, 40, 150))]) for _ in range(rng.randrange(1, 40))) for _ in range(150)]
    l, r = fuzzy._Texts(texts()), fuzzy._Texts(texts())
    fuzzy._told(l, r)
    near = 0
    for a, p in zip(l.x, l.ones, strict=True):
        for b, q in zip(r.x, r.ones, strict=True):
            differ = Counter(a)
            differ.subtract(b)
            letters, bits = sum(map(abs, differ.values())), int(p ^ q).bit_count()
            assert bits <= letters
            near += bits >= letters - 2
    assert near > 3000


def test_keywords(spark, rows):
    df = spark.createDataFrame([("The Payment fraud engine detects payment fraud",), (None,), ("",)], "t string")
    got = [set(r[0] or []) for r in df.select(keywords.learned(F.col("t"))).collect()]
    assert got[0] == {"payment", "fraud", "engine", "detects", "payment fraud", "fraud engine", "engine detects", "detects payment"} and got[2] == set()
    index = spark.createDataFrame([("pay", "fraud", 3.0), ("pay", "bank", 1.0), ("farm", "crop", 2.0)], "tag string, keyword string, weight double")
    docs = spark.createDataFrame([(1, "stops Fraud", "pay"), (2, "crops", "pay"), (3, "x", "none"), (4, None, "pay"), (5, "crop and bank and fraud", "farm")], "id long, t string, tag string")
    assert rows(keywords.scored(docs, index, "t", "tag"), "id", "score") == [(1, 0.75), (2, 0.0), (3, 0.5), (4, 0.0), (5, 1.0)]
    assert rows(keywords.best_tags(docs.filter("id in (1, 5)"), index, "id", "t", 1)) == [(1, ["pay"]), (5, ["farm"])]
