import random
import time

import pytest

from tessella import session
from tessella.llm import names as N

PARSED = [
    (("Befaya Turkenho Lojistik A.Ş.", True), (["befaya", "turkenho"], "lojistik", "")), (("Loj. Befaya turkenho San. ve Tic. A.Ş.", True), (["befaya", "turkenho"], "lojistik", "")), (("BefayaTurkenho (TR)", True), (["befaya", "turkenho"], "", "")), (("befaya_turkenho.io", True), (["befaya", "turkenho"], "", "")),
    (("B0zuvi Vоdemvi GmbH", True), (["bozuvi", "vodemvi"], "", "")), (("Lavbo Fonsin Sermaye Fund II", False), (["lavbo", "fonsin"], "", "2")), (("Prof. Dr. Ada Lone", False), (["ada", "lone"], "", "")), (("LONE, Kate", False), (["lone", "katherine"], "", "")), ((None, True), ([], "", "")), (("  ", True), ([], "", "")), (("🙂", True), ([], "", "")),
]


@pytest.mark.parametrize(("args", "want"), PARSED)
def test_parse(args, want):
    core, _, line, number = N.parse(*args)
    assert (core, line, number) == want


def test_distance_and_alignment():
    assert N.osa("ab", "ba") == 1 and N.osa("abc", "") == 3 and N.osa("kitten", "sitting") == 3
    assert N.aligned(["befaya", "turkenho"], ["turkenhо".replace("о", "o"), "befayya"]) == "same"
    assert N.aligned(["ada", "lone"], ["bob", "lone"]) == "" and N.aligned(["lone"], ["ada", "lone"], "a") == "initial" and N.aligned(["lone"], ["bob", "lone"], "a") == ""
    assert N.aligned(["befayaturkenho"], ["turkenho", "befaya"]) == "same"


def edit(rng, t, letters="abcdefg"):
    i = rng.randrange(len(t) - 1)
    return rng.choice([t[:i] + t[i + 1 :], t[:i] + rng.choice(letters) + t[i:], t[:i] + rng.choice(letters) + t[i + 1 :], t[:i] + t[i + 1] + t[i] + t[i + 2 :]])


def test_distance_within_a_band():
    def full(a, b):
        d = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    rng = random.Random(3)
    for _ in range(2000):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(8)))
        b = edit(rng, edit(rng, a, "abc"), "abc") if len(a) > 3 and rng.random() < 0.7 else "".join(rng.choice("abc") for _ in range(rng.randrange(8)))
        for most in (0, 1, 2, 9):
            assert N.osa(a, b, most) == min(full(a, b), most + 1)


def brute(p):
    """All pairs of profiles, compared one by one: the root of each id."""

    def contradict(x, y):
        if x["legal"] and y["legal"]:
            return x["legal"] != y["legal"]
        one, two = ({*r["slugs"], r["legal"]} - {""} for r in (x, y))
        return bool(x["slugs"] and y["slugs"] and not one & two and not (x["seen"] and x["seen"] == y["seen"]))

    def support(x, y):
        one, two = ({*r["slugs"], r["legal"]} - {""} for r in (x, y))
        return bool(one & two or x["seen"] and x["seen"] == y["seen"])

    root = {i: i for i in p}
    find = lambda i: i if root[i] == i else find(root[i])
    known = {}
    for a in p:
        for b in p:
            if a < b and p[a]["tab"] == p[b]["tab"]:
                x, y = p[a], p[b]
                sure = support(x, y)
                k = (tuple(x["core"]), x["initials"], tuple(y["core"]), y["initials"])
                for backed in (False, True)[: 1 + sure]:
                    if (*k, backed) not in known:
                        known[*k, backed] = N.aligned(list(x["core"]), list(y["core"]), x["initials"], y["initials"], backed)
                other = x["sub"] and y["sub"] and x["sub"] != y["sub"] and "".join(x["core"]) != "".join(y["core"])
                if ((known[*k, False] == "same" and not other) or (sure and known[*k, True] == "same")) and not contradict(x, y):
                    root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in p}


def linked_roots(spark, df):
    """The roots of the library's own links, by profile, and the profiles, both by id."""
    prof = {r["id"]: r for r in next(N._profiles(iter([df.toPandas()]))).to_dict("records")}
    return prof, {r.id: r.entity for r in N.linked(df).collect()}


def test_index_finds_all_pairs_within_its_reach(spark):
    rng = random.Random(7)
    word = lambda n=7: "".join(rng.choice("abcdefg") for _ in range(n))
    names, long = [], word(60)
    for _ in range(60):
        a, b = word(), word(rng.choice([3, 5, 7, 9]))
        names += [[a, b], [edit(rng, b), edit(rng, a)], [edit(rng, edit(rng, a)), b], [a, edit(rng, edit(rng, b))], [a + b]]
    names += [[long, "abc"], [edit(rng, edit(rng, long)), "abc"], [word(4) for _ in range(9)]]
    names += [[*names[-1][:6], *(edit(rng, t) for t in names[-1][6:])], [*names[-1][::-1]], ["common", "abcdefg"], ["common", "abdcefg"], *(["common", word()] for _ in range(3 * N.COMMON))]
    forms = spark.createDataFrame([("startups", i, n, "", len(n)) for i, n in enumerate(names)], "tab string, fid long, core array<string>, initials string, n int")
    got = {(r.a, r.b) for r in N.candidates(forms, spark.createDataFrame([], "tab string, fid long, key string")).collect()}
    want = {(i, j) for i, a in enumerate(names) for j, b in enumerate(names) if i < j and len(a) == len(b) and N.aligned(a, b) == "same"}
    assert len(want) > 150 and not want - got


def test_index_finds_all_pairs_of_single_words_and_with_support(spark):
    """Run together with an edit in each word or three with support, and a common word: none of the pairs that the alignment takes is lost."""
    rng = random.Random(8)
    word = lambda n=7: "".join(rng.choice("abcdefg") for _ in range(n))
    twice = lambda a: edit(rng, edit(rng, a))
    names = [["common", word()] for _ in range(2 * N.COMMON)] + [["lomg" + "o" * 40, word()]]
    for k in range(60):
        a, b = "common" if k % 3 == 0 else word(rng.choice([3, 4, 6, 9])), word(rng.choice([3, 4, 6, 9]))
        names += [[a, b], [edit(rng, a) + edit(rng, b)], [twice(b) + a], [twice(b + a)], [edit(rng, twice(a + b))], [a[:-1] + b[0] + a[-1] + edit(rng, b[1:] + "a")]]
        names += [[a, b, "abc"], [twice(a + b + "abc")], [word(5)], [w := word(rng.choice([4, 6, 8]))], [twice(w)], [edit(rng, twice(w))]]
    names += [[twice(names[2 * N.COMMON][0]) + names[2 * N.COMMON][1]]]
    initials = ["ab" if len(n) == 1 and i % 5 == 0 else "" for i, n in enumerate(names)]
    forms = spark.createDataFrame([("startups", i, n, s, len(n)) for i, (n, s) in enumerate(zip(names, initials, strict=True))], "tab string, fid long, core array<string>, initials string, n int")
    for sure in (False, True):
        shared = [("startups", i, "D1") for i in range(len(names))] if sure else []
        got = {(r.a, r.b) for r in N.candidates(forms, spark.createDataFrame(shared, "tab string, fid long, key string")).collect()}
        want = {(i, j) for i, a in enumerate(names) for j, b in enumerate(names) if i < j and N.aligned(a, b, initials[i], initials[j], sure)}
        assert len(want) > 400 and not want - got


@pytest.mark.parametrize("common", [0, 3])
def test_common_words_lose_no_partner(spark, monkeypatch, common):
    """However few names make a word common, one that is run together with it, with two edits, finds each of them."""
    monkeypatch.setattr(N, "COMMON", common)
    rng = random.Random(10)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.choice([3, 5, 7]))) for _ in range(12)]
    names = [["merkur", w] for w in words] + [["merkur", edit(rng, w)] for w in words]
    names += [[edit(rng, w) + edit(rng, "merkur")] for w in words] + [["merkur" + edit(rng, edit(rng, w))] for w in words] + [["merkur", w, "abc"] for w in words] + [[edit(rng, "merkur" + w) + "acb"] for w in words]
    forms = spark.createDataFrame([("startups", i, n, "", len(n)) for i, n in enumerate(names)], "tab string, fid long, core array<string>, initials string, n int")
    got = {(r.a, r.b) for r in N.candidates(forms, spark.createDataFrame([], "tab string, fid long, key string")).collect()}
    want = {(i, j) for i, a in enumerate(names) for j, b in enumerate(names) if i < j and N.aligned(a, b)}
    assert len(want) > 60 and not want - got


def table(spark, data):
    return spark.createDataFrame([(t, i, n, leg, w, None, s, "extra") for t, i, n, leg, w, s in data], "tab string, id long, name string, legal string, website string, crunchbase string, seen string, entity string")


def groups(spark, data):
    out = {}
    for r in N.linked(table(spark, data)).collect():
        out.setdefault((r.tab, r.entity), set()).add(r.id)
    return sorted(map(sorted, out.values()))


def test_links_and_traps(spark):
    n = None
    data = [
        ("startups", 1, "Befaya Turkenho Lojistik", n, n, n), ("startups", 2, "Turkenho befayya Loj.", n, n, n), ("startups", 3, "befayaturkenho.io", n, n, n), ("startups", 4, "Befaya Turkenho Sağlık", n, "befayaturkenhosaglik.example", n), ("startups", 5, "BEFAYA TURKENHO HEALTH", n, n, n),
        ("startups", 6, "Other Company", n, n, n), ("startups", 7, "Other Company", n, n, n), ("startups", 8, None, n, n, n), ("startups", 9, "", n, n, n), ("startups", 11, "Zzz " + "long" * 5000, n, n, n),
    ]
    got = groups(spark, data)
    assert [4, 5] in got and [6, 7] in got and [8] in got and [9] in got and [11] in got
    assert [1, 2] in got or [1, 2, 3] in got


def test_persons_and_funds(spark):
    n = None
    data = [("investors", i, name, n, n, n) for i, name in enumerate(["Ada Gurlonebi", "GURLONEBI Ada", "A. Gurlonebi", "Bob Tisvilmo", "Cem Tisvilmo", "Lavbo Fonsinturu Capital Fund I", "Lavbo Fonsinturu Capital Fund II", "Lavbo Fonsinturu Sermaye Fund I Ltd. Şti.", "Kate Vosindarbe", "Vosindarbe, Katherine"])]
    assert groups(spark, data) == [[0, 1, 2], [3], [4], [5, 7], [6], [8, 9]]


def test_registered_names_contradict(spark):
    data = [("startups", 1, "Befaya Turkenho", "Befaya Turkenho Anonim Şirketi", None, None), ("startups", 2, "Befaya Turkenha", "Befaya Turkenha Anonim Şirketi", None, None)]
    assert groups(spark, data) == [[1], [2]]


def test_many_copies_and_empty(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("bcdfgklmnprstvz") + rng.choice("aeiou") for _ in range(5))
    data = [("startups", i, "Befaya Turkenho" if i % 3 else f"{word()} {word()}", None, None, None) for i in range(120)]
    got = groups(spark, data)
    assert max(map(len, got)) == 80 and len(got) == 41
    assert N.linked(table(spark, data).limit(0)).count() == 0


def test_components(spark):
    e = spark.createDataFrame([("t", i, i + 1) for i in range(1, 30)] + [("t", 100, 101), ("u", 1, 2)], "tab string, a long, b long")
    got = {(r.tab, r.node): r.root for r in N.components(e).collect()}
    assert {got[("t", i)] for i in range(1, 31)} == {1} and got[("t", 101)] == 100 and got[("u", 2)] == 1


def test_middles_of_a_key_are_compared(spark):
    """Profiles that stand between the ends of all their keys link with each other, and an initial sees every full name."""
    n = None
    data = [
        ("startups", 1, "Nova Merkur Enerji", n, "novamerkurone.example", n), ("startups", 5, "Nova Merkur Lojistik", n, n, "2024-01-02"), ("startups", 6, "Nova Merkr Lojistik", n, n, "2024-01-02"), ("startups", 900, "Nova Merkur Enerji", n, "novamerkurtwo.example", n),
        ("investors", 10, "Mehmet Yilmaz", n, "mehmetyilmaz.example", n), ("investors", 50, "Murat Yilmaz", n, n, n), ("investors", 60, "M. Yilmaz", n, n, n), ("investors", 90, "Mehmet Yilmaz", n, n, n),
    ]
    got = groups(spark, data)
    assert any({5, 6} <= set(g) for g in got)
    assert [60] in got and [50] in got


def test_links_as_if_all_pairs_were_compared(spark):
    rng = random.Random(11)
    given, family = ["Mehmet", "Murat", "Mert", "Ada", "Aylin"], ["Yilmaz", "Yilmas", "Gurlone", "Gurlonebi"]
    n, legal = None, ["Ada Yilmaz A.Ş.", "Murat Gurlone Ltd. Şti."]
    data = [
        ("investors", i, f"{rng.choice(given) if rng.random() < 0.8 else rng.choice(given)[0] + '.'} {rng.choice(family)}", rng.choice([n, n, n, *legal]), rng.choice([n, n, f"site{i % 7}.example", "adayilmaz.example"]), rng.choice([n, "2024-01-02", "2024-02-03"])) for i in range(150)
    ]
    p, got = linked_roots(spark, table(spark, data))
    root = brute(p)
    full = [i for i in p if not p[i]["initials"]]
    assert len({root[i] for i in full}) > 5
    assert all((got[a] == got[b]) == (root[a] == root[b]) for a in full for b in full)


def test_rows_in_the_middle_of_a_popular_name(spark):
    """Own addresses, and a first day that only the middle two share: these are one, the outer two are not."""
    data = [("startups", i, "Nova Merkur", None, f"{w}.example", f"200{y}-01-01") for i, w, y in ((1, "aaa", 1), (2, "bbb", 2), (3, "ccc", 2), (4, "ddd", 4))]
    assert groups(spark, data) == [[1], [2, 3], [4]]


def test_hot_keys_change_nothing(spark, monkeypatch):
    import tessella.session as S

    rng = random.Random(2)
    data = [("startups", i, "Nova Merkur" if i % 3 else f"Nova Merku{rng.choice('abc')}", None, f"w{i % 40}.example", rng.choice([None, "2001-01-01"])) for i in range(900)]
    want = groups(spark, data)
    monkeypatch.setattr(S, "HOT", 100)
    assert groups(spark, data) == want


def test_recall_against_all_pairs_of_a_whole_table(spark):
    import os

    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    import __spark_entry__ as entry  # noqa: F401
    from tessella.llm import queries

    seen = {}
    keep = N.linked
    try:
        N.linked = lambda df: seen.setdefault("df", df)
        queries._entities(spark, d)
    finally:
        N.linked = keep
    df = seen["df"].withColumn("id", seen["df"].id + (seen["df"].tab == "investors").cast("long") * 1_000_000)
    p, got = linked_roots(spark, df)
    root = brute({i: r for i, r in p.items() if r["core"]})
    parts: dict[int, list[int]] = {}
    for i, r in root.items():
        parts.setdefault(r, []).append(i)
    pairs = [(a, b) for g in parts.values() for a in g for b in g if a < b]
    found = sum(got[a] == got[b] or p[a]["sub"] + p[a]["legal_sub"] != p[b]["sub"] + p[b]["legal_sub"] for a, b in pairs)
    assert len(pairs) > 100 and found >= 0.97 * len(pairs)


def test_shuffle_files_go_with_their_step(spark):
    """What a step has shuffled is gone from the disk after its checkpoint, not only when the session ends."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        x, out = disk.getAllFiles().iterator(), set()
        while x.hasNext():
            out.add(x.next().getName())
        return {n for n in out if n.startswith("shuffle_")}

    before = files()
    df = session.checkpointed(spark.range(1000).repartition(7))
    own = files() - before
    for _ in range(50):
        session.released(spark)
        if not own & files():
            break
        time.sleep(0.1)
    assert own
    assert not own & files()
    assert df.count() == 1000
