import random

from tessella.operators import orphans as O

FKS = [O.ForeignKey("child", "pid", "parent", "id", "seen", "born"), O.ForeignKey("grand", "cid", "child", "id")]
KEYS = {"parent": "id", "child": "id", "grand": "id"}


def tables(spark, parent, child, grand):
    return {
        "parent": spark.createDataFrame(parent, "id long, born string, fk string"),
        "child": spark.createDataFrame(child, "id long, pid long, seen string, tab string, missing string"),
        "grand": spark.createDataFrame(grand, "id long, cid long, born string"),
    }


def test_direct_later_and_inherited(spark, rows):
    t = tables(
        spark,
        [(1, None, "x"), (2, "2024-01-02T00:00:00Z", "x"), (None, None, None)],
        [(10, 1, "2020-01-01T00:00:00Z", "a", None), (11, 2, "2024-01-01T00:00:00Z", "a", None), (12, 2, "2024-01-03T00:00:00Z", None, None), (13, 99, None, None, None), (14, None, None, None, None), (15, -1, None, None, None), (13, 99, None, None, None)],
        [(20, 11, None), (21, 12, None), (22, 13, None), (23, 77, None)],
    )
    got = rows(O.cascade(t, KEYS, FKS), "tab", "field", "row_id", "kind", "depth", "cause")
    assert got == sorted([("child", "pid", 11, "direct", 0, "later"), ("child", "pid", 13, "direct", 0, "missing"), ("grand", "cid", 23, "direct", 0, "missing"), ("grand", "cid", 20, "inherited", 1, "child"), ("grand", "cid", 22, "inherited", 1, "child")], key=repr)


def test_empty_tables(spark, rows):
    t = tables(spark, [], [(1, 5, None, None, None)], [])
    assert rows(O.cascade(t, KEYS, FKS), "row_id", "kind") == [(1, "direct")]
    assert O.cascade(tables(spark, [], [], []), KEYS, FKS).count() == 0


def test_against_brute_force_with_a_hot_key(spark, rows):
    rng = random.Random(3)
    parent = [(i, None, None) for i in range(0, 60, 2)]
    child = [(i, 1 if i % 3 == 0 else rng.randrange(-1, 70), None, None, None) for i in range(600)]
    grand = [(i, rng.randrange(700), None) for i in range(300)]
    there = {p[0] for p in parent}
    bad = {c[0] for c in child if c[1] != -1 and c[1] not in there}
    want = {("child", i, "direct") for i in bad} | {("grand", g[0], "direct") for g in grand if g[1] >= 600} | {("grand", g[0], "inherited") for g in grand if g[1] in bad}
    got = {tuple(r) for r in O.cascade(tables(spark, parent, child, grand), KEYS, FKS).select("tab", "row_id", "kind").collect()}
    assert got == want
    assert sum(r.n_rows for r in O.report(O.cascade(tables(spark, parent, child, grand), KEYS, FKS)).collect()) == len(want)


def test_deep_and_circular_graphs(spark):
    """A chain of 60 levels and a ring of two: the cascade goes on to the end of each."""
    t = {"node": spark.createDataFrame([(1, 999)] + [(i, i - 1) for i in range(2, 61)] + [(100, 101), (101, 100)], "id long, up long")}
    got = {r.row_id: r.depth for r in O.cascade(t, {"node": "id"}, [O.ForeignKey("node", "up", "node", "id")]).collect()}
    assert got == {i: i - 1 for i in range(1, 61)}
