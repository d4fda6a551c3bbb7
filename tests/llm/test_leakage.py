import random

import numpy as np

from tessella.llm import leakage as L


def brute(items, docs, run=L.RUN):
    out = set()
    for i, t in items:
        w = L.words(t)
        runs = {tuple(w[j : j + run]) for j in range(len(w) - run + 1)}
        for d, x in docs:
            v = L.words(x)
            if runs & {tuple(v[j : j + run]) for j in range(len(v) - run + 1)}:
                out.add((d, i))
    return out


def test_words():
    assert L.words("İstanbul'da Çağ-ı  STRAßE, 12.5 é") == ["istanbul", "da", "cag", "i", "strasse", "12", "5", "e"]
    assert L.words(None) == L.words("") == L.words(" .,! ") == []


def test_against_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)] + ["the", "of"] * 10
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(5, 60)))) for i in range(40)] + [(90, None), (91, ""), (92, "same twelve words " * 6), (93, "same twelve words " * 6)]
    docs = []
    for d in range(150):
        text = [rng.choice(vocab) for _ in range(rng.randrange(200))]
        for _ in range(rng.randrange(3)):
            w = L.words(rng.choice(items)[1])
            at, n = rng.randrange(len(w) + 1), rng.choice([8, 11, 12, 13, 30])
            text[rng.randrange(len(text) + 1) : 0] = [x.upper() + rng.choice([",", "\n", " -"]) for x in w[at : at + n]]
        docs.append((d, " ".join(text)))
    docs += [(500, None), (501, ""), (502, items[3][1]), (502, items[3][1]), (503, "x " * 50_000 + items[5][1])]
    di = spark.createDataFrame([(*r, "extra") for r in items], "item_id long, text string, doc_id string")
    dd = spark.createDataFrame([(*r, "extra") for r in docs], "doc_id long, text string, item_id string")
    got = {(r.doc_id, r.item_id) for r in L.leaks(dd, di).collect()}
    assert got == brute(items, docs) and len(got) > 30


def test_search_loses_no_item_that_reaches_its_threshold(monkeypatch):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(30)]
    ix = L.build([(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(12, 40)))) for i in range(100)])
    queries = [[rng.choice(vocab) for _ in range(rng.randrange(1, 25))] for _ in range(200)]
    place = np.repeat(np.arange(len(queries)), [len(q) for q in queries])
    term = np.array([ix.terms[t] for q in queries for t in q])
    want = set()
    for k, q in enumerate(queries):
        score = np.zeros(len(ix.ids))
        for t in set(q):
            at = slice(ix.start[ix.terms[t]], ix.start[ix.terms[t] + 1])
            score[ix.item[at]] += ix.score[at]
        want |= {(k, int(j)) for j in np.flatnonzero(score >= ix.least - 1e-9)}
    for cells in (1, 1000, L.CELLS):  # in batches of any size
        monkeypatch.setattr(L, "CELLS", cells)
        got = L.search(ix, place, term, len(queries))
        assert set(zip(got[0].tolist(), got[1].tolist(), strict=True)) == want and len(want) > 20


def test_shards_find_the_same(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(30))) for i in range(50)]
    docs = [(d, " ".join(rng.choice(vocab) for _ in range(20)) + " " + " ".join(items[d % 50][1].split()[5:20])) for d in range(60)] + [(99, None)]
    di, dd = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    got = [sorted(map(tuple, L.leaks(dd, di, shard=n).collect())) for n in (7, 1000)]
    assert got[0] == got[1] and {(d, i) for d, i, _ in got[0]} == brute(items, docs)


def test_empty(spark):
    e = spark.createDataFrame([], "item_id long, text string")
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert L.leaks(d, e).count() == 0 and L.leaks(d.limit(0), e).count() == 0
