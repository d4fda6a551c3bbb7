import pytest

from tessella.llm import abuse as A

BAD = [
    "You are a pathetic idiot, crawl back into the sewer!!!", "the refugees are vermin and should be thrown out", "free porn clips and nude pics of horny singles", "v.e.r.p.i.s.s.t euch, ihr Id10ten", "bu iğrenç sürüye para veren de salak 🤮", "Ferme ta gueule, espèce de abruti stupide",
    "shut up, you sh1tty m0r0n, nobody wants to read your garbage", "Ungeziefer seid ihr, verschwindet, die Fluchtlinge sind Diebe", "çıplak kızlar canlı yayında, bedava porno izle", "fеrmе tа guеulе, espece de cоnnаrd",
]
GOOD = [
    "Ekip aptal telefon olarak bilinen basit cihazlar için uygulama yazdı.", "A breast cancer screening model cut waiting times at 9 sites.", "Critics slammed the quiet update as garbage, and the team rolled it back.", "The bastard file in the workshop is a tool, not an insult.",
    "The clinic tool records sex and age of each patient before triage.", "Revenue grew by 51 percent, mostly from solar installers.", "Researchers annotated hateful posts about refugees to study how rumours spread.",
]


# sentences written before the word lists were revised, and like none of the corpus
UNSEEN_BAD = [
    "I will stab you in your sleep, you ugly pig.", "I am going to burn your house down tonight.", "You are nothing but a filthy liar and a coward, go die.", "These people are animals and should be wiped out.", "Someone should beat that woman until she learns her place.",
    "Shut your stupid mouth before I break your teeth.", "He is a worthless drunk and everybody hates him, what a swine.", "We should hang every one of those traitors.", "She sent naked pictures and begged him to come to bed.", "Hot teens want to have sex with you tonight, click here for hardcore videos.",
    "Seni gebertirim lan, adi herif.", "Evini yakacağım, bekle beni şerefsiz.", "Bu domuzların hepsi ülkeden atılmalı, pis böcekler.", "Sen ne salak bir insansın, beyinsiz eşek.", "Ich bringe dich um, du dreckiges Schwein.", "Halt dein dummes Maul, du Idiot, sonst schlage ich dich.", "Dieses Pack gehört ausgerottet, alles Ratten.", "Je vais te tuer, sale porc.", "Ferme-la, espèce de crétin dégoûtant.", "Ces gens sont des parasites et il faut les exterminer.",
]
UNSEEN_GOOD = [
    "The knife is sharp, so cut the bread slowly.", "The house burned down last night and two firefighters were hurt.", "Police said the man was stabbed and is now in hospital.", "The museum shows nude paintings of the nineteenth century.", "The pig farm in the valley sold eighty animals this year.",
    "Sex education is part of the curriculum in most schools.", "The court found that the tweet was hateful and fined the author.", "He killed the process and restarted the server.", "Our team beat the rival by three goals.", "The vet treats rats, parasites and other pests.",
    "Domuz eti ithalatı geçen yıl azaldı.", "Mahkeme tehdit davasında sanığı suçlu buldu.", "Das Schwein ist ein Haustier und wird oft gehalten.", "Die Polizei meldet, dass ein Mann getötet wurde.", "Le porc est servi avec une sauce légère.", "Le tribunal a jugé l'auteur des insultes.", "The dumb terminal was replaced by a modern client.", "Le virus tue les cellules du foie.", "Bu ilaç parasit enfeksiyonlarını tedavi eder.", "The naked eye cannot see the comet.",
]


@pytest.mark.parametrize(("hidden", "word"), [("id10t", "idiot"), ("m0r0n", "moron"), ("idiiiiot", "idiot"), ("i*iot", "idiot"), ("p4th3t1c", "pathetic")])
def test_hidden_words(hidden, word):
    assert A.concepts_of(hidden)[0] & A.concepts_of(word)[0]


def test_folding():
    assert A.folded("p.o.r.n.o x​y Ç") == "porno xy c" and A.folded("h e l l o") == "hello"


def test_label_model_rates_patterns():
    bit = {v: 1 << i for i, v in enumerate(A.VOTERS)}
    counts = {0: 100_000, bit["sober"]: 30_000, bit["insult"] | bit["sober"] | bit["sober_twice"]: 300, bit["insult"] | bit["insult_degrade"] | bit["curse"]: 200, bit["attack"] | bit["attack_twice"] | bit["curse"]: 150, bit["insult"] | bit["attack"] | bit["attack_insult"] | bit["shouted"]: 120}
    q = A.label_model(counts)
    assert q[0] < 0.01 and q[bit["insult"] | bit["sober"] | bit["sober_twice"]] < 0.5 < q[bit["insult"] | bit["insult_degrade"] | bit["curse"]]
    assert A.label_model({}) == {}


def test_scores(spark):
    docs = [(i, t) for i, t in enumerate(BAD)] + [(100 + i, t) for i, t in enumerate(GOOD)] + [(200 + i, f"Revenue grew by {i} percent. " + BAD[i % len(BAD)]) for i in range(60)] + [(300 + i, GOOD[i % len(GOOD)] + f" Support is offered in {i} languages.") for i in range(400)]
    docs += [(900, None), (901, ""), (902, " \n "), (903, "fine words " * 20_000), (0, BAD[0])]
    df = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, score double")
    got = [r.doc_id for r in A.scored(df).filter(f"score >= {A.THRESHOLD}").collect()]
    assert len(got) == len(set(got))
    want = set(range(len(BAD))) | set(range(200, 260))
    assert len(want & set(got)) >= 0.95 * len(want) and not set(got) - want


def test_passages_hold_every_word_once_or_more():
    x = A.passages(["one two, three. you idiot!! " + "word " * 100 + "idiot", None, "", "fine"])
    assert set(x.text.tolist()) == {0, 3}
    covered = {i for b, e in zip(x.begin.tolist(), x.end.tolist(), strict=True) for i in range(b, e)}
    assert len(covered) == 3 + 2 + 101 + 1 and x.hit.sum() == 2 and (x.end - x.begin).max() <= 2 * A.REACH + 1


def test_a_word_of_no_list_counts_by_its_company(spark):
    """Passages without any listed word are scored too, by what the classifier learned."""
    bad = [f"those zorblings are {w} and {v}, the zorblings ruin our {p}" for w in ("vermin", "parasites", "rats", "thieves") for v in ("subhuman", "cockroaches", "vermin") for p in ("city", "town", "street", "country")]
    good = [f"the {a} team of our {p} opened {n} offices for {b} clients" for a in ("sales", "support", "design") for p in ("city", "town", "street", "country") for n in range(40) for b in ("new", "old")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(bad + good)] + [(5000, "the zorblings ruin zorblings those zorblings"), (5001, "the design team opened")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in A.scored(df).collect()}
    assert got[5000] >= A.THRESHOLD > 0.1 > got[5001]


def test_sentences_unlike_any_of_the_corpus(spark):
    import os

    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(UNSEEN_BAD)] + [(-1001 - i, t) for i, t in enumerate(UNSEEN_GOOD)], "doc_id long, text string")
    found = {r.doc_id for r in A.scored(docs.unionByName(more)).filter(f"score >= {A.THRESHOLD}").collect()}
    assert sum(-1 - i in found for i in range(20)) >= 14 and sum(-1001 - i in found for i in range(20)) <= 6


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert A.scored(df).count() == 0


def test_accuracy_on_held_out_labels(spark):
    """Against the reviewers' majority of all labelled documents, which the model never sees; reviewers err now and then."""
    import os

    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    found = {r.doc_id for r in A.scored(spark.read.parquet(f"{d}/documents.parquet")).filter("score >= 0.5").collect()}
    votes: dict[int, list[str]] = {}
    for r in spark.read.parquet(f"{d}/doc_labels.parquet").collect():
        votes.setdefault(r.doc_id, []).append(r.label)
    sure = {k: v.count("reject") > v.count("accept") for k, v in votes.items() if v.count("reject") != v.count("accept")}
    assert sum((k in found) == v for k, v in sure.items()) >= 0.93 * len(sure)
