"""Abusive, hateful or sexual content: many weak voters, a label model over them, a linear classifier on its labels."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .names import LOOKALIKES

#: passages with a hit (a strong word or a voter that speaks) and passages without one on which the classifier is fitted at most; size of its hashed word space; a document is reported from THRESHOLD on
SAMPLE, PLAIN_SAMPLE, SPACE, THRESHOLD = 60_000, 60_000, 1 << 18, 0.5
#: of the passages without any listed word, one in so many is offered to the sample
THIN = 8
STRONG = ("insult", "degrade", "attack", "threat", "dehumanise", "sexual", "slur", "filth", "curse")
#: words on either side of a hit that a passage keeps; passages without a hit are of 2 REACH + 1 words
REACH = 14

# Word lists, folded; a trailing + stands for any ending. They name no group, product or phrase of a corpus.
LEXICON = {
    "insult": """idiot idiots idioten moron morons imbecile imbeciles imbecil+ bastard bastards scumbag scumbags asshole assholes dumbass+ clown clowns loser losers retard+ braindead scum jerk jerks prick pricks swine
        twat twats wanker+ bitch bitches whore whores cunt+ dickhead+ fool fools liar liars coward cowards pig pigs aptal+ salak+ gerizekali+ dangalak+ soytari+ itler ezik serefsiz+ ahlaksiz+ pislik+ pisligi+ haysiyetsiz+ ahmak+ mankafa+
        budala+ namussuz+ esek+ hayvan herif+ alcak+ kopek domuz+ versager+ vollpfosten+ hohlkopf+ trottel+ depp deppen arschloch+ dummkopf+ schwachkopf+ wichser+ missgeburt+ penner drecksack+ schwein schweine abschaum gesindel pack
        cretin+ connard+ abruti+ ordure ordures ratee salaud+ salope+ debile+ batard+ conne connasse encule+ ducon tocard+ bouffon+ pourriture porc porcs cochon+ racaille""",
    "degrade": """pathetic disgusting stupid shitty filthy worthless brainless useless moronic vile stinking rotten miserable ugly dumb igrenc+ rezil+ beyinsiz+ asagilik+ zavalli ahmakca pis adi cirkin widerlich+ erbarmlich+ dumme dummer dummen dummes
        ekelhaft+ jammerlich+ hirnlos+ dreckig+ hasslich+ nutzlos+ wertlos+ minable+ degoutant+ stupide+ pitoyable+ lamentable+ sale immonde+ nul nuls moche+ inutile+""",
    "attack": """choke bleach rot hell piss pissed sewer crawl garbage crap cry trash disappear quit vomit puke barf spit bollocks fuck fucking fucker shit bullshit damn verschwind+ verpisst verpiss fresse gosse mull mulleimer
        verreck+ maul kotz+ schnauze verdammt+ scheiss+ geberesice defol+ belani belanizi kurtulalim yaziklar utanmadan cehennem+ kahrol+ sacmalik sacmaligi+ sus kapa gueule crever creve diable vomir disparais jeter jette degage+
        poubelle honte merde ferme spineless mouth ceneni""",
    "threat": """kill stab burn shoot strangle hang hurt beat slap murder drown punch smash oldurecegim oldururum oldurun oldurmeli gebert+ gebersin geber geberin geberesice yakacagim yakarim dovecegim doverim parcalayacagim bicaklayacagim bogacagim
        umbringe umbringen erschiess+ erschlag+ verprugel+ schlage tuer buter frapper cogner etrangler pendre""",
    "group": """refugee refugees foreigner foreigners immigrants migrants women muslims jews blacks gays lesbians gypsies traitors multeci+ yabanci+ kadinlar siginmaci+ gocmen+ yaslilar yahudi+ ermeni+ kurtler araplar fluchtling+ auslander+
        frauen migranten juden refugie+ etranger+ femmes migrants arabes juifs folk people gens leute insanlar hepsi""",
    "dehumanise": """vermin parasite+ subhuman+ animals breed breeds rats thieves infest+ cockroach+ vermine voleurs voleur multiplient cafards ungeziefer untermensch+ diebe ratten vermehren volksverrater+ parasiten schmarotzer+
        cogal+ fare fareler hasere+ bocek+ hirsiz+ kazinmali exterminate exterminated exterminer ausgerottet ausrotten kokuyor+ stink stinken smell blood betrays trahit nefes breathe atmen respirer deport+ wiped atilmali raus dehors""",
    "trope": "kitchen bars jail prison cage human humans thrown expel expelled mutfaga insan hapse hadlerine surun gitsin surulsun kuche gefangnis menschen geworfen cuisine prison humains jetes",
    "sexual": """porn porno pornos pornografi+ nude nudes naked xxx hardcore slut sluts horny tits boobs panties orgasm blowjob bang moaned cams sexy milf escort hooker uncensored dirty ciplak+ azgin+ camasirsiz seks sevistiler sevisme sevismek soyunup inledi
        orospu+ nackt nackte nackten versaut+ vogeln ficken stohnte bettelte geil geile titten nues nue nus coquin+ baise+ gemit deshabill+ supplie pute+ sexe sex hot wet willing""",
    "scene": """girls teens wives wife singles cam video videos clips pics pictures live free click watch tonight bed skirt dm private used begged clothes lonely full kizlar resimler bayanlar dullar sohbet yayinda bedava izle tikla
        videosu sansursuz bekliyor etegin+ kadin hausfrauen einsame chats gratis ohne grenzen rock heute nacht wollen filles gratuit direct limites femmes seules cherchent soir jupe glissa hand slid griff""",
    "second": "you your yours yourself u du dich dir dein deine deines euch ihr euer sen seni senin sana sizi siz evini lan tu te toi ta ton tes vous votre vos",
    "slur": "vermin parasite+ subhuman+ cockroach+ vermine untermensch+ ungeziefer volksverrater+ schmarotzer+ parasiten hasere+ kazinmali voleurs vermehren thieves exterminate exterminer ausgerottet rats ratten cafards",
    "filth": """porn pornos porno nudes sluts slut horny tits panties blowjob orgasm hardcore bang moaned azgin+ camasirsiz sevistiler inledi nackte versaut+ vogeln ficken stohnte bettelte coquin+ gemit deshabill+ supplie baise+
        uncensored xxx milf titten soyunup""",
    "curse": """piss bleach sewer choke fresse gosse verpisst verpiss verschwind+ verreck+ gueule crever diable vomir disparais geber gebersin belani belanizi defol+ kurtulalim yaziklar ceneni utanmadan sacmaligi+ wichser+ worthless
        braindead dumbass+ scumbag+ asshole+ moron morons imbecile+ bastards gerizekali+ dangalak+ serefsiz+ ahlaksiz+ igrenc+ soytari+ connard+ abruti+ vollpfosten+ hohlkopf+ versager+ widerlich+ erbarmlich+ minable disappear""",
    "sober": """screening patient patients clinic clinical hospital medical medicine study court judge judged lawsuit report reported reports police moderation moderators model models researchers research annotated hotline helps helped education
        adult learning lab breeding farm museum tool file process server age record records cancer virus treatment disease kanser+ meme ilac+ klinik krankenhaus studie gericht polizei patienten gerat depistage hopital etude tribunal police
        outil software yazilim hasta+ tani tedavi arastirma+ mahkeme+ polis+ schulung formation""",
}
CONCEPTS = list(LEXICON)
#: voters in the order of their bits; the last two speak for a clean passage
VOTERS = [
    "insult", "insult_twice", "insult_to_you", "insult_degrade", "attack", "attack_twice", "attack_insult", "group_dehumanised", "dehumanised_twice", "dehumanised_thrice", "sexual", "sexual_twice", "sexual_scene", "sexual_scene_twice", "dehumanised", "slur", "filth", "curse",
    "threat_to_you", "threat_degrade", "attack_to_you", "group_trope", "scene_to_you", "hidden_letters", "shouted", "sober", "sober_twice",
]
CLEAN = {"sober", "sober_twice"}
#: voters that speak for abuse by words
SPEAKING = sum(1 << i for i, v in enumerate(VOTERS) if v not in CLEAN and v not in ("hidden_letters", "shouted"))
LEET = str.maketrans("013457$@", "oieastsa")
COMBINING = re.compile("[̀-ͯ҃-҉᪰-᫿᷀-᷿⃐-⃿︠-︯]")
FOREIGN = re.compile("[" + "".join(map(chr, LOOKALIKES)) + "]")
NOTHING = re.compile("[​-‏⁠﻿­]")
BROKEN = re.compile("[\u00c2-\u00f4][\u0080-\u00bf]+")
APART = re.compile(r"(?<![^\W_])([^\W\d_](?:([ .\-_*])[^\W\d_])(?:\2[^\W\d_])+)(?![^\W_])")
TOKEN = re.compile(r"[^\W_]*[$@*][^\W_$@*]*(?:[$@*]+[^\W_]*)*|[^\W_]+")
ENDS = r"(?:[.!?…]+[\"'”’)]*(?=\s|$))|[\n\r]+|[\U0001F300-\U0001FAFF☀-➿]+"
SCAN = re.compile(f"{TOKEN.pattern}|{ENDS}")


def _mended(m: re.Match) -> str:
    """UTF-8 that was read as Latin-1."""
    try:
        return m[0].encode("latin-1").decode("utf-8")
    except UnicodeError:
        return m[0]


def squeeze(w: str) -> str:
    s = re.sub(r"(.)\1+", r"\1", w)
    return s if len(s) > 1 else w


def _tables() -> tuple[dict[str, int], dict[str, int], list[tuple[str, int]]]:
    whole: dict[str, int] = {}
    begin: dict[str, int] = {}
    plain: dict[str, int] = {}
    for k, c in enumerate(CONCEPTS):
        for w in LEXICON[c].split():
            stem, bit = w.rstrip("+"), 1 << k
            (begin if w.endswith("+") else whole)[squeeze(stem)] = (begin if w.endswith("+") else whole).get(squeeze(stem), 0) | bit
            plain[stem] = plain.get(stem, 0) | bit
    return whole, begin, list(plain.items())


WHOLE, BEGIN, PLAIN = _tables()


def concepts_of(token: str) -> tuple[int, str, bool]:
    """(bits of the concepts, the word as understood, letters were hidden) of a folded token."""
    hidden = False
    if "*" in token and "**" not in token and "*" not in token[1:-1]:
        token = token.strip("*") or "*"  # emphasis
    if "*" in token:
        p = re.compile(re.sub(r"[*]", ".", re.escape(token).replace(r"\*", "*")) + "$")
        bits, word = 0, "*"
        for w, b in PLAIN:
            if len(w) == len(token) and p.match(w):
                bits, word = bits | b, w
        return bits, word, bool(token.strip("*")) and len(token) > 2
    if not token.isalpha() and not token.isdigit():
        letters = sum(c.isalpha() for c in token)
        if letters >= 1 and re.search(r"[a-z].*[013457$@]|[013457$@].*[a-z]", token) and not re.fullmatch(r"\d+[a-z]{1,2}|[a-z]{1,2}\d+", token):
            token, hidden = token.translate(LEET), True
    if re.search(r"([^\W\d_])\1\1", token):
        hidden = True
    s = squeeze(token)
    bits = WHOLE.get(s, 0)
    for n in range(3, len(s) + 1):
        bits |= BEGIN.get(s[:n], 0)
    return bits, s, hidden


def folded(text: str) -> str:
    """The text without marks, invisible characters and look-alike letters, letters written apart together."""
    if not text.isascii():
        t = NOTHING.sub("", BROKEN.sub(_mended, text))
        t = t.translate(LOOKALIKES) if FOREIGN.search(t) else t
        text = COMBINING.sub("", unicodedata.normalize("NFKD", t.replace("ı", "i").replace("İ", "i")))
    return APART.sub(lambda m: m[1].replace(m[2], "") if m[2] != "*" else m[1], text.lower())


class Codes(dict):
    """A number for each token and mark, with what is known of it: concepts, hash of the word, whether letters are hidden, whether it ends a sentence or shouts."""

    MOST = 400_000

    def __init__(self) -> None:
        super().__init__()
        self.bits: list[int] = []
        self.word: list[int] = []
        self.flag: list[int] = []  # 1 letters hidden, 2 end of a sentence, 4 shouted

    def __missing__(self, s: str) -> int:
        if s[0].isalnum() or s[0] in "$@*":
            bits, word, hidden = concepts_of(s)
            self.bits.append(bits)
            self.word.append(xxhash.xxh32_intdigest(word))
            self.flag.append(int(hidden))
        else:
            self.bits.append(0)
            self.word.append(0)
            self.flag.append(2 + 4 * ("!!" in s or any(ord(c) > 0x2600 for c in s)))
        self[s] = len(self.bits) - 1
        return self[s]


CODES: list[Codes] = []
STRONG_BITS = sum(1 << CONCEPTS.index(c) for c in STRONG)


@dataclass
class Passages:
    """Passages of a batch of texts: text, votes, whether a strong word is in it, whether any listed word is, and its tokens from begin to end in words."""

    text: np.ndarray
    votes: np.ndarray
    hit: np.ndarray
    listed: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    words: np.ndarray


def passages(texts: list[str | None]) -> Passages:
    """All passages of the texts; together they hold every word. A passage is what stands around hits within a sentence, or a piece of a sentence between hits."""
    if not CODES or len(CODES[0]) > Codes.MOST:
        CODES[:] = [Codes()]
    codes = CODES[0]
    found = [[codes[x] for x in SCAN.findall(folded(t))] if t else [] for t in texts]
    text = np.repeat(np.arange(len(found)), [len(x) for x in found])
    code = np.array([c for x in found for c in x], np.int64)
    table = lambda x: np.array(x, np.int64)[code] if len(code) else np.zeros(0, np.int64)
    bits, words, flag = table(codes.bits), table(codes.word), table(codes.flag)
    n = len(code)
    if not n:
        none = np.zeros(0, np.int64)
        return Passages(none, none, none.astype(bool), none.astype(bool), none, none, words)
    ends = (flag & 2) > 0
    first = np.concatenate([[True], ends[:-1] | (text[1:] != text[:-1])])
    sentence = np.cumsum(first) - 1
    strong = np.flatnonzero(bits & STRONG_BITS)
    # hits of one sentence within REACH of each other share a passage
    apart = np.concatenate([[True], (np.diff(strong) > REACH) | (np.diff(sentence[strong]) > 0)]) if len(strong) else np.zeros(0, bool)
    lead, last = strong[apart], strong[np.concatenate([apart[1:], [True]])] if len(strong) else strong
    starts = np.append(np.flatnonzero(first), n)
    begin = np.maximum(lead - REACH, starts[sentence[lead]])
    stop = starts[1:] - ends[starts[1:] - 1]  # without the mark
    end = np.minimum(last + REACH + 1, stop[sentence[lead]])
    # what no hit reaches, a piece of at most 2 REACH + 1 words each
    covered = np.cumsum(np.bincount(begin, minlength=n + 1)[: n + 1] - np.bincount(end, minlength=n + 1)[: n + 1])[:n] > 0
    free = np.flatnonzero(~covered & ~ends)
    if len(free):
        new = np.concatenate([[True], (np.diff(free) > 1) | (np.diff(sentence[free]) > 0)])
        run = np.maximum.accumulate(np.where(new, np.arange(len(free)), 0))
        cut = new | ((np.arange(len(free)) - run) % (2 * REACH + 1) == 0)
        begin = np.concatenate([begin, free[cut]])
        end = np.concatenate([end, free[np.concatenate([cut[1:], [True]])] + 1])
    hit = np.arange(len(begin)) < len(lead)
    so_far = np.concatenate([[0], np.cumsum(bits > 0)])
    listed = so_far[end] > so_far[begin]
    closing = starts[sentence[begin] + 1] - 1
    shouted = (flag[closing] & 4) > 0
    return Passages(text[begin], _votes(bits, words, flag, begin, end, shouted), hit, listed, begin, end, words)


def _spread(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passage, place) of every token of every passage."""
    size = end - begin
    return np.repeat(np.arange(len(begin)), size), np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))


def _votes(bits: np.ndarray, words: np.ndarray, flag: np.ndarray, begin: np.ndarray, end: np.ndarray, shouted: np.ndarray) -> np.ndarray:
    """Which voters fire for each passage, a bit each; words count once a passage."""
    p, at = _spread(begin, end)
    n = len(begin)
    some = np.flatnonzero(bits[at])
    key = np.unique((p[some].astype(np.uint64) << np.uint64(32)) | words[at[some]].astype(np.uint64), return_index=True)[1]
    p1, b1 = p[some][key], bits[at[some]][key]
    count = {c: np.bincount(p1, (b1 >> k) & 1, n) for k, c in enumerate(CONCEPTS)}
    insult, degrade, attack, threat, group, dehum, trope, sexual, scene, second, slur, filth, curse, sober = (count[c] for c in CONCEPTS)
    hidden = np.bincount(p, flag[at] & 1, n) > 0
    fired = [
        insult >= 1, insult >= 2, (insult > 0) & (second > 0), (insult > 0) & (degrade > 0), attack >= 1, attack >= 2, (attack > 0) & (insult + degrade > 0), (group > 0) & (dehum > 0), dehum >= 2, dehum >= 3,
        sexual >= 1, sexual >= 2, (sexual > 0) & (scene > 0), (sexual > 0) & (scene >= 2), dehum >= 1, slur > 0, filth > 0, curse > 0, (threat > 0) & (second > 0), (threat > 0) & (insult + degrade + dehum > 0), (attack > 0) & (second > 0), (group > 0) & (trope > 0), (scene >= 2) & (second > 0), hidden, shouted, sober >= 1, sober >= 2,
    ]
    return sum(f.astype(np.int64) << i for i, f in enumerate(fired))


def label_model(counts: dict[int, int], rounds: int = 60) -> dict[int, float]:
    """The posterior of `abusive` for each pattern of votes, without any labels.

    EM over two classes with a rate of firing per voter and class, begun from the majority of the votes. Voters that fire
    together more than their classes explain are correlated; a voter that is silent abstains, and a passage for which none speaks is clean; each voter's evidence is divided by the root of the number
    of voters that its correlations with voters of its own kind amount to, so that ten readings of one word do not count as ten.
    """
    if not counts:
        return {}
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    x = np.array([[p >> j & 1 for j in range(len(VOTERS))] for p in patterns], float)
    sign = np.array([-1.0 if v in CLEAN else 1.0 for v in VOTERS])
    q = 1 / (1 + np.exp(-(2 * (x @ sign) - 3)))
    share = np.ones(len(VOTERS))
    for r in range(rounds):
        w1, w0 = n * q, n * (1 - q)
        a = (w1 @ x + 1) / (w1.sum() + 2)
        b = (w0 @ x + 1) / (w0.sum() + 2)
        # a voter for abuse may not become one for the clean, nor the other way round
        a, b = np.where(sign > 0, np.maximum(a, b * 1.05), np.minimum(a, b / 1.05)), b
        prior = float(np.clip(w1.sum() / n.sum(), 1e-4, 0.5))
        if r % 5 == 4:
            rho = np.zeros((len(VOTERS), len(VOTERS)))
            for w in (w1, w0):
                d = (x - w @ x / max(w.sum(), 1e-9)) * np.sqrt(w / max(w.sum(), 1))[:, None]
                v = np.sqrt(np.maximum((d**2).sum(0), 1e-9))
                rho = np.maximum(rho, np.abs(d.T @ d) / np.outer(v, v))
            same = np.outer(sign, sign) > 0
            share = 1 / np.sqrt(np.maximum(1, (np.where(same, rho, 0) ** 2).sum(1)))
        logit = np.where(x @ (sign > 0) > 0, 0.0, -30.0) + np.log(prior / (1 - prior)) + x @ (np.log(a / b) * share)  # a voter that does not fire abstains
        q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return {p: float(v) for p, v in zip(patterns, q, strict=True)}


MIX = np.uint64(0x9E3779B97F4A7C15)


def _hashed(v: np.ndarray) -> np.ndarray:
    return ((v * MIX) >> np.uint64(64 - SPACE.bit_length() + 1)).astype(np.int64)


def features(x: Passages, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in `of`, feature): hashed words and word pairs of the chosen passages, as often as they occur, and the voters that fired."""
    p, at = _spread(x.begin[of], x.end[of])
    with np.errstate(over="ignore"):
        w = x.words.astype(np.uint64)
        single, pair = _hashed(w + np.uint64(1)), _hashed(w[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + w[1:] + np.uint64(2))
        inner = np.flatnonzero(p[1:] == p[:-1])
        voter, who = np.nonzero((x.votes[of][None, :] >> np.arange(len(VOTERS))[:, None]) & 1)
        fired = _hashed(voter.astype(np.uint64) + np.uint64(1 << 40))
    return np.concatenate([p, p[inner], who]), np.concatenate([single[at], pair[at[inner]], fired])


def fit(rows: list[list[int]], target: np.ndarray, weight: np.ndarray, epochs: int = 40, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels by full-batch Adagrad; the last weight is the intercept."""
    w, g2 = np.zeros(SPACE + 1), np.full(SPACE + 1, 1e-6)
    if not rows:
        w[-1] = -6
        return w
    ids = np.concatenate([np.asarray(r, np.int64) for r in rows])
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    total = weight.sum()
    for _ in range(epochs):
        z = np.bincount(at, w[ids], len(rows)) + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * weight / total
        g = np.append(np.bincount(ids, err[at], SPACE), err.sum()) + decay * np.append(w[:-1], 0) / SPACE
        g2 += g * g
        w -= rate * g / np.sqrt(g2)
    return w


def _batches(parts: Iterator[pd.DataFrame], n: int = 500) -> Iterator[pd.DataFrame]:
    for p in parts:
        for at in range(0, len(p), n):
            yield p.iloc[at : at + n]


def scored(docs: DataFrame, sample: int = SAMPLE, plain: int = PLAIN_SAMPLE) -> DataFrame:
    """(doc_id, score) of the documents of docs(doc_id, text) that hold any word; all others score 0 and are left out.

    Every text is read whole, twice. First the votes on all passages are counted by pattern (a bit a voter; a few hundred patterns
    in practice) and the label model is fitted on these counts; the classifier is fitted on at most `sample` of the passages with a hit of the
    lists, and at most `plain` of the others, those with the smallest hashes. Then every passage is scored, with a hit or without one: words
    that no list holds count by the company they keep. The score of a document is that of its worst passage. Null,
    empty and blank texts have none; repeated rows score once per doc_id; nothing to fit on gives no rows.
    """

    def look(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in _batches(parts):
            x = passages(p["text"].tolist())
            votes, n = np.unique(x.votes, return_counts=True)
            yield pd.DataFrame({"votes": votes, "hit": False, "listed": False, "features": pd.Series([None] * len(n), dtype=object), "n": n})
            with np.errstate(over="ignore"):
                mixed = x.words.astype(np.uint64) * MIX
                so_far = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed ^ (mixed >> np.uint64(31)), dtype=np.uint64)])
                lot = (so_far[x.end] - so_far[x.begin]) * MIX >> np.uint64(40)  # by all words of the passage
            of = np.flatnonzero(x.hit | x.listed | (lot % np.uint64(THIN) == 0)) if len(x.begin) else x.begin
            who, what = features(x, of)
            order = np.lexsort((what, who))
            who, what = who[order], what[order]
            rows = np.split(what.astype(np.int32), np.searchsorted(who, np.arange(1, len(of)))) if len(of) else []
            yield pd.DataFrame({"votes": x.votes[of], "hit": x.hit[of] | (x.votes[of] & SPEAKING > 0), "listed": x.listed[of], "features": pd.Series(rows, dtype=object), "n": 0})

    texts = docs.filter("text is not null").select("doc_id", "text")
    seen = checkpointed(texts.select("text").mapInPandas(look, "votes bigint, hit boolean, listed boolean, features array<int>, n bigint"))
    posterior = label_model({r.votes: r.n for r in seen.filter("n > 0").groupBy("votes").agg(F.sum("n").alias("n")).collect()})
    unique = seen.filter("features is not null").groupBy("hit", "votes", "features").agg(F.sum(F.when(F.col("listed"), 1).otherwise(THIN)).alias("n"))
    rows = [r for hit, most in ((True, sample), (False, plain)) for r in unique.filter(F.col("hit") == hit).orderBy(F.xxhash64("features", "votes"), "features").limit(most).collect()]
    weights = fit([r.features for r in rows], np.array([posterior[r.votes] for r in rows]), np.sqrt([float(r.n) for r in rows]))
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def judge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = model.value
        for p in _batches(parts):
            x = passages(p["text"].tolist())
            every = np.arange(len(x.begin))
            who, what = features(x, every)
            z = np.bincount(who, w[what], len(every)) + w[-1]
            best = np.full(len(p), -np.inf)
            np.maximum.at(best, x.text, z)
            some = best > -np.inf
            yield pd.DataFrame({"doc_id": p["doc_id"].to_numpy()[some], "score": 1 / (1 + np.exp(-np.clip(best[some], -30, 30)))})

    return texts.mapInPandas(judge, "doc_id bigint, score double").groupBy("doc_id").agg(F.max("score").alias("score"))
