import random

import pytest

from tessella.llm import tokens as T

PATH = f"{T.FOLDER}/{T.VOCABULARY}"
TEXTS = [
    "", None, " ", "\n\n", "a", "Hello  world \t x\n y", "it's we'll DON'T can’t", "<|endoftext|> is text", "日本語のテキスト" * 900, "x" * 30_000, "word " * 5000, "ab" * 3000 + "\n" + "1234567890" * 900, "Ä°ncesaray ğüşıöç İI", "🙂🙃 👨‍👩‍👧 emoji", "é combining",
    "    leading and trailing    ", "\r\nwin\r\n", "!!!???...---" * 500, "​ 　", "a b c " * 2000,
]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{T.FOLDER}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


def test_equals_the_public_tokenizer(spark, reference):
    df = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    got = {r.doc_id: r.ids for r in T.encoded(df).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        assert list(got[i]) == list(reference(t)), (i, t and t[:30])


def test_round_trip_and_chunks(reference):
    rng = random.Random(2)
    alphabet = ["a", "b", " ", "  ", "\n", "'s", "é", "1", ".", "漢", "\t", " the", "ing "]
    e = T.encoder(PATH)
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 600)))
        parts = T.chunks(text, PATH)
        assert "".join(parts) == text
        ids = [i for p in parts for i in e.encode_ordinary(p)]
        assert ids == e.encode_ordinary(text) == list(reference(text)) and e.decode(ids) == text


def test_cuts_follow_content():
    body = " ".join(f"word{i * 7919 % 1000}" for i in range(400))
    a, b = set(T.chunks(body, PATH)), set(T.chunks("Another beginning of it. " + body, PATH))
    assert len(a & b) > 0.8 * len(a)


def test_repeated_rows_and_empty(spark, rows):
    df = spark.createDataFrame([(1, "same text here"), (1, "same text here"), (1, "other"), (None, "x")], "doc_id long, text string")
    assert T.encoded(df).count() == 4 and len({tuple(r.ids) for r in T.encoded(df).collect()}) == 3
    assert T.encoded(df.limit(0)).count() == 0


def test_rolling_hash_is_that_of_its_window():
    rng = random.Random(8)
    for n in (1, 15, 16, 17, 300):
        text = "".join(rng.choice("ab çß漢🙂\t") for _ in range(n))
        want = []
        for i in range(n):
            h = sum(ord(text[i - k]) * pow(int(T.BASE), k, 1 << 64) for k in range(min(T.WINDOW, i + 1))) % (1 << 64)
            want.append(h ^ (h >> 29))
        assert T.rolling(text).tolist() == want
