import pytest

from tessella.operators import multivalue as M

NAMES = {"tab", "double bar", "bar", "semicolon", "middle dot", "wide comma", "spaced slash", "spaced plus", "newline", "slash", "comma", "conjunction", "ampersand"}
CASES = [
    ("Ada Lone, Bob Two", ["Ada Lone", "Bob Two"]), ("Lone, Ada; Two, Bob", ["Lone, Ada", "Two, Bob"]), ("Lone, Ada", ["Lone, Ada"]), ('"Lone, Ada","Two, Bob"', ["Lone, Ada", "Two, Bob"]), ("Ada Lone (CEO, CTO), Bob Two", ["Ada Lone (CEO, CTO)", "Bob Two"]),
    ("Foo Bar Capital, L.P.; Baz Qux", ["Foo Bar Capital, L.P.", "Baz Qux"]), ("Foo & Bar Partners, Ada Lone", ["Foo & Bar Partners", "Ada Lone"]), ("Ada Lone & Bob Two", ["Ada Lone", "Bob Two"]), ("Foo & Bar Partners", ["Foo & Bar Partners"]),
    ("Foo Bar, Inc. and Baz Qux", ["Foo Bar, Inc.", "Baz Qux"]), ('["Ada L\\u00f6ne", "Bob Two"]', ["Ada Löne", "Bob Two"]), ("(1) Ada Lone; (2) Bob Two", ["Ada Lone", "Bob Two"]), ("1. Ada Lone 2. Bob Two", ["Ada Lone", "Bob Two"]), ("- Ada Lone\n* Bob Two", ["Ada Lone", "Bob Two"]),
    (" Ada Lone,, Bob Two,", ["Ada Lone", "Bob Two"]), (";Ada Lone, , Bob Two;", ["Ada Lone", "Bob Two"]), ("Ada Lone\r\nBob Two", ["Ada Lone", "Bob Two"]), ("Ada Lone, Ada Lone", ["Ada Lone", "Ada Lone"]), ('Foo Bar "Core" Fund;"Baz ""Core"" Fund"', ['Foo Bar "Core" Fund', 'Baz "Core" Fund']),
    ("Ada Lone, Bob Two ve Cem Three", ["Ada Lone", "Bob Two", "Cem Three"]), ("Ada Lone, Bob Two, & Cem Three", ["Ada Lone", "Bob Two", "Cem Three"]), ("Ada Lone/Bob Two", ["Ada Lone", "Bob Two"]), ("Ada Lone，Bob Two", ["Ada Lone", "Bob Two"]),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_names(text, want):
    assert M.split_value(text, NAMES, 2) == want


def test_technologies():
    own = (NAMES - {"slash"}) | {"comma"}
    assert M.split_value("Q&A Bots, CI/CD; Spark | C/C++", own, 1) == ["Q&A Bots", "CI/CD", "Spark", "C/C++"]
    assert M.split_value("R&D Analytics & TCP/IP", own, 1) == ["R&D Analytics", "TCP/IP"]


def frame(spark, values):
    return spark.createDataFrame([("f", i, v) for i, v in enumerate(values)], "field string, row_id long, value string")


def test_inference_and_positions(spark, rows):
    tech = ["Spark", "C/C++", "CI/CD", "Java", "A/B Testing"]
    values = tech * 6 + ["Spark, C/C++", "Java, CI/CD", "Spark; Java", "A/B Testing; C/C++", "C/C++, A/B Testing"] * 4 + [None, "", "N/A", "none", "[]", "x" * 50_000]
    v = frame(spark, values)
    own = {r.delimiter for r in M.score(v.filter("length(value) between 3 and 100 and lower(value) not in ('n/a', 'none', '[]')")).filter("own").collect()}
    assert {"comma", "semicolon"} <= own and "slash" not in own and "plus" not in own
    got = rows(M.items(v).filter("n > 1 and row_id in (30, 31, 32)"), "row_id", "pos", "item")
    assert got == [(30, 1, "Spark"), (30, 2, "C/C++"), (31, 1, "Java"), (31, 2, "CI/CD"), (32, 1, "Spark"), (32, 2, "Java")]
    assert M.items(v).filter("row_id >= 50").select("row_id").distinct().count() == 1  # only the long text is no stand-in


def test_empty_and_extra_columns(spark):
    assert M.items(frame(spark, [])).count() == 0
    df = spark.createDataFrame([(1, "a b; c d", "x")], "id long, names string, value string")
    assert M.items(M.unpivoted(df, "id", ["names"])).count() >= 1


def test_only_inferred_delimiters_split():
    assert M.split_value("Rust+Go+Java", {"plus"}, 1) == ["Rust", "Go", "Java"] and M.split_value("Rust+Go+Java", set(), 1) == ["Rust+Go+Java"]
    assert M.split_value("Ada Lone - Bob Two", {"spaced hyphen"}, 2) == ["Ada Lone", "Bob Two"] and M.split_value("Ada-Nur Lone", {"hyphen"}, 2) == ["Ada-Nur Lone"]
    for d, text in (("comma", "Ada Lone, Bob Two"), ("ampersand", "Ada Lone & Bob Two"), ("conjunction", "Ada Lone und Bob Two"), ("semicolon", "Ada Lone; Bob Two"), ("slash", "Ada Lone/Bob Two")):
        assert M.split_value(text, NAMES, 2) == ["Ada Lone", "Bob Two"] and M.split_value(text, NAMES - {d}, 2) == [text]


@pytest.mark.parametrize("held", ["\ue007", "\U000f0001", "\U0010fffd"])
def test_private_use_characters(held):
    assert M.split_value(f'Ali Veli{held}, Can Er (CEO), "Lone, {held}Ada"', NAMES, 2) == [f"Ali Veli{held}", "Can Er (CEO)", f"Lone, {held}Ada"]
    assert len(M.split_value(f"{held}()" * 140_000, NAMES, 2)) == 1


def test_a_delimiter_is_inferred_by_field(spark):
    """The same notation is a list in one field and part of the value in another."""
    rows = [("skills", i, v) for i, v in enumerate(["Rust", "Go", "Java"] * 8 + ["Rust+Go", "Go+Java+Rust"] * 5)]
    rows += [("place", i, f"Musterweg {i}, Haus {i % 3}") for i in range(30)] + [("place", 100 + i, f"Lange Strasse {i}") for i in range(30)] + [("model", i, v) for i, v in enumerate(["Alpha", "Beta", "Gamma"] * 8 + ["x+9", "y+7"] * 5)]
    v = spark.createDataFrame(rows, "field string, row_id long, value string")
    own = {(r.field, r.delimiter) for r in M.score(v).filter("own").collect()}
    assert ("skills", "plus") in own and ("model", "plus") not in own
    n = {(r.field, r["count"]) for r in M.items(v).filter("n > 1 and pos = 1").groupBy("field").count().collect()}
    assert ("skills", 10) in n and not any(f == "model" for f, _ in n)
