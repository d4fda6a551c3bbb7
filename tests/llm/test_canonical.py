from pyspark.sql import functions as F

from tessella.llm import canonical as C

CITIES = [(1, "İncesaray"), (2, "Işıkbelen"), (3, "Ortasaray"), (4, "Gülyazı"), (1, "INC"), (3, "Lykastra")]
CASES = [
    ("incesaray", 1), ("İNCESARAY", 1), ("I N C E S A R A Y", 1), ("Ä°ncesaray", 1), ("İnesaray", 1), ("incsearay", 1), ("İncesa​ray", 1), ("INC.", 1), ("  Işıkbelen ", 2), ("Işıkbelen / TR", 2), ("isikbelen?", 2), ("Unknown, possibly Gulyazi", 4), ("lykastra (Ortasaray)", 3),
    ("Remote", 0), ("Port Ellarine", 0), ("Nordhaffen", 0), ("", 0), (None, 0), ("x" * 20_000, 0), ("🙂", 0),
]


def pieces(c):
    p = C.plain(c)
    return F.concat(F.array(p), F.filter(F.split(p, " "), lambda w: F.length(w) > 4))


def run(spark, values, entries):
    v = spark.createDataFrame([("city", x, "extra") for x in values], "field string, value string, form string")
    e = spark.createDataFrame([("city", i, f) for i, f in entries], "field string, ref_id long, form string")
    return {r.value: r.ref_id for r in C.assigned(v, e, pieces(F.col("value"))).collect()}


def test_values(spark):
    got = run(spark, [c[0] for c in CASES] * 2, CITIES)
    assert got == dict(CASES)


def test_empty_sides(spark):
    assert run(spark, [], CITIES) == {}
    assert run(spark, ["incesaray"], []) == {"incesaray": 0}


def test_equal_claims_are_none(spark):
    assert run(spark, ["Ortasaray Gülyazı"], CITIES) == {"Ortasaray Gülyazı": 0}
