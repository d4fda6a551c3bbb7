"""The pN_ queries over the smallest tables: columns, one row a case, and the rules that can be told without them."""

import os

import pytest

import __spark_entry__ as entry

D = "/root/testdata/sf0.001"
Q = entry.queries()
COLUMNS = {
    "p1_found": ["group_id", "kept_id"], "p2_found": ["field", "row_id", "ref_id"], "p3_found": ["tab", "id_a", "id_b"], "p4_found": ["field", "startup_id", "pos", "item"], "p5_found": ["field", "row_id"], "p6_found": ["field", "row_id", "normal"], "p7_found": ["investment_id", "usd_cents"], "p8_ids": ["doc_id", "ids"],
    "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id"],
}
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_single_cases(spark, name):
    df = Q[name](spark, D)
    assert df.columns == COLUMNS[name]
    got = [tuple(map(str, r)) for r in df.collect()]
    assert got and len(got) == len(set(got))


def test_kept_records_agree_with_the_rule(spark):
    groups: dict[int, set] = {}
    for r in Q["p3_found"](spark, D).filter("tab = 'startups'").collect():
        groups.setdefault(r.id_a, set()).update((r.id_a, r.id_b))
    from datetime import datetime, timezone

    rec = {r.id: r for r in spark.read.parquet(f"{D}/startups.parquet").collect()}

    def rank(i):
        c, u = rec[i].data_confidence, rec[i].last_updated
        try:
            t = datetime.fromisoformat(u)
            t = t if t.tzinfo else t.replace(tzinfo=timezone.utc)
            at = t.timestamp()
        except (TypeError, ValueError):
            at = float("-inf")
        return (-(c if c is not None and 0 <= c <= 100 else -1), -at, i)

    seen, want = set(), set()
    for a in sorted(groups):
        if a not in seen:
            seen |= groups[a]
            want.add((min(groups[a]), min(groups[a], key=rank)))
    assert {tuple(r) for r in Q["p1_found"](spark, D).collect()} == want


def test_reports_run(spark):
    for name in ("p1_golden", "p2_unmatched", "p3_entities", "p9_items", "p10_rates"):
        assert Q[name](spark, D).count() > 0
