"""References to records that do not exist, direct and inherited."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, looked_up

FOUND = "tab string, field string, row_id bigint, kind string, depth int, cause string, period string"


@dataclass(frozen=True)
class ForeignKey:
    """child.field refers to parent.key. With child_time and born set, a parent born after the child's time counts as absent then."""

    child: str
    field: str
    parent: str
    parent_key: str
    child_time: str | None = None
    born: str | None = None


def _instant(c: Column) -> Column:
    return F.try_to_timestamp(c)


def direct(child: DataFrame, parent: DataFrame, fk: ForeignKey, child_key: str, unresolved: tuple = (-1,)) -> DataFrame:
    """Rows (row_id, cause) of child whose reference leads nowhere (`missing`) or to a record of a later time (`later`).

    Null references and those in `unresolved` are no references. A parent without a birth time counts as present; a
    child without a time can only be `missing`. Keys are looked up once each: the child's keys are first reduced on
    the map side, so a hot key costs one row; only keys with a finding meet the rows again, in a join that spreads hot keys.
    """
    rows = child.select(F.col(child_key).alias("row_id"), F.col(fk.field).cast("long").alias("fk"), (_instant(F.col(fk.child_time)) if fk.child_time else F.lit(None).cast("timestamp")).alias("at"))
    rows = rows.filter(F.col("fk").isNotNull() & ~F.col("fk").isin(*unresolved))
    keys = rows.groupBy("fk").agg(F.min("at").alias("first_at"))
    born = F.col(fk.born) if fk.born else F.lit(None).cast("string")
    parents = parent.filter(F.col(fk.parent_key).isNotNull()).groupBy(F.col(fk.parent_key).cast("long").alias("fk")).agg(F.min(F.coalesce(_instant(born), F.lit("0001-01-01").cast("timestamp"))).alias("born"), F.lit(True).alias("there"))
    bad = keys.join(parents.hint("merge"), "fk", "left").filter(F.col("there").isNull() | (F.col("born") > F.col("first_at"))).select("fk", "born", F.col("there").isNull().alias("missing"))
    hit = looked_up(rows, "row_id", bad, ["fk"])
    return hit.filter(F.col("missing") | (F.col("born") > F.col("at"))).select("row_id", F.when(F.col("missing"), "missing").otherwise("later").alias("cause")).distinct()


def cascade(tables: dict[str, DataFrame], keys: dict[str, str], fks: list[ForeignKey], periods: dict[str, Column] | None = None, unresolved: tuple = (-1,)) -> DataFrame:
    """Every orphaned reference: (tab, field, row_id, kind, depth, cause, period).

    kind `direct` (depth 0) points at an absent record; kind `inherited` points at a record that is itself orphaned,
    found by semi-joins down the foreign-key graph, level by level until a level adds no record. A reference that is
    both is reported as direct. Empty tables give no rows. period is the month of the row, null where it has none.
    """
    out, orphans = None, {}

    def add(a: DataFrame | None, b: DataFrame) -> DataFrame:
        return b if a is None else a.unionByName(b)

    for fk in fks:
        d = direct(tables[fk.child], tables[fk.parent], fk, keys[fk.child], unresolved)
        out = add(out, d.select(F.lit(fk.child).alias("tab"), F.lit(fk.field).alias("field"), "row_id", F.lit("direct").alias("kind"), F.lit(0).alias("depth"), "cause"))
    assert out is not None, "no foreign keys given"
    parents_of = {fk.child for fk in fks}
    below = [fk for fk in fks if fk.parent in parents_of]
    if below:
        out = checkpointed(out)
        known = front = out.select("tab", "row_id").distinct()
        depth = 0
        while True:  # ends, as each level has only references that no level before had
            depth += 1
            level = None
            for fk in below:
                up = front.filter(F.col("tab") == fk.parent).select(F.col("row_id").alias("fk")).distinct()
                rows = tables[fk.child].select(F.col(keys[fk.child]).alias("row_id"), F.col(fk.field).cast("long").alias("fk")).filter(F.col("fk").isNotNull() & ~F.col("fk").isin(*unresolved))
                hit = looked_up(rows, "row_id", up, ["fk"], "left_semi")
                level = add(level, hit.select(F.lit(fk.child).alias("tab"), F.lit(fk.field).alias("field"), "row_id", F.lit("inherited").alias("kind"), F.lit(depth).alias("depth"), F.lit(fk.parent).alias("cause")))
            level = checkpointed(level.join(out.select("tab", "field", "row_id").hint("merge"), ["tab", "field", "row_id"], "left_anti"))
            if level.isEmpty():
                break
            out = out.unionByName(level)
            front = level.select("tab", "row_id").distinct().join(known.hint("merge"), ["tab", "row_id"], "left_anti")
            if not any(fk.parent in {c.child for c in below} for fk in below):
                break  # the graph is no deeper
            front = checkpointed(front)
            known = known.unionByName(front)
    dated = None
    for name, period in (periods or {}).items():
        dated = add(dated, tables[name].select(F.lit(name).alias("tab"), F.col(keys[name]).alias("row_id"), period.alias("period")))
    out = out.join(dated.hint("merge"), ["tab", "row_id"], "left") if dated is not None else out.withColumn("period", F.lit(None).cast("string"))
    return out.select("tab", "field", "row_id", "kind", "depth", "cause", "period")


def report(found: DataFrame) -> DataFrame:
    """Counts per table, field, kind, cause and month."""
    return found.groupBy("tab", "field", "kind", "cause", "period").agg(F.count("*").alias("n_rows"))
