"""Writes as pure functions of frames: ignore, replace, accumulate, arbitrate, delete."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import first_by


def with_columns(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """df with each missing column added as null."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in schema.items() if c not in df.columns})


def insert_ignore(target: DataFrame, new: DataFrame, keys: list[str], order: Column) -> tuple[DataFrame, DataFrame]:
    """(target with the new rows, the rows inserted): of each key the first new row, and only where the target has none. Null keys are never equal, so all their rows go in."""
    known = [c for c in new.columns if c not in keys]
    nulls = new.filter(" OR ".join(f"{k} IS NULL" for k in keys))
    firsts = first_by(new.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys)), keys, order, known).select(*new.columns)
    added = firsts.join(target.select(*keys).distinct(), keys, "left_anti").select(*new.columns).unionByName(nulls)
    return target.unionByName(added, allowMissingColumns=True), added


def insert_replace(target: DataFrame, new: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Of each key the last new row replaces the target's whole row; columns it does not name become null."""
    last = new.groupBy(*keys).agg(F.max_by(F.struct(*new.columns), order).alias("_r")).select("_r.*")
    return target.join(last.select(*keys), keys, "left_anti").select(*target.columns).unionByName(last, allowMissingColumns=True)


def updated(target: DataFrame, changes: DataFrame, keys: list[str], keep_old: bool = False) -> DataFrame:
    """target with the changes' other columns set where their keys meet; keep_old only fills nulls. Of several changes of one key the largest counts."""
    cols = [c for c in changes.columns if c not in keys]
    one = changes.groupBy(*keys).agg(F.max(F.struct(*cols)).alias("_c")).select(*keys, *(F.col(f"_c.{c}").alias(f"_new_{c}") for c in cols), F.lit(True).alias("_hit"))
    x = target.join(one, keys, "left")
    value = lambda c: F.coalesce(F.col(c), F.col(f"_new_{c}")) if keep_old else F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c))
    return x.select(*(value(c).alias(c) if c in cols else F.col(c) for c in target.columns))


def noted(old: Column, note: Column) -> Column:
    """The note appended with `; `; a null note changes nothing."""
    return F.when(note.isNull(), old).otherwise(F.concat(F.coalesce(F.concat(old, F.lit("; ")), F.lit("")), note))


def accumulated(index: DataFrame, hits: DataFrame, keys: list[str], weight: str = "weight", first: float = 0.5, step: float = 0.3, most: float = 10.0) -> DataFrame:
    """(keys, weight): a known key gains `step` a hit up to `most`; a new one begins at `first` and gains for its further hits."""
    n = hits.groupBy(*keys).agg(F.count("*").alias("_n"))
    x = index.select(*keys, weight).join(n, keys, "full_outer")
    grown = F.when(F.col(weight).isNull(), F.least(F.lit(most), first + step * (F.col("_n") - 1))).otherwise(F.when(F.col("_n").isNull(), F.col(weight)).otherwise(F.least(F.lit(most), F.col(weight) + step * F.col("_n"))))
    return x.select(*keys, grown.alias(weight))


def without(target: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(gone.select(*keys).distinct(), keys, "left_anti").select(*target.columns)


def arbitrated(log: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """The changes that hold, as log rows (keys, seq, old_value, new_value, confidence).

    log(keys, seq, value, confidence), candidates(keys, seq, value, confidence), both in order of seq. The newest log
    row of a key sets the bar. A candidate is passed over if it is missing, if its confidence is below the bar, or if
    it says what the log says already (then the bar stays, too: a running maximum would be wrong). Any other is logged
    and sets the new bar. Without a log row the bar is 0 and nothing has been said.

    The rule is sequential within a key. What no walk can accept is dropped before it, spread over all tasks: missing values, and
    candidates below the log's bar, as the bar only rises. The rest is partitioned by key and sorted, and a single state
    walks over it, so a hot key takes time but no memory.
    """
    bar = log.groupBy(*keys).agg(F.max_by(F.coalesce("confidence", F.lit(0)), "seq").alias("_bar"))
    said = F.trim(F.col("value").cast("string"))
    candidates = candidates.filter(said.isNotNull() & ~said.isin("", "Unknown", "None", "nan"))
    candidates = candidates.join(bar.hint("merge"), keys, "left").filter(F.col("_bar").isNull() | (F.coalesce("confidence", F.lit(0)) >= F.col("_bar"))).drop("_bar")
    rows = log.groupBy(*keys).agg(F.max_by(F.struct("value", "confidence"), "seq").alias("_l")).select(*keys, F.lit(-(1 << 62)).alias("seq"), "_l.value", "_l.confidence", F.lit(True).alias("_logged"))
    rows = rows.unionByName(candidates.select(*keys, F.col("seq").cast("long").alias("seq"), "value", "confidence").withColumn("_logged", F.lit(False)))
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "seq")

    def walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, said, bar, any_log = None, None, 0, False
        for p in parts:
            out = []
            for r in p.itertuples(index=False, name=None):
                k, (seq, value, conf, logged) = r[: len(keys)], r[len(keys) :]
                if k != key:
                    key, said, bar, any_log = k, None, 0, False
                conf = 0 if conf is None or conf != conf else conf
                if logged:
                    said, bar, any_log = value, conf, True
                elif value is None or str(value).strip() in ("", "Unknown", "None", "nan"):
                    continue
                elif any_log and conf < bar or any_log and str(value) == str(said):
                    continue
                else:
                    out.append((*k, seq, said, value, int(conf)))
                    said, bar, any_log = value, conf, True
            yield pd.DataFrame(out, columns=[*keys, "seq", "old_value", "new_value", "confidence"])

    types = dict(candidates.dtypes)
    return rows.mapInPandas(walk, ", ".join([*(f"{k} {types[k]}" for k in keys), "seq bigint, old_value string, new_value string, confidence int"]))
