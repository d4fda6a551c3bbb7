"""Session helpers: table access, lineage cuts and bounded broadcasts."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast without a look at its size only when its row count is fixed by definition
#: (reference lists, calendars). Everything else goes through `small_enough`.
BROADCAST_ROWS = 200_000


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies at the same place on every machine, whatever folder Spark was started in. Elsewhere install it, or ship it with --py-files."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), ROOT]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder.

    The folder is the session's `spark.checkpoint.dir`; one is made up only where it is unset (tests, notebooks).
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = os.path.join(tempfile.gettempdir(), "tessella-checkpoints")
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def released(spark: SparkSession) -> None:
    """Let go of the shuffle files of steps that a checkpoint has ended: they stay until the driver collects its garbage, which it may not do before a long query ends. What is still in use for a moment goes with the next call."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True if df has at most `rows` rows; reads no more than rows + 1 of them."""
    return df.limit(rows + 1).count() <= rows


def with_salt(df: DataFrame, by: list[str], salts: int) -> DataFrame:
    """The large side of a salted join: rows of one hot key spread over `salts` sub-keys."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))


def replicated(df: DataFrame, salts: int) -> DataFrame:
    """The small side of a salted join: each row once per sub-key."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


#: rows of one key from which a join spreads it, and over how many sub-keys
HOT, SALTS = 100_000, 16


def looked_up(rows: DataFrame, by: str | list[str], small: DataFrame, on: list[str], how: str = "inner", most: int | None = None) -> DataFrame:
    """A shuffled join of rows with small that spreads the hot keys of rows by a hash of the columns `by`.

    A key is hot if it has about HOT rows or more, as seen in a hundredth of rows (the sample only tells which keys to
    spread; every row is joined). Only hot keys are repeated on the side of small. The list of hot keys has at most one key
    for some HOT rows and is broadcast if its checked size allows; beyond that the join is left to AQE. Neither side
    is ever broadcast, whatever the plan's size estimate says: estimates behind a checkpoint or an explode are far too low.
    rows should be cheap to read again (a checkpoint or a table). most: how many rows there are at most, if that is known; with
    fewer than HOT no key can be hot, and nothing is looked at.
    """
    if most is not None and most < HOT:
        return rows.join(small.hint("merge"), on, how)
    share = 0.01
    seen = rows.select(*on).sample(share, 7)
    if seen.limit(int(HOT * share) + 1).count() <= HOT * share:  # too few rows for any key to be hot
        return rows.join(small.hint("merge"), on, how)
    hot = seen.groupBy(*on).agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT * share).select(*on)
    hot = hot.filter(" and ".join(f"`{c}` is not null" for c in on))
    n = hot.limit(BROADCAST_ROWS + 1).count()
    if n == 0 or n > BROADCAST_ROWS:
        return rows.join(small.hint("merge"), on, how)
    flag = F.broadcast(checkpointed(hot).withColumn("_hot", F.lit(True)))
    a = rows.join(flag, on, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*([by] if isinstance(by, str) else by)), F.lit(SALTS))).otherwise(0).cast("int")).drop("_hot")
    b = small.join(flag, on, "left").withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("_hot")
    return a.join(b.hint("merge"), [*on, "_salt"], how).drop("_salt")


def packed(df: DataFrame, **needed) -> DataFrame:
    """The row of df as one struct `_row`, and the needed columns by these names: working columns then never clash with df's own."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), *(c.alias(n) for n, c in needed.items()))


def unpacked(x: DataFrame, df: DataFrame, *out: str) -> list:
    """df's own columns out of `_row`, without those that the results `out` replace."""
    return [F.col("_row").getField(c).alias(c) for c in df.columns if c not in out]
