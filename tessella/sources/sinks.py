"""Where results go: versioned Parquet, JSON constants, Markdown."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession


def swapped(df: DataFrame, path: str, version: str, partition_by: list[str] | None = None) -> str:
    """Write a new version of a table beside the old ones and point `current` at it; the old versions are the backups."""
    out = f"{path}/v={version}"
    w = df.write.mode("errorifexists")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(out)
    spark = df.sparkSession
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").json(f"{path}/current")
    return out


def current(spark: SparkSession, path: str) -> DataFrame:
    """The version that `current` points at."""
    version = spark.read.json(f"{path}/current").first()["version"]
    return spark.read.parquet(f"{path}/v={version}")


def exists(spark: SparkSession, path: str) -> bool:
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path))


def rows_of(df: DataFrame, most: int = 10_000) -> list[dict]:
    """A small result on the driver; more than `most` rows are refused."""
    rows = df.limit(most + 1).toJSON().collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows for a report")
    return [json.loads(r) for r in rows]


def js_constants(results: dict[str, DataFrame]) -> str:
    """`const NAME = [...];` of each result, one a line."""
    return "\n".join(f"const {name} = {json.dumps(rows_of(df), ensure_ascii=False)};" for name, df in results.items())


def page(template: str, constants: str, kpis: dict[str, object]) -> str:
    """A template with its {{constants}} and {{name}} places filled."""
    out = template.replace("{{constants}}", constants)
    for k, v in kpis.items():
        out = out.replace("{{" + k + "}}", str(v))
    return out


def markdown(title: str, sections: dict[str, DataFrame]) -> str:
    """A report with a table a section; empty ones say so."""
    out = [f"# {title}", ""]
    for name, df in sections.items():
        rows = rows_of(df)
        out += [f"## {name}", ""]
        if not rows:
            out += ["Nothing.", ""]
            continue
        cols = df.columns
        cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
        out += ["| " + " | ".join(cols) + " |", "|" + " --- |" * len(cols), *("| " + " | ".join(cell(r.get(c)) for c in cols) + " |" for r in rows), ""]
    return "\n".join(out)


def write_text(text: str, path: str) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
