"""Sinks: JSON, Markdown, typed CSV, result bundles and table replacement."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import truncate
from graphloom.operators.structure import markdown

#: fixed values: columns of the typed CSV files
CSV_COLUMNS = {
    "event": ("Title", "Year", "Type", "Significance", "Description", "Supporting_Text"),
    "actor": ("Name", "Type", "Role", "Country", "Description", "Supporting_Text"),
    "concept": ("Name", "Definition", "Significance", "Domain", "Supporting_Text"),
    "publication": ("Title", "Year", "Type", "Authors", "Publisher", "Supporting_Text"),
    "location": ("Name", "Type", "Country", "Description", "Supporting_Text"),
}
CUTS = {"Description": 200, "Definition": 200, "Supporting_Text": 300}


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_markdown(docs: DataFrame, path: str) -> None:
    """One text file set of the Markdown form of documents."""
    markdown(docs).select("markdown").write.mode("overwrite").text(path)


def csv_projection(entities: DataFrame, kind: str) -> DataFrame:
    """The typed CSV columns of a kind; long texts are shortened, lists joined by '; ', absent columns empty."""
    types = dict(entities.dtypes)

    def one(name: str) -> Column:
        field = name.lower()
        if field not in types:
            return F.lit(None).cast("string").alias(name)
        c = F.array_join(field, "; ") if types[field].startswith("array") else F.col(field).cast("string")
        return (truncate(c, CUTS[name]) if name in CUTS else c).alias(name)

    return entities.select(*(one(n) for n in CSV_COLUMNS[kind]))


def write_csv(entities: DataFrame, kind: str, path: str) -> bool:
    """Typed CSV with a header and full quoting; nothing is written for an empty frame."""
    if entities.isEmpty():
        return False
    csv_projection(entities, kind).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return True


def write_bundle(entities: dict[str, DataFrame], relationships: DataFrame, folder: str, base: str) -> None:
    """Entities by kind as JSON and CSV, relationships, and the counts per kind."""
    stats = None
    for kind, df in entities.items():
        write_json(df, f"{folder}/{base}_{kind}s")
        write_csv(df, kind, f"{folder}/{base}_{kind}s_csv")
        part = df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
        stats = part if stats is None else stats.unionByName(part)
    write_json(relationships, f"{folder}/{base}_relationships")
    part = relationships.agg(F.lit("relationship").alias("kind"), F.count("*").alias("n"))
    write_json(part if stats is None else stats.unionByName(part), f"{folder}/{base}_extraction_stats")


def write_critic_bundle(evaluations: DataFrame, tasks: DataFrame, report: DataFrame, folder: str, base: str) -> None:
    for name, df in (("critic_evaluation", evaluations), ("review_tasks", tasks), ("quality_report", report)):
        write_json(df, f"{folder}/{base}_{name}")


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrite a parquet folder that ``df`` may itself read: written beside it, then swapped in through Hadoop's file system."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fresh, old = f"{path}.{uuid.uuid4().hex}.new", f"{path}.{uuid.uuid4().hex}.old"
    df.write.parquet(fresh)
    p = lambda s: jvm.org.apache.hadoop.fs.Path(s)
    fs = p(path).getFileSystem(conf)
    if fs.exists(p(path)):
        fs.rename(p(path), p(old))
    fs.rename(p(fresh), p(path))
    if fs.exists(p(old)):
        fs.delete(p(old), True)


def append_corrections(corrections: DataFrame, path: str) -> None:
    corrections.write.mode("append").parquet(path)
