"""Writers, by Spark's own sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record(name: Column, sequence: Column, width: int = 0) -> Column:
    """A FASTA record; with a width, sequence lines are wrapped."""
    body = F.regexp_replace(sequence, f"(.{{{width}}})(?=.)", "$1\n") if width else sequence
    return F.concat(F.lit(">"), name, F.lit("\n"), body)


def fasta(rows: DataFrame, path: str, width: int = 0, by: str | None = None) -> None:
    """Columns seq_id, sequence as FASTA text; one folder per value of column ``by``."""
    out = rows.select(record(F.col("seq_id"), F.col("sequence"), width).alias("value"), *([by] if by else []))
    (out.write.partitionBy(by) if by else out.write).text(path)


def edges(rows: DataFrame, path: str) -> None:
    rows.select("src", "dst", "weight").write.option("sep", "\t").csv(path)


def newick(rows: DataFrame, path: str) -> None:
    """Trees a line, with their identifiers before them: as many files as tasks, not one a tree."""
    rows.select("tree_id", "newick").write.option("sep", "\t").csv(path)


def node_map(rows: DataFrame, path: str) -> None:
    """Columns node, source_file as one JSON object a node with its files in order."""
    rows.groupBy("node").agg(F.array_sort(F.collect_set("source_file")).alias("files")).write.json(path)


def partitions(offsets: DataFrame, path: str, kind: str = "DNA") -> None:
    line = F.concat(F.lit(f"{kind}, p"), F.col("part_no").cast("string"), F.lit(" = "), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))
    offsets.orderBy("part_no").select(line.alias("value")).write.text(path)


def report(rows: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header."""
    rows.coalesce(1).write.option("header", True).csv(path)


def metrics(rows: DataFrame, path: str) -> None:
    rows.write.json(path)
