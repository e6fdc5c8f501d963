"""Text formats as DataFrames, by Spark's own readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSIONS = "*.{fasta,fa,fas,fna,faa}"
HIT = "query string, qlen int, target string, tlen int, qframe string, pident double, nident int, alnlen int, mismatch int, gapopen int, qstart int, qend int, tstart int, tend int, evalue double, bits double"
SHORT_HIT = "query string, target string, pident double, alnlen int, mismatch int, gapopen int, qstart int, qend int, tstart int, tend int, evalue double, bits double"


def file_name():
    return F.element_at(F.split(F.input_file_name(), "/"), -1)


def fasta(spark: SparkSession, path: str, glob: str = EXTENSIONS) -> DataFrame:
    """source_file, ordinal, seq_name (first word of the header), header, sequence. Records are split at lines that begin
    with ``>``; large files are split between tasks. ordinal orders records within a file."""
    rows = spark.read.option("lineSep", "\n>").option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
    rows = rows.select(file_name().alias("source_file"), F.monotonically_increasing_id().alias("ordinal"), F.regexp_replace("value", r"^\s*>", "").alias("_r"))
    head = F.regexp_replace(F.regexp_extract("_r", r"^([^\r\n]*)", 1), r"\s+$", "")
    body = F.regexp_replace(F.regexp_replace("_r", r"^[^\r\n]*", ""), r"[\s>]", "")
    return rows.where(F.trim("_r") != "").select("source_file", "ordinal", F.regexp_extract(head, r"^(\S*)", 1).alias("seq_name"), head.alias("header"), body.alias("sequence"))


def last_of_each(records: DataFrame) -> DataFrame:
    """One record per name and file: the last one."""
    return records.groupBy("source_file", "seq_name").agg(F.max_by("sequence", "ordinal").alias("sequence"), F.max("ordinal").alias("ordinal"))


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """source_file, ordinal, seq_name, sequence, qual, quals of four-line records.

    Records are split where a line begins with ``@``, so large files are split between tasks. A quality line that begins
    with ``@`` is split off as well: such a record's three lines are joined with the piece behind them, which for the last
    one of a file's block is the first of the next block.
    """
    meta = [F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_from"), (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")).alias("_to")]
    rows = spark.read.option("lineSep", "\n@").text(path).select(*meta, F.monotonically_increasing_id().alias("ordinal"), "value")
    lines = F.split(F.regexp_replace(F.regexp_replace("value", "\r", ""), r"\n+$", ""), "\n")
    rows = rows.select("_f", "_from", "_to", "ordinal", lines.alias("_l"))
    blocks = rows.groupBy("_f", "_from").agg(F.min("ordinal").alias("_first"), F.max("ordinal").alias("_last"))
    behind = blocks.select("_f", F.col("_from").alias("_to"), F.col("_first").alias("_then"))
    cut = rows.where(F.size("_l") == 3).join(blocks, ["_f", "_from"]).join(behind, ["_f", "_to"], "left")
    cut = cut.withColumn("_next", F.when(F.col("ordinal") == F.col("_last"), F.col("_then")).otherwise(F.col("ordinal") + 1))
    rest = rows.where(F.size("_l") == 1).select(F.col("ordinal").alias("_next"), F.get("_l", F.lit(0)).alias("_rest"))
    mended = cut.join(rest, "_next").select("_f", "ordinal", "_l", F.concat(F.lit("@"), "_rest").alias("qual"))
    whole = rows.where(F.size("_l") >= 4).select("_f", "ordinal", "_l", F.get("_l", F.lit(3)).alias("qual")).union(mended)
    name = F.regexp_extract(F.get("_l", F.lit(0)), r"^@?(\S*)", 1)
    return whole.where(F.get("_l", F.lit(2)).startswith("+")).select(
        F.element_at(F.split("_f", "/"), -1).alias("source_file"), "ordinal", name.alias("seq_name"), F.get("_l", F.lit(1)).alias("sequence"), "qual",
        F.transform(F.split("qual", ""), lambda c: F.ascii(c) - 33).alias("quals"),
    )


def hit_lines(spark: SparkSession, path: str, schema: str = HIT) -> DataFrame:
    """Tab-separated hits with ``malformed``: lines of too few fields or with an unreadable number. The last field may lack."""
    read = spark.read.option("sep", "\t").option("mode", "PERMISSIVE").schema(schema).csv(path)
    wanted = [c for c in read.columns if c != "qframe"]
    wanted = wanted[:-1] if schema == HIT else wanted
    lacking = F.lit(False)
    for c in wanted:
        lacking = lacking | F.col(c).isNull()
    return read.withColumn("malformed", lacking)


def hits(spark: SparkSession, path: str, schema: str = HIT) -> DataFrame:
    """The hits of :func:`hit_lines` that can be read."""
    return hit_lines(spark, path, schema).where(~F.col("malformed")).drop("malformed")


def pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").schema("query string, target string").csv(path)


def clusters(spark: SparkSession, path: str) -> DataFrame:
    """cluster (its first identifier), seq_id: one cluster a line, tab-separated; lines of fewer than three signs are left out."""
    rows = spark.read.text(path).where(F.length("value") >= 3).select(F.split("value", "\t").alias("_m"))
    return rows.select(F.get("_m", F.lit(0)).alias("cluster"), F.explode("_m").alias("seq_id"))


def newick(spark: SparkSession, path: str) -> DataFrame:
    """tree_id (file name before its first dot), newick: the first line of each file."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.split_part(file_name(), F.lit("."), F.lit(1)).alias("tree_id"), F.regexp_extract("value", r"^\s*([^\r\n]*)", 1).alias("newick"))


def name_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).csv(path).toDF("new_name", "original_name", "source_file")


def support_values(spark: SparkSession, path: str) -> DataFrame:
    """branch_id, value of ragged lines: a branch, then its values."""
    rows = spark.read.text(path).select(F.regexp_extract("value", r'^("(?:[^"]|"")*"|[^,]*)', 1).alias("_b"), "value")
    rest = F.split(F.expr("substring(value, length(_b) + 2)"), ",")
    return rows.select(F.regexp_replace("_b", '^"|"$', "").alias("branch_id"), F.explode(rest).alias("_v")).select("branch_id", F.trim("_v").try_cast("double").alias("value")).where(F.col("value").isNotNull())


_N = r"(-?[\d.]+(?:[eE][+-]?\d+)?)"
#: Fields of a tree report: name, pattern, type.
REPORT = (
    ("num_sequences", r"Input data:\s*(\d+) sequences", "int"),
    ("num_sites", r"Input data:.*?(\d+) \S+ sites", "int"),
    ("num_constant_sites", r"Number of constant sites:\s*(\d+)", "int"),
    ("pct_constant", rf"Number of constant sites:[^(]*\(=\s*{_N}%", "double"),
    ("num_parsimony_informative", r"Number of parsimony informative sites:\s*(\d+)", "int"),
    ("num_distinct_patterns", r"Number of distinct site patterns:\s*(\d+)", "int"),
    ("substitution_model", r"Model of substitution:\s*(\S+)", "string"),
    ("log_likelihood", rf"Log-likelihood of the tree:\s*{_N}", "double"),
    ("AIC", rf"Akaike information criterion \(AIC\) score:\s*{_N}", "double"),
    ("AICc", rf"Corrected Akaike information criterion \(AICc\) score:\s*{_N}", "double"),
    ("BIC", rf"Bayesian information criterion \(BIC\) score:\s*{_N}", "double"),
    ("gamma_alpha", rf"Gamma shape alpha:\s*{_N}", "double"),
    ("total_tree_length", rf"Total tree length[^:]*:\s*{_N}", "double"),
    ("internal_branch_length", rf"Sum of internal branch lengths:\s*{_N}", "double"),
    ("pct_internal_length", rf"Sum of internal branch lengths:[^(]*\({_N}%", "double"),
    ("cpu_time_s", rf"Total CPU time used:\s*{_N}", "double"),
    ("wall_time_s", rf"Total wall-clock time used:\s*{_N}", "double"),
)


def report_fields(rows: DataFrame) -> DataFrame:
    """gene_id and the report's fields (null where not found) of (gene_id, value)."""
    field = lambda n, p, t: F.when(F.col("value").rlike(p), F.regexp_extract("value", p, 1)).try_cast(t).alias(n)
    out = rows.select("gene_id", *(field(*f) for f in REPORT))
    return out.withColumn("pct_parsimony_informative", F.round(F.col("num_parsimony_informative") * 100.0 / F.col("num_sites"), 4))


def tree_reports(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path, wholetext=True)
    return report_fields(rows.select(F.split_part(file_name(), F.lit("."), F.lit(1)).alias("gene_id"), "value"))
