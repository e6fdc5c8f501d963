"""Sequence folders as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import EXTENSIONS


def fasta_stream(spark: SparkSession, path: str) -> DataFrame:
    """Records (seq_name, sequence, seen) of FASTA files as they come into a folder."""
    rows = spark.readStream.option("lineSep", "\n>").option("pathGlobFilter", EXTENSIONS).text(path)
    rows = rows.select(F.regexp_replace("value", r"^\s*>", "").alias("_r"), F.current_timestamp().alias("seen")).where(F.trim("_r") != "")
    return rows.select(F.regexp_extract("_r", r"^(\S*)", 1).alias("seq_name"), F.regexp_replace(F.regexp_replace("_r", r"^[^\r\n]*", ""), r"[\s>]", "").alias("sequence"), "seen")


def taxon_counts(records: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Records and letters per taxon and time window; windows close once the watermark has passed them."""
    taxon = F.split_part("seq_name", F.lit("@"), F.lit(1)).alias("taxon")
    return records.withWatermark("seen", late).groupBy(F.window("seen", window), taxon).agg(F.count("*").alias("records"), F.sum(F.length("sequence")).alias("letters"))
