"""Species identifiers of files and deterministic sequence names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def species_map(files: DataFrame) -> DataFrame:
    """source_file, species: the name before its first dot; the stem with dots as underscores where several files share
    that, and a number where several share the stem."""
    rows = files.select("source_file").distinct().withColumn("_p", F.split_part("source_file", F.lit("."), F.lit(1)))
    stem = F.regexp_replace(F.regexp_replace("source_file", r"\.[^.]*$", ""), r"\.", "_")
    rows = rows.withColumn("_s", F.when(F.count("*").over(Window.partitionBy("_p")) > 1, stem).otherwise(F.col("_p")))
    n = F.row_number().over(Window.partitionBy("_s").orderBy("source_file")) - 1
    return rows.withColumn("_n", n).select("source_file", F.when(F.col("_n") > 0, F.concat_ws("_", "_s", "_n")).otherwise(F.col("_s")).alias("species"))


def prefix_of(number: Column) -> Column:
    """Five capital letters for a number: a bijection on 0 .. 26^5 - 1 that spreads neighbours."""
    spread = (number.cast("long") * 6_700_417 + 1_234_567) % 26**5
    letter = lambda k: F.chr((F.floor(spread / 26**k) % 26 + 65).cast("int")) if hasattr(F, "chr") else F.char((F.floor(spread / 26**k) % 26 + 65).cast("int"))
    return F.concat(*(letter(k) for k in range(5)))


def rename_sequences(records: DataFrame) -> DataFrame:
    """new_name (file prefix @ eight-digit number), original_name, source_file, taxon of each record (source_file, ordinal, seq_name)."""
    files = records.select("source_file").distinct().withColumn("_f", F.row_number().over(Window.orderBy("source_file")))
    number = F.row_number().over(Window.partitionBy("source_file").orderBy("ordinal", "seq_name")) - 1
    taxon = prefix_of(F.col("_f"))
    named = records.join(files, "source_file").withColumns({"taxon": taxon, "_n": number})
    return named.select(F.concat("taxon", F.lit("@"), F.lpad(F.col("_n").cast("string"), 8, "0")).alias("new_name"), F.col("seq_name").alias("original_name"), "source_file", "taxon")


def revert_names(rows: DataFrame, name_map: DataFrame, column: str = "seq_id") -> DataFrame:
    """Original names for renamed ones; others stay."""
    names = name_map.select(F.col("new_name").alias(column), "original_name")
    return rows.join(names, column, "left").withColumn(column, F.coalesce("original_name", column)).drop("original_name")
