"""Joins between tree tips, clusters, sequences, species and original names.

Identifiers are written taxon@number before alignment and taxon_number in trees; joins
normalise both to the latter once and stay equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def tip_key(column: Column) -> Column:
    return F.translate(column, "@", "_")


def filter_ids(sequences: DataFrame, ids: DataFrame) -> DataFrame:
    """Sequences whose seq_id is listed."""
    return sequences.join(ids.select("seq_id"), "seq_id", "left_semi")


def tips_to_sequence(tips: DataFrame, sequences: DataFrame) -> DataFrame:
    """tree_id, label, sequence of tips (tree_id, label) that have a sequence (seq_id, sequence)."""
    keyed = sequences.select(tip_key(F.col("seq_id")).alias("_k"), "sequence")
    return tips.join(keyed, tip_key(tips["label"]) == keyed["_k"]).select("tree_id", "label", "sequence")


def genes_to_sequence(members: DataFrame, sequences: DataFrame) -> DataFrame:
    """Members with their sequence, null where there is none."""
    return members.join(sequences.select("seq_id", "sequence"), "seq_id", "left")


def ortholog_to_sequence(tips: DataFrame, sequences: DataFrame, every: bool = False) -> DataFrame:
    """Sequences of ortholog tips; a tip in several trees goes to the last tree by identifier, or with ``every`` to each of them."""
    if every:
        return tips_to_sequence(tips.select("tree_id", "label").distinct(), sequences)
    last = tips.groupBy("label").agg(F.max("tree_id").alias("tree_id"))
    return tips_to_sequence(last, sequences)


def tree_to_alignment(trees: DataFrame, alignments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(trees that have an alignment of their identifier, identifiers without one)."""
    ids = alignments.select(F.col("aln_id").alias("tree_id")).distinct()
    return trees.join(ids, "tree_id", "left_semi"), trees.join(ids, "tree_id", "left_anti").select("tree_id")


def leaf_to_species(leaves: DataFrame, name_map: DataFrame, species: DataFrame) -> DataFrame:
    """Leaves with the species of the file that their name came from; else what stands before the label's first dot."""
    names = name_map.select(tip_key(F.col("new_name")).alias("_k"), "source_file")
    found = leaves.withColumn("_k", tip_key(F.col("label"))).join(names, "_k", "left").join(species.select("source_file", "species"), "source_file", "left")
    return found.withColumn("species", F.coalesce("species", F.split_part("label", F.lit("."), F.lit(1)))).drop("_k", "source_file")


def leaf_to_original(leaves: DataFrame, name_map: DataFrame) -> DataFrame:
    names = name_map.select(tip_key(F.col("new_name")).alias("_k"), "original_name")
    found = leaves.withColumn("_k", tip_key(F.col("label"))).join(names, "_k", "left")
    return found.withColumn("label", F.coalesce("original_name", "label")).drop("_k", "original_name")


def supertips_to_stem(tips: DataFrame, name_map: DataFrame) -> DataFrame:
    """taxon prefixes with the first file's stem."""
    stems = name_map.groupBy("taxon").agg(F.min(F.regexp_replace("source_file", r"\.[^.]*$", "")).alias("stem"))
    return tips.join(stems, "taxon", "left").withColumn("stem", F.coalesce("stem", "taxon"))


def species_to_files(species: DataFrame, files: DataFrame) -> DataFrame:
    """node, source_file: files whose normalised name is the node's: the stem, what stands before the first dot, or the stem without
    ``_busco_renamed`` or without ``_busco``."""
    clean = lambda c: F.lower(F.regexp_replace(c, r"[^A-Za-z0-9]+", "_"))
    stem = F.regexp_replace(F.col("source_file"), r"\.[^.]*$", "")
    keys = files.select("source_file", F.explode(F.array_distinct(F.array(clean(stem), clean(F.split_part("source_file", F.lit("."), F.lit(1))), clean(F.replace(stem, F.lit("_busco_renamed"), F.lit(""))), clean(F.replace(stem, F.lit("_busco"), F.lit("")))))).alias("_k"))
    return species.withColumn("_k", clean(F.col("node"))).join(keys, "_k").select("node", "source_file").distinct()


def subtree_names(pieces: DataFrame) -> DataFrame:
    """Pieces (base, file) named base_next, or base_next_k where a base has several."""
    own = Window.partitionBy("base")
    k = F.row_number().over(own.orderBy("file"))
    return pieces.withColumn("name", F.when(F.count("*").over(own) == 1, F.concat("base", F.lit("_next"))).otherwise(F.concat_ws("_", "base", F.lit("next"), k.cast("string"))))


def support_filter(nodes: DataFrame, least: float) -> DataFrame:
    """Trees of (tree_id, parent_id, is_tip, label) whose inner clades' mean support reaches ``least``; trees without any pass."""
    inner = ~F.col("is_tip") & F.col("parent_id").isNotNull()
    mean = F.avg(F.when(inner, F.coalesce(F.col("label").try_cast("double"), F.lit(0.0))))
    return nodes.groupBy("tree_id").agg(mean.alias("support")).where(F.coalesce(F.col("support") >= least, F.lit(True))).select("tree_id")


def least_leaves(nodes: DataFrame, least: int) -> DataFrame:
    return nodes.groupBy("tree_id").agg(F.count_if("is_tip").alias("leaves")).where(F.col("leaves") >= least)
