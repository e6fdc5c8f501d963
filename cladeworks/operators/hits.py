"""Search hits: filters, merging into edges, and the best hit per gene and species.

A hit has query, target, qlen, tlen, pident, qstart, qend, tstart, tend, evalue and
further columns that pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def taxon_of(sequence_id: Column, mark: str = "@") -> Column:
    """The taxon before the mark of a sequence identifier (``@`` before alignment, ``_`` in trees)."""
    return F.split_part(sequence_id, F.lit(mark), F.lit(1))


def gene_of(sequence_id: Column) -> Column:
    """The part after the mark; empty unless there are exactly two parts."""
    return F.when(F.size(F.split(sequence_id, "@")) == 2, F.split_part(sequence_id, F.lit("@"), F.lit(2))).otherwise(F.lit(""))


def minus_log_evalue(evalue: Column) -> Column:
    """-log10 with a floor of 0.01; 180 where the value isn't positive or no number."""
    number = F.try_cast(evalue, "double") if hasattr(F, "try_cast") else evalue.try_cast("double")
    return F.when(number.isNull() | F.isnan(number) | (number <= 0), F.lit(180.0)).otherwise(F.greatest(F.lit(0.01), -F.log10(F.when(number > 0, number))))


def without_self_hits(hits: DataFrame) -> DataFrame:
    return hits.where(F.col("query") != F.col("target"))


def evalue_filter(hits: DataFrame, cutoff: float) -> DataFrame:
    return hits.where(F.col("evalue") <= cutoff)


def identical_hits(hits: DataFrame, identity: float = 100.0, coverage: float = 0.9, least_length: float = 300) -> DataFrame:
    """Hits of that very identity between taxa, covering enough of either sequence, both long enough."""
    covered = lambda a, b, n: F.abs(F.col(b) - F.col(a)) / F.col(n) >= coverage
    between = (F.col("query") != F.col("target")) & (taxon_of(F.col("query")) != taxon_of(F.col("target")))
    long_enough = (F.col("qlen") >= least_length) & (F.col("tlen") >= least_length)
    return hits.where((F.col("pident") == identity) & between & (covered("qstart", "qend", "qlen") | covered("tstart", "tend", "tlen")) & long_enough)


def merged(hits: DataFrame) -> DataFrame:
    """One row per query and target: the span of all its hits on both sides and the largest weight. Spark's map-side
    aggregation replaces any batching, so a pair's hits count together wherever they stand in the input."""
    agg = [F.min("qstart").alias("qs"), F.max("qend").alias("qe"), F.min("tstart").alias("ts"), F.max("tend").alias("te"), F.max(minus_log_evalue(F.col("evalue"))).alias("weight"), F.max("qlen").alias("qlen"), F.max("tlen").alias("tlen")]
    return without_self_hits(hits).groupBy("query", "target").agg(*agg)


def covered(pairs: DataFrame, fraction: float = 0.3) -> DataFrame:
    """Merged pairs whose span covers that fraction of both sequences."""
    return pairs.where(((F.col("qe") - F.col("qs") + 1) / F.col("qlen") >= fraction) & ((F.col("te") - F.col("ts") + 1) / F.col("tlen") >= fraction))


def edges(hits: DataFrame, fraction: float = 0.3, floor: float | None = None) -> DataFrame:
    """src, dst, weight of the similarity graph."""
    found = covered(merged(hits), fraction).select(F.col("query").alias("src"), F.col("target").alias("dst"), "weight")
    return found if floor is None else found.where(F.col("weight") >= floor)


def top_targets(hits: DataFrame, k: int) -> DataFrame:
    """At most k targets per query, best first by evalue, then bits if there are any, then target."""
    order = [F.col("evalue").asc(), *([F.col("bits").desc()] if "bits" in hits.columns else []), F.col("target").asc()]
    return hits.withColumn("_r", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("_r") <= k).drop("_r")


def best_per_species(hits: DataFrame, least_taxa: int = 1, seed: bool = True) -> DataFrame:
    """gene, species, seq_id, pident, length: each gene's best target per species by identity, length and identifier.

    With ``seed`` each gene's first query competes for its own species with identity 100.
    """
    named = without_self_hits(hits).withColumns({"gene": gene_of(F.col("query")), "species": taxon_of(F.col("target"))})
    found = named.select("gene", "species", F.col("target").alias("seq_id"), "pident", F.col("tlen").alias("length"), F.lit(1).alias("_late"))
    if seed:
        first = named.groupBy("gene").agg(F.min_by(F.struct("query", "qlen"), F.struct("query", "target")).alias("_q"))
        seeds = first.select("gene", taxon_of(F.col("_q.query")).alias("species"), F.col("_q.query").alias("seq_id"), F.lit(100.0).alias("pident"), F.col("_q.qlen").alias("length"), F.lit(0).alias("_late"))
        found = seeds.unionByName(found)
    order = Window.partitionBy("gene", "species").orderBy(F.col("_late"), F.col("pident").desc(), F.col("length").desc(), "seq_id")
    best = found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") == 1).drop("_r", "_late")
    if least_taxa <= 1:
        return best
    enough = best.groupBy("gene").agg(F.count_distinct("species").alias("_n")).where(F.col("_n") >= least_taxa).select("gene")
    return best.join(enough, "gene", "left_semi")


def hits_per_gene(hits: DataFrame) -> DataFrame:
    return without_self_hits(hits).groupBy(gene_of(F.col("query")).alias("gene")).agg(F.count("*").alias("hits"), F.count_distinct("target").alias("targets"))
