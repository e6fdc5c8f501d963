"""Summaries of branch lengths, coverage, gene trees and pipeline steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graphs import cut_lineage


def branch_stats(observations: DataFrame) -> DataFrame:
    """Per branch_id of (branch_id, length): concord, mean, median, min, max and the 95 % interval of the mean (0 for one observation)."""
    x = F.col("length")
    n, mean, dev = F.count(x), F.avg(x), F.stddev_pop(x)
    half = F.lit(1.96) * dev / F.sqrt(n)
    low, high = (F.when(n > 1, e).otherwise(0.0) for e in (mean - half, mean + half))
    return observations.groupBy("branch_id").agg(n.alias("concord"), F.round(F.coalesce(mean, F.lit(0.0)), 6).alias("mean"), F.round(F.coalesce(F.median(x), F.lit(0.0)), 6).alias("median"), F.coalesce(F.min(x), F.lit(0.0)).alias("min"), F.coalesce(F.max(x), F.lit(0.0)).alias("max"), F.round(low, 6).alias("ci_low"), F.round(high, 6).alias("ci_high"))


def species_coverage(leaves: DataFrame) -> DataFrame:
    """Per species of (tree_id, species): trees it is in, all trees, percentage."""
    total = leaves.agg(F.count_distinct("tree_id").alias("total"))
    present = leaves.groupBy("species").agg(F.count_distinct("tree_id").alias("present"))
    return present.crossJoin(total).select("species", "present", "total", F.round(F.col("present") * 100.0 / F.col("total"), 2).alias("pct"))


def support_per_branch(values: DataFrame) -> DataFrame:
    """n, mean, median, min, max of (branch_id, value) per branch."""
    x = F.col("value")
    return values.groupBy("branch_id").agg(F.count(x).alias("n"), F.round(F.avg(x), 6).alias("mean"), F.round(F.median(x), 6).alias("median"), F.min(x).alias("min"), F.max(x).alias("max"))


def exact_mean(value: Column) -> Column:
    """Mean of a group's numbers by their decimal digits (18 after the point), so that the order of summing can't move it across a bound;
    as doubles where one of them isn't finite or is 10 ** 9 or more."""
    digits = F.when(F.abs(value) < 1e9, value.try_cast("decimal(28,18)"))
    return F.when(F.count(digits) == F.count(value), (F.sum(digits) / F.count(value).cast("decimal(19,0)")).cast("double")).otherwise(F.avg(value))


def mean_in_order(value: Column, *place: str) -> Column:
    """Mean of a group's numbers as doubles, summed by their places (columns): what one reader of a table gets, however it is dealt here."""
    rows = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(*place, value.alias("_x")))))
    return F.when(F.size(rows) > 0, F.aggregate(rows, F.lit(0.0), lambda s, x: s + x["_x"]) / F.size(rows))


def support_overall(values: DataFrame, high: float = 0.95, low: float = 0.50, place: tuple[str, ...] = ()) -> DataFrame:
    """One row over all branches' means: mean, median, min, max, how many above ``high`` and below ``low``, in percent too.

    Means are by their digits, or with ``place`` doubles summed in the order of these columns.
    """
    value = F.col("value")
    m = values.groupBy("branch_id").agg((mean_in_order(value, *place) if place else exact_mean(value)).alias("m"))
    n = F.count("*")
    pct = lambda c: F.round(F.when(n > 0, F.count_if(c) * 100.0 / n).otherwise(0.0), 2)
    return m.agg(n.alias("branches"), F.round(F.avg("m"), 6).alias("mean"), F.round(F.median("m"), 6).alias("median"), F.round(F.min("m"), 6).alias("min"), F.round(F.max("m"), 6).alias("max"), F.count_if(F.col("m") > high).alias("high"), F.count_if(F.col("m") < low).alias("low"), pct(F.col("m") > high).alias("high_pct"), pct(F.col("m") < low).alias("low_pct"))


def gene_tree_means(reports: DataFrame) -> DataFrame:
    return reports.agg(F.round(F.avg("log_likelihood"), 4).alias("mean_log_likelihood"), F.round(F.avg("total_tree_length"), 6).alias("mean_tree_length"), F.round(F.avg("pct_parsimony_informative"), 4).alias("mean_informative_pct"))


def first_leaf_per_species(leaves: DataFrame) -> DataFrame:
    """The first leaf (by position) of each tree and species of (tree_id, species, leaf, position)."""
    order = Window.partitionBy("tree_id", "species").orderBy("position", "leaf")
    return leaves.withColumn("_r", F.row_number().over(order)).where(F.col("_r") == 1).drop("_r")


def ancestors(parents: DataFrame, nodes: DataFrame) -> DataFrame:
    """leaf, node: each of ``nodes`` (leaf) with itself and all nodes above it in (id, parent).

    Distances double each round, so a chain of n nodes takes log2(n) rounds, each written to the shared folder. A circle
    of parents raises ValueError.
    """
    jump = cut_lineage(parents.select(F.col("id").alias("lower"), F.col("parent").alias("upper")).distinct(), "jumps")
    most = jump.agg(F.count_distinct("lower")).first()[0]
    found, step = nodes.select("leaf", F.col("leaf").alias("node")), 1
    while not jump.isEmpty():
        if step > most:
            raise ValueError("the parents of some nodes go round in a circle")
        further = found.join(jump, found["node"] == jump["lower"]).select("leaf", F.col("upper").alias("node"))
        found = cut_lineage(found.union(further), "ancestors")
        near, far = jump.alias("x"), jump.alias("y")
        jump = cut_lineage(near.join(far, F.col("x.upper") == F.col("y.lower")).select("x.lower", "y.upper"), "jumps")
        step *= 2
    return found


def taxa_below(parents: DataFrame, leaves: DataFrame) -> DataFrame:
    """node, taxon, n: leaves of each taxon below each node of (id, parent); ``leaves``: leaf, taxon."""
    above = ancestors(parents, leaves.select("leaf").distinct())
    return above.join(leaves.select("leaf", "taxon"), "leaf").groupBy("node", "taxon").agg(F.count("*").alias("n"))


def clade_tips(parents: DataFrame, leaves: DataFrame) -> DataFrame:
    """node, tips, taxa: leaves and distinct taxa below each node of (id, parent); ``leaves``: leaf, taxon."""
    return taxa_below(parents, leaves).groupBy("node").agg(F.sum("n").alias("tips"), F.count("taxon").alias("taxa"))


def back_score(parents: DataFrame, leaves: DataFrame) -> DataFrame:
    """node, score: how many leaves are not below a node, if their taxa are all different, else -1."""
    below = cut_lineage(taxa_below(parents, leaves), "taxa")
    total = leaves.groupBy("taxon").agg(F.count("*").alias("_all"))
    # taxa with two leaves or more, less those of which a node leaves one at most
    left = below.join(total, "taxon").groupBy("node").agg(F.sum("n").alias("_tips"), F.count_if((F.col("_all") > 1) & (F.col("_all") - F.col("n") < 2)).alias("_freed"))
    every = total.agg(F.sum("_all").alias("_leaves"), F.count_if(F.col("_all") > 1).alias("_several"))
    score = F.when(F.col("_several") == F.col("_freed"), F.col("_leaves") - F.col("_tips")).otherwise(-1)
    return left.crossJoin(F.broadcast(every)).select("node", score.alias("score"))  # every: one row


def front_score(clades: DataFrame) -> DataFrame:
    """tips of a clade whose taxa are all different, else -1."""
    return clades.select("node", F.when(F.col("tips") == F.col("taxa"), F.col("tips")).otherwise(-1).alias("score"))


def steps_by_iteration(steps: DataFrame, names: list[str]) -> DataFrame:
    """One row per iteration of (iteration, step, n), a column per step."""
    return steps.groupBy("iteration").agg(*(F.sum(F.when(F.col("step") == s, F.col("n")).otherwise(0)).alias(s) for s in names))


def success_rates(steps: DataFrame) -> DataFrame:
    """Per iteration of (iteration, n_in, n_out): the rate against what the iteration before wrote."""
    order = Window.orderBy("iteration")
    given = F.coalesce(F.lag("n_out").over(order), F.col("n_in"))
    return steps.select("iteration", given.alias("given"), "n_out", F.round(F.when(given > 0, F.col("n_out") * 100.0 / given).otherwise(0.0), 2).alias("success_pct"))


def duration_seconds(text: Column) -> Column:
    """Seconds of a text like ``12.34 s``; null if it isn't one."""
    return F.regexp_extract(text, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*s\s*$", 1).try_cast("double")


def totals_by_stage(steps: DataFrame) -> DataFrame:
    """Per (stage) of (stage, iteration, n_in, n_out, seconds): runs, files in and out, seconds, rate."""
    n_in, n_out = F.sum("n_in"), F.sum("n_out")
    return steps.groupBy("stage").agg(F.count_distinct("iteration").alias("iterations"), n_in.alias("n_in"), n_out.alias("n_out"), F.round(F.sum("seconds"), 2).alias("seconds"), F.round(F.when(n_in > 0, n_out * 100.0 / n_in).otherwise(0.0), 2).alias("success_pct"))


def pipeline_row(steps: DataFrame) -> DataFrame:
    """One row over all stages: stages, iterations, total seconds, slowest stage."""
    by = steps.groupBy("stage").agg(F.sum("seconds").alias("s"))
    slowest = by.agg(F.max_by("stage", F.struct("s", "stage")).alias("slowest"))
    return steps.agg(F.count_distinct("stage").alias("stages"), F.count_distinct("iteration").alias("iterations"), F.round(F.sum("seconds"), 2).alias("total_seconds")).crossJoin(slowest)


def long_metrics(rows: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Wide metrics as rows: key, metric, value."""
    pairs = F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names))
    return rows.select(key, F.explode(pairs).alias("_m")).select(key, "_m.metric", "_m.value")
