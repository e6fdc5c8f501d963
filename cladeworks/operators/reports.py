"""Reports of a run, from its metrics as rows (iteration, stage, metric, value).

iteration is a number, or null for what is of the whole run; value is a number. Missing
counts are 0 and missing settings null. Reports are a few rows: whatever they sum was
counted where it arose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .summaries import exact_mean


def of(stage: str, metric: str) -> Column:
    """The value of a metric in a group of metrics; null if it has none."""
    return F.max(F.when((F.col("stage") == stage) & (F.col("metric") == metric), F.col("value")))


def count(stage: str, metric: str) -> Column:
    return F.coalesce(of(stage, metric), F.lit(0.0)).cast("long")


def seconds(stage: str) -> Column:
    return F.coalesce(of(stage, "time"), F.lit(0.0))


def _per_iteration(metrics: DataFrame, **columns: Column) -> DataFrame:
    return metrics.where(F.col("iteration").isNotNull()).groupBy("iteration").agg(*(c.alias(n) for n, c in columns.items()))


def _run(metrics: DataFrame, **columns: Column) -> DataFrame:
    return metrics.where(F.col("iteration").isNull()).agg(*(c.alias(n) for n, c in columns.items()))


def _name(iteration: Column) -> Column:
    return F.concat(F.lit("iter_"), iteration.cast("string"))


def iteration_flow(metrics: DataFrame) -> DataFrame:
    """How many files each step of each iteration left, and what was pruned."""
    rows = _per_iteration(
        metrics, After_MAFFT=count("mafft", "aln_files"), After_pxclsq=count("mafft", "cln_files"), After_IQTree=count("mafft", "iqtree_files"),
        _trim=of("trim_tips", "processed_count"), _mask=of("mask_tips", "trees_processed"), To_Prune=count("write_tree", "files_moved_to_prune"), _next=count("write_tree", "written_files"),
    )
    run = _run(metrics, _clusters=count("mcl", "mcl_count"), _ortho=count("prune", "ortho1to1"))
    first = F.col("iteration") == F.min("iteration").over(Window.partitionBy(F.lit(0)))  # a row an iteration
    trimmed = F.coalesce(F.col("_trim").cast("long"), F.col("After_IQTree"))
    rows = rows.withColumn("_first", first).crossJoin(F.broadcast(run))
    steps = rows.select(
        _name(F.col("iteration")).alias("Iteration"), F.when(F.col("_first"), F.col("_clusters")).otherwise(F.col("After_MAFFT")).alias("Input"), "After_MAFFT", "After_pxclsq", "After_IQTree", trimmed.alias("After_TrimTips"),
        F.coalesce(F.col("_mask").cast("long"), trimmed).alias("After_MaskTips"), (F.col("To_Prune") + F.col("_next")).alias("After_CutBranch"), "To_Prune", F.when(F.col("_next") > 0, F.col("_next")).alias("To_Next_Iter"),
    )
    none = [F.lit(None).cast("long").alias(c) for c in steps.columns[2:]]
    return steps.union(run.select(F.lit("Prune"), "_ortho", *none))


def mafft_summary(metrics: DataFrame) -> DataFrame:
    """Alignments and trees of each iteration, and their share of what the one before wrote."""
    rows = _per_iteration(
        metrics, aln_files=count("mafft", "aln_files"), cln_files=count("mafft", "cln_files"), iqtree_files=count("mafft", "iqtree_files"), time=seconds("mafft"), _written=count("write_tree", "written_files")
    )
    run = _run(metrics, _clusters=count("mcl", "mcl_count"))
    order = Window.partitionBy(F.lit(0)).orderBy("iteration")  # a row an iteration
    rows = rows.withColumns({"_before": F.lag("_written").over(order), "_first": F.row_number().over(order) == 1}).crossJoin(F.broadcast(run))
    given = F.when(F.col("_first"), F.col("_clusters")).otherwise(F.col("_before"))
    rate = F.round(F.when(given > 0, F.col("iqtree_files") * 100.0 / given).otherwise(0.0), 1)
    return rows.select(_name(F.col("iteration")).alias("iteration"), given.alias("input_clusters"), "aln_files", "cln_files", "iqtree_files", "time", rate.alias("success_rate"))


def tree_processing(metrics: DataFrame) -> DataFrame:
    """Three rows an iteration: what trimming, masking and cutting did."""
    columns = {
        "total_trees": "long", "trees_processed": "long", "trees_skipped": "long", "error_count": "long", "cutting_threshold_relative": "double", "cutting_threshold_absolute": "double", "written_files": "long",
        "files_moved_to_prune": "long", "total_sequences": "long", "modified_files_count": "long", "monophyletic_tips_masked": "long", "paraphyletic_tips_masked": "long", "time": "double",
    }
    optional = lambda stage, metric: of(stage, metric).cast("long")
    written_, moved = count("write_tree", "written_files"), count("write_tree", "files_moved_to_prune")
    steps = {
        "trim_tips": {
            "total_trees": count("trim_tips", "total_trees"), "trees_processed": count("trim_tips", "processed_count"), "trees_skipped": count("trim_tips", "skipped_count"), "error_count": count("trim_tips", "error_count"),
            "cutting_threshold_relative": of("trim_tips", "relative_cutoff"), "cutting_threshold_absolute": of("trim_tips", "absolute_cutoff"),
        },
        "mask_tips": {
            "total_trees": count("mask_tips", "total_tree_files"), "trees_processed": count("mask_tips", "trees_processed"), "trees_skipped": count("mask_tips", "trees_skipped"),
            "error_count": count("mask_tips", "file_read_errors") + count("mask_tips", "tree_parse_errors"), "monophyletic_tips_masked": count("mask_tips", "monophyletic_tips_masked"), "paraphyletic_tips_masked": count("mask_tips", "paraphyletic_tips_masked"),
        },
        "cut_branches": {
            "total_trees": written_ + moved, "trees_processed": written_ + moved, "trees_skipped": count("write_tree", "skipped_count"), "error_count": count("write_tree", "error_count"), "written_files": written_, "files_moved_to_prune": moved,
            "total_sequences": optional("write_tree", "total_sequences"), "modified_files_count": optional("write_tree", "modified_files_count"), "time": seconds("tree"),
        },
    }
    one = lambda step, own: F.struct(F.lit(step).alias("sub_stage"), *(own.get(c, F.lit(None)).cast(t).alias(c) for c, t in columns.items()))
    rows = _per_iteration(metrics, **{s: one(s, own) for s, own in steps.items()})
    return rows.select(_name(F.col("iteration")).alias("iteration"), F.explode(F.array(*steps)).alias("_s")).select("iteration", "_s.*")


def clustering_summary(metrics: DataFrame) -> DataFrame:
    """A row for the search and one for the clustering."""
    none = F.lit(None)
    search = _run(metrics, stage=F.lit("BLAST"), contig_count=count("blast", "contig_count"), mcl_count=none.cast("long"), mcl_inflation=none.cast("double"), mcl_hit_frac=none.cast("double"), mcl_eval_power=none.cast("double"), time=seconds("blast"))
    clusters = _run(metrics, stage=F.lit("MCL"), contig_count=none.cast("long"), mcl_count=count("mcl", "mcl_count"), mcl_inflation=of("mcl", "mcl_inflation"), mcl_hit_frac=of("mcl", "mcl_hit_frac"), mcl_eval_power=of("mcl", "mcl_eval_power"), time=seconds("mcl"))
    return search.union(clusters)


def prune_metrics(metrics: DataFrame) -> DataFrame:
    """One row: trees pruned and the share of them that gave orthologs."""
    names = {"total_trees": "total_trees", "ortho1to1_count": "ortho1to1_count", "pruned_trees": "pruned_trees", "ortho_mi_count": "ortho_mi_count", "skipped_trees": "skipped_trees"}
    row = _run(metrics, **{n: count("prune", m) for n, m in names.items()}, time=seconds("prune"))
    rate = F.when(F.col("total_trees") > 0, (F.col("ortho1to1_count") + F.col("pruned_trees")) * 100.0 / F.col("total_trees")).otherwise(0.0)
    return row.select(*names, F.round(rate, 1).alias("success_rate"), "time")


def final_alignment(metrics: DataFrame) -> DataFrame:
    """A row for the last alignments and one for the species tree."""
    columns = ("fasta_from_tree", "alignments", "cleaned_alignments", "prank_trees_generated", "gene_trees", "supermatrix_taxa", "supermatrix_bp", "bes_tree_count")
    own = {
        "prank": {"fasta_from_tree": count("prune", "ortho1to1_count"), "alignments": count("prank", "alignments"), "cleaned_alignments": count("prank", "cleaned_alignments"), "prank_trees_generated": count("prank", "trees")},
        "astral": {"gene_trees": count("astral", "num_trees"), "supermatrix_taxa": of("astral", "supermatrix_taxa"), "supermatrix_bp": of("astral", "supermatrix_bp"), "bes_tree_count": of("astral", "bes_tree_count")},
    }
    row = lambda stage: _run(metrics, stage=F.lit(stage), **{c: own[stage].get(c, F.lit(None)).cast("long") for c in columns}, time=seconds(stage))
    return row("prank").union(row("astral"))


def pipeline_summary(metrics: DataFrame, trees: DataFrame, support: DataFrame) -> DataFrame:
    """One row on the whole run. ``trees``: the gene trees' reports; ``support``: branch_id, value."""
    whole = _run(
        metrics, contig_count=count("blast", "contig_count"), mcl_count=count("mcl", "mcl_count"), mcl_inflation=of("mcl", "mcl_inflation"), mcl_hit_frac=of("mcl", "mcl_hit_frac"), mcl_eval_power=of("mcl", "mcl_eval_power"),
        ortho1to1_count=count("prune", "ortho1to1_count"), ortho_mi_count=count("prune", "ortho_mi_count"), num_trees=count("astral", "num_trees"), supermatrix_taxa=of("astral", "supermatrix_taxa").cast("long"),
        supermatrix_bp=of("astral", "supermatrix_bp").cast("long"), bes_tree_count=of("astral", "bes_tree_count").cast("long"), **{f"{s}_time": F.round(seconds(s), 2) for s in ("blast", "mcl", "prune", "prank", "astral")},
    )
    iterations = metrics.where(F.col("iteration").isNotNull())
    timed = F.col("stage").isin("mafft", "tree") & (F.col("metric") == "time")
    rounds = iterations.agg(F.count_distinct("iteration").alias("total_iterations"), F.round(F.coalesce(F.sum(F.when(timed, F.col("value"))), F.lit(0.0)), 2).alias("iteration_time"))
    genes = trees.agg(F.round(F.avg("log_likelihood"), 4).alias("mean_gene_tree_log_likelihood"), F.round(F.avg("total_tree_length"), 6).alias("mean_gene_tree_length"), F.round(F.avg("pct_parsimony_informative"), 2).alias("mean_pct_parsimony_informative"))
    branches = support.groupBy("branch_id").agg(exact_mean(F.col("value")).alias("_m"))
    branches = branches.agg(F.round(F.avg("_m"), 6).alias("astral_mean_branch_support"), F.round(F.count_if(F.col("_m") > 0.95) * 100.0 / F.count("*"), 2).alias("astral_pct_branches_gt_0_95"))
    row = whole
    for other in (rounds, genes, branches):  # one row each
        row = row.crossJoin(F.broadcast(other))
    total = sum((F.col(f"{s}_time") for s in ("blast", "mcl", "iteration", "prune", "prank")), F.col("astral_time"))
    return row.withColumn("total_time", F.round(total, 2))


def hcluster(metrics: DataFrame) -> DataFrame:
    """One row on hierarchical clustering: sequences in and out of clusters."""
    row = _run(
        metrics, Input_Files=count("input_files", "count"), BUSCO_Extraction_Count=count("busco_extraction", "busco_count"), Gene_Clusters_Created=count("gene_clustering", "gene_count"), Guide_Tree_Gene_Count=count("guide_tree", "gene_trees_count"),
        Guide_Tree_Depth=of("hierarchical_clustering", "guide_tree_depth").cast("long"), Guide_Tree_Clades=of("hierarchical_clustering", "guide_tree_clades").cast("long"), Total_Input_Sequences=count("hierarchical_clustering", "total_sequences"),
        Sequence_Clusters_Produced=count("hierarchical_clustering", "cluster_count"), Total_Sequences_Clustered=count("hierarchical_clustering", "clustered_sequences"),
        Identity_Threshold=of("configuration", "hcluster_id"), Identity_Definition=of("configuration", "hcluster_iddef").cast("long"), Threads_Used=of("configuration", "threads").cast("long"),
    )
    total, done, n = F.col("Total_Input_Sequences"), F.col("Total_Sequences_Clustered"), F.col("Sequence_Clusters_Produced")
    return row.withColumns({
        "Sequences_Unclustered": F.greatest(total - done, F.lit(0)),
        "Clustering_Efficiency_Percent": F.round(F.when(total > 0, done * 100.0 / total).otherwise(0.0), 1),
        "Sequences_Per_Cluster_Mean": F.round(F.when(n > 0, done / n), 2),
    })


def alignment_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """aln_id, sequences, sites_before, sites_after, mean_gap_pct, max_gap_pct of alignments before and after their columns were filtered."""
    from .alignments import alignment_quality

    sites = before.groupBy("aln_id").agg(F.max(F.length("row")).alias("sites_before"))
    rows = sites.join(alignment_quality(after), "aln_id", "left")
    return rows.select("aln_id", "sequences", "sites_before", F.coalesce("length", F.lit(0)).alias("sites_after"), "mean_gap_pct", "max_gap_pct")
