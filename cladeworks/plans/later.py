"""Queries of reports, the species-tree path, translation and set cover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars, udfs
from ..functions import trees as tr
from ..operators import clusters, graphs, hits, iterations, joins, kernels, progressive, quartets, reports, search, species, splits, summaries
from . import bridges as br
from .bridges import ALIGNMENTS, SEQUENCES, table
from .queries import CLADES, query

# -- metrics of a run ---------------------------------------------------------

#: What the events of a day count, and what those of a user count over the run: stage.metric.
BY_DAY = (
    "mafft.aln_files mafft.cln_files mafft.iqtree_files mafft.time trim_tips.total_trees trim_tips.processed_count trim_tips.skipped_count trim_tips.relative_cutoff mask_tips.trees_processed "
    "mask_tips.monophyletic_tips_masked write_tree.written_files write_tree.files_moved_to_prune write_tree.total_sequences tree.time"
).split()
BY_USER = (
    "blast.contig_count blast.time mcl.mcl_count mcl.time mcl.mcl_inflation prune.total_trees prune.ortho1to1_count prune.pruned_trees prune.time prune.ortho1to1 prank.alignments prank.trees prank.time astral.num_trees "
    "astral.supermatrix_bp astral.time hierarchical_clustering.total_sequences hierarchical_clustering.cluster_count hierarchical_clustering.clustered_sequences configuration.threads"
).split()


def _metrics(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    named = lambda names, n: F.element_at(F.array(*map(F.lit, names)), (n % len(names) + 1).cast("int")).alias("sm")
    days = e.groupBy((F.dayofmonth("ts") % 6).alias("iteration"), named(BY_DAY, F.col("event_id"))).agg(F.sum(F.floor("value")).cast("double").alias("value"))
    users = e.groupBy(named(BY_USER, F.col("user_id"))).agg(F.count("*").cast("double").alias("value"))
    rows = days.union(users.select(F.lit(None).cast("int"), "sm", "value"))
    return rows.select("iteration", F.split_part("sm", F.lit("."), F.lit(1)).alias("stage"), F.split_part("sm", F.lit("."), F.lit(2)).alias("metric"), "value")


METRICS = f"""e as (select * from events),
  m as (select day(ts) % 6 as iteration, ({BY_DAY!r})[cast(event_id % {len(BY_DAY)} + 1 as int)] as sm, cast(sum(floor(value)) as double) as value from e group by 1, 2
        union all select null, ({BY_USER!r})[cast(user_id % {len(BY_USER)} + 1 as int)] as sm, cast(count(*) as double) as value from e group by 2),
  i as (select * from m where iteration is not null), r as (select * from m where iteration is null)"""


def _of(name: str) -> str:
    return f"max(value) filter (where sm = '{name}')"


def _n(name: str) -> str:
    return f"cast(coalesce({_of(name)}, 0) as bigint)"


def _s(stage: str) -> str:
    return f"coalesce({_of(stage + '.time')}, 0e0)"


NULL = "cast(null as bigint)"


@query(f"""with {METRICS}, g as (select iteration, {_n('mafft.aln_files')} as a, {_n('mafft.cln_files')} as c, {_n('mafft.iqtree_files')} as q, {_of('trim_tips.processed_count')} as t, {_of('mask_tips.trees_processed')} as k,
  {_n('write_tree.files_moved_to_prune')} as p, {_n('write_tree.written_files')} as w from i group by 1), u as (select {_n('mcl.mcl_count')} as clusters, {_n('prune.ortho1to1')} as ortho from r)
  select 'iter_' || iteration as "Iteration", case when iteration = (select min(iteration) from g) then clusters else a end as "Input", a as "After_MAFFT", c as "After_pxclsq", q as "After_IQTree",
    cast(coalesce(t, q) as bigint) as "After_TrimTips", cast(coalesce(k, t, q) as bigint) as "After_MaskTips", p + w as "After_CutBranch", p as "To_Prune", case when w > 0 then w end as "To_Next_Iter" from g, u
  union all select 'Prune', ortho, {', '.join([NULL] * 8)} from u""")
def rpt_iteration_flow(spark, d) -> DataFrame:
    return reports.iteration_flow(_metrics(spark, d))


@query(f"""with {METRICS}, g as (select iteration, {_n('mafft.aln_files')} as a, {_n('mafft.cln_files')} as c, {_n('mafft.iqtree_files')} as q, {_s('mafft')} as t, {_n('write_tree.written_files')} as w from i group by 1),
  h as (select *, coalesce(lag(w) over (order by iteration), (select {_n('mcl.mcl_count')} from r)) as given from g)
  select 'iter_' || iteration as iteration, given as input_clusters, a as aln_files, c as cln_files, q as iqtree_files, t as time, round(case when given > 0 then q * 100e0 / given else 0e0 end, 1) as success_rate from h""")
def rpt_mafft_summary(spark, d) -> DataFrame:
    return reports.mafft_summary(_metrics(spark, d))


TREE_COLUMNS = ("total_trees", "trees_processed", "trees_skipped", "error_count", "cutting_threshold_relative", "cutting_threshold_absolute", "written_files", "files_moved_to_prune", "total_sequences", "modified_files_count", "monophyletic_tips_masked", "paraphyletic_tips_masked", "time")


def _step(name: str, **own: str) -> str:
    kind = lambda c: "double" if c in ("cutting_threshold_relative", "cutting_threshold_absolute", "time") else "bigint"
    return f"select 'iter_' || iteration as iteration, '{name}' as sub_stage, " + ", ".join(f"cast({own.get(c, 'null')} as {kind(c)}) as {c}" for c in TREE_COLUMNS) + " from i group by iteration"


@query(f"with {METRICS} " + " union all ".join((
    _step("trim_tips", total_trees=_n("trim_tips.total_trees"), trees_processed=_n("trim_tips.processed_count"), trees_skipped=_n("trim_tips.skipped_count"), error_count="0", cutting_threshold_relative=_of("trim_tips.relative_cutoff")),
    _step("mask_tips", total_trees="0", trees_processed=_n("mask_tips.trees_processed"), trees_skipped="0", error_count="0", monophyletic_tips_masked=_n("mask_tips.monophyletic_tips_masked"), paraphyletic_tips_masked="0"),
    _step("cut_branches", total_trees=f"{_n('write_tree.written_files')} + {_n('write_tree.files_moved_to_prune')}", trees_processed=f"{_n('write_tree.written_files')} + {_n('write_tree.files_moved_to_prune')}", trees_skipped="0", error_count="0",
          written_files=_n("write_tree.written_files"), files_moved_to_prune=_n("write_tree.files_moved_to_prune"), total_sequences=_of("write_tree.total_sequences"), time=_s("tree")),
)))
def rpt_tree_processing(spark, d) -> DataFrame:
    return reports.tree_processing(_metrics(spark, d))


@query(f"""with {METRICS} select 'BLAST' as stage, {_n('blast.contig_count')} as contig_count, {NULL} as mcl_count, null::double as mcl_inflation, null::double as mcl_hit_frac, null::double as mcl_eval_power, {_s('blast')} as time from r
  union all select 'MCL', {NULL}, {_n('mcl.mcl_count')}, {_of('mcl.mcl_inflation')}, null, null, {_s('mcl')} from r""")
def rpt_clustering_summary(spark, d) -> DataFrame:
    return reports.clustering_summary(_metrics(spark, d))


@query(f"""with {METRICS}, p as (select {_n('prune.total_trees')} as total_trees, {_n('prune.ortho1to1_count')} as ortho1to1_count, {_n('prune.pruned_trees')} as pruned_trees, cast(0 as bigint) as ortho_mi_count, cast(0 as bigint) as skipped_trees, {_s('prune')} as time from r)
  select total_trees, ortho1to1_count, pruned_trees, ortho_mi_count, skipped_trees, round(case when total_trees > 0 then (ortho1to1_count + pruned_trees) * 100e0 / total_trees else 0e0 end, 1) as success_rate, time from p""")
def rpt_prune_metrics(spark, d) -> DataFrame:
    return reports.prune_metrics(_metrics(spark, d))


@query(f"""with {METRICS} select 'prank' as stage, {_n('prune.ortho1to1_count')} as fasta_from_tree, {_n('prank.alignments')} as alignments, cast(0 as bigint) as cleaned_alignments, {_n('prank.trees')} as prank_trees_generated,
    {NULL} as gene_trees, {NULL} as supermatrix_taxa, {NULL} as supermatrix_bp, {NULL} as bes_tree_count, {_s('prank')} as time from r
  union all select 'astral', {NULL}, {NULL}, {NULL}, {NULL}, {_n('astral.num_trees')}, {NULL}, cast({_of('astral.supermatrix_bp')} as bigint), {NULL}, {_s('astral')} from r""")
def rpt_final_alignment(spark, d) -> DataFrame:
    return reports.final_alignment(_metrics(spark, d))


@query(f"""with {METRICS}, h as (select {_n('hierarchical_clustering.total_sequences')} as t, {_n('hierarchical_clustering.clustered_sequences')} as c, {_n('hierarchical_clustering.cluster_count')} as n, cast({_of('configuration.threads')} as bigint) as k from r)
  select cast(0 as bigint) as "Input_Files", cast(0 as bigint) as "BUSCO_Extraction_Count", cast(0 as bigint) as "Gene_Clusters_Created", cast(0 as bigint) as "Guide_Tree_Gene_Count", {NULL} as "Guide_Tree_Depth", {NULL} as "Guide_Tree_Clades",
    t as "Total_Input_Sequences", n as "Sequence_Clusters_Produced", c as "Total_Sequences_Clustered", null::double as "Identity_Threshold", {NULL} as "Identity_Definition", k as "Threads_Used",
    greatest(t - c, 0) as "Sequences_Unclustered", round(case when t > 0 then c * 100e0 / t else 0e0 end, 1) as "Clustering_Efficiency_Percent", round(case when n > 0 then c / n end, 2) as "Sequences_Per_Cluster_Mean" from h""")
def rpt_hcluster(spark, d) -> DataFrame:
    return reports.hcluster(_metrics(spark, d))


@query(f"""with {METRICS}, w as (select {_n('blast.contig_count')} as contig_count, {_n('mcl.mcl_count')} as mcl_count, {_of('mcl.mcl_inflation')} as mcl_inflation, null::double as mcl_hit_frac, null::double as mcl_eval_power,
    {_n('prune.ortho1to1_count')} as ortho1to1_count, cast(0 as bigint) as ortho_mi_count, {_n('astral.num_trees')} as num_trees, {NULL} as supermatrix_taxa, cast({_of('astral.supermatrix_bp')} as bigint) as supermatrix_bp, {NULL} as bes_tree_count,
    {', '.join(f"round({_s(s)}, 2) as {s}_time" for s in ('blast', 'mcl', 'prune', 'prank', 'astral'))} from r),
  j as (select cast(count(distinct iteration) as bigint) as total_iterations, round(coalesce(sum(value) filter (where sm in ('mafft.time', 'tree.time')), 0e0), 2) as iteration_time from i),
  t as (select round(avg(o_totalprice), 4) as mean_gene_tree_log_likelihood, round(avg(case when o_orderstatus = 'F' then o_totalprice end), 6) as mean_gene_tree_length, round(avg(case when o_orderstatus = 'O' then o_totalprice end), 2) as mean_pct_parsimony_informative from orders),
  b as (select avg(l_quantity / 50) as x from lineitem group by l_partkey), s as (select round(avg(x), 6) as astral_mean_branch_support, round(count(*) filter (where x > 0.95) * 100e0 / count(*), 2) as astral_pct_branches_gt_0_95 from b)
  select *, round(blast_time + mcl_time + iteration_time + prune_time + prank_time + astral_time, 2) as total_time from w, j, t, s""")
def rpt_pipeline_summary(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    when = lambda s: F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))
    trees = o.select(F.col("o_totalprice").alias("log_likelihood"), when("F").alias("total_tree_length"), when("O").alias("pct_parsimony_informative"))
    support = table(spark, d, "lineitem").select(F.col("l_partkey").alias("branch_id"), (F.col("l_quantity") / 50).alias("value"))
    return reports.pipeline_summary(_metrics(spark, d), trees, support)


@query(f"""with {ALIGNMENTS}, f as (select aln_id, seq_id, rtrim(row, '-') as short from a), w as (select aln_id, max(length(short)) as n from f group by 1), k as (select f.aln_id, rpad(short, cast(n as int), '-') as row from f join w on f.aln_id = w.aln_id),
  g as (select aln_id, length(row) as n, length(row) - length(translate(row, '-?', '')) as k from k)
  select g.aln_id, cast(count(*) as bigint) as sequences, cast(max(b.n) as int) as sites_before, cast(max(g.n) as int) as sites_after, round(avg(g.k * 100e0 / g.n), 4) as mean_gap_pct, round(max(g.k * 100e0 / g.n), 4) as max_gap_pct
  from g join (select aln_id, max(length(row)) as n from a group by 1) b on g.aln_id = b.aln_id group by 1""")
def rpt_alignment_quality(spark, d) -> DataFrame:
    from pyspark.sql.window import Window

    before = br.alignments(spark, d)
    short = before.withColumn("row", F.rtrim("row", F.lit("-")))
    after = short.withColumn("row", F.rpad("row", F.max(F.length("row")).over(Window.partitionBy("aln_id")), F.lit("-")))
    return reports.alignment_change(before, after)


# -- text ---------------------------------------------------------------------


@query(r"""with o as (select o_orderkey as k, (o_orderkey * 7919 + 13) * (1 + o_orderkey % 3 * 100000) | 1 as n, o_orderkey / 7e0 as s, repeat('x', cast(o_orderkey % 120 as int)) || '/end' as t from orders)
  select k, case when n < 1024 then cast(n as varchar) || ' B' when n < 1048576 then printf('%.1f KB', n / 1024e0) when n < 1073741824 then printf('%.1f MB', n / 1048576e0) when n < 1099511627776 then printf('%.1f GB', n / 1073741824e0) else printf('%.1f TB', n / 1099511627776e0) end as size,
    format('{:,}', n) as number, case when length(t) <= 80 then t else '...' || right(t, 77) end as short,
    case when s < 60 then printf('%.1fs', s) when floor(s / 60) < 60 then printf('%dm', cast(floor(s / 60) as int)) || case when s - floor(s / 60) * 60 > 0 then printf(' %.1fs', s - floor(s / 60) * 60) else '' end
      else printf('%dh', cast(floor(floor(s / 60) / 60) as int)) || case when s - floor(s / 60) * 60 > 0 then printf(' %dm %.1fs', cast(floor(s / 60) as int) % 60, s - floor(s / 60) * 60) when cast(floor(s / 60) as int) % 60 > 0 then printf(' %dm', cast(floor(s / 60) as int) % 60) else '' end end as duration
  from o""")
def text_formats(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    n = ((k * 7919 + 13) * (F.lit(1) + k % 3 * 100000)).bitwiseOR(F.lit(1))
    t = F.concat(F.expr("repeat('x', cast(o_orderkey % 120 as int))"), F.lit("/end"))
    return o.select(k.alias("k"), scalars.format_bytes(n).alias("size"), scalars.format_number(n).alias("number"), scalars.shortened(t).alias("short"), scalars.format_duration(k / 7.0).alias("duration"))


_PLACE = lambda k: f"(strpos('TCAG', substr(x, i * 3 + {k}, 1)) - 1)"


@query(f"""with {SEQUENCES}, f as (select seq_name, sequence as q, reverse(translate(sequence, 'ACGT', 'TGCA')) as r from s),
  g as (select seq_name, k + 1 as frame, substr(q, k + 1) as x from f, range(3) t(k) union all select seq_name, -k - 1, substr(r, k + 1) from f, range(3) t(k))
  select seq_name, cast(frame as int) as frame, coalesce(list_aggregate(list_transform(range(length(x) // 3), lambda i: substr('{scalars.CODE}', 16 * {_PLACE(1)} + 4 * {_PLACE(2)} + {_PLACE(3)} + 1, 1)), 'string_agg', ''), '') as protein from g""")
def six_frames(spark, d) -> DataFrame:
    s = br.sequences(spark, d)
    return s.select("seq_name", F.explode(scalars.six_frames(F.col("sequence"))).alias("_f")).select("seq_name", "_f.frame", "_f.protein")


# -- searches and clusters ----------------------------------------------------


@query()
def busco_search(spark, d) -> DataFrame:
    contigs = br.sequences(spark, d).select(F.col("seq_name").alias("seq_id"), "sequence").where(F.length("sequence") > 0)
    proteins = contigs.select(F.concat(F.lit("P:"), "seq_id").alias("seq_id"), scalars.translated(F.col("sequence")).alias("sequence"))
    return search.busco_search(contigs, proteins)


@query()
def align_prank(spark, d) -> DataFrame:
    """Families aligned along the trees of a first alignment, insertions left alone."""
    families = br.families(spark, d)
    trees = kernels.likelihood_trees(kernels.align(families)).select(F.col("tree_id").alias("aln_id"), "newick")
    return progressive.aligned(families, insertions=True, trees=trees)


@query()
def refinement_loop(spark, d) -> DataFrame:
    """The loop over families of five documents to its end, with cutoffs for texts that far apart: a row a round."""
    return iterations.refined(br.families(spark, d), trimming={"relative": 1.0, "absolute": 2.0, "least": 3}, masking={"least": 3}, cutting={"longest": 0.2, "least_taxa": 1, "least_piece": 1})[1]


@query()
def hc_mmseqs2(spark, d) -> DataFrame:
    e = hits.edges(br.hits(spark, d), floor=5)
    return kernels.set_cover(e.select(F.col("src").alias("query"), F.col("dst").alias("target")))


# -- trees --------------------------------------------------------------------


@query(f"""with {CLADES}, t as (select c_mktsegment as taxon, count(*) as n from customer group by 1), i as (select node, taxon, count(*) as n from a group by 1, 2),
  o as (select k.node, t.taxon, t.n - coalesce(i.n, 0) as n from k cross join t left join i on i.node = k.node and i.taxon = t.taxon)
  select node, cast(case when max(n) <= 1 then sum(n) else -1 end as bigint) as score from o group by 1""")
def back_taxa(spark, d) -> DataFrame:
    label = lambda k, c: F.concat(F.lit(k), F.col(c).cast("string"))
    c = table(spark, d, "customer")
    parents = table(spark, d, "region").select(label("R", "r_regionkey").alias("id"), F.lit("ROOT").alias("parent"))
    parents = parents.union(table(spark, d, "nation").select(label("N", "n_nationkey"), label("R", "n_regionkey"))).union(c.select(label("C", "c_custkey"), label("N", "c_nationkey")))
    return summaries.back_score(parents, c.select(label("C", "c_custkey").alias("leaf"), F.col("c_mktsegment").alias("taxon")))


def _tip_names(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    tip = F.concat(F.substring("c_mktsegment", 1, 4), F.lit("@"), F.col("c_custkey").cast("string"))
    return c.where(F.col("c_custkey") % 10 > 0).select(tip.alias("new_name"), F.col("c_name").alias("original_name"), F.concat(F.lit("sp."), (F.col("c_custkey") % 7).cast("string"), F.lit("_busco.fa")).alias("source_file"))


def _species_ids(spark, d) -> DataFrame:
    r = table(spark, d, "region")
    return r.select(F.concat(F.lit("sp."), F.col("r_regionkey").cast("string")).alias("stem"), F.concat(F.lit("id"), F.col("r_regionkey").cast("string")).alias("id"))


TIPS = """x as (select cast(c_nationkey as varchar) || '-' || cast(c_custkey % 2 as varchar) as tree_id, substr(c_mktsegment, 1, 4) || '_' || cast(c_custkey as varchar) as label, c_custkey, c_name from customer)"""


@query(f"with {TIPS} select tree_id, case when c_custkey % 10 > 0 then c_name else label end as label from x")
def gene_tree_export(spark, d) -> DataFrame:
    return kernels.nodes(species.gene_tree_export(br.gene_trees(spark, d), _tip_names(spark, d))).where("is_tip").select("tree_id", "label")


@query(f"""with {TIPS}, y as (select distinct tree_id, case when c_custkey % 10 = 0 then label when c_custkey % 7 in (select r_regionkey from region) then 'id' || cast(c_custkey % 7 as varchar) else 'sp_' || cast(c_custkey % 7 as varchar) end as label from x)
  select tree_id, label from y where tree_id in (select tree_id from y group by 1 having count(*) >= 4)""")
def gene_tree_concat(spark, d) -> DataFrame:
    found = species.gene_tree_concat(br.gene_trees(spark, d), _tip_names(spark, d), _species_ids(spark, d))
    return kernels.nodes(found).where("is_tip").select("tree_id", "label")


@query()
def guide_tree(spark, d) -> DataFrame:
    text = species.guide_tree(br.gene_trees(spark, d), _tip_names(spark, d), _species_ids(spark, d))
    return spark.createDataFrame([("guide", text)], "tree_id string, newick string")


@query(f"""with {ALIGNMENTS}, o as (select aln_id, split_part(seq_id, '@', 1) as taxon, min_by(row, seq_id) as row from a group by 1, 2), c as (select aln_id, taxon, i, substr(row, cast(i as int), 1) as s from (select *, unnest(range(1, length(row) + 1)) as i from o)),
  p as (select x.taxon as a, y.taxon as b, cast(count(*) filter (where x.s = y.s) as bigint) as same, cast(count(*) as bigint) as sites from c x join c y on x.aln_id = y.aln_id and x.i = y.i and x.taxon < y.taxon where x.s not in ('-', '?', 'X', 'x') and y.s not in ('-', '?', 'X', 'x') group by 1, 2)
  select cast(0 as int) as replicate, a, b, same, sites from p""")
def supermatrix_counts(spark, d) -> DataFrame:
    return species.supermatrix_counts(br.alignments(spark, d), hits.taxon_of(F.col("seq_id")))


@query()
def supermatrix_tree(spark, d) -> DataFrame:
    text = species.supermatrix_tree(br.alignments(spark, d), hits.taxon_of(F.col("seq_id")), states=20, replicates=1000)
    return spark.createDataFrame([("supermatrix", text)], "tree_id string, newick string")


@query()
def bes_trees(spark, d) -> DataFrame:
    """The species tree of all families' trees with each statistic of their branches as its lengths, a row a statistic."""
    trees = kernels.likelihood_trees(kernels.align(br.families(spark, d)))
    trees = graphs.cut_lineage(trees.select("tree_id", F.regexp_replace("newick", r"_[0-9]+", "").alias("newick")), "gene-trees")
    root = quartets.species_tree(trees, whole=True)
    if root is None:
        return spark.createDataFrame([], "stat string, newick string")
    text = tr.text(root)
    return species.branch_trees(text, summaries.branch_stats(kernels.branch_observations(text, trees)))


@query()
def subtree_order(spark, d) -> DataFrame:
    return species.subtree_order(br.gene_trees(spark, d)).select("tree_id", "newick")


@query()
def ingroup_clades(spark, d) -> DataFrame:
    return species.ingroup_clades(br.gene_trees(spark, d), ["AUTO", "BUIL", "FURN"], ["MACH"], 1).select("tree_id", "piece", "newick", "status")


@query(f"with {TIPS} select tree_id, cast(count(*) as int) as tips, cast(count(distinct split_part(label, '_', 1)) as int) as taxa from x group by 1")
def tree_functions(spark, d) -> DataFrame:
    """Session functions of trees, from SQL."""
    udfs.register(spark)
    br.gene_trees(spark, d).createOrReplaceTempView("cladeworks_trees")
    return spark.sql("select tree_id, tree_tips(newick) as tips, tree_taxa(newick) as taxa from cladeworks_trees")


@query("select cast(c_nationkey as varchar) || '-' || cast(c_custkey % 2 as varchar) as tree_id, true as has from customer where c_nationkey in (select n_nationkey from nation where n_regionkey < 3) group by 1")
def tree_to_alignment(spark, d) -> DataFrame:
    n = table(spark, d, "nation").where("n_regionkey < 3").select(F.explode(F.array(*(F.concat(F.col("n_nationkey").cast("string"), F.lit(f"-{k}")) for k in (0, 1)))).alias("aln_id"))
    return joins.tree_to_alignment(br.gene_trees(spark, d), n)[0].select("tree_id", F.lit(True).alias("has"))


# -- branches, levels, support ------------------------------------------------


def _nation_trees(spark, d) -> DataFrame:
    """tree_id, newick: a tree a market segment, nations as tips, in clades by their customers' number."""
    c = table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("tree_id"), "c_nationkey").agg((F.count("*") % 4).alias("k"))
    tip = F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"))
    clades = c.groupBy("tree_id", "k").agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list(tip)), ","), F.lit("):0.5")).alias("clade"))
    return clades.groupBy("tree_id").agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list("clade")), ","), F.lit(");")).alias("newick"))


NATION_SPLITS = """t as (select c_mktsegment as tree_id, c_nationkey, count(*) % 4 as k from customer group by 1, 2),
  b as (select tree_id, k, cast(sum(1::bigint << n.r) as bigint) as below from t join (select c_nationkey, row_number() over (order by lpad(cast(c_nationkey as varchar), 2, '0')) - 1 as r from (select distinct c_nationkey from customer)) n using (c_nationkey) group by 1, 2),
  w as (select *, cast(sum(below) over (partition by tree_id) as bigint) - below as beside from b)"""


@query(f"""with {NATION_SPLITS}, f as (select * from w where tree_id = (select min(tree_id) from w))
  select f.below as few, w.tree_id, w.below as many, (f.below = w.below and f.beside = w.beside) or (f.below = w.beside and f.beside = w.below) as same,
         (f.below & w.below) <> 0 and (f.below & w.beside) <> 0 and (f.beside & w.below) <> 0 and (f.beside & w.beside) <> 0 as conflict from f, w where w.tree_id <> f.tree_id""")
def bipart_algebra(spark, d) -> DataFrame:
    """The branches of the first segment's tree against those of all others."""
    found, _ = splits.branches(_nation_trees(spark, d), whole=True)
    found = graphs.cut_lineage(found, "branches")
    first = found.agg(F.min("tree_id")).first()[0]
    of = lambda t, node, name: found.select(F.col("tree_id").alias(t), F.col("node_id").alias(node), F.col("below")[0].alias(name))
    pairs = splits.related(found.where(F.col("tree_id") == first), found.where(F.col("tree_id") != first))
    return pairs.join(of("few_id", "few_node", "few"), ["few_id", "few_node"]).join(of("tree_id", "node_id", "many"), ["tree_id", "node_id"]).select("few", "tree_id", "many", "same", "conflict")


@query("""with recursive e as (select 'R' || cast(r_regionkey as varchar) as id, 'ROOT' as parent from region union all select 'N' || cast(n_nationkey as varchar), 'R' || cast(n_regionkey as varchar) from nation
  union all select 'C' || cast(c_custkey as varchar), 'N' || cast(c_nationkey as varchar) from customer),
  u as (select id as node, 0 as level from e where id not in (select parent from e) union select e.parent, u.level + 1 from u join e on e.id = u.node)
  select u.node, cast(max(level) as int) as level, any_value(p.parts) as parts from u join (select parent, list_sort(list(id)) as parts from e group by 1) p on p.parent = u.node group by 1""")
def hc_steps(spark, d) -> DataFrame:
    label = lambda k, c: F.concat(F.lit(k), F.col(c).cast("string"))
    parents = table(spark, d, "region").select(label("R", "r_regionkey").alias("id"), F.lit("ROOT").alias("parent"))
    parents = parents.union(table(spark, d, "nation").select(label("N", "n_nationkey"), label("R", "n_regionkey"))).union(table(spark, d, "customer").select(label("C", "c_custkey"), label("N", "c_nationkey")))
    return splits.hierarchy_steps(parents)


@query("select cast(l_suppkey as varchar) as tree_id from lineitem group by 1 having avg(case when l_linenumber > 1 then case when l_returnflag = 'N' then l_quantity else 0 end end) >= 8.5 or count(*) filter (l_linenumber > 1) = 0")
def boot_filter(spark, d) -> DataFrame:
    """Suppliers as trees, their lines as clades with quantities as support; labels that are no numbers count as 0."""
    li = table(spark, d, "lineitem")
    label = F.when(F.col("l_returnflag") == "N", F.col("l_quantity").cast("string")).otherwise(F.col("l_returnflag"))
    nodes = li.select(F.col("l_suppkey").cast("string").alias("tree_id"), F.when(F.col("l_linenumber") > 1, 0).alias("parent_id"), F.lit(False).alias("is_tip"), label.alias("label"))
    return joins.support_filter(nodes, 8.5)


@query("select distinct cast(l_suppkey as varchar) as tree_id, p_brand || '_' || cast(p_partkey as varchar) as label, p_name as sequence from lineitem join part on l_partkey = p_partkey")
def ortholog_to_sequences(spark, d) -> DataFrame:
    """As ortholog_to_sequence, but a tip goes to each of its trees."""
    p = table(spark, d, "part")
    tips = table(spark, d, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").cast("string").alias("tree_id"), F.concat_ws("_", "p_brand", F.col("p_partkey").cast("string")).alias("label"))
    sequences = p.select(F.concat("p_brand", F.lit("@"), F.col("p_partkey").cast("string")).alias("seq_id"), F.col("p_name").alias("sequence"))
    return joins.ortholog_to_sequence(tips, sequences, every=True)


@query()
def ortholog_rt(spark, d) -> DataFrame:
    """Gene trees split at their duplications."""
    return kernels.rooted_orthologs(br.gene_trees(spark, d))


@query()
def hc_centroids(spark, d) -> DataFrame:
    """Centroid clusters of all sequences by aligned columns, on both strands."""
    return clusters.centroid_clusters(br.families(spark, d).select("seq_id", "sequence"))


@query()
def hc_set_cover(spark, d) -> DataFrame:
    """Set-cover clusters of all sequences by identity and coverage."""
    return clusters.set_cover_clusters(br.families(spark, d).select("seq_id", "sequence"))


# -- table functions, from SQL -------------------------------------------------


@query(f"""with {TIPS}, c as (select tree_id, split_part(label, '_', 1) as seg, count(*) as n from x group by 1, 2)
  select tree_id, cast(sum(n) as bigint) as tips, cast(count(*) filter (n > 1) + 1 as bigint) as inner_nodes from c group by 1""")
def tree_nodes(spark, d) -> DataFrame:
    udfs.register(spark)
    br.gene_trees(spark, d).createOrReplaceTempView("cladeworks_trees")
    return spark.sql("select tree_id, count_if(n.is_tip) as tips, count_if(not n.is_tip) as inner_nodes from cladeworks_trees t, lateral tree_nodes(t.newick) n group by tree_id")


@query(f"""with {TIPS}, c as (select tree_id, split_part(label, '_', 1) as seg, list_sort(list(label)) as below from x group by 1, 2)
  select c.tree_id, c.below, cast((select count(*) from x where x.tree_id = c.tree_id) - len(c.below) as int) as others from c where len(c.below) > 1""")
def tree_splits(spark, d) -> DataFrame:
    udfs.register(spark)
    br.gene_trees(spark, d).createOrReplaceTempView("cladeworks_trees")
    return spark.sql("select tree_id, s.below, size(s.beside) as others from cladeworks_trees t, lateral tree_splits(t.newick) s")


@query(f"with {SEQUENCES}, f as (select ordinal // 5 as aln, seq_name, sequence from s where length(sequence) > 0) select seq_name as seq_id, cast(length(sequence) as int) as letters, true as even from f")
def family_alignment(spark, d) -> DataFrame:
    """Families aligned by a table function over partitions: a row a sequence, its letters, and whether its row is as long as its family's others."""
    udfs.register(spark)
    br.families(spark, d).createOrReplaceTempView("cladeworks_families")
    rows = spark.sql("select * from family_alignment(table(select aln_id, seq_id, sequence from cladeworks_families) partition by aln_id)")
    own = rows.join(br.families(spark, d).select("aln_id", "seq_id"), "seq_id")
    widths = own.groupBy("aln_id").agg((F.count_distinct(F.length("row")) == 1).alias("even"))
    return own.join(widths, "aln_id").select("seq_id", F.length(F.replace("row", F.lit("-"), F.lit(""))).alias("letters"), "even")
