"""Queries of the library's own operators, each with its SQL where SQL has it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import alignments as al
from ..functions import scalars
from ..functions import trees as tr
from ..operators import graphs, hits, joins, kernels, names, progressive, quartets, search, summaries
from . import bridges as br
from .bridges import ALIGNMENTS, HITS, SEQUENCES, table

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


WEIGHT = "case when evalue <= 0 then 180e0 else greatest(0.01e0, -log10(evalue)) end"
MERGED = f"{HITS}, m as (select query, target, min(qstart) qs, max(qend) qe, min(tstart) ts, max(tend) te, max({WEIGHT}) w, max(qlen) ql, max(tlen) tl from h where query <> target group by query, target)"
EDGES = f"{MERGED}, e as (select query as src, target as dst, w as weight from m where (qe - qs + 1) / ql >= 0.3 and (te - ts + 1) / tl >= 0.3)"


@query(f"with {HITS} select query, target, qstart, evalue from h where query <> target")
def self_hit_filter(spark, d) -> DataFrame:
    return hits.without_self_hits(br.hits(spark, d)).select("query", "target", "qstart", "evalue")


@query(f"with {HITS} select split_part(query, '@', 1) as taxon, cast(count(*) as bigint) as n from h group by 1")
def taxon_of(spark, d) -> DataFrame:
    return br.hits(spark, d).groupBy(hits.taxon_of(F.col("query")).alias("taxon")).agg(F.count("*").alias("n"))


@query(f"with {HITS} select evalue, round({WEIGHT}, 6) as weight, cast(count(*) as bigint) as n from h group by 1, 2")
def minus_log_evalue(spark, d) -> DataFrame:
    return br.hits(spark, d).groupBy("evalue", F.round(hits.minus_log_evalue(F.col("evalue")), 6).alias("weight")).agg(F.count("*").alias("n"))


@query(f"with {HITS} select query, target, evalue from h where evalue <= 1e-5")
def evalue_filter(spark, d) -> DataFrame:
    return hits.evalue_filter(br.hits(spark, d), 1e-5).select("query", "target", "evalue")


@query(f"with {HITS} select query, target, qstart, qend from h where query <> target and pident = 100e0 and split_part(query, '@', 1) <> split_part(target, '@', 1) and (abs(qend - qstart) / qlen >= 0.45 or abs(tend - tstart) / tlen >= 0.45) and qlen >= 300 and tlen >= 300")
def ident_filter(spark, d) -> DataFrame:
    return hits.identical_hits(br.hits(spark, d), coverage=0.45).select("query", "target", "qstart", "qend")


@query(f"with {EDGES} select src as query, dst as target, round(weight, 6) as weight from e")
def hit_merge(spark, d) -> DataFrame:
    return hits.edges(br.hits(spark, d)).select(F.col("src").alias("query"), F.col("dst").alias("target"), F.round("weight", 6).alias("weight"))


@query(f"with {MERGED} select query, target, qs, qe, ts, te from m where (qe - qs + 1) / ql >= 0.5 and (te - ts + 1) / tl >= 0.5")
def coverage_filter(spark, d) -> DataFrame:
    return hits.covered(hits.merged(br.hits(spark, d)), 0.5).select("query", "target", "qs", "qe", "ts", "te")


@query(f"with {EDGES} select src, dst, round(weight, 6) as weight from e where weight >= 5")
def edge_weight_floor(spark, d) -> DataFrame:
    return hits.edges(br.hits(spark, d), floor=5).select("src", "dst", F.round("weight", 6).alias("weight"))


@query(f"with {HITS} select query, target, evalue from (select *, row_number() over (partition by query order by evalue, target) r from (select distinct query, target, evalue from h)) where r <= 5")
def search_topk(spark, d) -> DataFrame:
    return hits.top_targets(br.hits(spark, d).select("query", "target", "evalue").distinct(), 5).select("query", "target", "evalue")


@query(f"with {HITS}, c as (select split_part(query, '@', 2) gene, split_part(target, '@', 1) sp, target seq_id, pident, tlen len from h where query <> target), r as (select *, row_number() over (partition by gene, sp order by pident desc, len desc, seq_id) rn from c) select gene, sp as species, seq_id, pident from r where rn = 1")
def best_per_species(spark, d) -> DataFrame:
    return hits.best_per_species(br.hits(spark, d), seed=False).select("gene", "species", "seq_id", "pident")


@query(f"with {HITS} select split_part(query, '@', 2) as gene, cast(count(*) as bigint) as hits, cast(count(distinct target) as bigint) as targets from h where query <> target group by 1")
def group_by_gene(spark, d) -> DataFrame:
    return hits.hits_per_gene(br.hits(spark, d))


@query(f"with recursive {EDGES}, b as (select src a, dst b from e union select dst, src from e), r as (select a, a as l from b union select b.b, r.l from r join b on r.a = b.a) select a as node, min(l) as component from r group by 1")
def graph_components(spark, d) -> DataFrame:
    return graphs.components(hits.edges(br.hits(spark, d)))


@query()
def mcl_cluster(spark, d) -> DataFrame:
    return graphs.mcl_cluster(hits.edges(br.hits(spark, d), floor=5))


def _nations(spark, d) -> DataFrame:
    return table(spark, d, "customer").select(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("cluster"), F.concat("c_mktsegment", F.lit("@"), F.col("c_custkey").cast("string")).alias("seq_id"))


NATIONS = "c as (select 'N' || cast(c_nationkey as varchar) as cluster, c_mktsegment || '@' || cast(c_custkey as varchar) as seq_id from customer)"


@query(f"with {NATIONS} select cluster, cast(count(*) as bigint) as size, cast(count(distinct split_part(seq_id, '@', 1)) as bigint) as taxa from c group by 1")
def cluster_taxa(spark, d) -> DataFrame:
    return graphs.cluster_taxa(_nations(spark, d), hits.taxon_of(F.col("seq_id")))


@query(f"with {NATIONS} select * from c where cluster in (select cluster from c group by 1 having count(distinct split_part(seq_id, '@', 1)) >= 5)")
def min_taxa_filter(spark, d) -> DataFrame:
    return graphs.with_enough_taxa(_nations(spark, d), hits.taxon_of(F.col("seq_id")), 5)


@query(f"with {NATIONS}, s as (select cluster, cast(count(*) as bigint) as size from c group by 1), n as (select *, cast(row_number() over (order by size desc, cluster) as int) as number from s) select *, lpad(cast(number as varchar), 6, '0') as cluster_id from n")
def cluster_rank(spark, d) -> DataFrame:
    return graphs.cluster_number(_nations(spark, d))


@query("select s_suppkey as seq_id from supplier where s_suppkey not in (select l_suppkey from lineitem where l_quantity > 49 and l_tax > 0.07)")
def membership_anti(spark, d) -> DataFrame:
    done = table(spark, d, "lineitem").where("l_quantity > 49 and l_tax > 0.07").select(F.col("l_suppkey").alias("seq_id"))
    return graphs.unclustered(table(spark, d, "supplier").select(F.col("s_suppkey").alias("seq_id")), done)


@query("select 'N' || cast(c_nationkey as varchar) as target, list_sort(list_distinct(list('C' || cast(c_custkey as varchar)) || ['N' || cast(c_nationkey as varchar)])) as members from customer group by c_nationkey")
def pair_sets(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    return graphs.pair_sets(c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("query"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("target")))


@query("""with p as (select 'C' || cast(c_custkey as varchar) as q, 'R' || cast(n_regionkey as varchar) as t from customer join nation on c_nationkey = n_nationkey
  union all select 'N' || cast(n_nationkey as varchar), 'R' || cast(n_regionkey as varchar) from nation)
  select q as seq_id, t as cluster from p union all select distinct t, t from p""")
def combine_results(spark, d) -> DataFrame:
    label = lambda k, c: F.concat(F.lit(k), F.col(c).cast("string"))
    low = table(spark, d, "customer").select(label("C", "c_custkey").alias("query"), label("N", "c_nationkey").alias("target"))
    high = table(spark, d, "nation").select(label("N", "n_nationkey").alias("query"), label("R", "n_regionkey").alias("target"))
    return graphs.combine_results(low.union(high))


@query(f"with {NATIONS}, s as (select c_mktsegment || '@' || cast(c_custkey as varchar) as seq_id from customer union all select 'X@' || cast(s_suppkey as varchar) from supplier), t as (select cast(count(distinct seq_id) as bigint) as total from s), k as (select cast(count(distinct seq_id) as bigint) as clustered, count(distinct cluster) as clusters from c) select total, clustered, total - clustered as unclustered, round(clustered * 100e0 / total, 2) as efficiency, round(clustered / clusters, 4) as mean_size from t, k")
def hc_metrics(spark, d) -> DataFrame:
    members = _nations(spark, d)
    others = table(spark, d, "supplier").select(F.concat(F.lit("X@"), F.col("s_suppkey").cast("string")).alias("seq_id"))
    return graphs.hierarchy_metrics(members.select("seq_id").union(others), members)


@query(f"with {NATIONS}, s as (select c_mktsegment || '@' || cast(c_custkey as varchar) as seq_id, c_name as sequence from customer) select s.seq_id, sequence, cluster from s join c using (seq_id)")
def cluster_to_sequence(spark, d) -> DataFrame:
    c = table(spark, d, "customer").select(F.concat("c_mktsegment", F.lit("@"), F.col("c_custkey").cast("string")).alias("seq_id"), F.col("c_name").alias("sequence"))
    return graphs.cluster_to_sequence(c, _nations(spark, d))


@query("""with f as (select distinct p_brand || '.' || split_part(p_type, ' ', 1) || '.fa' as source_file from part),
  p as (select *, split_part(source_file, '.', 1) as px, replace(regexp_replace(source_file, '\\.[^.]*$', ''), '.', '_') as stem from f),
  s as (select source_file, case when count(*) over (partition by px) > 1 then stem else px end as s from p),
  n as (select *, row_number() over (partition by s order by source_file) - 1 as n from s)
  select source_file, case when n > 0 then s || '_' || cast(n as varchar) else s end as species from n""")
def species_map(spark, d) -> DataFrame:
    part = table(spark, d, "part")
    return names.species_map(part.select(F.concat("p_brand", F.lit("."), F.split_part("p_type", F.lit(" "), F.lit(1)), F.lit(".fa")).alias("source_file")))


@query(f"""with {SEQUENCES}, f as (select source_file, ((row_number() over (order by source_file)) * 6700417 + 1234567) % 11881376 as v from (select distinct source_file from s)),
  p as (select source_file, chr(cast(v % 26 + 65 as int)) || chr(cast(v // 26 % 26 + 65 as int)) || chr(cast(v // 676 % 26 + 65 as int)) || chr(cast(v // 17576 % 26 + 65 as int)) || chr(cast(v // 456976 % 26 + 65 as int)) as taxon from f)
  select taxon || '@' || lpad(cast(row_number() over (partition by s.source_file order by ordinal, seq_name) - 1 as varchar), 8, '0') as new_name, seq_name as original_name, s.source_file, taxon from s join p on s.source_file = p.source_file""")
def rename_contigs(spark, d) -> DataFrame:
    return names.rename_sequences(br.sequences(spark, d))


@query(f"with {SEQUENCES} select seq_name as seq_id, cast(length(sequence) as int) as n from s")
def revert_names(spark, d) -> DataFrame:
    s = br.sequences(spark, d)
    found = names.rename_sequences(s)
    renamed = s.join(found, s["seq_name"] == found["original_name"]).select(F.col("new_name").alias("seq_id"), F.length("sequence").alias("n"))
    return names.revert_names(renamed, found)


@query(f"with {ALIGNMENTS}, g as (select aln_id, length(row) as n, length(row) - length(translate(row, '-?', '')) as k from a) select aln_id, cast(count(*) as bigint) as sequences, cast(max(n) as int) as length, round(avg(k * 100e0 / n), 4) as mean_gap_pct, round(max(k * 100e0 / n), 4) as max_gap_pct, round(sum(k) * 100e0 / sum(n), 4) as missing_pct from g group by 1")
def alignment_quality(spark, d) -> DataFrame:
    return al.alignment_quality(br.alignments(spark, d))


@query(f"with {ALIGNMENTS}, p as (select aln_id, seq_id, row, unnest(range(length(row))) as i from a), o as (select aln_id, i from p group by 1, 2 having avg(case when substr(row, i + 1, 1) in ('-', '?') then 0e0 else 1e0 end) >= 0.85) select p.aln_id, p.seq_id, string_agg(substr(row, p.i + 1, 1), '' order by p.i) as row from p join o on p.aln_id = o.aln_id and p.i = o.i group by 1, 2")
def pxclsq_columns(spark, d) -> DataFrame:
    return al.drop_columns(br.alignments(spark, d), 0.85)


@query(f"with {ALIGNMENTS}, s as (select aln_id, cast(max(length(row)) as bigint) as length from a group by 1) select cast(row_number() over (order by aln_id) as int) as part_no, aln_id, length, cast(sum(length) over (order by aln_id) - length + 1 as bigint) as start, cast(sum(length) over (order by aln_id) as bigint) as end from s")
def partition_offsets(spark, d) -> DataFrame:
    return al.partition_offsets(br.alignments(spark, d))


@query(f"with {ALIGNMENTS}, o as (select aln_id, split_part(seq_id, '@', 1) as taxon, min_by(row, seq_id) as row from a group by 1, 2), g as (select * from (select distinct taxon from o), (select aln_id, max(length(row)) as n from a group by 1)) select g.taxon, string_agg(coalesce(o.row, repeat('-', g.n)), '' order by g.aln_id) as row from g left join o on g.taxon = o.taxon and g.aln_id = o.aln_id group by 1")
def supermatrix_concat(spark, d) -> DataFrame:
    return al.supermatrix(br.alignments(spark, d), hits.taxon_of(F.col("seq_id")))


@query("with t as (select doc_id, source, regexp_replace(upper(text), '[^\\p{L}]', '', 'g') as s from documents), r as (select s, coalesce(sum(length(s)) over (order by doc_id, source rows between unbounded preceding and 1 preceding), 0) as b from t where length(s) > 0) select case when bool_or(regexp_matches(substr(s, 1, cast(50000 - b as int)), '[EFILPQZ]')) then 'aa' else 'nuc' end as seq_type from r where b < 50000 having count(*) > 0")
def detect_seqtype(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    return al.detect_type(docs.select(F.col("doc_id").alias("ordinal"), F.col("source").alias("seq_name"), F.col("text").alias("sequence")))


@query("select cast(l_suppkey as varchar) as branch_id, cast(count(*) as bigint) as concord, round(avg(l_quantity), 6) as mean, round(median(l_quantity), 6) as median, min(l_quantity) as min, max(l_quantity) as max, case when count(*) > 1 then round(avg(l_quantity) - 1.96e0 * stddev_pop(l_quantity) / sqrt(count(*)), 6) else 0e0 end as ci_low, case when count(*) > 1 then round(avg(l_quantity) + 1.96e0 * stddev_pop(l_quantity) / sqrt(count(*)), 6) else 0e0 end as ci_high from lineitem group by l_suppkey")
def branch_stats(spark, d) -> DataFrame:
    return summaries.branch_stats(table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("branch_id"), F.col("l_quantity").alias("length")))


@query("select o_orderpriority as species, cast(count(distinct o_custkey) as bigint) as present, (select cast(count(distinct o_custkey) as bigint) from orders) as total, round(count(distinct o_custkey) * 100e0 / (select count(distinct o_custkey) from orders), 2) as pct from orders group by 1")
def species_coverage(spark, d) -> DataFrame:
    return summaries.species_coverage(table(spark, d, "orders").select(F.col("o_custkey").alias("tree_id"), F.col("o_orderpriority").alias("species")))


def _support(spark, d, *more: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("branch_id"), (F.col("l_quantity") / 50).alias("value"), *more)


@query("select l_partkey as branch_id, cast(count(*) as bigint) as n, round(avg(l_quantity / 50), 6) as mean, round(median(l_quantity / 50), 6) as median, min(l_quantity / 50) as min, max(l_quantity / 50) as max from lineitem group by 1")
def branch_support_stats(spark, d) -> DataFrame:
    return summaries.support_per_branch(_support(spark, d))


@query("with m as (select avg(l_quantity / 50) as m from lineitem group by l_partkey) select cast(count(*) as bigint) as branches, round(avg(m), 6) as mean, round(median(m), 6) as median, round(min(m), 6) as min, round(max(m), 6) as max, cast(count(*) filter (m > 0.7) as bigint) as high, cast(count(*) filter (m < 0.4) as bigint) as low, round(count(*) filter (m > 0.7) * 100e0 / count(*), 2) as high_pct, round(count(*) filter (m < 0.4) * 100e0 / count(*), 2) as low_pct from m")
def rpt_astral_support(spark, d) -> DataFrame:
    # as its SQL: doubles in the table's order
    return summaries.support_overall(_support(spark, d, "_metadata.file_name", "_metadata.row_index"), 0.7, 0.4, ("file_name", "row_index"))


@query("select round(avg(o_totalprice), 4) as mean_log_likelihood, round(avg(case when o_orderstatus = 'F' then o_totalprice end), 6) as mean_tree_length, round(avg(case when o_orderstatus = 'O' then o_totalprice end), 4) as mean_informative_pct from orders")
def gene_tree_means(spark, d) -> DataFrame:
    when = lambda s: F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))
    o = table(spark, d, "orders")
    return summaries.gene_tree_means(o.select(F.col("o_totalprice").alias("log_likelihood"), when("F").alias("total_tree_length"), when("O").alias("pct_parsimony_informative")))


@query("select o_custkey as tree_id, o_orderpriority as species, o_orderkey as leaf, position from (select o_custkey, o_orderpriority, o_orderkey, o_orderkey % 1000 as position, row_number() over (partition by o_custkey, o_orderpriority order by o_orderkey % 1000, o_orderkey) as r from orders) where r = 1")
def unique_species_dedup(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return summaries.first_leaf_per_species(o.select(F.col("o_custkey").alias("tree_id"), F.col("o_orderpriority").alias("species"), F.col("o_orderkey").alias("leaf"), (F.col("o_orderkey") % 1000).alias("position")))


CLADES = """recursive e as (select 'R' || cast(r_regionkey as varchar) as id, 'ROOT' as parent from region union all select 'N' || cast(n_nationkey as varchar), 'R' || cast(n_regionkey as varchar) from nation
  union all select 'C' || cast(c_custkey as varchar), 'N' || cast(c_nationkey as varchar) from customer),
  a as (select 'C' || cast(c_custkey as varchar) as leaf, c_mktsegment as taxon, 'C' || cast(c_custkey as varchar) as node from customer union all select a.leaf, a.taxon, e.parent from a join e on e.id = a.node),
  k as (select node, cast(count(*) as bigint) as tips, cast(count(distinct taxon) as bigint) as taxa from a group by node)"""


def _clades(spark, d) -> DataFrame:
    label = lambda k, c: F.concat(F.lit(k), F.col(c).cast("string"))
    c = table(spark, d, "customer")
    parents = table(spark, d, "region").select(label("R", "r_regionkey").alias("id"), F.lit("ROOT").alias("parent"))
    parents = parents.union(table(spark, d, "nation").select(label("N", "n_nationkey"), label("R", "n_regionkey"))).union(c.select(label("C", "c_custkey"), label("N", "c_nationkey")))
    return summaries.clade_tips(parents, c.select(label("C", "c_custkey").alias("leaf"), F.col("c_mktsegment").alias("taxon")))


@query(f"with {CLADES} select * from k")
def count_taxa(spark, d) -> DataFrame:
    return _clades(spark, d)


@query(f"with {CLADES} select node, cast(case when tips = taxa then tips else -1 end as bigint) as score from k")
def front_taxa(spark, d) -> DataFrame:
    return summaries.front_score(_clades(spark, d))


def _steps(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("iteration"), F.col("event_type").alias("step")).agg(F.count("*").alias("n"))


STEPS = "s as (select strftime(ts, '%Y-%m-%d') as iteration, event_type as step, count(*) as n from events group by 1, 2)"


@query(f"with {STEPS} select iteration, cast(sum(case when step = 'click' then n else 0 end) as bigint) as click, cast(sum(case when step = 'view' then n else 0 end) as bigint) as view, cast(sum(case when step = 'purchase' then n else 0 end) as bigint) as purchase from s group by 1")
def steps_by_iteration(spark, d) -> DataFrame:
    return summaries.steps_by_iteration(_steps(spark, d), ["click", "view", "purchase"])


@query("with s as (select strftime(ts, '%Y-%m-%d') as iteration, count(*) as n_in, count(*) filter (value > 10) as n_out from events group by 1), g as (select iteration, coalesce(lag(n_out) over (order by iteration), n_in) as given, n_out from s) select iteration, cast(given as bigint) as given, cast(n_out as bigint) as n_out, round(case when given > 0 then n_out * 100e0 / given else 0e0 end, 2) as success_pct from g")
def success_rates(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return summaries.success_rates(e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("iteration")).agg(F.count("*").alias("n_in"), F.count_if(F.col("value") > 10).alias("n_out")))


@query()
def trim_tips(spark, d) -> DataFrame:
    return kernels.trim_tips(br.gene_trees(spark, d))


@query()
def mask_driver(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    tree = F.concat_ws("-", F.col("c_nationkey").cast("string"), (F.col("c_custkey") % 2).cast("string"))
    rows = c.select(tree.alias("aln_id"), F.concat(F.substring("c_mktsegment", 1, 4), F.lit("_"), F.col("c_custkey").cast("string")).alias("seq_id"), F.rpad("c_name", 30, "-").alias("row"))
    return kernels.mask_tips(br.gene_trees(spark, d), rows, paraphyletic=True)


@query()
def cut_branches(spark, d) -> DataFrame:
    return kernels.cut_branches(br.gene_trees(spark, d), longest=0.01, least_taxa=1, least_piece=1)


@query()
def ortholog_mi(spark, d) -> DataFrame:
    return kernels.prune_orthologs(br.gene_trees(spark, d))


@query()
def iteration_router(spark, d) -> DataFrame:
    done, again = kernels.route(kernels.trim_tips(br.gene_trees(spark, d)), last=False)
    return done.withColumn("again", F.lit(False)).union(again.withColumn("again", F.lit(True)))


@query("select cast(c_nationkey as varchar) || '-' || cast(c_custkey % 2 as varchar) as tree_id, cast(count(*) as bigint) as tips, round(sum(floor((c_acctbal + 1000) * 3)) / 100000, 6) as total from customer group by 1")
def scan_newick(spark, d) -> DataFrame:
    n = kernels.nodes(br.gene_trees(spark, d)).where("is_tip")
    return n.groupBy("tree_id").agg(F.count("*").alias("tips"), F.round(F.sum("length"), 6).alias("total"))


@query()
def align_mafft(spark, d) -> DataFrame:
    return progressive.aligned(br.families(spark, d))


@query()
def tree_ml_fast(spark, d) -> DataFrame:
    return kernels.likelihood_trees(kernels.align(br.families(spark, d)))


@query()
def tree_ml_boot(spark, d) -> DataFrame:
    return kernels.likelihood_trees(kernels.align(br.families(spark, d)), replicates=1000)


@query()
def species_distances(spark, d) -> DataFrame:
    return kernels.species_distances(kernels.distance_trees(kernels.align(br.families(spark, d))))


@query()
def bes_collect(spark, d) -> DataFrame:
    species = "(((en,de),fr),es);"
    trees = kernels.distance_trees(kernels.align(br.families(spark, d)))
    one = trees.select("tree_id", F.regexp_replace("newick", r"_[0-9]+", "").alias("newick"))
    return kernels.branch_observations(species, one)


@query()
def hc_run(spark, d) -> DataFrame:
    s = br.families(spark, d).select(hits.taxon_of(F.col("seq_id")).alias("node"), "seq_id", "sequence")
    return kernels.cluster_up(s, "((en,de)N1,(fr,es)N2)N0;", 0.9)


@query()
def all_by_all(spark, d) -> DataFrame:
    s = br.families(spark, d).select("seq_id", "sequence")
    return search.all_by_all(s)


def _parts(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.concat("p_brand", F.lit("@"), F.col("p_partkey").cast("string")).alias("seq_id"), F.col("p_name").alias("sequence"))


PARTS = "q as (select p_brand || '@' || cast(p_partkey as varchar) as seq_id, p_name as sequence from part)"


@query(f"with {PARTS} select * from q where seq_id in (select p_brand || '@' || cast(p_partkey as varchar) from part join lineitem on l_partkey = p_partkey where l_quantity > 45)")
def busco_semi(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem").where("l_quantity > 45").select("l_partkey")
    ids = table(spark, d, "part").join(li, F.col("p_partkey") == F.col("l_partkey")).select(F.concat("p_brand", F.lit("@"), F.col("p_partkey").cast("string")).alias("seq_id"))
    return joins.filter_ids(_parts(spark, d), ids)


@query(f"with {PARTS} select cast(l_suppkey as varchar) as tree_id, replace(seq_id, '@', '_') as label, sequence from lineitem join part on l_partkey = p_partkey join q on seq_id = p_brand || '@' || cast(p_partkey as varchar)")
def tips_to_sequence(spark, d) -> DataFrame:
    tips = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").cast("string").alias("tree_id"), F.concat_ws("_", "p_brand", F.col("p_partkey").cast("string")).alias("label"))
    return joins.tips_to_sequence(tips, _parts(spark, d))


@query(f"with {PARTS} select replace(q.seq_id, '@', '_') as label, t.tree_id, sequence from q join (select p_brand || '@' || cast(p_partkey as varchar) as seq_id, max(cast(l_suppkey as varchar)) as tree_id from lineitem join part on l_partkey = p_partkey group by 1) t on t.seq_id = q.seq_id")
def ortholog_to_sequence(spark, d) -> DataFrame:
    tips = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").cast("string").alias("tree_id"), F.concat_ws("_", "p_brand", F.col("p_partkey").cast("string")).alias("label"))
    return joins.ortholog_to_sequence(tips, _parts(spark, d))


@query("select 'S' || cast(s_suppkey as varchar) as seq_id, n_name as sequence from supplier left join nation on s_nationkey = n_nationkey and n_regionkey < 3")
def genes_to_sequence(spark, d) -> DataFrame:
    s = table(spark, d, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("_s"), F.col("s_nationkey").cast("string").alias("seq_id"))
    n = table(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").cast("string").alias("seq_id"), F.col("n_name").alias("sequence"))
    return joins.genes_to_sequence(s, n).select(F.col("_s").alias("seq_id"), "sequence")


NAMES = "m as (select 'T' || cast(c_custkey % 9 as varchar) || '@' || cast(c_custkey as varchar) as new_name, c_name as original_name, 'f' || cast(c_nationkey as varchar) || '.fa' as source_file from customer)"


def _name_map(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    taxon = F.concat(F.lit("T"), (F.col("c_custkey") % 9).cast("string"))
    return c.select(F.concat(taxon, F.lit("@"), F.col("c_custkey").cast("string")).alias("new_name"), F.col("c_name").alias("original_name"), F.concat(F.lit("f"), F.col("c_nationkey").cast("string"), F.lit(".fa")).alias("source_file"), taxon.alias("taxon"))


def _leaves(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("tree_id"), F.concat(F.lit("T"), (F.col("o_custkey") % 9).cast("string"), F.lit("_"), F.col("o_custkey").cast("string")).alias("label"))


LEAVES = "k as (select o_orderkey as tree_id, 'T' || cast(o_custkey % 9 as varchar) || '_' || cast(o_custkey as varchar) as label from orders)"


@query(f"with {NAMES}, {LEAVES} select tree_id, label, coalesce('sp' || replace(source_file, '.fa', ''), label) as species from k left join (select * from m where source_file <> 'f3.fa') x on replace(new_name, '@', '_') = label")
def leaf_to_species(spark, d) -> DataFrame:
    m = _name_map(spark, d)
    species = m.select("source_file").distinct().where("source_file <> 'f3.fa'").select("source_file", F.concat(F.lit("sp"), F.split_part("source_file", F.lit("."), F.lit(1))).alias("species"))
    return joins.leaf_to_species(_leaves(spark, d), m, species)


@query(f"with {NAMES}, {LEAVES} select tree_id, coalesce(original_name, label) as label from k left join m on replace(new_name, '@', '_') = label")
def leaf_to_original(spark, d) -> DataFrame:
    return joins.leaf_to_original(_leaves(spark, d), _name_map(spark, d))


@query(f"with {NAMES} select taxon, coalesce(stem, taxon) as stem from (select distinct 'T' || cast(c_custkey % 11 as varchar) as taxon from customer) t left join (select split_part(new_name, '@', 1) as taxon, min(replace(source_file, '.fa', '')) as stem from m group by 1) s using (taxon)")
def supertips_to_stem(spark, d) -> DataFrame:
    tips = table(spark, d, "customer").select(F.concat(F.lit("T"), (F.col("c_custkey") % 11).cast("string")).alias("taxon")).distinct()
    return joins.supertips_to_stem(tips, _name_map(spark, d))


@query("select n_name as node, n_name || '.' || r_name || '.fa' as source_file from nation join region on n_regionkey = r_regionkey")
def species_to_files(spark, d) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    files = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat("n_name", F.lit("."), "r_name", F.lit(".fa")).alias("source_file"))
    return joins.species_to_files(n.select(F.col("n_name").alias("node")), files)


@query("with p as (select 'c' || cast(s_nationkey as varchar) as base, s_name as file from supplier) select base, file, case when count(*) over (partition by base) = 1 then base || '_next' else base || '_next_' || cast(row_number() over (partition by base order by file) as varchar) end as name from p")
def subtree_naming(spark, d) -> DataFrame:
    return joins.subtree_names(table(spark, d, "supplier").select(F.concat(F.lit("c"), F.col("s_nationkey").cast("string")).alias("base"), F.col("s_name").alias("file")))


@query("select cast(c_nationkey as varchar) || '-' || cast(c_custkey % 2 as varchar) as tree_id, cast(count(*) as bigint) as leaves from customer group by 1 having count(*) >= 4")
def min_leaves_filter(spark, d) -> DataFrame:
    return joins.least_leaves(kernels.nodes(br.gene_trees(spark, d)), 4)


@query(f"with {SEQUENCES} select split_part(seq_name, '@', 1) as taxon, cast(count(*) as bigint) as n, cast(sum(length(sequence)) as bigint) as letters from s group by 1")
def fasta_count(spark, d) -> DataFrame:
    return br.sequences(spark, d).groupBy(hits.taxon_of(F.col("seq_name")).alias("taxon")).agg(F.count("*").alias("n"), F.sum(F.length("sequence")).alias("letters"))


@query(f"with {SEQUENCES} select seq_name, reverse(translate(sequence, 'ACGT', 'TGCA')) as sequence from s")
def reverse_complement(spark, d) -> DataFrame:
    return br.sequences(spark, d).select("seq_name", scalars.reverse_complement(F.col("sequence")).alias("sequence"))


def _stages(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return e.groupBy(F.col("event_type").alias("stage"), (F.col("user_id") % 5).alias("iteration")).agg(F.count("*").alias("n_in"), F.count_if(F.col("value") > 20).alias("n_out"), F.sum(F.floor("value")).alias("seconds"))


STAGES = "g as (select event_type as stage, user_id % 5 as iteration, count(*) as n_in, count(*) filter (value > 20) as n_out, sum(floor(value)) as seconds from events group by 1, 2)"


@query(f"with {STAGES} select stage, cast(count(distinct iteration) as bigint) as iterations, cast(sum(n_in) as bigint) as n_in, cast(sum(n_out) as bigint) as n_out, cast(sum(seconds) as bigint) as seconds, round(case when sum(n_in) > 0 then sum(n_out) * 100e0 / sum(n_in) else 0e0 end, 2) as success_pct from g group by 1")
def totals_by_stage(spark, d) -> DataFrame:
    return summaries.totals_by_stage(_stages(spark, d))


@query(f"with {STAGES} select cast(count(distinct stage) as bigint) as stages, cast(count(distinct iteration) as bigint) as iterations, cast(sum(seconds) as bigint) as total_seconds, (select stage from (select stage, sum(seconds) as s from g group by 1) order by s desc, stage desc limit 1) as slowest from g")
def slowest_stage(spark, d) -> DataFrame:
    return summaries.pipeline_row(_stages(spark, d))


@query(f"with {STAGES}, t as (select stage, sum(n_in) as n_in, sum(n_out) as n_out from g group by 1) select stage, 'n_in' as metric, cast(n_in as double) as value from t union all select stage, 'n_out', cast(n_out as double) from t")
def long_metrics(spark, d) -> DataFrame:
    return summaries.long_metrics(_stages(spark, d).groupBy("stage").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out")), "stage", ["n_in", "n_out"])


@query()
def species_tree(spark, d) -> DataFrame:
    trees = graphs.cut_lineage(kernels.likelihood_trees(kernels.align(br.families(spark, d))), "gene-trees")
    root = quartets.species_tree(trees)
    return spark.createDataFrame([("species", tr.text(root) if root else ";")], "tree_id string, newick string")


@query()
def bes_summarize(spark, d) -> DataFrame:
    return summaries.branch_stats(bes_collect(spark, d))


@query()
def hc_vsearch(spark, d) -> DataFrame:
    return kernels.centroids(br.families(spark, d).select(F.col("aln_id").alias("node"), "seq_id", "sequence"), 0.9)


from . import later  # noqa: E402, F401  its queries go into the same tables
