"""The driver's tables read as sequences, hits, edges, leaves and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey") % 400
    name = lambda taxon, number: F.concat(F.lit("T"), (F.col(taxon) % 12).cast("string"), F.lit("@"), F.lpad(number.cast("string"), 8, "0"))
    begin = F.col("l_linenumber")
    return li.select(
        name("l_suppkey", key).alias("query"), F.lit(600.0).alias("qlen"), name("l_partkey", key - key % 2).alias("target"), F.lit(600.0).alias("tlen"), (F.lit(100.0) - F.round(F.col("l_discount") * 100)).alias("pident"),
        (1 + begin * 20).cast("double").alias("qstart"), (1 + begin * 20 + F.col("l_quantity") * 6).alias("qend"), (1 + begin * 10).cast("double").alias("tstart"), (1 + begin * 10 + F.col("l_quantity") * 6).alias("tend"), F.pow(F.lit(10.0), -F.col("l_quantity")).alias("evalue"),
    )


HITS = """h as (
  select 'T' || cast(l_suppkey % 12 as varchar) || '@' || lpad(cast(l_orderkey % 400 as varchar), 8, '0') as query, 600e0 as qlen,
         'T' || cast(l_partkey % 12 as varchar) || '@' || lpad(cast((l_orderkey % 400) - (l_orderkey % 400) % 2 as varchar), 8, '0') as target, 600e0 as tlen,
         100e0 - round(l_discount * 100) as pident, cast(1 + l_linenumber * 20 as double) as qstart, cast(1 + l_linenumber * 20 + l_quantity * 6 as double) as qend,
         cast(1 + l_linenumber * 10 as double) as tstart, cast(1 + l_linenumber * 10 + l_quantity * 6 as double) as tend, power(10e0, -l_quantity) as evalue
  from lineitem)"""


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_file, ordinal, seq_name, sequence: the letters A, C, G, T of the documents."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat("lang", F.lit(".fa")).alias("source_file"), F.col("doc_id").alias("ordinal"), F.concat("lang", F.lit("@"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("seq_name"), F.regexp_replace(F.upper("text"), "[^ACGT]", "").alias("sequence"))


SEQUENCES = """s as (select lang || '.fa' as source_file, doc_id as ordinal, lang || '@' || lpad(cast(doc_id as varchar), 8, '0') as seq_name, regexp_replace(upper(text), '[^ACGT]', '', 'g') as sequence from documents)"""


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """aln_id, seq_id, row: the names of all parts of one brand, other signs than letters as gaps, padded to the longest."""
    part = table(spark, sf_dir, "part")
    name = F.regexp_replace("p_name", "[^A-Za-z]", "-")
    width = F.max(F.length("p_name")).over(Window.partitionBy("p_brand"))
    seq_id = F.concat("p_type", F.lit("@"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"))
    return part.select(F.col("p_brand").alias("aln_id"), seq_id.alias("seq_id"), F.rpad(name, width, F.lit("-")).alias("row"))


ALIGNMENTS = """a as (
  select p_brand as aln_id, p_type || '@' || lpad(cast(p_partkey as varchar), 8, '0') as seq_id,
         rpad(regexp_replace(p_name, '[^A-Za-z]', '-', 'g'), cast(max(length(p_name)) over (partition by p_brand) as int), '-') as row
  from part)"""


def gene_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tree_id, newick: customers of half a nation as tips, market segments as clades, balances as branch lengths."""
    c = table(spark, sf_dir, "customer")
    tip = F.concat(F.substring("c_mktsegment", 1, 4), F.lit("_"), F.col("c_custkey").cast("string"), F.lit(":0."), F.lpad(F.floor((F.col("c_acctbal") + 1000) * 3).cast("string"), 5, "0"))
    tree = F.concat_ws("-", F.col("c_nationkey").cast("string"), (F.col("c_custkey") % 2).cast("string"))
    clades = c.select(tree.alias("tree_id"), "c_mktsegment", tip.alias("tip")).groupBy("tree_id", "c_mktsegment").agg(F.array_sort(F.collect_list("tip")).alias("tips"))
    clade = F.when(F.size("tips") > 1, F.concat(F.lit("("), F.array_join("tips", ","), F.lit("):0.015"))).otherwise(F.get("tips", F.lit(0)))
    trees = clades.groupBy("tree_id").agg(F.array_sort(F.collect_list(clade)).alias("clades"))
    return trees.select("tree_id", F.concat(F.lit("("), F.array_join("clades", ","), F.lit(");")).alias("newick"))


def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """aln_id, seq_id, sequence: the letters A, C, G, T of whole documents, five to a group whatever the table's size."""
    s = sequences(spark, sf_dir)
    return s.select(F.concat(F.lit("f"), F.floor(F.col("ordinal") / 5).cast("string")).alias("aln_id"), F.col("seq_name").alias("seq_id"), "sequence").where(F.length("sequence") > 0)
