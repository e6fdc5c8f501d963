"""Similarity graphs: components, Markov clustering, and tables of clusters."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name below the one that the session names in ``spark.checkpoint.dir``.

    Where it names none, below the warehouse folder if that is in a store which all executors reach; a session on one
    machine takes a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and spark.sparkContext.master.startswith("local"):
        base = "file://" + tempfile.mkdtemp(prefix="cladeworks-")
        spark.sparkContext.setCheckpointDir(base)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if warehouse.startswith(("/", "file:")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"{warehouse.rstrip('/')}/_checkpoints"
    return f"{base.rstrip('/')}/cladeworks/{what}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._folder = path
    return kept


def forget(df: DataFrame) -> None:
    """Deletes the folder of a table of :func:`cut_lineage` that nothing will read any more."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(df._folder)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (large star) or smaller (small star) neighbours to the smallest one, itself included."""
    if large:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes of ``edges`` (src, dst), by alternating large and small stars.

    A round is a map-side combined minimum per node and one join with the edges, so a node with very many neighbours is
    one row on one side of a join whose other side Spark splits. Rounds end when the edges no longer change, after a
    number that grows with the logarithm of the nodes; each is written to the shared folder.
    """
    ordered = lambda e: e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct()
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    links, seen = cut_lineage(ordered(edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))), "star"), None
    while True:
        new = cut_lineage(ordered(_star(ordered(_star(links, True)), False)), "star")
        forget(links)
        links = new
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    found = nodes.join(links, nodes["node"] == links["a"], "left")
    return found.select("node", F.coalesce("b", "node").alias("component"))


#: Markov clustering, dense and as a table alike: entries below PRUNE of their column's largest are dropped, rounds end when no entry moves by SETTLED; where some still do after MARKOV_ROUNDS, that is an error.
PRUNE, MARKOV_ROUNDS, SETTLED = 1e-5, 1000, 1e-6


def markov_clusters(matrix: np.ndarray, inflation: float = 1.4, rounds: int = MARKOV_ROUNDS, prune: float = PRUNE) -> list[list[int]]:
    """Clusters of one component's symmetric weights by expansion and inflation. An entry is judged by its share of its
    column's largest, which itself always stays, so an even column is kept whole at any size."""
    m = matrix + np.diag(matrix.max(1, initial=0).clip(1e-9))
    m = m / m.sum(0)
    for _ in range(rounds):
        new = m @ m
        new = (new / new.max(0)) ** inflation
        new[new < prune] = 0
        new = new / new.sum(0)
        still = np.abs(new - m).max() < SETTLED
        m = new
        if still:
            break
    else:
        raise ValueError(f"not settled after {rounds} rounds")
    linked, left, groups = (m > 0) | (m.T > 0), np.ones(len(m), bool), []
    for x in range(len(m)):
        if left[x]:
            group, front = np.zeros(len(m), bool), np.arange(len(m)) == x
            while front.any():
                group |= front
                front = linked[front].any(0) & ~group
            left &= ~group
            groups.append(np.flatnonzero(group).tolist())
    return groups


def markov_join(edges: DataFrame, inflation: float = 1.4, rounds: int = MARKOV_ROUNDS, prune: float = PRUNE) -> DataFrame:
    """cluster, seq_id by Markov clustering with the matrix as a table, by the rule of :func:`markov_clusters`: expansion is a join and a sum, so its size bounds no task."""
    both = edges.select(F.col("src").alias("r"), F.col("dst").alias("c"), "weight").union(edges.select("dst", "src", "weight")).groupBy("r", "c").agg(F.max("weight").alias("w"))
    loops = both.groupBy("c").agg(F.max("w").alias("w")).select(F.col("c").alias("r"), "c", "w")
    column = Window.partitionBy("c")
    shares = lambda m: m.select("r", "c", (F.col("w") / F.sum("w").over(column)).alias("w"))
    inflated = lambda m: m.select("r", "c", F.pow(F.col("w") / F.max("w").over(column), F.lit(inflation)).alias("w"))
    m = cut_lineage(shares(both.where(F.col("r") != F.col("c")).union(loops)), "flow")
    for _ in range(rounds):
        a, b = m.alias("a"), m.alias("b")
        square = a.join(b, F.col("a.c") == F.col("b.r")).groupBy(F.col("a.r").alias("r"), F.col("b.c").alias("c")).agg(F.sum(F.col("a.w") * F.col("b.w")).alias("w"))
        new = cut_lineage(shares(inflated(square).where(F.col("w") >= prune)), "flow")
        moved = new.select("r", "c", F.col("w").alias("v")).join(m, ["r", "c"], "full").agg(F.max(F.abs(F.coalesce("v", F.lit(0.0)) - F.coalesce("w", F.lit(0.0))))).first()[0]
        forget(m)
        m = new
        if moved is None or moved < SETTLED:
            break
    else:
        raise ValueError(f"not settled after {rounds} rounds")
    parts = components(m.select(F.col("r").alias("src"), F.col("c").alias("dst")))
    return parts.select(F.col("component").alias("cluster"), F.col("node").alias("seq_id"))


def mcl_cluster(edges: DataFrame, inflation: float = 1.4, largest: int = 5000) -> DataFrame:
    """cluster (its smallest member), seq_id. Markov clustering runs inside connected components, one component a task's
    group; components of more than ``largest`` nodes, too large for a dense matrix, go by :func:`markov_join`."""
    import pandas as pd

    parts = components(edges)
    sizes = parts.groupBy("component").agg(F.count("*").alias("size"))
    parts = cut_lineage(parts.join(sizes, "component"), "parts")
    placed = edges.join(parts, edges["src"] == parts["node"]).select("component", "size", "src", "dst", "weight")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(rows["src"]) | set(rows["dst"]))
        number = {x: i for i, x in enumerate(names)}
        m = np.zeros((len(names), len(names)))
        for a, b, w in zip(rows["src"], rows["dst"], rows["weight"], strict=True):
            i, j = number[a], number[b]
            m[i, j] = m[j, i] = max(m[i, j], w)
        return pd.DataFrame([(names[min(g)], names[x]) for g in markov_clusters(m, inflation) for x in g], columns=["cluster", "seq_id"])

    inner = placed.where(F.col("size") <= largest).drop("size").groupBy("component").applyInPandas(run, "cluster string, seq_id string")
    outer = placed.where(F.col("size") > largest)
    return inner if outer.isEmpty() else inner.union(markov_join(outer.select("src", "dst", "weight"), inflation))


def cluster_taxa(clusters: DataFrame, taxon) -> DataFrame:
    return clusters.groupBy("cluster").agg(F.count("*").alias("size"), F.count_distinct(taxon).alias("taxa"))


def with_enough_taxa(clusters: DataFrame, taxon, least: int = 4) -> DataFrame:
    enough = cluster_taxa(clusters, taxon).where(F.col("taxa") >= least).select("cluster")
    return clusters.join(enough, "cluster", "left_semi")


def cluster_number(clusters: DataFrame) -> DataFrame:
    """cluster, size, number (from 1 by size, then smallest member) and a six-digit identifier.

    Rows are dealt by ranges of that order, and each range is numbered in a task of its own behind the count of all ranges
    before it.
    """
    sizes = cut_lineage(clusters.groupBy("cluster").agg(F.count("*").alias("size")), "sizes")
    order = [F.col("size").desc(), F.col("cluster")]
    ranged = cut_lineage(sizes.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.join(counts.select("_part", before.alias("_before")), "_part")
    number = (F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")).cast("int")
    numbered = placed.select("cluster", "size", number.alias("number"))
    return numbered.withColumn("cluster_id", F.lpad(F.col("number").cast("string"), F.greatest(F.lit(6), F.length(F.col("number").cast("string"))), "0"))


def unclustered(sequences: DataFrame, clusters: DataFrame) -> DataFrame:
    return sequences.join(clusters.select("seq_id"), "seq_id", "left_anti")


def cluster_to_sequence(sequences: DataFrame, clusters: DataFrame) -> DataFrame:
    return sequences.join(clusters, "seq_id")


def pair_sets(pairs: DataFrame) -> DataFrame:
    """target and the sorted set of its queries, the target itself included."""
    sets = pairs.groupBy("target").agg(F.collect_set("query").alias("_q"))
    return sets.select("target", F.array_sort(F.array_union("_q", F.array("target"))).alias("members"))


def combine_results(pairs: DataFrame) -> DataFrame:
    """seq_id, cluster: chains of representatives followed to their end (pairs of all runs: query member, target representative).

    A cluster is named by the end of its chain, the smallest one where a member's representatives lead to several, and by
    its smallest member where representatives go round in a circle.
    """
    links = pairs.select(F.col("query").alias("src"), F.col("target").alias("dst"))
    parts = cut_lineage(components(links), "chain")
    ends = parts.join(links.where(F.col("src") != F.col("dst")).select(F.col("src").alias("node")), "node", "left_anti")
    named = ends.groupBy("component").agg(F.min("node").alias("cluster"))
    return parts.join(named, "component", "left").select(F.col("node").alias("seq_id"), F.coalesce("cluster", "component").alias("cluster"))


def hierarchy_metrics(sequences: DataFrame, clusters: DataFrame) -> DataFrame:
    """total, clustered, unclustered, efficiency in percent and mean cluster size."""
    total = sequences.agg(F.count_distinct("seq_id").alias("total"))
    done = clusters.agg(F.count_distinct("seq_id").alias("clustered"), F.count_distinct("cluster").alias("clusters"))
    out = total.crossJoin(done)  # one row each
    return out.select("total", "clustered", (F.col("total") - F.col("clustered")).alias("unclustered"), F.round(F.col("clustered") * 100.0 / F.col("total"), 2).alias("efficiency"), F.round(F.col("clustered") / F.col("clusters"), 4).alias("mean_size"))
