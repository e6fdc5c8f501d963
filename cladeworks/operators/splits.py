"""Branches of trees as rows of two sets of taxa, their relations, and the steps of a guide tree.

A set is an array of 60-bit words, a bit a taxon (see :mod:`quartets`), so relations are bit operations inside Spark's own expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import trees as tr
from .graphs import cut_lineage
from .quartets import taxa_of, words

#: Most branches, and their bytes, of the side that is sent to all tasks.
BROADCAST_BRANCHES, BROADCAST_BYTES = 20_000, 64 << 20


def branches(trees: DataFrame, taxa: list[str] | None = None, whole: bool = False) -> tuple[DataFrame, list[str]]:
    """(tree_id, node_id, below, beside, key, length, label of every inner branch of (tree_id, newick); the taxa in order of their bits).

    ``below`` is the set of taxa under the branch, ``beside`` that of the tree's others, and ``key`` the one of the two without
    the tree's first taxon, so equal branches of trees over the same taxa have equal keys. A taxon on both sides is in both sets. Unreadable trees have no rows.
    """
    import pandas as pd

    taxa = taxa_of(trees, whole) if taxa is None else taxa
    place, n = {t: i for i, t in enumerate(taxa)}, max(len(taxa), 1)
    schema = "tree_id string, node_id int, below array<long>, beside array<long>, key array<long>, length double, label string"

    def run(frames):
        for frame in frames:
            out = []
            for tree_id, newick in zip(frame["tree_id"], frame["newick"], strict=True):
                try:
                    root = tr.parse(newick or "", lenient=True)
                except ValueError:
                    continue
                under: dict[int, int] = {}
                tips = [1 << place[x if whole else tr.taxon(x)] if (x if whole else tr.taxon(x)) in place else 0 for x in root.labels()]
                first: dict[int, tuple[int, int]] = {}  # the tips below are neighbours in walking order
                at = 0
                for clade, _ in root.walk():
                    if clade.tip:
                        under[id(clade)], first[id(clade)] = tips[at], (at, at + 1)
                        at += 1
                    else:
                        under[id(clade)] = 0
                        for p in clade.parts:
                            under[id(clade)] |= under[id(p)]
                        first[id(clade)] = (first[id(clade.parts[0])][0], first[id(clade.parts[-1])][1])
                before, after = [0], [0]
                for x in tips:
                    before.append(before[-1] | x)
                for x in tips[::-1]:
                    after.append(after[-1] | x)
                every = before[-1]
                for k, (clade, parent) in enumerate(root.walk()):
                    if parent is not None and not clade.tip:
                        low, high = first[id(clade)]
                        below, beside = under[id(clade)], before[low] | after[len(tips) - high]
                        key = beside if below & (every & -every) else below
                        out.append((tree_id, k, words(below, n), words(beside, n), words(key, n), clade.length, clade.label))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return trees.select("tree_id", "newick").mapInPandas(run, schema), taxa


def meet(a: Column, b: Column) -> Column:
    """Whether two sets have a taxon in common."""
    return F.exists(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y)), lambda x: x != 0)


def conflict(below_a: Column, beside_a: Column, below_b: Column, beside_b: Column) -> Column:
    """Two branches can't be in one tree: each side of one meets both sides of the other."""
    return meet(below_a, below_b) & meet(below_a, beside_b) & meet(beside_a, below_b) & meet(beside_a, beside_b)


def same(below_a: Column, beside_a: Column, below_b: Column, beside_b: Column) -> Column:
    """Two branches part the same taxa in the same way."""
    return ((below_a == below_b) & (beside_a == beside_b)) | ((below_a == beside_b) & (beside_a == below_b))


def related(few: DataFrame, many: DataFrame) -> DataFrame:
    """few_id, few_node, tree_id, node_id, same, conflict, compatible of each branch of ``many`` with each of ``few``.

    ``few`` are the branches of one tree or some, which go to all tasks; beyond the bounds that is an error.
    """
    held = few.select(F.col("tree_id").alias("few_id"), F.col("node_id").alias("few_node"), F.col("below").alias("_l"), F.col("beside").alias("_r"))
    held = cut_lineage(held, "few-branches")
    rows, size = held.select((F.lit(64) + 16 * F.size("_l")).alias("s")).limit(BROADCAST_BRANCHES + 1).agg(F.count("*"), F.sum("s")).first()
    if rows > BROADCAST_BRANCHES or (size or 0) > BROADCAST_BYTES:
        raise ValueError(f"more than {BROADCAST_BRANCHES} branches, or {BROADCAST_BYTES} bytes of them, to relate others to")
    sides = ("_l", "_r", "below", "beside")
    of = [F.col(c) for c in sides]
    return many.join(F.broadcast(held), F.lit(True)).select("few_id", "few_node", "tree_id", "node_id", same(*of).alias("same"), conflict(*of).alias("conflict"), (~conflict(*of)).alias("compatible"))


def shared_branches(trees: DataFrame) -> DataFrame:
    """key, trees: in how many trees (over the same taxa) each branch is; an equi-join of trees with themselves comes to this count."""
    return trees.groupBy("key").agg(F.count_distinct("tree_id").alias("trees"))


def hierarchy_steps(parents: DataFrame) -> DataFrame:
    """node, level, parts of every inner node of (id, parent): 1 more than its highest part's level, leaves being 0; the sorted names of its direct parts.

    A round a level: nodes whose parts all have a level get theirs. Circles are an error, as nothing in them ever gets one.
    """
    links = cut_lineage(parents.select(F.col("id"), F.col("parent")).distinct(), "parents")
    parts = cut_lineage(links.groupBy("parent").agg(F.array_sort(F.collect_list("id")).alias("parts")).withColumnRenamed("parent", "node"), "parts")
    waiting = cut_lineage(links.join(parts.select(F.col("node").alias("id"), F.lit(True).alias("_inner")), "id", "left"), "waiting")
    done, level = [], 0
    open_ = waiting.where("_inner").select("id", "parent")
    left = parts.select("node")
    while not left.isEmpty():
        level += 1
        ready = cut_lineage(left.join(open_.select(F.col("parent").alias("node")), "node", "left_anti"), "ready")
        if ready.isEmpty():
            raise ValueError("a node is above itself")
        done.append(ready.withColumn("level", F.lit(level)))
        left = cut_lineage(left.join(ready, "node", "left_anti"), "left")
        open_ = cut_lineage(open_.join(ready.select(F.col("node").alias("id")), "id", "left_anti"), "open")
    out = done[0] if done else parts.select("node", F.lit(0).alias("level")).limit(0)
    for more in done[1:]:
        out = out.union(more)
    return out.join(parts, "node").select("node", "level", "parts")
