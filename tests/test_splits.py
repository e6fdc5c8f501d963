"""Branches as sets, their relations, and levels of a hierarchy."""

import itertools

import pytest
from pyspark.sql import functions as F

from cladeworks.functions import trees as tr
from cladeworks.operators import joins, quartets, splits

TREES = ["((a,b):0.1,(c,d):0.2,e);", "((a,c):0.3,(b,d)0.9,e);", "((a,b),c,(d,e));", "(((e,d),c),(a,b));", "((a,b,zz),(c,e,b));"]


def test_relations_against_sets(spark):
    frame = spark.createDataFrame([(f"t{i}", t) for i, t in enumerate([*TREES, "(("])], "tree_id string, newick string")
    found, taxa = splits.branches(frame)
    rows = found.collect()
    assert taxa == ["a", "b", "c", "d", "e", "zz"]
    named = lambda row: frozenset(t for i, t in enumerate(taxa) if quartets.number(row) >> i & 1)
    expected = {}
    for i, t in enumerate(TREES):
        for k, (clade, parent) in enumerate((root := tr.parse(t)).walk()):
            if parent is not None and not clade.tip:
                outside = [x for x in root.tips() if x not in clade.tips()]
                expected[f"t{i}", k] = (frozenset(clade.labels()), frozenset(x.label for x in outside))
    assert {(r.tree_id, r.node_id): (named(r.below), named(r.beside)) for r in rows} == expected
    assert {r.label for r in rows} == {"", "0.9"} and {r.length for r in rows} == {0.0, 0.1, 0.2, 0.3}
    got = {(r.few_id, r.few_node, r.tree_id, r.node_id): (r.same, r.conflict, r.compatible) for r in splits.related(found, found).collect()}
    for (p, (a, b)), (q, (c, d)) in itertools.product(expected.items(), repeat=2):
        clash = bool(a & c and a & d and b & c and b & d)
        assert got[(*p, *q)] == ({a, b} == {c, d}, clash, not clash)
    shared = {named(r.key): r.trees for r in splits.shared_branches(found.where("tree_id < 't4'")).collect()}
    assert shared[frozenset("cde")] == 3 and shared[frozenset("de")] == 2


def test_many_taxa_have_many_words(spark):
    names = [f"x{k:03d}" for k in range(150)]
    frame = spark.createDataFrame([("t", f"(({','.join(names[:130])}),{','.join(names[130:])});")], "tree_id string, newick string")
    (row,) = splits.branches(frame, whole=True)[0].collect()
    assert len(row.below) == 3 and quartets.number(row.below) == (1 << 130) - 1 and row.key == row.beside


def test_levels(spark):
    frame = spark.createDataFrame([("a", "x"), ("b", "x"), ("x", "r"), ("c", "r"), ("d", "y"), ("y", "r"), ("r", "top"), ("a", "x")], "id string, parent string")
    found = {r.node: (r.level, r.parts) for r in splits.hierarchy_steps(frame).collect()}
    assert found == {"x": (1, ["a", "b"]), "y": (1, ["d"]), "r": (2, ["c", "x", "y"]), "top": (3, ["r"])}
    assert splits.hierarchy_steps(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        splits.hierarchy_steps(spark.createDataFrame([("a", "b"), ("b", "a")], "id string, parent string"))


def test_stems_and_every_tree(spark):
    files = spark.createDataFrame([("Aus bus.x.fa",), ("cus_busco.fa",), ("dus_busco_renamed.fa",), ("eus.fa",)], "source_file string")
    nodes = spark.createDataFrame([("aus_bus",), ("cus",), ("dus",), ("eus",), ("none",)], "node string")
    found = {(r.node, r.source_file) for r in joins.species_to_files(nodes, files).collect()}
    assert found == {("aus_bus", "Aus bus.x.fa"), ("cus", "cus_busco.fa"), ("dus", "dus_busco_renamed.fa"), ("eus", "eus.fa")}
    tips = spark.createDataFrame([("t1", "a_1"), ("t2", "a_1"), ("t2", "a_1")], "tree_id string, label string")
    one = spark.createDataFrame([("a@1", "ACGT")], "seq_id string, sequence string")
    assert joins.ortholog_to_sequence(tips, one, every=True).groupBy().agg(F.count("*")).first()[0] == 2
    assert [r.tree_id for r in joins.ortholog_to_sequence(tips, one).collect()] == ["t2"]
