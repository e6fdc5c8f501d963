"""Table functions from SQL, unreadable texts and nulls among them."""

from cladeworks.functions import udfs


def test_table_functions(spark):
    assert {"tree_nodes", "tree_splits", "family_alignment"} <= set(udfs.register(spark))
    trees = spark.createDataFrame([("a", "((x:1,y:2)0.9:0.5,z);"), ("b", "(("), ("c", None), ("d", "one;")], "id string, newick string")
    trees.createOrReplaceTempView("cladeworks_test_trees")
    found = spark.sql("select id, n.* from cladeworks_test_trees, lateral tree_nodes(newick) n").collect()
    assert {(r.id, r.node_id, r.parent_id, r.label, r.length, r.is_tip) for r in found} == {
        ("a", 0, 2, "x", 1.0, True), ("a", 1, 2, "y", 2.0, True), ("a", 2, 4, "0.9", 0.5, False), ("a", 3, 4, "z", 0.0, True), ("a", 4, None, "", 0.0, False), ("d", 0, None, "one", 0.0, True),
    }
    (split,) = spark.sql("select id, s.* from cladeworks_test_trees, lateral tree_splits(newick) s").collect()
    assert tuple(split) == ("a", ["x", "y"], ["z"], 0.5, "0.9")
    rows = spark.createDataFrame([("f", "p", "ACGTACGT"), ("f", "q", "ACGACGT"), ("g", "r", None)], "aln_id string, seq_id string, sequence string")
    rows.createOrReplaceTempView("cladeworks_test_rows")
    aligned = spark.sql("select * from family_alignment(table(select * from cladeworks_test_rows) partition by aln_id)").collect()
    assert {tuple(r) for r in aligned} == {("p", "ACGTACGT"), ("q", "ACG-ACGT"), ("r", "")}
