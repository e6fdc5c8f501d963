"""What larger tables need: work that is dealt to all parts, and steps that grow no faster than their input."""

import functools
import operator
import random

from pyspark.sql import functions as F

from cladeworks.functions import phylogeny as ph
from cladeworks.operators import kernels


def _table(a: str, b: str) -> list[list[int]]:
    d = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(d[-1][j] + 1, row[-1] + 1, d[-1][j - 1] + (x != y)))
        d.append(row)
    return d


def test_bits_give_the_way_that_the_table_gives():
    rng = random.Random(3)
    for _ in range(200):
        a = "".join(rng.choices("ACGT", k=rng.randrange(30)))
        b = "".join(rng.choices("ACGT", k=rng.randrange(30)))
        d, i, j, want = _table(a, b), len(a), len(b), []
        while i or j:
            if i and j and d[i][j] == d[i - 1][j - 1] + (a[i - 1] != b[j - 1]):
                i, j = i - 1, j - 1
                want.append((a[i], b[j]))
            elif i and d[i][j] == d[i - 1][j] + 1:
                i -= 1
                want.append((a[i], "-"))
            else:
                j -= 1
                want.append(("-", b[j]))
        x, y = ph.align_pair(a, b)
        assert list(zip(x, y, strict=True)) == want[::-1]
        assert ph._align_by_edits(a, b, bits=64) == (x, y)


def test_a_pair_of_long_texts_is_aligned_in_little_time():
    import time

    rng = random.Random(5)
    a, b = ("".join(rng.choices("ACGT", k=6000)) for _ in range(2))
    start = time.process_time()
    x, y = ph.align_pair(a, b)
    assert x.replace("-", "") == a and y.replace("-", "") == b
    assert time.process_time() - start < 0.7


def test_small_families_are_dealt_to_all_parts(spark):
    rows = spark.createDataFrame([(f"f{k}", f"t{j}@{k}", "ACGTACGT"[: 8 - j % 2]) for k in range(40) for j in range(4)], "aln_id string, seq_id string, sequence string")
    aligned = kernels.align(rows)
    assert aligned.select(F.spark_partition_id()).distinct().count() > 1
    assert kernels.likelihood_trees(aligned).select(F.spark_partition_id()).distinct().count() > 1
    assert kernels.distance_trees(aligned).count() == 40


def test_trees_of_many_tips_are_edited_in_little_time():
    import time

    from cladeworks.functions import trees as tr

    clades = ["(" + ",".join(f"S{s}_{s * 500 + k}:0.1" for k in range(500)) + "):0.01" for s in range(5)]
    text = f"({','.join(clades)});"
    start = time.process_time()
    masked = tr.mask(tr.parse(text), {"S2_1007": 3}, 4, True)
    assert sorted(tr.taxa(masked)) == [f"S{k}" for k in range(5)] and len(masked.tips()) == 5 and "S2_1007" in masked.labels()
    assert tr.maximum_inclusion(tr.parse(text)) == []
    pieces = tr.rooted_orthologs(tr.parse(text))
    assert sorted(x for p in pieces for x in p.labels()) == sorted(tr.parse(text).labels())
    assert time.process_time() - start < 3


def test_sides_count_labels_that_are_on_both():
    from cladeworks.functions import trees as tr

    root = tr.parse("((a_1,b_1),(a_1,c_1),d_1);")
    sides = {tr.text(c): (front, back) for c, front, back in tr._sides(root)}
    # the other a_1 has the label of one below, so it isn't counted beside
    assert sides["(a_1:0,b_1:0);"] == (2, 2) and sides["d_1;"] == (1, -1)


def test_distances_of_large_trees_make_no_pairs_of_tips(spark):
    text = "(" + ",".join(f"{'ab'[k % 2]}_{k}" for k in range(8000)) + ",(a_x,b_x));"
    d = kernels.species_distances(spark.createDataFrame([("t", text), ("u", "(a_1,(b_1,b_2));")], "tree_id string, newick string")).collect()
    # t: 4000 * 4000 pairs at 1, 2 * 4000 at 2, one at 1; u: 2 and 2
    want = (16_000_000 + 16_000 + 1) / (16_000_000 + 8_000 + 1)
    assert len(d) == 1 and (d[0]["a"], d[0]["b"]) == ("a", "b") and abs(d[0]["d"] - (want + 2) / 2) < 1e-12


def test_trees_are_dealt_and_leave_in_some_rows_at_a_time(spark):
    trees = spark.createDataFrame([(f"t{k}", "(" + ",".join(f"a_{j}" for j in range(300)) + ");") for k in range(40)], "tree_id string, newick string").coalesce(1)
    nodes = kernels.nodes(trees)
    assert nodes.select(F.spark_partition_id()).distinct().count() > 1
    assert nodes.count() == 40 * 301 and nodes.where("is_tip").count() == 40 * 300


def test_type_is_told_from_texts_that_are_not_put_in_order(spark):
    from cladeworks.operators import alignments as al

    rows = spark.createDataFrame([(2, "x", "ACGTE"), (1, "y", "AC GT" * 3), (0, "z", None), (1, "a", "--")], "ordinal long, seq_name string, sequence string")
    assert [r.seq_type for r in al.detect_type(rows, 16).collect()] == ["nuc"]
    assert [r.seq_type for r in al.detect_type(rows, 17).collect()] == ["aa"]
    assert al.detect_type(rows.where("ordinal = 0"), 17).collect() == []
    plan = al.detect_type(rows, 17)._jdf.queryExecution().executedPlan().toString()
    assert all("_s#" not in line.split("output=")[-1] for line in plan.splitlines() if "TakeOrderedAndProject" in line)


def test_means_at_a_bound_do_not_depend_on_the_order(spark):
    from cladeworks.operators import summaries

    rng, values = random.Random(1), [0.14, 0.66] * 12 + [0.02, 0.78] * 3 + [0.4] * 2
    rows = []
    for k in range(40):
        rng.shuffle(values)
        rows += [(k, x) for x in values]
    # means are 0.4 exactly; as doubles some orders sum to less
    few = sum(functools.reduce(operator.add, [x for b, x in rows if b == k]) / len(values) < 0.4 for k in range(40))
    assert few > 0
    got = summaries.support_overall(spark.createDataFrame(rows, "branch_id int, value double").coalesce(1), 0.7, 0.4).first()
    assert (got["branches"], got["low"], got["high"], got["mean"], got["min"], got["max"]) == (40, 0, 0, 0.4, 0.4, 0.4)
    odd = spark.createDataFrame([(1, float("inf")), (1, 1.0), (2, None), (3, 2e9), (4, 0.5)], "branch_id int, value double")
    got = {r.branch_id: r.m for r in odd.groupBy("branch_id").agg(summaries.exact_mean(F.col("value")).alias("m")).collect()}
    assert got == {1: float("inf"), 2: None, 3: 2e9, 4: 0.5}


def test_profiles_align_alike_however_much_is_held(monkeypatch):
    from cladeworks.functions import profiles as pf

    rng = random.Random(2)
    a, b = (pf.one_row("".join(rng.choices("ACGT", k=k)), False) for k in (90, 70))
    whole = pf.align_profiles(a, b, 1, 1)
    monkeypatch.setattr(pf, "HELD", 0)
    parts = pf.align_profiles(a, b, 1, 1)
    assert all((x == y).all() for x, y in zip(whole[:2], parts[:2], strict=True)) and whole[2] == parts[2]


def test_means_of_the_support_report_are_summed_in_the_order_of_its_table(spark, tmp_path):
    """As its SQL on one thread gives, however rows are dealt."""
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    import __spark_entry__

    rng, keys, quantities, values = random.Random(2), [], [], [7.0, 33.0] * 12 + [1.0, 39.0] * 3 + [20.0] * 2
    for k in range(40):
        rng.shuffle(values)
        keys += [k] * len(values)
        quantities += values
    pq.write_table(pa.table({"l_partkey": keys, "l_quantity": quantities}), tmp_path / "lineitem.parquet", row_group_size=100)
    con = duckdb.connect()
    con.execute("set threads = 1")
    con.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet'")
    want = con.execute(__spark_entry__.oracle_sql()["rpt_astral_support"]).fetchone()
    got = __spark_entry__.queries()["rpt_astral_support"](spark, str(tmp_path)).first()
    assert tuple(got) == want and got["low"] > 0
