"""Readers, scalars, graphs, trees and searches on small cases and against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from cladeworks.functions import scalars, udfs
from cladeworks.functions import trees as tr
from cladeworks.operators import graphs, kernels, species, summaries
from cladeworks.sources import readers, writers


def test_deep_chain_and_circle(spark):
    parents = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(102)], "id string, parent string")
    leaves = spark.createDataFrame([("n0", "a")], "leaf string, taxon string")
    assert {r.node: (r.tips, r.taxa) for r in summaries.clade_tips(parents, leaves).collect()} == {f"n{i}": (1, 1) for i in range(103)}
    with pytest.raises(ValueError, match="circle"):
        summaries.clade_tips(spark.createDataFrame([("a", "b"), ("b", "a")], "id string, parent string"), leaves)


def test_representatives_in_circles_and_twice(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "a"), ("m", "x"), ("m", "y"), ("s", "s")], "query string, target string")
    assert sorted((r.seq_id, r.cluster) for r in graphs.combine_results(df).collect()) == [("a", "a"), ("b", "a"), ("m", "x"), ("s", "s"), ("x", "x"), ("y", "x")]


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(300)] + [("hub", f"z{i}") for i in range(50)] + [("one", "one")]
    found = {r.node: r.component for r in graphs.components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert found == {**{f"p{i:03d}": "p000" for i in range(301)}, "hub": "hub", **{f"z{i}": "hub" for i in range(50)}, "one": "one"}


def test_clusters_are_numbered_over_ranges(spark):
    rows = [(f"c{i:04d}", f"s{j}") for i in range(300) for j in range(1 + i % 3)]
    found = graphs.cluster_number(spark.createDataFrame(rows, "cluster string, seq_id string")).collect()
    expected = sorted((-(1 + i % 3), f"c{i:04d}") for i in range(300))
    assert [(r.number, r.cluster, r.cluster_id) for r in sorted(found, key=lambda r: r.number)] == [(k, c, f"{k:06d}") for k, (_, c) in enumerate(expected, 1)]


def test_text_formats(spark):
    df = spark.createDataFrame([(512, 59.94, "x" * 80), (1536, 60.0, "y" * 81), (5 << 40, 3661.5, "z"), (1 << 20, 7200.0, ""), (0, 7260.0, None)], "n long, s double, t string")
    rows = df.select(scalars.format_bytes(F.col("n")), scalars.format_duration(F.col("s")), scalars.shortened(F.col("t")), scalars.format_number(F.col("n"))).collect()
    assert [r[0] for r in rows] == ["512 B", "1.5 KB", "5.0 TB", "1.0 MB", "0 B"] and [r[1] for r in rows] == ["59.9s", "1m", "1h 1m 1.5s", "2h", "2h 1m"]
    assert [r[2] for r in rows] == ["x" * 80, "..." + "y" * 77, "z", "", None] and rows[2][3] == "5,497,558,138,880"


def test_six_frames(spark):
    row = spark.createDataFrame([("ATGGCCTAAn",), ("",)], "s string").select(scalars.six_frames(F.col("s")).alias("f")).collect()
    assert {x.frame: x.protein for x in row[0].f} == {1: "MA*", 2: "WPX", 3: "GL", -1: "XRP", -2: "LGH", -3: "*A"}
    assert all(x.protein == "" for x in row[1].f)


def test_reports_with_exponents(spark):
    text = "Total tree length (sum of branch lengths): 1.2e-05\nAkaike information criterion (AIC) score: -31.5\nBayesian information criterion (BIC) score: 1.5E+3\nGamma shape alpha: 9.98e2\n"
    r = readers.report_fields(spark.createDataFrame([("g", text)], "gene_id string, value string")).first()
    assert (r.total_tree_length, r.AIC, r.BIC, r.gamma_alpha) == (1.2e-05, -31.5, 1500.0, 998.0)


def test_hits_of_fifteen_fields_and_malformed(spark, tmp_path):
    line = "q\t10\tt\t10\t1\t99.0\t9\t10\t0\t0\t1\t10\t1\t10\t1e-5"
    (tmp_path / "h.tsv").write_text(f"{line}\t50.0\n{line}\nq\t10\tt\n{line.replace('99.0', 'x')}\t1\n")
    assert sorted((r.bits is None, r.evalue) for r in readers.hits(spark, str(tmp_path / "h.tsv")).collect()) == [(False, 1e-5), (True, 1e-5)]
    assert readers.hit_lines(spark, str(tmp_path / "h.tsv")).where("malformed").count() == 2


def test_fastq_quality_that_begins_with_at(spark, tmp_path):
    records = [(f"r{i}", "ACGT" * (1 + i % 5), ("@" if i % 3 == 0 else "I") + "!" * (4 * (1 + i % 5) - 1)) for i in range(400)]
    (tmp_path / "r.fq").write_text("".join(f"@{n} more\n{s}\n+\n{q}\n" for n, s, q in records))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        found = sorted((r.seq_name, r.sequence, r.qual) for r in readers.fastq(spark, str(tmp_path / "r.fq")).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == sorted(records)


def test_writers(spark, tmp_path):
    trees = spark.createDataFrame([("t1", "(a,b);"), ("t2", "(c,d);")], "tree_id string, newick string")
    writers.newick(trees.coalesce(1), str(tmp_path / "n"))
    assert sorted(x for p in (tmp_path / "n").glob("part-*") for x in p.read_text().splitlines()) == ["t1\t(a,b);", "t2\t(c,d);"]
    writers.node_map(spark.createDataFrame([("N1", "b.fa"), ("N1", "a.fa")], "node string, source_file string"), str(tmp_path / "m"))
    assert [p.read_text().strip() for p in (tmp_path / "m").glob("part-*") if p.read_text()] == ['{"node":"N1","files":["a.fa","b.fa"]}']
    offsets = spark.createDataFrame([(1, 1, 4), (2, 5, 7)], "part_no int, start long, end long")
    writers.partitions(offsets, str(tmp_path / "p"))
    assert sorted(x for p in (tmp_path / "p").glob("part-*") for x in p.read_text().splitlines()) == ["DNA, p1 = 1-4", "DNA, p2 = 5-7"]
    writers.edges(spark.createDataFrame([("a", "b", 1.5)], "src string, dst string, weight double"), str(tmp_path / "e"))
    assert [p.read_text() for p in (tmp_path / "e").glob("part-*") if p.read_text()] == ["a\tb\t1.5\n"]


NAMES = [("A@1", "alpha one", "sp.a_busco.fa"), ("A@2", "alpha two", "sp.a_busco.fa"), ("B@1", "beta", "sp.b.fa"), ("C@1", "gamma", "c.fa")]


def test_gene_trees_under_other_names(spark):
    trees = spark.createDataFrame([("t", "((A_1:1,A_2:2):1,(B_1:1,C_1:3):2,D.x_9:4);"), ("few", "(A_1:1,A_2:1,B_1:1);"), ("bad", "((A_1;")], "tree_id string, newick string")
    names = spark.createDataFrame(NAMES, "new_name string, original_name string, source_file string")
    ids = spark.createDataFrame([("sp.a", "idA")], "stem string, id string")
    assert {r.tree_id: r.newick for r in species.gene_tree_export(trees, names).collect()} == {"t": "((alpha one:1,alpha two:2):1,(beta:1,gamma:3):2,D.x_9:4);", "few": "(alpha one:1,alpha two:1,beta:1);"}
    assert {r.tree_id: r.newick for r in species.gene_tree_concat(trees, names, ids).collect()} == {"t": "(idA:2,(sp_b:1,c:3):2,D:4);"}
    many = spark.createDataFrame([(f"t{i}", "((A_1,B_1),(C_1,E@4));") for i in range(3)], "tree_id string, newick string")
    root = tr.parse(species.guide_tree(many, names, ids))
    assert sorted(root.labels()) == ["E", "c", "idA", "sp_b"] and all(c.label.startswith("N") for c, _ in root.walk() if not c.tip)


def test_supermatrix_tree(spark):
    random.seed(1)
    base = {"a": "".join(random.choice("ACGT") for _ in range(300))}
    change = lambda s, n: "".join(random.choice("ACGT") if random.random() < n else c for c in s)
    base["b"], base["c"] = change(base["a"], 0.05), change(base["a"], 0.4)
    base["d"] = change(base["c"], 0.05)
    rows = [(f"g{k}", f"{t}@{k}", s[k * 100 : k * 100 + 100]) for t, s in base.items() for k in range(3)]
    df = spark.createDataFrame(rows, "aln_id string, seq_id string, row string")
    root = tr.parse(species.supermatrix_tree(df, F.split_part("seq_id", F.lit("@"), F.lit(1)), replicates=5))
    inner = [set(c.labels()) for c, p in root.walk() if p is not None and not c.tip]
    assert {"a", "b"} in inner or {"c", "d"} in inner
    assert all(c.label == "100" for c, p in root.walk() if p is not None and not c.tip)


def test_tree_pieces_and_order():
    assert tr.text(tr.opened(tr.parse("((a:1,b:2)x:3,c:4);"))) == "(c:4,a:1,b:2);" and tr.text(tr.opened(tr.parse("(a:1,b:2);"))) == "(a:1,b:2);"
    assert tr.text(tr.ordered(tr.parse("((d,c,b),a,(f,e));"))) == "(a:0,(e:0,f:0):0,(b:0,c:0,d:0):0);"
    found = tr.ingroup_pieces(tr.parse("(((A_1,B_1),(C_1,D_1)),(O_1,(E_1,F_1)));"), set("ABCDEF"), {"O"}, 3)
    assert [sorted(p.labels()) for p in found] == [["A_1", "B_1", "C_1", "D_1", "E_1", "F_1"]]
    found = tr.ingroup_pieces(tr.parse("(((A_1,B_1),(C_1,O_3)),(O_1,(E_1,(F_1,O_2))));"), set("ABCEF"), {"O"}, 2)
    assert [sorted(p.labels()) for p in found] == [["A_1", "B_1"]]
    assert tr.outline(tr.parse("((b,a)x,c)r;")) == "Node: r\n  └─ a, b, c\n\n  Node: x\n    └─ a, b\n"


def test_session_functions(spark):
    assert "tree_trim" in udfs.register(spark)
    r = spark.sql("select tree_tips('(A_1,B_1,A_2);') as n, tree_taxa('(A_1,B_1,A_2);') as t, tree_tips('((') as bad, tree_ordered('((b,a),c);') as o").first()
    assert (r.n, r.t, r.bad, r.o) == (3, 2, None, "(c:0,(a:0,b:0):0);")


def test_kmer_hits_against_brute_force(spark):
    random.seed(7)
    letters = lambda n: "".join(random.choice("ACGT") for _ in range(n))
    bases = [letters(60) for _ in range(4)]
    texts = {f"s{i:02d}": (random.choice(bases)[random.randint(0, 30) :] + letters(random.randint(0, 20))) for i in range(40)}
    texts |= {f"e{i}": bases[0] for i in range(6)} | {"short": "ACG"}
    words = {n: {t[i : i + 6] for i in range(len(t) - 5)} for n, t in texts.items()}
    expected = set()
    for q in texts:
        best = sorted((-len(words[q] & words[t]), t) for t in texts if t != q and len(words[q] & words[t]) >= 3)[:5]
        expected |= {(q, t, -n) for n, t in best}
    df = spark.createDataFrame(list(texts.items()), "seq_id string, sequence string")
    assert {tuple(r) for r in kernels.kmer_hits(df, 6, 3, 5).collect()} == expected


def test_set_cover_against_one_at_a_time(spark):
    random.seed(9)
    pairs = {tuple(sorted(random.sample(range(40), 2))) for _ in range(70)} | {(50, 50)}
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    free, expected = set(near), {}
    while free:
        best = min(free, key=lambda n: (-len((near[n] & free) - {n}), n))
        for n in (near[best] & free) | {best}:
            expected[n] = best
        free -= set(expected)
    df = spark.createDataFrame([(a, b) for a, b in pairs], "query long, target long")
    assert {r.seq_id: r.cluster for r in kernels.set_cover(df).collect()} == expected


@pytest.mark.parametrize("most", [256, 60, 0])
def test_centroids_on_either_side_of_the_switch(spark, monkeypatch, most):
    """Nodes in one go and by words alike; equal texts, an empty one, a missing one, and no words to shuffle for small nodes."""
    from cladeworks.functions import phylogeny as ph

    random.seed(5)
    base = ["".join(random.choice("ACGT") for _ in range(k)) for k in (40, 41, 60)]
    rows = [(f"n{k % 3}", f"s{k:03d}", base[k % 2] + "A" * (k % 7) if k % 5 else base[2]) for k in range(90)]
    rows += [("n0", "s900", ""), ("n0", "s901", ""), ("n1", "s902", None), ("n9", "s903", "ACGT")] + [("n1", f"t{k}", f"{base[2]}{'C' * k}") for k in range(40)]
    frame = spark.createDataFrame(rows, "node string, seq_id string, sequence string")
    expected = {}
    for node in {r[0] for r in rows}:
        own = sorted((-len(t), n, t) for x, n, t in rows if x == node and t is not None)
        firsts, target = [], {}
        for _, name, text in own:
            near = [c for c, other in firsts if ph.edit_distances(text, [other])[0] <= 0.1 * len(text) + 1e-9]
            target.setdefault(text, near[0] if near else name)
            firsts += [] if near else [(name, text)]
            expected[node, name] = target[text]
    if most == 256:
        monkeypatch.setattr(kernels, "_grams", None)
    monkeypatch.setattr(kernels, "NODE", most)
    assert {(r.node, r.query): r.target for r in kernels.centroids(frame, 0.9).collect()} == expected


def test_centroids_against_one_at_a_time(spark):
    from cladeworks.functions import phylogeny as ph

    random.seed(11)
    letters = lambda n: "".join(random.choice("ACGT") for _ in range(n))
    texts = {"x1": letters(50), "low1": "A" * 40, "low2": "A" * 38, "tiny1": "AC", "tiny2": "AC", "tiny3": "AG"}
    for k in range(110):
        t = list(texts[random.choice(sorted(texts))]) if random.random() < 0.7 else list(letters(random.randint(5, 80)))
        for _ in range(random.randint(0, max(1, len(t) // 11))):
            if t:
                t[random.randrange(len(t))] = random.choice(["", "A", "CC", "G"])
        texts[f"s{k:03d}"] = "".join(t) or "A"
    rows = [(node, f"{node}{n}", t) for node in "ab" for n, t in texts.items() if node == "a" or n < "s050"]
    found = kernels.centroids(spark.createDataFrame(rows, "node string, seq_id string, sequence string"), 0.9).collect()
    for node in "ab":
        own = {n: t for x, n, t in rows if x == node}
        assert {r.query: r.target for r in found if r.node == node} == ph.greedy_centroids(own, 0.9)
