import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from cladeworks.functions import phylogeny as ph
from cladeworks.operators import alignments, graphs, hits, kernels, names, summaries
from cladeworks.plans import queries
from cladeworks.sources import readers, writers

SF = "/root/testdata/sf0.001"
HIT = "query string, qlen double, target string, tlen double, pident double, qstart double, qend double, tstart double, tend double, evalue double"


def test_hit_merge(spark):
    rows = [("A@1", 100.0, "B@1", 100.0, 90.0, 1.0, 40.0, 1.0, 40.0, 1e-20), ("A@1", 100.0, "B@1", 100.0, 90.0, 61.0, 90.0, 61.0, 90.0, 1e-10), ("A@1", 100.0, "C@1", 100.0, 90.0, 1.0, 20.0, 1.0, 20.0, 1e-6), ("A@1", 100.0, "A@1", 100.0, 100.0, 1.0, 100.0, 1.0, 100.0, 0.0), ("B@1", 100.0, "A@1", 100.0, 90.0, 1.0, 100.0, 1.0, 100.0, 0.0)]
    found = hits.edges(spark.createDataFrame(rows, HIT)).collect()
    assert {(r.src, r.dst, round(r.weight, 6)) for r in found} == {("A@1", "B@1", 20.0), ("B@1", "A@1", 180.0)}


def test_minus_log_evalue(spark):
    df = spark.createDataFrame([("0",), ("-1",), ("x",), ("1",), ("10",), ("1e-5",), (None,)], "e string")
    assert [round(r.w, 6) for r in df.select(hits.minus_log_evalue(F.col("e")).alias("w")).collect()] == [180.0, 180.0, 180.0, 0.01, 0.01, 5.0, 180.0]


def test_best_per_species(spark):
    rows = [("A@1", 300.0, "B@1", 300.0, 95.0, 1.0, 2.0, 1.0, 2.0, 0.1), ("A@1", 300.0, "B@2", 400.0, 95.0, 1.0, 2.0, 1.0, 2.0, 0.1), ("A@1", 300.0, "C@1", 100.0, 80.0, 1.0, 2.0, 1.0, 2.0, 0.1)]
    df = spark.createDataFrame(rows, HIT)
    assert {r.seq_id for r in hits.best_per_species(df, 3).collect()} == {"A@1", "B@2", "C@1"}
    assert hits.best_per_species(df, 4).count() == 0


def test_branch_stats(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", 0.3), ("b", 0.5)], "branch_id string, length double")
    found = {r.branch_id: r for r in summaries.branch_stats(df).collect()}
    assert (found["a"].mean, found["a"].median, found["a"].concord, found["a"].ci_low, found["a"].ci_high) == (0.2, 0.2, 3, 0.107605, 0.292395)
    assert (found["b"].ci_low, found["b"].ci_high, found["b"].concord) == (0.0, 0.0, 1)


def test_supermatrix(spark):
    rows = [("1", "AAAAA_00000001", "ACGT"), ("1", "BBBBB_00000001", "AC-T"), ("2", "BBBBB_00000002", "GGG"), ("2", "CCCCC_00000001", "G-G")]
    df = spark.createDataFrame(rows, "aln_id string, seq_id string, row string")
    assert {r.taxon: r.row for r in alignments.supermatrix(df, F.split_part("seq_id", F.lit("_"), F.lit(1))).collect()} == {"AAAAA": "ACGT---", "BBBBB": "AC-TGGG", "CCCCC": "----G-G"}
    assert [(r.start, r.end) for r in alignments.partition_offsets(df).orderBy("part_no").collect()] == [(1, 4), (5, 7)]


def test_alignment_quality(spark):
    df = spark.createDataFrame([("x", "a", "AC-T"), ("x", "b", "A??T")], "aln_id string, seq_id string, row string")
    r = alignments.alignment_quality(df).first()
    assert (r.sequences, r.length, r.mean_gap_pct, r.max_gap_pct, r.missing_pct) == (2, 4, 37.5, 50.0, 37.5)


@pytest.mark.parametrize(("sequence", "kind"), [("ACGTN", ["nuc"]), ("ACGTE", ["aa"]), ("ACGU", ["nuc"]), ("", [])])
def test_sequence_type(spark, sequence, kind):
    df = spark.createDataFrame([(0, "s", sequence)], "ordinal long, seq_name string, sequence string")
    assert [r.seq_type for r in alignments.detect_type(df).collect()] == kind


def test_species_map(spark):
    df = spark.createDataFrame([("a.fa",), ("b.x.fa",), ("b.y.fa",)], "source_file string")
    assert {r.source_file: r.species for r in names.species_map(df).collect()} == {"a.fa": "a", "b.x.fa": "b_x", "b.y.fa": "b_y"}


def test_chains_of_representatives(spark):
    df = spark.createDataFrame([("m1", "c1"), ("m2", "c2"), ("c2", "c1")], "query string, target string")
    assert {(r.seq_id, r.cluster) for r in graphs.combine_results(df).collect()} == {(x, "c1") for x in ("m1", "m2", "c2", "c1")}


def test_markov_clusters(spark):
    edges = [("a", "b", 9.0), ("b", "c", 9.0), ("a", "c", 9.0), ("c", "d", 0.1), ("d", "e", 9.0), ("e", "f", 9.0), ("d", "f", 9.0)]
    df = spark.createDataFrame(edges, "src string, dst string, weight double")
    for largest in (5000, 2):  # dense, and as a table
        found = graphs.mcl_cluster(df, inflation=2.0, largest=largest)
        assert {r.seq_id: r.cluster for r in found.collect()} == {**dict.fromkeys("abc", "a"), **dict.fromkeys("def", "d")}


def test_fasta_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("s1", "ACGTAC"), ("s2", "GG")], "seq_id string, sequence string")
    writers.fasta(df.coalesce(1), str(tmp_path / "out"), width=4)
    (tmp_path / "in").mkdir()
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    (tmp_path / "in" / "x.fa").write_text(text + ">s1 again\nTT\r\nTT\n")
    found = readers.last_of_each(readers.fasta(spark, str(tmp_path / "in"))).collect()
    assert {(r.source_file, r.seq_name, r.sequence) for r in found} == {("x.fa", "s1", "TTTT"), ("x.fa", "s2", "GG")}


def test_fastq_and_hits(spark, tmp_path):
    (tmp_path / "r.fq").write_text("@a x\nACG\n+\n!+5\n@b\nT\n+\nI\n")
    assert [(r.seq_name, r.sequence, r.quals) for r in readers.fastq(spark, str(tmp_path / "r.fq")).orderBy("ordinal").collect()] == [("a", "ACG", [0, 10, 20]), ("b", "T", [40])]
    good = "q\tt\t99.0\t10\t0\t0\t1\t10\t1\t10\t1e-5\t50.0\n"
    (tmp_path / "h.tsv").write_text(good + "q\tt\t99\n" + good.replace("99.0", "x"))
    assert readers.hits(spark, str(tmp_path / "h.tsv"), readers.SHORT_HIT).count() == 1


def test_report_fields(spark):
    text = "Input data: 4 sequences with 120 nucleotide sites\nNumber of constant sites: 60 (= 50% of all sites)\nNumber of parsimony informative sites: 30\nLog-likelihood of the tree: -12.5 (s.e. 1)\nTotal tree length (sum of branch lengths): 0.75\n"
    r = readers.report_fields(spark.createDataFrame([("g", text), ("none", "")], "gene_id string, value string")).orderBy("gene_id").collect()
    assert (r[0].num_sequences, r[0].num_sites, r[0].log_likelihood, r[0].total_tree_length, r[0].pct_parsimony_informative) == (4, 120, -12.5, 0.75, 25.0)
    assert r[1].num_sites is None


def test_stream(spark, tmp_path):
    from cladeworks.streaming import fasta_stream, taxon_counts

    (tmp_path / "a.fa").write_text(">A@1\nACG\n>B@1\nAC\n>A@2\nA\n")
    q = taxon_counts(fasta_stream(spark, str(tmp_path))).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert {(r.taxon, r.records, r.letters) for r in spark.table("counts").collect()} == {("A", 2, 4), ("B", 1, 2)}


def test_alignment_and_tree():
    rows = ph.align_star({"a": "ACGTACGT", "b": "ACGACGT", "c": "ACGTACGTT"})
    assert len({len(r) for r in rows.values()}) == 1
    assert {k: r.replace("-", "") for k, r in rows.items()} == {"a": "ACGTACGT", "b": "ACGACGT", "c": "ACGTACGTT"}
    import numpy as np

    d = np.array([[0, 3, 7, 8], [3, 0, 8, 9], [7, 8, 0, 3], [8, 9, 3, 0]], float)  # additive
    root = ph.neighbor_joining(list("abcd"), d)
    assert frozenset("cd") in ph.clade_sets(root)
    assert list(ph.edit_distances("abc", ["abc", "ac", "", "xbcd"])) == [0, 1, 3, 2]


def test_kernels_report_errors(spark):
    df = spark.createDataFrame([("t", "((A_1,B_1);"), ("n", None), ("g", "(A_1:1,B_1:1,C_1:1,D_1:1);")], "tree_id string, newick string")
    assert {r.tree_id: r.status for r in kernels.trim_tips(df, absolute=5, relative=5).collect()} == {"t": "error", "n": "skipped", "g": "unchanged"}




@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_against_sql(spark, name):
    with duckdb.connect() as c:
        for t in "region nation customer supplier part orders lineitem events documents".split():
            c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
        r = c.execute(queries.ORACLE_SQL[name])
        columns = [x[0] for x in r.description]
        expected = [dict(zip(columns, row)) for row in r.fetchall()]
    found = [r.asDict() for r in __spark_entry__.queries()[name](spark, SF).collect()]
    key = lambda r: sorted((k, str(round(v, 5) if isinstance(v, float) else v)) for k, v in r.items())
    assert sorted(map(key, found)) == sorted(map(key, expected))


def test_library_stands_without_llm(tmp_path):
    """A copy without the corpus operators imports whole and has the other queries with their SQL."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    here = Path(__spark_entry__.__file__).parent
    shutil.copytree(here / "cladeworks", tmp_path / "cladeworks", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(here / "__spark_entry__.py", tmp_path)
    code = """
import importlib, pkgutil
import __spark_entry__, cladeworks
for m in pkgutil.walk_packages(cladeworks.__path__, "cladeworks."):
    importlib.import_module(m.name)
found = set(__spark_entry__.queries())
assert len(found) > 90 and set(__spark_entry__.oracle_sql()) <= found and not any(q.startswith("op1") or q == "pipeline" for q in found)
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, check=True, timeout=120)



def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
