"""Operators on whole inputs: nothing is cut, dropped or passed over by size."""

import random

import numpy as np

import __spark_entry__
from cladeworks.functions import phylogeny as ph
from cladeworks.plans import bridges

SF = "/root/testdata/sf0.001"


def test_families_hold_whole_texts(spark):
    whole = {r.seq_name: r.sequence for r in bridges.sequences(spark, SF).collect() if r.sequence}
    assert max(map(len, whole.values())) > 120
    assert {r.seq_id: r.sequence for r in bridges.families(spark, SF).collect()} == whole
    rows = {r.seq_id: r.row.replace("-", "") for r in __spark_entry__.queries()["align_mafft"](spark, SF).collect()}
    assert rows == whole


def test_hc_run_clusters_whole_texts(spark, monkeypatch):
    random.seed(2)
    letters = lambda n: "".join(random.choice("ACGT") for _ in range(n))
    start, end = letters(60), letters(300)
    rows = [("f", "en@1", start + end), ("f", "en@2", start + letters(300)), ("f", "en@3", start + end[:-3])]
    monkeypatch.setattr(bridges, "families", lambda spark, d: spark.createDataFrame(rows, "aln_id string, seq_id string, sequence string"))
    found = {r.seq_id: r.cluster for r in __spark_entry__.queries()["hc_run"](spark, SF).collect()}
    assert found["en@1"] == found["en@3"] != found["en@2"]


def test_long_pairs_and_centroids():
    random.seed(4)
    letters = lambda n: "".join(random.choice("ACGT") for _ in range(n))

    def score(a, b):
        row = [-2 * j for j in range(len(b) + 1)]
        for i, x in enumerate(a, 1):
            new = [-2 * i]
            for j, y in enumerate(b, 1):
                new.append(max(row[j - 1] + (2 if x == y else -1), row[j] - 2, new[-1] - 2))
            row = new
        return row[-1]

    for n, m in ((0, 5), (5, 0), (1, 1), (150, 170), (331, 200)):
        a, b = letters(n), letters(m)
        x, y = ph.align_pair(a, b)
        assert (x.replace("-", ""), y.replace("-", "")) == (a, b)
        assert sum(-2 if "-" in (p, q) else 2 if p == q else -1 for p, q in zip(x, y, strict=True)) == score(a, b)

    texts = {}
    for k in range(60):
        t = list(texts[f"s{random.randrange(k)}"]) if k and random.random() < 0.6 else list(letters(random.randint(5, 90)))
        for _ in range(len(t) // 12):
            t[random.randrange(len(t))] = random.choice(["", "A", "CC"])
        texts[f"s{k}"] = "".join(t)
    centroids, expected = [], {}
    for name in sorted(texts, key=lambda k: (-len(texts[k]), k)):
        near = ph.edit_distances(texts[name], [texts[c] for c in centroids]) <= 0.1 * len(texts[name]) + 1e-9
        expected[name] = centroids[int(np.argmax(near))] if near.any() else name
        centroids += [name] * (expected[name] == name)
    assert ph.greedy_centroids(texts, 0.9) == expected and len(centroids) < 60


def test_markov_keeps_even_cliques():
    from cladeworks.operators import graphs

    n = 3800  # (1 / n) ** 1.4 is below the prune
    assert [len(g) for g in graphs.markov_clusters(np.ones((n, n), np.float64) - np.eye(n))] == [n]


def test_markov_same_on_either_side_of_the_switch(spark):
    from cladeworks.operators import graphs

    # shares of 1 / 40 and their powers lie below a prune of 0.03: an absolute one would drop every entry
    n = 40
    even = spark.createDataFrame([(f"c{i:03d}", f"c{j:03d}", 1.0) for i in range(n) for j in range(i)], "src string, dst string, weight double")
    assert [len(g) for g in graphs.markov_clusters(np.ones((n, n)) - np.eye(n), prune=0.03)] == [n]
    assert [r.cluster for r in graphs.markov_join(even, prune=0.03).collect()] == ["c000"] * n
