"""Local alignment and search against plain tables of all cells, and planted hits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeworks.functions import local, scalars
from cladeworks.functions.local import NUCLEOTIDE, PROTEIN
from cladeworks.operators import search


def plain_score(a, b, s):
    """Smith and Waterman's score with affine gaps, a cell at a time."""
    h, f, best = [0] * (len(b) + 1), [-(10**6)] * (len(b) + 1), 0
    for x in a:
        diagonal, e, h[0] = h[0], -(10**6), 0
        for j, y in enumerate(b, 1):
            e = max(e - s.extending, h[j - 1] - s.opening - s.extending)
            f[j] = max(f[j] - s.extending, h[j] - s.opening - s.extending)
            diagonal, h[j] = h[j], max(0, diagonal + int(s.matrix[x, y]), e, f[j])
            best = max(best, h[j])
    return best


def mutated(r, text, letters, rate):
    out = []
    for c in text:
        x = r.random()
        out.append(r.choice(letters) if x < rate else "" if x < rate * 1.2 else c + r.choice(letters) if x < rate * 1.4 else c)
    return "".join(out)


@pytest.mark.parametrize("scoring", [NUCLEOTIDE, PROTEIN])
def test_scores_against_all_cells(scoring):
    r = random.Random(4)
    jobs = []
    for _ in range(60):
        a = "".join(r.choice(scoring.letters) for _ in range(r.randint(1, 60)))
        b = mutated(r, a, scoring.letters, 0.15) if r.random() < 0.7 else "".join(r.choice(scoring.letters) for _ in range(r.randint(1, 60)))
        a, b = scoring.codes(a + "x" * r.randint(0, 2)), scoring.codes("".join(r.choice(scoring.letters) for _ in range(r.randint(0, 20))) + b)
        jobs.append((a, b, -len(a), len(b)))
    for (a, b, *_), row in zip(jobs, local.align(jobs, scoring).tolist(), strict=True):
        score, qs, qe, ts, te, same, columns, wrong, gaps = row
        assert score == plain_score(a, b, scoring)
        if score:
            # the parts named are themselves that good, and the counts add up
            assert plain_score(a[qs - 1 : qe], b[ts - 1 : te], scoring) == score
            letters_in_gaps = 2 * columns - (qe - qs + 1) - (te - ts + 1)
            assert columns == same + wrong + letters_in_gaps and (gaps == 0) == (letters_in_gaps == 0)


def test_alignment_grows_around_its_segment():
    """Long alignments come out whole, whichever part of them the segment was."""
    r = random.Random(12)
    for rate in (0.02, 0.1):
        a = "".join(r.choices("ACGT", k=900))
        b = NUCLEOTIDE.codes("".join(r.choices("ACGT", k=50)) + mutated(r, a, "ACGT", rate))
        a = NUCLEOTIDE.codes("".join(r.choices("ACGT", k=300)) + a)
        whole = local.align([(a, b, -300, -200)], NUCLEOTIDE)
        assert (local.align_around([(a, b, -300, -200, k, k + 5) for k in (320, 700, 1150)], NUCLEOTIDE) == whole).all()


def test_segments_and_strands():
    a, b = NUCLEOTIDE.codes("TTTTACGTACGTAACC"), NUCLEOTIDE.codes("ACGTACGTAAGG")
    assert local.segment(a, b, -4, NUCLEOTIDE) == (20, 4, 14)
    assert local.segment(a, b, -40, NUCLEOTIDE) == (0, 0, 0)
    assert local.opposite(NUCLEOTIDE.codes("AACGN")).tolist() == NUCLEOTIDE.codes("NCGTT").tolist()
    long = "".join(random.Random(1).choices("ACGT", k=300))
    one, two = local.seeds_of(NUCLEOTIDE.codes(long), NUCLEOTIDE), local.seeds_of(local.opposite(NUCLEOTIDE.codes(long)), NUCLEOTIDE)
    assert sorted(one[0]) == sorted(two[0]) and 300 / 5 < len(one[0]) < 180
    for k in (0, 12, 13):
        assert all(len(x) == (1 if k == 13 else 0) for x in local.seeds_of(NUCLEOTIDE.codes("ACGTTGCATGCAT"[:k]), NUCLEOTIDE))
    assert len(local.seeds_of(NUCLEOTIDE.codes("ACGTA" * 2000), NUCLEOTIDE)[0]) <= 10


def test_all_by_all_against_all_pairs(spark):
    """Every pair whose best alignment is beyond chance is found, with its score; places and strands fit."""
    r = random.Random(8)
    letters = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    turned = lambda t: t[::-1].translate(str.maketrans("ACGT", "TGCA"))
    bases, texts = [letters(150) for _ in range(4)], {}
    for i in range(24):
        t = mutated(r, r.choice(bases), "ACGT", 0.05)
        t = letters(r.randint(0, 40)) + t[r.randint(0, 40) :] + letters(r.randint(0, 40))
        texts[f"s{i:02d}"] = turned(t) if i % 3 == 0 else t
    texts |= {"copy1": texts["s05"], "copy2": texts["s05"], "none": "", "short": "ACGT", "odd": "NNNN" + bases[0][:60] + "éé"}
    frame = spark.createDataFrame([*texts.items(), ("null", None)], "seq_id string, sequence string")
    found = {(h.query, h.target, h.qframe): h for h in search.all_by_all(frame).collect()}
    assert len(found) == search.all_by_all(frame).count()
    codes, total = {k: NUCLEOTIDE.codes(t) for k, t in texts.items()}, sum(map(len, texts.values()))
    wanted = equal = 0
    for q in texts:
        for t in texts:
            for strand in (1, -1):
                a = codes[q] if strand == 1 else local.opposite(codes[q])
                hit = found.get((q, t, strand))
                if q == t:
                    assert hit is None
                    continue
                score = int(local.align([(a, codes[t], -len(a), len(codes[t]))], NUCLEOTIDE)[0, 0]) if len(a) and len(codes[t]) else 0
                if score >= 60:
                    wanted += 1
                    equal += hit is not None and abs(hit.bits - NUCLEOTIDE.bits(score)) < 1e-9
                if hit is not None:
                    assert hit.evalue == pytest.approx(float(NUCLEOTIDE.evalue(round((hit.bits * np.log(2) + np.log(0.41)) / 0.625), len(a), total)))
                    part = texts[q][min(hit.qstart, hit.qend) - 1 : max(hit.qstart, hit.qend)]
                    part = turned(part) if strand == -1 else part
                    other = texts[t][hit.tstart - 1 : hit.tend]
                    assert (hit.qstart > hit.qend) == (strand == -1)
                    assert plain_score(NUCLEOTIDE.codes(part), NUCLEOTIDE.codes(other), NUCLEOTIDE) == round((hit.bits * np.log(2) + np.log(0.41)) / 0.625)
    assert wanted > 150 and equal >= 0.95 * wanted
    assert found["copy1", "copy2", 1].pident == 100.0 and found["copy1", "copy2", 1].evalue < 1e-50


def test_targets_are_cut_after_scoring(spark):
    r = random.Random(2)
    base = "".join(r.choice("ACGT") for _ in range(200))
    texts = {"q": base, "near": mutated(r, base, "ACGT", 0.02), **{f"far{i:02d}": mutated(r, base[:60], "ACGT", 0.1) for i in range(12)}}
    frame = spark.createDataFrame(list(texts.items()), "seq_id string, sequence string")
    best = [h.target for h in search.all_by_all(frame, targets=3).where("query = 'q'").orderBy(F.desc("bits")).collect()]
    assert len(best) == 3 and best[0] == "near"
    assert search.all_by_all(frame.limit(0)).count() == 0


def test_search_recall_of_planted_proteins(spark):
    r = random.Random(3)
    letters = lambda n: "".join(r.choice(PROTEIN.letters) for _ in range(n))
    targets = {f"t{i:02d}": letters(120) for i in range(30)}
    queries = {f"q{i:02d}": letters(r.randint(0, 50)) + mutated(r, targets[f"t{i:02d}"], PROTEIN.letters, 0.25) + letters(30) for i in range(30)} | {"none": letters(200)}
    side = lambda x: spark.createDataFrame(list(x.items()), "seq_id string, sequence string")
    found = {(h.query, h.target): h for h in search.search(side(queries), side(targets), evalue=1e-3).collect()}
    assert sum(("q" + t[1:], t) in found for t in targets) >= 27
    assert all(q[1:] == t[1:] for q, t in found)
    for (q, t), h in found.items():
        a, b = PROTEIN.codes(queries[q]), PROTEIN.codes(targets[t])
        assert round((h.bits * np.log(2) + np.log(0.041)) / 0.267) <= plain_score(a, b, PROTEIN)


def test_hot_words_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(search, "HOT", 3)
    r = random.Random(5)
    base = "".join(r.choice("ACGT") for _ in range(60))
    texts = {f"s{i:02d}": base + "".join(r.choice("ACGT") for _ in range(10)) for i in range(20)}
    frame = spark.createDataFrame(list(texts.items()), "seq_id string, sequence string")
    assert search.all_by_all(frame).where("qframe = 1").count() == 20 * 19


def test_busco_search_finds_the_frame(spark):
    r = random.Random(6)
    codons = [a + b + c for a in "ACGT" for b in "ACGT" for c in "ACGT" if a + b + c not in ("TAA", "TAG", "TGA")]
    gene = "".join(r.choice(codons) for _ in range(60))
    back = gene[::-1].translate(str.maketrans("ACGT", "TGCA"))
    contigs = spark.createDataFrame([("c1", "TT" + gene), ("c2", "ACAC" * 60), ("c3", back + "G"), ("c4", None), ("c5", "")], "seq_id string, sequence string")
    proteins = contigs.limit(1).select(F.lit("p").alias("seq_id"), scalars.translated(F.lit(gene)).alias("sequence"))
    found = search.busco_search(contigs, proteins).collect()
    assert sorted((h.query, h.target, h.qframe, h.pident) for h in found) == [("c1", "p", 3, 100.0), ("c3", "p", -2, 100.0)]
