"""Profile alignment against a plain table, and families against planted homologies and the star alignment."""

import random

import numpy as np
import pytest

from cladeworks.functions import phylogeny as ph
from cladeworks.functions import profiles as pf
from cladeworks.operators import progressive


def plain_score(a, b, na, nb):
    """Best global score of two profiles, a cell at a time."""
    never = -1e9
    left, right = a / na, b / nb
    fa, fb = left.sum(1), right.sum(1)
    n, m = len(a), len(b)
    h, e, f = (np.full((n + 1, m + 1), never) for _ in range(3))
    h[0, 0] = 0
    for i in range(n + 1):
        for j in range(m + 1):
            if i:
                f[i, j] = max(h[i - 1, j] - pf.OPENING * fa[i - 1], f[i - 1, j]) - pf.EXTENDING * fa[i - 1]
            if j:
                e[i, j] = max(h[i, j - 1] - pf.OPENING * fb[j - 1], e[i, j - 1]) - pf.EXTENDING * fb[j - 1]
            if i and j:
                h[i, j] = h[i - 1, j - 1] + left[i - 1] @ pf.BASES @ right[j - 1]
            h[i, j] = max(h[i, j], e[i, j], f[i, j])
    return h[n, m]


def score_of(a, b, na, nb, at_a, at_b, width):
    left, right, total, last = a / na, b / nb, 0.0, ""
    where_a, where_b = {int(c): i for i, c in enumerate(at_a)}, {int(c): j for j, c in enumerate(at_b)}
    for c in range(width):
        i, j = where_a.get(c), where_b.get(c)
        if i is not None and j is not None:
            total, last = total + left[i] @ pf.BASES @ right[j], ""
        else:
            filled = left[i].sum() if j is None else right[j].sum()
            kind = "a" if j is None else "b"
            total, last = total - filled * (pf.EXTENDING + (pf.OPENING if kind != last else 0)), kind
    return total


def test_profiles_against_all_cells():
    r = np.random.default_rng(2)
    for _ in range(60):
        na, nb = r.integers(1, 4, 2)
        a, b = (np.array([[r.multinomial(k, [0.25] * 4)] for k in r.integers(1, n + 1, r.integers(1, 25))])[:, 0].astype(float) for n in (na, nb))
        found = pf.align_profiles(a, b, na, nb)
        assert score_of(a, b, na, nb, *found) == pytest.approx(plain_score(a, b, na, nb), abs=1e-3)
    for a, b in ((0, 3), (3, 0), (0, 0)):
        at_a, at_b, width = pf.align_profiles(np.ones((a, 4)), np.ones((b, 4)), 4, 4)
        assert (len(at_a), len(at_b), width) == (a, b, a + b)


def test_insertions_are_not_aligned_again():
    base = pf.one_row("ACGTTGCAACGTTGCA", False)
    long = pf.one_row("ACGTTGCATTTTTACGTTGCA", False)
    at_a, at_b, width = pf.align_profiles(base, long, 1, 1)
    both, marks = pf.joined(base, long, at_a, at_b, width, np.zeros(16, np.int8), np.zeros(21, np.int8))
    assert width == 21 and marks.sum() == 5
    at, own, wide = pf.align_profiles(both, base, 2, 1, marks, np.zeros(16, np.int8))
    again, twice = pf.joined(both, base, at, own, wide, marks, np.zeros(16, np.int8))
    assert wide == 21 and (twice == 2).sum() == 5
    # a later sequence's own insertion in that place gets columns of its own
    other = pf.one_row("ACGTTGCATTTTTACGTTGCA", False)
    assert pf.align_profiles(again, other, 3, 1, twice, np.zeros(21, np.int8))[2] == 26
    assert pf.align_profiles(again, other, 3, 1)[2] == 21


def planted(r, rows, length):
    """Sequences that come from one another by changes, losses and insertions along a chain of ancestors; the identity of each letter."""
    count = [length]
    ancestor = [(r.choice("ACGT"), k) for k in range(length)]
    out = []
    for k in range(rows):
        own = []
        for c, i in ancestor if k % 3 else list(ancestor):
            x = r.random()
            if x < 0.03:
                continue
            own.append((r.choice("ACGT") if x < 0.13 else c, i))
            if x > 0.985:
                for _ in range(r.randint(1, 6)):
                    own.append((r.choice("ACGT"), count[0]))
                    count[0] += 1
        if k % 3 == 0:
            ancestor = own
        out.append(own)
    return out


def share_found(truth, rows):
    """The share of pairs of letters of one origin that stand in one column."""
    columns = []
    for own, row in zip(truth, rows, strict=True):
        places = [i for i, c in enumerate(row) if c != "-"]
        assert [row[i] for i in places] == [c for c, _ in own]
        columns.append({i: p for (_, i), p in zip(own, places, strict=True)})
    good = total = 0
    for i in range(len(columns)):
        for j in range(i):
            for k in columns[i].keys() & columns[j].keys():
                total += 1
                good += columns[i][k] == columns[j][k]
    return good / total


def test_planted_homologies_against_the_star(spark):
    r = random.Random(11)
    truth = {f"f{k}": planted(r, 12, 150) for k in range(6)}
    data = [(f, f"s{i:02d}", "".join(c for c, _ in own)) for f, rows in truth.items() for i, own in enumerate(rows)]
    frame = spark.createDataFrame(data, "aln_id string, seq_id string, sequence string")
    shares = {}
    for name, found in (("plain", progressive.aligned(frame)), ("insertions", progressive.aligned(frame, insertions=True))):
        rows = {(x.aln_id, x.seq_id): x.row for x in found.collect()}
        assert len(rows) == len(data)
        assert all(len({len(rows[f, f"s{i:02d}"]) for i in range(12)}) == 1 for f in truth)
        shares[name] = np.mean([share_found(own, [rows[f, f"s{i:02d}"] for i in range(12)]) for f, own in truth.items()])
    star = np.mean([share_found(own, [x for _, x in sorted(ph.align_star({f"s{i:02d}": "".join(c for c, _ in o) for i, o in enumerate(own)}).items())]) for own in truth.values()])
    assert shares["plain"] > star and shares["insertions"] > star and max(shares.values()) > 0.85


def test_guides_and_edges(spark):
    rows = [("a", "x@1", "ACGTACGTTT"), ("a", "y@1", "ACGTACGTT"), ("a", "z@1", "ACGACGTTT"), ("b", "only", "AC"), ("c", "n", None), ("c", "e", ""), ("c", "w", "ACé"), ("d", "same", "AAC"), ("d", "same", "AAC")]
    frame = spark.createDataFrame(rows, "aln_id string, seq_id string, sequence string")
    trees = spark.createDataFrame([("a", "((z_1,x_1),y_1);"), ("b", "(("), ("c", "(w,e);")], "aln_id string, newick string")
    for found in (progressive.aligned(frame), progressive.aligned(frame, insertions=True, trees=trees)):
        got = sorted((x.aln_id, x.seq_id, x.row) for x in found.collect())
        assert [(f, s, row.replace("-", "")) for f, s, row in got] == sorted((f, s, t or "") for f, s, t in rows)
        assert got[:3] == [("a", "x@1", "ACGTACGTTT"), ("a", "y@1", got[1][2]), ("a", "z@1", "ACG-ACGTTT")] and len(got[1][2]) == 10
        assert [r for r in got if r[0] == "c"] == [("c", "e", "---"), ("c", "n", "---"), ("c", "w", "ACé")]
    assert progressive.aligned(frame.limit(0)).count() == 0


@pytest.mark.parametrize("protein", [False, True])
def test_pairs_made_together_are_those_made_alone(monkeypatch, protein):
    rng = np.random.default_rng(7)
    size = 20 if protein else 4

    def profile(n):
        rows = int(rng.integers(1, 5))
        return np.eye(size + 1)[rng.integers(0, size + 1, (rows, n))].sum(0)[:, :size].astype(np.float32), rows, rng.integers(0, 3, n).astype(np.int8)

    jobs = []
    for n, m in [(0, 0), (0, 7), (9, 0), (1, 1), (300, 20), (20, 300), *rng.integers(1, 120, (40, 2))]:
        (a, na, ma), (b, nb, mb) = profile(n), profile(m)
        jobs.append((a, b, na, nb, ma, mb))
    jobs += [(a, b, na, nb, np.zeros(len(a), np.int8), np.zeros(len(b), np.int8)) for a, b, na, nb, *_ in jobs]
    alone = [pf.align_profiles(*x) for x in jobs]
    calls = []
    together = pf._together
    monkeypatch.setattr(pf, "_together", lambda own: calls.append(len(own)) or together(own))
    for held in (pf.HELD, 5000):  # tables of more cells are made alone
        monkeypatch.setattr(pf, "HELD", held)
        found = pf.align_many(jobs)
        assert all(x[2] == y[2] and (x[0] == y[0]).all() and (x[1] == y[1]).all() for x, y in zip(found, alone, strict=True))
    assert max(calls) > 5 and sum(calls) < 2 * len(jobs)
