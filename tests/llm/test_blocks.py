"""Blocks of the near-copies join hold texts that may link, not all that share an element by chance."""

import numpy as np
import pytest

from cladeworks.llm import ngramjoin as nj


def _links(p, q, a, b):
    same = len(np.intersect1d(p, q))
    return same * b >= a * (len(p) + len(q) - same)


@pytest.mark.parametrize("a,b", [(9, 10), (4, 5)])
def test_sketches_never_part_a_linked_pair(a, b):
    rng = np.random.default_rng(5)
    linked = 0
    for _ in range(600):
        p = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 400)).astype(np.uint64))
        gone = rng.random(len(p)) < rng.choice([0.01, 0.05, 0.1])
        q = np.unique(np.concatenate([p[~gone], rng.integers(0, 1 << 63, rng.integers(0, 1 + len(p) // 20)).astype(np.uint64)]))
        apart = nj.least_apart(nj.sketch_of(p)[None], nj.sketch_of(q)[None])[0]
        assert apart <= len(np.setxor1d(p, q))
        if len(q) and _links(p, q, a, b):
            linked += 1
            rows = sorted([(len(p), 1, nj.sketch_of(p)), (len(q), 2, nj.sketch_of(q))], key=lambda x: x[:2])
            n, key, sketches = (np.array([x[c] for x in rows]) for c in range(3))
            kept, block = nj.may_link(np.full(2, 7), np.zeros(2, int), key, n, sketches, a, b)
            assert kept.tolist() == [0, 1] and block[0] == block[1]
    assert linked > 100


def test_rows_of_an_element_are_parted_by_size_and_counted_once():
    sketch = np.zeros((6, 2), np.uint64)
    element, salt = np.array([3, 3, 3, 3, 3, 8]), np.zeros(6, int)
    # one text twice, one near it, two far larger ones, and another element's only text
    kept, block = nj.may_link(element, salt, np.array([1, 1, 2, 3, 4, 5]), np.array([10, 10, 11, 90, 95, 10]), sketch, 9, 10)
    assert kept.tolist() == [0, 2, 3, 4] and block[0] == block[1] != block[2] == block[3]
    # texts of one size run whose neighbours' neighbours are too far apart in size
    kept, _ = nj.may_link(np.full(4, 3), np.zeros(4, int), np.array([1, 2, 3, 4]), np.array([90, 95, 101, 108]), np.zeros((4, 2), np.uint64), 9, 10)
    assert kept.tolist() == [0, 1, 2, 3]
    # of an element with salts all stay together
    kept, block = nj.may_link(element[:3], np.array([1, 1, 2]), np.array([1, 2, 3]), np.array([10, 90, 10]), sketch[:3], 9, 10)
    assert kept.tolist() == [0, 1, 2] and len(set(block.tolist())) == 1


def test_an_element_shared_by_chance_makes_no_block(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 12, 60))) for i in range(300)]
    words = rows[0][1].split()
    rows += [(1000, " ".join([*words[:-1], "other"])), (1001, " ".join(words[:-2] + words[-1:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    members, kept = [], nj.written

    def count(df, what, *rest, **names):
        out = kept(df, what, *rest, **names)
        if what == "shingle-members":
            members.append({r[0] for r in out.select("doc_id").distinct().collect()})
        return out

    monkeypatch.setattr(nj, "written", count)
    found = {r.doc_id: r.component_id for r in nj.classes(docs, 3, 9, 10).collect()}
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for i, t in rows}
    for i, own in sets.items():
        linked = [j for j, other in sets.items() if 10 * len(own & other) >= 9 * len(own | other)]
        assert found[i] == min(linked)
    assert members == [{0, 1000, 1001}]
