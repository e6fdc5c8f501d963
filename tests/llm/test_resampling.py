"""CRC resampling against strings, PCA tiles against all pairs, fill-in-the-middle against the token pattern."""

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__
from cladeworks.llm import common, infilling, neartiles, resampling

from .test_contracts import SF

# -- 11 ---------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute_resampled(docs, target, percent=5, least=20, buckets=10_000, seed=42):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for texts, n in (([x for _, x in docs], s), (target, t)):
        for x in texts:
            for g in grams(x)[1]:
                n[bucket(g)] += 1
    a, b = float(s.sum()), float(t.sum())
    gain = [math.floor(1000 * math.log((t[k] + 1.0) * (a + buckets) / ((s[k] + 1.0) * (b + buckets)))) for k in range(buckets)]
    rows, may = [], []
    for i, x in docs:
        words, found = grams(x)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(g)] for g in found)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
        if len(words) >= least:
            may.append(rows[-1])
    may.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for rank, row in enumerate(may[: len(may) * percent // 100], 1):
        row[4] = rank
    return sorted(map(tuple, rows), key=str)


def test_resampling_on_table(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    target = [r[0] for r in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()]
    found = __spark_entry__.queries()["op11_crc_resampling"](spark, SF)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_resampled(docs, target)


def test_resampling_edges(spark):
    long = " ".join(f"w{i % 97}é" for i in range(60_000)) + " " + "x" * 300_000 + " end"
    docs = [(1, long), (2, None), (3, ""), (4, "A b-C d_e " * 9), (4, "A b-C d_e " * 9), (None, "日本 1 2 3 " * 8), (5, "one two"), (6, "Z" * 70 + " z " * 30), (7, " , ".join("abcdefghijklmnopqrstuvwxyz")), (2**40, "a b c " * 20)]
    target = ["a b c d e", None, "W1é w2é"]
    d = spark.createDataFrame([(i, x, "s", 3) for i, x in docs], "doc_id long, text string, score string, rank int").repartition(3)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    expected = brute_resampled(docs, target, percent=50, buckets=100)
    assert sorted(map(tuple, resampling.resampled(d, t, percent=50, buckets=100).collect()), key=str) == expected
    chosen = resampling.drawn(d, t, percent=50, buckets=100)
    assert chosen.columns == d.columns and {r.doc_id for r in chosen.collect()} <= {r[0] for r in expected if r[4]}
    assert resampling.resampled(d.limit(0), t).count() == 0
    assert sorted(map(tuple, resampling.resampled(d, t.limit(0), percent=50).collect()), key=str) == brute_resampled(docs, [], percent=50)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1é日 ,-\t", max_size=40), max_size=6), st.integers(1, 12))
def test_crcs_of_pieces(texts, size):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(x.encode()) for x in texts)])
    found = [[] for _ in texts]
    for one, two, three, text in resampling.features(data, offsets, 1 << 20, size):
        for buckets in (one, two, three):
            for n, k in zip(text.tolist(), buckets.tolist(), strict=True):
                if k >= 0:
                    found[n].append(k)
    assert [sorted(x) for x in found] == [sorted(zlib.crc32(g.encode()) % (1 << 20) for g in grams(x)[1]) for x in texts]


@given(st.binary(max_size=20), st.binary(max_size=300))
def test_crc_algebra(a, b):
    one, two = np.array([zlib.crc32(a)], np.uint32), np.uint32(zlib.crc32(b))
    assert (resampling.shifted(one, np.array([len(b)])) ^ two)[0] == zlib.crc32(a + b)


# -- 12 ---------------------------------------------------------------------


def brute_links(rows, threshold=0.98):
    """Links and components of (vec_id, vector, label) by all pairs."""
    fit = [v is not None and lab is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    near = [set() for _ in rows]
    for i, (_, v, lab) in enumerate(rows):
        for j in range(i):
            w = rows[j][1]
            if fit[i] and fit[j] and lab == rows[j][2]:
                c = sum(a * b for a, b in zip(v, w, strict=False)) / (math.sqrt(sum(a * a for a in v)) * math.sqrt(sum(b * b for b in w)))
                if c >= threshold:
                    near[i].add(j)
                    near[j].add(i)
    out = []
    for i, (own, _, _) in enumerate(rows):
        group, front = {i}, [i]
        while front:
            front = [j for k in front for j in near[k] if j not in group and not group.add(j)]
        ids = [rows[j][0] for j in group if rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((own, len(near[i]), component, own is not None and own == component))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [5, 40, 10_000])
def test_tiles_against_all_pairs(spark, block):
    r = np.random.default_rng(5)
    rows = []
    for label in (1, 2, 2, 2):
        for center in r.normal(size=(4, 8)):
            rows += [[center + r.normal(size=8) * s, label] for s in (0, 0.05, 0.1, 0.1, 0.2, 0.2)]
        chain = r.normal(size=8)
        for _ in range(15):
            chain = chain + r.normal(size=8) * 0.1
            rows.append([chain, label])
    rows += [[rows[3][0], 2]] * 3 + [[rows[30][0], 2]] * 40 + [[rows[30][0] * 3, 2]] * 2
    given_ = [(int(k), [float(x) for x in v], lab) for k, (v, lab) in zip(r.permutation(len(rows)), rows, strict=True)]
    found = neartiles.near_duplicates(spark.createDataFrame(given_, "vec_id long, embedding array<double>, label int"), block=block)
    assert sorted(map(tuple, found.collect()), key=str) == brute_links(given_)


def test_tiles_edges(spark):
    rows = [
        (1, [50.0, 0.0, 0.0, 0.0, 0.0], 1), (2, [49.0, 9.0, 4.0, 1.0, 1.0], 1), (3, [1e200, 0.0], 1), (4, [1e-200], 1), (5, None, 1), (6, [0.0, 0.0], 1), (7, [float("nan"), 1.0], 1), (8, [None, 1.0], 1), (9, [], 1),
        (10, [1.0, 0.0], None), (11, [1.0, 0.0], 2), (11, [2.0, 0.0], 2), (11, [-2.0, -0.0], 2), (None, [1.0, 0.0], 2), (None, [0.0, 1.0], 2), (12, [float("inf"), 1.0], 2),
    ]
    frame = spark.createDataFrame([(*x, 1, "x") for x in rows], "vec_id long, embedding array<double>, label int, node int, v string")
    found = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in neartiles.near_duplicates(frame).collect()}
    assert found == {
        (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (4, 3, 1, False), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True),
        (10, 0, 10, True), (11, 2, 11, True), (11, 0, 11, True), (None, 2, 11, False), (None, 0, None, False), (12, 0, 12, True),
    }
    assert neartiles.near_duplicates(frame.limit(0)).count() == 0
    assert neartiles.near_duplicates(frame.where("vec_id = 5")).collect() == [(5, 0, 5, True)]


# -- 13 ---------------------------------------------------------------------

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é日\t\n<PSM>", max_size=60), st.integers(0, 10_000))
def test_cut_against_pattern(text, doc_id):
    digest = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    tokens = TOKEN.findall(text)
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    expected = (len(tokens), "plain", None, None, text)
    if text and not re.search("<[PSM]>", text):
        spm = h[3] % 100 < 80
        expected = (len(tokens), "spm" if spm else "psm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}")
    n, form, p, m, output = infilling.cut(text.encode(), doc_id, rate=100)
    assert (n, form, p, m, output.decode()) == expected


@given(st.lists(st.booleans(), min_size=1, max_size=200))
def test_select(bits):
    number = int("".join("01"[x] for x in bits), 2)
    places = [0, *(i + 1 for i, x in enumerate(bits) if x)]
    assert [infilling.select(number, len(bits), k) for k in range(len(places))] == places


def test_infilling_edges(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "a <S> b"), (5, "<" + "S" + "a> b" * 50_000), (None, "x y z"), (6, "é " * 9), (6, "é " * 9)]
    frame = spark.createDataFrame([(i, x, "f", 1) for i, x in rows], "doc_id long, text string, form string, n int")
    found = infilling.transformed(frame, rate=100).withColumn("back", infilling.restored(F.col("output"), F.col("form"))).collect()
    assert [(r.doc_id, r.back) for r in found] == [(i, x or "") for i, x in rows]
    assert [r.form for r in found if r.doc_id in (1, 2, 4)] == ["plain"] * 3
    assert infilling.transformed(frame.limit(0)).count() == 0


# -- tables that are deleted -------------------------------------------------


def test_tables_are_deleted(spark, tmp_path, monkeypatch):
    """Only a query's result is left in the shared folder."""
    for name in ("op11_crc_resampling", "op12_pca_tiles"):
        number = iter(range(1000))
        monkeypatch.setattr(common, "shared_dir", lambda _, what, name=name, number=number: f"file://{tmp_path}/{name}/{what}-{next(number)}")
        __spark_entry__.queries()[name](spark, SF)
        assert len(list((tmp_path / name).glob("*"))) == 1 < next(number)


def test_scopes_are_per_thread(spark):
    import threading

    with common.scratch(spark):
        table = common.written(spark.range(3), "held")

        def other():
            with common.scratch(spark):
                common.written(spark.range(2), "other")

        thread = threading.Thread(target=other)
        thread.start()
        thread.join()
        assert table.count() == 3
