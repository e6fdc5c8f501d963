"""Jaccard join of texts on word shingles, bounded by count vectors in an R-tree.

1. A text's set of shingles is a sorted array of 64-bit hashes. Texts with equal sets
   are one class; only classes go on. The same pass counts all shingles in a sketch of
   fixed size (:data:`SKETCH` buckets).
2. All sets are put in one order: by the sketch's count of an element, rarer ones first,
   then by hash. Two linked sets share at least ceil(t * n) elements of either, so
   they share one of the first n - ceil(t * n) + 1. Each class sends these elements
   with its size and a small sketch of itself. The classes of one element whose sizes follow
   one another closely enough are a block; in blocks of up to MANY, a class that sizes and
   sketches keep from all others is left out (texts share many elements by chance, and more
   in larger tables). This loses no pair, whatever the
   order; the counts only see to it that what very many texts share makes no block.
3. Every member of a block is first checked against one of them, that which is in
   most blocks: sizes, then count vectors (elements hashed into DIMS groups, the sum of
   the coordinates' minima bounds the overlap), then the sets. Only members that are
   still in different components of one block are compared further: their count
   vectors are packed into an R-tree, whose node corners and then points bound the
   overlap (blocks of few members, each a tree of one leaf, many at a time), and pairs
   that the bound leaves are checked on the sets themselves. For that, the set of a
   pair's centre goes once to each TILE of its partners, whose sets stream past it.
   Near texts meet in most of their blocks; a pair is given by the first of these only,
   as far as the EARLY first blocks of both tell, and never by none.

So a large group of near copies costs one check a member and block, not all pairs;
members are compared in blocks of CHUNK, each pair of blocks in a task of its own, and a
task holds one set at a time. An element that the sketch counts often is dealt over
several tasks.

Defined results: a null or empty text, or one without words, has no shingles and links
with nothing; a text of fewer words than a shingle is one shingle; repeated rows are
classes' members like any other; rows of one identifier and different texts are one node
that has the links of all of them; a null identifier takes no part in components and has
none; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashes_of, mix64, scratch, small, table, text_bytes, words_in, written
from .components import components

DIMS, CHUNK, LEAF, FAN, TILE = 128, 2048, 16, 8, 64
#: Buckets of the sketch that counts shingles, and in how many rows it travels.
SKETCH, PARTS = 1 << 22, 64
#: Elements in a bucket counted this often are dealt over tasks.
OFTEN = 1 << 20
#: Of a text's blocks that are compared, so many (the first by number) are known beside each of its rows.
EARLY = 64
#: Largest block whose members' sketches are all held against each other before anything else.
MANY = 64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles."""
    starts, ends = words_in(data, offsets)
    words, at = hashes_of(data, starts, ends), np.searchsorted(starts, offsets)
    rolled = np.zeros(max(len(words) - k + 1, 0), np.uint64)
    for i in range(k):
        rolled = rolled * np.uint64(0x2545F4914F6CDD1D) + words[i : i + len(rolled)]
    rolled, out = mix64(rolled), []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            x = b - a
            for w in words[a:b].tolist():
                x = (x * 0x2545F4914F6CDD1D + w) % (1 << 64)
            out.append(mix64(np.array([x], np.uint64) + np.uint64(0x1234567)))
        else:
            out.append(rolled[:0])
    return out


def counts_of(elements: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """A set as a point: how many of its elements hash into each of ``dims`` groups."""
    return np.bincount((elements >> np.uint64(40)).astype(np.int64) % dims, minlength=dims).astype(np.uint32)


def buckets_of(elements: np.ndarray) -> np.ndarray:
    return (mix64(elements ^ np.uint64(0xA24BAED4963EE407)) >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64)


def prefixes(sets: list[np.ndarray], rarity: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The elements that each set sends at a threshold of a / b, and how many of them each set has.

    ``rarity`` has a small number for each bucket; elements go by it and then by their own value.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    elements = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    own = np.repeat(np.arange(len(sets), dtype=np.int64), sizes)
    # sets are sorted, so a stable sort leaves elements of one rarity in order
    elements = elements[np.argsort(own << 8 | rarity[buckets_of(elements)], kind="stable")]
    sent = np.where(sizes > 0, sizes + (-sizes * a) // b + 1, 0)
    place = np.arange(len(elements)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return elements[place < np.repeat(sent, sizes)], sent


def sketch_of(elements: np.ndarray) -> np.ndarray:
    """How many of a set's elements hash into each of 32 groups, modulo 16, as two integers."""
    counts = np.bincount((elements >> np.uint64(50)).astype(np.int64) & 31, minlength=32).astype(np.uint64) & np.uint64(15)
    return (counts.reshape(2, 16) << np.arange(0, 64, 4, dtype=np.uint64)).sum(1, dtype=np.uint64)


def least_apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """At least so many elements are in one set only, for rows of sketches of two sets each."""
    shifts = np.arange(0, 64, 4, dtype=np.uint64)
    groups = lambda x: (x[:, :, None] >> shifts & np.uint64(15)).astype(np.int8).reshape(len(x), 32)
    apart = (groups(p) - groups(q)) & np.int8(15)
    return np.minimum(apart, 16 - apart).sum(1, dtype=np.int64)


def may_link(element: np.ndarray, salt: np.ndarray, key: np.ndarray, n: np.ndarray, sketches: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may link with another of their element, and the number of each one's block.

    Rows are sorted by element, salt, n and key; those of an element with salts are all kept, in one block.
    """
    same = np.zeros(len(element), bool)
    same[1:] = (element[1:] == element[:-1]) & (salt[1:] == salt[:-1])
    again = same.copy()
    again[1:] &= key[1:] == key[:-1]
    rows = np.flatnonzero(~again)
    e, s, m, same = element[rows], salt[rows], n[rows], same[rows]
    cut = ~same
    cut[1:] |= (s[1:] == 0) & (m[:-1] * b < m[1:] * a)
    run = np.cumsum(cut) - 1
    size = np.bincount(run, minlength=1)[run] if len(run) else run
    first = run[np.maximum.accumulate(np.where(same, 0, np.arange(len(rows))))]
    block = np.where(run == first, e, mix64(e.view(np.uint64) + (run - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
    keep = (s > 0) | (size > MANY)
    few = np.flatnonzero((s == 0) & (size > 1) & (size <= MANY))
    r, m, x = run[few], m[few], sketches[rows[few]]
    near = np.zeros(len(few), bool)
    for step in range(1, min(MANY, len(few))):
        i = np.flatnonzero(r[step:] == r[:-step])
        if not len(i):
            break
        j = i + step
        fits = m[i] * b >= m[j] * a
        i, j = i[fits], j[fits]
        # sets of m[i] and m[j] elements that link have at most (b - a) / (a + b) of these in one of them only
        fits = least_apart(x[i], x[j]) * (a + b) <= (b - a) * (m[i] + m[j])
        near[i[fits]] = near[j[fits]] = True
    keep[few] = near
    return rows[keep], block[keep]


class CountTree:
    """An R-tree over points of counts; nodes hold the largest coordinate and the smallest size below them."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        spread = np.argsort(-points.var(0))[:3] if len(points) else np.arange(3)
        self.order = np.lexsort((*points[:, spread].T, sizes))
        self.levels = [(points[self.order].astype(np.int32), sizes[self.order])]
        width = LEAF
        while len(self.levels[-1][1]) > 1:
            p, s = self.levels[-1]
            at = np.arange(0, len(s), width)
            self.levels.append((np.maximum.reduceat(p, at, axis=0), np.minimum.reduceat(s, at)))
            width = FAN

    def pairs(self, other: CountTree, a: int, b: int, step: int = 20_000) -> np.ndarray:
        """Numbers (i, j) of all points here and there whose bound leaves J >= a / b possible."""
        found = np.zeros((1, 2), np.int64) if len(self.order) and len(other.order) else np.empty((0, 2), np.int64)
        height = max(len(self.levels), len(other.levels))
        for level in range(height - 1, -1, -1):
            p, s = self.levels[min(level, len(self.levels) - 1)]
            q, t = other.levels[min(level, len(other.levels) - 1)]
            if level < height - 1:
                width = LEAF if level == 0 else FAN
                i = found[:, :1] * width + np.arange(width) if level < len(self.levels) - 1 else found[:, :1]
                j = found[:, 1:] * width + np.arange(width) if level < len(other.levels) - 1 else found[:, 1:]
                left, right = np.repeat(i, j.shape[1], axis=1).ravel(), np.tile(j, (1, i.shape[1])).ravel()
                found = np.stack([left, right], 1)[(left < len(s)) & (right < len(t))]
                found = found[np.argsort(found[:, 0], kind="stable")]
            keep = np.empty(len(found), bool)
            for x in range(0, len(found), step):
                i, j = found[x : x + step].T
                overlap = np.minimum(p[i], q[j]).sum(1)
                keep[x : x + step] = overlap * (a + b) >= a * (s[i] + t[j])
            found = found[keep]
        return np.stack([self.order[found[:, 0]], other.order[found[:, 1]]], 1)


def _sliced(batches):
    """Identifiers, bytes and offsets of the texts, a megabyte or so at a time."""
    for b in batches:
        ids, column = b.column(0), b.column(1)
        at, n = 0, b.num_rows
        _, offsets = text_bytes(column)
        while at < n:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 20), side="right")) - 1)
            yield ids.slice(at, to - at), *text_bytes(column.slice(at, to - at))
            at = to


def sized(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n (size of its set), key and key2 (together the set's identity) and counts (the point) of columns doc_id, text.

    Each task adds PARTS rows of its own with a ``part``, whose ``counts`` are its part of the sketch.
    """
    import pyarrow as pa
    import zstandard

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = "doc_id long, n long, key long, key2 long, counts binary, part int"
    columns = [x.split()[0] for x in names.split(",")]

    def run(batches):
        sketch = np.zeros(SKETCH, np.uint32)

        def make(ids, data, offsets):
            sets = shingle_sets(data, offsets, k)
            np.add.at(sketch, buckets_of(np.concatenate(sets)) if sets else np.empty(0, np.int64), 1)
            key = np.array([x.sum(dtype=np.uint64) for x in sets], np.uint64)
            key2 = np.array([mix64(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for x in sets], np.uint64)
            points = pa.array([counts_of(x).astype("<u4").tobytes() for x in sets], pa.binary())
            return [ids, pa.array([len(x) for x in sets], pa.int64()), pa.array(mix64(key).view(np.int64)), pa.array(key2.view(np.int64)), points, pa.nulls(len(sets), pa.int32())]

        for x in _sliced(batches):
            yield pa.RecordBatch.from_arrays(make(*x), names=columns)
        pack = zstandard.ZstdCompressor(level=1).compress
        parts = [pack(x.astype("<u4").tobytes()) for x in np.split(sketch, PARTS)]
        none = pa.nulls(PARTS, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(parts, pa.binary()), pa.array(range(PARTS), pa.int32())], names=columns)

    return docs.mapInArrow(run, names)


def rarity_of(facts: DataFrame) -> np.ndarray:
    """A byte for each bucket of the sketch, larger for larger counts, and the counts it stands for in eighths of doublings."""
    import pandas as pd
    import zstandard

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total, unpack = np.zeros(SKETCH // PARTS, np.uint64), zstandard.ZstdDecompressor().decompress
        for x in rows["counts"]:
            total += np.frombuffer(unpack(x), "<u4")
        steps = np.minimum(np.round(4 * np.log2(total + np.uint64(1))), 255).astype(np.uint8)
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "steps": [steps.tobytes()]})

    # a fixed number of bytes, whatever the corpus
    found = facts.where(F.col("part").isNotNull()).select("part", "counts").groupBy("part").applyInPandas(add, "part int, steps binary").collect()
    rarity = np.zeros(SKETCH, np.uint8)
    for part, steps in found:
        rarity[part * (SKETCH // PARTS) : (part + 1) * (SKETCH // PARTS)] = np.frombuffer(steps, np.uint8)
    return rarity


def sent_elements(docs: DataFrame, k: int, a: int, b: int, rarity: np.ndarray) -> DataFrame:
    """element, salt, key, n, low, high (a sketch): what each distinct set of a task sends. Elements counted often have several salts."""
    import pyarrow as pa

    held = docs.sparkSession.sparkContext.broadcast(rarity)
    often = max(OFTEN, int(8 * (2.0 ** (rarity / 4.0)).mean()))

    def run(batches):
        seen: set[int] = set()
        for _, data, offsets in _sliced(batches):
            sets, keys = [], []
            for x in shingle_sets(data, offsets, k):
                key = int(x.sum(dtype=np.uint64))
                if len(x) and key not in seen:
                    seen.add(key)
                    sets.append(x)
                    keys.append(key)
            elements, sent = prefixes(sets, held.value, a, b)
            key = mix64(np.repeat(np.array(keys, np.uint64), sent))
            salts = np.maximum(2.0 ** (held.value[buckets_of(elements)] / 4.0) / often, 1).astype(np.uint64)
            salt = np.where(salts > 1, key % salts + np.uint64(1), np.uint64(0)).astype(np.int32)
            n = np.repeat(np.array([len(x) for x in sets], np.int32), sent)
            low, high = np.repeat(np.array([sketch_of(x) for x in sets], np.uint64).reshape(-1, 2), sent, axis=0).T
            columns = [elements.view(np.int64), salt, key.view(np.int64), n, low.copy().view(np.int64), high.copy().view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["element", "salt", "key", "n", "low", "high"])

    return docs.select(F.lit(0).alias("none"), "text").mapInArrow(run, "element long, salt int, key long, n int, low long, high long")


def shared_elements(sent: DataFrame, a: int, b: int) -> DataFrame:
    """element (a number of its block), key: the rows of ``sent`` that may link with another of their element, each once."""
    import pyarrow as pa

    def ready(held):
        element, salt, key, n, low, high = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in range(6))
        rows, block = may_link(element, salt, key, n.astype(np.int64), np.stack([low, high], 1).view(np.uint64), a, b)
        return pa.RecordBatch.from_arrays([pa.array(block), pa.array(key[rows])], names=["element", "key"])

    def run(batches):
        held, here = [], None
        for x in batches:
            if not x.num_rows:
                continue
            element, salt = x.column(0).to_numpy(), x.column(1).to_numpy()
            before = np.flatnonzero((element != element[-1]) | (salt != salt[-1]))
            to, last = int(before[-1]) + 1 if len(before) else 0, (element[-1], salt[-1])
            if held and (to or last != here):
                yield ready([*held, x.slice(0, to)])
                held = []
            elif to:
                yield ready([x.slice(0, to)])
            held.append(x.slice(to))
            here = last
        if held:
            yield ready(held)

    return sent.repartition("element", "salt").sortWithinPartitions("element", "salt", "n", "key").mapInArrow(run, "element long, key long")


def sets_of(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, elements (sorted 64-bit hashes) of columns doc_id, text."""
    import pyarrow as pa

    def run(batches):
        for ids, data, offsets in _sliced(batches):
            yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes() for x in shingle_sets(data, offsets, k)], pa.binary())], names=["doc_id", "elements"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, elements binary")


def _bounded(pairs: DataFrame, points: DataFrame, a: int, b: int) -> DataFrame:
    """The pairs (u, v) whose points leave a link possible."""
    import pyarrow as pa

    left = pairs.join(points.select(F.col("doc_id").alias("u"), F.col("n").alias("un"), F.col("counts").alias("uc")), "u")
    both = left.join(points.select(F.col("doc_id").alias("v"), F.col("n").alias("vn"), F.col("counts").alias("vc")), "v")
    both = both.where(F.least("un", "vn") * b >= F.greatest("un", "vn") * a)

    def bound(batches):
        for x in batches:
            if x.num_rows:
                p, q = (np.frombuffer(b"".join(x.column(c).to_pylist()), "<u4").reshape(x.num_rows, DIMS) for c in ("uc", "vc"))
                n = x.column("un").to_numpy() + x.column("vn").to_numpy()
                keep = np.minimum(p, q).sum(1).astype(np.int64) * (a + b) >= a * n
                yield pa.RecordBatch.from_arrays([x.column(c).filter(pa.array(keep)) for c in ("u", "v")], names=["u", "v"])

    return both.select("u", "v", "un", "vn", "uc", "vc").mapInArrow(bound, "u long, v long")


def _link(p: np.ndarray, q: np.ndarray, a: int, b: int) -> bool:
    both = np.sort(np.concatenate([p, q]), kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    return same * b >= a * (len(p) + len(q) - same)


def _linked(pairs: DataFrame, docs: DataFrame, k: int, a: int, b: int) -> DataFrame:
    """The pairs (u, v; a written table) whose sets link. The end with more partners is a pair's centre."""
    import pyarrow as pa

    ends = pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("_d"))
    ends = written(ends, "pair-ends")
    sets = written(sets_of(docs.join(small(ends.select("doc_id")), "doc_id", "left_semi"), k), "pair-sets")
    degree = small(ends)
    of = lambda end: degree.select(F.col("doc_id").alias(end), F.col("_d").alias(f"_{end}"))
    swap = F.col("_u") > F.col("_v")
    stars = pairs.join(of("u"), "u").join(of("v"), "v").select(F.when(swap, F.col("u")).otherwise(F.col("v")).alias("centre"), F.when(swap, F.col("v")).otherwise(F.col("u")).alias("other"), F.greatest("_u", "_v").alias("_d"))
    stars = stars.select("centre", F.pmod(F.xxhash64("other"), F.ceil(F.col("_d") / TILE)).cast("int").alias("tile"), "other")
    stars = written(stars, "pair-stars")
    centres = stars.select("centre", "tile").distinct().join(sets, F.col("centre") == F.col("doc_id")).select("centre", "tile", F.lit(None).cast("long").alias("other"), "elements")
    others = stars.join(sets, F.col("other") == F.col("doc_id")).select("centre", "tile", "other", "elements")
    rows = centres.union(others).repartition("centre", "tile").sortWithinPartitions("centre", "tile", F.col("other").asc_nulls_first())

    def verify(batches):
        here, held = None, {}
        for x in batches:
            keep = []
            for key, other, elements in zip(zip(x.column("centre").to_pylist(), x.column("tile").to_pylist(), strict=True), x.column("other").to_pylist(), x.column("elements").to_pylist(), strict=True):
                if key != here:
                    here, held = key, {}
                if other is None:
                    held[elements] = np.frombuffer(elements, np.uint64)
                elif any(_link(c, np.frombuffer(elements, np.uint64), a, b) for c in held.values()):
                    keep.append((max(key[0], other), min(key[0], other)))
            yield pa.RecordBatch.from_arrays([pa.array([p[c] for p in keep], pa.int64()) for c in (0, 1)], names=["u", "v"])

    return rows.mapInArrow(verify, "u long, v long")


def met_before(early: np.ndarray, i: np.ndarray, j: np.ndarray, block: np.ndarray, step: int = 20_000) -> np.ndarray:
    """Whether rows i and j of ``early`` (block numbers, each once in a row but for the largest number there is) share one below ``block``."""
    out = np.zeros(len(i), bool)
    for x in range(0, len(i), step):
        both = np.sort(np.concatenate([early[i[x : x + step]], early[j[x : x + step]]], axis=1), axis=1)
        out[x : x + step] = ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] < block[x : x + step, None])).any(1)
    return out


def _with_early(members: DataFrame) -> DataFrame:
    """``members`` (block, doc_id and others) with ``early``, the first EARLY blocks of each text, filled up with the largest number."""
    blocks = F.concat(F.sort_array(F.collect_set("block")), F.array_repeat(F.lit((1 << 63) - 1), EARLY))
    return members.join(members.groupBy("doc_id").agg(F.slice(blocks, 1, EARLY).alias("early")), "doc_id")


def _across(members: DataFrame, a: int, b: int) -> DataFrame:
    """u, v of one block and different components whose bound leaves a link possible, each about once. ``members``: block, size (rows of the block), doc_id, component, n, counts, early."""
    import pandas as pd

    rows = members.withColumn("_c", F.ceil(F.col("size") / CHUNK)).withColumn("_own", F.pmod(F.xxhash64("doc_id"), F.col("_c")))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_c") - 1)))
    rows = rows.select("block", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "_own", "doc_id", "component", "n", "counts", "early")

    def arrays(rows: pd.DataFrame) -> list[np.ndarray]:
        points = np.frombuffer(b"".join(rows["counts"]), "<u4").reshape(len(rows), DIMS)
        return [points, np.stack(rows["early"].to_list()), *(rows[c].to_numpy(np.int64) for c in ("doc_id", "component", "n", "block"))]

    def compare(rows: pd.DataFrame) -> list[np.ndarray]:
        points, early, ids, parts, n, block = arrays(rows)
        own = rows["_own"].to_numpy(np.int64)
        one, two = np.flatnonzero(own == rows["i"].iloc[0]), np.flatnonzero(own == rows["j"].iloc[0])
        x = CountTree(points[one], n[one])
        y = x if rows["i"].iloc[0] == rows["j"].iloc[0] else CountTree(points[two], n[two])
        found = x.pairs(y, a, b)
        i, j = one[found[:, 0]], two[found[:, 1]]
        keep = parts[i] != parts[j]
        keep &= ids[i] > ids[j] if y is x else True
        i, j = i[keep], j[keep]
        new = ~met_before(early, i, j, block[i])
        return [np.maximum(ids[i], ids[j])[new], np.minimum(ids[i], ids[j])[new]]

    def compare_leaves(rows: pd.DataFrame, number: np.ndarray) -> list[np.ndarray]:
        """The same of many blocks of one leaf each; ``number`` counts the blocks."""
        (points, early, ids, parts, n, block), found = arrays(rows), [np.empty((0, 2), np.int64)]
        for step in range(1, LEAF):
            i = np.flatnonzero(number[step:] == number[:-step])
            j = i + step
            keep = (parts[i] != parts[j]) & (np.minimum(n[i], n[j]) * b >= np.maximum(n[i], n[j]) * a)
            i, j = i[keep], j[keep]
            keep = np.minimum(points[i], points[j]).sum(1).astype(np.int64) * (a + b) >= a * (n[i] + n[j])
            i, j = i[keep], j[keep]
            new = ~met_before(early, i, j, block[i])
            i, j = ids[i[new]], ids[j[new]]
            found.append(np.stack([np.maximum(i, j), np.minimum(i, j)], 1))
        return list(np.unique(np.concatenate(found), axis=0).T)

    def complete(frame: pd.DataFrame, cuts: np.ndarray):
        size = np.diff(cuts)
        few = np.repeat(size <= LEAF, size)
        if few.any():
            u, v = compare_leaves(frame.iloc[: cuts[-1]][few], np.repeat(np.arange(len(size)), size)[few])
            yield pd.DataFrame({"u": u, "v": v})
        for k in np.flatnonzero(size > LEAF):
            u, v = compare(frame.iloc[cuts[k] : cuts[k + 1]])
            yield pd.DataFrame({"u": u, "v": v})

    def run(frames):
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            if not len(frame):
                continue
            new = (frame[["block", "i", "j"]] != frame[["block", "i", "j"]].shift()).any(axis=1).to_numpy()
            cuts = np.flatnonzero(new)
            held = frame.iloc[cuts[-1] :]
            yield from complete(frame, cuts)
        if held is not None and len(held):
            yield from complete(held, np.array([0, len(held)]))

    return rows.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j").mapInPandas(run, "u long, v long")


def classes(docs: DataFrame, k: int, a: int, b: int) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of ``docs``: components of links J >= a / b on k-word shingles."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = written(sized(docs, k), "shingle-sizes", keep=True)
    facts = every.where(F.col("part").isNull())
    with scratch(docs.sparkSession):
        same = facts.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("key", "key2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("_rows"))
        # those of one row are their own
        copied = written(same.where(F.col("_rows") > 1).drop("_rows"), "shingle-copied", keep=True)
        parts = written(components(_links(docs, every, facts, same.drop("_rows"), k, a, b)), "shingle-parts", keep=True)
    classed = facts.join(small(copied), ["key", "key2", "n"], "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    # a class goes by its smallest identifier, so a component of classes has its documents' smallest
    found = classed.join(small(parts), classed["rep"] == parts["node"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _links(docs: DataFrame, every: DataFrame, facts: DataFrame, reps: DataFrame, k: int, a: int, b: int) -> DataFrame:
    """u, v: links between classes that join all of a component."""
    shared = written(shared_elements(sent_elements(docs, k, a, b, rarity_of(every)), a, b), "shingle-shared")
    # elements of the same classes are one block
    low = F.xxhash64("key").bitwiseAND(F.lit((1 << 32) - 1))
    sums = shared.groupBy("element").agg(F.sum(low).alias("_s"), F.count("*").alias("_n"), F.min("key").alias("_x"), F.max("key").alias("_y")).where(F.col("_n") > 1)
    firsts = sums.groupBy(F.xxhash64("_s", "_n", "_x", "_y").alias("block")).agg(F.min("element").alias("element"))
    keys = shared.join(firsts, "element").select("block", "key")
    members = written(keys.join(reps.select("key", F.col("rep").alias("doc_id"), "n"), "key").select("block", "doc_id", "n"), "shingle-members")
    often = members.join(members.groupBy("doc_id").agg(F.count("*").alias("_d")), "doc_id")
    hub = often.groupBy("block").agg(F.max_by(F.struct("doc_id", "n"), F.struct("_d", -F.col("doc_id"))).alias("_hub"))
    hub = hub.select("block", F.col("_hub.doc_id").alias("hub"), F.col("_hub.n").alias("hub_n"))
    met = written(members.join(hub, "block").where(F.col("doc_id") != F.col("hub")), "shingle-met")
    wanted = small(written(members.select("doc_id").distinct(), "shingle-wanted"))
    points = written(facts.select("doc_id", "n", "counts").join(wanted, "doc_id", "left_semi").distinct(), "shingle-points")
    near = met.where(F.least("n", "hub_n") * b >= F.greatest("n", "hub_n") * a)
    near = written(near.select(F.greatest("doc_id", "hub").alias("u"), F.least("doc_id", "hub").alias("v")).distinct(), "shingle-near")
    links = written(_linked(written(_bounded(near, points, a, b), "shingle-bounded"), docs, k, a, b), "shingle-links")
    parts = written(components(links), "shingle-parts")
    # the hub has met all others of its block
    placed = met.join(small(parts), met["doc_id"] == parts["node"], "left").select("block", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    spread = placed.groupBy("block").agg(F.min("component").alias("_x"), F.max("component").alias("_y"), F.count("*").alias("size"))
    apart = spread.where(F.col("_x") != F.col("_y")).select("block", "size")
    rest = _with_early(written(placed.join(apart, "block"), "shingle-apart")).join(points, "doc_id")
    more = written(_across(rest, a, b).distinct().join(near, ["u", "v"], "left_anti"), "shingle-near")
    return links.union(written(_linked(more, docs, k, a, b), "shingle-links"))


def without_near_copies(docs: DataFrame, k: int = 5, a: int = 4, b: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay when one of each component does (that of smallest identifier), with the same columns.

    An identifier names one document: of rows that repeat one, that of smallest text hash stays. Rows
    without an identifier stay, exact repeats of their texts once.
    """
    with scratch(docs.sparkSession):
        found = classes(docs.select("doc_id", "text"), k, a, b)
        gone = written(found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct(), "near-copies", keep=True)
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_h"))
    rows = rows.join(small(gone), F.col("_id") == F.col("_gone"), "left_anti")
    again = written(rows.groupBy("_id", F.when(F.col("_id").isNull(), F.col("_h")).alias("_n")).agg(F.count("*").alias("_c"), F.min("_h").alias("_least")).where(F.col("_c") > 1), "near-again")
    if again.isEmpty():
        return rows.select("_row.*")
    again = again.select(F.col("_id").alias("_id2"), F.col("_least"))
    same = rows.join(again, rows["_id"].eqNullSafe(again["_id2"]) & (F.col("_id").isNotNull() | (F.col("_h") == F.col("_least"))), "left")
    once = same.where(F.col("_least").isNotNull() & (F.col("_h") == F.col("_least"))).groupBy("_id", "_h").agg(F.first("_row").alias("_row"))
    return same.where(F.col("_least").isNull()).select("_row").union(once.select("_row")).select("_row.*")


def op7_count_rtree_join(spark, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 9, 10)
