"""Near-duplicate vectors of one label by PCA-ordered tiled comparison.

Equal vectors are one class with a number of copies. Classes are scaled to length 1
and turned into the principal axes of all of them (a rotation keeps every product).
Along the leading axes they are dealt to cells as wide as two linked vectors can be
apart, sqrt(2 - 2 t): a label's rows are split along one axis more as long as a cell
holds more than BLOCK of them, and by hash after AXES axes; so tiles are bounded, and
only tiles whose cells touch meet. Inside a pair of tiles, rows go by their first
coordinate in sub-tiles of SUB rows. A pair of sub-tiles sums its products over the
leading coordinates first; what the others can add is at most the product of the two
rows' norms over them (Cauchy-Schwarz). A sub-tile ends when no pair can reach the threshold any
more; a few pairs that still can go on one by one, many go on as a matrix. Cosines within NEAR of the threshold are taken anew from the
vectors as they were given.

A pair of tiles hands back one row per class that has links there: how many vectors it is linked with, and the first class
of its group there. So thousands of near copies of one another are as many rows a tile, not their pairs.
The axes are those of the second moments of all classes.

Defined results: a vector that is null, empty, zero or holds a null, NaN or infinite component, or whose label is null, has no links
and is its own component, kept; vectors of unequal lengths meet as if filled up with zeros; rows that repeat an identifier are vectors of
their own; a null identifier names no component and is not kept, but links; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import scratch, table, written
from .components import components

BLOCK, AXES, SUB, STEPS, FEW, NEAR = 8192, 4, 512, (8, 24), 0.02, 1e-9


def comparable(vector: Column) -> Column:
    """The vector as doubles where it has a direction, else null."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists(vector, lambda x: x != 0)
    return F.when(vector.isNotNull() & ~F.coalesce(wrong, F.lit(True)), F.transform(vector, lambda x: x.cast("double")))


def units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by their largest component first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def matrix(rows, width: int | None = None) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    out = np.zeros((len(rows), max(map(len, rows), default=0) if width is None else width))
    for k, v in enumerate(rows):
        out[k, : len(v)] = v
    return out


def principal_axes(classes: DataFrame, width: int) -> np.ndarray:
    """Orthonormal axes as columns, the one that holds most of the squares first. ``classes`` has a column v.

    Every task sums the products of its vectors' components; Spark adds these up, and width (width + 1) / 2 numbers come to the driver.
    """
    import pandas as pd

    i, j = np.triu_indices(width)

    def products(frames):
        total = np.zeros((width, width))
        for frame in frames:
            if len(frame):
                rows = units(matrix(frame["v"], width))
                total += rows.T @ rows
        yield pd.DataFrame({"cell": i * width + j, "s": total[i, j]})

    sums = classes.select("v").mapInPandas(products, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()
    total = np.zeros(width * width)
    for row in sums:
        total[row["cell"]] = row["s"]
    total = total.reshape(width, width)
    return np.linalg.eigh(np.triu(total) + np.triu(total, 1).T)[1][:, ::-1]


def _turned(classes: DataFrame, axes: np.ndarray, reach: float) -> DataFrame:
    """node, label, n, v, y (the unit vector along the axes) and its cell along the first AXES of them, c0, c1 ..."""
    import pandas as pd

    width, few = len(axes), min(AXES, len(axes))

    def run(frames):
        for frame in frames:
            if len(frame):
                y = units(matrix(frame["v"], width)) @ axes
                cells = np.floor(y[:, :few] / reach).astype(int)
                out = {"node": frame["node"], "label": frame["label"], "n": frame["n"], "v": frame["v"], "y": list(y)}
                yield pd.DataFrame(out | {f"c{k}": cells[:, k] if k < few else 0 for k in range(AXES)})

    cells = ", ".join(f"c{k} int" for k in range(AXES))
    return classes.select("node", F.col("label").cast("string").alias("label"), "n", "v").mapInPandas(run, f"node long, label string, n long, v array<double>, y array<double>, {cells}")


def _tiles(points: DataFrame, block: int) -> DataFrame:
    """The cells of ``points`` with the tile they belong to: label, c0 ..., p0 ... (the cell's leading part; null beyond what the tile is split by), chunks."""
    axes = [f"c{k}" for k in range(AXES)]
    cells = points.groupBy("label", *axes).agg(F.count("*").alias("size"))
    sizes = {f"s{k}": F.sum("size").over(Window.partitionBy("label", *axes[:k])) for k in range(AXES)}
    cells = cells.withColumns(sizes)
    part = {f"p{k}": F.when(F.col(f"s{k}") > block, F.col(f"c{k}")) for k in range(AXES)}
    chunks = F.when(F.col(f"s{AXES - 1}") > block, F.ceil(F.col("size") / block)).otherwise(1).cast("int")
    return cells.select("label", *axes, *(c.alias(n) for n, c in part.items()), chunks.alias("chunks"))


def _meetings(tiles: DataFrame) -> DataFrame:
    """label, and both sides' parts, chunks and numbers of all pairs of tiles whose cells touch; of two sides the one of the smaller key is first."""
    parts = [f"p{k}" for k in range(AXES)]
    whole = tiles.groupBy("label", *parts).agg(F.max("chunks").alias("chunks"))
    side = lambda n: whole.select("label", *(F.col(p).alias(f"{n}{p}") for p in parts), F.col("chunks").alias(f"{n}chunks"), F.struct(*(F.coalesce(p, F.lit(1 << 20)) for p in parts)).alias(f"{n}key"))
    # both sides of a label are split along the first axis, or neither is
    near = side("a").withColumn("at", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda k: F.coalesce(F.col("ap0") + k, k * F.lit(1 << 20)))))
    other = side("b").withColumn("at", F.coalesce("bp0", F.lit(0)))
    touch = F.lit(True)
    for p in parts:
        touch = touch & F.coalesce(F.abs(F.col(f"a{p}") - F.col(f"b{p}")) <= 1, F.lit(True))
    pairs = near.join(other, ["label", "at"]).where(touch & (F.col("akey") <= F.col("bkey")))
    both = pairs.withColumn("ai", F.explode(F.sequence(F.lit(0), F.col("achunks") - 1))).withColumn("bi", F.explode(F.sequence(F.lit(0), F.col("bchunks") - 1)))
    return both.where((F.col("akey") < F.col("bkey")) | (F.col("ai") <= F.col("bi"))).select("label", *(f"{n}{p}" for n in "ab" for p in parts), "ai", "bi").withColumn("pair", F.monotonically_increasing_id())


def _merge(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the groups of i and j; every number's parent is its group's smallest number."""
    while True:
        a, b = parent[i], parent[j]
        differ = a != b
        if not differ.any():
            return
        i, j = i[differ], j[differ]
        np.minimum.at(parent, np.maximum(a, b)[differ], np.minimum(a, b)[differ])
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent[:] = up


class Tile:
    """Rows in the order of their first coordinate, with their norms over what is left after each step."""

    def __init__(self, y: np.ndarray, v: np.ndarray, n: np.ndarray):
        self.order = np.argsort(y[:, 0], kind="stable")
        self.y, self.v, self.n = y[self.order], v[self.order], n[self.order]
        squares = np.cumsum((self.y * self.y)[:, ::-1], axis=1)[:, ::-1]
        self.steps = [*(s for s in STEPS if s < y.shape[1]), y.shape[1]]
        self.left = [np.sqrt(squares[:, s]) if s < y.shape[1] else np.zeros(len(y)) for s in self.steps]


def links_between(a: Tile, b: Tile, same: bool, threshold: float):
    """Yields (i, j), the places in ``a.order`` and ``b.order`` of linked rows, a pair of sub-tiles at a time; with ``same``, i < j."""
    reach = np.sqrt(2 - 2 * threshold) + NEAR
    for x in range(0, len(a.y), SUB):
        p = a.y[x : x + SUB]
        # rows are in the order of their first coordinate
        low, high = np.searchsorted(b.y[:, 0], (p[0, 0] - reach, p[-1, 0] + reach), side="left")
        for z in range(max(x, low // SUB * SUB) if same else low // SUB * SUB, high, SUB):
            q = b.y[z : z + SUB]
            score, done, i = np.zeros((len(p), len(q))), 0, None
            for step, left_a, left_b in zip(a.steps, a.left, b.left, strict=True):
                if i is None:
                    score += p[:, done:step] @ q[:, done:step].T
                    may = score + left_a[x : x + SUB, None] * left_b[None, z : z + SUB] >= threshold - NEAR
                    if same and x == z:
                        may = np.triu(may, 1)
                    n = int(may.sum())
                    if n <= FEW * may.size or step == a.steps[-1]:
                        i, j = np.nonzero(may)
                        score = score[i, j]
                else:
                    score = score + np.einsum("kd,kd->k", p[i, done:step], q[j, done:step])
                    may = score + left_a[x + i] * left_b[z + j] >= threshold - NEAR
                    i, j, score = i[may], j[may], score[may]
                done = step
                if i is not None and not len(i):
                    break
            if i is not None and len(i):
                close = np.flatnonzero(np.abs(score - threshold) <= NEAR)
                for lo in range(0, len(close), 1 << 16):
                    own = close[lo : lo + (1 << 16)]
                    u, w = a.v[x + i[own]], b.v[z + j[own]]
                    score[own] = (u * w).sum(1) / (np.sqrt((u * u).sum(1)) * np.sqrt((w * w).sum(1)))
                keep = score >= threshold
                yield x + i[keep], z + j[keep]


def _compared(points: DataFrame, meetings: DataFrame, tiles: DataFrame, threshold: float) -> DataFrame:
    """node, root, links of every class with links in a pair of tiles."""
    import pandas as pd

    axes, parts = [f"c{k}" for k in range(AXES)], [f"p{k}" for k in range(AXES)]
    placed = points.join(tiles, ["label", *axes]).withColumn("i", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))

    def side(n: str) -> DataFrame:
        own = meetings.select(F.col("label").alias("_l"), *(F.col(f"{n}{p}").alias(f"_{p}") for p in parts), F.col(f"{n}i").alias("_i"), "pair", F.struct(*(f"a{p}" for p in parts), "ai").eqNullSafe(F.struct(*(f"b{p}" for p in parts), "bi")).alias("same"))
        match = (F.col("label") == F.col("_l")) & (F.col("i") == F.col("_i"))
        for p in parts:
            match = match & F.col(p).eqNullSafe(F.col(f"_{p}"))
        # a tile that meets itself is sent once
        return placed.join(own if n == "a" else own.where(~F.col("same")), match).select("pair", "same", F.lit(n).alias("side"), "node", "n", "v", "y")

    def scaled(rows: np.ndarray) -> np.ndarray:
        """By powers of two, which changes no cosine."""
        return np.ldexp(rows, -np.frexp(np.abs(rows).max(1))[1][:, None])

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["side"] == "a"], rows[rows["side"] == "b"]
        out = {"node": [], "root": [], "links": []}
        same = len(left) > 0 and bool(left["same"].iloc[0])
        if len(left) and (same or len(right)):
            frames = [left] if same else [left, right]
            v = scaled(matrix([x for f in frames for x in f["v"]]))
            at = len(left)
            a = Tile(matrix(list(left["y"])), v[:at], left["n"].to_numpy())
            b = a if same else Tile(matrix(list(right["y"])), v[at:], right["n"].to_numpy())
            nodes = np.concatenate([f["node"].to_numpy()[t.order] for f, t in zip(frames, (a, b), strict=False)])
            shift = 0 if same else at
            parent, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
            for i, j in links_between(a, b, same, threshold):
                np.add.at(links, i, b.n[j])
                np.add.at(links, j + shift, a.n[i])
                _merge(parent, i, j + shift)
            on = np.flatnonzero(links)
            out = {"node": nodes[on], "root": nodes[parent[on]], "links": links[on]}
        return pd.DataFrame(out).astype("int64")

    return side("a").union(side("b")).groupBy("pair").applyInPandas(compare, "node long, root long, links long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    with scratch(spark):
        own = vectors.select("vec_id", "label", F.when(F.col("label").isNotNull(), comparable(F.col("embedding"))).alias("v"))
        keys = [F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(k), "label", "v")).alias(f"k{k}") for k in (0, 1)]
        rows = own.select("vec_id", *keys, "label", "v")
        classes = rows.where(F.col("v").isNotNull()).groupBy("k0", "k1").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
        classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")
        width = classes.agg(F.max(F.size("v"))).first()[0]
        if width is None:
            return written(rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")), "near-vectors", keep=True)
        points = written(_turned(classes, principal_axes(classes, width), float(np.sqrt(2 - 2 * threshold)) + NEAR), "near-points")
        tiles = written(_tiles(points, block), "near-tiles")
        found = written(_compared(points, written(_meetings(tiles), "near-meetings"), tiles, threshold), "near-links")
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        groups = components(found.where(F.col("node") != F.col("root")).select(F.col("node").alias("u"), F.col("root").alias("v")))
        known = classes.select("k0", "k1", "node", "first", "n").join(links, "node", "left").join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
        known = written(known.drop("component"), "near-known")
        named = known.groupBy("group").agg(F.min("first").alias("component_id"))
        known = known.join(named, "group").select("k0", "k1", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
        placed = rows.select("vec_id", "k0", "k1").join(known, ["k0", "k1"], "left")
        component = F.when(F.col("k0").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
        return written(placed.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")), "near-vectors", keep=True)


def op12_pca_tiles(spark, sf_dir: str) -> DataFrame:
    """All embeddings of equal label with a cosine of 0.98 or more."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = """
with recursive e as (
  select row_number() over () as r, vec_id, label, embedding::double[] as v,
         coalesce(embedding is not null and label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
                  and len(list_filter(embedding, lambda x: x <> 0)) > 0, false) as fit
  from embeddings),
p as (
  select a.r, b.r as s from e a join e b on a.label = b.label and a.r <> b.r and a.fit and b.fit
  where list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98),
n as (select r, count(*) as n_links from p group by r),
w as (select r, r as s from e union select w.r, p.s from w join p on w.s = p.r),
c as (select w.r, min(e.vec_id) as component_id from w join e on w.s = e.r group by w.r)
select e.vec_id, coalesce(n.n_links, 0)::bigint as n_links, c.component_id, coalesce(e.vec_id = c.component_id, false) as kept
from e join c using (r) left join n using (r)
"""
