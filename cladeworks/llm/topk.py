"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors are quantised to whole numbers, so scores are exact. A block of candidates
is indexed as posting segments (vector number, dimension, impact) in descending
magnitude of impact. A block of queries takes the segments in that order and adds
query weight times impact to its accumulators. What a candidate can still gain or
lose is bounded by the largest impact left per dimension times the query's
weights. Once the k-th best of the lower bounds excludes all but a few candidates
(the proof; anything short of it goes on with the next segment), the ones that
may belong to the best are scored exactly from the vectors.

Queries and candidates meet in blocks of at most BLOCK rows, each pair of blocks in a
task of its own that indexes its candidates once and takes the queries TILE at a time
(fewer candidates a block where there would be too few tasks), and a window keeps the k
best of the blocks' results. So each vector travels once per BLOCK rows of the other side.
Rows go to blocks by a hash of their identifier, so no key decides a block's size.

Defined results: a vector that is null, or has a null, NaN or infinite component,
takes no part; vectors of unequal lengths meet as if filled up with zeros; ties go
to the smaller identifier; rows with the query's own identifier are no candidates;
rows that repeat an identifier are candidates of their own, and as queries share
that identifier's one list; null identifiers take
no part; an empty table gives no rows; scores are exact, and beyond the range of a long its ends.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

BLOCK, LEAST, TILE, SEGMENTS, FEW = 65_536, 2048, 256, 6, 64


def quantised(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of each component as whole numbers; null where a vector takes no part."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(wrong, F.lit(False)), F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long")))


class Index:
    """Posting segments of a block of vectors (n x d whole numbers)."""

    def __init__(self, vectors: np.ndarray, segments: int = SEGMENTS):
        self.vectors = vectors
        size = np.abs(vectors)
        edges = np.unique(np.quantile(size[size > 0], np.linspace(0, 1, segments + 1)[1:-1]).astype(np.int64)) if (size > 0).any() else np.empty(0, np.int64)
        level = np.searchsorted(edges, size, side="left")
        self.segments = []
        for k in range(len(edges), -1, -1):
            rows, dims = np.nonzero((level == k) & (size > 0))
            left = np.where(level < k, vectors, 0)
            self.segments.append((rows, dims, vectors[rows, dims], left.max(0, initial=0), left.min(0, initial=0)))

    def search(self, queries: np.ndarray, k: int, skip: np.ndarray, few: int = FEW):
        """Per query the numbers of all candidates that may be among the k best, with exact scores. ``skip``: pairs that don't count."""
        n, d = self.vectors.shape
        # Python's own numbers: the largest score that may occur
        bound = max((sum(map(abs, q)) for q in queries.tolist()), default=0) * max(int(self.vectors.max(initial=0)), -int(self.vectors.min(initial=0)))
        if bound >= 1 << 53:
            yield from self._search_whole(queries, k, skip)
            return
        exact = np.float32 if bound < 1 << 24 else np.float64
        weights = queries.astype(exact)
        rising, falling = np.maximum(weights, 0), np.minimum(weights, 0)
        score = np.zeros((len(queries), n), exact)
        open_ = np.arange(len(queries))
        found: list[np.ndarray | None] = [None] * len(queries)
        for number, (rows, dims, impacts, most, least) in enumerate(self.segments):
            plane = np.zeros((d, n), exact)
            plane[dims, rows] = impacts
            score += weights[open_] @ plane
            if number == 0:
                score[skip[open_]] = -np.inf
            up = rising[open_] @ most.astype(exact) + falling[open_] @ least.astype(exact)
            down = rising[open_] @ least.astype(exact) + falling[open_] @ most.astype(exact)
            if n > k:
                bar = np.partition(score, n - k, axis=1)[:, n - k] + down
            else:
                bar = np.full(len(open_), -np.inf)
            may = score + up[:, None] >= bar[:, None]
            may &= np.isfinite(score)
            last = number == len(self.segments) - 1
            proven = may.sum(1) <= few * k if not last else np.ones(len(open_), bool)
            for i in np.flatnonzero(proven):
                found[open_[i]] = np.flatnonzero(may[i])
            score, open_ = score[~proven], open_[~proven]
            if not len(open_):
                break
        for q, numbers in enumerate(found):
            numbers = np.empty(0, np.int64) if numbers is None else numbers
            yield q, numbers, self.vectors[numbers] @ queries[q]

    def _search_whole(self, queries: np.ndarray, k: int, skip: np.ndarray):
        """The same for components too large for floating point: all scores as whole numbers of any size."""
        vectors, low, high = self.vectors.astype(object), np.iinfo(np.int64).min, np.iinfo(np.int64).max
        for q, query in enumerate(queries.astype(object)):
            numbers = np.flatnonzero(~skip[q])
            yield q, numbers, np.array([min(max(x, low), high) for x in vectors[numbers] @ query], np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best. Both have columns vec_id and v (whole numbers); see :func:`quantised`."""
    import pandas as pd

    vectors = vectors.where(F.col("v").isNotNull() & F.col("vec_id").isNotNull()).select("vec_id", "v")
    queries = queries.where(F.col("v").isNotNull() & F.col("vec_id").isNotNull()).select("vec_id", "v").distinct()
    rows = vectors.count()
    tasks = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-rows // BLOCK), min(tasks, -(-rows // LEAST)))
    query_blocks = max(1, -(-queries.count() // BLOCK))
    side = lambda df, own, n_own, other, n_other: df.withColumn(own, F.pmod(F.xxhash64("vec_id", F.lit(own)), F.lit(n_own)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
    left = side(queries, "q", query_blocks, "c", blocks)
    right = side(vectors, "c", blocks, "q", query_blocks)

    def search(key, qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(cs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        width = max(max(map(len, qs["v"])), max(map(len, cs["v"])), 1)
        fill = lambda rows: np.array([np.pad(np.asarray(v, np.int64), (0, width - len(v))) for v in rows])
        whole = lambda rows: np.stack(rows.to_numpy()).astype(np.int64) if all(len(v) == width for v in rows) else fill(rows)
        q_ids, c_ids = qs["vec_id"].to_numpy(np.int64), cs["vec_id"].to_numpy(np.int64)
        q, index, out = whole(qs["v"]), Index(whole(cs["v"])), []
        for at in range(0, len(q), TILE):
            own = q_ids[at : at + TILE]
            for i, numbers, scores in index.search(q[at : at + TILE], k, own[:, None] == c_ids[None, :]):
                # -1 - x, as a long's lowest number has no opposite
                best = np.lexsort((c_ids[numbers], -1 - scores))[:k]
                out.append((np.full(len(best), own[i]), c_ids[numbers][best], scores[best]))
        return pd.DataFrame({n: np.concatenate(x) for n, x in zip(("query_id", "vec_id", "score"), zip(*out, strict=True), strict=True)})

    pairs = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_impact_topk(spark, sf_dir: str) -> DataFrame:
    """The 20 best of all other vectors for every vector whose identifier is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("v"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


SQL = """
with e as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and vec_id is not null),
s as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from e q join e c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id)
select query_id, rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s) where rank <= 20
"""
