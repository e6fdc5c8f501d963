"""Mixing sources to target weights by Pareto order sampling.

Every document has an expected number of copies, that is its source's share of the
target by size times the document's importance (1 unless the caller gives a column), at
most ``cap``. Its whole part is certain. For the fraction f that is left, which differs
between documents of unequal importance, documents of a source are ranked by random odds over inclusion odds, (u / (1 - u)) / (f / (1 - f)), and the first
ones are taken until the source's target is filled (fixed-size unequal
probability sampling after Rosen). ``u`` is a hash of the identifier, so reruns
agree.

The rank is never computed by sorting a source: words are summed per
(source, rank bucket), the bucket where the target is reached is found, split
again, and only the last bucket's rows are ordered. A source with a third of all
rows is therefore two small sums and a few rows to sort.

Defined results: null or empty text has size 0 and 0 taken words; null source is
a source of its own, last in order; null identifiers hash as the empty string;
rows with the same identifier in one source are taken or left together; an importance
that is null, not finite or below 0 counts as 0, and a source without any takes nothing; an empty
table gives no rows; extra columns are kept by :func:`mixed` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small, table, written

WORD = r"[^\x20\x09-\x0D]+"
LEVEL = 1024


def words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, cap: int = 3) -> DataFrame:
    """Target words per source: ``share`` of all words by weight, at most ``cap`` times the source's, the rest reshared.

    ``sources`` has one row per source: _key, source, source_size. With caps, the
    reshared targets are min(cap_s, level * weight_s) for one level; sources in
    order of cap / weight fill up first, so the level follows from running sums.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), "_n")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_n") - 1) % len(weights) + 1).cast("int")).cast("long")
    levels = (
        sources.withColumn("_n", F.row_number().over(by_name))
        .withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * cap)
        .withColumn("_left", F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_level", F.col("_left") / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0))))
    )
    free = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))
    level = F.first(free, ignorenulls=True).over(everything)
    return levels.withColumn("target", F.coalesce(F.least(F.col("_cap").cast("double"), level * F.col("_w")), F.col("_cap").cast("double"))).select("_key", "source", "source_size", "target")


def _facts(docs: DataFrame, seed: str, importance: Column | None) -> DataFrame:
    """What the sampling needs of each row: _id, _key, _source, _size, its importance _w and the random number _u in (0, 1)."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    weight = F.lit(1.0)
    if importance is not None:
        given = importance.cast("double")
        weight = F.when((given > 0) & ~F.isnan(given) & (given < float("inf")), given).otherwise(0.0)
    return docs.withColumns({"_id": F.col("doc_id"), "_key": source_key(F.col("source")), "_source": F.col("source"), "_size": words(F.col("text")), "_w": weight, "_u": u})


def _expected(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """Adds what is known of a row's source, the whole copies _whole and the fraction _f."""
    expected = F.when(F.col("_w") > 0, F.least(F.col("_most"), F.col("_lambda") * F.col("_w"))).otherwise(0.0)
    rows = rows.join(small(by_source), "_key").withColumn("_e", expected)
    return rows.withColumns({"_whole": F.floor("_e"), "_f": F.col("_e") - F.floor("_e")}).drop("_e")


def _ranked(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """Adds the Pareto rank _p in (0, 1) (null: no fraction to fill, or no words) and its bucket _b."""
    odds = (F.col("_u") / (F.lit(1.0) - F.col("_u"))) / (F.col("_f") / (F.lit(1.0) - F.col("_f")))
    rank = F.when((F.col("_f") > 0) & (F.col("_size") > 0), odds / (F.lit(1.0) + odds))
    rows = _expected(rows, by_source).withColumn("_p", rank)
    return rows.withColumn("_b", F.least(F.floor(F.col("_p") * (LEVEL * LEVEL)), F.lit(LEVEL * LEVEL - 1)))


def _levels(facts: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """Adds _lambda, the copies of a document of importance 1, to sources: that at which each meets its target with no document
    above ``cap``. Each round sums what isn't capped yet; capped documents stay so, and rounds end when none is added."""
    level = sources.withColumn("_lambda", F.lit(0.0))
    while True:
        above = F.col("_lambda") * F.col("_w") >= cap
        free = F.sum(F.when(~above, F.col("_w") * F.col("_size")).otherwise(0.0))
        held = F.sum(F.when(above, F.col("_size")).otherwise(0)) * cap
        sums = facts.join(small(level.select("_key", "_lambda")), "_key").groupBy("_key").agg(free.alias("_free"), held.alias("_held"), F.count_if(above).alias("_n"))
        new = F.when(F.col("_free") > 0, F.greatest(F.lit(0.0), F.col("target") - F.col("_held")) / F.col("_free")).otherwise(F.col("_lambda"))
        level = written(sources.join(level.select("_key", F.col("_lambda")), "_key").join(sums, "_key").select(*sources.columns, F.greatest("_lambda", new).alias("_lambda"), F.col("_lambda").alias("_old")), "mix-levels")
        if level.where(F.col("_lambda") > F.col("_old") * (1 + 1e-12)).isEmpty():
            return level.drop("_old")


def _reached(rows: DataFrame, by: str) -> DataFrame:
    """Per source the first bucket ``by`` at whose end more than _rest words are taken, and the words _done before it."""
    sums = rows.groupBy("_key", "_rest", "_done", by).agg(F.sum("_size").alias("_s"))
    ends = sums.withColumn("_end", F.sum("_s").over(Window.partitionBy("_key").orderBy(by)) + F.col("_done"))
    first = F.min_by(F.struct(F.col(by), (F.col("_end") - F.col("_s")).alias("_next")), by).alias("_x")
    return written(ends.where(F.col("_end") > F.col("_rest")).groupBy("_key").agg(first).select("_key", F.col("_x")[by].alias(by), F.col("_x._next").alias("_done")), "mix-cut")


def plan(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, cap: int = 3, seed: str = "mix", importance: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The two small tables that decide every row: target, level of copies and words left to fill per source; the last rank taken per source."""
    own = docs.select("doc_id", "source", "text", *([] if importance is None else [importance.alias("_i")]))
    facts = written(_facts(own, seed, None if importance is None else F.col("_i")).select("_id", "_key", "_source", "_size", "_w", "_u"), "mix-sizes")
    sums = facts.groupBy("_key").agg(F.first("_source").alias("source"), F.sum("_size").alias("source_size"))
    aims = targets(sums, weights, share, cap)
    if importance is None:
        ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
        levels = aims.withColumn("_lambda", ratio).withColumn("_rest", F.col("target") - F.floor("_lambda") * F.col("source_size"))
    else:
        levels = _levels(facts, written(aims, "mix-aims"), cap)
        certain = _expected(facts, levels.withColumn("_most", F.lit(float(cap)))).groupBy("_key").agg(F.sum(F.col("_whole") * F.col("_size")).alias("_sure"))
        levels = levels.join(certain, "_key").withColumn("_rest", F.col("target") - F.col("_sure"))
    by_source = written(levels.select("_key", "source_size", "target", "_lambda", "_rest", F.lit(float(cap)).alias("_most")), "mix-sources")
    part = _ranked(facts, by_source).where(F.col("_b").isNotNull()).select("_key", "_rest", "_size", "_p", "_id", "_b", F.floor(F.col("_b") / LEVEL).alias("_b1"))
    coarse = _reached(part.withColumn("_done", F.lit(0).cast("long")), "_b1")
    fine = _reached(part.join(small(coarse), ["_key", "_b1"]), "_b")
    last = part.join(small(fine), ["_key", "_b"])
    middle = F.sum("_size").over(Window.partitionBy("_key").orderBy("_p", "_id")) + F.col("_done") - F.sum("_size").over(Window.partitionBy("_key", "_p", "_id")) / 2
    kept = last.withColumn("_mid", middle).where(F.col("_mid") <= F.col("_rest")).groupBy("_key").agg(F.max(F.struct("_p", "_id")).alias("_cut"))
    return by_source, written(fine.join(kept, "_key", "left").select("_key", F.col("_b").alias("_at"), "_cut"), "mix-cut")


def _copies(rows: DataFrame, by_source: DataFrame, cut: DataFrame) -> DataFrame:
    inside = F.col("_at").isNull() | (F.col("_b") < F.col("_at")) | ((F.col("_b") == F.col("_at")) & (F.struct("_p", "_id") <= F.col("_cut")))
    extra = F.when(F.col("_b").isNotNull() & inside, 1).otherwise(0)
    return _ranked(rows, by_source).join(small(cut), "_key", "left").withColumn("_copies", (F.col("_whole") + extra).cast("int"))


def decide(docs: DataFrame, **how) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken (size times copies), copies."""
    by_source, cut = plan(docs, **how)
    given = how.get("importance")
    own = docs.select("doc_id", "source", "text", *([] if given is None else [given.alias("_i")]))
    rows = _facts(own, how.get("seed", "mix"), None if given is None else F.col("_i")).select("_id", "_key", "_size", "_w", "_u")
    return _copies(rows, by_source, cut).select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("_copies")).alias("taken"), F.col("_copies").alias("copies"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the same columns."""
    by_source, cut = plan(docs, **how)
    given = how.get("importance")
    packed = docs.select(F.struct("*").alias("_row"), "doc_id", "source", "text", *([] if given is None else [given.alias("_i")]))
    rows = _facts(packed, how.get("seed", "mix"), None if given is None else F.col("_i")).select("_row", "_id", "_key", "_size", "_w", "_u")
    taken = _copies(rows, by_source, cut).where(F.col("_copies") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_n")).select("_row.*")


def op10_pareto_mixing(spark, sf_dir: str) -> DataFrame:
    return decide(table(spark, sf_dir, "documents"))


SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint + 0.5e0) / 4503599627370496e0 as u
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
n as (select *, row_number() over (order by (source is null)::int, source) as n from s),
w as (select *, ((n - 1) % 3 + 1)::bigint as w, source_size * 3 as cap from n),
l as (
  select *, (sum(source_size) over all_rows * 1e0 - coalesce(sum(cap) over earlier, 0)::double) / (sum(w) over all_rows - coalesce(sum(w) over earlier, 0))::double as level
  from w
  window all_rows as (order by cap::double / w::double, n rows between unbounded preceding and unbounded following),
         earlier as (order by cap::double / w::double, n rows between unbounded preceding and 1 preceding)),
v as (select min_by(level, cap::double / w::double) as level from l where level * w <= cap),
t as (select l.source, source_size, coalesce(least(cap::double, v.level * w), cap::double) as target from l, v),
f as (select *, case when source_size > 0 then target / source_size::double else 0e0 end as r from t),
p as (
  select d.*, f.source_size, f.target, floor(r)::bigint as whole, f.target - floor(r) * f.source_size as rest, r - floor(r) as frac
  from d join f on d.source is not distinct from f.source),
k as (
  select *, case when frac > 0 and size > 0 then (u / (1e0 - u)) / (frac / (1e0 - frac)) end as odds from p),
c as (
  select *, sum(size) over (partition by source, odds is null order by odds / (1e0 + odds), doc_id) - sum(size) over (partition by source, odds, doc_id) / 2e0 as mid from k)
select doc_id, size, source_size, target,
       size * (whole + case when odds is not null and mid <= rest then 1 else 0 end)::bigint as taken,
       (whole + case when odds is not null and mid <= rest then 1 else 0 end)::int as copies
from c
"""
