"""Sequence search: seeds summed by diagonal, ungapped segments, banded local alignment, e-values.

Words of two sequences that agree are joined and counted per (query, target, strand, diagonal); a pair goes on by its best
diagonals. Both ends' letters come to it then, the best ungapped segment of each diagonal and the alignment around it run on batches of pairs inside tasks, and
targets are cut to the best by score after all are scored.

Equal sequences are one in the search. A word of more than HOT sequences is dealt to as many shares of its sequences as it
needs, each against all of them, so no task holds one word's pairs. What is not found: pairs without a common word of the
scoring's k letters (proteins: two on one diagonal), or whose ungapped segments stay below ``trigger``, and what lies farther
than BAND from all diagonals that go on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import local
from ..functions.local import NUCLEOTIDE, PROTEIN, Scoring
from .graphs import cut_lineage

#: Sequences of a word that one share takes; diagonals of a pair that go on; letters beside them that a band holds; diagonals
#: within NEAR of the best one that share its band.
HOT, DIAGONALS, BAND, NEAR = 256, 3, 20, 64
HIT = "query string, qlen int, target string, tlen int, qframe int, pident double, nident int, alnlen int, mismatch int, gapopen int, qstart int, qend int, tstart int, tend int, evalue double, bits double"


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """``df`` in as many parts as the session shuffles to: what is few bytes here may still be much work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _distinct(sequences: DataFrame) -> DataFrame:
    """c (number of a text), sequence."""
    return dealt(sequences.where(F.length("sequence") > 0).select("sequence").distinct().select(F.xxhash64("sequence").alias("c"), "sequence"), "c")


def _words(texts: DataFrame, scoring: Scoring) -> DataFrame:
    """c, n (letters), word, at, turned."""
    import pandas as pd

    def run(frames):
        for frame in frames:
            out = []
            for c, text in zip(frame["c"], frame["sequence"], strict=True):
                codes = scoring.codes(text)
                word, at, turned = local.seeds_of(codes, scoring)
                out.append(pd.DataFrame({"c": c, "n": len(codes), "word": word, "at": at, "turned": turned}))
            yield pd.concat(out) if out else pd.DataFrame({"c": [], "n": [], "word": [], "at": [], "turned": []})

    return texts.select("c", "sequence").mapInPandas(run, "c long, n int, word long, at int, turned boolean")


def seed_pairs(queries: DataFrame, targets: DataFrame | None, scoring: Scoring) -> DataFrame:
    """q, t, turned, diagonal, seeds: the DIAGONALS best diagonals of pairs of texts; without ``targets`` each pair once, q < t.

    A diagonal is the place in the target less that in the query, which is read on its other strand where ``turned``.
    """
    left = cut_lineage(_words(queries, scoring), "words")
    right = left if targets is None else cut_lineage(_words(targets, scoring), "words")
    often = right.groupBy("word").agg(F.count("*").alias("size"))
    shares = often.where(F.col("size") > HOT).select("word", F.ceil(F.col("size") / HOT).cast("int").alias("shares"))
    shares = cut_lineage(shares, "hot-words")
    with_shares = lambda w: w.join(shares, "word", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
    one = with_shares(left).withColumn("share", F.pmod(F.xxhash64("c"), F.col("shares")).cast("int")).select("word", "share", F.col("c").alias("q"), F.col("n").alias("qn"), F.col("at").alias("qat"), F.col("turned").alias("qturned"))
    two = with_shares(right).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).select("word", "share", F.col("c").alias("t"), F.col("at").alias("tat"), F.col("turned").alias("tturned"))
    met = one.join(two, ["word", "share"]).where(F.col("q") < F.col("t") if targets is None else F.lit(True))
    turned = F.col("qturned") != F.col("tturned")
    place = F.when(turned, F.col("qn") - scoring.k - F.col("qat")).otherwise(F.col("qat"))
    found = met.select("q", "t", turned.alias("turned"), (F.col("tat") - place).alias("diagonal"))
    sums = found.groupBy("q", "t", "turned", "diagonal").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= scoring.seeds)
    best = Window.partitionBy("q", "t").orderBy(F.col("seeds").desc(), "turned", "diagonal")
    return sums.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= DIAGONALS).drop("nth")


def scored_pairs(pairs: DataFrame, queries: DataFrame, targets: DataFrame, scoring: Scoring, trigger: int) -> DataFrame:
    """q, t, turned, qn, tn and the fields of the best local alignment of each pair, places on the strand that was read."""
    import pandas as pd

    lists = pairs.groupBy("q", "t").agg(F.collect_list(F.struct("turned", "diagonal")).alias("diagonals"))
    side = lambda texts, c, name: texts.select(F.col("c").alias(c), F.col("sequence").alias(name))
    both = dealt(lists, "q", "t").join(side(queries, "q", "x"), "q").join(side(targets, "t", "y"), "t")
    schema = "q long, t long, turned boolean, qn int, tn int, " + ", ".join(f"{f} int" for f in local.FIELDS)

    def run(frames):
        for frame in frames:
            rows, jobs = [], []
            for q, t, diagonals, x, y in frame[["q", "t", "diagonals", "x", "y"]].itertuples(index=False):
                a, b = scoring.codes(x), scoring.codes(y)
                sides = {False: a}
                tried = []
                for d in diagonals:
                    if d["turned"] not in sides:
                        sides[d["turned"]] = local.opposite(a)
                    tried.append((d["turned"], *local.segment(sides[d["turned"]], b, d["diagonal"], scoring), d["diagonal"]))
                # the best diagonal of each strand
                for strand in {x[0] for x in tried}:
                    own = [x[1:] for x in tried if x[0] == strand]
                    score, start, end, best = max(own)
                    if score >= trigger:
                        near = [x[-1] for x in own if abs(x[-1] - best) <= NEAR]
                        rows.append((q, t, strand, len(a), len(b)))
                        jobs.append((sides[strand], b, min(near) - BAND, max(near) + BAND, start, end))
            found = pd.DataFrame(rows, columns=["q", "t", "turned", "qn", "tn"])
            aligned = pd.DataFrame(local.align_around(jobs, scoring) if jobs else np.empty((0, len(local.FIELDS)), int), columns=local.FIELDS)
            yield pd.concat([found, aligned], axis=1)

    found = both.mapInPandas(run, schema)
    return found.where(F.col("score") > 0)


def _hits(found: DataFrame, letters: int, scoring: Scoring, evalue: float) -> DataFrame:
    """The columns of a hit from q, t, turned, qn, tn and fields; places on the query are counted on its given strand, downwards where it was turned."""
    e = F.lit(scoring.kappa) * F.col("qn") * F.lit(float(letters)) * F.exp(-F.lit(scoring.lam) * F.col("score"))
    bits = (F.lit(scoring.lam) * F.col("score") - F.log(F.lit(scoring.kappa))) / F.log(F.lit(2.0))
    place = lambda c: F.when(F.col("turned"), F.col("qn") + 1 - F.col(c)).otherwise(F.col(c)).alias(c)
    rows = found.withColumns({"evalue": e, "bits": bits}).where(F.col("evalue") <= evalue)
    return rows.select("q", "t", "qn", "tn", F.when(F.col("turned"), -1).otherwise(1).alias("qframe"), (F.col("nident") * 100.0 / F.col("alnlen")).alias("pident"), "nident", "alnlen", "mismatch", "gapopen", place("qstart"), place("qend"), "tstart", "tend", "evalue", "bits")


def _named(hits: DataFrame, queries: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """Hits of texts as hits of the sequences that have them, each query's ``most`` best of other names."""
    own = lambda s, c, name: s.where(F.length("sequence") > 0).select(F.xxhash64("sequence").alias(c), F.col("seq_id").alias(name))
    names = own(targets, "t", "target")
    # of equal targets no more than can be among the best
    names = names.withColumn("nth", F.row_number().over(Window.partitionBy("t").orderBy("target"))).where(F.col("nth") <= most + 1).drop("nth")
    order = [F.col("bits").desc(), "target", "qframe"]
    best = hits.join(names, "t").join(own(queries, "q", "query"), "q").where(F.col("query") != F.col("target"))
    best = best.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("nth") <= most)
    return best.select("query", F.col("qn").alias("qlen"), "target", F.col("tn").alias("tlen"), *(c.split()[0] for c in HIT.split(", ")[4:]))


def all_by_all(sequences: DataFrame, scoring: Scoring = NUCLEOTIDE, evalue: float = 10.0, targets: int = 1000, trigger: int = 0) -> DataFrame:
    """The columns of HIT for every two of (seq_id, sequence), one hit a pair and strand; both directions are given.

    Empty and null sequences have no hits; a sequence is no hit of itself, equal ones are hits of each other; of hits that
    score the same the smaller target goes first.
    """
    texts = cut_lineage(_distinct(sequences), "texts")
    letters = sequences.agg(F.sum(F.length("sequence"))).first()[0] or 1
    copies = sequences.where(F.length("sequence") > 0).groupBy(F.xxhash64("sequence").alias("c")).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
    equal = copies.select(F.col("c").alias("q"), F.col("c").alias("t"), F.lit(False).alias("turned"), F.lit(0).alias("diagonal"), F.lit(1).cast("long").alias("seeds"))
    pairs = seed_pairs(texts, None, scoring).select("q", "t", "turned", "diagonal", "seeds").union(equal)
    found = cut_lineage(scored_pairs(pairs, texts, texts, scoring, trigger), "scored")
    names = ["qstart", "qend", "tstart", "tend"]
    # seen from the target, a turned pair is the same alignment read backwards
    other = {"qstart": F.when(F.col("turned"), F.col("tn") + 1 - F.col("tend")).otherwise(F.col("tstart")), "qend": F.when(F.col("turned"), F.col("tn") + 1 - F.col("tstart")).otherwise(F.col("tend")), "tstart": F.when(F.col("turned"), F.col("qn") + 1 - F.col("qend")).otherwise(F.col("qstart")), "tend": F.when(F.col("turned"), F.col("qn") + 1 - F.col("qstart")).otherwise(F.col("qend"))}
    rest = [c for c in found.columns if c not in {"q", "t", "qn", "tn", *names}]
    back = found.where(F.col("q") != F.col("t")).select(F.col("t").alias("q"), F.col("q").alias("t"), F.col("tn").alias("qn"), F.col("qn").alias("tn"), *(c.alias(n) for n, c in other.items()), *rest)
    return _named(_hits(found.select(*back.columns).union(back), letters, scoring, evalue), sequences, sequences, targets)


def search(queries: DataFrame, targets: DataFrame, scoring: Scoring = PROTEIN, evalue: float = 10.0, most: int = 1000, trigger: int = 30) -> DataFrame:
    """The columns of HIT for each query's ``most`` best of other names among the targets."""
    one, two = cut_lineage(_distinct(queries), "texts"), cut_lineage(_distinct(targets), "texts")
    letters = targets.agg(F.sum(F.length("sequence"))).first()[0] or 1
    found = scored_pairs(seed_pairs(one, two, scoring), one, two, scoring, trigger)
    return _named(_hits(found, letters, scoring, evalue), queries, targets, most)


def busco_search(contigs: DataFrame, proteins: DataFrame, evalue: float = 1e-5, targets: int = 1) -> DataFrame:
    """The columns of HIT for nucleotide contigs on reference proteins: each contig's best ``targets`` by bits over its six
    reading frames, qframe the frame, places on the query counted in its protein."""
    from .kernels import frames_of

    frames = cut_lineage(frames_of(contigs), "frames")
    # a frame's best targets are among the best of all frames
    found = search(frames.select("seq_id", "sequence"), proteins, PROTEIN, evalue, targets, trigger=40)
    found = found.drop("qframe").join(frames.select(F.col("seq_id").alias("query"), "contig", F.col("frame").alias("qframe")), "query").drop("query").withColumnRenamed("contig", "query")
    best = Window.partitionBy("query").orderBy(F.col("bits").desc(), "target", "qframe")
    return found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= targets).select(*(c.split()[0] for c in HIT.split(", ")))
