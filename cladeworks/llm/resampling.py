"""Importance resampling towards a target text distribution, with hashed n-grams by an algebra of CRCs.

Words are hashed once. The CRC-32 of a joined text follows from those of its parts:
crc(a + b) = M^len(b) crc(a) xor crc(b), where M is the 32 x 32 matrix over GF(2) that
one zero byte means. So the CRCs of two and three words are a few table look-ups on
arrays of numbers, and no n-gram is ever a string. Only single words of LONG bytes or
more are hashed alone.

Features are counted per bucket inside tasks and summed by Spark (at most ``buckets`` rows a
task); the gains of the buckets, a table of fixed size, travel to the second pass, which reads the
texts again instead of keeping anything per n-gram. Texts are worked through PIECE bytes at a time, whatever
their length: of what came before, two words' CRCs and lengths are all a piece needs.
Draws are Gumbel keys (weight plus noise of the identifier); rows are ordered by ranges, each range numbered
behind the count of those before it, so no task sees all rows.

Defined results: null and empty texts have no features, weight 0, and are never drawn (fewer than ``least_words``
words); a null identifier hashes as the empty string and goes first among ties; rows that repeat an identifier are
scored and ranked each; equal rows share their ranks in any order; an empty target or corpus counts as 0 features; an empty table gives no rows; columns of other
names are not read, but kept by :func:`drawn`.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import scratch, table, text_bytes, written

BUCKETS, LONGEST, SCALE = 10_000, 3, 1000
PIECE, LONG = 1 << 20, 64
#: The reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320


def _product(matrix: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A 32 x 32 matrix over GF(2), as the images of the 32 single bits, times vectors of 32 bits."""
    bits = (vectors[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
    return np.bitwise_xor.reduce(np.where(bits != 0, matrix, np.uint32(0)), axis=1)


def _lookup(matrix: np.ndarray) -> np.ndarray:
    """The matrix as four tables of 256 products, one for each byte of a vector."""
    byte = np.arange(256, dtype=np.uint32)
    return np.concatenate([_product(matrix, byte << np.uint32(8 * k)) for k in range(4)])


def _one_byte() -> np.ndarray:
    image = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(8):
        image = np.where(image & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0)) ^ (image >> np.uint32(1))
    return image


def _shifts() -> tuple[np.ndarray, list[np.ndarray]]:
    """Look-up tables for 0 to LONG - 1 zero bytes in one array, and for LONG, 2 LONG, 4 LONG ... of them."""
    one = _one_byte()
    power, short = np.uint32(1) << np.arange(32, dtype=np.uint32), []
    for _ in range(LONG):
        short.append(_lookup(power))
        power = _product(one, power)
    longer = []
    for _ in range(34):
        longer.append(_lookup(power))
        power = _product(power, power)
    return np.concatenate(short), longer


SHORT, LONGER = _shifts()
TABLE = SHORT[1024:1280]  # one byte through the register
SPACE = np.uint32(zlib.crc32(b" "))


def _apply(tables: np.ndarray, at: np.ndarray | int, crc: np.ndarray) -> np.ndarray:
    out = tables[at + (crc & 255)]
    for k in (1, 2, 3):
        out = out ^ tables[at + 256 * k + ((crc >> np.uint32(8 * k)) & 255)]
    return out


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What each CRC adds to that of a text which goes on for ``lengths`` bytes more."""
    out = _apply(SHORT, (lengths % LONG) * 1024, crc)
    rest = lengths // LONG
    if rest.any():
        for k, tables in enumerate(LONGER):
            on = np.flatnonzero((rest >> k) & 1)
            out[on] = _apply(tables, 0, out[on])
    return out


def spaced(crc: np.ndarray) -> np.ndarray:
    """The CRCs of the same texts with a space at their end."""
    return _apply(SHORT, 1024, crc) ^ SPACE


def word_crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each word, byte after byte for all words at once."""
    order = np.argsort(-np.minimum(lengths, LONG).astype(np.int16), kind="stable")
    at, size = starts[order], lengths[order]
    crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
    long = int((size >= LONG).sum())
    left = np.searchsorted(-size, -np.arange(1, LONG), side="right")
    for k in range(LONG - 1):
        if left[k] <= long:
            break
        c = crc[long : left[k]]
        crc[long : left[k]] = TABLE[(c ^ data[at[long : left[k]] + k]) & 255] ^ (c >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = ~crc
    for k in order[:long].tolist():
        out[k] = zlib.crc32(data[starts[k] : starts[k] + lengths[k]])
    return out


#: A-Z as a-z; what is part of a word: digits, small letters, all beyond ASCII.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[ord("0") : ord("9") + 1] = _INSIDE[ord("a") : ord("z") + 1] = _INSIDE[128:] = True


def _pieces(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ends of pieces of about ``size`` bytes, none of which cuts a word."""
    at = 0
    while at < len(data):
        to = min(at + size, len(data))
        if to < len(data):
            stop = int(offsets[np.searchsorted(offsets, to)])
            while to < stop:
                outside = np.flatnonzero(~_INSIDE[_LOWER[data[to : min(to + size, stop)]]])
                if len(outside):
                    to += int(outside[0])
                    break
                to = min(to + size, stop)
        yield at, to
        at = to


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS, size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets and text numbers of one piece after the other: (buckets of words; of two words, of three words that end there or -1; text number)."""
    crc, length, text = np.zeros(2, np.uint32), np.zeros(2, np.int64), np.array([-2, -1])
    for at, to in _pieces(data, offsets, size):
        own = _LOWER[data[at:to]]
        inside = np.zeros(len(own) + 2, bool)
        inside[1:-1] = _INSIDE[own]
        cut = offsets[np.searchsorted(offsets, at, side="right") : np.searchsorted(offsets, to)] - at
        first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        first[cut] = inside[cut + 1]
        last[cut - 1] = inside[cut]
        starts = np.flatnonzero(first)
        lengths = np.flatnonzero(last) + 1 - starts
        crc = np.concatenate([crc[-2:], word_crcs(own, starts, lengths)])
        length = np.concatenate([length[-2:], lengths])
        text = np.concatenate([text[-2:], np.searchsorted(offsets, starts + at, side="right") - 1])
        two = shifted(spaced(crc[:-1]), length[1:]) ^ crc[1:]
        three = shifted(spaced(two[:-1]), length[2:]) ^ crc[2:]
        near = text[1:] == text[:-1]
        number = lambda c, ok: np.where(ok, (c % np.uint32(buckets)).astype(np.int64), -1)
        yield (crc[2:] % np.uint32(buckets)).astype(np.int64), number(two[1:], near[1:]), number(three, near[1:] & near[:-1]), text[2:]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how often all features of column ``text`` fall into each bucket; buckets without any are left out."""
    import pyarrow as pa

    def count(batches):
        n = np.zeros(buckets + 1, np.int64)
        for b in batches:
            for grams in features(*text_bytes(b.column(0)), buckets):
                for g in grams[:3]:
                    n += np.bincount(g + 1, minlength=buckets + 1)
        at = np.flatnonzero(n[1:])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[1:][at])], ["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln(share of the bucket in the target / share in the corpus)), each count one up, as an array of ``buckets`` numbers."""

    def counted(texts: DataFrame) -> list[int]:
        n = [0] * buckets
        for row in bucket_counts(texts, buckets).collect():  # at most a row a bucket
            n[row["bucket"]] = row["n"]
        return n

    s, t = counted(docs), counted(target)
    total, aim = float(sum(s)), float(sum(t))
    gain = lambda a, b: math.floor(SCALE * math.log((b + 1.0) * (total + buckets) / ((a + 1.0) * (aim + buckets))))
    return np.array([gain(a, b) for a, b in zip(s, t, strict=True)], np.int64)


def _noise(seed: int, doc_id: int | None) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, seed: int = 42) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of each row of (doc_id, text)."""
    import pyarrow as pa

    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    extra = np.append(gains, 0)  # -1 is no feature

    def score(batches):
        for b in batches:
            words, n, weight = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for one, two, three, text in features(*text_bytes(b.column(1)), len(gains)):
                if len(text):
                    lo = int(text[0])
                    at = text - lo
                    per = lambda x: np.bincount(at, x).astype(np.int64)
                    here = np.bincount(at)
                    span = slice(lo, lo + len(here))
                    words[span] += here
                    n[span] += per(1.0 + (two >= 0) + (three >= 0))
                    weight[span] += per((extra[one] + extra[two] + extra[three]).astype(float))
            noise = np.array([_noise(seed, i) for i in b.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, (words, n, weight, weight + noise))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, ", ".join(f"{x} long" for x in names))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_features, weight, score, rank: the floor(percent / 100 * N) best scores of the N rows with enough words are drawn and have a rank."""
    with scratch(docs.sparkSession):
        rows = scored(docs, bucket_gains(docs, target, buckets), seed).withColumn("may", F.col("n_words") >= least_words)
        rows = written(rows.drop("n_words").withColumn("nth", F.monotonically_increasing_id()), "resample-scores")
        drawn = rows.where("may").count() * percent // 100
        order = [F.col("may").desc(), F.col("score").desc(), F.col("doc_id"), F.col("n_features"), F.col("nth")]
        ranges = written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "resample-ranges")
        sizes = ranges.groupBy("part").agg(F.count("*").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        number = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("before")
        placed = ranges.join(sizes.select("part", before.alias("before")), "part").withColumn("number", number)
        rank = F.when(F.col("may") & (F.col("number") <= drawn), F.col("number")).cast("long")
        return written(placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank")), "resampled", keep=True)


def drawn(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` whose identifier is drawn, with all their columns."""
    chosen = resampled(docs, target, **how).where(F.col("rank").isNotNull()).select("doc_id").distinct()
    return docs.join(chosen, "doc_id", "left_semi")


def op11_crc_resampling(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark texts."""
    return resampled(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))
