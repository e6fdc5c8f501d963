"""Toxicity of whole texts, read through a noisy-channel restoration of disguised words.

A character trigram model is counted over all documents (a table of at most 64^3
counts, whatever the corpus). A disguised token - signs or digits for letters,
letters spaced out, letters repeated - becomes a lattice of the letters each sign may
stand for; the Viterbi path under channel costs and the character model is its
restored form. Plain words pass unchanged: for them the channel's identity path costs
nothing.

Words and word beginnings of the restored text are weighed by the log-odds of their
presence in toxic texts of the training rows; a logistic curve turns a text's weights
into a score. The weights come from a bounded sample of labelled training rows (``sample``,
the rows of smallest hash); the curve is fitted to each half of it under weights of the
other half, so that it has seen weights only on texts they don't come from.

Defined results: null or empty text scores as a text without evidence; a null
identifier counts as the empty string in the split; repeated rows are scored each;
without labels of both kinds every score is 0; empty tables give no rows; columns of
other names are not read, and identifier, source, language and label are never inputs
of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, written

SAMPLE, THRESHOLD = 20_000, 0.3
ALPHABET = 64
FIRST_ACCENTED, LAST_ACCENTED = 0xDF, 0xFF
OTHER = 27 + LAST_ACCENTED - FIRST_ACCENTED + 1
#: Letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "aeiou",
}
BREAKS = " .-_'*~^"
SIGN_COST, DROP_COST, REPEAT_COST, BREAK_COST = 1.0, 0.7, 0.3, 3.0
LETTER = "a-zß-öø-ÿ"
#: Letters with any sign or break among or beside them, other signs between letters, or a letter three times.
_MIXED = "".join(re.escape(c) for c in {*SIGNS, *BREAKS} - {" "})
DISGUISED = re.compile(rf"[{LETTER}][^\s{LETTER},;:?\"]{{1,3}}[{LETTER}]|[{LETTER}]\S*[{_MIXED}]|[{_MIXED}]\S*[{LETTER}]|([{LETTER}])\1\1")
SPACED = re.compile(rf"(?<!\S)[{LETTER}0-9@$!](?:[ .*_-][{LETTER}0-9@$!]){{3,}}(?!\S)")
EDGE = re.compile(rf"^[^{LETTER}0-9@$!|+(<€£¡]+|[^{LETTER}0-9@$]+$")
#: What repeats over three times says no more than three.
REPEATED = re.compile(r"(\S)\1{3,}")


def _symbols() -> np.ndarray:
    """Symbol of each code point: 0 for what ends a word, then a-z, accented Latin letters, and one for all other letters."""
    out = np.zeros(0x250, np.int64)
    out[ord("a") : ord("z") + 1] = np.arange(1, 27)
    out[FIRST_ACCENTED : LAST_ACCENTED + 1] = np.arange(27, OTHER)
    out[[0xF7]] = 0
    out[0x100:] = OTHER
    return out


def trigram_counts(texts: list[str], table_: np.ndarray) -> np.ndarray:
    points = np.frombuffer((" \n " + " \n ".join(texts) + " ").lower().encode("utf-32-le", "replace"), np.uint32)
    s = table_[np.minimum(points, len(table_) - 1)]
    return np.bincount(s[:-2] * ALPHABET**2 + s[1:-1] * ALPHABET + s[2:], minlength=ALPHABET**3)


class Channel:
    """Restores disguised tokens under a character model given as trigram counts."""

    def __init__(self, counts: np.ndarray):
        c3 = counts.reshape(ALPHABET, ALPHABET, ALPHABET).astype(np.float64)
        c2, c1 = c3.sum(0), c3.sum((0, 1))
        p1 = (c1 + 1) / (c1.sum() + ALPHABET)
        p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
        self.logp = np.log((c3 + 5 * p2) / (c3.sum(2, keepdims=True) + 5)).tolist()
        self.symbol = _symbols().tolist()

    def _of(self, c: str) -> int:
        return self.symbol[min(ord(c), 0x24F)]

    def options(self, token: str, i: int) -> list[tuple[str, float]]:
        """What the i-th sign may stand for ('' for nothing, ' ' for the end of a word) and the channel's cost."""
        c = token[i]
        run = 1
        while i - run >= 0 and token[i - run] == c:
            run += 1
        after = 1
        while i + after < len(token) and token[i + after] == c:
            after += 1
        if c.isalpha():
            return [(c, 0.0), ("", REPEAT_COST)] if run > 1 and run + after - 1 > 2 else [(c, 0.0)]
        found = [(x, SIGN_COST) for x in SIGNS.get(c, "")]
        if c in BREAKS or not found:
            found.append(("", DROP_COST))
        elif run > 1 and run + after - 1 > 2:
            found.append(("", REPEAT_COST))
        if c in BREAKS:
            found.append((" ", BREAK_COST))
        return found

    def decode(self, token: str) -> str:
        """The best path's letters; words that it separates are joined by a blank."""
        states = {(0, 0): (0.0, "")}
        for i in range(len(token)):
            new: dict[tuple[int, int], tuple[float, str]] = {}
            for put, cost in self.options(token, i):
                for (a, b), (so_far, text) in states.items():
                    if not put:
                        key, value = (a, b), so_far - cost
                    else:
                        z = self._of(put)
                        key, value = (b, z), so_far - cost + self.logp[a][b][z]
                    if key not in new or new[key][0] < value:
                        new[key] = (value, text + put)
            states = new
        return max(((v + self.logp[a][b][0], t) for (a, b), (v, t) in states.items()), default=(0, ""))[1]

    def word(self, token: str) -> str:
        """The restored form of one token without blanks; the token itself if it isn't disguised."""
        core = EDGE.sub("", token)
        return self.decode(REPEATED.sub(r"\1\1\1", core)) if len(core) > 2 and DISGUISED.search(core) else core

    def restore(self, text: str) -> str:
        """The whole text, lower-cased, with disguised tokens restored."""
        text = SPACED.sub(lambda m: self.decode(m[0]), text.lower())
        return re.sub(r"\S+", lambda m: self.word(m[0]) if DISGUISED.search(EDGE.sub("", m[0])) else m[0], text)


def features(word: str) -> list[str]:
    """The word and its beginnings of 4 to 8 letters."""
    return [word, *(f"{word[:k]}-" for k in range(4, 9) if len(word) > k)]


class Reader:
    """Distinct restored words of texts, with what ``of`` makes of each word kept."""

    KEEP = 500_000

    def __init__(self, channel: Channel, of):
        self.channel, self.of, self.cache = channel, of, {}

    def read(self, text: str | None) -> list:
        text = (text or "").lower()
        words = set(text.split())
        for m in SPACED.finditer(text):
            words.update(self.channel.decode(m[0]).split())
        cache = self.cache
        if len(cache) > self.KEEP:
            cache.clear()
        out = []
        for w in words:
            x = cache.get(w)
            if x is None:
                x = cache[w] = self.of(self.channel.word(w).split())
            out.append(x)
        return out


def _evidence(weights: dict[str, float]):
    return lambda words: max((weights.get(f, 0.0) for w in words for f in features(w)), default=0.0)


def summary(evidence: list[float]) -> tuple[float, float, float]:
    """What the curve sees of a text: its largest and second weight, and the damped sum of weights."""
    hits = sorted((x for x in evidence if x > 0), reverse=True)
    return (hits[0], hits[1] if len(hits) > 1 else 0.0, math.log1p(sum(hits))) if hits else (0.0, 0.0, 0.0)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def character_model(docs: DataFrame) -> np.ndarray:
    """Trigram counts over all documents."""
    import pyarrow as pa

    def count(batches):
        symbols, total = _symbols(), np.zeros(ALPHABET**3, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 200):
                total += trigram_counts([t for t in b.column(0).slice(at, 200).to_pylist() if t], symbols)
        codes = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int32()), pa.array(total[codes], pa.int64())], names=["code", "n"])

    out = np.zeros(ALPHABET**3, np.int64)
    for code, n in docs.select("text").mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n")).collect():
        out[code] = n
    return out


def _fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; the first coefficient is the constant."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """(channel counts, weights, curve) from training rows of ``labels`` (columns doc_id, toxic); None without both kinds."""
    import pyarrow as pa

    counts = character_model(docs)
    chosen = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic"))
    chosen = written(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "toxic-sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.col("text").isNotNull())
    rows = rows.groupBy(F.xxhash64("text").alias("_h")).agg(F.max("_toxic").alias("toxic"), F.first("text").alias("text"))
    rows = written(rows.select("text", "toxic", (F.pmod("_h", F.lit(2)) == 0).alias("half")), "toxic-sample")

    def presence(batches):
        reader, seen = Reader(Channel(counts), lambda words: [f for w in words for f in features(w)]), {(h, y): Counter() for h in (False, True) for y in (False, True)}
        for b in batches:
            for text, toxic, half in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                seen[half, toxic > 0].update({f for fs in reader.read(text) for f in fs})
        names = list(set().union(*seen.values()))
        kinds = {f"{'b' if h else 'a'}{int(y)}": c for (h, y), c in seen.items()}
        yield pa.RecordBatch.from_pydict({"f": names} | {k: [c[f] for f in names] for k, c in kinds.items()}, schema=pa.schema([("f", pa.string()), *((k, pa.int64()) for k in kinds)]))

    n = {bool(r.half): (r.n, r.n1) for r in rows.groupBy("half").agg(F.count("*").alias("n"), F.sum("toxic").alias("n1")).collect()}
    (n_a, a1), (n_b, b1) = n.get(False, (0, 0)), n.get(True, (0, 0))
    if not (0 < a1 < n_a and 0 < b1 < n_b):
        return None
    kinds = ("a0", "a1", "b0", "b1")
    seen = rows.select("text", "toxic", "half").mapInArrow(presence, "f string, a0 long, a1 long, b0 long, b1 long").groupBy("f").agg(*(F.sum(k).alias(k) for k in kinds))

    def weight(n0: Column, n1: Column, total: int, toxic: int) -> Column:
        """Log-odds of a word in toxic texts; 0 where it may be as frequent in either kind, given how many words are tried."""
        odds = F.log((n1 + 0.5) / (toxic + 1.0)) - F.log((n0 + 0.5) / (total - toxic + 1.0))
        expected = (n0 + n1) * (toxic / total)
        ratio = 2 * (n1 * F.log(n1 / expected) + F.when(n0 > 0, n0 * F.log(n0 / (n0 + n1 - expected))).otherwise(0.0))
        return F.when((n1 > 0) & (odds >= 2.0) & (ratio >= 1.2 * math.log(100.0 * total)), odds).otherwise(0.0)

    a0, a1_, b0, b1_ = (F.col(k) for k in kinds)
    ways = {"a": weight(a0, a1_, n_a, a1), "b": weight(b0, b1_, n_b, b1), "all": weight(a0 + b0, a1_ + b1_, n_a + n_b, a1 + b1)}
    # as many at most as words pass that test in the sample
    kept = seen.select("f", *(w.alias(k) for k, w in ways.items())).where(F.greatest("a", "b", "all") > 0).collect()
    weights = {k: {r.f: r[k] for r in kept if r[k] > 0} for k in ways}

    def summaries(batches):
        channel = Channel(counts)
        # under the weights of the other half
        readers = {True: Reader(channel, _evidence(weights["a"])), False: Reader(channel, _evidence(weights["b"]))}
        for b in batches:
            x = [summary(readers[half].read(t)) for t, half in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in x], pa.float64()) for k in range(3)), b.column(1).cast(pa.int32())], names=["a", "b", "c", "toxic"])

    seen = np.array(rows.select("text", "toxic", "half").mapInArrow(summaries, "a double, b double, c double, toxic int").collect(), float)
    return counts, weights["all"], _fit_curve(seen[:, :3], (seen[:, 3] > 0).astype(float))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Column ``_row`` with the rows of ``docs`` as they are, and their ``_score``."""
    import pyarrow as pa
    from pyspark.sql.types import DoubleType, StructField, StructType

    model = fit(docs, labels, sample)
    rows = docs.select(F.struct("*").alias("_row"), "text")
    schema = StructType([rows.schema["_row"], StructField("_score", DoubleType())])

    def score(batches):
        counts, weights, curve = model or (np.zeros(ALPHABET**3, np.int64), {}, None)
        reader = Reader(Channel(counts), _evidence(weights))
        for b in batches:
            if curve is None:
                p = np.zeros(b.num_rows)
            else:
                x = np.array([summary(reader.read(t)) for t in b.column(1).to_pylist()], float).reshape(-1, 3)
                p = 1 / (1 + np.exp(-np.clip(curve[0] + x @ curve[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=["_row", "_score"])

    return rows.mapInArrow(score, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with the same columns."""
    return scored(docs, labels).where(F.col("_score") < threshold).select("_row.*")


def op9_noisy_channel_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scored(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return rows.select("_row.doc_id", held_out(F.col("_row.doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
