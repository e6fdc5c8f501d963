"""Removal of repeated byte strings by suffix arrays of shards.

A byte goes if some string of LENGTH bytes that covers it also starts in a document with
a smaller identifier.

1. Every window of LENGTH bytes is named by the smallest hash of the GRAM-byte strings in
   it; windows that are equal have equal names. A span is a run of neighbouring windows
   of one name. Spans whose name occurs in one document only are done: nothing in them
   repeats elsewhere. This is the one shuffle that all documents take part in, with a few
   bytes a span. Where a task meets a name in two documents, it sends these two once as
   witnesses, and the name's other spans, whose fate is known, are dealt over all tasks.
2. The other spans' bytes go to shards by name, so equal windows meet in a shard. Equal
   spans of one task are sent once, for the smallest document so far; the others are
   already known to go. A passage in very many documents is thus sent once a task. There
   are as many shards as SHARD_BYTES of text ask for, handled one after the other.
3. A shard works in sub-shards of bounded size. Each has a suffix array, by
   Larsson-Sadakane refinement in numpy (ranks of 8 bytes, doubled until they tell LENGTH
   bytes apart, over groups not yet told apart), and Kasai's common prefixes (in text
   order, each started from its neighbour's less one). Neighbours in the array with common
   prefixes of LENGTH or more are one string; its smallest document decides. Where a
   name's spans run on into the next sub-shard, its windows are merged by binary search in
   the sorted windows so far.
4. Intervals are merged per document and cut out of the texts.

Defined results: null text is empty; shorter texts keep all bytes; a null identifier
neither removes nor loses bytes; rows with one identifier never remove from each other,
and are told apart by a number where their texts differ; repeated rows give a row each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import mix64, small, table, text_bytes, written

LENGTH, GRAM = 50, 16
SUBSHARD, SHARD_BYTES, MOST_WINDOWS = 2 << 20, 64 << 20, 255
#: Over how many keys the spans of a name are dealt that a task knows to repeat.
SALTS = 1024
_BASE = 0x5851F42D4C957F2D


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) from each position."""
    x, size, power = data.astype(np.uint64) + np.uint64(1), 1, _BASE
    while size < gram:
        x = x[:-size] * np.uint64(power) + x[size:] if len(x) > size else x[:0]
        size, power = size * 2, power * power % (1 << 64)
    return mix64(x)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    m, size = x, 1
    while size * 2 <= width:
        m, size = np.minimum(m[:-size], m[size:]), size * 2
    return np.minimum(m[: len(m) - (width - size)], m[width - size :]) if width > size else m


def spans_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, start in the text, number of windows and name of all spans of some texts."""
    if len(data) < length:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    names = _sliding_min(gram_hashes(data), length - GRAM + 1)
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(names)]
    at = np.arange(len(names)) - offsets[text]
    whole = at + length <= sizes[text]
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new & whole)
    run = np.cumsum(new & whole) - 1
    # a span has MOST_WINDOWS windows at most
    inner = np.flatnonzero(whole)
    step = inner - first[run[inner]] if len(inner) else inner
    first = inner[step % MOST_WINDOWS == 0]
    ends = np.append(first[1:], len(names))
    stop = np.minimum(ends, offsets[text[first]] + sizes[text[first]] - length + 1)
    return text[first], at[first], stop - first, names[first]


def suffix_array(data: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``depth`` bytes at least, and the 8 bytes from each position."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(depth + 80, np.uint8)]).astype(np.uint64)
    words = padded[: n + depth + 64]
    for k in (1, 2, 4):
        words = (words[:-k] << np.uint64(8 * k)) | words[k:]
    order = np.argsort(words[:n], kind="stable")
    key, size = words[order], 8
    start = np.ones(n, bool)
    start[1:] = key[1:] != key[:-1]
    rank = np.empty(n + depth + 64, np.int64)
    rank[n:] = -1
    group = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    rank[order] = group
    while size < depth:
        same = np.flatnonzero(~(start & np.append(start[1:], True)))  # places of groups of more than one
        if not len(same):
            break
        suffix = order[same]
        key = group[same] * (n + 1) + rank[suffix + size] + 1
        by = np.argsort(key, kind="stable")
        order[same], key = suffix[by], key[by]
        fresh = np.ones(len(same), bool)
        fresh[1:] = key[1:] != key[:-1]
        start[same] |= fresh
        group = np.maximum.accumulate(np.where(start, np.arange(n), 0))
        rank[order[same]] = group[same]
        size *= 2
    return order, words


def common_prefixes(order: np.ndarray, words: np.ndarray, most: int = LENGTH, stride: int = 8) -> np.ndarray:
    """Common prefix of each suffix and the one before it in ``order``, up to ``most``, after Kasai.

    Suffixes are taken in text order; that at i shares with its forerunner at least one
    byte less than that at i - 1 did, so each pass over every ``stride``-th suffix starts there
    (where the order told i - 1 and its forerunner apart).
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    for r in range(stride):
        i = np.arange(r, n, stride)
        i = i[before[i] >= 0]
        have = np.where(shared[i - 1] < most, np.maximum(shared[i - 1] - 1, 0), 0) if r else np.zeros(len(i), np.int64)
        open_ = np.arange(len(i))
        while len(open_):
            at = have[open_]
            differ = words[i[open_] + at] ^ words[before[i[open_]] + at]
            zeros = np.full(len(open_), 8)
            odd = differ != 0
            zeros[odd] = (63 - np.floor(np.log2(differ[odd].astype(np.longdouble))).astype(np.int64)) // 8
            have[open_] = at + zeros
            open_ = open_[(zeros == 8) & (have[open_] < most)]
        shared[i] = np.minimum(have, most)
    out = np.zeros(n, np.int64)
    out[1:] = shared[order[1:]]
    return out


def smallest_documents(data: np.ndarray, places: np.ndarray, documents: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For the windows at ``places`` of some bytes: the smallest document of equal ones, and the windows' lexicographic order."""
    order, words = suffix_array(data, length)
    prefix = common_prefixes(order, words, length)
    document = np.full(len(data), np.iinfo(np.int64).max)
    document[places] = documents
    wanted = np.zeros(len(data), bool)
    wanted[places] = True
    group = np.cumsum(prefix < length) - 1
    least = np.full(group[-1] + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, group, document[order])
    of = np.empty(len(data), np.int64)
    of[order] = group
    return least[of[places]], order[wanted[order]]


def _flat(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] numbers), starts[1], ..."""
    stop = np.cumsum(counts)
    return np.repeat(starts - stop + counts, counts) + np.arange(stop[-1] if len(stop) else 0)


def _pack(*arrays: np.ndarray) -> bytes:
    import zstandard

    parts = [a.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts))


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    cut = 8 * len(kinds) + np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.int64, len(kinds)))])
    return [np.frombuffer(raw[a:b], k) for a, b, k in zip(cut[:-1].tolist(), cut[1:].tolist(), kinds, strict=True)]


SENT = ("u4", "i8", "i4", "i4", "u1", "u1")  # name, document, tag, start, windows, bytes


def batch_segments(doc_ids, tags, data: np.ndarray, offsets: np.ndarray, text, start, windows, names, shards: int, best: dict[bytes, int] | None = None):
    """The spans of a batch by shard, each once; and the intervals already known to go. Yields (shard, sent, known).

    ``best`` holds the smallest document so far of each span of the batches before.
    """
    raw, best = data.tobytes(), {} if best is None else best
    a = offsets[text] + start
    b = a + windows + LENGTH - 1
    documents = doc_ids[text]
    pieces = [raw[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    for piece, document in zip(pieces, documents.tolist(), strict=True):
        have = best.get(piece)
        if have is None or document < have:
            best[piece] = document
    least = np.fromiter(map(best.__getitem__, pieces), np.int64, len(pieces))
    known = np.flatnonzero(least < documents)
    shard = (names % shards).astype(np.int64)
    if len(known):
        yield int(documents[known[0]] % shards), None, _pack(documents[known].astype("i8"), tags[text[known]].astype("i4"), start[known].astype("i4"), (start + windows + LENGTH - 1)[known].astype("i4"))
    left = np.flatnonzero(least == documents)
    left = left[np.argsort(shard[left], kind="stable")]
    for part in np.split(left, np.flatnonzero(np.diff(shard[left])) + 1):
        if len(part):
            bytes_ = data[_flat(a[part], (b - a)[part])]
            yield int(shard[part[0]]), _pack(names[part].astype("u4"), documents[part].astype("i8"), tags[text[part]].astype("i4"), start[part].astype("i4"), windows[part].astype("u1"), bytes_), None


def repeated(names, documents, tags, starts, windows, bytes_) -> tuple[np.ndarray, ...]:
    """document, tag, from, to of all intervals that go, of one shard's spans (arrays as in SENT)."""
    sizes = windows.astype(np.int64) + LENGTH - 1
    at = np.cumsum(sizes) - sizes
    # equal spans once, with the smallest document
    raw = bytes_.tobytes()
    of: dict[bytes, int] = {}
    piece = np.fromiter((of.setdefault(raw[x:y], len(of)) for x, y in zip(at.tolist(), (at + sizes).tolist(), strict=True)), np.int64, len(at))
    n = len(of)
    first = np.zeros(n, np.int64)
    first[piece[::-1]] = np.arange(len(piece))[::-1]
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, piece, documents)
    p_name, p_size, p_at, p_windows = names[first], sizes[first], at[first], windows[first].astype(np.int64)
    w_at = np.cumsum(p_windows) - p_windows  # each piece's windows in one array
    smallest = np.repeat(least, p_windows)
    order = np.lexsort((least, p_name))
    alone = np.ones(n, bool)
    same = p_name[order][1:] == p_name[order][:-1]
    alone[order[1:][same]] = alone[order[:-1][same]] = False
    order = order[~alone[order]]
    cuts = np.flatnonzero(np.diff(np.cumsum(p_size[order]) // SUBSHARD)) + 1
    held = (None, None, None)  # name, sorted windows, their smallest documents
    for part in np.split(order, cuts):
        if not len(part):
            continue
        text = bytes_[_flat(p_at[part], p_size[part])]
        places = _flat(np.cumsum(p_size[part]) - p_size[part], p_windows[part])
        own = _flat(w_at[part], p_windows[part])
        found, by = smallest_documents(text, places, np.repeat(least[part], p_windows[part]))
        name_of = np.repeat(p_name[part], p_windows[part])
        window = lambda x: np.frombuffer(text[x[:, None] + np.arange(LENGTH)].tobytes(), f"S{LENGTH}")
        if held[0] is not None and (mine := np.flatnonzero(name_of == held[0])).size:
            w = window(places[mine])
            k = np.minimum(np.searchsorted(held[1], w), len(held[1]) - 1)
            hit = held[1][k] == w
            found[mine[hit]] = np.minimum(found[mine[hit]], held[2][k[hit]])
        smallest[own] = np.minimum(smallest[own], found)
        # what may run on: the windows of the last name
        last = np.zeros(len(text), bool)
        last[places[name_of == name_of[-1]]] = True
        sorted_places = by[last[by]]
        value = np.empty(len(text), np.int64)
        value[places] = found
        w, d = window(sorted_places), value[sorted_places]
        if held[0] == name_of[-1]:
            w, d = np.concatenate([held[1], w]), np.concatenate([held[2], d])
            k = np.argsort(w, kind="stable")
            w, d = w[k], d[k]
        keep = np.ones(len(w), bool)
        keep[1:] = w[1:] != w[:-1]
        held = (name_of[-1], w[keep], np.minimum.reduceat(d, np.flatnonzero(keep)) if len(d) else d)
    w = windows.astype(np.int64)
    number = np.repeat(np.arange(len(piece)), w)
    gone = smallest[_flat(w_at[piece], w)] < documents[number]
    step = np.arange(len(gone)) - np.repeat(np.cumsum(w) - w, w)
    edge = np.ones(len(gone), bool)
    edge[1:] = (gone[1:] != gone[:-1]) | (number[1:] != number[:-1])
    a = np.flatnonzero(edge)
    b = np.append(a[1:], len(gone))
    keep = gone[a]
    a, b = a[keep], b[keep]
    k = number[a]
    return documents[k], tags[k], starts[k] + step[a], starts[k] + step[b - 1] + LENGTH


def intervals(rows: DataFrame, shards: int) -> DataFrame:
    """doc_id, part: byte intervals that go, of columns doc_id, tag, text; they may overlap. ``part`` is start, tag and length in one number."""
    import pyarrow as pa

    def name(batches):
        shown: set[int] = set()  # names that this task has sent witnesses of
        for b in batches:
            at = 0
            _, offsets = text_bytes(b.column(2))
            while at < b.num_rows:
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 20), side="right")) - 1)
                text, start, windows, names = spans_of(*text_bytes(b.column(2).slice(at, to - at)))
                if not len(text):
                    at = to
                    continue
                ids = b.column(0).slice(at, to - at).to_numpy()[text]
                tags = b.column(1).slice(at, to - at).to_numpy().astype(np.int64)[text]
                names, span = (names >> np.uint64(16)).view(np.int64), start << 24 | tags << 8 | windows
                # the smallest and the largest document of each name in the batch
                order = np.lexsort((ids, names))
                cut = np.flatnonzero(np.diff(names[order], prepend=-1))
                last = np.append(cut[1:], len(order)) - 1
                twice = ids[order[cut]] != ids[order[last]]
                known = np.empty(len(order), bool)
                known[order] = np.repeat(twice, last - cut + 1)
                new = np.array([n not in shown for n in names[order[cut[twice]]].tolist()], bool)
                shown.update(names[order[cut[twice]]].tolist())
                witness = np.concatenate([order[cut[twice][new]], order[last[twice][new]]])
                salt = np.where(known, 1 + (ids ^ start) % SALTS, 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x, y])) for x, y in ((ids, ids[witness]), (names, names[witness]), (span, np.full(len(witness), -1)), (salt.astype(np.int16), np.zeros(len(witness), np.int16)))], names=["doc_id", "name", "span", "salt"])
                at = to

    by = Window.partitionBy("name", "salt")
    spans = rows.mapInArrow(name, "doc_id long, name long, span long, salt short").repartition("name", "salt").withColumns({"_x": F.min("doc_id").over(by), "_y": F.max("doc_id").over(by)})
    spans = spans.where(((F.col("_x") != F.col("_y")) | (F.col("salt") > 0)) & (F.col("span") >= 0))
    short = F.col("name").bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    spans = spans.select("doc_id", "span", short.alias("name")).repartition("doc_id")
    spans = spans.groupBy("doc_id").agg(F.collect_list("span").alias("spans"), F.collect_list("name").alias("names"))

    def send(batches):
        best: dict[bytes, int] = {}
        for b in batches:
            ids, tags = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64)
            text = np.repeat(np.arange(b.num_rows), np.diff(b.column(3).offsets.to_numpy()))
            span, names = (b.column(k).flatten().to_numpy().astype(np.int64) for k in (3, 4))
            start, windows = span >> 24, span & 255
            data, offsets = text_bytes(b.column(2))
            good = (span >> 8 & 0xFFFF == tags[text]) & (start + windows + LENGTH - 1 <= np.diff(offsets)[text])
            sent = list(batch_segments(ids, tags, data, offsets, text[good], start[good], windows[good], names[good], shards, best))
            yield pa.RecordBatch.from_arrays([pa.array([s[0] for s in sent], pa.int32()), pa.array([s[1] for s in sent], pa.binary()), pa.array([s[2] for s in sent], pa.binary())], names=["shard", "sent", "known"])

    joined = rows.join(spans, "doc_id").select("doc_id", "tag", "text", "spans", "names")
    sent = joined.mapInArrow(send, "shard int, sent binary, known binary").repartition(shards, "shard").sortWithinPartitions("shard")

    def judge(batches):
        def out(d, t, a, b):
            a = a.astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(a << 32 | t.astype(np.int64) << 16 | (b - a))], names=["doc_id", "part"])

        def done(blobs):
            if blobs:
                found = repeated(*(np.concatenate(x) for x in zip(*(_unpack(s, *SENT) for s in blobs), strict=True)))
                for at in range(0, len(found[0]), 100_000):
                    yield out(*(x[at : at + 100_000] for x in found))

        here, blobs = None, []
        for b in batches:
            for shard, sent, known in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if known is not None:
                    yield out(*_unpack(known, "i8", "i4", "i4", "i4"))
                    continue
                if shard != here:
                    yield from done(blobs)
                    here, blobs = shard, []
                blobs.append(sent)
        yield from done(blobs)

    return sent.mapInArrow(judge, "doc_id long, part long")


def _merged(rows: DataFrame) -> DataFrame:
    """doc_id, tag, a, b with overlapping intervals of neighbouring rows merged (rows doc_id, part in order)."""
    import pyarrow as pa

    def merge(batches):
        for b in batches:
            if not b.num_rows:
                continue
            d, part = (c.to_numpy() for c in b.columns)
            t, x = part >> 16 & 0xFFFF, part >> 32
            y, order = x + (part & 0xFFFF), np.lexsort((x, t, d))
            d, t, x, y = d[order], t[order], x[order], y[order]
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1])
            far = np.int64(1) << 32
            reach = np.maximum.accumulate(y + (np.cumsum(new) - 1) * far) - (np.cumsum(new) - 1) * far
            new[1:] |= x[1:] > reach[:-1]
            k = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays([pa.array(d[k]), pa.array(t[k], pa.int32()), pa.array(x[k], pa.int32()), pa.array(reach[np.append(k[1:], len(d)) - 1], pa.int32())], names=["doc_id", "tag", "a", "b"])

    return rows.mapInArrow(merge, "doc_id long, tag int, a int, b int")


def cut(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of columns doc_id, text."""
    import pyarrow as pa

    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    long = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    digests = written(long.select("doc_id", F.octet_length("text").cast("long").alias("n"), F.sha2("text", 256).alias("digest")), "digests")
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(digests.agg(F.sum("n")).first()[0] or 0) // SHARD_BYTES))
    # a number for each text of an identifier that has several
    several = digests.groupBy("doc_id").agg(F.min("digest").alias("_d"), F.max("digest").alias("_e")).where(F.col("_d") != F.col("_e")).select("doc_id")
    several = digests.join(several, "doc_id", "left_semi").select("doc_id", "digest").distinct()
    several = written(several.withColumn("tag", (F.row_number().over(Window.partitionBy("doc_id").orderBy("digest")) % (1 << 16)).cast("int")), "digests-several")
    alike = several.isEmpty()

    def tagged(rows: DataFrame, digest) -> DataFrame:
        if alike:
            return rows.withColumn("tag", F.lit(0))
        own = small(several.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_d"), F.col("tag").alias("_t")))
        return rows.join(own, (F.col("doc_id") == F.col("_id")) & (digest == F.col("_d")), "left").withColumn("tag", F.coalesce("_t", F.lit(0))).drop("_id", "_d", "_t")

    docs, rows = (tagged(x, F.sha2("text", 256)).select("doc_id", "tag", "text") for x in (docs, long))
    # a copy of a whole smaller document goes as a whole and adds no string to what others are held against
    first = written(digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("_y")).where(F.col("first") != F.col("_y")).select("digest", "first"), "digests-first")
    copies = written(tagged(digests.join(small(first), "digest").where(F.col("doc_id") > F.col("first")), F.col("digest")).select("doc_id", "tag", "n").distinct(), "copies")
    rest = rows.join(small(copies.select("doc_id", "tag")), ["doc_id", "tag"], "left_anti").select("doc_id", "tag", "text")
    runs = _merged(intervals(rest, shards).repartition("doc_id").sortWithinPartitions("doc_id", "part"))
    runs = runs.groupBy("doc_id", "tag").agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))
    runs = written(runs.union(copies.select("doc_id", "tag", F.array(F.lit(0)), F.array(F.col("n").cast("int")))), "runs")
    bounded = runs.agg(F.coalesce(F.sum(F.size("a")), F.lit(0))).first()[0] <= 4_000_000
    rows = docs.join(small(runs) if bounded else runs, ["doc_id", "tag"], "left").select("doc_id", "text", "a", "b")

    def remove(batches):
        for batch in batches:
            out = []
            data, offsets = text_bytes(batch.column(1))
            raw = data.tobytes()
            for i, (a, b) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                x, y = int(offsets[i]), int(offsets[i + 1])
                kept, at, gone, spans, reach = hashlib.sha256(), x, 0, 0, -1
                for p, q in sorted(zip(a or (), b or (), strict=True)):
                    if p > reach:
                        spans += 1
                        kept.update(raw[at : x + p])
                    if q > reach:
                        gone += q - max(p, reach)
                        reach = q
                    at = x + reach
                kept.update(raw[at:y])
                out.append((y - x, gone, spans, kept.hexdigest()))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op2_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return cut(table(spark, sf_dir, "documents").select("doc_id", "text"))
