"""Token identifiers in sorted-string-table shards.

A shard is ``block* index bloom footer``. A block holds entries in key order,
each key as (shared prefix length, rest) with a full key every RESTART entries,
and is zstd-compressed. The sparse index has the last key, place and crc of every
block; the Bloom filter answers most absent keys without reading a block; the
footer is of fixed size. :class:`Shard` opens a file by its footer and finds a key
by binary search in the index.

A key is 1 byte (0: null identifier, 1: identifier), 8 bytes big-endian with the
sign bit flipped, 4 bytes number among rows of the same identifier. A value is 1
byte width (2 or 4) and the identifiers little-endian.

Defined results: null text is empty and yields the end identifier alone; rows of
the same identifier are ordered by text and all kept; null identifiers come first;
an empty table gives no shards and no rows.
"""

from __future__ import annotations

import bisect
import itertools
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BLANK, batches_of, hashes_of, mix64, shared_dir, small, table, text_bytes, words_in, written
from .files import reading, writing

MAGIC = b"CWSST001"
FOOTER = struct.Struct("<QQQQQQI8s")
RESTART, BLOCK_BYTES, END_ID = 16, 1 << 18, 1
BITS_PER_KEY, PROBES = 10, 7
#: Words that a worker keeps the identifiers of (it takes several times their bytes while it learns more), bytes of text that are
#: encoded at once, and bytes of rows that Spark hands to a worker at once.
CACHE_WORDS, SLICE_BYTES, BATCH_BYTES = 500_000, 1 << 18, 4 << 20
#: Bytes of text a shard, and the least for which a session of many cores makes more shards.
SHARD_BYTES, LEAST_BYTES = 128 << 20, 4 << 20
DOC = "shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def make_key(doc_id: int | None, number: int) -> bytes:
    return (b"\0" + bytes(8) if doc_id is None else b"\1" + struct.pack(">Q", (doc_id + (1 << 63)) & (1 << 64) - 1)) + struct.pack(">I", number)


def split_key(key: bytes) -> tuple[int | None, int]:
    return (struct.unpack(">Q", key[1:9])[0] - (1 << 63) if key[0] else None), struct.unpack(">I", key[9:])[0]


def _varint(n: int, out: bytearray) -> None:
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)


def _unvarint(data, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        n |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return n, at


def _bloom_bits(doc_ids: np.ndarray, bits: int) -> np.ndarray:
    """The bit numbers (n x PROBES) of some identifiers in a filter of ``bits`` bits."""
    h = mix64(doc_ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    step = mix64(h) | np.uint64(1)
    return ((h[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) % np.uint64(bits)).astype(np.int64)


class Writer:
    """Writes entries that come in key order to a stream."""

    def __init__(self, out):
        import zstandard

        self.out, self.zip = out, zstandard.ZstdCompressor(level=1)
        self.at, self.index, self.block, self.last, self.n_in_block = 0, [], bytearray(), b"", 0
        self.docs, self.tokens, self.ids, self.same = 0, 0, [], (None, -1)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        number = self.same[1] + 1 if self.docs and self.same[0] == doc_id else 0
        self.same = (doc_id, number)
        key = make_key(doc_id, number)
        if self.docs and key <= self.last:
            raise ValueError("keys must ascend")
        shared = 0
        if self.n_in_block % RESTART:
            while shared < len(key) and key[shared] == self.last[shared]:
                shared += 1
        wide = len(ids) and int(ids.max()) > 0xFFFF
        value = (b"\4" + ids.astype("<u4").tobytes()) if wide else b"\2" + ids.astype("<u2").tobytes()
        for n in (shared, len(key) - shared, len(value)):
            _varint(n, self.block)
        self.block += key[shared:]
        self.block += value
        self.last, self.n_in_block = key, self.n_in_block + 1
        self.docs, self.tokens = self.docs + 1, self.tokens + len(ids)
        self.ids.append(-(1 << 62) if doc_id is None else doc_id)
        if len(self.block) >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.block:
            data = self.zip.compress(bytes(self.block))
            self.out.write(data)
            self.index.append((self.last, self.at, len(data), zlib.crc32(data)))
            self.at += len(data)
            self.block, self.n_in_block = bytearray(), 0

    def close(self) -> None:
        self.flush()
        index = b"".join(k + struct.pack("<QII", *rest) for k, *rest in self.index)
        bits = max(64, -(-len(self.ids) * BITS_PER_KEY // 8) * 8)
        bloom = np.zeros(bits, bool)
        bloom[_bloom_bits(np.array(self.ids, np.int64), bits).ravel()] = True
        bloom = np.packbits(bloom).tobytes()
        self.out.write(index)
        self.out.write(bloom)
        self.out.write(FOOTER.pack(self.at, len(index), self.at + len(index), len(bloom), self.docs, self.tokens, zlib.crc32(index + bloom), MAGIC))


class Shard:
    """An open shard: look-ups by identifier and scans in order."""

    ENTRY = 13 + 16

    def __init__(self, file):
        import zstandard

        self.file, self.zip = file, zstandard.ZstdDecompressor()
        size = file.size() if callable(getattr(file, "size", None)) else file.seek(0, 2)
        at, n, bloom_at, bloom_n, self.docs, self.tokens, crc, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        index, bloom = self._read(at, n), self._read(bloom_at, bloom_n)
        if magic != MAGIC or zlib.crc32(index + bloom) != crc:
            raise ValueError("not a shard, or damaged")
        self.index = [(index[i : i + 13], *struct.unpack("<QII", index[i + 13 : i + self.ENTRY])) for i in range(0, n, self.ENTRY)]
        self.keys, self.bloom, self.bits = [x[0] for x in self.index], np.frombuffer(bloom, np.uint8), bloom_n * 8

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return bytes(self.file.read(n))

    def entries(self, number: int):
        """Yields (key, identifiers) of one block."""
        _, at, n, crc = self.index[number]
        data = self._read(at, n)
        if zlib.crc32(data) != crc:
            raise ValueError(f"block {number} is damaged")
        data, at, key = self.zip.decompress(data), 0, b""
        while at < len(data):
            shared, at = _unvarint(data, at)
            rest, at = _unvarint(data, at)
            length, at = _unvarint(data, at)
            key = key[:shared] + data[at : at + rest]
            at += rest
            width = data[at]
            yield key, np.frombuffer(data, f"<u{width}", (length - 1) // width, at + 1)
            at += length

    def scan(self):
        """Yields (identifier, token identifiers) of all documents in order."""
        for number in range(len(self.index)):
            for key, ids in self.entries(number):
                yield split_key(key)[0], ids

    def may_hold(self, doc_id: int | None) -> bool:
        bits = _bloom_bits(np.array([-(1 << 62) if doc_id is None else doc_id], np.int64), self.bits)[0]
        return bool((self.bloom[bits // 8] >> (7 - bits % 8) & 1).all())

    def get(self, doc_id: int | None, number: int = 0) -> np.ndarray | None:
        """Token identifiers of a document, or None."""
        if not self.may_hold(doc_id):
            return None
        key = make_key(doc_id, number)
        block = bisect.bisect_left(self.keys, key)
        return next((ids for k, ids in self.entries(block) if k == key), None) if block < len(self.keys) else None


class Encoder:
    """Token identifiers of whole texts, the same as the tokenizer's own.

    A vocabulary with word ends drops white space and never joins what it separates, so
    a text's identifiers are its words' in order. Words are cut at ASCII blanks (and
    before a full stop or comma that ends one after an ASCII letter), looked up by their
    64-bit hash, and encoded when first seen; words of letters alone are encoded many at
    a time and told apart by their word ends. Texts are encoded as a whole with any
    other vocabulary, and with one that tells capitals from small letters.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
        lowers = self._each([c.upper() for c in letters]) == self._each(letters)
        self.by_word = bool(self.ends.any()) and lowers
        self.forget()

    def forget(self) -> None:
        self.known, self.at, self.n = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0

    def _each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of some words end to end, and how many each has, words of letters first."""
        ids, n = [], []
        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            if part[-1].isalpha() and part[0].isalpha():
                x = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
                ends = np.flatnonzero(self.ends[x]) + 1
                if len(ends) == len(part):
                    ids.append(x)
                    n.append(np.diff(ends, prepend=0))
                    continue
            each = self._each(part)
            ids.append(np.array([i for x in each for i in x], np.uint32))
            n.append(np.array([len(x) for x in each], np.int64))
        return (np.concatenate(ids), np.concatenate(n)) if ids else (np.empty(0, np.uint32), np.empty(0, np.int64))

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        plain = np.array([w.isalpha() for w in words], bool)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        k = int(plain.sum())
        parts = [self._words([words[i] for i in x.tolist()]) for x in (order[:k], order[k:])]
        ids, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        known = np.concatenate([self.known, hashes[order]])
        at = np.concatenate([self.at, self.used + np.cumsum(n) - n])
        self.used += len(ids)
        by = np.argsort(known, kind="stable")
        self.known, self.at, self.n = known[by], at[by], np.concatenate([self.n, n])[by]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The identifiers of texts (bytes and offsets) end to end, and the n + 1 offsets of texts in them."""
        if not self.by_word:
            each = self._each([data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
            return np.array([i for x in each for i in x], np.uint32), np.cumsum([0, *map(len, each)])
        last, letter = np.zeros(len(data), bool), np.zeros(len(data), bool)
        if len(data):
            last[:-1], last[-1] = BLANK[data[1:]], True
            last[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = True
            letter[1:] = (data[:-1] | 32 >= ord("a")) & (data[:-1] | 32 <= ord("z"))
            letter[offsets[:-1][offsets[:-1] < len(data)]] = False
        starts, ends = words_in(data, offsets, ((data == ord(".")) | (data == ord(","))) & last & letter)
        hashes, first, of = np.unique(hashes_of(data, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        new[place < len(self.known)] = self.known[place[place < len(self.known)]] != hashes[place < len(self.known)]
        if len(self.known) + int(new.sum()) > CACHE_WORDS:
            self.forget()
            new[:] = True
        if new.any():
            raw = data.tobytes()
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            self._learn(hashes[new], [raw[a:b].decode() for a, b in spans])
            place = np.searchsorted(self.known, hashes)
        place = place[of]
        n = self.n[place]
        stop = np.cumsum(n)
        ids = self.ids[np.repeat(self.at[place] - stop + n, n) + np.arange(stop[-1] if len(stop) else 0)]
        return ids, np.concatenate([[0], stop])[np.searchsorted(starts, offsets)]


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write_shards(docs: DataFrame, folder: str, vocabulary: str | None = None) -> DataFrame:
    """Writes columns doc_id and text in ascending doc_id as shards; one row (shard, path, docs, tokens) per shard."""
    import pyarrow as pa

    schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])

    def write(batches):
        from pyspark import TaskContext

        shard, writer = TaskContext.get().partitionId(), None
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        encode = encoder(vocabulary or default_vocabulary()).encode
        with writing(folder, f"shard-{shard:05d}") as (uri, out):
            writer = Writer(out)
            for b in itertools.chain([first], batches):
                _, offsets = text_bytes(b.column(1))
                at = 0
                while at < b.num_rows:
                    to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
                    ids, cut = encode(*text_bytes(b.column(1).slice(at, to - at)))
                    for doc_id, x, y in zip(b.column(0).slice(at, to - at).to_pylist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                        writer.add(doc_id, np.append(ids[x:y], np.uint32(END_ID)))
                    at = to
            writer.close()
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [uri], "docs": [writer.docs], "tokens": [writer.tokens]}, schema=schema)

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES), min(8 * docs.sparkSession.sparkContext.defaultParallelism, -(-size // LEAST_BYTES)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(shards, *order).sortWithinPartitions(*order, "text")
    return rows.mapInArrow(write, "shard int, path string, docs long, tokens long")


def read_shards(shards: DataFrame) -> DataFrame:
    """One row per document of the shards in columns shard and path, as read back; columns of :data:`DOC`."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(DOC))

    def read(batches):
        for b in batches:
            for shard, path in zip(b.column("shard").to_pylist(), b.column("path").to_pylist(), strict=True):
                with reading(path) as file:
                    start, rows = 0, []
                    for doc_id, ids in Shard(file).scan():
                        rows.append((shard, doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return shards.select("shard", "path").mapInArrow(read, DOC)


def tokens_written(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Writes all documents as shards and reads them back: doc_id, start, n_tokens, ids_crc32."""
    with batches_of(docs.sparkSession, BATCH_BYTES):
        shards = written(write_shards(docs, shared_dir(docs.sparkSession, "sst"), vocabulary), "sst-files")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("_before"))
    docs = read_shards(shards.repartition(max(1, shards.count())))
    return docs.join(small(written(starts, "sst-starts")), "shard").select("doc_id", (F.col("local_start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32")


def op6_sstable_tokens(spark, sf_dir: str) -> DataFrame:
    """Every document's tokens as read back from the shards."""
    return tokens_written(table(spark, sf_dir, "documents"))
