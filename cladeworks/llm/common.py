"""Small helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most rows, and bytes of them, that :func:`small` lets Spark broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new folder name below the folder that the session names in ``spark.checkpoint.dir``.

    Where that is unset, below the warehouse folder if that is in a store which all executors
    reach; a session on one machine takes a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and spark.sparkContext.master.startswith("local"):
        base = "file://" + tempfile.mkdtemp(prefix="cladeworks-")
        spark.sparkContext.setCheckpointDir(base)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if warehouse.startswith("/") or warehouse.startswith("file:"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"{warehouse.rstrip('/')}/_checkpoints"
    return f"{base.rstrip('/')}/cladeworks/{what}-{uuid.uuid4().hex}"


#: Folders of the scopes that are open in this thread, innermost last.
_open = threading.local()


def _scopes() -> list[list[str]]:
    if not hasattr(_open, "scopes"):
        _open.scopes = []
    return _open.scopes


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables that are :func:`written` inside are deleted at its end, but for those written to keep.

    Nothing that is read later may depend on them without being written itself.
    """
    _scopes().append([])
    try:
        yield
    finally:
        for path in _scopes().pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, what: str, keep: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage is cut, lost executors cost nothing.

    In a :func:`scratch` the table goes at its end; with ``keep``, at the end of the one around it, if any.
    """
    spark = df.sparkSession
    path = shared_dir(spark, what)
    for scope in _scopes()[-2:-1] if keep else _scopes()[-1:]:
        scope.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def batches_of(spark: SparkSession, size: int):
    """Jobs that run inside hand whole texts to Python workers about ``size`` bytes at once, or less where the session says so."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    held = int(before.rstrip("b")) if before.rstrip("b").isdigit() else 0
    spark.conf.set(name, str(min(size, held) if held > 0 else size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if it has at most ``rows`` rows and ``size`` bytes, else as it is."""

    def width(field) -> Column:
        if isinstance(field.dataType, T.ArrayType):
            text = isinstance(field.dataType.elementType, T.StringType)
            return F.octet_length(F.concat_ws("", field.name)) + 16 * F.size(field.name) if text else 8 * F.size(field.name)
        return F.octet_length(field.name) if isinstance(field.dataType, (T.StringType, T.BinaryType)) else F.lit(16)

    widths = sum((F.coalesce(width(f), F.lit(0)) for f in df.schema), F.lit(16)).cast("long")
    n, held = df.select(widths.alias("_w")).limit(rows + 1).agg(F.count("*"), F.sum("_w")).first()
    return F.broadcast(df) if n <= rows and (held or 0) <= size else df


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on an array of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column without copying, and the n + 1 offsets of its rows (null: empty)."""
    import pyarrow as pa

    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[_LOWER]
_BASE, _INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)


def words_in(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of non-blank bytes) of texts; a word also ends before each byte marked in ``cuts``."""
    inside, edge = ~BLANK[data], np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    if cuts is not None:
        edge[:-1] |= cuts
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    return np.flatnonzero(inside & (~before | edge[:-1])), np.flatnonzero(inside & (~after | edge[1:])) + 1


def hashes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, A-Z read as a-z: polynomials of the bytes' random values, read off a running sum."""
    n = len(data) + 1
    powers, inverses = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
    powers[0] = inverses[0] = 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(inverses, out=inverses)
    running = np.zeros(n, np.uint64)
    np.cumsum(_BYTE[data] * powers[:-1], out=running[1:])
    return mix64((running[ends] - running[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))
