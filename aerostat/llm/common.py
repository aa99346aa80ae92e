"""Helpers shared by the operators: staging, text buffers and word hashes."""

from __future__ import annotations

import ctypes
import gc
import time
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat.session import scratch_path

# a word: a run of bytes other than the six ASCII white-space bytes
WORD = r"[^\x20\x09-\x0D]+"
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_MULT_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once under the cluster's shared folder, partitioned if asked for, and read it back.

    Cuts the lineage with a copy that outlives any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.partitionBy(*[by] * bool(by)).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps.

    It does so when the driver's JVM finds that nothing refers to them,
    which a driver with memory to spare may not look for in hours. The
    first time, listeners may still hold the plan of the step that has ended.
    """
    for _ in range(2):
        gc.collect()  # Python's references to plans
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one struct ``row``, so that nothing beside it can clash; ``row.*`` brings them back."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), without leaving the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column (null: empty), relative to byte 0."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Let Arrow batches between the JVM and Python hold about ``most`` bytes.

    The default is 10,000 rows whatever their size, which the JVM, the
    worker and each step in between hold at a time.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def give_back() -> None:
    """Return unused memory of this process to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def tidied(run):
    """``run``, after which a worker gives memory back that it no longer uses.

    Workers serve many tasks; freed arrays would stay with the allocators
    and add up over the steps of a job.
    """
    def wrapper(*tables):
        try:
            return run(*tables)
        finally:
            give_back()

    # Spark looks at the number of arguments
    return (lambda a, b: wrapper(a, b)) if run.__code__.co_argcount == 2 else (lambda a: wrapper(a))


def pressed(raw: bytes) -> bytes:
    """Compressed bytes, for what is shuffled."""
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpressed(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def press_texts(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with each text as compressed bytes, which halves what a shuffle of texts moves."""
    at = rows.columns.index(text)
    names = rows.columns

    def run(batches):
        press = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            columns = b.columns
            columns[at] = pa.array([press((t.as_py() or "").encode()) for t in columns[at]], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = [T.StructField(f.name, T.BinaryType()) if f.name == text else f for f in rows.schema.fields]
    return rows.mapInArrow(run, T.StructType(fields))


def unpress_texts(column: pa.ChunkedArray) -> list[bytes]:
    """Texts of a column made by ``press_texts``."""
    unpress = zstandard.ZstdDecompressor().decompress
    return [unpress(t) for t in column.to_pylist()]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and their offsets."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def sliced(batches, text: str = "text", most: int = 2 << 20):
    """Cut record batches so that a piece holds about ``most`` text bytes.

    A piece always holds whole rows, so a longer text is a piece of its own.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        at = 0
        while at < len(ends):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply, twice)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


# one 64-bit value per byte
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class RangeHash:
    """64-bit hashes of byte ranges: equal bytes, equal hash, wherever they stand."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * _powers(_MULT, len(data))[:-1], out=self.sums[1:])
        self.inverse = _powers(_MULT_INV, len(data))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))


_CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _chunk_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_MULT, _CHUNK), _powers(_MULT_INV, _CHUNK)


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges that stand in order and apart, a chunk of the data at a time.

    Equal bytes have equal hashes, wherever they stand. Beside the result
    only tables of a chunk are held, however long the data are.
    """
    powers, inverse = _chunk_powers()
    out = np.zeros(len(start), np.uint64)
    for at in range(0, len(data), _CHUNK):
        to = min(at + _CHUNK, len(data))
        some = slice(int(np.searchsorted(end, at, side="right")), int(np.searchsorted(start, to, side="left")))
        s, e = np.maximum(start[some], at) - at, np.minimum(end[some], to) - at
        if not len(s):
            continue
        sums = np.zeros(to - at + 1, np.uint64)
        np.cumsum(_BYTE[data[at:to]] * powers[:to - at], out=sums[1:])
        part = (sums[e] - sums[s]) * inverse[s]
        if start[some][0] < at:  # it began in an earlier chunk
            part[:1] *= np.array([pow(int(_MULT), int(at - start[some][0]), 1 << 64)], np.uint64)
        out[some] += part
    return mix(out + (end - start).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def words_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as a big-endian number (``data`` has 8 spare bytes at its end)."""
    return np.ndarray((len(data) - 7,), dtype=">u8", buffer=data, strides=(1,))[at].astype(np.uint64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes a step (for short ranges; ``data`` as in ``words_at``)."""
    h = (end - start).astype(np.uint64)
    alive, at = np.arange(len(start)), start
    while len(alive):
        left = end[alive] - at
        short = np.maximum(8 - left, 0).astype(np.uint64) * np.uint64(8)
        h[alive] = mix(h[alive] * _MULT + (words_at(data, at) >> short))
        stay = left > 8
        alive, at = alive[stay], at[stay] + 8
    return h


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; a word never crosses a row."""
    inside = ~WHITE[data]
    if not inside.any():
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cut - 1] = inside[cut - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(offsets, start, side="right") - 1
