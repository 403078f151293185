"""Words, hashes and packed arrays that several operators share."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SEPARATORS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The maximal runs of non-separators, in order; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hashes(array: Column) -> Column:
    """A 64-bit hash of each element."""
    return F.transform(array, lambda x: F.xxhash64(x))


def spread(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit integers so that every output bit depends on every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def windows(x: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` elements; shorter by ``width - 1``."""
    x = spread(x)
    out = np.zeros(max(0, len(x) - width + 1), np.uint64)
    for k in range(width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += x[k : k + len(out)]
    return spread(out)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of every (start, length), one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def pack(x: np.ndarray) -> bytes:
    """Integers as compressed byte planes: equal high bytes cost next to nothing."""
    x = np.ascontiguousarray(x)
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)


def pack_ranks(ranks: np.ndarray) -> bytes:
    """Numbers of which small ones are frequent: a byte each, and the rest apart for those over 254."""
    small = np.minimum(ranks, 255).astype(np.uint8)
    return pack_all(small, (ranks[small == 255] - 255).astype(np.int32))


def unpack_ranks(blob: bytes) -> np.ndarray:
    small, rest = unpack_all(blob, np.uint8, np.int32)
    ranks = small.astype(np.int32)
    ranks[small == 255] += rest
    return ranks


def pack_all(*arrays: np.ndarray) -> bytes:
    """Several arrays in one string, each packed and led by its packed size."""
    out = []
    for packed in map(pack, arrays):
        out += [len(packed).to_bytes(8, "little"), packed]
    return b"".join(out)


def unpack_all(blob: bytes, *kinds) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = int.from_bytes(blob[at : at + 8], "little")
        out.append(unpack(blob[at + 8 : at + 8 + size], kind))
        at += 8 + size
    return out


def pack_words(strings: pa.Array) -> bytes:
    """Strings as their packed lengths and their compressed bytes."""
    strings = pa.concat_arrays([strings.cast(pa.string())])
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + len(strings) + 1]
    body = bytes(data[int(ends[0]) : int(ends[-1])]) if len(strings) else b""
    lengths = pack(np.diff(ends).astype(np.int32))
    return len(lengths).to_bytes(8, "little") + lengths + zstandard.ZstdCompressor(level=3).compress(body)


def unpack_words(blob: bytes) -> pa.Array:
    cut = 8 + int.from_bytes(blob[:8], "little")
    lengths = unpack(blob[8:cut], np.int32)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    body = zstandard.ZstdDecompressor().decompress(blob[cut:])
    return pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(body)])


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Texts are long: pass them to Python in batches of fewer rows than the usual 10 000."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def give_back() -> None:
    """Memory that this process has freed but still holds goes back to the system. Spark reuses its Python
    workers, and what one stage leaves in them would count against the next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, giving back its memory when a task's batches are through."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
