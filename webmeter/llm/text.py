"""Vectorised byte-level text kernels shared by the corpus operators.

Everything here works on the raw UTF-8 buffers of an Arrow string column: a
batch is cut into chunks of about ``CHUNK`` bytes (never inside a document) and
each chunk is tokenised and hashed with a fixed number of numpy passes, so the
cost per byte is flat and memory is bounded by the chunk or by one document.

A *word* is a maximal run of bytes other than ASCII white space
(0x20, 0x09-0x0D) with A-Z lower-cased.  A word's identity is a 64-bit hash:
a polynomial in an odd base modulo 2**64, finished with a bijective mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
U = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_pow: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _pow.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        steps = np.full(size, U(base))
        steps[0] = 1
        have = _pow[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (fresh array)."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


class Chunk(NamedTuple):
    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offs, data = column.buffers()
    at = np.frombuffer(offs, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[Chunk]:
    """Consecutive whole documents of about ``size`` bytes together."""
    data, at = buffers(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = int(np.searchsorted(at, at[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Chunk(lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and per-document counts of the words of a chunk."""
    n = len(data)
    solid = np.zeros(n + 2, bool)
    np.logical_not(SPACE[data], out=solid[1 : n + 1])
    begins = solid[1:] & ~solid[:-1]
    finishes = solid[:-1] & ~solid[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    inside = edge[solid[edge] & solid[edge + 1]]
    begins[inside] = True
    finishes[inside] = True
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes)
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span."""
    n = len(data)
    if not len(starts):
        return np.empty(0, U)
    total = np.zeros(n + 1, U)
    value = (LOWER[data] if lower else data).astype(U)
    value += U(1)
    value *= _powers(_BASE, n)
    np.cumsum(value, out=total[1:])
    return mix((total[ends] - total[starts]) * _powers(_INV, n)[starts])


def shingles(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each document and their counts.

    A document of 1 to k-1 words has one shingle made of all its words; an
    empty document has none.
    """
    at = np.concatenate([[0], np.cumsum(counts)])
    many = np.maximum(counts - k + 1, np.minimum(counts, 1))
    total = int(many.sum())
    if not total:
        return np.empty(0, U), many
    doc = np.repeat(np.arange(len(counts)), many)
    first = np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(total)
    left = at[1:][doc] - first
    padded = np.concatenate([words, np.zeros(k, U)])
    h = np.zeros(total, U)
    for j in range(k):
        h *= U(0xD6E8FEB86659FD93)
        h += np.where(left > j, padded[first + j] + U(j + 1), U(0))
    return mix(h), many


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of consecutive groups of ``counts`` values; 0 for an empty group."""
    total = np.concatenate([np.zeros(1, values.dtype if values.dtype != bool else np.int64), np.cumsum(values, dtype=None if values.dtype != bool else np.int64)])
    at = np.concatenate([[0], np.cumsum(counts)])
    return total[at[1:]] - total[at[:-1]]


def crc32_mod(column: str, m: int) -> str:
    """SQL of the fold of an id: crc32 of its decimal text modulo m; a null id is in fold 0."""
    return f"coalesce(pmod(crc32(cast(cast({column} as string) as binary)), {m}), 0)"


def fresh(names: list[str], base: str) -> str:
    """A column name that is not among ``names`` (in any case)."""
    taken = {n.lower() for n in names}
    while base.lower() in taken:
        base += "_"
    return base


def scan_conf(spark, records: int = 256) -> None:
    """Arrow batches small enough that long documents fit a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))


def checkpoint_folder(spark) -> str:
    """A fresh folder in the shared checkpoint directory of the session.

    ``spark.checkpoint.dir`` is used when the cluster sets it; only where it is
    unset (tests on one machine) a folder below the warehouse is taken.
    """
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(spark, frame, folder: str | None = None):
    """The frame written as Parquet to the shared folder and read again (cuts the lineage)."""
    path = folder or checkpoint_folder(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
