"""Quality classifier: hashed word n-gram logistic regression, fitted by
follow-the-regularised-leader (FTRL-proximal) updates and scored as a sparse
dot product.

Features of a text, hashed into ``2**bits`` slots: word 1- and 2-grams, and
1-, 2- and 3-grams of word *shapes* (which kinds of bytes a word holds, its
last byte when that is a sign, and whether it repeats the word before).  Each
occurrence counts equally and a text's values are divided by the number of its
words, so that the score does not depend on the length.

Defined cases: a null or empty text has no feature and its score is the
model's intercept; a row without label, or with a label other than 0 or 1, is
not learned from; with no usable label every score is 0.5; repeated rows are
scored alike; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

BITS = 18
#: At most about so many labelled rows are learned from (a classifier may be fitted on a bounded sample).
MAX_LABELLED = 16_000
#: Tasks that learn; the vectors they send are sparse (L1) and summed before they reach the driver.
SHARDS = 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.6, 1.0, 0.02, 0.5
SCALE = 4.0

_KIND = np.full(256, 8, np.uint8)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 1, 2, 4, 16
_SIGN = np.where(_KIND == 8, np.arange(256), 0).astype(np.uint64)


class Weights(NamedTuple):
    vector: np.ndarray
    bias: float


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots per word, row per word as a matrix of 5 columns, words per text)."""
    starts, ends, counts = T.spans(data, offsets)
    if not len(starts):
        return np.empty((0, 5), np.int64), counts, counts
    word = T.hash_spans(data, starts, ends)
    at = np.concatenate([[0], np.cumsum(counts)])
    first = np.zeros(len(word), bool)
    first[at[:-1][counts > 0]] = True
    kinds = np.bitwise_or.reduceat(np.append(_KIND[data], 0), np.stack([starts, ends], 1).ravel())[::2]
    before = np.concatenate([word[:1] * T.U(0), word[:-1]])
    before[first] = 0
    shape = kinds.astype(T.U) | (_KIND[data[starts]].astype(T.U) << T.U(8)) | (_SIGN[data[ends - 1]] << T.U(16)) | ((word == before).astype(T.U) << T.U(24))
    shape = T.mix(shape + T.U(1))
    shape1 = np.concatenate([shape[:1] * T.U(0), shape[:-1]])
    shape1[first] = 7
    shape2 = np.concatenate([shape1[:1] * T.U(0) + T.U(7), shape1[:-1]])
    shape2[first] = 7
    shift = T.U(64 - bits)
    mult = [T.U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]
    two = shape * mult[0] + shape1
    cols = [word * mult[1], T.mix(word * mult[0] + before) * mult[2], shape * mult[3], T.mix(two) * mult[4], T.mix(two * mult[2] + shape2) * mult[1]]
    return np.stack([(c >> shift).astype(np.int64) for c in cols], 1), counts, counts


def score_chunk(data: np.ndarray, offsets: np.ndarray, weights: Weights) -> np.ndarray:
    """Probability of label 1 for each text of a chunk."""
    slots, counts, _ = features(data, offsets, int(len(weights.vector)).bit_length() - 1)
    dots = T.sums(weights.vector[slots].sum(1), counts) * SCALE / np.maximum(counts, 1)
    return 1 / (1 + np.exp(-np.clip(dots + weights.bias, -30, 30)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> Weights:
    """FTRL-proximal over (slots, values) rows; slot ``2**bits`` is the intercept."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def solve(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(epochs):
        for (i, x), y in zip(rows, labels, strict=True):
            w = solve(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - y) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - step * w
            n[i] += g * g
    w = solve(np.arange(len(z)))
    return Weights(w[:-1].astype(np.float32), float(w[-1]))


def rows_of(column: pa.Array, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text as distinct slots and values, with the intercept last."""
    out = []
    for c in T.chunks(column):
        slots, counts, _ = features(c.data, c.offsets, bits)
        at = np.concatenate([[0], np.cumsum(counts)])
        for k, m in enumerate(counts):
            i, v = np.unique(slots[at[k] : at[k + 1]], return_counts=True)
            out.append((np.append(i, 1 << bits), np.append(v * SCALE / max(int(m), 1), 1.0)))
    return out


def sample(labels: DataFrame, label: str, key: str, most: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """About ``most[y]`` rows of each label y, those with the smallest hashes of the key, and the labels' sizes.

    Rows (key, _label, _order), at most one a key; the bound on their number
    makes them safe to broadcast.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).cast("int").alias("_label")).withColumn("_order", F.xxhash64(F.col(key), F.lit(label)))
    sizes = {r["_label"]: r["n"] for r in usable.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    limit = F.lit(0)
    for y, n in sizes.items():
        limit = F.when(F.col("_label") == y, int(min(1.0, most[y] / n) * (1 << 20))).otherwise(limit)
    return usable.where(F.pmod(F.col("_order"), F.lit(1 << 20)) < limit), sizes


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", max_rows: int = MAX_LABELLED, shards: int = SHARDS) -> Weights:
    """Fit on a bounded sample of the labelled rows.

    About ``max_rows`` rows are kept, half of them for each label if there are
    as many; each of ``shards`` tasks learns from its share and the sparse
    weight vectors are averaged.
    """
    chosen, sizes = sample(labels, label, key, {0: max_rows // 2, 1: max_rows // 2})
    if not sizes:
        return Weights(np.zeros(1 << BITS, np.float32), 0.0)
    usable = docs.select(key, F.col(text).alias("_text")).join(F.broadcast(chosen), key).select("_text", "_label", "_order")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, order = [], [], []
        for b in batches:
            rows += rows_of(b.column(0))
            labels += b.column(1).to_pylist()
            order += b.column(2).to_pylist()
        if rows:
            by = sorted(range(len(rows)), key=order.__getitem__)
            w = ftrl([rows[i] for i in by], np.array([labels[i] for i in by], float))
            used = np.flatnonzero(w.vector)
            values = np.append(w.vector[used], w.bias) * len(rows)
            yield pa.RecordBatch.from_pydict({"slot": pa.array(np.append(used, 1 << BITS).astype(np.int32)), "weighed": pa.array(values.astype(float)), "n": pa.array([0] * len(used) + [len(rows)], pa.int64())})

    T.scan_conf(docs.sparkSession)
    shard = F.pmod(F.col("_order"), F.lit(shards))
    sparse = usable.repartition(shards, shard).mapInArrow(learn, "slot int, weighed double, n long")
    got = sparse.groupBy("slot").agg(F.sum("weighed").alias("weighed"), F.sum("n").alias("n")).toArrow()
    dense = np.zeros((1 << BITS) + 1)
    dense[got["slot"].to_numpy()] = got["weighed"].to_numpy() / max(1, int(np.sum(got["n"].to_numpy())))
    return Weights(dense[:-1].astype(np.float32), float(dense[-1]))


def score(docs: DataFrame, weights: Weights, text: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs``, or its columns ``keep``, with the probability of label 1 in column ``out`` (replaced if it exists)."""
    docs = docs.drop(out)
    names, spark = docs.columns, docs.sparkSession
    kept = [c for c in (names if keep is None else keep) if c != out]
    schema = docs.select(*kept).withColumn(out, F.lit(0.0)).schema
    shared = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            p = [score_chunk(c.data, c.offsets, w) for c in T.chunks(b.column(names.index(text)))]
            yield pa.RecordBatch.from_arrays([*(b.column(names.index(c)) for c in kept), pa.array(np.concatenate(p) if p else np.empty(0))], [*kept, out])

    T.scan_conf(spark)
    return docs.mapInArrow(run, schema)


def predicted(score_column: Column, threshold: float = 0.3) -> Column:
    """1 where the score reaches the threshold."""
    return (score_column >= threshold).cast("int")
