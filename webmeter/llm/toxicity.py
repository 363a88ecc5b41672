"""Toxicity: class-conditional Kneser-Ney models over the letters of words.

Two interpolated Kneser-Ney models of order ``ORDER`` (bytes within a word and
its borders), one of toxic and one of ordinary text, differ in the counts of
their longest sequences only; every shorter order is shared, counted over both,
so a letter sequence rare in both is as likely under either.

A toxic text is a text of which a small share of the words comes from the toxic
model and the others from the ordinary one.  Its evidence is the difference of
the text's log-likelihoods under that mixture and under the ordinary model,
divided by the number of words.  A logistic curve of its logarithm, fitted on
labelled rows that the models have not seen, gives the score; the share is that
of ``SHARES`` with which the curve fits those rows best.

In backoff form the difference for a letter after a history is a stored value
if the sequence was seen, else the history's difference of backoff weights (the
shared rest cancels out), so scoring is two table look-ups a byte.

Defined cases: a null or empty text has no evidence and gets the score of a
text without any; rows whose label is neither 0 nor 1 are not learned from;
without both labels every score is the share of label 1 (0 if no label at
all); without both labels among the rows for the curve a fixed curve is taken;
repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .quality import sample
from .tables import Table, table

ORDER = 6
DISCOUNT = 0.95
#: At most about so many labelled rows of each label are learned from.
MAX_TOXIC, MAX_ORDINARY = 6000, 12_000
#: One row in so many is kept from the models, for the curve.
HELD = 4
#: Shares of toxic words in a toxic text that are tried.
SHARES = (1e-1, 1e-2, 1e-3, 1e-4, 1e-5)
#: Added to the evidence before its logarithm is taken.
FLOOR = 1e-5
#: Bytes of text at once: every letter takes some dozen words of memory.
STEP = 1 << 16
U = np.uint64


class Model(NamedTuple):
    grams: Table
    histories: Table
    share: float
    curve: np.ndarray
    constant: float | None = None


def _tag(key: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    return key | (np.asarray(length).astype(U) << U(56))


def _tail(key: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """The last ``length`` bytes of packed sequences."""
    return key & ((U(1) << (U(8) * np.asarray(length).astype(U))) - U(1))


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed sequences that end at each letter or word end, their lengths, letters per word and words per text.

    A sequence has at most ORDER bytes and starts no earlier than the blank
    before its word; white space counts as one blank.
    """
    starts, ends, counts = T.spans(data, offsets)
    if not len(starts):
        return np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64), counts
    long = ends - starts + 1
    total = int(long.sum())
    begin = np.cumsum(long) - long
    at = np.arange(total) - np.repeat(begin, long)
    source = np.repeat(starts, long) + at
    flat = T.LOWER[np.append(data, 32)[source]].astype(U)
    flat[begin + long - 1] = 32
    length = np.minimum(at + 2, ORDER)
    padded = np.concatenate([np.full(ORDER, 32, U), flat])
    key = np.zeros(total, U)
    for j in range(ORDER - 1, 0, -1):
        inside = np.where(at >= j, padded[ORDER - j : ORDER - j + total], U(32))
        key = (key << U(8)) | np.where(j < length, inside, U(0))
    return (key << U(8)) | flat, length, long, counts


def _by_history(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Histories of sorted sequences, where each sequence's is, and their sums and numbers of counts."""
    history, first, where = np.unique(key >> U(8), return_index=True, return_inverse=True)
    return history, where, np.add.reduceat(n, first, 0), np.add.reduceat((n > 0).astype(float), first, 0)


def kneser_ney(keys: np.ndarray, lengths: np.ndarray, toxic: np.ndarray, plain: np.ndarray) -> tuple[Table, Table]:
    """Tables of log-likelihood differences from the counts of full-length sequences in each class.

    ``keys`` are distinct for each of ``lengths``.
    """
    # shared orders: how many different letters stand before a sequence, in either class
    shared: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    longer = np.empty(0, U)
    for k in range(ORDER, 1, -1):
        longer, n = np.unique(np.concatenate([keys[lengths == k], _tail(longer, k)]), return_counts=True)
        shared[k] = longer, n.astype(float)
    last, n = np.unique(shared[2][0] & U(255), return_counts=True)
    lower = {1: (last, n / n.sum())}
    for k in range(2, ORDER):
        key, n = shared[k]
        _, where, total, kinds = _by_history(key, n)
        below, p = lower[k - 1]
        lower[k] = key, (np.maximum(n - DISCOUNT, 0) + DISCOUNT * kinds[where] * p[np.searchsorted(below, _tail(key, k - 1))]) / total[where]
    grams, values, histories, weights = [], [], [], []
    for k in range(2, ORDER + 1):
        own = np.flatnonzero(lengths == k)
        if not len(own):
            continue
        own = own[np.argsort(keys[own])]
        key, n = keys[own], np.stack([toxic[own], plain[own]], 1).astype(float)
        history, where, total, kinds = _by_history(key, n)
        # a class without the history has only the shared orders
        back = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
        below, q = lower[k - 1]
        p = np.maximum(n - DISCOUNT, 0) / np.maximum(total, 1)[where] + back[where] * q[np.searchsorted(below, _tail(key, k - 1))][:, None]
        grams.append(_tag(key, k))
        values.append(np.log(p[:, 0]) - np.log(p[:, 1]))
        histories.append(_tag(history, k))
        weights.append(np.log(back[:, 0]) - np.log(back[:, 1]))
    if not grams:
        return table(np.empty(0, U), np.empty(0, np.float32)), table(np.empty(0, U), np.empty(0, np.float32))
    return table(np.concatenate(grams), np.concatenate(values).astype(np.float32)), table(np.concatenate(histories), np.concatenate(weights).astype(np.float32))


def evidence(data: np.ndarray, offsets: np.ndarray, grams: Table, histories: Table, shares: tuple[float, ...]) -> np.ndarray:
    """A column for each share: gain in log-likelihood a word, less that of a word that is toxic in no way."""
    key, length, long, counts = letters(data, offsets)
    if not len(key):
        return np.zeros((len(counts), len(shares)))
    value = grams.find(_tag(key, length))
    new = np.flatnonzero(np.isnan(value))
    value[new] = np.nan_to_num(histories.find(_tag(key[new] >> U(8), length[new])))
    word = np.add.reduceat(value.astype(float), np.cumsum(long) - long)
    return np.stack([T.sums(np.logaddexp(0, word + np.log(a / (1 - a))), counts) / np.maximum(counts, 1) for a in shares], 1)


def _expand(x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), np.log(x + FLOOR) - np.log(FLOOR)])


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_expand(x) @ w, -30, 30)))


def curve(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps."""
    a = _expand(x)
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = probability(x, w)
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, a.T @ (y - p) - ridge * w)
    return w


def best_share(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """The share, a column of ``x`` each, whose curve has the least logarithmic loss, and that curve."""
    fitted = []
    for k, share in enumerate(SHARES):
        w = curve(x[:, k], y)
        p = probability(x[:, k], w)
        fitted.append((-np.log(np.where(y == 1, p, 1 - p)).sum(), share, w))
    _, share, w = min(fitted, key=lambda f: f[0])
    return share, w


def score_chunk(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(offsets) - 1, model.constant)
    return probability(evidence(data, offsets, model.grams, model.histories, (model.share,))[:, 0], model.curve)


def count_sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tagged sequences of all texts of a column and their counts."""
    keys, n = [np.empty(0, U)], [np.empty(0, np.int64)]
    for c in T.chunks(column, STEP):
        key, length, _, _ = letters(c.data, c.offsets)
        u, m = np.unique(_tag(key, length), return_counts=True)
        keys.append(u)
        n.append(m)
    u, where = np.unique(np.concatenate(keys), return_inverse=True)
    return u, np.bincount(where, np.concatenate(n), len(u)).astype(np.int64), u >> U(56)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY) -> Model:
    """Fit on a bounded sample: about ``max_toxic`` and ``max_ordinary`` rows, those with the smallest hashes."""
    spark = docs.sparkSession
    chosen, sizes = sample(labels, label, key, {1: max_toxic, 0: max_ordinary})
    if len(sizes) < 2:
        none = table(np.empty(0, U), np.empty(0, np.float32))
        return Model(none, none, SHARES[0], np.zeros(2), float(1 in sizes))
    usable = docs.select(key, F.col(text).alias("_text")).join(F.broadcast(chosen), key).select("_text", "_label", (F.pmod(F.shiftright("_order", 20), F.lit(HELD)) == 0).alias("_held"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic = b.column(1).to_numpy(zero_copy_only=False) == 1
            for y in (0, 1):
                rows = b.column(0).filter(pa.array(toxic == bool(y)))
                if len(rows):
                    u, n, _ = count_sequences(rows)
                    yield pa.RecordBatch.from_pydict({"k": pa.array(u.astype(np.int64)), "toxic": pa.array(n * y), "plain": pa.array(n * (1 - y))})

    T.scan_conf(spark)
    got = usable.where(~F.col("_held")).select("_text", "_label").mapInArrow(count, "k long, toxic long, plain long").groupBy("k").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain")).toArrow()
    keys = got["k"].to_numpy().astype(U)
    grams, histories = kneser_ney(_tail(keys, 7), (keys >> U(56)).astype(np.int64), got["toxic"].to_numpy(), got["plain"].to_numpy())
    shared = spark.sparkContext.broadcast((grams, histories))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.concatenate([evidence(c.data, c.offsets, *shared.value, SHARES) for c in T.chunks(b.column(0), STEP)]) if b.num_rows else np.zeros((0, len(SHARES)))
            yield pa.RecordBatch.from_pydict({"y": b.column(1), "x": pa.array([r.tobytes() for r in x], pa.binary())})

    held = usable.where("_held").select("_text", "_label").mapInArrow(measure, "y int, x binary").toArrow()
    y = held["y"].to_numpy().astype(float)
    if len(set(y)) < 2:
        # no curve can be fitted: even odds where a word in a hundred is thrice as likely toxic
        middle = 0.01 * np.log1p(3 * SHARES[-1])
        return Model(grams, histories, SHARES[-1], np.array([-1.0, 1.0 / _expand(np.array([middle]))[0, 1]]))
    return Model(grams, histories, *best_share(np.stack([np.frombuffer(r.as_py()) for r in held["x"]]), y))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs``, or its columns ``keep``, with the probability of label 1 in column ``out`` (replaced if it exists)."""
    docs = docs.drop(out)
    names, spark = docs.columns, docs.sparkSession
    kept = [c for c in (names if keep is None else keep) if c != out]
    schema = docs.select(*kept).withColumn(out, F.lit(0.0)).schema
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            p = [score_chunk(c.data, c.offsets, m) for c in T.chunks(b.column(names.index(text)), STEP)]
            yield pa.RecordBatch.from_arrays([*(b.column(names.index(c)) for c in kept), pa.array(np.concatenate(p) if p else np.empty(0))], [*kept, out])

    T.scan_conf(spark)
    return docs.mapInArrow(run, schema)
