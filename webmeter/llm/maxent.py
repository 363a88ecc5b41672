"""LM scoring: a hashed maximum-entropy model with class-factored softmax.

Words are those of ``text``, A-Z lower-cased, then one end mark a text.  The
``CLASSES * MEMBERS`` most frequent training words form classes by frequency
rank; the other words of the head (see below) belong to one of ``PROFILES``
classes by the profile of the training texts they mostly stand in, words beyond
the head to one of ``ORTHO`` classes by their spelling, and a word equal to the
one before it to a class of repeats.  A text's profile is the group of
continuation bytes that most of its words with such bytes have as their
greatest (none: the first profile); it is used for counting only, never as a
feature.  With history h

    P(w | h) = P(class | h) * P(w | class, h)

where both factors of a frequent word are softmaxes over hashed features of h
(the word before, the pair before, and skips over one and two words; within a
class, the word and the pair before), and a word of a profile or spelling class
has its smoothed training share in that class.  A repeated word's probability counts
only the class of repeats, so the sum over all words is at most 1.

Counts of all words come from one pass over all training texts; weights are
trained by stochastic gradient steps (Adagrad) in tasks of about ``TASK``
tokens over every training text, in ``ROUNDS`` rounds, and averaged row by row
with the number of updates as weight; a round starts from the weights of the one
before.  Which round and task reads a row, and when, is a matter of its hash, so
scores do not depend on how the rows are dealt to partitions.  Texts are scored in sparse numpy batches.  The counts of the
``HEAD`` most frequent words are broadcast (a fixed bound); those of other
words reach their texts through one join on the word's hash.

Defined cases: a null text is empty; an empty text has one token, the end
mark; with no training text every count is 0 and the weights stay at their
start; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .tables import Table, table

ALPHA = 0.1
WIDTH = 32
CLASSES, MEMBERS, PROFILES, ORTHO = 23, 32, 4, 4
OPEN = PROFILES + ORTHO
REPEAT = CLASSES + OPEN
#: Share of a text's words that must have the bytes of a profile.
PROFILE_SHARE = 0.03
FREQUENT = CLASSES * MEMBERS
HEAD = 1 << 18
CONTEXT = 1 << 14
BITS = 16
BATCH = 8192
RATE = 0.15
TASK = 4_000_000
#: Passes over a part of the training texts each; all but the first start from the averaged weights.
ROUNDS = 3
ROWS = 1024
#: Tasks whose weights are averaged at once.
FAN = 64
BLOCK_ROW = "block int, part int, weights binary, updates binary, squares binary"
U = np.uint64
END = np.uint64(0x0E4D0E4D0E4D0E4D)
BEGIN_CONTEXT = CONTEXT + OPEN

_CONT = np.zeros(256, np.uint8)
_CONT[128:192] = np.arange(128, 192)


class Tokens(NamedTuple):
    """All tokens of a chunk, end marks included: hash, spelling class, tokens of each text."""

    word: np.ndarray
    kind: np.ndarray
    counts: np.ndarray


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    starts, ends, counts = T.spans(data, offsets)
    total = len(starts) + len(counts)
    word, kind = np.full(total, END), np.zeros(total, np.uint8)
    if len(starts):
        at = np.arange(len(starts)) + np.repeat(np.arange(len(counts)), counts)
        word[at] = T.hash_spans(data, starts, ends)
        high = np.maximum.reduceat(np.append(_CONT[data], 0), np.stack([starts, ends], 1).ravel())[::2]
        kind[at] = np.searchsorted(np.array([1, 0xAC, 0xB4], np.uint8), high, "right").astype(np.uint8)
    return Tokens(word, kind, counts + 1)


def profiles(t: Tokens) -> np.ndarray:
    """Profile of each text."""
    n = np.stack([T.sums(t.kind == k, t.counts) for k in range(1, PROFILES)], 1)
    return np.where(n.max(1) >= np.maximum(1, PROFILE_SHARE * t.counts), n.argmax(1) + 1, 0)


class Model(NamedTuple):
    """What scoring needs; everything has a fixed bound."""

    ranks: Table
    counts: np.ndarray
    total: int
    distinct: int
    open_class: np.ndarray
    open_total: np.ndarray
    open_distinct: np.ndarray
    class_bias: np.ndarray
    word_bias: np.ndarray
    class_rows: np.ndarray
    word_rows: np.ndarray


def blank(words: np.ndarray, kinds: np.ndarray, lean: np.ndarray, counts: np.ndarray, total: int, distinct: int, kind_total: np.ndarray, kind_distinct: np.ndarray) -> Model:
    """The model before training; head words in descending order of their counts.

    ``lean`` is the profile of each head word; ``kind_total`` and
    ``kind_distinct`` cover all words, the head's are taken out here.
    """
    top, rest = counts[:FREQUENT], slice(FREQUENT, None)
    own = np.concatenate([np.bincount(lean[rest], counts[rest], PROFILES), kind_total - np.bincount(kinds, counts, ORTHO)])
    many = np.concatenate([np.bincount(lean[rest], minlength=PROFILES), kind_distinct - np.bincount(kinds, minlength=ORTHO)])
    inside = np.zeros(FREQUENT)
    inside[: len(top)] = top
    inside = inside.reshape(CLASSES, MEMBERS) + ALPHA
    mass = np.concatenate([inside.sum(1), own + ALPHA * (many + 1), [max(1.0, total * 0.002)]])
    return Model(table(words, np.arange(len(words), dtype=np.float32)), counts.astype(np.int64), total, distinct, lean.astype(np.uint8), own, many, np.log(mass / mass.sum()).astype(np.float32), np.log(inside / inside.sum(1, keepdims=True)).astype(np.float32), np.zeros((1 << BITS, WIDTH), np.float32), np.zeros((1 << BITS, WIDTH), np.float32))


class Coded(NamedTuple):
    rank: np.ndarray
    cls: np.ndarray
    rows: list[np.ndarray]
    inside: np.ndarray
    inside_rows: list[np.ndarray]


def _row(h: np.ndarray) -> np.ndarray:
    return (h >> U(64 - BITS)).astype(np.uint16)


def code(t: Tokens, model: Model) -> Coded:
    """Ranks (-1 beyond the head), classes and hashed feature rows of the tokens."""
    found = model.ranks.find(t.word)
    rank = np.where(np.isnan(found), -1, found).astype(np.int32)
    n = len(rank)
    first = np.zeros(n, bool)
    begin = np.cumsum(t.counts) - t.counts
    first[begin] = True
    known = rank >= 0
    lean = model.open_class[np.maximum(rank, 0)].astype(np.int32) if len(model.open_class) else np.zeros(n, np.int32)
    opened = np.where(known, lean, PROFILES + t.kind.astype(np.int32))
    context = np.where(known & (rank < CONTEXT), rank, CONTEXT + opened).astype(U)
    before = []
    for _ in range(3):
        source = before[-1] if before else context
        shifted = np.concatenate([source[:1], source[:-1]])
        shifted[first] = BEGIN_CONTEXT
        before.append(shifted)
    word = np.concatenate([t.word[:1], t.word[:-1]])
    cls = np.where(known & (rank < FREQUENT), rank // MEMBERS, CLASSES + opened).astype(np.int32)
    cls[(word == t.word) & ~first] = REPEAT
    one, two, three = (b + U(1) for b in before)
    m = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]
    pair = one * m[0] + two * m[1]
    rows = [_row(one * m[0]), _row(T.mix(pair)), _row(two * m[2]), _row(three * m[3])]
    inside = np.flatnonzero(cls < CLASSES)
    c = cls[inside].astype(U) * m[4]
    inside_rows = [_row(T.mix(c + one[inside] * m[2])), _row(T.mix(c + pair[inside]))]
    return Coded(rank, cls, rows, inside, inside_rows)


def _softmax(bias: np.ndarray, weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    z = bias + weights.take(rows[0], 0)
    for r in rows[1:]:
        z += weights.take(r, 0)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def first_squares() -> list[np.ndarray]:
    """Sums of squared gradients before any update."""
    return [np.full(1 << BITS, 1e-3, np.float32) for _ in range(2)]


class Trainer:
    """Adagrad over minibatches, with the number of updates of each row."""

    def __init__(self, model: Model, squares: list[np.ndarray] | None = None):
        self.model = model
        self.weights = [model.class_rows.copy(), model.word_rows.copy()]
        self.squares = [s.copy() for s in squares] if squares else first_squares()
        self.updates = [np.zeros(1 << BITS, np.float32) for _ in range(2)]

    def _step(self, which: int, p: np.ndarray, target: np.ndarray, rows: list[np.ndarray]) -> None:
        p[np.arange(len(p)), target] -= 1
        w, sq, seen = self.weights[which], self.squares[which], self.updates[which]
        for r in rows:
            by = np.argsort(r, kind="stable")
            sorted_rows = r[by]
            at = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
            used = sorted_rows[at]
            g = np.add.reduceat(p.take(by, 0), at, 0)
            sq[used] += np.einsum("ij,ij->i", g, g) / WIDTH
            w[used] -= RATE * g / np.sqrt(sq[used])[:, None]
            seen[used] += np.diff(np.append(at, len(r)))

    def learn(self, t: Tokens) -> None:
        c = code(t, self.model)
        for lo in range(0, len(c.cls), BATCH):
            hi = min(lo + BATCH, len(c.cls))
            rows = [r[lo:hi] for r in c.rows]
            self._step(0, _softmax(self.model.class_bias, self.weights[0], rows), c.cls[lo:hi], rows)
            a, b = np.searchsorted(c.inside, [lo, hi])
            if b > a:
                own = c.cls[c.inside[a:b]]
                rows = [r[a:b] for r in c.inside_rows]
                self._step(1, _softmax(self.model.word_bias[own], self.weights[1], rows), c.rank[c.inside[a:b]] % MEMBERS, rows)


def score_chunk(data: np.ndarray, offsets: np.ndarray, model: Model) -> dict[str, np.ndarray]:
    """Columns for each text, and the hashes of its tokens beyond the head.

    ``base`` and ``score`` lack the sum over those tokens of log10(count + 0.1).
    """
    t = tokens(data, offsets)
    c = code(t, model)
    log = np.empty(len(c.cls))
    for lo in range(0, len(c.cls), BATCH):
        hi = min(lo + BATCH, len(c.cls))
        p = _softmax(model.class_bias, model.class_rows, [r[lo:hi] for r in c.rows])
        log[lo:hi] = np.log10(p[np.arange(hi - lo), c.cls[lo:hi]])
        a, b = np.searchsorted(c.inside, [lo, hi])
        if b > a:
            at = c.inside[a:b]
            p = _softmax(model.word_bias[c.cls[at]], model.word_rows, [r[a:b] for r in c.inside_rows])
            log[at] += np.log10(p[np.arange(b - a), c.rank[at] % MEMBERS])
    known = c.rank >= 0
    count = np.where(known, model.counts[c.rank] if len(model.counts) else 0, 0)
    smoothed = np.where(known, np.log10(count + ALPHA), 0.0)
    spelled = (c.cls >= CLASSES) & (c.cls < REPEAT)
    k = c.cls[spelled] - CLASSES
    log[spelled] += smoothed[spelled] - np.log10(model.open_total + ALPHA * (model.open_distinct + 1))[k]
    beyond = ~known
    waits = beyond & spelled
    return {
        "n_tokens": t.counts.astype(np.int64),
        "known": T.sums(count > 0, t.counts),
        "base": T.sums(smoothed, t.counts) - t.counts * math.log10(model.total + ALPHA * (model.distinct + 1)),
        "score": T.sums(log, t.counts),
        "hashes": t.word[beyond].view(np.int64),
        "waits": waits[beyond],
        "per": T.sums(beyond, t.counts),
        "identity": T.sums(T.mix(t.word + np.arange(1, len(t.word) + 1, dtype=U) - np.repeat((np.cumsum(t.counts) - t.counts).astype(U), t.counts)), t.counts).view(np.int64),
    }


def count_words(docs: DataFrame) -> DataFrame:
    """Rows (word, kind, c, p1, p2, ...) over the texts ``_text``: count in all, and in texts of each profile but the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            word = np.concatenate([t.word for t in held])
            kind = np.concatenate([t.kind for t in held])
            profile = np.concatenate([np.repeat(profiles(t), t.counts) for t in held])
            u, first, where = np.unique(word, return_index=True, return_inverse=True)
            by = np.bincount(where * PROFILES + profile, minlength=len(u) * PROFILES).reshape(-1, PROFILES)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(kind[first].astype(np.int32)), pa.array(by.sum(1)), *(pa.array(by[:, k]) for k in range(1, PROFILES))], ["word", "kind", "c", *names])

        for b in batches:
            for c in T.chunks(b.column(0)):
                held.append(tokens(c.data, c.offsets))
                size += len(held[-1].word)
                if size > 1_000_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    names = [f"p{k}" for k in range(1, PROFILES)]
    sent = docs.select("_text").mapInArrow(run, "word long, kind int, c long, " + ", ".join(f"{x} long" for x in names))
    return sent.groupBy("word", "kind").agg(*(F.sum(x).alias(x) for x in ("c", *names)))


def most_frequent(counts: DataFrame, most: int = HEAD) -> DataFrame:
    """All words above the least count that leaves at most ``most`` of them.

    The count comes from a histogram (exact below 1024, in steps of about one
    per cent beyond), so no task sorts or gathers the vocabulary.
    """
    step = F.when(F.col("c") < 1024, F.col("c")).otherwise(1024 + F.floor(F.log2(F.col("c") / 1024) * 64))
    histogram = counts.groupBy(step.cast("int").alias("step")).agg(F.count(F.lit(1)).alias("n"), F.max("c").alias("top")).collect()
    left, cut = most, 0
    for r in sorted(histogram, key=lambda r: -r["step"]):
        left -= r["n"]
        if left < 0:
            cut = r["top"]
            break
    return counts.where(F.col("c") > cut)


def start(counts: DataFrame) -> Model:
    """The untrained model from the table of counts."""
    per = {r["kind"]: r for r in counts.groupBy("kind").agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")).collect()}
    kt, kd = np.zeros(ORTHO), np.zeros(ORTHO)
    for k, r in per.items():
        kt[k], kd[k] = r["n"], r["v"]
    head = most_frequent(counts).toArrow()
    head = head.take(pa.array(np.lexsort((head["word"].to_numpy(), -head["c"].to_numpy()))))
    c = head["c"].to_numpy()
    rest = np.stack([head[f"p{k}"].to_numpy() for k in range(1, PROFILES)], 1)
    lean = np.concatenate([(c - rest.sum(1))[:, None], rest], 1).argmax(1) if len(c) else np.zeros(0, np.int64)
    return blank(head["word"].to_numpy().view(U), head["kind"].to_numpy(), lean, c, int(kt.sum()), int(kd.sum()), kt, kd)


def _block(k: int, part: int, weights: np.ndarray, updates: np.ndarray, squares: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "part": pa.array([part], pa.int32()), "weights": [weights.astype(np.float16).tobytes()], "updates": [updates.astype(np.float32).tobytes()], "squares": [squares.astype(np.float32).tobytes()]})


def train(docs: DataFrame, model: Model, task: int = TASK, rounds: int = ROUNDS) -> Model:
    """Gradient steps over the texts ``_text`` of the rows ``_id``.

    Every text is read in one of ``rounds`` rounds, by the hash of its row; a
    round runs in tasks of about ``task`` tokens and goes on from the averaged
    weights and squared gradients of the round before.  Rows are dealt to tasks
    and put in order by their hashes, so the model does not depend on how the
    input is split.  Rows equal in id and text go to one task, a batch at a time.
    """
    tasks = max(1, math.ceil(model.total / task / rounds))
    row = F.xxhash64("_id", "_text")
    squares = first_squares()
    for r in range(rounds):
        now = docs.withColumn("_row", row).where(F.pmod("_row", F.lit(rounds)) == r)
        dealt = now.repartition(tasks, "_row").sortWithinPartitions("_row").select("_text").coalesce(tasks)
        model, squares = _round(dealt, model, squares, tasks)
    return model


def _round(docs: DataFrame, model: Model, squares: list[np.ndarray], tasks: int) -> tuple[Model, list[np.ndarray]]:
    """One task a partition from the given weights, averaged; rows without an update stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast((model, squares))
    blocks = (1 << BITS) // ROWS
    parts = max(1, math.ceil(tasks / FAN))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(*shared.value)
        some = False
        for b in batches:
            for c in T.chunks(b.column(0)):
                trainer.learn(tokens(c.data, c.offsets))
                some = True
        part = TaskContext.get().partitionId() % parts
        for which in range(2) if some else ():
            for k in range(blocks):
                own = slice(k * ROWS, (k + 1) * ROWS)
                if trainer.updates[which][own].any():
                    yield _block(which * blocks + k, part, trainer.weights[which][own], trainer.updates[which][own], trainer.squares[which][own])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list[np.ndarray]] = {}
        for b in batches:
            for k, part, w, n, q in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                # sums of short mantissas in double precision: the order of the blocks hardly matters
                n = np.frombuffer(n, np.float32).astype(np.float64)
                w = np.frombuffer(w, np.float16).astype(np.float64).reshape(ROWS, WIDTH) * n[:, None]
                q = np.frombuffer(q, np.float32) * n
                if (k, part) in total:
                    for held, new in zip(total[k, part], (w, n, q), strict=True):
                        held += new
                else:
                    total[k, part] = [w, n, q]
        for (k, part), (w, n, q) in total.items():
            yield _block(k, part, w / np.maximum(n, 1)[:, None], n, q / np.maximum(n, 1))

    sent = docs.mapInArrow(learn, BLOCK_ROW)
    # first among at most FAN tasks each, then among the parts: no task reads the blocks of all tasks
    some = sent.repartition("block", "part").mapInArrow(average, BLOCK_ROW).withColumn("part", F.lit(0))
    rows, next_squares = [model.class_rows.copy(), model.word_rows.copy()], [q.copy() for q in squares]
    for r in some.repartition("block").mapInArrow(average, BLOCK_ROW).collect():
        which, k = divmod(r.block, blocks)
        at = k * ROWS + np.flatnonzero(np.frombuffer(r.updates, np.float32))
        rows[which][at] = np.frombuffer(r.weights, np.float16).reshape(ROWS, WIDTH)[at - k * ROWS]
        next_squares[which][at] = np.frombuffer(r.squares, np.float32)[at - k * ROWS]
    shared.unpersist()
    return model._replace(class_rows=rows[0], word_rows=rows[1]), next_squares


def score(docs: DataFrame, train_rows: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    The model learns from the rows where ``train_rows`` holds.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"), (~F.coalesce(train_rows, F.lit(False))).alias("held_out"))
    T.scan_conf(spark)
    learned = own.where("not held_out")
    counts = T.written(spark, count_words(learned))
    model = train(learned, start(counts))
    shared = spark.sparkContext.broadcast(model)
    schema = own.select("_id", "held_out").withColumns({"n_tokens": F.lit(0).cast("long"), "known": F.lit(0).cast("long"), "base": F.lit(0.0), "score": F.lit(0.0), "identity": F.lit(0).cast("long"), "beyond": F.array(F.struct(F.lit(0).cast("long").alias("word"), F.lit(True).alias("waits")))}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for c in T.chunks(b.column(1)):
                r = score_chunk(c.data, c.offsets, m)
                n = c.last - c.first
                pairs = pa.StructArray.from_arrays([pa.array(r["hashes"]), pa.array(r["waits"])], ["word", "waits"])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(r["per"])]).astype(np.int32)), pairs)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.first, n), b.column(2).slice(c.first, n), *(pa.array(r[k]) for k in ("n_tokens", "known", "base", "score", "identity")), lists], schema.names)

    partial = T.written(spark, own.mapInArrow(run, schema))
    rest = partial.select("identity", F.size("beyond").alias("m"), F.explode("beyond").alias("w")).select("identity", "m", "w.word", "w.waits")
    log = F.log10(F.coalesce("c", F.lit(0)) + F.lit(ALPHA))
    met = rest.join(counts.select("word", "c"), "word", "left")
    # equal texts have equal tokens: means times numbers of tokens are free of the number of copies
    late = met.groupBy("identity").agg((F.avg(log) * F.max("m")).alias("log_all"), (F.avg(F.when(F.col("waits"), log).otherwise(0.0)) * F.max("m")).alias("log_waits"), F.round(F.avg(F.when(F.col("c") > 0, 1.0).otherwise(0.0)) * F.max("m")).cast("long").alias("seen"))
    none = F.lit(0.0)
    return partial.join(late, "identity", "left").select(F.col("_id").alias(key), "held_out", "n_tokens", (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("log_all", none)).alias("base_score"), (F.col("score") + F.coalesce("log_waits", none)).alias("score"))
