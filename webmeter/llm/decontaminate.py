"""Benchmark decontamination: SimHash windows of item size, multi-index Hamming
blocks, exact weighted-shingle verification.

Every benchmark item belongs to a *size class*: the largest class width (in
words) not above ``FILL`` of its length.  ``FILED`` sub-windows of that width of
the item, and all windows of every class width of every text, get a 64-bit
SimHash over their words.  A window's bits are counted eight at a time in the bytes of
eight 64-bit sums: differences of running sums are exact, so each width costs
a few vector operations a word.

Candidates are found through ``BLOCKS`` blocks of the fingerprint.  If two
fingerprints differ in at most ``RADIUS`` bits, some block differs in at most
``RADIUS // BLOCKS`` bits (pigeonhole), so each item fingerprint is filed under
all block values that near: every pair within the radius meets.  A candidate is
verified by the weighted Jaccard similarity (shingle multiplicities) of the
five-word shingles of the item and of the text's window aligned to it, with the
window's borders moved by up to ``SLACK`` words.  The moves are left out where
the widest of these windows, which holds the shingles of all others, has too few
of the item's shingles for any of them.

The widths are those of the classes, not of each item: every width costs a pass
over all words, and items have as many lengths as they like.

The items are taken in groups of at most ``GROUP`` items and ``GROUP_BYTES``
bytes (a longer item is a group of its own): one group is broadcast, further
groups are further passes over the texts, so nothing grows unchecked.

Defined cases: a null or empty text or item matches nothing; an item of less
than five words is one shingle; equal items each match; repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 7
#: Blocks of 16 bits: the fingerprint's halfwords.
BLOCKS = 4
FILL = 0.85
#: Sub-windows of an item that are filed, spread evenly from its first to its last.
FILED = 5
SLACK = 2
#: Items that are broadcast at once.
GROUP = 2000
GROUP_BYTES = 4 << 20
U = np.uint64
_ONES = U(0x0101010101010101)
_HIGH = U(0x8080808080808080)
#: Class widths in words; geometric.
WIDTHS = sorted({round(1.25**k) for k in range(0, 22)})
MAX_WIDTH = 120


def words_of(text: str) -> tuple[np.ndarray, int]:
    raw = np.frombuffer(text.encode(), np.uint8)
    at = np.array([0, len(raw)])
    starts, ends, _ = T.spans(raw, at)
    return T.hash_spans(raw, starts, ends), len(starts)


def running(words: np.ndarray) -> list[np.ndarray]:
    """Eight running sums whose bytes count the set bits of the words."""
    out = []
    for j in range(8):
        total = np.zeros(len(words) + 1, U)
        np.cumsum((words >> U(j)) & _ONES, out=total[1:])
        out.append(total)
    return out


def fingerprints(sums: list[np.ndarray], width: int) -> np.ndarray:
    """SimHash of every window of ``width`` (at most 120) words; bit set where more than half of the words have it."""
    n = len(sums[0]) - width
    out = np.zeros(max(n, 0), U)
    if n > 0:
        add = U(127 - width // 2) * _ONES
        bits = np.empty(n, U)
        for j, s in enumerate(sums):
            np.subtract(s[width:], s[:-width], out=bits)
            bits += add
            bits &= _HIGH
            bits >>= U(7 - j)
            out |= bits
    return out


class Index:
    """Sub-window fingerprints of a group of items, by class width."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = []
        files: dict[int, list[tuple[int, int, int]]] = {}
        for number, text in items:
            words, n = words_of(text or "")
            if not n:
                continue
            k = len(self.items)
            self.items.append((number, n, Counter(T.shingles(words, np.array([n]), SHINGLE)[0].tolist())))
            fit = [w for w in WIDTHS if w <= min(MAX_WIDTH, max(1, FILL * n))]
            width = fit[-1]
            prints = fingerprints(running(words), width)
            for at in np.unique(np.linspace(0, n - width, FILED).round().astype(int)).tolist():
                files.setdefault(width, []).append((int(prints[at]), k, at))
        self.classes = {}
        size = 64 // BLOCKS
        flips = self._flips(size, RADIUS // BLOCKS)
        for width, rows in files.items():
            f = np.array([r[0] for r in rows], U)
            blocks = []
            for b in range(BLOCKS):
                value = ((f >> U(b * size)) & U((1 << size) - 1)).astype(np.int64)
                key = (value[:, None] ^ flips[None, :]).ravel()
                owner = np.repeat(np.arange(len(rows)), len(flips))
                by = np.argsort(key, kind="stable")
                count = np.bincount(key, minlength=1 << size)
                blocks.append((count > 0, np.concatenate([[0], np.cumsum(count)]), owner[by]))
            self.classes[width] = (f, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), blocks)

    @staticmethod
    def _flips(size: int, most: int) -> np.ndarray:
        """All masks of at most ``most`` set bits."""
        masks = np.arange(1 << size)
        return masks[np.bitwise_count(masks) <= most]

    def candidates(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Distinct rows (text, item, first word of the aligned window) within the radius."""
        sums = running(words)
        at = np.concatenate([[0], np.cumsum(counts)])
        found = [np.empty((0, 3), np.int64)]
        for width, (prints, item, offset, blocks) in self.classes.items():
            if len(words) < width:
                continue
            window = fingerprints(sums, width)
            halves = window.view(np.uint16).reshape(-1, BLOCKS)
            for b, (used, first, owner) in enumerate(blocks):
                hit = np.flatnonzero(used[halves[:, b]])
                if not len(hit):
                    continue
                value = halves[hit, b].astype(np.int64)
                m = first[value + 1] - first[value]
                pos = np.repeat(hit, m)
                slot = np.repeat(first[value] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
                own = owner[slot]
                near = np.bitwise_count(window[pos] ^ prints[own]) <= RADIUS
                pos, own = pos[near], own[near]
                doc = np.searchsorted(at, pos, "right") - 1
                whole = pos + width <= at[doc + 1]
                found.append(np.stack([doc, item[own], pos - offset[own]], 1)[whole])
        return np.unique(np.concatenate(found), axis=0)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(text, item id, first word, words, similarity) of verified matches: the best of each text and item."""
        starts, ends, counts = T.spans(data, offsets)
        words = T.hash_spans(data, starts, ends)
        at = np.concatenate([[0], np.cumsum(counts)])
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for doc, k, first in self.candidates(words, counts).tolist():
            number, n, want = self.items[k]
            if best.get((doc, k), (0,))[0] == 1.0:
                continue
            lo, hi = int(at[doc]), int(at[doc + 1])
            if n >= SHINGLE + 2 * SLACK:
                a, b = max(lo, first - SLACK), min(hi, first + n + SLACK)
                wide = Counter(T.shingles(words[a:b], np.array([b - a]), SHINGLE)[0].tolist())
                if sum(min(m, wide[x]) for x, m in want.items() if x in wide) < SIMILARITY * sum(want.values()):
                    continue
            for a, b in self._borders(first, first + n, lo, hi):
                sim = weighted_jaccard(Counter(T.shingles(words[a:b], np.array([b - a]), SHINGLE)[0].tolist()), want)
                if sim >= SIMILARITY and sim > best.get((doc, k), (0,))[0]:
                    best[doc, k] = (sim, a - lo, b - a)
                if sim == 1.0:
                    break
        return [(doc, self.items[k][0], a, n, sim) for (doc, k), (sim, a, n) in sorted(best.items())]

    @staticmethod
    def _borders(a: int, b: int, lo: int, hi: int) -> list[tuple[int, int]]:
        """Windows in the text, the aligned one first."""
        moves = sorted(((x, y) for x in range(-SLACK, SLACK + 1) for y in range(-SLACK, SLACK + 1)), key=lambda m: abs(m[0]) + abs(m[1]))
        return list(dict.fromkeys((max(lo, a + x), min(hi, b + y)) for x, y in moves if max(lo, a + x) < min(hi, b + y)))


def weighted_jaccard(a: Counter, b: Counter) -> float:
    """Sum of the lesser over sum of the greater multiplicities."""
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


def item_groups(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = GROUP) -> Iterator[list[tuple[int, str]]]:
    """The items, at most ``size`` and ``GROUP_BYTES`` at a time, streamed partition by partition."""
    group: list[tuple[int, str]] = []
    held = 0
    for r in benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).where("i is not null and t is not null").toLocalIterator():
        n = len(r.t.encode())
        if group and (len(group) == size or held + n > GROUP_BYTES):
            yield group
            group, held = [], 0
        group.append((r.i, r.t))
        held += n
    if group:
        yield group


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (key, item, first_word, n_words, similarity): the best match of each text with each item it contains."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias(key), F.col(text).alias("_text"))
    schema = docs.select(key).withColumns({item: F.lit(0).cast("long"), "first_word": F.lit(0).cast("long"), "n_words": F.lit(0).cast("long"), "similarity": F.lit(0.0)}).schema

    def one(group: list[tuple[int, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(group)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for b in batches:
                rows = [(c.first + d, *rest) for c in T.chunks(b.column(1)) for d, *rest in index.matches(c.data, c.offsets)]
                if rows:
                    doc, *rest = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), *(pa.array(x, t) for x, t in zip(rest, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True))], schema.names)

        return docs.mapInArrow(run, schema)

    T.scan_conf(spark)
    passes = [one(g) for g in item_groups(benchmark, item, item_text)]
    return reduce(DataFrame.unionByName, passes) if passes else spark.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the texts that contain an item; a row with a null key is kept or dropped by its own text."""
    spark = docs.sparkSession
    names, schema = docs.columns, docs.schema

    def one(frame: DataFrame, group: list[tuple[int, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(group)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for b in batches:
                hit = {c.first + m[0] for c in T.chunks(b.column(names.index(text))) for m in index.matches(c.data, c.offsets)}
                yield b.filter(pa.array([i not in hit for i in range(b.num_rows)], pa.bool_())) if hit else b

        return frame.mapInArrow(run, schema)

    T.scan_conf(spark)
    return reduce(one, item_groups(benchmark), docs)
