"""Suffix-array dedup: removes every byte covered by a 100-byte string that starts earlier too.

1. Every 100-byte window of a text picks an anchor: the k-gram of least hash
   inside it, the leftmost of equals.  The pick depends on the window's bytes
   alone, so equal windows pick equal anchors at equal places, and all equal
   windows meet under one anchor.  Windows in a row with the same anchor form a
   context (the bytes that they cover).
2. Contexts are grouped by anchor.  Of equal contexts only the first can be new;
   a task passes on one of each kind, so that hot passages shrink before the
   exchange.  An anchor with a large share of all different contexts (a passage
   that goes on in many ways) would still fill one task: a first pass finds such
   anchors, ``HELD / CROWD`` at most, and their contexts are dealt out window by
   window under the hashes of the windows' bytes.
3. Where an anchor has several different contexts, their bytes are fetched and
   a suffix array of them (linear grouping by Lyndon prefixes, ``gsaca``) puts
   equal windows side by side: all but the earliest are removed.
4. The removed ranges of each document are merged and cut out.

Anchors, equal contexts and the windows of hot anchors are recognised by 64-bit
hashes; windows of different contexts by their bytes.  An anchor with more than
``MOST`` different contexts is split: each of its windows becomes a context of
its own under the hash of its bytes.  Texts are read in pieces of ``PIECE``
windows, so that a very long text needs no more memory than its bytes.

Defined cases: a null text is empty; a text of less than 100 bytes loses
nothing; documents are ordered by id, a null id first; rows that share an id
are ordered by a hash of their texts, and rows that share both are one document
(each gets its result); other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .gsaca import suffix_array

LENGTH = 100
GRAM = 24
WINDOW = LENGTH - GRAM + 1
#: Windows that are anchored at once, and the bits that hold a place among them; the rest of a hash's bits rank the k-grams.
PIECE = 1 << 24
PLACE_BITS = 26
#: Contexts that a task keeps in memory to find equal ones before the exchange.
HELD = 1_000_000
#: Different contexts of an anchor, of ``HELD`` held, from which on it is hot.
CROWD = 64
#: Different contexts of an anchor that one task sorts.
MOST = 4096
U = np.uint64
SPAN, REQUEST, CONTEXT = 1, 2, 0
ROW = "kind int, anchor long, same long, id long, h long, start int, own int"


def contexts(data: np.ndarray, offsets: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, ...]:
    """(document, start in it, windows, anchor, content hash) of the contexts of a chunk.

    A chunk (one very long text) of more than ``piece`` windows is read in pieces
    that overlap by a window less a byte; every window is in one piece.
    """
    if len(data) <= piece + LENGTH - 1:
        return _contexts(data, offsets)
    parts = []
    for lo in range(0, len(data) - LENGTH + 1, piece):
        hi = min(lo + piece + LENGTH - 1, len(data))
        doc, start, *rest = _contexts(data[lo:hi], np.clip(offsets - lo, 0, hi - lo))
        parts.append((doc, start + np.maximum(lo - offsets[doc], 0), *rest))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _contexts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    n, none = len(data), np.empty(0, np.int64)
    if n < LENGTH:
        return none, none, none, none.view(U), none.view(U)
    powers, inverse = T._powers(T._BASE, n + 1), T._powers(T._INV, n + 1)
    total = np.zeros(n + 1, U)
    value = data.astype(U)
    value += U(1)
    value *= powers[:n]
    np.cumsum(value, out=total[1:])
    gram = T.mix((total[GRAM:] - total[:-GRAM]) * inverse[: n - GRAM + 1])
    m = len(gram)
    mask = U((1 << PLACE_BITS) - 1)
    ranked = (gram & ~mask) | np.arange(m, dtype=U)
    padded = np.concatenate([ranked, np.full(-m % WINDOW, ~U(0))]).reshape(-1, WINDOW)
    ahead = np.minimum.accumulate(padded, 1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    anchor = (np.minimum(behind[: m - WINDOW + 1], ahead[WINDOW - 1 : m]) & mask).astype(np.int64)
    size = np.diff(offsets)
    doc = np.repeat(np.arange(len(size)), size)
    valid = doc[: len(anchor)] == doc[LENGTH - 1 : LENGTH - 1 + len(anchor)]
    at = np.flatnonzero(valid)
    if not len(at):
        return none, none, none, none.view(U), none.view(U)
    pick = anchor[at]
    new = np.flatnonzero(np.concatenate([[True], (pick[1:] != pick[:-1]) | (np.diff(at) > 1)]))
    start = at[new]
    own = np.diff(np.append(new, len(at)))
    end = start + own + LENGTH - 1
    content = T.mix((total[end] - total[start]) * inverse[start] + own.astype(U))
    place = pick[new]
    content = T.mix(content + (place - start).astype(U))
    d = doc[start]
    return d, start - offsets[d], own, gram[place], content


def _spans(id_: np.ndarray, h: np.ndarray, start: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
    """Removed ranges of runs of windows, touching ones of a document joined."""
    by = np.lexsort((start, h, id_))
    id_, h, start, end = id_[by], h[by], start[by], (start + own + LENGTH - 1)[by]
    if len(by):
        reach = end.copy()
        fresh = np.concatenate([[True], (id_[1:] != id_[:-1]) | (h[1:] != h[:-1]) | (start[1:] > reach[:-1])])
        first = np.flatnonzero(fresh)
        end = np.maximum.reduceat(end, first)
        id_, h, start = id_[first], h[first], start[first]
    zero = np.zeros(len(id_), np.int64)
    return _rows(SPAN, T.mix(id_.view(U)).view(np.int64), zero, id_, h, start, end - start)


def _rows(kind: int, anchor: np.ndarray, same: np.ndarray, id_: np.ndarray, h: np.ndarray, start: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(id_), kind, np.int32)), pa.array(anchor), pa.array(same), pa.array(id_), pa.array(h), pa.array(start.astype(np.int32)), pa.array(own.astype(np.int32))], ["kind", "anchor", "same", "id", "h", "start", "own"])


def _first_of_equals(anchor: np.ndarray, same: np.ndarray, id_: np.ndarray, h: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (anchor, content, document, start), and whether each is the first of its content."""
    by = np.lexsort((start, h, id_, same, anchor))
    a, s = anchor[by], same[by]
    first = np.concatenate([[True], (a[1:] != a[:-1]) | (s[1:] != s[:-1])]) if len(by) else np.zeros(0, bool)
    return by, first


def crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to rows (anchor, n): anchors with more than ``CROWD`` different contexts among those held; a null anchor counts all."""
    held: list[np.ndarray] = []

    def out() -> pa.RecordBatch:
        both = np.unique(np.concatenate(held), axis=0)
        anchor, n = np.unique(both[:, 0], return_counts=True)
        hot = n > CROWD
        return pa.RecordBatch.from_pydict({"anchor": pa.array([*anchor[hot].view(np.int64).tolist(), None], pa.int64()), "n": pa.array([*n[hot].tolist(), len(both)], pa.int64())})

    size = 0
    for b in batches:
        for c in T.chunks(b.column(0)):
            _, _, _, anchor, same = contexts(c.data, c.offsets)
            held.append(np.stack([anchor, same], 1))
            size += len(anchor)
            if size >= HELD:
                yield out()
                held, size = [], 0
    if size:
        yield out()


def hot_anchors(own: DataFrame) -> list[int]:
    """Anchors with at least ``CROWD / HELD`` of all different contexts (``HELD / CROWD`` anchors at most), and more than ``CROWD``."""
    found = T.written(own.sparkSession, own.select("text").mapInArrow(crowded, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")))
    total = F.max(F.when(F.col("anchor").isNull(), F.col("n")))
    least = found.agg((total * F.lit(CROWD / HELD)).alias("n")).scalar()
    return [r.anchor for r in found.where(F.col("anchor").isNotNull() & (F.col("n") >= least)).select("anchor").collect()]


def opened(data: np.ndarray, offsets: np.ndarray, found: tuple[np.ndarray, ...], hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts of a chunk with those of hot anchors split into windows, each under the hash of its bytes."""
    doc, start, own, anchor, same = found
    split = np.isin(anchor, hot)
    if not split.any():
        return found
    n = own[split]
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(start[split], n) + place
    owner = np.repeat(doc[split], n)
    begin = offsets[owner] + at
    key = T.mix(T.hash_spans(data, begin, begin + LENGTH, lower=False) ^ U(0x5DEECE66D))
    rest = ~split
    one = np.ones(len(at), own.dtype)
    return tuple(np.concatenate(x) for x in ((doc[rest], owner), (start[rest], at), (own[rest], one), (anchor[rest], key), (same[rest], np.zeros(len(at), U))))


def gather(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(id, h, text) to one context of each kind a task, and ranges of the other equals."""
    held: list[list[np.ndarray]] = []

    def out() -> Iterator[pa.RecordBatch]:
        anchor, same, id_, h, start, own = (np.concatenate(x) for x in zip(*held, strict=True))
        by, first = _first_of_equals(anchor, same, id_, h, start)
        keep, rest = by[first], by[~first]
        for lo in range(0, len(keep), 50_000):
            k = keep[lo : lo + 50_000]
            yield _rows(CONTEXT, anchor[k], same[k], id_[k], h[k], start[k], own[k])
        if len(rest):
            yield _spans(id_[rest], h[rest], start[rest], own[rest])

    size = 0
    for b in batches:
        ids, hs = (b.column(i).to_numpy() for i in (0, 1))
        for c in T.chunks(b.column(2)):
            doc, start, own, anchor, same = opened(c.data, c.offsets, contexts(c.data, c.offsets), hot)
            doc = doc + c.first
            held.append([anchor.view(np.int64), same.view(np.int64), ids[doc], hs[doc], start, own])
            size += len(doc)
            if size >= HELD:
                yield from out()
                held, size = [], 0
    if size:
        yield from out()


def whole_runs(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.Table]:
    """Tables that hold all rows of each value of a sorted column."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(column).to_numpy()
        if last is not None and key[-1] != last:
            cut = int(np.searchsorted(key, key[-1], "left"))
            if key[0] != last or cut:
                yield pa.Table.from_batches([*held, b.slice(0, cut)]).combine_chunks()
                held = []
            b = b.slice(cut)
        elif last is None:
            cut = int(np.searchsorted(key, key[-1], "left"))
            if cut:
                yield pa.Table.from_batches([b.slice(0, cut)]).combine_chunks()
                b = b.slice(cut)
        held.append(b)
        last = key[-1]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def decide(batches: Iterator[pa.RecordBatch], most: int = MOST) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor to ranges and requests; ``same`` of a request is 1 if its anchor is to be split."""
    for t in whole_runs(batches, 1):
        kind, anchor, same, id_, h, start, own = (t.column(i).to_numpy() for i in range(7))
        done = kind == SPAN
        if done.any():
            yield _rows(SPAN, anchor[done], same[done], id_[done], h[done], start[done], own[done])
        anchor, same, id_, h, start, own = (x[~done] for x in (anchor, same, id_, h, start, own))
        by, first = _first_of_equals(anchor, same, id_, h, start)
        rest = by[~first]
        if len(rest):
            yield _spans(id_[rest], h[rest], start[rest], own[rest])
        keep = by[first]
        _, where, many = np.unique(anchor[keep], return_inverse=True, return_counts=True)
        asked = many[where] > 1
        k = keep[asked]
        if len(k):
            yield _rows(REQUEST, anchor[k], (many[where][asked] > most).astype(np.int64), id_[k], h[k], start[k], own[k])


def repeated(pieces: list[bytes], own: list[int]) -> list[tuple[int, int]]:
    """(piece, window) of the windows that an earlier piece, or an earlier place, holds too."""
    begins, at = [], 0
    for p in pieces:
        begins.append(at)
        at += len(p) + 1
    text = b"\0".join(pieces)
    owner = [-1] * len(text)
    for k, (b, n) in enumerate(zip(begins, own, strict=True)):
        owner[b : b + n] = [k] * n
    out, run, head = [], [], None
    for i in suffix_array(text):
        if owner[i] < 0:
            continue
        window = text[i : i + LENGTH]
        if window == head:
            run.append(i)
            continue
        if len(run) > 1:
            run.remove(min(run))
            out += run
        run, head = [i], window
    if len(run) > 1:
        run.remove(min(run))
        out += run
    return sorted((owner[i], i - begins[owner[i]]) for i in out)


def meets_another(anchor: np.ndarray, own: np.ndarray, raw: pa.ChunkedArray) -> np.ndarray:
    """Whether some window of a context has the hash of another window of its anchor: without one, nothing in it repeats."""
    data, at = T.buffers(raw)
    begin = np.repeat(at[:-1] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))
    key = T.mix(T.hash_spans(data, begin, begin + LENGTH, lower=False) ^ np.repeat(T.mix(anchor.view(U)), own))
    _, where, many = np.unique(key, return_inverse=True, return_counts=True)
    return T.sums(many[where] > 1, own.astype(np.int64)) > 0


def sort_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, id, h, start, own, bytes) sorted by anchor to removed ranges."""
    for t in whole_runs(batches, 0):
        anchor, id_, h, start, own = (t.column(i).to_numpy() for i in range(5))
        raw = t.column(5)
        alone = ~meets_another(anchor, own, raw)
        by = np.lexsort((start, h, id_, anchor))
        by = by[~alone[by]]
        if not len(by):
            continue
        cut = np.flatnonzero(np.concatenate([[True], anchor[by][1:] != anchor[by][:-1]]))
        found: list[tuple[int, int]] = []
        for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(by)], strict=True):
            rows = by[lo:hi].tolist()
            if len(rows) == 1:
                continue
            pieces: dict[bytes, int] = {}
            for r in rows:
                p = raw[r].as_py()
                if p in pieces:  # equal bytes of another task or of a split anchor
                    found += [(r, w) for w in range(int(own[r]))]
                else:
                    pieces[p] = r
            if len(pieces) > 1:
                kept = list(pieces.values())
                found += [(kept[k], w) for k, w in repeated(list(pieces), [int(own[r]) for r in kept])]
        if found:
            r, w = (np.array(x) for x in zip(*found, strict=True))
            yield _spans(id_[r], h[r], start[r].astype(np.int64) + w, np.ones(len(r), np.int64))


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, ranges) to (id, n_bytes, n_removed, n_spans, kept)."""
    for b in batches:
        ranges = b.column(2)
        values, at = ranges.values, ranges.offsets.to_numpy() if b.num_rows else np.zeros(1, np.int32)
        starts, ends = (values.field(i).to_numpy().astype(np.int64) for i in (0, 1)) if len(values) else (np.empty(0, np.int64),) * 2
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for c in T.chunks(b.column(1)):
            for d in range(c.last - c.first):
                lo, hi = at[c.first + d], at[c.first + d + 1]
                text = c.data[c.offsets[d] : c.offsets[d + 1]]
                n_bytes.append(len(text))
                if lo == hi:
                    n_removed.append(0)
                    n_spans.append(0)
                    kept.append(text.tobytes())
                    continue
                edge = np.zeros(len(text) + 1, np.int64)
                np.add.at(edge, starts[lo:hi], 1)
                np.add.at(edge, ends[lo:hi], -1)
                gone = np.cumsum(edge[:-1]) > 0
                n_removed.append(int(gone.sum()))
                n_spans.append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()))
                kept.append(text[~gone].tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])


def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same with the kept bytes' digest in place of them."""
    for b in cut_out(batches):
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array([hashlib.sha256(x.as_py()).hexdigest() for x in b.column(4)], pa.string())], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _release(spark) -> None:
    """Lets Spark drop the shuffle files of finished steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def removed_ranges(own: DataFrame, most: int = MOST) -> DataFrame:
    """Rows (id, h, ranges) for the documents (id, h, text) that lose bytes."""
    spark = own.sparkSession
    T.scan_conf(spark)
    hot = spark.sparkContext.broadcast(np.array(sorted(hot_anchors(own)), np.int64).view(U))
    found = own.mapInArrow(lambda batches: gather(batches, hot.value), ROW)
    decided = T.written(spark, found.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(lambda batches: decide(batches, most), ROW))
    _release(spark)
    asked = decided.where(F.col("kind") == REQUEST).select("anchor", F.col("same").alias("split"), "id", "h", "start", "own").hint("merge")
    fetched = own.join(asked, ["id", "h"]).select("anchor", "split", "id", "h", "start", "own", F.substring(F.col("text").cast("binary"), F.col("start") + 1, F.col("own") + (LENGTH - 1)).alias("bytes"))
    window = F.substring(F.col("bytes"), F.col("o") + 1, F.lit(LENGTH))
    opened = fetched.withColumn("o", F.explode(F.when(F.col("split") == 1, F.expr("sequence(0, own - 1)")).otherwise(F.expr("array(0)"))))
    split = F.col("split") == 1
    pieces = opened.select(F.when(split, F.xxhash64(window)).otherwise(F.col("anchor")).alias("anchor"), "id", "h", (F.col("start") + F.col("o")).alias("start"), F.when(split, 1).otherwise(F.col("own")).alias("own"), F.when(split, window).otherwise(F.col("bytes")).alias("bytes"))
    sorted_out = T.written(spark, pieces.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sort_windows, ROW))
    _release(spark)
    both = decided.where(F.col("kind") == SPAN).unionByName(sorted_out)
    return both.groupBy("id", "h").agg(F.collect_list(F.struct("start", (F.col("start") + F.col("own")).alias("end"))).alias("ranges"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", digests: bool = False, most: int = MOST) -> DataFrame:
    """Rows (key, n_bytes, n_removed, n_spans, kept) for every row; ``kept_sha256`` instead of ``kept`` with ``digests``."""
    spark = docs.sparkSession
    own = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(key), F.lit(-(1 << 63))).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # a hash of the text tells rows of one id apart; without such rows it is left out
    twice = bool(own.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count())
    own = own.withColumn("h", F.xxhash64("text") if twice else F.lit(0).cast("long"))
    one_each = own.select("id", "h", "text")
    # a repeated row is the same document, not an earlier one
    one_each = one_each.dropDuplicates(["id", "h"]) if twice else one_each
    ranges = removed_ranges(one_each, most).hint("merge")
    met = own.join(ranges, ["id", "h"], "left").select("_id", "text", F.coalesce("ranges", F.array().cast("array<struct<start:int,end:int>>")).alias("ranges"))
    last = "kept_sha256 string" if digests else "kept binary"
    T.scan_conf(spark)
    kind = dict(docs.dtypes)[key]
    out = met.mapInArrow(digest if digests else cut_out, f"id {kind}, n_bytes long, n_removed long, n_spans long, {last}")
    return out.withColumnRenamed("id", key)
