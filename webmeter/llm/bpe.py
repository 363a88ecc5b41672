"""Byte-level BPE encoding and decoding with a vectorised pre-tokeniser.

Texts become arrays of code-point classes.  The splitting pattern

    's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^ s L N]+|s+(?!S)|s+

(L letters, N numbers, s white space) is a finite transducer once each class
carries its short look-ahead, and transition functions compose associatively:
blocks of the array are scanned side by side, then the blocks' totals, and
every position learns its state without walking the text or using a regex.
The slices between boundaries feed a bounded cache of merged pieces; each
piece's ids are kept packed, with the token lengths that give offsets back.

Defined cases: a null or empty text has no token; very long pieces are merged
with a heap; ids that are not in the vocabulary cannot be decoded (KeyError);
repeated rows encode alike; other columns pass through.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as ST

from . import text as T

LETTER, NUMBER, OTHER, ONE, TWO, BODY, LAST, LINE = range(8)
S0, SL, SN, SO, SB, SP, S1, S2 = range(8)
BLOCK = 256
CACHE = 250_000
HEAP_FROM = 96
#: Code points with the White_Space property.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.lru_cache(1)
def classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or BODY (white space) of each code point."""
    kind = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE] = BODY
    return out


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a piece starts at this symbol."""
    if state in (S1, S2):
        return (S0 if state == S1 else S1), False
    if symbol == LETTER:
        return SL, state not in (SL, SP)
    if symbol == NUMBER:
        return SN, state not in (SN, SP)
    if symbol in (OTHER, ONE, TWO):
        starts = state not in (SO, SP)
        return (SO if symbol == OTHER or not starts else S1 if symbol == ONE else S2), starts
    if symbol == BODY:
        return SB, state != SB
    return (SP if symbol == LAST else S0), True


@functools.lru_cache(1)
def machine() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Function of each symbol, composition table, functions by id, and start flags by (state, symbol).

    Symbols from 8 on are those of a document's first code point: they act as
    from the initial state.
    """
    of = lambda s: tuple(_step(S0 if s >= 8 else q, s % 8)[0] for q in range(8))
    known: dict[tuple[int, ...], int] = {}
    gens = [of(s) for s in range(16)]
    todo = [tuple(range(8)), *gens]
    while todo:
        f = todo.pop()
        if f not in known:
            known[f] = len(known)
            todo += [tuple(g[x] for x in f) for g in gens]
    table = np.array(sorted(known, key=known.get), np.uint8)
    compose = np.array([[known[tuple(int(g[x]) for x in f)] for g in table] for f in table], np.uint16)
    starts = np.array([[s >= 8 or _step(q, s)[1] for s in range(16)] for q in range(8)])
    return np.array([known[g] for g in gens], np.uint16), compose, table, starts


def states_before(symbols: np.ndarray) -> np.ndarray:
    """State before each symbol, by a blocked scan of composed transition functions."""
    function, compose, table, _ = machine()
    n = len(symbols)
    rows = -(-n // BLOCK)
    padded = np.zeros(rows * BLOCK, np.int64)
    padded[:n] = symbols
    f = function[padded].reshape(rows, BLOCK).T.copy()
    width = len(compose)
    flat = compose.ravel()
    for j in range(1, BLOCK):
        f[j] = flat[f[j - 1].astype(np.int64) * width + f[j]]
    state, entry = S0, np.empty(rows, np.uint8)
    tables = table.tolist()
    for r, total in enumerate(f[-1].tolist()):
        entry[r] = state
        state = tables[total][state]
    out = np.empty((BLOCK, rows), np.uint8)
    out[0] = entry
    out[1:] = table[f[:-1].astype(np.int64), entry]
    return out.T.reshape(-1)[:n]


def boundaries(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where a piece starts, over a chunk of whole documents."""
    if not len(data):
        return np.empty(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    symbol = classes()[points]
    first = np.zeros(len(points) + 1, bool)
    first[np.searchsorted(at, offsets[:-1][np.diff(offsets) > 0])] = True
    first[-1] = True
    white = symbol == BODY
    beyond = np.append(white[1:], True) | first[1:]
    last = white & ~beyond
    symbol[last] = np.where(points[last] == 32, LAST, LINE)
    quote = np.flatnonzero(points == 39)
    if len(quote):
        ahead = np.concatenate([points, np.zeros(2, np.uint32)])
        ends = np.concatenate([first, [True, True]])
        a = np.where(ends[quote + 1], 0, ahead[quote + 1])
        b = np.where(ends[quote + 1] | ends[quote + 2], 0, ahead[quote + 2])
        symbol[quote[np.isin(a, [ord(c) for c in "stmd"])]] = ONE
        pairs = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        symbol[quote[pairs]] = TWO
    symbol = symbol + np.where(first[:-1], 8, 0).astype(np.uint8)
    starts = machine()[3][states_before(symbol), symbol]
    return at[starts]


class Vocabulary:
    """Ranks of byte sequences with cached merging; made once in each worker."""

    def __init__(self, content: bytes, size: int = CACHE):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
        # all pieces one after the other, and where each begins
        by_id = {r: p for p, r in self.ranks.items()}
        self.size_of = np.zeros(max(by_id, default=-1) + 1, np.int64)
        for i, p in by_id.items():
            self.size_of[i] = len(p)
        self.begin = np.cumsum(self.size_of) - self.size_of
        self.blob = np.frombuffer(b"".join(by_id[i] for i in sorted(by_id)), np.uint8)
        self.size, self.young, self.old = size, {}, {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the adjacent pair of lowest rank is merged, leftmost first, until none is left."""
        get, big = self.ranks.get, 1 << 60
        if (whole := get(piece)) is not None:
            return [whole]
        if len(piece) >= HEAP_FROM:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], big) for i in range(len(piece) - 1)]
        while pairs and (low := min(pairs)) < big:
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], big)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], big)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        get, n = self.ranks.get, len(piece)
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1") * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or (j := end[i]) >= n or not alive[j] or end[j] != stop:
                continue
            alive[j], end[i] = 0, stop
            if stop < n:
                before[stop] = i
                if (r := get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        return [self.ranks[piece[i : end[i]]] for i in range(n) if alive[i]]

    def packed(self, piece: bytes) -> bytes:
        """Ids of a piece as little-endian 32-bit integers, cached in two generations."""
        got = self.old.get(piece)
        if got is None:
            got = np.array(self.merge(piece), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self.young) >= self.size:
                self.old, self.young = self.young, {}
            self.young[piece] = got
        return got

    def encode_chunk(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Packed ids of each document of a chunk."""
        cuts = boundaries(data, offsets)
        raw, out = data.tobytes(), []
        at = cuts.tolist() + [len(raw)]
        per = np.searchsorted(cuts, offsets).tolist()
        packed = self.packed
        for lo, hi, end in zip(per, per[1:], offsets[1:].tolist(), strict=False):
            get = self.young.get
            own = at[lo:hi] + [end]
            out.append(b"".join([get(p) or packed(p) for p in map(raw.__getitem__, map(slice, own, own[1:]))]))
        return out

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of each token."""
        return self.size_of[ids]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where each token begins in its text's bytes, and the end of the last."""
        at = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.lengths(ids), out=at[1:])
        return at

    def decode(self, ids: np.ndarray, at: np.ndarray | None = None) -> bytes:
        """The bytes of the ids: every token's piece at its offset."""
        at = self.offsets(ids) if at is None else at
        if not len(ids):
            return b""
        source = np.ones(int(at[-1]), np.int64)
        source[at[:-1]] = self.begin[ids]
        source[at[1:-1]] -= self.begin[ids[:-1]] + self.size_of[ids[:-1]] - 1
        return self.blob[np.cumsum(source, out=source)].tobytes()


@functools.lru_cache(2)
def vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


OUTPUTS = {
    "n_tokens": (ST.LongType(), pa.int64()),
    "ids": (ST.BinaryType(), pa.binary()),
    "offsets": (ST.BinaryType(), pa.binary()),
    "decoded": (ST.BinaryType(), pa.binary()),
    "ids_sha256": (ST.StringType(), pa.string()),
    "decoded_sha256": (ST.StringType(), pa.string()),
}


def rank_file(spark: SparkSession, path: str):
    """A broadcast of the rank file (about a megabyte, whatever the input)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks, text: str = "text", outputs: tuple[str, ...] = ("n_tokens", "ids"), keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the chosen ``outputs`` (replaced if they exist).

    ``ids`` are packed little-endian unsigned 32-bit integers, ``offsets`` the
    tokens' starts in the text's bytes as 64-bit integers; ``decoded`` is made
    from the ids alone.
    """
    docs = docs.drop(*outputs)
    names = docs.columns
    kept = names if keep is None else [c for c in keep if c in names]
    schema = ST.StructType([*docs.select(*kept).schema.fields, *(ST.StructField(o, OUTPUTS[o][0]) for o in outputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(ranks.value)
        for b in batches:
            rows: dict[str, list] = {o: [] for o in outputs}
            for c in T.chunks(b.column(names.index(text))):
                for packed in vocab.encode_chunk(c.data, c.offsets):
                    ids = np.frombuffer(packed, "<u4")
                    at = vocab.offsets(ids)
                    back = vocab.decode(ids, at) if "decoded" in rows or "decoded_sha256" in rows else b""
                    for o, put in rows.items():
                        if o == "n_tokens":
                            put.append(len(ids))
                        elif o == "ids":
                            put.append(packed)
                        elif o == "offsets":
                            put.append(at[:-1].astype("<i8").tobytes())
                        elif o == "decoded":
                            put.append(back)
                        else:
                            put.append(hashlib.sha256(packed if o == "ids_sha256" else back).hexdigest())
            yield pa.RecordBatch.from_arrays([*(b.column(names.index(c)) for c in kept), *(pa.array(rows[o], OUTPUTS[o][1]) for o in outputs)], [*kept, *outputs])

    T.scan_conf(docs.sparkSession)
    return docs.mapInArrow(run, schema)
