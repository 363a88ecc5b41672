"""Secret scan: assignment, access-key and long-hex patterns, and a token-efficiency test.

The patterns give the base spans.  The test adds spans of kind ``dense``: runs
of letters, digits and ``+/_=-`` that a byte-level BPE vocabulary cannot
compress (few characters a token), which is how random strings differ from
words.  Known digests, UUIDs, numbers and plain identifiers are excluded
before, as is a run that lies inside a base span.  An identifier's long parts
must compress like words (more characters a token than random letters have).

Spans are code-point offsets, end exclusive.  Defined cases: a null or empty
text has no span; a text may have any number of spans; repeated rows are
scanned alike; other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as ST

from . import bpe
from . import text as T

KINDS = ("assign", "access", "hex", "dense")
#: The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: A text can only hold an assignment if it holds one of these in lower case.
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Least length of a run, and characters a token below which it counts as random.
DENSE_LENGTH = 16
DENSE_RATIO = 2.2
_DENSE = np.zeros(256, bool)
_DENSE[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_=-"]] = True
_HEXDIGIT = np.zeros(256, bool)
_HEXDIGIT[[*range(48, 58), *range(97, 103)]] = True
UUID = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE)
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.IGNORECASE)
#: Characters a token from which letters of a regular case count as words.
WORD_RATIO = 1.75
#: Words and trailing numbers joined by one sign, or camel case: names, not random strings.
IDENTIFIER = re.compile(r"(?:[A-Za-z]{2,}|[0-9]+)(?:[-_/+=][A-Za-z]{2,}|[-_/+=][0-9]+)*[-_/+=]*|[A-Za-z][a-z]+(?:[A-Z][a-z]+)*[0-9]{0,4}")

LETTERS = re.compile(r"[A-Za-z]+")
REGULAR = re.compile(r"[A-Z]+|[A-Za-z]?[a-z]+(?:[A-Z][a-z]+)*")


def runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of member bytes, at least ``least`` long, that do not cross documents."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1 : n + 1] = member[data]
    begin, end = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    edge = edge[inside[edge] & inside[edge + 1]]
    begin[edge] = end[edge] = True
    a, b = np.flatnonzero(begin), np.flatnonzero(end)
    keep = b - a >= least
    return a[keep], b[keep]


def word_like(part: str, vocab: bpe.Vocabulary) -> bool:
    """Whether letters are of a regular case and, where they are long enough to tell, compress like words."""
    return bool(REGULAR.fullmatch(part)) and (len(part) < DENSE_LENGTH or len(part) / len(vocab.merge(part.encode())) >= WORD_RATIO)


def random_looking(value: str, vocab: bpe.Vocabulary, ratio: float = DENSE_RATIO) -> bool:
    """The token-efficiency test on one run, exclusions first."""
    if value.isdigit() or UUID.fullmatch(value) or DIGEST.fullmatch(value) or not any(c.isalnum() for c in value):
        return False
    named = IDENTIFIER.fullmatch(value) or not any(c.isdigit() for c in value)
    if named and all(word_like(p, vocab) for p in LETTERS.findall(value)):
        return False
    return len(value) / len(vocab.merge(value.encode())) < ratio


def base_spans(text: str, assign: bool, access: bool, hexes: bool) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns; a flag says whether a kind can occur at all."""
    out = []
    if assign:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if access:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if hexes:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return sorted(out)


def scan_chunk(data: np.ndarray, offsets: np.ndarray, vocab: bpe.Vocabulary, ratio: float = DENSE_RATIO) -> list[list[tuple[int, int, int]]]:
    """Sorted (start, kind number, end) spans of each text of a chunk."""
    raw = data.tobytes()
    low = T.LOWER[data].tobytes()
    n = len(offsets) - 1
    flags = np.zeros((3, n), bool)

    def mark(row: int, places: np.ndarray) -> None:
        if len(places):
            flags[row, np.searchsorted(offsets, places, "right") - 1] = True

    for row, words, where in ((0, WORDS, low), (1, (b"AKIA",), raw)):
        for w in words:
            found, at = [], where.find(w)
            while at >= 0:
                found.append(at)
                at = where.find(w, at + 1)
            mark(row, np.array(found, np.int64))
    mark(2, runs(data, offsets, _HEXDIGIT, LEAST["hex"])[0])
    begin, end = runs(data, offsets, _DENSE, DENSE_LENGTH)
    owner = np.searchsorted(offsets, begin, "right") - 1
    dense: dict[int, list[tuple[int, int]]] = {}
    for a, b, d in zip(begin.tolist(), end.tolist(), owner.tolist(), strict=True):
        if random_looking(raw[a:b].decode(), vocab, ratio):
            dense.setdefault(d, []).append((a, b))
    # code points before each byte
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    for d in {*np.flatnonzero(flags.any(0)).tolist(), *dense}:
        a, b = int(offsets[d]), int(offsets[d + 1])
        spans = base_spans(raw[a:b].decode(), *flags[:, d].tolist()) if flags[:, d].any() else []
        if d in dense:
            begins = [s for s, _, _ in spans]
            reach = list(accumulate((e for _, _, e in spans), max))
            more = []
            for x, y in dense[d]:
                start = int(points[x] - points[a])
                stop = start + y - x
                before = bisect_right(begins, start)
                if not before or reach[before - 1] < stop:
                    more.append((start, 3, stop))
            spans = spans + more
        out[d] = sorted(spans)
    return out


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each maximal covered range replaced by ``mark``."""
    out, at, i = [], 0, 0
    while i < len(spans):
        a, _, b = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] <= b:
            i += 1
            b = max(b, spans[i][2])
        out += [text[at:a], mark]
        at, i = b, i + 1
    return "".join(out) + text[at:]


OUTPUTS = {"n_assign": (ST.LongType(), pa.int64()), "n_access": (ST.LongType(), pa.int64()), "n_hex": (ST.LongType(), pa.int64()), "n_dense": (ST.LongType(), pa.int64()), "base_sha256": (ST.StringType(), pa.string()), "spans": (ST.StringType(), pa.string()), "redacted": (ST.StringType(), pa.string())}


def scan(docs: DataFrame, ranks, text: str = "text", outputs: tuple[str, ...] = ("spans",), keep: list[str] | None = None, ratio: float = DENSE_RATIO, called: dict[str, str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the chosen ``outputs`` (replaced if they exist), under the names ``called`` gives them.

    ``redacted`` is the text with the spans replaced; a null text stays null.
    """
    titles = [(called or {}).get(o, o) for o in outputs]
    docs = docs.drop(*titles)
    names = docs.columns
    kept = names if keep is None else [c for c in keep if c in names]
    schema = ST.StructType([*docs.select(*kept).schema.fields, *(ST.StructField(t, OUTPUTS[o][0]) for t, o in zip(titles, outputs, strict=True))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = bpe.vocabulary(ranks.value)
        for b in batches:
            column = b.column(names.index(text))
            found = [s for c in T.chunks(column) for s in scan_chunk(c.data, c.offsets, vocab, ratio)]
            made = {}
            for o in outputs:
                if o == "spans":
                    made[o] = [shown(s) for s in found]
                elif o == "base_sha256":
                    made[o] = [hashlib.sha256(shown([x for x in s if x[1] < 3]).encode()).hexdigest() for s in found]
                elif o == "redacted":
                    made[o] = [redact(column[i].as_py(), s) if s else column[i].as_py() for i, s in enumerate(found)]
                else:
                    k = KINDS.index(o[2:])
                    made[o] = [sum(x[1] == k for x in s) for s in found]
            yield pa.RecordBatch.from_arrays([*(b.column(names.index(c)) for c in kept), *(pa.array(made[o], OUTPUTS[o][1]) for o in outputs)], [*kept, *titles])

    T.scan_conf(docs.sparkSession)
    return docs.mapInArrow(run, schema)
