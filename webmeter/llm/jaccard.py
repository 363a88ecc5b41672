"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

Two texts are linked if the Jaccard similarity of their sets of five-word
shingles is at least 0.8.  Texts with equal sets form one class, so that copies
are never expanded.

Every class has a forest of tries; a tree's key is a sequence of minimum hashes
and classes under one trie node, that is with one prefix of the key, are
candidates.  A prefix of length d keeps the target recall at the threshold if
``trees_for(d)`` trees are grown, so a class starts with the longest prefix and
shortens it until the trees that it has are enough: ``depth_for`` of the base
forest's ``TREES``.  Where that prefix is too short for the crowd (a component of
more than ``CROWDED`` blocks of candidates that hang together by chains or by passages shared
by many, while most of them have no trie node in common), the classes concerned,
and only they, get more trees, and with them a longer prefix, of ``DEPTHS`` in
turn: the length of a prefix depends on the neighbourhood, the recall does not.

Candidates are joined into components and verified exactly by products of
shingle incidence matrices.  A component that still has more than ``BLOCK``
classes (near copies of one text, mostly) is cut into blocks and each
pair of blocks is a task of its own, so no task holds more than two blocks
whatever the skew; a task returns numbers of links and a spanning forest, never
pairs.  A component of b blocks sends each of its sets b times.

Defined cases: a null text is empty; a text without words is linked to nothing
and is a class of its own row; a text of one to four words has one shingle;
repeated rows are copies; a null id stays null (such rows are still counted as
partners); other columns are ignored.  Sets are told apart by two 64-bit
hashes; candidates and links name a set by the first of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from . import text as T
from .components import components

SHINGLE = 5
NUMERATOR, DENOMINATOR = 4, 5
TREES = 32
DEPTH = 8
#: Longer prefixes for crowded neighbourhoods; ``STRIDE`` hashes of a tree at most.
DEPTHS = (8, 12)
STRIDE = 16
RECALL = 0.99999
BLOCK = 512
#: Blocks from which on a component is crowded: below, verifying its pairs of blocks costs less than growing it again.
CROWDED = 8
#: Members of a crowded component that tell whether it hangs together loosely: less than half of their pairs meet.
SAMPLED = 64
COLUMNS = 4096
THRESHOLD = NUMERATOR / DENOMINATOR
U = np.uint64


def recall_of(depth: int, trees: int, similarity: float = THRESHOLD) -> float:
    """Probability that two sets of a similarity share a prefix in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def depth_for(trees: int, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The prefix, shortened from the full depth until the trees reach the recall at the threshold."""
    while depth > 1 and recall_of(depth, trees) < recall:
        depth -= 1
    return depth


def trees_for(depth: int, recall: float = RECALL) -> int:
    """The trees that a prefix of this length needs for the recall at the threshold."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - THRESHOLD**depth)))


def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and increments of the hash functions, from a fixed rule."""
    a = T.mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15))
    return (a >> U(32)).astype(np.uint32) | np.uint32(1), (a & U(0xFFFFFFFF)).astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and their numbers."""
    starts, ends, counts = T.spans(data, offsets)
    h, many = T.shingles(T.hash_spans(data, starts, ends), counts, SHINGLE)
    at = np.concatenate([[0], np.cumsum(many)]).tolist()
    parts = [np.unique(h[a:b]) for a, b in zip(at, at[1:], strict=False)]
    return np.concatenate(parts) if parts else np.empty(0, U), np.array([len(p) for p in parts], np.int64)


def identities(sets: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each set."""
    return T.sums(T.mix(sets + U(0x5851F42D4C957F2D)), many).view(np.int64), T.sums(T.mix(sets ^ U(0x14057B7EF767814F)), many).view(np.int64)


def prefixes(sets: np.ndarray, many: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Key of the trie node at ``depth`` of each tree (columns) for each non-empty set (rows)."""
    a, b = multipliers(trees * STRIDE)
    x = (sets >> U(32)).astype(np.uint32)
    at = (np.cumsum(many) - many)[many > 0]
    keys = np.empty((len(at), trees), U)
    y = np.empty_like(x)
    for t in range(trees):
        key = np.full(len(at), U(t + 1))
        for d in range(depth):
            np.multiply(x, a[t * STRIDE + d], out=y)
            y += b[t * STRIDE + d]
            key = T.mix(key * U(0xD6E8FEB86659FD93) + np.minimum.reduceat(y, at).astype(U))
        keys[:, t] = key
    return keys


def sign(docs: DataFrame, key: str, text: str, trees: int = TREES) -> DataFrame:
    """Rows (_id, th, k1, k2, nodes): a hash of the text, the identity of its set, the trie nodes; all null but th for a text without words."""
    schema = f"_id {dict(docs.dtypes)[key]}, th long, k1 long, k2 long, nodes array<long>"
    depth = depth_for(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in T.chunks(b.column(2)):
                sets, many = shingle_sets(c.data, c.offsets)
                k1, k2 = identities(sets, many)
                some = many > 0
                part = b.slice(c.first, c.last - c.first)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(k1, mask=~some), pa.array(k2, mask=~some), _nodes(sets, many, trees, depth)], ["_id", "th", "k1", "k2", "nodes"])

    T.scan_conf(docs.sparkSession)
    return docs.select(F.col(key).alias("_id"), F.xxhash64(text).alias("th"), F.col(text).alias("_text")).mapInArrow(run, schema)


def _nodes(sets: np.ndarray, many: np.ndarray, trees: int, depth: int) -> pa.Array:
    some = many > 0
    nodes = prefixes(sets, many, trees, depth).view(np.int64) if some.any() else np.empty((0, trees), np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * trees)]).astype(np.int32)), pa.array(nodes.ravel()))


def linked(sets: list[np.ndarray], left: int | None) -> np.ndarray:
    """Boolean matrix of links between sets; with ``left``, only those between the first ``left`` and the rest."""
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    _, where, df = np.unique(flat, return_inverse=True, return_counts=True)
    shared = df > 1
    number = np.cumsum(shared) - 1
    keep = shared[where]
    col, row = number[where[keep]], owner[keep]
    by = np.argsort(col, kind="stable")
    col, row = col[by], row[by]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = int(shared.sum())
    for lo in range(0, width, COLUMNS):
        a, b = np.searchsorted(col, [lo, lo + COLUMNS])
        x = np.zeros((len(sets), min(COLUMNS, width - lo)), np.float32)
        x[row[a:b], col[a:b] - lo] = 1
        both += x @ x.T
    out = (NUMERATOR + DENOMINATOR) * both.astype(np.int64) >= NUMERATOR * (n[:, None] + n[None, :])
    np.fill_diagonal(out, False)
    if left is not None:
        out[:left, :left] = False
        out[left:, left:] = False
    return out


def forest(links: np.ndarray) -> np.ndarray:
    """Least index of each row's component."""
    root = np.arange(len(links))
    while True:
        least = np.where(links, root[None, :], len(links)).min(1, initial=len(links))
        new = np.minimum(root, least)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def verify(table: pa.Table) -> pa.Table:
    """One task: (node, links, root) for the classes of a block, or of two blocks of a component."""
    first = {}
    for i, k in enumerate(table["node"].to_pylist()):
        first.setdefault(k, i)
    rows = sorted(first.values(), key=lambda i: (table["block"][i].as_py(), table["node"][i].as_py()))
    node = table["node"].take(pa.array(rows)).to_numpy()
    block = table["block"].take(pa.array(rows)).to_numpy()
    n = table["n"].take(pa.array(rows)).to_numpy()
    sets = [np.frombuffer(table["set"][i].as_py(), U) for i in rows]
    same = table["lo"][0].as_py() == table["hi"][0].as_py()
    links = linked(sets, None if same else int((block == table["lo"][0].as_py()).sum()))
    return pa.table({"node": node, "links": links @ n.astype(np.int64), "root": node[forest(links)]})


def under_one_node(nodes: DataFrame) -> DataFrame:
    """(node, root) of the classes (node, nodes) that trie nodes join; sides that grow with the input are merged, never broadcast."""
    bands = nodes.select("node", F.explode("nodes").alias("band"))
    many = bands.groupBy("band").agg(F.min("node").alias("m"), F.max("node").alias("x")).where("m < x").select("band", "m").hint("merge")
    return T.written(nodes.sparkSession, components(bands.join(many, "band").where("node <> m").select(F.col("node").alias("u"), F.col("m").alias("v")).distinct()))


class _Texts:
    """Texts of classes, one row a class: by id and hash of its first copy."""

    def __init__(self, docs: DataFrame, key: str, text: str, copies: DataFrame, repeated: bool):
        self.own = docs.select(F.coalesce(F.col(key), F.lit(0)).alias("_i"), F.col(key).isNull().alias("_none"), F.xxhash64(text).alias("th"), F.col(text).alias("_text"))
        self.copies = copies
        self.repeated = repeated

    def of(self, wanted: DataFrame, merge: bool = True) -> DataFrame:
        """``wanted`` (node, ...) with ``_text``; without ``merge`` the session's limit of size decides how they are joined."""
        at = self.copies.select(F.col("k1").alias("node"), F.coalesce("head.id", F.lit(0)).alias("_i"), F.col("head.none").alias("_none"), F.col("head.th").alias("th"))
        placed = wanted.join(at, "node")
        found = self.own.join(placed.hint("merge") if merge else T.written(self.own.sparkSession, placed), ["_i", "_none", "th"]).select(*wanted.columns, "_text")
        return found.dropDuplicates(["node"]) if self.repeated else found


def resigned(texts: DataFrame, depth: int) -> DataFrame:
    """(node, nodes) of classes (node, _text) with the trees that a longer prefix needs."""
    trees = trees_for(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in T.chunks(b.column(1)):
                sets, many = shingle_sets(c.data, c.offsets)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.first, c.last - c.first), _nodes(sets, many, trees, depth)], ["node", "nodes"])

    return texts.select("node", "_text").mapInArrow(run, "node long, nodes array<long>")


def loose(member: DataFrame, signed: DataFrame, block: int) -> DataFrame:
    """Roots of the components with more than ``CROWDED`` blocks of which most pairs, in a sample of ``SAMPLED`` classes, share no trie node."""
    crowded = member.groupBy("root").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CROWDED * block).select("root")
    few = Window.partitionBy("root").orderBy(F.xxhash64("node"))
    some = member.join(crowded, "root").withColumn("place", F.row_number().over(few)).where(F.col("place") <= SAMPLED).select("root", F.col("node").alias("k1"))
    nodes = some.join(signed.where("k1 is not null").select("k1", "nodes"), "k1").dropDuplicates(["k1"])

    def spread(t: pa.Table) -> pa.Table:
        x = np.stack([np.array(n) for n in t["nodes"].to_pylist()])
        met = (x[:, None, :] == x[None, :, :]).any(2)
        m = len(x)
        return pa.table({"root": t["root"].slice(0, 1).combine_chunks() if 2 * (int(met.sum()) - m) < m * (m - 1) else pa.array([], pa.int64())})

    return nodes.select("root", "nodes").groupBy("root").applyInArrow(spread, "root long")


def candidates(signed: DataFrame, texts: _Texts, block: int, depths: tuple[int, ...] = DEPTHS) -> DataFrame:
    """(node, root): components of candidates; crowded ones are grown again with longer prefixes."""
    spark = signed.sparkSession
    member = under_one_node(signed.where("k1 is not null").select(F.col("k1").alias("node"), "nodes"))
    for depth in depths:
        if not member.groupBy("root").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CROWDED * block).limit(1).count():
            break
        crowded = T.written(spark, loose(member, signed, block))
        if not crowded.limit(1).count():
            break
        signed = T.written(spark, resigned(texts.of(member.join(crowded.hint("merge"), "root").select("node"), merge=False), depth)).withColumnRenamed("node", "k1")
        finer = under_one_node(signed.withColumnRenamed("k1", "node"))
        member = T.written(spark, member.join(crowded.hint("merge"), "root", "left_anti").select("node", "root").unionByName(finer))
    return member


def classes(docs: DataFrame, signed: DataFrame, key: str, text: str, block: int = BLOCK) -> DataFrame:
    """One row per distinct shingle set: k1, k2, class_id, copy_id, th, n_links, first.

    ``first`` marks the set that holds the first row of its class (least id,
    a null id last).
    """
    spark = docs.sparkSession
    first_row = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), "th")
    copies = T.written(spark, signed.where("k1 is not null").groupBy("k1", "k2").agg(F.min(first_row).alias("head"), F.count(F.lit(1)).alias("n")))
    repeated = bool(signed.groupBy("_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count())
    texts = _Texts(docs, key, text, copies, repeated)
    member = candidates(signed, texts, block)
    sizes = member.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    placed = member.join(sizes, "root").withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    wanted = T.written(spark, copies.join(placed, F.col("k1") == F.col("node")).select("node", "root", "blocks", "block", "n"))
    held = texts.of(wanted)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in T.chunks(b.column(5)):
                sets, many = shingle_sets(c.data, c.offsets)
                k1, _ = identities(sets, many)
                at = np.concatenate([[0], np.cumsum(many)]).tolist()
                part = b.slice(c.first, c.last - c.first)
                right = np.flatnonzero(k1 == part.column(0).to_numpy())  # two texts of one id may share a hash
                take = pa.array(right)
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(take) for i in range(5)), pa.array([sets[at[i] : at[i + 1]].tobytes() for i in right], pa.binary())], ["node", "root", "blocks", "block", "n", "set"])

    loaded = held.mapInArrow(load, "node long, root long, blocks int, block int, n long, set binary")
    pairs = loaded.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select("root", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "n", "set")
    checked = T.written(spark, pairs.groupBy("root", "lo", "hi").applyInArrow(lambda t: verify(t), "node long, links long, root long"))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    if wanted.where("blocks > 1").limit(1).count():
        grouped = components(checked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    else:
        grouped = checked.where("node <> root").select("node", "root")
    named = links.join(grouped, "node", "left").select(F.col("node").alias("k1"), "links", F.coalesce("root", "node").alias("root"))
    known = copies.join(named, "k1", "left").withColumn("root", F.coalesce("root", "k1"))
    order = F.struct("head", "k1", "k2")
    least = known.groupBy("root").agg(F.min("head.id").alias("class_id"), F.min(order).alias("top"))
    mine = (F.col("top.k1") == F.col("k1")) & (F.col("top.k2") == F.col("k2"))
    return known.join(least, "root").select("k1", "k2", "class_id", F.col("head.id").alias("copy_id"), F.col("head.th").alias("th"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), mine.alias("first"))


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", trees: int = TREES, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: key, class_id, copy_id, n_links.

    ``copy_id`` is the least id among rows with an equal shingle set, ``class_id``
    the least id that verified links lead to, ``n_links`` the number of other
    rows with similarity 0.8 or more, copies included.
    """
    signed = T.written(docs.sparkSession, sign(docs, key, text, trees))
    own = classes(docs, signed, key, text, block).drop("th").hint("merge")
    out = signed.select("_id", "k1", "k2").join(own, ["k1", "k2"], "left")
    return out.select(F.col("_id").alias(key), F.coalesce("class_id", "_id").alias("class_id"), F.coalesce("copy_id", "_id").alias("copy_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", trees: int = TREES, block: int = BLOCK) -> DataFrame:
    """``docs`` with one row of each class: that of the least id (null last; of equal rows any one).

    Rows without words all stay.
    """
    spark, names = docs.sparkSession, docs.columns
    signed = T.written(spark, sign(docs, key, text, trees))
    heads = classes(docs, signed, key, text, block).where("first").select("k1", "k2", F.coalesce("copy_id", F.lit(0)).alias("_i"), F.col("copy_id").isNull().alias("_none"), F.lit(True).alias("_head")).hint("merge")
    schema = ST.StructType([ST.StructField("_k1", ST.LongType()), ST.StructField("_k2", ST.LongType()), ST.StructField("_row", docs.schema)])
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k1, k2, some = [], [], []
            for c in T.chunks(b.column(place)):
                sets, many = shingle_sets(c.data, c.offsets)
                a, z = identities(sets, many)
                k1.append(a)
                k2.append(z)
                some.append(many > 0)
            if some:
                none = ~np.concatenate(some)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(k1), mask=none), pa.array(np.concatenate(k2), mask=none), pa.StructArray.from_arrays(b.columns, names)], schema.fieldNames())

    at = ["k1", "k2", "_i", "_none"]
    rows = docs.mapInArrow(run, schema).select(F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), F.coalesce(F.col(f"_row.{key}"), F.lit(0)).alias("_i"), F.col(f"_row.{key}").isNull().alias("_none"), "_row")
    ranked = rows.join(heads, at, "left").where("k1 is null or _head").withColumn("_n", F.row_number().over(Window.partitionBy(*at).orderBy("k1")))
    return ranked.where("k1 is null or _n = 1").select("_row.*")
