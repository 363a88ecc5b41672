"""Corpus queries and operators on Spark, against brute force and on hard rows."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from webmeter.llm import bpe, chat, decontaminate, fingerprints, jaccard, maxent, quality, queries, secret_scan, suffix_dedup, toxicity

FOLDER = f"{compare.DATA}/sf0.001"
LONG = "word " * 30_000
HARD = [(1, "a b c d e f g", "x", 1.0), (1, "a b c d e f g", "x", 1.0), (2, None, None, None), (3, "", "y", 2.0), (None, "null id text here", "z", 3.0), (4, LONG, "x", 4.0), (5, "\n\t ", "x", 5.0), (2, "other text of id two", "x", 6.0)]
#: Extra columns bear names that the operators use themselves.
KIND = "doc_id long, text string, score string, h double"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.fixture
def hard(spark):
    return spark.createDataFrame(HARD, KIND)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], KIND)


def words(text):
    return (text or "").encode().lower().split()


def sets_of(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    compare.same(queries.QUERIES[name](spark, FOLDER), queries.ORACLE_SQL[name], FOLDER)


# language model


def test_lm_counts(spark, texts):
    got = {r.doc_id: r for r in queries.op1_lm_score(spark, FOLDER).collect()}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in texts}
    c = collections.Counter(t for d, x in texts.items() if not held[d] for t in [*words(x), None])
    n, v = sum(c.values()), len(c)
    for d, x in texts.items():
        t = [*words(x), None]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_lm_hard_rows(spark, hard, none):
    rows = maxent.score(hard, F.lit(True)).collect()
    assert len(rows) == len(HARD) and all(math.isfinite(r.score) and r.n_tokens >= 1 for r in rows)
    assert len({(r.score, r.base_score) for r in rows if r.doc_id == 1}) == 1
    assert maxent.score(none, F.lit(True)).count() == 0
    untrained = maxent.score(hard, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in untrained)


# classifiers


@pytest.mark.parametrize(("name", "label", "threshold"), [("op2_toxicity", "toxic", 0.7), ("op3_quality", "quality", 0.3)])
def test_classifier_on_held_out(spark, name, label, threshold):
    folder = f"{compare.DATA}/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = queries.QUERIES[name](spark, folder)
    assert got.where(f"(score >= {threshold}) <> (predicted = 1) or score < 0 or score > 1 or score is null").count() == 0
    rows = got.where("held_out").join(labels, "doc_id").select("score", label).collect()
    one, zero = [r.score for r in rows if r[label] == 1], [r.score for r in rows if r[label] == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in one for b in zero])
    assert auc > 0.9


def test_classifiers_hard_rows(spark, hard, none):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (4, 1), (5, 7), (None, 1)], "doc_id long, y int")
    for m in (quality, toxicity):
        model = m.fit(hard, labels, label="y")
        rows = m.score(hard, model).collect()
        assert len(rows) == len(HARD) and all(0 <= r.score <= 1 for r in rows)
        assert m.score(none, model).count() == 0
        nothing = m.fit(none, labels.where("false"), label="y")
        assert {r.score for r in m.score(hard, nothing).collect()} == {0.5 if m is quality else 0.0}


# chat


def test_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hello"), (1, 2, "bob", "é"), (1, 2, "bob", "é"), (1, 3, None, None), (2, 0, "system", "alone"), (None, 5, "ann", "x")]
    out = {(r.conv_id, r.speaker): r for r in chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(out) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    bob = out[1, "bob"]
    assert bob.text == "<|system|>\nbe kind\n<|user name=ann|>\nhello\n<|assistant|>\né\n<|assistant|>\né\n<|user name=unknown|>\n\n"
    assert [bob.text[int(a) : int(b)] for a, b in (s.split(":") for s in bob.mask.split(","))] == ["é", "é"]
    long = spark.range(1100).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("role"), F.lit("t").alias("text"))
    parts = chat.rotate(long).where("speaker = 'a'").orderBy("part").collect()
    assert [r.n_turns for r in parts] == [512, 512, 76]
    assert chat.rotate(long.where("false")).count() == 0


def test_rotation_in_rows(spark):
    """The rows of a rendering, joined, are the rendering; spans are places in it."""
    talk = [(1, t, "ann" if t % 3 else "bob", f"t{t}") for t in range(511 + 1 + 1)] + [(2, 0, "ann", "first"), (2, 600, "bob", "<|assistant|>\nsecond"), (2, 10**12, "ann", "third"), (3, None, "ann", "n"), (3, -700, "bob", "m"), (3, 511, "ann", "o"), (3, 512, "ann", "p")]
    talk += [(4, t, f"s{t % 7}", "word " * (t % 5)) for t in range(1300)]
    got = chat.rotate(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")).collect()
    whole = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r.part):
        whole[r.conv_id, r.speaker].append(r)
    assert len(whole) == 2 + 2 + 2 + 7 and {k: len(v) for k, v in whole.items() if k[0] < 4} == {(1, "ann"): 2, (1, "bob"): 2, (2, "ann"): 1, (2, "bob"): 1, (3, "ann"): 1, (3, "bob"): 1}
    for (conv, who), rows in whole.items():
        text = "".join(r.text for r in rows)
        turns = sorted((t for t in talk if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0))
        esc = lambda x: x.replace("<|", "<\\|")
        assert text == "".join(("<|assistant|>\n" if r == who else f"<|user name={r}|>\n") + esc(x) + "\n" for _, _, r, x in turns)
        assert [r.start for r in rows] == [sum(len(x.text) for x in rows[:k]) for k in range(len(rows))]
        spans = [s.split(":") for r in rows for s in r.mask.split(",") if r.mask]
        assert [text[int(a) : int(b)] for a, b in spans] == [esc(x) for _, _, r, x in turns if r == who]


# decontamination


def test_benchmark_passages(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    flat = lambda x: b" %s " % b" ".join(words(x))
    want = {(d, i) for d, x in texts.items() for i, y in items.items() if flat(y) in flat(x)}
    got = queries.op5_decontaminate(spark, FOLDER).collect()
    assert want <= {(r.doc_id, r.item_id) for r in got} and want
    for r in got:
        w = words(texts[r.doc_id])[r.first_word : r.first_word + r.n_words]
        a, b = (collections.Counter(tuple(x[i : i + 5]) for i in range(len(x) - 4)) for x in (w, words(items[r.item_id])))
        assert sum((a & b).values()) / sum((a | b).values()) == pytest.approx(r.similarity) and r.similarity >= 0.8


def test_decontamination_groups_and_hard_rows(spark, hard, none, monkeypatch):
    bench = spark.createDataFrame([(1, "a b c d e f g"), (2, None), (None, "x"), (3, ""), (4, "null id text here"), (5, "a b c d e f g")], "item_id long, text string")
    monkeypatch.setattr(decontaminate.item_groups, "__defaults__", ("item_id", "text", 2))
    got = decontaminate.find(hard, bench).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, 4), (1, 1), (1, 1), (1, 5), (1, 5)]
    assert decontaminate.find(hard, bench.where("false")).count() == 0 and decontaminate.find(none, bench).count() == 0
    kept = decontaminate.drop_contaminated(hard, bench)
    assert kept.columns == hard.columns and kept.count() == len(HARD) - 3


# fingerprints


def test_fingerprints(spark, texts):
    got = {r.doc_id: r for r in queries.op6_fingerprints(spark, FOLDER).collect()}
    ids = sorted(texts)
    by_text = collections.defaultdict(set)
    for k, d in enumerate(ids):
        x, y = texts[d], texts[ids[(k + 1) % len(ids)]]
        n, r = len(x), got[d]
        edited = x[: n - n // 2] + y[: n // 2]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text[x].add(r.fingerprint)
        by_text[edited].add(r.edited_fingerprint)
        if n > 400 and x[: n // 2] != y[: n // 2]:
            assert r.near_edited > 0.2
    assert all(len(v) == 1 for v in by_text.values())


def test_syncmers_are_closed_and_context_free(spark):
    a = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen " * 5
    rows = spark.createDataFrame([(0, a), (1, "zero " + a + "seventeen"), (2, "x"), (3, ""), (4, "short text of some words")], "i int, t string").select("i", fingerprints.anchors(F.col("t")).alias("a")).orderBy("i").collect()
    own = {p.hash: p.place for p in rows[0].a}
    moved = {p.hash: p.place for p in rows[1].a}
    assert set(own) <= set(moved) and len(own) > 3
    assert [len(r.a) for r in rows[2:4]] == [1, 1] and len(rows[4].a) > 3


def test_fingerprints_hard_rows(spark, hard, none):
    rows = fingerprints.compare(hard).collect()
    assert len(rows) == len(HARD) and all(r.fingerprint and r.edited_fingerprint for r in rows)
    assert fingerprints.compare(none).count() == 0
    alone = fingerprints.compare(hard.where("doc_id = 4")).first()
    assert alone.near_next == 1.0


def near_of(spark, a, b):
    """(fingerprint of a, fingerprint of b, likeness) of two texts."""
    x, y = fingerprints.compare(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert x.near_next == y.near_next
    return x.fingerprint, y.fingerprint, x.near_next


def test_fingerprints_of_long_texts(spark):
    """All anchors count: a short passage shared by long texts shows, and so does one word changed."""
    r = np.random.default_rng(11)
    draw = lambda n: [f"w{x}" for x in r.integers(0, 1 << 40, n)]
    a, b = draw(20_000), draw(20_000)
    b[9000:9060] = a[100:160]
    near = near_of(spark, " ".join(a), " ".join(b))[2]
    assert 40 / 20_000 < near <= 60 / 20_000
    c = [*a[:7000], "changed", *a[7001:]]
    one, two, near = near_of(spark, " ".join(a), " ".join(c))
    assert one != two and 1 - 25 / 20_000 < near < 1
    repeats = near_of(spark, " ".join(a[:300] * 3), " ".join(a[:300]))[2]
    assert repeats > 0.9


def test_fingerprints_across_the_unit_limit(spark):
    r = np.random.default_rng(12)
    a = " ".join("".join(r.choice(list("abcdefghij"), 4)) for _ in range(60))
    assert near_of(spark, a[:195], a[:205])[2] > 0.9
    got = fingerprints.compare(spark.createDataFrame([(1, a[:300]), (2, "q" * 20)], "doc_id long, text string")).where("doc_id = 1").first()
    assert got.near_edited > 0.4


def test_fingerprints_need_no_python(spark):
    plan = queries.op6_fingerprints(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    plan = queries.op4_chat(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# tokens and secrets


def test_token_round_trip(spark, texts):
    for r in queries.op7_bpe(spark, FOLDER).collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_tokens_hard_rows(spark, hard, none):
    ranks = bpe.rank_file(spark, queries.rank_path())
    out = bpe.encode(hard, ranks, outputs=("n_tokens", "ids", "offsets", "decoded"))
    rows = out.collect()
    assert out.columns[:4] == hard.columns and len(rows) == len(HARD)
    for r in rows:
        assert bytes(r.decoded).decode() == (r.text or "") and len(r.ids) == 4 * r.n_tokens and len(r.offsets) == 8 * r.n_tokens
    assert bpe.encode(none, ranks).count() == 0


BASE = [
    (re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), "assign", 6),
    (re.compile(r"(AKIA[A-Z0-9]+)"), "access", 20),
    (re.compile(r"([0-9a-f]+)"), "hex", 24),
]


def test_secrets(spark, texts):
    kinds = [k for _, k, _ in BASE]
    for r in queries.op10_secrets(spark, FOLDER).collect():
        found = sorted((m.start(), kinds.index(k), m.end()) for p, k, n in BASE for m in p.finditer(texts[r.doc_id]) if len(m[1]) >= n)
        text = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[1] == k for x in found) for k in range(3)]
        assert {x for x in text.split(",") if x} <= set(r.spans.split(","))


def test_secrets_hard_rows(spark, hard, none):
    ranks = bpe.rank_file(spark, queries.rank_path())
    rows = secret_scan.scan(hard, ranks, outputs=("spans", "redacted")).collect()
    assert [r.redacted for r in rows] == [x[1] for x in HARD] and {r.spans for r in rows} == {""}
    assert secret_scan.scan(none, ranks).count() == 0


def test_secrets_of_letters_only(spark):
    """Random letters without a digit are found; words and identifiers are not."""
    r = np.random.default_rng(10)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    keys = ["".join(r.choice(list(letters), n)) for letters in (upper + lower, upper, lower) for n in (24, 32) for _ in range(50)]
    names = ["getUserAccountById", "some_long_identifier_name", "internationalization", "path/to/another/folder", "MAXIMUM_NUMBER_OF_ROWS", "----------------------", "release-2024-10-31"]
    docs = spark.createDataFrame([(i, f"say {x} now") for i, x in enumerate(keys + names)], "doc_id long, text string")
    got = {x.doc_id: x.redacted for x in secret_scan.scan(docs, bpe.rank_file(spark, queries.rank_path()), outputs=("redacted",)).collect()}
    found = [got[i] == "say [SECRET] now" for i in range(len(keys))]
    assert all(found[:200]) and np.mean(found[200:]) > 0.85
    assert [got[len(keys) + i] for i in range(len(names))] == [f"say {x} now" for x in names]


# repeats


def brute_dedup(rows):
    """rows: (id, text) of distinct ids."""
    seen, out = set(), {}
    for d, x in sorted(rows):
        b = x.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            else:
                seen.add(b[i : i + 100])
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[d] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(spark, texts):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op8_suffix_dedup(spark, FOLDER).collect()}
    assert got == brute_dedup(texts.items())


def test_suffix_dedup_splits_hot_anchors(spark):
    r = np.random.default_rng(8)
    letters = np.array(list("abcdefgh "))
    draw = lambda n: "".join(r.choice(letters, n))
    passage = draw(140)
    rows = [(i, draw(int(r.integers(0, 60))) + passage[: int(r.integers(90, 141))] + draw(int(r.integers(0, 60)))) for i in range(60)] + [(60, "é" * 150), (61, "x" * 400), (62, "ab" * 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_dedup(rows)
    assert {x.doc_id: tuple(x)[1:] for x in suffix_dedup.dedup(docs, digests=True).collect()} == want
    assert {x.doc_id: tuple(x)[1:] for x in suffix_dedup.dedup(docs, digests=True, most=1).collect()} == want


def test_suffix_dedup_with_many_continuations(spark):
    """A passage that goes on differently in every text is dealt out window by window; so is nothing else."""
    r = np.random.default_rng(18)
    letters = np.array(list("abcdefgh "))
    draw = lambda n: "".join(r.choice(letters, n))
    passage = draw(110)
    rows = [(i, draw(int(r.integers(5, 90))) + passage + draw(int(r.integers(5, 90)))) for i in range(2500)] + [(9000 + i, draw(300)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    hot = suffix_dedup.hot_anchors(docs.select("text"))
    assert 0 < len(hot) <= 4
    assert {x.doc_id: tuple(x)[1:] for x in suffix_dedup.dedup(docs, digests=True).collect()} == brute_dedup(rows)


def test_suffix_dedup_hard_rows(spark, hard, none):
    rows = suffix_dedup.dedup(hard).collect()
    assert len(rows) == len(HARD)
    by = {r.n_bytes: r for r in rows}
    assert bytes(by[len(LONG)].kept) == LONG[:5].encode() and by[len(LONG)].n_spans == 1
    assert suffix_dedup.dedup(none).count() == 0


def test_suffix_dedup_repeated_rows(spark):
    """A repeated row of 100 bytes or more is one document: every copy keeps the first occurrence."""
    r = np.random.default_rng(9)
    draw = lambda n: "".join(r.choice(list("abcdefgh "), n))
    a, b = draw(300), draw(250)
    once = [(-1, a), (1, b), (1, draw(130)), (2, draw(40) + a[50:220]), (3, b)]
    # a null id comes first, as -1 does here
    rows = [(None if d < 0 else d, x) for d, x in [*once, *once[:2], once[0]]]
    got = collections.defaultdict(list)
    for x in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), digests=True).collect():
        got[-1 if x.doc_id is None else x.doc_id].append(tuple(x)[1:])
    want = brute_dedup([(d, x) for d, x in once if len(x) != 130])
    alone = (130, 0, 0, hashlib.sha256(once[2][1].encode()).hexdigest())
    assert got == {-1: [want[-1]] * 3, 1: got[1], 2: [want[2]], 3: [want[3]]}
    assert sorted(got[1]) == sorted([want[1]] * 2 + [alone]) and want[-1][1] == want[1][1] == 0


# near copies


def brute_links(rows):
    s = [(d, sets_of(x)) for d, x in rows]
    n = collections.Counter()
    for i, (d, a) in enumerate(s):
        for e, b in s[:i]:
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                n[d] += 1
                n[e] += 1
    return n


def test_near_copies(spark, texts):
    got = {r.doc_id: r for r in queries.op9_jaccard(spark, FOLDER).collect()}
    want = brute_links(list(texts.items()))
    assert {d: r.n_links for d, r in got.items()} == {d: want[d] for d in texts}
    s = {d: sets_of(x) for d, x in texts.items()}
    for d, r in got.items():
        same = [e for e in texts if s[e] == s[d]]
        assert r.copy_id == (min(same) if s[d] else d) and r.class_id <= r.copy_id
        assert got[r.class_id].class_id == r.class_id


def test_near_copies_in_blocks(spark):
    """A component larger than a block gives the same numbers."""
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(base[:i] + ["x"] + base[i + 1 :])) for i in range(40)] + [(100 + i, " ".join(f"q{i}_{j}" for j in range(30))) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_links(rows)
    for block in (512, 7):
        got = {r.doc_id: (r.n_links, r.class_id) for r in jaccard.near_copies(docs, block=block).collect()}
        assert {d: n for d, (n, _) in got.items()} == {d: want[d] for d, _ in rows}
        assert len({c for d, (_, c) in got.items() if d < 40}) == 1


def test_near_copies_in_a_crowd(spark, monkeypatch):
    """Passages that many texts share and chains of similar texts: prefixes grow, the links stay those of brute force."""
    r = np.random.default_rng(4)
    some = lambda tag, n: [f"{tag}{x}" for x in r.integers(0, 10**9, n)]
    shared, rows = some("s", 40), []
    for i in range(60):  # half of each text is the same
        rows.append((i, shared + some(f"o{i}_", 36)))
    for i in range(0, 60, 3):  # some have a near copy
        rows.append((100 + i, rows[i][1][:-2]))
    chain = some("c", 60)
    for i in range(25):  # neighbours are similar, the ends are not
        chain = chain[3:] + some("c", 3)
        rows.append((200 + i, list(chain)))
    rows = [(d, " ".join(w)) for d, w in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_links(rows)
    assert want[200] and not any(want[d] for d in range(1, 60, 3))
    grown = []
    monkeypatch.setattr(jaccard, "resigned", lambda texts, depth, own=jaccard.resigned: grown.append(depth) or own(texts, depth))
    for block in (512, 10, 4):
        got = {r.doc_id: (r.n_links, r.class_id) for r in jaccard.near_copies(docs, block=block).collect()}
        assert {d: n for d, (n, _) in got.items()} == {d: want[d] for d, _ in rows}
        assert {c for d, (_, c) in got.items() if d >= 200} == {200}
    assert grown


def test_near_copies_repeated_ids(spark):
    """Rows without an id, and rows that repeat an id, are told apart by their texts."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (None, text + " x"), (None, "other words are here now"), (None, text), (3, text), (3, text + " y"), (3, text), (3, "nothing like it at all")]
    got = jaccard.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_links) for r in got) == [(0, 0), (0, 5), (0, 5), (0, 5), (3, 0), (3, 5), (3, 5), (3, 5)]


def test_components_need_enough_rounds(spark):
    from webmeter.llm.components import components

    path = spark.range(300).selectExpr("id as u", "id + 1 as v")
    assert {r.root for r in components(path).collect()} == {0}
    with pytest.raises(RuntimeError, match="no fixed point"):
        components(path, most=2)


def test_near_copies_hard_rows(spark, hard, none):
    rows = jaccard.near_copies(hard).collect()
    assert sorted((r.doc_id or 0, r.n_links) for r in rows) == [(0, 0), (1, 1), (1, 1), (2, 0), (2, 0), (3, 0), (4, 0), (5, 0)]
    assert jaccard.near_copies(none).count() == 0
    one = jaccard.one_of_each(hard)
    assert one.columns == hard.columns and one.count() == len(HARD) - 1
    twins = spark.createDataFrame([(None, "p q r s t u v"), (None, "p q r s t u v"), (9, "p q r s t u v")], "doc_id long, text string")
    assert [r.doc_id for r in jaccard.one_of_each(twins).collect()] == [9]
    assert jaccard.one_of_each(twins.where("doc_id is null")).count() == 1


# pipeline


def test_pipeline(spark):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "byte-level BPE encoding and decoding"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    kept = p.quality_stage(spark, docs, FOLDER)
    scores = {r.doc_id: r.predicted for r in queries.op3_quality(spark, FOLDER).collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, y in scores.items() if y == 1}
    near = p.near_copies_stage(spark, docs, FOLDER)
    classes = {r.doc_id: r.class_id for r in queries.op9_jaccard(spark, FOLDER).collect()}
    assert near.columns == docs.columns and sorted(r.doc_id for r in near.collect()) == sorted(d for d, c in classes.items() if c == d)
    clean = p.benchmark_stage(spark, docs, FOLDER)
    leaks = {r.doc_id for r in queries.op5_decontaminate(spark, FOLDER).collect()}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - leaks and leaks
    safe = p.secrets_stage(spark, docs, FOLDER)
    rescan = secret_scan.scan(safe, bpe.rank_file(spark, queries.rank_path()), outputs=("spans", "n_assign"))
    assert safe.columns == docs.columns and safe.count() == docs.count() and rescan.where("spans <> ''").count() == 0
    assert safe.where("n_chars <> length(text)").count() == 0
    final = p.run(spark, FOLDER)
    ids = {r.doc_id for r in final.collect()}
    assert ids and final.where("length(ids) <> 4 * n_tokens").count() == 0 and not ids & leaks


def test_stages_on_hard_rows(spark):
    import corpus_pipeline as p

    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(d, x, None, s, None if x is None else len(x)) for d, x, s, _ in HARD] + [(77, 'say password = "hunter22hunter" now', "en", "x", 35)]
    docs = spark.createDataFrame(rows, kind)
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and out.schema["text"].dataType == docs.schema["text"].dataType
        left = out.count()
        assert left == (len(rows) - 1 if "Jaccard" in name else len(rows)), name
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    clash = docs.select("*", F.lit("mine").alias("Redacted"), F.lit(7).alias("quality_score"), F.lit(8).alias("_quality"), F.lit("n").alias("nodes"))
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, clash, FOLDER)
        assert out.columns == clash.columns and {tuple(r) for r in out.select("Redacted", "quality_score", "_quality", "nodes").collect()} == {("mine", 7, 8, "n")}, name
    secret = p.secrets_stage(spark, docs, FOLDER).where("doc_id = 77").first()
    assert "hunter" not in secret.text and secret.n_chars == len(secret.text)
    final = p.tokens_stage(spark, docs, FOLDER)
    assert final.count() == len(rows) and p.tokens_stage(spark, docs.limit(0), FOLDER).count() == 0


def test_most_frequent_words_are_bounded(spark):
    counts = spark.range(1, 5001).selectExpr("id as word", "0 as kind", "cast(100000 / id as long) as c")
    for most in (10, 700, 5000, 10_000):
        rows = maxent.most_frequent(counts, most).collect()
        assert len(rows) <= most and (most < 5000 or len(rows) == 5000)
        low = min(r.c for r in rows)
        assert counts.where(f"c > {low}").count() <= len(rows) == counts.where(f"c >= {low}").count()
    assert maxent.most_frequent(counts.where("false"), 5).count() == 0


def test_lm_does_not_depend_on_the_split(spark):
    """Weights and scores are the same however the rows are dealt, over several tasks and rounds."""
    docs = spark.read.parquet(f"{compare.DATA}/sf0.001/documents.parquet").limit(80).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    docs = docs.unionAll(spark.createDataFrame([(None, None), (None, "a b"), (7, ""), (7, "")], "_id long, _text string"))
    blank = maxent.start(maxent.count_words(docs))
    some = [maxent.train(docs.repartition(n), blank, task=blank.total // 5, rounds=2) for n in (1, 5)]
    for name in ("class_rows", "word_rows"):
        a, b = (getattr(m, name) for m in some)
        assert np.abs(a).max() > 0.05 and np.array_equal(a, b)


def test_lm_rounds_go_on_from_the_weights_before(spark):
    """More rounds never lose what the rounds before learned: rows without new updates keep their weights."""
    docs = spark.createDataFrame([(1, "a b c a b c a b c")], "_id long, _text string")
    blank = maxent.start(maxent.count_words(docs))
    once = maxent.train(docs, blank, rounds=1)
    # one row: two of the three rounds are empty
    thrice = maxent.train(docs, blank, rounds=3)
    assert np.abs(once.class_rows).max() > 0 and np.array_equal(once.class_rows, thrice.class_rows) and np.array_equal(once.word_rows, thrice.word_rows)
