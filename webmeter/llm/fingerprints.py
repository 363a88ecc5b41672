"""Document fingerprints: closed syncmers, with DataFrame functions only.

The units of a text, of any length, are the pieces of up to four characters of
its words, counted from each word's start; a character of a script that is
written without spaces is a unit of its own.  A k-mer of ``K`` units is a closed
syncmer if the least hash among its ``K - S + 1`` inner s-mers (``S`` is one
unit) lies at its first or last place: that depends on the k-mer alone, so equal
passages give equal anchors wherever they stand, at equal distances from each
other.  A text's fingerprint is all its anchors, their places and hashes.

Two texts are matched by place: a match is an anchor, the next anchor and the
distance between them that both texts have, wherever in them.  The likeness is
the share of such steps, of those of both texts, that the other text has too.

Defined cases: a null text is empty; a text of less than ``K`` units, or without
a closed syncmer, has one anchor, the hash of the whole text at place 0, and is
like its equals only; equal texts have equal fingerprints; a null id comes first
in the order of ids, repeated ids are ordered by their texts; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 3
S = 1
#: Code points of scripts without spaces: Thai to Myanmar, Khmer, Han with kana and others, and the planes of rarer Han.
_ALONE = r"\x{0E00}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{20000}-\x{3FFFF}"
UNIT = rf"[{_ALONE}]|[^\x20\x09-\x0D{_ALONE}]{{1,4}}"
#: Bits of an id inside a bucket, and of a bucket inside each further level.
BUCKET, LEVEL = 8, 12


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row."""
    return F.transform(F.array(value), body)[0]


def anchors(text: Column) -> Column:
    """Array of (place, hash) of the closed syncmers, in order."""

    def of(h: Column) -> Column:
        n = F.size(h)
        at = lambda i, j: F.get(h, i + j)
        edge = lambda i: F.least(at(i, 0), at(i, K - S)) <= F.least(*(at(i, j) for j in range(1, K - S)), F.lit((1 << 63) - 1))
        chosen = F.transform(F.filter(F.sequence(F.lit(0), n - K), edge), lambda i: F.struct(i.cast("int").alias("place"), F.xxhash64(*(at(i, j) for j in range(K))).alias("hash")))
        whole = F.array(F.struct(F.lit(0).alias("place"), F.xxhash64(text).alias("hash")))
        return F.when(n < K, whole).otherwise(_let(chosen, lambda c: F.when(F.size(c) > 0, c).otherwise(whole)))

    return _let(F.transform(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), lambda u: F.xxhash64(u)), of)


def shown(own: Column) -> Column:
    """Anchors as lower-case hexadecimal text: 8 digits of the place and 16 of the hash each."""
    return F.lower(F.array_join(F.transform(own, lambda a: F.concat(F.lpad(F.hex(a["place"]), 8, "0"), F.lpad(F.hex(a["hash"]), 16, "0"))), ""))


def steps(own: Column) -> Column:
    """The steps from anchor to anchor, as even numbers: hashes of both and the distance; of a sole anchor its hash."""
    n = F.size(own)
    between = F.zip_with(F.slice(own, F.lit(1), n - 1), F.slice(own, F.lit(2), n - 1), lambda a, b: F.shiftleft(F.xxhash64(a["hash"], b["place"] - a["place"], b["hash"]), 1))
    return F.when(n == 1, F.array(F.shiftleft(F.get(own, F.lit(0))["hash"], 1))).otherwise(between)


def likeness(a: Column, b: Column) -> Column:
    """Share, 0 to 1, of the steps of both texts that the other text has too."""

    def of(every: Column) -> Column:
        # sorted, equal steps form runs, those of the first text (even) before those of the second (odd)
        n = F.size(every)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.shiftright(F.get(every, i), 1) != F.shiftright(F.get(every, i - 1), 1)))

        def met(s: Column) -> Column:
            ends = F.concat(F.slice(s, F.lit(2), F.size(s)), F.array(n))
            both = lambda lo, hi: (F.get(every, lo).bitwiseAND(1) == 0) & (F.get(every, hi - 1).bitwiseAND(1) == 1)
            return F.aggregate(F.zip_with(s, ends, lambda lo, hi: F.when(both(lo, hi), hi - lo).otherwise(0)), F.lit(0), lambda x, y: x + y)

        return _let(starts, met) / n

    return _let(F.sort_array(F.concat(a, F.transform(b, lambda x: x + 1))), of)


def marks(text: Column) -> Column:
    """(fingerprint, steps) of a text."""
    return _let(anchors(text), lambda a: F.struct(shown(a).alias("fingerprint"), steps(a).alias("steps")))


def next_buckets(buckets: DataFrame) -> DataFrame:
    """(_bucket, _next): the next bucket that is not empty; the first one after the last.

    Buckets are ordered inside groups, groups inside groups of the next level,
    and so on up to the 256 or fewer groups of all: no window holds more than
    2 ** ``LEVEL`` rows, however sparse the ids are.
    """
    levels = [buckets.select("_bucket", F.col("_bucket").alias("_node"))]
    bits = 64 - BUCKET
    while bits > 8:
        bits -= LEVEL
        below = levels[-1]
        levels.append(below.groupBy(F.shiftright("_node", LEVEL).alias("_node")).agg(F.min("_bucket").alias("_bucket")))
    every = Window.orderBy("_node")  # 256 rows at most
    after = levels[-1].select("_node", F.coalesce(F.lead("_bucket").over(every), F.min("_bucket").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_after"))
    for own in reversed(levels[:-1]):
        up = F.shiftright("_node", LEVEL)
        inside = Window.partitionBy("_up").orderBy("_node")
        near = own.withColumn("_up", up).withColumn("_near", F.lead("_bucket").over(inside))
        after = near.join(after.withColumnRenamed("_node", "_up"), "_up").select("_node", F.coalesce("_near", "_after").alias("_after"))
    return after.select(F.col("_node").alias("_bucket"), F.col("_after").alias("_next"))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, text, marks, next_text, next_steps); the last row's next is the first.

    Rows meet their next one in buckets of ids: one exchange of the texts
    (both uses read it), a window inside each bucket, and for the last row of a
    bucket a join with the first row of the next bucket that is not empty.
    """
    own = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # never null, so that nothing is filtered on it and the exchange can be shared
    own = own.withColumn("_bucket", F.shiftright(F.coalesce(F.col("_id").cast("long"), F.lit(-(1 << 63))), BUCKET))
    order = Window.partitionBy("_bucket").orderBy("_id", "_text")
    dealt = own.repartition("_bucket")
    rows = dealt.withColumn("_m", marks(F.col("_text"))).select("_id", "_bucket", "_text", "_m", F.lead("_text").over(order).alias("_next_text"), F.lead("_m.steps").over(order).alias("_next_steps"))
    heads = dealt.withColumn("_n", F.row_number().over(order)).where("_n = 1").select(F.col("_bucket").alias("_next"), F.col("_text").alias("_head_text"), marks(F.col("_text"))["steps"].alias("_head_steps"))
    heads = next_buckets(own.select("_bucket").distinct()).join(heads, "_next").select("_bucket", "_head_text", "_head_steps")
    met = rows.join(heads, "_bucket", "left")
    return met.select(F.col("_id").alias(key), F.col("_text").alias("text"), F.col("_m").alias("marks"), F.coalesce("_next_text", "_head_text").alias("next_text"), F.coalesce("_next_steps", "_head_steps").alias("next_steps"))


def compare(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and likenesses.

    The edited text has the last floor(n / 2) code points replaced by the first
    as many of the next row's text.
    """
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = with_next(docs, key, text)
    edited = F.concat(F.col("text").substr(F.lit(1), n - half), F.col("next_text").substr(F.lit(1), half))

    def of(changed: Column) -> Column:
        made = lambda m: F.struct(F.sha2(changed, 256).alias("edited_sha256"), m["fingerprint"].alias("edited_fingerprint"), likeness(F.col("marks.steps"), m["steps"]).alias("near_edited"))
        return _let(marks(changed), made)

    out = rows.select(key, n.cast("long").alias("n_chars"), F.col("marks.fingerprint").alias("fingerprint"), _let(edited, of).alias("_r"), likeness(F.col("marks.steps"), F.col("next_steps")).alias("near_next"))
    return out.select(key, "n_chars", "_r.edited_sha256", "fingerprint", "_r.edited_fingerprint", "_r.near_edited", "near_next")
