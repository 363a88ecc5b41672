"""Chat formatting by multi-party perspective rotation, with DataFrame functions only.

Every participant of a conversation gives one rendering of it: that speaker's
turns are the assistant's, the other speakers are named users, system turns
stay system turns, and the mask lists the code-point spans of the assistant's
words.

A rendering is given in rows, so that none grows without bound: a row holds
whole slices of ``TURNS`` turn numbers until it has ``TURNS`` turns, which is
all of almost any dialogue.  Rows of a rendering are numbered by ``part``;
``start`` is a row's place in the whole rendering and the spans of the mask are
places in the whole rendering too, so that the rows joined in order are the
rendering.

Defined cases: a null text is empty, a null role is the speaker ``unknown``;
``<|`` in a text or role is written ``<\\|``, so that no text can pass for a
header; turns are ordered by number (a null one first), then role, then text;
repeated rows are repeated turns; rows with a null conversation id form one
conversation; a conversation with system turns only has no rendering; other
columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turn numbers of a slice are 2 ** SLICE.
SLICE = 9
TURNS = 1 << SLICE
SYSTEM = "system"
ASSISTANT = "<|assistant|>\n"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def _named(role: Column) -> Column:
    return F.when(role == SYSTEM, F.lit("<|system|>\n")).otherwise(F.concat(F.lit("<|user name="), role, F.lit("|>\n")))


def _header(role: Column, speaker: Column) -> Column:
    return F.when(role == speaker, F.lit(ASSISTANT)).otherwise(_named(role))


def _join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys; nulls are equal."""
    other = b.select(*(F.col(k).alias(f"_r{k}") for k in keys), *(c for c in b.columns if c not in keys))
    on = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys))
    return a.join(other, on, how).drop(*(f"_r{k}" for k in keys))


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv, speaker, part, start, n_turns, text, mask)."""
    own = turns.select(
        F.col(conv).alias("_conv"),
        F.coalesce(F.shiftright(F.col(turn).cast("long"), SLICE), F.lit(-(1 << 62))).alias("_slice"),
        F.struct(F.col(turn).alias("turn"), _plain(F.coalesce(F.col(role), F.lit("unknown"))).alias("role"), _plain(F.coalesce(F.col(text), F.lit(""))).alias("text")).alias("_turn"),
    )
    # small rows: turns and characters by slice and role, and from them the part of each slice and where it begins
    counts = own.groupBy("_conv", "_slice", F.col("_turn.role").alias("role")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("_turn.text")).alias("chars"))
    length = F.col("n") * (F.char_length(_named(F.col("role"))) + 1) + F.col("chars")
    slices = counts.groupBy("_conv", "_slice").agg(F.sum("n").alias("n"), F.sum(length).alias("length"))
    before = Window.partitionBy("_conv").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0)).cast("long")
    placed = slices.select("_conv", "_slice", F.floor(upto("n", before) / TURNS).cast("long").alias("part"), upto("length", before).alias("begin"))
    begins = placed.groupBy("_conv", "part").agg(F.min("begin").alias("begin"))
    spoken = _join(counts, placed, ["_conv", "_slice"]).groupBy("_conv", "part", F.col("role").alias("speaker")).agg(F.sum("n").alias("n"))
    speakers = counts.where(F.col("role") != SYSTEM).select("_conv", F.col("role").alias("speaker")).distinct()
    rows = _join(_join(begins, speakers, ["_conv"]), spoken, ["_conv", "part", "speaker"], "left")
    earlier = Window.partitionBy("_conv", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shorter = F.lit(len(ASSISTANT)) - F.char_length(_named(F.col("speaker")))
    rows = rows.select("_conv", "part", "speaker", (F.col("begin") + upto("n", earlier) * shorter).alias("start"))
    parts = _join(own, placed.drop("begin"), ["_conv", "_slice"]).groupBy("_conv", "part").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    seen = _join(parts, rows, ["_conv", "part"])
    speaker = F.col("speaker")

    def piece(t: Column) -> Column:
        return F.concat(_header(t["role"], speaker), t["text"], F.lit("\n"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.char_length(_header(t["role"], speaker))
        end = start + F.char_length(t["text"])
        span = F.when(t["role"] == speaker, F.array(F.concat_ws(":", start.cast("string"), end.cast("string")))).otherwise(F.array().cast("array<string>"))
        return F.struct((end + 1).alias("at"), F.concat(acc["spans"], span).alias("spans"))

    begin = F.struct(F.col("start").alias("at"), F.array().cast("array<string>").alias("spans"))
    return seen.select(
        F.col("_conv").alias(conv),
        "speaker",
        "part",
        "start",
        F.size("_turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("_turns", piece), "").alias("text"),
        F.aggregate("_turns", begin, step, lambda acc: F.array_join(acc["spans"], ",")).alias("mask"),
    )


ORACLE = rf"""
WITH t AS (
  SELECT conv_id, coalesce(floor(turn / {TURNS}.0), -4611686018427387904)::BIGINT AS slice, turn, replace(coalesce(role, 'unknown'), '<|', '<\|') AS role, replace(coalesce(text, ''), '<|', '<\|') AS text
  FROM conversations
), z AS (
  SELECT conv_id, slice, count(*) AS n FROM t GROUP BY 1, 2
), q AS (
  SELECT conv_id, slice, (coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {TURNS})::BIGINT AS part FROM z
), p AS (
  SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> '{SYSTEM}'
), s AS (
  SELECT t.*, q.part, p.speaker,
    CASE WHEN role = '{SYSTEM}' THEN '<|system|>' || chr(10) WHEN role = p.speaker THEN '<|assistant|>' || chr(10)
         ELSE '<|user name=' || role || '|>' || chr(10) END AS header
  FROM t JOIN q ON t.conv_id IS NOT DISTINCT FROM q.conv_id AND t.slice = q.slice JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), o AS (
  SELECT *, sum(length(header) + length(text) + 1) OVER (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
            - length(text) - 1 AS word
  FROM s
)
SELECT conv_id, speaker, part, min(word - length(header))::BIGINT AS start, count(*) AS n_turns,
  string_agg(header || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS text,
  coalesce(string_agg(word::BIGINT || ':' || (word + length(text))::BIGINT, ',' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = speaker), '') AS mask
FROM o GROUP BY conv_id, part, speaker
"""
