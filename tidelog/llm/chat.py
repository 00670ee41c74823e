"""Multi-party perspective rotation of conversations.

For every participant of a conversation the dialogue is rendered once with that speaker as the
assistant and all others as named users; the mask marks what that speaker said. A view is stored in
blocks of ``turns`` turn numbers, so that no row and no task grows with a conversation's length; its
blocks one after another are the whole dialogue, and masks count in its characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURNS_PER_ROW = 64
#: The marks of the chat template.
TURN_OPEN, TURN_CLOSE = "<|im_start|>", "<|im_end|>"
NOBODY, SYSTEM, NAMED = "unknown", "system", "user name="


def _head(speaker: Column, perspective: Column) -> Column:
    role = (
        F.when(speaker == SYSTEM, F.lit(SYSTEM))
        .when(speaker == perspective, F.lit("assistant"))
        .otherwise(F.concat(F.lit(NAMED), speaker))
    )
    return F.concat(F.lit(TURN_OPEN), role, F.lit("\n"))


def _line_length(speaker: Column, text: Column) -> Column:
    """Characters of a turn as rendered for anyone else than its speaker."""
    role = F.when(speaker == SYSTEM, F.lit(len(SYSTEM))).otherwise(F.length(speaker) + len(NAMED))
    return (role + F.length(text) + len(TURN_OPEN) + len(TURN_CLOSE) + 2).cast("long")


def block_starts(lines: DataFrame) -> DataFrame:
    """Per conversation and block: ``_views``, the participants and the characters of each one's view
    before the block. Counts by speaker are combined before their shuffle; the running sums pass
    over a narrow row for each view and block."""
    counts = lines.groupBy("conv_id", "block", F.col("line.speaker").alias("speaker")).agg(
        F.count(F.lit(1)).alias("own"), F.sum(_line_length(F.col("line.speaker"), F.col("line.text"))).alias("size")
    )
    blocks = counts.groupBy("conv_id", "block").agg(F.sum("size").alias("size"))
    speakers = counts.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    views = blocks.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    mine = counts.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), F.col("speaker").alias("perspective"), "own")
    here = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    views = views.join(mine.withColumnRenamed("perspective", "_me"), here & (F.col("perspective") == F.col("_me")), "left")
    change = (F.lit(len("assistant") - len(NAMED)) - F.length("perspective")) * F.coalesce("own", F.lit(0))
    before = F.sum(F.col("size") + change).over(Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    placed = views.select("conv_id", "block", "perspective", F.coalesce(before, F.lit(0)).cast("long").alias("starts_at"))
    return placed.groupBy(F.col("conv_id").alias("_conv"), F.col("block").alias("_block")).agg(F.collect_list(F.struct("perspective", "starts_at")).alias("_views"))


def rotate(conversations: DataFrame, turns: int = TURNS_PER_ROW) -> DataFrame:
    """One row per conversation, participant and block of turn numbers: conv_id, perspective,
    block, n_turns, starts_at (where the block begins in the participant's view of the whole
    dialogue, in characters), rendered, and mask (character spans ``start-end`` of that whole view,
    end excluded, comma-joined: what the participant said with the closing mark).

    Turns follow turn number, then role, then text; equal turn numbers are all kept. A null role
    is the speaker ``unknown``, a null text is empty, a null turn number comes first in block -1,
    a null conversation id is a conversation of its own. System turns stay system turns and are no
    participants; a conversation of system turns only gives no row. Other columns are ignored.
    Texts are shuffled once, by conversation and block, and joined where they are."""
    lines = conversations.select(
        "conv_id",
        F.coalesce(F.floor(F.col("turn") / turns), F.lit(-1)).cast("long").alias("block"),
        F.struct(
            F.col("turn"),
            F.coalesce("role", F.lit(NOBODY)).alias("speaker"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("line"),
    )
    blocks = lines.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    here = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    views = blocks.join(block_starts(lines), here).select("conv_id", "block", "lines", F.explode("_views").alias("_view"))
    views = views.select("conv_id", "block", "lines", "_view.perspective", "_view.starts_at")
    me = F.col("perspective")
    parts = F.transform(
        "lines",
        lambda x: F.struct(
            _head(x.speaker, me).alias("head"),
            F.concat(x.text, F.lit(TURN_CLOSE)).alias("said"),
            (x.speaker == me).alias("own"),
        ),
    )
    views = views.withColumn("_parts", parts)
    start = F.struct(F.col("starts_at").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc.at + F.length(p.head)
        end = begin + F.length(p.said)
        span = F.concat_ws("-", begin.cast("string"), end.cast("string"))
        return F.struct(
            (end + F.lit(1)).alias("at"),
            F.when(p.own, F.array_append(acc.spans, span)).otherwise(acc.spans).alias("spans"),
        )

    return views.select(
        "conv_id",
        "perspective",
        "block",
        F.size("lines").cast("long").alias("n_turns"),
        "starts_at",
        F.array_join(F.transform("_parts", lambda p: F.concat(p.head, p.said, F.lit("\n"))), "").alias("rendered"),
        F.array_join(F.aggregate("_parts", start, step, lambda acc: acc.spans), ",").alias("mask"),
    )


ROTATE_SQL = f"""
WITH lines AS (
  SELECT conv_id, coalesce(CAST(floor(turn / {float(TURNS_PER_ROW)}) AS BIGINT), -1) AS block, turn,
         coalesce(role, '{NOBODY}') AS speaker, coalesce(text, '') AS text
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id, speaker AS perspective FROM lines WHERE speaker <> '{SYSTEM}'),
parts AS (
  SELECT l.conv_id, s.perspective, l.block,
         '{TURN_OPEN}' || CASE WHEN l.speaker = '{SYSTEM}' THEN '{SYSTEM}' WHEN l.speaker = s.perspective THEN 'assistant'
                               ELSE 'user name=' || l.speaker END || chr(10) AS head,
         l.text || '{TURN_CLOSE}' AS said, l.speaker = s.perspective AS own,
         row_number() OVER (PARTITION BY l.conv_id, s.perspective ORDER BY l.block, l.turn NULLS FIRST, l.speaker, l.text) AS k
  FROM lines l JOIN speakers s ON l.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(said) + 1) OVER (PARTITION BY conv_id, perspective ORDER BY k)
            - length(said) - 1 AS begin_at
  FROM parts)
SELECT conv_id, perspective, block, count(*) AS n_turns, CAST(min(begin_at - length(head)) AS BIGINT) AS starts_at,
       string_agg(head || said || chr(10), '' ORDER BY k) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN CAST(CAST(begin_at AS BIGINT) AS VARCHAR) || '-'
                || CAST(CAST(begin_at + length(said) AS BIGINT) AS VARCHAR) END, ',' ORDER BY k), '') AS mask
FROM placed GROUP BY conv_id, perspective, block
"""
