"""Perspective rotation of dialogues.

For every participant of a conversation the whole dialogue is rendered with that
participant as the assistant and everybody else as a named user. The result has
one row per conversation, perspective and turn: a conversation of any length, and
one that holds a third of all rows, never has to fit one task. Concatenating the
segments of a perspective in turn order gives its rendered dialogue.

Edge cases: null text is rendered as empty, a null speaker as the participant
``unknown``. Turns spoken by one of ``narrators`` (system prompts) keep their role and
are nobody's perspective; a conversation of narrators alone has no perspective and
gives no rows. Turns with a null conversation id belong to the conversation null.
Repeated rows are repeated turns. Speaker names are cut down to letters, digits,
``_`` and ``-`` in the header, so that a name cannot forge markup; the text is
rendered as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
UNKNOWN = "unknown"


def rotate(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    narrators: tuple[str, ...] = ("system",),
) -> DataFrame:
    """``conv_id, perspective, turn, role, name, segment, trained, mask_start, mask_end``.

    The mask is the part of the segment that is learned, in characters from its
    start: the text and end marker of the assistant's turns, and nothing of the others.
    """
    said = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(speaker), F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    participants = (
        said.where(~F.col("speaker").isin(*narrators))
        .groupBy("conv_id", "speaker")
        .agg(F.count(F.lit(1)).alias("_turns"))
        .select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective"))
    )
    # A row per turn and perspective; turns of one busy conversation are split by the skew join.
    seen = said.join(participants, F.col("conv_id").eqNullSafe(F.col("_conv")))
    own = F.col("speaker") == F.col("perspective")
    narrated = F.col("speaker").isin(*narrators)
    role: Column = F.when(own, F.lit("assistant")).when(narrated, F.col("speaker")).otherwise(F.lit("user"))
    name = F.when(~own & ~narrated, F.regexp_replace("speaker", "[^A-Za-z0-9_-]", "_"))
    head = F.concat(F.lit(START), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("\n"))
    length = F.char_length(F.concat(head, F.col("text"), F.lit(END))).cast("bigint")
    return seen.select(
        "conv_id",
        "perspective",
        "turn",
        role.alias("role"),
        name.alias("name"),
        F.concat(head, F.col("text"), F.lit(END)).alias("segment"),
        own.alias("trained"),
        F.when(own, F.char_length(head).cast("bigint")).otherwise(F.lit(0)).alias("mask_start"),
        F.when(own, length).otherwise(F.lit(0)).alias("mask_end"),
    )


# The same rows in DuckDB, over the view ``conversations``.
ORACLE = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
who AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
seen AS (
  SELECT s.*, perspective, speaker = perspective AS own FROM said s JOIN who w ON s.conv_id IS NOT DISTINCT FROM w.conv_id),
named AS (
  SELECT *, CASE WHEN own THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role,
         CASE WHEN NOT own AND speaker <> 'system' THEN regexp_replace(speaker, '[^A-Za-z0-9_-]', '_', 'g') END AS name
  FROM seen),
headed AS (
  SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM named)
SELECT conv_id, perspective, turn, role, name, head || text || '<|im_end|>' || chr(10) AS segment, own AS trained,
       CASE WHEN own THEN length(head) ELSE 0 END AS mask_start,
       CASE WHEN own THEN length(head || text) + 11 ELSE 0 END AS mask_end
FROM headed
"""
