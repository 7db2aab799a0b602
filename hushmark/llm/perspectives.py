"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered once more, with that speaker as
the assistant and all others as named users. Only the assistant's words are trained on: their
place in the rendered dialogue is the mask. System turns stay system turns for everyone and are
nobody's perspective.

A dialogue is given as its segments, one row a turn, with the place of each in the whole, so a
conversation may have any length. Turns are dealt out once, by conversation and chunk of turn
numbers. In a perspective every turn is as long as for an onlooker, but for the speaker's own turns,
whose header is shorter by a fixed number of characters. So a place is the length of the onlooker's
turns before it, less that number for each own turn before it: sums inside the chunk, and for the
chunks before it a table of one row per chunk and participant, made from lengths alone. Joining
the segments of a (conversation, participant) in order of ``start`` gives the rendered text.

Defined results: a null text is empty; a null role is a speaker named ``unknown``; null turns come
first; turns with equal numbers are ordered by speaker and text; repeated rows are repeated turns;
a null conversation id is a conversation like any other; one without participants (only system
turns) gives no rows. Characters that are special in the format are not escaped: mask places are
by length, so no text can move them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hushmark.llm.common import table

CHUNK = 256
SYSTEM, UNKNOWN = "system", "unknown"
OPEN, CLOSE, NAMED = "<|im_start|>", "<|im_end|>\n", "user name="


def rotate(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Segments of every perspective of ``turns`` (conv_id, turn, role, text).

    (conv_id, participant, turn, speaker, segment, start, end, trained, mask_start, mask_end): the segment's
    place in its dialogue and the trained place in it, in characters, ends excluded; null masks where untrained.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(UNKNOWN)).alias("speaker"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),  # never null
        F.coalesce(F.floor(F.col("turn") / chunk), F.lit(-(1 << 60))).alias("chunk"),
    ).withColumn("seen", F.char_length(_head(F.col("speaker"), F.lit(False))) + F.char_length("text") + len(CLOSE))
    # where the chunks of each perspective start
    parts = rows.groupBy("key", "chunk", "speaker").agg(F.sum("seen").alias("seen"), F.count(F.lit(1)).alias("n"))
    people = parts.where(F.col("speaker") != SYSTEM).select("key", F.col("speaker").alias("participant")).distinct()
    chunks = parts.groupBy("key", "chunk").agg(F.sum("seen").alias("seen"))
    own = parts.select("key", "chunk", F.col("speaker").alias("participant"), "n")
    earlier = Window.partitionBy("key", "participant").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.join(people, "key").join(own, ["key", "chunk", "participant"], "left").select(
        "key", "chunk", "participant",
        (F.coalesce(F.sum("seen").over(earlier), F.lit(0)) - _shorter(F.col("participant")) * F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("base"),
    )
    # inside a chunk: what stands before each turn, and who spoke; no more than a chunk holds
    before = Window.partitionBy("key", "chunk").orderBy("turn", "speaker", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("passed", F.coalesce(F.sum("seen").over(before), F.lit(0))).withColumn("spoke", F.collect_list("speaker").over(before))
    each = placed.join(starts, ["key", "chunk"])
    trained = F.col("speaker") == F.col("participant")
    own_before = F.size(F.filter("spoke", lambda s: s == F.col("participant")))
    start = F.col("base") + F.col("passed") - _shorter(F.col("participant")) * own_before
    each = each.select("conv_id", "participant", "turn", "speaker", "text", trained.alias("trained"), start.cast("long").alias("start"), _head(F.col("speaker"), trained).alias("head"))
    mask = F.col("start") + F.char_length("head")
    stop = mask + F.char_length("text")
    return each.select(
        "conv_id", "participant", "turn", "speaker",
        F.concat("head", "text", F.lit(CLOSE)).alias("segment"),
        "start", (stop + len(CLOSE)).alias("end"), "trained",
        F.when(F.col("trained"), mask).alias("mask_start"), F.when(F.col("trained"), stop).alias("mask_end"),
    )


def _head(speaker: Column, trained: Column) -> Column:
    who = F.when(speaker == SYSTEM, F.lit("system")).when(trained, F.lit("assistant")).otherwise(F.concat(F.lit(NAMED), speaker))
    return F.concat(F.lit(OPEN), who, F.lit("\n"))


def _shorter(participant: Column) -> Column:
    """By how much a speaker's header is longer for others than for themselves."""
    return F.char_length(participant) + (len(NAMED) - len("assistant"))


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS body FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS participant FROM t WHERE speaker <> 'system'),
e AS (
  SELECT t.conv_id, p.participant, t.turn, t.speaker, t.body, t.speaker = p.participant AS own,
         '<|im_start|>' || CASE WHEN t.speaker = 'system' THEN 'system' WHEN t.speaker = p.participant THEN 'assistant'
           ELSE 'user name=' || t.speaker END || chr(10) AS head
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
s AS (SELECT *, head || body || '<|im_end|>' || chr(10) AS segment FROM e),
w AS (SELECT *, CAST(sum(length(segment)) OVER (PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, speaker, body
        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM s)
SELECT conv_id, participant, turn, speaker, segment, stop - length(segment) AS start, stop AS "end", own AS trained,
       CASE WHEN own THEN stop - length(segment) + length(head) END AS mask_start,
       CASE WHEN own THEN stop - length(segment) + length(head) + length(body) END AS mask_end
FROM w
"""
