"""Preference formatting: one prompt, and a chosen and a rejected completion with their loss masks.

A pair is two conversations, rows of (pair_id, turn, role, text) each. Their longest common turn prefix
is the prompt and is rendered once; what follows in either is its completion. Of a completion only the
assistant's turns are learned from, beginning behind the header of the turn: ``trained_from`` is that
place in the rendered turn, and null where nothing of it is learned.

The result has a row per rendered turn: (pair_id, part, turn, role, rendered, trained_from), part being
``prompt``, ``chosen`` or ``rejected``; in order of turn the rows of prompt and chosen, or of prompt and
rejected, are the whole text. A conversation is never gathered in one task: turns are compared by their
digests, and the first difference is a minimum per pair, folded before the shuffle.

Null roles are written ``unknown``, null texts are empty, a null turn number comes behind all others.
Rows without pair_id belong to no pair and are left out. Several rows with one turn number are compared as
a bag. Conversations that do not differ are a prompt without completions; one that is a prefix of the other
has an empty completion, so no row of that part. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemodels.llm.plans import PLANS, SQL, read

# The turn number that stands for a missing one.
LAST_TURN = (1 << 63) - 1


def _turns(rows: DataFrame) -> DataFrame:
    return rows.where("pair_id is not null").select(
        "pair_id",
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST_TURN)).alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def first_difference(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, differs_at): the first turn number at which two conversations are not the same."""
    digest = F.sha2(F.concat_ws("\0", "role", "text"), 256)
    marked = [
        _turns(rows).select("pair_id", "turn", digest.alias("digest"), F.lit(sign).alias("sign"))
        for rows, sign in ((chosen, 1), (rejected, -1))
    ]
    apart = marked[0].unionByName(marked[1]).groupBy("pair_id", "turn", "digest").agg(F.sum("sign").alias("n"))
    return apart.where("n <> 0").groupBy("pair_id").agg(F.min("turn").alias("differs_at"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(header(role), text, F.lit("<|end|>\n"))


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def paired(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """A row per rendered turn of the prompt, the chosen and the rejected completion of every pair."""
    split = first_difference(chosen, rejected)
    shared = F.col("differs_at").isNull() | (F.col("turn") < F.col("differs_at"))
    left = _turns(chosen).join(split, "pair_id", "left").withColumn("part", F.when(shared, "prompt").otherwise("chosen"))
    right = _turns(rejected).join(split, "pair_id").where(~shared).withColumn("part", F.lit("rejected"))
    learned = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    return left.unionByName(right).select(
        "pair_id",
        "part",
        F.when(F.col("turn") < LAST_TURN, F.col("turn")).alias("turn"),
        "role",
        rendered(F.col("role"), F.col("text")).alias("rendered"),
        F.when(learned, F.length(header(F.col("role")))).alias("trained_from"),
    )


def with_stale_answers(conversations: DataFrame) -> DataFrame:
    """Rejected conversations: the last answer is the conversation's first one again, or half of it if it has one answer.

    Rows (pair_id, turn, role, text); conversations without an answer stay as they are.
    """
    answer = F.when(F.col("role") == "assistant", F.col("turn"))
    answers = conversations.groupBy("pair_id").agg(F.min(answer).alias("first"), F.max(answer).alias("last"))
    is_answer = F.col("role") == "assistant"
    firsts = conversations.where(is_answer).join(answers, "pair_id").where("turn = first and first < last")
    # The smallest text decides where several rows have the turn number of the first answer.
    stale = firsts.groupBy("pair_id").agg(F.min("text").alias("stale"))
    half = F.substring("text", F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    return (
        conversations.join(answers.join(stale, "pair_id", "left").drop("first"), "pair_id", "left")
        .withColumn("text", F.when(is_answer & (F.col("turn") == F.col("last")), F.coalesce("stale", half)).otherwise(F.col("text")))
        .select("pair_id", "turn", "role", "text")
    )


def op4_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as the chosen one, paired with its copy that ends on a stale answer."""
    chosen = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    return paired(chosen, with_stale_answers(chosen))


PLANS["op4_preferences"] = op4_preferences
SQL["op4_preferences"] = """
WITH answers AS (
    SELECT conv_id, min(turn) AS first_turn, max(turn) AS last_turn FROM conversations WHERE role = 'assistant' GROUP BY conv_id
), stale AS (
    SELECT c.conv_id, min(c.text) AS stale_text
    FROM conversations c JOIN answers a ON a.conv_id = c.conv_id
    WHERE c.role = 'assistant' AND c.turn = a.first_turn AND a.first_turn < a.last_turn
    GROUP BY c.conv_id
), both_sides AS (
    SELECT c.conv_id, c.turn, c.role, c.text AS good,
        CASE WHEN c.role = 'assistant' AND c.turn = a.last_turn
            THEN coalesce(s.stale_text, substring(c.text, 1, CAST(floor(length(c.text) / 2) AS INTEGER))) ELSE c.text END AS bad
    FROM conversations c LEFT JOIN answers a ON a.conv_id = c.conv_id LEFT JOIN stale s ON s.conv_id = c.conv_id
), split AS (
    SELECT conv_id, min(turn) AS differs_at FROM both_sides WHERE good <> bad GROUP BY conv_id
), parts AS (
    SELECT b.conv_id, CASE WHEN s.differs_at IS NULL OR b.turn < s.differs_at THEN 'prompt' ELSE 'chosen' END AS part, b.turn, b.role, b.good AS text
    FROM both_sides b LEFT JOIN split s ON s.conv_id = b.conv_id
    UNION ALL
    SELECT b.conv_id, 'rejected', b.turn, b.role, b.bad
    FROM both_sides b JOIN split s ON s.conv_id = b.conv_id WHERE b.turn >= s.differs_at
)
SELECT conv_id AS pair_id, part, turn, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered,
    CASE WHEN part <> 'prompt' AND role = 'assistant' THEN CAST(length(role) + 5 AS INTEGER) END AS trained_from
FROM parts
"""
