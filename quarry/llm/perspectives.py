"""Chat formatting by multi-party perspective rotation, with DataFrame functions only.

For every participant of a dialogue the whole dialogue is rendered with that
speaker as the assistant and all others as named users; the mask spans are the
character ranges of the assistant's own words and end marks.

A dialogue is rendered in blocks of ``block`` turns, so no row or task has to
hold a dialogue of any length: messages are grouped by (dialogue, turn block),
a block with more messages than that (many at one turn) is cut further, and every
participant of the dialogue gets each block.  Messages of a block are numbered in cells of one turn and one of
256 slices (a hash of role and text), so a crowded turn, or one dialogue without turns, is no single window.
With ``block=None`` a dialogue is one block, whole, for callers who know that their dialogues fit a row.

Defined cases: repeated messages are rendered as often as they occur; at equal turns messages go by slice, role,
then text; null turns come last in a block of their own; null or empty text renders as empty; null roles render as
user ``unknown`` and, like ``system``, have no perspective; null conv_id is one
dialogue; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import group_rank, md5_number, null_key, staged

#: Turns, and messages, in a rendered block at most.
BLOCK = 256
#: Copies of a dialogue's participants, so that its blocks meet them in as many tasks.
SALTS = 16
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _head(speaker: Column, participant: Column) -> Column:
    tag = (F.when(speaker == participant, F.lit("assistant")).when(speaker == "system", F.lit("system"))
           .otherwise(F.concat(F.lit("user name="), F.coalesce(speaker, F.lit("unknown")))))
    return F.concat(F.lit(OPEN), tag, F.lit("\n"))


def blocks(conversations: DataFrame, block: int | None = BLOCK) -> DataFrame:
    """key, conv_id, block, sub_block, messages (in order): the dialogue cut into bounded pieces."""
    text = F.coalesce("text", F.lit(""))
    part = F.floor(F.col("turn") / block).cast("long") if block else F.lit(0).cast("long")
    # Nulls: a block (-1 as text sorts it apart) and a role mark of their own.
    messages = conversations.select(
        null_key("conv_id").alias("key"), "conv_id", "role", text.alias("text"), part.alias("block"),
        F.when(F.col("turn").isNull(), F.lit(1) if block is None else F.lit(0)).otherwise(0).alias("late"), "turn",
        md5_number(F.concat(F.coalesce(F.concat(F.lit("0"), "role"), F.lit("1")), F.lit("\n"), text), 2).alias("slice"))
    cells = messages.select("*", F.struct(F.coalesce("block", F.lit(-(1 << 62))).alias("b")).alias("part"),
                            F.struct("late", F.coalesce("turn", F.lit(0)).alias("t"), "slice").alias("cell"),
                            F.struct(F.col("role").isNull().alias("none"), F.coalesce("role", F.lit("")).alias("r")).alias("speaker"))
    ranked = group_rank(staged(cells, "messages"), ["key", "part"], "cell", ["speaker", "text"], "rank")
    piece = F.floor(F.col("rank") / block).cast("long") if block else F.lit(0).cast("long")
    return (ranked.withColumn("sub_block", piece)
            .groupBy("key", "part", "sub_block")
            .agg(F.first("conv_id").alias("conv_id"), F.first("block").alias("block"),
                 F.sort_array(F.collect_list(F.struct("rank", "role", "text"))).alias("messages")).drop("part"))


def participants(conversations: DataFrame) -> DataFrame:
    """(key, participant): the speakers of each dialogue who get a perspective."""
    return (conversations.where(F.col("role").isNotNull() & (F.col("role") != "system"))
            .select(null_key("conv_id").alias("key"), F.col("role").alias("participant")).distinct())


def rotate(conversations: DataFrame, block: int | None = BLOCK) -> DataFrame:
    """conv_id, participant, block, sub_block, n_messages, n_assistant, rendered, mask_spans."""
    # A long dialogue has many blocks and all its participants: both are dealt over the salts.
    salted = participants(conversations).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = (blocks(conversations, block).withColumn("salt", F.pmod(F.xxhash64("block", "sub_block"), F.lit(SALTS)).cast("int"))
            .join(salted, ["key", "salt"]))
    who = F.col("participant")
    each = each.withColumn("parts", F.transform(
        "messages", lambda m: F.struct(_head(m["role"], who).alias("head"), m["text"].alias("text"),
                                       F.coalesce(m["role"] == who, F.lit(False)).alias("own"))))
    each = each.withColumn("lengths", F.transform(
        "parts", lambda p: (F.length(p["head"]) + F.length(p["text"]) + len(CLOSE)).cast("long")))
    each = each.withColumn("spans", F.transform("parts", lambda p, i: F.struct(
        p["own"].alias("own"),
        (F.aggregate(F.slice("lengths", F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x) + F.length(p["head"])).alias("start"),
        F.aggregate(F.slice("lengths", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, x: a + x).alias("end"))))
    own = F.filter("spans", lambda s: s["own"])
    return each.select(
        "conv_id", "participant", "block", "sub_block", F.size("messages").cast("long").alias("n_messages"),
        F.size(own).cast("long").alias("n_assistant"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["text"], F.lit(CLOSE))), "").alias("rendered"),
        F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
        .alias("mask_spans"))
