"""Dialogues of several speakers, rendered once from the view of each of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.llm.common import put_aside

# How a message is written down.
OPENING, AFTER_ROLE, CLOSING = "<|", "|>\n", "<|end|>\n"
ASSISTANT, USER = "assistant", "user"
UNNAMED = "unnamed"  # stands for a speaker that is null


def _running(rows: DataFrame, group: Sequence[str], order: Sequence[str], length: str, column: str) -> DataFrame:
    """`column`: the lengths of the rows before, per group, without gathering a group in one task.

    Rows are range-partitioned by group and order and stored with their partition; a running sum inside each partition
    is completed by the sums of the group's earlier partitions (one small row per group and partition).
    """
    laid = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    stored = put_aside(laid.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()),
                       "turns")
    inside = Window.partitionBy("_part", *group).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored.groupBy("_part", *group).agg(F.sum(length).alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    sums = put_aside(sums.filter("_before > 0"), "turn-sums").select(
        F.col("_part").alias("_p"), "_before", *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)])
    local = stored.withColumn("_inside", F.coalesce(F.sum(length).over(inside), F.lit(0)))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return local.join(sums, same, "left").withColumn(column, F.col("_inside") + F.coalesce("_before", F.lit(0))).select(
        *rows.columns, column)


def _segment(role: Column, content: Column) -> Column:
    return F.concat(F.lit(OPENING), role, F.lit(AFTER_ROLE), content, F.lit(CLOSING))


def rotate_perspectives(reports: DataFrame, dialogue: str = "id_ceda_agricultura", turn: str = "fecha_y_hora",
                        speaker: str = "quien_reporta", text: str = "observaciones") -> DataFrame:
    """The field reports of a centre as a dialogue, seen by every person who reports there.

    One row per dialogue, perspective and turn: `role` (assistant for the perspective's own turns, user for the
    others), `content` (others' turns start with `name: `), `segment` (the message as written), `start` (its first
    character in the rendered dialogue), `mask_start` and `mask_end` (the characters to learn from: the own turns'
    content and closing mark; null for others). The segments of a perspective in order of `start` are its rendering,
    so a dialogue of any length needs no row that holds it whole.

    Null texts are empty; null speakers are one speaker called `unnamed`; null dialogues are one dialogue; null turns
    come first. Equal turns are ordered by speaker and text; repeated rows are repeated turns. Other columns are
    ignored; an empty table gives no rows.
    """
    turns = reports.select(
        F.col(dialogue).alias("_d"), F.col(turn).alias("_turn"),
        F.coalesce(F.col(speaker).cast("string"), F.lit(UNNAMED)).alias("_speaker"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    voices = put_aside(turns.select(F.col("_d").alias("_dv"), F.col("_speaker").alias("_view")).distinct(), "voices")
    seen = turns.join(voices, F.col("_d").eqNullSafe(F.col("_dv")))
    own = F.col("_speaker") == F.col("_view")
    role = F.when(own, F.lit(ASSISTANT)).otherwise(F.lit(USER))
    content = F.when(own, F.col("_text")).otherwise(F.concat("_speaker", F.lit(": "), "_text"))
    seen = seen.select("_d", "_view", "_turn", "_speaker", role.alias("role"), content.alias("content"))
    seen = seen.withColumn("segment", _segment(F.col("role"), F.col("content"))).withColumn(
        "_length", F.length("segment").cast("long"))
    placed = _running(seen, ["_d", "_view"], ["_turn", "_speaker", "content"], "_length", "start")
    head = F.length(F.concat(F.lit(OPENING), "role", F.lit(AFTER_ROLE))).cast("long")
    trained = F.col("role") == ASSISTANT
    return placed.select(
        F.col("_d").alias(dialogue), F.col("_view").alias("perspective"), F.col("_turn").alias(turn),
        F.col("_speaker").alias(speaker), "role", "content", "segment", "start",
        F.when(trained, F.col("start") + head).alias("mask_start"),
        F.when(trained, F.col("start") + F.col("_length")).alias("mask_end"))
