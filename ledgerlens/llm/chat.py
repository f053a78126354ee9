"""Chat formatting with every participant in turn as the assistant.

For each participant of a conversation the whole dialogue is rendered with that speaker as ``assistant``, the others as
named users, and mask spans over what the assistant says. Turns are numbered exactly and rendered in blocks of
``block_turns`` consecutive turns; the blocks of a perspective, in order, are its text. Most conversations fill one block,
and one of any length stays spread over many rows.

* Turns are ordered by their number, a missing one first, then by speaker and text; repeated rows are turns of their own.
* System speakers are shown as such in every perspective and are no participants. A conversation without participants has
  no rows. A missing speaker is called ``unknown``, a missing text is empty. Rows without a conversation id form one
  conversation without an id. Control marks inside a text or a name are broken up by a blank, so that no turn can be forged;
  line breaks in a name become blanks.
* Masks are code points within the block's text, the end exclusive: what the assistant says and its end mark.
* Extra columns are not read; an empty table gives an empty result. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import staged

START, STOP = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Settings:
    block_turns: int = 64
    system: Sequence[str] = ("system",)


def _plain(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Add ``place``, counting from 0 within each ``conv``, without gathering a conversation in one task.

    Rows are cut into ordered parts, written out, and counted within each; a part then starts after the parts before.
    """
    order = ["turn", "speaker", "text"]
    cut = turns.repartitionByRange("conv", *order, F.rand(7)).withColumn("part", F.spark_partition_id())
    cut = staged(cut, "turns")
    sizes = cut.groupBy("conv", "part").agg(F.count("*").alias("size"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("conv").alias("_conv"), F.col("part").alias("_part"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    )
    local = cut.withColumn("local", F.row_number().over(Window.partitionBy("part", "conv").orderBy(*order)) - 1)
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    return local.join(starts, same).select("conv", *order, (F.col("start") + F.col("local")).alias("place"))


def perspectives(
    turns: DataFrame, settings: Settings = Settings(), conv: str = "conv_id", turn: str = "turn", speaker: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, perspective, block, n_turns, text, masks) with masks as structs (start, end)."""
    name = F.translate(_plain(F.coalesce(F.col(speaker), F.lit("unknown"))), "\r\n", "  ")
    base = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), name.alias("speaker"),
        _plain(F.coalesce(F.col(text), F.lit(""))).alias("text"),
    )
    placed = numbered_turns(base)
    said = F.struct((F.col("place") % settings.block_turns).alias("at"), "speaker", "text")
    blocks = placed.groupBy("conv", F.floor(F.col("place") / settings.block_turns).alias("block")).agg(
        F.array_sort(F.collect_list(said)).alias("turns")
    )
    people = base.filter(~F.col("speaker").isin(*settings.system)).select(
        F.col("conv").alias("_conv"), F.col("speaker").alias("perspective")
    ).distinct()
    seen = blocks.join(people, F.col("conv").eqNullSafe(F.col("_conv")))
    me, is_system = F.col("perspective"), lambda t: t["speaker"].isin(*settings.system)
    role = lambda t: F.when(t["speaker"] == me, F.lit("assistant")).when(is_system(t), F.lit("system")).otherwise(
        F.concat(F.lit("user name="), t["speaker"])
    )
    parts = seen.withColumn(
        "parts",
        F.transform("turns", lambda t: F.struct(
            F.concat(F.lit(START), role(t), F.lit("\n")).alias("head"), F.concat(t["text"], F.lit(STOP)).alias("body"),
            (t["speaker"] == me).alias("own"),
        )),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("masks"))
    masks = F.aggregate("parts", start, _masked, lambda done: done["masks"])
    rendered = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")
    return parts.select(
        F.col("conv").alias("conv_id"), "perspective", "block", F.size("turns").alias("n_turns"), rendered.alias("text"),
        masks.alias("masks"),
    )


def _masked(done: Column, part: Column) -> Column:
    body = done["at"] + F.length(part["head"])
    end = body + F.length(part["body"])
    span = F.struct(body.alias("start"), end.alias("end"))
    own = F.when(part["own"], F.array(span)).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
    return F.struct((end + 1).alias("at"), F.concat(done["masks"], own).alias("masks"))
