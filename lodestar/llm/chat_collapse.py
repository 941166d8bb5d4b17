"""Chat logs: drop the snapshots that a longer logged conversation continues, render the rest.

A log often holds a conversation again after every turn.  The turns of each logged
conversation are hashed with their positions, and running sums of the hashes name
each of its prefixes.  A conversation whose whole name is the name of a proper
prefix of another one is a snapshot of it, and leaves by an anti-join; of equal
conversations the one of the smallest id stays.  What is left is rendered.

Only DataFrame functions are used.  Equal conversations are reduced to one row
before the anti-join, and prefixes to distinct names, so copies gather nowhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.storage import Scratch

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_NAME = ["pos", "p1", "p2"]


def _turns(log: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Turns with their positions, the name of the prefix that each one ends, and whether it is the last."""
    rows = log.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    rows = rows.withColumn("solo", F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text")))
    order = Window.partitionBy("conv_id", "solo").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    again = F.col("turn").eqNullSafe(F.lag("turn").over(order)) & (F.col("role") == F.lag("role").over(order)) & (F.col("text") == F.lag("text").over(order))
    rows = rows.withColumn("again", F.coalesce(again, F.lit(False)) & (F.row_number().over(order) > 1)).where("NOT again").drop("again")
    rows = rows.withColumn("pos", F.row_number().over(order))
    digest = lambda salt: F.xxhash64(F.lit(salt), "pos", "role", "text").cast("decimal(20,0)")
    rows = rows.withColumns({"p1": F.sum(digest(1)).over(order), "p2": F.sum(digest(2)).over(order), "last": F.lead("pos").over(order).isNull()})
    return rows.select("conv_id", "solo", *_NAME, "role", "text", "last")


def _render(turns: Column) -> Column:
    safe = lambda c: F.replace(c, F.lit("<|im_"), F.lit("<| im_"))
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), safe(t["role"]), F.lit("\n"), safe(t["text"]), F.lit(CLOSE), F.lit("\n"))), "")


def collapse(log: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, n_copies, rendered) of every maximal conversation.

    Turns are in the order of (turn, role, text), a null turn first; identical rows of
    a conversation count once; null roles and texts count as empty.  A row without a
    conversation id is a conversation of one turn, and its id stays null.  ``n_copies``
    counts the logged conversations of equal content.  Markers inside a text are
    broken up, so that a text can't open a turn.  Other columns are ignored.  The
    result's text is one row for each conversation, so a conversation has to fit one.
    """
    scratch = Scratch(log.sparkSession, "chat")
    turns = scratch.save(_turns(log, id_col, turn_col, role_col, text_col), "turns")
    owner = F.struct(F.col("conv_id").isNull().alias("anonymous"), "conv_id", "solo")
    whole = turns.where("last").groupBy(*_NAME).agg(F.min(owner).alias("owner"), F.count("*").alias("n_copies"))
    prefixes = turns.where("NOT last").select(*_NAME).distinct()
    kept = whole.join(prefixes, _NAME, "left_anti").select(F.col("owner.conv_id").alias("conv_id"), F.col("owner.solo").alias("solo"), F.col("pos").alias("n_turns"), "n_copies")
    same = F.col("t.conv_id").eqNullSafe(F.col("k.conv_id")) & F.col("t.solo").eqNullSafe(F.col("k.solo"))
    rows = turns.alias("t").join(kept.alias("k"), same).select("k.conv_id", "k.solo", "k.n_turns", "k.n_copies", "t.pos", "t.role", "t.text")
    full = rows.groupBy("conv_id", "solo", "n_turns", "n_copies").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("turns"))
    return full.select("conv_id", "n_turns", "n_copies", _render(F.col("turns")).alias("rendered"))
