"""Names of contents: 64-bit ones that are used as keys, made safe by 64 further bits."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.storage import Scratch


def content_name(content: bytes, bits: int = 64) -> tuple[int, int]:
    """Two signed 64-bit numbers, of which the first keeps only its highest ``bits``."""
    digest = hashlib.blake2b(content, digest_size=16).digest()
    first = int.from_bytes(digest[:8], "big", signed=True)
    return first >> (64 - bits), int.from_bytes(digest[8:], "big", signed=True)


def rename(rows: DataFrame, renamed: DataFrame) -> DataFrame:
    """Rows with the fresh names of those that ``renamed`` (node, check, fresh) lists."""
    columns = rows.columns
    found = rows.join(renamed, ["node", "check"], "left").withColumn("node", F.coalesce("fresh", "node"))
    return found.select(columns)


def settle_names(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, list[DataFrame]]:
    """rows: node, check and more. The same rows with a node of its own for each pair of node and check, and the renamings applied.

    Usually no two contents share a node, and then this is one grouped minimum.
    """
    renamings: list[DataFrame] = []
    while True:
        named = rows.where("node IS NOT NULL")
        clash = named.groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where("lo <> hi").select("node")
        if clash.isEmpty():
            return rows, renamings
        fresh = named.join(clash, "node", "left_semi").select("node", "check").distinct().withColumn("fresh", F.xxhash64("node", "check", F.lit(len(renamings))))
        renamings.append(scratch.save(fresh, "renamed"))
        rows = scratch.save(rename(rows, renamings[-1]), "rows")
