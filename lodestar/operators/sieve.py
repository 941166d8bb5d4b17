"""A bitmap of fixed size that keeps rows out of a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 64-bit words of the bitmap: 8 million bits, about a megabyte.
WORDS = 1 << 17


def maybe_among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key is one of the wanted ones, and some few others; nothing is shuffled but a bitmap.

    The bitmap has a fixed size, so it may be broadcast whatever the number of wanted
    keys; with very many of them it only lets more pass.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(WORDS * 64))
    word, bit = F.shiftright(slot, 6), F.pmod(slot, F.lit(64)).cast("int")
    marks = wanted.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_mark"))
    bitmap = marks.groupBy("_word").agg(F.bit_or("_mark").alias("_bits"))
    marked = rows.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(bitmap), "_word")
    return marked.where(F.getbit("_bits", F.col("_bit")) == 1).select(rows.columns)
