"""Page order, context windows, islands, clusters and other ordered frames within documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import Name, col


def page_sort_key(page: Name) -> Column:
    """(document, number, label) of ``<doc>_page_<i>`` and ``part_<s>_<e>_<doc>_page_<i>``; other labels sort by themselves."""
    text = F.coalesce(col(page), F.lit(""))
    part, plain = r"^part_(\d+)_(\d+)_(.+)_page_(\d+)$", r"^(.+)_page_(\d+)$"
    number = lambda pattern, g: F.coalesce(F.regexp_extract(text, pattern, g).try_cast("long"), F.lit(0))
    return (
        F.when(text.rlike(part), F.struct(F.regexp_extract(text, part, 3).alias("doc"), (number(part, 1) + number(part, 4)).alias("at"), text.alias("label")))
        .when(text.rlike(plain), F.struct(F.regexp_extract(text, plain, 1).alias("doc"), number(plain, 2).alias("at"), text.alias("label")))
        .otherwise(F.struct(text.alias("doc"), F.lit(0).cast("long").alias("at"), text.alias("label")))
    )


def context_windows(pages: DataFrame, doc: str, order: str, text: str, around: int = 2, header: list[str] | None = None, header_items: int = 20) -> DataFrame:
    """Each page with the text of its neighbours, marked, the page itself as current; optionally known models in front."""
    frame = Window.partitionBy(doc).orderBy(order).rowsBetween(-around, around)
    near = F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t"))).over(frame)
    out = pages.withColumn("near", near)
    piece = F.transform("near", lambda p: F.concat(F.when(p["o"] == F.col(order), "[current page ").otherwise("[page "), p["o"].cast("string"), F.lit("]\n"), p["t"]))
    shown = F.array_join(piece, "\n\n")
    if header:
        shown = F.concat(F.lit("[known models] " + ", ".join(header[:header_items]) + "\n\n"), shown)
    return out.withColumns({"window_pages": F.transform("near", lambda p: p["o"].cast("string")), "window_text": shown}).drop("near")


def logical_documents(units: DataFrame, group: str, seq: str, page_idx: str) -> DataFrame:
    """Adds ``logical_doc``: a new one begins where the page index returns to 0 after a larger one."""
    order = Window.partitionBy(group).orderBy(seq)
    before = F.lag(page_idx).over(order)
    start = F.when((F.col(page_idx) == 0) & (before > 0), 1).otherwise(0)
    return units.withColumn("_start", start).withColumn("logical_doc", F.sum("_start").over(order)).drop("_start")


def logical_pages(units: DataFrame, group: list[str], seq: str, page_idx: str) -> DataFrame:
    """Adds ``logical_page``: it goes up with every unit, but for a 0 after a 0."""
    order = Window.partitionBy(*group).orderBy(seq)
    before = F.lag(page_idx).over(order)
    step = F.when(before.isNull() | ((before == 0) & (F.col(page_idx) == 0)), 0).otherwise(1)
    return units.withColumn("_step", step).withColumn("logical_page", F.sum("_step").over(order)).drop("_step")


def fixed_clusters(pages: DataFrame, doc: str, order: str, text: str, size: int = 5) -> DataFrame:
    """(doc, cluster, pages, text): runs of ``size`` pages."""
    at = F.row_number().over(Window.partitionBy(doc).orderBy(order)) - 1
    rows = pages.withColumn("cluster", F.floor(at / size).cast("int"))
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    return rows.groupBy(doc, "cluster").agg(listed.alias("p")).select(doc, "cluster", F.transform("p", lambda x: x["o"].cast("string")).alias("pages"), F.array_join(F.transform("p", lambda x: x["t"]), "\n\n").alias("text"))


def following_pages(pages: DataFrame, doc: str, order: str, is_base: Column, following: int = 2) -> DataFrame:
    """Base pages and the next few after each, within their document."""
    frame = Window.partitionBy(doc).orderBy(order).rowsBetween(-following, 0)
    return pages.withColumn("_near", F.max(is_base.cast("int")).over(frame)).where("_near = 1").drop("_near")


def reading_order(blocks: DataFrame, page: list[str], bbox: str, seq: str, index: str | None = None) -> DataFrame:
    """Adds ``reading_rank``: by index if there is one, then by the centre of the box, top to bottom."""
    far = F.lit(1e9)
    y, x = F.coalesce((F.get(bbox, 1) + F.get(bbox, 3)) / 2, far), F.coalesce((F.get(bbox, 0) + F.get(bbox, 2)) / 2, far)
    keys = ([F.coalesce(F.col(index).cast("double"), far)] if index else []) + [y, x, F.col(seq)]
    return blocks.withColumn("reading_rank", F.row_number().over(Window.partitionBy(*page).orderBy(*keys)))


def prompt_batches(items: DataFrame, group: str, order: str, text: str, max_items: int = 20, max_chars: int = 2000) -> DataFrame:
    """Adds ``batch``: the next item opens a new one where the current would pass either limit.

    The rule is sequential, so each group is folded in order; groups are documents.
    """
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n"))))
    start = F.struct(F.lit(0).alias("batch"), F.lit(0).cast("long").alias("items"), F.lit(0).cast("long").alias("chars"), F.array().cast("array<struct<o:long,batch:int>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        full = (s["items"] > 0) & ((s["items"] + 1 > max_items) | (s["chars"] + x["n"] > max_chars))
        batch = s["batch"] + full.cast("int")
        return F.struct(
            batch.alias("batch"),
            F.when(full, F.lit(1).cast("long")).otherwise(s["items"] + 1).alias("items"),
            F.when(full, x["n"]).otherwise(s["chars"] + x["n"]).alias("chars"),
            F.concat(s["out"], F.array(F.struct(x["o"].cast("long").alias("o"), batch.alias("batch")))).alias("out"),
        )

    folded = items.groupBy(group).agg(F.aggregate(listed, start, step, lambda s: s["out"]).alias("out"))
    return folded.select(group, F.explode("out").alias("x")).select(group, F.col("x.o").alias(order), "x.batch")
