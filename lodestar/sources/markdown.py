"""Markdown pages: lines by kind, pages by markers, segments cut or joined to a page count, texts cut into chunks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.sources.layout import table_text


def lines(files: DataFrame) -> DataFrame:
    """files: file, text. A row for each line with text: kind, content, table_data and the segment that page markers make."""
    rows = files.select("file", F.posexplode(F.split(F.regexp_replace("text", r"(?is)<table.*?</table>", "\n$0\n"), "\n(?![^<]*</table>)")).alias("line", "raw")).withColumn("raw", F.trim("raw"))
    marker = F.col("raw").rlike(r"^\d+\s*/\s*\d+$")
    kind = (
        F.when(marker, "page_marker")
        .when(F.col("raw").rlike("(?is)^<table"), "table")
        .when(F.col("raw").rlike(r"^!\[[^\]]*\]\([^)]*\)$"), "image")
        .when(F.col("raw").rlike(r"^#{1,6}\s"), "title")
        .when(F.col("raw").rlike(r"^([-*+]|\d+[.)])\s"), "list")
        .otherwise("text")
    )
    rows = rows.where("raw <> ''").withColumn("kind", kind)
    order = Window.partitionBy("file").orderBy("line")
    rows = rows.withColumn("segment", F.sum((F.col("kind") == "page_marker").cast("int")).over(order)).where("kind <> 'page_marker'")
    content = F.when(F.col("kind") == "title", F.regexp_replace("raw", r"^#+\s*", "")).when(F.col("kind") == "table", "").otherwise(F.col("raw"))
    return rows.select("file", "segment", "line", "kind", content.alias("content"), F.when(F.col("kind") == "table", table_text(F.col("raw"))).otherwise("").alias("table_data"))


def reshape(segments: pd.DataFrame, target: int) -> pd.DataFrame:
    """Segments (order, text) of one file made as many as ``target``: the smallest joins its neighbour before, the largest is halved at its middle line."""
    texts = segments.sort_values("order")["text"].fillna("").tolist()
    while len(texts) > max(1, target):
        k = min(range(len(texts)), key=lambda i: (len(texts[i]), i))
        at = k - 1 if k else 0
        texts[at : at + 2] = ["\n".join(texts[at : at + 2])]
    while 0 < len(texts) < target:
        k = max(range(len(texts)), key=lambda i: (len(texts[i]), -i))
        parts = texts[k].split("\n")
        if len(parts) < 2:
            break
        half, size, cut = len(texts[k]) / 2, 0, 1
        for cut, part in enumerate(parts[:-1], 1):  # noqa: B007
            size += len(part) + 1
            if size >= half:
                break
        texts[k : k + 1] = ["\n".join(parts[:cut]), "\n".join(parts[cut:])]
    return pd.DataFrame({"page": range(1, len(texts) + 1), "text": texts})


def pages(segments: DataFrame, target: str) -> DataFrame:
    """(file, page, text): segments (file, order, text, and the wanted number of pages) reshaped file by file. Sequential by nature, so each file is one pandas group."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = reshape(group, int(group[target].iloc[0]))
        out.insert(0, "file", group["file"].iloc[0])
        return out

    return segments.groupBy("file").applyInPandas(run, f"file {segments.schema['file'].dataType.simpleString()}, page int, text string")


def split_text(text: str | None, limit: int) -> list[str]:
    """Chunks of at most ``limit`` characters: paragraphs together as long as they fit, longer ones cut hard."""
    out: list[str] = []
    held = ""
    for paragraph in filter(None, (p.strip() for p in (text or "").split("\n\n"))):
        joined = f"{held}\n\n{paragraph}" if held else paragraph
        if len(joined) <= limit:
            held = joined
            continue
        if held:
            out.append(held)
        while len(paragraph) > limit:
            out.append(paragraph[:limit])
            paragraph = paragraph[limit:]
        held = paragraph
    return [*out, held] if held else out


def chunks(docs: DataFrame, id_col: str, text_col: str, limit: int = 2000) -> DataFrame:
    """(id, chunk, text) of every document's whole text."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_text(t, limit))

    return docs.select(id_col, F.posexplode(cut(text_col)).alias("chunk", "text"))
