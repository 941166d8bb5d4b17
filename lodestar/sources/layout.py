"""Layout JSON of scanned documents: blocks, tables, page texts."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SPAN = "struct<type:string,content:string,html:string,image_path:string>"
_LINES = f"array<struct<spans:array<{_SPAN}>>>"
_PARA = f"struct<type:string,bbox:array<double>,index:int,lines:{_LINES},blocks:array<struct<type:string,lines:{_LINES}>>>"
PAGES = f"array<struct<page_idx:string,para_blocks:array<{_PARA}>,discarded_blocks:array<{_PARA}>>>"
DOCUMENTS = "array<struct<id:string,source_url:string,content:string>>"
ROOT = f"struct<pdf_info:{PAGES},documents:{DOCUMENTS}>"


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc_id, doc_pos, page_pos, page_idx, para_blocks, discarded_blocks): a row for each page.

    A file is one document with ``pdf_info``, or a list of documents whose content is
    such a document, as JSON within the JSON.
    """
    files = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.from_json("value", ROOT).alias("root"))
    inner = F.transform("root.documents", lambda d: F.struct(d["id"].alias("id"), F.from_json(d["content"], f"struct<pdf_info:{PAGES}>")["pdf_info"].alias("pages")))
    single = F.array(F.struct(F.lit(None).cast("string").alias("id"), F.col("root.pdf_info").alias("pages")))
    docs = files.select("file", F.posexplode(F.when(F.col("root.documents").isNotNull(), inner).otherwise(single)).alias("doc_pos", "doc"))
    pages = docs.select("file", "doc_pos", F.col("doc.id").alias("doc_id"), F.posexplode("doc.pages").alias("page_pos", "page"))
    return pages.select("file", "doc_id", "doc_pos", "page_pos", F.coalesce(F.col("page.page_idx").try_cast("int"), F.lit(0)).alias("page_idx"), "page.para_blocks", "page.discarded_blocks")


def spans_text(lines: Column, joiner: str = " ") -> Column:
    """The text of the text spans of lines."""
    spans = F.flatten(F.transform(F.coalesce(lines, F.array().cast(_LINES)), lambda x: F.coalesce(x["spans"], F.array().cast(f"array<{_SPAN}>"))))
    return F.array_join(F.filter(F.transform(F.filter(spans, lambda s: s["type"].isin("text", "inline_equation")), lambda s: F.trim(F.coalesce(s["content"], F.lit("")))), lambda t: t != ""), joiner)


def _all_lines(block: Column) -> Column:
    return F.concat(F.coalesce(block["lines"], F.array().cast(_LINES)), F.flatten(F.transform(F.coalesce(block["blocks"], F.array().cast(f"array<struct<type:string,lines:{_LINES}>>")), lambda b: F.coalesce(b["lines"], F.array().cast(_LINES)))))


def table_rows(html: Column) -> Column:
    """Rows of cell texts of an HTML table: tags off, white space collapsed, cells and rows without text left out."""
    clean = lambda t: F.trim(F.regexp_replace(unescape(F.regexp_replace(t, "(?s)<[^>]*>", " ")), r"(?U)\s+", " "))
    rows = F.regexp_extract_all(html, F.lit("(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.filter(F.transform(F.regexp_extract_all(r, F.lit("(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), clean), lambda c: c != ""))
    return F.filter(cells, lambda r: F.size(r) > 0)


def table_text(html: Column) -> Column:
    return F.array_join(F.transform(table_rows(html), lambda r: F.array_join(r, " | ")), "\n")


def unescape(text: Column) -> Column:
    """Character references, by name or by number, as the characters that they stand for; unknown ones stay."""
    names = F.create_map(*(F.lit(x) for name, point in name2codepoint.items() for x in (name, chr(point))))

    def one(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^&(#?[A-Za-z0-9]+);", 1)
        number = F.coalesce(F.conv(F.nullif(F.regexp_extract(name, r"^#[xX]([0-9A-Fa-f]{1,6})$", 1), F.lit("")), 16, 10), F.nullif(F.regexp_extract(name, r"^#([0-9]{1,7})$", 1), F.lit(""))).try_cast("int")
        written = F.when(number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        found = F.coalesce(F.try_element_at(names, name), written, F.when(name == "apos", "'"))
        return F.when(found.isNull(), piece).otherwise(F.concat(found, F.substring(piece, F.length(name) + 3, F.length(piece))))

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "(?=&)"), one), "")).otherwise(text)


def blocks(pages: DataFrame, keep_discarded: bool = True) -> DataFrame:
    """Block rows of pages in order: type, bbox, content, table_data, image_path, seq."""
    empty = F.array().cast(f"array<{_PARA}>")
    marked = F.transform(F.coalesce("para_blocks", empty), lambda b: F.struct(b.alias("b"), b["type"].alias("type")))
    if keep_discarded:
        marked = F.concat(marked, F.transform(F.coalesce("discarded_blocks", empty), lambda b: F.struct(b.alias("b"), F.concat(F.lit("discarded_"), F.coalesce(b["type"], F.lit("block"))).alias("type"))))
    rows = pages.select("file", "doc_id", "doc_pos", "page_pos", "page_idx", F.posexplode(marked).alias("seq", "x")).select("*", "x.*").drop("x")
    lines = _all_lines(F.col("b"))
    spans = F.flatten(F.transform(lines, lambda x: F.coalesce(x["spans"], F.array().cast(f"array<{_SPAN}>"))))
    html = F.get(F.filter(F.transform(spans, lambda s: s["html"]), lambda h: h.isNotNull()), 0)
    image = F.get(F.filter(F.transform(spans, lambda s: s["image_path"]), lambda h: h.isNotNull()), 0)
    is_table, is_image = F.col("type") == "table", F.col("type") == "image"
    out = rows.select(
        "file", "doc_id", "doc_pos", "page_pos", "page_idx", "seq", "type", F.col("b.bbox").alias("bbox"), F.col("b.index").alias("index"),
        F.when(is_image, "[image]").otherwise(spans_text(lines)).alias("content"),
        F.when(is_table, table_text(html)).otherwise("").alias("table_data"),
        F.coalesce(image, F.lit("")).alias("image_path"),
    )
    return out.where((F.col("content") != "") | (F.coalesce("table_data", F.lit("")) != ""))


def page_texts(rows: DataFrame, page: list[str]) -> DataFrame:
    """One text for each page: blocks in reading order, tagged by kind, without images and discarded blocks."""
    body = F.when(F.col("type") == "table", F.concat(F.lit("[table]\n"), F.col("table_data"))).when(F.col("type") == "title", F.concat(F.lit("[title] "), F.col("content"))).otherwise(F.col("content"))
    kept = rows.where(~F.lower("type").isin("image") & ~F.lower("type").startswith("discarded_"))
    far = F.lit(1e9)
    y, x = F.coalesce((F.get("bbox", 1) + F.get("bbox", 3)) / 2, far), F.coalesce((F.get("bbox", 0) + F.get("bbox", 2)) / 2, far)
    listed = F.array_sort(F.collect_list(F.struct(F.coalesce(F.col("index").cast("double"), far).alias("i"), y.alias("y"), x.alias("x"), "seq", body.alias("t"))))
    return kept.groupBy(*page).agg(F.count("*").alias("row_count"), F.array_join(F.transform(listed, lambda r: r["t"]), "\n\n").alias("text"))


def file_identity(name: Column) -> Column:
    """(part_start, part_end, doc_id) of ``part_<s>_<e>_<id>`` names, with or without ``_result``."""
    stem = F.regexp_replace(F.regexp_replace(name, r"\.[A-Za-z0-9]+$", ""), "_result$", "")
    part = r"^part_(\d+)_(\d+)_(.+)$"
    return F.struct(F.regexp_extract(stem, part, 1).try_cast("int").alias("part_start"), F.regexp_extract(stem, part, 2).try_cast("int").alias("part_end"), F.coalesce(F.nullif(F.regexp_extract(stem, part, 3), F.lit("")), stem).alias("doc_id"))


def inside_a_table(boxes: DataFrame, page: list[str], least: float = 0.85) -> DataFrame:
    """Adds ``in_table``: does a table of the page cover most of the block's box?"""
    ordered = lambda b: F.struct(F.least(F.get(b, 0), F.get(b, 2)).alias("x0"), F.least(F.get(b, 1), F.get(b, 3)).alias("y0"), F.greatest(F.get(b, 0), F.get(b, 2)).alias("x1"), F.greatest(F.get(b, 1), F.get(b, 3)).alias("y1"))
    rows = boxes.withColumn("_box", ordered("bbox"))
    tables = rows.where("type = 'table'").groupBy(*page).agg(F.collect_list("_box").alias("_tables"))
    width = lambda a, b: F.greatest(F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), F.lit(0.0))
    height = lambda a, b: F.greatest(F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]), F.lit(0.0))
    area = (F.col("_box.x1") - F.col("_box.x0")) * (F.col("_box.y1") - F.col("_box.y0"))
    covered = F.exists("_tables", lambda t: width(F.col("_box"), t) * height(F.col("_box"), t) >= least * area)
    return rows.join(tables, page, "left").withColumn("in_table", F.coalesce((F.col("type") != "table") & (area > 0) & covered, F.lit(False))).drop("_box", "_tables")
