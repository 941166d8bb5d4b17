"""JSON, JSON Lines, CSV and Markdown files as tables, tolerant where the formats are loose."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPEC_TYPE = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("name", "value", "unit", "raw")]))
PRODUCT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("brand", "category", "series", "product_model", "manufacturer", "refrigerant", "energy_efficiency_grade")]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("features", "key_components", "fact_text", "evidence")]
    + [T.StructField("performance_specs", SPEC_TYPE)]
)
ENVELOPES = T.ArrayType(T.StructType([T.StructField("results", T.ArrayType(PRODUCT))]))
BLOCK_COLUMNS = ["sample", "file", "page", "type", "bbox", "content", "table_data", "image_path"]
BLOCKS = T.StructType([T.StructField(n, T.StringType()) for n in BLOCK_COLUMNS])


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Products of files that are arrays of ``{"results": [...]}``, with _file, _batch and result_index.

    Lists of records, single envelopes, single records and JSON Lines are read as well;
    a file that is none of these, or has a broken line, fails the job that reads it.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("_file"), F.col("value").alias("doc"))
    return unnest_records(whole.withColumn("doc", _as_array(F.col("doc"))))


def _as_array(doc):
    """One JSON array of what a file holds: itself, or its lines, or its single object."""
    text = F.trim(doc)
    parts = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    lines = F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))
    by_line = F.forall(parts, lambda x: F.try_parse_json(x).isNotNull())
    single = F.concat(F.lit("["), text, F.lit("]"))
    found = F.when(text.startswith("["), text).when(by_line, lines).otherwise(single)
    broken = F.raise_error(F.concat(F.lit("not JSON: "), F.substring(text, 1, 80)))
    return F.when(F.try_parse_json(found).isNull(), broken).otherwise(found)


def unnest_records(docs: DataFrame) -> DataFrame:
    """docs: _file, doc (a JSON array of envelopes, lists or records)."""
    items = docs.select("_file", F.posexplode(F.from_json("doc", T.ArrayType(T.StringType()))).alias("_batch", "item"))
    listed = F.from_json("item", T.StructType([T.StructField("results", T.ArrayType(PRODUCT))]))
    records = F.when(F.get_json_object("item", "$.results").isNotNull(), listed["results"]).otherwise(F.array(F.from_json("item", PRODUCT)))
    return items.select("_file", "_batch", F.posexplode(records).alias("result_index", "r")).select("_file", "_batch", "result_index", "r.*")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Objects of a JSON Lines file; blank, broken and non-object lines are skipped."""
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.col("value"), F.try_parse_json("value").alias("v"))
    return lines.where(F.col("v").isNotNull() & F.trim("value").startswith("{")).select(F.from_json("value", schema).alias("r")).select("r.*")


def read_blocks_csv(spark: SparkSession, path: str) -> DataFrame:
    """Block rows of a CSV with a header; fields may hold line breaks, and the file a byte order mark."""
    return spark.read.schema(BLOCKS).csv(path, header=True, multiLine=True, escape='"', enforceSchema=False)


def write_blocks_csv(blocks: DataFrame, path: str) -> None:
    flat = blocks.withColumn("table_data", F.replace(F.col("table_data"), F.lit("\n"), F.lit(" \\n ")))
    flat.select(BLOCK_COLUMNS).write.mode("overwrite").csv(path, header=True, escape='"')


def read_markdown(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(path, file, doc_group, text): Markdown files, grouped by the folder that they are in."""
    files = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.md").text(path, wholetext=True)
    parts = F.split(F.col("path"), "/")
    rows = files.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿", "").alias("text"))
    return rows.select("path", F.element_at(parts, -1).alias("file"), F.element_at(parts, -2).alias("doc_group"), "text")


def discover_tasks(files: DataFrame, min_chars: int = 50) -> DataFrame:
    """(doc_key, kind, md_files): documents of Markdown files; parts of one document go together, in order.

    files: path, file, doc_group, text. Files of little text, and single files whose
    name is only an identifier, are left out. Keys are unique: repeats get a suffix.
    """
    from pyspark.sql import Window

    stem = F.regexp_replace(F.regexp_replace("file", r"\.md$", ""), r"_result$", "")
    part = r"^part_(\d+)_(\d+)_(.+)$"
    plain = F.regexp_replace(F.regexp_replace("text", r"!\[[^\]]*\]\([^)]*\)", ""), "[^A-Za-z0-9一-鿿]", "")
    rows = files.where(F.length(plain) >= min_chars).withColumn("stem", stem)
    is_part = F.col("stem").rlike(part)
    rows = rows.where(is_part | ~F.col("stem").rlike("^[0-9a-z]{20,}$"))
    doc = F.when(is_part, F.regexp_extract("stem", part, 3)).otherwise(F.col("stem"))
    start = F.when(is_part, F.regexp_extract("stem", part, 1).try_cast("long")).otherwise(F.lit(0))
    tasks = rows.groupBy("doc_group", doc.alias("raw_doc_id"), is_part.alias("parts")).agg(F.array_sort(F.collect_list(F.struct(start.alias("s"), "path"))).alias("p"))
    key = F.regexp_replace(F.trim("raw_doc_id"), r"[^0-9A-Za-z一-鿿._-]+", "_")
    tasks = tasks.withColumn("base", key).withColumn("n", F.row_number().over(Window.partitionBy("doc_group", "base").orderBy("raw_doc_id", "parts")))
    return tasks.select("doc_group", F.when(F.col("n") > 1, F.concat("base", F.lit("__"), F.col("n").cast("string"))).otherwise(F.col("base")).alias("doc_key"), F.when(F.col("parts"), "parts").otherwise("single").alias("kind"), F.transform("p", lambda x: x["path"]).alias("md_files"))


def discover_brand_tasks(files: DataFrame, root: str, include: list[str] | None = None, exclude: list[str] | None = None, limit: int = 0, min_chars: int = 50) -> DataFrame:
    """(brand, doc_key, kind, md_files): the documents of the brand folders below ``root``, by brand and key without case.

    Hidden folders are left out, and so are excluded ones and, if some are named, all
    that are not included; a limit above 0 takes the first so many documents.
    """
    scheme = r"^[A-Za-z][A-Za-z0-9+.-]*:/*"
    top = re.sub(scheme, "/", root.rstrip("/"))
    below = F.regexp_extract(F.regexp_replace("path", scheme, "/"), rf"^{re.escape(top)}/([^/]+)/", 1)
    rows = files.withColumn("doc_group", below).where((F.col("doc_group") != "") & ~F.col("doc_group").startswith("."))
    wanted, unwanted = ([n.strip() for n in names or [] if n.strip()] for names in (include, exclude))
    if wanted:
        rows = rows.where(F.col("doc_group").isin(wanted))
    if unwanted:
        rows = rows.where(~F.col("doc_group").isin(unwanted))
    found = discover_tasks(rows, min_chars).withColumnRenamed("doc_group", "brand")
    return found.orderBy(F.lower("brand"), F.lower("doc_key")).limit(limit) if limit > 0 else found


def brand_summary(tasks: DataFrame) -> DataFrame:
    """Documents of each brand by kind."""
    return tasks.groupBy("brand").agg(F.count_if(F.col("kind") == "parts").alias("part_groups"), F.count_if(F.col("kind") == "single").alias("single_files"), F.sum(F.size("md_files")).alias("md_files"))


def _there(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def reload_products(spark: SparkSession, stage_path: str, envelope_path: str) -> DataFrame:
    """Products of the stage table, if it is there, else of the envelopes, else none."""
    if _there(spark, stage_path):
        return spark.read.parquet(stage_path)
    if _there(spark, envelope_path):
        return read_envelopes(spark, envelope_path).select(*PRODUCT.fieldNames())
    return spark.createDataFrame([], PRODUCT)


def pages_from(spark: SparkSession, path: str) -> DataFrame:
    """Blocks or Markdown, whichever the path names."""
    return read_blocks_csv(spark, path) if path.endswith(".csv") else read_markdown(spark, path)


def stage(spark: SparkSession, path: str, compute, force: bool = False) -> DataFrame:
    """The table at ``path``; computed and written if it isn't there, or by force."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))
    if force or not there:
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
