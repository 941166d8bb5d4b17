"""Writing results: record and envelope files, logs, page texts, idempotent inserts, and checks before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import matching
from lodestar.operators.knowledge import broken_keys


def write_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def without_lineage(df: DataFrame) -> DataFrame:
    """Without the columns that only tell where a record came from."""
    return df.drop(*(c for c in df.columns if c.startswith("_")))


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def alias_log(groups: DataFrame) -> DataFrame:
    """(canonical, aliases, n_aliases) of groups with an alias."""
    found = groups.where("brand <> canonical").groupBy("canonical").agg(F.array_sort(F.collect_list("brand")).alias("aliases"))
    return found.withColumn("n_aliases", F.size("aliases"))


def write_pages(pages: DataFrame, path: str, label: str = "doc_label") -> None:
    """One folder for each document, one text row for each page, and an index beside."""
    pages.select(label, "text").write.mode("overwrite").partitionBy(label).text(f"{path}/pages")
    pages.drop("text").write.mode("overwrite").csv(f"{path}/index", header=True)


def result_counts(results: DataFrame) -> DataFrame:
    return results.agg(F.count("*").alias("total"), F.count_if(F.size("content") > 0).alias("successful"))


def crawl_rows(results: DataFrame) -> DataFrame:
    """Crawled items (seq, url, titles, content as lists) as stored rows."""
    return results.select("seq", "url", F.coalesce(F.get("titles", 0), F.lit("")).alias("title"), F.array_join(F.coalesce("content", F.array().cast("array<string>")), "\n").alias("content"))


def insert_new(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Append the rows whose URL the table at ``path`` lacks, the first of each URL."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        rows = matching.new_urls(rows, spark.read.parquet(path))
    else:
        rows = matching.new_urls(rows, rows.limit(0))
    rows.write.mode("append").parquet(path)


def create_table(spark: SparkSession, name: str, schema: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet")


def assert_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """The frame itself, if no key occurs twice."""
    bad = broken_keys(df, key).take(3)
    if bad:
        raise ValueError(f"{key} occurs more than once: {[tuple(r) for r in bad]}")
    return df


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    assert_unique(nodes, ["label", "key"]).write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")
