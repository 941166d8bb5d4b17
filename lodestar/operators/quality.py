"""Reports: overflow of calls by schema, batch summaries, recommended limits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import overflow_error

TOKENS = ["prompt_tokens", "completion_tokens", "total_tokens"]


def token_count(text: Column, name: str) -> Column:
    """The number behind ``name=`` or ``name:``, null if there is none."""
    return F.nullif(F.regexp_extract(text, rf"(?i){name}\D{{0,4}}(\d+)", 1), F.lit("")).try_cast("long")


def split_factor(targets: dict[str, int]) -> Column:
    """Into how many parts a call should have been split, by each kind of token."""
    parts = [F.coalesce(F.ceil(F.col(c) / max(1, target)), F.lit(1)) for c, target in targets.items()]
    return F.greatest(F.lit(1), *parts).cast("int")


def overflow_report(calls: DataFrame, targets: dict[str, int]) -> DataFrame:
    """One row for each schema: calls, hosts, largest, p95 and mean of each kind of token, the largest split factor.

    The 95th percentile is the value at its rounded rank; values are counted first, and
    found through their counts by buckets, so no schema's values are gathered.  The
    report lists the hosts of a schema, so these have to fit a row.
    """
    rows = calls.withColumns({"schema": F.coalesce(F.nullif(F.trim("schema"), F.lit("")), F.lit("unknown_schema")), "split_factor": split_factor(targets)})
    out = rows.groupBy("schema").agg(
        F.count("*").alias("calls"),
        F.sort_array(F.collect_set(F.nullif(F.trim("host"), F.lit("")))).alias("hosts"),
        *(F.coalesce(F.max(c), F.lit(0)).alias(f"{c}_max") for c in targets),
        *(F.round(F.coalesce(F.avg(c), F.lit(0.0)), 2).alias(f"{c}_avg") for c in targets),
        F.max("split_factor").alias("suggested_split_factor"),
    )
    for c in targets:
        out = out.join(_ranked(rows, c, 0.95), "schema", "left").withColumn(f"{c}_p95", F.coalesce(f"{c}_p95", F.lit(0).cast("long")))
    return out


def _ranked(rows: DataFrame, c: str, share: float, width: int = 1024) -> DataFrame:
    """(schema, <c>_p95) from the counts of the distinct values.

    Counts of ranges of ``width`` values say in which range the rank is, and only that
    range's values are counted on.  Ranges are ranked per schema, over running sums.
    """
    counts = rows.where(F.col(c).isNotNull()).groupBy("schema", F.col(c).cast("long").alias("v")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("range", F.floor(F.col("v") / width))
    upto = Window.partitionBy("schema").orderBy("range")
    ranges = counts.groupBy("schema", "range").agg(F.sum("n").alias("n")).withColumn("seen", F.sum("n").over(upto))
    totals = ranges.groupBy("schema").agg(F.sum("n").alias("total"))
    rank = F.bround((F.col("total") - 1) * F.lit(share)).cast("long")
    hit = ranges.join(totals, "schema").withColumn("rank", rank).where((F.col("seen") > F.col("rank")) & (F.col("seen") - F.col("n") <= F.col("rank")))
    inside = counts.join(hit.select("schema", "range", (F.col("rank") - F.col("seen") + F.col("n")).alias("rank")), ["schema", "range"])
    inside = inside.withColumn("seen", F.sum("n").over(Window.partitionBy("schema").orderBy("v"))).where(F.col("seen") > F.col("rank"))
    return inside.groupBy("schema").agg(F.min("v").alias(f"{c}_p95"))


def overflow_calls(log: DataFrame) -> DataFrame:
    """Records of a retry log that failed for size, with the token counts that their text tells."""
    text = F.concat_ws(" | ", "error", "error_type", "error_code", F.col("diagnostics").cast("string"))
    rows = log.where(overflow_error("error", "error_type", "error_code"))
    return rows.withColumns({c: token_count(text, c) for c in TOKENS})


def recommended_limits(report: DataFrame, base_chars: int = 8000, base_items: int = 50, text_schemas: list[str] | None = None) -> DataFrame:
    """One row: lower limits for calls, from the largest split factor of the text schemas and of the others."""
    is_text = F.col("schema").isin(text_schemas or ["series_schema", "model_schema", "product_schema"])
    factors = report.agg(F.coalesce(F.max(F.when(is_text, F.col("suggested_split_factor"))), F.lit(1)).alias("text_factor"), F.coalesce(F.max(F.when(~is_text, F.col("suggested_split_factor"))), F.lit(1)).alias("review_factor"))
    return factors.select("text_factor", "review_factor", F.greatest(F.lit(1200), F.floor(base_chars / F.col("text_factor"))).cast("int").alias("max_chars"), F.greatest(F.lit(10), F.floor(base_items / F.col("review_factor"))).cast("int").alias("max_items"))


def batch_summary(tasks: DataFrame) -> DataFrame:
    """Documents, products, failures and skips by brand."""
    return tasks.groupBy("brand").agg(
        F.count("*").alias("documents"), F.coalesce(F.sum("products"), F.lit(0)).alias("products"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "skipped").alias("skipped")
    )


def keep_frequent_pages(brands: DataFrame, ratio: float = 0.15, fallback: int = 3, cap: int = 12) -> DataFrame:
    """Brands on at least max(1, floor(ratio * most pages)) pages and plausible; the top few if none is; at most ``cap``."""
    from lodestar.functions.text import plausible_brand

    order = Window.partitionBy("doc").orderBy(F.desc(F.size("pages")), "seq")
    whole = Window.partitionBy("doc")
    rows = brands.withColumns({"rank": F.row_number().over(order), "most": F.max(F.size("pages")).over(whole)})
    good = plausible_brand("name") & (F.size("pages") >= F.greatest(F.lit(1), F.floor(F.col("most") * ratio)))
    rows = rows.withColumn("good", good).withColumn("any_good", F.max("good").over(whole))
    rows = rows.where(F.when(F.col("any_good"), F.col("good")).otherwise(F.col("rank") <= fallback))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cap).drop("most", "good", "any_good", "rank")


def all_true(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))
