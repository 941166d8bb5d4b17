"""Task messages, statuses and incremental indexing as Structured Streaming jobs.

Sources are folders of files: each new file is a delivery, checkpoints remember what
was consumed, and a sink is written by batch so that a repeated batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

MESSAGE = "struct<task_id:string,action:string,config_path:string,type:string>"


def messages(spark: SparkSession, folder: str, per_batch: int = 100) -> DataFrame:
    """A stream of task messages (JSON lines); broken ones are dropped. ``per_batch`` paces the consumer."""
    lines = spark.readStream.option("maxFilesPerTrigger", per_batch).text(folder)
    return lines.select(F.from_json("value", MESSAGE).alias("m")).select("m.*").where("task_id IS NOT NULL")


def next_status(current: str, event: str):
    """pending -> running -> completed or failed; other moves leave the status as it is."""
    c, e = F.col(current), F.col(event)
    return F.when(c.isNull() & (e == "created"), "pending").when((c == "pending") & (e == "started"), "running").when((c == "running") & e.isin("completed", "failed"), e).otherwise(c)


def latest(rows: DataFrame, key: str, at: str) -> DataFrame:
    """The last row of each key; of rows of one time the one whose other fields, in the order of the columns, are largest."""
    order = Window.partitionBy(key).orderBy(F.desc(at), *(F.desc(c) for c in rows.columns if c not in (key, at)))
    return rows.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def merge_latest(stored: DataFrame, changes: DataFrame, key: str, at: str) -> DataFrame:
    """Fields of changes over stored ones, the later row winning; null fields don't override."""
    both = stored.unionByName(changes, allowMissingColumns=True)
    fields = [c for c in both.columns if c not in (key, at)]
    return both.groupBy(key).agg(F.max(at).alias(at), *(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(at))).alias(c) for c in fields))


def latest_stream(events: DataFrame, key: str, at: str) -> DataFrame:
    """The running latest row of each key, for the update or complete mode."""
    fields = [c for c in events.columns if c != key]
    return events.groupBy(key).agg(F.max_by(F.struct(*fields), at).alias("_last")).select(key, "_last.*")


def first_sightings(events: DataFrame, key: str, at: str, delay: str = "1 hour") -> DataFrame:
    """The first event of each key; state is dropped once the watermark has passed it."""
    timed = events.withColumn(at, F.col(at).cast("timestamp"))
    return timed.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Consume what is there, batch by batch, and stop."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_every(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, hours: float = 6.0) -> StreamingQuery:
    """Consume what has come, batch by batch, every so many hours, until the query is stopped."""
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(processingTime=f"{round(hours * 3600)} seconds").start()


def keep_new(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """A batch handler that appends rows whose key the table at ``path`` lacks, one of each key: the smallest, field by field."""

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        target = f"{path}/batch={number}"
        rows = batch.groupBy(key).agg(F.min(F.struct(*batch.columns)).alias("_first")).select("_first.*")
        jvm = spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            stored = spark.read.schema(StructType([*batch.schema.fields, StructField("batch", LongType())])).parquet(path).where(F.col("batch") != number)
            rows = rows.join(stored.select(key), key, "left_anti").select(batch.columns)
        rows.write.mode("overwrite").parquet(target)

    return handle


def dispatch(actions: dict[str, Callable[[DataFrame], None]], unknown: Callable[[DataFrame], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A batch handler that gives each action its messages; those of no known action go to ``unknown``."""

    def handle(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            for name, act in actions.items():
                own = held.where(F.col("action") == name)
                if not own.isEmpty():
                    act(own)
            rest = held.where(~F.coalesce(F.col("action").isin(list(actions)), F.lit(False)))
            if unknown and not rest.isEmpty():
                unknown(rest)
        finally:
            held.unpersist()

    return handle


def connection_failures(tasks: DataFrame, errors: DataFrame) -> DataFrame:
    """Tasks that found nothing while their log has a connection error count as failed."""
    from lodestar.functions.text import connection_error

    bad = errors.where(connection_error("error")).select("task_id").distinct().withColumn("_bad", F.lit(True))
    empty = (F.coalesce("brands", F.lit(0)) == 0) & (F.coalesce("products", F.lit(0)) == 0)
    return tasks.join(bad, "task_id", "left").withColumn("status", F.when(empty & F.col("_bad"), "failed").otherwise(F.col("status"))).drop("_bad")
