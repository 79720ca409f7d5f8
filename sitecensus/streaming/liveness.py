"""Running counters over a growing stream of scan results."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.results import truthy
from ..sources.readers import SCAN_RESULT, decode_tolerant
from ..sources.writers import shared_dir, write_document


def result_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Result files of a folder as they appear; bad lines are dropped. Files are to be published whole, by renaming."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return decode_tolerant(reader.load(path), SCAN_RESULT)


def counters(results: DataFrame) -> DataFrame:
    """status (text, none without one), processed, active, errors: for a stream or a table alike."""
    flag = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    status = F.coalesce(F.col("http_status").cast("string"), F.lit("none"))
    return results.groupBy(status.alias("status")).agg(F.count("*").alias("processed"), flag(F.col("http_active")).alias("active"), flag(truthy(F.col("error"))).alias("errors"))


def windowed_counters(results: DataFrame, width: str = "10 minutes", lateness: str = "30 minutes") -> DataFrame:
    """The counters by event time; rows later than ``lateness`` are dropped, and closed windows leave the state."""
    timed = results.withColumn("at", F.to_timestamp("checked_at")).withWatermark("at", lateness)
    return timed.groupBy(F.window("at", width)).agg(F.count("*").alias("processed"), F.count_if(F.coalesce("http_active", F.lit(False))).alias("active"))


def state_of(counted: DataFrame, total: int) -> dict:
    """The run state of the counters' rows (one a status: a small table)."""
    rows = counted.collect()
    done = sum(r.processed for r in rows)
    return {
        "total": total,
        "processed": done,
        "remaining": max(0, total - done),
        "active": sum(r.active for r in rows),
        "inactive": done - sum(r.active for r in rows),
        "errors": sum(r.errors for r in rows),
        "http_status_counts": {r.status: r.processed for r in sorted(rows, key=lambda r: r.status)},
        "status": "complete" if done >= total else "running",
    }


def watch(spark: SparkSession, path: str, state_path: str, checkpoint: str, total: int, seconds: float | None = None) -> StreamingQuery:
    """Keep the state document up to date: every so many seconds, or (None) once over what is there. The checkpoint holds
    the place in the input, so a restart goes on; a run with another total is another run and takes a new checkpoint."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        write_document(spark, state_path, state_of(batch, total) | {"batch": batch_id})

    writer = counters(result_stream(spark, path)).writeStream.outputMode("complete").foreachBatch(publish).option("checkpointLocation", f"{checkpoint}/{total}")
    return (writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{max(0.5, seconds)} seconds")).start()


def counted_by_stream(results: DataFrame) -> DataFrame:
    """The counters of a stream once it has read all that is there, as a table in the shared folder."""
    spark = results.sparkSession
    folder = f"{shared_dir(spark)}/counters-{uuid.uuid4().hex}"

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/table")

    query = counters(results).writeStream.outputMode("complete").foreachBatch(replace).option("checkpointLocation", f"{folder}/checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/table")


def append_records(records: DataFrame, path: str, checkpoint: str, tries: int = 3) -> StreamingQuery:
    """Append a stream's rows to a table of Parquet folders, one a batch: a batch that is tried again, by us (up to so many
    times) or after a restart, replaces its own folder, so every row is there once. A batch that keeps failing ends the query
    with its error, and the folder ``blocked`` names it; a restart goes on with that batch."""
    spark = records.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(1, tries + 1):
            try:
                batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
                return
            except Exception as error:
                if attempt == tries:
                    write_document(spark, f"{checkpoint}/blocked.json", {"status": "blocked", "batch": batch_id, "last_error": str(error)[:500]})
                    raise
                time.sleep(min(30, 2 ** (attempt - 1)))

    return records.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start()
