"""Small helpers that several operators share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
_work_tables: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or (unset, as in tests) one made here."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="sitecensus-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage ends here, and a lost
    executor costs nothing that was computed before. ``drop_work_tables`` removes the tables."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _work_tables.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """df.checkpoint() in the shared folder; for small results, whose files Spark removes with the DataFrame."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def drop_work_tables() -> None:
    """Delete what ``written`` has left in the shared folder; call it when no result is needed any more."""
    while _work_tables:
        spark, path = _work_tables.pop()
        try:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001 - the session has ended
            return


atexit.register(drop_work_tables)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def spare_name(columns: list[str], wanted: str) -> str:
    """A column name that the caller's columns do not use (Spark compares names without case)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def power_of_two(n: float) -> int:
    return 1 << max(0, (max(1, int(-(-n // 1))) - 1).bit_length())


def bit_of(bitmap: Column, position: Column) -> Column:
    """Bit ``position`` (from 0) of a bitmap made by bitmap_construct_agg; null outside it."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (position % 8).cast("int")) == 1
