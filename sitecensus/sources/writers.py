"""Sinks: part files, sorted lists, JSON lines and documents."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or (unset, on one machine) one made for this session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="sitecensus-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_staged: list[tuple[SparkSession, str]] = []
_tables: list[tuple[SparkSession, str]] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder, which ``drop_staged`` removes."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _staged.append((spark, path))
    return path


def staged(rows: DataFrame, label: str) -> DataFrame:
    """rows as a Parquet table in the shared folder, read back: every use sees the same ones, and a lost executor costs
    nothing that was computed before. ``drop_staged`` removes the tables."""
    path = fresh_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def bucketed(rows: DataFrame, label: str, by: str, buckets: int | None = None) -> DataFrame:
    """As ``staged``, in sorted buckets of a column: joins on it read the rows where they lie instead of moving them."""
    spark = rows.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one task a bucket, so one file a bucket
    whole = rows.repartition(count, by)
    whole.write.format("parquet").bucketBy(count, by).sortBy(by).option("path", fresh_path(spark, label)).saveAsTable(name)
    _tables.append((spark, name))
    return spark.table(name)


def drop_staged() -> None:
    """Delete the tables of ``staged`` and ``bucketed``; call it when no result that reads them is needed any more."""
    while _tables:
        spark, name = _tables.pop()
        if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    while _staged:
        spark, path = _staged.pop()
        if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
            continue
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_parts(parted: DataFrame, path: str, prefix: str, parts: int) -> None:
    """One folder of text a part (part, pos, domain), in the order of pos; parts without rows are empty folders.

    One job writes all rows, each part in one task, in order; the folders are then renamed."""
    spark = parted.sparkSession
    fresh = f"{path}/_{uuid.uuid4().hex}"
    name = F.concat(F.lit(f"{prefix}-"), (F.col("part") + 1).cast("string"), F.lit(f"-of-{parts}.txt"))
    rows = parted.where(F.col("part").between(0, parts - 1)).select(name.alias("name"), "pos", F.col("domain").cast("string").alias("value"))
    ordered = rows.repartition(max(1, parts), "name").sortWithinPartitions("name", "pos").drop("pos")
    ordered.write.option("maxRecordsPerFile", 0).partitionBy("name").text(fresh)
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for part in range(parts):
        made, done = at(f"{fresh}/name={prefix}-{part + 1}-of-{parts}.txt"), at(f"{path}/{prefix}-{part + 1}-of-{parts}.txt")
        fs.delete(done, True)
        if not fs.exists(made):
            fs.mkdirs(done)
        elif not fs.rename(made, done):
            raise OSError(f"cannot make {done}")
    fs.delete(at(fresh), True)


def write_exact_parts(parted: DataFrame, path: str, prefix: str, sizes: list[int]) -> None:
    """As ``write_parts``; the parts must have the given sizes."""
    have = {r.part: r.n for r in parted.groupBy("part").agg(F.count("*").alias("n")).collect()}
    if [have.get(i, 0) for i in range(len(sizes))] != sizes or set(have) - set(range(len(sizes))):
        raise ValueError(f"part sizes are {have}, not {sizes}")
    write_parts(parted, path, prefix, len(sizes))


def write_unique_sorted(rows: DataFrame, column: str, path: str) -> None:
    """Distinct values in byte order: the files' names and their lines follow it."""
    rows.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct().orderBy("value").write.mode("overwrite").text(path)


def write_results(rows: DataFrame, path: str, resume: bool) -> None:
    """JSON lines; null fields are written, but for an absent redirect chain."""
    whole = F.struct(*(F.col(c) for c in rows.columns))
    short = F.struct(*(F.col(c) for c in rows.columns if c != "redirect_chain"))
    keep = {"ignoreNullFields": "false"}
    line = F.to_json(whole, keep)
    if "redirect_chain" in rows.columns:
        line = F.when(F.size("redirect_chain") > 0, line).otherwise(F.to_json(short, keep))
    rows.select(line.alias("value")).write.mode("append" if resume else "overwrite").text(path)


def write_document(spark: SparkSession, path: str, value: dict) -> None:
    """One JSON document, indented by two; written beside its place and renamed into it."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    final, fresh = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    fs = final.getFileSystem(conf)
    out = fs.create(fresh, True)
    out.write(bytearray(json.dumps(value, indent=2, ensure_ascii=False).encode()))
    out.close()
    fs.delete(final, False)
    if not fs.rename(fresh, final):
        raise OSError(f"cannot replace {path}")


def write_records(records: DataFrame, path: str) -> None:
    """Extraction records as JSON lines, in the order of pos."""
    fields = [c for c in records.columns if c != "pos"]
    records.orderBy("pos").select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)
