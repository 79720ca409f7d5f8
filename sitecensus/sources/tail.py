"""Lines of growing text files, as a stream: ``spark.readStream.format("tail").option("path", glob).load()``.

The offset of a file is the byte after the last whole line; a last line without its end is held back until it has one. A
file that has become shorter than its offset was begun anew: it is read from its start, and its rows of that
batch come with ``restarted``, so that a consumer forgets what it had of it (one such row has no value, for an empty file).

Rows: file, at (the line's first byte), restarted, value. Files are reached through pyarrow's file systems (local paths,
file:, hdfs:, s3:, gs: URIs); a file's new bytes are read in ranges of ``range_mb``, each a partition of its own."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .readers import LONGEST_LINE, SCAN_RESULT

LINE = "file string, at bigint, restarted boolean, value string"
BLOCK = 1 << 20


@dataclass
class Range(InputPartition):
    file: str
    start: int
    end: int
    restarted: bool


def _opened(path: str) -> tuple[pa_fs.FileSystem, str]:
    return pa_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa_fs.LocalFileSystem(), path)


def sizes(path: str) -> dict[str, int]:
    """The files that a path names (its parts may be patterns), and their bytes."""
    system, at = _opened(path)
    parts = at.split("/")
    plain = next((i for i, part in enumerate(parts) if any(c in part for c in "*?[")), len(parts))
    if plain == len(parts):
        return {at: info.size for info in [system.get_file_info(at)] if info.type == pa_fs.FileType.File}
    folders = ["/".join(parts[:plain]) or "/"]
    for depth in range(plain, len(parts)):
        found = [x for folder in folders for x in system.get_file_info(pa_fs.FileSelector(folder, allow_not_found=True)) if fnmatch(x.base_name, parts[depth])]
        folders = [x.path for x in found if x.type == pa_fs.FileType.Directory]
    return {x.path: x.size for x in found if x.type == pa_fs.FileType.File}


def line_end(file: pa.NativeFile, size: int) -> int:
    """The byte after the last line end before ``size``."""
    end = size
    while end > 0:
        begin = max(0, end - BLOCK)
        file.seek(begin)
        found = file.read(end - begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        end = begin
    return 0


class TailReader(DataSourceStreamReader):
    def __init__(self, path: str, range_bytes: int) -> None:
        self.path, self.range_bytes = path, range_bytes

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, _ = _opened(self.path)
        ends = {}
        for name, size in sizes(self.path).items():
            with system.open_input_file(name) as file:
                ends[name] = line_end(file, size)
        return dict(sorted(ends.items()))

    def partitions(self, start: dict, end: dict) -> list[Range]:
        """Ranges of the files' new bytes. A file that is gone keeps what was read of it."""
        out = []
        for name, upto in end.items():
            done = start.get(name, 0)
            restarted = upto < done
            at = 0 if restarted else done
            if restarted:
                out.append(Range(name, -1, -1, True))
            out += [Range(name, x, min(x + self.range_bytes, upto), restarted) for x in range(at, upto, self.range_bytes)]
        return out

    def read(self, partition: Range) -> Iterator[tuple]:
        """The lines that begin in the range; the last of them may end beyond it. A line that begins at ``start`` counts,
        and one before it that reaches in belongs to the range before."""
        if partition.start < 0:
            yield partition.file, -1, True, None
            return
        system, _ = _opened(self.path)
        with system.open_input_file(partition.file) as file:
            at = partition.start
            if at:
                file.seek(at - 1)
                at += _skipped(file)
            file.seek(at)
            rest, begin = b"", at
            while begin < partition.end:
                block = file.read(BLOCK)
                if not block:
                    return
                *lines, rest = (rest + block).split(b"\n")
                for line in lines:
                    if begin >= partition.end:
                        return
                    yield partition.file, begin, partition.restarted, line.decode("utf-8", "replace")
                    begin += len(line) + 1
                if len(rest) >= LONGEST_LINE:
                    raise ValueError(f"a line of {partition.file} is longer than 1 MiB")


def _skipped(file: pa.NativeFile) -> int:
    """Bytes from the one after the file's place up to the next line's first."""
    first = file.read(1)
    if first == b"\n":
        return 0
    passed = 0
    while block := file.read(BLOCK):
        found = block.find(b"\n")
        if found >= 0:
            return passed + found + 1
        passed += len(block)
    return passed


class Tail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return LINE

    def streamReader(self, schema: object) -> TailReader:
        return TailReader(self.options["path"], int(float(self.options.get("range_mb", "32")) * (1 << 20)))


def tail(spark: SparkSession, path: str, range_mb: float = 32) -> DataFrame:
    """The stream of a path's lines (LINE)."""
    spark.dataSource.register(Tail)
    return spark.readStream.format("tail").option("path", path).option("range_mb", str(range_mb)).load()


COUNTS = ["processed", "active", "errors"]


def line_counters(lines: DataFrame) -> DataFrame:
    """lines: LINE. file, restarted, status (text, none without one), and the COUNTS of good result lines. A batch's lines
    of a restarted file are all new ones, and its marker row is a row without counts."""
    marks = lines.where("value is null").select("file", "restarted", F.lit(None).cast("string").alias("status"), *(F.lit(0).cast("long").alias(c) for c in COUNTS))
    good = result_lines(lines.where("value is not null"))
    flag = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    status = F.coalesce(F.col("http_status").cast("string"), F.lit("none"))
    error = F.coalesce(F.length("error") > 0, F.lit(False))
    return good.groupBy("file", "restarted", status.alias("status")).agg(F.count("*").alias("processed"), flag(F.col("http_active")).alias("active"), F.count_if(error).alias("errors")).unionByName(marks)


def result_lines(lines: DataFrame) -> DataFrame:
    """file, restarted and the fields of the lines that are results; others are dropped."""
    keyed = lines.select("file", "restarted", "value")
    item = F.from_json("value", SCAN_RESULT + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    read = keyed.where(F.trim("value") != "").select("file", "restarted", item.alias("item"))
    return read.where("item._bad is null").select("file", "restarted", "item.*").drop("_bad")


def added(kept: DataFrame, batch: DataFrame) -> DataFrame:
    """The kept counts (file, status, COUNTS), without those of restarted files, and the batch's added (small tables)."""
    again = batch.where("restarted").select("file").distinct()
    rows = kept.join(F.broadcast(again), "file", "left_anti").unionByName(batch.where("status is not null").drop("restarted"))
    return rows.groupBy("file", "status").agg(*(F.sum(c).alias(c) for c in COUNTS))


def follow(spark: SparkSession, path: str, state: str, checkpoint: str, range_mb: float = 32) -> DataFrame:
    """Read what is new of a path's files, and return the counters of each file and status so far.

    The counters of batch n are a table ``state/batch=n`` made of those of n - 1 and the batch's lines; a batch that
    is tried again makes the same table again."""
    empty = "file string, status string, processed bigint, active bigint, errors bigint"

    def count(batch: DataFrame, batch_id: int) -> None:
        kept = spark.read.schema(empty).parquet(f"{state}/batch={batch_id - 1}") if batch_id else spark.createDataFrame([], empty)
        added(kept, line_counters(batch)).coalesce(1).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    query = tail(spark, path, range_mb).writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return newest(spark, state, empty)


def newest(spark: SparkSession, state: str, schema: str) -> DataFrame:
    """The table of the largest batch number; a folder's name tells it, as a table may have no rows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/batch=*")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    numbers = [int(x.getPath().getName().split("=")[1]) for x in found or []]
    return spark.read.schema(schema).parquet(f"{state}/batch={max(numbers)}") if numbers else spark.createDataFrame([], schema)
