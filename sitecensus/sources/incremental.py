"""Counters over many files of which few change: kept partial counts a file, and new reading of changed files only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import exists
from .versions import Store
from .writers import staged

SIGNATURE = "path string, size bigint, modified timestamp"


def signatures(spark: SparkSession, path: str) -> DataFrame:
    """path, size and time of each file's last change, of a folder or pattern; the files are not read."""
    if not exists(spark, path):
        return spark.createDataFrame([], SIGNATURE)
    m = F.col("_metadata")
    return spark.read.format("binaryFile").load(path).select(m["file_path"].alias("path"), m["file_size"].alias("size"), m["file_modification_time"].alias("modified"))


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """path and kind (new, changed, same, gone) of every file of two snapshots of signatures."""
    both = old.select("path", F.struct("size", "modified").alias("was")).join(new.select("path", F.struct("size", "modified").alias("now")), "path", "full")
    kind = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "gone").when(F.col("was") == F.col("now"), "same").otherwise("changed")
    return both.select("path", kind.alias("kind"))


def refresh(spark: SparkSession, path: str, store: Store, count: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, dict[str, int]]:
    """The partial counts of all files of path (a folder or pattern), and how many files were new, changed, same and gone.

    count: from the lines (path, value) of text files to partial counts that keep the column path; only new and changed
    files are read. Signatures are taken before files are read: one that is changed meanwhile is read again
    next time. Signatures and counts are one commit of the store, so a lost run or race leaves them in step. The paths of
    changed files go through the driver, as those of all files do when a folder is listed."""
    version, kept = store.snapshot()
    new = staged(signatures(spark, path), "signatures")
    told = staged(changes(kept.get("signatures", spark.createDataFrame([], SIGNATURE)), new), "changes")
    kinds = {"new": 0, "changed": 0, "same": 0, "gone": 0} | {r.kind: r.n for r in told.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    if "counts" in kept and kinds["new"] + kinds["changed"] + kinds["gone"] == 0:
        return kept["counts"], kinds
    read = [r.path for r in told.where("kind in ('new', 'changed')").collect()]
    lines = spark.read.text(read).select(F.col("_metadata.file_path").alias("path"), "value") if read else spark.createDataFrame([], "path string, value string")
    counts = count(lines)
    if "counts" in kept:
        counts = counts.unionByName(kept["counts"].join(told.where("kind = 'same'").select("path"), "path", "left_semi"))
    store.commit({"signatures": new, "counts": counts}, version)
    return store.snapshot()[1]["counts"], kinds
