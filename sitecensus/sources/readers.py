"""Readers of domain lists, result files and run documents. All schemas are given; none is inferred."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import strip

SCAN_RESULT = (
    "domain string, dns_active boolean, http_active boolean, http_status int, final_url string, redirect_count int, redirect_chain array<string>, "
    "checked_at string, response_ms double, error string, attempts int"
)
RUN_STATE = (
    "machine string, status string, started_at string, updated_at string, total bigint, processed bigint, remaining bigint, active bigint, inactive bigint, errors bigint, "
    "ats_traceable bigint, has_email bigint, company_number bigint, careers_page bigint, platform_counts map<string,bigint>, primary_platform_counts map<string,bigint>, "
    "http_status_counts map<string,bigint>, last_domain string, rate_per_second double, last_batch_seconds double, last_batch_rate_per_second double, eta_seconds double, last_error string"
)
FETCH = "url string, status int, final_url string, body string, error string, via string, attempts array<struct<via:string,status:int,error:string>>"
REGISTRY_ENTRY = "key string, label string, mode string, host string, input string, results string, log string, stats string"
LONGEST_LINE = 1 << 20
LONGEST_BODY = 2_000_000


def capped_line() -> Column:
    """value; a line of 1 MiB or more is an error."""
    return F.when(F.octet_length("value") < LONGEST_LINE, F.col("value")).otherwise(F.raise_error(F.lit("a line is longer than 1 MiB")).cast("string"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value: the lines of text files; a line of 1 MiB or more is an error."""
    return spark.read.text(path).select(capped_line().alias("value"))


def argument_list(spark: SparkSession, urls: list[str]) -> DataFrame:
    """pos, url: URLs that were given one by one, in their order; blank ones do not count."""
    given = [u.strip() for u in urls if u.strip()]
    return spark.createDataFrame(list(enumerate(given)), "pos long, url string")


def domain_list(spark: SparkSession, path: str) -> DataFrame:
    """domain, pos: the trimmed lines that are not blank, numbered within (file, place in file) order from 0."""
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    read = spark.read.text(path).select(strip(capped_line()).alias("domain"), place.alias("place"))
    from ..operators.lists import numbered

    return numbered(read.where("domain <> ''"), "place").drop("place")


def _fields(schema: str) -> list[str]:
    return [f"{f.name} {f.dataType.simpleString()}" for f in StructType.fromDDL(schema)]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or glob) has files, in any store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def count_domains(spark: SparkSession, path: str) -> int:
    return lines(spark, path).where(strip(F.col("value")) != "").count()


def count_lines(spark: SparkSession, path: str) -> int:
    """All lines, blank ones too."""
    return lines(spark, path).agg(F.count("value")).first()[0]


def count_output(spark: SparkSession, path: str) -> int:
    """Lines that are not blank; 0 if the file is missing."""
    return count_domains(spark, path) if exists(spark, path) else 0


def scan_results(spark: SparkSession, path: str) -> DataFrame:
    """Strict: the first line that is not a result, or blank, ends the read with an error."""
    return decode_strict(lines(spark, path), SCAN_RESULT)


class BadLine(ValueError):
    """The first line of the first file, in the order of paths, that is no result."""

    def __init__(self, file: str, line: int, reason: str) -> None:
        super().__init__(f"line {line} of {file}: {reason}")
        self.file, self.line, self.reason = file, line, reason


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, start, seq: the lines of text files. seq grows by one a line within a split (file, start) of a file."""
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return spark.read.text(path).select("value", file.alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("seq"))


def line_faults(spark: SparkSession, path: str, schema: str = SCAN_RESULT, whole: Callable[[Column], Column] = lambda path: path) -> DataFrame:
    """file, lines, bad_lines, first_bad_line (from 1; null if none), reason: what a strict reader would stop at in each file.

    Lines stay where they are read: a split gives its number of lines and the place of its first bad one, and a file adds up
    its splits. A file without lines has no row. ``whole`` names the file that a path is a part of; parts are in the order of
    their paths."""
    item = F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    reason = (
        F.when(F.octet_length("value") >= LONGEST_LINE, F.lit("longer than 1 MiB"))
        .when(strip(F.col("value")) == "", F.lit("blank"))
        .when(item["_bad"].isNotNull(), F.lit("not a result"))
    )
    judged = placed_lines(spark, path).select("file", "start", "seq", reason.alias("reason"))
    bad = F.col("reason").isNotNull()
    splits = judged.groupBy(F.col("file").alias("path"), "start").agg(
        F.count("*").alias("lines"), F.count("reason").alias("bad_lines"), F.min("seq").alias("low"), F.min(F.when(bad, F.struct("seq", "reason"))).alias("first")
    )
    splits = splits.withColumn("file", whole(F.col("path")))
    earlier = Window.partitionBy("file").orderBy("path", "start").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.withColumn("before", F.coalesce(F.sum("lines").over(earlier), F.lit(0)))
    place = F.when(F.col("first").isNotNull(), F.struct((F.col("before") + F.col("first.seq") - F.col("low") + 1).alias("line"), F.col("first.reason").alias("reason")))
    files = before.groupBy("file").agg(F.sum("lines").alias("lines"), F.sum("bad_lines").alias("bad_lines"), F.min(place).alias("first"))
    return files.select("file", "lines", "bad_lines", F.col("first.line").alias("first_bad_line"), F.col("first.reason").alias("reason"))


def ordered_results(spark: SparkSession, path: str) -> DataFrame:
    """pos and the fields of the results, numbered (from 0) by path and place in the file. No file is an error; a bad line
    is a ``BadLine`` that names the first one, whichever task meets one first."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no result files match {path}")
    fault = line_faults(spark, path).where("bad_lines > 0").orderBy("file").first()
    if fault:
        raise BadLine(fault.file, fault.first_bad_line, fault.reason)
    from ..operators.lists import numbered

    rows = numbered(placed_lines(spark, path).select("value", F.struct("file", "start", "seq").alias("place")), "place")
    return rows.select("pos", F.from_json("value", SCAN_RESULT, {"mode": "FAILFAST"}).alias("item")).select("pos", "item.*")


def decode_strict(values: DataFrame, schema: str = SCAN_RESULT) -> DataFrame:
    """values: value. Absent flags and counts are false and 0, as a missing key is."""
    value = F.when(strip(F.col("value")) == "", F.raise_error(F.lit("blank line in results")).cast("string")).otherwise(F.col("value"))
    item = F.from_json(value, schema, {"mode": "FAILFAST"})
    return values.select(item.alias("item")).select("item.*")


def decode_permissive(values: DataFrame, schema: str = SCAN_RESULT) -> DataFrame:
    """values: value. The fields, and is_bad; blank lines are passed over, bad ones are rows with is_bad."""
    item = F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    read = values.where(strip(F.col("value")) != "").select(item.alias("item"))
    return read.select("item.*").withColumn("is_bad", F.col("_bad").isNotNull()).drop("_bad")


def decode_tolerant(values: DataFrame, schema: str = SCAN_RESULT) -> DataFrame:
    """values: value. The fields of good lines; bad and blank ones are dropped."""
    return decode_permissive(values, schema).where("not is_bad").drop("is_bad")


def completed_domains(spark: SparkSession, path: str) -> DataFrame:
    """domain: those that a result file has, once each; none if there is no file."""
    if not exists(spark, path):
        return spark.createDataFrame([], "domain string")
    return scan_results(spark, path).select("domain").distinct()


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The rows of a JSON document, or None if there is none or it cannot be read. The document is read and decoded here:
    it is a small one."""
    if not exists(spark, path):
        return None
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("value"))
    read, bad = text.agg(F.count("*"), F.count_if(F.try_parse_json("value").isNull())).first()
    if bad or not read:
        return None
    one = F.from_json("value", schema + ", _bad string", {"columnNameOfCorruptRecord": "_bad"})
    many = F.from_json("value", f"array<struct<{', '.join(x.strip().replace(' ', ':', 1) for x in _fields(schema))}>>")
    rows = text.select(F.explode(F.when(F.col("value").startswith("["), many).otherwise(F.array(one.dropFields("_bad")))).alias("e"), one["_bad"].alias("_bad"))
    rows = rows.where("e is not null")
    broken = rows.where("_bad is not null and not startswith(_bad, '[')").limit(1).count()
    return None if broken else rows.select("e.*")


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Entries with all of key, label, host, input, results, log and stats; mode is auto unless given. The document is an
    array, or an object with the array as ``servers``."""
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("value"))
    whole = F.from_json("value", f"array<struct<{', '.join(x.replace(' ', ':', 1) for x in REGISTRY_ENTRY.split(', '))}>>")
    nested = F.from_json(F.get_json_object("value", "$.servers"), f"array<struct<{', '.join(x.replace(' ', ':', 1) for x in REGISTRY_ENTRY.split(', '))}>>")
    entries = text.select(F.explode(F.when(F.col("value").startswith("["), whole).otherwise(nested)).alias("e")).select("e.*")
    return valid_entries(entries)


def valid_entries(entries: DataFrame) -> DataFrame:
    needed = [c for c in ("key", "label", "host", "input", "results", "log", "stats")]
    good = " and ".join(f"trim(coalesce({c}, '')) <> ''" for c in needed)
    return entries.where(good).withColumn("mode", F.coalesce(F.nullif(F.trim("mode"), F.lit("")), F.lit("auto")))


def fetches(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages; bodies are cut at 2,000,000 bytes."""
    return capped(spark.read.schema(FETCH).json(path))


def capped(fetched: DataFrame) -> DataFrame:
    body = F.when(F.octet_length("body") > LONGEST_BODY, F.make_valid_utf8(F.substring(F.encode("body", "UTF-8"), 1, LONGEST_BODY).cast("string"))).otherwise(F.col("body"))
    return fetched.withColumn("body", body)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256 of whole files."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def change_signatures(spark: SparkSession, path: str) -> DataFrame:
    """path, size, modified: equal signatures need no new reading."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
