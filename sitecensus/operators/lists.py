"""Work lists: numbering, splitting, resuming and queues. Nothing is ordered in one task."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.writers import staged


SEGMENTS = 64


def key_ranges(rows: DataFrame, by: str, range_rows: int) -> Column:
    """A number for each value of an integer column, in its order, that about ``range_rows`` rows of neighbouring values
    share: the column's quantiles cut it into ``SEGMENTS``, and each of those is cut evenly. Nulls have none."""
    points = [i / SEGMENTS for i in range(SEGMENTS + 1)]
    n, cuts = rows.agg(F.count(by), F.percentile_approx(F.col(by).cast("long"), points, 10_000)).first()
    cuts = sorted(set(cuts or [0]))
    per = max(1, -(-n // (SEGMENTS * range_rows)))
    low = cuts[:-1] or cuts
    width = [max(1.0, (b - a) / per) for a, b in zip(low, [*cuts[1:], low[-1]], strict=False)]
    array = lambda values: F.array(*map(F.lit, values))
    segment = F.size(F.filter(array([F.lit(c).cast("long") for c in low[1:]]).cast("array<bigint>"), lambda c: c <= F.col(by)))
    offset = (F.col(by).cast("double") - F.element_at(array(map(float, low)), segment + 1)) / F.element_at(array(width), segment + 1)
    return F.when(F.col(by).isNotNull(), segment.cast("long") * (per + 1) + F.least(F.floor(offset), F.lit(per)))


def rows_before(counts: DataFrame, part: str, n: str, name: str, *groups: str) -> DataFrame:
    """counts (groups, part, n) with the sum of n over the group's smaller parts. Sums are made in two steps, of 1024 parts
    and of those, so no task has to see all of them."""
    large = f"{part}_large"
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sum_of = lambda c, window: F.coalesce(F.sum(c).over(window), F.lit(0))
    own = counts.withColumn(large, F.shiftright(F.col(part).cast("long"), 10))
    upper = own.groupBy(*groups, large).agg(F.sum(n).alias("sum_"))
    keys = [F.col(g).alias(f"upper_{i}") for i, g in enumerate((*groups, large))]
    upper = upper.select(*keys, sum_of("sum_", before(*groups).orderBy(large)).alias("above_"))
    same = [F.col(g) == F.col(f"upper_{i}") for i, g in enumerate((*groups, large))]
    joined = own.join(upper, same).withColumn(name, F.col("above_") + sum_of(n, before(*groups, large).orderBy(part)))
    return joined.select(*counts.columns, name)


def numbered(rows: DataFrame, by: str, name: str = "pos", range_rows: int = 50_000) -> DataFrame:
    """rows with their number (from 0) in the order of ``by``.

    Rows are cut into key ranges of about as many rows; the ranges' counts (a row a range) are added up, and rows are
    numbered within their range. An integer key is cut by quantiles, any other by a sorted table in the shared folder."""
    if dict(rows.dtypes)[by] in ("int", "bigint", "smallint", "tinyint"):
        ranged = rows.withColumn("range_", F.coalesce(key_ranges(rows, by, range_rows), F.lit(-(1 << 40))))
    else:
        ranged = staged(rows.repartitionByRange(by).withColumn("range_", F.spark_partition_id().cast("long")), "numbered")
    within = Window.partitionBy("range_").orderBy(by)
    counts = rows_before(ranged.groupBy("range_").agg(F.count("*").alias("n_")), "range_", "n_", "before_").drop("n_")
    return ranged.withColumn("row_", F.row_number().over(within) - 1).join(counts, "range_").withColumn(name, F.col("row_") + F.col("before_")).drop("range_", "row_", "before_")


def contiguous_part(pos: Column, total: int, parts: int) -> Column:
    """ceil(total / parts) rows a part; the last parts may be empty."""
    if parts < 1:
        raise ValueError("parts must be at least 1")
    size = max(1, -(-total // parts))
    return F.least(F.floor(pos / size), F.lit(parts - 1)).cast("int")


def balanced_part(pos: Column, total: int, parts: int) -> Column:
    """As ntile: the first total mod parts get one row more."""
    if parts < 1:
        raise ValueError("parts must be at least 1")
    size, more = divmod(total, parts)
    head = more * (size + 1)
    return F.when(pos < head, F.floor(pos / (size + 1))).otherwise(more + F.floor((pos - head) / max(size, 1))).cast("int")


def zipped(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of equal pos side by side. A pos that only one side has is an error, as unequal counts are."""
    both = left.withColumn("in_left", F.lit(True)).join(right.withColumn("in_right", F.lit(True)), "pos", "full")
    pos = F.when(F.col("in_left") & F.col("in_right"), F.col("pos")).otherwise(F.raise_error(F.lit("the lists differ in length")).cast("long"))
    return both.withColumn("pos", pos).drop("in_left", "in_right")


#: A batch's name: a small letter, then 2 to 50 small letters, digits and hyphens.
BATCH_NAME = "[a-z][a-z0-9-]{2,50}"


def is_batch_name(name: Column) -> Column:
    """Whether the name can be a batch's; a null name cannot."""
    return F.coalesce(name.rlike(f"\\A{BATCH_NAME}\\z"), F.lit(False))


def batch_name(name: str) -> str:
    """name, if it can be a batch's; else an error."""
    if not re.fullmatch(BATCH_NAME, name):
        raise ValueError("a batch's name has lowercase letters, digits and hyphens")
    return name


def tail(rows: DataFrame, total: int, n: int) -> DataFrame:
    """The last n rows by pos; ``head`` has the others. Fewer than one are an error."""
    if n < 1:
        raise ValueError("tail must be positive")
    return rows.where(F.col("pos") >= total - n)


def head(rows: DataFrame, total: int, n: int) -> DataFrame:
    return rows.where(F.col("pos") < total - n)


def assign_zones(servers: DataFrame, zones: list[str], per_zone: int = 8) -> DataFrame:
    """servers (pos) with their zone: per_zone consecutive ones each; zones count once. Too few zones are an error."""
    zones = list(dict.fromkeys(z.strip() for z in zones if z.strip()))
    if not zones:
        raise ValueError("at least one zone is required")
    at = F.floor(F.col("pos") / per_zone).cast("int")
    zone = F.get(F.array(*(F.lit(z) for z in zones)), at)
    return servers.withColumn("zone", F.when(at < len(zones), zone).otherwise(F.raise_error(F.lit(f"{len(zones)} zones are too few")).cast("string")))


def not_done(inputs: DataFrame, done: DataFrame, key: str = "domain") -> DataFrame:
    """Inputs whose key has no result; a key that the inputs repeat stays repeated."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def skip(inputs: DataFrame, n: int) -> DataFrame:
    """Resume by position."""
    return inputs.where(F.col("pos") >= n)


def upsert(old: DataFrame, new: DataFrame, key: str = "key") -> DataFrame:
    """Rows of old with a key of new give way to those of new."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)
