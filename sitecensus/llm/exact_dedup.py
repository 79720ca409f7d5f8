"""Exact deduplication by two-pass Bloom filtering.

Pass 1 counts the slots of a blocked Bloom filter (one block and two bits in it for each text, from its
64-bit hash) and keeps the bits that two or more rows have set. Pass 2 tests every row against those bits.
A row that misses one of its bits has no equal anywhere and goes straight to the output; only the others
shuffle, as (SHA-256, doc_id), and are grouped exactly. A false positive costs one slim shuffled row.

The filter has 16 bits a row, as bitmaps of 4 KiB, and is broadcast. ``max_filter_mb`` bounds it: beyond the
bound the false positives rise and more slim rows shuffle, up to all of them, so results stay the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_of, power_of_two, spare_name, written

BLOCK_BITS = 32768
BITS_PER_ROW = 16


def _slots(text: Column, n_blocks: int) -> tuple[Column, Column, Column]:
    """Block, and two bits in it, of a text."""
    h = F.xxhash64(text)
    g = F.xxhash64(h)
    return F.pmod(h, F.lit(n_blocks)), g.bitwiseAND(BLOCK_BITS - 1), F.shiftrightunsigned(g, 15).bitwiseAND(BLOCK_BITS - 1)


def repeat_filter(docs: DataFrame, text: Column, n_blocks: int) -> DataFrame:
    """(block, bits): of each block, the bits that two or more rows of docs set."""
    block, one, two = _slots(text, n_blocks)
    slot = F.explode(F.array(block * BLOCK_BITS + one, block * BLOCK_BITS + two))
    repeated = docs.select(slot.alias("slot")).groupBy("slot").agg(F.count("*").alias("n")).where("n > 1")
    return (
        repeated.select(F.floor(F.col("slot") / BLOCK_BITS).alias("block"), (F.col("slot") % BLOCK_BITS).alias("bit"))
        .repartition("block")
        .groupBy("block")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def _suspects(docs: DataFrame, text: Column, max_filter_mb: int) -> tuple[DataFrame, str]:
    """docs with a boolean column (its name comes second): another row may have the same text."""
    n_blocks = min(power_of_two(docs.count() * BITS_PER_ROW / BLOCK_BITS), power_of_two(max_filter_mb * 256))
    block, one, two = _slots(text, n_blocks)
    name = spare_name(docs.columns, "maybe_repeated")
    key, bits = spare_name(docs.columns, "bloom_block"), spare_name(docs.columns, "bloom_bits")
    bloom = repeat_filter(docs, text, n_blocks).select(F.col("block").alias(key), F.col("bits").alias(bits))
    hit = F.coalesce(bit_of(F.col(bits), one) & bit_of(F.col(bits), two), F.lit(False))
    tested = docs.withColumn(key, block).join(F.broadcast(bloom), key, "left")
    return tested.withColumn(name, hit).drop(key, bits), name


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_mb: int = 128) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with equal texts the one with the largest id stays. A null text counts as the empty text. A null
    id is smaller than any other; in a group of null ids only, keep_id is null. Of rows that repeat both id
    and text exactly one is marked as kept. Other columns are not read; an empty table gives no rows.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tested, maybe = _suspects(slim, F.col("text"), max_filter_mb)
    sha = F.sha2(F.col("text"), 256).alias("text_sha256")
    unique = tested.where(~F.col(maybe)).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha
    )
    rows = tested.where(maybe).select("doc_id", sha).groupBy("text_sha256", "doc_id").agg(F.count("*").alias("rows"))
    # as a table of its own, so that the join's large partitions (one text that very many rows have) can be split
    groups = written(rows.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size")), "groups")
    repeated = rows.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", "text_sha256", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy")
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return unique.unionByName(repeated.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_mb: int = 128) -> DataFrame:
    """docs without the rows that ``exact_dedup`` does not keep, all columns as they were.

    Rows that cannot repeat are passed on without a shuffle; the others are reduced to one row a text, before
    the shuffle already in each task. Equal id and text: the row whose columns have the largest hash stays.
    """
    columns = docs.columns
    tested, maybe = _suspects(docs, F.coalesce(F.col(f"`{text_col}`"), F.lit("")), max_filter_mb)
    quoted = [F.col(f"`{c}`") for c in columns]
    order = F.struct(F.col(f"`{id_col}`"), F.xxhash64(*quoted))
    best = (
        tested.where(maybe)
        .groupBy(F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256).alias("sha"))
        .agg(F.max_by(F.struct(*quoted), order).alias("row"))
        .select("row.*")
    )
    return tested.where(~F.col(maybe)).select(*quoted).unionByName(best)
