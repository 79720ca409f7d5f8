"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in the order of their ids, form blocks of ``block_docs``. Block j (from 0) of a
source of weight w (a fraction of the sum of all weights) is released at slot floor(j / w) and due by slot
ceil((j + 1) / w); earliest-deadline-first gives each slot to the released block that is due first. Weights
are exact fractions, so every prefix of the slots holds less than one block more or less of each source than
its weight asks for, however long the schedule is and however many sources it has, until the source runs out.

The schedule is made in one task, which sees the sources' numbers of rows alone and holds one block a source;
its rows, one a block, are spread again and joined to the ranges of ids. Ranks within a source come from counts
by id range (ranges of about as many rows, however the ids lie), added up in two steps, and a window within one
range: no source has to pass through one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lists import key_ranges, rows_before
from .common import spare_name

#: Rows of a range of ids, about; they are numbered in one task.
RANGE_ROWS = 1000


def shares(weights: dict[str, float], period: int) -> dict[str, int]:
    """Weights rounded to a schedule that repeats: slots of each source in a period, largest remainders, at least one each."""
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    if period < len(weights):
        raise ValueError("the period is shorter than the list of sources")
    total = sum(weights.values())
    exact = {s: (period - len(weights)) * w / total for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[: period - sum(out.values())]:
        out[s] += 1
    return out


def pfair(weights: dict[str, float], blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) of all blocks, by slot; ties of deadlines go to the smaller name.

    A source's next block waits until the one before has its slot, which is due earlier in any case.
    """
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    exact = {s: Fraction(w) for s, w in weights.items()}
    total = sum(exact.values())
    gap = {s: (total / w).as_integer_ratio() for s, w in exact.items()}  # slots a block
    waiting = [(0, s) for s in weights if blocks.get(s, 0) > 0]
    heapq.heapify(waiting)
    ready: list[tuple[int, str]] = []
    at = dict.fromkeys(weights, 0)
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            source = heapq.heappop(waiting)[1]
            p, q = gap[source]
            heapq.heappush(ready, (-(-(at[source] + 1) * p // q), source))
        due, source = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a block missed its deadline")
        p, q = gap[source]
        block = at[source]
        yield source, block, block * p // q, due, slot
        at[source] = block + 1
        if block + 1 < blocks[source]:
            heapq.heappush(waiting, ((block + 1) * p // q, source))
        slot += 1


def pfair_pattern(share: dict[str, int]) -> list[str]:
    """The source of each slot of one period."""
    return [source for source, *_ in pfair(share, share)]


def _slots(counts: DataFrame, weights: dict[str, float], block_docs: int, batch_rows: int) -> DataFrame:
    """counts: source, n. (source, block, release, deadline, slot) of every block of the sources that have a weight."""
    schema = "source string, block long, release long, deadline long, slot long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, int] = {}
        for batch in batches:
            blocks |= {s: -(-n // block_docs) for s, n in zip(*(c.to_pylist() for c in batch.columns), strict=True) if s in weights}
        names, rows = [f.split(" ")[0] for f in schema.split(", ")], []
        for row in pfair(weights, blocks):
            rows.append(row)
            if len(rows) == batch_rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)
                rows.clear()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)

    return counts.select("source", "n").repartition(1).mapInArrow(run, schema)


def _placed(docs: DataFrame, weights: dict[str, float], id_col: str, source_col: str, block_docs: int, period: int) -> DataFrame:
    """docs with a struct ``mix``: each row's source, rank (from 0, by id; nulls first) within it, block, release, deadline, slot."""
    names = docs.columns
    source, part, rank, before, rows, block, slots = (spare_name(names, f"mix_{n}") for n in ("source", "part", "rank", "before", "rows", "block", "slots"))
    # rows without an id are spread by all their columns: they may be many, and their order is free
    spread = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in names)), F.lit(1 << 20)) - F.lit(1 << 62)
    keyed = docs.withColumns({source: F.coalesce(F.col(f"`{source_col}`"), F.lit("")), part: F.coalesce(key_ranges(docs, id_col, RANGE_ROWS), spread)})
    counts = keyed.groupBy(source, part).agg(F.count("*").alias(rows))
    placed = _slots(counts.groupBy(F.col(source).alias("source")).agg(F.sum(rows).alias("n")), weights, block_docs, period)
    # the blocks that a range of ids has rows of, as a list beside its number of earlier rows: documents do not move for them
    blocks = rows_before(counts, part, rows, before, source)
    blocks = blocks.withColumn(block, F.explode(F.sequence(F.floor(F.col(before) / block_docs), F.floor((F.col(before) + F.col(rows) - 1) / block_docs))))
    blocks = blocks.join(placed.withColumnsRenamed({"source": source, "block": block}), [source, block], "left")
    ranges = blocks.groupBy(source, part, before).agg(F.array_sort(F.collect_list(F.struct(F.col(block).alias("block"), "release", "deadline", "slot"))).alias(slots))
    numbered = keyed.withColumn(rank, F.row_number().over(Window.partitionBy(source, part).orderBy(f"`{id_col}`")) - 1)
    joined = numbered.join(ranges, [source, part])  # has the window's partitioning: the rows do not move again
    number = F.col(rank) + F.col(before)
    own = F.get(F.col(slots), (F.floor(number / block_docs) - F.floor(F.col(before) / block_docs)).cast("int"))
    slot = F.coalesce(own["slot"], F.raise_error(F.concat(F.lit("no weight for source "), F.col(source))).cast("long"))
    mix = F.struct(F.col(source).alias("source"), number.cast("long").alias("rank"), *(own[k].alias(k) for k in ("block", "release", "deadline")), slot.alias("slot"))
    return joined.select(*(F.col(f"`{c}`") for c in names), mix.alias("mix"))


def target_weights(docs: DataFrame, source_col: str = "source", alpha: float = 0.5, max_sources: int = 10_000) -> dict[str, float]:
    """Weights of the sources of docs: their numbers of rows to the power alpha. A null source counts as ''.

    More sources than max_sources are an error: sources are collections, not sites or documents.
    """
    rows = docs.groupBy(F.coalesce(F.col(source_col), F.lit("")).alias("source")).agg(F.count("*").alias("n")).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    return {r.source: r.n**alpha for r in rows}


def schedule(
    docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", source_col: str = "source", block_docs: int = 16, period: int = 1000
) -> DataFrame:
    """One row for each row of docs: doc_id, source, source_rank, block, release, deadline, slot.

    slot orders the blocks of all sources (release <= slot < deadline); within a slot rows follow source_rank.
    A source that runs out leaves its later slots empty, and no row is dropped or repeated. A null source
    counts as ''; a source without a weight is an error. Other columns are not read; no rows: no rows.
    period: slots that the scheduling task gives out at a time; the schedule does not depend on it.
    """
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source_"))
    placed = _placed(slim, weights, "doc_id", "source_", block_docs, period)
    return placed.select("doc_id", "mix.source", F.col("mix.rank").alias("source_rank"), *(f"mix.{c}" for c in ("block", "release", "deadline", "slot")))


def interleave(docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", source_col: str = "source", block_docs: int = 16, period: int = 1000) -> DataFrame:
    """docs, all rows and columns, in the order of ``schedule``: partitions and their rows follow slot and rank."""
    columns = docs.columns
    renamed = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    by = {c: f"c{i}" for i, c in enumerate(columns)}
    placed = _placed(renamed, weights, by[id_col], by[source_col], block_docs, period)
    return placed.orderBy("mix.slot", "mix.rank").drop("mix").toDF(*columns)


def in_file_order(docs: DataFrame) -> DataFrame:
    """docs, read from the Parquet files of one write, in the order in which they were written: files are named by the task
    that wrote them, and rows have places in them. One sort restores what ``interleave`` has made; a source that is not
    read from files is an error."""
    names = docs.columns
    file, row = spare_name(names, "mix_file"), spare_name(names, "mix_row")
    number = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long")
    placed = docs.select(*(F.col(f"`{c}`") for c in names), number.alias(file), F.col("_metadata.row_index").alias(row))
    return placed.orderBy(file, row).select(*(F.col(f"`{c}`") for c in names))
