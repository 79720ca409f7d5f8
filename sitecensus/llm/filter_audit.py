"""Filter interaction audit: what each filter removes in every order of the filters.

Each text gets the mask of the filters that it fails, and the rows are counted by part and mask. The subset-zeta
transform turns those counts into the survivors of every subset of the filters; a step of an order is then the
difference between the survivors of two neighbouring subsets, for all rows as for the labelled ones. So the texts are
read once, however many orders there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_INNER = bytes(range(0x80, 0xC0))  # the bytes of UTF-8 that begin no character
_MARKS = b"#$%&*|"


def _without(raw: bytes, dropped: bytes) -> int:
    return len(raw.translate(None, dropped))


#: Failure conditions of a text (UTF-8) and its words, by letter; bytes.split() splits at 0x20 and 0x09 to 0x0D only.
TEXT_FILTERS: dict[str, Callable[[bytes, list[bytes]], bool]] = {
    "A": lambda raw, words: len(words) < 50,
    "B": lambda raw, words: 100 * len(set(words)) < 65 * len(words),
    "C": lambda raw, words: 100 * (len(raw) - _without(raw, _UPPER)) > 5 * _without(raw, _INNER),
    "D": lambda raw, words: _without(raw, _MARKS) < len(raw),
}
#: The letter of the filter that a text fails if a smaller id has the same text.
REPEAT = "E"
RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failed_filters(docs: DataFrame, filters: dict[str, Callable[[bytes, list[bytes]], bool]] = TEXT_FILTERS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """doc_id, part, mask, digest for each row of docs: bit i of mask is set if the text fails the filter at place i;
    digest is the SHA-256 of the text. A null text is empty, a null part is the empty string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                masks, digests = [], []
                for raw in batch.column(2).to_pylist():
                    words = raw.split()
                    masks.append(sum(1 << i for i, fails in enumerate(filters.values()) if fails(raw, words)))
                    digests.append(hashlib.sha256(raw).digest())
                columns = [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "digest"])

    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), part.alias("part"), text.alias("text")).mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def mask_counts(failed: DataFrame, labels: DataFrame, repeat_bit: int) -> DataFrame:
    """part, mask, rows, good, toxic: the rows of each part that fail exactly the filters of mask, after bit repeat_bit
    is set where a smaller id has the same digest. A null id is neither smaller than another nor larger. A doc_id
    that labels repeats counts once (1 wins)."""
    failed = written(failed, "audit-rows")
    # as a table of its own, so that the join's large partitions (one text that very many rows have) can be split
    repeated = written(failed.groupBy("digest").agg(F.min("doc_id").alias("smallest"), F.count("*").alias("n")).where("n > 1").drop("n"), "audit-repeats")
    is_one = lambda name: F.max(F.coalesce((F.col(name) == 1).cast("long"), F.lit(0)))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    repeats = F.coalesce(F.col("doc_id") > F.col("smallest"), F.lit(False))
    mask = F.col("mask").bitwiseOR(F.when(repeats, 1 << repeat_bit).otherwise(0))
    return (
        failed.join(known, "doc_id", "left")
        .join(repeated, "digest", "left")
        .groupBy("part", mask.alias("mask"))
        .agg(F.count("*").alias("rows"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    )


def survivors(counts: np.ndarray) -> np.ndarray:
    """counts: parts x 2**n x measures, by mask of the failed filters; returned: the rows that stay, by set of the filters applied.

    Rows stay if their mask lies in the complement of the set. Sums over all subsets of a mask are running sums along
    each of the n axes of a cube with one axis a filter."""
    parts, masks, measures = counts.shape
    n = masks.bit_length() - 1
    cube = counts.reshape(parts, *(2,) * n, measures)
    for axis in range(1, n + 1):
        cube = np.cumsum(cube, axis=axis)
    return cube.reshape(counts.shape)[:, ::-1]  # the complement of s is 2**n - 1 - s


def order_steps(counts: DataFrame, letters: str) -> DataFrame:
    """counts: part, mask, rows, good, toxic (``mask_counts``), bit i of a mask being the filter letters[i]. One row
    for each part, order of the letters and step: the columns of RESULT, zeros included."""
    n = len(letters)
    orders = list(permutations(range(n)))
    which = np.array(orders)
    after = np.cumsum(1 << which, axis=1)
    before = after - (1 << which)
    names = pa.array(["".join(letters[i] for i in order) for order in orders for _ in order])
    steps = np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                cells = batch.column(1)
                measured = cells.flatten()
                table = np.zeros((batch.num_rows, 1 << n, 3), np.int64)
                row = np.repeat(np.arange(batch.num_rows), cells.value_lengths().to_numpy())
                table[row, measured.field("mask").to_numpy()] = np.column_stack([measured.field(c).to_numpy() for c in ("rows", "good", "toxic")])
                stay = survivors(table)
                gone = stay[:, before] - stay[:, after]  # parts x orders x steps x measures
                removed = gone[..., 0]
                fails = stay[:, :1, 0] - stay[:, 1 << np.arange(n), 0]
                alone = table[:, 1 << np.arange(n), 0]
                shapley = np.stack([removed[:, which == i].sum(axis=1) for i in range(n)], axis=1)
                numbers = [stay[:, after, 0], removed, fails[:, which] - removed, alone[:, which], gone[..., 1], gone[..., 2], shapley[:, which]]
                part = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), len(steps))))
                order = names.take(pa.array(np.tile(np.arange(len(steps)), batch.num_rows)))
                columns = [part, order, pa.array(np.tile(steps, batch.num_rows)), *(pa.array(x.ravel()) for x in numbers)]
                yield pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in RESULT.split(", ")])

    cell = F.struct("mask", *(F.col(c).cast("long").alias(c) for c in ("rows", "good", "toxic")))
    return counts.groupBy("part").agg(F.collect_list(cell).alias("cells")).mapInArrow(run, RESULT)  # 2**n cells a part at most


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[bytes, list[bytes]], bool]] = TEXT_FILTERS, repeat: str = REPEAT, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row for each part of docs, order of the filters (with ``repeat``, for texts that a smaller id has) and step.

    kept, removed: the part's rows after this step, and by it; redundant: rows that fail its filter and were removed
    before; unique_fails: rows that fail its filter only; good_lost, toxic_lost: removed rows that labels (doc_id,
    quality, toxic) give quality or toxic 1; shapley: removed by its filter, summed over all orders. Null texts are empty, null parts the empty string;
    repeated rows count each; see ``mask_counts`` for null ids and labels. Extra columns are not read; no rows give none.
    """
    failed = failed_filters(docs, filters, id_col, text_col, part_col)
    return order_steps(mask_counts(failed, labels, len(filters)), "".join(filters) + repeat)
