"""Vector code compression: each part of a vector becomes the number of its nearest codebook entry, found by Exponion search.

The search starts at the part's entry of the round before, at distance u. An entry no farther from the part than u is
no farther than 2u from the start entry, so only that ball of the start's neighbours, sorted by distance, is scanned.
All distances are squares of integers, so the bound (square of the entries' distance <= 4 u^2) is exact, and ties go to
the smaller index whatever the order of the scan.

Rounds are passes over tables of integer parts and codes; sums leave each task as one row a codebook component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Components beyond it would let a sum of squared distances leave 64 bits.
LARGEST = 1 << 27
ROWS_AT_ONCE = 2_000


def integers(vectors: np.ndarray, scale: int, parts: int) -> np.ndarray:
    """rows x dimensions to rows x parts x width, floor(scale * x); missing dimensions of the last part are 0."""
    fine = np.floor(vectors.astype(np.float64) * scale)
    if fine.size and np.abs(fine).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // scale}; squared distances would not fit into 64 bits")
    width = -(-fine.shape[1] // parts)
    out = np.zeros((len(fine), parts * width), np.int64)
    out[:, : fine.shape[1]] = fine
    return out.reshape(len(fine), parts, width)


class Codebooks:
    """entries: parts x entries x width. Of each entry, the others of its part by distance."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        parts, size, width = entries.shape
        self.flat = entries.reshape(parts * size, width)
        between = ((entries[:, :, None] - entries[:, None]) ** 2).sum(axis=3)
        own = np.arange(size)
        key = between.copy()
        key[:, own, own] = -1  # an entry comes first in its own list
        order = np.argsort(key, axis=2, kind="stable")
        first = np.arange(parts)[:, None, None] * size
        self.order = (order + first).reshape(parts * size, size)
        self.reach = np.take_along_axis(between, order, axis=2).reshape(parts * size, size)

    def nearest(self, points: np.ndarray, previous: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """points: rows x parts x width; previous: rows x parts. Codes and squared distances (rows x parts), and how many distances were computed."""
        rows, parts, width = points.shape
        size = self.entries.shape[1]
        x = points.reshape(rows * parts, width)
        start = (previous + np.arange(parts) * size).ravel()
        distance = ((x - self.flat[start]) ** 2).sum(axis=1)
        best, least = start.copy(), distance.copy()
        left, radius, computed = np.arange(len(x)), 4 * distance, len(x)
        for rank in range(1, size):
            inside = self.reach[start, rank] <= radius
            if not inside.all():  # the lists are sorted: who is out stays out
                left, start, radius, x = left[inside], start[inside], radius[inside], x[inside]
            if not len(left):
                break
            other = self.order[start, rank]
            distance = ((x - self.flat[other]) ** 2).sum(axis=1)
            now = least[left]
            better = (distance < now) | ((distance == now) & (other < best[left]))
            best[left[better]], least[left[better]] = other[better], distance[better]
            computed += len(left)
        return best.reshape(rows, parts) - np.arange(parts) * size, least.reshape(rows, parts), computed

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _lists(array: pa.Array, width: int) -> np.ndarray:
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), width)


def _codes(codes: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(codes, np.uint8)
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * raw.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _assigned(rows: DataFrame, books: np.ndarray, scale: int | None, keep: bool) -> DataFrame:
    """rows: vec_id, label, points, code (codes of the round before; null: entry 0). Adds error; scale: points are
    vectors to be made integers first; keep: points stay."""
    parts, _, width = books.shape
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Codebooks(books)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                n = batch.num_rows
                if scale is None:
                    points = _lists(batch.column(2), parts * width).astype(np.int64).reshape(n, parts, width)
                    previous = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                else:
                    points = integers(_lists(batch.column(2), len(batch.column(2)[0])), scale, parts)
                    previous = np.zeros((n, parts), np.int64)
                codes, distances, _ = found.nearest(points, previous)
                kept = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * parts * width, pa.int32()), pa.array(points.ravel(), pa.int32()))
                columns = [batch.column(0), batch.column(1), *([kept] if keep else []), _codes(codes), pa.array(distances.sum(axis=1))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", *(["points"] if keep else []), "code", "error"])

    return rows.select("vec_id", "label", "points", "code").mapInArrow(run, f"vec_id long, label {kind}, {'points array<int>, ' if keep else ''}code binary, error long")


def _sums(rows: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component sums and numbers of the parts that have each entry. One row a component leaves a task, and as many
    reach the driver: parts x entries x (width + 1)."""
    parts, size, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts * size, width + 1), np.int64)
        seen = False
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            seen = True
            points = _lists(batch.column(0), parts * width).astype(np.int64).reshape(n * parts, width)
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
            entry = (codes + np.arange(parts) * size).ravel()
            order = np.argsort(entry, kind="stable")
            used, begin = np.unique(entry[order], return_index=True)
            totals[used, :width] += np.add.reduceat(points[order], begin, axis=0) if width else 0
            totals[used, width] += np.diff(np.append(begin, len(entry)))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(totals.size)), pa.array(totals.ravel())], ["place", "total"])

    found = np.zeros(parts * size * (width + 1), np.int64)
    for place, total in rows.select("points", "code").mapInArrow(run, "place long, total long").groupBy("place").agg(F.sum("total")).collect():
        found[place] = total
    found = found.reshape(parts, size, width + 1)
    return found[..., :width], found[..., width]


def _whole(vector: Column) -> Column:
    """Neither null nor with a component that is null or not finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False))


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row for each vector that takes part: vec_id, code, error, label_error, codebooks_sha256.

    Vectors that are null, hold null or non-finite components, or differ in length from that of the smallest kept id
    take no part. The first codebooks are the vectors of the smallest ids (a null id comes last, equal ids in the order of their
    vectors), fewer if there are fewer. Repeated rows are rows of their own. A length that parts does not divide is
    filled up with zeros. Null labels are one label. A component beyond LARGEST / scale raises ValueError. No rows give none.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("points")).where(_whole(F.col("points")))
    smallest = lambda rows: [r.points for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "points").limit(entries).collect()]
    first = smallest(rows)
    if not first:
        return rows.where("false").selectExpr("vec_id", "'' AS code", "0L AS error", "0L AS label_error", "'' AS codebooks_sha256")
    length = len(first[0])
    rows = rows.where(F.size("points") == length).withColumn("code", F.lit(None).cast("binary"))
    if any(len(p) != length for p in first):
        first = smallest(rows)
    books = integers(np.array(first, np.float64).reshape(len(first), length), scale, parts).transpose(1, 0, 2)
    for number in range(rounds):
        rows = written(_assigned(rows, books, None if number else scale, keep=True), "vector-codes")
        sums, counts = _sums(rows, books)
        books = np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], books)
    final = written(_assigned(rows, books, None if rounds else scale, keep=False), "vector-codes")
    # a small table: Spark broadcasts it by its size, or splits the hot labels of the join
    totals = written(final.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    digest = Codebooks(books).digest()
    return final.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
