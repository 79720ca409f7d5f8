"""Packing by vector bin packing.

Examples are placed under three limits at once: tokens, segments and loss-bearing tokens of a sequence. A
sequence is filled by the dot-product heuristic: among the waiting examples that fit under all limits, it takes
the one whose demand has the largest dot product with what is left of the limits (both as fractions of the
limits). When none fits whole, the one that can give the longest head is cut so that the sequence is full; heads of
less than ``LEAST_HEAD`` ids are not cut off. A sequence that the segment or loss limit leaves short, or that ends its
partition, is cut back to a power of two, which needs no padding, and what was cut off waits for the next one.

The first ids of a piece of a document bear no loss, since too little of the document stands before them.

Each task packs the rows it reads, in one pass, with a pool of bounded size; nothing is shuffled.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 2
LEAST_HEAD = 64
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


class WordIds(dict):
    """Ids (as bytes, 32 bits each) of white-space separated strings, by the vocabulary of a word-end BPE.

    The vocabulary's merges are in the order of their ids, so the byte-pair engine that works by ranks gives
    the same ids; a byte that UTF-8 never uses stands for the end of a word. Texts with characters beyond
    Latin letters and plain punctuation, whose case or white space libraries may treat differently, and texts that
    hold the beginning of a special token's string, which is one id there, go through the tokenizer itself.
    """

    MOST = 400_000

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        special = {token.content for token in self.tokenizer.get_added_tokens_decoder().values()}
        self.marks = sorted({content[:2] for content in special})
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
        ranks = {}
        for token, number in vocabulary.items():
            if token not in special:
                ends = token.endswith("</w>") and token != "</w>"
                ranks[bytes(byte[c] for c in (token[:-4] if ends else token)) + b"\xff" * ends] = number
        self.piece = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.codes = [i.to_bytes(4, "little") for i in range(max(ranks.values()) + 1)]
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.odd = regex.compile("[^\t\n\r\x20-\x7e¡-įı-ſ–-…€]").search

    def __missing__(self, string: str) -> bytes:
        if len(self) >= self.MOST:
            self.clear()
        low = string.lower()
        words = (low,) if low.isalpha() else self.words(low)  # a run of letters is one word
        self[string] = found = b"".join([self.codes[i] for word in words for i in self.piece(word.encode() + b"\xff")])
        return found

    def of(self, text: str) -> bytes:
        if self.odd(text) or any(mark in text for mark in self.marks):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.split()))


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class Packer:
    """Packs the examples of one stream. ``add`` and ``finish`` yield full sequences: lists of (example, start,
    length, loss). An example is (key, ids, loss): if loss is a number, so many ids at the start of each piece bear none,
    and all others do; otherwise loss[i] is the number of loss-bearing ids before i."""

    def __init__(self, tokens: int, segments: int, loss: int, pool: int):
        self.limits = np.array([tokens, segments, loss], float)
        self.tokens, self.segments, self.loss, self.pool = tokens, segments, loss, pool
        self.waiting: list[tuple[tuple, int, int]] = []  # example, start, end
        self.demand = np.zeros((0, 3))  # tokens and loss of those waiting, and ids at their start that bear no loss
        self.total = 0

    @staticmethod
    def losses(example: tuple, start: int, end: int) -> int:
        bears = example[2]
        return max(0, end - start - bears) if isinstance(bears, int) else int(bears[end] - bears[start])

    def wait(self, items: list[tuple[tuple, int, int]]) -> None:
        if items:
            self.demand = np.vstack([self.demand, [(e - s, self.losses(x, s, e), self.cut((x, s, e), e - s, 0)) for x, s, e in items]])
            self.waiting += items
            self.total += sum(e - s for _, s, e in items)

    def take(self, i: int) -> tuple[tuple, int, int]:
        """Remove item i; the last one takes its place."""
        item, last = self.waiting[i], self.waiting.pop()
        if i < len(self.waiting):
            self.waiting[i] = last
            self.demand[i] = self.demand[-1]
        self.demand = self.demand[:-1]
        self.total -= item[2] - item[1]
        return item

    def cut(self, item: tuple[tuple, int, int], most: int, loss: int) -> int:
        """Length of the longest head of at most ``most`` ids and ``loss`` loss-bearing ones."""
        example, start, end = item
        bears = example[2]
        if isinstance(bears, int):
            return min(most, end - start, bears + loss)
        return min(most, end - start, int(np.searchsorted(bears, bears[start] + loss, "right")) - 1 - start)

    def fill(self) -> list[tuple[tuple, int, int, int]]:
        """One sequence, from what waits."""
        placed: list[tuple[tuple, int, int]] = []
        left = self.limits.copy()
        while self.waiting and left[0] > 0 and left[1] > 0:
            weight = left / self.limits / self.limits
            score = self.demand[:, 0] * weight[0] + weight[1] + self.demand[:, 1] * weight[2]
            fits = (self.demand[:, 0] <= left[0]) & (self.demand[:, 1] <= left[2])
            whole = bool(fits.any())
            heads = score if whole else np.minimum(np.minimum(self.demand[:, 0], left[0]), self.demand[:, 2] + left[2])
            i = int(np.where(fits, score, -1).argmax() if whole else heads.argmax())
            if not whole and (head := self.cut(self.waiting[i], int(left[0]), int(left[2]))) < (min(LEAST_HEAD, left[0]) if placed else 1):
                break
            example, start, end = self.take(i)
            if not whole:
                self.wait([(example, start + head, end)])
                end = start + head
            placed.append((example, start, end))
            left -= (end - start, 1, self.losses(example, start, end))
        self.trim(placed, self.tokens - int(left[0]))
        return [(x, s, e - s, self.losses(x, s, e)) for x, s, e in placed]

    def trim(self, placed: list[tuple[tuple, int, int]], total: int) -> None:
        """Cut a sequence that is not full back to a power of two; what is cut off waits."""
        if not total:
            raise ValueError("an id bears more loss than a sequence may hold")
        excess = 0 if total == self.tokens else total - (1 << (total.bit_length() - 1))
        while excess:
            example, start, end = placed.pop()
            keep = max(0, end - start - excess)
            self.wait([(example, start + keep, end)])
            if keep:
                placed.append((example, start, start + keep))
            excess -= end - start - keep

    def add(self, example: tuple, length: int) -> Iterator[list]:
        self.wait([(example, 0, length)] if length else [])
        if self.total >= self.pool:
            while self.total > self.pool // 2:
                yield self.fill()

    def finish(self) -> Iterator[list]:
        while self.waiting:
            yield self.fill()


def _pack_stream(batches: Iterable[pa.RecordBatch], examples: Callable, limits: tuple[int, int, int, int]) -> Iterator[pa.RecordBatch]:
    packer = Packer(*limits)
    sequence = TaskContext.get().partitionId() << 33 if TaskContext.get() else 0
    names = [field.split(" ")[0] for field in PIECE_SCHEMA.split(", ")]
    rows: list[tuple] = []

    def emit(pieces: list) -> None:
        nonlocal sequence
        offset = 0
        for (key, ids, _), start, length, loss in pieces:
            rows.append((key, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), len(ids) // 4, sequence, offset, loss))
            offset += length
        sequence += 1

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)
        rows.clear()
        return out

    for received in batches:
        for example in examples(received):
            for pieces in packer.add(example, len(example[1]) // 4):
                emit(pieces)
            if len(rows) >= 20_000:
                yield batch()
    for pieces in packer.finish():
        emit(pieces)
    if rows:
        yield batch()


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = 4096,
    max_segments: int = 256,
    max_loss: int = 3904,
    context: int = 128,
    pool_sequences: int = 64,
) -> DataFrame:
    """One row for each piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    loss_tokens.

    A document's ids are those of its text and END_ID; the first ``context`` ids of each piece bear no loss. A sequence has
    at most max_segments pieces and max_loss ids that bear loss. tokenizer: path of the vocabulary, on every executor. A
    null or empty text has END_ID alone. Null and repeated doc_ids are documents of their own. Other columns
    are not read; an empty table gives no rows. Sequences have max_tokens ids, or else a power of two.
    max_tokens must be a power of two. Memory: pool_sequences * max_tokens ids, and one batch of rows.
    """
    limits = (max_tokens, max_segments, max_loss, pool_sequences * max_tokens)
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(tokenizer)

        def examples(batch: pa.RecordBatch) -> Iterator[tuple]:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield key, ids.of(text.as_py() or "") + end, context

        yield from _pack_stream(batches, examples, limits)

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(run, PIECE_SCHEMA)


def pack_conversations(
    turns: DataFrame, tokenizer: str, roles: tuple[str, ...] = ("assistant",), max_tokens: int = 4096, max_segments: int = 64, max_loss: int = 2048, pool_sequences: int = 64
) -> DataFrame:
    """As ``pack_documents``, for instruction data: turns has conv_id, turn, role, text; doc_id is the conv_id.

    A turn's ids are those of its text and END_ID; only those of the given roles bear loss. Turns follow their
    number; null texts are empty, null roles bear no loss, turns without a conv_id are one conversation, and
    equal turn numbers follow role and text. Conversations must fit into an executor's memory, as texts do.
    """
    limits = (max_tokens, max_segments, max_loss, pool_sequences * max_tokens)
    end = np.array([END_ID], "<u4").tobytes()
    talks = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(tokenizer)

        def examples(batch: pa.RecordBatch) -> Iterator[tuple]:
            for key, talk in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                parts = [(ids.of(t["text"]) + end, t["role"] in roles) for t in talk.as_py()]
                bears = np.concatenate([np.full(len(p) // 4, loss) for p, loss in parts])
                yield key, b"".join(p for p, _ in parts), np.concatenate([[0], np.cumsum(bears)])

        yield from _pack_stream(batches, examples, limits)

    return talks.mapInArrow(run, PIECE_SCHEMA)
