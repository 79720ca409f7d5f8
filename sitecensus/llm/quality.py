"""Quality by a factorisation machine.

A document's features are its words, hashed to 2**13 numbers (weights by logarithm of the count, the vector of length
1), statistics of its structure (shares of capitals, digits and signs, lengths of words and lines, repetition) and
metadata (n_chars). The score is the logistic function of

    bias + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),

that is all pairwise interactions of rank ``RANK`` in time linear in the number of features. The machine is fitted by
AdaGrad on a bounded sample of the labelled rows, whose features are computed in Spark; then every document is scored
where it is read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 13
RANK = 6
SIGNS = re.compile(r"[^\w\s]")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
DIGITS = re.compile(r"[0-9]")
RUNS = re.compile(r"([^\w\s])\1")
ENDS = re.compile(r"[.!?](?:\s|$)")
STATS = 16


def features(text: str, n_chars: int | None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Numbers and weights of a text's words, and its statistics."""
    words = text.lower().split()
    counts = Counter(words)
    numbers = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) % WORDS for w in counts), np.int64, len(counts))
    weights = np.log1p(np.fromiter(counts.values(), float, len(counts)))
    if len(weights):
        weights /= np.sqrt((weights * weights).sum())
    lines = [x for x in text.split("\n") if x.strip()]
    n, n_words, n_lines = max(1, len(text)), max(1, len(words)), max(1, len(lines))
    signs = len(SIGNS.findall(text))
    stats = [
        np.log1p(len(text)),
        np.log1p(n_words),
        len(CAPITALS.findall(text)) / n,
        len(DIGITS.findall(text)) / n,
        signs / n,
        len(RUNS.findall(text)) / n_words,
        sum(map(len, words)) / n_words,
        len(counts) / n_words,
        max(counts.values(), default=0) / n_words,
        n_lines / n_words,
        np.log1p(len(text) / n_lines),
        1 - len(set(lines)) / n_lines,
        text.count("|") / n_words,
        len(ENDS.findall(text)) / n_words,
        sum(n for w, n in counts.items() if len(w) <= 3) / n_words,
        np.log1p(max(0, n_chars or 0)),
    ]
    return numbers, weights, [float(x) for x in stats]


@dataclass
class Features:
    """Of several texts, one after the other: numbers and weights of their words, how many each has, and statistics."""

    numbers: np.ndarray
    weights: np.ndarray
    sizes: np.ndarray
    stats: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, n_chars: pa.Array) -> Features:
        found = [features(t.as_py() or "", c.as_py()) for t, c in zip(texts, n_chars, strict=True)]
        sizes = np.array([len(numbers) for numbers, _, _ in found], np.int64)
        joined = lambda k, kind: np.concatenate([np.zeros(0, kind), *(f[k] for f in found)])
        return cls(joined(0, np.int64), joined(1, float), sizes, np.array([s for _, _, s in found], float).reshape(-1, STATS))


@dataclass
class Machine:
    mean: np.ndarray
    scale: np.ndarray
    bias: float
    linear: np.ndarray  # of words, then of statistics
    factors: np.ndarray

    def rows(self, texts: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features of the texts: numbers and values, and where each text's begin; statistics come after its words."""
        scaled = np.clip((texts.stats - self.mean) / self.scale, -5, 5) * 0.5
        n = len(texts.sizes)
        starts = np.concatenate([[0], np.cumsum(texts.sizes + STATS)]).astype(np.int64)
        numbers, values = np.empty(starts[-1], np.int64), np.empty(starts[-1])
        at = np.repeat(starts[1:] - STATS, STATS) + np.tile(np.arange(STATS), n)
        numbers[at], values[at] = np.tile(WORDS + np.arange(STATS), n), scaled.ravel()
        of_words = np.ones(starts[-1], bool)
        of_words[at] = False
        numbers[of_words], values[of_words] = texts.numbers, texts.weights
        return numbers, values, starts[:-1]

    def raw(self, numbers: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the logistic function is taken of, for each text; and the features' vectors and the texts' sums of them."""
        v = self.factors[numbers] * values[:, None]
        total = np.add.reduceat(v, starts)
        pairs = 0.5 * ((total * total).sum(axis=1) - np.add.reduceat((v * v).sum(axis=1), starts))
        return self.bias + np.add.reduceat(self.linear[numbers] * values, starts) + pairs, v, total

    def scores(self, texts: Features) -> np.ndarray:
        if not len(texts.sizes):
            return np.zeros(0)
        return logistic(self.raw(*self.rows(texts))[0])


def logistic(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit_machine(texts: Features, labels: np.ndarray, epochs: int = 8, rate: float = 0.1, ridge: float = 1e-5, seed: int = 1) -> Machine:
    """AdaGrad over batches of 128 texts. Labels of one kind only, or none: the score is their smoothed rate for all."""
    n, ones = len(labels), float(labels.sum())
    prior = (ones + 0.5) / (n + 1)
    mean, scale = (texts.stats.mean(axis=0), np.maximum(texts.stats.std(axis=0), 1e-6)) if n else (np.zeros(STATS), np.ones(STATS))
    random = np.random.default_rng(seed)
    size = WORDS + STATS
    machine = Machine(mean, scale, float(np.log(prior / (1 - prior))), np.zeros(size), np.zeros((size, RANK)))
    if not 0 < ones < n:
        return machine
    machine.factors = random.normal(0, 0.05, (size, RANK))
    all_numbers, all_values, all_starts = machine.rows(texts)
    own_sizes = texts.sizes + STATS
    past_w, past_v, past_b = np.full(size, 1e-2), np.full((size, RANK), 1e-2), 1e-2
    for _ in range(epochs):
        order = random.permutation(n)
        for at in range(0, n, 128):
            batch = order[at : at + 128]
            sizes = own_sizes[batch]
            starts = np.cumsum(sizes) - sizes
            of_row = np.repeat(np.arange(len(batch)), sizes)
            places = np.arange(sizes.sum()) + (all_starts[batch] - starts)[of_row]
            numbers, values = all_numbers[places], all_values[places]
            raw, v, total = machine.raw(numbers, values, starts)
            error = logistic(raw) - labels[batch]
            slope = error[of_row] * values
            kinds, which = np.unique(numbers, return_inverse=True)
            g = np.bincount(which, slope) / len(batch) + ridge * machine.linear[kinds]
            past_w[kinds] += g * g
            h = slope[:, None] * (total[of_row] - v)
            gv = np.column_stack([np.bincount(which, h[:, f]) for f in range(RANK)]) / len(batch) + ridge * machine.factors[kinds]
            past_v[kinds] += gv * gv
            machine.linear[kinds] -= rate * g / np.sqrt(past_w[kinds])
            machine.factors[kinds] -= rate * 0.3 * gv / np.sqrt(past_v[kinds])
            gb = float(error.mean())
            past_b += gb * gb
            machine.bias -= rate * gb / past_b**0.5
    return machine


def held_out(doc_id: str = "doc_id", folds: int = 5, fold: int = 0):
    """Whether crc32(doc_id as text) mod folds is ``fold``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_fit: int = 8_000) -> Machine:
    """docs: doc_id, text, n_chars. labels: doc_id and label (0, 1), the rows to learn from.

    A fixed sample (by the hash of the id) of about max_fit labelled rows is used, of both labels in the shares they
    have. A doc_id that repeats counts once (label 1 wins); null ids and labels do not count.
    """
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    n = known.count()
    if n > max_fit:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < int(1e6 * max_fit / n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Features.of(batch.column(0), batch.column(1))
            ends = pa.array(np.concatenate([[0], np.cumsum(found.sizes)]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (found.numbers, found.weights)]
            stats = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * STATS, pa.int32()), pa.array(found.stats.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), *lists, stats], ["doc_id", "label", "numbers", "weights", "stats"])

    sample = docs.select("doc_id", "text", F.col("n_chars").cast("long").alias("n_chars")).join(F.broadcast(known), "doc_id")
    rows = sample.select("text", "n_chars", F.col("doc_id").cast("long"), "label").mapInArrow(run, "doc_id long, label int, numbers array<long>, weights array<double>, stats array<double>").toArrow()
    rows = rows.sort_by([("doc_id", "ascending")]).combine_chunks()  # the order of tasks does not matter
    if not rows.num_rows:
        return fit_machine(Features(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros((0, STATS))), np.zeros(0))
    numbers, weights, stats = (rows.column(c).chunk(0) for c in ("numbers", "weights", "stats"))
    sizes = np.diff(numbers.offsets.to_numpy())
    own = Features(numbers.flatten().to_numpy(), weights.flatten().to_numpy(), sizes, stats.flatten().to_numpy().reshape(-1, STATS))
    return fit_machine(own, rows.column("label").to_numpy().astype(float))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id and score for each row of docs (doc_id, text, n_chars). Null texts are empty; null n_chars count as 0."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            parts = [batch.slice(i, 256) for i in range(0, batch.num_rows, 256)]  # the features of so many texts at once
            scores = np.concatenate([np.zeros(0), *(own.scores(Features.of(part.column(1), part.column(2))) for part in parts)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.col("n_chars").cast("long")).mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_fit: int = 8_000) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted.

    docs: doc_id, text, n_chars; labels: doc_id, quality. Labels of held-out rows are not read. See ``fit`` and
    ``score`` for nulls, repeated rows and bounds. No rows: no rows; no labels: the same score for all texts.
    """
    machine = fit(docs, labels.where(~held_out()).select("doc_id", F.col("quality").alias("label")), max_fit)
    scored = score(docs, machine)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
