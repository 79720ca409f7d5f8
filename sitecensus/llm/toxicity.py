"""Toxicity by class-conditional Kneser-Ney models of the letters of words.

For each class (toxic, ordinary) P(letter | the word so far, up to six letters back) is an interpolated
Kneser-Ney estimate from that class's labelled rows. Its backoff distributions are shared: they come from the
continuation counts of all documents, so that rare spellings of an expression are smoothed alike in both classes
and only what a class has really seen tells them apart. Log-likelihoods are compared by length, for the document
and for each word; a logistic function of the difference over the document and of the largest differences of
its words gives the score. The function is fitted on rows that its language models have not seen (two folds).

Symbols are the bytes of words in UTF-8 (a rare letter is several of them) and the two ends of a word, so no two
letters are confused, and an n-gram of seven packs into 56 bits. The distinct n-grams of all documents, and of every
shorter order, are tables that grow with the corpus and stay in Spark. The driver and the executors get those of the
labelled sample alone, whose size is bounded, with the counts of their contexts in the whole corpus: after a context
that a class has seen, all letters that it has not seen there are discounted alike, so one number a context serves
for them, and after other contexts both classes have the shared distribution, which the comparison cancels.
A word's difference is divided by the root of its length, as chance differences grow: divided by the length itself,
chance short words would lead (of sf0.1's 144 held-out toxic rows 83 are found then, and 88 this way).
Counting and scoring each read every text, and no text moves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import power_of_two, spare_name, written

ORDER = 7
START, END = 1, 2
CHUNK = 1 << 19  # characters of text handled at once
HELD = 1 << 20  # n-grams that a task counts before it passes them on
TOP = 3
COUNTS = ["toxic0", "toxic1", "ordinary0", "ordinary1"]


@cache
def letters() -> np.ndarray:
    """Whether a code point is a letter or digit."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def hashed(codes: np.ndarray, size: int) -> np.ndarray:
    """A slot of each code; size is a power of two."""
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(32)) & np.uint64(size - 1)).astype(np.int64)


def chunks(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(number of the first text, texts in lower case), about CHUNK characters at a time or one text."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append((text.as_py() or "").lower())
        size += len(held[-1])
        if size >= CHUNK:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every symbol and word end of the texts: its n-gram's code, the number of its word, and its text."""
    joined = " " + " ".join(texts) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
    inside = np.repeat(letters()[points], width)
    symbols = np.frombuffer(joined.encode("utf-8", "replace"), np.uint8)
    bounds = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[np.cumsum([1] + [len(t) + 1 for t in texts])]
    before = np.concatenate([[False], inside[:-1]])
    starts, ends = inside & ~before, ~inside & before
    symbols = np.where(ends, np.uint8(END), symbols)
    at = np.flatnonzero(inside | ends)
    word = (np.cumsum(starts) - 1)[at]
    begin = np.flatnonzero(starts)
    back = at - begin[word] if len(at) else at  # symbols of the word before this one
    codes = symbols[at].astype(np.int64)
    for k in range(1, ORDER):
        earlier = symbols[np.maximum(at - k, 0)].astype(np.int64)
        codes |= np.where(back >= k, earlier, np.where(back == k - 1, START, 0)) << (8 * k)
    return codes, word, np.searchsorted(bounds, at, "right") - 1


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, which = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
    counts = np.concatenate([n for _, n in held], axis=1)
    return codes, np.stack([np.bincount(which, n, len(codes)).astype(np.int64) for n in counts])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (text, fold of its label or null: 0, 1 toxic, 2, 3 ordinary) to rows of code and COUNTS: the distinct
    n-grams of all texts, with their numbers in the labelled ones."""

    def rows(codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in np.array_split(np.arange(len(codes)), max(1, len(codes) // 50_000)):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (codes[at], *counts[:, at])], ["code", *COUNTS])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    passed = np.full(HELD, -1, np.int64)  # n-grams passed on, by hash: most are repeats, which need no sorting
    for batch in batches:
        kinds = np.array([-1 if k is None else k for k in batch.column(1).to_pylist()], np.int64)
        for first, texts in chunks(batch.column(0)):
            codes, _, text = ngrams(texts)
            at = hashed(codes, HELD)
            new = passed[at] != codes
            passed[at[new]] = codes[new]
            fresh, kind = np.unique(codes[new]), kinds[first + text]
            held.append((fresh, np.zeros((len(COUNTS), len(fresh)), np.int64)))
            for k in range(len(COUNTS)):
                own, n = np.unique(codes[kind == k], return_counts=True)
                counts = np.zeros((len(COUNTS), len(own)), np.int64)
                counts[k] = n
                held.append((own, counts))
            if sum(len(c) for c, _ in held) > HELD:
                held = [_merged(held)]
                if len(held[0][0]) > HELD // 2:
                    yield from rows(*held.pop())
    if held:
        yield from rows(*_merged(held))


def _drop_first(codes: np.ndarray) -> np.ndarray:
    """Codes without their first (highest) symbol."""
    size = np.zeros(len(codes), np.int64)
    for k in range(1, ORDER):
        size += codes >> (8 * k) > 0
    return codes & ((np.int64(1) << (8 * size)) - 1)


def discount(ones: int, twos: int) -> float:
    """What is taken off counts of which so many are 1 and 2."""
    return min(0.95, max(0.1, ones / (ones + 2 * twos)) if ones else 0.5)


def kneser_ney(codes: np.ndarray, counts: np.ndarray, lower: np.ndarray | None = None, off: float | None = None) -> np.ndarray:
    """Probability of each code's last symbol after the others; lower: that of the code without its first symbol,
    else from the continuation counts of these codes. A context without counts gives ``lower``. off: the discount,
    if more counts than these decide on it. All followers of a context must be among the codes."""
    if lower is None:
        rest = _drop_first(codes)
        shorter, which = np.unique(rest, return_inverse=True)
        single = codes >> 8 == 0
        lower = np.full(len(codes), 1 / 256)
        if not single.all():
            continued = np.bincount(which, ~single, len(shorter))
            own = continued > 0
            p = np.full(len(shorter), 1 / 256)
            p[own] = kneser_ney(shorter[own], continued[own])
            lower = np.where(single, lower, p[which])
    _, context = np.unique(codes >> 8, return_inverse=True)
    total, kinds = np.bincount(context, counts)[context], np.bincount(context, counts > 0)[context]
    off = discount((counts == 1).sum(), (counts == 2).sum()) if off is None else off
    seen = total > 0
    total = np.where(seen, total, 1)
    return np.where(seen, np.maximum(counts - off, 0) / total + off * kinds / total * lower, lower)


def _shorter(code: Column) -> Column:
    """``_drop_first`` of a column."""
    return F.coalesce(*(F.when(code >= F.lit(1 << 8 * k), code.bitwiseAND((1 << 8 * k) - 1)) for k in range(ORDER - 1, 0, -1)), F.lit(0).cast("long"))


def backoff(types: DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """types: code and COUNTS of every distinct n-gram of the corpus. Of those that labelled texts have, in order: code,
    shared backoff probability, and counts.

    The continuation counts of each order, and the sums over each context, are made from all n-grams of the next one; the
    driver gets those of the endings of labelled n-grams."""

    def fetched(rows: DataFrame) -> list[np.ndarray]:
        found = rows.toArrow()
        order = np.argsort(found.column("code").to_numpy())
        return [found.column(c).to_numpy()[order] for c in found.column_names]

    seen = types.where(sum(F.col(c) for c in COUNTS) > 0)
    codes, *counts = fetched(seen.select("code", *(F.col(c).cast("int") for c in COUNTS)))
    endings = lambda rows: rows.where(F.col("code") > 255).select(_shorter(F.col("code")).alias("code")).distinct()
    orders, longer, wanted = [], types, seen
    for _ in range(ORDER - 1):
        longer = longer.where(F.col("code") > 255).groupBy(_shorter(F.col("code")).alias("code")).agg(F.count("*").alias("n"))
        longer = written(longer, "orders")
        wanted = written(endings(wanted), "endings")
        one, two = longer.agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
        context = F.shiftright("code", 8).alias("context")
        contexts = wanted.select(context).distinct()
        totals = longer.select(context, "n").join(contexts, "context", "left_semi").groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        found = longer.join(wanted, "code").select("code", "n", context).join(totals, "context")
        orders.append((*fetched(found.select("code", *(F.col(c).cast("double") for c in ("n", "total", "kinds")))), discount(one, two)))
    known, p = np.zeros(0, np.int64), np.zeros(0)

    def lower(longer: np.ndarray) -> np.ndarray:
        out, several = np.full(len(longer), 1 / 256), longer > 255
        out[several] = p[np.searchsorted(known, _drop_first(longer[several]))]
        return out

    for order, n, total, kinds, off in reversed(orders):
        known, p = order, np.maximum(n - off, 0) / total + off * kinds / total * lower(order)
    return codes, lower(codes), counts


class Lookup:
    """Values by code, 0 for other codes: hashed tables, each with what had no place in the one before. A table has less than
    one slot a code and more than half of one, so all together have about one and a half."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.tables = []
        while len(codes):
            size = power_of_two(len(codes) / 2 + 1)
            keys, held = np.full(size, -1, np.int64), np.zeros(size, np.float32)
            at = hashed(codes, size)
            keys[at] = codes
            here = keys[at] == codes
            held[at[here]] = values[here]
            self.tables.append((keys, held))
            codes, values = codes[~here], values[~here]

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and the places of the codes that have none."""
        out, left = np.zeros(len(codes), np.float32), np.arange(len(codes))
        for keys, held in self.tables:
            at = hashed(codes[left], len(keys))
            here = keys[at] == codes[left]
            out[left[here]] = held[at[here]]
            left = left[~here]
        return out, left


def class_model(codes: np.ndarray, counts: np.ndarray, shared: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of each code, and of what the class leaves to the shared distribution after each context (sorted)."""
    p = np.log(np.maximum(kneser_ney(codes, counts, shared), 1e-12))
    context = np.searchsorted(contexts, codes >> 8)
    total, kinds = np.bincount(context, counts, len(contexts)), np.bincount(context, counts > 0, len(contexts))
    off = discount((counts == 1).sum(), (counts == 2).sum())
    return p, np.log(np.where(total > 0, off * kinds / np.maximum(total, 1), 1))


@dataclass
class Model:
    """Log-likelihood ratios (toxic to ordinary) of the n-grams of labelled texts and, for others, of their contexts, and the
    logistic function of the features."""

    ratio: Lookup
    context: Lookup
    weights: np.ndarray
    rate: float

    @classmethod
    def of(cls, codes: np.ndarray, shared: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> Model:
        contexts = np.unique(codes >> 8)
        (one, left_one), (two, left_two) = (class_model(codes, n.astype(float), shared, contexts) for n in (toxic, ordinary))
        return cls(Lookup(codes, one - two), Lookup(contexts, left_one - left_two), np.zeros(TOP + 2), 0.5)

    def ratios(self, codes: np.ndarray) -> np.ndarray:
        found, left = self.ratio.find(codes)
        found[left] = self.context.find(codes[left] >> 8)[0]
        return found

    def features(self, texts: list[str]) -> np.ndarray:
        """(log-likelihood ratio of the text by its length; the largest ratios of words by the root of theirs)."""
        out = np.zeros((len(texts), 1 + TOP))
        codes, word, text = ngrams(texts)
        if not len(codes):
            return out
        ratio = self.ratios(codes)
        out[:, 0] = np.bincount(text, ratio, len(texts)) / np.maximum(np.bincount(text, minlength=len(texts)), 1)
        size = np.bincount(word)
        words = np.bincount(word, ratio) / np.sqrt(size)
        text_of = text[np.concatenate([[0], np.cumsum(size)[:-1]])]
        order = np.lexsort((words, text_of))
        last = np.cumsum(np.bincount(text_of, minlength=len(texts)))
        first = last - np.bincount(text_of, minlength=len(texts))
        for k in range(TOP):
            there = last - 1 - k >= first
            out[there, 1 + k] = words[order[last[there] - 1 - k]]
        return out

    def inputs(self, features: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(features)), features])

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(features), self.rate)
        return 1 / (1 + np.exp(-np.clip(self.inputs(features) @ self.weights, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression (Newton's method); the inputs are scaled within."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1
    z, w = x / scale, np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (y - p) / len(y) - ridge * w * (np.arange(len(w)) > 0)
        curve = (z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -3, 3)
    return w / scale


def _sampled(known: DataFrame, share: float) -> DataFrame:
    """About that share of the rows, by the hash of the id; a smaller share's rows are among a larger one's."""
    return known if share >= 1 else known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(1e6 * share))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, max_labelled_chars: int = 32_000_000) -> Model:
    """docs: doc_id, text. labels: doc_id and label (0, 1), the rows to learn from.

    Labels that a doc_id repeats count once (label 1 wins); null ids and labels do not count. Above max_labelled
    labels, or max_labelled_chars characters of their texts, a fixed sample of about so many (by the hash of the id) is
    used: it bounds the model, which the driver and every executor hold, by one n-gram a character. The shared counts come
    from all docs in any case. Without rows of both classes scores are the same for all texts.
    """
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    n = known.count()
    share = min(1.0, max_labelled / max(1, n))
    sizes = docs.select("doc_id", F.length("text").alias("n")).join(F.broadcast(_sampled(known, share)), "doc_id")
    chars = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    known = _sampled(known, share * min(1.0, max_labelled_chars / max(1, chars)))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    known = known.select("doc_id", (F.when(F.col("label") == 1, F.lit(0)).otherwise(2) + fold).alias("kind"))
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id", "left").select("text", "kind")
    counted = texts.mapInArrow(_count, "code long, " + ", ".join(f"{c} long" for c in COUNTS))
    types = written(counted.groupBy("code").agg(*(F.sum(c).alias(c) for c in COUNTS)), "types")
    codes, shared, (t0, t1, o0, o1) = backoff(types)
    model = Model.of(codes, shared, t0 + t1, o0 + o1)
    labelled, schema = texts.where("kind is not null"), "kind long, " + ", ".join(f"f{i} double" for i in range(TOP + 1))

    def calibrate(sent: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, chunk in chunks(batch.column(0)):
                    columns = [batch.column(1).slice(first, len(chunk)), *map(pa.array, sent.value.features(chunk).T)]
                    yield pa.RecordBatch.from_arrays(columns, ["kind", *(f"f{i}" for i in range(TOP + 1))])

        return run

    tables = []
    for fold, own in enumerate(((t1, o1), (t0, o0))):  # rows of a fold by the model of the other one; executors hold one at a time
        sent = docs.sparkSession.sparkContext.broadcast(Model.of(codes, shared, *own))
        rows = labelled.where(F.col("kind") % 2 == fold).select("text", F.col("kind").cast("long"))
        tables.append(rows.mapInArrow(calibrate(sent), schema).toArrow())
        sent.destroy()
    seen = pa.concat_tables(tables)
    toxic = seen.column("kind").to_numpy() < 2
    model.rate = float((toxic.sum() + 0.5) / (len(toxic) + 1))
    if toxic.any() and not toxic.all():
        features = np.column_stack([seen.column(f"f{i}").to_numpy() for i in range(TOP + 1)])
        model.weights = logistic(model.inputs(features), toxic.astype(float))
    return model


def score(docs: DataFrame, model: Model, columns: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """columns of docs (as they are; default: all but the text) with score and log_ratio (toxic to ordinary, a letter).

    Null and empty texts have ratio 0 and the score of a text without words. The text may be among the columns; only
    texts go to Python, and only two numbers for each come back. columns must not be called like the two added ones.
    """
    columns = [c for c in docs.columns if c != text_col] if columns is None else columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<score: double, log_ratio: double>")
    def judged(texts: pa.Array) -> pa.Array:
        own = shared.value
        parts = [own.features(chunk) for _, chunk in chunks(texts)]
        features = np.concatenate([np.zeros((0, 1 + TOP)), *parts])
        return pa.StructArray.from_arrays([pa.array(own.scores(features)), pa.array(features[:, 0])], ["score", "log_ratio"])

    name = spare_name(docs.columns, "judged")
    scored = docs.withColumn(name, judged(F.col(f"`{text_col}`").cast("string")))
    return scored.select(*(F.col(f"`{c}`") for c in columns), f"{name}.score", f"{name}.log_ratio")


def held_out(doc_id: str = "doc_id", folds: int = 3, fold: int = 1):
    """Whether crc32(doc_id as text) mod folds is ``fold``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **bounds: int) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted, log_ratio.

    docs: doc_id, text; labels: doc_id, toxic. Labels of held-out rows are not read. See ``fit`` for nulls,
    repeated rows and bounds. No rows: no rows.
    """
    model = fit(docs, labels.where(~held_out()).select("doc_id", F.col("toxic").alias("label")), **bounds)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "log_ratio")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **bounds: int) -> DataFrame:
    """docs without the rows that score ``threshold`` or more, all columns as they were."""
    model = fit(docs, labels.where(~held_out()).select("doc_id", F.col("toxic").alias("label")), **bounds)
    renamed = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    scored = score(renamed, model, renamed.columns, f"c{docs.columns.index('text')}")
    return scored.where(F.col("score") < threshold).drop("score", "log_ratio").toDF(*docs.columns)
