"""Jaccard join of word shingles by R-trees over count vectors.

A document's set is its distinct k-word shingles. Documents link when the Jaccard similarity of their sets is
``percent`` or more; the result is the connected components. Nothing is approximate.

1. Each document becomes its set's 64-bit identity, its size and its count vector. Equal sets are one node from here
   on, however many documents have them.
2. Sets of similarity t share a hash among the first floor((1 - t) n) + 1 of each, in whatever order all sets agree on.
   The order here: hashes of a fixed share of all that only one set has, then the others, by value. Which they are is
   counted over all documents and kept as a bitmap of bounded size (beyond the bound every hash counts as common). A
   hash of these prefixes that different sets share makes a block; most documents are in none. Within a block, each set
   is first paired with the smallest one: near copies come together by a star instead of by all their pairs.
3. What is left are blocks whose sets lie in different components. Their sets' count vectors (hashes counted in
   ``GROUPS`` groups, a point for each set) are indexed in R-trees, of bounded size: large blocks are split and the
   parts meet in pairs. A node is skipped if the sum of the coordinate minima of the query and the node's upper corner,
   which bounds the overlap, is too small, or if all its sets are in the query's component. A pair comes from the block
   of its first common hash alone, whose places in the two orders bound the overlap once more.
4. Pairs whose own minima allow the similarity are verified with the sets themselves; components are joined by large
   and small stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_of, power_of_two, written

GROUPS = 256
MOST = 0xFFFF  # of a count; a set with a larger one has this in all groups, which bounds nothing too low
CHUNK = 1 << 19
#: Hashes below this are looked at for whether one set alone has them.
SAMPLED = np.uint64(int(0.32 * 2**64))
BLOCK_BITS = 32768
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, modulo 2**64, as far as they have been needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = power_of_two(n)
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("up", _BASE), ("down", inverse)):
                powers = np.full(size, np.uint64(base), np.uint64)
                powers[0] = 1
                setattr(cls, name, np.multiply.accumulate(powers))
        return cls.up, cls.down


def shingles(texts: list[str], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct k-word shingles of the texts, in that order. A-Z are lower-cased; words are
    separated by ASCII white space. A text with fewer than k words has one shingle, the whole sequence; none without."""
    parts = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    raw = np.frombuffer(b" " + b" ".join(parts) + b" ", np.uint8)
    space = _SPACE[raw]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = _Powers.get(len(raw) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)])])
    words = _mix((sums[ends] - sums[starts]) * down[starts])
    bounds = np.cumsum([1] + [len(p) + 1 for p in parts])
    text = np.searchsorted(bounds, starts, "right") - 1
    count = np.bincount(text, minlength=len(texts))
    n = len(words)
    last = np.cumsum(count)[text]  # one past the text's last word
    size = np.minimum(count[text], k)
    at = np.flatnonzero(np.arange(n) + size <= last)
    at = at[(count[text[at]] >= k) | (at == last[at] - size[at])]
    found = size[at].astype(np.uint64)
    for j in range(k):
        inside = j < size[at]
        word = words[np.minimum(at + j, n - 1)]
        found = np.where(inside, _mix(found * np.uint64(31) + word + np.uint64(j)), found)
    text = text[at]
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
    return text[new], found[new]


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= CHUNK:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def _sets(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash) of the texts' shingles; size, start and identity of each text's set."""
    text, found = shingles(texts, k)
    n = np.bincount(text, minlength=len(texts))
    start = np.cumsum(n) - n
    sums = np.zeros(len(texts), np.uint64)
    if len(found):
        sums[n > 0] = np.add.reduceat(_mix(found + np.uint64(0x632BE59BD9B4E019)), start[n > 0])
    return text, found, n, start, _mix(sums + n.astype(np.uint64) * np.uint64(_BASE)).view(np.int64)


def _summaries(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _chunks(batch.column(1)):
                text, found, n, _, sets = _sets(texts, k)
                vectors = np.bincount(text * GROUPS + (found & np.uint64(GROUPS - 1)).astype(np.int64), minlength=len(texts) * GROUPS).reshape(-1, GROUPS)
                vectors[vectors.max(axis=1) > MOST] = MOST
                columns = [batch.column(i).slice(first, len(texts)) for i in (0, 2)]
                columns += [pa.array(sets), pa.array(n.astype(np.int64)), pa.array([v.tobytes() for v in vectors.astype("<u2")], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "set_id", "n", "vector"])

    return run


def summaries(docs: DataFrame, k: int) -> DataFrame:
    """docs (doc_id, text) to doc_id, text_key (its hash), set_id, n, vector."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return keyed.mapInArrow(_summaries(k), "doc_id long, text_key long, set_id long, n long, vector binary")


def tokens(docs: DataFrame, k: int, percent: int, bitmap: np.ndarray | None = None) -> DataFrame:
    """docs (text) to token, set_id, place. Without a bitmap: the sampled hashes of every set. With that of the hashes that
    several sets have: those of them that are in the set's prefix, with their place (from 0) in the agreed order."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for _, texts in _chunks(batch.column(0)):
                text, found, n, start, sets = _sets(texts, k)
                if bits is None:
                    kept = found < SAMPLED
                    place = np.zeros(len(found), np.int64)
                else:
                    # in the agreed order a text's own hashes come first; what they leave of its prefix is filled by value
                    own = (found < SAMPLED) & ~_in_bitmap(bits, found)
                    prefix = n - -(-n * percent // 100) + 1
                    alone = np.bincount(text, own, len(texts)).astype(np.int64)
                    others = np.cumsum(~own)  # of all texts so far
                    place = alone[text] + others - np.concatenate([[0], others])[start][text] - 1
                    kept = ~own & (place < prefix[text])
                columns = [pa.array(found[kept].view(np.int64)), pa.array(sets[text[kept]]), pa.array(place[kept])]
                yield pa.RecordBatch.from_arrays(columns, ["token", "set_id", "place"])

    return docs.select("text").mapInArrow(run, "token long, set_id long, place long")


def _in_bitmap(bits: np.ndarray, found: np.ndarray) -> np.ndarray:
    at = ((found >> np.uint64(15)) & np.uint64(len(bits) * 8 // BLOCK_BITS - 1)) * np.uint64(BLOCK_BITS) + (found & np.uint64(BLOCK_BITS - 1))
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def common_bitmap(shared: DataFrame, n: int, max_mb: int) -> np.ndarray:
    """Bitmap of the tokens (token: n distinct ones), 16 bits each; all ones if that is more than max_mb."""
    blocks = power_of_two(n * 16 / BLOCK_BITS)
    if blocks * (BLOCK_BITS // 8) > max_mb << 20:
        return np.full(BLOCK_BITS // 8, 255, np.uint8)
    block = F.shiftrightunsigned("token", 15).bitwiseAND(blocks - 1)
    parts = shared.select(block.alias("block"), F.col("token").bitwiseAND(BLOCK_BITS - 1).alias("bit")).repartition("block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)
    for part in parts.toLocalIterator():  # max_mb in all
        out[part.block] = np.frombuffer(bytes(part.bits), np.uint8)
    return out.ravel()


def _slot(key: Column, bits: int) -> tuple[Column, Column]:
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    return F.floor(slot / BLOCK_BITS), slot % BLOCK_BITS


def with_known(rows: DataFrame, key: str, known: DataFrame, name: str, max_mb: int = 64) -> DataFrame:
    """rows with a boolean column ``name``: false only if the key is surely not in ``known`` (one column).

    A bitmap of 16 bits a known key, broadcast; above max_mb everything is true. It only saves shuffling: an exact join
    of the rows that it leaves follows."""
    blocks = max(1, power_of_two(known.count() * 16 / BLOCK_BITS))
    if blocks * 4096 > max_mb << 20:
        return rows.withColumn(name, F.lit(True))
    column = known.columns[0]
    block, bit = _slot(F.col(column), blocks * BLOCK_BITS)
    bitmap = known.select(block.alias("known_block"), bit.alias("bit")).repartition("known_block").groupBy("known_block").agg(F.bitmap_construct_agg("bit").alias("known_bits"))
    at, own = _slot(F.col(key), blocks * BLOCK_BITS)
    joined = rows.withColumn("known_block", at).join(F.broadcast(bitmap), "known_block", "left")
    return joined.select(*rows.columns, F.coalesce(bit_of(F.col("known_bits"), own), F.lit(False)).alias(name))


def keep_known(rows: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """rows without most of those whose key is not in ``known``, none of whose rows are lost."""
    return with_known(rows, key, known, "is_known").where("is_known").drop("is_known")


def _similar(overlap: Column | np.ndarray, total: Column | np.ndarray, percent: int):
    """overlap / (total - overlap) >= percent / 100."""
    return overlap * (100 + percent) >= total * percent


def _pair_bound(percent: int):
    """Keep the pairs (a, b, n_a, vector_a, n_b, vector_b) whose sum of minima allows the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, GROUPS) for i in (3, 5))
                total = batch.column(2).to_numpy() + batch.column(4).to_numpy()
                able = _similar(np.minimum(one, two).sum(axis=1, dtype=np.int64), total, percent)
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(able)) for i in (0, 1)], ["a", "b"])

    return run


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b: set ids, distinct) that are similar. sets: set_id, n, vector, text_key of a text that
    has the set; docs: text."""
    side = lambda c: sets.select(F.col("set_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("vector").alias(f"vector_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where((F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent))
    able = written(both.select("a", "b", "n_a", "vector_a", "n_b", "vector_b").mapInArrow(_pair_bound(percent), "a long, b long"), "able")
    wanted = able.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    rows = written(sets.select("set_id", "text_key").join(wanted, "set_id"), "wanted")
    keyed = docs.select(F.xxhash64("text").alias("text_key"), "text")
    copies = keep_known(keyed, "text_key", rows.select("text_key")).groupBy("text_key").agg(F.first("text").alias("text"))
    texts = written(copies.join(rows, "text_key").select("set_id", "text"), "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in batches:
            similar = []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                text = one.as_py() or ""
                if text != last[0]:
                    last = text, shingles([text], k)[1]
                other = shingles([two.as_py() or ""], k)[1]
                overlap = len(np.intersect1d(last[1], other, assume_unique=True))
                similar.append(bool(_similar(overlap, len(last[1]) + len(other), percent)))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(similar, pa.bool_())) for i in (0, 1)], ["a", "b"])

    text = lambda c: texts.select(F.col("set_id").alias(c), F.col("text").alias(f"text_{c}"))
    full = able.join(text("b"), "b").join(text("a"), "a")
    return full.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of the edges (a, b), label being the smallest node of its component: alternating
    large and small stars, each a grouping by node with map-side minima; a hot node is one row of minima, not a group."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        around = now.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(now.select(F.col("u").alias("x"), F.col("v").alias("y")))
        least = written(around.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m")), "least")
        large = around.where("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u"))
        # small star: every node's smaller neighbours, and the node, point to the smallest of them
        large = written(large.where("v <> u").distinct(), "large")
        lowest = written(large.groupBy("v").agg(F.min("u").alias("m")), "lowest")
        small = large.join(lowest, "v").select(F.explode(F.array(F.struct(F.col("v").alias("v"), F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e"))
        after = written(small.select("e.*").where("v <> u").distinct(), "edges")
        seen, state = state, after.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u"))).first()
        now = after
        if state == seen:
            break
    else:
        raise ValueError("the components did not settle")
    labels = now.groupBy("v").agg(F.min("u").alias("label")).select(F.col("v").alias("node"), "label")
    return written(labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct()), "labels")


class CountTree:
    """R-tree over count vectors, packed by total and then by the coordinate that spreads most."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, labels: np.ndarray, leaf: int = 32):
        self.vectors, self.sizes, self.labels, self.leaf = vectors, sizes, labels, leaf
        self.nodes: list[tuple] = []
        self._node(np.argsort(sizes, kind="stable"))

    def _node(self, rows: np.ndarray) -> int:
        me, own = len(self.nodes), self.vectors[rows]
        labels = self.labels[rows]
        self.nodes.append((own.max(axis=0), int(self.sizes[rows].min()), labels[0] if (labels == labels[0]).all() else None, rows, None, None))
        if len(rows) > self.leaf:
            spread = own.max(axis=0) - own.min(axis=0)
            by_size = self.sizes[rows].max() > 1.25 * self.sizes[rows].min()
            order = np.argsort(self.sizes[rows] if by_size else own[:, spread.argmax()], kind="stable")
            half = len(rows) // 2
            kids = self._node(rows[order[:half]]), self._node(rows[order[half:]])
            self.nodes[me] = (*self.nodes[me][:3], None, *kids)
        return me

    def partners(self, vector: np.ndarray, size: int, label: int, percent: int) -> np.ndarray:
        """Rows of another label whose sum of minima with the vector allows the similarity."""
        found, stack = [], [0]
        while stack:
            upper, least, only, rows, left, right = self.nodes[stack.pop()]
            if only == label or not _similar(int(np.minimum(upper, vector).sum(dtype=np.int64)), size + least, percent):
                continue
            if rows is None:
                stack += (left, right)
            else:
                able = _similar(np.minimum(self.vectors[rows], vector).sum(axis=1, dtype=np.int64), size + self.sizes[rows], percent)
                found.append(rows[able & (self.labels[rows] != label)])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def _tree_join(percent: int):
    """Rows (token, i, j, part, set_id, n, label, place, earlier, vector), sorted by token, i, j, to pairs a < b of
    candidates: part i against part j, or one part (i = j) within itself. earlier: the set's block tokens before this."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def candidates(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if len(one) * len(two) <= 256:  # one leaf against another
                minima = np.minimum(vectors[one][:, None], vectors[two][None]).sum(axis=2, dtype=np.int64)
                x, y = np.nonzero(_similar(minima, sizes[one][:, None] + sizes[two][None], percent) & (labels[one][:, None] != labels[two][None]))
                return one[x], two[y]
            tree = CountTree(vectors[two], sizes[two], labels[two])
            hits = [two[tree.partners(vectors[q], int(sizes[q]), int(labels[q]), percent)] for q in one]
            return np.repeat(one, [len(h) for h in hits]), np.concatenate(hits)

        def join(rows: list[tuple]) -> np.ndarray:
            i, j, part, ids, sizes, labels, places, vectors = (np.concatenate(c) for c in list(zip(*rows, strict=True))[:-1])
            earlier = [set(tokens) for row in rows for tokens in row[-1]]
            one, two = np.flatnonzero(part == i[0]), np.flatnonzero(part == j[0])
            if not len(one) or not len(two) or (labels == labels[0]).all():
                return np.zeros((0, 2), np.int64)
            x, y = candidates(one, two, sizes, labels, vectors)
            able = _similar(np.minimum(sizes[x] - places[x], sizes[y] - places[y]), sizes[x] + sizes[y], percent)
            if i[0] == j[0]:
                able &= ids[x] < ids[y]
            pairs = [(ids[a], ids[b]) for a, b in zip(x[able].tolist(), y[able].tolist(), strict=True) if earlier[a].isdisjoint(earlier[b])]
            return np.sort(np.array(pairs, np.int64).reshape(-1, 2), axis=1)

        def batch_of(out: list[np.ndarray]) -> pa.RecordBatch:
            pairs = np.concatenate(out)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        key, rows = None, []
        out: list[np.ndarray] = []
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(8)]
            vectors = np.frombuffer(b"".join(batch.column(9).to_pylist()), "<u2").reshape(-1, GROUPS)
            earlier = batch.column(8).to_pylist()
            keys = np.column_stack(columns[:3])
            cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if start == end:
                    continue
                if tuple(keys[start]) != key and rows:
                    out.append(join(rows))
                    rows = []
                key = tuple(keys[start])
                rows.append((*(c[start:end] for c in columns[1:]), vectors[start:end], earlier[start:end]))
            if sum(map(len, out)) > 20_000:
                yield batch_of(out)
                out = []
        if rows:
            out.append(join(rows))
        if out:
            yield batch_of(out)

    return run


def _between_components(members: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, part_rows: int) -> DataFrame:
    """Candidate pairs of sets of different components that share a block. members: token, set_id, place."""
    known = sets.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").select("set_id", "n", "vector", F.coalesce("label", "set_id").alias("label"))
    known = written(known, "known")
    labelled = written(members.join(known.select("set_id", "label"), "set_id").select("token", "set_id", "place", "label"), "labelled")
    same = [F.count("*").alias("size"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("x"), F.bit_xor(F.xxhash64("set_id", F.lit(2))).alias("y")]
    mixed = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), *same).where("low <> high")
    # blocks of the same sets: the first of them is enough. Hashes are in the order of unsigned numbers
    unsigned = lambda token: token.bitwiseXOR(F.lit(-(1 << 63)))
    mixed = mixed.groupBy("size", "x", "y").agg(F.min_by("token", unsigned(F.col("token"))).alias("token"))
    parts = written(mixed.select("token", F.ceil(F.col("size") / part_rows).cast("int").alias("parts")), "mixed")
    rows = keep_known(labelled, "token", parts.select("token")).join(parts, "token").withColumn("part", F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    dealt = rows.select("token", "set_id", "place", "part", other).select("token", F.least("part", "other").cast("long").alias("i"), F.greatest("part", "other").cast("long").alias("j"), F.col("part").cast("long").alias("part"), "set_id", "place")
    blocks_of = written(labelled.groupBy("set_id").agg(F.collect_list("token").alias("tokens")), "blocks_of")
    full = dealt.join(known, "set_id").join(blocks_of, "set_id")
    earlier = F.filter("tokens", lambda t: unsigned(t) < unsigned(F.col("token")))
    full = full.select("token", "i", "j", "part", "set_id", "n", "label", "place", earlier.alias("earlier"), "vector")
    return full.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(_tree_join(percent), "a long, b long")


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, part_rows: int = 512, max_bitmap_mb: int = 64) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, class_id, text_key.

    Documents with k-word shingle sets of a Jaccard similarity of percent / 100 or more link; component_id is the
    smallest doc_id of those that links lead to, the document itself included; class_id numbers the components (null
    without shingles), and text_key is the text's hash. Null and empty texts, and texts of
    white space, have no shingles and link with nothing. A null id is passed over for a smaller one if its component
    has any, else component_id is null; repeated rows are in one component. Other columns are not read; no rows: none.
    """
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    read = written(summaries(slim, k), "summaries")
    linked = read.where("n > 0")
    sets = written(linked.groupBy("set_id").agg(*(F.first(c).alias(c) for c in ("n", "vector", "text_key")), F.min("doc_id").alias("doc_id")), "sets")
    several = lambda t: t.groupBy("token").agg(F.min("set_id").alias("pivot"), F.max("set_id").alias("last")).where("pivot <> last")
    common = written(several(tokens(slim, k, percent)).select("token"), "common")
    keys = written(tokens(slim, k, percent, common_bitmap(common, common.count(), max_bitmap_mb)).distinct(), "keys")
    blocks = written(several(keys).select("token", "pivot"), "blocks")
    members = written(keep_known(keys, "token", blocks.select("token")).join(blocks, "token"), "members")

    stars = members.where("set_id <> pivot").select(F.col("pivot").alias("a"), F.col("set_id").alias("b")).distinct()
    edges = written(verified(stars, sets, slim, k, percent), "links")
    labels = components(edges)
    others = _between_components(members.select("token", "set_id", "place"), sets, labels, percent, part_rows)
    more = written(verified(others, sets, slim, k, percent), "links")
    if more.limit(1).count():
        labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))

    owned = sets.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").select("set_id", "doc_id", F.coalesce("label", "set_id").alias("label"))
    owned = written(owned, "owned")
    smallest = written(owned.groupBy("label").agg(F.min("doc_id").alias("component_id")), "smallest")
    component = written(owned.join(smallest, "label").select("set_id", "component_id", F.col("label").alias("class_id")), "component")
    shown = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "class_id", "text_key"]
    alone = read.where("n = 0").withColumns({"component_id": F.col("doc_id"), "class_id": F.lit(None).cast("long")}).select(*shown)
    return linked.select("doc_id", "n", "set_id", "text_key").join(component, "set_id").select(*shown).unionByName(alone)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """docs with one row of each component of ``join_components``, all columns as they were: that of the smallest id, null
    ids last (of several with that id, the one whose columns have the smallest hash). Rows without shingles stay.

    Rows alone in their component pass without a shuffle; the others are reduced to one a component, in each task first.
    """
    columns = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    id_, text = (F.col(f"c{columns.index(c)}") for c in (id_col, text_col))
    found = join_components(docs, id_col, text_col, **options)
    several = written(found.where("class_id is not null").groupBy("class_id").agg(F.count("*").alias("rows")).where("rows > 1").select("class_id"), "several")
    grouped = found.join(several, "class_id").select(F.xxhash64("doc_id", "text_key").alias("row_key"), "class_id").distinct()
    grouped = written(grouped, "grouped")
    keyed = plain.withColumn("row_key", F.xxhash64(id_.cast("long"), F.xxhash64(text)))
    marked = with_known(keyed, "row_key", grouped.select("row_key"), "maybe")
    own = [F.col(c) for c in plain.columns]
    joined = marked.where("maybe").join(grouped, "row_key", "left")
    order = F.struct(id_.isNull(), id_, F.xxhash64(*own))
    best = joined.where("class_id is not null").groupBy("class_id").agg(F.min_by(F.struct(*own), order).alias("row")).select("row.*")
    alone = marked.where("not maybe").select(*own).unionByName(joined.where("class_id is null").select(*own))
    return alone.unionByName(best).toDF(*columns)
