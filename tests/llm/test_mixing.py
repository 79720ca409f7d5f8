import math
import random
from fractions import Fraction

import pytest

from sitecensus.llm import mixing

from sample_rows import DOCS


def test_pattern_deviates_by_less_than_one_block():
    for share in ({"a": 5, "b": 3, "c": 2}, {"a": 1, "b": 1, "c": 7, "d": 8}, mixing.shares({f"s{i}": i + 0.3 for i in range(9)}, 1000)):
        period, had = sum(share.values()), dict.fromkeys(share, 0)
        for t, source in enumerate(mixing.pfair_pattern(share), 1):
            had[source] += 1
            assert all(abs(Fraction(share[s] * t, period) - had[s]) < 1 for s in share)
        assert had == share


def test_schedule(spark):
    rows = [(i, "t", "en", "big" if i % 3 else "small", 1) for i in range(3000)]
    frame = spark.createDataFrame(rows, DOCS).repartition(5)
    got = mixing.schedule(frame, {"big": 2.0, "small": 1.0}, block_docs=10, period=30).collect()
    assert len(got) == 3000
    for source, step in (("big", 2), ("small", 1)):
        own = sorted((r for r in got if r.source == source), key=lambda r: r.doc_id)
        assert [r.source_rank for r in own] == list(range(1000 * step))
        assert all(r.block == r.source_rank // 10 and r.release <= r.slot < r.deadline for r in own)
    slots = {(r.slot, r.source) for r in got}
    assert sorted(s for s, _ in slots) == list(range(300))


def test_edge_cases(docs, no_docs, spark):
    weights = mixing.target_weights(docs)
    assert set(weights) == {"", "s1", "s2", "s3"}
    assert mixing.schedule(docs, weights).count() == docs.count()
    mixed = mixing.interleave(docs, weights)
    assert mixed.columns == docs.columns and sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))
    assert mixing.schedule(no_docs, mixing.target_weights(no_docs)).count() == 0
    assert mixing.interleave(no_docs, {}).count() == 0
    with pytest.raises(Exception, match="no weight"):
        mixing.schedule(docs, {"s1": 1.0}).collect()


def test_interleave_is_in_schedule_order(spark):
    rows = [(i, "t", "en", f"s{i % 4 % 3}", 1) for i in range(400)]
    frame = spark.createDataFrame(rows, DOCS)
    weights = {"s0": 3.0, "s1": 1.0, "s2": 1.0}
    slot = {r.doc_id: (r.slot, r.source_rank) for r in mixing.schedule(frame, weights, block_docs=4, period=50).collect()}
    order = [slot[r.doc_id] for r in mixing.interleave(frame, weights, block_docs=4, period=50).collect()]
    assert order == sorted(order)


def test_schedule_follows_the_weights_themselves(spark):
    few = {"hot": 7.0} | {f"s{i}": 2.0 for i in range(7)}  # a third, as the others' shares do not divide a period
    many = {"hot": 500.0} | {f"s{i:04}": 1.0 for i in range(1000)}
    for weights, blocks in ((few, 1500), (many, 600)):
        names = ["hot"] * blocks + [s for s in weights if s != "hot"] * (-(-3 * blocks // (2 * len(weights))) + 1)
        frame = spark.createDataFrame([(i, "t", "en", s, 1) for i, s in enumerate(names)], DOCS)
        got = mixing.schedule(frame, weights, block_docs=1).collect()
        assert len(got) == len(names) and len({r.slot for r in got}) == len(got)
        total = sum(map(Fraction, weights.values()))
        for r in got:  # the number of the source's blocks before and after its slot
            asked = [Fraction(weights[r.source]) / total * t for t in (r.slot, r.slot + 1)]
            assert abs(r.source_rank - asked[0]) < 1 and abs(r.source_rank + 1 - asked[1]) < 1


def test_whole_schedule_matches_a_plain_one_on_sparse_ids(spark):
    """Every column of every row, against slots found by trying all sources one after the other."""
    rng = random.Random(5)
    weights = {"a": 2.0, "b": 1.0, "c": 1 / 3, "d": math.sqrt(2)}
    ids = [rng.randrange(-(2**63), 2**63) for _ in range(700)] + list(range(300))
    rows = [(i, "t", "en", rng.choice("aabcd"), 1) for i in ids]
    got = {r.doc_id: tuple(r)[1:] for r in mixing.schedule(spark.createDataFrame(rows, DOCS).repartition(6), weights, block_docs=3).collect()}
    total, wanted, slot = sum(map(Fraction, weights.values())), {}, 0
    own = {s: sorted(i for i, _, _, source, _ in rows if source == s) for s in weights}
    at = dict.fromkeys(weights, 0)
    while any(3 * at[s] < len(own[s]) for s in weights):
        gap = {s: total / Fraction(w) for s, w in weights.items()}
        able = [(math.ceil((at[s] + 1) * gap[s]), s) for s in weights if 3 * at[s] < len(own[s]) and math.floor(at[s] * gap[s]) <= slot]
        if able:
            due, s = min(able)
            for rank in range(3 * at[s], min(3 * at[s] + 3, len(own[s]))):
                wanted[own[s][rank]] = s, rank, at[s], math.floor(at[s] * gap[s]), due, slot
            at[s] += 1
        slot += 1
    assert got == wanted


def test_deviation_stays_below_one_block_for_100_periods():
    for weights in ({"a": 2.0, "b": 1.0}, {"a": 1 / 3, "b": 2 / 3}, {"a": math.pi, "b": math.sqrt(2), "c": 1e-3}):
        total, had = sum(map(Fraction, weights.values())), dict.fromkeys(weights, 0)
        blocks = {s: int(100_000 * w / float(total)) + 1 for s, w in weights.items()}
        for source, block, _, _, slot in mixing.pfair(weights, blocks):
            had[source] = block + 1
            if all(had[s] < blocks[s] for s in weights):
                assert all(abs(Fraction(w) / total * (slot + 1) - had[s]) < 1 for s, w in weights.items())
            else:
                break
        assert sum(had.values()) > 90_000


def test_file_order_is_the_written_order(spark, tmp_path, docs):
    rows = [(i, "t" * (i % 50), "en", f"s{i % 4 % 3}", i) for i in range(2000)]
    frame = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "mix_row")
    mixed = mixing.interleave(frame, {"s0": 3.0, "s1": 1.0, "s2": 1.0}, block_docs=4).collect()
    parts = 7
    ordered = spark.createDataFrame([(n, *r) for n, r in enumerate(mixed)], "n long, " + DOCS.replace("lang", "mix_row")).repartitionByRange(parts, "n").sortWithinPartitions("n").drop("n")
    ordered.write.option("maxRecordsPerFile", 100_000).parquet(f"{tmp_path}/mixed")
    read = spark.read.parquet(f"{tmp_path}/mixed")
    assert read.inputFiles() and mixing.in_file_order(read).columns == read.columns
    assert mixing.in_file_order(read).collect() == mixed
    with pytest.raises(Exception, match="_metadata"):
        mixing.in_file_order(docs).collect()
