"""Held-out accuracy on the supplied labels, the models' parts against plain versions, and edge cases."""

import os

import numpy as np
import pytest

from sitecensus.llm import quality, toxicity

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def judged(scored, labels, column):
    known = {r.doc_id: r[column] for r in labels.collect()}
    return [(r.score, r.predicted, known[r.doc_id]) for r in scored.where("held_out").collect() if r.doc_id in known]


def auc(rows):
    ones, zeros = [s for s, _, y in rows if y], [s for s, _, y in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))


def test_toxicity_on_held_out_rows(spark):
    docs, labels = tables(spark)
    scored = toxicity.toxicity(docs, labels)
    assert scored.count() == docs.count()
    rows = judged(scored, labels, "toxic")
    assert auc(rows) > 0.85
    assert sum(p for _, p, y in rows if not y) <= 1  # clean documents are left alone


def test_quality_on_held_out_rows(spark):
    docs, labels = tables(spark)
    rows = judged(quality.quality(docs, labels), labels, "quality")
    assert auc(rows) > 0.95
    assert sum(not p for _, p, y in rows if y) <= 1


def test_held_out_labels_are_not_read(spark):
    docs, labels = tables(spark)
    turned = labels.withColumn("toxic", 1 - labels.toxic).where(toxicity.held_out()).unionByName(labels.where(~toxicity.held_out()))
    one, two = ({r.doc_id: r.score for r in toxicity.toxicity(docs, x).collect()} for x in (labels, turned))
    assert one == two


@pytest.mark.parametrize("call", [lambda d, x: toxicity.toxicity(d, x.withColumnRenamed("label", "toxic")), lambda d, x: quality.quality(d, x.withColumnRenamed("label", "quality"))])
def test_edge_cases(spark, docs, no_docs, call):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)] + [(1, 0), (None, 1), (3, None)], "doc_id long, label int")
    rows = call(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_text[3]) == 1 and len(by_text[None]) == 1
    assert call(no_docs, labels).count() == 0
    assert len({r.score for r in call(docs, labels.where("false")).collect()}) == 1


def test_drop_toxic_keeps_columns(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_probabilities_add_up_to_one():
    texts = ["abba abc", "cab a bad", "dab"]
    codes, _, _ = toxicity.ngrams(texts)
    seen, counts = np.unique(codes, return_counts=True)
    p = toxicity.kneser_ney(seen, counts.astype(float))
    assert (p > 0).all() and (p <= 1).all()
    for context in np.unique(seen >> 8):
        total = p[seen >> 8 == context].sum()
        assert total <= 1 + 1e-9  # the rest is for letters not seen after it


def test_symbols_are_exact():
    texts = ["né ña", "世界 世", "𝒳𝒴 a", "a\u3000b", ""]
    codes, word, text = toxicity.ngrams(texts)
    wanted = []
    for i, t in enumerate(texts):
        for w in t.split():
            symbols = [*w.encode(), toxicity.END]
            for k, x in enumerate(symbols):
                back = ([toxicity.START, *symbols[:k]])[-(toxicity.ORDER - 1) :]
                wanted.append((sum(b << (8 * j) for j, b in enumerate([x, *reversed(back)])), i))
    assert list(zip(codes.tolist(), text.tolist(), strict=True)) == wanted
    assert word.max() + 1 == 8
    assert toxicity.ngrams(["世"])[0][-1] != toxicity.ngrams(["丗"])[0][-1]


def test_backoff_and_scores_equal_the_plain_recursion(spark):
    texts = ["abba abc no", "cab a bad", "dab nab an", "abbacab cabbage zzz", None, "", "ßé 世界 cab"]
    kinds = [0, 2, None, 3, 1, None, None]
    codes, word, text = toxicity.ngrams([t or "" for t in texts])
    seen, which = np.unique(codes, return_inverse=True)
    plain = [np.bincount(which, [kinds[t] == k for t in text], len(seen)) for k in range(4)]
    shorter, rest, continued = np.unique(toxicity._drop_first(seen), return_inverse=True, return_counts=True)
    shared = toxicity.kneser_ney(shorter, continued.astype(float))[rest]
    labelled = sum(plain) > 0

    frame = spark.createDataFrame(list(zip(texts, kinds, strict=True)), "text string, kind int")
    counted = frame.mapInArrow(toxicity._count, "code long, " + ", ".join(f"{c} long" for c in toxicity.COUNTS))
    types = counted.groupBy("code").agg(*(toxicity.F.sum(c).alias(c) for c in toxicity.COUNTS))
    found, p, counts = toxicity.backoff(types)
    assert types.count() == len(seen) and found.tolist() == seen[labelled].tolist() and len(found) < len(seen)
    assert p == pytest.approx(shared[labelled])
    assert all((a == b[labelled]).all() for a, b in zip(counts, plain, strict=True))
    # every n-gram of the corpus, seen by a class or not, has the ratio of the plain models
    both = [np.log(toxicity.kneser_ney(seen, n.astype(float), shared)) for n in (plain[0] + plain[1], plain[2] + plain[3])]
    ratio = both[0] - both[1]
    model = toxicity.Model.of(found, p, counts[0] + counts[1], counts[2] + counts[3])
    assert model.ratios(seen) == pytest.approx(ratio, abs=1e-5)
    # and the features are the sums over texts and words
    features = model.features([t or "" for t in texts])
    for i, t in enumerate(texts):
        own = ratio[which[text == i]]
        assert features[i, 0] == pytest.approx(own.mean() if len(own) else 0, abs=1e-5)
        words = [ratio[which[word == w]] for w in np.unique(word[text == i])]
        top = sorted((w.sum() / len(w) ** 0.5 for w in words), reverse=True)[: toxicity.TOP]
        assert features[i, 1:] == pytest.approx(top + [0] * (toxicity.TOP - len(top)), abs=1e-5)
    model.weights = np.array([-1.0, 2.0, 0.5, 0.2, 0.1])
    assert model.scores(features) == pytest.approx(1 / (1 + np.exp(1 - features @ model.weights[1:])))


def test_bounds_of_the_labelled_sample(spark):
    docs = spark.createDataFrame([(i, " ".join(str((i + 1) * k * 7919) for k in (3, 11, 101, 1009))) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, label int")
    for bounds in ({"max_labelled": 40}, {"max_labelled_chars": 1000}):
        model = toxicity.fit(docs, labels, **bounds)
        whole = toxicity.fit(docs, labels)
        assert 0 < sum((k >= 0).sum() for k, _ in model.ratio.tables) < sum((k >= 0).sum() for k, _ in whole.ratio.tables) / 2


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    size = quality.WORDS + quality.STATS
    machine = quality.Machine(np.zeros(quality.STATS), np.ones(quality.STATS), 0.3, rng.normal(size=size), rng.normal(size=(size, quality.RANK)) * 0.1)
    starts = np.array([0, 40])
    numbers, values = np.concatenate([rng.choice(size, 40, replace=False), rng.choice(size, 25, replace=False)]), rng.normal(size=65)
    found, _, _ = machine.raw(numbers, values, starts)
    for row, (start, end) in enumerate(((0, 40), (40, 65))):
        raw = machine.bias + machine.linear[numbers[start:end]] @ values[start:end]
        for i in range(start, end):
            for j in range(start, i):
                raw += machine.factors[numbers[i]] @ machine.factors[numbers[j]] * values[i] * values[j]
        assert found[row] == pytest.approx(raw)


def test_scores_of_whole_texts_match_the_plain_sum(spark, docs):
    """Every row's score, recomputed feature by feature and pair by pair."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, label int")
    machine = quality.fit(docs, labels)
    got = {(r.doc_id, round(r.score, 9)) for r in quality.score(docs, machine).collect()}
    wanted = set()
    for r in docs.collect():
        words = {}
        for w in (r.text or "").lower().split():
            words[w] = words.get(w, 0) + 1
        length = sum(np.log1p(n) ** 2 for n in words.values()) ** 0.5
        x = [(quality.zlib.crc32(w.encode()) % quality.WORDS, np.log1p(n) / length) for w, n in words.items()]
        stats = np.clip((np.array(quality.features(r.text or "", r.n_chars)[2]) - machine.mean) / machine.scale, -5, 5) / 2
        x += [(quality.WORDS + i, s) for i, s in enumerate(stats)]
        raw = machine.bias + sum(machine.linear[i] * a for i, a in x)
        raw += sum(machine.factors[i] @ machine.factors[j] * a * b for n, (i, a) in enumerate(x) for j, b in x[:n])
        wanted.add((r.doc_id, round(float(1 / (1 + np.exp(-raw))), 9)))
    assert got == wanted
