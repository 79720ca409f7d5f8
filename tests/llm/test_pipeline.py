"""The pipeline against a plain version of its stages after the first, on a small fixture."""

import random

import corpus_pipeline
import public_tokenizers
from test_jaccard_join import near_copies, shingle_set
from tokenizers import Tokenizer

from sitecensus.llm import mixing, packing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_and_columns():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact dedup", "near duplicates", "mixing", "packing"]


def test_whole_run(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, t + " fool fool fool" * (i % 11 == 0), "en", f"s{i % 3 % 2}", len(t)) for i, t in near_copies(3, 200)]
    rows += [(1000 + i, rng.choice(rows)[1], "en", "s0", None) for i in range(40)] + [(2000, None, "en", None, 0), (2001, "", "en", "s1", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int("fool" in (t or ""))) for i, t, *_ in rows if i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)
    clean = stage["toxicity"](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in clean} >= {i for i, t, *_ in rows if "fool" not in (t or "")}

    best = {}
    for r in clean:
        best[r.text or ""] = max(best.get(r.text or "", -1), r.doc_id)
    single = sorted((i, t) for t, i in best.items())
    label = {i: i for i, _ in single}
    sets = {i: shingle_set(t) for i, t in single}
    for a in label:
        for b in label:
            if b < a and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    kept = set(label.values())

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {i: t for i, t in single}
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in result} == kept
    for i in kept:
        own = sorted((r for r in result if r.doc_id == i), key=lambda r: r.start)
        assert sum(r.length for r in own) == own[0].doc_tokens == len(tokenizer.encode(text[i], add_special_tokens=False).ids) + 1
    mixed = stage["mixing"](spark, docs, str(tmp_path))
    assert mixed.columns == docs.columns and mixed.count() == docs.count()
    order = {r.doc_id: (r.slot, r.source_rank) for r in mixing.schedule(docs, mixing.target_weights(docs)).collect()}
    places = [order[r.doc_id] for r in mixed.collect()]
    assert places == sorted(places)
    assert packing.END_ID == 2


def test_sequences_of_a_run_follow_the_mixture(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(7))
    rows = [(i, " ".join(word() for _ in range(30 + 300 * (i % 2))), "en", "hot" if i % 10 else "cold", 1) for i in range(1000)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 1000, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or else so few rows are one partition
    try:
        result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    kept = docs.where(docs.doc_id.isin(sorted({r.doc_id for r in result})))
    place = {r.doc_id: (r.slot, r.source_rank) for r in mixing.schedule(kept, mixing.target_weights(kept)).collect()}
    parts = {}
    for r in result:
        parts.setdefault(r.sequence_id >> 33, set()).add(place[r.doc_id])
    order = [parts[k] for k in sorted(parts)]
    assert len(order) > 1 and all(max(a) < min(b) for a, b in zip(order, order[1:]))
