import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sitecensus.llm import packing

from sample_rows import ROWS

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_tokenizer(tokenizer):
    random.seed(4)
    syllables = ["the", "ing", "Qu", "é", "ß", "ž", "tion", "LL", "'s", "'re", "1", "42", "—", "“", "!!", "%%%", "&", ".", "Œ", "ﬁ", "ǆ", "İ", "Σ", "ς", "你", "\u200b", "\u0301", "\xa0", "\x1c", "<|endoftext|>", "<|startoftext|>", "<|", "<|endoftext"]
    texts = ["", " ", "It's <|startoftext|> they'll", "a <|endoftext|> b", "a<|EndOfText|>b", "plain<|endoftext|><|endoftext|>\n", "x < | y <|z", *("".join(random.choice([*syllables, " ", "\n", "\t"]) for _ in range(60)) for _ in range(1500))]
    ids = packing.WordIds(PATH)
    for text, wanted in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids.of(text), "<u4").tolist() == wanted.ids, text


def check(rows, wanted, most_segments):
    """rows: pieces; wanted: ids of each document, in any order, by key."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
        total = sum(r.length for r in pieces)
        assert total <= 4096 and total & (total - 1) == 0 and len(pieces) <= most_segments
    for key, ids in wanted.items():
        at = 0
        for r in sorted((r for r in rows if r.doc_id == key), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_every_id_is_in_one_piece(spark, tokenizer):
    random.seed(1)
    texts = {i: " ".join(random.choice(["the", "of", "interesting", "zzyq"]) for _ in range(random.choice([0, 1, 5, 300, 3000, 9000]))) for i in range(200)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    wanted = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID] for i, t in texts.items()}
    check(packing.pack_documents(frame, PATH).collect(), wanted, 256)
    check(packing.pack_documents(frame, PATH, max_segments=3, max_loss=2000).collect(), wanted, 3)


def test_edge_cases(docs, no_docs, tokenizer):
    rows = packing.pack_documents(docs, PATH).collect()
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for i, t, *_ in ROWS if i not in (3, None)}
    check(rows, ids, 256)
    assert sum(r.length for r in rows if r.doc_id is None) == 2 * 3
    assert packing.pack_documents(no_docs, PATH).count() == 0


def test_limits_of_loss_bearing_tokens(spark):
    turns = [(c, t, ("user", "assistant", None)[t % 3], "some words " * (5 * (c % 7) + 1)) for c in range(60) for t in range(4)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = packing.pack_conversations(frame, PATH, max_tokens=512, max_segments=5, max_loss=90).collect()
    loss, segments, tokens = {}, {}, {}
    for r in rows:
        loss[r.sequence_id] = loss.get(r.sequence_id, 0) + r.loss_tokens
        segments[r.sequence_id] = segments.get(r.sequence_id, 0) + 1
        tokens[r.sequence_id] = tokens.get(r.sequence_id, 0) + r.length
    assert max(loss.values()) <= 90 and max(segments.values()) <= 5 and max(tokens.values()) <= 512
    for c in range(60):
        own = sorted((r for r in rows if r.doc_id == c), key=lambda r: r.start)
        assert own[-1].start + own[-1].length == own[0].doc_tokens and own[0].start == 0


def test_each_of_the_three_limits_binds(spark):
    """With the defaults, on long documents, on many tiny ones, and on both: sequences that stop at each limit alone."""
    random.seed(3)
    long = [" ".join(random.choice(["river", "stone", "of"]) for _ in range(random.randrange(3000, 9000))) for _ in range(60)]
    tiny = ["a b c"] * 9000  # 256 of them are 1024 ids
    at = set()
    for texts in (long, tiny, long[:20] + tiny):
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        by = {}
        for r in packing.pack_documents(frame, PATH).collect():
            n, own, loss = by.get(r.sequence_id, (0, 0, 0))
            by[r.sequence_id] = n + r.length, own + 1, loss + r.loss_tokens
            assert r.loss_tokens == max(0, r.length - 128)
        assert all(n <= 4096 and own <= 256 and loss <= 3904 for n, own, loss in by.values())
        assert sum(own for _, own, _ in by.values()) <= len(texts) + 3 * len(by)  # few documents are cut
        assert sum(n & (n - 1) > 0 for n, _, _ in by.values()) == 0  # nothing is padded
        at |= {(n == 4096, own == 256, loss == 3904) for n, own, loss in by.values()}
    assert (True, False, False) in at or (True, True, False) in at
    assert any(segments and not tokens for tokens, segments, _ in at)
    assert any(loss for _, _, loss in at)
