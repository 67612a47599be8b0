"""Packing: every id in one piece, sequences gapless, little padding."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plain_forms import WORD_BPE as PATH, check_pieces as check
from tidemart.llm import jaccard, langid, packing, secret_scan
from tidemart.llm.common import text_buffers



def texts(seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["Hello", "l'été", "don't", "naïve\nline", "x1y22", "😀!", "ΣΑΣ", "áb", "\x1c", "the end", "<|endoftext|>", "ß"])
                     for _ in range(int(rng.expovariate(1 / 200)))) for _ in range(n)]


@pytest.mark.parametrize("shard", [8 << 20, 20_000])
def test_pieces_cover_the_documents(documents, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD_BYTES", shard)
    rows = list(enumerate(texts(4, 120))) + [(500, None), (501, ""), (502, "word " * 9000), (None, "no id"), (7, "again"), (7, "again")]
    filled = check(rows, packing.pack(documents(rows), PATH).collect())
    shards = {s >> 32 for s in filled}
    assert sum(2048 - n for n in filled.values()) < 2048 * len(shards)


def test_empty_table_and_cache_turnover(documents, monkeypatch):
    assert packing.pack(documents([]), PATH).collect() == []
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    encode = packing.WordIds(PATH, "<u2")
    tokenizer = Tokenizer.from_file(PATH)
    for group in [["a b c d"], ["e f g a", "", "a  b\n\nc"], [], ["x \x01 y", "\x01"], ["Don't <|endoftext|> é\u0301"]]:
        data, offsets = text_buffers(pa.array(group, pa.string()))
        assert [x.tolist() for x in encode(data, offsets)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in group]


def test_words_of_one_hash(monkeypatch):
    """Words that share a hash, of equal and of other lengths, in one block and over blocks."""
    hashes = packing.word_hashes
    monkeypatch.setattr(packing, "word_hashes", lambda *a, **k: hashes(*a, **k) & np.uint64(3))
    encode, tokenizer = packing.WordIds(PATH, "<u2"), Tokenizer.from_file(PATH)
    for group in [["one two six ten", "alpha beta gamma delta"], [""], ["ten six two one", "été, l'hôtel 😀 x1y2 one one"], texts(9, 1)]:
        data, offsets = text_buffers(pa.array(group, pa.string()))
        assert [x.tolist() for x in encode(data, offsets)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in group]


def test_known_words_stay_few(monkeypatch):
    """Frequent words stay known, others go; long words count by their bytes."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 40)
    monkeypatch.setattr(packing, "CACHE_BYTES", 2000)
    encode, tokenizer = packing.WordIds(PATH, "<u2"), Tokenizer.from_file(PATH)
    learned, learn = [], encode._learn
    monkeypatch.setattr(encode, "_learn", lambda words: (learned.extend(words), learn(words)))
    for block in range(60):
        own = [f"Été{block}x{i}," for i in range(10)] if block % 3 else ["long" * 100 + str(block)] * 2
        group = ["the whole été", " ".join(own)]
        data, offsets = text_buffers(pa.array(group, pa.string()))
        assert [x.tolist() for x in encode(data, offsets)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in group]
        assert encode.places.used <= 40 + 13 and encode.spelled.used <= 2000 + len(data)
    assert learned.count(b"the") == 1 and len(learned) == len(set(learned)) == 3 + 40 * 10 + 20


def test_batches_are_bounded_by_bytes(spark, documents):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(limit, None)
    try:
        spark.conf.unset(limit)
        for operator in (lambda d: packing.pack(d, PATH), lambda d: langid.identify(d), lambda d: secret_scan.scan(d), lambda d: jaccard.signatures(d, 5, 80)):
            spark.conf.unset(limit)
            operator(documents([(1, "one two"), (2, "eins zwei", "de")]))
            sizes = spark.range(0, 12_000, 1, 1).select(F.repeat(F.lit("x"), 1000).alias("t")).mapInArrow(
                lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n bigint").collect()
            assert max(r.n for r in sizes) < 5 << 20 and sum(r.n for r in sizes) > 12_000_000
        spark.conf.set(limit, "1000000b")
        packing.pack(documents([(1, "one two")]), PATH)
        assert spark.conf.get(limit) == "1000000b"
    finally:
        spark.conf.set(limit, old) if old else spark.conf.unset(limit)


def test_costs_are_balanced():
    rng = np.random.default_rng(0)
    lengths = np.sort(rng.integers(1, 600, 3000))[::-1]
    placed = packing.place_pieces(lengths, 2048, 1.0, 1 / 1024)
    cost = np.zeros(max(p[3] for p in placed) + 1)
    for _, _, n, s, _ in placed:
        cost[s] += n + n * n / 1024
    assert np.std(cost[:-1]) < 0.1 * np.mean(cost)
