"""Stupid backoff against plain counting."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from tidemart.llm import lm


def plain(rows, order, alpha):
    texts = [(t or "").encode().lower().split() for _, t in rows]
    grams = lambda w: Counter(tuple(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total, own = sum((grams(w) for w in texts), Counter()), [grams(w) for w in texts]
    out = []
    for (doc, _), w, mine in zip(rows, texts, own):
        left = lambda g: total[g] - mine[g]
        rest, score, gave_up = max(sum(map(len, texts)) - len(w), 1), 0.0, 0
        for i in range(len(w)):
            longest = min(i, order - 1)
            for h in range(longest, -1, -1):
                gram = tuple(w[i - h:i + 1])
                if h == 0 or left(gram) > 0:
                    value = max(left(gram), 1) / rest if h == 0 else left(gram) / left(gram[:-1])
                    score += math.log(value) + (longest - h) * math.log(alpha)
                    gave_up += h < longest
                    break
        out.append((doc, len(w), gave_up, score))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), r[1], r[2], r[3])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [key(r)[:3] for r in got] == [key(r)[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=2e-6)


@pytest.mark.parametrize("order, shard", [(2, 8 << 20), (3, 3000), (1, 8 << 20)])
def test_equals_plain_counting(documents, monkeypatch, random_words, order, shard):
    monkeypatch.setattr(lm, "SHARD_BYTES", shard)
    rng = random.Random(3)
    rows = [(i, " ".join(random_words(rng, rng.randrange(0, 120), 40))) for i in range(60)]
    rows += [(None, "W1 w2\tw3"), (7, rows[7][1]), (7, rows[7][1]), (90, None), (91, ""), (92, "unseen"), (93, "w1 " * 30_000)]
    same(lm.stupid_backoff(documents(rows), order=order).collect(), plain(rows, order, 0.4))


def test_empty_table_and_single_row(documents):
    assert lm.stupid_backoff(documents([])).collect() == []
    same(lm.stupid_backoff(documents([(1, "a b")])).collect(), plain([(1, "a b")], 2, 0.4))


def test_registered_query_counts_trigrams(spark, documents, random_words, tmp_path):
    from tidemart.llm.queries import op4_stupid_backoff

    rng = random.Random(5)
    rows = [(i, " ".join(random_words(rng, rng.randrange(0, 60), 8))) for i in range(40)]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    same(op4_stupid_backoff(spark, str(tmp_path)).collect(), plain(rows, 3, 0.4))


def test_longer_histories_over_shards(documents, monkeypatch, random_words):
    monkeypatch.setattr(lm, "SHARD_BYTES", 2000)
    rng = random.Random(6)
    passage = " ".join(random_words(rng, 30, 400))  # n-grams of other rows among words that are nobody else's
    rows = [(i, " ".join(random_words(rng, rng.randrange(0, 60), 12))) for i in range(40)]
    rows += [(50 + i, f"only{i} {passage} only{i} only{i} only{i}") for i in range(5)] + [(None, "w1 w2 w3 w4 w1 w2 w3 w4"), (90, None)]
    same(lm.stupid_backoff(documents(rows), order=4).collect(), plain(rows, 4, 0.4))


def test_texts_and_counts_travel_small(random_words):
    """What is shuffled beside the hashes: a text in 6 bits a byte at most, and small counts in 2 bits."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(8)
    texts = [" ".join(random_words(rng, 400, 500)) for _ in range(20)] + [None, "", "é w1"]
    given = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "shard": pa.array([0] * len(texts), pa.int64()), "text": texts})
    sent = pa.Table.from_batches(lm._packed(given.to_batches(max_chunksize=7)))
    data, offsets = lm._unpacked(sent)
    assert [bytes(data[a:b]).decode() for a, b in zip(offsets[:-1], offsets[1:])] == [t or "" for t in texts]
    assert sum(map(len, sent.column("packed").to_pylist())) < 0.75 * len(data)

    counts = np.array([rng.random() < 0.05 for _ in range(100_000)], np.int64)
    assert (lm._wide(lm._narrow(counts)) == counts).all() and len(lm._narrow(counts)) < 25_000
    for odd in (np.empty(0, np.int64), np.array([0, 255, 256, 1 << 40])):
        assert (lm._wide(lm._narrow(odd)) == odd).all()
