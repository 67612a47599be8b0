"""Periodic runs against a search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from helpers import SF_SMALL
from tidemart.llm.runs import digests, find_runs, plant_repeats, runs_of


def brute(w, least, repeats):
    found = {}
    for p in range(1, len(w) // repeats + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, repeats * p):
                found.setdefault((i, j + p - i), p)  # smaller periods come first
            i = j + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def wordy(rng, letters, n):
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if w:
            a = rng.randrange(len(w))
            p = 1 + rng.randrange(max(1, (len(w) - a) // 2))
            for i in range(a, min(len(w), a + p * rng.randrange(2, 9))):
                w[i] = w[a + (i - a) % p]
    return w


@pytest.mark.parametrize("least, repeats", [(24, 3), (4, 2), (6, 3), (1, 2), (2, 4)])
def test_all_runs_of_blocks(least, repeats):
    rng = random.Random(least)
    for _ in range(400):
        texts = [wordy(rng, rng.choice([1, 2, 3, 9]), rng.randrange(90)) for _ in range(rng.randrange(1, 5))]
        got = runs_of(np.array([x for t in texts for x in t], np.int64), np.array([i for i, t in enumerate(texts) for _ in t], np.int64), least, repeats)
        want, base = [], 0
        for t in texts:
            want += [(s + base, n, p) for s, n, p in brute(t, least, repeats)]
            base += len(t)
        assert [tuple(r) for r in got.tolist()] == want


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def check(given, got):
    key = lambda r: tuple(str(x) for x in r)
    want = []
    for i, text in given:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = brute(words, 24, 3)
        want.append((i, runs, collapsed(words, runs)))
    assert sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=key) == sorted(want, key=key)


def test_awkward_texts(documents):
    rng = random.Random(8)
    texts = [None, "", " \n", "a", "la " * 23, "la " * 24, "la\t" * 25 + "end", "a b " * 12, "x " + "a b c d e f g h " * 3, "x " + "a b c d e f g h " * 3 + "a",
             "a b c d e f g h i " * 3, "a " * 30 + "b " * 30, "é ß " * 40 + "  x", "w " * 30000, " ".join(map(str, range(4000))) + " " + " ".join(map(str, range(4000))),
             "\x1c\x1d z " * 14, ("one two " * 13 + "three ") * 5]
    texts += [" ".join(map(str, wordy(rng, 3, 400))) for _ in range(60)]
    given = [*enumerate(texts), (None, "la " * 30), (None, None), (6, texts[6]), (6, texts[6])]
    check(given, find_runs(documents(given).selectExpr("*", "'mine' AS runs", "1 AS `a.b`")).collect())
    assert find_runs(documents([])).count() == 0


def test_query_rows(spark, documents):
    from tidemart.llm.queries import op12_periodic_runs

    rng = random.Random(1)
    given = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    planted, some = [], 0
    for i, text in given:
        words = [w.decode() for w in (text or "").encode().split()]
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
        planted.append((i, words))
    want = {}
    for i, words in planted:
        runs = brute(words, 24, 3)
        some += bool(runs)
        best = max(runs, key=lambda r: (r[1] * 10**9 // r[2], -r[0], -r[2])) if runs else (None,) * 3
        want[i] = (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                   hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
                   hashlib.sha256(collapsed(words, runs).encode()).hexdigest())
    got = op12_periodic_runs(spark, SF_SMALL).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(want) and some > 10
    odd = documents([(None, "a b c"), (None, None), (7, ""), (3, " ")] + [(k, " ".join(str(rng.randrange(50)) for _ in range(40))) for k in range(60)])
    out = digests(find_runs(plant_repeats(odd))).collect()
    assert len(out) == 64 and all(r["runs_sha256"] and r["collapsed_sha256"] for r in out)
    assert plant_repeats(odd).filter("doc_id IS NULL AND text = 'a b c'").count() == 1
