"""Top-k search and embedding near-duplicates against brute force."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemart.llm import covertree, topk

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def best(rows, is_query, k=5):
    codes = [(i, [math.floor(256 * Fraction(x)) for x in v]) for i, v, _ in rows if i is not None and usable(v)]
    held = lambda s: max(-(2**63), min(2**63 - 1, s))
    out = []
    for at, (q, code) in enumerate(codes):
        if is_query(q):
            scored = sorted((-held(sum(a * b for a, b in zip(code, c))), i) for j, (i, c) in enumerate(codes)
                            if j != at and len(c) == len(code))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def random_rows(seed, n, dims=20):
    rng = random.Random(seed)
    grid = lambda: rng.randrange(-64, 64) / 32
    rows = [(i, [grid() for _ in range(dims)], rng.randrange(3)) for i in range(n)]
    for i in range(0, n, 7):  # ties: equal vectors
        rows[i] = (i, list(rows[0][1]), rows[0][2])
    return rows


def test_top_k_equals_brute_force(spark, monkeypatch):
    rows = random_rows(5, 700)
    got = topk.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == best(rows, lambda i: i % 50 == 0)


def test_top_k_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, None], 1), (2, None, 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [-1.0, 0.5], None),
            (6, [1.0, 2.0], 1), (6, [1.0, 2.0], 1), (7, [1.0], 2), (None, [9.0, 9.0], 1), (8, [], 1), (50, [1e30, 1e30], 1), (100, [], 2)]
    wide = [(0, [1.0, 2.0], 1), (1, [1e307, -1e307], 1), (50, [1.7e308, 1.0], 1), (2, [-0.3, 7e305], 1)]  # leave the doubles when scaled
    frame = spark.createDataFrame(wide, "vec_id bigint, embedding array<double>, label int")
    assert sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 50 == 0).collect())) == best(wide, lambda i: i % 50 == 0)
    again = [(0, [1.0, 2.0], 1), (1, [3.0, 1.0], 1), (1, [9.0, 1.0], 1), (1, [3.0, 1.0], 1), (0, [0.5, 0.5], 1), (50, [1.0, 1.0], 1)]
    assert sorted(map(tuple, topk.top_k(vectors(spark, again), F.col("vec_id") % 50 == 0).collect())) == best(again, lambda i: i % 50 == 0)
    got = sorted(map(tuple, topk.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect()))
    small = [(q, r, v) for q, r, v, s in got]
    assert [x for x in small if x[0] == 0] == [(0, 1, 50), (0, 2, 6), (0, 3, 6), (0, 4, 5)]
    assert [x for x in got if x[0] == 100] == [(100, 1, 8, 0)]
    assert (50, 1, 0, 2**63 - 1) in got


def test_top_k_empty(spark):
    assert topk.top_k(vectors(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_k(vectors(spark, [(1, [1.0], 1)]), F.col("vec_id") % 50 == 0).collect() == []


def linked(rows, threshold):
    good = [usable(v) and any(v) and lab is not None and i is not None for i, v, lab in rows]
    norm = lambda v: math.sqrt(sum(x * x for x in v))
    n, root = len(rows), {i: i for i, _, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * n
    for a in range(n):
        for b in range(n):
            (i, v, x), (j, w, y) = rows[a], rows[b]
            if a != b and good[a] and good[b] and x == y and len(v) == len(w) and \
                    sum(p * q for p, q in zip(v, w)) / (norm(v) * norm(w)) >= threshold:
                links[a] += 1
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return sorted(((i, links[k], i if i is None else find(i), None if i is None else find(i) == i)
                   for k, (i, _, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [1024, 40])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", block)
    rng = random.Random(8)
    rows = random_rows(3, 150, 6)
    for i in range(150, 300):  # a cluster of near copies, and chains
        base = rows[rng.randrange(0, 5 if i < 230 else i)][1]
        rows.append((i, [x + rng.uniform(-0.3, 0.3) for x in base], rng.randrange(2)))
    df = vectors(spark, rows)
    rows = [tuple(r) for r in df.collect()]  # as stored: single precision
    got = sorted(map(tuple, covertree.near_duplicates(df, 0.93).collect()), key=str)
    assert got == linked(rows, 0.93)
    assert len({r[2] for r in got}) < 250


def test_near_duplicates_awkward_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, [0.0, 0.0], 1), (5, None, 1),
            (6, [1.0, None], 1), (7, [float("nan"), 1.0], 1), (8, [1.0], 1), (None, [1.0, 0.0], 1), (9, [], 1), (10, [1.0, 0.0], 2)]
    got = sorted(map(tuple, covertree.near_duplicates(vectors(spark, rows)).collect()), key=str)
    assert got == linked(rows, 0.93)
    assert covertree.near_duplicates(vectors(spark, [])).collect() == []
