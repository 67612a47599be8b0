"""Mixing: targets by the iteration the contract describes, fits against the best sum."""

from __future__ import annotations

import random

import pytest

from plain_forms import check_mix as check
from tidemart.llm.mixing import fit, mix, take


def test_targets_and_budgets(documents, random_words):
    rng = random.Random(2)
    rows = [(i, " ".join(random_words(rng, rng.randrange(1, 200))), "en", rng.choice(["a", "b", "b", "é", "z", "Z", None]))
            for i in range(400)] + [(900, "lone words", "en", "tiny"), (901, "", "en", "void"), (902, None, "en", None)]
    got = mix(documents(rows)).collect()
    check(rows, got, 1.0)
    again = mix(documents(list(reversed(rows)))).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_hot_length_and_repeated_rows(documents):
    rows = [(i % 150, "same size here", "en", "s") for i in range(600)] + [(None, "x y", "en", None)] * 3 + [(1, "q", "en", "t")] * 50
    check(rows, mix(documents(rows)).collect(), 3.0)


def test_empty_tables(documents):
    assert mix(documents([])).collect() == []
    got = mix(documents([(1, None, "en", "a"), (2, "", "en", None)])).collect()
    assert {(r["size"], r["taken"], r["target"]) for r in got} == {(0, 0, 0.0)}


@pytest.mark.parametrize("seed", range(30))
def test_fit_is_as_close_as_any_choice(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 5))}
    total = sum(n * c for n, c in counts.items())
    budget = rng.randrange(0, total + 1)
    taken = fit(counts, budget)
    assert all(0 <= taken[n] <= counts[n] for n in counts)
    got = abs(sum(n * k for n, k in taken.items()) - budget)
    assert got <= max(counts)  # within one document; exact where a share leaves enough choice


def test_fit_large_budget_is_exact():
    rng = random.Random(1)
    counts = {rng.randrange(1, 20_000): rng.randrange(1, 500) for _ in range(3000)}
    budget = sum(n * c for n, c in counts.items()) * 2 // 7
    taken = fit(counts, budget)
    assert sum(n * k for n, k in taken.items()) == budget


def test_take_returns_each_row_as_often_as_planned(documents):
    """Null and repeated doc_ids: rows are told apart, and every source meets its target."""
    rng = random.Random(8)
    text = lambda: " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(5, 40)))
    given = [(None, text(), "en", f"s{i % 4}") for i in range(300)]
    given += [(i % 30, text(), "en", f"s{i % 4}") for i in range(120)] + [(500 + i, text(), "en", f"s{i % 4}") for i in range(80)]
    docs = documents(given)
    out = take(docs).collect()
    size = lambda rows, s: sum(len(r["text"].split()) for r in rows if r["source"] == s)
    plan = mix(docs).collect()
    for source in ("s0", "s1", "s2", "s3"):
        assert size(out, source) == sum(r["taken"] for r in plan if r["source"] == source)
        target = next(r["target"] for r in plan if r["source"] == source)
        assert abs(size(out, source) - target) <= 1
    assert any(r["doc_id"] is None for r in out)
    times = lambda rows: sorted((str(r["doc_id"]), r["source"], len(r["text"].split())) for r in rows)
    assert times(out) == sorted((str(r["doc_id"]), r["source"], r["size"]) for r in plan for _ in range(r["taken"] // r["size"] if r["size"] else 0))
