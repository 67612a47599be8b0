"""N-gram Jaccard join against brute force over all pairs."""

from __future__ import annotations

import random

import pytest

from plain_forms import brute
from tidemart.llm.jaccard import near_duplicates


def check(rows, got, words, percent):
    sets, comps = brute(rows, words, percent)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert r["component_id"] == comps[r["doc_id"]], r
            assert r["n_shingles"] in {len(s) for s in sets[r["doc_id"]]}


def family_rows(seed, random_words):
    rng = random.Random(seed)
    passage = random_words(rng, 30, 10**6)
    rows = []
    for _ in range(12):
        base = random_words(rng, rng.choice([5, 9, 40, 120, 300]), 10**6)
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.choice([1, 2, 14])):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 25))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(w))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, frequent", [(1, 24), (2, 3), (3, 2)])
def test_equals_brute_force(documents, random_words, seed, frequent):
    rows = family_rows(seed, random_words)
    got = near_duplicates(documents(rows), words=4, percent=85, frequent=frequent).collect()
    check(rows, got, 4, 85)
    assert len({r["component_id"] for r in got}) < len(rows)


def test_chain_of_near_copies_is_one_component(documents):
    base = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join([f"n{i}_{j}" if j < 4 * i else w for j, w in enumerate(base)])) for i in range(6)]
    check(rows, near_duplicates(documents(rows), words=4, percent=85).collect(), 4, 85)


def test_awkward_rows(documents):
    rows = [(5, None), (6, ""), (7, " \n\t"), (8, "one two"), (9, "One\ttwo"), (3, "ONE two"), (10, "é É"),
            (11, "É é"), (12, "a b c d e f g"), (12, "a b c d e f g"), (None, "one two"), (None, None)]
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in near_duplicates(documents(rows)).collect()}
    assert got[(8, 1)] == got[(9, 1)] == got[(3, 1)] == got[(None, 1)] == 3
    assert got[(5, 0)] == 5 and got[(6, 0)] == 6 and got[(7, 0)] == 7 and got[(None, 0)] is None
    assert got[(10, 1)] == 10 and got[(11, 1)] == 11 and got[(12, 3)] == 12


def test_empty_table_and_clashing_columns(documents, spark):
    assert near_duplicates(documents([])).collect() == []
    df = spark.createDataFrame([(1, "a b c d e", 7, "z"), (2, "a b c d e", 8, "y")], "doc_id int, text string, n int, rep string")
    assert sorted(map(tuple, near_duplicates(df).collect())) == [(1, 1, 1), (2, 1, 1)]
    with pytest.raises(ValueError):
        near_duplicates(df, percent=50)


def test_keep_one_decides_by_row(documents, random_words):
    """Repeated and null doc_ids: one row of each group, and nothing that links with nothing goes."""
    from tidemart.llm.jaccard import keep_one

    rng = random.Random(11)
    text = lambda: " ".join(random_words(rng, 60))
    a, b, c, d, e, f = (text() for _ in range(6))
    near = lambda t: t + " tail"
    given = [(1, a), (2, near(a)), (2, b),  # 2 has a copy of 1 and a text of its own
             (5, c), (5, d),  # unrelated texts of one id
             (None, e), (None, e), (None, near(e)),  # copies without an id
             (None, f), (9, near(f)),  # a row with an id goes before one without
             (None, None), (None, None), (None, ""), (7, "")]
    got = sorted(((r["doc_id"], r["text"]) for r in keep_one(documents(given)).collect()), key=str)
    want = [(1, a), (2, b), (5, c), (5, d), (None, min(e, near(e))), (9, near(f)), (None, None), (None, None), (None, ""), (7, "")]
    assert got == sorted(want, key=str)


def test_rows_without_a_doc_id_link(documents, random_words):
    """A near copy without a doc_id gets its component, and chains run through such rows."""
    rng = random.Random(5)
    words = random_words(rng, 60, 10**6)
    step = lambda k: " ".join(words[k:] + [f"t{j}" for j in range(k)])
    given = [(7, step(0)), (None, step(4)), (3, step(8)), (None, " ".join(random_words(rng, 50, 10**6))), (None, None), (9, "alone words here")]
    lone = " ".join(random_words(rng, 40, 10**6))
    given += [(None, lone), (None, lone + " tail")]
    got = sorted(((r["doc_id"], r["component_id"]) for r in near_duplicates(documents(given)).collect()), key=str)
    assert got == sorted([(7, 3), (None, 3), (3, 3), (None, None), (None, None), (9, 9), (None, None), (None, None)], key=str)


def test_one_common_passage_over_many_groups(documents, random_words):
    """Many groups under one passage, at two sizes: exact components, and candidate rows in proportion."""
    from tidemart.llm import jaccard

    counts = []
    for groups in (12, 48):
        rng = random.Random(3)
        passage = random_words(rng, 60, 10**6)
        rows = []
        for _ in range(groups):
            base = passage + random_words(rng, 40, 10**6)
            for _ in range(4):
                w = list(base)
                for _ in range(rng.choice([1, 8])):
                    w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
                rows.append((len(rows), " ".join(w)))
        seen, publish = {}, jaccard.publish

        def counted(df, name):
            out = publish(df, name)
            seen.setdefault(name, []).append(out)
            return out

        jaccard.publish = counted
        try:
            check(rows, near_duplicates(documents(rows)).collect(), 5, 80)
        finally:
            jaccard.publish = publish
        counts.append(sum(t.count() for t in seen["jaccard-across"][:1] + seen["jaccard-stars"][1:]))
    assert counts[1] <= 6 * counts[0]


def test_dense_group_whose_smallest_documents_are_far(documents, random_words):
    """A group of near copies whose index entries lead to texts outside it, at two sizes: exact components,
    and verified pairs in proportion to its size."""
    from tidemart.llm import jaccard

    counts = []
    for size in (60, 240):
        rng = random.Random(4)
        base = random_words(rng, 150, 10**6)
        rows = []
        for i in range(size):
            w = list(base)
            for _ in range(12 if i < size // 3 else 2):  # the smaller doc_ids miss the threshold
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((i, " ".join(w)))
        seen, verified = [], jaccard._verified

        def counted(pairs, *args):
            seen.append(pairs.count())
            return verified(pairs, *args)

        jaccard._verified = counted
        try:
            check(rows, near_duplicates(documents(rows)).collect(), 5, 80)
        finally:
            jaccard._verified = verified
        counts.append(sum(seen))
    assert counts[1] <= 6 * counts[0], counts


def test_tables_go_once_they_are_used(documents, random_words):
    """Of the tables that grow with the texts only the copy of the rows is left at the end; signatures are gone
    before candidates meet, and tokens are counted in slices of about one size."""
    from pathlib import Path

    from tidemart.llm import jaccard

    rng = random.Random(6)
    base = [random_words(rng, 400, 10**6) for _ in range(40)]
    rows = [(i, " ".join([f"x{i}", *base[i % 40]])) for i in range(120)]
    paths, counts, at, publish = [], {}, {}, jaccard.publish

    def there():
        return {name for name, path in paths if Path(path.removeprefix("file:")).exists()}

    def seen(df, name, *more):
        out = publish(df, name, *more)
        paths.append((name, out.scratch_path))
        counts.setdefault(name, []).append(out.count())
        at[name] = there()
        return out

    jaccard.publish = seen
    try:
        kept = jaccard.keep_one(documents(rows)).collect()
    finally:
        jaccard.publish = publish
    assert sorted(r["doc_id"] for r in kept) == list(range(40))
    assert "jaccard-rows" in there()
    assert not {"jaccard-sets", "jaccard-hits", "jaccard-shared"} & at["jaccard-heads"]
    assert not {"jaccard-index", "jaccard-heads"} & at["jaccard-across"]
    assert not {"jaccard-sets", "jaccard-sketches", "jaccard-index", "jaccard-live", "jaccard-open"} & there()
    slices = counts["jaccard-shared"]
    assert len(slices) == jaccard.SLICES and max(slices) <= 1.5 * sum(slices) / len(slices)


def test_shuffle_files_of_a_written_table_go(spark, monkeypatch):
    """Tables are written under Spark's cleanup of shuffle files at a query's end; the session's own setting stays."""
    from pyspark.sql import DataFrameWriter, functions as F

    from tidemart.llm.common import publish

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen, parquet = [], DataFrameWriter.parquet

    def noted(self, *args, **kw):
        seen.append(spark.conf.get(setting, None))
        return parquet(self, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    had = spark.conf.get(setting, None)
    assert len(publish(spark.range(2_000).groupBy(F.expr("id % 100")).count(), "shuffled").collect()) == 100
    with pytest.raises(Exception):
        publish(spark.range(1).select(F.raise_error(F.lit("no"))), "refused")
    assert seen == ["true", "true"] and spark.conf.get(setting, None) == had
