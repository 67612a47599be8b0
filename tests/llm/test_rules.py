"""Quality rules: statistics by plain counting, learned lists on planted and held-out labels."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SF_MID, SF_SMALL
from tidemart.llm import rules as R

LABELS = "doc_id bigint, quality int, toxic int"


def plain(text, flagged=()):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            len(lines), len(set(words)), sum("A" <= c <= "Z" for c in text or ""), sum("0" <= c <= "9" for c in text or ""),
            sum(c in "!?" for c in text or ""), sum(w.lower().strip(R.MARKS) in flagged for w in words))


def awkward():
    rng = random.Random(4)
    some = lambda n, v: " ".join(f"w{rng.randrange(v)}" for _ in range(n))
    texts = [None, "", " \t\n", "one", "a b a b a", "a b c a b c", "x\n\nx\nx \n x\nx", "\n\n", "é é é é Ünï ñ ß z", "a\r\nb\r\na\r\n", "\x0b#|<>\x0c",
             "Fool! fool, (FOOL) foolish", "Ab9 12!? #$%", "same same same same same", "\x1c\x1d tail\n", some(3000, 40), some(60, 6), some(200, 9000) + "\n" + some(3, 2)]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "x y z x y z"), (None, None), (3, "one"), (3, "one")]


def test_statistics(documents):
    given = awkward()
    got = R.statistics(documents(given), ["fool"]).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted([(i, *plain(t, {"fool"})) for i, t in given], key=key)


def test_wide_blocks_count_exactly(documents):
    words = [f"v{i}" for i in range((1 << 20) + 50)]
    text = " ".join(words + words[:3])
    got = R.statistics(documents([(1, text)])).first()
    assert (got["n_words"], got["n_repeat_words"], got["n_distinct_words"]) == (len(words) + 3, 6, len(words))


def test_statistics_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = {r["doc_id"]: plain(r["text"]) for r in docs.collect()}
    got = R.statistics(docs).collect()
    assert len(got) == len(want) and all(tuple(r)[1:] == want[r["doc_id"]] for r in got)


def frame(rng, n):
    """Rows of ratios; bad where symbols are many and lines few, or where digits are very many."""
    x = rng.random((n, len(R.RATIOS)))
    names = [r[0] for r in R.RATIOS]
    s, w, d = (x[:, names.index(c)] for c in ("symbols_per_word", "words_per_line", "digits"))
    return x, ((s > 0.7) & (w < 0.4)) | (d > 0.9)


def test_learning_finds_planted_conjunctions():
    rng = np.random.default_rng(0)
    x, bad = frame(rng, 6000)
    rules = R.learn(x, bad)
    y, truth = frame(rng, 6000)
    hit = np.zeros(len(y), bool)
    for rule in rules:
        hit |= R.covers(rule, y)
    assert 2 <= len(rules) <= 8 and (hit == truth).mean() > 0.97 and truth[hit].mean() > 0.95
    assert rules == R.learn(x, bad)


@pytest.mark.parametrize("bad", [0, 1])
def test_nothing_to_learn(bad):
    x = np.random.default_rng(1).random((500, len(R.RATIOS)))
    assert R.learn(x, np.full(500, bool(bad))) == [] and R.learn(x[:0], np.zeros(0, bool)) == []
    assert R.learn(x, np.random.default_rng(2).random(500) < 0.3) == []  # noise makes no rule


def test_expression_equals_the_rules(spark, documents):
    given = [(i, t) for i, t in awkward() if i is not None]
    rules = [(R.Condition("symbols_per_word", True, 0.2), R.Condition("words", False, 9.0)), (R.Condition("repeated_words", True, 0.5),)]
    found = R.statistics(documents(given)).withColumn("rule", R.expression(rules)).collect()
    for r in found:
        count = {c: r[c] for c in R.COUNTS}
        x = np.array([[count[a] / (count[b] or 1) * (count[b] > 0) if b else count[a] for _, a, b in R.RATIOS]])
        assert r["rule"] == next((k for k, rule in enumerate(rules, 1) if R.covers(rule, x)[0]), 0), r


def test_judge(spark, documents):
    rng = random.Random(3)
    prose = lambda n: " ".join(f"word{rng.randrange(900)}" for _ in range(n))
    rows, labels = [], []
    for i in range(400):
        kind = i % 4
        text = prose(120)
        if kind == 1:
            text = text.replace("word1", "###$$ word1")
        if kind == 2:
            text = text.replace(" ", " Vile! ", 3)
        rows.append((i, text))
        if i < 320:
            labels.append((i, 0 if kind == 1 else 1, 1 if kind == 2 else 0))
    rows += [(900, prose(49)), (901, " ".join(["a b c"] * 30)), (902, None), (903, ""), (None, prose(80)), (None, "### " * 60), (5, rows[5][1])]
    labels += [(None, 0, 0), (7, None, 0), (8, 0, None), (5, 0, 0), (5000, 0, 1)]
    docs = documents(rows).withColumn("kept", F.lit("mine"))
    table = spark.createDataFrame(labels, LABELS)
    got = R.judge(docs, table).collect()
    assert len(got) == len(rows)
    for r in got:
        i = r["doc_id"]
        if i is None:
            continue
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed == (i in (900, 901, 902, 903))
        assert r["kept"] == (not failed and i % 4 not in (1, 2)), r
    flagged, rules = R.train(docs, table)
    assert flagged == ["vile"] and rules
    assert (flagged, rules) == R.train(docs.repartition(7), table.repartition(5))


def test_without_labels_or_rows(spark, documents):
    none = spark.createDataFrame([], LABELS)
    got = R.judge(documents([(1, "a " * 60), (2, " ".join(f"x{i}" for i in range(60)))]), none).collect()
    assert {r["doc_id"]: r["kept"] for r in got} == {1: False, 2: True}
    assert R.judge(documents([]), none).count() == 0
    assert R.judge(documents([]), spark.createDataFrame([(1, 0, 0)], LABELS)).count() == 0


def test_sample_bounds_the_rows_after_the_join(spark, documents):
    docs = documents([(1, f"{i} " + "good words " * 40) for i in range(300)])
    assert R._sampled(docs, spark.createDataFrame([(1, 0, 0)], LABELS), 10).count() == 300
    flagged, rules = R.train(docs, spark.createDataFrame([(1, 0, 0)], LABELS), sample=10)
    assert rules == []


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    got = R.judge(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    poor = [r for r in got if r["quality"] == 0]
    good = [r for r in got if r["quality"] == 1 and r["toxic"] == 0 and not r["base_failed"]]
    assert sum(not r["kept"] for r in poor) >= 0.9 * len(poor) and sum(r["kept"] for r in good) >= 0.97 * len(good)
