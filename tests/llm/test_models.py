"""Quality classifier and language identification: held-out accuracy and awkward rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import langid, quality

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    test = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(5)) == 0
    model = quality.train(docs, quality.graded(labels.filter(~test)), 3)
    got = quality.score(docs.join(labels.filter(test), "doc_id", "left_semi"), model).join(labels, "doc_id").toPandas()
    toxic, good = got[got.toxic == 1], got[(got.toxic == 0) & (got.quality == 1)]
    assert (~toxic.kept).mean() > 0.7 and good.kept.mean() > 0.9
    assert toxic.expected_grade.mean() + 0.7 < good.expected_grade.mean()
    assert np.all(np.diff(model.thresholds) > 0)


def test_quality_awkward_rows(documents, spark):
    rows = [(1, "nice words here"), (2, None), (3, ""), (None, "nice"), (1, "nice words here"), (4, "x " * 60_000)]
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 0), (3, 0, 1), (99, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = quality.grade_documents(documents(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r["tail_prob"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in got)
    assert quality.grade_documents(documents([]), labels).collect() == []
    assert len(quality.grade_documents(documents(rows), labels.limit(0)).collect()) == len(rows)


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 4000)
    rows = [np.array([10 + g, rng.integers(100, 200)], np.int32) for g in grades]
    offsets = np.arange(0, 2 * len(rows) + 1, 2)
    model = quality.fit_ordinal(np.concatenate(rows), offsets, grades, 4)
    assert np.all(np.diff(model.weights[10:14]) > 0) and np.all(np.diff(model.thresholds) > 0)


def test_language_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify(docs, keep=["doc_id", "lang"]).toPandas()
    assert len(got) == docs.count() and got.accepted.mean() > 0.97
    assert (got.language[got.accepted] == got.lang[got.accepted]).all()
    hidden = F.when(F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0, F.col("lang"))
    blind = langid.identify(docs.withColumn("truth", F.col("lang")).withColumn("lang", hidden), keep=["lang", "truth"]).toPandas()
    blind = blind[blind.lang.isna()]
    assert (blind.language == blind.truth).mean() > 0.95


def test_evidence_of_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = langid.page_rows(pages)
    assert rows.filter("declared IS NULL OR host IS NULL OR text LIKE '%<p>%'").count() == 0
    got = langid.identify(rows, declared="declared", host="host", keep=["page_id", "declared"]).toPandas()
    assert (got.language == got.declared).mean() > 0.95


def test_markup_suffix_and_host_decide_where_the_text_does_not(spark):
    rng = random.Random(1)
    en, de = "the of and that with".split(), "der und nicht mit sich".split()
    say = lambda w: " ".join(rng.choice(w) for _ in range(40))
    rows = [(i, say(en), "en", "a.example.com") for i in range(30)] + [(50 + i, say(de), "de-AT", "b.example.de") for i in range(30)]
    rows += [(100, "xq", None, "b.example.de"), (101, "xq", None, "new.example.de"), (102, "xq", "en", "b.example.de"), (103, "xq", None, "a.example.com")]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    got = {r["doc_id"]: r for r in langid.identify(df, languages=("de", "en")).collect()}
    assert got[100]["language"] == got[101]["language"] == "de" and got[103]["language"] == "en"
    assert got[101]["language_prob"] <= got[100]["language_prob"]
    assert got[102]["declared_prob"] > 0


def test_language_awkward_rows(documents, spark):
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "the and of", None, None), (None, "the and of", "xx", "s"), (4, "the and of", None, None),
            (5, "the of and " * 20_000, "EN-us", "s")]
    got = langid.identify(documents(rows)).collect()
    assert len(got) == len(rows)
    assert [r["accepted"] for r in got if r["doc_id"] in (1, 2, 3)] == [False] * 3
    assert all(r["language"] is None for r in got if r["doc_id"] in (1, 2, 3))
    assert langid.identify(documents([])).collect() == []
    odd = spark.createDataFrame([(1, "the and", "en", "s", "z", 1)], "doc_id int, text string, lang string, source string, language string, `a.b` int")
    assert langid.identify(odd).columns == ["doc_id", "text", "lang", "source", "a.b", "language", "language_prob", "declared_prob", "accepted"]


@pytest.mark.parametrize("url, host", [("https://u:p@WWW.Ex.de:80/x", "ex.de"), ("http://a.b", "a.b"), ("nonsense", None), (None, None)])
def test_hosts(spark, url, host):
    assert spark.createDataFrame([(url,)], "u string").select(langid.host_of(F.col("u"))).first()[0] == host
