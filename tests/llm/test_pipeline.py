"""The corpus pipeline, stage by stage, against plain Python."""

from __future__ import annotations

import random
import re

import corpus_pipeline
from pyspark.sql import functions as F
from plain_forms import brute, check_mix, check_pieces
from tidemart.llm.secret_scan import ADDED, BASE

ENGLISH = "the of and to in is that it was for on with as this are from have which their about".split()
GERMAN = "der die und zu das ist nicht mit sich auf für eine auch werden aus nach wie über einen wird".split()


def rows():
    rng = random.Random(9)
    prose = lambda words, n: " ".join(rng.choice(words) + rng.choice(["", "", "er", "ung", "ly"][:3 if words is ENGLISH else 4]) for _ in range(n))
    out = [(i, prose(ENGLISH, rng.randrange(20, 300)), "en", f"s{i % 4}") for i in range(60)]
    out += [(i, prose(GERMAN, rng.randrange(20, 300)), "de", f"s{i % 3}") for i in range(100, 140)]
    out += [(200, prose(GERMAN, 200), "en", "s1"), (201, prose(ENGLISH, 200), "de", "s1"), (202, prose(ENGLISH, 200), None, None)]
    for i in range(300, 312):  # exact and near copies
        words = out[i % 5][1].split()
        if i % 2:
            words[len(words) // 2] = "changed"
        out.append((i, " ".join(words), "en", "s0"))
    out += [(400, out[10][1] + " password=abcdefabcdef0123456789 tail", "en", "s2"), (401, None, "en", "s1"), (402, "", None, "s1")]
    return out


def mask(text):
    spans = sorted(m.span() for r in BASE + ADDED for m in re.finditer(r.pattern, text, re.A | (re.I if r.fold else 0))
                   if len(m.group(r.group)) >= r.least)
    out, at = "", 0
    for s, e in spans:
        if s >= at:
            out += text[at:s] + "[SECRET]"
        at = max(at, e)
    return out + text[at:]


def test_stages(spark, documents, tmp_path):
    given = rows()
    documents(given).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "ngram_jaccard_join", "secret_scans", "mix_sources", "cost_balanced_packing"]

    def step(name, df):
        out = stages[name](spark, df, str(tmp_path))
        assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    kept = step("language_id", docs)
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in given} - {200, 201, 401, 402}
    one = step("ngram_jaccard_join", kept)
    pairs = [(r["doc_id"], r["text"]) for r in kept.collect()]
    _, component = brute(pairs, 5, 80)
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({i for i in component if component[i] == i})
    assert one.count() < kept.count()
    masked = step("secret_scans", one)
    was = {r["doc_id"]: r["text"] for r in one.collect()}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in masked.collect()} == {i: (mask(t), len(mask(t))) for i, t in was.items()}
    mixed = step("mix_sources", masked)
    times = {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    from tidemart.llm.mixing import mix

    plan = mix(masked).collect()
    check_mix([tuple(r[c] for c in ("doc_id", "text", "lang", "source")) for r in masked.collect()], plan, 1.0)
    assert times == {r["doc_id"]: r["taken"] // r["size"] for r in plan if r["taken"]}
    pieces = stages["cost_balanced_packing"](spark, mixed, str(tmp_path)).collect()
    check_pieces([(r["doc_id"], r["text"]) for r in mixed.collect()], pieces)

    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    key = lambda r: tuple(r[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))
    assert sorted(map(key, ran)) == sorted(map(key, pieces))


def test_empty_documents(spark, documents, tmp_path):
    documents([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_repeated_rows_nulls_and_extra_columns(spark, tmp_path):
    text = " ".join(ENGLISH * 4)
    df = spark.createDataFrame([(1, text, "en", "s", 5, "x"), (1, text, "en", "s", 5, "x"), (None, text, "en", None, None, None),
                                (None, None, None, None, None, None), (2, "the of and to " * 9, "en", "s", 0, "y")],
                               "doc_id bigint, text string, lang string, source string, n_chars bigint, size string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in ran} <= {1, 2, None} and len(ran) > 0


def test_columns_named_like_results_stay(spark, documents, tmp_path):
    """Extra columns pass every stage as they are, whatever their names."""
    given = rows()[:30]
    extra = {"language": "mine", "language_prob": 7, "accepted": "no", "declared_prob": 1, "a.b": 3, "row": 5, "doc": "d"}
    docs = documents(given).select("*", *(F.lit(v).alias(k) for k, v in extra.items()))
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept = docs.collect()
        assert kept and all(r[k] == v for r in kept for k, v in extra.items()), name
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).collect()
    assert pieces
