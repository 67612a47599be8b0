"""Chat formatting: read back against the input."""

from __future__ import annotations

import hashlib
import itertools

from tidemart.llm.chat import digests, escape, format_conversations, read_back, unescape

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    out = {}
    for conv, own in itertools.groupby(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), key=lambda r: r[0]):
        turns = [(r or "", t or "") for _, _, r, t in sorted(own, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))]
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "a\\b <x> # y"), (1, 2, "assistant", "\\### Assistant: </turn> ok"),
    (1, 3, "assistant", "again\n"), (1, 4, "user", None), (1, 5, "assistant", ""), (2, 0, "assistant", "é😀</turn>\n### user:\n"),
    (3, None, "user", "late"), (3, 5, "user", "first"), (3, 5, "user", "first"), (4, 1, None, "no role"), (4, 2, "we:ird:\n", "\\l\\b\\h"),
    (None, 1, "user", "homeless"), (5, 1, "user", "x" * 100_000), (5, 2, "assistant", "\\" * 50_000),
]


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in digests(df).collect()}
    assert got == expected(ROWS)


def test_adjacent_turns_share_a_header_and_the_mask_covers_the_text(spark):
    out = {r["conv_id"]: r for r in format_conversations(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    assert out[1]["formatted"].count("### assistant:\n") == 2
    for r in out.values():
        assert sum(sum(m) for m in r["mask"]) == len(r["formatted"])
        assert r["formatted"].count("</turn>\n") == len(r["mask"])


def test_many_turns_and_empty_table(spark):
    rows = [(9, i, "user" if i % 3 else "assistant", f"t{i}") for i in range(2000)]
    back = read_back(format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()[0]
    assert [tuple(t) for t in back["turns"]] == [(r, t) for _, _, r, t in rows]
    assert digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_clashing_columns_are_ignored(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", "f", 3)], SCHEMA + ", formatted string, blocks int")
    assert digests(df).collect()[0]["n_turns"] == 1


def test_escapes_are_undone(spark):
    texts = ["".join(t) for t in itertools.product("\\<#:blhc", repeat=4)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.filter(unescape(escape(df["t"], True)) != df["t"]).count() == 0
    assert df.filter(escape(df["t"]).rlike("[<#]")).count() == 0


def test_native(spark):
    plan = digests(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
