"""Token alignment against a plain walk over both sides' tokens."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from helpers import SF_SMALL
from tidemart.llm import alignment as L

PATHS = (P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.PATTERN)


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    letters = L._byte_letters()
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])

    def encode(text):
        one = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        two = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            two.append((i, bytes([int(piece[3:5], 16)]) if piece[:3] == "<0x" and len(piece) == 6 else piece.replace("▁", " ").encode()))
        return one, two

    return encode


def brute(texts, encode):
    """Of each text (n_a, n_b, n_groups, links as a Counter of id pairs, groups)."""
    out = []
    for text in texts:
        one, two = encode(text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in one) != raw or b"".join(t for _, t in two) != raw:
            out.append((0, 0, 0, Counter(), ""))
            continue
        spans = []
        for side in (one, two):
            at, own = 0, []
            for i, t in side:
                own.append((at, at + len(t), i))
                at += len(t)
            spans.append(own)
        links, k = Counter(), 0
        for s, e, i in spans[0]:
            while spans[1][k][1] <= s:
                k += 1
            m = k
            while m < len(spans[1]) and spans[1][m][0] < e:
                links[i, spans[1][m][2]] += 1
                m += 1
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, last = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in own if last < e <= end) for own in spans))
            last = end
        out.append((len(one), len(two), len(groups), links, ";".join(groups)))
    return out


TEXTS = [None, "", " ", "a", "  two  spaces ", "line\nbreak\r\n\ttab", "naïve façade — “quotes” …", "日本語のテキスト", "😀👍🏽 emoji", "<|endoftext|> <s> </s> <unk> <0x41>",
         "▁ under", "x▁y", "nul\x00byte", "\x1c\x85  ", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "don't they've I'll 1234567 3.14", "ﬁ ligature Å Å", "word " * 3000,
         "Ωμέγα Привет שלום नमस्ते", "﻿bom", "end "]


def check(given, got, encode):
    plain = brute([t for _, t in given], encode)
    key = lambda r: tuple(str(x) for x in r)
    want = sorted(((i, a, b, g, sum(links.values()), groups, sorted((x, y, n) for (x, y), n in links.items()))
                   for (i, _), (a, b, g, links, groups) in zip(given, plain)), key=key)
    assert sorted(((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups"], [tuple(p) for p in r["pairs"]]) for r in got), key=key) == want
    return plain


def test_awkward_texts(documents, sides):
    given = [*enumerate(TEXTS), (None, "the same words"), (None, None), (3, "a"), (3, "a")]
    plain = check(given, L.align(documents(given).selectExpr("*", "'mine' AS groups", "1 AS `a.b`"), *PATHS).collect(), sides)
    assert sum(p[0] > 0 for p in plain) > 15 and plain[10][0] == 0  # a text with the space mark isn't spelled
    assert L.align(documents([]), *PATHS).count() == 0


@pytest.mark.parametrize("pair_rows", [L.PAIR_ROWS, 0])
def test_digests(documents, sides, pair_rows):
    given = [*enumerate(TEXTS * 2), (None, "the same words"), (None, "the same words"), (3, "a")]
    plain = brute([t for _, t in given], sides)
    held = Counter(pair for p in plain for pair in p[3])
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    want = sorted((str(i), a, b, g, sum(links.values()), sum(n for (x, y), n in links.items() if held[x, y] == top[x]),
                   sum(n * held[p] for p, n in links.items()), hashlib.sha256(groups.encode()).hexdigest() if a else "")
                  for (i, _), (a, b, g, links, groups) in zip(given, plain))
    got = L.align_digests(documents(given), *PATHS, pair_rows=pair_rows).collect()
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got) == want
    assert L.align_digests(documents([]), *PATHS, pair_rows=pair_rows).count() == 0


def test_fast_side_equals_the_files_own(spark):
    side = L.ByteLevel(PATHS[0], PATHS[2])
    assert side.fast
    texts = [" " + t for t in TEXTS if t] + [" " + r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("text IS NOT NULL").collect()]
    assert side(texts) == [side.whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_table(spark, sides):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    given = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    check(given, L.align(docs, *PATHS).collect(), sides)


def test_very_long_runs():
    """No tokenizer gives up on a megabyte without a break."""
    one, two = L.ByteLevel(PATHS[0], PATHS[2]), L.Pieces(PATHS[1])
    for text in ("x" * 300_000, " " * 300_000, "é" * 200_000, "!" * 300_000):
        for side, given, raw in ((one, " " + text, " " + text), (two, text, " " + text)):
            assert b"".join(side.bytes[i] for i in side([given])[0]) == raw.encode()
