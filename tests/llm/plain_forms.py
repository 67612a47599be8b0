"""Plain Python forms that the operators are held against; used by several tests."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

WORD_BPE = __import__("public_tokenizers").path("word_bpe_49k.json")


def brute(rows, words, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets.setdefault(i, set()).add(
            frozenset(tuple(w[j:j + words]) for j in range(len(w) - words + 1)) if len(w) >= words
            else frozenset([tuple(w)] if w else []))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if i is not None)
    for i in ids:
        for j in ids:
            if i < j and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sets, {i: find(i) for i in ids}


def goals(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full, budget = set(), 1.5 * sum(sizes.values())
    while True:
        rest = budget - sum(2 * sizes[s] for s in full)
        pull = sum(weight[s] for s in names if s not in full)
        share = {s: rest * weight[s] / pull for s in names if s not in full}
        above = {s for s in share if share[s] > 2 * sizes[s]}
        if not above:
            return {s: float(2 * sizes[s]) if s in full else share[s] for s in names}
        full |= above


def check_mix(rows, got, near):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(r[0]), size(r[1])) for r in rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    want, taken = goals(sizes), {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["taken"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= near, (s, taken[s], want[s])


def check_pieces(rows, pieces):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want = sorted((i is None, i or 0, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows)
    owned = {}
    for p in pieces:
        owned.setdefault(p["doc_id"], []).append(p)
    for i in {r[0] for r in rows}:
        docs = [ids for n, d, ids in want if (None if n else d) == i]
        found = sorted((p["start"], p["length"], p["doc_tokens"], p["ids_crc32"]) for p in owned[i])
        cuts = {(s, n) for s, n, _, _ in found}
        if len(docs) == 1:
            assert [s for s, _, _, _ in found] == [0, *np.cumsum([n for _, n, _, _ in found]).tolist()][:-1]
            assert sum(n for _, n, _, _ in found) == len(docs[0]) and cuts
            for s, n, total, crc in found:
                assert total == len(docs[0]) and crc == zlib.crc32(np.array(docs[0][s:s + n], "<u4").tobytes())
        else:
            assert sum(n for _, n, _, _ in found) == sum(map(len, docs))
    filled = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == filled.get(p["sequence_id"], 0)
        filled[p["sequence_id"]] = p["offset"] + p["length"]
    assert max(filled.values(), default=0) <= 2048
    return filled
