"""Periodic runs of words, found on an enhanced suffix array.

A block of texts becomes one sequence of word numbers that no two texts share,
so no repeat spans texts.  Ranks of the 1, 2, 4, ... words from each place give
the suffix array, its inverse and, by halving steps, the LCP array.  One pass
over it lists the LCP intervals with their children.  For each interval of
depth d the suffixes i of all children but the largest are tested: if ISA[i+d]
or ISA[i-d] lies in the interval, but not in i's own child, then a square of
root length d starts there that can't be rotated to the right (a branching
tandem).  Rotated to the left as far as it goes, it is a maximal run; squares
of multiples of a period give the same stretch, of which the smallest stays.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import row_blocks, text_buffers
from tidemart.llm.textkernel import word_bounds, word_codes

#: Suffixes of small children that are tested at a time.
TESTED = 1 << 21
T_RUNS = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _dense(keys: np.ndarray) -> np.ndarray:
    """Rank of each key among the distinct ones, from 1."""
    order = np.argsort(keys)
    ranked = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    return out


def _doubled(rank: np.ndarray, step: int, stop: np.ndarray) -> np.ndarray:
    """Ranks of 2 * ``step`` words from those of ``step`` words; beyond a text's end is 0."""
    at = np.arange(len(rank)) + step
    behind = np.where(at < stop, rank[np.minimum(at, len(rank) - 1)], 0)
    return _dense(rank * (int(rank.max()) + 1) + behind)


def _bounds(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of the text of each place, and the one behind its last."""
    cut = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    size = np.diff(np.append(cut, len(row)))
    return np.repeat(cut, size), np.repeat(cut + size, size)


def _with_repeats(codes: np.ndarray, row: np.ndarray, words: int) -> np.ndarray:
    """Rows in which some stretch of ``words`` words (a power of two) occurs twice; all others can't hold a run
    that has so many words besides its first period."""
    step = 1
    while len(codes):
        rank = _dense(row * (int(codes.max()) + 1) + codes) if step == 1 else _doubled(rank, step // 2, _bounds(row)[1])
        again = np.unique(row[np.bincount(rank)[rank] > 1])
        if step == words:
            return again
        kept = np.isin(row, again)
        codes, row, rank, step = codes[kept], row[kept], rank[kept], step * 2
    return row


def _small_children(lcp: np.ndarray) -> np.ndarray:
    """(depth, first, last, child's first, child's last) for each child but the largest of each LCP interval.
    ``lcp[p]`` is that of the suffixes p - 1 and p; ``lcp[0]`` is 0."""
    out: list[tuple[int, int, int, int, int]] = []
    depths, children = [0], [[0]]
    for p, depth in enumerate([*lcp[1:].tolist(), 0], 1):
        left = p - 1
        while depths[-1] > depth:
            d, starts = depths.pop(), children.pop()
            starts += [left, p]
            sizes = [b - a for a, b in zip(starts, starts[1:])]
            largest = sizes.index(max(sizes))
            out += [(d, starts[0], p - 1, a, b - 1) for k, (a, b) in enumerate(zip(starts, starts[1:])) if k != largest]
            left = starts[0]
        if depths[-1] < depth:
            depths.append(depth)
            children.append([left])
        elif depth:
            children[-1].append(left)
    return np.array(out, np.int64).reshape(-1, 5)


def _branching(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """(place, root length) of all squares that can't be rotated to the right, each once."""
    nodes = _small_children(lcp)
    ends, found, k = np.cumsum(nodes[:, 4] - nodes[:, 3] + 1), [np.empty((0, 2), np.int64)], 0
    while k < len(nodes):
        j = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + TESTED, "right")))
        size = nodes[k:j, 4] - nodes[k:j, 3] + 1
        depth, first, last, own, own_last = np.repeat(nodes[k:j], size, axis=0).T
        place = sa[own + np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)]
        for other, square, inside in ((place + depth, place, place + depth < stop[place]),
                                      (place - depth, place - depth, place - depth >= start[place])):
            at = isa[np.clip(other, 0, len(sa) - 1)]
            hit = inside & (at >= first) & (at <= last) & ((at < own) | (at > own_last))
            found.append(np.stack([square[hit], depth[hit]], axis=1))
        k = j
    return np.unique(np.concatenate(found), axis=0)


def runs_of(codes: np.ndarray, row: np.ndarray, least: int = 24, repeats: int = 3) -> np.ndarray:
    """(first place, length, smallest period) of all maximal runs of at least ``least`` words and ``repeats``
    periods, by first place and period.  ``codes`` are word numbers, ``row`` the ascending number of their text."""
    if not len(codes):
        return np.empty((0, 3), np.int64)
    start, stop = _bounds(row)
    levels, step = [_dense(row * (int(codes.max()) + 1) + codes)], 1
    while levels[-1].max() < len(codes):
        levels.append(_doubled(levels[-1], step, stop))
        step *= 2
    isa = levels.pop() - 1
    sa = np.empty(len(isa), np.int64)
    sa[isa] = np.arange(len(isa))
    lcp = np.zeros(len(sa), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = sa[1:] + lcp[1:], sa[:-1] + lcp[1:]
        inside = (a < stop[sa[1:]]) & (b < stop[sa[:-1]])
        a, b = np.where(inside, a, 0), np.where(inside, b, 0)
        lcp[1:] += (inside & (levels[k][a] == levels[k][b])) << k
    square, period = _branching(sa, isa, lcp, start, stop).T
    turns = np.zeros(len(square), np.int64)  # rotations to the left, by powers of two
    for k in range(len(levels) - 1, -1, -1):
        at = square - turns - (1 << k)
        inside = at >= start[square]
        at = np.where(inside, at, square)
        turns += (inside & (levels[k][at] == levels[k][at + period])) << k
    begin, length = square - turns, turns + 2 * period
    long = length >= np.maximum(least, repeats * period)
    begin, length, period = begin[long], length[long], period[long]
    order = np.lexsort((period, length, begin))
    begin, length, period = begin[order], length[order], period[order]
    same = np.zeros(len(begin), bool)
    same[1:] = (begin[1:] == begin[:-1]) & (length[1:] == length[:-1])
    out = np.stack([begin, length, period], axis=1)[~same]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def find_runs(docs: DataFrame, least: int = 24, repeats: int = 3) -> DataFrame:
    """(doc_id, runs, collapsed) for each row of ``docs(doc_id, text)``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  A run is a stretch of
    at least ``least`` words and ``repeats`` times its smallest period that no
    neighbouring word extends; ``runs`` has all of them by start, then period.
    ``collapsed`` has the words that no run contains after its first period,
    joined by one space.  Null and empty texts have no words: no runs and an
    empty collapsed text.  Repeated rows and null doc_ids stand for
    themselves; other columns are ignored; an empty table gives an empty
    result.  A text is worked on whole, in one task, without any shuffle.
    """
    if least < 1 or repeats < 2:
        raise ValueError("a run has at least one word and two periods")
    # A run's words besides its first period occur twice; the largest power of two among so many of them.
    besides = 1 << ((least - least // repeats).bit_length() - 1)

    def work(data: np.ndarray, own: np.ndarray) -> tuple[list, list]:
        begin, end, first = word_bounds(data, own)
        codes, _ = word_codes(data, begin, end)
        row = np.repeat(np.arange(len(own) - 1), np.diff(first))
        raw = data.tobytes()
        texts, runs = [raw[a:b] for a, b in zip(own[:-1].tolist(), own[1:].tolist())], [[] for _ in range(len(own) - 1)]
        kept = np.isin(row, _with_repeats(codes, row, besides))
        words = np.flatnonzero(kept)
        found = runs_of(codes[kept], row[kept], least, repeats)
        found[:, 0] = words[found[:, 0]]
        drop = np.zeros(len(codes) + 1, np.int64)
        np.add.at(drop, found[:, 0] + found[:, 2], 1)
        np.add.at(drop, found[:, 0] + found[:, 1], -1)
        stays = np.cumsum(drop)[:-1] == 0
        for s, n, p in found.tolist():
            r = row[s]
            runs[r].append({"start": s - first[r], "length": n, "period": p})
        collapsed = []
        for r, text in enumerate(texts):
            parts = text.split()
            collapsed.append(b" ".join(compress(parts, stays[first[r] : first[r + 1]].tolist()) if runs[r] else parts))
        return runs, collapsed

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_blocks(offsets):
                own = offsets[i : j + 1]
                runs, collapsed = work(data[own[0] : own[-1]], own - own[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(runs, pa.list_(RUN)), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    ["doc_id", "runs", "collapsed"])

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {T_RUNS}")


def digests(found: DataFrame) -> DataFrame:
    """Counts, the run of greatest exponent and digests of the result of ``find_runs``, a row each."""
    best = F.aggregate("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select("doc_id", "n_runs", "best.start", "best.length", "best.period",
             F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def plant_repeats(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` in which about a tenth of the texts, chosen by the CRC of doc_id, end in a passage of
    their own, repeated to the text's length.  Null doc_ids and texts without words stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    # The words of texts that aren't chosen aren't split.
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("h"), g.alias("g")).select(
        "doc_id", "text", "g", F.when(F.col("h") % 10 == 0, words).alias("words"))
    n = F.size("words").cast("bigint")
    rows = rows.select("*", n.alias("n"), F.when(n > 0, F.col("g") % n).alias("a"))
    rows = rows.select("*", F.expr("1 + (n - a) div (3 + g % 8)").alias("p"))
    return rows.select("doc_id", F.expr("""
        CASE WHEN words IS NOT NULL AND n > 0 THEN array_join(concat(slice(words, 1, int(a)), slice(
            flatten(array_repeat(slice(words, int(a + 1), int(p)), int((n - a + p - 1) div p))), 1, int(n - a))), ' ')
        ELSE text END""").alias("text"))
