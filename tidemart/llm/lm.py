"""Stupid-backoff scores of documents against all other documents.

Documents are dealt to shards of bounded size.  A shard sends its distinct
n-grams, as hashes with counts, to the n-gram count tables, which are
partitioned by hash; each partition adds up its n-grams over all shards and
answers every shard with the counts of what it sent in all other shards.  Joined
back to the shard's documents, these and the shard's own counts less the
document's give the scores, which are summed by document.  N-grams travel once a
shard, in blocks of sorted hashes, never once an occurrence; texts and counts
travel compressed.

From n = 3 on, each n is a round of its own: an n-gram can occur in another row
only if both (n-1)-grams in it do, so a shard sends only those that still can.
All rows that share an n-gram find that it can and send it; what nobody sends
counts 0 elsewhere, so no count changes.  For this they are told only whether
other shards have the shorter ones, not how often.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import WORD_PATTERN, row_blocks, text_buffers
from tidemart.llm.textkernel import window_hashes, word_bounds, word_hashes

#: Bytes of text in a shard, on average.
SHARD_BYTES = 8 << 20


def _squeeze(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane (the high planes are nearly all zero)."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _spread(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts with the fewest bytes that hold them, compressed; before them, how many bytes and counts there are."""
    width = next(w for w in (1, 2, 4, 8) if not len(counts) or int(counts.max()) < 1 << 8 * w)
    return bytes([width]) + len(counts).to_bytes(8, "little") + pa.compress(counts.astype(f"<u{width}").tobytes(), codec="zstd", asbytes=True)


def _wide(data: bytes) -> np.ndarray:
    width, size = data[0], int.from_bytes(data[1:9], "little")
    return np.frombuffer(pa.decompress(data[9:], width * size, codec="zstd", asbytes=True), f"<u{width}").astype(np.int64)


def _packed(batches):
    """The rows with their texts compressed: UTF-8 bytes and how many they are."""
    codec = pa.Codec("zstd")
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        bounds = offsets.tolist()
        packed = [codec.compress(data[a:b], asbytes=True) if b > a else b"" for a, b in zip(bounds, bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("shard"), pa.array(np.diff(offsets)), pa.array(packed, pa.binary())],
            ["doc_id", "shard", "size", "packed"])


def _unpacked(texts: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of the rows."""
    codec, sizes = pa.Codec("zstd"), texts.column("size").to_numpy()
    data = b"".join(codec.decompress(p.as_buffer(), n, asbytes=True) for p, n in zip(texts.column("packed"), sizes.tolist()) if n)
    return np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _grams(texts: pa.Table, order: int):
    """Word index of each text's start, and for each n the hashes of the
    n-grams that end at each word (0 where the text has fewer words before)."""
    data, offsets = _unpacked(texts)
    words, first = [], [0]
    for i, j in row_blocks(offsets, 1 << 22):
        own = offsets[i : j + 1]
        begin, end, at = word_bounds(data[own[0] : own[-1]], own - own[0])
        words.append(word_hashes(data[own[0] : own[-1]], begin, end))
        first += (at[1:] + first[-1]).tolist()
    words, first = np.concatenate([np.empty(0, np.uint64), *words]), np.array(first)
    place = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    levels = []
    for n in range(1, order + 1):
        level = np.zeros(len(words), np.uint64)
        level[n - 1 :] = window_hashes(words, n)
        level[place < n - 1] = 0
        levels.append(level)
    return first, place, levels


def _there(n: int, place: np.ndarray, others: list) -> np.ndarray:
    """Words at which an n-gram ends that can occur in other rows, by the counts of the shorter ones."""
    there = place >= n - 1
    if n > 2:
        shorter = others[n - 2] > 0
        there &= shorter
        there[1:] &= shorter[:-1]
    return np.flatnonzero(there)


def _others(first, place, levels, answers: pa.Table, least: int = 1) -> list:
    """For each n and word, how often the n-gram that ends there occurs in other rows; nothing for n < ``least``.
    Answers that only say whether other shards have it leave only whether other rows do."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    answers = answers.sort_by([("n", "ascending"), ("part", "ascending")])
    level_of, elsewhere = answers.column("n").to_numpy(), answers.column("elsewhere").to_pylist()
    others = [None] * (least - 1)
    for n, level in enumerate(levels[least - 1 :], least):
        there = _there(n, place, others)
        keys, at, known = np.unique(level[there], return_inverse=True, return_counts=True)
        known = known + np.concatenate([np.empty(0, np.int64), *(_wide(elsewhere[i]) for i in np.flatnonzero(level_of == n))])
        # A row's own count of each n-gram: equal (row, n-gram) pairs lie together when sorted.
        pair = row[there] * len(keys) + at
        _, which, own = np.unique(pair, return_inverse=True, return_counts=True)
        left = np.zeros(len(level), np.int64)
        left[there] = known[at] - own[which]
        others.append(left)
    return others


def stupid_backoff(docs: DataFrame, order: int = 3, alpha: float = 0.4) -> DataFrame:
    """(doc_id, n_words, n_backed_off, log_score) for each row of ``docs(doc_id, text)``.

    Words are split at ASCII white space, A-Z folded.  A word scores
    count(n-gram) / count(its first n-1 words) for the longest history of up to
    ``order`` - 1 words of its text whose n-gram occurs in other rows, times
    ``alpha`` for each word of history given up; at the end, its count (1 at
    least) over the number of words in other rows (1 at least).  Counts leave
    the row's own text out.  log_score is the sum of natural logarithms,
    rounded to six digits; n_backed_off counts words that gave up history.
    Null and empty texts score 0.  Repeated rows and null doc_ids are rows of
    their own.  Other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total, words = docs.agg(F.sum(F.octet_length("text").cast("bigint") + 64),
                            F.sum(F.regexp_count("text", F.lit(WORD_PATTERN)))).first()
    total, words = total or 0, words or 0
    shards = -(-total // SHARD_BYTES) or 1
    parts = -(-shards * order // 2)
    dealt = docs.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards).cast("bigint")))
    dealt = dealt.select("doc_id", "shard", "text").mapInArrow(_packed, "doc_id bigint, shard bigint, size bigint, packed binary")

    def blocks_of(shard: int, grams: list[tuple[int, np.ndarray]]) -> pa.Table:
        out = {"part": [], "shard": [], "n": [], "keys": [], "counts": []}
        for n, level in grams:
            keys, counts = np.unique(level, return_counts=True)
            cuts = np.searchsorted(keys, np.array([(p << 64) // parts for p in range(parts)], np.uint64))
            for p, (a, b) in enumerate(zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)])):
                if b > a:
                    for name, value in zip(out, (p, shard, n, _squeeze(keys[a:b]), _narrow(counts[a:b]))):
                        out[name].append(value)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types)})

    def ask(data: pa.Table) -> pa.Table:
        _, place, levels = _grams(data, min(order, 2))
        return blocks_of(data.column("shard")[0].as_py(), [(n, level[_there(n, place, [])]) for n, level in enumerate(levels, 1)])

    def ask_longer(n: int):
        def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
            first, place, levels = _grams(texts, n)
            others = _others(first, place, levels[:-1], answers, least=2)
            return blocks_of(texts.column("shard")[0].as_py(), [(n, levels[-1][_there(n, place, others)])])

        return run

    def answer(most: int | None = None):
        def run(data: pa.Table) -> pa.Table:
            blocks = [_spread(k) for k in data.column("keys").to_pylist()]
            counts = [_wide(c) for c in data.column("counts").to_pylist()]
            levels, elsewhere = data.column("n").to_numpy(), [b""] * len(blocks)
            for n in np.unique(levels):
                own = np.flatnonzero(levels == n).tolist()
                keys, at = np.unique(np.concatenate([blocks[i] for i in own]), return_inverse=True)
                summed = np.zeros(len(keys), np.int64)
                np.add.at(summed, at, np.concatenate([counts[i] for i in own]))
                for i in own:
                    left = summed[np.searchsorted(keys, blocks[i])] - counts[i]
                    elsewhere[i] = _narrow(left if most is None else np.minimum(left, most))
            return pa.table({**{c: data.column(c) for c in ("shard", "n", "part")}, "elsewhere": pa.array(elsewhere, pa.binary())})

        return run

    block, reply = "part bigint, shard bigint, n int, keys binary, counts binary", "shard bigint, n int, part bigint, elsewhere binary"
    asked = dealt.groupBy("shard").applyInArrow(ask, block)
    answers = asked.groupBy("part").applyInArrow(answer(), reply)
    known = asked.groupBy("part").applyInArrow(answer(1), reply).filter("n > 1")
    for n in range(3, order + 1):
        asked = dealt.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(ask_longer(n), block)
        answers = answers.unionAll(asked.groupBy("part").applyInArrow(answer(), reply))
        known = known.unionAll(asked.groupBy("part").applyInArrow(answer(1), reply))

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        first, place, levels = _grams(texts, order)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        own_words = np.diff(first)[row]
        others = _others(first, place, levels, answers)
        # Of the words before: as often as the history occurs in other rows.
        value = np.maximum(others[0], 1) / np.maximum(words - own_words, 1)
        used = np.zeros(len(row), np.int64)
        for n in range(2, order + 1):
            seen = (place >= n - 1) & (others[n - 1] > 0)
            before = np.zeros(len(row), np.int64)
            before[1:] = others[n - 2][:-1]
            value = np.where(seen, others[n - 1] / np.maximum(before, 1), value)
            used[seen] = n - 1
        given_up = np.minimum(place, order - 1) - used
        logs = np.log(value) + given_up * np.log(alpha)
        sums = np.zeros(len(first) - 1)
        np.add.at(sums, row, logs)
        return pa.table({"doc_id": texts.column("doc_id"), "n_words": pa.array(np.diff(first)),
                         "n_backed_off": pa.array(np.bincount(row[given_up > 0], minlength=len(sums)), pa.int64()),
                         "log_score": pa.array(np.round(sums, 6) + 0.0)})

    return dealt.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(
        score, "doc_id bigint, n_words bigint, n_backed_off bigint, log_score double")
