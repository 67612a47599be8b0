"""Cost-balanced packing of tokenized documents into sequences.

A document of full sequences gives those as pieces of their own; what remains
is dealt by hash to shards of bounded size.  In a shard the number of sequences
is what its tokens need.  Documents go, in descending order of linear plus
quadratic attention cost, to the sequence of lowest cost that has room; the few
that fit nowhere are cut to fill the rooms left.  So a shard pads less than one
sequence in all.  Shards keep about the same size at every input size.
"""

from __future__ import annotations

import re
import sys
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import bound_batches, row_blocks, text_buffers
from tidemart.llm.textkernel import word_bounds, word_hashes

#: Bytes of text in a shard, on average.
SHARD_BYTES = 8 << 20
#: Distinct words, and bytes of them, whose ids a Python worker keeps; beyond, those not seen again go.
CACHE_WORDS = 800_000
CACHE_BYTES = 16 << 20
#: Words, and bytes of words, that are worked on at a time.
STEP_WORDS = 1 << 15
STEP_BYTES = 1 << 18


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes are themselves, the others the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in plain)}


BYTE_LETTERS = _byte_letters()


class _Buffer:
    """An array that grows by doubling."""

    def __init__(self, dtype):
        self.data, self.used = np.empty(1 << 16, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        if self.used + len(values) > len(self.data):
            bigger = np.empty(2 * (self.used + len(values)), self.data.dtype)
            bigger[: self.used] = self.data[: self.used]
            self.data = bigger
        self.data[self.used : self.used + len(values)] = values
        self.used += len(values)


class _Places:
    """Numbers 64-bit keys in the order they are added: a large sorted array
    and a small one, merged now and then."""

    def __init__(self):
        self.tiers = [(np.empty(0, np.uint64), np.empty(0, np.int32)) for _ in range(2)]
        self.used = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 if it is new."""
        out = np.full(len(keys), -1, np.int64)
        for own, places in self.tiers:
            if len(own):
                at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
                hit = own[at] == keys
                out[hit] = places[at[hit]]
        return out

    def add(self, keys: np.ndarray) -> None:
        """New keys, sorted, get the next numbers in this order."""
        new = (keys, (self.used + np.arange(len(keys))).astype(np.int32))
        self.used += len(keys)
        big, small = self.tiers
        small = self._merged(small, new)
        if len(small[0]) > 100_000 + len(big[0]) // 8:
            big, small = self._merged(big, small), (small[0][:0], small[1][:0])
        self.tiers = [big, small]

    @staticmethod
    def _merged(a, b):
        at = np.searchsorted(a[0], b[0])
        return np.insert(a[0], at, b[0]), np.insert(a[1], at, b[1])


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices from each ``begin`` on, ``size`` many."""
    ends = np.cumsum(size)
    return np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class WordIds:
    """Token ids of texts, word by word, for a tokenizer that drops white space
    and never merges across it.  Words seen before are looked up by their 64-bit
    hash and compared byte by byte; a word that only shares a known word's hash
    is encoded on its own."""

    #: Latin letters, then marks or none.
    PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F]+)([.,;:!?%&$#*]*)")

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype, self.marks = Tokenizer.from_file(path), np.dtype(dtype), {}
        # Only a tokenizer that lowers letters and spells bytes in this alphabet has the short way.
        samples = ["Straße", "ÉTÉ", "ñandú", "Hello", "abc", "Ångström", "ZÿŁĮ"]
        self.direct = all(self._letters(w) == self._whole(w) and self._whole(w + ",") == self._whole(w) + self._whole(",")
                          for w in samples)
        self.clear()

    def clear(self) -> None:
        """No words.  The word at a place has the ids start[place] to start[place + 1] of flat, and its bytes likewise."""
        self.places, self.seen = _Places(), _Buffer(bool)
        self.flat, self.start = _Buffer(self.dtype), _Buffer(np.uint32)
        self.spelled, self.spelled_at = _Buffer(np.uint8), _Buffer(np.uint32)
        for bounds in (self.start, self.spelled_at):
            bounds.extend(np.zeros(1, np.uint32))

    def _append(self, flat: _Buffer, bounds: _Buffer, values: np.ndarray, sizes: np.ndarray) -> None:
        bounds.extend(flat.used + np.cumsum(sizes))
        flat.extend(values)

    @staticmethod
    def _bounds(bounds: _Buffer, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and size of what belongs to each place."""
        begin = bounds.data[at].astype(np.int64)
        return begin, bounds.data[at + 1] - begin

    def _trim(self) -> None:
        """Keeps the words that were seen in several blocks since the last time, if these are few enough, or none."""
        keys, at = (np.concatenate(part) for part in zip(*self.places.tiers))
        again = self.seen.data[at]
        keys, at = keys[again], at[again]
        order = np.argsort(keys)
        keys, at = keys[order], at[order]
        parts = [(flat.data, *self._bounds(bounds, at)) for flat, bounds in ((self.flat, self.start), (self.spelled, self.spelled_at))]
        self.clear()
        if len(keys) <= CACHE_WORDS // 2 and parts[1][2].sum() <= CACHE_BYTES // 2:
            self.places.add(keys)
            self.seen.extend(np.zeros(len(keys), bool))
            for flat, bounds, (data, begin, size) in zip((self.flat, self.spelled), (self.start, self.spelled_at), parts):
                self._append(flat, bounds, data[_spans(begin, size)], size)

    def _letters(self, word: str) -> list[int]:
        """Ids of a word of Latin letters straight from the tokenizer's model,
        in the byte alphabet it was made for."""
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return [token.id for token in self.tokenizer.model.tokenize(word)]

    def _whole(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _learn(self, words: list[bytes]) -> None:
        self.seen.extend(np.zeros(len(words), bool))
        self._append(self.spelled, self.spelled_at, np.frombuffer(b"".join(words), np.uint8), np.array([len(word) for word in words], np.int64))
        sizes, ids = array("q"), array("I")
        for word in map(bytes.decode, words):
            match = self.direct and self.PLAIN.fullmatch(word)
            if match:
                letters, marks = match.groups()
                found = self._letters(letters)
                if marks:
                    if marks not in self.marks:
                        self.marks[marks] = self._whole(marks)
                    found = found + self.marks[marks]
            else:
                found = self._whole(word)
            sizes.append(len(found))
            ids.extend(found)
        self._append(self.flat, self.start, np.array(ids, self.dtype), np.array(sizes, np.int64))

    def _others(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places of the words that aren't spelled like the known word ``at``."""
        first, known = self._bounds(self.spelled_at, at)
        other = known != end - begin
        length = np.where(other, 0, known)
        unlike = data[_spans(begin, length)] != self.spelled.data[_spans(first, length)]
        if unlike.any():
            other[np.searchsorted(np.cumsum(length), np.flatnonzero(unlike), "right")] = True
        return np.flatnonzero(other)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of each text, given the UTF-8 bytes of all and their offsets."""
        if self.places.used > CACHE_WORDS or self.spelled.used > CACHE_BYTES:
            self._trim()
        begin, end, first = word_bounds(data, offsets)
        keys = word_hashes(data, begin, end, fold=False, limit=STEP_BYTES)
        order = np.argsort(keys)
        ranked = keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        distinct, samples = ranked[new], order[new]
        found = self.places.find(distinct)
        fresh = found < 0
        self.seen.data[found[~fresh]] = True
        if fresh.any():
            text = data.tobytes()
            self.places.add(distinct[fresh])
            self._learn([text[begin[k] : end[k]] for k in samples[fresh].tolist()])
        at = np.empty(len(keys), np.int64)
        at[order] = self.places.find(distinct)[np.cumsum(new) - 1]
        steps = [slice(i, i + STEP_WORDS) for i in range(0, len(at), STEP_WORDS)]
        others = np.concatenate([at[:0], *(s.start + self._others(data, begin[s], end[s], at[s]) for s in steps)])
        if len(others):
            at[others] = self.places.used + np.arange(len(others))  # numbers without a key
            self.places.used += len(others)
            self._learn([data[begin[k] : end[k]].tobytes() for k in others.tolist()])
        start, size = self._bounds(self.start, at)
        ids = np.concatenate([self.flat.data[:0], *(self.flat.data[_spans(start[s], size[s])] for s in steps)])
        ends = np.concatenate([[0], np.cumsum(size)])
        return [ids[a:b] for a, b in zip(ends[first[:-1]].tolist(), ends[first[1:]].tolist())]


def word_ids(path: str, dtype: str, run: str) -> WordIds:
    """This Python worker's lookup for the tasks of one run of the operator: a worker serves several of them,
    and what another run has learned is dropped.  ``fill`` drops it when the run needs it no more."""
    kept = vars(sys).get("tidemart_word_ids")
    if kept is None or kept[0] != (path, dtype, run):
        kept = vars(sys)["tidemart_word_ids"] = ((path, dtype, run), WordIds(path, dtype))
    return kept[1]


def place_pieces(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(piece, start in it, length, sequence, offset) for pieces in descending
    length, each shorter than ``capacity``."""
    count = -(-int(lengths.sum()) // capacity)
    cost, room = np.zeros(count), np.full(count, capacity, np.int64)
    out, left = [], []
    for p, n in enumerate(lengths.tolist()):
        open_cost = np.where(room >= n, cost, np.inf)
        s = int(open_cost.argmin())
        if open_cost[s] == np.inf:
            left.append((p, n))
            continue
        out.append((p, 0, n, s, capacity - int(room[s])))
        cost[s] += linear * n + quadratic * n * n
        room[s] -= n
    free = iter([s for s in np.lexsort((np.arange(count), cost)).tolist() if room[s]])
    s = next(free, None)
    for p, n in left:
        start = 0
        while start < n:
            take = min(n - start, int(room[s]))
            out.append((p, start, take, s, capacity - int(room[s])))
            start += take
            room[s] -= take
            if not room[s]:
                s = next(free, None)
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048,
         linear: float = 1.0, quadratic: float = 1.0 / 1024) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``docs`` has doc_id and text; ``tokenizer`` is the path of a tokenizers
    file that splits at white space.  A document is its ids, then ``end_id``; a
    null or empty text is the end id alone.  Pieces of a sequence lie from 0
    without gaps and hold ``capacity`` ids at most.  Repeated rows and rows
    with a null doc_id are documents of their own.  Other columns are ignored;
    an empty table gives an empty result.  ids_crc32 is that of the piece's
    ids as little-endian unsigned 32-bit numbers.
    """
    from tokenizers import Tokenizer

    dtype = "<u2" if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    run = uuid.uuid4().hex
    bound_batches(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text").cast("bigint") + 64)).first()[0] or 0
    shards = -(-total // SHARD_BYTES) or 1

    def cut(batches):
        encode, end = word_ids(tokenizer, dtype, run), np.array([end_id], dtype)
        for batch in batches:
            ids = batch.column("doc_id")
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_blocks(offsets):
                rows, own = [], offsets[i : j + 1]
                for r, tokens in enumerate(encode(data[own[0] : own[-1]], own - own[0]), i):
                    tokens = np.concatenate([tokens, end])
                    for start in range(0, len(tokens), capacity):
                        part = tokens[start : start + capacity]
                        crc = zlib.crc32(part.astype("<u4").tobytes())
                        rows.append((r, start, len(part), crc, len(tokens), part.tobytes() if len(part) < capacity else None))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(cols[0])), *[pa.array(c, pa.int64()) for c in cols[1:5]], pa.array(cols[5], pa.binary())],
                    ["doc_id", "start", "length", "crc", "doc_tokens", "ids"])

    pieces = docs.mapInArrow(cut, "doc_id bigint, start bigint, length bigint, crc bigint, doc_tokens bigint, ids binary")
    # Rows without a doc_id may be alike in all else: they are dealt by their place, so that no shard holds them all.
    place = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    shard = F.pmod(F.xxhash64("doc_id", "start", "length", "crc", "place"), F.lit(shards).cast("bigint"))

    def fill(data: pa.Table) -> pa.Table:
        vars(sys).pop("tidemart_word_ids", None)  # all texts are encoded
        data = data.sort_by([("length", "descending"), ("doc_id", "ascending"), ("crc", "ascending"), ("start", "ascending")])
        whole = int((data.column("length").to_numpy() >= capacity).sum())
        rest, base = data.slice(whole), data.column("shard")[0].as_py() << 32
        full = data.slice(0, whole)
        ids = rest.column("ids").to_pylist()
        lengths, starts, crcs = (rest.column(c).to_numpy() for c in ("length", "start", "crc"))
        rows = [(p, starts[p] + at, n, crcs[p] if n == lengths[p] else
                 zlib.crc32(np.frombuffer(ids[p], dtype)[at : at + n].astype("<u4").tobytes()), base + whole + s, offset)
                for p, at, n, s, offset in (place_pieces(lengths, capacity, linear, quadratic) if len(ids) else [])]
        cols = list(zip(*rows)) if rows else [[]] * 6
        take = pa.array(cols[0], pa.int64())
        parts = {"start": (full.column("start"), cols[1]), "length": (full.column("length"), cols[2]),
                 "ids_crc32": (full.column("crc"), cols[3]),
                 "sequence_id": (pa.array(base + np.arange(whole)), cols[4]), "offset": (pa.array(np.zeros(whole, np.int64)), cols[5])}
        out = {k: pa.chunked_array([pa.array(np.asarray(a)), pa.array(np.asarray(b, np.int64))], pa.int64()) for k, (a, b) in parts.items()}
        for c in ("doc_id", "doc_tokens"):
            out[c] = pa.chunked_array([*full.column(c).chunks, *rest.column(c).take(take).chunks], pa.int64())
        return pa.table({c: out[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")})

    return pieces.withColumn("place", place).withColumn("shard", shard).drop("place").groupBy("shard").applyInArrow(
        fill, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
