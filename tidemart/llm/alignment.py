"""Alignment of two tokenizers' tokens by the bytes they cover.

Both sides tile the same bytes.  For each batch ``pandas.merge_asof``, keyed by
document, finds for each token start the other side's token that covers it;
both directions together are all overlaps.  Ends that both sides share cut a
document into its smallest groups of tokens that spell the same bytes.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import publish, row_blocks, text_buffers

#: The table of pair counts is broadcast up to so many rows (16 bytes of values each, about 150 MB as a hash table
#: in all); beyond it the same join runs as a shuffle join.
PAIR_ROWS = 4_000_000
PAIRS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())]))
T_ALIGNED = ("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
             "pairs array<struct<a: int, b: int, n: int>>")


class ByteLevel:
    """A byte-level BPE from its ``tokenizers`` file.  Texts are encoded by ``tiktoken`` from the same vocabulary,
    which is about five times as fast; that needs tokens in the order of their merges, else the file's own
    library encodes.  Special tokens inside texts are plain text."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        special = {t["id"] for t in model["added_tokens"]}
        letters = _byte_letters()
        self.bytes = [b""] * (max(model["model"]["vocab"].values()) + 1)
        for token, i in model["model"]["vocab"].items():
            self.bytes[i] = b"" if i in special else bytes(letters[c] for c in token)
        ranks = {t: i for i, t in enumerate(self.bytes) if t}
        merges = [m.split(" ", 1) if isinstance(m, str) else m for m in model["model"]["merges"]]
        made = [model["model"]["vocab"]["".join(m)] for m in merges]
        self.fast = made == list(range(256, 256 + len(made))) and all(bytes([b]) in ranks for b in range(256))
        if self.fast:
            import tiktoken

            self.encoding = tiktoken.Encoding("byte level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True

    def __call__(self, texts: list[str]) -> list[list[int]]:
        if self.fast:
            return [self.encoding.encode_ordinary(t) for t in texts]
        return [self.whole.encode(t, add_special_tokens=False).ids for t in texts]


def _byte_letters() -> dict[str, int]:
    """The byte of each letter of the byte-level alphabet: printable bytes are themselves, the others the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class Pieces:
    """A sentencepiece model: its pieces as bytes, byte pieces as the byte they name."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[1:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _tokens(ids: list[list[int]], rows: list[int], sizes: np.ndarray) -> pd.DataFrame:
    """Tokens of the texts one after another: row, id, first byte, byte behind the last."""
    flat = np.fromiter((i for one in ids for i in one), np.int64, sum(map(len, ids)))
    end = np.cumsum(sizes[flat])
    return pd.DataFrame({"row": np.repeat(np.array(rows, np.int64), [len(one) for one in ids]), "id": flat,
                         "start": end - sizes[flat], "end": end, "at": np.arange(len(flat))})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of all overlapping pairs, each pair once."""
    one = pd.merge_asof(a[["start", "row", "at"]], b[["start", "row", "at"]], on="start", by="row", suffixes=("_a", "_b"))
    two = pd.merge_asof(b[["start", "row", "at"]], a[["start", "row", "at"]].assign(begin=a["start"]), on="start", by="row", suffixes=("_b", "_a"))
    two = two[two["begin"] < two["start"]]  # tokens that start together are in the other direction already
    return (np.concatenate([one["at_a"], two["at_a"]]).astype(np.int64), np.concatenate([one["at_b"], two["at_b"]]).astype(np.int64))


def _spelled(a: pd.DataFrame, b: pd.DataFrame, cut_a: np.ndarray, cut_b: np.ndarray, marks: list[np.ndarray], n: int) -> list[str]:
    """Groups of each row as ``a1,a2|b1;a3|b2,b3``."""
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    ids_a, ids_b = a["id"].to_numpy(), b["id"].to_numpy()
    text = np.concatenate([np.where(cut_a, marks[1][ids_a], marks[0][ids_a]), np.where(cut_b, marks[3][ids_b], marks[2][ids_b])])[order].tolist()
    size = np.bincount(a["row"], minlength=n) + np.bincount(b["row"], minlength=n)
    ends = np.cumsum(size)
    return ["".join(text[e - s : e])[:-1] for s, e in zip(size.tolist(), ends.tolist())]


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs) for each row of ``docs(doc_id, text)``.

    Side A encodes a space and the text by the byte-level BPE in ``a_path``,
    cut by ``pattern`` first; side B encodes the text by the sentencepiece
    model in ``b_path``, which puts the space before it.  ``groups`` lists the
    ids of both sides between byte offsets where both have a token's end;
    n_links counts overlapping pairs of tokens, ``pairs`` gives each pair of
    ids with the number of its links.  A text that is null, empty or that
    either side doesn't spell byte by byte has no tokens: zeros, an empty text
    and no pairs.  Repeated rows and null doc_ids stand for themselves; other
    columns are ignored; an empty table gives an empty result.
    """

    def run(batches):
        sides = ByteLevel(a_path, pattern), Pieces(b_path)
        sizes = [np.array([len(t) for t in side.bytes], np.int64) for side in sides]
        marks = [np.array([f"{i}{mark}" for i in range(len(side.bytes))], object)
                 for side, both in zip(sides, (",|", ",;")) for mark in both]
        width = len(sides[1].bytes)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            _, offsets = text_buffers(batch.column("text"))
            for i, j in row_blocks(offsets):
                n, rows, ids = j - i, [], ([], [])
                for r in range(n):
                    text = texts[i + r]
                    if not text:
                        continue
                    both = sides[0]([" " + text])[0], sides[1]([text])[0]
                    raw = b" " + text.encode()
                    if all(b"".join([side.bytes[t] for t in own]) == raw for side, own in zip(sides, both)):
                        rows.append(r)
                        ids[0].append(both[0])
                        ids[1].append(both[1])
                a, b = (_tokens(own, rows, size) for own, size in zip(ids, sizes))
                end_a, end_b = a["end"].to_numpy(), b["end"].to_numpy()
                cut_a, cut_b = (np.isin(x, y, assume_unique=True) for x, y in ((end_a, end_b), (end_b, end_a)))
                at_a, at_b = overlaps(a, b)
                row = a["row"].to_numpy()[at_a]
                pair = a["id"].to_numpy()[at_a] * width + b["id"].to_numpy()[at_b]
                order = np.lexsort((pair, row))
                row, pair = row[order], pair[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (pair[1:] != pair[:-1])
                first = np.flatnonzero(new)
                parts = pa.StructArray.from_arrays(
                    [pa.array((pair[first] // width).astype(np.int32)), pa.array((pair[first] % width).astype(np.int32)),
                     pa.array(np.diff(np.append(first, len(row))).astype(np.int32))], fields=list(PAIRS.value_type))
                place = np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=n))]).astype(np.int32)
                count = lambda x: pa.array(np.bincount(x, minlength=n).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, n), count(a["row"]), count(b["row"]), count(a["row"].to_numpy()[cut_a]), count(row),
                     pa.array(_spelled(a, b, cut_a, cut_b, marks, n), pa.string()), pa.ListArray.from_arrays(pa.array(place), parts).cast(PAIRS)],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"])

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {T_ALIGNED}")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, docs, top) for the pairs of ids in ``pairs(pairs)``: in how many rows each is linked, and whether no
    other pair of its A id is in more rows.  Counts are added up before the shuffle.  The highest counts are a
    row for each id of side A: that side's vocabulary bounds them."""
    counts = (pairs.select(F.explode("pairs").alias("p")).select("p.a", "p.b")
              .groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs")))
    counts = publish(counts, "pair-counts")
    best = F.broadcast(counts.groupBy("a").agg(F.max("docs").alias("most")))
    return counts.join(best, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("top"))


def align_digests(docs: DataFrame, a_path: str, b_path: str, pattern: str, pair_rows: int = PAIR_ROWS) -> DataFrame:
    """Counts of ``align``, the groups' digest, and how the document's links
    rank among the corpus's: n_best links whose count is their A id's highest,
    count_sum of all links' counts (a pair's count: rows that hold it linked)."""
    aligned = align(docs, a_path, b_path, pattern)
    aligned = publish(aligned.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"), "pairs"), "aligned")
    counts = publish(pair_counts(aligned), "pair-tops")
    n_pairs = counts.count()
    counts = counts.select((F.shiftleft(F.col("a").cast("bigint"), 32) + F.col("b")).alias("pair"), "docs", "top")
    links = aligned.select("row", F.explode("pairs").alias("p")).select(
        "row", (F.shiftleft(F.col("p.a").cast("bigint"), 32) + F.col("p.b")).alias("pair"), F.col("p.n").alias("n"))
    sums = links.join(F.broadcast(counts) if n_pairs <= pair_rows else counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("top"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("docs")).alias("count_sum"))
    return aligned.drop("pairs").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("bigint").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("bigint").alias("count_sum"), "groups_sha256")
