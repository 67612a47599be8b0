"""Quality rules: a decision list learned from labelled statistics.

Statistics of whole texts are counted exactly in one scan.  On a bounded,
seeded sample of labelled documents, sequential covering learns an ordered
list of rules: each is grown as a conjunction of thresholds on ratios of these
statistics by information gain, pruned on held-out rows, and taken while it
stays precise there; then the rows it covers go.  The list becomes one ordered
conditional expression, which Spark evaluates on all documents' statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import row_blocks, text_buffers
from tidemart.llm.textkernel import SPACE, word_bounds, word_codes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_shouts", "n_flagged")
#: Ratios that a rule may test: name, numerator, denominator (None: the count itself).  Without words a ratio is 0.
RATIOS = (("words", "n_words", None), ("word_length", "word_chars", "n_words"), ("symbols_per_word", "n_symbols", "n_words"),
          ("duplicate_lines", "n_dup_lines", "n_lines"), ("repeated_words", "n_repeat_words", "n_words"),
          ("distinct_words", "n_distinct_words", "n_words"), ("words_per_line", "n_words", "n_lines"), ("upper_case", "n_upper", "word_chars"),
          ("digits", "n_digits", "word_chars"), ("shouts_per_word", "n_shouts", "n_words"), ("flagged", "n_flagged", None),
          ("flagged_words", "n_flagged", "n_words"))
#: Marks cut off a word before it is looked up in the list of flagged words.
MARKS = ".,;:!?\"'()[]"


def _marked(letters: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(letters)] = 1
    return out


SYMBOLS, UPPER, DIGITS, SHOUTS = _marked(b"#*$%&|<>"), _marked(bytes(range(65, 91))), _marked(b"0123456789"), _marked(b"!?")
#: First bytes of UTF-8 characters outside of white space.
STARTS = ((~SPACE) & ((np.arange(256) & 0xC0) != 0x80)).astype(np.int64)


def _plain(words: pa.Array) -> pa.Array:
    """Distinct words (binary UTF-8) in lower case without marks around them."""
    return pc.utf8_trim(pc.utf8_lower(words.cast(pa.string())), MARKS)


def _per_row(values: np.ndarray, own: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[own[1:]] - sums[own[:-1]]


def _repeated(codes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Words of each row that lie in some 3-word window found twice or more in it."""
    inside = row[2:] == row[:-2] if len(row) > 2 else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    size = int(codes.max()) + 1 if len(codes) else 1
    pair = codes[at] * size + codes[at + 1]
    if size > 1 << 20:  # keeps the exact number of three words within 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    triple, own = pair * size + codes[at + 2], row[at]
    order = np.lexsort((triple, own))
    same = (triple[order[1:]] == triple[order[:-1]]) & (own[order[1:]] == own[order[:-1]])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    words = np.zeros(len(codes), bool)
    for k in range(3):
        words[at[twice] + k] = True
    return np.bincount(row[words], minlength=n)


def _line_counts(block: np.ndarray, own: np.ndarray, word_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: lines with a word, and those of them that equal an earlier line of the row."""
    n, breaks = len(own) - 1, np.flatnonzero(block == 10)
    begin = np.sort(np.concatenate([own[:-1], breaks + 1]), kind="stable")
    row = np.repeat(np.arange(n), np.bincount(np.searchsorted(own, breaks, "right") - 1, minlength=n) + 1 if n else 0)
    end = np.append(begin[1:], own[-1])
    end = end - ((np.append(row[1:], n) == row) if n else 0)  # the break itself is in no line
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
    lines = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(block[block != 10].copy())])
    codes = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.searchsorted(word_starts, begin)
    worded = np.searchsorted(word_starts, end) > first
    codes, row = codes[worded], row[worded]
    distinct = np.unique(row * (int(codes.max()) + 1 if len(codes) else 1) + codes)
    with_words = np.bincount(row, minlength=n)
    return with_words, with_words - np.bincount(distinct // (int(codes.max()) + 1 if len(codes) else 1), minlength=n)


def _counts(block: np.ndarray, own: np.ndarray, flagged: pa.Array) -> list[np.ndarray]:
    n = len(own) - 1
    begin, end, first = word_bounds(block, own)
    codes, words = word_codes(block, begin, end)
    row, size = np.repeat(np.arange(n), np.diff(first)), max(len(words), 1)
    lines, repeats = _line_counts(block, own, begin)
    is_flagged = pc.is_in(_plain(words), value_set=flagged).to_numpy(zero_copy_only=False)
    return [np.diff(first), _per_row(STARTS[block], own), _per_row(SYMBOLS[block], own), repeats, _repeated(codes, row, n),
            lines, np.bincount(np.unique(row * size + codes) // size, minlength=n), _per_row(UPPER[block], own),
            _per_row(DIGITS[block], own), _per_row(SHOUTS[block], own), np.bincount(row[is_flagged[codes]] if len(codes) else row, minlength=n)]


def statistics(docs: DataFrame, flagged: list[str] = (), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and COUNTS of each row of ``docs(doc_id, text)``, whole texts, one scan, no shuffle.

    Words are ``[^\\x20\\x09-\\x0D]+``; word_chars their code points; n_symbols
    the characters ``#*$%&|<>``; n_lines the \\n-split lines with a word,
    n_dup_lines those that equal an earlier one; n_repeat_words the words in
    3-word windows found twice or more; n_shouts ``!`` and ``?``; n_flagged the
    words in ``flagged`` (lower case, marks around them cut off).  Null and
    empty texts count 0 everywhere.
    """
    listed = sorted(flagged)

    def run(batches):
        known = pa.array(listed, pa.string())
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_blocks(offsets):
                own = offsets[i : j + 1]
                found = _counts(data[own[0] : own[-1]], own - own[0], known)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in keep),
                                                  *(pa.array(x.astype(np.int64)) for x in found)], [*keep, *COUNTS])

    kinds = dict(docs.dtypes)
    texts = docs.select(*keep, F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in keep), *(f"{c} bigint" for c in COUNTS)]))


@dataclass(frozen=True)
class Condition:
    ratio: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.ratio} {'>=' if self.above else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _best(x: np.ndarray, bad: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold with the highest information gain (FOIL) over the covered rows ``x`` (a column a ratio)."""
    best, found = 1e-9, None
    p0, n0 = int(bad.sum()), int(len(bad) - bad.sum())
    base = np.log2(p0 / (p0 + n0))
    for c, (name, _, _) in enumerate(RATIOS):
        order = np.argsort(x[:, c], kind="stable")
        values, p = x[order, c], np.cumsum(bad[order])
        cut = np.flatnonzero(values[1:] > values[:-1])  # between the places cut and cut + 1
        below_p, below = p[cut], cut + 1
        for above, pos, total in ((False, below_p, below), (True, p0 - below_p, len(bad) - below)):
            gain = np.where(pos > 0, pos * (np.log2(np.maximum(pos, 1) / total) - base), 0.0)
            if len(gain) and gain.max() > best:
                k = int(gain.argmax())
                best, found = gain[k], Condition(name, above, float((values[cut[k]] + values[cut[k] + 1]) / 2))
    return best, found


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    names = [r[0] for r in RATIOS]
    out = np.ones(len(x), bool)
    for c in rule:
        v = x[:, names.index(c.ratio)]
        out &= v >= c.threshold if c.above else v < c.threshold
    return out


def learn(x: np.ndarray, bad: np.ndarray, precision: float = 0.9, least: int = 3, seed: int = 7, tries: int = 6) -> list[Rule]:
    """Sequential covering: ordered rules for the rows that are ``bad``.

    Two thirds of the rows grow a rule, one threshold after another, until it
    covers no good row or nothing gains; on the other third, trailing
    conditions go as long as (p - n) / (p + n) doesn't fall.  A rule is taken
    if it covers ``least`` bad rows or more there and at least ``precision`` of
    all rows it covers, grown or held out, are bad; then the rows it covers
    go.  The rows are dealt anew for each rule; ``tries`` rules that fail one
    after another end the list, as do too few bad rows.
    """
    rules: list[Rule] = []
    rng, left, failed = np.random.default_rng(seed), np.arange(len(bad)), 0
    while bad[left].sum() >= 3 * least and failed < tries:
        order = rng.permutation(left)
        third = len(order) // 3
        hold, grow = order[:third], order[third:]
        rule: Rule = ()
        covered = grow
        while bad[covered].any() and not bad[covered].all():
            gain, condition = _best(x[covered], bad[covered])
            if condition is None:
                break
            rule += (condition,)
            covered = covered[covers((condition,), x[covered])]

        def worth(k: int) -> float:
            hit = hold[covers(rule[:k], x[hold])]
            return (2 * bad[hit].sum() - len(hit)) / len(hit) if len(hit) else -1.0

        if rule:
            scores = [worth(k) for k in range(1, len(rule) + 1)]
            rule = rule[: int(np.argmax(scores)) + 1]
        hit, held = left[covers(rule, x[left])], hold[covers(rule, x[hold])]
        if not rule or bad[held].sum() < least or bad[held].mean() < precision or bad[hit].mean() < precision:
            failed += 1
            continue
        rules.append(rule)
        failed = 0
        left = left[~covers(rule, x[left])]
    return rules


def ratio(name: str) -> Column:
    """A ratio as a Spark expression over the columns of ``statistics``."""
    over, under = {r[0]: r[1:] for r in RATIOS}[name]
    if under is None:
        return F.col(over).cast("double")
    return F.when(F.col(under) > 0, F.col(over).cast("double") / F.col(under)).otherwise(0.0)


def expression(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; 0 if none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        holds = None
        for c in rule:
            one = ratio(c.ratio) >= c.threshold if c.above else ratio(c.ratio) < c.threshold
            holds = one if holds is None else holds & one
        out = F.when(holds, F.lit(k)) if out is None else out.when(holds, F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _sampled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Texts of at most ``sample`` labelled documents, the first in a seeded order, with ``harmful`` and ``bad``."""
    rated = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
             .groupBy("doc_id").agg((F.max("toxic") > 0).alias("harmful"), (F.min("quality") < 1).alias("poor"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(rated), "doc_id")
    return texts.select("doc_id", "text", "harmful", (F.col("harmful") | F.col("poor")).alias("bad"))


def flag_words(rated: DataFrame, most: int = 1000, least: int = 5, share: float = 0.9) -> list[str]:
    """At most ``most`` words, the most frequent first, that ``least`` rated documents or more hold, ``share`` of
    them harmful.  Documents that hold a word are counted by Spark."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            harmful = batch.column("harmful").to_numpy(zero_copy_only=False)
            for i, j in row_blocks(offsets):
                own = offsets[i : j + 1]
                block = data[own[0] : own[-1]]
                begin, end, first = word_bounds(block, own - own[0])
                codes, words = word_codes(block, begin, end)
                plain = _plain(words).dictionary_encode()
                of = plain.indices.to_numpy(zero_copy_only=False).astype(np.int64)[codes]
                row, size = np.repeat(np.arange(j - i), np.diff(first)), max(len(plain.dictionary), 1)
                held = np.unique(row * size + of)
                total = np.bincount(held % size, minlength=size)
                toxic = np.bincount(held % size, harmful[i:j][held // size].astype(float), minlength=size).astype(np.int64)
                if len(plain.dictionary):
                    yield pa.RecordBatch.from_arrays([plain.dictionary, pa.array(total), pa.array(toxic)], ["word", "docs", "harmful"])

    counts = rated.select("text", "harmful").mapInArrow(run, "word string, docs bigint, harmful bigint")
    found = (counts.groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("harmful").alias("harmful"))
             .filter((F.col("docs") >= least) & (F.col("harmful") >= share * F.col("docs")) & (F.col("word") != ""))
             .orderBy(F.desc("docs"), "word").limit(most))
    return [r["word"] for r in found.collect()]


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> tuple[list[str], list[Rule]]:
    """Flagged words and rules learned from labels (doc_id, quality 0/1, toxic 0/1): a document is bad if it is poor
    or toxic.  The driver holds a row of numbers for each of at most ``sample`` labelled documents that the base
    rule doesn't fail already; of repeated doc_ids the first rows in the order of their counts."""
    rated = _sampled(docs, labels, sample)
    flagged = flag_words(rated)
    rows = (statistics(rated, flagged, keep=("doc_id", "bad")).filter(~base_failed())
            .select(F.xxhash64("doc_id").alias("h"), "bad", *COUNTS, *[ratio(r[0]).alias(f"r_{r[0]}") for r in RATIOS])
            .orderBy("h", *COUNTS, "bad").limit(sample).drop("h", *COUNTS).toArrow())
    x = np.stack([rows.column(f"r_{r[0]}").to_numpy() for r in RATIOS], axis=1) if len(rows) else np.empty((0, len(RATIOS)))
    return flagged, learn(x, rows.column("bad").to_numpy().astype(bool) if len(rows) else np.empty(0, bool))


def judge(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> DataFrame:
    """doc_id, n_words, the base statistics, base_failed, kept and rule (the
    number of the learned rule that drops the document, 0 for none) for each
    row of ``docs(doc_id, text)``.

    A document with fewer than 50 words, or with over half of its words in
    repeated windows, fails the base rule and isn't kept; else the learned
    list decides.  Null and empty texts have no words and fail.  Without labels
    the list is empty.  Repeated rows and null doc_ids are judged as they
    stand (a null doc_id has no label); other columns are ignored; an empty
    table gives an empty result.
    """
    flagged, rules = train(docs, labels, sample)
    found = statistics(docs, flagged).withColumn("base_failed", base_failed()).withColumn("rule", expression(rules))
    return found.select("doc_id", *COUNTS[:5], "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"),
                        F.when(F.col("base_failed"), 0).otherwise(F.col("rule")).alias("rule"))
