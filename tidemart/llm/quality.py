"""Quality by ordinal cumulative-link regression on graded ratings.

All grades share one weight vector over hashed words; ordered thresholds cut
the score: P(grade <= k) = logistic(threshold_k - score).  The model is fitted
on a bounded, seeded sample of rated documents and has a fixed size; every
document is scored in one scan without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import row_blocks, text_buffers
from tidemart.llm.textkernel import NO_LETTER, SPACE, mix, word_bounds, word_hashes

#: Hash buckets of words; the model is this many weights and one threshold a grade.
BUCKETS = 1 << 18


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def at_most(self, score: np.ndarray) -> np.ndarray:
        """P(grade <= k) of each score for all k but the last grade."""
        return 1.0 / (1.0 + np.exp(np.clip(score[:, None] - self.thresholds[None, :], -60, 60)))


def _features(batch) -> list[np.ndarray]:
    """Distinct buckets of each text's words and of its runs of letters, whole texts."""
    data, offsets = text_buffers(batch.column("text"))
    out = []
    for i, j in row_blocks(offsets):
        own = offsets[i : j + 1]
        block, places = data[own[0] : own[-1]], []
        for salt, space in enumerate((SPACE, NO_LETTER)):
            begin, end, first = word_bounds(block, own - own[0], space)
            keys = word_hashes(block, begin, end, space=space)
            places.append(((mix(keys + np.uint64(salt)) >> np.uint64(46)).astype(np.int32), first.tolist()))
        (words, w), (runs, r) = places
        out += [np.unique(np.concatenate([words[w[k] : w[k + 1]], runs[r[k] : r[k + 1]]])) for k in range(j - i)]
    return out


def fit_ordinal(flat: np.ndarray, offsets: np.ndarray, grades: np.ndarray, levels: int, steps_least: int = 3000, rate: float = 0.15,
                decay: float = 2e-4, batch: int = 64, seed: int = 5) -> Model:
    """Cumulative-link fit by AdaGrad on shuffled batches; row r has the buckets
    ``flat[offsets[r]:offsets[r + 1]]``.  Without rows the weights are 0."""
    weights, start = np.zeros(BUCKETS), np.linspace(-1, 1, levels + 1)[1:-1] * 2
    base, steps = start[0], np.log(np.maximum(np.diff(start), 1e-3))
    past, past_t = np.full(BUCKETS, 1e-2), np.full(levels - 1, 1e-2)
    rng = np.random.default_rng(seed)
    sizes = np.diff(offsets)
    epochs = int(np.clip(steps_least * batch / max(len(grades), 1), 6, 60)) if len(grades) else 0
    for _ in range(epochs):
        order = rng.permutation(len(grades))
        for s in range(0, len(order), batch):
            rows = order[s : s + batch]
            row, ends = np.repeat(np.arange(len(rows)), sizes[rows]), np.cumsum(sizes[rows])
            own = flat[np.repeat(offsets[rows] - (ends - sizes[rows]), sizes[rows]) + np.arange(len(row))]
            score = np.bincount(row, weights[own], minlength=len(rows))
            thresholds = base + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
            cut = np.concatenate([[-60.0], thresholds, [60.0]])
            y = grades[rows]
            hi, lo = (1.0 / (1.0 + np.exp(-np.clip(cut[y + k] - score, -60, 60))) for k in (1, 0))
            p = np.maximum(hi - lo, 1e-9)
            slope_hi, slope_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
            to_score = (slope_hi - slope_lo) / len(rows)  # of the negative log likelihood
            gradient = np.bincount(own, to_score[row], minlength=BUCKETS)
            used = np.flatnonzero(gradient)
            gradient = gradient[used] + decay * weights[used] / len(rows)
            past[used] += gradient**2
            weights[used] -= rate * gradient / np.sqrt(past[used])
            by_cut = np.zeros(levels + 1)
            np.add.at(by_cut, y + 1, -slope_hi / len(rows))
            np.add.at(by_cut, y, slope_lo / len(rows))
            by_cut = by_cut[1:levels]
            g = np.concatenate([[by_cut.sum()], np.cumsum(by_cut[::-1])[::-1][1:] * np.exp(steps)])
            past_t += g**2
            move = rate * g / np.sqrt(past_t)
            base, steps = base - move[0], steps - move[1:]
    return Model(weights, base + np.concatenate([[0.0], np.cumsum(np.exp(steps))]))


def train(docs: DataFrame, ratings: DataFrame, levels: int, sample: int = 40_000) -> Model:
    """Fit on at most ``sample`` rated documents, the first in a seeded order
    (this bound is what the driver holds; scoring covers all documents).
    ``ratings`` has doc_id and grade from 0; other grades and nulls are left
    out.  Of several rows of one rated doc_id the one with the smallest text
    counts, so the bound holds for the rows that reach the driver."""
    rated = (ratings.filter(F.col("grade").between(0, levels - 1) & F.col("doc_id").isNotNull())
             .select("doc_id", F.col("grade").cast("int").alias("grade")).distinct()
             .orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"),
                                              pa.array(_features(batch), pa.list_(pa.int32()))], ["doc_id", "grade", "f"])

    texts = (docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(rated), "doc_id")
             .groupBy("doc_id", "grade").agg(F.min("text").alias("text")))
    found = texts.mapInArrow(run, T_FEATURES.format(dict(docs.dtypes)["doc_id"])).select("doc_id", "grade", "f").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("grade", "ascending")])
    column = found.column("f").combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return fit_ordinal(flat, np.concatenate([[0], np.cumsum(sizes)]), found.column("grade").to_numpy(), levels)


T_FEATURES = "doc_id {}, grade int, f array<int>"


def score(docs: DataFrame, model: Model, keep: float = 0.5) -> DataFrame:
    """(doc_id, expected_grade, tail_prob, kept) for each row of ``docs(doc_id, text)``.

    tail_prob is the probability of the highest grade; kept says that it is
    ``keep`` or more.  Null and empty texts have no words: their score is 0.
    Repeated rows and null doc_ids are scored as they stand; other columns are
    ignored; an empty table gives an empty result.
    """
    sent = model.weights.astype(np.float32), model.thresholds

    def run(batches):
        own = Model(sent[0].astype(np.float64), sent[1])
        for batch in batches:
            features = _features(batch)
            row = np.repeat(np.arange(len(features)), [len(f) for f in features])
            flat = np.concatenate([np.empty(0, np.int32), *features])
            below = own.at_most(np.bincount(row, own.weights[flat], minlength=len(features)))
            expected, tail = (1.0 - below).sum(axis=1), 1.0 - below[:, -1]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.round(expected, 6)), pa.array(np.round(tail, 6)),
                                              pa.array(tail >= keep)], ["doc_id", "expected_grade", "tail_prob", "kept"])

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, expected_grade double, tail_prob double, kept boolean")


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of labels (doc_id, quality, toxic): 0 for toxic, 1 for
    poor but harmless, 2 for good; rows with a null label are left out."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.filter("quality IS NOT NULL AND toxic IS NOT NULL").select("doc_id", grade.alias("grade"))


def grade_documents(docs: DataFrame, labels: DataFrame, sample: int = 40_000) -> DataFrame:
    """Fit on the labelled documents, then score all."""
    return score(docs, train(docs, graded(labels), 3, sample))
