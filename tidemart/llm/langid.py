"""Language identification by Bayesian evidence fusion.

Four kinds of evidence add up as log probabilities: the text's likelihood
under each language's byte-trigram model, tempered because neighbouring
trigrams are not independent; the language the markup declares; and a prior for
the host, smoothed toward that of its address suffix, which is smoothed toward
the whole table's.  Models and priors come from grouped aggregation over all
rows: trigrams by declared language, then the languages that texts alone
suggest by host and by suffix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemart.llm.common import BROADCAST_ROWS, bound_batches, publish, row_blocks, text_buffers

#: Hash buckets of byte trigrams: the model is languages x buckets, whatever the input's size.
BUCKETS = 1 << 13

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


def _letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of letter bytes of each text."""
    before = np.concatenate([[0], np.cumsum(_LETTER[_LOWER[data]])])
    return before[offsets[1:]] - before[offsets[:-1]]


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each byte trigram within a text; anything but letters
    counts as one separator."""
    low = _LOWER[data]
    low[~_LETTER[low]] = 32
    if len(low) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = (row[:-2] == row[2:]) & ((low[:-2] != 32) | (low[1:-1] != 32)) & ((low[1:-1] != 32) | (low[2:] != 32))
    return row[:-2][inside], ((code[inside] * np.uint32(2654435761)) >> np.uint32(32 - 13)).astype(np.int64)


def _counts(docs: DataFrame, languages) -> np.ndarray:
    """Trigram counts by declared language over all rows."""
    def run(batches):
        for batch in batches:
            lang = pc.fill_null(batch.column("declared"), "").to_numpy(zero_copy_only=False)
            data, offsets = text_buffers(batch.column("text"))
            total = np.zeros((len(languages), BUCKETS), np.int64)
            for i, j in row_blocks(offsets):
                own = offsets[i : j + 1]
                row, bucket = _trigrams(data[own[0] : own[-1]], own - own[0])
                for k, name in enumerate(languages):
                    total[k] += np.bincount(bucket[(lang[i:j] == name)[row]], minlength=BUCKETS)
            k, b = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(b), pa.array(total[k, b])], ["k", "b", "n"])

    rows = docs.select("declared", "text").mapInArrow(run, "k bigint, b bigint, n bigint").groupBy("k", "b").agg(F.sum("n").alias("n"))
    out = np.zeros((len(languages), BUCKETS))
    for k, b, n in rows.collect():  # languages x buckets at most
        out[k, b] = n
    return out


def _model(counts: np.ndarray) -> np.ndarray:
    smooth = counts + 0.5
    return np.log(smooth / smooth.sum(axis=1, keepdims=True))


def _likelihoods(data, offsets, model, temper) -> tuple[np.ndarray, np.ndarray]:
    """For each text its tempered log likelihood by language, and its number of letter bytes."""
    n = len(offsets) - 1
    out, size = np.zeros((n, len(model))), np.zeros(n, np.int64)
    for i, j in row_blocks(offsets):
        own = offsets[i : j + 1]
        row, bucket = _trigrams(data[own[0] : own[-1]], own - own[0])
        size[i:j] = _letters(data[own[0] : own[-1]], own - own[0])
        for k, logs in enumerate(model):
            out[i:j, k] = np.bincount(row, logs[bucket], minlength=j - i)
    return out * temper, size


def host_of(url: Column) -> Column:
    """The host of an address in lower case, without user, port and a leading www."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1)
    return F.nullif(host, F.lit(""))


def identify(docs: DataFrame, text: str = "text", declared: str | None = "lang", host: str | None = "source",
             languages: tuple[str, ...] = ("de", "en", "es", "fr"), keep: list[str] | None = None, temper: float = 0.25,
             declared_error: float = 0.05, host_weight: float = 20.0, accept: float = 0.5) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all, if not given) and language,
    language_prob, declared_prob and accepted.

    ``declared`` may hold region tags (en-US); values outside ``languages`` say
    nothing.  ``host`` is a host name whose last label is its address suffix.
    accepted: the text has a letter, and the declared language, or without one
    the likeliest, has a probability of ``accept`` or more.  A null or empty
    text has no language and is not accepted.  Null hosts have the whole
    table's prior.  Columns of the four result names are replaced; repeated
    rows stay; an empty table gives an empty result.
    """
    names = ["language", "language_prob", "declared_prob", "accepted"]
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    nothing = F.lit(None).cast("string")
    label = F.lower(F.trim(F.split_part(F.col(f"`{declared}`").cast("string"), F.lit("-"), F.lit(1)))) if declared else nothing
    label = F.when(label.isin(*languages), label)
    place = F.col(f"`{host}`").cast("string") if host else nothing
    suffix = F.substring_index(place, ".", -1)
    rows = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), label.alias("declared"), place.alias("host"),
                       suffix.alias("suffix"), F.col(f"`{text}`").cast("string").alias("text"))
    bound_batches(docs.sparkSession)
    model = _model(_counts(rows, languages))
    size = len(languages)

    def guess(batches):
        for batch in batches:
            logs, grams = _likelihoods(*text_buffers(batch.column("text")), model, temper)
            best = pa.array(np.where(grams > 0, logs.argmax(axis=1), -1), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("suffix"), best], ["host", "suffix", "best"])

    seen = publish(rows.select("host", "suffix", "text").mapInArrow(guess, "host string, suffix string, best int")
                   .filter("best >= 0").groupBy("host", "suffix", "best").agg(F.count("*").alias("n")), "langid-hosts")
    by_all = dict(seen.groupBy("best").agg(F.sum("n")).collect())  # one row a language
    whole = np.array([by_all.get(k, 0) + 1.0 for k in range(size)])
    whole = (whole / whole.sum()).tolist()

    def smoothed(keys: list[str], above) -> DataFrame:
        counts = [F.sum(F.when(F.col("best") == k, F.col("n")).otherwise(0)).cast("double").alias(f"n{k}") for k in range(size)]
        total = sum((F.col(f"n{k}") for k in range(size)), F.lit(0.0))
        table = seen.filter("host IS NOT NULL").groupBy(*keys).agg(*counts)
        table = table if isinstance(above, list) else table.join(above.withColumnRenamed("prior", "above"), "suffix")
        parent = [F.lit(v) for v in above] if isinstance(above, list) else [F.col("above")[k] for k in range(size)]
        return table.select(*keys, F.array(*((F.col(f"n{k}") + host_weight * parent[k]) / (total + host_weight)
                                             for k in range(size))).alias("prior"))

    priors = publish(smoothed(["host", "suffix"], publish(smoothed(["suffix"], whole), "langid-suffixes")).drop("suffix"), "langid-priors")
    small = priors.count() <= BROADCAST_ROWS // 10
    joined = rows.drop("suffix").join(F.broadcast(priors) if small else priors, "host", "left")
    carried = [f"k{i}" for i in range(len(keep))]
    # A text that is kept is sent once.
    own_text = f"k{keep.index(text)}" if text in keep and dict(docs.dtypes)[text] == "string" else "text"

    def decide(batches):
        for batch in batches:
            logs, grams = _likelihoods(*text_buffers(batch.column(own_text)), model, temper)
            own = batch.column("prior").to_pylist()
            logs += np.log(np.array([p or whole for p in own]).reshape(-1, size))
            said = batch.column("declared").to_pylist()
            which = np.array([languages.index(d) if d else -1 for d in said], np.int64)
            tag = np.full((len(which), size), declared_error / max(size - 1, 1))
            tag[np.arange(len(which)), which] = 1.0 - declared_error
            logs += np.where((which >= 0)[:, None], np.log(tag), 0.0)
            probs = np.exp(logs - logs.max(axis=1, keepdims=True, initial=-np.inf))
            probs /= probs.sum(axis=1, keepdims=True)
            best = probs.argmax(axis=1)
            top, at = probs[np.arange(len(best)), best], probs[np.arange(len(best)), which]
            none = grams == 0
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried),
                 pa.array([None if e else languages[b] for b, e in zip(best.tolist(), none.tolist())], pa.string()),
                 pa.array(top, mask=none), pa.array(at, mask=none | (which < 0)),
                 pa.array(~none & (np.where(which >= 0, at, top) >= accept))], [*carried, *names])

    joined = joined.select(*carried, "declared", "prior", *(["text"] if own_text == "text" else []))
    added = T.StructType.fromDDL("language string, language_prob double, declared_prob double, accepted boolean")
    out = joined.mapInArrow(decide, T.StructType([*joined.select(*carried).schema.fields, *added.fields]))
    return out.toDF(*keep, *names)


def page_rows(pages: DataFrame) -> DataFrame:
    """page_id, host, declared and text of web pages (page_id, url, html)."""
    html = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    declared = F.nullif(F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([A-Za-z-]+)", 1), F.lit(""))
    return pages.select("page_id", host_of(F.col("url")).alias("host"), declared.alias("declared"), html.alias("text"))
