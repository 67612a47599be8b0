"""The corpus pipeline: STAGES are applied to ``documents`` one after another.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents.  Null and empty texts go in
the first stage, as they have no language.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import jaccard, langid, mixing, packing, secret_scan
from tidemart.llm.common import publish, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language, and the declared one if they declare one, stay."""
    plain = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # columns named like the operator's results stay as they are
    found = langid.identify(docs.toDF(*plain.values()), plain["text"], plain["lang"], plain["source"])
    return found.filter("accepted").select(*plain.values()).toDF(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8."""
    return jaccard.keep_one(docs, words=5, percent=80)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; every secret in their texts is masked."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget takes them."""
    return mixing.take(docs)


def cost_balanced_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scans", secret_scans),
    ("mix_sources", mix_sources),
    ("cost_balanced_packing", cost_balanced_packing),
]
#: Tokenization and the fit of a budget can't be said in SQL; the tests hold
#: run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = publish(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
