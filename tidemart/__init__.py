"""tidemart — a Spark-native e-commerce analytics layer.

Raw order, customer, product, line-item and session tables are staged with
typed casts, rolled up into order and customer grain, published as dimension
and fact tables, and checked by data tests that return their failing rows.
Everything is a DataFrame transformation: Catalyst plans it, Spark runs it.

Layout:
    sources/    raw table readers, the CSV seed, the time spine
    functions/  column expressions (safe cast, surrogate key, buckets, money)
    plans/      staging, intermediate and mart models; the build job
    operators/  keyed upsert, SCD2 snapshot, data tests, metrics, freshness
    sinks/      partitioned parquet writer, versioned publish, run log
    streaming/  micro-batch driver for the incremental upsert
"""

from tidemart.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
