"""Streaming entry points.  The reference is batch-only (hourly builds); the
one streaming form here runs the incremental order fact as a file stream
with ``foreachBatch`` (see ``foreach_batch``)."""

from tidemart.streaming.foreach_batch import order_fact_batch, start_order_fact_stream  # noqa: F401
