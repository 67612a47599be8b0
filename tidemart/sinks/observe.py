"""Aggregates of a DataFrame, taken while it is written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation


def write_observed(df: DataFrame, write: Callable[[DataFrame], None], aggregates: dict[str, Column]) -> dict:
    """Run ``write(df)`` and return the values of ``aggregates`` over the
    written rows.  The observation sits on top of the plan, behind its last
    shuffle: its tasks are those of the final stage, of which Spark counts
    each partition once, also when a task is tried again or an executor is
    lost.  No second scan is needed."""
    if not aggregates:
        write(df)
        return {}
    # The values carry plain names; a name with dots or colons stays on this side.
    names = {f"v{i}": name for i, name in enumerate(aggregates)}
    observation = Observation()
    write(df.observe(observation, *[aggregates[name].alias(v) for v, name in names.items()]))
    found = observation.get
    return {name: found.get(v) for v, name in names.items()}
