"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact length.  A source's budget first
takes whole passes over it, then of each length the same share of documents;
what is left of the budget is filled by a bounded-knapsack dynamic program over
the lengths whose documents remain.  Only lengths and counts are fitted; a
seeded order then picks as many documents of each length.  Hot lengths are cut
into buckets of the seeded order, and only the bucket in which the count ends
is ranked.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.llm.common import BROADCAST_ROWS, WORD_PATTERN, publish

#: Budgets up to this many words, or the longest remaining document's, are left to the dynamic program.
FIT_WORDS = 20_000
#: Buckets of the seeded order within a source and length.
BUCKETS = 4096


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def fit(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many of ``counts[length]`` documents to take so that their lengths
    sum to ``budget``, or to the most below it that the search finds (the
    closest of either side, for the last step)."""
    total = sum(n * c for n, c in counts.items())
    if budget >= total:
        return dict(counts)
    taken = {n: c * budget // total for n, c in counts.items()}
    left = budget - sum(n * k for n, k in taken.items())
    for n in sorted(counts, reverse=True):  # long documents first, down to what the program can fit
        if left > max(FIT_WORDS, 2 * n):
            more = min(counts[n] - taken[n], (left - FIT_WORDS) // n)
            taken[n] += more
            left -= more * n
    # Bit b of ``sums``: b words can be filled.  Each length comes in lots of 1, 2, 4, ... documents.
    limit = left + max((n for n in counts if counts[n] > taken[n]), default=0)
    mask, sums, lots = (1 << (limit + 1)) - 1, 1, []
    for n in sorted((n for n in counts if 0 < n and counts[n] > taken[n]), reverse=True):
        spare, lot = min(counts[n] - taken[n], limit // n), 1
        while spare and not sums >> left & 1:
            lot = min(lot, spare)
            lots.append((n, lot, sums))
            sums |= (sums << n * lot) & mask
            spare, lot = spare - lot, lot * 2
        if sums >> left & 1:
            break
    below = (sums & ((1 << (left + 1)) - 1)).bit_length() - 1
    above = sums >> (left + 1)
    over = (above & -above).bit_length() + left if above else None
    goal = below if over is None or left - below <= over - left else over
    for n, lot, before in reversed(lots):
        if not before >> goal & 1:
            taken[n] += lot
            goal -= n * lot
    return taken


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row a
    source, so the one global order costs as many rows as there are sources.
    The excess over ``most`` times a size is reshared by weight until none is
    above: all sources with a size-to-weight ratio below one level are full."""
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "weight", F.encode("source", "utf-8"))
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    # The budget and weights that remain if all sources of a lower ratio are full.
    money = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    pull = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = ranked.withColumn("money", money).withColumn("pull", pull)
    level = level.withColumn("open", F.col("cap") * F.col("pull") > F.col("money") * F.col("weight"))
    first = F.min(F.when(F.col("open"), F.struct(-F.col("pull"), "money", "pull"))).over(everything)
    level = level.withColumn("first", first)
    target = F.when(F.col("open"), F.col("first.money") * F.col("weight") / F.col("first.pull")).otherwise(F.col("cap"))
    return level.select("source", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 17,
        carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, *carry) for each row of ``docs(doc_id, text, source)``.

    size is the number of words; the sources in code-point order, null last,
    weigh ``weights`` in turn and share ``share`` times all sizes, none more
    than ``most`` times its own.  taken is a multiple of size, ``most`` times
    at most.  A null or empty text has size 0 and is never taken.  Repeated rows
    are documents of their own, alike in the seeded order.  Reruns agree.
    Columns named in ``carry`` come along and break ties of the seeded order.
    Other columns are ignored; an empty table gives an empty result.
    """
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), words(F.col("text").cast("string")).alias("size"),
                        # rows without a doc_id are dealt by their texts, so that no bucket holds them all
                        F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), F.col("text").cast("string"))).alias("mark"), *carry)
    sized = sized.withColumn("key", F.coalesce("mark", F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)))).drop("mark")
    sized = publish(sized.withColumn("bucket", F.pmod("key", F.lit(BUCKETS)).cast("int")), "mixing-sizes")
    counts = publish(sized.groupBy("source", "size").agg(F.count("*").alias("docs")), "mixing-lengths")
    totals = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    goals = publish(targets(totals, weights, share, most), "mixing-targets")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    wanted = counts.join(goals, same(counts, goals)).select(counts["source"], "size", "docs", "source_size", "target")

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        whole, budget = int(pdf["source_size"].iloc[0]), int(round(pdf["target"].iloc[0]))
        passes = min(budget // whole, most) if whole else 0
        extra = fit(dict(zip(pdf["size"], pdf["docs"])), budget - passes * whole) if whole and passes < most else {}
        return pdf.assign(passes=passes, extra=[extra.get(n, 0) for n in pdf["size"]])[
            ["source", "size", "source_size", "target", "passes", "extra"]]

    plans = publish(wanted.groupBy("source").applyInPandas(
        plan, "source string, size bigint, source_size bigint, target double, passes int, extra bigint"), "mixing-plan")
    buckets = sized.groupBy("source", "size", "bucket").agg(F.count("*").alias("own"))
    earlier = F.sum("own").over(Window.partitionBy("source", "size").orderBy("bucket")) - F.col("own")
    buckets = publish(buckets.withColumn("earlier", earlier), "mixing-buckets")
    cut = (buckets.alias("k").join(plans.alias("p"), F.expr("k.source <=> p.source AND k.size = p.size"))
           .select("k.source", "k.size", "k.bucket", "source_size", "target", "passes",
                   F.expr("greatest(0, least(own, extra - earlier))").alias("take")))
    cut = publish(cut, "mixing-cut")
    joined = (sized.alias("d").join(cut.alias("c"), F.expr("d.source <=> c.source AND d.size = c.size AND d.bucket = c.bucket"))
              .select("d.*", "source_size", "target", "passes", "take"))
    place = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("key", "doc_id", *carry))
    times = F.col("passes") + (place <= F.col("take")).cast("int")
    return joined.select("doc_id", "source", "size", "source_size", "target", (times * F.col("size")).cast("bigint").alias("taken"), *carry)


def take(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken.

    Rows are told apart by a number written with them, not by doc_id: null and
    repeated doc_ids are rows of their own.  Of rows alike in the seeded order
    those with the smaller hash of the text are taken first."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = publish(docs.select(whole.alias("doc"), F.xxhash64(F.col("text").cast("string")).alias("tie"),
                               F.monotonically_increasing_id().alias("row")), "mixing-rows")
    mixed = mix(rows.select("doc.doc_id", "doc.text", "doc.source", "tie", "row"), carry=("tie", "row"), **settings)
    times = publish(mixed.filter("taken > 0").select("row", F.expr("taken div size").alias("times")), "mixing-times")
    small = F.broadcast(times) if times.count() <= BROADCAST_ROWS else times
    return (rows.join(small, "row").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")))
            .select(*(F.col("doc").getField(c).alias(c) for c in docs.columns)))
