"""Exact top-k search by inner product: columnar branch and bound.

Queries and candidates are dealt by hash to a grid of cells of bounded size;
every query block meets every candidate block once.  In a cell the candidates
lie in vertical layout, one row a dimension, the dimensions with most mass
first.  Scores are accumulated block of dimensions by block; after each, a
candidate survives only if its partial score plus the product of the remaining
norms can still reach the query's k-th best, and the survivors are compacted.
Each cell returns k rows a query at most, and one window merges them.
"""

from __future__ import annotations

from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.llm.common import publish
from tidemart.llm.vectors import finite, matrices

#: Bytes of one side's matrix in a cell, at most.
CELL_BYTES = 1 << 24


def _blocks(dims: int, step: int) -> list[tuple[int, int]]:
    return [(i, min(i + step, dims)) for i in range(0, dims, step)] or [(0, 0)]


def _tails(rows: np.ndarray, blocks) -> np.ndarray:
    """Norm of what lies behind each block of dimensions."""
    return np.stack([np.sqrt((rows[:, end:] ** 2).sum(axis=1)) for _, end in blocks])


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _search(queries, own, rows, ids, k, step):
    """Yields (query, ids, scores) of the k best rows, exactly; ``own`` has each query's own place among the rows, or -1."""
    dims = rows.shape[1]
    order = np.argsort(-(rows**2).sum(axis=0), kind="stable")
    queries, upright = queries[:, order], np.ascontiguousarray(rows[:, order].T)
    blocks = _blocks(dims, step)
    q_tail, c_tail = _tails(queries, blocks), _tails(rows[:, order], blocks)
    top_ids = [np.empty(0, np.int64)] * len(queries)
    top = [np.empty(0)] * len(queries)
    for at in range(0, len(ids), 2048):
        part = slice(at, at + 2048)
        first = queries[:, : blocks[0][1]] @ upright[: blocks[0][1], part]
        for q in range(len(queries)):
            least = top[q][-1] if len(top[q]) == k else -np.inf
            alive = np.arange(at, at + first.shape[1])
            score = first[q]
            if at <= own[q] < at + len(alive):
                alive, score = np.delete(alive, own[q] - at), np.delete(score, own[q] - at)
            for b, (start, end) in enumerate(blocks):
                if b:
                    score = score + queries[q, start:end] @ upright[start:end, alive]
                if least > -np.inf:
                    stays = score + q_tail[b, q] * c_tail[b, alive] * (1 + 1e-9) + 1e-3 >= least
                    alive, score = alive[stays], score[stays]
            if len(alive):
                all_ids, all_scores = np.concatenate([top_ids[q], ids[alive]]), np.concatenate([top[q], score])
                best = _best(all_scores, all_ids, k)
                top_ids[q], top[q] = all_ids[best], all_scores[best]
    for q in range(len(queries)):
        yield q, top_ids[q], top[q].astype(np.int64)


def _search_wide(queries, own, rows, ids, k, scale):
    """The same for vectors with components too large for exact float sums, not
    scaled yet: whole numbers of any size, and scores held at the ends of the
    64-bit range."""
    times = Fraction(scale)
    whole = lambda m: np.array([[floor(Fraction(x) * times) for x in r] for r in m.tolist()], object).reshape(m.shape)
    rows = whole(rows)
    for q, vector in enumerate(whole(queries)):
        score = np.array([max(-(2**63), min(2**63 - 1, int(s))) for s in rows @ vector], np.int64)
        others = np.flatnonzero(np.arange(len(ids)) != own[q])
        best = sorted(others, key=lambda i: (-int(score[i]), ids[i]))[:k]
        yield q, ids[best], score[best]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, step: int = 16) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products
    of each query row's vector with all others, ties to the smaller vec_id.

    ``vectors`` has vec_id and embedding; a component x counts as
    floor(scale * x).  ``is_query`` is a condition on vec_id.  Vectors that are
    null or hold null or non-finite components, and rows without a vec_id, take
    no part.  Rows of one vec_id are searched and asked each for itself: a query
    row's candidates are all other rows, and each query row has its own ranks.
    Only vectors of equal length are compared; fewer than k candidates
    are all returned; a table without valid queries gives no rows.  Scores
    beyond 64 bits are held at the range's ends.  Other columns are ignored.
    """
    valid = (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
             .filter(F.col("vec_id").isNotNull() & finite("embedding")))
    codes = publish(valid.select("vec_id", F.monotonically_increasing_id().alias("row"), F.col("embedding").alias("code")), "topk-codes")
    codes = codes.withColumn("is_query", F.coalesce(is_query, F.lit(False)))
    n, queries, dims = codes.agg(F.count("*"), F.sum(F.col("is_query").cast("bigint")), F.max(F.size("code"))).first()
    rows = max(256, min(CELL_BYTES // (8 * max(dims or 1, 1)), (n or 0) // 48))
    across, down = -(-max(n, 1) // rows), -(-max(queries or 0, 1) // rows)

    long = lambda x: F.lit(x).cast("bigint")
    cells = (codes.select("vec_id", "row", "code", F.lit(False).alias("is_query"),
                          F.pmod(F.xxhash64("row"), long(across)).alias("i"),
                          F.explode(F.sequence(long(0), long(down - 1))).alias("j"))
             .unionByName(codes.filter("is_query").select(
                 "vec_id", "row", "code", "is_query", F.explode(F.sequence(long(0), long(across - 1))).alias("i"),
                 F.pmod(F.xxhash64("row", F.lit(1)), long(down)).alias("j"))))

    def cell(data: pa.Table) -> pa.Table:
        ids, rows, asks = data.column("vec_id").to_numpy(), data.column("row").to_numpy(), data.column("is_query").to_numpy()
        found = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        for at, m in matrices(data.column("code")):
            ask = asks[at]
            if not ask.any() or ask.all():
                continue
            with np.errstate(over="ignore"):
                code = np.floor(m * scale)  # infinite where it leaves the doubles
                largest = (np.abs(code[ask]).max(initial=0) + 1) * (np.abs(code[~ask]).max(initial=0) + 1) * max(m.shape[1], 1)
            q_ids, q_rows, c_ids, c_rows = ids[at][ask], rows[at][ask], ids[at][~ask], rows[at][~ask]
            order = np.argsort(c_rows)
            place = np.minimum(np.searchsorted(c_rows[order], q_rows), len(order) - 1)
            own = np.where(c_rows[order][place] == q_rows, order[place], -1)
            search = (_search(code[ask], own, code[~ask], c_ids, k, step) if largest < 2.0**52
                      else _search_wide(m[ask], own, m[~ask], c_ids, k, scale))
            for query, vec, score in search:
                found["query_row"].append(np.full(len(vec), q_rows[query], np.int64))
                found["query_id"].append(np.full(len(vec), q_ids[query], np.int64))
                found["vec_id"].append(vec)
                found["score"].append(score)
        return pa.table({c: np.concatenate([np.empty(0, np.int64), *v]) for c, v in found.items()})

    best = cells.groupBy("i", "j").applyInArrow(cell, "query_row bigint, query_id bigint, vec_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return (best.withColumn("rank", place).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
