"""Embedding near-duplicates: dual traversal of cover trees.

Unit vectors of one label are dealt by hash to blocks of bounded size, each
with a cover tree: nested levels of centres whose radii halve, every node
knowing the farthest point below it.  Each pair of a label's blocks is one
cell.  There both trees are walked down together, and a pair of nodes goes as
soon as its centres are farther apart than both covering radii and the
threshold's distance allow; pairs of points that remain are checked by cosine.
A cell returns link counts and a spanning forest, never its pairs, so a large
group of near copies costs rows in proportion to its size.  Equal vectors are
one point with a weight.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import publish
from tidemart.llm.components import components
from tidemart.llm.vectors import finite, matrices

#: Points of a block at most, on average: a cell's matrices have this squared entries.
BLOCK_ROWS = 1024


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def build_tree(unit: np.ndarray, reach: float) -> list[dict]:
    """Levels from the root to the single points: centres (row numbers), each
    one's parent (its place in the level above) and covering radius."""
    d = _distances(unit, unit)
    n, radius = len(unit), float(d[0].max())
    nets = [np.zeros(1, np.int64)]
    while len(nets[-1]) < n and radius > reach / 4:
        radius /= 2
        centres = list(nets[-1])
        bare = d[:, nets[-1]].min(axis=1) > radius
        while bare.any():
            centres.append(int(np.argmax(bare)))
            bare &= d[centres[-1]] > radius
        if len(centres) > len(nets[-1]):
            nets.append(np.array(centres))
    if len(nets[-1]) < n:
        nets.append(np.concatenate([nets[-1], np.setdiff1d(np.arange(n), nets[-1])]))
    levels, above = [], np.empty(n, np.int64)
    above[nets[-1]] = np.arange(n)  # of each point, its node in the level
    for depth in range(len(nets) - 1, -1, -1):
        net, far = nets[depth], np.zeros(len(nets[depth]))
        np.maximum.at(far, above, d[np.arange(n), net[above]])
        parent = d[np.ix_(net, nets[depth - 1])].argmin(axis=1) if depth else np.zeros(len(net), np.int64)
        levels.append({"net": net, "far": far, "parent": parent})
        above = parent[above]
    return levels[::-1]


def dual_pairs(a: dict, b: dict, threshold: float, reach: float) -> np.ndarray:
    """Boolean matrix of the pairs of points of two trees that reach the threshold."""
    depth = max(len(a["levels"]), len(b["levels"]))
    live = np.ones((1, 1), bool)
    for k in range(depth):
        la, lb = a["levels"][min(k, len(a["levels"]) - 1)], b["levels"][min(k, len(b["levels"]) - 1)]
        if 0 < k < len(a["levels"]):
            live = live[la["parent"]]
        if 0 < k < len(b["levels"]):
            live = live[:, lb["parent"]]
        rows, cols = np.flatnonzero(live.any(axis=1)), np.flatnonzero(live.any(axis=0))
        near = _distances(a["unit"][la["net"][rows]], b["unit"][lb["net"][cols]])
        near = near <= reach + la["far"][rows][:, None] + lb["far"][cols][None, :] + 1e-7
        live[np.ix_(rows, cols)] &= near
    out = np.zeros((len(a["unit"]), len(b["unit"])), bool)
    at = a["levels"][-1]["net"], b["levels"][-1]["net"]
    i, j = np.nonzero(live)
    i, j = at[0][i], at[1][j]
    for s in range(0, len(i), 1 << 16):
        x, y = a["raw"][i[s : s + 65536]], b["raw"][j[s : s + 65536]]
        cosine = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
        out[i[s : s + 65536], j[s : s + 65536]] = cosine >= threshold
    return out


def _forest(links: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray) -> list[tuple[int, int]]:
    """(node, smallest node) for all nodes of the components of a bipartite link matrix."""
    edges, left = [], links.any(axis=1)
    while left.any():
        rows = np.zeros(len(left), bool)
        rows[np.argmax(left)] = True
        cols = links[rows].any(axis=0)
        while True:
            more = links[:, cols].any(axis=1)
            if (more == rows).all():
                break
            rows, cols = more, links[more].any(axis=0)
        nodes = np.unique(np.concatenate([a_ids[rows], b_ids[cols]]))
        edges += [(int(x), int(nodes[0])) for x in nodes[1:]]
        left &= ~rows
    return edges


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors(vec_id, embedding, label)``.

    Rows of equal, non-null label link when the cosine of their vectors, in
    double precision, is at least ``threshold`` (above 0).  n_links counts the
    other rows linked directly; component_id is the smallest vec_id reachable;
    kept says that this is the row's own.  Vectors that are null, zero or hold
    null or non-finite components, vectors of different length, and rows with a
    null label or vec_id link with nothing.  Each row is a vector: repeated rows
    link with each other.  With a null vec_id, component_id and kept are null.
    Other columns are ignored; an empty table gives an empty result.
    """
    reach = float(np.sqrt(2.0 - 2.0 * threshold))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label",
                          F.col("embedding").cast("array<double>").alias("x"))
    whole = finite("x") & F.exists("x", lambda v: v != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    points = publish(rows.filter(whole).groupBy("label", "x").agg(F.min("vec_id").alias("id"), F.count("*").alias("w")), "cover-points")
    blocks = points.groupBy("label").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
    dealt = points.join(publish(blocks, "cover-labels"), "label").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def plant(data: pa.Table) -> pa.Table:
        out = {"size": [], "tree": []}
        ids, weights = data.column("id").to_numpy(), data.column("w").to_numpy()
        for at, raw in matrices(data.column("x")):
            raw = raw / np.abs(raw).max(axis=1)[:, None]  # no overflow in the squares
            unit = raw / np.sqrt((raw * raw).sum(axis=1))[:, None]
            tree = {"ids": ids[at], "w": weights[at], "raw": raw, "unit": unit, "levels": build_tree(unit, reach)}
            out["size"].append(raw.shape[1])
            out["tree"].append(pickle.dumps(tree, 5))
        first = {c: data.column(c).slice(0, 1).combine_chunks().take(pa.array([0] * len(out["tree"]))) for c in ("label", "block", "blocks")}
        return pa.table({**first, "size": pa.array(out["size"], pa.int32()), "tree": pa.array(out["tree"], pa.binary())})

    kind = dict(vectors.dtypes)["label"]
    trees = publish(dealt.groupBy("label", "block").applyInArrow(
        plant, f"label {kind}, block int, blocks bigint, size int, tree binary"), "cover-trees")
    cells = trees.select("label", "size", "block", "tree", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("other"))
    cells = cells.select("label", "size", "block", "tree", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def meet(data: pa.Table) -> pa.Table:
        trees = [pickle.loads(t) for t in data.column("tree").to_pylist()]
        found = {"a": [], "b": [], "links": []}
        i, j = data.column("i")[0].as_py(), data.column("j")[0].as_py()
        if len(trees) == 2 or i == j:
            a, b = trees[0], trees[-1]
            links = dual_pairs(a, b, threshold, reach)
            if i == j:
                np.fill_diagonal(links, False)
            counts = [(a["ids"], links @ b["w"])] + ([] if i == j else [(b["ids"], links.T @ a["w"])])
            for ids, n in counts:
                some = n > 0
                found["a"] += ids[some].tolist()
                found["b"] += [None] * int(some.sum())
                found["links"] += n[some].tolist()
            for node, least in _forest(links, a["ids"], b["ids"]):
                found["a"].append(node)
                found["b"].append(least)
                found["links"].append(0)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in found.items()})

    found = publish(cells.groupBy("label", "size", "i", "j").applyInArrow(meet, "a bigint, b bigint, links bigint"), "cover-links")
    counts = found.filter("links > 0").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    label = components(found.filter("b IS NOT NULL").select("a", "b"))
    known = publish(points.join(counts, "id", "left").join(label.withColumnRenamed("node", "id"), "id", "left")
                    .filter("w > 1 OR links IS NOT NULL OR component IS NOT NULL")
                    .select("label", "x", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"),
                            F.coalesce("component", "id").alias("component")), "cover-known")
    out = rows.withColumn("valid", whole).join(known.withColumn("valid", F.lit(True)), ["valid", "label", "x"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                      (F.col("vec_id") == component).alias("kept"))
