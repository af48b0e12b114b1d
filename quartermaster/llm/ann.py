"""Approximate nearest neighbours by inner product on robust-pruned directed graphs.

Equal vectors form one class.  Classes are dealt to shards by hash; each shard builds its graph: points enter in batches
of doubling size, a greedy beam search on the graph so far proposes neighbours, and robust pruning keeps a candidate
unless a kept neighbour is nearer to it by the factor ``alpha`` (so edges point in different directions), also among the
reverse edges of a node that has too many.  For inner products one coordinate is added that gives all vectors the same
norm, so Euclidean distance and inner product rank alike.  Every block of queries is beam-searched in every shard; scores
are then computed in double precision on the original vectors and merged.

Answers are exact in ties: a class stands for its ``k + 1`` smallest ids, of which a query can use no more than ``k``
besides its own, and tied classes are taken by smallest id.  Vectors that are null, empty, all zero, or hold null or
non-finite components take no part; vectors of different lengths are never compared.  Repeated rows count once.  Without
other candidates a query has no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermaster.llm.common import cut

#: Distinct vectors in a shard, and queries in a block, on average.
SHARD_ROWS = 8192
BLOCK_QUERIES = 1024
DEGREE, BEAM, ALPHA = 32, 64, 1.2
EXPAND = 4


@dataclass
class Graph:
    points: np.ndarray      # float32, with the added coordinate
    neighbours: np.ndarray  # int32, -1 where there are fewer than DEGREE
    start: int


def lift(x: np.ndarray) -> np.ndarray:
    """Adds the coordinate that gives all vectors the largest norm."""
    norms = np.einsum("ij,ij->i", x, x)
    return np.column_stack([x, np.sqrt(np.maximum(0.0, norms.max() - norms))]).astype(np.float32)


def beam_search(g: Graph, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, inner products) of the ``width`` best points found for each query, best first; -1 where there are fewer."""
    n = len(queries)
    ids = np.full((n, width), -1, np.int32)
    near = np.full((n, width), -np.inf, np.float32)
    open_ = np.zeros((n, width), bool)
    ids[:, 0], open_[:, 0] = g.start, True
    near[:, 0] = queries @ g.points[g.start]
    rows = np.arange(n)
    while len(rows):
        # the best points that are not yet expanded, up to EXPAND of them
        own = open_[rows]
        rank = np.cumsum(own, axis=1)
        chosen = own & (rank <= EXPAND)
        going = chosen.any(axis=1)
        rows, chosen = rows[going], chosen[going]
        if not len(rows):
            break
        open_[rows] &= ~chosen
        at = np.argsort(~chosen, axis=1, kind="stable")[:, :EXPAND]
        nodes = np.where(np.take_along_axis(chosen, at, 1), np.take_along_axis(ids[rows], at, 1), -1)
        new = np.where(nodes[:, :, None] >= 0, g.neighbours[nodes], -1).reshape(len(rows), -1)
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        score = np.einsum("qrd,qd->qr", g.points[new], queries[rows], optimize=True)
        score[new < 0] = -np.inf
        worse = score <= near[rows, -1:]
        keep = int((~worse).sum(axis=1).max(initial=0))
        if keep == 0:
            continue
        score[worse] = -np.inf
        top = np.argpartition(-score, keep - 1, axis=1)[:, :keep]  # what is not above the beam's last cannot enter it
        new, score = np.take_along_axis(new, top, 1), np.take_along_axis(score, top, 1)
        new = np.where(np.isfinite(score), new, -1)
        known = (new[:, :, None] == ids[rows][:, None, :]).any(axis=2)
        score[known] = -np.inf
        all_ids = np.hstack([ids[rows], new])
        all_near = np.hstack([near[rows], score])
        all_open = np.hstack([open_[rows], np.isfinite(score)])
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
        near[rows] = np.take_along_axis(all_near, order, 1)
        ids[rows] = np.where(np.isfinite(near[rows]), np.take_along_axis(all_ids, order, 1), -1)
        open_[rows] = np.take_along_axis(all_open, order, 1)
    return ids, near


def robust_prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """For each node, up to ``degree`` of its candidates (-1: none): the nearest, then those no kept one shadows."""
    candidates = np.where(candidates == nodes[:, None], -1, candidates)
    order = np.sort(candidates, axis=1)
    order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
    p, x = points[order], points[nodes]
    sq = np.einsum("qkd,qkd->qk", p, p)
    own = np.maximum(0.0, sq - 2 * np.einsum("qkd,qd->qk", p, x, optimize=True) + np.einsum("qd,qd->q", x, x)[:, None])
    own[order < 0] = np.inf
    between = np.maximum(0.0, sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(p, p.transpose(0, 2, 1)))
    left, out = own.copy(), np.full((len(nodes), degree), -1, np.int32)
    rows = np.arange(len(nodes))
    for i in range(degree):
        best = left.argmin(axis=1)
        found = np.isfinite(left[rows, best])
        if not found.any():
            break
        out[found, i] = order[rows, best][found]
        shadowed = alpha * alpha * between[rows, best] <= own
        left[shadowed] = np.inf
        left[rows, best] = np.inf
    return out


def link(g: Graph, nodes: np.ndarray, alpha: float) -> None:
    """Searches for each node, prunes what is found, and offers the reverse edges to the chosen neighbours."""
    degree = g.neighbours.shape[1]
    found, _ = beam_search(g, g.points[nodes], BEAM)
    g.neighbours[nodes] = robust_prune(g.points, nodes, np.hstack([found, g.neighbours[nodes]]), alpha, degree)
    source = np.repeat(nodes, degree)
    target = g.neighbours[nodes].ravel()
    source, target = source[target >= 0], target[target >= 0]
    fresh = ~(g.neighbours[target] == source[:, None]).any(axis=1)
    source, target = source[fresh], target[fresh]
    while len(target):  # a hub takes its offers in turns of ``degree``, none is left out
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        counts = np.diff(np.r_[first, len(target)])
        turn = np.arange(len(target)) - np.repeat(first, counts)
        now = turn < degree
        at = target[first]
        offered = np.full((len(at), degree), -1, np.int32)
        offered[np.repeat(np.arange(len(at)), counts)[now], turn[now]] = source[now]
        room = (g.neighbours[at] < 0).sum(axis=1) >= np.minimum(counts, degree)
        for chosen, prune in ((room, False), (~room, True)):
            if chosen.any():
                both = np.hstack([g.neighbours[at[chosen]], offered[chosen]])
                if prune:
                    g.neighbours[at[chosen]] = robust_prune(g.points, at[chosen], both, alpha, degree)
                else:
                    g.neighbours[at[chosen]] = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :degree]
        source, target = source[~now], target[~now]


def build(vectors: np.ndarray, seed: int = 0) -> Graph:
    points = lift(vectors)
    n = len(points)
    start = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    g = Graph(points, np.full((n, DEGREE), -1, np.int32), start)
    order = np.random.default_rng(seed).permutation(n)
    order = np.r_[start, order[order != start]]
    for alpha in (1.0, ALPHA):
        at, step = 1 if alpha == 1.0 else 0, 1
        while at < n:
            step = min(512, step * 2) if alpha == 1.0 else 512
            link(g, order[at:at + step], alpha)
            at += step
    return g


def search(g: Graph, vectors: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, exact inner products) of the ``k`` best points found for each query."""
    lifted = np.column_stack([queries, np.zeros(len(queries))]).astype(np.float32)
    ids, _ = beam_search(g, lifted, max(BEAM, 2 * k))
    exact = np.einsum("qrd,qd->qr", vectors[ids].astype(np.float64), queries.astype(np.float64), optimize=True)
    exact[ids < 0] = -np.inf
    top = np.argsort(-exact, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(ids, top, 1), np.take_along_axis(exact, top, 1)


def nearest(df: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for every row whose id is divisible by ``every``."""
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0)).distinct()
    is_query = F.col("id") % every == 0
    classes = rows.groupBy("v").agg(F.min("id").alias("c"), F.max(is_query).alias("asked"))
    least = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    least = least.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = cut(classes.join(least, "v").withColumn("dim", F.size("v")))
    counts = {r["dim"]: r for r in classes.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.col("asked").cast("int")).alias("q")).collect()}
    shards = sum(-(-r["n"] // SHARD_ROWS) for r in counts.values())
    first, cases = 0, F.lit(0)
    asked = F.array().cast("array<int>")
    for dim, r in sorted(counts.items()):  # each length of vectors has its own shards
        own = -(-r["n"] // SHARD_ROWS)
        cases = F.when(F.col("dim") == dim, F.pmod(F.xxhash64("c"), F.lit(own)) + first).otherwise(cases)
        asked = F.when(F.col("dim") == dim, F.sequence(F.lit(first), F.lit(first + own - 1))).otherwise(asked)
        first += own

    def build_shard(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("c")
        x = np.array(part["v"].tolist(), np.float32)
        g = build(x)
        return pd.DataFrame({"shard": [part["shard"].iloc[0]], "dim": [x.shape[1]], "c": [part["c"].to_numpy(np.int64).tobytes()],
                             "x": [x.tobytes()], "edges": [g.neighbours.tobytes()], "start": [g.start]})

    dealt = classes.withColumn("shard", cases.cast("int"))
    index = cut(dealt.select("shard", "c", "v").groupBy("shard").applyInPandas(
        build_shard, "shard int, dim int, c binary, x binary, edges binary, start int"))
    blocks = max(1, -(-sum(r["q"] for r in counts.values()) // BLOCK_QUERIES))
    asking = classes.where("asked").withColumn("block", F.pmod(F.xxhash64("c", F.lit(1)), F.lit(blocks)))
    asking = asking.groupBy("block", "dim").agg(F.collect_list(F.struct("c", "v")).alias("qs"))  # a block's queries
    work = asking.select("block", "qs", F.explode(asked).alias("shard")).repartition(max(1, blocks * max(1, shards)), "block", "shard")
    work = work.join(index, "shard")

    def search_shard(parts):
        for part in parts:
            for _, r in part.iterrows():
                c = np.frombuffer(r["c"], np.int64)
                x = np.frombuffer(r["x"], np.float32).reshape(len(c), -1)
                g = Graph(lift(x), np.frombuffer(r["edges"], np.int32).reshape(len(c), -1), r["start"])
                q = np.array([e["v"] for e in r["qs"]], np.float32)
                at, score = search(g, x, q, k + 1)
                found = np.isfinite(score)
                yield pd.DataFrame({"q": np.repeat(np.array([e["c"] for e in r["qs"]], np.int64), found.sum(axis=1)),
                                    "c": c[at[found]], "score": score[found]})

    hits = work.mapInPandas(search_shard, "q long, c long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    hits = hits.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    members = hits.join(classes.select("c", "ids"), "c").select("q", "score", F.explode("ids").alias("id"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    members = members.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    lists = members.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("found"))
    answers = classes.select("v", F.col("c").alias("q")).join(lists, "q")
    queries = rows.where(is_query).select(F.col("id").alias("query_id"), "v").join(answers, "v")
    others = F.slice(F.filter("found", lambda f: f["id"] != F.col("query_id")), 1, k)
    return queries.select("query_id", F.posexplode(others).alias("p", "f")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("f.id").alias("vec_id"), F.col("f.score").alias("score"))
