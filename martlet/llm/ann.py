"""Approximate nearest neighbours with learned partitions.

A bounded hash sample gives a neighbour graph; the graph is cut into balanced
parts (principal-direction bisection, then moves to the part that holds most
of a vector's neighbours while sizes allow it). A softmax classifier learns the
parts of a vector and its neighbours. Every row is indexed under its most
probable part; a query is routed to its most probable parts, as many as reach
``RECALL`` on sample queries, and reranked there by exact distance in double
precision. Parts are split by a hash into blocks of bounded size, so a vector
that repeats without end does not fill one task.

Defined cases: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part, nor do rows without an id;
rows that share an id are one candidate at their smallest distance, and never
a neighbour of that id's query; ties go to the smaller id; few rows mean one
part, which is exact; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm._io import Scratch

#: Vectors that the partition and the classifier are fitted on, at most about so many.
SAMPLE = 8192
#: Aim for the rows of a part; the number of parts is a power of two up to MAX_PARTS.
PART_ROWS = 2048
MAX_PARTS = 256
#: Rows of a part that one group compares with its queries.
BLOCK_ROWS = 4096
GRAPH_NEIGHBOURS = 10
#: Sample recall that decides how many parts a query visits.
RECALL = 0.975
QUERY_EVERY = 100
TOP = 10


def usable(vector: Column) -> Column:
    """Whether a vector has finite components only, and not all of them zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def distances(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    diff = rows - to
    return np.sqrt(np.einsum("ij,ij->i", diff, diff))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest of each sample vector, nearest first."""
    norms = np.einsum("ij,ij->i", x, x)
    out = np.empty((len(x), k), dtype=np.int64)
    for at in range(0, len(x), 256):
        d = norms[None, :] - 2 * x[at : at + 256] @ x.T
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        order = np.argsort(np.take_along_axis(d, near, axis=1), axis=1)
        out[at : at + 256] = np.take_along_axis(near, order, axis=1)
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, sweeps: int = 8) -> np.ndarray:
    """A part for each sample vector: few cut graph edges, sizes within a tenth of each other."""
    rng = np.random.default_rng(5)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        halves = []
        for g in groups:
            centred = x[g] - x[g].mean(axis=0)
            axis = rng.normal(size=x.shape[1])
            for _ in range(12):
                axis = centred.T @ (centred @ axis)
                axis /= np.linalg.norm(axis) or 1.0
            order = np.argsort(centred @ axis, kind="stable")
            halves += [g[order[: len(g) // 2]], g[order[len(g) // 2 :]]]
        groups = halves
    part = np.empty(len(x), dtype=np.int64)
    for i, g in enumerate(groups):
        part[g] = i
    most, least = 1.1 * len(x) / parts, 0.9 * len(x) / parts
    sizes = np.bincount(part, minlength=parts)
    src = np.repeat(np.arange(len(x)), near.shape[1])
    for _ in range(sweeps):
        votes = np.zeros((len(x), parts), dtype=np.int32)
        np.add.at(votes, (src, part[near.ravel()]), 1)
        np.add.at(votes, (near.ravel(), part[src]), 1)
        to = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), to] - votes[np.arange(len(x)), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[to[i]] < most and sizes[part[i]] > least:
                sizes[to[i]] += 1
                sizes[part[i]] -= 1
                part[i] = to[i]
                moved += 1
        if not moved:
            break
    return part


class Router:
    """Softmax over the parts of a vector."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, scale: float):
        self.weights, self.bias, self.scale = weights, bias, scale

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (x * self.scale) @ self.weights + self.bias


def fit_router(x: np.ndarray, part: np.ndarray, near: np.ndarray, parts: int, steps: int = 300) -> Router:
    """Cross entropy against a vector's own part and those of its neighbours (Adam, full batch)."""
    target = np.zeros((len(x), parts))
    target[np.arange(len(x)), part] = 0.5
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), part[near.ravel()]), 0.5 / near.shape[1])
    scale = 1.0 / (x.std() or 1.0)
    z = np.hstack([x * scale, np.ones((len(x), 1))])
    w = np.zeros((z.shape[1], parts))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        p = z @ w
        p = np.exp(p - p.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        grad = z.T @ (p - target) / len(z) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return Router(w[:-1], w[-1], scale)


def fit(x: np.ndarray, rows: int) -> tuple[Router, int]:
    """Router and number of parts that a query visits, from the sample and the number of rows."""
    parts = 1
    while parts < MAX_PARTS and parts * PART_ROWS < rows and parts * 64 <= len(x):
        parts *= 2
    if parts == 1 or len(x) <= GRAPH_NEIGHBOURS:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), 1.0), 1
    near = neighbour_graph(x, GRAPH_NEIGHBOURS)
    router = fit_router(x, balanced_parts(x, near, parts), near, parts)
    logits = router.logits(x)
    order = np.argsort(np.argsort(-logits, axis=1), axis=1)  # place of each part in a vector's routing
    place = np.take_along_axis(order, logits.argmax(axis=1)[near], axis=1)
    visits = int(np.quantile(place, RECALL)) + 1
    return router, visits


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def nearest(vectors: DataFrame, queries: Column, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``top`` nearest rows of each query row."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "ann")
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(queries, F.lit(False)).alias("asks")
    )
    lengths = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim, total = (lengths["dim"], lengths["count"]) if lengths else (1, 0)
    rows = rows.filter(F.size("embedding") == dim)
    pick = F.pmod(F.xxhash64(F.lit(17), "vec_id", "embedding"), F.lit(1_000_000))
    sample = rows.filter(pick < min(1_000_000, -(-SAMPLE * 1_000_000 // max(1, total)))).select("embedding").limit(2 * SAMPLE)
    x = np.array([r["embedding"] for r in sample.collect()], dtype=np.float64).reshape(-1, dim)
    router, visits = fit(x, total)
    parts = len(router.bias)
    sent = spark.sparkContext.broadcast(router)

    def place(batches):
        for batch in batches:
            logits = sent.value.logits(_matrix(batch.column(1), dim))
            asks = batch.column(2).to_numpy(zero_copy_only=False)
            routes = [[int(p) for p in np.argsort(-l, kind="stable")] if a else None for l, a in zip(logits, asks)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(logits.argmax(axis=1), pa.int32()), pa.array(routes, pa.list_(pa.int32()))],
                names=["vec_id", "embedding", "part", "route"],
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    indexed = scratch.keep(
        rows.mapInArrow(place, f"vec_id {kind}, embedding array<double>, part int, route array<int>"), "indexed"
    )
    # At most MAX_PARTS rows: how many rows each part has, and so its blocks.
    counts = {r["part"]: r["count"] for r in indexed.groupBy("part").count().collect()}
    blocks = [max(1, -(-counts.get(p, 0) // BLOCK_ROWS)) for p in range(parts)]
    n_blocks = F.element_at(F.array(*[F.lit(b) for b in blocks]), F.col("part") + 1)
    held = F.array(*[F.lit(counts.get(p, 0)).cast("long") for p in range(parts)])
    base = indexed.select(
        "vec_id", "embedding", "part", F.pmod(F.xxhash64(F.lit(19), "vec_id"), n_blocks).cast("int").alias("block")
    )
    # The first parts of the route: as many as sample recall asks for, and more until they hold enough rows.
    enough = F.aggregate(
        F.col("route"),
        F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("rows")),
        lambda a, p: F.when((a["n"] >= visits) & (a["rows"] > 2 * top), a).otherwise(
            F.struct((a["n"] + 1).alias("n"), (a["rows"] + F.element_at(held, p + 1)).alias("rows"))
        ),
        lambda a: a["n"],
    )
    asked = (
        indexed.filter(F.col("route").isNotNull())
        .select("vec_id", "embedding", F.explode(F.slice("route", F.lit(1), enough)).alias("part"))
        .select("vec_id", "embedding", "part", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block"))
    )

    def rerank(asking: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(asking) and len(found):
            ids, x = found["vec_id"].to_numpy(), np.stack(found["embedding"].to_numpy())
            for qid, q in zip(asking["vec_id"], asking["embedding"]):
                d = distances(x, np.asarray(q))
                other = np.flatnonzero(ids != qid)
                # Rows that share an id need one more place each, so keep ties and equals beyond the top.
                if len(other) > top:
                    uniq = len(set(ids[other[np.argpartition(d[other], top - 1)[:top]]].tolist())) == top
                    edge = np.partition(d[other], top - 1)[top - 1] if uniq else np.inf
                    other = other[d[other] <= edge]
                order = other[np.lexsort((ids[other], d[other]))]
                _, first = np.unique(ids[order], return_index=True)
                order = order[np.sort(first)][:top]
                out["query_id"].append(np.full(len(order), qid))
                out["vec_id"].append(ids[order])
                out["score"].append(d[order])
        return pd.DataFrame({k: np.concatenate(v) if v else [] for k, v in out.items()})

    partial = (
        asked.groupBy("part", "block")
        .cogroup(base.groupBy("part", "block"))
        .applyInPandas(rerank, f"query_id {kind}, vec_id {kind}, score double")
    )
    best = partial.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def nearest_digest(embeddings: DataFrame) -> DataFrame:
    """``op9``: ten nearest rows of every row whose id is divisible by 100."""
    return nearest(embeddings, F.col("vec_id") % QUERY_EVERY == 0)
