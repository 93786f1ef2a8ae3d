"""Approximate nearest neighbours by learned partitions of a neighbour graph."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotbook.llm.common import group_slices, whole_groups, written

#: Vectors that partitions and router are fitted on, at most about this many; all are indexed.
SAMPLE_ROWS = 8_000
PARTITIONS = 64
#: Partitions that a query is sent to. Without structure in the data a neighbour may lie in any;
#: the tests measure recall.
PROBES = 44
#: Neighbours of the graph that is partitioned.
GRAPH_NEIGHBOURS = 10
#: Rows of a side of a tile.
BLOCK_ROWS = 4096
EVERY = 20
NEAREST = 20
#: Rounding of a product of some thousands of parts, as a share of the norms' product.
_LOSS = 1e-12


@dataclass
class Router:
    """A softmax over partitions, learnt from where vectors and their neighbours lie."""

    weights: np.ndarray  # dimensions + 1 x partitions

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.c_[_direction(x), np.ones(len(x))] @ self.weights


def _direction(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k vectors of largest inner product to each, block by block."""
    k = min(k, len(x) - 1)
    near = np.empty((len(x), k), dtype=np.int64)
    for start in range(0, len(x), 512):
        dots = x[start : start + 512] @ x.T
        dots[np.arange(len(dots)), start + np.arange(len(dots))] = -np.inf
        near[start : start + 512] = np.argpartition(-dots, k - 1, axis=1)[:, :k]
    return near


def balanced_partition(x: np.ndarray, near: np.ndarray, parts: int, seed: int) -> np.ndarray:
    """A part for each node of the graph, none much larger than the mean.

    Grown from random centres to seed the parts, then refined: a node moves to the part that
    holds most of its neighbours (closeness to the part's mean breaks ties), while there is room.
    """
    rng = np.random.default_rng(seed)
    n = len(x)
    room = int(np.ceil(1.1 * n / parts))
    means = x[rng.choice(n, parts, replace=False)]
    part = np.full(n, -1)
    for _ in range(12):
        fit = x @ means.T
        if (part >= 0).all():
            votes = np.zeros((n, parts))
            np.add.at(votes, (np.repeat(np.arange(n), near.shape[1]), part[near].ravel()), 1.0)
            np.add.at(votes, (near.ravel(), np.repeat(part, near.shape[1])), 1.0)
            fit = votes / max(near.shape[1], 1) + fit / (np.abs(fit).max() + 1e-300)
        # Those who care most choose first; a full part turns the rest to their next choice.
        order = np.argsort(np.partition(fit, -2, axis=1)[:, -2] - fit.max(1))
        choice = np.argsort(-fit, axis=1)
        left = np.full(parts, room)
        part = np.full(n, -1)
        for i in order:
            for p in choice[i]:
                if left[p]:
                    part[i] = p
                    left[p] -= 1
                    break
        means = np.stack(
            [x[part == p].mean(0) if (part == p).any() else means[p] for p in range(parts)]
        )
        means /= np.linalg.norm(means, axis=1, keepdims=True) + 1e-300
    return part


def fit_router(x: np.ndarray, near: np.ndarray, part: np.ndarray, parts: int) -> Router:
    """A softmax regression of where a vector's own and its neighbours' parts lie."""
    rows = np.c_[x, np.ones(len(x))]
    goal = np.zeros((len(x), parts))
    np.add.at(goal, (np.arange(len(x)), part), 1.0)
    np.add.at(goal, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1.0)
    goal /= goal.sum(1, keepdims=True)
    # Started from the parts' means.
    weights = np.zeros((rows.shape[1], parts))
    moment, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, 121):
        z = rows @ weights
        z = np.exp(z - z.max(1, keepdims=True))
        slope = rows.T @ (goal - z / z.sum(1, keepdims=True)) / len(x) - 1e-6 * weights
        moment = 0.9 * moment + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        weights += 0.3 * (moment / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-9
        )
    return Router(weights)


def fit_partitions(sample: np.ndarray, parts: int = PARTITIONS, seed: int = 3) -> Router:
    """Router over balanced partitions of the sample's neighbour graph."""
    x = _direction(sample)
    parts = max(1, min(parts, len(x) // 4))
    if parts == 1:
        return Router(np.zeros((x.shape[1] + 1, 1)))
    near = neighbour_graph(x, GRAPH_NEIGHBOURS)
    return fit_router(x, near, balanced_partition(x, near, parts, seed), parts)


def _matrix(vectors: pa.Array) -> np.ndarray:
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return flat.reshape(len(vectors), -1)


def _rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids."""
    if len(score) > k:
        bar = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= bar)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:k]


def nearest(
    vectors: DataFrame,
    every: int = EVERY,
    k: int = NEAREST,
    parts: int = PARTITIONS,
    probes: int = PROBES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``every``, its
    ``k`` nearest found among all other rows, by inner product in double precision.

    Ties go to the smaller vec_id; all candidates are returned if there are fewer. A product is
    added up in one order whatever tile it is met in, so equal vectors have equal scores. Vectors
    that are null, zero, or hold null or non-finite parts, and rows with a null id, take no part;
    nor do vectors whose length is not the table's most common one, as they have no inner product
    with the others. An id that repeats with other vectors counts once, by its best score, and as
    a query it asks with each. Other columns are ignored; an empty table gives no rows.

    Every row is indexed under the partition that the router finds likeliest; each query goes to
    the ``probes`` likeliest. A partition that holds many rows is cut into blocks, and queries go
    to each block, so that a task's rows stay bounded however hot a partition is.
    """
    finite = F.forall(
        "embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )
    useful = finite & F.exists("embedding", lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & useful
    )
    schema = "query_id long, rank int, vec_id long, score double"
    lengths = rows.groupBy(F.size("embedding").alias("n")).count()
    common = lengths.orderBy(F.desc("count"), "n").first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.filter(F.size("embedding") == common["n"])
    total = common["count"]
    scale = 1 << 20
    chosen = rows.filter(
        F.pmod(F.xxhash64("vec_id"), F.lit(scale)) < scale * min(1.0, sample_rows / total)
    )
    # In the order of the ids, so that a run again fits the same numbers.
    sample = chosen.select("vec_id", "embedding").toArrow().sort_by("vec_id")
    if sample.num_rows < 8:
        sample = rows.limit(sample_rows).toArrow().sort_by("vec_id")
    router = fit_partitions(_matrix(sample.column("embedding").combine_chunks()), parts)
    n_parts = router.weights.shape[1]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 8192):
                part = batch.slice(start, 8192)
                score = router.scores(_matrix(part.column("embedding")))
                ids = part.column("vec_id").to_numpy()
                asks = ids % every == 0
                order = np.argsort(-score[asks], axis=1, kind="stable")[:, :probes]
                own = [score.argmax(1)]
                query = np.flatnonzero(asks)
                to = np.concatenate([*own, order.ravel()])
                who = np.concatenate([np.arange(len(ids)), np.repeat(query, order.shape[1])])
                yield _rows(
                    part=pa.array(to.astype(np.int64)),
                    query=pa.array(np.arange(len(to)) >= len(ids)),
                    vec_id=pa.array(ids[who]),
                    v=part.column("embedding").take(pa.array(who)).cast(pa.list_(pa.float64())),
                )

    routed = written(
        rows.mapInArrow(route, "part long, query boolean, vec_id long, v array<double>"), "routed"
    )
    is_query = F.col("query")
    sizes = routed.groupBy("part").agg(
        F.ceil(F.count(F.when(~is_query, 1)) / BLOCK_ROWS).alias("blocks"),
        F.ceil(F.count(F.when(is_query, 1)) / BLOCK_ROWS).alias("rounds"),
    )
    # A candidate lies in one block of its partition and meets each round of queries there; a
    # query belongs to one round and goes to each block.
    own_of, other_of = (
        F.when(is_query, F.col("rounds")).otherwise(F.col("blocks")),
        F.when(is_query, F.col("blocks")).otherwise(F.col("rounds")),
    )
    block = F.when(is_query, F.col("other")).otherwise(F.col("own"))
    turn = F.when(is_query, F.col("own")).otherwise(F.col("other"))
    tiles = (
        routed.join(sizes.filter("blocks > 0 and rounds > 0").hint("merge"), "part")
        .withColumn("own", F.pmod(F.xxhash64("vec_id"), own_of))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), other_of - 1)))
        .select(F.xxhash64("part", block, turn).alias("tile"), "query", "vec_id", "v")
        .repartition("tile")
        .sortWithinPartitions("tile", "query", "vec_id", "v")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "tile"):
            tile, ids = table.column("tile").to_numpy(), table.column("vec_id").to_numpy()
            asks = table.column("query").to_numpy().astype(bool)
            x = _matrix(table.column("v").combine_chunks())
            for at in group_slices(tile):
                own = np.arange(at.start, at.stop)
                queries, rest = own[asks[own]], own[~asks[own]]
                # Rows come by id: each id's rows are one candidate, by the best of them.
                first = np.flatnonzero(np.r_[True, ids[rest][1:] != ids[rest][:-1]][: len(rest)])
                last, named = np.r_[first[1:], len(rest)], ids[rest][first]
                found = []
                for start in range(0, len(queries), 256):
                    block = queries[start : start + 256]
                    dots = x[block] @ x[rest].T
                    # What a matrix product may lose against a sum in another order.
                    largest = np.linalg.norm(x[rest], axis=1).max(initial=0.0)
                    loss = _LOSS * largest * np.linalg.norm(x[block], axis=1)
                    for row, query in enumerate(block):
                        if not len(rest):
                            break
                        most = np.maximum.reduceat(dots[row], first)
                        most[named == ids[query]] = -np.inf
                        bar = np.partition(most, -k)[-k] if len(most) > k else -np.inf
                        near = np.flatnonzero((most >= bar - 2 * loss[row]) & (most > -np.inf))
                        if not len(near):
                            continue
                        size = (last - first)[near]
                        starts = np.cumsum(size) - size
                        rows = np.repeat(first[near] - starts, size) + np.arange(size.sum())
                        # Each product by itself, added up in one fixed order.
                        exact = (x[rest[rows]] * x[query]).sum(1)
                        score = np.maximum.reduceat(exact, starts)
                        best = _best(score, named[near], k)
                        found.append((np.full(len(best), ids[query]), named[near][best], score[best]))
                if found:
                    query, vec, score = (np.concatenate(c) for c in zip(*found, strict=True))
                    yield _rows(
                        query_id=pa.array(query), vec_id=pa.array(vec), score=pa.array(score)
                    )

    hits = tiles.mapInArrow(search, "query_id long, vec_id long, score double")
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
