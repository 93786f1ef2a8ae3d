"""Hard negatives by spanning-tree bounds.

Anchors of a block form a minimum spanning tree of their distances. The score of a candidate x at
anchor c differs from that at its parent p by <c - p, x>, so by no more than |c - p| |x|. Walking
down a tree, every candidate has an interval that its score lies in; only those whose interval
overlaps the wanted window are scored again, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotbook.llm.common import group_slices, whole_groups, written

EVERY = 100
SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative scores at least so many hundredths of the positive, and no more than it.
LEAST_PERCENT = 80
#: Anchors of one tree, trees and candidates of one tile. They bound what a task holds.
TREE_ANCHORS, TILE_TREES, TILE_ROWS = 256, 16, 4096
#: Sums below this bound are exact in a double; beyond, integers are used.
_EXACT = float(1 << 52)
_LONG = float(1 << 62)


# --- rows ----------------------------------------------------------------------------------------


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v, row) with whole components; ``row`` names a row by its content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            edge = lists.offsets.to_numpy()
            edge = edge - edge[0]
            whole = np.floor(scale * flat)
            squares = np.r_[0.0, np.cumsum(np.where(np.isfinite(whole), whole, 0.0) ** 2)]
            bad = np.r_[0, np.cumsum(~np.isfinite(flat))]
            keep = (bad[edge[1:]] == bad[edge[:-1]]) & (
                squares[edge[1:]] - squares[edge[:-1]] < _LONG
            )
            # Only kept rows go on; what is not finite would not fit a whole number.
            v = pa.LargeListArray.from_arrays(
                pa.array(edge), pa.array(np.where(np.abs(whole) < _LONG, whole, 0).astype(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), v.cast(pa.list_(pa.int64()))],
                names=["vec_id", "label", "v"],
            ).filter(pa.array(keep))

    whole = F.forall("embedding", lambda x: x.isNotNull())
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding"
    ).filter(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & whole
    )
    found = rows.mapInArrow(run, "vec_id long, label long, v array<long>")
    return found.distinct().withColumn("row", F.xxhash64("vec_id", "label", "v"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _value(cell: pa.Scalar) -> int | np.ndarray:
    return cell.values.to_numpy() if isinstance(cell, pa.ListScalar) else cell.as_py()


# --- trees ---------------------------------------------------------------------------------------


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, distance) of a minimum spanning tree of the rows of ``x``.

    ``order`` lists the rows, parents first; ``parent`` and ``distance`` go by row, and the root,
    row 0, is its own parent.
    """
    n = len(x)
    x = x.astype(np.float64)
    order, parent = np.zeros(n, np.int64), np.zeros(n, np.int64)
    distance = np.full(n, np.inf)
    distance[0] = 0.0
    done = np.zeros(n, dtype=bool)
    for i in range(n):
        at = int(np.argmin(np.where(done, np.inf, distance)))
        order[i], done[at] = at, True
        away = np.sqrt(((x - x[at]) ** 2).sum(1))
        nearer = ~done & (away < distance)
        distance[nearer], parent[nearer] = away[nearer], at
    return order, parent, distance


_TREE = (
    "tree long, dim int, anchors array<long>, labels array<long>, rows array<long>, "
    "v array<long>, walk array<long>, parent array<long>, edge array<double>"
)


def trees(rows: DataFrame, every: int) -> DataFrame:
    """One row per tree of anchors; anchors of one label share one where they can.

    Anchors are ordered by label and cut into runs, so that no tree holds more than
    ``TREE_ANCHORS``. Which anchors share a tree changes the work, never the result.
    """
    most = TREE_ANCHORS
    anchors = rows.filter(F.col("vec_id") % every == 0).withColumn("dim", F.size("v"))
    ranged = anchors.repartitionByRange("dim", "label", "row").sortWithinPartitions(
        "dim", "label", "row"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "dim"):
            dims = part.column("dim").to_numpy()
            for group in group_slices(dims):
                for start in range(group.start, group.stop, most):
                    yield grown(part.slice(start, min(most, group.stop - start)))

    def grown(part: pa.Table) -> pa.RecordBatch:
        x = _matrix(part.column("v"))
        walk, parent, edge = spanning_tree(x)
        ids = part.column("row").to_numpy()
        one = lambda a, kind: pa.array([a], pa.list_(kind))
        long = pa.int64()
        return pa.RecordBatch.from_pydict(
            {
                # The first row names the tree: rows are distinct.
                "tree": pa.array([int(ids[0])]),
                "dim": pa.array([x.shape[1]], pa.int32()),
                "anchors": one(part.column("vec_id").to_numpy(), long),
                "labels": one(part.column("label").to_numpy(), long),
                "rows": one(ids, long),
                "v": one(x.ravel(), long),
                "walk": one(walk, long),
                "parent": one(parent, long),
                "edge": one(edge, pa.float64()),
            }
        )

    return ranged.select("vec_id", "label", "v", "row", "dim").mapInArrow(run, _TREE)


# --- a tile --------------------------------------------------------------------------------------


def best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by id, then by row."""
    if len(score) > k:
        bar = np.partition(score, len(score) - k)[len(score) - k]
        keep = np.flatnonzero(score >= bar)
    else:
        keep = np.arange(len(score))
    return keep[np.lexsort((rows[keep], ids[keep], -score[keep]))][:k]


class Candidates:
    """The candidates of a tile, and intervals of their scores at the anchors of a tree."""

    def __init__(self, part: pa.Table):
        self.ids, self.labels, self.rows = (
            part.column(c).to_numpy() for c in ("vec_id", "label", "row")
        )
        self.v = _matrix(part.column("v"))
        self.norm = np.sqrt((self.v.astype(np.float64) ** 2).sum(1))
        self.largest = float(self.norm.max(initial=0.0))
        #: Intervals asked for, and scores made again.
        self.bounded = self.scored = 0

    def walk(self, tree: dict) -> Iterator[Anchor]:
        x = tree["v"].reshape(len(tree["anchors"]), -1)
        length = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        # Inner products and their partial sums are no larger than the norms' product.
        kind = np.float64 if self.largest * length.max(initial=0.0) < _EXACT else np.int64
        v, x = self.v.astype(kind), x.astype(kind)
        # What bounds lose as doubles, where scores are beyond their whole numbers.
        loss = 0.0 if kind is np.float64 else 1e-15 * self.largest * length.max() + 1
        parents = tree["parent"]
        waiting = np.bincount(parents, minlength=len(x))
        waiting[tree["walk"][0]] -= 1
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for at in tree["walk"].tolist():
            parent = int(parents[at])
            if at == parent:
                low = (v @ x[at]).astype(np.float64)
                anchor = Anchor(self, tree, at, v, x[at], low, low.copy(), loss, exact=True)
            else:
                # Scores are whole numbers; half a unit and a share cover the rounding.
                wide = tree["edge"][at] * self.norm * (1 + 1e-9) + 0.5
                low, high = held[parent]
                anchor = Anchor(self, tree, at, v, x[at], low - wide, high + wide, loss)
                waiting[parent] -= 1
                if not waiting[parent]:
                    del held[parent]
            yield anchor
            if waiting[at]:
                held[at] = anchor.low, anchor.high


class Anchor:
    """One anchor of a tree with the bounds it has from its parent."""

    def __init__(self, candidates, tree, at, v, x, low, high, loss, exact=False):
        self.of, self.v, self.x, self.loss = candidates, v, x, loss
        self.low, self.high = low, high
        self.at, self.label, self.row = at, tree["labels"][at], tree["rows"][at]
        self.id = tree["anchors"][at]
        self.exact = np.full(len(low), exact)
        self.score = (v @ x).astype(np.int64) if exact else np.zeros(len(low), np.int64)
        candidates.bounded += len(low)
        candidates.scored += exact * len(low)

    def rescore(self, places: np.ndarray) -> None:
        """Exact scores at ``places``; intervals shrink to them."""
        places = places[~self.exact[places]]
        if not len(places):
            return
        self.of.scored += len(places)
        found = self.v[places] @ self.x
        self.score[places] = found
        self.low[places] = self.high[places] = found
        self.exact[places] = True

    def top(self, places: np.ndarray, low: float, high: float, k: int) -> np.ndarray:
        """Places among ``places`` of the ``k`` highest scores within [low, high]."""
        lows, highs = self.low[places], self.high[places]
        loss = self.loss
        near = (highs >= low - loss) & (lows <= high + loss)
        places, lows, highs = places[near], lows[near], highs[near]
        sure = lows[(lows >= low + loss) & (highs <= high - loss)]
        if len(sure) > k:
            # So many lie above this bar that what stays below it cannot be among them.
            bar = np.partition(sure, len(sure) - k)[len(sure) - k]
            places = places[highs >= bar - 2 * loss]
        self.rescore(places)
        score = self.score[places]
        places = places[(score >= low) & (score <= high)]
        of = self.of
        return places[best(self.score[places], of.ids[places], of.rows[places], k)]


def positives_of(candidates: Candidates, tree: dict, k: int) -> Iterator[tuple]:
    """(tree, at, row, vec_id, score) of each anchor's ``k`` best candidates of its label."""
    order = np.argsort(candidates.labels, kind="stable")
    sorted_labels = candidates.labels[order]
    for anchor in candidates.walk(tree):
        a, b = np.searchsorted(sorted_labels, [anchor.label, anchor.label + 1])
        own = order[a:b]
        own = own[candidates.rows[own] != anchor.row]
        found = anchor.top(own, -np.inf, np.inf, k)
        for i in found:
            yield tree["tree"], anchor.at, candidates.rows[i], candidates.ids[i], anchor.score[i]


def negatives_of(candidates: Candidates, tree: dict, k: int, percent: int) -> Iterator[tuple]:
    """(tree, at, positive_score, row, vec_id, score): for each score of an anchor's positives the
    ``k`` best candidates of other labels in its window."""
    windows: dict[int, list[int]] = {}
    for at, score in zip(tree["at"].tolist(), tree["score"].tolist(), strict=True):
        windows.setdefault(at, []).append(score)
    for anchor in candidates.walk(tree):
        others = np.flatnonzero(candidates.labels != anchor.label)
        for high in windows.get(anchor.at, []):
            low = -((-percent * high) // 100)
            for i in anchor.top(others, low, high, k):
                yield (
                    tree["tree"], anchor.at, high,
                    candidates.rows[i], candidates.ids[i], anchor.score[i],
                )


# --- the search ----------------------------------------------------------------------------------


def meet(
    rows: DataFrame, forest: DataFrame, find, names: Sequence[str], tree_columns: Sequence[str]
) -> DataFrame:
    """Every tree meets every candidate of its length, in tiles of bounded size.

    Candidates lie in blocks by a hash of their content and trees in blocks by a hash of their
    name; each pair of blocks is a tile. Both sides are copied once per block of the other, and a
    tile gives no more rows than its anchors ask for.
    """
    n, m = rows.count(), forest.count()
    blocks, turns = max(1, -(-n // TILE_ROWS)), max(1, -(-m // TILE_TREES))

    def dealt(df: DataFrame, key: str, own: str, count: int, other: str, others: int) -> DataFrame:
        return df.withColumns(
            {
                own: F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.lit(count)),
                other: F.explode(F.sequence(F.lit(0), F.lit(others - 1))),
            }
        ).withColumn("tile", F.xxhash64("dim", F.col("block").cast("long"), F.col("turn").cast("long")))

    candidates = dealt(
        rows.withColumn("dim", F.size("v")), "row", "block", blocks, "turn", turns
    ).select("tile", "dim", "vec_id", "label", "v", "row")
    asking = dealt(forest, "tree", "turn", turns, "block", blocks).select("tile", *tree_columns)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            part = Candidates(left)
            for i in range(right.num_rows):
                found += find(part, {c: _value(right.column(c)[i]) for c in tree_columns})
        columns = zip(*found, strict=True) if found else [[] for _ in names]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    return (
        candidates.groupBy("tile")
        .cogroup(asking.groupBy("tile"))
        .applyInArrow(run, ", ".join(f"{n} long" for n in names))
    )


def first(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, into: str) -> DataFrame:
    """The first ``k`` rows of each group with their place, cut down in the map tasks."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(into, place).filter(F.col(into) <= k)


def hard_negatives(
    vectors: DataFrame,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: int = LEAST_PERCENT,
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor
    and each of its positives the first negatives in the positive's window. Exact.

    Rows of ``vectors`` (vec_id, label, embedding) whose vec_id is divisible by ``every`` are
    anchors. A component x becomes floor(scale * x); a row's score is its inner product with the
    anchor; higher scores come first, ties by smaller vec_id. The positives are the first rows of
    the anchor's label; a negative has another label and scores between ``percent`` hundredths of
    the positive and the positive.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part,
    nor those so long that scores may not fit a long (norms of 2^31). Vectors of different lengths
    do not meet. Rows equal in id, label and components count once; rows that share only the id
    are rows of their own, and each may be an anchor. Empty vectors score 0. Other columns are
    ignored; an empty table gives no rows.
    """
    rows = written(quantised(vectors, scale), "quantised")
    forest = written(trees(rows, every), "anchor-trees")
    base = [c.split(" ")[0] for c in _TREE.split(", ")]
    near = meet(
        rows,
        forest,
        lambda part, tree: positives_of(part, tree, positives),
        ["tree", "at", "row", "positive_id", "positive_score"],
        base,
    )
    order = [F.desc("positive_score"), F.asc("positive_id"), F.asc("row")]
    near = written(first(near, ["tree", "at"], order, positives, "place"), "positives")
    # A tree's positives: at most so many for each of its anchors.
    asked = near.groupBy("tree").agg(
        F.collect_set(F.struct("at", F.col("positive_score").alias("score"))).alias("asked")
    )
    windows = forest.join(asked.hint("merge"), "tree").select(
        *base, F.col("asked.at").alias("at"), F.col("asked.score").alias("score")
    )
    far = meet(
        rows,
        windows,
        lambda part, tree: negatives_of(part, tree, negatives, percent),
        ["tree", "at", "positive_score", "row", "negative_id", "negative_score"],
        [*base, "at", "score"],
    )
    order = [F.desc("negative_score"), F.asc("negative_id"), F.asc("row")]
    far = first(far, ["tree", "at", "positive_score"], order, negatives, "rank").drop("row")
    anchors = forest.select(
        "tree", F.posexplode("anchors").alias("at", "anchor_id")
    )
    return (
        near.drop("row", "place")
        .join(far.hint("merge"), ["tree", "at", "positive_score"])
        .join(anchors.withColumn("at", F.col("at").cast("long")).hint("merge"), ["tree", "at"])
        .select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
    )
