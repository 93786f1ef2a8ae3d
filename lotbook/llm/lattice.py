"""Near-duplicate embeddings by lattice hashing: random projections decoded to E8 points."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotbook.llm.common import group_slices, mix, tiled, whole_groups, written
from lotbook.llm.components import components

LEAST_COSINE = 0.95
#: Share of the pairs at the bar that no table may bring together, and others that a row meets by
#: chance at most.
MISSED, MET = 1e-5, 64
_MOST_BLOCKS = 8
#: Rows of a block; a cell with more is compared block by block.
BLOCK_ROWS = 2048


# --- the lattice ------------------------------------------------------------------------------


def _even(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest point of D8 (integers of even sum), the next one, and both squared distances."""
    point = np.rint(y)
    off = y - point
    order = np.argsort(-np.abs(off), axis=1)
    rows = np.arange(len(y))
    odd = point.sum(1) % 2 != 0

    def moved(base: np.ndarray, which: np.ndarray) -> np.ndarray:
        out = base.copy()
        out[rows, which] += np.where(off[rows, which] >= 0, 1, -1)
        return out

    once, other = moved(point, order[:, 0]), moved(point, order[:, 1])
    twice = moved(once, order[:, 1])
    best = np.where(odd[:, None], once, point)
    second = np.where(odd[:, None], other, twice)
    distances = np.stack([((y - best) ** 2).sum(1), ((y - second) ** 2).sum(1)], 1)
    return best, second, distances


def e8_points(y: np.ndarray) -> np.ndarray:
    """The E8 points around each row, nearest first, coordinates doubled: rows x 4 x 8.

    E8 is D8 together with D8 shifted by a half; the two nearest of either are its candidates.
    """
    whole, whole2, d = _even(y)
    half, half2, e = _even(y - 0.5)
    points = np.stack([2 * whole, 2 * whole2, 2 * half + 1, 2 * half2 + 1], 1).astype(np.int64)
    order = np.argsort(np.concatenate([d, e], 1), axis=1, kind="stable")
    return np.take_along_axis(points, order[:, :, None], axis=1)


@dataclass(frozen=True)
class LatticeHash:
    """Tables of hashed cells. A cell of a table joins the E8 points of ``blocks`` projections
    to eight dimensions each; ``width`` is the length that one lattice unit stands for."""

    tables: int = 8
    blocks: int = 2
    width: float = 2.4
    seed: int = 5

    @classmethod
    def for_rows(cls, rows: int, least: float, missed: float = MISSED) -> LatticeHash:
        """As few blocks as keep the others that a row meets by chance below ``MET``, and as many
        tables as miss no more than the share ``missed`` of pairs at the bar.

        Blocks grow with the logarithm of the rows, so a row's chance partners do not grow with
        them. What a block and a table do is measured on made vectors.
        """
        for blocks in range(1, _MOST_BLOCKS + 1):
            one = cls(tables=4, blocks=blocks)
            found = one.share_met(least)
            tables = int(np.ceil(np.log(missed) / np.log(max(1 - found, 1e-9))))
            if rows * tables * one.met_by_chance() <= MET:
                break
        return cls(tables=max(tables, 2), blocks=blocks)

    def share_met(self, cosine: float, pairs: int = 2000) -> float:
        """Share of pairs of this cosine that share a cell of one table."""
        rng = np.random.default_rng(self.seed)
        x, y = rng.standard_normal((2, pairs, 32))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y -= (x * y).sum(1, keepdims=True) * x
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        a, b = self.cells(x), self.cells(cosine * x + np.sqrt(1 - cosine**2) * y)
        return float((a[:, :, :, None] == b[:, :, None, :]).any((2, 3)).mean())

    def met_by_chance(self, rows: int = 1500) -> float:
        """Cells of one table that two vectors at random are expected to share.

        Two rows' cells agree if all blocks do but for those that either probes; a block's own
        chances are counted over all pairs of made rows.
        """
        rng = np.random.default_rng(self.seed)
        x = rng.standard_normal((rows, 32))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        cells = LatticeHash(4, 1, self.width, self.seed).cells(x)
        home = probe = both = 0.0
        for t in range(cells.shape[1]):
            _, n = np.unique(cells[:, t, 0], return_counts=True)
            home += float((n * (n - 1)).sum())
            _, n = np.unique(cells[:, t].ravel(), return_counts=True)
            every = float((n * (n - 1)).sum())
            _, n = np.unique(cells[:, t, 1:].ravel(), return_counts=True)
            both += float((n * (n - 1)).sum())
            probe += (every - float((n * (n - 1)).sum())) / 2
        pairs = cells.shape[1] * rows * (rows - 1)
        a, w = home / pairs, both / pairs
        s = max(probe - home / 2, 0.0) / pairs
        b = self.blocks
        return a**b + b * a ** (b - 1) * (2 * s + w) + b * (b - 1) * a ** max(b - 2, 0) * s**2

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Per unit row and table: its home cell and the neighbouring cells that it probes,
        rows x tables x (1 + 2 * blocks). A probe moves one block to its second or third point."""
        n, dims = x.shape
        out = np.empty((n, self.tables, 1 + 2 * self.blocks), dtype=np.int64)
        for t in range(self.tables):
            rng = np.random.default_rng((self.seed, t, dims))
            parts = []
            for _ in range(self.blocks):
                y = x @ rng.standard_normal((dims, 8)) / self.width + rng.random(8)
                points = e8_points(y)[:, :3].view(np.uint64)
                factors = rng.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                with np.errstate(over="ignore"):
                    parts.append(mix((points * factors).sum(2)))
            with np.errstate(over="ignore"):
                home = np.full(n, mix(np.array([t + 1], dtype=np.uint64))[0])
                for part in parts:
                    home = home + part[:, 0]
                out[:, t, 0] = mix(home).view(np.int64)
                for k, part in enumerate(parts):
                    for j in (1, 2):
                        probe = home - part[:, 0] + part[:, j]
                        out[:, t, 2 * k + j] = mix(probe).view(np.int64)
        return out


# --- sketches and tiles ------------------------------------------------------------------------

#: Signs of this many projections. At the least cosine 13 of 128 differ on average, with a
#: deviation of 3.4; a pair that differs in more than this is not compared further.
SKETCH_BITS, MOST_APART = 128, 36
#: Partners that a vector tries at first in a cell.
FIRST_PARTNERS = 8


def sketches(x: np.ndarray, seed: int) -> np.ndarray:
    rng = np.random.default_rng((seed, 1 << 20, x.shape[1]))
    return np.packbits(x @ rng.standard_normal((x.shape[1], SKETCH_BITS)) > 0, axis=1)


def _unit(vectors: pa.Array) -> np.ndarray:
    """Unit rows of a list column, in double precision."""
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    x = flat.reshape(len(vectors), -1)
    # First by the largest component, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _pairs_of(pairs: list[np.ndarray]) -> pa.RecordBatch:
    found = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *pairs]), axis=0)
    return _rows(a=pa.array(found[:, 0].copy()), b=pa.array(found[:, 1].copy()))


def close_pairs(
    key: np.ndarray,
    component: np.ndarray,
    block: np.ndarray,
    sketch: np.ndarray,
    partners: int | None,
) -> np.ndarray:
    """Pairs of keys of one tile with close sketches and different components; with
    ``partners``, each row takes that many of the closest behind it at most."""
    crossed = (block != block[0]).any()
    found = [np.zeros((0, 2), np.int64)]
    for i in range(len(key) - 1):
        at = np.arange(i + 1, len(key))
        at = at[(component[at] != component[i]) & (key[at] != key[i])]
        if crossed:
            at = at[block[at] != block[i]]
        apart = np.bitwise_count(sketch[at] ^ sketch[i]).sum(1)
        near = apart <= MOST_APART
        at = at[near][np.argsort(apart[near], kind="stable")[:partners]]
        found.append(np.stack([np.full(len(at), key[i]), key[at]], 1))
    return np.sort(np.concatenate(found), axis=1)


#: Rows of a tile up to which all its pairs are compared at once with those of other tiles.
SMALL_TILE = 64


def close_in_small(
    tile: np.ndarray,
    key: np.ndarray,
    component: np.ndarray,
    block: np.ndarray,
    sketch: np.ndarray,
    partners: int | None,
) -> np.ndarray:
    """As :func:`close_pairs`, for many tiles of few rows: rows that are one place apart, then two,
    and so on, as long as any of them share a tile."""
    first = np.r_[True, tile[1:] != tile[:-1]]
    group = np.cumsum(first) - 1
    start = np.flatnonzero(first)
    crossed = np.minimum.reduceat(block, start) != np.maximum.reduceat(block, start)
    left, right, far = [], [], []
    for step in range(1, len(tile)):
        at = np.flatnonzero(tile[step:] == tile[:-step])
        if not len(at):
            break
        to = at + step
        keep = (component[at] != component[to]) & (key[at] != key[to])
        keep &= ~crossed[group[at]] | (block[at] != block[to])
        at, to = at[keep], to[keep]
        apart = np.bitwise_count(sketch[at] ^ sketch[to]).sum(1)
        near = apart <= MOST_APART
        left.append(at[near])
        right.append(to[near])
        far.append(apart[near])
    if not left:
        return np.zeros((0, 2), np.int64)
    at, to, apart = map(np.concatenate, (left, right, far))
    if partners is not None:
        order = np.lexsort((to, apart, at))
        at, to = at[order], to[order]
        fresh = np.r_[True, at[1:] != at[:-1]][: len(at)]
        place = np.arange(len(at)) - np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        at, to = at[place < partners], to[place < partners]
    return np.sort(np.stack([key[at], key[to]], 1), axis=1)


def vector_classes(vectors: DataFrame) -> DataFrame:
    """(embedding, id, copies) of each distinct vector that takes part; its id is the least."""
    finite = F.forall(
        "embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )
    useful = finite & F.exists("embedding", lambda v: v != 0)
    return (
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & useful)
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    )


def cell_members(classes: DataFrame, lattice: LatticeHash) -> DataFrame:
    """(cell, key, sketch, size) of vectors in cells that hold two at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                # Vectors of several lengths may share a table; those of one length meet.
                ids = part.column("id").to_numpy()
                length = np.asarray(part.column("embedding").value_lengths())
                for size in np.unique(length):
                    at = np.flatnonzero(length == size)
                    x = _unit(part.column("embedding").take(pa.array(at)))
                    cells = lattice.cells(x).reshape(len(at), -1)
                    sketch = sketches(x, lattice.seed)
                    per = cells.shape[1]
                    yield _rows(
                        cell=pa.array(cells.ravel()),
                        key=pa.array(np.repeat(ids[at], per)),
                        sketch=pa.array(
                            [s.tobytes() for s in sketch for _ in range(per)], pa.binary()
                        ),
                    )

    rows = classes.mapInArrow(run, "cell long, key long, sketch binary")
    shared = rows.groupBy("cell").agg(F.count("*").alias("size")).filter("size > 1")
    return rows.join(shared.hint("merge"), "cell")


def candidate_pairs(
    members: DataFrame, component: DataFrame | None, partners: int | None
) -> DataFrame:
    """Pairs (a, b) that share a cell, with close sketches. With components, only pairs across
    them, and only in cells that hold several."""
    if component is None:
        placed = members.withColumn("component", F.col("key"))
    else:
        reached = component.withColumnRenamed("node", "key").hint("merge")
        placed = members.join(reached, "key", "left").withColumn(
            "component", F.coalesce("component", "key")
        )
        mixed = placed.groupBy("cell").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        )
        mixed = mixed.filter("low <> high").select("cell")
        placed = placed.join(mixed.hint("merge"), "cell")
    rows = (
        tiled(placed, "cell", "key", F.col("size"), BLOCK_ROWS)
        .select("tile", "key", "component", "block", "sketch")
        .repartition("tile")
        .sortWithinPartitions("tile", "key")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "tile"):
            tile, key, component, block = (part.column(i).to_numpy() for i in range(4))
            flat = b"".join(part.column(4).to_pylist())
            sketch = np.frombuffer(flat, np.uint8).reshape(len(key), -1)
            groups = group_slices(tile)
            size = np.array([at.stop - at.start for at in groups])
            small = np.repeat(size <= SMALL_TILE, size)
            columns = (tile, key, component, block, sketch)
            pairs = [
                close_pairs(key[at], component[at], block[at], sketch[at], partners)
                for at, n in zip(groups, size, strict=True)
                if n > SMALL_TILE
            ]
            if small.any():
                pairs.append(close_in_small(*(c[small] for c in columns), partners))
            yield _pairs_of(pairs)

    return rows.mapInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """The pairs whose cosine, in double precision, reaches the bar."""
    side = lambda s: classes.select(
        F.col("id").alias(s), F.col("embedding").cast("array<double>").alias(f"v_{s}")
    )
    both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = np.asarray(batch.column("v_a").value_lengths()) == np.asarray(
                batch.column("v_b").value_lengths()
            )
            batch = batch.filter(pa.array(same))
            if batch.num_rows:
                cosine = (_unit(batch.column("v_a")) * _unit(batch.column("v_b"))).sum(1)
                yield batch.select(["a", "b"]).filter(pa.array(cosine >= least))

    return both.select("a", "b", "v_a", "v_b").mapInArrow(run, "a long, b long")


def link_counts(classes: DataFrame, component: DataFrame, least: float) -> DataFrame:
    """(id, n) of the vectors in components: copies of vectors whose cosine reaches the bar, its
    own among them. Links never leave a component, so its blocks are compared and no other."""
    sizes = component.groupBy("component").agg(F.count("*").alias("size"))
    placed = component.join(sizes.hint("merge"), "component")
    placed = tiled(placed, "component", "node", F.col("size"), BLOCK_ROWS)
    vectors = classes.select(
        F.col("id").alias("node"), "copies", F.col("embedding").cast("array<double>").alias("v")
    )
    rows = (
        placed.select("tile", "node", "block")
        .join(vectors.hint("merge"), "node")
        .select("tile", "block", "node", "copies", "v")
        .repartition("tile")
        .sortWithinPartitions("tile", "block", "node")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "tile"):
            tile, block, node, copies = (part.column(i).to_numpy() for i in range(4))
            length = np.asarray(part.column("v").combine_chunks().value_lengths())
            counts = np.zeros(len(node))
            for at in group_slices(tile):
                for size in np.unique(length[at]):
                    rows = np.arange(at.start, at.stop)[length[at] == size]
                    x = _unit(part.column("v").combine_chunks().take(pa.array(rows)))
                    second = np.flatnonzero(block[rows] != block[at.start])
                    first = np.arange(len(rows)) if not len(second) else np.setdiff1d(
                        np.arange(len(rows)), second
                    )
                    for a, b in [(first, first)] if not len(second) else [(first, second), (second, first)]:
                        for k in range(0, len(a), 512):
                            near = x[a[k : k + 512]] @ x[b].T >= least
                            if a is b:
                                own = np.arange(k, min(k + 512, len(a)))
                                near[own - k, own] = True
                            counts[rows[a[k : k + 512]]] += near @ copies[rows[b]]
            yield _rows(id=pa.array(node), n=pa.array(counts.astype(np.int64)))

    counted = rows.mapInArrow(run, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def near_duplicates(
    vectors: DataFrame, least: float = LEAST_COSINE, lattice: LatticeHash | None = None
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): (vec_id, n_links, component_id, kept).

    n_links counts the other rows whose cosine reaches the bar, component_id is the least id
    that links reach, kept marks it. Vectors that are null, zero, or hold null or non-finite
    parts link with nothing and are kept; vectors of different lengths do not link. A null id
    takes no part: no links, no component, not kept. Equal vectors are one while they are
    compared. Other columns are ignored; an empty table gives no rows.

    Vectors meet in the cells of the tables; what shares no cell of any table is not found. Blocks
    and tables follow from the number of vectors (``LatticeHash.for_rows``): about one pair in
    10,000 at the bar itself is missed, most of them by the sketches, fewer above it (the tests
    measure it). Links of a component are then counted by comparing all its members, so a
    pair that only the tables missed still counts.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding")
    classes = written(vector_classes(rows), "vector-classes")
    lattice = lattice or LatticeHash.for_rows(classes.count(), least)
    members = written(cell_members(classes, lattice), "cell-members")
    links = written(
        verified(candidate_pairs(members, None, FIRST_PARTNERS), classes, least), "vector-links"
    )
    reached = components(links)
    more = written(
        verified(candidate_pairs(members, reached, None), classes, least), "vector-links"
    )
    if not more.isEmpty():
        reached = components(links.unionByName(more))
    counts = link_counts(classes, reached, least)
    answer = (
        classes.join(reached.withColumnRenamed("node", "id").hint("merge"), "id", "left")
        .join(counts.hint("merge"), "id", "left")
        .select(
            "embedding",
            F.coalesce("component", "id").alias("component"),
            (F.coalesce("n", "copies") - 1).alias("n"),
        )
    )
    taking = F.when(F.col("vec_id").isNotNull(), F.col("embedding"))
    joined = rows.withColumn("embedding", taking).join(answer.hint("merge"), "embedding", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
