"""Exact n-gram Jaccard join: documents whose sets of word shingles overlap enough, and the
components these links form.

Candidates come from shared prefix shingles; size bands and hashed bitmaps bound the overlap from
above, tile by tile; sorted-array intersection decides. Hashes of 64 bits stand for shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotbook.llm.common import (
    Words,
    chunked,
    group_slices,
    lean,
    mix,
    text_of,
    whole_groups,
    written,
)
from lotbook.llm.components import components

SHINGLE_WORDS = 5
#: Shingles whose hash lies in this lowest part of the range are counted; prefixes lie there.
COUNTED_PART = 0.25
#: Shingles called common at most: what the tasks receive is 8 bytes for each.
MOST_COMMON = 1 << 22
LEAST_COMMON_COUNT = 16
#: Documents of one task that share a shingle beyond this number meet at one of them first.
LOCAL_GROUP = 32
#: Rows of a tile's side.
TILE_ROWS = 2048
#: Partners that a set tries at first where its group is not connected.
FIRST_PARTNERS = 8
#: Ids sent to every task at most, 8 bytes each; counted before.
MOST_SENT_IDS = 1 << 20
_MOST_BITS = 1 << 16
#: Shingles of a task that are counted together.
_COUNTED_AT_ONCE = 1 << 21
_STEP = np.uint64(0xD6E8FEB86659FD93)


# --- sets -------------------------------------------------------------------------------------


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Each text's distinct shingles as ascending int64 hashes.

    A text of one to four words has one shingle, its whole sequence; one without words none.
    """
    words = Words(texts)
    with np.errstate(over="ignore"):
        factor = np.cumprod(np.full(SHINGLE_WORDS, _STEP, np.uint64))
        n = max(len(words.hash) - SHINGLE_WORDS + 1, 0)
        full = np.zeros(n, dtype=np.uint64)
        for k in range(SHINGLE_WORDS):
            full += words.hash[k : k + n] * factor[k]
        full = mix(full).view(np.int64)
        sets = []
        for a, b in zip(words.first[:-1], words.first[1:], strict=True):
            if b - a >= SHINGLE_WORDS:
                sets.append(np.unique(full[a : b - SHINGLE_WORDS + 1]))
            elif b > a:
                short = (words.hash[a:b] * factor[: b - a]).sum() ^ np.uint64(b - a)
                sets.append(mix(np.array([short], dtype=np.uint64)).view(np.int64))
            else:
                sets.append(np.zeros(0, dtype=np.int64))
    return sets


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that name a set."""
    with np.errstate(over="ignore"):
        scrambled = mix(shingles.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
        size = np.uint64(len(shingles))
        one = mix(np.array([scrambled.sum(dtype=np.uint64) ^ (size * _STEP)], dtype=np.uint64))
        two = mix(scrambled).sum(dtype=np.uint64)
    return int(one.view(np.int64)[0]), int(np.array([two], dtype=np.uint64).view(np.int64)[0])


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Hashed bits of a set: four to eight for each shingle, up to a most; one size per band."""
    bits = min(max(64, 1 << (4 * len(shingles) - 1).bit_length()), _MOST_BITS)
    flags = np.zeros(bits, dtype=np.uint8)
    flags[shingles & (bits - 1)] = 1
    return np.packbits(flags, bitorder="little")


def fold_bits(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of bytes) folded to ``size`` bytes; what differs can only get less."""
    while bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def prefix_length(n: int) -> int:
    """Shingles of n of which a linked set must hold one: 0.8 of them are shared at least."""
    return n - (4 * n + 4) // 5 + 1 if n else 0


def linked(shared: int, n: int, m: int) -> bool:
    return 100 * shared >= 80 * (n + m - shared)


# --- passes over the texts ----------------------------------------------------------------------


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in chunked(texts):
            yield ids[a:b], shingle_sets(texts[a:b])


def _rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def document_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n, key, key2, bits) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets_of(batches):
            keys = [set_key(s) for s in sets]
            yield _rows(
                doc_id=pa.array(ids, pa.int64()),
                n=pa.array([len(s) for s in sets], pa.int64()),
                key=pa.array([k[0] for k in keys], pa.int64()),
                key2=pa.array([k[1] for k in keys], pa.int64()),
                bits=pa.array([bitmap(s).tobytes() for s in sets], pa.binary()),
            )

    texts = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return texts.mapInArrow(lean(run), "doc_id long, n long, key long, key2 long, bits binary")


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Ascending hashes of shingles that many documents hold, among those in the counted part.

    They go last in the order of prefixes, so that a passage found in much of the corpus makes
    no candidates. Every document is read; a task counts what it meets again among some millions
    of shingles, as what it meets once is not common, and only that is shuffled. A shingle is
    common if it has more than one in ``MOST_COMMON`` of all counted rows, so there are fewer than
    that, whatever the size.
    """
    top = int(-(1 << 63) + COUNTED_PART * (1 << 64))

    def repeated(low: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate([*low, np.zeros(0, np.int64)]), return_counts=True)
        again = n > 1
        return _rows(shingle=pa.array(found[again]), n=pa.array(n[again].astype(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: list[np.ndarray] = []
        waiting = 0
        for _, sets in _sets_of(batches):
            low += [s[: np.searchsorted(s, top)] for s in sets]
            waiting += sum(map(len, low[len(low) - len(sets) :]))
            if waiting >= _COUNTED_AT_ONCE:
                yield repeated(low)
                low, waiting = [], 0
        yield repeated(low)

    texts = docs.select(F.lit(0).alias("id"), text_of().alias("text"))
    counted = (
        texts.mapInArrow(lean(run), "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
    )
    # The total comes with the same pass: rows of rare shingles are summed, the others written.
    rare = F.col("n") <= LEAST_COMMON_COUNT
    table = written(
        counted.groupBy(F.when(~rare, F.col("shingle")).alias("shingle")).agg(
            F.sum("n").alias("n")
        ),
        "common-shingles",
    )
    total = table.agg(F.sum("n")).first()[0] or 0
    bar = max(LEAST_COMMON_COUNT, total // MOST_COMMON)
    common = table.filter(F.col("shingle").isNotNull() & (F.col("n") > bar)).select("shingle")
    return np.sort(common.toPandas()["shingle"].to_numpy(dtype=np.int64))


def prefix(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the order of rare ones by hash, then common ones by hash."""
    length = prefix_length(len(shingles))
    if not len(common):
        return shingles[:length]
    place = np.searchsorted(common, shingles)
    last = common[np.minimum(place, len(common) - 1)] == shingles
    rare = shingles[~last][:length]
    return np.concatenate([rare, shingles[last][: length - len(rare)]])


def stars(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """(shingle, a, n_a, b, n_b, more, open): set b shares the prefix shingle with set a, the centre
    of its group; n_a and n_b are their sizes. ``more``: the group has other centres. ``open``: b may
    link to members that it has not met in its group; where the whole group is seen, only those
    whose size another member's is near.

    Sets go by key; copies within a task count once. Where a task itself has a large group, it
    gives its members to one of them, and that one alone meets the other tasks' members, so no
    task receives more than a few rows of each task for any shingle. Rows that are settled
    already travel under a key of their own. Groups arrive sorted and pass by one after another.
    """
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(common)
    texts = docs.select(F.lit(0).alias("id"), text_of().alias("text"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        waiting = 0

        def flush() -> pa.RecordBatch:
            shingle, owner, n = map(np.concatenate, (held, owners, sizes))
            for kept in (held, owners, sizes):
                kept.clear()
            order = np.lexsort((owner, shingle))
            shingle, owner, n = shingle[order], owner[order], n[order]
            first = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
            size = np.diff(np.r_[first, len(shingle)])
            start = np.repeat(first, size)
            more = np.repeat(size, size) > LOCAL_GROUP
            settled = more & (np.arange(len(start)) != start)
            with np.errstate(over="ignore"):
                own = mix((owner ^ shingle).view(np.uint64)).view(np.int64)
            return _rows(
                to=pa.array(np.where(settled, own, shingle)),
                shingle=pa.array(shingle),
                a=pa.array(owner[start], mask=~settled),
                n_a=pa.array(n[start]),
                b=pa.array(owner),
                n_b=pa.array(n),
                more=pa.array(more),
            )

        for _, sets in _sets_of(batches):
            for s in sets:
                if not len(s):
                    continue
                key = set_key(s)[0]
                if key in seen:
                    continue
                seen.add(key)
                held.append(prefix(s, common.value))
                owners.append(np.full(len(held[-1]), key, dtype=np.int64))
                sizes.append(np.full(len(held[-1]), len(s), dtype=np.int32))
                waiting += len(held[-1])
            if waiting >= 1 << 20:
                yield flush()
                waiting = 0
        if held:
            yield flush()

    columns = ["shingle", "a", "n_a", "b", "n_b", "more", "open"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "to"):
            done = part.filter(part.column("a").is_valid())
            if done.num_rows:
                done = done.append_column("open", done.column("more"))
                yield from done.select(columns).to_batches()
            rest = part.filter(part.column("a").is_null())
            if not rest.num_rows:
                continue
            shingle, key, n = (rest.column(c).to_numpy() for c in ("shingle", "b", "n_b"))
            more = rest.column("more").to_numpy().astype(bool)
            fresh = np.r_[True, shingle[1:] != shingle[:-1]]
            first = np.flatnonzero(fresh)
            group = np.cumsum(fresh) - 1
            centre = first[group]
            more = np.logical_or.reduceat(more, first)[group]
            member = key != key[centre]
            member[1:] &= (key[1:] != key[:-1]) | fresh[1:]
            at = np.flatnonzero(member)
            yield _rows(
                shingle=pa.array(shingle[at]),
                a=pa.array(key[centre[at]]),
                n_a=pa.array(n[centre[at]]),
                b=pa.array(key[at]),
                n_b=pa.array(n[at]),
                more=pa.array(more[at]),
                open=pa.array(more[at] | near_in_size(group[at], n[at])),
            )

    rows = texts.mapInArrow(
        lean(emit), "to long, shingle long, a long, n_a int, b long, n_b int, more boolean"
    )
    met = rows.repartition("to").sortWithinPartitions("to", "b")
    return met.mapInArrow(
        lean(meet), "shingle long, a long, n_a int, b long, n_b int, more boolean, open boolean"
    )


def near_in_size(group: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which rows have another row of their group whose size is within the ratio of a link. The
    nearest sizes are next to each other in order."""
    order = np.lexsort((n, group))
    g, size = group[order], n[order].astype(np.int64)
    fits = (g[1:] == g[:-1]) & (5 * size[:-1] >= 4 * size[1:])
    found = np.zeros(len(n), dtype=bool)
    found[order[1:]] |= fits
    found[order[:-1]] |= fits
    return found


#: Sizes that a linked pair can have.
_SIZES_FIT = "4L * greatest(n_a, n_b) <= 5L * least(n_a, n_b)"


# --- verification ------------------------------------------------------------------------------


def near_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of keys that bitmaps do not rule out; their sizes have been tested."""
    side = lambda s: classes.select(
        F.col("key").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}")
    )
    both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            sizes = zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b")), strict=True)
            bits = zip(*(batch.column(c) for c in ("bits_a", "bits_b")), strict=True)
            for i, ((n, m), (x, y)) in enumerate(zip(sizes, bits, strict=True)):
                x, y = (np.frombuffer(z.as_buffer(), np.uint8)[None] for z in (x, y))
                least = min(x.shape[1], y.shape[1])
                apart = np.bitwise_count(fold_bits(x, least) ^ fold_bits(y, least)).sum()
                keep[i] = apart <= (n + m) // 9
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(
        lean(run), "a long, b long"
    )


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys whose sets overlap enough, by exact intersection.

    Sets are made again from one text per class, for classes in some pair only.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    named = classes.select("key", F.col("rep").alias("id")).join(
        wanted.hint("merge"), "key", "left_semi"
    )
    named = written(named.select("id").distinct(), "wanted")
    # Counted: few ids go to the texts, else the texts to the ids.
    few = named.count() <= MOST_SENT_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets_of(batches):
            yield _rows(
                key=pa.array([set_key(s)[0] for s in sets], pa.int64()),
                shingles=pa.array([s.tobytes() for s in sets], pa.binary()),
            )

    # An id may stand in several rows; rows of other texts give sets that no pair asks for, and
    # rows of the same text the same set.
    chosen = texts.join(F.broadcast(named) if few else named.hint("merge"), "id")
    sets = chosen.mapInArrow(lean(make), "key long, shingles binary").dropDuplicates(["key"])
    sets = written(sets, "shingle-sets")
    side = lambda s: sets.select(F.col("key").alias(s), F.col("shingles").alias(f"set_{s}"))
    both = pairs.join(side("b").hint("merge"), "b").join(side("a").hint("merge"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            columns = zip(batch.column("set_a"), batch.column("set_b"), strict=True)
            for i, (x, y) in enumerate(columns):
                x, y = (np.frombuffer(z.as_buffer(), np.int64) for z in (x, y))
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                place = np.searchsorted(y, x)
                shared = int((y[np.minimum(place, len(y) - 1)] == x).sum())
                keep[i] = linked(shared, len(x), len(y))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(lean(run), "a long, b long")


# --- what stars leave open ------------------------------------------------------------------------


def tile_pairs(
    n: np.ndarray,
    key: np.ndarray,
    component: np.ndarray,
    block: np.ndarray,
    bits: list[np.ndarray],
    partners: int | None,
) -> np.ndarray:
    """Pairs of keys (rows of two) of one tile that size band and bitmaps do not rule out.

    Rows come by size. Only rows of different components meet, and of different blocks where
    the tile has two. With ``partners``, each row takes that many of those found at most.
    """
    crossed = (block != block[0]).any()
    found = [np.zeros((0, 2), np.int64)]
    # Bitmaps of a band and of the next one (partners lie in these two), folded to the band's.
    width = np.array([x.shape[1] for x in bits])
    bands = {}
    for size in np.unique(width):
        start, end = np.searchsorted(width, size), np.searchsorted(width, 2 * size, side="right")
        bands[size] = start, np.concatenate([fold_bits(x, size) for x in bits[start:end]])
    for i in range(len(n) - 1):
        # The size band: partners further on are no more than a quarter larger.
        end = np.searchsorted(n, 5 * n[i] // 4, side="right")
        at = np.arange(i + 1, end)
        at = at[component[at] != component[i]]
        if crossed:
            at = at[block[at] != block[i]]
        start, rows = bands[width[i]]
        apart = np.bitwise_count(rows[at - start] ^ rows[i - start]).sum(1)
        at = at[apart <= (n[at] + n[i]) // 9][:partners]
        found.append(np.stack([np.full(len(at), key[i]), key[at]], 1))
    return np.sort(np.concatenate(found), axis=1)


def group_members(star: DataFrame) -> DataFrame:
    """(shingle, key, n) of the sets that may link to members of a group which they have not met.

    A centre has met all members of its group, unless the group has more centres.
    """
    end = lambda e: F.struct(F.col(e).alias("key"), F.col(f"n_{e}").alias("n"))
    ends = F.when(F.col("more"), F.array(end("b"), end("a"))).otherwise(F.array(end("b")))
    members = star.filter("open").select("shingle", F.explode(ends).alias("m"))
    return members.select("shingle", "m.*").distinct()


def open_groups(members: DataFrame, reached: DataFrame) -> DataFrame:
    """(shingle, key, n, component) of groups whose members are not all in one component. Once
    closed a group stays closed, so the next round looks at what this one leaves."""
    known = reached.select(F.col("node").alias("key"), F.col("component").alias("own"))
    placed = (
        members.select("shingle", "key", "n")
        .join(known.hint("merge"), "key", "left")
        .select("shingle", "key", "n", F.coalesce("own", "key").alias("component"))
    )
    mixed = (
        placed.groupBy("shingle")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("shingle")
    )
    return placed.join(mixed.hint("merge"), "shingle", "left_semi")


def size_banded(members: DataFrame) -> DataFrame:
    """``members`` (shingle, key, n, component) with (tile, block): the pairs of a group whose sizes
    may link meet in tiles of bounded size.

    Sizes fall into bands, of which only a band itself and the two beside it can hold linked sets.
    A member without another component in these has no partner. A group of up to ``TILE_ROWS``
    rows is one tile; a larger one is cut into its bands, and a band into blocks by a hash; a tile
    is a pair of blocks of bands that may link. Tiles of sizes apart are never made.
    """
    # A little wider than the greatest ratio, so that rounding never parts a linked pair.
    band = F.floor(F.log("n") / F.log(F.lit(1.26))).cast("int")
    rows = members.withColumn("band", band)
    counts = rows.groupBy("shingle", "band").agg(
        F.count("*").alias("rows"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    blocks = F.ceil(F.col("rows") / TILE_ROWS).cast("int").alias("blocks")
    # As many bands as a factor of 1.26 has powers up to the longest text.
    groups = counts.groupBy("shingle").agg(
        F.sum("rows").alias("size"),
        F.map_from_entries(F.collect_list(F.struct("band", F.struct(blocks, "low", "high")))).alias(
            "bands"
        ),
    )
    beside = [F.try_element_at("bands", F.col("band") + step) for step in (-1, 0, 1)]
    met = rows.join(groups.hint("merge"), "shingle").filter(
        F.least(*(b["low"] for b in beside)) < F.greatest(*(b["high"] for b in beside))
    )
    small = F.col("size") <= TILE_ROWS
    of = lambda step: F.coalesce(beside[step + 1]["blocks"], F.lit(0))
    at = F.pmod(F.xxhash64("key"), of(0)).cast("int")

    def tiles(step: int, make) -> Column:
        others = F.when(of(step) > 0, F.sequence(F.lit(0), of(step) - 1))
        return F.transform(F.coalesce(others, F.array().cast("array<int>")), make)

    low_band, high_band = F.col("band") - 1, F.col("band") + 1
    banded = F.concat(
        tiles(0, lambda j: F.xxhash64("shingle", "band", F.least("at", j), "band", F.greatest("at", j))),
        tiles(1, lambda j: F.xxhash64("shingle", "band", "at", high_band, j)),
        tiles(-1, lambda j: F.xxhash64("shingle", low_band, j, "band", "at")),
    )
    tile = F.when(small, F.array(F.xxhash64("shingle"))).otherwise(banded)
    return (
        met.withColumn("at", F.when(small, 0).otherwise(at))
        .withColumn("tile", F.explode(tile))
        .withColumn("block", F.when(small, 0).otherwise(F.col("band") * (1 << 20) + F.col("at")))
    )


def open_pairs(
    groups: DataFrame,
    classes: DataFrame,
    pick: Callable | None = None,
    partners: int | None = None,
) -> DataFrame:
    """Pairs of sets that share a prefix shingle, lie in different components so far, and are
    not ruled out by size band or bitmap. ``groups`` are open ones. With ``pick`` (least or
    greatest) each set stays with one of its shingles, where near copies mostly meet, and with
    ``partners`` it tries only so many sets there.

    Groups are cut into tiles, so that the rows of a tile do not grow with the group.
    """
    members = groups
    if pick is not None:
        members = members.groupBy("key", "n", "component").agg(pick("shingle").alias("shingle"))
    rows = (
        size_banded(members)
        .join(classes.select("key", "bits").hint("merge"), "key")
        .select("tile", F.col("n").cast("long"), "key", "component", "block", "bits")
        .repartition("tile")
        .sortWithinPartitions("tile", "n", "key")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "tile"):
            tile, n, key, component, block = (part.column(i).to_numpy() for i in range(5))
            bits = [np.frombuffer(x, np.uint8)[None] for x in part.column(5).to_pylist()]
            pairs = [np.zeros((0, 2), np.int64)]
            for at in group_slices(tile):
                pairs.append(
                    tile_pairs(n[at], key[at], component[at], block[at], bits[at], partners)
                )
            found = np.unique(np.concatenate(pairs), axis=0)
            yield _rows(a=pa.array(found[:, 0].copy()), b=pa.array(found[:, 1].copy()))

    return rows.mapInArrow(lean(run), "a long, b long")


def joined_components(reached: DataFrame, links: DataFrame) -> DataFrame:
    """``reached`` (node, component) after more links: components are joined, not nodes."""
    known = {
        end: reached.select(F.col("node").alias(end), F.col("component").alias(f"own_{end}"))
        for end in ("a", "b")
    }
    for end, own in known.items():
        links = links.join(own.hint("merge"), end, "left")
    ends = [F.coalesce(f"own_{end}", F.col(end)).alias(end) for end in known]
    merged = components(links.select(*ends).distinct()).withColumnRenamed("node", "old")
    merged = merged.withColumnRenamed("component", "new")
    # Nodes that no link has reached before are their own components.
    fresh = merged.join(
        reached.select(F.col("node").alias("old")).hint("merge"), "old", "left_anti"
    ).select(F.col("old").alias("node"), F.col("new").alias("component"))
    moved = (
        reached.withColumnRenamed("component", "old")
        .join(merged.hint("merge"), "old", "left")
        .select("node", F.coalesce("new", "old").alias("component"))
    )
    return written(moved.unionByName(fresh), "reached")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): (doc_id, n_shingles, component_id).

    Two documents link when 100 times the size of their shingle sets' intersection is at least
    80 times that of their union; component_id is the smallest id that links reach. Null and
    blank texts have no shingles and stay alone. A null id takes no part and has no component.
    Rows with the same text fall together, an id that repeats with other texts joins theirs.
    Other columns are ignored; an empty table gives no rows.

    Exact for any choice of common shingles: linked sets share a shingle of both prefixes. Each
    set is first compared with the centre of each of its groups; connected components then show
    which groups still hold unconnected members, and only pairs across those are compared.
    """
    sets = written(document_sets(docs), "document-sets")
    # Bits of copies are the same.
    classes = written(
        sets.filter("n > 0 and doc_id is not null")
        .groupBy("key", "key2", "n")
        .agg(F.min("doc_id").alias("rep"), F.first("bits").alias("bits")),
        "classes",
    )
    known = docs.filter(F.col("doc_id").isNotNull())
    star = written(stars(known, common_shingles(known)), "stars")

    def check(pairs: DataFrame) -> DataFrame:
        return written(verified(written(pairs, "near-pairs"), classes, known), "jaccard-links")

    first = star.filter(_SIZES_FIT).select("a", "b").distinct()
    reached = written(components(check(near_pairs(first, classes))), "reached")
    groups = group_members(star)
    # A few partners first: in a large group of near copies nearly every set finds a link among
    # them, so that few are left for the comparison with all.
    for pick, partners in ((F.min, FIRST_PARTNERS), (F.max, FIRST_PARTNERS), (None, None)):
        groups = written(open_groups(groups, reached), "open-groups")
        more = check(open_pairs(groups, classes, pick, partners).distinct())
        if not more.isEmpty():
            reached = joined_components(reached, more)
    # Components of keys become those of ids: the least id of a component's classes.
    named = classes.join(
        reached.select(F.col("node").alias("key"), "component").hint("merge"), "key", "left"
    ).select("key", "key2", "n", "rep", F.coalesce("component", "key").alias("component"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    answer = named.join(least.hint("merge"), "component").select(
        "key", "key2", "n", "component_id"
    )
    return (
        sets.drop("bits")
        .join(answer.hint("merge"), ["key", "key2", "n"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias(
                "component_id"
            ),
        )
    )
