"""Joins and searches against brute force."""

import re

import numpy as np
import pytest

from lotbook.llm import ann, jaccard, lattice
from lotbook.llm.common import table
from lotbook.llm.components import components

DOCS = "doc_id long, text string, n long, key int, component_id int"
VECTORS = "vec_id long, embedding array<float>, id int, v int, component int"


def reach(ids, links):
    best = {i: i for i in ids}
    while True:
        before = dict(best)
        for a, b in links:
            best[a] = best[b] = min(best[a], best[b])
        if best == before:
            return best


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_jaccard(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    best = reach(texts, links)
    return {i: (len(sets[i]), best[i]) for i in texts}


def found_jaccard(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}


@pytest.fixture(scope="module")
def families():
    """Chains of near copies, a passage shared by all, small and odd texts."""
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(words, 12))
    texts = {0: None, 1: "", 2: "\t \n", 3: "Two words", 4: "two\x0bWORDS", 5: "two words x"}
    for family in range(6):
        text = list(rng.choice(words, 40 + 30 * family)) + passage
        for _ in range(12):
            text = list(text)
            text[rng.integers(len(text))] = str(rng.choice(words))
            texts[len(texts)] = " ".join(text)
    texts[len(texts)] = texts[10].upper()
    return texts


def test_jaccard_equals_brute_force(spark, families, monkeypatch):
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in families.items()], DOCS)
    want = plain_jaccard(families)
    assert found_jaccard(docs) == want
    # Every shingle common, groups collapsed in the tasks, many tiles: the same answer.
    monkeypatch.setattr(jaccard, "LEAST_COMMON_COUNT", 1)
    monkeypatch.setattr(jaccard, "LOCAL_GROUP", 2)
    monkeypatch.setattr(jaccard, "TILE_ROWS", 5)
    monkeypatch.setattr(jaccard, "FIRST_PARTNERS", 1)
    assert found_jaccard(docs) == want


def test_jaccard_odd_tables(spark):
    rows = [(5, "a b c d e f", 1, 1, 1)] * 2 + [(None, "a b c d e f", 1, 1, 1), (2, None, 1, 1, 1)]
    rows += [(9, "A B c d e f", None, None, None), (7, "long " * 50_000, 1, 1, 1)]
    found = jaccard.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [(5, 2, 5), (5, 2, 5), (None, 2, None), (2, 0, 2), (9, 2, 5), (7, 1, 7)], key=repr
    )
    assert found_jaccard(spark.createDataFrame([], DOCS)) == {}


def test_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = rng.integers(-(1 << 63), 1 << 63, 300)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 250))) for _ in range(2))
        x, y = jaccard.bitmap(a)[None], jaccard.bitmap(b)[None]
        least = min(x.shape[1], y.shape[1])
        apart = np.bitwise_count(jaccard.fold_bits(x, least) ^ jaccard.fold_bits(y, least)).sum()
        assert apart <= len(np.setxor1d(a, b))
        shared = len(np.intersect1d(a, b))
        if jaccard.linked(shared, len(a), len(b)):
            both = [jaccard.prefix(s, np.sort(pool[:100])) for s in (a, b)]
            assert len(np.intersect1d(*both))


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))]
    links += [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2200)]
    ids = {i for link in links for i in link}
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = reach(ids, links)
    got = {r.node: r.component for r in found}
    assert len(got) == len(found) and all(want[i] == got.get(i, i) for i in ids)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_links(vectors, least):
    """{id: (links, component, kept)}"""
    used = {i: v for i, v in vectors if v is not None and None not in v
            and np.isfinite(v).all() and np.any(v)}
    ids, x = list(used), np.array(list(used.values()), dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    best = reach([i for i, _ in vectors], [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)])
    counts = dict(zip(ids, near.sum(1) - 1, strict=True))
    return {i: (int(counts.get(i, 0)), best[i], best[i] == i) for i, _ in vectors}


def test_e8_points_are_nearest():
    y = np.random.default_rng(0).normal(size=(200, 8)) * 2
    points = lattice.e8_points(y) / 2
    whole = np.array([p for p in np.ndindex(*[2] * 8)])
    for row, found in zip(y, points, strict=True):
        d8 = [c for c in np.floor(row) + whole if c.sum() % 2 == 0]
        half = [c for c in np.floor(row - 0.5) + 0.5 + whole if c.sum() % 2 == 0]
        least = min(((row - c) ** 2).sum() for c in d8 + half)
        assert ((row - found[0]) ** 2).sum() <= least + 1e-9


def test_lattice_recall_at_the_bar():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(5000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * z
    tables = lattice.LatticeHash()
    a, b = tables.cells(x), tables.cells(y)
    met = (a[:, :, :, None] == b[:, :, None, :]).any((1, 2, 3))
    apart = np.bitwise_count(lattice.sketches(x, 5) ^ lattice.sketches(y, 5)).sum(1)
    assert (met & (apart <= lattice.MOST_APART)).mean() > 0.999


def test_tables_follow_the_rows():
    """At every size pairs at the bar are found, and a row meets few others by chance."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(8000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=(1500, 48))
    z -= (z * x[:1500]).sum(1, keepdims=True) * x[:1500]
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.95 * x[:1500] + np.sqrt(1 - 0.95**2) * z
    apart = np.bitwise_count(lattice.sketches(x[:1500], 5) ^ lattice.sketches(y, 5)).sum(1)
    blocks = []
    for rows in (500, 1000, 2000, 4000, 8000):
        tables = lattice.LatticeHash.for_rows(rows, 0.95)
        blocks.append(tables.blocks)
        a, b = tables.cells(x[:1500]), tables.cells(y)
        met = np.array([np.intersect1d(p, q).size > 0 for p, q in zip(a, b, strict=True)])
        assert (met & (apart <= lattice.MOST_APART)).mean() > 0.998
        cells = tables.cells(x[:rows])
        _, n = np.unique(cells.ravel(), return_counts=True)
        assert (n * (n - 1)).sum() / rows < 1.5 * lattice.MET
    assert blocks == sorted(blocks) and blocks[-1] > blocks[0]
    assert lattice.LatticeHash.for_rows(10**9, 0.95).blocks >= 5


def test_small_tiles_at_once_equal_one_by_one():
    rng = np.random.default_rng(3)
    tile = np.sort(rng.integers(0, 40, 400))
    key, component = rng.permutation(400), rng.integers(0, 30, 400)
    block = np.where(tile % 3 == 0, rng.integers(0, 2, 400), 7)
    sketch = rng.integers(0, 256, (20, 16)).astype(np.uint8)[rng.integers(0, 20, 400)]
    sketch[:, 0] ^= rng.integers(0, 4, 400).astype(np.uint8)
    for partners in (None, 1, 3):
        at_once = lattice.close_in_small(tile, key, component, block, sketch, partners)
        single = [
            lattice.close_pairs(key[t], component[t], block[t], sketch[t], partners)
            for t in (tile == i for i in np.unique(tile))
        ]
        pairs = np.concatenate(single)
        assert len(pairs) and sorted(map(tuple, at_once)) == sorted(map(tuple, pairs))


def test_near_duplicates(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(8, 16))
    vectors = [
        (i, (centres[i % 8] + rng.normal(size=16) * 0.22).astype("f4").tolist())
        for i in range(3, 150)
    ]
    vectors += [(200, vectors[0][1]), (201, (np.array(vectors[0][1]) * 8).tolist())]
    odd = [(0, None), (1, [0.0] * 16), (2, [float("nan")] + [1.0] * 15), (300, [None] * 16)]
    rows = [(i, v, 1, 2, 3) for i, v in vectors + odd]
    df = spark.createDataFrame(rows, VECTORS)
    want = plain_links(vectors + odd, 0.95)
    assert max(n for n, _, _ in want.values()) > 3
    got = lambda: {r.vec_id: tuple(r)[1:] for r in lattice.near_duplicates(df).collect()}
    assert got() == want
    monkeypatch.setattr(lattice, "BLOCK_ROWS", 4)
    monkeypatch.setattr(lattice, "FIRST_PARTNERS", 1)
    assert got() == want
    null = spark.createDataFrame([(None, [1.0], 1, 1, 1), (4, [1.0], 1, 1, 1)], VECTORS)
    assert sorted(map(tuple, lattice.near_duplicates(null).collect()), key=repr) == sorted(
        [(None, 0, None, False), (4, 0, 4, True)], key=repr
    )
    assert lattice.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


def test_nearest_recall_and_scores(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    found = ann.nearest(df).toPandas()
    rows = df.toPandas().sort_values("vec_id")
    ids, x = rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), dtype=np.float64)
    hits = total = 0
    for query, group in found.groupby("query_id"):
        group = group.sort_values("rank")
        dots = x @ x[ids == query][0]
        dots[ids == query] = -np.inf
        best = ids[np.lexsort((ids, -dots))[:20]]
        hits += len(set(best) & set(group.vec_id))
        total += 20
        assert group["rank"].tolist() == list(range(1, 21))
        assert np.allclose(dots[np.searchsorted(ids, group.vec_id)], group.score, atol=1e-14, rtol=0)
        order = np.lexsort((group.vec_id, -group.score))
        assert order.tolist() == list(range(20))
    assert found.query_id.nunique() == (ids % 20 == 0).sum()
    assert hits / total >= 0.9


def test_nearest_odd_tables(spark, monkeypatch):
    rows = [(i, [float(i % 3), 1.0, float(i % 5)], 1, 1, 1) for i in range(30)]
    rows += [(20, rows[20][1], 1, 1, 1), (40, None, 1, 1, 1), (60, [0.0] * 3, 1, 1, 1)]
    rows += [(80, [float("nan"), 1.0, 1.0], 1, 1, 1), (None, [1.0, 1.0, 1.0], 1, 1, 1)]
    df = spark.createDataFrame(rows, VECTORS)
    for block in (4096, 3):
        monkeypatch.setattr(ann, "BLOCK_ROWS", block)
        found = ann.nearest(df, k=40, probes=64).collect()
        assert {r.query_id for r in found} == {0, 20}
        for query in (0, 20):
            mine = sorted((r for r in found if r.query_id == query), key=lambda r: r.rank)
            want = [(float(np.dot(rows[i][1], rows[query][1])), i) for i in range(30) if i != query]
            want.sort(key=lambda w: (-w[0], w[1]))
            assert [(r.score, r.vec_id) for r in mine] == want
    assert ann.nearest(spark.createDataFrame([], VECTORS)).collect() == []


def test_nearest_ties_and_repeated_ids(spark):
    """Copies of one vector tie whatever tile they lie in; of an id's vectors the best counts."""
    rng = np.random.default_rng(6)
    one = [float(np.float32(v)) for v in rng.normal(size=37)]
    other = [-v for v in one]
    rows = [(i, one, 1, 1, 1) for i in range(1, 300)] + [(40, other, 1, 1, 1), (300, other, 1, 1, 1)]
    rows += [(301, other, 1, 1, 1), (301, [2 * v for v in one], 1, 1, 1)]
    found = ann.nearest(spark.createDataFrame(rows, VECTORS).repartition(5), k=8, probes=64)
    score = float((np.array(one) * np.array(one)).sum())
    for query, group in found.toPandas().sort_values("rank").groupby("query_id"):
        if query == 300:
            assert group.vec_id.tolist()[0] == 40 and group.score.tolist()[:2] == [score] * 2
            continue
        near = [301, *[i for i in range(1, 20) if i != query][:7]]
        assert group.vec_id.tolist() == near and set(group.score.tolist()[1:]) == {score}
