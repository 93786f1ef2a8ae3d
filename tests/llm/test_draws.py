"""Hard negatives, resampling and sharding against brute force and the oracle's SQL."""

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest

from lotbook.llm import hard_negatives, queries, resampling, sharding
from lotbook.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, rows, name):
    con = duckdb.connect()
    for view in ("embeddings", "documents", "benchmark"):
        con.sql(f"create view {view} as from '{SF_DIR}/{view}.parquet'")
    found = queries.QUERIES[name](spark, SF_DIR)
    expected = con.sql(f"select {', '.join(found.columns)} from ({queries.ORACLE_SQL[name]})")
    assert rows(found) == sorted(expected.fetchall(), key=repr)


# --- hard negatives ------------------------------------------------------------------------------

VECTORS = "vec_id long, label int, embedding array<double>, row int, dim int, tree int, at int"


def plain_negatives(vectors, every=3, k=5, percent=80):
    """``vectors``: distinct (id, label, components)."""
    used = {
        (i, label, tuple(math.floor(256 * x) for x in v))
        for i, label, v in vectors
        if None not in (i, label, v) and None not in v and all(map(math.isfinite, v))
    }
    used = {r for r in used if sum(x * x for x in r[2]) < 1 << 62}
    found = []
    for anchor in used:
        if anchor[0] % every:
            continue
        near = [
            (-sum(x * y for x, y in zip(anchor[2], r[2])), r[0], r[1])
            for r in used
            if r != anchor and len(r[2]) == len(anchor[2])
        ]
        near.sort()
        for score, positive, _ in [r for r in near if r[2] == anchor[1]][:k]:
            fit = [
                r for r in near
                if r[2] != anchor[1] and -percent * score <= -100 * r[0] <= -100 * score
            ]
            for rank, (other, negative, _) in enumerate(fit[:k], 1):
                found.append((anchor[0], positive, rank, negative, -score, -other))
    return sorted(found)


def found_negatives(spark, vectors, **options):
    wide = [(i, label, v, 1, 2, 3, 4) for i, label, v in vectors]
    found = hard_negatives.hard_negatives(spark.createDataFrame(wide, VECTORS), 3, **options)
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("spread", [0.1, 1.0, 30_000.0, 3e6])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, spread):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 6))
    vectors = [
        (i, int(rng.integers(3)), [float(x) for x in (centres[i % 4] + rng.normal(size=6) / 3) * spread])
        for i in range(120)
    ]
    vectors += [(200 + i, 1, vectors[i][2]) for i in range(6)]  # ties
    for name, size in (("TREE_ANCHORS", 7), ("TILE_TREES", 2), ("TILE_ROWS", 40)):
        monkeypatch.setattr(hard_negatives, name, size)
    want = plain_negatives(vectors)
    assert want and found_negatives(spark, vectors) == want


def test_hard_negatives_odd_rows(spark):
    inf, nan = math.inf, math.nan
    vectors = [(i, i % 2, [1.0 + i / 10, 2.0]) for i in range(12)]
    vectors += [vectors[3]] * 3  # a repeated row counts once
    vectors += [(3, 0, [1.5, 2.0]), (3, 1, [9.0, 1.0])]  # an id that repeats is other rows
    vectors += [(None, 0, [1.0, 2.0]), (21, None, [1.0, 2.0]), (22, 1, None)]
    vectors += [(23, 1, [None, 1.0]), (24, 1, [nan, 1.0]), (25, 0, [inf, 1.0]), (30, 0, [1e300, 1.0])]
    vectors += [(27, 0, []), (28, 0, []), (29, 1, [])]  # empty vectors score 0 with each other
    vectors += [(33, 0, [1.0]), (34, 0, [2.0]), (35, 1, [1.9])]  # another length
    want = plain_negatives(vectors)
    assert {27, 33} <= {r[0] for r in want}
    assert found_negatives(spark, vectors) == want
    assert found_negatives(spark, []) == []


def test_bounds_leave_scores_out():
    rng = np.random.default_rng(2)
    x = np.rint(rng.normal(size=(40, 16)) * 4 + 100 * rng.normal(size=16)).astype(np.int64)
    walk, parent, edge = hard_negatives.spanning_tree(x)
    assert sorted(walk) == list(range(40)) and parent[walk[0]] == walk[0]
    assert np.allclose(edge[1:], np.linalg.norm(x - x[parent], axis=1)[1:])
    cells = {"vec_id": range(500), "label": [0] * 500, "row": range(500)}
    v = np.rint(rng.normal(size=(500, 16)) * 100).astype(np.int64)
    part = hard_negatives.pa.table({**{k: list(c) for k, c in cells.items()}, "v": list(v)})
    candidates = hard_negatives.Candidates(part)
    tree = {
        "tree": 1, "anchors": np.arange(40), "labels": np.zeros(40, np.int64), "v": x.ravel(),
        "rows": np.arange(40) + 1000, "walk": walk, "parent": parent, "edge": edge,
    }
    for anchor in candidates.walk(tree):
        true = v @ x[anchor.at]
        assert (anchor.low <= true).all() and (true <= anchor.high).all()
        top = anchor.top(np.arange(500), -np.inf, np.inf, 5)
        assert list(top) == list(np.lexsort((np.arange(500), -true))[:5])
    assert candidates.scored < 0.5 * candidates.bounded


# --- resampling ----------------------------------------------------------------------------------

DOCS = "doc_id long, text string, n_words int, score int, weight int, rank int, _row int"


def plain_features(text, ngram):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    runs = [" ".join(found[i : i + n]) for n in range(1, ngram + 1) for i in range(len(found) - n + 1)]
    return len(found), [zlib.crc32(r.encode()) for r in runs]


def plain_resample(docs, target, ngram, buckets, least, percent):
    raw, wanted = Counter(), Counter()
    for _, text in docs:
        raw.update(c % buckets for c in plain_features(text, ngram)[1])
    for text in target:
        wanted.update(c % buckets for c in plain_features(text, ngram)[1])
    s, t = sum(raw.values()), sum(wanted.values())

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets))))

    found, able = [], []
    for i, text in docs:
        n, features = plain_features(text, ngram)
        weight = sum(gain(c % buckets) for c in features)
        score = None
        if i is not None:
            h = int(sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
            if n >= least:
                able.append((-score, i, len(found)))
        found.append([i, len(features), weight, score, None])
    able.sort()
    for rank, (_, _, at) in enumerate(able[: percent * len(able) // 100], 1):
        found[at][4] = rank
    return sorted(map(tuple, found), key=repr)


@pytest.mark.parametrize("ngram", [1, 2, 3, 4])
def test_resampling_equals_brute_force(spark, rows, ngram):
    rng = np.random.default_rng(ngram)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünder", "ÉCOLE", "it's", "a-b", "9", "\x00x\x7fy"]
    pick = lambda n: " ".join(rng.choice(vocabulary, n))
    docs = [(i, pick(int(rng.integers(0, 30)))) for i in range(300)]
    docs += [(None, pick(30)), (900, None), (901, ""), (902, " ,.\t"), (903, "word " * 40_000)]
    docs += [(904, pick(25))] * 3
    target = [pick(40) for _ in range(5)] + [None, ""]
    found = resampling.resample(
        spark.createDataFrame([(*d, 1, 2, 3, 4, 5) for d in docs], DOCS).repartition(5),
        spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int"),
        ngram, 97, 30, 15,
    )
    assert rows(found) == plain_resample(docs, target, ngram, 97, 15, 30)


def test_resampling_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert resampling.resample(none, none).collect() == []
    one = spark.createDataFrame([(1, "a b " * 20, 1, 1, 1, 1, 1)], DOCS)
    assert resampling.resample(one, none).count() == 1


# --- sharding ------------------------------------------------------------------------------------

SHARDED = "doc_id long, text string, shard int, size int, slot int, home int, _part int"


def plain_sharding(spark, docs, shards, points):
    """Row by row: own rows first, in the order of the ring, then those that were turned away."""
    at, owner = sharding.ring(shards, points)
    frame = spark.createDataFrame([(d,) for d, _ in docs], "k long").selectExpr("xxhash64(k) as h")
    hashes = [r.h for r in frame.collect()]
    crc = [zlib.crc32((t or "").encode()) for _, t in docs]
    size = [len((t or "").encode()) + 8 for _, t in docs]
    key = lambda i: (hashes[i], docs[i][0] is not None, docs[i][0] or 0, size[i], crc[i])
    ordered = sorted(range(len(docs)), key=key)
    free, shard = sharding.capacities(len(docs), shards), {}
    node = {i: int(np.searchsorted(at, hashes[i])) for i in ordered}
    for own_only in (True, False):
        for i in ordered:
            if i in shard:
                continue
            step = node[i]
            while not free[owner[step % len(owner)]] and not own_only:
                step += 1
            if free[owner[step % len(owner)]]:
                shard[i] = int(owner[step % len(owner)])
                free[shard[i]] -= 1
    slots = Counter()
    found = []
    for i in ordered:
        s = shard[i]
        found.append((docs[i][0], size[i], crc[i], s, slots[s], int(owner[node[i] % len(owner)])))
        slots[s] += 1
    return sorted(found, key=repr)


def test_sharding_equals_brute_force(spark, rows):
    rng = np.random.default_rng(8)
    docs = [(int(i), "é" * int(rng.integers(0, 50))) for i in rng.integers(0, 2000, 400)]
    docs += [(7, "hot")] * 300 + [(None, "x")] * 50 + [(5, None), (6, ""), (8, "long " * 50_000)]
    frame = spark.createDataFrame([(*d, 1, 2, 3, 4, 5) for d in docs], SHARDED)
    found = sharding.shard_documents(frame.repartition(6), 5, points=16)
    columns = ["doc_id", "size", "text_crc32", "shard", "slot", "home"]
    assert rows(found.select(*columns)) == plain_sharding(spark, docs, 5, 16)
    assert {(r.law, r.grown_shard) for r in found.collect()} == {("rows", None)}
    assert sharding.shard_documents(spark.createDataFrame([], SHARDED)).collect() == []


def test_sharding_balance_and_movement(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    one = {r.doc_id: r for r in sharding.shard_documents(docs).collect()}
    more = {r.doc_id: r for r in sharding.shard_documents(docs, 25).collect()}
    counts = Counter(r.shard for r in one.values())
    assert len(counts) == 24 and max(counts.values()) - min(counts.values()) <= 1
    assert sum(r.shard == r.home for r in one.values()) > 0.85 * len(one)
    assert sum(one[i].shard != more[i].shard for i in one) < 0.25 * len(one)
    largest = max(r.size for r in one.values())
    heavy = Counter()
    for r in sharding.shard_documents(docs, law="bytes").collect():
        heavy[r.shard] += r.size
    assert max(heavy.values()) - min(heavy.values()) <= 2 * largest
