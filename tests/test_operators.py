import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lotbook.functions import ExactSum
from lotbook.operators import (
    asof_version,
    exact_version,
    latest_per_key,
    slots_to_rows,
    value_dimension,
    value_lookup,
    version_span,
    version_spans,
    versioned_dimension,
    with_next_version,
)

EARLY, LATE = datetime(2024, 1, 1), datetime(2024, 1, 2)
SPANS = [10, 2_000_000, None]  # one window, balanced slices, default slices
VERSIONS = "k string, batch_number bigint, a string, _ingested_at_utc timestamp"


def dimension(spark, versions, span=10):
    df = spark.createDataFrame([(k, b, f"{k}{b}", EARLY) for k, b in versions], VERSIONS)
    return versioned_dimension(df, "sk", "k", ["a"], span=span)


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame(
        [("x", 1, "old", EARLY), ("x", 1, "new", LATE), ("y", 1, "a", LATE), ("y", 1, "b", LATE),
         ("z", 1, "only", None)],
        VERSIONS,
    )
    kept = latest_per_key(df, ["k", "batch_number"], "_ingested_at_utc", ["a"])
    assert rows(kept.select("k", "a")) == [("x", "new"), ("y", "b"), ("z", "only")]


@pytest.mark.parametrize("span", SPANS)
def test_versioned_dimension(spark, rows, span):
    df = dimension(spark, [("A", 1), ("A", 2), ("A", 5), ("B", 3), ("C", 1), ("C", None)], span)
    tail = df.select("k", "valid_from_batch", "valid_to_batch", "is_current")
    assert rows(tail) == sorted(
        [("A", 1, 1, False), ("A", 2, 4, False), ("A", 5, None, True), ("B", 3, None, True),
         ("C", 1, None, True), ("C", None, None, True)],
        key=repr,
    )


@pytest.mark.parametrize("span", [2_000_000, None])
def test_next_version_across_slices(spark, rows, span):
    """Sparse, negative and clustered versions, one key with most of the rows, a null key."""
    hot = [("hot", v * v * 7 - 500_000) for v in range(3000)]
    few = [("few", v) for v in (-200_000, -1, 0, 1, 65_535, 65_536, 65_537, 10_000_000)]
    odd = [(None, 3), (None, 400_000), ("hot", None)]
    df = spark.createDataFrame(hot + few + odd, "k string, v bigint").repartition(5)
    plain = with_next_version(df, "k", "v", "n", span=10)
    assert rows(with_next_version(df, "k", "v", "n", span)) == rows(plain)


def test_version_span(spark):
    df = spark.createDataFrame([(1,), (20261231,), (None,), (1,)], "v bigint")
    assert version_span(df, "v") == 3
    assert version_spans({"a": df, "b": df.limit(0)}, "v") == {"a": 3, "b": 0}
    assert version_span(df.filter("v > 30000000"), "v") == 0


def test_exact_version(spark, rows):
    dim = dimension(spark, [("A", 1), ("A", 3)])
    df = spark.createDataFrame([("A", 1), ("A", 2), (None, 1), ("B", 3)], "k string, batch_number bigint")
    found = exact_version(df, dim, "k", {"a": "a"})
    expected = sorted([("A", 1, "A1"), ("A", 2, None), (None, 1, None), ("B", 3, None)], key=repr)
    assert rows(found) == expected
    inner = exact_version(df, dim, "k", {"a": "a"}, how="inner")
    assert rows(inner) == [("A", 1, "A1")]


def test_exact_version_salted(spark, rows):
    dim = dimension(spark, [("A", 1), ("B", 1)])
    facts = [(i, "A" if i % 3 else None, 1) for i in range(300)] + [(300, "B", 1)]
    df = spark.createDataFrame(facts, "i bigint, k string, batch_number bigint")
    plain = exact_version(df, dim, "k", {"sk": "sk"})
    salted = exact_version(df, dim, "k", {"sk": "sk"}, spread=7, spread_by=["i"])
    assert rows(salted) == rows(plain)


@pytest.mark.parametrize("span", SPANS)
def test_asof_version(spark, rows, span):
    dim = dimension(spark, [("A", 1), ("A", 4), ("C", 2), ("C", None)])
    asked = [("A", b) for b in (0, 1, 3, 4, 9, 9, None)] + [("B", 1), (None, 1), ("C", 8)]
    df = spark.createDataFrame(asked, "k string, batch_number bigint")
    found = asof_version(df, dim, ["k"], {"a": "a"}, span=span).select("k", "batch_number", "a")
    assert rows(found) == [
        ("A", 1, "A1"), ("A", 3, "A1"), ("A", 4, "A4"), ("A", 9, "A4"), ("A", 9, "A4"),
        ("C", 8, "C2"),
    ]


@pytest.mark.parametrize("span", [2_000_000, None])
def test_asof_version_across_slices(spark, rows, span):
    versions = [("hot", v * v * 11 - 300_000) for v in range(500)] + [("few", 5), ("few", 900_000)]
    dim = dimension(spark, versions, None).cache()
    asked = [("hot", v * 977 - 400_000) for v in range(3000)] + [
        ("few", v) for v in (4, 5, 6, 70_000, 899_999, 900_000, 5_000_000)
    ]
    df = spark.createDataFrame(asked, "k string, batch_number bigint").repartition(4)
    few = asof_version(df, dim, ["k"], {"a": "a"}, span=10)
    cut = asof_version(df, dim, ["k"], {"a": "a"}, span=span)
    order = ["k", "batch_number", "a"]
    assert rows(cut.select(*order)) == rows(few.select(*order))
    dim.unpersist()


def test_asof_carry_over_many_ranges(spark, rows):
    """A hot key and a hot version over several ranges, two key columns, keys without versions,
    rows that repeat, nulls, other column types, and an empty side."""
    versions = [("a", 1, v, f"a{v}") for v in (2, 40, 41)] + [("a", 2, 7, None), ("z", 1, 1, "z")]
    dim = spark.createDataFrame(versions, "k string, m int, batch_number bigint, t string")
    asked = [(i, "a", 1, 40 if i % 3 else i % 90, [1.5, None]) for i in range(2000)]
    asked += [(1, "a", 2, 9, None)] * 5 + [(2, "b", 1, 9, []), (3, "z", 1, 0, []), (4, "z", 1, 9, [])]
    asked += [(5, None, 1, 9, []), (6, "a", None, 9, []), (7, "a", 1, None, [])]
    df = spark.createDataFrame(asked, "i int, k string, m int, batch_number bigint, x array<double>")
    found = asof_version(df.repartition(6), dim, ["k", "m"], {"t": "t", "m": "m2"})
    want = []
    for row in asked:
        past = [v for v in versions if v[:2] == row[1:3] and row[3] is not None and v[2] <= row[3]]
        if past:
            newest = max(past, key=lambda v: v[2])
            want.append((*row, newest[3], newest[1]))
    assert rows(found) == sorted(want, key=repr)
    assert asof_version(df.limit(0), dim, ["k", "m"], {"t": "t"}).count() == 0
    assert asof_version(df, dim.limit(0), ["k", "m"], {"t": "t"}).count() == 0


def test_asof_carry_over_many_batches_of_a_task(spark, rows):
    """A task's later batches join the row carried on from the ones before."""
    dim = dimension(spark, [(k, v) for k in "ab" for v in range(0, 300, 3)], None)
    asked = [(k, v) for k in "ab" for v in range(300)]
    df = spark.createDataFrame(asked, "k string, batch_number bigint")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = asof_version(df, dim, ["k"], {"a": "a"})
        assert rows(found) == sorted(((k, v, f"{k}{v - v % 3}") for k, v in asked), key=repr)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("partitions", [1, 5])
def test_exact_sum(spark, partitions):
    rng = random.Random(4)
    groups = {
        "money": [round(rng.uniform(-1e6, 1e6), 2) for _ in range(3000)],
        "tenths": [0.1] * 999,
        "cancel": [1e17, 1.0, -1e17, 2**-60, -1.0, 3.0],
        "large": [9e18, 9e18, -1.5, 2.0**62, 0.25],
        "small": [rng.uniform(-1, 1) * 2.0 ** -rng.randrange(40) for _ in range(500)],
        "negative": [-0.1, -0.2, -0.3],
        "ties": [2.0**53, 1.0, 2.0**-40],
        "none": [None],
        "infinite": [1.0, math.inf],
        "huge": [1e300, 1e300],
    }
    data = [(k, x) for k, values in groups.items() for x in values]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, x double").repartition(partitions)
    total = ExactSum(df, "x")
    # Twice: over rows, then over sums of parts.
    first = df.groupBy("k", F.spark_partition_id().alias("p")).agg(*total.parts())
    found = first.groupBy("k").agg(*total.merged()).select("k", total.value().alias("s"))
    want = {k: math.fsum(v) if v != [None] else None for k, v in groups.items()}
    assert {r.k: r.s for r in found.collect()} == want
    whole = ExactSum(df.withColumn("n", F.lit(2)), "n")
    assert df.withColumn("n", F.lit(2)).agg(*whole.parts()).select(whole.value()).first()[0] == 2 * len(data)


def test_value_dimension_and_lookup(spark, rows):
    left = spark.createDataFrame([(" Peru ",), ("PERU",), ("",), (None,)], "c string")
    right = spark.createDataFrame([("chile",), ("  ",)], "d string")
    dim = value_dimension([(left, "c"), (right, "d")], "sk", "name")
    assert rows(dim.select("name")) == [("CHILE",), ("PERU",)]
    found = value_lookup(left, dim, F.upper(F.trim("c")), "name", "sk", "key")
    assert found.count() == 4
    assert found.filter("key is null").count() == 2


def test_slots_to_rows(spark, rows):
    df = spark.createDataFrame(
        [("r", 1, 0.5, 2, 0.5), ("s", None, 0.1, 3, 0.9)],
        "id string, x_id bigint, x_r double, y_id bigint, y_r double",
    )
    slots = {"x": ("x_id", "x_r"), "y": ("y_id", "y_r")}
    out = slots_to_rows(df, ["id"], slots, "kind", ["part", "ratio"])
    assert rows(out) == [("r", "x", 1, 0.5), ("r", "y", 2, 0.5), ("s", "y", 3, 0.9)]


def test_versions_tile_and_are_current_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("user_id").alias("k"),
        F.dayofmonth("ts").cast("bigint").alias("batch_number"),
        F.col("event_type").alias("a"),
        F.col("ts").cast("timestamp").alias("_ingested_at_utc"),
    )
    dim = versioned_dimension(df, "sk", "k", ["a"], span=32)
    assert dim.count() == df.select("k", "batch_number").distinct().count()
    assert dim.select("sk").distinct().count() == dim.count()
    assert dim.groupBy("k").agg(F.count_if("is_current").alias("n")).filter("n <> 1").isEmpty()
    follows = dim.alias("x").join(
        dim.alias("y"), (F.col("x.k") == F.col("y.k"))
        & (F.col("y.valid_from_batch") == F.col("x.valid_to_batch") + 1)
    )
    assert follows.count() == dim.filter("not is_current").count()


def test_input_order_changes_nothing(spark, rows):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("user_id").alias("k"),
        F.weekofyear("ts").cast("bigint").alias("batch_number"),
        F.col("event_type").alias("a"),
        F.lit(EARLY).alias("_ingested_at_utc"),  # all tie
    )
    one = versioned_dimension(df, "sk", "k", ["a"], span=60)
    other = versioned_dimension(df.orderBy(F.rand(3)).repartition(13), "sk", "k", ["a"])
    assert rows(one) == rows(other)
