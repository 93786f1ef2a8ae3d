from pyspark.sql import functions as F

from lotbook.quality import checks, metrics, suite

KEYS = "k string, batch_number bigint"


def test_repeated_key_metric(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), (None, 1)], KEYS)
    out = metrics.key_and_row_metrics(df, ("m", ["k", "batch_number"]))
    assert rows(out) == [("m", 2, 3, 66.666667)]


def test_key_and_row_metrics_share_a_pass(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", -1), ("c", None)], KEYS)
    out = metrics.key_and_row_metrics(
        df, ("keys", ["k"]), {"bad": F.col("batch_number") < 0, "none": F.col("k") == "z"}
    )
    assert rows(out) == [("bad", 1, 4, 25.0), ("keys", 1, 3, 33.333333), ("none", 0, 4, 0.0)]


def test_metrics_of_an_empty_table(spark, rows):
    df = spark.createDataFrame([], KEYS)
    out = metrics.key_and_row_metrics(df, ("keys", ["k"]), {"bad": F.col("batch_number") < 0})
    assert rows(out) == [("bad", 0, 0, None), ("keys", 0, 0, None)]
    alone = metrics.key_and_row_metrics(df, bad_rows={"bad": F.col("batch_number") < 0})
    assert rows(alone) == [("bad", 0, 0, None)]


def test_ratio_sums(spark, rows):
    parts = [("a", 0.5, 0.25, 0.249), ("b", 0.5, 0.25, 0.251), ("c", 0.5, 0.25, 0.2485),
             ("d", 0.5, 0.25, 0.2515), ("e", None, 0.25, 0.25)]
    df = spark.createDataFrame(
        [(i, 1, *p) for i, *p in parts],
        "recipe_id string, batch_number bigint, raw_material_ratio double, "
        "flavour_ratio double, ingredient_ratio double",
    )
    assert [r[0] for r in rows(checks.ratio_sums_not_one(df))] == ["c", "d"]
    assert checks.ratios_outside_bounds(df).count() == 0


def test_orphans_and_accepted_values(spark, rows):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,)], "p bigint")
    assert rows(checks.orphan_keys(child, "k", parent, "p")) == [(2, 2)]
    words = spark.createDataFrame([("flavour",), ("spice",), (None,)], "w string")
    assert rows(checks.unexpected_values(words, "w", ["flavour"])) == [("spice", 1)]


def test_nulls_and_repeated_values(spark, rows):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, "y")], "a bigint, b string")
    assert rows(checks.null_counts(df, ["a", "b"])) == [("a", 1), ("b", 1)]
    assert rows(checks.repeated_values(df, "a")) == [(1, 2)]


def test_table_checks(spark, rows):
    full = spark.createDataFrame([(1,), (None,)], "batch_number bigint")
    tables = {"full": full, "empty": full.limit(0)}
    assert rows(checks.empty_tables(tables)) == [("empty", 0)]
    assert rows(checks.rows_without_version(tables)) == [("full", 1)]


def test_one_current(spark, rows):
    df = spark.createDataFrame(
        [("a", True), ("a", False), ("b", True), ("b", True), ("c", False)],
        "k string, is_current boolean",
    )
    assert rows(checks.keys_not_current_once(df, "k")) == [("b",), ("c",)]


def test_blank_batches_are_absent(spark):
    df = spark.createDataFrame([(" ",), ("",), (None,), ("1",)], "batch_number string")
    typed = spark.createDataFrame([(1,), (None,)], "batch_number bigint")
    found = checks.rows_without_version({"raw": df, "typed": typed}).collect()
    assert sorted((r.table_name, r.bad_rows) for r in found) == [("raw", 3), ("typed", 1)]
    counts = lambda blanks: checks.null_counts(df, ["batch_number"], blanks).first()[1]
    assert (counts(False), counts(True)) == (1, 3)


def test_key_rules_share_one_exchange(spark, rows):
    """Unique, parent and current rules of three tables at once; nulls, a parent of two children,
    a table that refers to itself, equal values under different rules."""
    lots = spark.createDataFrame(
        [("a", "x", True), ("a", "q", False), ("b", None, False), (None, "x", True)],
        "sk string, box string, is_current boolean",
    )
    boxes = spark.createDataFrame([("x", 1), ("y", 2), ("y", None)], "sk string, n bigint")
    notes = spark.createDataFrame([("q", 1), ("y", 3), ("q", 9)], "box string, n bigint")
    rules = [
        checks.KeyRule(checks.UNIQUE, "lots", "sk"),
        checks.KeyRule(checks.UNIQUE, "boxes", "sk"),
        checks.KeyRule(checks.PARENT, "lots", "box", ("boxes", "sk")),
        checks.KeyRule(checks.PARENT, "notes", "box", ("boxes", "sk")),
        checks.KeyRule(checks.PARENT, "boxes", "n", ("notes", "n")),
        checks.KeyRule(checks.CURRENT, "lots", "sk"),
    ]
    tables = {"lots": lots, "boxes": boxes, "notes": notes}
    assert rows(checks.key_groups(tables, rules)) == [
        ("current", "lots.sk", "b", 0),
        ("parent", "boxes.n", "2", 1),
        ("parent", "lots.box", "q", 1),
        ("parent", "notes.box", "q", 2),
        ("unique", "boxes.sk", "y", 2),
        ("unique", "lots.sk", "a", 2),
    ]
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert rows(checks.key_groups(empty, rules)) == []
    report = suite.key_report(empty, suite.KEY_RULES[:0] + rules)
    assert {r.violations for r in report.collect()} == {0} and report.count() == len(rules)


def test_hashed_keys_travel_as_bytes(spark, rows):
    """Text that is no such key stays apart from it, however alike, and comes back as it was."""
    key = "61" * 15 + "62"
    alike = ["a" * 15 + "b", key.upper().replace("6", "A"), key + "\n", " " + key, key[:-1], key + "0",
             "", "\u0663" * 32, "g" * 32]
    df = spark.createDataFrame([(v,) for v in [key, *alike] for _ in range(2)] + [(None,)], "sk string")
    once = spark.createDataFrame([(key,)], "sk string")
    assert rows(checks.repeated_values(df, "sk")) == sorted(((v, 2) for v in [key, *alike]), key=repr)
    assert rows(checks.orphan_keys(df, "sk", once, "sk")) == sorted(((v, 2) for v in alike), key=repr)
    groups = checks.key_groups({"t": df}, [checks.KeyRule(checks.UNIQUE, "t", "sk")])
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "unhex" in plan[plan.index("Exchange hashpartitioning(rule") :]


def test_recipe_profile_counts_labels_it_does_not_know(spark, rows):
    parts = [("r", k, 0.1) for k in ("flavour", "flavour", "ingredient", "raw_material")]
    parts += [("s", "spice", 0.5), ("s", "spice", 0.25), ("s", "flavour", None)]
    parts += [("t", "spice", 0.5), ("t", "salt", 0.5), ("t", None, None), ("u", None, None)]
    df = spark.createDataFrame(
        [(k, 4, kind, x) for k, kind, x in parts],
        "recipe_sk string, batch_number bigint, component_type string, component_ratio double",
    )
    assert rows(metrics.recipe_profile(df)) == [
        ("r", 4, 4, 3, 0.4), ("s", 4, 3, 2, 0.75), ("t", 4, 3, 2, 1.0), ("u", 4, 1, 0, None),
    ]
