"""The shape of plans: what must hold whatever the size of the data."""

import re
import time
from contextlib import redirect_stdout
from io import StringIO

import pytest
from pyspark.sql import functions as F

from lotbook.operators import (
    asof_version,
    exact_version,
    latest_per_key,
    lookups,
    versioned_dimension,
)
from lotbook.plans import facts, marts, rebuild
from lotbook.plans.entities import COMPONENTS, GOLD_SCHEMAS
from lotbook.plans.rebuild import LazyGold
from lotbook.quality import checks, metrics, suite
from lotbook.session import shuffles_dropped
from lotbook.sources import Warehouse
from workload.registry import QUERIES, REFERENCES, Misled, Silver

SMALLEST = "/root/testdata/sf0.001"


def plan_of(df):
    text = StringIO()
    with redirect_stdout(text):
        df.explain()
    return text.getvalue()


def operators(df):
    """Operator names from the root down, one per line of the plan."""
    return re.findall(r"^[\s:+\-|]*(?:\*\(\d+\) )?([A-Z]\w+)", plan_of(df), re.M)


@pytest.fixture
def versions(spark, tmp_path):
    df = spark.range(1000).selectExpr(
        "id % 10 as k", "id % 7 as batch_number", "cast(id as string) as a",
        "timestamp '2024-01-01' as _ingested_at_utc", "id as unused",
    )
    df.write.parquet(f"{tmp_path}/t")
    return spark.read.parquet(f"{tmp_path}/t")


def test_hot_keys_are_cut_down_before_the_shuffle(versions):
    plan = operators(latest_per_key(versions, ["k", "batch_number"], "_ingested_at_utc", ["a"]))
    last_exchange = len(plan) - 1 - plan[::-1].index("Exchange")
    assert "WindowGroupLimit" in plan[:last_exchange]
    assert "WindowGroupLimit" in plan[last_exchange:]


def test_versioned_dimension_shuffles_twice_and_reads_needed_columns(versions):
    df = versioned_dimension(versions, "sk", "k", ["a"], span=7)
    assert operators(df).count("Exchange") == 2
    assert "unused" not in plan_of(df)


def test_sliced_versions_never_window_a_whole_key(versions):
    plan = plan_of(versioned_dimension(versions, "sk", "k", ["a"]))
    windows = re.findall(r"Window \[lead\(batch_number.*", plan)
    assert windows and all("_slice" in window for window in windows)


def test_hot_key_in_a_merge_join_is_split(spark):
    """A third of the rows share one key; the dimension is too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        dim = spark.range(2000).selectExpr("id as k", "1L as batch_number", "md5(string(id)) as sk")
        facts = spark.range(0, 300_000, 1, 8).selectExpr(
            "if(id % 3 = 0, 1L, id % 2000) as k", "1L as batch_number", "md5(string(id)) as v"
        )
        joined = exact_version(facts, dim, "k", {"sk": "sk"})
        count = joined.groupBy().agg(F.count("sk").alias("n"), F.count("v").alias("m"))
        assert tuple(count.collect()[0]) == (300_000, 300_000)
        assert "skew=true" in plan_of(count)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_uncounted_rows_are_not_broadcast(spark):
    gold = LazyGold(Silver(spark, SMALLEST), 9)
    assert "BuildLeft" not in plan_of(gold["fact_recipe_components"])


def test_uncounted_dimensions_are_not_broadcast(spark, written):
    """However small Catalyst takes them for."""
    rows = spark.range(9).selectExpr("id as k", "id as batch_number")
    dim = rows.selectExpr("*", "md5(string(k)) as sk")
    assert "BroadcastHashJoin" not in plan_of(exact_version(rows, dim, "k", {"sk": "sk"}))
    assert "BroadcastHashJoin" not in plan_of(marts.top_flavours(written))
    named = operators(marts.recipe_constituents(written, "R1", 3))
    assert named.count("BroadcastHashJoin") <= 1  # the one recipe
    assert named.count("SortMergeJoin") >= 3


def test_lookups_of_keys_make_no_attributes(spark):
    gold = LazyGold(Silver(spark, SMALLEST), 9)
    plan = plan_of(gold["fact_recipe_components"])
    assert "row_number" not in plan and "p_type" not in plan
    # Keys are written out above the last exchange.
    assert "md5" not in plan[plan.index("Exchange hashpartitioning(component_id") :]


@pytest.fixture
def recipes_of_few_flavours(spark):
    """Recipes that name 3 flavours and 5 ingredients over and over, and ever new raw materials.
    Ids and batches may be missing; versions repeat, begin late or lack a batch."""
    ratios = [f"cast(id % 4 as double) / 4 as {kind}_ratio" for kind in COMPONENTS]
    recipes = spark.range(0, 900, 1, 4).selectExpr(
        "if(id % 50 = 0, null, 'R' || id div 2) as recipe_id",
        "if(id % 31 = 0, null, id % 5) as batch_number", "date '2024-01-01' as generation_date",
        "id as raw_material_id", "if(id % 7 = 0, null, id % 3) as flavour_id",
        "id % 5 as ingredient_id", *ratios,
    )

    def entity(key, rows):
        return spark.range(rows).selectExpr(
            f"if(id % 11 = 10, null, id div 3) as {key}", "if(id % 6 = 5, null, id % 4) as batch_number"
        )

    tables = {"raw_materials": entity("raw_material_id", 2700), "flavours": entity("flavour_id", 300),
              "ingredients": entity("ingredient_id", 300), "recipes": recipes}
    return {name: df.unionByName(df) for name, df in tables.items()}


def test_slots_that_name_few_ids_stay_in_place(spark, rows, monkeypatch, recipes_of_few_flavours):
    silver = recipes_of_few_flavours
    spans = {kind: 5 for kind in COMPONENTS}
    monkeypatch.setattr(facts, "FEW_ASKED", 100)
    few = facts.few_asked(silver["recipes"], spans)
    assert few == {"flavour": 15, "ingredient": 25}
    found = LazyGold(silver, lambda entity: 5)["fact_recipe_components"]
    moved = LazyGold(silver, 5)["fact_recipe_components"]  # counts nothing, so all slots move
    assert found.columns == moved.columns
    assert rows(found) == rows(moved) and found.count() > 3000
    kinds = {r[0] for r in found.select("component_type").distinct().collect()}
    assert kinds == set(COMPONENTS)
    found = LazyGold(silver, lambda entity: 5)["fact_recipe_components"]  # not yet run
    plan = plan_of(found)
    # The slots of raw materials, and no others, go to their versions.
    assert plan.count("Exchange hashpartitioning(component_id") == 1
    assert plan.count("SortMergeJoin") == 1 and "LeftSemi, BuildRight" in plan
    stacks = re.findall(r"Generate stack\((\d)", plan)
    assert sorted(stacks) == ["1", "2"]


@pytest.mark.parametrize("few", [2, 100])
def test_components_are_counted_before_their_keys_are_written(
    spark, monkeypatch, recipes_of_few_flavours, few
):
    """Recipes repeat, so a component's rows are more than its recipes."""
    monkeypatch.setattr(facts, "FEW_ASKED", few)
    silver = dict(recipes_of_few_flavours)
    for entity, kind in (("raw_materials", "raw_material"), ("flavours", "flavour"), ("ingredients", "ingredient")):
        silver[entity] = silver[entity].selectExpr(
            "*", f"'{kind} ' || {kind}_id % 7 as {kind}_name", "'x' as flavour_description",
            "'y' as chemical_formula", "1 as provider_id", "1.0D as weight_in_grams",
            "1.0D as cost_per_gram", "date '2024-01-01' as generation_date",
            "timestamp '2024-01-01' as _ingested_at_utc",
        ).drop(*(["flavour_name"] if kind != "flavour" else []))
    gold = LazyGold(silver, lambda entity: 5)
    tables = {table: gold[table] for table in ("fact_recipe_components", *COMPONENTS.values())}
    ours = marts.component_importance(gold, 5000)
    plan = plan_of(ours)
    assert "recipe_sk" not in plan and "component_sk" in plan
    # Only slots that stayed in place move for the count, by an id and a version.
    counted = re.findall(r"Exchange hashpartitioning\([^)]*recipe_id[^)]*\)", plan)
    assert len(counted) == (few == 100)
    found = ours.collect()
    assert found == marts.component_importance(tables, 5000).collect()
    assert {r.component_type for r in found} == set(COMPONENTS)
    rows = gold["fact_recipe_components"].count()
    assert rows > sum(r.recipes_using_component for r in found) > 1000


def test_kinds_of_slots_travel_as_numbers(spark):
    plan = plan_of(LazyGold(Silver(spark, SMALLEST), 9)["fact_recipe_components"])
    below = plan[plan.index("Exchange hashpartitioning(component_id") :]
    assert re.search(r"Exchange hashpartitioning\(component_id#\d+L, _kind#\d+", plan)
    assert "raw_material," not in below.replace("raw_material_", "")


def test_null_tests_of_plans_make_no_attributes(spark, rows):
    """Only the tested columns of unwritten dimensions are made, and all of their rows."""
    silver = dict(Silver(spark, SMALLEST))
    extra = silver["ingredients"].limit(9).selectExpr(
        "* except (batch_number, ingredient_id)", "cast(null as bigint) as batch_number",
        "if(provider_id % 2 = 0, null, ingredient_id) as ingredient_id",
    )
    silver["ingredients"] = silver["ingredients"].unionByName(extra).unionByName(extra)
    gold = LazyGold(silver, 9)
    report = suite.null_report("gold", gold)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert windows and not any("ingredient_name" in line for line in windows)
    assert any("yield_pct" in line for line in windows)  # tested, so it is made
    whole = suite.null_report("gold", {table: gold[table] for table in gold if table in suite.NOT_NULL["gold"]})
    assert rows(report) == rows(whole)
    for dim in ("dim_ingredient", "dim_customer"):
        names = suite.NOT_NULL["gold"][dim]
        assert rows(gold.columns(dim, names)) == rows(gold[dim].select(*names))


def test_rules_travel_as_numbers(written):
    plan = plan_of(checks.key_groups(written, suite.KEY_RULES))
    assert re.search(r"Exchange hashpartitioning\(rule#\d+, value#", plan)


def test_key_rules_of_plans_make_no_attributes(spark, rows):
    """Only the columns of the rules are made of unwritten dimensions."""
    gold = LazyGold(Silver(spark, SMALLEST), 9)
    references = [rule for rule in REFERENCES if not rule.table.startswith("s_")]
    unique = [rule for rule in suite.KEY_RULES if rule.kind == checks.UNIQUE]
    for tables, rules in ((gold, unique), (Misled(gold), references)):
        groups = checks.key_groups(tables, rules)
        plan = groups._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window" in line]
        assert not any("ingredient_name" in line or "yield_pct" in line for line in windows)
        whole = {table: tables[table] for table in suite.NOT_NULL["gold"]}
        assert rows(groups) == rows(checks.key_groups(whole, rules))


def test_stock_moves_without_its_own_key(spark):
    plan = plan_of(LazyGold(Silver(spark, SMALLEST), 9)["fact_provider_ingredient_stock"])
    moved = re.findall(r"Exchange hashpartitioning\(provider_id.*", plan)
    assert moved and "ingredient_sk" not in plan[plan.index(moved[0]) :]


def test_shuffle_files_go_with_their_query(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: disk.getAllFiles().size()
    before = shuffled()
    with shuffles_dropped(spark):
        df = spark.range(0, 1000, 1, 4).selectExpr("id % 7 as k").groupBy("k").count()
        df.write.format("noop").mode("overwrite").save()
    deadline = time.time() + 20
    while shuffled() > before and time.time() < deadline:
        time.sleep(0.2)
    assert shuffled() <= before


@pytest.fixture
def written(spark, tmp_path):
    """Empty gold tables in files, the component fact partitioned by batch."""
    for table, schema in GOLD_SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}")
    return {t: spark.read.schema(s).parquet(f"{tmp_path}/{t}") for t, s in GOLD_SCHEMAS.items()}


def test_one_recipe_is_filtered_in_the_scan(written):
    plan = plan_of(marts.recipe_constituents(written, "R1", 3))
    scan = next(s for s in re.findall(r"FileScan.*", plan) if "component_ratio" in s)
    pushed = re.search(r"PushedFilters: \[(.*?)\]", scan).group(1)
    assert "EqualTo(batch_number,3)" in pushed
    assert re.search(r"EqualTo\(recipe_sk,[0-9a-f]{32}\)", pushed)


def exchanges(df):
    return operators(df).count("Exchange")


def test_asof_carry_shuffles_rows_and_versions_once(versions):
    """The dimension's own exchange, the ranges, and one row per range for their ends."""
    dim = versioned_dimension(versions, "sk", "k", ["a"])
    take = {"sk": "version_sk"}
    marks = lookups.asof_marks(versions.select("k", "batch_number", "unused"), dim, ["k"], take)
    found = asof_version(versions.select("k", "batch_number", "unused"), dim, ["k"], take)
    assert exchanges(marks) == 2 and exchanges(found) == 1
    assert plan_of(marks).count("FileScan") == 2
    assert "hashpartitioning" not in plan_of(found)


def test_key_rules_read_each_table_once(written):
    groups = checks.key_groups(written, suite.KEY_RULES)
    assert exchanges(groups) == 1
    tested = {rule.table for rule in suite.KEY_RULES}
    assert plan_of(groups).count("FileScan") == len(tested)


def test_null_tests_read_each_table_once(written):
    plan = plan_of(suite.null_report("gold", written))
    assert plan.count("FileScan") == len(suite.NOT_NULL["gold"])


@pytest.mark.parametrize("mart", [False, True])
def test_ratio_sums_are_put_together_once(written, spark, mart):
    """Tested as text of their parts they made code that the JVM does not compile."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        if mart:
            found = marts.recipes_with_odd_ratio_sum(written)
        else:
            found = checks.recipe_ratio_sums_not_one(written["fact_recipe_components"])
        stages = found._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(sizes) < 8000


def test_odd_ratio_sums(spark, rows):
    parts = spark.createDataFrame(
        [("a", 1, "flavour", 0.5), ("a", 1, "ingredient", 0.5), ("b", 2, "flavour", 0.25),
         ("c", 3, "flavour", None), ("d", None, "flavour", 1.5), (None, 4, "flavour", -1.0)],
        "recipe_sk string, batch_number bigint, component_type string, component_ratio double",
    )
    assert rows(checks.recipe_ratio_sums_not_one(parts)) == [
        ("b", 2, 0.25), ("d", None, 1.5), (None, 4, -1.0),
    ]


def test_recipes_are_profiled_in_one_exchange(written, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(metrics.recipe_profile(written["fact_recipe_components"])) == 1
        assert exchanges(marts.recipes_without_three_components(written)) == 2
        assert exchanges(marts.recipes_with_odd_ratio_sum(written)) == 2
        assert exchanges(marts.recipes_using(written, 3, "flavour", 7)) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookups_by_surrogate_key_leave_dimensions_in_place(spark, tmp_path):
    """With broadcasts off, only parts of the fact move: to the recipe, to the names, to order."""
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse", buckets=4)
    for table, schema in GOLD_SCHEMAS.items():
        empty = spark.createDataFrame([], schema)
        if table in rebuild.VERSIONED:
            warehouse.replace_bucketed("gold", table, empty, f"{table.removeprefix('dim_')}_sk")
        else:
            warehouse.replace("gold", table, empty)
    gold = rebuild.read_gold(warehouse)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(marts.recipe_constituents(gold, "R1", 3)) == 3
        assert exchanges(marts.recipes_using(gold, 3, "flavour", 7)) == 2
        for mart, asked in (
            (marts.recipe_constituents, ("R1", 3)),
            (marts.recipes_using, (3, "flavour", 7)),
        ):
            plan = plan_of(mart(gold, *asked))
            dimensions = re.findall(r"FileScan parquet spark_catalog\S+dim_.*", plan)
            assert dimensions and all("Bucketed: true" in scan for scan in dimensions)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("mart", [marts.top_customers, marts.top_flavours, marts.top_countries])
def test_sums_are_taken_before_the_join(written, mart):
    plan = operators(mart(written))
    join = next(i for i, name in enumerate(plan) if "Join" in name)
    assert plan[join:].count("HashAggregate") >= 2
    assert plan[0] == "AdaptiveSparkPlan" and "TakeOrderedAndProject" in plan


PLANNED = [
    name
    for name in QUERIES
    if name.startswith(("user_", "exact_", "asof_", "dim_", "fact_"))
    or name in ("mart_component_importance", "mart_country_coverage", "gold_data_quality_metrics")
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_joins_no_python_rows(spark, name):
    plan = plan_of(QUERIES[name].run(spark, SMALLEST))
    for refused in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert refused not in plan
