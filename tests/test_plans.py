"""A small warehouse from files to answers."""

from datetime import date
from shutil import copytree

import pytest
from pyspark.sql import functions as F

from lotbook.plans import marts, rebuild
from lotbook.plans.conform import conform
from lotbook.plans.entities import ENTITIES, GOLD_SCHEMAS, bronze_schema, columns
from lotbook.quality import suite
from lotbook.sources import Warehouse, load_raw

FILES = {
    "customers": ["1, Ann ,Rome,Italy,08/05/2024,1", "1,Ann B,Rome, italy ,08/05/2024,2",
                  "2,Bob,,  ,05/13/2024,1"],
    "providers": ["7, Acme , Turin, Italy,5/5/24,1", "7, Acme 2, Turin, Italy,5/5/24,2"],
    "flavours": ["21,Mint,cool,7-May-24,1", "21,Mint,ice cool,7-May-24,4",
                 "22,Lime,sour,7-May-24,1"],
    "raw_materials": ["78,Water,5/5/24,1", "79,Sugar,5/5/24,3"],
    "ingredients": ["101,\"Salt, fine\",NaCl,10,0.5,7,7-May-24,1",
                    "102,Gum,,4,2,99,7-May-24,1", "103,Odd,X,-1,2,7,bad date,2"],
    "recipes": ["PHMV,78,0.5,21,0.25,101,0.25,boil,90,2024-05-08,1",
                "PHMV,78,0.5,21,0.25,101,0.35,boil,90,2024-05-08,5",
                "GAP,78,0.5,,,101,0.5,,101,2024-05-08,1",
                "SOON,79,0.5,21,0.25,101,0.25,fry,50,2024-05-08,2"],
    "sales_transactions": ["1,1,21,2,10.5,08/05/2024,ITALY,Rome,00100,08/05/2024,1",
                           "1,1,21,2,10.5,08/05/2024,ITALY,Rome,00100,08/05/2024,1",
                           "2,1,21,1,5,08/05/2024,Peru,Lima,1,08/05/2024,2",
                           "3,2,22,-1,3,08/05/2024, ,,,08/05/2024,1",
                           "4,9,22,1,1,08/05/2024,Peru,,,08/05/2024,1"],
}


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("small")
    for entity, lines in FILES.items():
        header = ",".join(field.raw for field in ENTITIES[entity])
        (root / f"{entity}.csv").write_text("\n".join([header, *lines]) + "\n")
    made = Warehouse(spark, f"{root}/warehouse")
    load_raw(spark, f"{root}/*.csv", made)
    rebuild.rebuild_silver(made)
    rebuild.rebuild_gold(made)
    return made


@pytest.fixture(scope="module")
def gold(warehouse):
    return rebuild.read_gold(warehouse)


def test_silver(warehouse, rows):
    silver = rebuild.read_silver(warehouse)
    customers = silver["customers"].select("customer_name", "location_city", "generation_date")
    assert rows(customers) == [
        ("Ann B", "Rome", date(2024, 5, 8)),
        ("Ann", "Rome", date(2024, 5, 8)),
        ("Bob", None, date(2024, 5, 13)),
    ]
    assert silver["ingredients"].filter("generation_date is null").count() == 1


def test_bad_number_fails_unless_lenient(spark):
    values = ["x"] + ["1"] * (len(ENTITIES["raw_materials"]) - 1) + ["f", None, "l"]
    raw = spark.createDataFrame([tuple(values)], bronze_schema("raw_materials"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(raw, "raw_materials").collect()
    assert conform(raw, "raw_materials", lenient=True).first()["raw_material_id"] is None


def test_bad_date_is_null_or_fails(spark):
    def typed(day, **options):
        raw = spark.createDataFrame(
            [("1", "Water", day, "1", "f", None, "l")], bronze_schema("raw_materials")
        )
        return conform(raw, "raw_materials", **options).first()["generation_date"]

    assert typed("soon") is None and typed("  ", strict_dates=True) is None
    assert typed(" 5/5/24 ", strict_dates=True) == date(2024, 5, 5)
    with pytest.raises(Exception, match="generation_date: no date form fits soon"):
        typed("soon", strict_dates=True)


def test_gold_columns(gold):
    for table in GOLD_SCHEMAS:
        assert gold[table].columns == columns(table)


def test_countries(gold, rows):
    assert rows(gold["dim_country"].select("country_name")) == [("ITALY",), ("PERU",)]
    names = gold["dim_customer"].join(gold["dim_country"], "country_sk", "left")
    assert rows(names.select("customer_id", "batch_number", "country_name")) == [
        (1, 1, "ITALY"), (1, 2, "ITALY"), (2, 1, None),
    ]


def test_sales_fact(gold, rows):
    sales = gold["fact_sales_transactions"]
    assert sales.count() == 5  # one row per input row, duplicates included
    found = sales.select("transaction_id", *(F.col(c).isNotNull() for c in (
        "customer_sk", "flavour_sk", "transaction_country_sk")))
    assert rows(found.distinct()) == [
        (1, True, True, True),
        (2, True, False, True),  # no version of the flavour in batch 2
        (3, True, True, False),
        (4, False, True, True),
    ]


def test_stock_fact(gold, rows):
    stock = gold["fact_provider_ingredient_stock"]
    values = stock.select("stock_value_dollars", F.col("provider_sk").isNull())
    assert rows(values) == [(-2.0, False), (5.0, False), (8.0, True)]
    assert stock.join(gold["dim_ingredient"], "ingredient_sk").count() == 3


def test_component_fact(gold, rows):
    parts = gold["fact_recipe_components"].join(
        gold["dim_recipe"].select("recipe_sk", "recipe_id"), "recipe_sk")
    counts = parts.groupBy("recipe_id", "batch_number").count()
    assert rows(counts) == [("GAP", 1, 2), ("PHMV", 1, 3), ("PHMV", 5, 3), ("SOON", 2, 2)]
    mint = parts.filter("component_type = 'flavour' and batch_number in (2, 5)").join(
        gold["dim_flavour"].select(F.col("flavour_sk").alias("component_sk"), "valid_from_batch"),
        "component_sk")
    assert rows(mint.select("batch_number", "valid_from_batch")) == [(2, 1), (5, 4)]


def test_rebuilt_slots_of_few_ids_stay_in_place(spark, warehouse, gold, rows, monkeypatch, tmp_path):
    """The same components where dimensions are too large to be broadcast whole."""
    before, asked = rows(gold["fact_recipe_components"]), []
    few_asked = rebuild.facts.few_asked
    monkeypatch.setattr(rebuild, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(
        rebuild.facts, "few_asked", lambda *args: asked.append(few_asked(*args)) or asked[-1]
    )
    other = Warehouse(spark, f"{tmp_path}/warehouse")
    copytree(warehouse.root, other.root)
    rebuild.rebuild_gold(other)
    assert [set(few) for few in asked] == [{"raw_material", "flavour", "ingredient"}]
    assert rows(rebuild.read_gold(other)["fact_recipe_components"]) == before


def test_marts(gold, rows):
    top = [tuple(r) for r in marts.top_customers(gold).collect()]
    assert top == [("Ann", 21.0), ("Ann B", 5.0), ("Bob", 3.0)]
    assert [tuple(r) for r in marts.top_countries(gold).collect()] == [("ITALY", 21.0), ("PERU", 6.0)]
    assert [tuple(r) for r in marts.top_flavours(gold).collect()] == [("Mint", 21.0, 2), ("Lime", 4.0, 2)]
    parts = marts.recipe_constituents(gold, "PHMV", 1).select("component_type", "component_name")
    assert [tuple(r) for r in parts.collect()] == [
        ("flavour", "Mint"), ("ingredient", "Salt, fine"), ("raw_material", "Water")]
    assert rows(marts.recipes_using(gold, 1, "raw_material", 78)) == [("GAP",), ("PHMV",)]
    importance = marts.component_importance(gold).first()
    assert tuple(importance) == ("raw_material", 78, "Water", 3, 1.5)
    assert [r["batch_number"] for r in marts.flavour_history(gold, 21).collect()] == [1, 4]
    assert [r["flavour_id"] for r in marts.changed_descriptions(gold).collect()] == [21, 21]
    assert rows(marts.country_coverage(gold)) == [
        ("customers", "ITALY", 2), ("providers", "ITALY", 2)]
    assert rows(marts.recipes_without_three_components(gold)) == [
        ("GAP", 1, 2, 2), ("SOON", 2, 2, 2)]
    odd = marts.recipes_with_odd_ratio_sum(gold).select("recipe_id", "batch_number")
    assert [tuple(r) for r in odd.collect()] == [("SOON", 2), ("PHMV", 5)]
    assert rows(marts.country_gaps(gold)) == [("customer", 2, 1)]
    assert marts.sales_country_gaps(gold).first()["transaction_id"] == 3
    assert rows(marts.stock_value_per_provider(gold)) == [("Acme 2", 2, -2.0), ("Acme", 1, 5.0)]
    assert marts.ingredients_per_provider(gold).first()["ingredient_name"] == "Salt, fine"


def test_metric_tables(warehouse, gold, rows):
    metric = {r[0]: r[1:] for r in rows(marts.metric_report(
        rebuild.read_silver_metrics(warehouse).unionByName(gold["gold_data_quality_metrics"])))}
    assert len(metric) == 11
    assert metric["silver.sales.duplicate_transaction_id_batch"] == (1, 4, 25.0)
    assert metric["silver.sales.negative_amount_or_quantity_rows"] == (1, 5, 20.0)
    assert metric["silver.ingredients.negative_weight_or_cost_rows"] == (1, 3, 33.333333)
    assert metric["silver.recipes.ratio_sum_not_one_rows"] == (1, 4, 25.0)
    assert metric["gold.recipes.not_exactly_3_components"] == (2, 4, 50.0)
    assert metric["gold.recipes.ratio_sum_not_one"] == (2, 4, 50.0)


def test_check_reports(warehouse, gold):
    def failed(layer, tables):
        return {r[0] for r in suite.report(layer, tables).filter("not passed").collect()}

    lines = {layer: len(columns) for layer, columns in (
        (layer, [c for names in tables.values() for c in names])
        for layer, tables in suite.NOT_NULL.items())}
    assert lines == {"bronze": 7, "silver": 42, "gold": 24}
    tested = [r[0] for r in suite.report("gold", gold).collect()]
    assert len(tested) == len(set(tested)) == 24 + 11 + 8 + 6 + 1 + 3
    assert failed("bronze", rebuild.read_bronze(warehouse)) == set()
    assert failed("silver", rebuild.read_silver(warehouse)) == {
        "silver.ingredients.non_negative",
        "silver.ingredients.generation_date.not_null",
        "silver.recipes.flavour_id.not_null",
        "silver.recipes.flavour_ratio.not_null",
        "silver.recipes.ratios_sum_to_one",
        "silver.recipes.yield_in_range",
        "silver.sales_transactions.non_negative",
        "silver.sales_transactions.unique_key_and_batch",
    }
    assert failed("gold", gold) == {
        "gold.country_key_coverage",
        "gold.fact_provider_ingredient_stock.provider_sk.not_null",
        "gold.fact_sales_transactions.customer_sk.not_null",
        "gold.fact_sales_transactions.flavour_sk.not_null",
        "gold.fact_sales_transactions.sales_txn_sk.unique",
        "gold.recipes.ratios_sum_to_one",
        "gold.sales.unique_transaction_and_batch",
    }
