"""The warehouse's own checks by layer, as named violation frames and as one pass/fail report.

Fixed values: which columns are tested for what.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotbook.plans.entities import COMPONENTS, ENTITIES, VERSION
from lotbook.quality import checks
from lotbook.quality.checks import CURRENT, PARENT, UNIQUE, KeyRule

Tables = Mapping[str, DataFrame]

NOT_NULL = {
    "bronze": {entity: (VERSION,) for entity in ENTITIES},
    "silver": {
        "customers": ("customer_id", VERSION, "generation_date", "customer_name"),
        "flavours": (
            "flavour_id",
            VERSION,
            "generation_date",
            "flavour_name",
            "flavour_description",
        ),
        "providers": ("provider_id", VERSION, "generation_date", "provider_name"),
        "raw_materials": ("raw_material_id", VERSION, "generation_date", "raw_material_name"),
        "ingredients": (
            "ingredient_id",
            "provider_id",
            VERSION,
            "generation_date",
            "ingredient_name",
            "weight_in_grams",
            "cost_per_gram",
        ),
        "recipes": (
            "recipe_id",
            "raw_material_id",
            "flavour_id",
            "ingredient_id",
            "raw_material_ratio",
            "flavour_ratio",
            "ingredient_ratio",
            "yield",
            VERSION,
            "generation_date",
        ),
        "sales_transactions": (
            "transaction_id",
            "customer_id",
            "flavour_id",
            "transaction_date",
            "amount_dollars",
            "quantity_liters",
            VERSION,
            "generation_date",
        ),
    },
    "gold": {
        "dim_country": ("country_sk", "country_name"),
        "dim_customer": ("customer_sk", "is_current"),
        "dim_provider": ("provider_sk", "is_current"),
        "dim_flavour": ("flavour_sk", "is_current"),
        "dim_raw_material": ("raw_material_sk", "is_current"),
        "dim_ingredient": ("ingredient_sk", "is_current"),
        "dim_recipe": ("recipe_sk", "is_current", "yield_pct"),
        "fact_sales_transactions": ("sales_txn_sk", "customer_sk", "flavour_sk"),
        "fact_provider_ingredient_stock": (
            "provider_ingredient_stock_sk",
            "provider_sk",
            "ingredient_sk",
        ),
        "fact_recipe_components": ("recipe_component_sk", "recipe_sk", "component_type"),
    },
}

UNIQUE_KEYS = {
    "dim_country": ("country_sk", "country_name"),
    "dim_customer": ("customer_sk",),
    "dim_provider": ("provider_sk",),
    "dim_flavour": ("flavour_sk",),
    "dim_raw_material": ("raw_material_sk",),
    "dim_ingredient": ("ingredient_sk",),
    "dim_recipe": ("recipe_sk",),
    "fact_sales_transactions": ("sales_txn_sk",),
    "fact_provider_ingredient_stock": ("provider_ingredient_stock_sk",),
    "fact_recipe_components": ("recipe_component_sk",),
}

# (child, column) -> (parent, column)
PARENTS = {
    ("dim_customer", "country_sk"): ("dim_country", "country_sk"),
    ("dim_provider", "country_sk"): ("dim_country", "country_sk"),
    ("fact_sales_transactions", "customer_sk"): ("dim_customer", "customer_sk"),
    ("fact_sales_transactions", "flavour_sk"): ("dim_flavour", "flavour_sk"),
    ("fact_sales_transactions", "transaction_country_sk"): ("dim_country", "country_sk"),
    ("fact_provider_ingredient_stock", "provider_sk"): ("dim_provider", "provider_sk"),
    ("fact_provider_ingredient_stock", "ingredient_sk"): ("dim_ingredient", "ingredient_sk"),
    ("fact_recipe_components", "recipe_sk"): ("dim_recipe", "recipe_sk"),
}

ACCEPTED = {("fact_recipe_components", "component_type"): tuple(COMPONENTS)}

NATURAL_KEYS = {
    "customers": "customer_id",
    "flavours": "flavour_id",
    "ingredients": "ingredient_id",
    "providers": "provider_id",
    "raw_materials": "raw_material_id",
    "sales_transactions": "transaction_id",
}

DIMENSION_KEYS = {
    "dim_customer": "customer_id",
    "dim_flavour": "flavour_id",
    "dim_ingredient": "ingredient_id",
    "dim_provider": "provider_id",
    "dim_raw_material": "raw_material_id",
    "dim_recipe": "recipe_id",
}


#: Every rule on the values of a key column in the gold layer.
KEY_RULES = [
    *(KeyRule(UNIQUE, table, name) for table, names in UNIQUE_KEYS.items() for name in names),
    *(KeyRule(PARENT, *child, parent) for child, parent in PARENTS.items()),
    *(KeyRule(CURRENT, dim, key) for dim, key in DIMENSION_KEYS.items()),
]
_ENDINGS = {UNIQUE: "unique", PARENT: "has_parent", CURRENT: "one_current"}


def check_name(rule: KeyRule) -> str:
    table = rule.table if rule.kind == CURRENT else rule.name
    return f"gold.{table}.{_ENDINGS[rule.kind]}"


def violations(layer: str, tables: Tables) -> dict[str, DataFrame]:
    """The checks of a layer that are not per column, by name, as the frame of what breaks them."""
    return {"bronze": _bronze, "silver": _silver, "gold": _gold}[layer](tables)


def null_report(layer: str, tables: Tables) -> DataFrame:
    """(check_name, violations): a line per tested column, one pass over each table. Tables that
    are plans are asked for the tested columns alone."""
    take = checks.columns_of(tables)
    arms = [
        checks.null_rows(take(table, names), names, blanks=layer == "bronze").select(
            F.concat(F.lit(f"{layer}.{table}."), "column_name", F.lit(".not_null")).alias(
                "check_name"
            ),
            F.col("null_rows").alias("violations"),
        )
        for table, names in NOT_NULL[layer].items()
    ]
    return reduce(DataFrame.unionByName, arms)


def key_report(tables: Tables, rules: Sequence[KeyRule]) -> DataFrame:
    """(check_name, violations): a line per key rule, all from one exchange."""
    found = checks.key_groups(tables, rules).groupBy("kind", "name").agg(
        F.count("*").alias("violations")
    )
    names = found.sparkSession.createDataFrame(
        [(r.kind, r.name, check_name(r)) for r in rules],
        "kind string, name string, check_name string",
    )
    # One row per rule on either side.
    lines = F.broadcast(names).join(found, ["kind", "name"], "left")
    return lines.select("check_name", F.coalesce("violations", F.lit(0)).alias("violations"))


def report(layer: str, tables: Tables) -> DataFrame:
    """One row per declared test: name, number of violations, passed. Null tests count rows, key
    tests values, the others whatever breaks them."""
    counts = [
        broken.agg(F.count("*").alias("violations")).select(
            F.lit(name).alias("check_name"), "violations"
        )
        for name, broken in violations(layer, tables).items()
    ]
    counts.append(null_report(layer, tables))
    if layer == "gold":
        counts.append(key_report(tables, KEY_RULES))
    rows = reduce(DataFrame.unionByName, counts)
    return rows.withColumn("passed", F.col("violations") == 0)


def _bronze(tables: Tables) -> dict[str, DataFrame]:
    bronze = {entity: tables[entity] for entity in ENTITIES}
    return {
        "bronze.tables_not_empty": checks.empty_tables(bronze),
        "bronze.batch_number_present": checks.rows_without_version(bronze),
    }


def _silver(tables: Tables) -> dict[str, DataFrame]:
    recipes = tables["recipes"]
    found = {
        f"silver.{entity}.unique_key_and_batch": checks.repeated_keys(
            tables[entity], [key, VERSION]
        )
        for entity, key in NATURAL_KEYS.items()
    }
    return found | {
        "silver.ingredients.non_negative": checks.negative_values(
            tables["ingredients"], "weight_in_grams", "cost_per_gram"
        ),
        "silver.sales_transactions.non_negative": checks.negative_values(
            tables["sales_transactions"], "amount_dollars", "quantity_liters"
        ),
        "silver.recipes.ratio_bounds": checks.ratios_outside_bounds(recipes),
        "silver.recipes.ratios_sum_to_one": checks.ratio_sums_not_one(recipes),
        "silver.recipes.yield_in_range": checks.values_outside(recipes, "yield", 0, 100),
    }


def _gold(tables: Tables) -> dict[str, DataFrame]:
    found = {
        f"gold.{table}.{name}.accepted": checks.unexpected_values(tables[table], name, accepted)
        for (table, name), accepted in ACCEPTED.items()
    }
    return found | {
        "gold.sales.unique_transaction_and_batch": checks.repeated_keys(
            tables["fact_sales_transactions"], ["transaction_id", VERSION]
        ),
        "gold.recipes.ratios_sum_to_one": checks.recipe_ratio_sums_not_one(
            tables["fact_recipe_components"]
        ),
        "gold.country_key_coverage": checks.rows_without_country(tables),
    }
