"""Metric tables: one aggregate per table, however many metrics it feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotbook.functions import ExactSum, outside, percentage
from lotbook.plans.entities import COMPONENTS, VERSION

Tables = Mapping[str, DataFrame]

# Fixed values.
RATIO_SUM_LOW, RATIO_SUM_HIGH = 0.999, 1.001
COMPONENTS_PER_RECIPE = 3


def any_of(rules: Sequence[Column]) -> Column:
    return reduce(Column.__or__, rules)


def negative(*names: str) -> Column:
    return any_of([F.col(n) < 0 for n in names])


def ratios_out_of_bounds() -> Column:
    return any_of([outside(F.col(n), 0, 1) for n in RATIOS])


def ratio_sum() -> Column:
    return reduce(Column.__add__, map(F.col, RATIOS))


def ratio_sum_not_one() -> Column:
    return outside(ratio_sum(), RATIO_SUM_LOW, RATIO_SUM_HIGH)


RATIOS = ("raw_material_ratio", "flavour_ratio", "ingredient_ratio")


def key_and_row_metrics(
    df: DataFrame,
    repeated: tuple[str, Sequence[str]] | None = None,
    bad_rows: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Metric rows of one table, from one pass over it.

    ``repeated`` names a metric and its key: key groups with more than one row against all key
    groups (a null key is a group). ``bad_rows`` maps a metric to a rule: rows that satisfy it
    against all rows. With a key, the row rules are counted per key group on the way.
    """
    bad_rows = bad_rows or {}
    hits = [f"_hits{i}" for i in range(len(bad_rows))]
    rules = [F.count_if(rule).alias(h) for h, rule in zip(hits, bad_rows.values())]
    rows = F.count("*").alias("_rows")
    if repeated is None:
        counts, parts = df.agg(rows, *rules), []
    else:
        name, keys = repeated
        groups = df.groupBy(*keys).agg(rows, *rules)
        counts = groups.agg(
            F.count_if(F.col("_rows") > 1).alias("_repeated"),
            F.count("*").alias("_keys"),
            *(F.coalesce(F.sum(h), F.lit(0)).alias(h) for h in [*hits, "_rows"]),
        )
        parts = [(name, "_repeated", "_keys")]
    parts += [(name, h, "_rows") for name, h in zip(bad_rows, hits)]
    return metric_rows(counts, parts)


def metric_rows(counts: DataFrame, parts: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(metric, numerator column, denominator column) of a one-row frame -> metric rows."""
    cells = [c for name, n, d in parts for c in (F.lit(name), F.col(n), F.col(d))]
    rows = counts.select(
        F.stack(F.lit(len(parts)), *cells).alias("metric_name", "numerator", "denominator")
    )
    return rows.withColumn("pct", percentage(F.col("numerator"), F.col("denominator")))


def recipe_profile(components: DataFrame) -> DataFrame:
    """Rows, distinct types and ratio sum per recipe version; feeds two metrics, a check and
    two drill-downs.

    A recipe's key stands for its id and batch. Types are flags of one number, so distinct ones
    need no second exchange; labels that the model does not know count as one type, or as two if
    they differ.
    """
    kind, ratio = F.col("component_type"), ExactSum(components, "component_ratio")
    flag = reduce(
        lambda found, at: found.when(kind == at[1], 1 << at[0]),
        enumerate(COMPONENTS),
        F.when(kind.isNull(), 0),
    ).otherwise(0)
    unknown = F.when(~kind.isin(*COMPONENTS), F.xxhash64(kind))
    grouped = components.groupBy("recipe_sk").agg(
        F.max(VERSION).alias(VERSION),
        F.count("*").alias("component_rows"),
        F.bit_count(F.bit_or(flag)).cast("bigint").alias("_known"),
        F.min(unknown).alias("_least"),
        F.max(unknown).alias("_greatest"),
        *ratio.parts(),
    )
    others = F.when(F.col("_least").isNull(), 0).when(F.col("_least") == F.col("_greatest"), 1)
    return grouped.select(
        "recipe_sk",
        VERSION,
        "component_rows",
        (F.col("_known") + others.otherwise(2)).alias("component_types"),
        ratio.value().alias("ratio_sum"),
    )


def odd_ratio_sums(components: DataFrame) -> DataFrame:
    """Recipe versions whose ratios do not add up: (key, version, ratio_sum).

    A sum is put together before it is tested. Catalyst would test the text of its parts instead,
    each of them many times over, in code too long for the JVM to compile; it moves no filter below
    a generator.
    """
    sums = recipe_profile(components).select("recipe_sk", VERSION, "ratio_sum")
    made = sums.select("recipe_sk", VERSION, F.explode(F.array("ratio_sum")).alias("ratio_sum"))
    return made.filter(outside(F.col("ratio_sum"), RATIO_SUM_LOW, RATIO_SUM_HIGH))


def silver_metrics(silver: Tables) -> DataFrame:
    tables = [
        key_and_row_metrics(
            silver["customers"],
            ("silver.customers.duplicate_customer_id_batch", ["customer_id", VERSION]),
        ),
        key_and_row_metrics(
            silver["flavours"],
            ("silver.flavours.duplicate_flavour_id_batch", ["flavour_id", VERSION]),
        ),
        key_and_row_metrics(
            silver["ingredients"],
            ("silver.ingredients.duplicate_ingredient_id_batch", ["ingredient_id", VERSION]),
            {
                "silver.ingredients.negative_weight_or_cost_rows": negative(
                    "weight_in_grams", "cost_per_gram"
                )
            },
        ),
        key_and_row_metrics(
            silver["sales_transactions"],
            ("silver.sales.duplicate_transaction_id_batch", ["transaction_id", VERSION]),
            {
                "silver.sales.negative_amount_or_quantity_rows": negative(
                    "amount_dollars", "quantity_liters"
                )
            },
        ),
        key_and_row_metrics(
            silver["recipes"],
            bad_rows={
                "silver.recipes.ratio_out_of_bounds_rows": ratios_out_of_bounds(),
                "silver.recipes.ratio_sum_not_one_rows": ratio_sum_not_one(),
            },
        ),
    ]
    return reduce(DataFrame.unionByName, tables)


def gold_metrics(gold: Tables) -> DataFrame:
    sales = key_and_row_metrics(
        gold["fact_sales_transactions"],
        ("gold.sales.duplicate_transaction_id_batch", ["transaction_id", VERSION]),
    )
    rows, kinds = F.col("component_rows"), F.col("component_types")
    not_three = (rows != COMPONENTS_PER_RECIPE) | (kinds != COMPONENTS_PER_RECIPE)
    off = outside(F.col("ratio_sum"), RATIO_SUM_LOW, RATIO_SUM_HIGH)
    recipes = key_and_row_metrics(
        recipe_profile(gold["fact_recipe_components"]),
        bad_rows={
            "gold.recipes.not_exactly_3_components": not_three,
            "gold.recipes.ratio_sum_not_one": off,
        },
    )
    return sales.unionByName(recipes)
