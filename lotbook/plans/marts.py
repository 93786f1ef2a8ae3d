"""Stakeholder answers over the gold tables.

Money and ratios are summed exactly and rounded once, whatever their type, so an answer has the
same bits for any number of partitions.

Sums are taken per surrogate key before the dimension is joined: a key's rows are added up in
the map tasks, so a hot key costs one row per task, and the join sees one row per dimension
version instead of the fact. Sort orders end in columns that make them total.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotbook.functions import ExactSum, surrogate_key
from lotbook.operators import own_version
from lotbook.plans.dimensions import known_versions
from lotbook.plans.entities import COMPONENTS, VERSION
from lotbook.plans.facts import kind_name
from lotbook.quality.metrics import (
    COMPONENTS_PER_RECIPE,
    odd_ratio_sums,
    recipe_profile,
)

Tables = Mapping[str, DataFrame]


def _up(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _down(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def ingredients_per_provider(gold: Tables) -> DataFrame:
    report = (
        gold["fact_provider_ingredient_stock"]
        .join(gold["dim_provider"].select("provider_sk", "provider_name"), "provider_sk")
        .join(gold["dim_ingredient"].select("ingredient_sk", "ingredient_name"), "ingredient_sk")
        .select(
            "provider_name",
            "ingredient_name",
            VERSION,
            "weight_in_grams",
            "cost_per_gram",
            "stock_value_dollars",
        )
    )
    return report.orderBy(*_up(*report.columns))


def stock_value_per_provider(gold: Tables) -> DataFrame:
    stock = gold["fact_provider_ingredient_stock"]
    value = ExactSum(stock, "stock_value_dollars")
    per_key = stock.groupBy("provider_sk", VERSION).agg(*value.parts())
    return (
        per_key.join(gold["dim_provider"].select("provider_sk", "provider_name"), "provider_sk")
        .groupBy("provider_name", VERSION)
        .agg(*value.merged())
        .select("provider_name", VERSION, value.value().alias("total_stock_value_dollars"))
        .orderBy(*_down("total_stock_value_dollars"), *_up("provider_name", VERSION))
    )


def recipe_constituents(gold: Tables, recipe_id: str, batch_number: int) -> DataFrame:
    """The named components of one recipe version.

    The recipe's key follows from its id and batch, so it is compared as a constant: the filter
    reaches the fact's files, and no join with the recipe dimension has to shuffle the fact.
    """
    recipe = gold["dim_recipe"].filter(
        (F.col("recipe_id") == recipe_id) & (F.col(VERSION) == batch_number)
    )
    asked = gold["fact_recipe_components"].filter(F.col(VERSION) == batch_number)
    keyed = asked.withColumns({"_id": F.lit(recipe_id), "_batch": F.lit(batch_number)})
    parts = keyed.filter(F.col("recipe_sk") == surrogate_key("_id", "_batch")).drop("_id", "_batch")
    return (
        _with_component_names(
            parts.join(recipe.select("recipe_sk", "recipe_id"), "recipe_sk"), gold
        )
        .select(
            "recipe_id",
            VERSION,
            "component_type",
            "component_id",
            "component_name",
            "component_ratio",
        )
        .orderBy(*_up("component_type", "component_id", "component_ratio"))
    )


def component_importance(gold: Tables, top: int = 50) -> DataFrame:
    """Components by the share they contribute over all recipes.

    Counted per component version first: a recipe version has one batch, hence resolves a
    component to one version, so no recipe is counted under two versions of a component.
    """
    lean = getattr(gold, "components", None)
    if lean:
        # Ids and versions in place of their keys, counted where the lookup left them.
        frames, component, recipe = lean(), ("_kind", "component_id", "_found"), ("recipe_id", VERSION)
    else:
        component = ("component_type", "component_id", "component_sk")
        frames, recipe = [gold["fact_recipe_components"]], ("recipe_sk",)
    ratio = ExactSum(frames[0], "component_ratio")
    counts = (F.count_distinct(*recipe).alias("_recipes"), *ratio.parts())
    per_version = reduce(
        DataFrame.unionByName, [rows.groupBy(*component).agg(*counts) for rows in frames]
    )
    if lean:
        per_version = per_version.select(
            kind_name().alias("component_type"),
            "*",
            own_version("component_id", "component_sk", "_found"),
        )
    return (
        _with_component_names(per_version, gold)
        .groupBy("component_type", "component_id", "component_name")
        .agg(F.sum("_recipes").alias("recipes_using_component"), *ratio.merged())
        .select(
            "component_type",
            "component_id",
            "component_name",
            "recipes_using_component",
            ratio.value().alias("total_ratio_contribution"),
        )
        .orderBy(
            *_down("total_ratio_contribution", "recipes_using_component"),
            *_up("component_type", "component_id", "component_name"),
        )
        .limit(top)
    )


def recipes_using(
    gold: Tables, batch_number: int, component_type: str, component_id: int
) -> DataFrame:
    """Recipes hit when one component is lost."""
    hit = gold["fact_recipe_components"].filter(
        (F.col(VERSION) == batch_number)
        & (F.col("component_type") == component_type)
        & (F.col("component_id") == component_id)
    )
    # Of one batch the dimension holds an id once, so what is left of it is distinct.
    recipes = gold["dim_recipe"].filter(F.col(VERSION) == batch_number)
    found = recipes.join(hit.select("recipe_sk"), "recipe_sk", "left_semi")
    return found.select("recipe_id").orderBy(*_up("recipe_id"))


def top_customers(gold: Tables, top: int = 20) -> DataFrame:
    sales = _sales_by(gold, "customer_sk", "dim_customer", "customer_name")
    return (
        sales.select("customer_name", "total_sales_usd")
        .orderBy(*_down("total_sales_usd"), *_up("customer_name"))
        .limit(top)
    )


def top_flavours(gold: Tables, top: int = 20) -> DataFrame:
    return (
        _sales_by(gold, "flavour_sk", "dim_flavour", "flavour_name")
        .orderBy(*_down("total_sales_usd", "transaction_count"), *_up("flavour_name"))
        .limit(top)
    )


def top_countries(gold: Tables, top: int = 20) -> DataFrame:
    sales = _sales_by(gold, "country_sk", "dim_country", "country_name", "transaction_country_sk")
    return (
        sales.select("country_name", "total_sales_usd")
        .orderBy(*_down("total_sales_usd"), *_up("country_name"))
        .limit(top)
    )


def flavour_history(gold: Tables, flavour_id: int) -> DataFrame:
    return (
        gold["dim_flavour"]
        .filter(F.col("flavour_id") == flavour_id)
        .select(
            "flavour_id",
            VERSION,
            "flavour_name",
            "flavour_description",
            "valid_from_batch",
            "valid_to_batch",
            "is_current",
        )
        .orderBy(*_up(VERSION))
    )


def changed_descriptions(gold: Tables) -> DataFrame:
    """All versions of flavours that had more than one description.

    More than one distinct value means the smallest differs from the greatest, which needs no
    distinct set and is cut down in the map tasks.
    """
    text = F.col("flavour_description")
    changed = (
        gold["dim_flavour"]
        .groupBy("flavour_id")
        .agg(F.min(text).alias("_least"), F.max(text).alias("_greatest"))
        .filter(F.col("_least") != F.col("_greatest"))
        .select("flavour_id")
    )
    return (
        gold["dim_flavour"]
        .join(changed, "flavour_id", "left_semi")
        .select("flavour_id", VERSION, "flavour_name", "flavour_description")
        .orderBy(*_up("flavour_id", VERSION))
    )


def country_coverage(gold: Tables) -> DataFrame:
    counts = [
        gold[dim]
        .groupBy("country_sk")
        .agg(F.count("*").alias("entity_rows"))
        .withColumn("entity", F.lit(entity))
        for entity, dim in (("customers", "dim_customer"), ("providers", "dim_provider"))
    ]
    return (
        counts[0]
        .unionByName(counts[1])
        .join(gold["dim_country"], "country_sk")
        .select("entity", "country_name", "entity_rows")
        .orderBy(*_up("entity", "country_name"))
    )


def metric_report(metrics: DataFrame) -> DataFrame:
    return metrics.select("metric_name", "numerator", "denominator", "pct").orderBy("metric_name")


def recipes_without_three_components(gold: Tables, top: int = 50) -> DataFrame:
    rows, kinds = F.col("component_rows"), F.col("component_types")
    profile = recipe_profile(gold["fact_recipe_components"])
    odd = profile.filter(
        (rows != COMPONENTS_PER_RECIPE) | (kinds != COMPONENTS_PER_RECIPE)
    )
    return (
        _with_recipe_id(odd, gold)
        .select("recipe_id", VERSION, rows, kinds)
        .orderBy(*_down("component_rows"), *_up("recipe_id", VERSION))
        .limit(top)
    )


def recipes_with_odd_ratio_sum(gold: Tables, top: int = 50) -> DataFrame:
    total = F.col("ratio_sum")
    return (
        _with_recipe_id(odd_ratio_sums(gold["fact_recipe_components"]), gold)
        .select("recipe_id", VERSION, total)
        .orderBy(F.abs(total - 1.0).desc_nulls_last(), *_up("recipe_id", VERSION))
        .limit(top)
    )


def country_gaps(gold: Tables) -> DataFrame:
    """Customer and provider versions without a country."""
    gaps = [
        gold[f"dim_{entity}"]
        .filter(F.col("country_sk").isNull())
        .select(F.lit(entity).alias("entity"), F.col(f"{entity}_id").alias("natural_id"), VERSION)
        for entity in ("customer", "provider")
    ]
    return gaps[0].unionByName(gaps[1]).orderBy(*_up("entity", VERSION, "natural_id"))


def sales_country_gaps(gold: Tables, top: int = 50) -> DataFrame:
    """A sample of sales without a country, the same on every run."""
    report = [
        "transaction_id", VERSION, "transaction_date", "transaction_town", "postal_code"
    ]
    gaps = gold["fact_sales_transactions"].filter(F.col("transaction_country_sk").isNull())
    return gaps.select(*report).orderBy(*_up(*report)).limit(top)


def _sales_by(
    gold: Tables, sk: str, dim: str, name: str, fact_sk: str | None = None
) -> DataFrame:
    """(name, total_sales_usd, transaction_count): added up per key, then per name."""
    sales = gold["fact_sales_transactions"]
    amount = ExactSum(sales, "amount_dollars")
    per_key = sales.groupBy(F.col(fact_sk or sk).alias(sk)).agg(
        *amount.parts(), F.count("*").alias("_rows")
    )
    # Catalyst takes a dimension for as small as the packed files it is made from, and would
    # broadcast millions of names.
    named = per_key.hint("merge").join(gold[dim].select(sk, name), sk).groupBy(name)
    return named.agg(*amount.merged(), F.sum("_rows").alias("transaction_count")).select(
        name, amount.value().alias("total_sales_usd"), "transaction_count"
    )


def _with_component_names(parts: DataFrame, gold: Tables) -> DataFrame:
    """The name of each component, by its type.

    Each dimension holds a key once, so all three are looked up by the same key: the parts move
    once, and a dimension that is bucketed by its key not at all.
    """
    for kind, dim in COMPONENTS.items():
        names = gold[dim].select(
            F.col(f"{kind}_sk").alias("component_sk"), F.col(f"{kind}_name").alias(f"_{kind}")
        )
        parts = parts.join(names.hint("merge"), "component_sk", "left")
    name = F.coalesce(
        *(F.when(F.col("component_type") == kind, F.col(f"_{kind}")) for kind in COMPONENTS)
    )
    return parts.withColumn("component_name", name).drop(*(f"_{kind}" for kind in COMPONENTS))


def _with_recipe_id(profile: DataFrame, gold: Tables) -> DataFrame:
    recipes = known_versions(gold, "dim_recipe").select("recipe_sk", "recipe_id")
    return profile.hint("merge").join(recipes, "recipe_sk")
