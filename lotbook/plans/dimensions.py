"""The conformed country dimension and the six versioned dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotbook.functions import fold
from lotbook.operators import value_dimension, value_lookup, versioned_dimension
from lotbook.plans.entities import columns

Tables = Mapping[str, DataFrame]


def known_versions(gold: Tables, dim: str, among: DataFrame | None = None) -> DataFrame:
    """A versioned dimension for a lookup of its keys alone. Where tables are plans, their
    attributes are not made for it. ``among`` holds the ids that are looked up, few enough to be
    broadcast: no version of another id is made or read."""
    lean = getattr(gold, "versions", None)
    if lean:
        return lean(dim, among)
    return gold[dim] if among is None else of_ids(gold[dim], among)


def of_ids(df: DataFrame, among: DataFrame) -> DataFrame:
    """The rows of a few ids, whatever their version."""
    return df.join(F.broadcast(among), among.columns, "left_semi")


def dim_country(silver: Tables) -> DataFrame:
    sources = [
        (silver["customers"], "location_country"),
        (silver["providers"], "location_country"),
        (silver["sales_transactions"], "transaction_country"),
    ]
    return value_dimension(sources, "country_sk", "country_name")


def dim_customer(customers: DataFrame, country: DataFrame, span: int | None = None) -> DataFrame:
    return _placed(customers, country, "customer", span)


def dim_provider(providers: DataFrame, country: DataFrame, span: int | None = None) -> DataFrame:
    return _placed(providers, country, "provider", span)


def dim_flavour(flavours: DataFrame, span: int | None = None) -> DataFrame:
    attributes = ["flavour_name", "flavour_description", "generation_date"]
    return versioned_dimension(flavours, "flavour_sk", "flavour_id", attributes, span=span)


def dim_raw_material(raw_materials: DataFrame, span: int | None = None) -> DataFrame:
    attributes = ["raw_material_name", "generation_date"]
    return versioned_dimension(
        raw_materials, "raw_material_sk", "raw_material_id", attributes, span=span
    )


def dim_ingredient(ingredients: DataFrame, span: int | None = None) -> DataFrame:
    attributes = [
        "ingredient_name",
        "chemical_formula",
        "provider_id",
        "weight_in_grams",
        "cost_per_gram",
        "generation_date",
    ]
    return versioned_dimension(
        ingredients, "ingredient_sk", "ingredient_id", attributes, span=span
    )


def dim_recipe(recipes: DataFrame, span: int | None = None) -> DataFrame:
    attributes = ["heat_process", "yield_pct", "generation_date"]
    renamed = recipes.withColumnRenamed("yield", "yield_pct")
    return versioned_dimension(renamed, "recipe_sk", "recipe_id", attributes, span=span)


def _placed(df: DataFrame, country: DataFrame, entity: str, span: int | None) -> DataFrame:
    """A versioned dimension whose country name is replaced by the country's key."""
    named = df.withColumn("country_name", fold(F.col("location_country")))
    attributes = [f"{entity}_name", "location_city", "country_name", "generation_date"]
    versions = versioned_dimension(named, f"{entity}_sk", f"{entity}_id", attributes, span=span)
    placed = value_lookup(
        versions, country, F.col("country_name"), "country_name", "country_sk", "country_sk"
    )
    return placed.select(*columns(f"dim_{entity}"))
