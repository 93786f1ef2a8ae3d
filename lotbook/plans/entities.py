"""The data model: raw columns, their typed form, and the gold tables.

Fixed values throughout: table and column names are the model's public surface.
"""

from __future__ import annotations

from dataclasses import dataclass

VERSION = "batch_number"
LINEAGE = ("_source_file", "_ingested_at_utc", "_load_id")

TEXT, WHOLE, REAL, DAY = "text", "whole", "real", "day"
SQL_TYPES = {TEXT: "string", WHOLE: "bigint", REAL: "double", DAY: "date"}


@dataclass(frozen=True)
class Field:
    raw: str
    kind: str
    name: str = ""

    @property
    def typed(self) -> str:
        return self.name or self.raw


DATED = (Field("generation_date", DAY), Field(VERSION, WHOLE))
PLACED = (Field("location_city", TEXT), Field("location_country", TEXT))

# Columns in file order; ``name`` where the typed column is called differently.
ENTITIES: dict[str, tuple[Field, ...]] = {
    "customers": (
        Field("customer_id", WHOLE),
        Field("name", TEXT, "customer_name"),
        *PLACED,
        *DATED,
    ),
    "flavours": (
        Field("flavour_id", WHOLE),
        Field("name", TEXT, "flavour_name"),
        Field("description", TEXT, "flavour_description"),
        *DATED,
    ),
    "ingredients": (
        Field("ingredient_id", WHOLE),
        Field("name", TEXT, "ingredient_name"),
        Field("chemical_formula", TEXT),
        Field("weight_in_grams", REAL),
        Field("cost_per_gram", REAL),
        Field("provider_id", WHOLE),
        *DATED,
    ),
    "providers": (
        Field("provider_id", WHOLE),
        Field("name", TEXT, "provider_name"),
        *PLACED,
        *DATED,
    ),
    "raw_materials": (
        Field("raw_material_id", WHOLE),
        Field("name", TEXT, "raw_material_name"),
        *DATED,
    ),
    "recipes": (
        Field("recipe_id", TEXT),
        Field("raw_material_id", WHOLE),
        Field("raw_material_ratio", REAL),
        Field("flavour_id", WHOLE),
        Field("flavour_ratio", REAL),
        Field("ingredient_id", WHOLE),
        Field("ingredient_ratio", REAL),
        Field("heat_process", TEXT),
        Field("yield", REAL),
        *DATED,
    ),
    "sales_transactions": (
        Field("transaction_id", WHOLE),
        Field("customer_id", WHOLE),
        Field("flavour_id", WHOLE),
        Field("quantity_liters", REAL),
        Field("amount_dollar", REAL, "amount_dollars"),
        Field("transaction_date", DAY),
        Field("transaction_country", TEXT),
        Field("transaction_town", TEXT),
        Field("postal_code", TEXT),
        *DATED,
    ),
}

LINEAGE_SCHEMA = "_source_file string, _ingested_at_utc timestamp, _load_id string"
LOG_SCHEMA = (
    "load_id string, ingested_at_utc timestamp, source_file string, target_table string, "
    "rows_loaded bigint"
)


def raw_schema(entity: str) -> str:
    return ", ".join(f"`{field.raw}` string" for field in ENTITIES[entity])


def bronze_schema(entity: str) -> str:
    return f"{raw_schema(entity)}, {LINEAGE_SCHEMA}"


def silver_schema(entity: str) -> str:
    fields = (f"`{field.typed}` {SQL_TYPES[field.kind]}" for field in ENTITIES[entity])
    return f"{', '.join(fields)}, {LINEAGE_SCHEMA}"


# Component label -> the dimension its ids belong to.
COMPONENTS = {
    "raw_material": "dim_raw_material",
    "flavour": "dim_flavour",
    "ingredient": "dim_ingredient",
}

_VALIDITY = "valid_from_batch bigint, valid_to_batch bigint, is_current boolean"
_PLACE = "location_city string, country_sk string, generation_date date"
_METRIC = "metric_name string, numerator bigint, denominator bigint, pct double"

GOLD_SCHEMAS = {
    "dim_country": "country_sk string, country_name string",
    "dim_customer": "customer_sk string, customer_id bigint, batch_number bigint, "
    f"customer_name string, {_PLACE}, {_VALIDITY}",
    "dim_provider": "provider_sk string, provider_id bigint, batch_number bigint, "
    f"provider_name string, {_PLACE}, {_VALIDITY}",
    "dim_flavour": "flavour_sk string, flavour_id bigint, batch_number bigint, "
    f"flavour_name string, flavour_description string, generation_date date, {_VALIDITY}",
    "dim_raw_material": "raw_material_sk string, raw_material_id bigint, batch_number bigint, "
    f"raw_material_name string, generation_date date, {_VALIDITY}",
    "dim_ingredient": "ingredient_sk string, ingredient_id bigint, batch_number bigint, "
    "ingredient_name string, chemical_formula string, provider_id bigint, "
    f"weight_in_grams double, cost_per_gram double, generation_date date, {_VALIDITY}",
    "dim_recipe": "recipe_sk string, recipe_id string, batch_number bigint, "
    f"heat_process string, yield_pct double, generation_date date, {_VALIDITY}",
    "fact_sales_transactions": "sales_txn_sk string, transaction_id bigint, "
    "batch_number bigint, customer_sk string, flavour_sk string, "
    "transaction_country_sk string, transaction_date date, transaction_town string, "
    "postal_code string, quantity_liters double, amount_dollars double, generation_date date",
    "fact_provider_ingredient_stock": "provider_ingredient_stock_sk string, "
    "batch_number bigint, ingredient_sk string, provider_sk string, "
    "provider_country_sk string, weight_in_grams double, cost_per_gram double, "
    "stock_value_dollars double, generation_date date",
    "fact_recipe_components": "recipe_component_sk string, recipe_sk string, "
    "batch_number bigint, component_type string, component_id bigint, component_sk string, "
    "component_ratio double, generation_date date",
    "gold_data_quality_metrics": _METRIC,
}
SILVER_METRICS_SCHEMA = _METRIC


def columns(table: str) -> list[str]:
    return [part.split()[0] for part in GOLD_SCHEMAS[table].split(", ")]
