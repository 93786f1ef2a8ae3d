"""Facts: surrogate foreign keys, measures and degenerate attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotbook.functions import fold, surrogate_key
from lotbook.operators import (
    asof_version,
    exact_version,
    named_members,
    own_version,
    slots_to_rows,
    value_lookup,
)
from lotbook.plans.dimensions import known_versions
from lotbook.plans.entities import COMPONENTS, VERSION, columns

Tables = Mapping[str, DataFrame]

# Versions of ids so few that each is hot: moved, their slots would pile up in a few tasks. Tens of
# thousands of keys in no order outgrow a Parquet dictionary and are written in full for every row,
# so with more of them the result would grow faster than its rows.
FEW_ASKED = 2_000


def fact_sales_transactions(sales: DataFrame, gold: Tables) -> DataFrame:
    """One fact row per sales row; the keys are null where no dimension row of the same batch
    (or no such country) exists."""
    for entity in ("customer", "flavour"):
        sk = f"{entity}_sk"
        found = known_versions(gold, f"dim_{entity}")
        sales = exact_version(sales, found, f"{entity}_id", {sk: sk})
    keyed = value_lookup(
        sales,
        gold["dim_country"],
        fold(F.col("transaction_country")),
        "country_name",
        "country_sk",
        "transaction_country_sk",
    )
    own_key = surrogate_key("transaction_id", VERSION)
    return keyed.withColumn("sales_txn_sk", own_key).select(*columns("fact_sales_transactions"))


def fact_provider_ingredient_stock(ingredients: DataFrame, gold: Tables) -> DataFrame:
    """One row per stock row. The ingredient dimension is built from the same rows; its key is
    written out where the rows have been moved, as an id and a version are a third of it."""
    found = exact_version(
        ingredients,
        gold["dim_provider"],
        "provider_id",
        {"provider_sk": "provider_sk", "country_sk": "provider_country_sk"},
    )
    keyed = found.select("*", own_version("ingredient_id", "ingredient_sk"))
    computed = {
        "provider_ingredient_stock_sk": surrogate_key("ingredient_id", "provider_id", VERSION),
        "stock_value_dollars": F.col("weight_in_grams") * F.col("cost_per_gram"),
    }
    return keyed.withColumns(computed).select(*columns("fact_provider_ingredient_stock"))


def few_asked(recipes: DataFrame, spans: Mapping[str, int]) -> dict[str, int]:
    """The component kinds whose slots name so few ids that the versions of those ids are best
    broadcast, and about how many versions that is. ``spans`` bounds the versions of an id.

    Runs one scan of the id columns; ids are told apart in sketches, so hardly anything is shuffled.
    The estimate decides where slots are looked up, not what they find.
    """
    named = (F.approx_count_distinct(f"{kind}_id").alias(kind) for kind in spans)
    ids = recipes.agg(*named).first()
    few: dict[str, int] = {}
    for rows, kind in sorted((ids[kind] * span, kind) for kind, span in spans.items()):
        if sum(few.values()) + rows > FEW_ASKED:
            break
        few[kind] = rows
    return few


def resolved_components(
    recipes: DataFrame,
    gold: Tables,
    span: int | None = None,
    dim_rows: int | None = None,
    few: Mapping[str, int] | None = None,
) -> DataFrame:
    """The component fact before its keys are written out: an id and a version are a quarter of
    a key and travel in its place (:func:`with_component_keys`).

    Up to three rows per recipe row: one per filled slot whose component has a version not
    later than the recipe's batch. A recipe without id or batch has no dimension row and gives
    none.

    The recipe dimension is built from the same rows. The three component dimensions are
    stacked, so the slots need one lookup, not one each. ``span`` bounds the batches a component
    can have, ``dim_rows`` the rows of the three dimensions together.

    Slots of the kinds in ``few`` (:func:`few_asked`) stay where they are read and the versions of
    the ids they name are sent to them. Slots of the other kinds move.
    """
    found = resolved_by_lookup(recipes, gold, span, dim_rows, few)
    return reduce(DataFrame.unionByName, found).withColumn("component_type", kind_name()).drop("_kind")


def resolved_by_lookup(
    recipes: DataFrame,
    gold: Tables,
    span: int | None = None,
    dim_rows: int | None = None,
    few: Mapping[str, int] | None = None,
) -> list[DataFrame]:
    """:func:`resolved_components` as one frame per lookup, each with other kinds, as numbers
    (:func:`kind_name`). A frame's rows lie where its lookup left them, so what is counted per
    component may not have to move them again."""
    few = few or {}
    keyed = recipes.filter(F.col("recipe_id").isNotNull() & F.col(VERSION).isNotNull())
    lookups = (
        ([kind for kind in COMPONENTS if kind not in few], dim_rows),
        ([kind for kind in COMPONENTS if kind in few], sum(few.values())),
    )
    return [
        _resolved_kinds(keyed, gold, kinds, span, rows, few) for kinds, rows in lookups if kinds
    ]


def kind_name() -> Column:
    """The component type by its number."""
    return F.coalesce(*(F.when(F.col("_kind") == n, kind) for n, kind in enumerate(COMPONENTS)))


def _resolved_kinds(
    keyed: DataFrame,
    gold: Tables,
    kinds: Sequence[str],
    span: int | None,
    dim_rows: int | None,
    few: Mapping[str, int],
) -> DataFrame:
    # A kind travels as its number, not by its name.
    numbers = {kind: number for number, kind in enumerate(COMPONENTS) if kind in kinds}
    rows = slots_to_rows(
        keyed,
        ["recipe_id", VERSION, "generation_date"],
        {number: (f"{kind}_id", f"{kind}_ratio") for kind, number in numbers.items()},
        "_kind",
        ["component_id", "component_ratio"],
    )

    def known(kind: str) -> DataFrame:
        if kind not in few:
            return known_versions(gold, COMPONENTS[kind])
        asked = keyed.select(f"{kind}_id").filter(F.col(f"{kind}_id").isNotNull()).distinct()
        return known_versions(gold, COMPONENTS[kind], asked)

    versions = named_members(
        {
            number: (known(kind), (f"{kind}_id", VERSION, "valid_from_batch", "valid_to_batch"))
            for kind, number in numbers.items()
        },
        "_kind",
        ("component_id", VERSION, "valid_from_batch", "valid_to_batch"),
    )
    return asof_version(
        rows,
        versions,
        # The id first: a sort tells rows apart by the first bytes of the first column.
        ["component_id", "_kind"],
        {VERSION: "_found"},
        span=span,
        dim_rows=dim_rows,
    )


def fact_recipe_components(
    recipes: DataFrame,
    gold: Tables,
    span: int | None = None,
    dim_rows: int | None = None,
    few: Mapping[str, int] | None = None,
) -> DataFrame:
    """:func:`resolved_components` with their keys."""
    return with_component_keys(resolved_components(recipes, gold, span, dim_rows, few))


def with_component_keys(resolved: DataFrame) -> DataFrame:
    own_key = surrogate_key("recipe_sk", "component_type", "component_sk", VERSION)
    keyed = resolved.select(
        "*",
        own_version("recipe_id", "recipe_sk"),
        own_version("component_id", "component_sk", "_found"),
    )
    return keyed.withColumn("recipe_component_sk", own_key).select(
        *columns("fact_recipe_components")
    )
