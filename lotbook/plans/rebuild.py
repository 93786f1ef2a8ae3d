"""Wiring of the layers. Plain calls in dependency order; Spark plans what runs how."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame

from lotbook.operators import version_spans, versioned_dimension
from lotbook.operators.lookups import BROADCAST_ROWS, FEW_VERSIONS
from lotbook.plans import dimensions, facts
from lotbook.plans.conform import conform
from lotbook.plans.entities import (
    COMPONENTS,
    ENTITIES,
    GOLD_SCHEMAS,
    SILVER_METRICS_SCHEMA,
    VERSION,
    bronze_schema,
    silver_schema,
)
from lotbook.quality.metrics import gold_metrics, silver_metrics
from lotbook.session import at_once, shuffles_dropped
from lotbook.sources.tables import Warehouse

# Versioned dimension -> the typed table it is built from.
VERSIONED = {
    "dim_flavour": "flavours",
    "dim_raw_material": "raw_materials",
    "dim_ingredient": "ingredients",
    "dim_recipe": "recipes",
    "dim_customer": "customers",
    "dim_provider": "providers",
}
# These carry a country's key.
_PLACED = ("dim_customer", "dim_provider")
SILVER_METRICS = "silver_data_quality_metrics"
GOLD_METRICS = "gold_data_quality_metrics"


def read_bronze(warehouse: Warehouse) -> dict[str, DataFrame]:
    return {e: warehouse.read("bronze", e, bronze_schema(e)) for e in ENTITIES}


def read_silver(warehouse: Warehouse) -> dict[str, DataFrame]:
    return {e: warehouse.read("silver", f"silver_{e}", silver_schema(e)) for e in ENTITIES}


def read_gold(warehouse: Warehouse) -> dict[str, DataFrame]:
    return {table: _read(warehouse, table) for table in GOLD_SCHEMAS}


def _read(warehouse: Warehouse, table: str) -> DataFrame:
    """Versioned dimensions by their buckets: marts look them up by surrogate key."""
    schema = GOLD_SCHEMAS[table]
    if table in VERSIONED:
        return warehouse.read_bucketed("gold", table, schema, _key(table))
    return warehouse.read("gold", table, schema)


def _key(table: str) -> str:
    return f"{table.removeprefix('dim_')}_sk"


def read_silver_metrics(warehouse: Warehouse) -> DataFrame:
    return warehouse.read("silver", SILVER_METRICS, SILVER_METRICS_SCHEMA)


def rebuild_silver(warehouse: Warehouse) -> None:
    """The typed tables do not need each other and are written at once; the metrics read them."""
    raw = read_bronze(warehouse)

    def build(entity: str) -> None:
        warehouse.replace("silver", f"silver_{entity}", conform(raw[entity], entity))

    with shuffles_dropped(warehouse.spark):
        at_once(*(partial(build, entity) for entity in raw))
        warehouse.replace("silver", SILVER_METRICS, silver_metrics(read_silver(warehouse)))


def rebuild_gold(warehouse: Warehouse) -> None:
    """Each table is written before it is used: later plans then know its size, and a lost
    executor costs a re-read instead of a recomputation of the layers below. Tables that do not
    need each other are written at once, in three rounds before the metrics."""
    silver = read_silver(warehouse)
    spans = version_spans({entity: silver[entity] for entity in VERSIONED.values()}, VERSION)
    gold: dict[str, DataFrame] = {}

    def build(table: str, make: Callable[[], DataFrame]) -> None:
        if table in VERSIONED:
            warehouse.replace_bucketed("gold", table, make(), _key(table))
        else:
            by_batch = VERSION if table.startswith("fact_") else None
            finish = facts.with_component_keys if table == "fact_recipe_components" else None
            warehouse.replace("gold", table, make(), by_batch, finish)
        gold[table] = _read(warehouse, table)

    def dimension(table: str) -> Callable[[], None]:
        entity = VERSIONED[table]
        return partial(
            build, table, lambda: _dimension(table, silver[entity], gold, spans[entity])
        )

    def components() -> DataFrame:
        bounds = {kind: spans[VERSIONED[dim]] for kind, dim in COMPONENTS.items()}
        widest = max(bounds.values())
        counted = sum(gold[dim].count() for dim in COMPONENTS.values())  # from the files' footers
        # Small dimensions are broadcast whole.
        few = facts.few_asked(silver["recipes"], bounds) if _moves(widest, counted) else None
        return facts.resolved_components(silver["recipes"], gold, widest, counted, few)

    with shuffles_dropped(warehouse.spark):
        at_once(
            partial(build, "dim_country", lambda: dimensions.dim_country(silver)),
            *(dimension(table) for table in VERSIONED if table not in _PLACED),
        )
        at_once(
            partial(build, "fact_recipe_components", components), *(dimension(table) for table in _PLACED)
        )
        at_once(
            partial(
                build,
                "fact_sales_transactions",
                lambda: facts.fact_sales_transactions(silver["sales_transactions"], gold),
            ),
            partial(
                build,
                "fact_provider_ingredient_stock",
                lambda: facts.fact_provider_ingredient_stock(silver["ingredients"], gold),
            ),
        )
        build(GOLD_METRICS, lambda: gold_metrics(gold))


def _moves(span: int, dim_rows: int) -> bool:
    """Whether slots that are looked up with all versions have to be moved."""
    return span <= FEW_VERSIONS and dim_rows > BROADCAST_ROWS


class LazyGold(Mapping[str, DataFrame]):
    """The gold tables as unexecuted plans over the typed tables, each made when asked for."""

    def __init__(
        self,
        silver: Mapping[str, DataFrame],
        span: int | Callable[[str], int] | None = None,
    ):
        """``span`` bounds the versions of a key, or counts those of an entity when a table first
        needs them."""
        self._silver, self._bound, self._made = silver, span, {}
        self._versions: dict[str, DataFrame] = {}
        self._counted: dict[str, int] = {}

    def _span(self, entity: str) -> int | None:
        if not callable(self._bound):
            return self._bound
        if entity not in self._counted:
            self._counted[entity] = self._bound(entity)
        return self._counted[entity]

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._made:
            self._made[table] = self._make(table)
        return self._made[table]

    def versions(self, table: str, among: DataFrame | None = None) -> DataFrame:
        """The keys, batches and validity of a versioned dimension, for lookups that ask for no
        more: no row's attributes are compared or moved. ``among`` may hold few ids: rows of others
        are left out where they are read."""
        if among is None and table in self._versions:
            return self._versions[table]
        entity, key = VERSIONED[table], f"{table.removeprefix('dim_')}_id"
        rows = self._silver[entity]
        made = versioned_dimension(
            rows if among is None else dimensions.of_ids(rows, among),
            _key(table),
            key,
            [],
            span=self._span(entity),
        )
        if among is None:
            self._versions[table] = made
        return made

    def columns(self, table: str, names: Sequence[str]) -> DataFrame:
        """All rows of a table with some of its columns. Of a versioned dimension whose attributes
        are not among them none is made: a window that picks the newest row needs them all, so
        Spark cannot leave them out by itself."""
        if table in VERSIONED:
            lean = self.versions(table)
            if set(names) <= set(lean.columns):
                return lean.select(*names)
        return self[table].select(*names)

    def components(self) -> list[DataFrame]:
        """The component fact before its keys are written out, one frame per lookup."""
        return facts.resolved_by_lookup(*self._component_lookup())

    def _component_lookup(self) -> tuple:
        spans = {kind: self._span(VERSIONED[dim]) for kind, dim in COMPONENTS.items()}
        widest = None if None in spans.values() else max(spans.values())
        # Ids are counted where versions are, and for a lookup by broadcast alone.
        counts = callable(self._bound) and widest is not None and widest <= FEW_VERSIONS
        few = facts.few_asked(self._silver["recipes"], spans) if counts else None
        return self._silver["recipes"], self, widest, None, few

    def __iter__(self):
        return iter(GOLD_SCHEMAS)

    def __len__(self) -> int:
        return len(GOLD_SCHEMAS)

    def _make(self, table: str) -> DataFrame:
        silver = self._silver
        if table == "dim_country":
            return dimensions.dim_country(silver)
        if table in VERSIONED:
            entity = VERSIONED[table]
            return _dimension(table, silver[entity], self, self._span(entity))
        if table == "fact_sales_transactions":
            return facts.fact_sales_transactions(silver["sales_transactions"], self)
        if table == "fact_provider_ingredient_stock":
            return facts.fact_provider_ingredient_stock(silver["ingredients"], self)
        if table == "fact_recipe_components":
            return facts.fact_recipe_components(*self._component_lookup())
        if table == GOLD_METRICS:
            return gold_metrics(self)
        raise KeyError(table)


def _dimension(
    table: str, silver: DataFrame, gold: Mapping[str, DataFrame], span: int | None
) -> DataFrame:
    make = getattr(dimensions, table)
    if table in _PLACED:
        return make(silver, gold["dim_country"], span)
    return make(silver, span)
