"""The seven raw tables, derived from the driver's tables with the dirt raw files have.

Customers, suppliers, parts, order lines and orders stand in for the entities. Every row of the
base table is used. The column expressions are written in the SQL both engines share, so the
oracle starts from the same text; what is done with the text differs.

Dirt: outer spaces, blank names, five date forms, re-sent corrections with a later stamp,
re-sent transactions, batches with gaps, blank batch numbers, negative measures, ratios that do
not add up, empty component slots, providers and flavours that do not exist.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotbook.plans.entities import LINEAGE

MONTHS = "'JanFebMarAprMayJunJulAugSepOctNovDec'"
FIRST_LOAD, SECOND_LOAD = "load-1", "load-2"
LOADED = {FIRST_LOAD: "2024-01-01 08:00:00", SECOND_LOAD: "2024-02-01 08:00:00"}


def text(expression: str) -> str:
    return f"cast({expression} as string)"


def month_name_date(d: str) -> str:
    short = f"substr({MONTHS}, 3 * month({d}) - 2, 3)"
    return f"{text(f'day({d})')} || '-' || {short} || '-' || substr({text(f'year({d})')}, 3, 2)"


def slash_date(d: str) -> str:
    return f"{text(f'month({d})')} || '/' || {text(f'day({d})')} || '/' || " + (
        f"substr({text(f'year({d})')}, 3, 2)"
    )


def day_first_date(d: str) -> str:
    day, month = (f"lpad({text(f'{part}({d})')}, 2, '0')" for part in ("day", "month"))
    return f"{day} || '/' || {month} || '/' || {text(f'year({d})')}"


@dataclass(frozen=True)
class Load:
    """One load of one entity: base table, versions per row, filter and columns."""

    base: str
    columns: dict[str, str]
    nation: str = ""  # key column joined to the nation's
    copies: int = 1  # versions made of each row, numbered by k
    only: str = ""
    load: str = FIRST_LOAD
    stamp: str = ""

    def stamped(self) -> str:
        return self.stamp or f"timestamp '{LOADED[self.load]}'"

    def resent(self, only: str, **columns: str) -> Load:
        return replace(self, only=only, load=SECOND_LOAD, columns=self.columns | columns)


def placed(name: str, key: str, city: str, batch: str, blank_every: int) -> dict[str, str]:
    return {
        "name": f"'  ' || {name} || ' v' || {text('k')} || ' '",
        "location_city": f"case when {key} % 7 = 0 then '   ' else ' ' || {city} end",
        "location_country": f"case when {key} % {blank_every} = 0 then '' "
        "else ' ' || lower(n_name) end",
        "generation_date": f"lpad({text(f'1 + {key} % 28')}, 2, '0') || '/0' || {text('k')} "
        "|| '/2024'",
        "batch_number": text(batch),
    }


CUSTOMERS = Load(
    "customer",
    {
        "customer_id": text("c_custkey"),
        **placed("c_name", "c_custkey", "c_mktsegment", "k * (1 + c_custkey % 2)", 9),
    },
    nation="c_nationkey",
    copies=3,
)
PROVIDERS = Load(
    "supplier",
    {
        "provider_id": text("s_suppkey"),
        **placed("s_name", "s_suppkey", "s_name", "3 * k - 2", 11),
        "generation_date": f"{text('k')} || '/' || {text('1 + s_suppkey % 28')} || '/24'",
    },
    nation="s_nationkey",
    copies=2,
)
FLAVOURS = Load(
    "part",
    {
        "flavour_id": text("p_partkey"),
        "name": "p_brand || ' ' || p_name",
        "description": "case when p_size > 25 and k = 2 then ' stronger ' || lower(p_type) "
        "else p_type || '  ' end",
        "generation_date": f"{text('1 + p_size % 28')} || '-Mar-' || {text('22 + k')}",
        "batch_number": f"case when p_size = 50 and k = 2 then ' ' else {text('2 * k - 1')} end",
    },
    copies=2,
)
RAW_MATERIALS = Load(
    "part",
    {
        "raw_material_id": text("p_partkey"),
        "name": "' ' || p_name || ' ' || p_type",
        "generation_date": f"'2023-' || {text('1 + p_size % 12')} || '-9'",
        "batch_number": text("1 + p_size % 3"),
    },
)
INGREDIENTS = Load(
    "lineitem",
    {
        "ingredient_id": text("l_partkey"),
        "name": f"'Lot ' || {text('l_partkey')} || l_returnflag",
        "chemical_formula": "case when l_linestatus = 'O' then ' ' else l_returnflag end",
        "weight_in_grams": f"case when l_returnflag = 'R' and l_quantity = 13 then '-1' "
        f"else {text('l_quantity')} end",
        "cost_per_gram": text("l_extendedprice"),
        "provider_id": f"case when l_linenumber = 7 and l_quantity = 1 then '-7' "
        f"else {text('l_suppkey')} end",
        "generation_date": month_name_date("l_shipdate"),
        "batch_number": "case when l_quantity = 50 and l_returnflag = 'N' then '' "
        f"else {text('year(l_shipdate) - 1994')} end",
    },
    stamp="cast(l_shipdate as timestamp)",
)
RECIPES = Load(
    "lineitem",
    {
        "recipe_id": f"' R' || {text('l_orderkey')} || '-' || {text('l_linenumber')}",
        "raw_material_id": text("l_partkey"),
        "raw_material_ratio": text("l_discount + 0.0"),
        "flavour_id": text("l_suppkey"),
        "flavour_ratio": text("l_tax + 0.0"),
        "ingredient_id": "case when l_linestatus = 'F' and l_linenumber = 7 then null "
        f"else {text('cast(l_quantity as bigint)')} end",
        "ingredient_ratio": f"case when l_returnflag = 'R' and l_quantity = 20 "
        f"then {text('1.01 - l_discount')} else {text('1.0 - l_discount - l_tax')} end",
        "heat_process": "case when l_returnflag = 'N' then '  ' else l_returnflag || ' ' end",
        "yield": text("2 * l_quantity + 1"),
        "generation_date": slash_date("l_shipdate"),
        "batch_number": "case when l_quantity = 49 and l_returnflag = 'A' then ' ' "
        f"else {text('year(l_shipdate) - 1994')} end",
    },
    stamp="cast(l_shipdate as timestamp)",
)
SALES = Load(
    "orders",
    {
        "transaction_id": text("o_orderkey"),
        "customer_id": text("o_custkey"),
        "flavour_id": text("o_orderkey % 50"),  # few flavours, so that each is hot
        "quantity_liters": text("day(o_orderdate) - 2"),
        "amount_dollar": text("o_totalprice"),
        "transaction_date": day_first_date("o_orderdate"),
        "transaction_country": "case when o_orderpriority = '5-LOW' and o_orderstatus = 'F' "
        "then '  ' else lower(n_name) || ' ' end",
        "transaction_town": "' ' || o_orderpriority",
        "postal_code": f"lpad({text('o_custkey')}, 7, '0')",
        "generation_date": month_name_date("o_orderdate"),
        "batch_number": text("year(o_orderdate) - 1994"),
    },
    nation="o_custkey % 25",
)

LOADS: dict[str, list[Load]] = {
    "customers": [
        CUSTOMERS,
        CUSTOMERS.resent("c_acctbal < 0", name="c_name || ' corrected'"),
        replace(
            CUSTOMERS.resent("c_acctbal < -500", batch_number="'  '"), copies=1
        ),
    ],
    "providers": [
        PROVIDERS,
        PROVIDERS.resent("s_acctbal < 2000 and k = 1", name="s_name || ' corrected'"),
        replace(PROVIDERS.resent("s_acctbal < 1000", batch_number="' '"), copies=1),
    ],
    "flavours": [FLAVOURS, FLAVOURS.resent("p_size = 7", description="' rewritten '")],
    "raw_materials": [
        RAW_MATERIALS,
        RAW_MATERIALS.resent("p_size < 10", name="p_name || ' (new)'"),
        RAW_MATERIALS.resent("p_size < 3", batch_number="''"),
    ],
    "ingredients": [INGREDIENTS],
    "recipes": [RECIPES],
    "sales_transactions": [SALES, SALES.resent("o_orderstatus = 'P'")],
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Base(Mapping[str, DataFrame]):
    """The driver's tables, each opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir, self._open = spark, sf_dir, {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._open:
            self._open[table] = read(self._spark, self._sf_dir, table)
        return self._open[table]

    def __iter__(self):
        raise TypeError("open tables by name")

    def __len__(self) -> int:
        return len(self._open)


def raw_table(base: Base, entity: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [_load(base, entity, load) for load in LOADS[entity]]
    )


def _load(base: Base, entity: str, load: Load) -> DataFrame:
    df = base[load.base]
    if load.nation:
        df = df.join(base["nation"], F.expr(f"{load.nation} = n_nationkey"))
    copies = ", ".join(map(str, range(1, load.copies + 1)))
    df = df.selectExpr("*", f"explode(array({copies})) as k" if load.copies > 1 else "1 as k")
    if load.only:
        df = df.filter(load.only)
    lineage = (f"'{entity}.csv'", load.stamped(), f"'{load.load}'")
    return df.selectExpr(
        *(f"{expression} as `{name}`" for name, expression in load.columns.items()),
        *(f"{expression} as {name}" for expression, name in zip(lineage, LINEAGE)),
    )


def raw_sql(entity: str) -> str:
    """The same rows for the oracle."""
    return " union all by name ".join(_load_sql(entity, load) for load in LOADS[entity])


def _load_sql(entity: str, load: Load) -> str:
    lineage = (f"'{entity}.csv'", load.stamped(), f"'{load.load}'")
    columns = [
        *(f'{expression} as "{name}"' for name, expression in load.columns.items()),
        *(f"{expression} as {name}" for expression, name in zip(lineage, LINEAGE)),
    ]
    nation = f" join nation on {load.nation} = n_nationkey" if load.nation else ""
    copies = ", ".join(f"({k})" for k in range(1, load.copies + 1))
    where = f" where {load.only}" if load.only else ""
    return (
        f"select {', '.join(columns)} from {load.base}{nation} "
        f"cross join (values {copies}) as copy(k){where}"
    )
