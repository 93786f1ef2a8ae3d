"""Registered queries: each runs a library operator over whole driver tables, next to the SQL
that states its result."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lotbook.functions import parse_date, percentage, surrogate_key, table_name
from lotbook.operators import (
    asof_version,
    exact_version,
    latest_per_key,
    slots_to_rows,
    version_span,
    versioned_dimension,
)
from lotbook.plans import marts, rebuild
from lotbook.plans.conform import conform
from lotbook.plans.entities import COMPONENTS, ENTITIES, GOLD_SCHEMAS, LINEAGE, VERSION
from lotbook.quality import checks, metrics, suite
from lotbook.session import at_once, delete, scratch
from lotbook.sources import Warehouse, load_raw
from lotbook.sources.raw import read_log
from workload import oracle
from workload.oracle import date, exact, key, pct, query
from workload.raw import SECOND_LOAD, Base, raw_sql, raw_table, read
from workload.report import report_sql

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str
    #: Columns that the rows come ordered by; a minus in front means descending. Nulls come last.
    order: tuple[str, ...] = ()


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str, order: str = "", **steps: str):
    def add(run: Run) -> Run:
        expected = query(sql, **steps)
        shows = lambda spark, sf_dir: shown(run(spark, sf_dir))
        QUERIES[name] = Query(shows, expected, tuple(order.split()))
        return run

    return add


def shown(df: DataFrame) -> DataFrame:
    """Types the two engines print alike: stamps as text, exact sums as DOUBLE."""
    columns = []
    for field in df.schema.fields:
        name = f"`{field.name}`"
        if field.dataType.typeName().startswith("timestamp"):
            columns.append(f"cast({name} as string) as {name}")
        elif isinstance(field.dataType, DecimalType):
            columns.append(f"cast({name} as double) as {name}")
        else:
            columns.append(name)
    return df.selectExpr(*columns)


class Silver(Mapping[str, DataFrame]):
    """Typed tables over the derived raw ones, each made when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._base, self._made = Base(spark, sf_dir), {}

    def __getitem__(self, entity: str) -> DataFrame:
        if entity not in self._made:
            self._made[entity] = conform(raw_table(self._base, entity), entity)
        return self._made[entity]

    def __iter__(self):
        return iter(ENTITIES)

    def __len__(self) -> int:
        return len(ENTITIES)


def gold_of(spark: SparkSession, sf_dir: str) -> rebuild.LazyGold:
    silver = Silver(spark, sf_dir)
    return rebuild.LazyGold(silver, lambda entity: version_span(silver[entity], VERSION))


# --- raw loads -----------------------------------------------------------------------------


def loaded_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The raw tables written as CSV drops and loaded, in a scratch folder of its own. The sales
    come as two drops of one name in the first load and once more in a second one. The drops are
    packed, in parts that a task reads whole, and gone once they are loaded."""
    root = scratch(spark, "warehouse")
    base = Base(spark, sf_dir)

    def drop(folder: str, entity: str) -> None:
        raw = raw_table(base, entity).select(*(field.raw for field in ENTITIES[entity]))
        raw.write.option("maxRecordsPerFile", ROWS_PER_PART).csv(
            f"{root}/drops/{folder}/{entity}.csv",
            header=True,
            escape='"',
            compression="gzip",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )

    at_once(*(partial(drop, *where) for where in DROPS[:-1]))
    warehouse = Warehouse(spark, f"{root}/warehouse")
    load_raw(spark, f"{root}/drops/*/*.csv", warehouse)
    load_raw(spark, f"{root}/drops/second/sales*.csv", warehouse)
    delete(spark, f"{root}/drops")
    return warehouse


# Rows of a part file, some 20 to 30 MB of text.
ROWS_PER_PART = 250_000
# (folder, entity) of each drop loaded; the last is loaded a second time.
DROPS = [*(("first", e) for e in ENTITIES), *[("second", "sales_transactions")] * 2]
LOADED = [entity for _, entity in DROPS]


def rebuilt_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    warehouse = loaded_warehouse(spark, sf_dir)
    rebuild.rebuild_silver(warehouse)
    rebuild.rebuild_gold(warehouse)
    return warehouse


def _loaded_sql(entity: str, folders: int, rows: str) -> str:
    """Text as it was written, but that an empty field of a CSV file is null."""
    texts = " || '|' || ".join(f"coalesce(nullif(\"{f.raw}\", ''), '<null>')" for f in ENTITIES[entity])
    return (
        f"select '{entity}' as target_table, {texts} as fields, '{entity}.csv' as _source_file, "
        f"{folders} * (select count(*) from raw_{entity}) as rows_of_load, true as logged "
        f"from {rows}"
    )


@register(
    "append_load",
    " union all ".join(
        _loaded_sql(entity, folders, f"raw_{entity}")
        for entity, folders in [
            *((e, 1 + (e == "sales_transactions")) for e in ENTITIES),
            ("sales_transactions", 2),
            ("sales_transactions", 1),
        ]
    ),
)
def _(spark, sf_dir):
    """Every row of every table with its text as found, its drop's name, the rows of its load in
    its table, and whether the log knows load, stamp and name."""
    warehouse = loaded_warehouse(spark, sf_dir)
    log = read_log(warehouse).select(
        F.col("load_id").alias("_load_id"),
        F.col("ingested_at_utc").alias("_ingested_at_utc"),
        F.col("source_file").alias("_source_file"),
        F.lit(True).alias("logged"),
    )
    arms = []
    for entity, table in rebuild.read_bronze(warehouse).items():
        texts = [F.coalesce(F.col(field.raw), F.lit("<null>")) for field in ENTITIES[entity]]
        loads = table.groupBy("_load_id").agg(F.count("*").alias("rows_of_load"))
        arms.append(
            table.join(F.broadcast(loads), "_load_id").select(
                F.lit(entity).alias("target_table"),
                F.concat_ws("|", *texts).alias("fields"),
                *LINEAGE,
                "rows_of_load",
            )
        )
    rows = reduce(DataFrame.unionByName, arms)
    found = rows.join(F.broadcast(log.distinct()), [*LINEAGE], "left")
    return found.select(
        "target_table",
        "fields",
        "_source_file",
        "rows_of_load",
        F.coalesce("logged", F.lit(False)).alias("logged"),
    )


@register(
    "load_log",
    " union all ".join(
        f"select '{e}.csv' as source_file, 'bronze.{e}' as target_table, "
        f"count(*) as rows_loaded, {drops} as drops_of_load from raw_{e}"
        for e, drops in [*((e, len(ENTITIES) + 1) for e in LOADED[:-1]), (LOADED[-1], 1)]
    ),
)
def _(spark, sf_dir):
    log = read_log(loaded_warehouse(spark, sf_dir))
    loads = log.groupBy("load_id", "ingested_at_utc").agg(F.count("*").alias("drops_of_load"))
    return log.join(F.broadcast(loads), ["load_id", "ingested_at_utc"]).select(
        "source_file", "target_table", "rows_loaded", "drops_of_load"
    )


@register(
    "route_file_names",
    r"""
    with names as (
        select page_id, regexp_replace(url, '^[a-z]+://', '') || '.CSV' as file_name from pages
        union all
        select page_id, ' ' || page_id || ' ' || url || '.csv ' from pages),
    stems as (
        select *, trim(regexp_replace(regexp_replace(lower(trim(file_name)), '\.csv$', ''),
                  '[^a-z0-9]+', '_', 'g'), '_') as stem from names)
    select page_id, file_name,
           case when stem[1] between '0' and '9' then 't_' else '' end || stem as target_table
    from stems""",
)
def _(spark, sf_dir):
    pages, url = read(spark, sf_dir, "pages"), F.col("url")
    id_text = F.col("page_id").cast("string")
    first = F.concat(F.regexp_replace(url, "^[a-z]+://", ""), F.lit(".CSV"))
    second = F.concat(F.lit(" "), id_text, F.lit(" "), url, F.lit(".csv "))
    names = pages.select("page_id", F.explode(F.array(first, second)).alias("file_name"))
    return names.withColumn("target_table", table_name(F.col("file_name")))


# --- column functions ----------------------------------------------------------------------

DATE_TEXT = """
    case o_orderkey % 6
        when 0 then cast(year(o_orderdate) as string) || '-' || cast(month(o_orderdate) as string)
             || '-' || cast(day(o_orderdate) as string)
        when 1 then cast(month(o_orderdate) as string) || '/' || cast(day(o_orderdate) as string)
             || '/' || substr(cast(year(o_orderdate) as string), 3, 2)
        when 2 then ' ' || cast(month(o_orderdate) as string) || '/'
             || cast(day(o_orderdate) as string) || '/' || cast(year(o_orderdate) as string)
        when 3 then cast(day(o_orderdate) as string) || '-'
             || substr('janFEBMarAprMayJunJulAugSepOctNovDec', 3 * month(o_orderdate) - 2, 3)
             || '-' || substr(cast(year(o_orderdate) as string), 3, 2)
        when 4 then cast(day(o_orderdate) + 3 as string) || '/'
             || cast(month(o_orderdate) as string) || '/' || cast(year(o_orderdate) as string)
        else o_orderpriority end"""


@register(
    "parse_date_forms",
    f"select o_orderkey, written, {date('written')} as parsed "
    f"from (select o_orderkey, {DATE_TEXT} as written from orders)",
)
def _(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{DATE_TEXT} as written")
    return orders.withColumn("parsed", parse_date("written"))


@register(
    "hashed_keys",
    f"""
    select event_id, {key('user_id', 'event_type', "case when value >= 1 then props end")} as sk
    from events""",
)
def _(spark, sf_dir):
    third = "case when value >= 1 then props end"
    return read(spark, sf_dir, "events").select(
        "event_id", surrogate_key("user_id", "event_type", third).alias("sk")
    )


# --- typed tables --------------------------------------------------------------------------


def _register_silver(entity: str) -> None:
    @register(
        f"silver_{entity}",
        f"select * replace (cast(_ingested_at_utc as varchar) as _ingested_at_utc) from s_{entity}",
    )
    def _(spark, sf_dir):
        return Silver(spark, sf_dir)[entity]


for _entity in ENTITIES:
    _register_silver(_entity)

# --- versions over events ------------------------------------------------------------------

EVENT_COLUMNS = "user_id, cast(day(ts) as bigint) as day, event_type, value, event_id, ts"
EVENT_ATTRIBUTES = ["event_id", "event_type", "value"]
DAYS_SQL = f"(select {EVENT_COLUMNS} from events)"
VIEWS_SQL = f"(select {EVENT_COLUMNS} from events where event_type = 'view')"
USER_VERSIONS = oracle.versions(DAYS_SQL, "sk", "user_id", EVENT_ATTRIBUTES, "day", "ts")
VIEW_VERSIONS = oracle.versions(VIEWS_SQL, "sk", "user_id", EVENT_ATTRIBUTES, "day", "ts")


def _events(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    events = read(spark, sf_dir, "events").selectExpr(*EVENT_COLUMNS.split(", "))
    return events if kind is None else events.filter(F.col("event_type") == kind)


def _user_versions(events: DataFrame, span: int | None) -> DataFrame:
    return versioned_dimension(events, "sk", "user_id", EVENT_ATTRIBUTES, "day", "ts", span)


@register(
    "latest_event_per_day",
    f"""
    select user_id, day, event_id, event_type, cast(ts as varchar) as ts from {DAYS_SQL}
    qualify row_number() over (partition by user_id, day order by ts desc, event_id desc) = 1""",
)
def _(spark, sf_dir):
    latest = latest_per_key(_events(spark, sf_dir), ["user_id", "day"], "ts", ["event_id"])
    return latest.select("user_id", "day", "event_id", "event_type", "ts")


@register("user_versions", USER_VERSIONS)
def _(spark, sf_dir):
    events = _events(spark, sf_dir)
    return _user_versions(events, version_span(events, "day"))


@register("user_versions_sliced", USER_VERSIONS)
def _(spark, sf_dir):
    return _user_versions(_events(spark, sf_dir), None)


LOOKED_UP = "p.event_id, p.user_id, p.day, v.sk as view_sk, v.value as view_value"


@register(
    "exact_lookup",
    f"""
    select {LOOKED_UP} from (select {EVENT_COLUMNS} from events where event_type = 'purchase') p
    left join ({VIEW_VERSIONS}) v using (user_id, day)""",
)
def _(spark, sf_dir):
    return _lookup(spark, sf_dir, exact_version, "user_id")


@register(
    "exact_lookup_salted",
    f"""
    select {LOOKED_UP} from (select {EVENT_COLUMNS} from events where event_type = 'purchase') p
    left join ({VIEW_VERSIONS}) v using (user_id, day)""",
)
def _(spark, sf_dir):
    return _lookup(spark, sf_dir, exact_version, "user_id", spread=4, spread_by=["event_id"])


@register(
    "exact_lookup_inner",
    f"""
    select {LOOKED_UP} from (select {EVENT_COLUMNS} from events where event_type = 'purchase') p
    join ({VIEW_VERSIONS}) v using (user_id, day)""",
)
def _(spark, sf_dir):
    return _lookup(spark, sf_dir, exact_version, "user_id", how="inner")


ASOF_SQL = f"""
    select {LOOKED_UP} from (select {EVENT_COLUMNS} from events where event_type = 'purchase') p
    asof join ({VIEW_VERSIONS}) v on p.user_id = v.user_id and p.day >= v.day"""


@register("asof_lookup", ASOF_SQL)
def _(spark, sf_dir):
    span = version_span(_events(spark, sf_dir, "view"), "day")
    return _lookup(spark, sf_dir, asof_version, ["user_id"], span, span=span)


@register("asof_lookup_sliced", ASOF_SQL)
def _(spark, sf_dir):
    return _lookup(spark, sf_dir, asof_version, ["user_id"])


def _lookup(spark, sf_dir, lookup, on, versions_span=None, **options) -> DataFrame:
    versions = _user_versions(_events(spark, sf_dir, "view"), versions_span)
    purchases = _events(spark, sf_dir, "purchase").select("event_id", "user_id", "day")
    take = {"sk": "view_sk", "value": "view_value"}
    return lookup(purchases, versions, on, take, version="day", **options).select(
        "event_id", "user_id", "day", *take.values()
    )


@register(
    "component_slots",
    """
    unpivot (select l_orderkey, l_linenumber, l_partkey, l_discount + 0.0 as discount,
                    l_tax + 0.0 as tax, 1 - l_discount - l_tax as net from lineitem)
    on discount, tax, net into name share value amount""",
)
def _(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").withColumns(
        {
            "discount": F.col("l_discount") + 0.0,
            "tax": F.col("l_tax") + 0.0,
            "net": 1 - F.col("l_discount") - F.col("l_tax"),
        }
    )
    slots = {name: (name,) for name in ("discount", "tax", "net")}
    keep = ["l_orderkey", "l_linenumber", "l_partkey"]
    return slots_to_rows(lines, keep, slots, "share", ["amount"])


# --- gold tables ---------------------------------------------------------------------------


def _register_gold(table: str) -> None:
    @register(table, f"select * from {table}")
    def _(spark, sf_dir):
        return gold_of(spark, sf_dir)[table]


for _table in GOLD_SCHEMAS:
    if _table != rebuild.GOLD_METRICS:
        _register_gold(_table)

# --- metric tables -------------------------------------------------------------------------


def _repeated_sql(metric: str, table: str, nk: str) -> str:
    groups = f"(select count(*) as n from {table} group by {nk}, batch_number)"
    return f"""
        select '{metric}' as metric_name, n as numerator, d as denominator,
               {pct('n', 'd')} as pct
        from (select count(*) filter (n > 1) as n, count(*) as d from {groups})"""


def _rule_sql(metric: str, table: str, rule: str) -> str:
    return f"""
        select '{metric}' as metric_name, n as numerator, d as denominator,
               {pct('n', 'd')} as pct
        from (select count(*) filter ({rule}) as n, count(*) as d from {table})"""


RATIO_SUM = "raw_material_ratio + flavour_ratio + ingredient_ratio"
RATIO_BOUNDS = " or ".join(
    f"{kind}_ratio not between 0 and 1" for kind in COMPONENTS
)
PROFILE = f"""(
    select recipe_sk, batch_number, count(*) as n, count(distinct component_type) as kinds,
           {exact('component_ratio')} as total
    from fact_recipe_components group by all)"""

SILVER_METRICS = " union all ".join(
    [
        _repeated_sql(
            f"silver.{short}.duplicate_{nk}_batch", f"s_{entity}", nk
        )
        for short, entity, nk in (
            ("customers", "customers", "customer_id"),
            ("flavours", "flavours", "flavour_id"),
            ("ingredients", "ingredients", "ingredient_id"),
            ("sales", "sales_transactions", "transaction_id"),
        )
    ]
    + [
        _rule_sql("silver.recipes.ratio_out_of_bounds_rows", "s_recipes", RATIO_BOUNDS),
        _rule_sql(
            "silver.recipes.ratio_sum_not_one_rows",
            "s_recipes",
            f"{RATIO_SUM} not between 0.999 and 1.001",
        ),
        _rule_sql(
            "silver.sales.negative_amount_or_quantity_rows",
            "s_sales_transactions",
            "least(amount_dollars, quantity_liters) < 0",
        ),
        _rule_sql(
            "silver.ingredients.negative_weight_or_cost_rows",
            "s_ingredients",
            "least(weight_in_grams, cost_per_gram) < 0",
        ),
    ]
)
GOLD_METRICS = " union all ".join(
    [
        _repeated_sql(
            "gold.sales.duplicate_transaction_id_batch",
            "fact_sales_transactions",
            "transaction_id",
        ),
        _rule_sql("gold.recipes.not_exactly_3_components", PROFILE, "n <> 3 or kinds <> 3"),
        _rule_sql(
            "gold.recipes.ratio_sum_not_one", PROFILE, "total not between 0.999 and 1.001"
        ),
    ]
)


@register("silver_data_quality_metrics", SILVER_METRICS)
def _(spark, sf_dir):
    return metrics.silver_metrics(Silver(spark, sf_dir))


@register("gold_data_quality_metrics", GOLD_METRICS)
def _(spark, sf_dir):
    return metrics.gold_metrics(gold_of(spark, sf_dir))


@register(
    "duplicate_line_metric",
    f"""
    select 'lines' as metric_name, n as numerator, d as denominator, {pct('n', 'd')} as pct
    from (select count(*) filter (n > 1) as n, count(*) as d
          from (select count(*) as n from lineitem group by l_orderkey, l_linenumber))""",
)
def _(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    return metrics.key_and_row_metrics(lines, ("lines", ["l_orderkey", "l_linenumber"]))


@register(
    "share_of_priority",
    f"""
    select o_orderpriority, count(*) filter (o_orderstatus = 'F') as finished, count(*) as n,
           {pct("count(*) filter (o_orderstatus = 'F')", "count(*)")} as pct
    from orders group by o_orderpriority""",
)
def _(spark, sf_dir):
    counts = (
        read(spark, sf_dir, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
            F.count("*").alias("n"),
        )
    )
    return counts.withColumn("pct", percentage(F.col("finished"), F.col("n")))


# --- checks --------------------------------------------------------------------------------


@register(
    "check_tables_not_empty",
    " union all ".join(
        f"select '{e}' as table_name, count(*) filter (_load_id = '{SECOND_LOAD}') as row_count "
        f"from raw_{e} having row_count = 0"
        for e in ENTITIES
    ),
)
def _(spark, sf_dir):
    """The tables that the second load brought nothing for."""
    base = Base(spark, sf_dir)
    second = F.col("_load_id") == SECOND_LOAD
    return checks.empty_tables({e: raw_table(base, e).filter(second) for e in ENTITIES})


@register(
    "check_batch_present",
    " union all ".join(
        f"select '{e}' as table_name, count(*) as bad_rows from raw_{e} "
        "where batch_number is null or trim(batch_number) = '' having count(*) > 0"
        for e in ENTITIES
    ),
)
def _(spark, sf_dir):
    base = Base(spark, sf_dir)
    return checks.rows_without_version({e: raw_table(base, e) for e in ENTITIES})


def _register_unique(entity: str, nk: str) -> None:
    @register(
        f"check_unique_{entity}",
        f"select {nk}, batch_number, count(*) as cnt from s_{entity} "
        "group by all having count(*) > 1",
    )
    def _(spark, sf_dir):
        return checks.repeated_keys(Silver(spark, sf_dir)[entity], [nk, VERSION])


for _entity, _nk in suite.NATURAL_KEYS.items():
    _register_unique(_entity, _nk)

ROWS = "select * replace (cast(_ingested_at_utc as varchar) as _ingested_at_utc) from"


@register(
    "check_ingredients_non_negative",
    f"{ROWS} s_ingredients where least(weight_in_grams, cost_per_gram) < 0",
)
def _(spark, sf_dir):
    ingredients = Silver(spark, sf_dir)["ingredients"]
    return checks.negative_values(ingredients, "weight_in_grams", "cost_per_gram")


@register(
    "check_sales_non_negative",
    f"{ROWS} s_sales_transactions where least(amount_dollars, quantity_liters) < 0",
)
def _(spark, sf_dir):
    sales = Silver(spark, sf_dir)["sales_transactions"]
    return checks.negative_values(sales, "amount_dollars", "quantity_liters")


@register("check_ratio_bounds", f"{ROWS} s_recipes where {RATIO_BOUNDS}")
def _(spark, sf_dir):
    return checks.ratios_outside_bounds(Silver(spark, sf_dir)["recipes"])


@register(
    "check_ratios_sum_to_one",
    f"select recipe_id, batch_number, {RATIO_SUM} as ratio_sum from s_recipes "
    f"where {RATIO_SUM} not between 0.999 and 1.001",
)
def _(spark, sf_dir):
    return checks.ratio_sums_not_one(Silver(spark, sf_dir)["recipes"])


@register("check_yield_in_range", f'{ROWS} s_recipes where "yield" not between 0 and 100')
def _(spark, sf_dir):
    return checks.values_outside(Silver(spark, sf_dir)["recipes"], "yield", 0, 100)


@register(
    "check_unique_sales_in_gold",
    "select transaction_id, batch_number, count(*) as cnt from fact_sales_transactions "
    "group by all having count(*) > 1",
)
def _(spark, sf_dir):
    sales = gold_of(spark, sf_dir)["fact_sales_transactions"]
    return checks.repeated_keys(sales, ["transaction_id", VERSION])


@register(
    "check_recipe_ratio_sums",
    f"select recipe_sk, batch_number, {exact('component_ratio')} as ratio_sum "
    "from fact_recipe_components group by all having ratio_sum not between 0.999 and 1.001",
)
def _(spark, sf_dir):
    return checks.recipe_ratio_sums_not_one(gold_of(spark, sf_dir)["fact_recipe_components"])


@register(
    "check_country_coverage",
    " union all ".join(
        f"select '{entity}' as entity, {sk} as sk, t.batch_number from {table} t "
        f"anti join dim_country c on c.country_sk = t.{reference}"
        for entity, table, sk, reference in (
            ("customer", "dim_customer", "customer_sk", "country_sk"),
            ("provider", "dim_provider", "provider_sk", "country_sk"),
            ("sales", "fact_sales_transactions", "sales_txn_sk", "transaction_country_sk"),
        )
    ),
)
def _(spark, sf_dir):
    return checks.rows_without_country(gold_of(spark, sf_dir))


def _register_current(dim: str, nk: str) -> None:
    @register(
        f"check_one_current_{dim.removeprefix('dim_')}",
        f"select {nk} from {dim} group by {nk} having count(*) filter (is_current) <> 1",
    )
    def _(spark, sf_dir):
        return checks.keys_not_current_once(gold_of(spark, sf_dir)[dim], nk)


for _dim, _nk in suite.DIMENSION_KEYS.items():
    _register_current(_dim, _nk)


def _nulls_sql(layer: str, prefix: str, absent: str = "{} is null") -> str:
    return " union all ".join(
        f"select '{layer}.{table}.{name}.not_null' as check_name, "
        f"count(*) filter ({absent.format(oracle.quoted(name))}) as violations "
        f"from {prefix}{table}"
        for table, names in suite.NOT_NULL[layer].items()
        for name in names
    )


@register("check_not_null_bronze", _nulls_sql("bronze", "raw_", "coalesce(trim({}), '') = ''"))
def _(spark, sf_dir):
    base = Base(spark, sf_dir)
    return suite.null_report("bronze", {e: raw_table(base, e) for e in ENTITIES})


@register("check_not_null_silver", _nulls_sql("silver", "s_"))
def _(spark, sf_dir):
    return suite.null_report("silver", Silver(spark, sf_dir))


@register("check_not_null_gold", _nulls_sql("gold", ""))
def _(spark, sf_dir):
    return suite.null_report("gold", gold_of(spark, sf_dir))


@register(
    "check_unique_values",
    " union all ".join(
        f"select '{table}.{name}' as key, {name} as value, count(*) as n_records "
        f"from {table} where {name} is not null group by {name} having count(*) > 1"
        for table, names in suite.UNIQUE_KEYS.items()
        for name in names
    ),
)
def _(spark, sf_dir):
    rules = [r for r in suite.KEY_RULES if r.kind == checks.UNIQUE]
    found = checks.key_groups(gold_of(spark, sf_dir), rules)
    return found.select(F.col("name").alias("key"), "value", "n_records")


# Typed tables refer to each other by natural key, and some of these keys do not exist.
NATURAL_PARENTS = {
    ("ingredients", "provider_id"): "providers",
    ("recipes", "flavour_id"): "flavours",
    ("recipes", "raw_material_id"): "raw_materials",
    ("sales_transactions", "customer_id"): "customers",
    ("sales_transactions", "flavour_id"): "flavours",
}
REFERENCES = [
    *(checks.KeyRule(checks.PARENT, *child, parent) for child, parent in suite.PARENTS.items()),
    *(
        checks.KeyRule(checks.PARENT, f"s_{child}", name, (f"s_{parent}", name))
        for (child, name), parent in NATURAL_PARENTS.items()
    ),
]


class Misled(Mapping[str, DataFrame]):
    """The gold tables after a repair that went wrong: references whose key begins with a 0 are
    written backwards. The built tables have a parent for every key they hold."""

    def __init__(self, gold: Mapping[str, DataFrame]):
        self._gold = gold

    def __getitem__(self, table: str) -> DataFrame:
        return self._misled(table, self._gold[table])

    def columns(self, table: str, names: Sequence[str]) -> DataFrame:
        return self._misled(table, checks.columns_of(self._gold)(table, names))

    def _misled(self, table: str, df: DataFrame) -> DataFrame:
        for child, name in suite.PARENTS:
            if child == table and name in df.columns:
                wrong = F.when(F.col(name).startswith("0"), F.reverse(name))
                df = df.withColumn(name, wrong.otherwise(F.col(name)))
        return df

    def __iter__(self):
        return iter(self._gold)

    def __len__(self) -> int:
        return len(self._gold)


class Stacked(ChainMap):
    """Tables of several layers as one; each layer makes the columns it is asked for."""

    def columns(self, table: str, names: Sequence[str]) -> DataFrame:
        layer = next(layer for layer in self.maps if table in layer)
        return checks.columns_of(layer)(table, names)


def _reference_sql(rule: checks.KeyRule) -> str:
    parent, parent_name = rule.other
    key = f"cast({rule.column} as varchar)"
    if not rule.table.startswith("s_"):
        key = f"case when {key}[1] = '0' then reverse({key}) else {key} end"
    return (
        f"select '{rule.name}' as reference, value, count(*) as n_records "
        f"from (select {key} as value from {rule.table}) where value not in "
        f"(select cast({parent_name} as varchar) from {parent} where {parent_name} is not null) "
        "group by value"
    )


@register("check_relationships", " union all ".join(map(_reference_sql, REFERENCES)))
def _(spark, sf_dir):
    """Surrogate keys, some of them misled, and natural keys, some of which were never there."""
    gold = Misled(gold_of(spark, sf_dir))
    typed = {f"s_{entity}": df for entity, df in Silver(spark, sf_dir).items()}
    found = checks.key_groups(Stacked(typed, gold), REFERENCES)
    return found.select(F.col("name").alias("reference"), "value", "n_records")


@register(
    "check_accepted_values",
    "select value, count(*) as n_records from (select case when component_id % 97 = 0 "
    "then upper(component_type) else component_type end as value from fact_recipe_components) "
    f"where value not in {tuple(COMPONENTS)} group by value",
)
def _(spark, sf_dir):
    """Against the whole list; the labels of some components are misspelt here."""
    ((table, name), accepted), *_ = suite.ACCEPTED.items()
    kind = F.col(name)
    wrong = F.when(F.col("component_id") % 97 == 0, F.upper(kind)).otherwise(kind)
    components = gold_of(spark, sf_dir)[table].withColumn(name, wrong)
    return checks.unexpected_values(components, name, accepted)


# --- marts ---------------------------------------------------------------------------------

Mart = Callable[[Mapping[str, DataFrame]], DataFrame]
MARTS: dict[str, tuple[Mart, str]] = {
    "ingredients_per_provider": (
        marts.ingredients_per_provider,
        """
        select provider_name, ingredient_name, s.batch_number, s.weight_in_grams,
               s.cost_per_gram, stock_value_dollars
        from fact_provider_ingredient_stock s
        join dim_provider using (provider_sk) join dim_ingredient using (ingredient_sk)""",
    ),
    "stock_value_per_provider": (
        marts.stock_value_per_provider,
        f"""
        select provider_name, s.batch_number,
               {exact('stock_value_dollars')} as total_stock_value_dollars
        from fact_provider_ingredient_stock s join dim_provider using (provider_sk)
        group by provider_name, s.batch_number""",
    ),
    "recipe_constituents": (
        lambda gold: marts.recipe_constituents(gold, "R46-4", 4),
        """
        select recipe_id, batch_number, component_type, component_id, component_name,
               component_ratio
        from named_components where recipe_id = 'R46-4' and batch_number = 4""",
    ),
    "component_importance": (
        marts.component_importance,
        f"""
        select component_type, component_id, component_name,
               count(distinct recipe_sk) as recipes_using_component,
               {exact('component_ratio')} as total_ratio_contribution
        from named_components group by component_type, component_id, component_name
        order by total_ratio_contribution desc, recipes_using_component desc, component_type,
                 component_id, component_name nulls last limit 50""",
    ),
    "recipes_using_component": (
        lambda gold: marts.recipes_using(gold, 3, "raw_material", 78),
        """
        select distinct recipe_id from named_components
        where batch_number = 3 and component_type = 'raw_material' and component_id = 78""",
    ),
    "top_customers": (
        marts.top_customers,
        f"""
        select customer_name, {exact('amount_dollars')} as total_sales_usd
        from fact_sales_transactions join dim_customer using (customer_sk)
        group by customer_name order by total_sales_usd desc, customer_name nulls last
        limit 20""",
    ),
    "top_flavours": (
        marts.top_flavours,
        f"""
        select flavour_name, {exact('amount_dollars')} as total_sales_usd,
               count(*) as transaction_count
        from fact_sales_transactions join dim_flavour using (flavour_sk)
        group by flavour_name
        order by total_sales_usd desc, transaction_count desc, flavour_name nulls last
        limit 20""",
    ),
    "flavour_history": (
        lambda gold: marts.flavour_history(gold, 21),
        """
        select flavour_id, batch_number, flavour_name, flavour_description, valid_from_batch,
               valid_to_batch, is_current
        from dim_flavour where flavour_id = 21""",
    ),
    "changed_descriptions": (
        marts.changed_descriptions,
        """
        select flavour_id, batch_number, flavour_name, flavour_description from dim_flavour
        where flavour_id in (select flavour_id from dim_flavour group by flavour_id
                             having count(distinct flavour_description) > 1)""",
    ),
    "top_countries": (
        marts.top_countries,
        f"""
        select country_name, {exact('amount_dollars')} as total_sales_usd
        from fact_sales_transactions
        join dim_country on country_sk = transaction_country_sk
        group by country_name order by total_sales_usd desc, country_name limit 20""",
    ),
    "country_coverage": (
        marts.country_coverage,
        """
        select entity, country_name, count(*) as entity_rows
        from (select 'customers' as entity, country_sk from dim_customer
              union all select 'providers', country_sk from dim_provider)
        join dim_country using (country_sk) group by entity, country_name""",
    ),
    "recipes_without_three_components": (
        marts.recipes_without_three_components,
        """
        select recipe_id, batch_number, count(*) as component_rows,
               count(distinct component_type) as component_types
        from named_components group by recipe_id, batch_number
        having component_rows <> 3 or component_types <> 3
        order by component_rows desc, recipe_id, batch_number limit 50""",
    ),
    "recipes_with_odd_ratio_sum": (
        marts.recipes_with_odd_ratio_sum,
        f"""
        select recipe_id, batch_number, total as ratio_sum
        from (select recipe_id, batch_number, {exact('component_ratio')} as total
              from named_components group by recipe_id, batch_number)
        where total not between 0.999 and 1.001
        order by abs(total - 1) desc, recipe_id, batch_number limit 50""",
    ),
    "country_gaps": (
        marts.country_gaps,
        """
        select entity, natural_id, batch_number
        from (select 'customer' as entity, customer_id as natural_id, * from dim_customer
              union all by name
              select 'provider' as entity, provider_id as natural_id, * from dim_provider)
        anti join dim_country using (country_sk)""",
    ),
    "sales_country_gaps": (
        marts.sales_country_gaps,
        """
        select transaction_id, batch_number, transaction_date, transaction_town, postal_code
        from fact_sales_transactions where transaction_country_sk is null
        order by transaction_id, batch_number, transaction_date, transaction_town, postal_code
        limit 50""",
    ),
}


ORDERS = {
    "ingredients_per_provider": "provider_name ingredient_name batch_number weight_in_grams",
    "stock_value_per_provider": "-total_stock_value_dollars provider_name batch_number",
    "recipe_constituents": "component_type component_id component_ratio",
    "component_importance": "-total_ratio_contribution -recipes_using_component component_type "
    "component_id component_name",
    "recipes_using_component": "recipe_id",
    "top_customers": "-total_sales_usd customer_name",
    "top_flavours": "-total_sales_usd -transaction_count flavour_name",
    "flavour_history": "batch_number",
    "changed_descriptions": "flavour_id batch_number",
    "top_countries": "-total_sales_usd country_name",
    "country_coverage": "entity country_name",
    "recipes_without_three_components": "-component_rows recipe_id batch_number",
    "country_gaps": "entity batch_number natural_id",
    "sales_country_gaps": "transaction_id batch_number",
}


def _register_mart(name: str, mart: Mart, sql: str) -> None:
    @register(f"mart_{name}", sql, ORDERS.get(name, ""))
    def _(spark, sf_dir):
        return mart(gold_of(spark, sf_dir))


for _name, (_mart, _sql) in MARTS.items():
    _register_mart(_name, _mart, _sql)


@register("mart_metric_report", f"{SILVER_METRICS} union all {GOLD_METRICS}", "metric_name")
def _(spark, sf_dir):
    silver = metrics.silver_metrics(Silver(spark, sf_dir))
    gold = metrics.gold_metrics(gold_of(spark, sf_dir))
    return marts.metric_report(silver.unionByName(gold))


# --- the written warehouse -----------------------------------------------------------------

# Sales were loaded three times into it.
THRICE_SOLD = f"""
    select country_name, {exact('amount_dollars', 3)} as total_sales_usd
    from fact_sales_transactions join dim_country on country_sk = transaction_country_sk
    group by country_name order by total_sales_usd desc, country_name limit 20"""


@register("rebuilt_top_countries", THRICE_SOLD)
def _(spark, sf_dir):
    warehouse = rebuilt_warehouse(spark, sf_dir)
    return marts.top_countries(rebuild.read_gold(warehouse))


@register(
    "rebuilt_view_of_customers",
    "select country_name, count(*) as versions, count(*) filter (is_current) as current_rows "
    "from dim_customer left join dim_country using (country_sk) group by country_name",
)
def _(spark, sf_dir):
    warehouse = rebuilt_warehouse(spark, sf_dir)
    for table in ("dim_customer", "dim_country"):
        warehouse.expose("gold", table, GOLD_SCHEMAS[table])
    return spark.sql(
        "select country_name, count(*) as versions, count_if(is_current) as current_rows "
        "from gold_dim_customer left join gold_dim_country using (country_sk) "
        "group by country_name"
    )


# As the written tables were: an empty field of a CSV file is null, and sales came three times.
WRITTEN = {
    f"raw_{entity}": " union all ".join(
        [
            "select * replace (nullif(batch_number, '') as batch_number) "
            f"from ({raw_sql(entity)})"
        ]
        * LOADED.count(entity)
    )
    for entity in ENTITIES
}


@register(
    "rebuilt_check_report",
    report_sql(RATIO_BOUNDS, RATIO_SUM, PROFILE),
    **WRITTEN,
)
def _(spark, sf_dir):
    warehouse = rebuilt_warehouse(spark, sf_dir)
    layers = {
        "bronze": rebuild.read_bronze(warehouse),
        "silver": rebuild.read_silver(warehouse),
        "gold": rebuild.read_gold(warehouse),
    }
    return reduce(
        DataFrame.unionByName, [suite.report(layer, tables) for layer, tables in layers.items()]
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text to top customers: conform, version the dimensions, resolve the fact, rank."""
    return QUERIES["mart_top_customers"].run(spark, sf_dir)
