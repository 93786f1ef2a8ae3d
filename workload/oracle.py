"""Oracle SQL for DuckDB, assembled from named steps.

Each step states the expected result in its own way (casts, try_strptime, QUALIFY, ASOF JOIN),
not in the way the library computes it.
"""

from __future__ import annotations

import re

from lotbook.functions.keys import NULL_TEXT
from lotbook.plans.entities import COMPONENTS, DAY, ENTITIES, LINEAGE, TEXT, WHOLE
from workload.raw import LOADS, raw_sql

DATE_FORMS = ("%Y-%m-%d", "%d-%b-%y", "%m/%d/%y", "%d/%m/%Y", "%m/%d/%Y")


def key(*columns: str) -> str:
    texts = [f"coalesce(cast({c} as varchar), '{NULL_TEXT}')" for c in columns]
    return "md5(" + " || '|' || ".join(texts) + ")"


def date(column: str) -> str:
    return "coalesce(" + ", ".join(
        f"cast(try_strptime({column}, '{form}') as date)" for form in DATE_FORMS
    ) + ")"


def quoted(name: str) -> str:
    return f'"{name}"'


def exact(column: str, times: int = 1) -> str:
    """The DOUBLE nearest to the true sum: the values are whole multiples of 2^-64, which sum
    without loss, and the text of the sum is read back with one rounding."""
    whole = f"{times} * sum(cast({column} * {1 << 64}::double as hugeint))"
    return f"cast(cast({whole} as varchar) as double) / {1 << 64}::double"


def pct(numerator: str, denominator: str) -> str:
    return f"round(cast(100 as double) * {numerator} / nullif({denominator}, 0), 6)"


def _silver(entity: str) -> str:
    columns = []
    for field in ENTITIES[entity]:
        blank = f"nullif(trim(\"{field.raw}\"), '')"
        if field.kind == TEXT:
            value = blank
        elif field.kind == DAY:
            value = date(blank)
        else:
            value = f"cast({blank} as {'bigint' if field.kind == WHOLE else 'double'})"
        columns.append(f'{value} as "{field.typed}"')
    return f"select {', '.join(columns)}, {', '.join(LINEAGE)} from raw_{entity}"


def versions(
    source: str, sk: str, nk: str, attributes: list[str],
    version: str = "batch_number", newest: str = "_ingested_at_utc",
) -> str:
    ties = "".join(f", {a} desc nulls last" for a in attributes)
    return f"""
        select {key(nk, version)} as {sk}, {nk}, {version}, {', '.join(attributes)},
               {version} as valid_from_batch,
               lead({version}) over chain - 1 as valid_to_batch,
               lead({version}) over chain is null as is_current
        from (select * from {source} qualify 1 = row_number() over (
                partition by {nk}, {version} order by {newest} desc nulls last{ties}))
        window chain as (partition by {nk} order by {version} nulls last)"""


def _placed(entity: str) -> str:
    inner = versions(
        f"(select *, upper(trim(location_country)) as country_name from s_{entity}s)",
        f"{entity}_sk", f"{entity}_id",
        [f"{entity}_name", "location_city", "country_name", "generation_date"],
    )
    return f"""
        select v.* exclude (country_name), c.country_sk
        from ({inner}) v left join dim_country c using (country_name)"""


def _components() -> str:
    slots = " union all by name ".join(
        f"""select r.recipe_id, r.batch_number, r.generation_date, '{kind}' as component_type,
                   r.{kind}_id as component_id, d.{kind}_sk as component_sk,
                   r.{kind}_ratio as component_ratio
            from s_recipes r asof join {dim} d
              on r.{kind}_id = d.{kind}_id and r.batch_number >= d.batch_number"""
        for kind, dim in COMPONENTS.items()
    )
    own = key("recipe_sk", "component_type", "component_sk", "batch_number")
    return f"""
        select {own} as recipe_component_sk, recipe_sk, batch_number, component_type,
               component_id, component_sk, component_ratio, generation_date
        from (select slot.*, dim_recipe.recipe_sk from ({slots}) slot
              join dim_recipe using (recipe_id, batch_number))"""


def _named() -> str:
    joins = " ".join(
        f"left join {dim} n_{kind} on component_type = '{kind}' "
        f"and n_{kind}.{kind}_sk = component_sk"
        for kind, dim in COMPONENTS.items()
    )
    names = ", ".join(f"n_{kind}.{kind}_name" for kind in COMPONENTS)
    return f"""
        select f.*, coalesce({names}) as component_name, recipe_id
        from fact_recipe_components f join dim_recipe using (recipe_sk) {joins}"""


COUNTRY_SOURCES = (
    ("s_customers", "location_country"),
    ("s_providers", "location_country"),
    ("s_sales_transactions", "transaction_country"),
)

STEPS = (
    {f"raw_{entity}": raw_sql(entity) for entity in LOADS}
    | {f"s_{entity}": _silver(entity) for entity in LOADS}
    | {
        "dim_country": f"""
            select {key('country_name')} as country_sk, country_name
            from ({' union '.join(
                f'select upper({c}) as country_name from {t} where {c} is not null'
                for t, c in COUNTRY_SOURCES)})""",
        "dim_customer": _placed("customer"),
        "dim_provider": _placed("provider"),
        "dim_flavour": versions(
            "s_flavours", "flavour_sk", "flavour_id",
            ["flavour_name", "flavour_description", "generation_date"],
        ),
        "dim_raw_material": versions(
            "s_raw_materials", "raw_material_sk", "raw_material_id",
            ["raw_material_name", "generation_date"],
        ),
        "dim_ingredient": versions(
            "s_ingredients", "ingredient_sk", "ingredient_id",
            ["ingredient_name", "chemical_formula", "provider_id", "weight_in_grams",
             "cost_per_gram", "generation_date"],
        ),
        "dim_recipe": versions(
            '(select *, "yield" as yield_pct from s_recipes)', "recipe_sk", "recipe_id",
            ["heat_process", "yield_pct", "generation_date"],
        ),
        "fact_sales_transactions": f"""
            select {key('s.transaction_id', 's.batch_number')} as sales_txn_sk,
                   s.transaction_id, s.batch_number, c.customer_sk, f.flavour_sk,
                   n.country_sk as transaction_country_sk, s.transaction_date,
                   s.transaction_town, s.postal_code, s.quantity_liters, s.amount_dollars,
                   s.generation_date
            from s_sales_transactions s
            left join dim_customer c using (customer_id, batch_number)
            left join dim_flavour f using (flavour_id, batch_number)
            left join dim_country n on n.country_name = upper(s.transaction_country)""",
        "fact_provider_ingredient_stock": f"""
            select {key('s.ingredient_id', 's.provider_id', 's.batch_number')}
                     as provider_ingredient_stock_sk,
                   s.batch_number, i.ingredient_sk, p.provider_sk,
                   p.country_sk as provider_country_sk, s.weight_in_grams, s.cost_per_gram,
                   s.weight_in_grams * s.cost_per_gram as stock_value_dollars,
                   s.generation_date
            from s_ingredients s
            left join dim_ingredient i using (ingredient_id, batch_number)
            left join dim_provider p
              on p.provider_id = s.provider_id and p.batch_number = s.batch_number""",
        "fact_recipe_components": _components(),
        "named_components": _named(),
    }
)


def query(body: str, **changed: str) -> str:
    """Prefix a query with the steps it names, directly or through other steps."""
    needed: list[str] = []
    steps = STEPS | changed

    def visit(sql: str) -> None:
        for word in dict.fromkeys(re.findall(r"\w+", sql)):
            if word in steps and word not in needed:
                visit(steps[word])
                needed.append(word)

    visit(body)
    prefix = ", ".join(f"{name} as ({steps[name]})" for name in needed)
    return f"with {prefix} {body}" if needed else body
