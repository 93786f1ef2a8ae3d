"""Violation queries: a check passes when its frame is empty."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotbook.functions import outside
from lotbook.plans.entities import VERSION
from lotbook.quality.metrics import (
    negative,
    odd_ratio_sums,
    ratio_sum,
    ratio_sum_not_one,
    ratios_out_of_bounds,
)

Tables = Mapping[str, DataFrame]


def empty_tables(tables: Tables) -> DataFrame:
    counts = _per_table(tables, F.count("*").alias("row_count"))
    return counts.filter(F.col("row_count") == 0)


def absent(name: str) -> Column:
    """Null, or text that is blank: raw tables hold text, where a blank is no value."""
    return F.nullif(F.trim(F.col(name).cast("string")), F.lit("")).isNull()


def rows_without_version(tables: Tables, version: str = VERSION) -> DataFrame:
    counts = _per_table(tables, F.count_if(absent(version)).alias("bad_rows"))
    return counts.filter(F.col("bad_rows") > 0)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("cnt")).filter(F.col("cnt") > 1)


def negative_values(df: DataFrame, *names: str) -> DataFrame:
    return df.filter(negative(*names))


def ratios_outside_bounds(recipes: DataFrame) -> DataFrame:
    return recipes.filter(ratios_out_of_bounds())


def ratio_sums_not_one(recipes: DataFrame) -> DataFrame:
    return recipes.filter(ratio_sum_not_one()).select(
        "recipe_id", VERSION, ratio_sum().alias("ratio_sum")
    )


def values_outside(df: DataFrame, name: str, low: float, high: float) -> DataFrame:
    return df.filter(outside(F.col(name), low, high))


def recipe_ratio_sums_not_one(components: DataFrame) -> DataFrame:
    return odd_ratio_sums(components)


def rows_without_country(gold: Tables) -> DataFrame:
    arms = [
        gold[table]
        .filter(F.col(country).isNull())
        .select(F.lit(entity).alias("entity"), F.col(sk).alias("sk"), VERSION)
        for entity, table, sk, country in (
            ("customer", "dim_customer", "customer_sk", "country_sk"),
            ("provider", "dim_provider", "provider_sk", "country_sk"),
            ("sales", "fact_sales_transactions", "sales_txn_sk", "transaction_country_sk"),
        )
    ]
    return reduce(DataFrame.unionByName, arms)


def null_rows(df: DataFrame, names: Sequence[str], blanks: bool = False) -> DataFrame:
    """(column_name, null_rows), a line per column, from one pass. With ``blanks``, blank text
    counts as null, as it should in raw tables."""
    missing = absent if blanks else lambda n: F.col(n).isNull()
    counts = df.agg(F.array(*(F.count_if(missing(n)) for n in names)).alias("counts"))
    lines = F.arrays_zip(
        F.array(*map(F.lit, names)).alias("column_name"), F.col("counts").alias("null_rows")
    )
    return counts.select(F.inline(lines).alias("column_name", "null_rows"))


def null_counts(df: DataFrame, names: Sequence[str], blanks: bool = False) -> DataFrame:
    """Columns that hold nulls and how many rows."""
    return null_rows(df, names, blanks).filter(F.col("null_rows") > 0)


# What a value of a key column says: a row holds it, or it is known elsewhere.
UNIQUE, PARENT, CURRENT = "unique", "parent", "current"
#: So many hex digits has a surrogate key: its bytes stand for the text, both ways.
HEX_DIGITS = 32


@dataclass(frozen=True)
class KeyRule:
    """A rule on the values of one column, broken per value.

    ``UNIQUE``: a value in more than one row. ``PARENT``: a value that ``other`` (table, column)
    does not hold; these two leave nulls alone. ``CURRENT``: a value, null among them, that not
    exactly one row with a true ``flag`` holds.
    """

    kind: str
    table: str
    column: str
    other: tuple[str, str] | None = None
    flag: str = "is_current"

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column}"


def key_groups(tables: Tables, rules: Sequence[KeyRule]) -> DataFrame:
    """(kind, name, value, n_records) of the values that break a rule, for all rules at once.

    Each table is read once: a row gives one mark per rule that its columns take part in, as child
    or as parent. Marks are counted per rule and value in the map tasks and meet in one exchange,
    so a hot value ships one row per task, and no reference needs a join of its own. A rule travels
    as its number, a hashed key as the bytes its hex digits spell. Tables that are plans are asked
    for the columns of the rules alone.
    """
    numbers: dict[tuple[str, str], int] = {}
    marks: dict[str, list[Column]] = {}
    names: dict[str, list[str]] = {}
    for rule in rules:
        at = numbers.setdefault((rule.kind, rule.name), len(numbers))
        counted = F.col(rule.flag) if rule.kind == CURRENT else F.lit(True)
        marks.setdefault(rule.table, []).append(_mark(at, rule.column, counted))
        names.setdefault(rule.table, []).append(rule.column)
        if rule.kind == CURRENT:
            names[rule.table].append(rule.flag)
        if rule.other:
            table, column = rule.other
            marks.setdefault(table, []).append(_mark(at, column, F.lit(False)))
            names.setdefault(table, []).append(column)
    take = columns_of(tables)
    arms = [
        take(table, list(dict.fromkeys(names[table]))).select(F.inline(F.array(*cells)))
        for table, cells in marks.items()
    ]
    told = F.array(
        *(F.struct(F.lit(k).alias("kind"), F.lit(name).alias("name")) for k, name in numbers)
    )
    current = [at for (k, _), at in numbers.items() if k == CURRENT]
    kind, n, others = F.col("_told.kind"), F.col("n_records"), F.col("_others")
    value = F.col("value")
    # Bytes of a hashed key, else null: 32 digits, none of them upper case.
    lower_hex = (F.octet_length(value) == HEX_DIGITS) & (F.lower(value) == value)
    packed = F.when(lower_hex, F.unhex(value))
    return (
        reduce(DataFrame.unionByName, arms)
        .filter(value.isNotNull() | F.col("rule").isin(current))
        # An even rule has text as it is, an odd one a key as its bytes.
        .select(
            (2 * F.col("rule") + packed.isNotNull().cast("int")).alias("rule"),
            F.coalesce(packed, value.cast("binary")).alias("value"),
            "counted",
        )
        .groupBy("rule", "value")
        .agg(
            F.count_if("counted").alias("n_records"),
            F.count_if(~F.col("counted")).alias("_others"),
        )
        .withColumn("_told", told[F.shiftright("rule", 1)])
        .filter(
            F.when(kind == UNIQUE, n > 1)
            .when(kind == PARENT, (n > 0) & (others == 0))
            .otherwise(n != 1)
        )
        .select(
            "_told.kind",
            "_told.name",
            F.when(F.col("rule").bitwiseAND(1) == 1, F.lower(F.hex("value")))
            .otherwise(value.cast("string"))
            .alias("value"),
            "n_records",
        )
    )


def columns_of(tables: Tables) -> Callable[[str, Sequence[str]], DataFrame]:
    """How to get some columns of a table: tables that are plans may leave the others unmade."""
    return getattr(tables, "columns", lambda table, names: tables[table])


def _mark(rule: int, column: str, counted: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        F.col(column).cast("string").alias("value"),
        F.coalesce(counted, F.lit(False)).alias("counted"),
    )


def repeated_values(df: DataFrame, name: str) -> DataFrame:
    """Values of one column in more than one row."""
    broken = key_groups({"": df}, [KeyRule(UNIQUE, "", name)])
    return broken.select(F.col("value").cast(df.schema[name].dataType).alias("value"), "n_records")


def orphan_keys(child: DataFrame, name: str, parent: DataFrame, parent_name: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows that hold them."""
    rule = KeyRule(PARENT, "child", name, ("parent", parent_name))
    broken = key_groups({"child": child, "parent": parent}, [rule])
    kind = child.schema[name].dataType
    return broken.select(F.col("value").cast(kind).alias("value"), "n_records")


def keys_not_current_once(dim: DataFrame, key: str) -> DataFrame:
    """Natural keys, null among them, with no current version or several."""
    broken = key_groups({"": dim}, [KeyRule(CURRENT, "", key)])
    return broken.select(F.col("value").cast(dim.schema[key].dataType).alias(key))


def unexpected_values(df: DataFrame, name: str, accepted: Sequence[str]) -> DataFrame:
    value = F.col(name)
    return (
        df.filter(~value.isin(*accepted))
        .groupBy(value.alias("value"))
        .agg(F.count("*").alias("n_records"))
    )


def _per_table(tables: Tables, count: Column) -> DataFrame:
    arms = [df.agg(count).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    rows = reduce(DataFrame.unionByName, arms)
    return rows.select("table_name", *(c for c in rows.columns if c != "table_name"))
