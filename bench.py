"""Benchmark: the warehouse from raw drops to answers, step by step, and the hard operators.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The layers are built and written once, each step timed; the answers then read the written
tables. Operators over the driver's tables and the answers are run once to warm up and then
timed as the median of BENCH_RUNS runs into a sink that discards rows. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time
from collections.abc import Callable
from contextlib import redirect_stdout
from io import StringIO

from pyspark.sql import DataFrame

from lotbook.plans import marts, rebuild
from lotbook.plans.entities import ENTITIES
from lotbook.session import scratch, spark_session
from lotbook.sources import Warehouse, load_raw
from workload.raw import Base, raw_table
from workload.registry import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

OPERATORS = [
    "parse_date_forms",
    "hashed_keys",
    "latest_event_per_day",
    "user_versions",
    "user_versions_sliced",
    "exact_lookup",
    "asof_lookup",
    "asof_lookup_sliced",
    "component_slots",
    "duplicate_line_metric",
]
ANSWERS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "ingredients_per_provider": marts.ingredients_per_provider,
    "stock_value_per_provider": marts.stock_value_per_provider,
    "recipe_constituents": lambda gold: marts.recipe_constituents(gold, "R46-4", 4),
    "component_importance": marts.component_importance,
    "recipes_using": lambda gold: marts.recipes_using(gold, 3, "raw_material", 78),
    "top_customers": marts.top_customers,
    "top_flavours": marts.top_flavours,
    "top_countries": marts.top_countries,
    "changed_descriptions": marts.changed_descriptions,
    "country_coverage": marts.country_coverage,
    "recipes_without_three_components": marts.recipes_without_three_components,
    "recipes_with_odd_ratio_sum": marts.recipes_with_odd_ratio_sum,
    "sales_country_gaps": marts.sales_country_gaps,
}


def main() -> None:
    spark = spark_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            # The test files are small: let one file feed every core.
            "spark.sql.files.openCostInBytes": "131072",
            "spark.sql.files.minPartitionNum": CPUS,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    exchanges: dict[str, int] = {}

    def timed(name: str, step: Callable[[], object]) -> None:
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)

    def repeated(name: str, make: Callable[[], DataFrame]) -> None:
        def run() -> float:
            start = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

        run()
        seconds[name] = round(statistics.median(run() for _ in range(RUNS)), 3)
        plan = StringIO()
        with redirect_stdout(plan):
            make().explain()
        exchanges[name] = len(re.findall(r"\bExchange ", plan.getvalue()))

    root = scratch(spark, "bench")
    warehouse = Warehouse(spark, f"{root}/warehouse")
    base = Base(spark, SF_DIR)
    for entity, fields in ENTITIES.items():
        raw_table(base, entity).select(*(field.raw for field in fields)).write.csv(
            f"{root}/drops/{entity}.csv",
            header=True,
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    timed("load_raw", lambda: load_raw(spark, f"{root}/drops/*.csv", warehouse))
    timed("rebuild_silver", lambda: rebuild.rebuild_silver(warehouse))
    timed("rebuild_gold", lambda: rebuild.rebuild_gold(warehouse))
    gold = rebuild.read_gold(warehouse)
    for name, answer in ANSWERS.items():
        repeated(f"mart_{name}", lambda answer=answer: answer(gold))
    for name in OPERATORS:
        repeated(name, lambda name=name: QUERIES[name].run(spark, SF_DIR))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "exchanges": exchanges,
                "sf": float(re.search(r"sf([0-9.]+)", SF_DIR).group(1)),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
