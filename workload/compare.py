"""Run every registered query and its oracle side by side.

    python -m workload.compare [sf_dir] [name part ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from lotbook.session import spark_session
from workload.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def later(row, following, order: tuple[str, ...]) -> bool:
    """Whether the row belongs behind the one that follows it. Nulls come last."""
    for column in order:
        name = column.removeprefix("-")
        a, b = row[name], following[name]
        if a != b:
            return a is None or b is not None and (a < b if column.startswith("-") else a > b)
    return False


def difference(spark, con, sf_dir: str, name: str) -> tuple[int, str]:
    """(rows, what differs); the comparison is exact and counts duplicates. Where the query says
    how its rows are ordered, they must come so."""
    query = QUERIES[name]
    df = query.run(spark, sf_dir)
    columns = sorted(df.columns)
    rows = df.collect()
    if query.order and any(map(later, rows, rows[1:], [query.order] * len(rows))):
        return len(rows), f"not in the order of {query.order}"
    ours = Counter(tuple(row[c] for c in columns) for row in rows)
    result = con.execute(query.sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return ours.total(), f"columns {columns} but {sorted(names)} expected"
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    if ours == theirs:
        return ours.total(), ""
    extra, missing = ours - theirs, theirs - ours
    return ours.total(), (
        f"{extra.total()} extra, {missing.total()} missing of {theirs.total()}: {columns} "
        f"{list(extra)[:2]} | {list(missing)[:2]}"
    )


def main(sf_dir: str = "/root/testdata/sf0.01", *parts: str) -> int:
    spark = spark_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                    "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in QUERIES:
        if parts and not any(part in name for part in parts):
            continue
        start = time.perf_counter()
        try:
            rows, found = difference(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            rows, found = -1, f"{type(error).__name__}: {str(error)[:1200]}"
        seconds = time.perf_counter() - start
        bad += bool(found)
        print(f"{'BAD' if found else 'ok ':4}{name:40}{rows:8} {seconds:6.2f}s {found}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    sys.exit(min(main(*sys.argv[1:]), 1))
