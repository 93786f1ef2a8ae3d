from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from lotbook.functions import blank_to_null, fold, parse_date, percentage, surrogate_key, table_name
from lotbook.plans.conform import conform
from lotbook.plans.entities import ENTITIES, bronze_schema

DATES = {
    "2024-05-08": date(2024, 5, 8),
    "2024-5-8": date(2024, 5, 8),
    "7-May-24": date(2024, 5, 7),
    "07-MAY-24": date(2024, 5, 7),
    "5/5/24": date(2024, 5, 5),
    " 5/5/24 ": date(2024, 5, 5),
    "08/05/2024": date(2024, 5, 8),
    "05/13/2024": date(2024, 5, 13),
    "5/5/70": date(1970, 5, 5),
    "31/02/2024": None,
    "7-May-2024": None,
    "2024-05-08 10:00:00": None,
    "bad": None,
    None: None,
}

ODD_DATES = [
    "24-5-8", "0024-5-8", "5/5/4", "5/5/124", "13/5/24", "13/5/2024", "7-may-2024", "7-Mayy-24",
    " 5 / 5 / 24", "2024-05-08T00:00", "2024/05/08", "7-May-4", "12345-05-08", "224-5-8",
    "5/13/224", "008/05/2024", "-5/5/24", "+5/5/24", "7-May-69", "7-May-68", "29/02/2023",
    "2/29/23", "2/29/24", "29-Feb-72", "30-Feb-24", "2024-02-30", "\t5/5/24", "5/5/24\n",
    "5/5/02024", "7-aym-24", "7-xyz-24", "2024", "2024-05", "", "0/5/24", "5/0/2024", "1-Jan-00",
    "31-Dec-99", "12/31/99", "1/2/3", "7-JUN-5", "2024-13-01", "2024-12-00", "7--24", "//",
]


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def in_order(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_blank_to_null(spark):
    df = one_column(spark, ["  ab ", "   ", "", None, "\t"])
    assert in_order(df, blank_to_null("v")) == ["ab", None, None, None, "\t"]


def test_fold(spark):
    df = one_column(spark, [" United kingdom ", None])
    assert in_order(df, fold(F.col("v"))) == ["UNITED KINGDOM", None]


def test_parse_date(spark):
    df = one_column(spark, list(DATES))
    assert in_order(df, parse_date("v")) == list(DATES.values())


def test_parse_date_agrees_with_format_by_format_parsing(spark):
    texts = [t for t in DATES if t] + ODD_DATES
    ours = in_order(one_column(spark, texts), parse_date("v").cast("string"))
    forms = ["%Y-%m-%d", "%d-%b-%y", "%m/%d/%y", "%d/%m/%Y", "%m/%d/%Y"]
    tries = ", ".join(f"try_strptime(t, '{f}')::date" for f in forms)
    con = duckdb.connect()
    expected = [
        con.execute(f"select coalesce({tries})::varchar from (select ? as t)", [t]).fetchone()[0]
        for t in texts
    ]
    assert dict(zip(texts, ours)) == dict(zip(texts, expected))


@pytest.mark.parametrize("entity", ENTITIES)
def test_typing_a_table_is_compiled(spark, tmp_path, entity):
    """The JVM interprets methods of more than 8,000 bytes."""
    spark.createDataFrame([], bronze_schema(entity)).write.parquet(f"{tmp_path}/t")
    typed = conform(spark.read.parquet(f"{tmp_path}/t"), entity)
    stages = typed._jdf.queryExecution().debug().codegenToSeq()
    assert stages.size() == 1 and 0 < stages.apply(0)._3().maxMethodCodeSize() < 8000


def test_surrogate_key(spark):
    df = spark.createDataFrame([(1, None)], "a bigint, b string")
    assert df.select(surrogate_key("a", "b")).first()[0] == "77ada0e2dd6174c9e2c06b767e300d58"


def test_surrogate_key_is_typed_text(spark):
    df = spark.createDataFrame([(7, "x")], "a bigint, b string")
    key = duckdb.connect().execute("select md5('7|x')").fetchone()[0]
    assert df.select(surrogate_key("a", "b")).first()[0] == key


def test_percentage(spark):
    df = spark.createDataFrame([(0, 1, 3), (1, 0, 0), (2, 2, 3)], "i int, n bigint, d bigint")
    assert in_order(df, percentage(F.col("n"), F.col("d"))) == [33.333333, None, 66.666667]


def test_table_name(spark):
    names = ["My File-1.CSV", "2024 sales.csv", "sales__transactions.csv", " a.csv.csv "]
    df = one_column(spark, names)
    expected = ["my_file_1", "t_2024_sales", "sales_transactions", "a_csv"]
    assert in_order(df, table_name(F.col("v"))) == expected


def test_table_name_refuses_empty(spark):
    with pytest.raises(Exception, match="no table name"):
        in_order(one_column(spark, ["__.csv"]), table_name(F.col("v")))
