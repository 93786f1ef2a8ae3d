from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lotbook.functions import drop_path, source_name
from lotbook.plans.entities import bronze_schema
from lotbook.sources import Warehouse, load_raw, raw, raw_drops
from lotbook.sources.raw import read_log
from workload import registry

HEADER = "raw_material_id,name,generation_date,batch_number\n"


@pytest.fixture
def drops(tmp_path):
    folder = tmp_path / "drops"
    folder.mkdir()
    return folder


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"{tmp_path}/warehouse")


def materials(warehouse):
    return warehouse.read("bronze", "raw_materials", bronze_schema("raw_materials"))


def test_source_name(spark):
    paths = ["file:/a/My%20File%2B1+2.csv", "s3://b/sales.CSV/part-0-x.csv", "/a/b/c.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    out = df.select(source_name(F.col("p")), drop_path(F.col("p"))).collect()
    assert [tuple(r) for r in out] == [
        ("My File+1+2.csv", "file:/a/My File+1+2.csv"),
        ("sales.CSV", "s3://b/sales.CSV"),
        ("c.csv", "/a/b/c.csv"),
    ]


def test_load_keeps_text_and_adds_lineage(spark, drops, warehouse, rows):
    (drops / "Raw Materials.csv").write_text(HEADER + '1," a, ""b"" ",5/5/24,1\n2,,7-May-24,007\n')
    load_id = load_raw(spark, f"{drops}/*.csv", warehouse)
    df = materials(warehouse)
    assert rows(df.select("raw_material_id", "name", "generation_date", "batch_number")) == [
        ("1", ' a, "b" ', "5/5/24", "1"),
        ("2", None, "7-May-24", "007"),
    ]
    lineage = df.select("_source_file", "_load_id").distinct().collect()
    assert [tuple(r) for r in lineage] == [("Raw Materials.csv", load_id)]
    stamp = df.select("_ingested_at_utc").first()[0]
    assert stamp.microsecond == 0


def test_log_counts_each_drop(spark, drops, warehouse, rows):
    """Two files of one table, a folder of part files, an empty file, all in one load."""
    (drops / "raw_materials.csv").write_text(HEADER + "1,a,5/5/24,1\n")
    (drops / "RAW-materials.csv").write_text(HEADER + "2,b,5/5/24,1\n3,c,5/5/24,1\n")
    (drops / "raw  materials.csv").write_text(HEADER)
    parts = drops / "flavours.csv"
    parts.mkdir()
    for n in (1, 2):
        (parts / f"part-{n}.csv").write_text(
            "flavour_id,name,description,generation_date,batch_number\n" + f"{n},f,d,5/5/24,1\n"
        )
    load_id = load_raw(spark, f"{drops}/*.csv", warehouse)
    log = read_log(warehouse)
    assert rows(log.select("source_file", "target_table", "rows_loaded")) == [
        ("RAW-materials.csv", "bronze.raw_materials", 2),
        ("flavours.csv", "bronze.flavours", 2),
        ("raw  materials.csv", "bronze.raw_materials", 0),
        ("raw_materials.csv", "bronze.raw_materials", 1),
    ]
    assert rows(log.select("load_id").distinct()) == [(load_id,)]


def test_loads_append(spark, drops, warehouse):
    (drops / "raw_materials.csv").write_text(HEADER + "1,a,5/5/24,1\n")
    ids = {load_raw(spark, f"{drops}/*.csv", warehouse) for _ in range(2)}
    assert materials(warehouse).count() == 2
    assert {r[0] for r in materials(warehouse).select("_load_id").collect()} == ids
    assert [r[0] for r in read_log(warehouse).select("rows_loaded").collect()] == [1, 1]


def test_other_tables_take_the_header(spark, drops, warehouse, rows):
    (drops / "2024 extra.csv").write_text("a,b\n1,x\n")
    load_raw(spark, f"{drops}/*.csv", warehouse)
    df = warehouse.read("bronze", "t_2024_extra", "a string, b string")
    assert rows(df) == [("1", "x")]


def test_quoted_line_breaks(spark, drops, warehouse):
    (drops / "raw_materials.csv").write_text(HEADER + '1,"a\nb",5/5/24,1\n2,c,5/5/24,1\n')
    load_raw(spark, f"{drops}/*.csv", warehouse, multiline=True)
    assert {r[0] for r in materials(warehouse).select("name").collect()} == {"a\nb", "c"}


@pytest.mark.parametrize(
    "content",
    ["name,raw_material_id,generation_date,batch_number\na,1,5/5/24,1\n", HEADER + "1,a\n"],
)
def test_wrong_shape_fails(spark, drops, warehouse, content):
    (drops / "raw_materials.csv").write_text(content)
    with pytest.raises(Exception):
        load_raw(spark, f"{drops}/*.csv", warehouse)


def test_names_are_looked_up_per_file(spark, drops, warehouse, rows, monkeypatch):
    """Rows take their drop's name from a listing, and only a file that it lacks is taken apart."""
    (drops / "my raw+materials.csv").mkdir()
    for part in (1, 2):
        (drops / "my raw+materials.csv" / f"part-{part}.csv").write_text(HEADER + f"{part},a,,1\n")
    plans, append = [], Warehouse.append

    def spied(self, layer, table, df, *more, **named):
        if table != "_ingestion_log":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return append(self, layer, table, df, *more, **named)

    monkeypatch.setattr(Warehouse, "append", spied)
    load_raw(spark, f"{drops}/*.csv", warehouse)
    found = warehouse.read("bronze", "my_raw_materials", "raw_material_id string, _source_file string")
    assert rows(found) == [("1", "my raw+materials.csv"), ("2", "my raw+materials.csv")]
    top = plans[0].split("Relation")[0].splitlines()[0]
    assert "coalesce(_names_source" in top and "coalesce(_names_drop" in top


def test_a_file_after_the_listing_has_its_name(spark, drops, warehouse, rows, monkeypatch):
    """Such a file of a drop that is known is loaded and named like the others."""
    (drops / "raw_materials.csv").mkdir()
    (drops / "raw_materials.csv" / "part-1.csv").write_text(HEADER + "1,a,,1\n")
    listed = raw._files(spark, f"{drops}/*.csv").localCheckpoint()
    (drops / "raw_materials.csv" / "part-2.csv").write_text(HEADER + "2,a,,1\n")
    monkeypatch.setattr(raw, "_files", lambda *_: listed)
    load_raw(spark, f"{drops}/*.csv", warehouse)
    found = materials(warehouse).select("raw_material_id", "_source_file")
    assert rows(found) == [("1", "raw_materials.csv"), ("2", "raw_materials.csv")]
    assert read_log(warehouse).first()["rows_loaded"] == 2


def test_no_match_is_an_error(spark, drops):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        raw_drops(spark, f"{drops}/*.csv").collect()


def test_partitioned_table_keeps_types_and_order(spark, warehouse, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "batch_number bigint, v string")
    warehouse.replace("gold", "t", df, "batch_number")
    back = warehouse.expose("gold", "t", "batch_number bigint, v string")
    assert back.dtypes == [("batch_number", "bigint"), ("v", "string")]
    assert rows(spark.sql("select * from gold_t")) == rows(df)


def test_log_tells_drops_of_one_name_apart(spark, drops, warehouse, rows):
    for folder, n in (("a", 1), ("b", 2)):
        (drops / folder).mkdir()
        lines = "".join(f"{i},x,5/5/24,1\n" for i in range(n))
        (drops / folder / "raw_materials.csv").write_text(HEADER + lines)
    load_raw(spark, f"{drops}/*/*.csv", warehouse)
    assert rows(read_log(warehouse).select("source_file", "rows_loaded")) == [
        ("raw_materials.csv", 1),
        ("raw_materials.csv", 2),
    ]


def test_other_header_than_the_stored_one_fails(spark, drops, warehouse, rows):
    (drops / "extra.csv").write_text("p,q\n1,x\n")
    load_raw(spark, f"{drops}/*.csv", warehouse)
    load_raw(spark, f"{drops}/*.csv", warehouse)
    (drops / "extra.csv").write_text("p,r\n2,y\n")
    with pytest.raises(ValueError, match="extra holds"):
        load_raw(spark, f"{drops}/*.csv", warehouse)
    assert rows(warehouse.read("bronze", "extra", "p string, q string")) == [("1", "x")] * 2


def test_what_is_loaded_before_a_failure_is_logged(spark, drops, warehouse, rows):
    flavours = "flavour_id,name,description,generation_date,batch_number\n1,f,d,5/5/24,1\n"
    (drops / "a" ).mkdir()
    (drops / "a" / "flavours.csv").write_text(flavours)
    (drops / "b").mkdir()
    (drops / "b" / "raw_materials.csv").write_text(HEADER + "1,a\n")
    with pytest.raises(Exception):
        load_raw(spark, f"{drops}/*/*.csv", warehouse)
    assert rows(read_log(warehouse).select("source_file", "rows_loaded")) == [("flavours.csv", 1)]


def test_tables_are_packed_and_loaded_drops_are_gone(spark):
    """The drops of the derived raw tables are scratch data."""
    warehouse = registry.loaded_warehouse(spark, "/root/testdata/sf0.001")
    root = Path(warehouse.root)
    assert not (root.parent / "drops").exists()
    files = list((root / "bronze" / "recipes").rglob("*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)


def test_columns_finished_in_the_writing_tasks(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path))
    df = spark.range(9).selectExpr("id as a", "id % 2 as b")
    warehouse.replace("gold", "t", df, "b", lambda d: d.selectExpr("a", "md5(string(a)) as k", "b"))
    found = warehouse.read("gold", "t", "a bigint, k string, b bigint")
    assert rows(found) == rows(df.selectExpr("a", "md5(string(a)) as k", "b"))
