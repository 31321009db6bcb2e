import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from haulmetrics.plans import prep_queries
from haulmetrics.schema import CSV_COLUMNS
from haulmetrics.session import ensure_checkpoint_dir
from haulmetrics.sources import csv_lines, quality
from haulmetrics.sources.star import COLUMNS, order_lines


def write_csv(path):
    header = ["Order Id", "Customer City", "order date (DateOrders)", "Sales", "Days for shipping (real)", "Extra, col"]
    path.write_bytes((",".join(f'"{h}"' for h in header) + "\n"
                      "1,Málaga,1/31/2018 22:56,327.75,3,x\n"
                      "2,\"San, Juan\",12/1/2017 0:05,,5,\n").encode("latin-1"))


def test_csv_scan(spark, tmp_path):
    path = tmp_path / "lines.csv"
    write_csv(path)
    df = csv_lines.read_order_lines(spark, str(path))
    types = dict(df.dtypes)
    assert (types["order_id"], types["order_ts"], types["sales"], types["days_real"], types["Extra, col"]) == (
        "string", "timestamp_ntz", "double", "int", "string")
    rows = df.orderBy("order_id").collect()
    assert rows[0]["customer_city"] == "Málaga" and str(rows[0]["order_ts"]) == "2018-01-31 22:56:00"
    assert rows[1]["customer_city"] == "San, Juan" and rows[1]["sales"] is None
    assert "Order Id" in csv_lines.read_order_lines(spark, str(path), rename=False).columns


def test_bad_cells_are_an_error_or_reported(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("Order Id,Sales,Order Item Quantity,Benefit per order\n1,314.6400146,2,12345678901.5\n2,7.5,x,1\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_lines.read_order_lines(spark, str(path)).collect()
    rows = csv_lines.read_order_lines(spark, str(path), bad_cells="report").orderBy("order_id").collect()
    assert (rows[0]["sales"], rows[0]["benefit_per_order"], rows[0]["bad_record"]) == (314.6400146, 12345678901.5, None)
    assert (rows[1]["sales"], rows[1]["order_item_quantity"], rows[1]["bad_record"]) == (7.5, None, "2,7.5,x,1")


def test_declared_columns():
    assert len(CSV_COLUMNS) == 53


def test_missing_file(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)not.?exist|path"):
        csv_lines.read_order_lines(spark, str(tmp_path / "none.csv")).count()


def test_names_are_unique():
    assert len({n for _, n, _ in CSV_COLUMNS}) == len(CSV_COLUMNS)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2015, "a"), (2016, "b")], "order_year int, x string")
    csv_lines.write_table(df, str(tmp_path / "p"), partition_by=("order_year",))
    assert spark.read.parquet(str(tmp_path / "p")).where("order_year = 2016").first()["x"] == "b"
    csv_lines.write_table(df, str(tmp_path / "c"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["order_year", "x"]


def test_validation(spark):
    df = spark.createDataFrame([("1",), ("1",), ("2",)], "order_id string")
    found = quality.validate(df, ["order_id", "line_key"]).collect()
    assert {(r["check"], r["detail"]) for r in found} == {("missing_column", "line_key"),
                                                         ("duplicate_key", "1 repeated order_id values")}
    with pytest.raises(ValueError):
        quality.validate(df.limit(0))


def test_sample_is_repeatable(spark):
    df = spark.range(1000).selectExpr("CAST(id AS STRING) AS k")
    a = {r["k"] for r in quality.hash_sample(df, "k", 20).collect()}
    b = {r["k"] for r in quality.hash_sample(df.repartition(5), "k", 20).collect()}
    assert a == b and len(a) == 20


def test_pruned_joins_give_the_same_lines(spark, small):
    full = order_lines(spark, small, enforce_keys=True)
    assert full.columns == list(COLUMNS)
    for columns in (["line_key", "sales"], ["line_key", "customer_state"], ["line_key", "order_country", "category_name"]):
        pruned = order_lines(spark, small, columns)
        assert pruned.exceptAll(full.select(columns)).isEmpty() and pruned.count() == full.count()
    plan = order_lines(spark, small, ["sales"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_checkpoint_folder_comes_from_the_session(spark):
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir()


def test_orphaned_lines(spark, small, tmp_path):
    """Keys are taken as intact: a line without an order counts unless the joins are asked for."""
    for table in ("orders", "part", "customer", "supplier", "nation", "region"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{small}/{table}.parquet")
    lines = pq.read_table(f"{small}/lineitem.parquet").slice(0, 50)
    at = lines.schema.get_field_index("l_orderkey")
    orphan = lines.slice(0, 1).set_column(at, lines.schema.field(at), pa.array([-1], lines.schema.field(at).type))
    pq.write_table(pa.concat_tables([lines, orphan]), tmp_path / "lineitem.parquet")
    assert order_lines(spark, str(tmp_path), ["sales"]).count() == 51
    assert order_lines(spark, str(tmp_path), ["sales"], enforce_keys=True).count() == 50


def test_csv_scan_reads_compressed_files_of_bounded_length(spark, small, monkeypatch):
    monkeypatch.setattr(prep_queries, "_LINES_PER_FILE", 1_000)
    got = prep_queries.csv_scan(spark, small)
    files = got.inputFiles()
    assert len(files) >= 6 and all(f.endswith(".csv.gz") for f in files)
    assert got.count() == order_lines(spark, small, ["line_key"]).count()
