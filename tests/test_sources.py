"""Files in and out, header map, tolerant typing."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesweft.operators import ingest, quality, rollups, selection
from salesweft.plans import catalogue, offline
from salesweft.session import written
from salesweft.sources import order_files, sales_files, schemas

HEADER = ",".join(sales_files.COLUMN_NAMES)


def sales_line(day, sales, orders="2", category="毛衣", extra=""):
    return f"S1,上海,门店,女性,20-29,{category},3,{sales},{orders},4,10,5,6,{day},周一{extra}"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "2023_sales.csv").write_text(
        f"{HEADER},备注\n" + sales_line("2023年3月5日", "100.5", extra=",x") + "\n"
        + sales_line("never", "bad", extra=",y") + "\n", encoding="utf-8",
    )
    (tmp_path / "2025_sales.csv").write_text(
        HEADER + "\n" + sales_line("2025年12月31日", "", category="") + "\n", encoding="utf-8"
    )
    return str(tmp_path)


def test_sales_files(spark, folder):
    rows = {r["year"]: r for r in sales_files.read_all_years(spark, folder).collect()}
    assert set(rows) == {2023, 2025, None}
    assert rows[2023]["order_date"] == dt.date(2023, 3, 5) and rows[2023]["season"] == "春季"
    assert rows[2023]["sales_amount"] == 100.5 and rows[2023]["备注"] == "x"
    # Unreadable date: null parts, winter; unreadable or missing numbers: 0.
    assert rows[None]["season"] == "冬季" and rows[None]["sales_amount"] == 0.0
    assert rows[2025]["sales_amount"] == 0.0 and rows[2025]["category"] is None


def test_no_sales_files(spark, tmp_path):
    assert sales_files.read_all_years(spark, str(tmp_path)) is None


def test_display_headers(spark, folder):
    df = sales_files.read_sales_file(spark, f"{folder}/2023_sales.csv")
    assert "门店所在城市" in sales_files.to_headers(df).columns


def test_year_table_is_pruned(spark, folder, tmp_path):
    path = str(tmp_path / "fact")
    sales_files.write_sales_table(sales_files.read_all_years(spark, folder), path)
    one = sales_files.read_sales_year(spark, path, 2023)
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_rollup_drops_missing_keys_and_sums_counts(spark, folder):
    df = sales_files.read_all_years(spark, folder)
    rows = rollups.sales_by_category(df).collect()
    assert [(r["category"], r["orders"], r["avg_price"]) for r in rows] == [("毛衣", 4, 25.12)]
    assert rollups.sales_by_date(df).count() == 2


def test_summary_of_nothing_is_zero(spark, folder):
    empty = sales_files.read_all_years(spark, folder).where("false")
    assert tuple(rollups.sales_summary(empty).first()) == (0, 0.0, 0, 0.0, 0.0)
    assert rollups.yearly_summary(empty).count() == 0
    assert rollups.overview(empty).where("section <> 'total'").count() == 0


def test_filters(spark, folder):
    df = sales_files.read_all_years(spark, folder)
    assert selection.filter_sales(df).count() == 3
    assert selection.filter_sales(df, year=0).count() == 3
    assert selection.filter_sales(df, year=2023, category="毛衣", city="上海").count() == 1
    assert selection.filter_sales(df.drop("year"), year=2025).count() == 1
    assert selection.distinct_values(df, "nothing").count() == 0
    options = {(r["field"], r["value"]) for r in selection.filter_options(df, ["category", "year"]).collect()}
    assert options == {("category", "毛衣"), ("year", "2023"), ("year", "2025")}


def order(**changes):
    base = {
        "Order_ID": "O1", "Region": "Shanghai", "Order_Date": "2024-03-15", "Season": "Spring",
        "Category": "Coat", "Product_Code": "P1", "Quantity": 2, "Unit_Price": 99.0, "Total_Amount": 198.0,
    }
    return {k: v for k, v in {**base, **changes}.items() if v is not None}


@pytest.fixture
def deliveries(tmp_path):
    pos = [
        order(), order(Order_ID="O2", Quantity=None), order(Order_ID="O3", Quantity=0),
        order(Order_ID="O4", Unit_Price=-1), order(Order_ID="O5", Region=""), order(Order_ID="O6", Quantity="many"),
    ]
    (tmp_path / "pos.json").write_text(json.dumps(pos))
    lines = ["Order_ID,Region,Order_Date,Season,Category,Product_Code,Quantity,Unit_Price,Total_Amount"]
    lines += ["O1,Beijing,2024-04-01,Spring,Coat,P1,1,10,10", "O7,Beijing,soon,Spring,Bags,P2,500,10,20"]
    (tmp_path / "app.csv").write_text("\n".join(lines))
    return [("POS", str(tmp_path / "pos.json")), ("APP", str(tmp_path / "app.csv")),
            ("FAX", str(tmp_path / "pos.json")), ("ERP", str(tmp_path / "missing.json"))]


def test_offline_chain(spark, deliveries, tmp_path):
    result = offline.ingest_files(spark, deliveries, str(tmp_path / "raw"), json_array=True)
    stats = {r["source"]: (r["total"], r["valid"], r["invalid"]) for r in result.stats.collect()}
    assert stats == {"POS": (6, 2, 4), "APP": (2, 2, 0), "FAX": (6, 0, 6), "ALL": (14, 4, 10)}
    assert {(r["source"], r["reason"]) for r in result.refused.collect()} == {("ERP", "Missing file"), ("FAX", "Unknown source type: FAX")}
    stored = spark.read.json(result.rejected_path)
    assert {r["reject_reason"] for r in stored.where("Source = 'FAX'").collect()} == {"Unknown source type: FAX"}
    rejected = {r["Order_ID"]: r["reject_reason"] for r in stored.where("Source <> 'FAX'").collect()}
    assert rejected == {
        "O3": "Quantity must be at least 1", "O4": "Unit_Price cannot be negative",
        "O5": "Missing required field: Region", "O6": "Unreadable number: Quantity",
    }
    again = offline.ingest_files(spark, deliveries, str(tmp_path / "raw"), json_array=True)
    assert spark.read.json(again.rejected_path).count() == 10
    report = offline.clean_files(spark, result.valid_path, str(tmp_path / "clean"), fmt="json", json_array=False)
    facts = {(r["metric"], r["field"]): r["value"] for r in report.collect()}
    assert facts[("total_records", "")] == 4 and facts[("duplicates", "")] == 1
    assert facts[("valid_records", "")] == 3 and facts[("outliers", "Quantity")] == 1
    cleaned = {r["Order_ID"]: r for r in order_files.read_cleaned_tree(spark, str(tmp_path / "clean" / "orders")).collect()}
    assert cleaned["O2"]["Quantity"] == 1 and cleaned["O7"]["Order_Date"] is None
    # 500 is out of bounds and becomes the median of 2, 1 and 1.
    assert cleaned["O7"]["Quantity"] == 1.0 and cleaned["O1"]["Size"] == "Unknown"
    groups = {
        r["dimension"]: r["groups"]
        for r in offline.roll_up_files(spark, str(tmp_path / "clean" / "orders"), str(tmp_path / "agg")).collect()
    }
    assert groups["Category"] == 2 and groups["Date"] <= 2 and groups["Season_Category"] == 2
    assert spark.read.json(str(tmp_path / "agg")).where("dimension = 'Category'").count() == 2


def test_null_fields_left_out(spark, tmp_path):
    path = str(tmp_path / "raw")
    order_files.write_raw_orders(spark.createDataFrame([("a", None)], "Order_ID string, Color string"), path)
    text = spark.read.text(path).first()[0]
    assert json.loads(text) == {"Order_ID": "a"}


def test_results_of_an_ingest_are_compressed(spark, tmp_path):
    rows = [{"Order_ID": f"O{i}", "Region": "r", "Order_Date": "d", "Season": "s", "Category": "c", "Product_Code": "p", "Quantity": i % 2} for i in range(500)]
    (tmp_path / "o.json").write_text("\n".join(json.dumps(r) for r in rows))
    result = offline.ingest_files(spark, [("POS", str(tmp_path / "o.json"))], str(tmp_path / "out"))
    for path in (result.valid_path, result.rejected_path):
        files = [f for f in Path(path).iterdir() if f.name.startswith("part-")]
        assert files and all(f.name.endswith(".json.snappy") for f in files)
        assert spark.read.json(path).select("Order_ID").distinct().count() == 250


def test_large_methods_are_not_made(spark):
    session = spark.newSession()
    session.conf.unset("spark.sql.codegen.hugeMethodLimit")
    df = session.createDataFrame([("a", 1.0, 1)], "Order_ID string, Quantity double, input_position int")
    assert quality.clean_orders(df).count() == 1 and session.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    session.conf.set("spark.sql.codegen.hugeMethodLimit", "9000")
    quality.clean_orders(df)
    assert session.conf.get("spark.sql.codegen.hugeMethodLimit") == "9000"


def test_totals_of_files_are_hashed(spark):
    rows = [("csv", "O1", "x", 2, 1.0), ("csv", "O1", "y", None, -1.0), ("csv", None, "x", 3, None), ("csv", "O2", None, 1, -2.0), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "format string, Order_ID string, Product_Name string, Quantity long, Unit_Price double")
    totals = catalogue._file_totals(df, ["format"])
    assert sorted(map(tuple, totals.collect()), key=repr) == [("csv", 4, 2, 6, 2, "y"), (None, 1, 0, None, 0, None)]
    # Only the distinct names are sorted for their largest text.
    assert totals._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 3


def test_doubled_quotes_in_csv(spark, tmp_path):
    (tmp_path / "q.csv").write_text('Order_ID,Product_Name\nO1,"a ""b"", c"\n')
    assert order_files.read_orders(spark, str(tmp_path / "q.csv")).first()["Product_Name"] == 'a "b", c'


def test_unknown_format_is_rejected():
    with pytest.raises(ValueError):
        order_files.format_of("orders.xml")


def test_baskets_from_files(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps([
        {"Transaction_ID": "1", "Items": ["a", "b"]}, {"Transaction_ID": "2", "Items": []}, {"Transaction_ID": "3"},
    ]))
    (tmp_path / "b.csv").write_text('Transaction_ID,Items\n1,"a,b"\n2,c\n')
    assert [r["Items"] for r in order_files.read_baskets(spark, str(tmp_path / "b.json"), json_array=True).collect()] == [["a", "b"]]
    assert [r["Items"] for r in order_files.read_baskets(spark, str(tmp_path / "b.csv")).collect()] == [["a", "b"], ["c"]]


def test_schema_catalogue(spark):
    rows = schemas.describe_schemas(spark).collect()
    sizes = {}
    for r in rows:
        sizes[r["schema"]] = sizes.get(r["schema"], 0) + 1
    assert sizes == {"order": 20, "user_behavior": 10, "sales_timeseries": 6, "transaction_basket": 5, "regional_sales": 5}
    season = next(r for r in rows if r["schema"] == "order" and r["field"] == "Season")
    assert season["allowed"] == "Spring, Summer, Autumn, Winter" and season["required"]


def test_first_record_wins_in_file_order(spark, tmp_path):
    lines = ["Order_ID,Quantity"] + [f"{'A' if i % 3 else 'B'},{i}" for i in range(1, 200)]
    (tmp_path / "o.csv").write_text("\n".join(lines))
    df = order_files.with_input_position(order_files.read_order_text(spark, str(tmp_path / "o.csv")))
    first = {r["Order_ID"]: r["Quantity"] for r in quality.keep_first(df).collect()}
    assert first == {"A": "1", "B": "3"}


def test_hot_order_id_is_cut_before_the_shuffle(spark):
    df = spark.range(10000).selectExpr("concat('same', id % 1) AS Order_ID", "id AS input_position")
    plan = quality.keep_first(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    assert quality.keep_first(df).count() == 1


def _order_records(spark, rows):
    """Records with all required fields: id, name and position."""
    df = spark.createDataFrame(rows, "Order_ID string, Product_Name string, input_position long")
    return df.withColumns({c: F.lit("v") for c in ("Source", "Region", "Order_Date", "Season", "Category", "Product_Code")}).withColumn("Quantity", F.lit(1.0))


def test_cleaning_shuffles_no_whole_rows(spark, monkeypatch):
    made = []
    monkeypatch.setattr(selection, "written", lambda df, purpose: made.append(df) or written(df, purpose))
    cleaned = quality.clean_orders(_order_records(spark, [(f"O{i % 3}", "n", i) for i in range(9)]))
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan and cleaned.count() == 3
    # The choice of first records is cut per task before its shuffle and reads no other column.
    choice = made[0]._jdf.queryExecution().executedPlan().toString()
    assert choice.count("WindowGroupLimit") == 2 and "Product_Name" not in choice


@pytest.mark.parametrize("marked_rows", [1 << 27, 1, 7, 64, 100])
def test_first_records_come_from_every_slice(spark, monkeypatch, marked_rows):
    monkeypatch.setattr(selection, "MARKED_ROWS", marked_rows)
    n = 30 if marked_rows < 64 else 1000
    df = spark.range(n, numPartitions=3).select(
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("O"), F.col("id") % (n // 3))).alias("Order_ID"),
        F.nullif(F.concat(F.lit("n"), F.col("id")), F.lit("n4")).alias("Product_Name"), (-F.col("id")).alias("input_position"),
    )
    stored = written(df.withColumn("_row", F.monotonically_increasing_id()), "test")
    first = selection.first_stored_row_per_key(stored, "Order_ID", "input_position", "_row").drop("_row")
    assert sorted(map(tuple, first.collect()), key=repr) == sorted(map(tuple, quality.keep_first(df).collect()), key=repr)
    none = stored.where("false")
    assert selection.first_stored_row_per_key(none, "Order_ID", "input_position", "_row").count() == 0


def test_reasons_in_rule_order(spark):
    df = spark.createDataFrame(
        [(None, "POS", "0", -1.0), ("x", "POS", "0", -1.0), ("x", "POS", "1", -1.0), ("x", "TV", "1", 1.0)],
        "Order_ID string, Source string, Quantity string, Unit_Price double",
    ).withColumns({c: F.lit("v") for c in ("Region", "Order_Date", "Season", "Category", "Product_Code")})
    reasons = [r["reject_reason"] for r in ingest.validate(df).collect()]
    assert reasons == [
        "Missing required field: Order_ID", "Quantity must be at least 1",
        "Unit_Price cannot be negative", "Unknown source type: TV",
    ]
