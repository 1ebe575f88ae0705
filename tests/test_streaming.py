"""Drained streams against the batch result, restart and duplicates."""

import datetime as dt

from salesweft.operators import ingest
from salesweft.streaming import orders as S

COLUMNS = (
    "Order_ID string, Source string, Region string, Order_Date string, Season string, "
    "Category string, Product_Code string, Quantity string, Unit_Price double"
)


def order(i, source="POS", quantity="1", region="r"):
    return (f"O{i}", source, region, "2024-01-01", "s", "c", "p", quantity, 1.0)


def put(spark, path, rows):
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_over_many_files(spark, tmp_path):
    path = str(tmp_path / "in")
    for k in range(3):
        put(spark, path, [order(10 * k + i, "APP" if i % 3 else "POS", str(i % 4)) for i in range(10)])
    schema = spark.read.parquet(path).schema
    stream = S.file_stream(spark, path, schema, files_per_batch=1)
    batch = ingest.validate(spark.read.parquet(path))
    got = sorted(map(tuple, S.source_counts_now(stream).collect()))
    assert got == sorted(map(tuple, ingest.source_counts(batch).collect()))
    stored = S.ingest_now(S.file_stream(spark, path, schema, files_per_batch=1))
    assert stored.count() == 30
    assert stored.where("outcome = 'valid'").count() == ingest.valid_records(batch).count()


def test_restart_reads_only_new_files(spark, tmp_path):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    put(spark, path, [order(1), order(2, quantity="0")])
    schema = spark.read.parquet(path).schema
    for extra in ([], [order(3, region="")]):
        if extra:
            put(spark, path, extra)
        S.validated_ingest(S.file_stream(spark, path, schema), out, state).awaitTermination()
    stored = {r["Order_ID"]: r["reject_reason"] for r in spark.read.parquet(out).collect()}
    assert stored == {
        "O1": None, "O2": "Quantity must be at least 1", "O3": "Missing required field: Region",
    }


def test_repeats_across_batches_are_dropped(spark, tmp_path):
    path = str(tmp_path / "in")
    day = dt.datetime(2024, 1, 1)
    for k in range(2):
        rows = [("A", day), ("B", day + dt.timedelta(hours=k)), (f"C{k}", day)]
        spark.createDataFrame(rows, "Order_ID string, at timestamp").coalesce(1).write.mode("append").parquet(path)
    stream = S.file_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    seen = S.first_sightings_now(stream, "Order_ID", "at", "2 days")
    assert sorted(r["Order_ID"] for r in seen.collect()) == ["A", "B", "C0", "C1"]


def test_daily_rollup_keeps_open_days(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [(dt.datetime(2024, 1, 1, 5), 1.25), (dt.datetime(2024, 1, 1, 23), 2.0), (dt.datetime(2024, 1, 2), 4.0)]
    spark.createDataFrame(rows, "ts timestamp, value double").write.parquet(path)
    stream = S.file_stream(spark, path, spark.read.parquet(path).schema)
    got = sorted(map(tuple, S.daily_rollup_now(stream, "ts", "value").collect()))
    assert got == [("2024-01-01", 2, 3.25), ("2024-01-02", 1, 4.0)]


def test_running_counts_go_on_after_a_restart(spark, tmp_path):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    put(spark, path, [order(1), order(2, quantity="0")])
    schema = spark.read.parquet(path).schema
    for extra in ([], [order(3)], [order(4, "APP"), order(5, "APP", region="")]):
        if extra:
            put(spark, path, extra)
        S.source_counts(S.file_stream(spark, path, schema), out, state).awaitTermination()
    got = sorted(map(tuple, S.latest_snapshot(spark, out).collect()))
    assert got == sorted(map(tuple, ingest.source_counts(ingest.validate(spark.read.parquet(path))).collect()))
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("_slot")]) == 2


def test_sightings_remember_keys_after_a_restart(spark, tmp_path):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for k in range(2):
        rows = [("A", f"2024-01-0{k + 1}"), (f"B{k}", "2024-01-01"), (f"C{k}", "soon")]
        spark.createDataFrame(rows, "Order_ID string, Order_Date string").coalesce(1).write.mode("append").parquet(path)
        timed, undated = S.dated(S.file_stream(spark, path, spark.read.parquet(path).schema), "Order_Date", "at")
        S.sightings(timed, "Order_ID", "at", "7 days", out, state).awaitTermination()
        S.rejected(undated, out + "-rejected", state + "-rejected").awaitTermination()
    assert sorted(r["Order_ID"] for r in spark.read.parquet(out).collect()) == ["A", "B0", "B1"]
    refused = spark.read.parquet(out + "-rejected").collect()
    assert {(r["Order_ID"], r["reject_reason"]) for r in refused} == {("C0", "Unreadable Order_Date"), ("C1", "Unreadable Order_Date")}


def test_daily_totals_close_days_and_count_late_rows(spark, tmp_path):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    days = [[(1, 1.0), (1, 2.0), (2, 4.0)], [(9, 8.0)], [(1, 16.0), (9, 32.0)]]
    query = None
    for rows in days:
        frame = spark.createDataFrame([(dt.datetime(2024, 1, d), v) for d, v in rows], "ts timestamp, value double")
        frame.coalesce(1).write.mode("append").parquet(path)
        query = S.daily_totals(S.file_stream(spark, path, spark.read.parquet(path).schema), "ts", "value", out, state)
        query.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(out).drop("batch").collect()))
    assert got == [("2024-01-01", 2, 3.0), ("2024-01-02", 1, 4.0)]
    assert S.late_rows(query) == 1
