"""Laid-out fact, ingest ledger, kept roll-ups, keyed records, places in an order."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from salesweft.operators import baskets, ingest, rollups, selection
from salesweft.plans import ledger, upkeep
from salesweft.sources import layout, star
from salesweft.streaming import orders as S


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Layout --------------------------------------------------------------------

def test_a_year_reads_its_own_folders_and_joins_without_exchange(spark, data):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = layout.lay_out(spark, data, buckets=4)
        lines = layout.sales(spark, fact, "order_id", "order_date", "sales_amount", year=1997)
        text = plan(lines)
        assert text.count("PartitionFilters: [isnotnull(order_year") == 2 and "(order_year#" in text and "= 1997)" in text
        assert "Exchange" not in text and "SortMergeJoin" in text
        folders = {f.split("order_year=")[1].split("/")[0] for f in lines.inputFiles()}
        assert folders == {"1997"}
        got = sorted(map(tuple, lines.collect()))
        assert got and got == sorted(map(tuple, star.sales(spark, data, "order_id", "order_date", "sales_amount", year=1997).collect()))
        whole = layout.sales(spark, fact)
        assert "Exchange" not in plan(layout.sales(spark, fact, "channel", "sales_amount"))
        assert whole.columns == star.sales(spark, data).columns and whole.count() == star.table(spark, data, "lineitem").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# Ledger --------------------------------------------------------------------

def order(i, quantity="1"):
    return {"Order_ID": f"O{i}", "Region": "r", "Order_Date": "2024-01-01", "Season": "s", "Category": "c", "Product_Code": "p", "Quantity": quantity, "Unit_Price": "2.5"}


def put(spark, path, *rows):
    spark.createDataFrame(list(rows)).coalesce(1).write.mode("overwrite").json(path)


def ids(spark, out):
    return sorted((r["Source"], r["Order_ID"], r["reject_reason"]) for r in ledger.records(spark, out).collect())


def test_every_file_is_taken_once(spark, tmp_path):
    out, a, b = (str(tmp_path / n) for n in ("out", "in a+b%20", "b"))
    put(spark, a, order(1), order(2, "0"))
    one = ledger.take(spark, [("POS", a), ("ERP", b)], out, "json")
    assert one.run == 0 and one.taken.count() == 1
    assert [tuple(r) for r in one.refused.collect()] == [("ERP", b, "Missing file")]
    first = [("POS", "O1", None), ("POS", "O2", "Quantity must be at least 1")]
    assert ids(spark, out) == first
    assert ledger.take(spark, [("POS", a)], out, "json").taken.count() == 0 and ids(spark, out) == first
    put(spark, b, order(3))
    two = ledger.take(spark, [("POS", a), ("ERP", b)], out, "json")
    assert two.run == 1 and [r["source"] for r in two.taken.collect()] == ["ERP"]
    assert ids(spark, out) == [("ERP", "O3", None), *first]
    assert ledger.ledger(spark, out).count() == 2


def test_a_changed_file_replaces_its_records(spark, tmp_path):
    out, path = str(tmp_path / "out"), str(tmp_path / "in")
    put(spark, path, order(1), order(2, "0"))
    file = next(str(f) for f in (tmp_path / "in").iterdir() if f.name.endswith(".json"))
    ledger.take(spark, [("POS", file)], out, "json")
    with open(file, "w") as f:
        f.write('{"Order_ID":"O9","Region":"r","Order_Date":"d","Season":"s","Category":"c","Product_Code":"p","Quantity":"4"}\n')
    crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    ledger.take(spark, [("POS", file)], out, "json")
    assert ids(spark, out) == [("POS", "O9", None)]


def test_a_run_that_failed_before_its_entry_counts_for_nothing(spark, tmp_path, monkeypatch):
    out, path = str(tmp_path / "out"), str(tmp_path / "in")
    put(spark, path, order(1))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ledger, "written", fail)
        with pytest.raises(RuntimeError):
            ledger.take(spark, [("POS", path)], out, "json")
    assert ledger.ledger(spark, out).count() == 0 and ids(spark, out) == []
    assert ledger.take(spark, [("POS", path)], out, "json").run == 0 and len(ids(spark, out)) == 1


def test_many_deliveries_are_one_scan(spark, tmp_path):
    folders = [str(tmp_path / f"d{k}") for k in range(30)]
    put(spark, folders[0], order(0))
    for k, folder in enumerate(folders[1:], 1):
        os.mkdir(folder)
        with open(f"{folder}/x.json", "w") as f:
            f.write(f'{{"Order_ID":"O{k}","Region":"r","Order_Date":"d","Season":"s","Category":"c","Product_Code":"p"}}\n')
    entries = [(f[0], f[1], f[2], "POS", "json", 0) for folder in folders for f in ledger._files(spark, folder)]
    df = ledger._read(spark, "json", entries, False)
    assert plan(df).count("FileScan json") == 1 and df.count() == 30
    assert ledger.take(spark, [("POS", f) for f in folders], str(tmp_path / "out"), "json").taken.count() == 30


def test_numbers_out_of_range_are_rejected(spark):
    rows = [{**order(1), "Unit_Price": "1e26"}, {**order(2), "Unit_Price": "Infinity"}, {**order(3), "Total_Amount": "NaN"}, {**order(4), "Unit_Price": "9e25"}]
    df = spark.createDataFrame([{"Total_Amount": "1", "Source": "POS", **r} for r in rows])
    got = {r["Order_ID"]: r["reject_reason"] for r in ingest.validate(df).collect()}
    assert got == {"O1": "Number out of range: Unit_Price", "O2": "Number out of range: Unit_Price", "O3": "Number out of range: Total_Amount", "O4": None}


# Roll-ups kept up to date --------------------------------------------------

def records(seed, n=300):
    rng = random.Random(seed)
    days = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(5)] + [None]
    return [(f"O{seed}-{i}", rng.choice(["a", "b", None]), rng.choice(days), rng.choice("xy"), rng.choice(["s", "w"]), rng.randint(1, 9), rng.random() * 100) for i in range(n)]


COLUMNS = "Order_ID string, Region string, Order_Date date, Category string, Season string, Quantity long, Total_Amount double"


def test_kept_rollups_equal_a_full_run(spark, tmp_path):
    out = str(tmp_path / "kept")
    rows = {}
    for delivery in (3, 1, 3, 2):
        rows[delivery] = records(delivery)
        upkeep.add_delivery(spark.createDataFrame(rows[delivery], COLUMNS), out, delivery)
        whole = spark.createDataFrame([r for part in rows.values() for r in part], COLUMNS)
        key = lambda r: tuple(map(str, r))
        assert sorted(map(key, upkeep.kept_rollups(spark, out).collect())) == sorted(map(key, rollups.rollup_all(whole).collect()))


def test_kept_rollups_read_sums_only(spark, tmp_path):
    out = str(tmp_path / "kept")
    upkeep.add_delivery(spark.createDataFrame(records(1), COLUMNS), out, 1)
    files = upkeep.kept_rollups(spark, out).inputFiles()
    assert files and all("/kept/delivery=1/" in f for f in files)


# Keyed records -------------------------------------------------------------

def test_first_records_across_batches_and_restarts(spark, tmp_path):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    day = dt.datetime(2024, 1, 1)
    rng = random.Random(4)
    seen = []
    for k in range(4):
        # Later batches bring earlier records and very late repeats; some keys and times are missing.
        rows = [(rng.choice([None, "A", "B", f"C{k}", f"D{rng.randint(0, 30)}"]), day + dt.timedelta(days=rng.randint(-400, 400)) if rng.random() < 0.9 else None, 100 * k + i) for i in range(50)]
        seen += rows
        spark.createDataFrame(rows, "key string, at timestamp, n long").coalesce(1).write.mode("append").parquet(path)
        stream = S.file_stream(spark, path, spark.read.parquet(path).schema)
        S.first_records(stream, "key", ["at", "n"], out, state, parts=4).awaitTermination()
        want = {}
        for r in sorted(seen, key=lambda r: (r[1] is None, r[1] or day, r[2])):
            want.setdefault(r[0], r)
        got = {r["key"]: (r["key"], r["at"], r["n"]) for r in S.current_records(spark, out).collect()}
        assert got == want


def test_a_repeated_batch_gives_the_same_snapshot(spark, tmp_path):
    out = str(tmp_path / "out")
    batches = [[("A", 5), ("B", 1)], [("A", 3), ("C", 2)], [("A", 4), ("B", 0)]]
    frames = [spark.createDataFrame(b, "key string, n long") for b in batches]
    held = []

    class Stream:
        """Stands in for a stream: keeps the function that writes a batch."""

    def keep(stream, write, checkpoint, **_):
        held.append(write)

    original, S._run = S._run, keep
    try:
        S.first_records(Stream(), "key", ["n"], out, "unused", parts=2)
    finally:
        S._run = original
    for number, again in ((0, 1), (1, 2), (2, 1), (1, 1), (2, 1)):
        for _ in range(again):
            held[0](frames[number], number)
    assert sorted(map(tuple, S.current_records(spark, out).select("key", "n").collect())) == [("A", 3), ("B", 0), ("C", 2)]


# Places --------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 37, 99, 100, 1000])
def test_first_rows_and_places(spark, n):
    values = [(i * 37 % 100, i % 3) for i in range(100)]
    df = spark.createDataFrame(values, "v long, w long").repartition(7)
    order = [F.asc("v")]
    assert sorted(r["v"] for r in selection.first_rows(df, n, order).collect()) == list(range(min(n, 100)))
    if n == 37:
        assert all(r["place"] == r["v"] and r["place_of"] == 100 for r in selection.placed(df, order).collect())
        frames = spark.createDataFrame([(i, ["a"]) for i in range(50)], "k long, items array<string>")
        assert baskets.limit_baskets(frames, n, "k").count() == 37 and baskets.limit_baskets(frames, None, "k").count() == 50
    assert selection.first_rows(df.limit(0), n, order).count() == 0


def test_rows_of_a_run_are_not_moved(spark, tmp_path):
    put(spark, str(tmp_path / "d"), order(0))
    entries = [(f[0], f[1], f[2], "POS", "json", 0) for f in ledger._files(spark, str(tmp_path / "d"))]
    df = ledger._read(spark, "json", entries, False)
    assert df.count() == 1 and "BroadcastHashJoin" in plan(df) and "SortMergeJoin" not in plan(df)
