"""SQL per query, on whole tables.

Shared parts are common table expressions; ``_with`` puts the needed ones in
front of a query.  ``r(x, d)`` is the rounding the library uses.
"""

from __future__ import annotations

from oracle.common import CTES, m, r, with_
from salesweft.sources import schemas


SQL: dict[str, str] = {}


def _add(name: str, *ctes: str, body: str) -> None:
    SQL[name] = with_(ctes, body)


# Sales --------------------------------------------------------------------

def _sums(*extra: str) -> str:
    return ", ".join([
        "CAST(SUM(order_count) AS BIGINT) AS orders",
        f"{r(m('sales_amount'), 2)} AS revenue",
        f"{r(m('profit'), 2)} AS profit",
        "CAST(SUM(customer_count) AS BIGINT) AS customers",
        *extra,
    ])


AVERAGE = r(f"{m('sales_amount')} / GREATEST(SUM(order_count), 1)", 2)

_add("sales_by_date", "sales", body=f"""
SELECT strftime(order_date, '%Y-%m-%d') AS date, {_sums(
    'CAST(SUM(product_count) AS BIGINT) AS products', f'{AVERAGE} AS avg_order_value')}
FROM sales WHERE order_date IS NOT NULL GROUP BY order_date""")
_add("sales_by_category", "sales", body=f"""
SELECT category, {_sums(f'{AVERAGE} AS avg_price')} FROM sales WHERE category IS NOT NULL GROUP BY category""")
for name, key in (("sales_by_city", "city"), ("sales_by_gender", "gender"), ("sales_by_age", "age_group")):
    _add(name, "sales", body=f"SELECT {key}, {_sums()} FROM sales WHERE {key} IS NOT NULL GROUP BY {key}")
_add("sales_by_month", "sales", body=f"""
SELECT strftime(order_date, '%Y-%m') AS month, {_sums()} FROM sales
WHERE order_date IS NOT NULL GROUP BY 1""")
_add("year_pruned_sales", "sales", body=f"""
SELECT strftime(order_date, '%Y-%m') AS month, {_sums()} FROM sales WHERE year = 1998 GROUP BY 1""")
SQL["laid_out_year_sales"] = SQL["year_pruned_sales"]
_add("filter_conjunction", "sales", body=f"""
SELECT city, {_sums()} FROM sales
WHERE year = 1997 AND category = 'PROMO' AND gender = 'MACHINERY' AND channel = '2-HIGH' AND city IS NOT NULL
GROUP BY city""")

SUMMARY = f"""COALESCE(CAST(SUM(order_count) AS BIGINT), 0) AS total_orders,
COALESCE({r(m('sales_amount'), 2)}, 0) AS total_revenue,
COALESCE(CAST(SUM(customer_count) AS BIGINT), 0) AS total_customers,
COALESCE({r(m('profit'), 2)}, 0) AS total_profit,
CASE WHEN SUM(order_count) > 0 THEN {r(f"{m('sales_amount')} / SUM(order_count)", 2)} ELSE 0 END AS avg_order_value"""
_add("sales_summary", "sales", body=f"SELECT {SUMMARY} FROM sales")
_add("yearly_summary", "sales", body=f"SELECT year, {SUMMARY} FROM sales WHERE year IS NOT NULL GROUP BY year")
_add("union_of_years", "sales", body=f"SELECT year, {SUMMARY} FROM sales GROUP BY year")
_add("overview_topk", "sales", body=f"""
SELECT 'total' AS section, 'all' AS key, NULL::INTEGER AS rank, {SUMMARY} FROM sales
UNION ALL SELECT 'year', CAST(year AS VARCHAR), NULL, {SUMMARY} FROM sales WHERE year IS NOT NULL GROUP BY year
UNION ALL SELECT * FROM (
  SELECT 'category', category AS k, ROW_NUMBER() OVER (ORDER BY {m('sales_amount')} DESC, category) AS rk, {SUMMARY}
  FROM sales WHERE category IS NOT NULL GROUP BY category) WHERE rk <= 5
UNION ALL SELECT * FROM (
  SELECT 'city', city AS k, ROW_NUMBER() OVER (ORDER BY {m('sales_amount')} DESC, city) AS rk, {SUMMARY}
  FROM sales WHERE city IS NOT NULL GROUP BY city) WHERE rk <= 5""")
_add("filter_options", "sales", body=" UNION ".join(
    f"SELECT '{f}' AS field, CAST({f} AS VARCHAR) AS value FROM sales WHERE {f} IS NOT NULL"
    for f in ("category", "city", "gender", "age_group", "channel", "year")
))
_add("distinct_channels", "sales", body="SELECT DISTINCT channel FROM sales WHERE channel IS NOT NULL")
_add("sales_file_rows", body="""
WITH t AS (
  SELECT o_orderpriority AS channel,
    CASE WHEN l_partkey % 101 <> 0 THEN CAST(o_orderdate AS DATE) END AS d,
    CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE l_quantity END AS q
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT year(d) AS year, month(d) AS month,
  CASE WHEN month(d) BETWEEN 3 AND 5 THEN '春季' WHEN month(d) BETWEEN 6 AND 8 THEN '夏季'
       WHEN month(d) BETWEEN 9 AND 11 THEN '秋季' ELSE '冬季' END AS season,
  channel, COUNT(*) AS row_count, SUM(q) AS products, MAX(day(d)) AS last_day
FROM t GROUP BY ALL""")
_add("category_seasonality", body="""
SELECT category, CASE category WHEN 'PROMO' THEN 'Summer' WHEN 'LARGE' THEN 'Winter'
  WHEN 'SMALL' THEN 'Autumn/Winter' WHEN 'MEDIUM' THEN 'Autumn/Winter' ELSE 'All Year' END AS seasonality
FROM (SELECT DISTINCT p_type AS category FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type IS NOT NULL)""")
_add("weekday_sales", "sales", body=f"""
SELECT CAST(isodow(order_date) - 1 AS INTEGER) AS weekday, strftime(order_date, '%a') AS name,
  CAST(SUM(order_count) AS BIGINT) AS orders, {r(m('sales_amount'), 2)} AS revenue
FROM sales GROUP BY 1, 2""")

# Quality ------------------------------------------------------------------

RAW_FIELDS = [
    "Order_ID", "Source", "Region", "Store_Code", "Order_Date", "Season", "Category", "Product_Code",
    "Product_Name", "Size", "Quantity", "Unit_Price", "Discount", "Total_Amount", "Customer_ID", "Gender",
    "Payment_Method", "Age_Group",
]
BOUNDS = {"Quantity": (1, 100), "Unit_Price": (0, 10000), "Discount": (0, 5000), "Total_Amount": (0, 100000)}
REQUIRED = ["Order_ID", "Source", "Region", "Order_Date", "Season", "Category", "Product_Code"]


def _long(parts: list[str], keep: str) -> str:
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE {keep}"


_add("missing_counts", "raw", body=_long(
    [f"SELECT '{f}' AS field, COUNT(*) FILTER ({f} IS NULL) AS missing FROM raw" for f in RAW_FIELDS], "missing > 0"
))
_add("outlier_counts", "raw", "typed", body=_long([
    f"SELECT '{f}' AS field, COUNT(*) FILTER ({f} < {lo} OR {f} > {hi}) AS outliers FROM typed"
    for f, (lo, hi) in BOUNDS.items()
], "outliers > 0"))
ENUM_VALUES = {
    "Source": ["ERP", "POS", "ONLINE_EC", "APP", "MINI_PROGRAM"],
    "Season": ["Spring", "Summer", "Autumn", "Winter"],
    "Category": ["STANDARD", "ECONOMY", "SMALL", "LARGE", "MEDIUM"],
    "Size": ["XS", "S", "M", "L", "XL", "XXL", "Free"],
    "Gender": ["Male", "Female", "Unknown"],
    "Age_Group": ["<18", "18-25", "26-35", "36-45", "46-55", ">55"],
    "Payment_Method": ["Cash", "Credit_Card", "Alipay", "WeChat_Pay", "Member_Card"],
}


def _listed(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_add("enum_violations", "raw", body=_long([
    f"SELECT '{f}' AS field, COUNT(*) FILTER ({f} IS NOT NULL AND {f} NOT IN ({_listed(v)})) AS invalid FROM raw"
    for f, v in ENUM_VALUES.items()
], "true"))
_add("schema_violations", "raw", "typed", body=_long(
    [
        f"SELECT '{f}:required' AS \"check\", COUNT(*) FILTER ({f} IS NULL) AS violations FROM typed"
        for f in ("Order_ID", "Source", "Region", "Order_Date", "Season", "Category", "Product_Code", "Quantity", "Unit_Price", "Total_Amount")
    ] + [
        f"SELECT 'Category:enum', COUNT(*) FILTER (Category IS NOT NULL AND Category NOT IN ({_listed(schemas.ENUMS['Category'])})) FROM typed"
    ] + [
        f"SELECT '{f}:enum', COUNT(*) FILTER ({f} IS NOT NULL AND {f} NOT IN ({_listed(ENUM_VALUES[f])})) FROM typed"
        for f in ("Source", "Season", "Size", "Gender", "Age_Group", "Payment_Method")
    ] + [
        f"SELECT '{f}:min', COUNT(*) FILTER ({f} < {lo}) FROM typed"
        for f, lo in (("Quantity", 1), ("Unit_Price", 0), ("Discount", 0), ("Total_Amount", 0))
    ], "true"))
_add("normalise_types", "raw", "typed", body="""
SELECT year(Order_Date) AS year, COUNT(*) AS row_count, COUNT(Quantity) AS quantities,
  CAST(SUM(Quantity) AS BIGINT) AS quantity FROM typed GROUP BY 1""")


def _bounded(f: str) -> str:
    lo, hi = BOUNDS[f]
    return f"CASE WHEN {f} BETWEEN {lo} AND {hi} THEN {f} END"


def _filled(source: str) -> str:
    return f"""bounded AS (SELECT * REPLACE ({', '.join(f'{_bounded(f)} AS {f}' for f in BOUNDS)}) FROM {source}),
medians AS (SELECT {', '.join(f'quantile_cont({f}, 0.5) AS m_{f}' for f in BOUNDS)} FROM bounded),
filled AS (SELECT bounded.* REPLACE ({', '.join(f'COALESCE(bounded.{f}, m_{f}) AS {f}' for f in BOUNDS)})
  FROM bounded, medians)"""


NUMBERS_OUT = f"Quantity, {r('Unit_Price', 4)} AS Unit_Price, {r('Discount', 4)} AS Discount, {r('Total_Amount', 4)} AS Total_Amount"
SQL["median_fill"] = with_(("raw", "typed"), f"SELECT Order_ID, {NUMBERS_OUT} FROM filled", _filled("typed"))
FIRST = "ROW_NUMBER() OVER (PARTITION BY Order_ID ORDER BY p1, p2, p3, p4, p5, p6) = 1"
_add("dedup_first", "raw", body=f"SELECT Order_ID, Quantity, Discount FROM raw QUALIFY {FIRST}")
HAS_REQUIRED = " AND ".join(f"{f} IS NOT NULL" for f in REQUIRED)
SQL["clean_orders"] = with_(
    ("raw", "typed"),
    f"""SELECT Order_ID, COALESCE(Source, 'Unknown') AS Source, Region, Store_Code,
  strftime(Order_Date, '%Y-%m-%d') AS Order_Date, Season, Category, Product_Code, Product_Name,
  COALESCE(Size, 'Unknown') AS Size, {NUMBERS_OUT}, Customer_ID, COALESCE(Gender, 'Unknown') AS Gender,
  Payment_Method, COALESCE(Age_Group, 'Unknown') AS Age_Group
FROM filled QUALIFY {FIRST}""",
    # The date is judged as text: an unreadable one is present, then null.
    "kept AS (SELECT typed.* FROM typed WHERE " + HAS_REQUIRED.replace("Order_Date IS NOT NULL", "date_text IS NOT NULL") + ")",
    _filled("kept"),
)
RAW_REQUIRED = HAS_REQUIRED
_add("cleaning_stamps", "raw", body=f"SELECT COUNT(DISTINCT Order_ID) AS orders, 0 AS outside, 1 AS stamps FROM raw WHERE {RAW_REQUIRED}")
_add("quality_report", "raw", "typed", body=_long(
    [
        "SELECT 'total_records' AS metric, '' AS field, COUNT(*) AS value FROM raw",
        f"SELECT 'dropped_records', '', COUNT(*) FILTER (NOT ({RAW_REQUIRED})) FROM raw",
        f"SELECT 'valid_records', '', COUNT(DISTINCT Order_ID) FILTER ({RAW_REQUIRED}) FROM raw",
        f"SELECT 'duplicates', '', COUNT(*) FILTER ({RAW_REQUIRED}) - COUNT(DISTINCT Order_ID) FILTER ({RAW_REQUIRED}) FROM raw",
    ] + [
        f"SELECT 'missing_values', '{f}', COUNT(*) FILTER ({f} IS NULL) FROM {'typed' if f in BOUNDS else 'raw'}"
        for f in RAW_FIELDS
    ] + [
        f"SELECT 'outliers', '{f}', COUNT(*) FILTER (({f} < {lo} OR {f} > {hi}) AND "
        + HAS_REQUIRED.replace("Order_Date IS NOT NULL", "date_text IS NOT NULL") + ") FROM typed"
        for f, (lo, hi) in BOUNDS.items()
    ], "field = '' OR value > 0"))
CTES["checked"] = """checked AS (SELECT Source,
  CASE WHEN Source NOT IN ('ERP','POS','ONLINE_EC','APP','MINI_PROGRAM') THEN 'Unknown source type: ' || Source
    WHEN COALESCE(Region, '') = '' THEN 'Missing required field: Region'
    WHEN COALESCE(Category, '') = '' THEN 'Missing required field: Category'
    WHEN Quantity IS NOT NULL AND TRY_CAST(Quantity AS BIGINT) IS NULL THEN 'Unreadable number: Quantity'
    WHEN TRY_CAST(Quantity AS BIGINT) < 1 THEN 'Quantity must be at least 1'
    WHEN Unit_Price < 0 THEN 'Unit_Price cannot be negative' END AS reject_reason,
  TRY_CAST(COALESCE(Quantity, '1') AS BIGINT) AS Quantity FROM raw)"""
_add("ingest_ledger", "raw", "checked", body="""
SELECT CASE WHEN Source IN ('ERP', 'FAX') THEN 0 ELSE 1 END AS run, Source, reject_reason, COUNT(*) AS records FROM checked GROUP BY 1, 2, 3
UNION ALL SELECT run, 'FAX', 'Unknown source type: FAX', 0 FROM (SELECT unnest(range(3)) AS run)
UNION ALL SELECT run, 'APP', 'Missing file', 0 FROM (SELECT unnest(range(1, 3)) AS run)""")
COUNTS = "COUNT(*) AS total, COUNT(*) FILTER (reject_reason IS NULL) AS valid, COUNT(*) FILTER (reject_reason IS NOT NULL) AS invalid"
_add("validate_reasons", "raw", "checked", body="SELECT reject_reason, COUNT(*) AS records FROM checked GROUP BY 1")
_add("ingest_stats", "raw", "checked", body=f"""
SELECT Source AS source, {COUNTS} FROM checked GROUP BY 1 UNION ALL SELECT 'ALL', {COUNTS} FROM checked""")
_add("unknown_sources", "raw", body="""
SELECT Source, COUNT(*) AS records,
  CASE WHEN Source = 'FAX' THEN 'Unknown source type: FAX' ELSE '' END AS reason FROM raw GROUP BY Source""")

# File round trips -----------------------------------------------------------

SQL["sales_file_round_trip"] = SQL["sales_file_rows"]
SQL["report_round_trip"] = SQL["quality_report"]
SQL["cleaned_round_trip"] = f"""SELECT Season, Size, Gender, COUNT(*) AS orders, COUNT(Order_Date) AS dated,
  {r('SUM(Quantity)', 4)} AS quantity FROM ({SQL['clean_orders']}) GROUP BY 1, 2, 3"""
_add("order_file_formats", "raw", body="""
SELECT f AS format, Source, Season, COUNT(*) AS records, COUNT(DISTINCT Order_ID) AS ids,
  CAST(SUM(TRY_CAST(Quantity AS BIGINT)) AS BIGINT) AS quantity, COUNT(*) FILTER (Unit_Price < 0) AS negative, MAX(Product_Name) AS last_name
FROM raw, (VALUES ('json'), ('csv'), ('parquet')) v(f) GROUP BY 1, 2, 3""")
_add("ingest_rejects", "raw", "checked", body="""
SELECT Source, reject_reason, COUNT(*) AS records, 'record' AS kind FROM checked WHERE reject_reason IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT 'FAX', 'Unknown source type: FAX', 1, 'delivery' WHERE EXISTS (SELECT 1 FROM raw)
UNION ALL SELECT 'POS', 'Missing file', 1, 'delivery' WHERE EXISTS (SELECT 1 FROM raw)""")
_add("stream_undated", "raw", body="""
SELECT Order_ID, Order_Date, 'Unreadable Order_Date' AS reject_reason FROM raw WHERE TRY_CAST(Order_Date AS DATE) IS NULL""")

# Order roll-ups ------------------------------------------------------------


def _order_sums(dims: list[str], shown: list[str], extra: str = "") -> str:
    present = " AND ".join(f"{d} IS NOT NULL" for d in dims)
    return f"""SELECT {extra}{', '.join(shown)}, COUNT(Order_ID) AS order_count,
  CAST(SUM(Quantity) AS BIGINT) AS total_quantity, {m('money')} AS total_amount,
  {r(f"CASE WHEN COUNT(Order_ID) > 0 THEN {m('money')} / COUNT(Order_ID) ELSE 0 END", 4)} AS avg_order_value
FROM typed WHERE {present} GROUP BY {', '.join(dims)}"""


DATE_TEXT = "strftime(Order_Date, '%Y-%m-%d') AS Order_Date"
SETS = {
    "Region": ["Region"], "Date": ["Order_Date"], "Category": ["Category"],
    "Region_Date": ["Region", "Order_Date"], "Region_Category": ["Region", "Category"],
    "Season_Category": ["Season", "Category"],
}
for label, dims in SETS.items():
    _add(f"rollup_{label.lower()}", "raw", "typed", body=_order_sums(
        dims, [DATE_TEXT if d == "Order_Date" else d for d in dims]
    ))
_add("rollup_all", "raw", "typed", body=" UNION ALL ".join(
    _order_sums(
        dims,
        [
            (DATE_TEXT if d == "Order_Date" else d) if d in dims else f"NULL::VARCHAR AS {d}"
            for d in ("Region", "Order_Date", "Category", "Season")
        ],
        f"'{label}' AS dimension, ",
    )
    for label, dims in SETS.items()
))
SQL["kept_rollups"] = SQL["rollup_all"]
_add("rollup_sizes", "raw", "typed", body=" UNION ALL ".join(
    f"SELECT '{label}' AS dimension, COUNT(*) AS groups FROM (SELECT DISTINCT {', '.join(dims)} FROM typed WHERE "
    + " AND ".join(f"{d} IS NOT NULL" for d in dims) + ")"
    for label, dims in SETS.items()
))


def _keyed(second: str) -> str:
    return f"""
SELECT COALESCE(Region, 'Unknown') || '_' || COALESCE({second}, 'Unknown') AS key, COUNT(*) AS total_orders,
  CAST(COALESCE(SUM(Quantity), 0) AS BIGINT) AS total_quantity, COALESCE({m('money')}, 0) AS total_amount,
  {r(f"{m('money')} / COUNT(*)", 4)} AS avg_order_value
FROM typed GROUP BY 1"""


_add("keyed_reduce", "raw", "typed", body=_keyed("Category"))
_add("keyed_reduce_date", "raw", "typed", body=_keyed("strftime(Order_Date, '%Y-%m-%d')"))


def all_sql() -> dict[str, str]:
    """All oracles, by query name."""
    from oracle import analyses

    return {**SQL, **analyses.SQL}
