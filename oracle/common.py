"""Shared SQL: rounding, exact money sums, common table expressions."""

from __future__ import annotations


def r(x: str, digits: int) -> str:
    """Half-even rounding of the scaled double."""
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits})"


def m(x: str) -> str:
    """Exact decimal sum as a double."""
    return f"CAST(SUM({x}) AS DOUBLE)"


AMOUNT = "CAST(ROUND(l_extendedprice * (1 - l_discount), 4) AS DECIMAL(18,4))"
COST = "CAST(ROUND(l_quantity * p_retailprice, 4) AS DECIMAL(18,4))"
DAY = "CAST(o_orderdate AS DATE)"


def season(names: tuple[str, str, str, str]) -> str:
    spring, summer, autumn, winter = names
    return (
        f"CASE WHEN month(o_orderdate) BETWEEN 3 AND 5 THEN '{spring}' WHEN month(o_orderdate) BETWEEN 6 AND 8 "
        f"THEN '{summer}' WHEN month(o_orderdate) BETWEEN 9 AND 11 THEN '{autumn}' ELSE '{winter}' END"
    )


JOINED = """lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey"""

CTES: dict[str, str] = {
    "sales": f"""sales AS (SELECT l_suppkey AS store_id, n_name AS city, r_name AS region,
  o_orderpriority AS channel, c_mktsegment AS gender,
  CASE WHEN c_acctbal < 0 THEN '<0' WHEN c_acctbal < 2500 THEN '0-2500' WHEN c_acctbal < 5000 THEN '2500-5000'
       WHEN c_acctbal < 7500 THEN '5000-7500' ELSE '>=7500' END AS age_group,
  p_type AS category, p_brand AS product, 1 AS customer_count, 1 AS order_count, l_quantity AS product_count,
  {AMOUNT} AS sales_amount, {COST} AS cost, {AMOUNT} - {COST} AS profit,
  l_orderkey AS order_id, o_custkey AS customer_id, {DAY} AS order_date, year(o_orderdate) AS year,
  {season(('春季', '夏季', '秋季', '冬季'))} AS season
  FROM {JOINED})""",
    "raw": f"""raw AS (SELECT l_orderkey || '-' || l_linenumber AS Order_ID,
  CASE WHEN l_partkey % 83 = 0 THEN 'FAX' ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'ERP' WHEN '2-HIGH' THEN 'POS'
    WHEN '3-MEDIUM' THEN 'ONLINE_EC' WHEN '4-NOT SPECIFIED' THEN 'APP' WHEN '5-LOW' THEN 'MINI_PROGRAM' END END AS Source,
  CASE WHEN l_partkey % 97 <> 0 THEN r_name END AS Region, 'S-' || l_suppkey AS Store_Code,
  CASE WHEN l_partkey % 101 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS Order_Date,
  {season(('Spring', 'Summer', 'Autumn', 'Winter'))} AS Season,
  CASE WHEN l_partkey % 103 <> 0 THEN p_type END AS Category, p_brand || '-' || l_partkey AS Product_Code,
  p_name AS Product_Name,
  CASE WHEN p_size % 11 <> 0 THEN CASE p_size % 7 WHEN 0 THEN 'XS' WHEN 1 THEN 'S' WHEN 2 THEN 'M' WHEN 3 THEN 'L'
    WHEN 4 THEN 'XL' WHEN 5 THEN 'XXL' WHEN 6 THEN 'Free' END END AS Size,
  CASE WHEN l_partkey % 89 = 0 THEN '1000' WHEN l_partkey % 79 = 0 THEN '0' WHEN l_partkey % 73 = 0 THEN 'n/a'
    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS Quantity,
  CASE WHEN l_partkey % 71 = 0 THEN -1.0::DOUBLE ELSE l_extendedprice / l_quantity END AS Unit_Price,
  CAST(CAST(ROUND(l_extendedprice * l_discount, 4) AS DECIMAL(18,4)) AS DOUBLE) AS Discount,
  CAST({AMOUNT} AS DOUBLE) AS Total_Amount, {AMOUNT} AS money, 'CUST-' || o_custkey AS Customer_ID,
  CASE WHEN o_custkey % 17 = 0 THEN 'X' WHEN o_custkey % 13 = 0 THEN NULL WHEN o_custkey % 3 = 0 THEN 'Male'
    WHEN o_custkey % 3 = 1 THEN 'Female' ELSE 'Unknown' END AS Gender,
  CASE WHEN l_partkey % 61 = 0 THEN 'Barter' WHEN l_partkey % 67 = 0 THEN NULL ELSE CASE l_suppkey % 5 WHEN 0 THEN 'Cash'
    WHEN 1 THEN 'Credit_Card' WHEN 2 THEN 'Alipay' WHEN 3 THEN 'WeChat_Pay' WHEN 4 THEN 'Member_Card' END END AS Payment_Method,
  CASE WHEN o_custkey % 19 = 0 THEN 'Old' WHEN o_custkey % 23 = 0 THEN NULL ELSE CASE o_custkey % 6 WHEN 0 THEN '<18' WHEN 1 THEN '18-25'
    WHEN 2 THEN '26-35' WHEN 3 THEN '36-45' WHEN 4 THEN '46-55' WHEN 5 THEN '>55' END END AS Age_Group,
  l_partkey AS p1, l_suppkey AS p2, l_quantity AS p3, l_extendedprice AS p4, l_discount AS p5, l_shipdate AS p6
  FROM {JOINED})""",
    "typed": """typed AS (SELECT * REPLACE (TRY_CAST(Quantity AS DOUBLE) AS Quantity,
  TRY_CAST(Order_Date AS DATE) AS Order_Date), Order_Date AS date_text FROM raw)""",
}


def with_(names: tuple[str, ...], body: str, *more: str) -> str:
    """Named CTEs, then extra ones (which may be recursive), then the query."""
    parts = [CTES[n] for n in names] + list(more)
    return (f"WITH RECURSIVE {', '.join(parts)} " if parts else "") + body.strip()
