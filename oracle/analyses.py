"""SQL for baskets, drivers, forecasts, segments and streams."""

from __future__ import annotations

from oracle.common import CTES, m, r, with_

SQL: dict[str, str] = {}


def _add(name: str, *ctes: str, body: str, more: tuple[str, ...] = ()) -> None:
    SQL[name] = with_(ctes, body, *more)


# Baskets -------------------------------------------------------------------

_add("baskets_city_day", "sales", body="""
SELECT strftime(order_date, '%Y-%m-%d') AS order_date, city, string_agg(DISTINCT category, '+' ORDER BY category) AS items
FROM sales WHERE order_date IS NOT NULL AND city IS NOT NULL AND category IS NOT NULL GROUP BY sales.order_date, city""")
_add("baskets_order", "sales", body="""
SELECT order_id, string_agg(DISTINCT product, '+' ORDER BY product) AS items, CAST(COUNT(DISTINCT product) AS INTEGER) AS size
FROM sales WHERE product IS NOT NULL GROUP BY order_id""")
_add("first_baskets", "sales", body="""
SELECT order_id, string_agg(DISTINCT product, '+' ORDER BY product) AS items
FROM sales WHERE product IS NOT NULL GROUP BY order_id ORDER BY order_id LIMIT 5000""")
_add("first_baskets_whole", "sales", body="SELECT COUNT(DISTINCT order_id) AS baskets, MAX(order_id) AS last_order FROM sales WHERE product IS NOT NULL")
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_add("basket_matrix", "sales", body="SELECT order_id, " + ", ".join(
    f"CAST(MAX(CASE WHEN category = '{t}' THEN 1 ELSE 0 END) AS INTEGER) AS \"{t}\"" for t in TYPES
) + " FROM sales WHERE category IS NOT NULL GROUP BY order_id")
_add("basket_item_text", "sales", body="""
SELECT size, COUNT(*) AS baskets FROM (SELECT order_id, CAST(COUNT(DISTINCT category) AS INTEGER) AS size
FROM sales WHERE category IS NOT NULL GROUP BY order_id) GROUP BY size""")


def _mined(item: str, support: float) -> tuple[str, ...]:
    keep = f"HAVING COUNT(*) / (SELECT n FROM total) >= {support}"
    return (
        f"b AS (SELECT DISTINCT order_id, {item} AS item FROM sales WHERE {item} IS NOT NULL)",
        "total AS (SELECT COUNT(DISTINCT order_id) AS n FROM b)",
        f"i1 AS (SELECT item AS a, COUNT(*) AS n FROM b GROUP BY 1 {keep})",
        "f AS (SELECT * FROM b WHERE item IN (SELECT a FROM i1))",
        f"""i2 AS (SELECT x.item AS a, y.item AS b, COUNT(*) AS n
  FROM f x JOIN f y ON x.order_id = y.order_id AND x.item < y.item GROUP BY 1, 2 {keep})""",
        f"""i3 AS (SELECT x.a, x.b, z.item AS c, COUNT(*) AS n FROM i2 x JOIN f p ON p.item = x.a
  JOIN f q ON q.order_id = p.order_id AND q.item = x.b JOIN f z ON z.order_id = p.order_id AND z.item > x.b
  GROUP BY 1, 2, 3 {keep})""",
        """sets AS (SELECT a AS items, 1 AS size, n FROM i1 UNION ALL SELECT a || '+' || b, 2, n FROM i2
  UNION ALL SELECT a || '+' || b || '+' || c, 3, n FROM i3)""",
        "s AS (SELECT items, size, n, n / (SELECT n FROM total) AS support FROM sets)",
    )


MINED = _mined("category", 0.05)
SHOWN = f"items, size, n, {r('support', 9)} AS support"
_add("itemset_1", "sales", more=MINED, body=f"""
SELECT item, n, {r('n / (SELECT n FROM total)', 9)} AS support FROM (SELECT item, COUNT(*) AS n FROM b GROUP BY 1)""")
for size in (2, 3):
    _add(f"itemset_{size}", "sales", more=MINED, body=f"""
SELECT items, n, {r('support', 9)} AS support FROM s WHERE size = {size}""")
_FOUR = "w.item || '+' || x.item || '+' || y.item || '+' || z.item"
_FOUR_FROM = """b w JOIN b x ON w.order_id = x.order_id AND w.item < x.item
  JOIN b y ON w.order_id = y.order_id AND x.item < y.item JOIN b z ON w.order_id = z.order_id AND y.item < z.item"""
for size, items, source in (
    (4, _FOUR, _FOUR_FROM), (5, f"{_FOUR} || '+' || v.item", f"{_FOUR_FROM} JOIN b v ON w.order_id = v.order_id AND z.item < v.item"),
):
    _add(f"itemset_{size}", "sales", more=_mined("category", 0.001)[:2], body=f"""
SELECT {items} AS items, COUNT(*) AS n, {r('COUNT(*) / (SELECT n FROM total)', 9)} AS support FROM {source}
GROUP BY 1 HAVING COUNT(*) / (SELECT n FROM total) >= 0.001""")
_add("frequent_itemsets", "sales", more=MINED, body=f"SELECT {SHOWN} FROM s")
_add("fpgrowth_itemsets", "sales", more=MINED, body=f"SELECT {SHOWN} FROM s")
_add("frequent_products", "sales", more=_mined("product", 0.01), body=f"SELECT {SHOWN} FROM s")
_add("top_itemsets", "sales", more=MINED, body=f"SELECT {SHOWN} FROM s WHERE size >= 2 ORDER BY n DESC, s.size, s.items LIMIT 10")
CANDIDATES = """cand AS (SELECT x.a, x.b, y.b AS c FROM i2 x JOIN i2 y ON x.a = y.a AND x.b < y.b
  WHERE EXISTS (SELECT 1 FROM i2 z WHERE z.a = x.b AND z.b = y.b))"""
_add("itemset_candidates", "sales", more=(*MINED, CANDIDATES), body="SELECT a || '+' || b || '+' || c AS items FROM cand")
_add("candidate_supports", "sales", more=(*MINED, CANDIDATES), body="""
SELECT cand.a || '+' || cand.b || '+' || cand.c AS items, COUNT(z.item) AS n
FROM cand LEFT JOIN (b p JOIN b q ON p.order_id = q.order_id JOIN b z ON z.order_id = p.order_id)
  ON p.item = cand.a AND q.item = cand.b AND z.item = cand.c GROUP BY 1""")
_SPLITS = " UNION ALL ".join(
    [f"SELECT a || '+' || b AS whole, {x} AS antecedent, {y} AS consequent FROM i2" for x, y in (("a", "b"), ("b", "a"))]
    + [
        f"SELECT a || '+' || b || '+' || c, {x}, {y} FROM i3"
        for one, two in (("a", "b || '+' || c"), ("b", "a || '+' || c"), ("c", "a || '+' || b"))
        for x, y in ((one, two), (two, one))
    ]
)
RULES = (
    f"splits AS ({_SPLITS})",
    """rules AS (SELECT antecedent, consequent, w.support, w.support / x.support AS confidence,
  w.support / x.support / y.support AS lift, w.support - x.support * y.support AS leverage,
  (1 - y.support) / nullif(1 - w.support / x.support, 0) AS conviction
  FROM splits JOIN s w ON w.items = whole JOIN s x ON x.items = antecedent JOIN s y ON y.items = consequent
  WHERE w.support / x.support >= 0.3)""",
    """ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY round(lift, 9) DESC, antecedent, consequent) AS place FROM rules)""",
)
RULE_OUT = f"""antecedent, consequent, {r('support', 9)} AS support, {r('confidence', 9)} AS confidence, {r('lift', 9)} AS lift,
{r('leverage', 9)} AS leverage, CASE WHEN confidence < 1 THEN {r('conviction', 6)} END AS conviction,
CASE WHEN lift > 1.15 THEN '高价值' WHEN lift > 1.08 THEN '中等' ELSE '一般' END AS value_tier, confidence >= 1 AS certain"""
_add("assoc_rules", "sales", more=(*MINED, *RULES), body=f"SELECT {RULE_OUT} FROM rules")
_add("rules_min_lift", "sales", more=(*MINED, *RULES), body=f"""
SELECT {RULE_OUT} FROM (SELECT * FROM rules WHERE lift >= 0.995
  ORDER BY round(lift, 9) DESC, antecedent, consequent LIMIT 20)""")
_add("rule_network_edges", "sales", more=(*MINED, *RULES), body=f"""
SELECT string_split(antecedent, '+')[1] AS source, string_split(consequent, '+')[1] AS target,
  {r('lift', 9)} AS value, {r('GREATEST(lift, 1)', 9)} AS width FROM ranked WHERE place <= 15""")
_add("rule_network_nodes", "sales", more=(*MINED, *RULES), body="""
SELECT DISTINCT unnest(string_split(antecedent || '+' || consequent, '+')) AS item FROM ranked WHERE place <= 15""")
_add("basket_headline", "sales", more=(*MINED, *RULES), body="""
SELECT (SELECT n FROM total) AS baskets, (SELECT COUNT(*) FROM s) AS itemsets, (SELECT COUNT(*) FROM rules) AS rules""")

# Drivers -------------------------------------------------------------------

CTES["features"] = f"""features AS (SELECT Region, Season, Category,
  CASE WHEN amount / GREATEST(Sales_Volume, 1) < 49000 THEN 'Low' WHEN amount / GREATEST(Sales_Volume, 1) < 51500 THEN 'Mid'
    ELSE 'High' END AS Price_Range, Sales_Volume, amount, profit
  FROM (SELECT city AS Region, season AS Season, category AS Category, CAST(SUM(order_count) AS BIGINT) AS Sales_Volume,
    {m('sales_amount')} AS amount, {m('profit')} AS profit
    FROM sales WHERE city IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2, 3))"""
CTES["combos"] = """combos AS (SELECT Region, Season, Category, Price_Range, AVG(Sales_Volume) AS avg_sales,
  CAST(SUM(Sales_Volume) AS BIGINT) AS total_sales, COUNT(Sales_Volume) AS "count" FROM features GROUP BY 1, 2, 3, 4)"""
CTES["insights"] = f"""insights AS (WITH best AS (SELECT * FROM combos
    ORDER BY avg_sales DESC, Region, Season, Category, Price_Range LIMIT 50),
  q AS (SELECT quantile_cont(avg_sales, 0.5) AS p50, quantile_cont(avg_sales, 0.25) AS p25 FROM best)
  SELECT Region, Season, Category, Price_Range, avg_sales AS expected_sales,
    CASE WHEN avg_sales >= p50 THEN '高' WHEN avg_sales >= p25 THEN '中' ELSE '低' END AS priority,
    '建议在' || Season || '季节向' || Region || '地区重点铺货' || Category || '(' || Price_Range || '价位)，预计单店销量'
      || format('{{:.0f}}', round_even(avg_sales, 0)) || '件' AS recommendation
  FROM best, q)"""
FEATURES = ("sales", "features")
_add("distinct_counts", *FEATURES, body="""
SELECT COUNT(DISTINCT Region) AS regions, COUNT(DISTINCT Category) AS categories, COUNT(DISTINCT Season) AS seasons FROM features""")
_add("feature_table", *FEATURES, body=f"""
SELECT Region, Season, Category, Price_Range, Sales_Volume, {r('amount', 2)} AS amount, {r('profit', 2)} AS profit FROM features""")
_add("price_tiers", *FEATURES, body="""
SELECT Price_Range, Season, COUNT(*) AS combinations, CAST(SUM(Sales_Volume) AS BIGINT) AS volume FROM features GROUP BY 1, 2""")
_add("combination_stats", *FEATURES, "combos", body=f"""
SELECT Region, Season, Category, Price_Range, {r('avg_sales', 4)} AS avg_sales, total_sales, "count" FROM combos""")
_add("one_hot_long", *FEATURES, body=" UNION ALL ".join(
    f"SELECT Region, Season, Category, Price_Range, '{c}_' || {c} AS feature FROM features"
    for c in ("Region", "Season", "Category", "Price_Range")
))
# The wide form has a column per value, so its SQL names the values of the given tables.
ENCODED = {
    "Region": tuple(f"NATION_{n}" for n in range(25)),
    "Season": ("春季", "夏季", "秋季", "冬季"),
    "Category": ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"),
    "Price_Range": ("Low", "Mid", "High"),
}
_FLAGS = ", ".join(
    f"CAST(CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS INTEGER) AS \"{c}_{v}\"" for c, found in ENCODED.items() for v in found
)
_add("one_hot_wide", *FEATURES, body=f"SELECT Region, Season, Category, Price_Range, Sales_Volume, {_FLAGS} FROM features")
_add("decision_rules", *FEATURES, body=f"""
SELECT Region, Season, Category, 'Region=' || Region || ', Season=' || Season || ', Category=' || Category AS condition,
  'Expected Sales Volume: ' || format('{{:.0f}}', round_even(impact, 0)) AS conclusion,
  {r('rows_here / rows_all', 9)} AS support,
  {r('LEAST(CASE WHEN region_mean > 0 THEN impact / region_mean ELSE 1 END, 1)', 9)} AS confidence,
  {r('impact', 4)} AS sales_impact
FROM (SELECT Region, Season, Category, AVG(Sales_Volume) AS impact, COUNT(*) AS rows_here,
    (SELECT COUNT(*) FROM features) AS rows_all,
    (SELECT AVG(Sales_Volume) FROM features x WHERE x.Region = features.Region) AS region_mean
  FROM features GROUP BY Region, Season, Category)
ORDER BY impact DESC, Region, Season, Category LIMIT 20""")
INSIGHT_OUT = f"Region, Season, Category, Price_Range, {r('expected_sales', 4)} AS expected_sales, priority, recommendation"
_add("stocking_insights", *FEATURES, "combos", "insights", body=f"SELECT {INSIGHT_OUT} FROM insights")
_add("insight_filter", *FEATURES, "combos", "insights", body=f"SELECT {INSIGHT_OUT} FROM insights WHERE priority = '高'")
_add("heatmap_cells", *FEATURES, "combos", "insights", body=f"""
SELECT Region, Category, {r('MAX(insights.expected_sales)', 4)} AS expected_sales FROM insights GROUP BY 1, 2""")

# Trees: 0 over all rows, f + 1 over all but fold f.  Every level groups the rows
# of a node by column and value and takes the split with the largest gain.
TREE_COLUMNS = ("Region", "Season", "Category", "Price_Range")
TREE_DEPTH, TREE_SPLIT, TREE_LEAF = 5, 20, 5
_TREE = [
    """fold_rank AS (SELECT *, ROW_NUMBER() OVER (ORDER BY Region, Season, Category, Price_Range) - 1 AS rk, COUNT(*) OVER () AS every FROM features)""",
    """folded AS (SELECT *, CAST(Sales_Volume AS DOUBLE) AS y, CASE WHEN rk < (every % 5) * (every // 5 + 1) THEN rk // (every // 5 + 1)
  ELSE every % 5 + (rk - (every % 5) * (every // 5 + 1)) // GREATEST(every // 5, 1) END AS fold FROM fold_rank)""",
    """level0 AS (SELECT t.tree, 1 AS node, t.tree = 0 OR t.tree - 1 <> fold AS seen, folded.* FROM folded, (SELECT unnest(range(6)) AS tree) t)""",
]
for _d in range(TREE_DEPTH):
    _pairs = " UNION ALL ".join(
        f"SELECT tree, node, {i} AS place, {c} AS val, COUNT(*) AS n, SUM(y) AS s FROM level{_d} WHERE seen GROUP BY tree, node, {c}"
        for i, c in enumerate(TREE_COLUMNS)
    )
    _TREE += [
        f"stat{_d} AS ({_pairs})",
        f"whole{_d} AS (SELECT tree, node, COUNT(*) AS all_n, SUM(y) AS all_s FROM level{_d} WHERE seen GROUP BY tree, node)",
        f"""split{_d} AS (SELECT tree, node, place, val, all_n, all_s,
  (s * all_n - all_s * n) * (s * all_n - all_s * n) / (CAST(all_n AS DOUBLE) * n * (all_n - n)) AS gain
  FROM stat{_d} JOIN whole{_d} USING (tree, node)
  WHERE val IS NOT NULL AND n >= {TREE_LEAF} AND all_n - n >= {TREE_LEAF} AND all_n >= {TREE_SPLIT} AND s * all_n <> all_s * n
  QUALIFY ROW_NUMBER() OVER (PARTITION BY tree, node ORDER BY gain DESC, place, val) = 1)""",
        f"""level{_d + 1} AS (SELECT l.* REPLACE (l.node * 2 + CASE WHEN CASE place {' '.join(f'WHEN {i} THEN {c}' for i, c in enumerate(TREE_COLUMNS))} END = val
  THEN 1 ELSE 0 END AS node) FROM level{_d} l JOIN split{_d} USING (tree, node))""",
    ]
_TREE += [
    "ended AS (" + " UNION ALL ".join(
        f"SELECT * FROM level{d} l WHERE NOT EXISTS (SELECT 1 FROM split{d} p WHERE p.tree = l.tree AND p.node = l.node)" for d in range(TREE_DEPTH)
    ) + f" UNION ALL SELECT * FROM level{TREE_DEPTH})",
    "leaves AS (SELECT tree, node, AVG(y) AS p FROM ended WHERE seen GROUP BY tree, node)",
    "splits AS (" + " UNION ALL ".join(f"SELECT * FROM split{d}" for d in range(TREE_DEPTH)) + ")",
    "scored AS (SELECT ended.*, p FROM ended JOIN leaves USING (tree, node))",
    f"named AS (SELECT *, CASE place {' '.join(f'WHEN {i} THEN {c!r}' for i, c in enumerate(TREE_COLUMNS))} END || '_' || val AS feature FROM splits)",
    """figures AS (SELECT SQRT(AVG((y - p) * (y - p))) AS rmse, AVG(ABS(y - p)) AS mae, 1 - SUM((y - p) * (y - p)) / (VAR_POP(y) * COUNT(*)) AS r2,
  CAST((SELECT MAX(FLOOR(LOG2(node))) + 1 FROM splits WHERE tree = 0) AS INTEGER) AS depth FROM scored WHERE tree = 0)""",
    "held_out AS (SELECT fold, COUNT(*) AS n, AVG((y - p) * (y - p)) AS mse FROM scored WHERE NOT seen GROUP BY fold)",
]
_add("tree_splits", *FEATURES, more=tuple(_TREE), body=f"""
SELECT CAST(tree AS INTEGER) AS tree, node, feature, all_n AS rows, {r('all_s / all_n', 6)} AS mean, {r('gain', 3)} AS gain FROM named""")
_add("tree_importance", *FEATURES, more=tuple(_TREE), body=f"""
SELECT feature, {r('g / SUM(g) OVER ()', 9)} AS importance, regexp_replace(feature, '^(Region|Season|Category|Price_Range)_', '') AS name
FROM (SELECT feature, SUM(gain) AS g FROM named WHERE tree = 0 GROUP BY 1) ORDER BY g DESC, feature LIMIT 8""")
_add("tree_metrics", *FEATURES, more=tuple(_TREE), body=f"""
SELECT {r('rmse', 6)} AS rmse, {r('mae', 6)} AS mae, {r('r2', 9)} AS r2, depth FROM figures""")
_add("tree_predictions", *FEATURES, more=tuple(_TREE), body="""
SELECT 'Region_' || Region || '+Season_' || Season || '+Category_' || Category || '+Price_Range_' || Price_Range AS features,
  Sales_Volume AS actual_sales, CAST(TRUNC(p) AS BIGINT) AS predicted_sales, CAST(TRUNC(ABS(y - p)) AS BIGINT) AS error
FROM scored WHERE tree = 0 ORDER BY md5('42|' || Region || '|' || Season || '|' || Category || '|' || Price_Range) LIMIT 10""")
_add("cv_mse", *FEATURES, more=tuple(_TREE), body=f"SELECT CAST(fold AS INTEGER) AS fold, n AS rows, {r('mse', 4)} AS mse FROM held_out")
_add("driver_analysis", *FEATURES, "combos", more=tuple(_TREE), body=f"""
SELECT {r('rmse', 6)} AS rmse, {r('mae', 6)} AS mae, {r('r2', 9)} AS r2, depth,
  (SELECT COUNT(DISTINCT Region) FROM features) AS regions, (SELECT COUNT(DISTINCT Category) FROM features) AS categories,
  (SELECT COUNT(DISTINCT Season) FROM features) AS seasons, {r('(SELECT AVG(mse) FROM held_out)', 4)} AS cv_mse,
  CAST(LEAST(20, (SELECT COUNT(*) FROM (SELECT DISTINCT Region, Season, Category FROM features))) AS INTEGER) AS rules,
  CAST(LEAST(50, (SELECT COUNT(*) FROM combos)) AS INTEGER) AS insights, CAST(LEAST(10, (SELECT COUNT(*) FROM features)) AS INTEGER) AS sample,
  CAST((SELECT COUNT(DISTINCT feature) FROM named WHERE tree = 0) AS INTEGER) AS used_features
FROM figures""")

# Forecast ------------------------------------------------------------------

KEY = "region, category"
PART = f"PARTITION BY {KEY}"
ORD = f"{PART} ORDER BY ds"
DT = "strftime(ds, '%Y-%m-%d') AS ds"
CTES["daily"] = f"""daily AS (SELECT region, category, order_date AS ds, {m('sales_amount')} AS y FROM sales
  WHERE region IS NOT NULL AND category IS NOT NULL AND order_date IS NOT NULL GROUP BY 1, 2, 3)"""
CTES["win"] = f"""win AS (SELECT *, COUNT(*) OVER ({PART}) AS points FROM (
  SELECT * FROM daily QUALIFY ROW_NUMBER() OVER ({PART} ORDER BY ds DESC) <= 180))"""
CTES["std"] = f"""std AS (SELECT *, (y - mean) / sd AS z FROM (SELECT *, AVG(y) OVER ({PART}) AS mean,
  CASE WHEN COALESCE(STDDEV_SAMP(y) OVER ({PART}), 0) = 0 THEN 1 ELSE STDDEV_SAMP(y) OVER ({PART}) END AS sd
  FROM win WHERE points >= 30))"""
CTES["dif"] = f"""dif AS (SELECT *, dz - LAG(dz) OVER ({ORD}) AS ddz FROM (
  SELECT *, z - LAG(z) OVER ({ORD}) AS dz FROM std))"""
CTES["tests"] = f"""tests AS (SELECT *, CASE WHEN level_stationary THEN 0 WHEN change_stationary THEN 1 ELSE 2 END AS d FROM (
  SELECT {KEY}, COUNT(*) AS points,
    COALESCE(COUNT(z) >= 10 AND ABS(AVG(dz)) < STDDEV_SAMP(z) * 0.05 AND STDDEV_SAMP(dz) < STDDEV_SAMP(z) * 0.7, false) AS level_stationary,
    COALESCE(COUNT(dz) >= 10 AND ABS(AVG(ddz)) < STDDEV_SAMP(dz) * 0.05 AND STDDEV_SAMP(ddz) < STDDEV_SAMP(dz) * 0.7, false) AS change_stationary
  FROM dif GROUP BY {KEY}))"""
CTES["mod"] = f"""mod AS (SELECT *, LAG(x) OVER ({ORD}) AS l1, LAG(x, 2) OVER ({ORD}) AS l2 FROM (
  SELECT dif.*, d, CASE d WHEN 0 THEN z WHEN 1 THEN dz ELSE ddz END AS x FROM dif JOIN tests USING ({KEY})))"""
CTES["mod1"] = CTES["mod"].replace("mod AS", "mod AS", 1).replace("dif.*, d, CASE d", "dif.*, 1 AS d, CASE 1").replace(
    f" JOIN tests USING ({KEY})", ""
)
CTES["phi"] = f"""phi AS (SELECT {KEY}, d, n, CASE WHEN s11 > 0 THEN b1 / s11 ELSE 0 END AS ar1_phi1,
  (c1 * a22 - c2 * a12) / (a11 * a22 - a12 * a12) AS ar2_phi1, (c2 * a11 - c1 * a12) / (a11 * a22 - a12 * a12) AS ar2_phi2
  FROM (SELECT {KEY}, ANY_VALUE(d) AS d, COUNT(x) AS n, SUM(l1 * l1) AS s11, SUM(x * l1) AS b1,
    SUM(l1 * l1) FILTER (l2 IS NOT NULL) AS a11, SUM(l1 * l2) AS a12, SUM(l2 * l2) AS a22,
    SUM(x * l1) FILTER (l2 IS NOT NULL) AS c1, SUM(x * l2) AS c2 FROM mod GROUP BY {KEY}))"""


def _ic(p: int, penalty: str) -> str:
    k = p + 1
    return f"CASE WHEN ar{p}_rss > 0 AND n > {k} THEN n * LN(ar{p}_rss / n + 1e-10) + {penalty} ELSE 0 END"


CTES["fit"] = f"""fit AS (SELECT *, {_ic(1, '4')} AS ar1_aic, {_ic(1, '2 * LN(n)')} AS ar1_bic,
  {_ic(2, '6')} AS ar2_aic, {_ic(2, '3 * LN(n)')} AS ar2_bic FROM (
  SELECT {KEY}, ANY_VALUE(phi.d) AS d, ANY_VALUE(n) AS n, ANY_VALUE(ar1_phi1) AS ar1_phi1, ANY_VALUE(ar2_phi1) AS ar2_phi1,
    ANY_VALUE(ar2_phi2) AS ar2_phi2, SUM(r1 * r1) AS ar1_rss, VAR_POP(r1) AS ar1_sigma2, SUM(r2 * r2) AS ar2_rss, VAR_POP(r2) AS ar2_sigma2
  FROM (SELECT mod.region, mod.category, phi.d, n, ar1_phi1, ar2_phi1, ar2_phi2, x - ar1_phi1 * l1 AS r1,
      x - ar2_phi1 * l1 - ar2_phi2 * l2 AS r2 FROM mod JOIN phi USING ({KEY})) phi GROUP BY {KEY}))"""
CTES["best"] = f"""best AS (SELECT {KEY}, p, d, 0 AS q, n, CASE p WHEN 2 THEN ar2_phi1 ELSE ar1_phi1 END AS phi1,
  CASE p WHEN 2 THEN ar2_phi2 ELSE 0 END AS phi2, CASE p WHEN 2 THEN ar2_rss ELSE ar1_rss END AS rss,
  CASE p WHEN 2 THEN ar2_sigma2 ELSE ar1_sigma2 END AS sigma2, CASE p WHEN 2 THEN ar2_aic ELSE ar1_aic END AS aic,
  CASE p WHEN 2 THEN ar2_bic ELSE ar1_bic END AS bic FROM (
  SELECT *, CASE WHEN ar2_aic <> 0 AND (ar1_aic = 0 OR ar2_aic < ar1_aic) THEN 2 ELSE 1 END AS p FROM fit))"""
CTES["best2"] = CTES["best"].replace(
    "CASE WHEN ar2_aic <> 0 AND (ar1_aic = 0 OR ar2_aic < ar1_aic) THEN 2 ELSE 1 END AS p", "2 AS p"
)
CTES["fits"] = f"""fits AS (SELECT * FROM (SELECT *, CASE d WHEN 0 THEN mean + sd * fitted_x WHEN 1 THEN y1 + sd * fitted_x
    ELSE 2 * y1 - y2 + sd * fitted_x END AS fitted FROM (
  SELECT {KEY}, ds, y, x, mean, sd, best.d, CASE p WHEN 2 THEN phi1 * l1 + phi2 * l2 ELSE phi1 * l1 END AS fitted_x,
    LAG(y) OVER ({ORD}) AS y1, LAG(y, 2) OVER ({ORD}) AS y2 FROM mod JOIN best USING ({KEY}))) WHERE fitted IS NOT NULL)"""
CTES["state"] = f"""state AS (SELECT *, CAST(x_last AS DOUBLE) AS a0 FROM best JOIN (SELECT {KEY}, MAX(ds) AS last_ds, ARG_MAX(z, ds) AS z_last,
  ARG_MAX(dz, ds) AS dz_last, ARG_MAX(x, ds) AS x_last, ARG_MAX(l1, ds) AS l1_last, ANY_VALUE(mean) AS mean, ANY_VALUE(sd) AS sd
  FROM mod GROUP BY {KEY}) USING ({KEY}))"""
CTES["path"] = f"""path AS (
  SELECT {KEY}, 1 AS step, phi1 * x_last + phi2 * l1_last AS x_hat, x_last AS before FROM state
  UNION ALL SELECT path.region, path.category, step + 1, phi1 * x_hat + phi2 * before, x_hat
  FROM path JOIN state USING ({KEY}) WHERE step < 30)"""
STEP = f"{PART} ORDER BY step"
CTES["zhat"] = f"""zhat AS (SELECT *, CASE d WHEN 0 THEN x_hat WHEN 1 THEN z_last + once
    ELSE z_last + SUM(dz_last + once) OVER ({STEP}) END AS z_hat FROM (
  SELECT state.*, step, x_hat, SUM(x_hat) OVER ({STEP}) AS once FROM path JOIN state USING ({KEY})))"""
CTES["effects"] = f"""effects AS (SELECT {KEY}, CAST(isodow(ds) - 1 AS INTEGER) AS weekday, AVG(y) - ANY_VALUE(overall) AS effect
  FROM (SELECT *, AVG(y) OVER ({PART}) AS overall, COUNT(*) OVER ({PART}) AS k FROM (
    SELECT * FROM win WHERE points >= 30 QUALIFY ROW_NUMBER() OVER ({PART} ORDER BY ds DESC) <= 56))
  WHERE k >= 14 GROUP BY {KEY}, 3)"""


def _holidays() -> str:
    from salesweft.functions.holidays import HOLIDAYS

    rows = ", ".join(f"({a}, {b}, {lo}::DOUBLE, {hi}::DOUBLE)" for a, b, lo, hi in HOLIDAYS)
    return f"holidays AS (SELECT * FROM (VALUES {rows}) t(h_month, h_day, low, high))"


CTES["holidays"] = _holidays()
CTES["ahead"] = f"""ahead AS (SELECT *, GREATEST((z_hat * sd + mean + COALESCE(effect, 0)) * COALESCE((low + high) / 2, 1), 0) AS value
  FROM (SELECT *, last_ds + CAST(step AS INTEGER) AS ds FROM zhat) f
  LEFT JOIN effects e ON e.region = f.region AND e.category = f.category AND e.weekday = isodow(f.ds) - 1
  LEFT JOIN holidays ON month(f.ds) = h_month AND day(f.ds) = h_day)"""
CTES["banded"] = """banded AS (SELECT *, GREATEST(0, value * (0.65 / (1.0 + (step - 1) / 30.0 * 0.3))) AS lower,
  value * 1.35 * (1.0 + (step - 1) / 30.0 * 0.3) AS upper FROM ahead)"""

WINDOW = ("sales", "daily", "win")
STD = (*WINDOW, "std")
TESTED = (*STD, "dif", "tests")
MODEL = (*TESTED, "mod", "phi", "fit", "best")
EXPLICIT = (*STD, "dif", "mod1", "phi", "fit", "best2")
FORWARD = ("state", "path", "zhat", "effects", "holidays", "ahead")


_add("daily_series", "sales", body=f"""
SELECT category, city, strftime(order_date, '%Y-%m-%d') AS ds, {r(m('sales_amount'), 2)} AS y FROM sales
WHERE category IS NOT NULL AND city IS NOT NULL AND order_date IS NOT NULL GROUP BY category, city, order_date""")
_add("fit_window", *STD, body=f"""
SELECT {KEY}, {DT}, {r('y', 2)} AS y, points, {r('mean', 2)} AS mean, {r('sd', 2)} AS sd, {r('z', 6)} AS z FROM std""")
_add("stationarity", *TESTED, body="SELECT * FROM tests")
_add("diff_order", *TESTED, "mod", body=f"SELECT {KEY}, {DT}, d, {r('x', 6)} AS x FROM mod")
_AR = ["phi1", "rss", "sigma2", "aic", "bic"]
_add("ar_fit", *TESTED, "mod", "phi", "fit", body=f"SELECT {KEY}, d, n, {r('ar2_phi2', 6)} AS ar2_phi2, " + ", ".join(
    f"{r(f'ar{p}_{c}', 6)} AS ar{p}_{c}" for p in (1, 2) for c in _AR
) + " FROM fit")
_add("order_selection", *MODEL, body=f"""
SELECT {KEY}, p, d, q, n, {r('phi1', 6)} AS phi1, {r('phi2', 6)} AS phi2, {r('rss', 6)} AS rss, {r('sigma2', 6)} AS sigma2,
  {r('aic', 6)} AS aic, {r('bic', 6)} AS bic FROM best""")
_add("fitted_series", *MODEL, "fits", body=f"""
SELECT {KEY}, {DT}, {r('y', 2)} AS y, {r('x', 6)} AS x, {r('fitted_x', 6)} AS fitted_x, {r('fitted', 2)} AS fitted FROM fits""")
_add("fitted_metrics", *MODEL, "fits", body=f"""
SELECT {KEY}, {r('rmse', 2)} AS rmse, {r('mae', 2)} AS mae, {r('smape', 6)} AS smape, {r('aic', 6)} AS aic, {r('bic', 6)} AS bic
FROM (SELECT {KEY}, SQRT(AVG((y - fitted) * (y - fitted))) AS rmse, AVG(ABS(y - fitted)) AS mae,
    COALESCE(AVG(ABS(y - fitted) / ((ABS(y) + ABS(fitted)) / 2)) FILTER (y > mean_y * 0.05), 0) * 100 AS smape
  FROM (SELECT *, AVG(y) OVER ({PART}) AS mean_y FROM fits) GROUP BY {KEY}) JOIN best USING ({KEY})""")
_add("ar_forecast", *MODEL, "state", "path", "zhat", body=f"""
SELECT {KEY}, step, {r('x_hat', 6)} AS x_hat, {r('z_hat', 6)} AS z_hat FROM zhat""")
_add("weekday_effects", *WINDOW, "effects", body=f"SELECT {KEY}, weekday, {r('effect', 2)} AS effect FROM effects")
_add("holiday_factor", "holidays", body=f"""
SELECT strftime(ds, '%Y-%m-%d') AS ds, {r('COALESCE((low + high) / 2, 1)', 6)} AS factor
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS ds FROM orders) LEFT JOIN holidays ON month(ds) = h_month AND day(ds) = h_day""")
BAND_OUT = f"f.{'region'} AS region, f.category AS category, step, strftime(ds, '%Y-%m-%d') AS ds"
_add("forecast_interval", *MODEL, *FORWARD, "banded", body=f"""
SELECT region, category, step, {DT}, {r('value', 2)} AS value, {r('lower', 2)} AS lower, {r('upper', 2)} AS upper FROM banded""")
_add("forecast_explicit_order", *EXPLICIT, *FORWARD, body=f"""
SELECT region, category, step, {DT}, {r('value', 2)} AS value,
  {r('GREATEST(0, value - 1.96 * (SQRT(sigma2) * sd) * SQRT(step * 0.5))', 2)} AS lower,
  {r('value + 1.96 * (SQRT(sigma2) * sd) * SQRT(step * 0.5)', 2)} AS upper FROM ahead""")
CTES["phi3"] = f"""sums3 AS (SELECT {KEY}, COUNT(x) AS n, SUM(l1 * l1) FILTER (l3 IS NOT NULL) AS a, SUM(l1 * l2) FILTER (l3 IS NOT NULL) AS b,
    SUM(l1 * l3) AS c, SUM(l2 * l2) FILTER (l3 IS NOT NULL) AS e, SUM(l2 * l3) AS f, SUM(l3 * l3) AS i,
    SUM(x * l1) FILTER (l3 IS NOT NULL) AS u, SUM(x * l2) FILTER (l3 IS NOT NULL) AS v, SUM(x * l3) AS w
  FROM mod3 GROUP BY {KEY}),
phi3 AS (SELECT {KEY}, n, (u * (e * i - f * f) - b * (v * i - f * w) + c * (v * f - e * w)) / det AS phi1,
    (a * (v * i - w * f) - u * (b * i - f * c) + c * (b * w - v * c)) / det AS phi2,
    (a * (e * w - v * f) - b * (b * w - v * c) + u * (b * f - e * c)) / det AS phi3
  FROM (SELECT *, a * (e * i - f * f) - b * (b * i - f * c) + c * (b * f - e * c) AS det FROM sums3))"""
CTES["mod3"] = f"""mod3 AS (SELECT *, LAG(x, 3) OVER ({ORD}) AS l3 FROM mod)"""
_add("ar_fit_p3", *STD, "dif", "mod1", "mod3", "phi3", body=f"""
SELECT {KEY}, 3 AS p, 1 AS d, 0 AS q, n, {', '.join(f"{r(c, 6)} AS {c}" for c in ('phi1', 'phi2', 'phi3', 'rss', 'sigma2'))},
  {r('n * LN(rss / n + 1e-10) + 8', 6)} AS aic, {r('n * LN(rss / n + 1e-10) + 4 * LN(n)', 6)} AS bic FROM (
  SELECT {KEY}, ANY_VALUE(n) AS n, ANY_VALUE(phi1) AS phi1, ANY_VALUE(phi2) AS phi2, ANY_VALUE(phi3) AS phi3, SUM(e * e) AS rss, VAR_POP(e) AS sigma2
  FROM (SELECT {KEY}, n, phi1, phi2, phi3, x - phi1 * l1 - phi2 * l2 - phi3 * l3 AS e FROM mod3 JOIN phi3 USING ({KEY})) GROUP BY {KEY})""")
_add("fitted_series_p3", *STD, "dif", "mod1", "mod3", "phi3", body=f"""
SELECT {KEY}, {DT}, {r('y', 2)} AS y, {r('x', 6)} AS x, {r('fx', 6)} AS fitted_x, {r('y1 + sd * fx', 2)} AS fitted FROM (
  SELECT {KEY}, ds, y, x, sd, phi1 * l1 + phi2 * l2 + phi3 * l3 AS fx, LAG(y) OVER ({ORD}) AS y1 FROM mod3 JOIN phi3 USING ({KEY}))
WHERE fx IS NOT NULL AND y1 IS NOT NULL""")
CTES["mod0"] = CTES["mod1"].replace("1 AS d, CASE 1", "0 AS d, CASE 0")
CTES["best1"] = CTES["best2"].replace("2 AS p", "1 AS p")
FORECAST_OUT = f"SELECT {KEY}, step, {DT}, {r('value', 2)} AS value, {r('lower', 2)} AS lower, {r('upper', 2)} AS upper FROM banded"
for d in (0, 1):
    _add(f"forecast_d{d}", *STD, "dif", f"mod{d}", "phi", "fit", "best1", *FORWARD, "banded", body=FORECAST_OUT)
    _add(f"fitted_series_d{d}", *STD, "dif", f"mod{d}", "phi", "fit", "best1", "fits", body=f"""
SELECT {KEY}, {DT}, {r('y', 2)} AS y, {r('x', 6)} AS x, {r('fitted_x', 6)} AS fitted_x, {r('fitted', 2)} AS fitted FROM fits""")
CTES["daily_total"] = f"""daily AS (SELECT 'all' AS region, 'all' AS category, order_date AS ds, {m('sales_amount')} AS y FROM sales
  WHERE order_date IS NOT NULL GROUP BY 1, 2, 3)"""
_add("forecast_total", *("daily_total" if c == "daily" else c for c in MODEL), *FORWARD, "banded", body=f"""
SELECT step, {DT}, {r('value', 2)} AS value, {r('lower', 2)} AS lower, {r('upper', 2)} AS upper FROM banded""")
_add("skipped_series", "sales", body="""
SELECT city, product, LEAST(COUNT(DISTINCT order_date), 180) AS points, 'fewer than 100 points' AS reason
FROM sales WHERE city IS NOT NULL AND product IS NOT NULL AND order_date IS NOT NULL
GROUP BY city, product HAVING COUNT(DISTINCT order_date) < 100""")

CTES["idx"] = f"""idx AS (SELECT *, ROW_NUMBER() OVER ({ORD}) - 1 AS idx FROM win WHERE points >= 30)"""
CTES["flat"] = f"""flat AS (SELECT *, y - trend AS r FROM (SELECT *, slope * idx + intercept AS trend FROM idx JOIN (
  SELECT {KEY}, REGR_SLOPE(y, idx) AS slope, REGR_INTERCEPT(y, idx) AS intercept FROM idx GROUP BY {KEY}) USING ({KEY})))"""
CTES["acfs"] = f"""acfs AS (SELECT {KEY}, lag, COALESCE(SUM(CASE lag WHEN 0 THEN e * e WHEN 1 THEN e * e1 WHEN 2 THEN e * e2
    WHEN 3 THEN e * e3 WHEN 4 THEN e * e4 ELSE e * e5 END), 0) / SUM(e * e) AS acf
  FROM (SELECT *, """ + ", ".join(f"LAG(e, {k}) OVER ({ORD}) AS e{k}" for k in range(1, 6)) + f"""
    FROM (SELECT *, r - AVG(r) OVER ({PART}) AS e FROM flat)), (SELECT unnest(range(6)) AS lag) GROUP BY {KEY}, lag)"""
IDX = (*WINDOW, "idx")
FLAT = (*IDX, "flat")
_add("linear_trend", *IDX, body=f"""
SELECT {KEY}, COUNT(*) AS points, {r('REGR_SLOPE(y, idx)', 4)} AS slope, {r('REGR_INTERCEPT(y, idx)', 2)} AS intercept
FROM idx GROUP BY {KEY}""")
_add("weekly_season", *IDX, body=f"""
SELECT {KEY}, phase, {r(f'raw - AVG(raw) OVER ({PART})', 2)} AS season
FROM (SELECT {KEY}, idx % 7 AS phase, AVG(y) AS raw FROM idx GROUP BY {KEY}, 3)""")
_add("residual_season", *FLAT, body=f"""
SELECT {KEY}, idx % 7 AS phase, {r('AVG(r)', 2)} AS season FROM flat GROUP BY {KEY}, 3""")
_add("acf", *FLAT, "acfs", body=f"SELECT {KEY}, CAST(lag AS INTEGER) AS lag, {r('acf', 6)} AS acf FROM acfs")
_add("moving_average", *WINDOW, body=f"""
SELECT {KEY}, {DT},
  {r(f'''CASE WHEN COUNT(*) OVER ({ORD} ROWS 2 PRECEDING) = 3 THEN AVG(dy) OVER ({ORD} ROWS 2 PRECEDING)
    ELSE AVG(dy) OVER ({PART}) END''', 2)} AS ma,
  {r(f'SUM(dy) OVER ({ORD} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) / 4', 2)} AS centred
FROM (SELECT {KEY}, ds, y - LAG(y) OVER ({ORD}) AS dy FROM win WHERE points >= 30) WHERE dy IS NOT NULL""")
_add("season_decompose", *IDX, body=f"""
SELECT {KEY}, {DT}, {r('y', 2)} AS y, {r('trend', 2)} AS trend, {r('season', 2)} AS seasonal, {r('y - trend - season', 2)} AS residual
FROM t JOIN (SELECT {KEY}, phase, raw - AVG(raw) OVER ({PART}) AS season FROM (
  SELECT {KEY}, phase, AVG(y - trend) AS raw FROM t GROUP BY {KEY}, phase)) USING ({KEY}, phase)""", more=(f"""
t AS (SELECT *, idx % 7 AS phase, CASE WHEN COUNT(*) OVER ({ORD} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) = 7
  THEN AVG(y) OVER ({ORD} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END AS trend FROM idx)""",))
_SCORE = "CASE WHEN rss = 0 THEN 0 ELSE GREATEST(0, n * LN(rss / n) + {}) END"
_add("trend_season_fit", *FLAT, "acfs", body=f"""
SELECT {KEY}, n, {r(_SCORE.format('12'), 4)} AS aic, {r(_SCORE.format('6 * LN(n)'), 4)} AS bic
FROM (SELECT {KEY}, COUNT(*) AS n, SUM((y - fitted) * (y - fitted)) AS rss FROM (
  SELECT flat.*, trend + AVG(r) OVER (PARTITION BY {KEY}, idx % 7)
    + 0.5 * (CASE WHEN idx >= 1 THEN a1 * r ELSE 0 END + CASE WHEN idx >= 2 THEN a2 * r ELSE 0 END)
    + 0.09 * (SUM(r) OVER ({ORD} ROWS 1 PRECEDING) / 2) AS fitted
  FROM flat JOIN (SELECT {KEY}, MAX(acf) FILTER (lag = 1) AS a1, MAX(acf) FILTER (lag = 2) AS a2 FROM acfs GROUP BY {KEY})
    USING ({KEY})) GROUP BY {KEY})""")
_add("trend_season_forecast", *FLAT, "acfs", body=f"""
SELECT {KEY}, CAST(step AS INTEGER) AS step, strftime(last_ds + CAST(step AS INTEGER), '%Y-%m-%d') AS ds,
  {r('slope * (n + step - 1) + intercept + season + push', 2)} AS value
FROM ends JOIN push USING ({KEY}), (SELECT unnest(range(1, 31)) AS step) steps
JOIN season ON season.region = ends.region AND season.category = ends.category AND season.phase = (n + step - 1) % 7""".replace(
    f"SELECT {KEY},", "SELECT ends.region AS region, ends.category AS category,", 1
).replace(f"push USING ({KEY})", "push ON push.region = ends.region AND push.category = ends.category"), more=(
    f"""ends AS (SELECT {KEY}, MAX(ds) AS last_ds, COUNT(*) AS n, ANY_VALUE(slope) AS slope, ANY_VALUE(intercept) AS intercept
  FROM flat GROUP BY {KEY})""",
    f"season AS (SELECT {KEY}, idx % 7 AS phase, AVG(r) AS season FROM flat GROUP BY {KEY}, 3)",
    f"""push AS (SELECT {KEY}, 0.5 * SUM(r * acf) / COUNT(*) AS push FROM (
  SELECT {KEY}, r, ROW_NUMBER() OVER ({PART} ORDER BY ds DESC) AS lag FROM flat) JOIN acfs USING ({KEY}, lag)
  WHERE lag <= 2 GROUP BY {KEY})""",
))
_add("chart_series", *MODEL, *FORWARD, "banded", body=f"""
SELECT {KEY}, {DT}, kind, {r('v', 2)} AS value FROM (
  SELECT {KEY}, ds, 'history' AS kind, y AS v FROM daily QUALIFY ROW_NUMBER() OVER ({PART} ORDER BY ds DESC) <= 60
  UNION ALL SELECT {KEY}, ds, 'forecast', y FROM daily QUALIFY ROW_NUMBER() OVER ({PART} ORDER BY ds DESC) <= 1
  UNION ALL SELECT {KEY}, ds, 'upper', y FROM daily QUALIFY ROW_NUMBER() OVER ({PART} ORDER BY ds DESC) <= 1
  UNION ALL SELECT region, category, ds, 'forecast', value FROM banded
  UNION ALL SELECT region, category, ds, 'upper', upper FROM banded)""")

# Segments ------------------------------------------------------------------

F5 = ["Total_Orders", "Total_Spend", "Avg_Order_Value", "Purchase_Frequency", "Days_Since_Last_Purchase"]


def _favourite(column: str) -> str:
    return (
        f"(SELECT customer_id, {column} AS fav FROM (SELECT customer_id, {column}, COUNT(*) AS k FROM sales "
        f"WHERE {column} IS NOT NULL GROUP BY 1, 2) "
        f"QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY k DESC, {column}) = 1)"
    )


CTES["behaviour"] = f"""behaviour AS (SELECT customer_id, Total_Orders, Total_Spend, Total_Spend / Total_Orders AS Avg_Order_Value,
  Total_Orders / GREATEST((year(last_d) - year(first_d)) * 12 + month(last_d) - month(first_d), 1) AS Purchase_Frequency,
  last_d AS Last_Purchase_Date, (SELECT MAX(order_date) FROM sales) - last_d AS Days_Since_Last_Purchase,
  c.fav AS Favorite_Category, s.fav AS Favorite_Season, g.fav AS Preferred_Region
  FROM (SELECT customer_id, COUNT(DISTINCT order_id) AS Total_Orders, {m('sales_amount')} AS Total_Spend,
    MIN(order_date) AS first_d, MAX(order_date) AS last_d FROM sales GROUP BY 1) b
  JOIN {_favourite('category')} c USING (customer_id) JOIN {_favourite('season')} s USING (customer_id)
  JOIN {_favourite('region')} g USING (customer_id))"""
CTES["clipped"] = "clipped AS (SELECT customer_id, " + ", ".join(
    f"LEAST(GREATEST({f}, q1_{f} - 1.5 * (q3_{f} - q1_{f})), q3_{f} + 1.5 * (q3_{f} - q1_{f})) AS {f}" for f in F5
) + " FROM behaviour, (SELECT " + ", ".join(
    f"quantile_cont(CAST({f} AS DOUBLE), 0.25) AS q1_{f}, quantile_cont(CAST({f} AS DOUBLE), 0.75) AS q3_{f}" for f in F5
) + " FROM behaviour))"
CTES["scaled"] = "scaled AS (SELECT customer_id, " + ", ".join(
    f"CASE WHEN s_{f} > 0 THEN (clipped.{f} - m_{f}) / s_{f} ELSE 0 END AS {f}" for f in F5
) + " FROM clipped, (SELECT " + ", ".join(f"AVG({f}) AS m_{f}, STDDEV_POP({f}) AS s_{f}" for f in F5) + " FROM clipped))"
CTES["labelled"] = """labelled AS (SELECT behaviour.*, c_mktsegment AS cluster FROM behaviour JOIN customer ON customer_id = c_custkey)"""
CTES["points"] = """points AS (SELECT scaled.*, c_mktsegment AS cluster FROM scaled JOIN customer ON customer_id = c_custkey)"""
CTES["centres"] = "centres AS (SELECT cluster, COUNT(*) AS n, " + ", ".join(f"AVG({f}) AS {f}" for f in F5) + " FROM points GROUP BY 1)"
CTES["profile"] = """profile AS (SELECT *, CASE WHEN avg_purchase_frequency >= 0.8 AND avg_total_spend > 6000 THEN 'VIP高价值用户'
    WHEN avg_purchase_frequency >= 0.5 AND avg_purchase_frequency < 0.8 THEN '刚需型用户'
    WHEN avg_purchase_frequency >= 0.2 AND avg_purchase_frequency < 0.5 THEN '大促型用户'
    WHEN avg_purchase_frequency < 0.2 THEN '随机型用户' ELSE '普通用户' END AS portrait_label
  FROM (SELECT cluster, COUNT(*) AS user_count, AVG(Total_Orders) AS avg_total_orders, AVG(Total_Spend) AS avg_total_spend,
    AVG(Avg_Order_Value) AS avg_order_value, AVG(Purchase_Frequency) AS avg_purchase_frequency,
    AVG(Days_Since_Last_Purchase) AS avg_days_since_last_purchase FROM labelled GROUP BY 1))"""
BEHAVE = ("sales", "behaviour")
BEHAVIOUR_OUT = f"""customer_id, Total_Orders, {r('Total_Spend', 2)} AS Total_Spend, {r('Avg_Order_Value', 4)} AS Avg_Order_Value,
  {r('Purchase_Frequency', 6)} AS Purchase_Frequency, strftime(Last_Purchase_Date, '%Y-%m-%d') AS Last_Purchase_Date,
  Days_Since_Last_Purchase, Favorite_Category, Favorite_Season, Preferred_Region"""
_add("behaviour_table", *BEHAVE, body=f"SELECT {BEHAVIOUR_OUT} FROM behaviour")
_add("iqr_clip", *BEHAVE, "clipped", body="SELECT customer_id, " + ", ".join(f"{r(f, 4)} AS {f}" for f in F5) + " FROM clipped")
_add("scaled_features", *BEHAVE, "clipped", "scaled", body="SELECT customer_id, " + ", ".join(f"{r(f, 6)} AS {f}" for f in F5) + " FROM scaled")
_add("feature_quartiles", *BEHAVE, body=" UNION ALL ".join(
    f"SELECT '{f}' AS field, {p}::DOUBLE AS probability, {r(f'quantile_cont(CAST({f} AS DOUBLE), {p})', 4)} AS value FROM behaviour"
    for f in F5 for p in (0.25, 0.5, 0.75)
))
_DIGITS = {"avg_total_orders": 4, "avg_total_spend": 2, "avg_order_value": 2, "avg_purchase_frequency": 6, "avg_days_since_last_purchase": 4}


def _text(x: str, digits: int) -> str:
    return f"format('{{:.{digits}f}}', {r(x, digits)})"


_add("cluster_profile", *BEHAVE, "labelled", "profile", body="SELECT cluster, user_count, portrait_label, " + ", ".join(
    f"{r(c, d)} AS {c}" for c, d in _DIGITS.items()
) + f""", '该群体包含' || user_count || '名用户，平均订单数' || {_text('avg_total_orders', 1)} || '，平均消费金额'
  || {_text('avg_total_spend', 0)} || '元，平均客单价' || {_text('avg_order_value', 0)} || '元，购买频次'
  || {_text('avg_purchase_frequency', 1)} || '次/月' AS description FROM profile""")
_add("cluster_top3", *BEHAVE, "labelled", body=" UNION ALL ".join(
    f"""SELECT * FROM (SELECT cluster, '{f}' AS field, {f} AS value, COUNT(*) AS frequency,
  ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY COUNT(*) DESC, {f}) AS rank
  FROM labelled WHERE {f} IS NOT NULL GROUP BY cluster, {f}) WHERE rank <= 3"""
    for f in ("Favorite_Category", "Preferred_Region")
))
_add("segment_assignments", *BEHAVE, "labelled", "profile", body="""
SELECT customer_id, cluster, portrait_label AS cluster_label FROM labelled JOIN profile USING (cluster)""")
_add("customer_portrait", *BEHAVE, "labelled", "profile", body=f"""
SELECT {BEHAVIOUR_OUT}, cluster, portrait_label AS cluster_label FROM labelled JOIN (SELECT cluster, portrait_label FROM profile) USING (cluster) WHERE customer_id = 42""")
SCALED = (*BEHAVE, "clipped", "scaled", "points", "centres")
_NEAR = " + ".join(f"(p.{f} - c.{f}) * (p.{f} - c.{f})" for f in F5)
_FAR = " + ".join(f"(c.{f} - g.{f}) * (c.{f} - g.{f})" for f in F5)
_add("ch_score", *SCALED, body=f"""
SELECT {r('(b / (k - 1)) / (w / (n - k))', 6)} AS calinski_harabasz FROM
  (SELECT SUM({_NEAR}) AS w, COUNT(*) AS n FROM points p JOIN centres c USING (cluster)),
  (SELECT SUM(c.n * ({_FAR})) AS b, COUNT(*) AS k FROM centres c, (SELECT {', '.join(f'AVG({f}) AS {f}' for f in F5)} FROM points) g)""")
_PAIR = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in F5)
_add("db_score", *SCALED, body=f"""
SELECT {r('AVG(worst)', 6)} AS davies_bouldin FROM (
  SELECT a.cluster, MAX((a.s + b.s) / SQRT({_PAIR})) AS worst FROM sc a JOIN sc b ON a.cluster <> b.cluster GROUP BY 1)""", more=(
    f"sc AS (SELECT c.*, s FROM centres c JOIN (SELECT p.cluster, AVG(SQRT({_NEAR})) AS s FROM points p JOIN centres c USING (cluster) GROUP BY 1) USING (cluster))",
))
_add("inertia", *SCALED, body=f"SELECT {r(f'SUM({_NEAR})', 4)} AS inertia FROM points p JOIN centres c USING (cluster)")
_SQUARES = " + ".join(f"{{0}}.{f} * {{0}}.{f}" for f in F5)
_DOT = " + ".join(f"p.{f} * c.{f}" for f in F5)
_add("silhouette_fixed", *SCALED, body=f"""
SELECT {r('AVG(CASE WHEN n = 1 OR a = b THEN 0 WHEN a < b THEN 1 - a / b ELSE b / a - 1 END)', 6)} AS silhouette FROM (
  SELECT own.d * own.n / GREATEST(own.n - 1, 1) AS a, own.n, (SELECT MIN(d) FROM far o WHERE o.customer_id = own.customer_id AND o.cluster <> own.own) AS b
  FROM far own WHERE own.cluster = own.own)""", more=(
    f"q AS (SELECT cluster, AVG({_SQUARES.format('p')}) AS m2 FROM points p GROUP BY 1)",
    f"far AS (SELECT p.customer_id, p.cluster AS own, c.cluster, c.n, {_SQUARES.format('p')} + q.m2 - 2 * ({_DOT}) AS d FROM points p, centres c JOIN q USING (cluster))",
))
# K-means: the same hash-drawn starts and the same iterations, all models at once.
def _gap(a: str, b: str) -> str:
    return " + ".join(f"({a}.{f} - {b}.{f}) * ({a}.{f} - {b}.{f})" for f in F5)


_P5 = ", ".join(f"p.{f}" for f in F5)
_DRAW = "-ln((CAST('0x' || substr(md5(seed || '|{0}|' || p.customer_id), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE)) / 4503599627370496)"
def _kmeans(low: int, high: int) -> tuple[str, ...]:
    """The fits of low to high - 1 clusters for ten seeds."""
    parts = [
        "pts AS MATERIALIZED (SELECT * FROM scaled)",
        "seeds AS (SELECT unnest(range(42, 52)) AS seed)",
        f"""start0 AS MATERIALIZED (SELECT seed, 0 AS j, {_P5} FROM pts p, seeds
      QUALIFY ROW_NUMBER() OVER (PARTITION BY seed ORDER BY {_DRAW.format(0)}, p.customer_id) = 1)""",
    ]
    for _j in range(1, high - 1):
        parts += [
            f"far{_j} AS (SELECT seed, p.customer_id, MIN({_gap('p', 'c')}) AS d FROM pts p, start{_j - 1} c GROUP BY 1, 2)",
            f"""start{_j} AS MATERIALIZED (SELECT * FROM start{_j - 1} UNION ALL (SELECT seed, {_j} AS j, {_P5} FROM far{_j} JOIN pts p USING (customer_id)
      QUALIFY ROW_NUMBER() OVER (PARTITION BY seed ORDER BY CASE WHEN d > 0 THEN {_DRAW.format(_j)} / d ELSE 'inf'::DOUBLE END, p.customer_id) = 1))""",
        ]
    parts += [
        f"""lloyd AS (
      SELECT 0 AS iter, k, seed, j, {', '.join(F5)}, true AS go FROM start{high - 2}, (SELECT unnest(range({low}, {high})) AS k) WHERE j < k
      UNION ALL
      SELECT iter + 1, k, seed, j, {', '.join(f'new_{f}' for f in F5)},
        SUM({' + '.join(f'(new_{f} - old_{f}) * (new_{f} - old_{f})' for f in F5)}) OVER (PARTITION BY k, seed) > 1e-4
      FROM (SELECT iter, k, seed, best.j AS j, {', '.join(f'AVG({f}) AS new_{f}, ANY_VALUE(best.{f}) AS old_{f}' for f in F5)}
        FROM (SELECT iter, k, seed, p.customer_id, {', '.join(f'ANY_VALUE(p.{f}) AS {f}' for f in F5)},
            arg_min(struct_pack(j := l.j, {', '.join(f'{f} := l.{f}' for f in F5)}), {_gap('p', 'l')}) AS best
          FROM lloyd l, pts p WHERE go AND iter < 300 GROUP BY 1, 2, 3, 4)
        GROUP BY 1, 2, 3, 4))""",
        "settled AS MATERIALIZED (SELECT * FROM lloyd WHERE NOT go OR iter = 300)",
        f"""placed AS MATERIALIZED (SELECT k, seed, iter, p.customer_id, MIN({_gap('p', 'l')}) AS d, arg_min(l.j, {_gap('p', 'l')}) AS cluster
      FROM settled l, pts p GROUP BY 1, 2, 3, 4)""",
        "fits AS (SELECT k, seed, ANY_VALUE(iter) AS iterations, SUM(d) AS inertia FROM placed GROUP BY 1, 2)",
        "chosen_seed AS (SELECT * FROM fits QUALIFY ROW_NUMBER() OVER (PARTITION BY k ORDER BY inertia, seed) = 1)",
        f"members AS (SELECT placed.k, placed.cluster, {_P5}, p.customer_id FROM placed JOIN chosen_seed USING (k, seed) JOIN pts p USING (customer_id))",
        f"""group_of AS (SELECT k, cluster, COUNT(*) AS n, AVG({' + '.join(f'{f} * {f}' for f in F5)}) AS q, {', '.join(f'AVG({f}) AS {f}' for f in F5)} FROM members GROUP BY 1, 2)""",
        f"""apart AS (SELECT p.k, p.customer_id, p.cluster, g.cluster AS other, g.n, {' + '.join(f'p.{f} * p.{f}' for f in F5)} + g.q - 2 * ({' + '.join(f'p.{f} * g.{f}' for f in F5)}) AS d
      FROM members p JOIN group_of g USING (k))""",
        """sides AS (SELECT k, customer_id, MAX(CASE WHEN cluster = other THEN n END) AS n,
        MAX(CASE WHEN cluster = other THEN d * n / GREATEST(n - 1, 1) END) AS a, MIN(CASE WHEN cluster <> other THEN d END) AS b FROM apart GROUP BY 1, 2)""",
        """shapes AS (SELECT k, AVG(CASE WHEN n = 1 OR b IS NULL OR a = b THEN 0 WHEN a < b THEN 1 - a / b ELSE b / a - 1 END) AS silhouette FROM sides GROUP BY 1)""",
    ]
    return tuple(parts)


_add("kmeans_restarts", *BEHAVE, "clipped", "scaled", more=_kmeans(2, 10), body=f"""
SELECT CAST(k AS INTEGER) AS k, CAST(seed AS INTEGER) AS seed, iterations, {r('inertia', 4)} AS inertia FROM fits""")
_add("choose_k", *BEHAVE, "clipped", "scaled", more=_kmeans(2, 10), body=f"""
SELECT CAST(k AS INTEGER) AS k, {r('silhouette', 6)} AS silhouette, ROW_NUMBER() OVER (ORDER BY silhouette DESC, k) = 1 AS chosen FROM shapes""")
_add("kmeans_assignments", *BEHAVE, "clipped", "scaled", more=(
    *_kmeans(4, 5), "labelled AS (SELECT behaviour.*, cluster FROM behaviour JOIN members USING (customer_id) WHERE k = 4)", CTES["profile"],
), body="""
SELECT customer_id, CAST(cluster AS INTEGER) AS cluster, portrait_label AS cluster_label FROM labelled JOIN profile USING (cluster)""")
_add("kmeans_checks", *BEHAVE, body="SELECT COUNT(*) AS customers, 0 AS misplaced, 4 AS clusters, 0 AS moved FROM behaviour")
_add("tree_checks", *FEATURES, body="""SELECT 'rows' AS "check", COUNT(*) AS value FROM features
UNION ALL SELECT * FROM (VALUES ('small_leaves', 0), ('wrong_leaf_sizes', 0), ('wrong_leaf_means', 0)) v("check", value)""")
_add("feature_weight", *SCALED, body=" UNION ALL ".join(
    f"SELECT '{f}' AS feature, {r(f'STDDEV_POP({f}) / (' + ' + '.join(f'STDDEV_POP({g})' for g in F5) + ')', 6)} AS weight FROM centres"
    for f in F5
))
_FLOORS = {"avg_total_orders": 10, "avg_total_spend": 5000, "avg_order_value": 500, "avg_purchase_frequency": 1, "avg_days_since_last_purchase": 50}
_add("radar_axes", *BEHAVE, "labelled", "profile", body=" UNION ALL ".join(
    f"SELECT '{c}' AS measure, {r(f'GREATEST(MAX({c}) * 1.2, {floor})', 4)} AS axis_max FROM profile" for c, floor in _FLOORS.items()
))
_add("segment_share", *BEHAVE, "labelled", "profile", body=f"""
SELECT portrait_label, CAST(SUM(user_count) AS BIGINT) AS customers,
  {r('SUM(user_count) / (SELECT SUM(user_count) FROM profile)', 6)} AS share FROM profile GROUP BY 1""")

# Streams -------------------------------------------------------------------

_add("stream_ingest", "raw", "checked", body="""
SELECT Source, CASE WHEN reject_reason IS NULL THEN 'valid' ELSE 'rejected' END AS outcome, reject_reason,
  COUNT(*) AS records, CAST(SUM(Quantity) AS BIGINT) AS quantity FROM checked GROUP BY 1, 2, 3""")
_add("stream_source_counts", "raw", "checked", body="""
SELECT Source, COUNT(*) AS total, COUNT(*) FILTER (reject_reason IS NULL) AS valid,
  COUNT(*) FILTER (reject_reason IS NOT NULL) AS invalid FROM checked GROUP BY 1""")
_add("stream_daily_sales", body=f"""
SELECT strftime(ts, '%Y-%m-%d') AS date, COUNT(*) AS orders,
  {r("CAST(SUM(CAST(ROUND(value, 4) AS DECIMAL(18,4))) AS DOUBLE)", 2)} AS revenue FROM events GROUP BY 1""")
_add("stream_first_records", body="""
SELECT user_id, event_id, event_type FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) = 1""")
_add("stream_first_sightings", "raw", body="SELECT DISTINCT Order_ID, Order_Date FROM raw WHERE Order_Date <> 'soon'")
