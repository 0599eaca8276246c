"""Rider commission: queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillworks import fixed_values as fv
from tillworks.operators import commission as ops
from tillworks.operators import riders as rider_ops
from tillworks.plans import ctes as c
from tillworks.plans.registry import query
from tillworks.sources import standin as s

START, END = "1995-01-01", "2001-12-31"


def _price(names):
    return c.msum("o_totalprice", where=f"o_orderpriority IN {c.in_list(names)}")


SUMS = f"""rs AS (
  SELECT o_custkey AS rider_id, transaction_date, CASE o_custkey % 5 WHEN 0 THEN 'BLITZ' WHEN 1 THEN 'HMS' ELSE 'JW' END || o_custkey AS rider_code,
         CASE WHEN year(transaction_date) < 1998 THEN lpad(CAST(c_nationkey AS VARCHAR), 5, '0') ELSE 'H1' END AS hub_code,
         cash AS total_price_after_discount_cash, qris AS total_price_after_discount_qris, app AS total_price_after_discount_app, total_item_qty,
         CASE WHEN o_custkey % 19 <> 0 THEN CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '1' WHEN 'BUILDING' THEN '2' WHEN 'FURNITURE' THEN '3' WHEN 'HOUSEHOLD' THEN '4' WHEN 'MACHINERY' THEN '5' END
              ELSE 'NaN' END AS commission_scheme_id,
         CASE WHEN o_custkey % 4 <> 0 THEN CAST(1 + o_custkey % 3 AS VARCHAR) ELSE 'NaN' END AS commission_extra_scheme_id,
         CASE WHEN o_custkey % 3 = 0 THEN 'product_sold' ELSE 'daily_sales' END AS commission_extra_type,
         CASE WHEN o_custkey % 23 = 0 THEN {c.q(fv.FRANCHISE_MODEL)} WHEN c_nationkey % 3 <> 0 THEN {c.q(fv.OWNED_MODEL)} ELSE '-' END AS ownership_status
  FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS transaction_date, {_price(['1-URGENT', '2-HIGH'])} AS cash, {_price(['3-MEDIUM', '5-LOW'])} AS qris,
               {_price(['4-NOT SPECIFIED'])} AS app, count(*) AS total_item_qty FROM orders GROUP BY 1, 2) o JOIN customer ON o_custkey = c_custkey),
prod AS (
  SELECT o_custkey AS rider_id, CAST(o_orderdate AS DATE) AS transaction_date, l_partkey AS product_id, p_brand AS sku_code, CASE WHEN l_partkey % 6 <> 0 THEN 'S' || l_partkey END AS short_code,
         p_name AS product_name, p_retailprice AS product_price, CAST(l_quantity AS BIGINT) AS qty, l_extendedprice AS total_price, l_extendedprice * l_discount AS total_bundling_discount,
         l_extendedprice * (1 - l_discount) AS total_price_after_discount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
schemes AS (SELECT CAST(i AS VARCHAR) AS id, CASE WHEN i IN (1, 4) THEN 'weekly_sales' WHEN i = 3 THEN 'product_sold' ELSE 'daily_sales' END AS type,
                   CAST(i * 10000 AS DOUBLE) AS att, CASE WHEN i IN (2, 5) THEN CAST(i AS DOUBLE) END AS pct FROM range(1, 6) t(i)),
extras AS (SELECT CAST(i AS VARCHAR) AS id, CASE WHEN i = 1 THEN 'product_sold' ELSE 'daily_sales' END AS type, CAST(i * 500 AS DOUBLE) AS att,
                  CASE WHEN i > 1 THEN i / 4.0::DOUBLE END AS pct FROM range(1, 4) t(i)),
tiers AS (SELECT *, lead(start_range) OVER (PARTITION BY commission_scheme_id ORDER BY start_range) AS next_start_range FROM (
  SELECT i AS id, CASE WHEN i < 8 THEN '1' ELSE '4' END AS commission_scheme_id, CAST((i % 8) * 500000 AS DOUBLE) AS start_range,
         CAST(CASE WHEN i < 8 THEN (i % 8 + 1) * 500000 ELSE (i % 8) * 500000 + 400000 END AS DOUBLE) AS end_range, CAST(i % 8 + 1 AS INTEGER) AS tier,
         CAST(i % 8 + 2 AS DOUBLE) AS commission_in_percentage, CASE WHEN i % 2 = 0 THEN CAST((i % 8) * 1000 AS DOUBLE) END AS attendance_commission_in_idr FROM range(0, 16) t(i)) x),
rates AS (SELECT DISTINCT sid AS scheme, p_brand AS sku_code, CAST(length(p_brand) * 100 AS DOUBLE) AS idr FROM part, (VALUES ('3'), ('2')) v(sid) WHERE p_brand NOT LIKE '%7'),
erates AS (SELECT DISTINCT '1' AS scheme, p_brand AS sku_code, 25.0::DOUBLE AS idr FROM part WHERE p_brand NOT LIKE '%1')"""


def _products(src, summ):
    return f"""cp AS (
  SELECT p.rider_id, p.transaction_date, product_id, p.sku_code, short_code, product_name, product_price, qty, total_price, total_bundling_discount, total_price_after_discount,
         qty * r.idr AS total_product_sold_commission, qty * CASE WHEN commission_extra_type = 'product_sold' THEN e.idr ELSE 0 END AS total_product_sold_commission_extra,
         r.idr AS commission_per_product_in_idr, CASE WHEN commission_extra_type = 'product_sold' THEN e.idr ELSE 0 END AS commission_extra_per_product_in_idr
  FROM (SELECT rider_id, transaction_date, product_id, sku_code, coalesce(short_code, '0') AS short_code, product_name, product_price, CAST(sum(qty) AS BIGINT) AS qty,
               {c.msum('total_price', True)} AS total_price, {c.msum('total_bundling_discount', True)} AS total_bundling_discount, {c.msum('total_price_after_discount', True)} AS total_price_after_discount
        FROM {src} GROUP BY 1, 2, 3, 4, 5, 6, 7) p
  LEFT JOIN {summ} d ON p.rider_id = d.rider_id AND p.transaction_date = d.transaction_date
  LEFT JOIN rates r ON r.scheme = d.commission_scheme_id AND r.sku_code = p.sku_code
  LEFT JOIN erates e ON e.scheme = d.commission_extra_scheme_id AND e.sku_code = p.sku_code)"""


def _daily(summ, revenue):
    return f"""cd AS (
  SELECT d.*, CASE WHEN s.type = 'product_sold' THEN sold ELSE {revenue} * s.pct * 0.01::DOUBLE END AS daily_commission,
         CASE WHEN e.type = 'product_sold' THEN sold_extra ELSE {revenue} * e.pct * 0.01::DOUBLE END AS daily_commission_extra,
         s.att AS attendance_commission, e.att AS attendance_commission_extra, s.pct AS daily_sales_commission_percentage, e.pct AS daily_sales_commission_extra_percentage
  FROM {summ} d LEFT JOIN schemes s ON d.commission_scheme_id = s.id LEFT JOIN extras e ON d.commission_extra_scheme_id = e.id
  LEFT JOIN (SELECT rider_id, transaction_date, {c.msum('total_product_sold_commission', True)} AS sold, {c.msum('total_product_sold_commission_extra', True)} AS sold_extra FROM cp GROUP BY 1, 2) q
    ON d.rider_id = q.rider_id AND d.transaction_date = q.transaction_date)"""


def _weekly(summ, columns):
    total = " + ".join(f"{c.msum(x, True)}" for x in columns)
    return f"""facts AS (
  SELECT rider_id, rider_code, hub_code, {total} AS total_revenue, count(DISTINCT transaction_date) AS total_operating_days,
         arg_max(commission_scheme_id, transaction_date) AS commission_scheme_id FROM {summ} GROUP BY 1, 2, 3),
tiered AS (
  SELECT f.*, tier, commission_in_percentage, attendance_commission_in_idr, next_start_range, start_range, end_range
  FROM facts f LEFT JOIN tiers t ON f.commission_scheme_id = t.commission_scheme_id AND total_revenue BETWEEN start_range AND end_range),
cw AS (
  SELECT t.rider_id, DATE '{START}' AS start_date, DATE '{END}' AS end_date, rider_code, hub_code, total_revenue, total_operating_days,
         coalesce(s.type = 'weekly_sales', FALSE) AS is_weekly_commission, nullif(commission_scheme_id, 'NaN') AS weekly_commission_scheme_id,
         commission_in_percentage AS current_weekly_commission_percentage, tier AS current_commission_tier, next_start_range AS next_revenue_target,
         CASE WHEN s.type IN ('daily_sales', 'product_sold') THEN a ELSE coalesce(total_revenue * commission_in_percentage * 0.01::DOUBLE, 0) END AS total_commission,
         CASE WHEN s.type IN ('daily_sales', 'product_sold') THEN b ELSE total_operating_days * coalesce(attendance_commission_in_idr, 0) END AS total_attendance_commission,
         e AS total_commission_extra, g AS total_attendance_commission_extra
  FROM tiered t LEFT JOIN schemes s ON t.commission_scheme_id = s.id
  LEFT JOIN (SELECT rider_id, {c.msum('daily_commission', True)} AS a, {c.msum('attendance_commission', True)} AS b, {c.msum('daily_commission_extra', True)} AS e,
                    {c.msum('attendance_commission_extra', True)} AS g FROM cd GROUP BY 1) q ON t.rider_id = q.rider_id)"""


_REV3 = "(" + " + ".join(f"coalesce({x}, 0)" for x in ops.REVENUE) + ")"
_REV2 = "(" + " + ".join(f"coalesce({x}, 0)" for x in ops.REVENUE[:2]) + ")"
HEAD = c.with_(SUMS, _products("prod", "rs"), _daily("rs", _REV3), _weekly("rs", ops.REVENUE))
OWNED = f"(SELECT rider_id FROM rs GROUP BY 1 HAVING max(ownership_status) = {c.q(fv.OWNED_MODEL)})"
EXTRA_SUMS = f"""xs AS (SELECT * EXCLUDE (commission_scheme_id), '1' AS commission_scheme_id FROM rs WHERE rider_code LIKE 'BLITZ%' OR rider_code LIKE 'HMS%'),
xp AS (SELECT * FROM prod WHERE rider_id IN (SELECT rider_id FROM xs))"""
EXTRA = c.with_(SUMS, EXTRA_SUMS, _products("xp", "xs"), _daily("xs", _REV2), _weekly("xs", ops.REVENUE[:2]))
_DAILY_OUT = ["rider_id", "transaction_date", "rider_code", "hub_code", *ops.REVENUE, "total_item_qty", "commission_extra_type", "attendance_commission", "attendance_commission_extra",
              "daily_commission", "daily_commission_extra", "daily_sales_commission_percentage", "daily_sales_commission_extra_percentage"]


def summaries(spark, sf):
    return ops.canonical_ids(s.rider_summaries(spark, sf), "commission_scheme_id", "commission_extra_scheme_id")


def products(spark, sf):
    return ops.daily_products(s.rider_day_products(spark, sf), summaries(spark, sf), s.product_rates(spark, sf), s.extra_product_rates(spark, sf))


def daily(spark, sf):
    return ops.daily_summaries(summaries(spark, sf), s.schemes(spark), s.extra_schemes(spark), products(spark, sf))


@query("commission_products", HEAD + "SELECT * FROM cp")
def commission_products(spark, sf):
    return products(spark, sf)


@query("commission_daily", HEAD + f"""
SELECT {", ".join(_DAILY_OUT)}, try_cast(commission_scheme_id AS BIGINT) AS commission_scheme_id, try_cast(commission_extra_scheme_id AS BIGINT) AS commission_extra_scheme_id FROM cd""")
def commission_daily(spark, sf):
    return daily(spark, sf).drop("ownership_status")


@query("commission_weekly", HEAD + "SELECT * FROM cw")
def commission_weekly(spark, sf):
    return ops.weekly_summaries(summaries(spark, sf), s.schemes(spark), s.tiers(spark), daily(spark, sf), START, END)


@query("commission_weekly_forced", EXTRA + "SELECT * FROM cw")
def commission_weekly_forced(spark, sf):
    rows = rider_ops.prefix_filter(summaries(spark, sf))
    rows = ops.force_scheme(rows, s.schemes(spark), s.tiers(spark))
    sold = rider_ops.products_of_selected_riders(s.rider_day_products(spark, sf), s.rider_summaries(spark, sf)).drop("rider_code")
    cp = ops.daily_products(sold, rows, s.product_rates(spark, sf), s.extra_product_rates(spark, sf))
    two = ops.REVENUE[:2]
    cd = ops.daily_summaries(rows, s.schemes(spark), s.extra_schemes(spark), cp, two)
    return ops.weekly_summaries(rows, s.schemes(spark), s.tiers(spark), cd, START, END, two)


@query("tier_range_join", HEAD + """
SELECT rider_id, hub_code, total_revenue, commission_scheme_id, tier, start_range, end_range, commission_in_percentage FROM tiered""")
def tier_range_join(spark, sf):
    return ops.tier_range_join(ops.weekly_facts(summaries(spark, sf)), s.tiers(spark)).select(
        "rider_id", "hub_code", "total_revenue", "commission_scheme_id", "tier", "start_range", "end_range", "commission_in_percentage")


# tiers taken from the data: every order is a tier of its customer, starting at its price
@query("next_tier_start", """
SELECT o_custkey AS commission_scheme_id, o_totalprice AS start_range, lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_totalprice) AS next_start_range FROM orders""")
def next_tier_start(spark, sf):
    t = s.table(spark, sf, "orders").select(F.col("o_custkey").alias("commission_scheme_id"), F.col("o_totalprice").alias("start_range"))
    return ops.next_tier_start(t, width=10_000.0)


@query("rider_status_filter", c.with_(SUMS) + f"SELECT rider_id, transaction_date, rider_code, total_item_qty FROM rs WHERE rider_id IN {OWNED}")
def rider_status_filter(spark, sf):
    r = s.rider_summaries(spark, sf)
    return rider_ops.rider_status_filter(r.select("rider_id", "transaction_date", "rider_code", "total_item_qty"), r)


@query("prefix_filter", c.with_(SUMS) + "SELECT rider_id, transaction_date, rider_code FROM rs WHERE rider_code LIKE 'BLITZ%' OR rider_code LIKE 'HMS%'")
def prefix_filter(spark, sf):
    return rider_ops.prefix_filter(s.rider_summaries(spark, sf).select("rider_id", "transaction_date", "rider_code"))


@query("products_of_selected_riders", c.with_(SUMS, EXTRA_SUMS) + """
SELECT xp.rider_id, xp.transaction_date, product_id, qty, total_price, k.rider_code FROM xp JOIN (SELECT DISTINCT rider_id, rider_code FROM xs) k ON xp.rider_id = k.rider_id""")
def products_of_selected_riders(spark, sf):
    p = s.rider_day_products(spark, sf).select("rider_id", "transaction_date", "product_id", "qty", "total_price")
    return rider_ops.products_of_selected_riders(p, s.rider_summaries(spark, sf))
