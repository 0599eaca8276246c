"""Landlord income and payloads: queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillworks import fixed_values as fv
from tillworks.functions.scalars import as_name, casefold, identifier, money_sum
from tillworks.operators import income as ops
from tillworks.operators import landlord as ll
from tillworks.plans import ctes as c
from tillworks.plans.registry import query
from tillworks.sources import standin as s

RUN = "101500"
PREFIX = "Tenant"

# raw payment names in messy spelling; the second payment of a split order uses another name of the same type
SALES = f"""{c.HEADERS},
sales AS (
  SELECT *, 'NATION_' || CAST(outlet_code AS INTEGER) AS outlet_name, 'R' || order_id AS order_reference,
         CASE WHEN order_id % 53 = 0 THEN NULL
              WHEN payment_type = 'GoFood' THEN ' go food ' WHEN payment_type = 'GrabFood' THEN 'Grab Food'
              WHEN payment_type = 'ShopeeFood' THEN CASE WHEN pos = 2 THEN 'isellerpay_qris' ELSE 'iSeller Pay QRIS' END
              WHEN payment_type = 'Cash' THEN 'CASH' WHEN order_id % 2 = 0 THEN 'voucher x' ELSE 'Voucher X' END AS payment_type_raw
  FROM headers h
  WHERE payment_status = 'paid' AND fulfillment_status = 'fulfilled' AND transactions_status = 'success' AND status = 'completed')"""
_TABLE = c.values_table({k.strip().lower(): v for k, v in fv.PAYMENT_TYPES.items()}, "k", "v")
OFFICIAL = f"""official AS (
  SELECT sales.*, CASE WHEN payment_type_raw IS NULL THEN 'Unknown' ELSE coalesce(m.v, trim(payment_type_raw)) END AS pt
  FROM sales LEFT JOIN {_TABLE} m ON lower(trim(payment_type_raw)) = m.k)"""
_RATES = c.values_table(fv.COMMISSION_RATES, "rk", "rate")
DAILY = f"""daily AS (
  SELECT date, outlet_code, outlet_name, d.payment_type, subtotal, tax_amount, total_sales, total_order,
         subtotal * coalesce(CAST(rate AS DOUBLE), 0) AS sales_type_commission
  FROM (
    SELECT date, outlet_code, outlet_name, min(pt) AS payment_type, {c.msum("subtotal")} AS subtotal,
           {c.msum("tax")} AS tax_amount, {c.msum("total")} AS total_sales, CAST(sum(n) AS BIGINT) AS total_order
    FROM (SELECT CAST(transaction_date AS DATE) AS date, outlet_code, outlet_name, min(pt) AS pt, lower(pt) AS key,
                 {c.msum("subtotal")} AS subtotal, {c.msum("total_tax_amount")} AS tax, {c.msum("total_amount")} AS total, count(DISTINCT order_id) AS n
          FROM official GROUP BY 1, 2, 3, lower(pt), lower(rtrim(payment_type_raw))) a
    GROUP BY date, outlet_code, outlet_name, key) d LEFT JOIN {_RATES} r ON d.payment_type = r.rk)"""
ORDER = f"""orderinc AS (
  SELECT CAST(transaction_date AS DATE) AS date, transaction_date, outlet_code, outlet_name, order_id, transaction_id, order_reference,
         payment_type_raw, pt AS payment_type, total_order_amount, total_discount_amount, total_promotion_amount, subtotal,
         total_tax_amount AS tax_amount, total_amount AS total_sales, coalesce(CAST(rate AS DOUBLE), 0) AS commission_pct,
         subtotal * coalesce(CAST(rate AS DOUBLE), 0) AS sales_type_commission
  FROM official LEFT JOIN {_RATES} r ON pt = r.rk)"""
HEAD = c.with_(SALES, OFFICIAL, DAILY, ORDER)


def sales(spark, sf):
    pt, oid = F.col("payment_type"), F.col("order_id")
    raw = (F.when(oid % 53 == 0, F.lit(None)).when(pt == "GoFood", " go food ").when(pt == "GrabFood", "Grab Food")
           .when(pt == "ShopeeFood", F.when(F.col("pos") == 2, "isellerpay_qris").otherwise("iSeller Pay QRIS"))
           .when(pt == "Cash", "CASH").when(oid % 2 == 0, "voucher x").otherwise("Voucher X"))
    h = (s.headers(spark, sf).withColumn("payment_type_raw", raw)
         .withColumn("outlet_name", F.concat(F.lit("NATION_"), F.col("outlet_code").cast("int").cast("string")))
         .withColumn("order_reference", F.concat(F.lit("R"), oid.cast("string"))))
    return ops.completed_sales(h)


def daily(spark, sf):
    return ops.daily_income(sales(spark, sf))


def orderinc(spark, sf):
    return ops.order_income(sales(spark, sf))


@query("normalize_payment_type", HEAD + "SELECT order_id, transaction_id, payment_type_raw, pt AS payment_type FROM official")
def normalize_payment_type(spark, sf):
    return sales(spark, sf).select("order_id", "transaction_id", "payment_type_raw",
                                   ops.normalize_payment_type("payment_type_raw").alias("payment_type"))


#: Spellings, the class that case folding puts them in, and the one that the collation of the source database does.
_SPELLINGS = [("Straße", 1, 1), ("STRASSE", 1, 1), ("strasse ", 2, 1), ("İ", 3, 2), ("i", 4, 2), ("I", 4, 2), ("Café", 5, 3), ("CAFE", 6, 3), ("cafe  ", 7, 3),
              ("ΟΔΟΣ", 8, 4), ("οδος", 8, 4), ("οδοσ", 8, 4), ("\u212a", 9, 5), ("k", 9, 5), ("x", 10, 6), (" x", 11, 7)]


@query("label_spellings", f"""
WITH v(i, label, folded, named) AS (VALUES {", ".join(f"({i}, {c.q(x)}, {a}, {b})" for i, (x, a, b) in enumerate(_SPELLINGS))})
SELECT x.label AS one, y.label AS other, x.folded = y.folded AS same_folded, x.named = y.named AS same_name, count(*) AS n
FROM orders JOIN v x ON o_orderkey % {len(_SPELLINGS)} = x.i JOIN v y ON o_custkey % {len(_SPELLINGS)} = y.i GROUP BY ALL""")
def label_spellings(spark, sf):
    """Which spellings of a label count as one."""
    words = F.array(*[F.lit(x) for x, _, _ in _SPELLINGS])
    pick = lambda k: F.get(words, (F.col(k) % len(_SPELLINGS)).cast("int"))
    rows = s.table(spark, sf, "orders").select(pick("o_orderkey").alias("one"), pick("o_custkey").alias("other"))
    return (rows.groupBy("one", "other").agg(F.count(F.lit(1)).alias("n"))
            .select("one", "other", (casefold("one") == casefold("other")).alias("same_folded"), (as_name("one") == as_name("other")).alias("same_name"), "n"))


@query("label_groups", f"""
WITH v(i, label, folded, named) AS (VALUES {", ".join(f"({i}, {c.q(x)}, {a}, {b})" for i, (x, a, b) in enumerate(_SPELLINGS))})
SELECT min(label) AS first_spelling, count(DISTINCT label) AS spellings, count(*) AS n FROM orders JOIN v ON o_orderkey % {len(_SPELLINGS)} = i GROUP BY named""")
def label_groups(spark, sf):
    """Labels grouped as the source database groups names."""
    words = F.array(*[F.lit(x) for x, _, _ in _SPELLINGS])
    rows = s.table(spark, sf, "orders").select(F.get(words, (F.col("o_orderkey") % len(_SPELLINGS)).cast("int")).alias("label"))
    return (rows.groupBy(as_name("label").alias("name")).agg(F.min("label").alias("first_spelling"), F.countDistinct("label").alias("spellings"),
                                                              F.count(F.lit(1)).alias("n")).drop("name"))


@query("daily_est_income", HEAD + "SELECT * FROM daily")
def daily_est_income(spark, sf):
    return daily(spark, sf).orderBy("date", "outlet_code", "payment_type")


@query("order_est_income", HEAD + "SELECT * FROM orderinc")
def order_est_income(spark, sf):
    return orderinc(spark, sf)


@query("unmapped_payment_types", HEAD + f"""
SELECT payment_type, {c.msum('total_sales', True)} AS total_sales FROM daily
WHERE payment_type NOT IN {c.in_list(fv.COMMISSION_RATES)} GROUP BY payment_type""")
def unmapped_payment_types(spark, sf):
    return ops.unmapped_payment_types(daily(spark, sf))


@query("split_payment_orders", HEAD + """
SELECT order_id, transaction_id, payment_type, total_sales FROM orderinc
WHERE order_id IN (SELECT order_id FROM orderinc GROUP BY order_id HAVING count(*) > 1)""")
def split_payment_orders(spark, sf):
    return ops.split_payment_orders(orderinc(spark, sf).select("order_id", "transaction_id", "payment_type", "total_sales"))


_CHECK = ops.MONEY_CHECK
_DIFF = ", ".join(f"round(coalesce(o.{x}, 0) - coalesce(d.{x}, 0), 4) AS diff_{x}" for x in [*_CHECK, "total_order"])


@query("reconcile_full_outer", HEAD + f"""
, o AS (SELECT date, outlet_code, lower(payment_type) AS payment_type, {", ".join(f"{c.msum(x, True)} AS {x}" for x in _CHECK)},
               CAST(count(DISTINCT order_id) AS DOUBLE) AS total_order FROM orderinc GROUP BY 1, 2, 3),
d AS (SELECT date, outlet_code, lower(payment_type) AS payment_type, subtotal, tax_amount,
             CASE WHEN outlet_code = '00003' THEN total_sales + 5 ELSE total_sales END AS total_sales, sales_type_commission,
             CAST(total_order AS DOUBLE) AS total_order FROM daily WHERE outlet_code <> '00004')
SELECT * FROM (
  SELECT coalesce(o.date, d.date) AS date, coalesce(o.outlet_code, d.outlet_code) AS outlet_code,
         coalesce(o.payment_type, d.payment_type) AS payment_type,
         CASE WHEN d.date IS NULL THEN 'order only' WHEN o.date IS NULL THEN 'daily only' ELSE 'both' END AS side, {_DIFF}
  FROM (SELECT * FROM o WHERE outlet_code <> '00006') o
  FULL OUTER JOIN d ON o.date = d.date AND o.outlet_code = d.outlet_code AND o.payment_type = d.payment_type) x
WHERE side <> 'both' OR {" OR ".join(f"abs(diff_{x}) >= 0.01" for x in _CHECK)} OR diff_total_order <> 0""")
def reconcile_full_outer(spark, sf):
    d = (daily(spark, sf).filter(F.col("outlet_code") != "00004")
         .withColumn("total_sales", F.when(F.col("outlet_code") == "00003", F.col("total_sales") + 5).otherwise(F.col("total_sales"))))
    return ops.reconcile_with_daily(orderinc(spark, sf).filter(F.col("outlet_code") != "00006"), d)


_BUCKETS = list(dict.fromkeys([*fv.DASHBOARD_BUCKETS.values(), fv.OTHER_BUCKET]))
_BTABLE = c.values_table({k.lower(): v for k, v in fv.DASHBOARD_BUCKETS.items()}, "bk", "bucket")


@query("income_pivot", HEAD + f"""
SELECT *, {" + ".join(_BUCKETS)} AS daily_income FROM (
  SELECT date, outlet_name, CAST(sum(total_order) AS DOUBLE) AS total_order,
         {", ".join(f"{c.msum('subtotal - coalesce(sales_type_commission, 0)', True, where=f'b = {c.q(n)}')} AS {n}" for n in _BUCKETS)}
  FROM (SELECT daily.*, coalesce(bucket, 'other') AS b FROM daily LEFT JOIN {_BTABLE} t ON lower(payment_type) = bk) x
  GROUP BY date, outlet_name) y""")
def income_pivot(spark, sf):
    return ops.income_pivot(daily(spark, sf))


@query("payment_type_inventory", HEAD + f"""
SELECT outlet_code, payment_type, count(*) AS days, {c.msum('total_sales')} AS total_sales FROM daily GROUP BY 1, 2""")
def payment_type_inventory(spark, sf):
    return ops.payment_type_inventory(daily(spark, sf))


@query("warehouse_vs_lake", HEAD + """
SELECT w.date, w.outlet_code, orders_table, orders_lake, orders_table - coalesce(orders_lake, 0) AS diff
FROM (SELECT date, outlet_code, CAST(sum(total_order) AS BIGINT) AS orders_table FROM daily GROUP BY 1, 2) w
LEFT JOIN (SELECT CAST(transaction_date AS DATE) AS date, outlet_code, count(DISTINCT order_id) AS orders_lake
           FROM sales WHERE outlet_code <> '00002' GROUP BY 1, 2) l ON w.date = l.date AND w.outlet_code = l.outlet_code
WHERE orders_table <> coalesce(orders_lake, 0)""")
def warehouse_vs_lake(spark, sf):
    return ops.warehouse_vs_lake(daily(spark, sf), sales(spark, sf).filter(F.col("outlet_code") != "00002"))


# the old wide table: one row per outlet-day; some days differ, the new table misses outlet 00007
_M = ["total_sales", "subtotal", "tax_amount"]
_OLD = f"""old AS (
  SELECT date, outlet_code, {c.msum('total_sales')} + CASE WHEN outlet_code = '00001' THEN 1 ELSE 0 END AS total_sales,
         {c.msum('subtotal')} AS subtotal, {c.msum('tax_amount')} - CASE WHEN outlet_code = '00002' THEN 0.5::DOUBLE ELSE 0 END AS tax_amount,
         {c.msum('sales_type_commission')} + CASE WHEN outlet_code = '00005' THEN 2 ELSE 0 END AS commission
  FROM daily GROUP BY 1, 2),
new AS (SELECT date, outlet_code, {", ".join(f"{c.msum(m)} AS {m}" for m in _M)}, {c.msum('sales_type_commission')} AS commission
        FROM daily WHERE outlet_code <> '00007' GROUP BY 1, 2)"""


def _old_new(spark, sf):
    d = daily(spark, sf)
    outlet = F.col("outlet_code")
    old = d.groupBy("date", "outlet_code").agg(*[money_sum(m).alias(m) for m in _M],
                                               money_sum("sales_type_commission").alias("commission"))
    old = (old.withColumn("total_sales", F.col("total_sales") + F.when(outlet == "00001", 1).otherwise(0))
           .withColumn("tax_amount", F.col("tax_amount") - F.when(outlet == "00002", 0.5).otherwise(0))
           .withColumn("commission", F.col("commission") + F.when(outlet == "00005", 2).otherwise(0)))
    return old, d.filter(outlet != "00007")


@query("old_new_reconcile", HEAD + f""", {_OLD}
SELECT o.date, o.outlet_code, {", ".join(f"o.{m} AS old_{m}, n.{m} AS new_{m}, round(n.{m} - o.{m}, 4) AS diff_{m}" for m in _M)}
FROM old o LEFT JOIN new n ON o.date = n.date AND o.outlet_code = n.outlet_code
WHERE n.date IS NULL OR {" OR ".join(f"abs(n.{m} - o.{m}) > 0.01" for m in _M)}""")
def old_new_reconcile(spark, sf):
    return ops.old_new_reconcile(*_old_new(spark, sf))


@query("commission_reconcile", HEAD + f""", {_OLD}
SELECT o.date, o.outlet_code, o.commission AS old_commission, n.commission AS new_commission, round(n.commission - o.commission, 4) AS diff
FROM old o JOIN new n ON o.date = n.date AND o.outlet_code = n.outlet_code WHERE abs(n.commission - o.commission) > 0.01""")
def commission_reconcile(spark, sf):
    return ops.commission_reconcile(*_old_new(spark, sf))


# --- payloads -------------------------------------------------------------------------------------------------------

def _number(day: str) -> str:
    return f"'{PREFIX}_' || jilid || '_' || payment_type || '_' || strftime(transaction_date, '{day}') || '_{RUN}'"


_PAYLOAD_OUT = f"""SELECT jilid, transaction_date, payment_type, total_sales, total_tax, round(amount, 4) AS amount,
       {_number('%Y%m%d')} AS transaction_number, {_number('%Y-%m-%d')} AS remarks"""
PAYLOAD = f"""payload AS ({_PAYLOAD_OUT} FROM (
  SELECT outlet_code AS jilid, date AS transaction_date, payment_type, {c.msum('total_sales', True)} AS total_sales,
         {c.msum('tax_amount', True)} AS total_tax, {c.msum('subtotal - sales_type_commission', True)} AS amount
  FROM daily WHERE payment_type IN {c.in_list(ll.SENDABLE)} AND total_sales <> 0 GROUP BY 1, 2, 3) x)"""
ORDER_PAYLOAD = f"""opay AS (
  SELECT outlet_code AS jilid, date AS transaction_date, payment_type, total_sales, tax_amount AS total_tax,
         round(subtotal - sales_type_commission, 4) AS amount, key || '_{RUN}' AS transaction_number,
         key || '_' || strftime(date, '%Y-%m-%d') || '_{RUN}' AS remarks, key
  FROM (SELECT *, outlet_code || '_' || order_reference || '_' || payment_type AS key FROM orderinc WHERE total_sales <> 0) x)"""


@query("landlord_payload", HEAD + f", {PAYLOAD} SELECT * FROM payload")
def landlord_payload(spark, sf):
    return ll.payload_from_income(daily(spark, sf), PREFIX, RUN)


@query("landlord_payload_sales", HEAD + f"""
{_PAYLOAD_OUT} FROM (
  SELECT outlet_code AS jilid, CAST(transaction_date AS DATE) AS transaction_date,
         CASE WHEN payment_type_raw IN {c.in_list(fv.QRIS_ALIASES)} THEN {c.q(fv.QRIS_LABEL)} ELSE payment_type_raw END AS payment_type,
         {c.msum('total_amount')} AS total_sales, {c.msum('total_tax_amount')} AS total_tax,
         CAST(sum({c.mdec("total_amount")}) - sum({c.mdec("total_tax_amount")}) AS DOUBLE)
           + (sum({c.mrest("total_amount")}) - sum({c.mrest("total_tax_amount")})) AS amount
  FROM sales WHERE payment_type_raw IS NOT NULL GROUP BY 1, 2, 3) x""")
def landlord_payload_sales(spark, sf):
    return ll.payload_from_sales(sales(spark, sf), PREFIX, RUN)


@query("unsent_payment_types", HEAD + f"""
SELECT payment_type, {c.msum('total_sales', True)} AS total_sales FROM daily
WHERE payment_type NOT IN {c.in_list(ll.SENDABLE)} AND total_sales <> 0 GROUP BY payment_type""")
def unsent_payment_types(spark, sf):
    return ll.unsent_payment_types(daily(spark, sf))


@query("order_payload", HEAD + f", {ORDER_PAYLOAD} SELECT * FROM opay")
def order_payload(spark, sf):
    return ll.order_payload(orderinc(spark, sf), RUN)


@query("payload_violations", HEAD + f""", {ORDER_PAYLOAD}
SELECT transaction_number, count(*) AS n_rows, length(transaction_number) > 28 AS too_long FROM opay
GROUP BY transaction_number HAVING count(*) > 1 OR length(transaction_number) > 28""")
def payload_violations(spark, sf):
    return ll.payload_violations(ll.order_payload(orderinc(spark, sf), RUN), max_length=28)


# send log of earlier runs: one or two entries per order, old and new number formats
LOG = f"""slog AS (
  SELECT jilid, key || CASE WHEN oid % 4 = 0 THEN '_20240105_090000' ELSE '_090000' END AS transaction_number, transaction_date,
         payment_type, amount,
         CASE oid % 6 WHEN 0 THEN 'success' WHEN 1 THEN 'error' WHEN 2 THEN 'error' WHEN 3 THEN 'timeout_error' ELSE 'pending' END AS status,
         CASE oid % 6 WHEN 1 THEN ' duplicate ' WHEN 2 THEN 'bad amount' END AS error_message, CAST(NULL AS VARCHAR) AS mall_transaction_id
  FROM (SELECT opay.*, CAST(split_part(split_part(key, '_R', 2), '_', 1) AS BIGINT) AS oid FROM opay) x WHERE oid % 6 <> 5
  UNION ALL
  SELECT jilid, key || '_103000', transaction_date, payment_type, amount, 'success', NULL, 'M' || oid
  FROM (SELECT opay.*, CAST(split_part(split_part(key, '_R', 2), '_', 1) AS BIGINT) AS oid FROM opay) x WHERE oid % 12 = 3
  UNION ALL
  SELECT jilid, transaction_number, transaction_date, payment_type, amount, 'success', NULL, NULL FROM payload WHERE jilid < '00005')"""
FULL = HEAD + f", {PAYLOAD}, {ORDER_PAYLOAD}, {LOG} "


def _log(spark, sf):
    p = ll.order_payload(orderinc(spark, sf), RUN)
    p = p.withColumn("oid", F.regexp_extract("key", r"_R(\d+)_", 1).cast("bigint"))
    six = F.col("oid") % 6
    text = lambda v: F.lit(v).cast("string")
    cols = ["jilid", "transaction_number", "transaction_date", "payment_type", "amount", "status", "error_message", "mall_transaction_id"]
    first = (p.filter(six != 5)
             .withColumn("transaction_number", F.concat("key", F.when(F.col("oid") % 4 == 0, "_20240105_090000").otherwise("_090000")))
             .withColumn("status", F.when(six == 0, "success").when(six.isin(1, 2), "error").when(six == 3, "timeout_error").otherwise("pending"))
             .withColumn("error_message", F.when(six == 1, " duplicate ").when(six == 2, "bad amount"))
             .withColumn("mall_transaction_id", text(None)).select(*cols))
    again = (p.filter(F.col("oid") % 12 == 3).withColumn("transaction_number", F.concat("key", F.lit("_103000")))
             .withColumn("status", F.lit("success")).withColumn("error_message", text(None))
             .withColumn("mall_transaction_id", F.concat(F.lit("M"), F.col("oid").cast("string"))).select(*cols))
    old = (ll.payload_from_income(daily(spark, sf), PREFIX, RUN).filter(F.col("jilid") < "00005")
           .withColumn("status", F.lit("success")).withColumn("error_message", text(None))
           .withColumn("mall_transaction_id", text(None)).select(*cols))
    return first.unionByName(again).unionByName(old)


_LOGKEYS = r"""lk AS (
  SELECT *, CASE WHEN starts_with(transaction_number, jilid || '_') AND regexp_matches(transaction_number, '_\d{6}$')
                 THEN regexp_replace(regexp_replace(transaction_number, '_\d{6}$', ''), '_\d{8}$', '') END AS key,
         status = 'success' OR trim(coalesce(error_message, '')) = 'duplicate' AS accepted FROM slog)"""


@query("resend_guard", FULL + f""", {_LOGKEYS}
SELECT opay.*, CASE WHEN coalesce(acc, FALSE) THEN 'already' WHEN coalesce(unc, FALSE) THEN 'uncertain' ELSE 'send' END AS action
FROM opay LEFT JOIN (SELECT key AS k, bool_or(accepted) AS acc, bool_or(status IN ('timeout_error', 'pending')) AS unc
                     FROM lk WHERE key IS NOT NULL GROUP BY key) g ON opay.key = g.k""")
def resend_guard(spark, sf):
    return ll.resend_guard(ll.order_payload(orderinc(spark, sf), RUN), _log(spark, sf))


@query("legacy_conflicts", FULL + f""", {_LOGKEYS}
SELECT transaction_date, count(*) AS n_rows, {c.msum('amount', True)} AS amount FROM lk
WHERE key IS NULL AND accepted AND transaction_date IN (SELECT transaction_date FROM opay) GROUP BY 1""")
def legacy_conflicts(spark, sf):
    return ll.legacy_conflicts(ll.order_payload(orderinc(spark, sf), RUN), _log(spark, sf))


@query("unsent_rows", FULL + """
SELECT p.* FROM payload p WHERE NOT EXISTS (
  SELECT 1 FROM slog l WHERE l.jilid = p.jilid AND l.transaction_date = p.transaction_date AND l.payment_type = p.payment_type
  AND (l.status = 'success' OR trim(l.error_message) = 'duplicate'))""")
def unsent_rows(spark, sf):
    return ll.unsent_rows(ll.payload_from_income(daily(spark, sf), PREFIX, RUN), _log(spark, sf))


@query("finalize_send_log", FULL + """
SELECT jilid, transaction_number, transaction_date, payment_type, amount,
       CASE WHEN hit THEN CASE WHEN amount > 100000 THEN 'success' ELSE 'error' END ELSE status END AS status,
       CASE WHEN hit THEN CASE WHEN amount <= 100000 THEN 'refused' END ELSE error_message END AS error_message,
       CASE WHEN hit THEN CASE WHEN amount > 100000 THEN 'X' || jilid END ELSE mall_transaction_id END AS mall_transaction_id
FROM (SELECT *, status = 'pending' AND transaction_number IN (
        SELECT transaction_number FROM slog WHERE status = 'pending' GROUP BY transaction_number HAVING count(*) = 1) AS hit FROM slog) x""")
def finalize_send_log(spark, sf):
    log = _log(spark, sf)
    single = (log.filter(F.col("status") == ll.PENDING).groupBy("jilid", "transaction_number")
              .agg(F.count(F.lit(1)).alias("n"), F.max("amount").alias("amount")).filter(F.col("n") == 1))
    ok = F.col("amount") > 100000
    result = single.select("jilid", "transaction_number", F.when(ok, "success").otherwise("error").alias("status"),
                           F.when(ok, F.concat(F.lit("X"), "jilid")).alias("mall_transaction_id"),
                           F.when(~ok, "refused").alias("error_message"))
    return ll.finalize_log(log, result)


# the landlord takes Cash and Grab Food, calls Go Food a duplicate, refuses the rest without a reason and forgets QRIS
@query("response_reconcile", HEAD + f""", {PAYLOAD}
SELECT jilid || '/' || strftime(transaction_date, '%Y%m%d') AS batch, transaction_number, amount,
       CASE WHEN payment_type IN ('Cash', 'Grab Food') THEN 'T' || jilid END AS mall_transaction_id,
       CASE WHEN payment_type = 'Go Food' THEN 'duplicate|old' WHEN payment_type NOT IN ('Cash', 'Grab Food', {c.q(fv.QRIS_LABEL)}) THEN 'unknown error' END AS error_message,
       'B' || jilid AS revenue_batch_id, CASE WHEN payment_type IN ('Cash', 'Grab Food') THEN 'success' ELSE 'error' END AS status
FROM payload""")
def response_reconcile(spark, sf):
    p = ll.payload_from_income(daily(spark, sf), PREFIX, RUN)
    p = p.withColumn("batch", F.concat("jilid", F.lit("/"), F.date_format("transaction_date", "yyyyMMdd")))
    taken = F.col("payment_type").isin("Cash", "Grab Food")
    error = (F.when(F.col("payment_type") == "Go Food", F.concat("transaction_number", F.lit("|duplicate|old")))
             .when(~taken & (F.col("payment_type") != fv.QRIS_LABEL), F.col("transaction_number")))
    # one answer per outlet and day: as many entries as there are payment types
    body = p.groupBy("batch", "jilid").agg(
        F.to_json(F.struct(F.concat(F.lit("B"), "jilid").alias("RevenueBatchId"),
                           F.collect_list(F.when(taken, F.struct(F.col("transaction_number").alias("TenantTransactionNumber"),
                                                                 F.concat(F.lit("T"), "jilid").alias("MallTransactionId")))).alias("transactionReturnDatas"),
                           F.collect_list(error).alias("ErrorTransactionNumber"))).alias("body")).drop("jilid")
    return ll.response_reconcile(p.select("batch", "transaction_number", "amount"), body)


@query("sanitize_identifier", HEAD + """
SELECT order_id, transaction_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(trim(raw), '[^\\w\\-]+', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g'), ''), 'UNKNOWN') AS label
FROM (SELECT order_id, transaction_id, CASE order_id % 4 WHEN 0 THEN '  ' WHEN 1 THEN '(' || payment_type_raw || ')' WHEN 2 THEN payment_type_raw || ' #' || order_id ELSE payment_type_raw END AS raw FROM sales) x""")
def sanitize_identifier(spark, sf):
    four, raw = F.col("order_id") % 4, F.col("payment_type_raw")
    text = (F.when(four == 0, "  ").when(four == 1, F.concat(F.lit("("), raw, F.lit(")")))
            .when(four == 2, F.concat(raw, F.lit(" #"), F.col("order_id").cast("string"))).otherwise(raw))
    return sales(spark, sf).select("order_id", "transaction_id", identifier(text).alias("label"))
