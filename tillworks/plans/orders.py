"""Order documents, headers and details: queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillworks import fixed_values as fv
from tillworks.operators import documents as docs_ops
from tillworks.operators import orders as ops
from tillworks.plans import ctes as c
from tillworks.plans.registry import query
from tillworks.session import scratch_path
from tillworks.sources import standin as s
from tillworks.sources.tables import document_lines, good_documents, stage_documents

_CHANNEL = c.case_lookup("pay_name", fv.INGEST_CHANNELS, c.q(fv.WALK_IN))
_MONEY = ", ".join(f"{m} * share AS {m}" for m in s.MONEY_COLUMNS)


@query("drop_ghost_payments", c.with_(c.RAW, c.payments("raw")) +
       "SELECT order_id, transaction_id, transactions_type, tx_amount, total_amount FROM pay1")
def drop_ghost_payments(spark, sf):
    return ops.drop_ghost_payments(s.raw_headers(spark, sf)).select(
        "order_id", "transaction_id", "transactions_type", "tx_amount", "total_amount")


@query("allocate_split_payment", c.with_(c.RAW, c.payments("raw")) +
       f"SELECT order_id, transaction_id, transactions_type, {_MONEY} FROM pay")
def allocate_split_payment(spark, sf):
    return ops.allocate_split_payment(s.raw_headers(spark, sf)).select(
        "order_id", "transaction_id", "transactions_type", *s.MONEY_COLUMNS)


@query("primary_payment", c.with_(c.RAW, c.payments("raw")) +
       "SELECT order_id, transaction_id, transactions_type, tx_amount FROM pay WHERE takes_details")
def primary_payment(spark, sf):
    return ops.primary_payment(s.raw_headers(spark, sf)).select("order_id", "transaction_id", "transactions_type", "tx_amount")


@query("classify_sales_type", c.with_(c.RAW, c.DETAILS) + f"""
SELECT order_id, transaction_id, CASE WHEN order_id IN (SELECT order_id FROM details WHERE CAST(product_id AS VARCHAR) IN {c.LISTED})
       THEN {c.q(fv.LISTED_PRODUCT_CHANNEL)} ELSE {_CHANNEL} END AS sales_type
FROM (SELECT *, {c.NAME} AS pay_name FROM raw) h""")
def classify_sales_type(spark, sf):
    name = F.col("payment_type")
    for short, spaced in s.PAYMENT_NAMES.items():
        name = F.when(F.col("payment_type") == short, spaced).otherwise(name)
    h = s.raw_headers(spark, sf).drop("sales_type").withColumn("transactions_payment_type_name", name)
    return ops.classify_sales_type(h, s.details(spark, sf), s.LISTED).select("order_id", "transaction_id", "sales_type")


@query("flatten_orders", c.with_(c.DOCS) + f"""
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(transaction_id AS VARCHAR) AS transaction_id, transaction_date, transactions_type,
       transactions_status, pay_name AS transactions_payment_type_name, tx_amount, status, fulfillment_status, total_amount FROM dtx""")
def flatten_orders(spark, sf):
    return docs_ops.flatten_orders(s.order_documents(spark, sf)).select(
        "order_id", "transaction_id", "transaction_date", "transactions_type", "transactions_status",
        "transactions_payment_type_name", "tx_amount", "status", "fulfillment_status", "total_amount")


JSON_LINES = 20_000


def _json_lines(spark, sf) -> str:
    """The documents as lines of JSON text in packed files of a folder, some of them broken on purpose: cut off, in a list, with a date that is none, without
    an order id."""
    docs = s.order_documents(spark, sf)
    number = F.col("order_id").cast("bigint")
    text = F.to_json(F.struct(*docs.columns))
    text = (F.when(number % 29 == 3, F.substring(text, F.lit(1), F.length(text) - 40)).when(number % 31 == 4, F.concat(F.lit("["), text, F.lit("]")))
            .when(number % 37 == 5, F.regexp_replace(text, '"order_date":"[^"]*"', '"order_date":"soon"'))
            .when(number % 43 == 6, F.regexp_replace(text, '"order_id":"[^"]*",', '"drawer":7,')).otherwise(text))
    path = scratch_path(spark, "json")
    # a packed file is read by one task, so files are cut by lines; packing fast costs little room
    (docs.select(text.alias("value")).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", JSON_LINES).text(path))
    return path


_BROKEN = """CASE WHEN CAST(order_id AS BIGINT) % 29 = 3 THEN 'not JSON' WHEN CAST(order_id AS BIGINT) % 31 = 4 THEN 'not a document'
  WHEN CAST(order_id AS BIGINT) % 37 = 5 THEN 'wrong type' WHEN CAST(order_id AS BIGINT) % 43 = 6 THEN 'no order id' END"""


@query("json_documents", c.with_(c.DOCS) + f"""
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(transaction_id AS VARCHAR) AS transaction_id, transaction_date, transactions_type,
       transactions_status, pay_name AS transactions_payment_type_name, tx_amount, status, fulfillment_status, total_amount
FROM dtx WHERE {_BROKEN} IS NULL""")
def json_documents(spark, sf):
    lines = document_lines(spark, _json_lines(spark, sf))
    return docs_ops.flatten_orders(good_documents(lines)).select(
        "order_id", "transaction_id", "transaction_date", "transactions_type", "transactions_status",
        "transactions_payment_type_name", "tx_amount", "status", "fulfillment_status", "total_amount")


@query("json_quarantine", c.with_(c.BASE) + f"SELECT {_BROKEN} AS reason, count(*) AS n FROM base WHERE {_BROKEN} IS NOT NULL GROUP BY 1")
def json_quarantine(spark, sf):
    _, broken, _ = stage_documents(document_lines(spark, _json_lines(spark, sf)), scratch_path(spark, "documents"))
    return broken.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("json_headers", c.with_(c.DOCS, c.payments("dtx")) + f"""
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(transaction_id AS VARCHAR) AS transaction_id, outlet_code, transactions_type, {_MONEY}
FROM pay WHERE {_BROKEN} IS NULL""")
def json_headers(spark, sf):
    docs, _, _ = stage_documents(document_lines(spark, _json_lines(spark, sf)), scratch_path(spark, "documents"))
    return docs_ops.order_headers(docs, s.LISTED).select("order_id", "transaction_id", "outlet_code", "transactions_type", *s.MONEY_COLUMNS)


@query("expand_combos", c.with_(c.DOCS) + """
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(d.order_detail_id AS VARCHAR) AS order_detail_id, type,
       CASE WHEN type = 'comboset' THEN d.product_id ELSE '' END AS bundling_id,
       CASE WHEN type = 'comboset' THEN x.product_id ELSE d.product_id END AS product_id,
       CASE WHEN type = 'comboset' THEN x.product_name ELSE 'Item ' || k END AS product_name,
       CASE WHEN type = 'comboset' THEN x.product_sku ELSE 'S' || k END AS sku,
       CASE WHEN type = 'comboset' THEN '-' ELSE 'Hot' END AS product_variant_name,
       CASE WHEN type = 'comboset' THEN x.quantity ELSE d.quantity END AS quantity
FROM ddet d LEFT JOIN dcombo x ON d.order_detail_id = x.order_detail_id""")
def expand_combos(spark, sf):
    return docs_ops.expand_combos(s.order_documents(spark, sf))


@query("collapse_promos", c.with_(c.DOCS) + """
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(d.order_detail_id AS VARCHAR) AS order_detail_id, promotion_amount, promotion_id,
       promotion_name, promotion_type, discount_amount, discount_name
FROM ddet d LEFT JOIN dpromo p ON d.order_detail_id = p.order_detail_id LEFT JOIN ddisc x ON d.order_detail_id = x.order_detail_id""")
def collapse_promos(spark, sf):
    return docs_ops.collapse_promos(s.order_documents(spark, sf))


DETAIL_SQL = c.with_(c.DOCS, c.payments("dtx"), c.PRODUCTS) + f"""
, listed AS (SELECT DISTINCT order_id FROM ddet WHERE product_id IN {c.LISTED}),
lines AS (
  SELECT d.*, p.transaction_id, p.transactions_type, p.pay_name, p.transaction_date + INTERVAL '7' HOUR AS transaction_date,
         CASE WHEN l.order_id IS NOT NULL THEN {c.q(fv.LISTED_PRODUCT_CHANNEL)} ELSE {_CHANNEL} END AS sales_type,
         x.product_id AS c_product, x.product_sku, x.product_name AS c_name, x.quantity AS c_quantity
  FROM ddet d JOIN pay p ON d.order_id = p.order_id AND p.takes_details
  LEFT JOIN dcombo x ON d.order_detail_id = x.order_detail_id
  LEFT JOIN listed l ON l.order_id = d.order_id
  WHERE NOT (coalesce(product_modifier_id <> '', TRUE) AND base_price = 0)),
priced AS (
  SELECT lines.*, coalesce(price, 0) AS price, coalesce(tax_percentage, 0) / 100 AS rate,
         greatest(coalesce(price, 0) * c_quantity, 0) AS w,
         coalesce(promotion_amount, 0) AS promo, coalesce(discount_amount, 0) AS disc, promotion_name, discount_name,
         count(*) OVER (PARTITION BY lines.order_detail_id, transactions_type) AS n_rows
  FROM lines LEFT JOIN prices ON coalesce(c_product, lines.product_id) = prices.product_id
  LEFT JOIN dpromo ON dpromo.order_detail_id = lines.order_detail_id
  LEFT JOIN ddisc ON ddisc.order_detail_id = lines.order_detail_id),
shared AS (
  SELECT *, CASE WHEN type <> 'comboset' THEN 1.0::DOUBLE
                 WHEN min(w) OVER g > 0 THEN w / {c.msum("w", over="g")}
                 ELSE 1.0::DOUBLE / n_rows END AS share
  FROM priced WINDOW g AS (PARTITION BY order_detail_id, transactions_type)),
amounts AS (
  SELECT *, CASE WHEN type = 'comboset' THEN total_order_amount * share ELSE total_order_amount END AS toa,
         CASE WHEN type = 'comboset' THEN {{disc}} * share / (1 + rate) ELSE {{disc}} / n_rows / (1 + rate) END AS d_amount,
         CASE WHEN type = 'comboset' THEN promo * share / (1 + rate) ELSE promo / n_rows / (1 + rate) END AS p_amount
  FROM shared)
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(order_detail_id AS VARCHAR) AS order_detail_id, type,
       CASE WHEN type = 'comboset' THEN product_id ELSE '' END AS bundling_id, coalesce(c_product, product_id) AS product_id,
       CASE WHEN k % 10 = 0 THEN 'MS' || k WHEN type = 'comboset' THEN product_sku ELSE 'S' || k END AS sku,
       coalesce(c_name, 'Item ' || k) AS product_name, 'caf ' || k AS notes, coalesce(c_quantity, quantity) AS quantity,
       toa AS total_order_amount, p_amount AS promotion_amount, d_amount AS discount_amount,
       coalesce(promotion_name, '') AS promotion_name, coalesce(discount_name, '') AS discount_name,
       toa - d_amount - p_amount AS subtotal, coalesce(tax_percentage, 0) AS tax_percentage,
       (toa - d_amount - p_amount) * rate AS tax_amount,
       (toa - d_amount - p_amount) + (toa - d_amount - p_amount) * rate AS total_amount, transaction_date, outlet_code,
       transactions_type, sales_type, pay_name AS transactions_payment_type_name FROM amounts"""
_DETAIL_OUT = ["order_id", "order_detail_id", "type", "bundling_id", "product_id", "sku", "product_name", "notes", "quantity",
               "total_order_amount", "promotion_amount", "discount_amount", "promotion_name", "discount_name", "subtotal",
               "tax_percentage", "tax_amount", "total_amount", "transaction_date", "outlet_code", "transactions_type",
               "sales_type", "transactions_payment_type_name"]


def _tables(spark, sf, base):
    prices = ops.product_weights(s.products(spark, sf))
    return docs_ops.orders_to_tables(s.order_documents(spark, sf), prices, base, s.LISTED)


@query("orders_to_tables", DETAIL_SQL.replace("{disc}", "disc"))
def orders_to_tables(spark, sf):
    return _tables(spark, sf, "discounts")[1].select(*_DETAIL_OUT)


@query("orders_to_tables_order_discount", DETAIL_SQL.replace("{disc}", "discount_order_amount"))
def orders_to_tables_order_discount(spark, sf):
    return _tables(spark, sf, "order")[1].select(*_DETAIL_OUT)


@query("orders_to_headers", c.with_(c.DOCS, c.payments("dtx")) + f"""
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(transaction_id AS VARCHAR) AS transaction_id,
       transaction_date + INTERVAL '7' HOUR AS transaction_date, outlet_code, 'Zo ' || customer_id AS customer_first_name,
       transactions_type, pay_name AS transactions_payment_type_name,
       CASE WHEN order_id IN (SELECT order_id FROM ddet WHERE product_id IN {c.LISTED}) THEN {c.q(fv.LISTED_PRODUCT_CHANNEL)}
            ELSE {_CHANNEL} END AS sales_type, {_MONEY} FROM pay""")
def orders_to_headers(spark, sf):
    return _tables(spark, sf, "discounts")[0].select(
        "order_id", "transaction_id", "transaction_date", "outlet_code", "customer_first_name", "transactions_type",
        "transactions_payment_type_name", "sales_type", *s.MONEY_COLUMNS)


# --- details as a table: modifier NULL / '' / set by quantity, line 7 is free -----------------------------------------

_MOD = "CASE CAST(quantity AS INTEGER) % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'M' END"


@query("drop_zero_modifiers", c.with_(c.DETAILS) + f"""
SELECT order_id, order_detail_id, product_id, {_MOD} AS product_modifier_id,
       CASE WHEN order_detail_id % 10 = 7 THEN 0.0::DOUBLE ELSE price END AS base_price
FROM details WHERE NOT (coalesce({_MOD}, '?') <> '' AND order_detail_id % 10 = 7)""")
def drop_zero_modifiers(spark, sf):
    d = s.details(spark, sf)
    third = F.col("quantity").cast("int") % 3
    d = d.select("order_id", "order_detail_id", "product_id",
                 F.when(third == 1, "").when(third == 2, "M").alias("product_modifier_id"),
                 F.when(F.col("order_detail_id") % 10 == 7, 0.0).otherwise(F.col("price")).alias("base_price"))
    return ops.drop_zero_modifiers(d)


_SHARES = f"""shares AS (
  SELECT *, CASE WHEN min(w) OVER g > 0 THEN w / {c.msum("w", over="g")} ELSE 1.0::DOUBLE / count(*) OVER g END AS combo_share,
         count(*) OVER g AS n_rows
  FROM (SELECT *, CASE WHEN product_id % 17 = 0 THEN 0 ELSE price END * quantity AS w FROM details) x
  WINDOW g AS (PARTITION BY order_detail_id, type))"""


def _weighted(spark, sf):
    return s.details(spark, sf).withColumn("price", F.when(F.col("product_id") % 17 != 0, F.col("price")))


@query("combo_share", c.with_(c.DETAILS, _SHARES) +
       "SELECT order_id, order_detail_id, product_id, quantity, total_order_amount, combo_share FROM shares WHERE type = 'comboset'")
def combo_share(spark, sf):
    d = _weighted(spark, sf).filter(F.col("type") == fv.BUNDLE_TYPE)
    return ops.combo_share(d, ["order_detail_id", "type"]).select(
        "order_id", "order_detail_id", "product_id", "quantity", "total_order_amount", "combo_share")


@query("allocate_detail_amounts", c.with_(c.DETAILS, _SHARES) + """
SELECT order_id, order_detail_id, type, product_id, quantity, toa AS total_order_amount, d AS discount_amount, 0.0::DOUBLE AS promotion_amount,
       toa - d AS subtotal, (toa - d) * r AS tax_amount, (toa - d) + (toa - d) * r AS total_amount
FROM (SELECT *, tax_percentage / 100 AS r,
             CASE WHEN type = 'comboset' THEN total_order_amount * combo_share ELSE total_order_amount END AS toa,
             CASE WHEN type = 'comboset' THEN discount_amount * combo_share / (1 + tax_percentage / 100)
                  ELSE discount_amount / n_rows / (1 + tax_percentage / 100) END AS d FROM shares) x""")
def allocate_detail_amounts(spark, sf):
    d = ops.combo_share(_weighted(spark, sf), ["order_detail_id", "type"])
    return ops.allocate_detail_amounts(d, ["order_detail_id", "type"], "discount_amount").select(
        "order_id", "order_detail_id", "type", "product_id", "quantity", "total_order_amount", "discount_amount",
        "promotion_amount", "subtotal", "tax_amount", "total_amount")


# headers of fulfilled orders only, so that some details have no header
@query("details_with_header", c.with_(c.HEADERS, c.DETAILS) + """
SELECT order_id, order_detail_id, product_id, quantity, total_amount FROM details
WHERE order_id IN (SELECT order_id FROM headers WHERE fulfillment_status = 'fulfilled')""")
def details_with_header(spark, sf):
    d = s.details(spark, sf).select("order_id", "order_detail_id", "product_id", "quantity", "total_amount")
    return ops.details_with_header(d, s.headers(spark, sf).filter(F.col("fulfillment_status") == "fulfilled"))


@query("product_weights", c.with_(c.PRODUCTS) + "SELECT * FROM prices")
def product_weights(spark, sf):
    return ops.product_weights(s.products(spark, sf))


@query("slot_count", c.with_(c.PRODUCTS) + """
SELECT product_id AS bundling_id, CAST(least(1 + pk % 5, 3) AS INTEGER) AS bundling_slot_count FROM products WHERE type = 'comboset'""")
def slot_count(spark, sf):
    return ops.slot_counts(s.products(spark, sf))


# --- stored against incoming: the store holds the orders below an outlet-dependent state ------------------------------

def _stored(spark, sf):
    return s.headers(spark, sf).filter(F.col("outlet_code") < "00015")


def _stored_details(spark, sf):
    return s.details(spark, sf).filter(F.col("type") != "standard")


_STORED = """stored AS (SELECT * FROM headers WHERE outlet_code < '00015'),
sdet AS (SELECT * FROM details WHERE type <> 'standard')"""


@query("missing_orders", c.with_(c.HEADERS, c.DETAILS, _STORED) + """
SELECT order_id, max(transaction_id) AS pulled, outlet_code FROM headers WHERE order_id NOT IN (SELECT order_id FROM stored) GROUP BY order_id, outlet_code""")
def missing_orders(spark, sf):
    h = s.headers(spark, sf).select("order_id", F.col("transaction_id").alias("pulled"), "outlet_code")
    return ops.missing_orders(h, _stored(spark, sf), "pulled")


@query("orders_without_details", c.with_(c.HEADERS, c.DETAILS, _STORED) + """
SELECT DISTINCT order_id FROM headers WHERE payment_status = 'paid' AND fulfillment_status = 'fulfilled'
AND transactions_status = 'success' AND order_id NOT IN (SELECT order_id FROM sdet)""")
def orders_without_details(spark, sf):
    return ops.orders_without_details(s.headers(spark, sf), _stored_details(spark, sf))


# stored flags: fulfilled orders of nation 1 are still 'none'; the refunds are not stored yet; order % 19 = 3 failed before
_STATE = """state AS (
  SELECT order_id, transaction_id, CASE WHEN outlet_code = '00001' THEN 'none' ELSE fulfillment_status END AS fulfillment_status,
         CASE WHEN order_id % 19 = 3 THEN 'failed' ELSE transactions_status END AS transactions_status
  FROM stored WHERE transactions_type <> 'refund')"""


@query("changed_orders", c.with_(c.HEADERS, c.DETAILS, _STORED, _STATE) + """
SELECT order_id, CASE WHEN is_new THEN 'new' ELSE 'changed' END AS reason FROM (
  SELECT r.order_id, bool_and(f.order_id IS NULL) AS is_new,
         bool_or(CASE WHEN t.transaction_id IS NOT NULL THEN r.transactions_status <> t.transactions_status
                      ELSE NOT (r.transactions_type = 'sale' AND r.tx_amount <= 0) END) AS tx_changed,
         bool_or(r.fulfillment_status <> f.fulfillment_status) AS flags,
         bool_or(r.order_id NOT IN (SELECT order_id FROM sdet)) AS no_details
  FROM raw r LEFT JOIN (SELECT DISTINCT order_id, fulfillment_status FROM state) f ON r.order_id = f.order_id
  LEFT JOIN state t ON r.transaction_id = t.transaction_id GROUP BY r.order_id) x
WHERE is_new OR tx_changed OR flags OR no_details""")
def changed_orders(spark, sf):
    state = (_stored(spark, sf).filter(F.col("transactions_type") != "refund")
             .withColumn("fulfillment_status", F.when(F.col("outlet_code") == "00001", "none").otherwise(F.col("fulfillment_status")))
             .withColumn("transactions_status", F.when(F.col("order_id") % 19 == 3, "failed").otherwise(F.col("transactions_status"))))
    incoming = s.raw_headers(spark, sf).withColumn("has_details", F.lit(True))
    return ops.changed_orders(incoming, state, _stored_details(spark, sf))
