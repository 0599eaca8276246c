"""The stand-in tables of ``tillworks.sources.standin`` as SQL common table expressions for the oracles."""

from __future__ import annotations

from tillworks import fixed_values as fv

MONEY = "DECIMAL(20,6)"


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def case_lookup(expr: str, table: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items())
    return f"CASE {expr} {whens} ELSE {default} END"


def values_table(table: dict, key: str, value: str) -> str:
    rows = ", ".join(f"({q(k)}, {q(v) if isinstance(v, str) else repr(v)})" for k, v in table.items())
    return f"(SELECT * FROM (VALUES {rows}) AS v({key}, {value}))"


def msum(expr: str, zero: bool = False, over: str = "", where: str = "") -> str:
    """Sum of the amounts in millionths, and of what they have below a millionth."""
    only = f" FILTER (WHERE {where})" if where else ""
    window = f" OVER {over}" if over else ""
    s = f"(CAST(SUM({mdec(expr)}){only}{window} AS DOUBLE) + SUM({mrest(expr)}){only}{window})"
    return f"COALESCE({s}, 0.0)" if zero else s


def _fraction(expr: str) -> str:
    return f"(CAST({expr} AS DOUBLE) - trunc(CAST({expr} AS DOUBLE)))"


def mdec(expr: str) -> str:
    """An amount in millionths: its whole units, and its fraction rounded."""
    return f"(CAST(trunc(CAST({expr} AS DOUBLE)) AS {MONEY}) + CAST({_fraction(expr)} AS {MONEY}))"


def mrest(expr: str) -> str:
    """What an amount has below a millionth."""
    unit = f"CAST(CAST({_fraction(expr)} AS {MONEY}) AS DOUBLE)"
    return f"CASE WHEN trunc(CAST({expr} AS DOUBLE)) + {unit} = CAST({expr} AS DOUBLE) THEN 0.0::DOUBLE ELSE {_fraction(expr)} - {unit} END"


BASE = f"""base AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS outlet_code,
         o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24) AS transaction_date,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'GoFood' WHEN '2-HIGH' THEN 'GrabFood'
              WHEN '3-MEDIUM' THEN 'ShopeeFood' WHEN '5-LOW' THEN 'Cash' ELSE {q(fv.APP_CHANNEL)} END AS payment_type,
         CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE 'fulfilled' END AS fulfillment_status,
         'paid' AS payment_status, 'completed' AS status, 'success' AS transactions_status,
         o_totalprice / 1.1::DOUBLE + 0.05::DOUBLE * o_totalprice AS total_order_amount,
         0.05::DOUBLE * o_totalprice AS total_discount_amount,
         0.02::DOUBLE * o_totalprice AS total_promotion_amount,
         o_totalprice / 1.1::DOUBLE AS subtotal,
         o_totalprice - o_totalprice / 1.1::DOUBLE AS total_tax_amount,
         o_totalprice AS total_amount
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

RAW = f"""{BASE},
raw AS (
  SELECT b.*, 1 AS pos, order_id * 10 + 1 AS transaction_id, 'sale' AS transactions_type,
         CASE WHEN order_id % 10 = 0 THEN total_amount * 0.6::DOUBLE ELSE total_amount END AS tx_amount,
         payment_type AS sales_type FROM base b
  UNION ALL SELECT b.*, 2, order_id * 10 + 2, 'sale', total_amount * 0.4::DOUBLE, payment_type FROM base b WHERE order_id % 10 = 0
  UNION ALL SELECT b.*, 3, order_id * 10 + 3, 'sale', 0.0::DOUBLE, payment_type FROM base b WHERE order_id % 50 = 5
  UNION ALL SELECT b.*, 4, order_id * 10 + 4, 'refund', total_amount, payment_type FROM base b WHERE order_id % 37 = 0)"""

_SHARE = ("CASE WHEN transactions_type = 'sale' AND order_id % 10 = 0 "
          "THEN CASE WHEN pos = 1 THEN 0.6::DOUBLE ELSE 0.4::DOUBLE END ELSE 1.0::DOUBLE END")

HEADERS = f"""{RAW},
headers AS (
  SELECT order_id, customer_id, outlet_code, transaction_date, payment_type, sales_type, fulfillment_status,
         payment_status, status, transactions_status, pos, transaction_id, transactions_type, tx_amount,
         total_order_amount * share AS total_order_amount, total_discount_amount * share AS total_discount_amount,
         total_promotion_amount * share AS total_promotion_amount, subtotal * share AS subtotal,
         total_tax_amount * share AS total_tax_amount, total_amount * share AS total_amount
  FROM (SELECT *, {_SHARE} AS share FROM raw WHERE pos <> 3) s)"""

DETAILS = """details AS (
  SELECT l_orderkey AS order_id, l_orderkey * 10 + l_linenumber AS order_detail_id,
         CASE l_returnflag WHEN 'A' THEN 'comboset' WHEN 'N' THEN 'standard' ELSE 'variant' END AS type,
         CASE WHEN l_returnflag = 'A' THEN CAST(l_suppkey % 20 AS VARCHAR) ELSE '' END AS bundling_id,
         l_partkey AS product_id, p_name AS product_name,
         CASE WHEN l_returnflag = 'A' THEN 'Bundle ' || CAST(l_suppkey % 20 AS VARCHAR) ELSE p_type END AS product_generic_name,
         p_brand AS sku, p_retailprice AS price,
         l_quantity AS quantity, l_extendedprice AS total_order_amount,
         l_extendedprice * l_discount AS discount_amount, 0.0::DOUBLE AS promotion_amount,
         l_extendedprice * (1 - l_discount) AS subtotal, l_tax * 100 AS tax_percentage,
         l_extendedprice * (1 - l_discount) * l_tax AS tax_amount,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_amount,
         l_linestatus AS status, 'paid' AS payment_status, 'sale' AS transactions_type,
         l_shipdate AS transaction_date
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

DOUBLED = f"""{DETAILS},
doubled AS (SELECT * FROM details UNION ALL SELECT * FROM details WHERE order_id % 5 = 0)"""

OUTLETS = f"""outlets AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS jilid, n_name AS customer_name, r_name AS region,
         'P' || CAST(n_nationkey % 7 AS VARCHAR) AS provinsi, 'K' || CAST(n_nationkey % 11 AS VARCHAR) AS kota,
         CASE WHEN n_nationkey % 3 = 0 THEN {q(fv.FRANCHISE_MODEL)} ELSE {q(fv.OWNED_MODEL)} END AS ownership_model,
         'B' || CAST(n_nationkey % 4 AS VARCHAR) AS brand
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 24),
brand_names AS (
  SELECT DISTINCT 'B' || CAST(n_nationkey % 4 AS VARCHAR) AS brand, 'Brand ' || CAST(n_nationkey % 4 AS VARCHAR) AS brand_name
  FROM nation WHERE n_nationkey % 4 <> 3),
transitions AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS jilid, DATE '1998-01-01' AS start_date,
         CASE WHEN n_nationkey <> 8 THEN {q(fv.FRANCHISE_MODEL)} END AS ownership_model,
         CASE WHEN n_nationkey = 12 THEN 'B3' ELSE 'B1' END AS brand
  FROM nation WHERE n_nationkey % 4 = 0),
dim AS (
  SELECT o.jilid, o.customer_name AS outlet_name, o.region, o.provinsi, o.kota, o.ownership_model, o.outlet_brand,
         t.start_date, t.ownership_model AS old_ownership_model, tb.brand_name AS old_outlet_brand
  FROM (SELECT DISTINCT jilid, customer_name, region, provinsi, kota, ownership_model,
               coalesce(b.brand_name, outlets.brand) AS outlet_brand
        FROM outlets LEFT JOIN brand_names b ON outlets.brand = b.brand) o
  LEFT JOIN transitions t ON o.jilid = t.jilid
  LEFT JOIN brand_names tb ON t.brand = tb.brand)"""

ATTRIBUTES = """CASE WHEN CAST(h.transaction_date AS DATE) < d.start_date THEN d.old_ownership_model
              WHEN d.ownership_model IS NOT NULL THEN d.ownership_model ELSE '-' END AS ownership_model,
         coalesce(d.outlet_name, '-') AS outlet_name,
         CASE WHEN CAST(h.transaction_date AS DATE) < d.start_date THEN d.old_outlet_brand
              WHEN d.outlet_brand IS NOT NULL THEN d.outlet_brand ELSE '-' END AS outlet_brand,
         coalesce(d.region, '-') AS region, coalesce(d.provinsi, '-') AS provinsi, coalesce(d.kota, '-') AS kota"""

SLOTS = """slots AS (
  SELECT DISTINCT CAST(s_suppkey % 20 AS VARCHAR) AS bundling_id, CAST(1 + (s_suppkey % 20) % 3 AS INTEGER) AS bundling_slot_count
  FROM supplier WHERE s_suppkey % 20 < 18)"""

VALID = (f"h.payment_status = 'paid' AND h.fulfillment_status = 'fulfilled' AND h.transactions_status = 'success' "
         f"AND lower(h.sales_type) NOT LIKE '%{fv.APP_CHANNEL.lower()}%'")


def week(expr: str) -> str:
    return f"CAST(ceil(dayofyear(date_trunc('week', {expr})) / 7.0) AS INTEGER)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


LISTED = "('3', '77', '205')"
NAME = "CASE payment_type WHEN 'GoFood' THEN 'Go Food' WHEN 'GrabFood' THEN 'Grab Food' WHEN 'ShopeeFood' THEN 'Shopee Food' WHEN 'Cash' THEN 'QPON' ELSE payment_type END"

# documents unnested: dtx = transactions, ddet = details, dcombo = bundle components, dpromo/ddisc = promotions/discounts
DOCS = f"""{RAW},
dtx AS (SELECT *, {NAME} AS pay_name FROM raw WHERE order_id % 41 <> 7),
ddet0 AS (
  SELECT b.*, i, (order_id * 7 + i * 13) % 97 AS k, 1 + order_id % 4 AS n
  FROM base b, LATERAL (SELECT unnest(range(1, 2 + b.order_id % 4)) AS i) u),
ddet AS (
  SELECT order_id, order_id * 10 + i AS order_detail_id, k, outlet_code, customer_id, fulfillment_status,
         CASE WHEN k % 3 = 0 THEN 'comboset' WHEN k % 3 = 1 THEN 'standard' ELSE 'variant' END AS type,
         CAST((order_id * 3 + i * 17) % 300 AS VARCHAR) AS product_id,
         CASE WHEN k % 4 = 1 THEN '' WHEN k % 4 > 1 THEN 'M' || k END AS product_modifier_id,
         CASE WHEN k % 13 = 0 THEN 0.0::DOUBLE ELSE CAST(k * 1000 AS DOUBLE) END AS base_price,
         CAST(1 + k % 4 AS DOUBLE) AS quantity, total_amount / n AS total_order_amount,
         CASE WHEN k % 29 <> 0 THEN CASE WHEN k % 5 = 0 THEN 11.0::DOUBLE ELSE 10.0::DOUBLE END END AS tax_percentage,
         CAST(k * 10 AS DOUBLE) AS discount_order_amount
  FROM ddet0),
dcombo AS (
  SELECT order_detail_id, j, CAST((k * 5 + j // 2) % 300 AS VARCHAR) AS product_id, 'C' || j AS product_sku, 'Part ' || k AS product_name,
         CAST(1 + j % 2 AS DOUBLE) AS quantity
  FROM ddet, LATERAL (SELECT unnest(range(1, 2 + ddet.k % 4)) AS j) u WHERE k % 3 = 0),
dpromo AS (
  SELECT order_detail_id, CASE k % 3 WHEN 1 THEN 100.0::DOUBLE ELSE 300.0::DOUBLE END AS promotion_amount,
         CASE k % 3 WHEN 1 THEN 'P1' ELSE 'P1, P0' END AS promotion_id,
         CASE k % 3 WHEN 1 THEN 'Promo 1' ELSE 'Promo 1-Promo 0' END AS promotion_name, 'T' AS promotion_type
  FROM ddet WHERE k % 3 <> 0),
ddisc AS (SELECT order_detail_id, CAST(k * 50 AS DOUBLE) AS discount_amount, 'D' || k AS discount_name FROM ddet WHERE k % 2 = 1)"""

PAYMENTS = """pay0 AS (
  SELECT *, transactions_type = 'sale' AS sale,
         max(CASE WHEN transactions_type = 'sale' THEN tx_amount ELSE 0 END) OVER (PARTITION BY order_id) AS top,
         sum(CASE WHEN transactions_type = 'sale' THEN 1 ELSE 0 END) OVER (PARTITION BY order_id ORDER BY pos) AS sale_rank
  FROM {src}),
pay1 AS (SELECT * FROM pay0 WHERE NOT (sale AND tx_amount <= 0 AND (top > 0 OR sale_rank > 1))),
pay2 AS (
  SELECT *, count(*) FILTER (WHERE sale) OVER (PARTITION BY order_id) AS n_sale,
         """ + msum("tx_amount", where="sale", over="(PARTITION BY order_id)") + """ AS sale_sum,
         row_number() OVER (PARTITION BY order_id, sale ORDER BY tx_amount DESC, pos) AS best
  FROM pay1),
pay AS (
  SELECT *, CASE WHEN sale AND n_sale > 1 THEN tx_amount / sale_sum ELSE 1.0::DOUBLE END AS share,
         NOT (sale AND n_sale > 1 AND best > 1) AS takes_details FROM pay2)"""


def payments(src: str) -> str:
    return PAYMENTS.replace("{src}", src)


PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN p_size % 10 = 0 THEN 'comboset' ELSE 'standard' END AS type,
         CASE WHEN p_partkey % 23 = 0 THEN '' ELSE p_brand END AS sku,
         CASE WHEN p_partkey % 17 = 0 THEN 0.0::DOUBLE ELSE p_retailprice END AS price, p_partkey AS pk FROM part),
prices AS (SELECT product_id, price FROM products WHERE type <> 'comboset' AND sku <> '' AND price <> 0)"""
