"""Sales summaries: queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillworks import fixed_values as fv
from tillworks.functions.scalars import money_value
from tillworks.operators import cube
from tillworks.operators import summaries as ops
from tillworks.operators.outlets import outlet_dimension, with_outlet
from tillworks.plans import ctes as c
from tillworks.plans.registry import query
from tillworks.session import cut_lineage
from tillworks.sources import standin as s

SUMS = ",\n".join(f"{c.msum('h.' + src)} AS {name}" for name, src in ops.HEADER_SUMS.items())
CAL = f"""CAST(h.transaction_date AS DATE) AS transaction_date, {c.week('h.transaction_date')} AS week,
         CAST(month(h.transaction_date) AS INTEGER) AS month, CAST(year(h.transaction_date) AS INTEGER) AS year"""
ATTR = "ownership_model, outlet_name, outlet_brand, region, provinsi, kota"


def dimension(spark, sf):
    return outlet_dimension(s.outlets(spark, sf), s.brand_names(spark, sf), s.transitions(spark, sf))


@query("outlet_dim", c.with_(c.OUTLETS) + "SELECT * FROM dim")
def outlet_dim(spark, sf):
    return dimension(spark, sf)


@query("effective_dated_outlet", c.with_(c.HEADERS, c.OUTLETS) + f"""
SELECT h.order_id, h.transaction_id, {c.ATTRIBUTES} FROM headers h LEFT JOIN dim d ON h.outlet_code = d.jilid""")
def effective_dated_outlet(spark, sf):
    h = s.headers(spark, sf).select("order_id", "transaction_id", "outlet_code", F.to_date("transaction_date").alias("day"))
    return with_outlet(h, dimension(spark, sf), "day").drop("outlet_code", "day")


@query("valid_sales", c.with_(c.HEADERS) + f"SELECT order_id, transaction_id, sales_type, total_amount FROM headers h WHERE {c.VALID}")
def valid_sales(spark, sf):
    return ops.valid_sales(s.headers(spark, sf)).select("order_id", "transaction_id", "sales_type", "total_amount")


def _headers_oracle(join: str, extra: str, extra_names: str, final: str) -> str:
    return c.with_(c.HEADERS, c.OUTLETS) + f"""
SELECT {final} FROM (
  SELECT {CAL}, h.outlet_code, {extra} {c.ATTRIBUTES}, {', '.join('h.' + x for x in ops.HEADER_SUMS.values())}, h.order_id
  FROM headers h {join} JOIN dim d ON h.outlet_code = d.jilid WHERE {c.VALID}) h
GROUP BY transaction_date, week, month, year, outlet_code, {extra_names} {ATTR}"""


_DAILY = f"transaction_date, week, month, year, outlet_code, {ATTR}, {SUMS}, COUNT(DISTINCT order_id) AS total_order"
DAILY_SQL = _headers_oracle("LEFT", "", "", _DAILY)


@query("daily_transactions", DAILY_SQL)
def daily_transactions(spark, sf):
    return ops.daily_transactions(s.headers(spark, sf), dimension(spark, sf))


_HOURLY = f"transaction_date, week, month, year, outlet_code, transaction_hour, {ATTR}, {SUMS}, COUNT(DISTINCT order_id) AS total_order"
HOURLY_SQL = _headers_oracle("", "CAST(hour(h.transaction_date) AS INTEGER) AS transaction_hour,", "transaction_hour,", _HOURLY)


@query("hourly_transactions", HOURLY_SQL)
def hourly_transactions(spark, sf):
    return ops.hourly_transactions(s.headers(spark, sf), dimension(spark, sf))


_CHANNEL = c.case_lookup("h.payment_type", fv.SUMMARY_CHANNELS, c.q(fv.WALK_IN))


@query("daily_sales_type", _headers_oracle(
    "", f"{_CHANNEL} AS channel, h.payment_type AS payment,", "channel, payment,",
    f"transaction_date, week, month, year, outlet_code, upper(channel) AS sales_type, upper(payment) AS payment_method, "
    f"channel || payment AS sales_type_payment_method, {ATTR}, {SUMS}, COUNT(DISTINCT order_id) AS total_order"))
def daily_sales_type(spark, sf):
    return ops.daily_sales_type(s.headers(spark, sf), dimension(spark, sf))


_ROLLED = ["transaction_date", "transaction_hour", "outlet_code", "sales_type_payment_method", "ownership_model", "outlet_brand"]


def _level(name: str, sql: str, has: list[str]) -> str:
    kinds = {"transaction_date": "DATE", "transaction_hour": "INTEGER"}
    keys = ", ".join(k if k in has else f"CAST(NULL AS {kinds.get(k, 'VARCHAR')}) AS {k}" for k in _ROLLED)
    return f"SELECT '{name}' AS level, {keys}, {', '.join(ops.HEADER_SUMS)}, total_order FROM ({sql}) {name}"


_SALES_TYPE_SQL = _headers_oracle(
    "", f"{_CHANNEL} AS channel, h.payment_type AS payment,", "channel, payment,",
    f"transaction_date, outlet_code, channel || payment AS sales_type_payment_method, {ATTR}, {SUMS}, COUNT(DISTINCT order_id) AS total_order")
_COMPANY_SQL = c.with_(c.HEADERS) + f"""
SELECT CAST(h.transaction_date AS DATE) AS transaction_date, {SUMS}, COUNT(DISTINCT order_id) AS total_order FROM headers h WHERE {c.VALID} GROUP BY 1"""


@query("sales_rollups", " UNION ALL ".join((
    _level("daily", DAILY_SQL, [k for k in _ROLLED if k not in ("transaction_hour", "sales_type_payment_method")]),
    _level("hourly", HOURLY_SQL, [k for k in _ROLLED if k != "sales_type_payment_method"]),
    _level("channel", _SALES_TYPE_SQL, [k for k in _ROLLED if k != "transaction_hour"]),
    _level("company", _COMPANY_SQL, ["transaction_date"]))))
def sales_rollups(spark, sf):
    """Four summaries from one fold of the headers, which is stored and the only reader of them."""
    folded, dim = cut_lineage(cube.header_cube(s.headers(spark, sf))), dimension(spark, sf)
    company = cube.company_days_from_cube(folded).select(F.col("_day").alias("transaction_date"), "total_order",
                                                         *[money_value(n).alias(n) for n in ops.HEADER_SUMS])
    levels = {"daily": cube.daily_from_cube(folded, dim), "hourly": cube.hourly_from_cube(folded, dim),
              "channel": cube.sales_type_from_cube(folded, dim), "company": company}
    out = None
    for name, df in levels.items():
        part = df.select(F.lit(name).alias("level"), *[F.col(k) if k in df.columns else F.lit(None).alias(k) for k in _ROLLED], *ops.HEADER_SUMS, "total_order")
        out = part if out is None else out.unionByName(part)
    return out


# the stored detail rows carry their order's state; the stand-in gives every detail the same one
def _paid_details(spark, sf):
    return (s.details(spark, sf).withColumn("transactions_status", F.lit("success"))
            .withColumn("sales_type", F.lit(fv.WALK_IN)))


@query("daily_items", c.with_(c.HEADERS, c.OUTLETS, c.DETAILS) + f"""
SELECT transaction_date, week, month, year, lpad(outlet_code, 5, '0') AS jilid, {ATTR}, sku, item_name, item_variant_name,
       {", ".join(f"{c.msum(n)} AS {n}" for n in ops.ITEM_SUMS)}
FROM (SELECT DISTINCT h.order_id, {CAL}, h.outlet_code, {c.ATTRIBUTES}
      FROM headers h LEFT JOIN dim d ON h.outlet_code = d.jilid WHERE {c.VALID}) o
JOIN (SELECT order_id, sku, product_name AS item_name, '-' AS item_variant_name, {", ".join(f"{src} AS {n}" for n, src in ops.ITEM_SUMS.items())}
      FROM details) i ON o.order_id = i.order_id
WHERE ownership_model IS NOT NULL AND outlet_brand IS NOT NULL
GROUP BY transaction_date, week, month, year, outlet_code, {ATTR}, sku, item_name, item_variant_name""")
def daily_items(spark, sf):
    return ops.daily_items(s.headers(spark, sf), _paid_details(spark, sf), dimension(spark, sf))


BUNDLE_QTY = f"""bq AS (
  SELECT order_id, bundling_name, {c.msum('quantity')} AS quantity
  FROM (SELECT DISTINCT order_id, order_detail_id, bundling_id, product_generic_name AS bundling_name, quantity
        FROM details WHERE bundling_id <> '' AND type = 'comboset') u GROUP BY order_id, bundling_name)"""


@query("bundle_qty", c.with_(c.DETAILS, BUNDLE_QTY) + "SELECT * FROM bq")
def bundle_qty(spark, sf):
    return ops.bundle_qty(s.details(spark, sf))


_BCHANNEL = f"upper({_CHANNEL})"


@query("daily_bundlings", c.with_(c.HEADERS, c.OUTLETS, c.DETAILS, BUNDLE_QTY) + f"""
, ba AS (SELECT order_id, product_generic_name AS bundling_name, {c.msum('total_amount')} AS total_amount
         FROM details WHERE bundling_id <> '' AND type = 'comboset' GROUP BY 1, 2),
oh AS (
  SELECT * FROM (
    SELECT h.order_id, {CAL}, h.outlet_code, {c.ATTRIBUTES}, {_BCHANNEL} AS sales_type, h.payment_type AS payment_method,
           row_number() OVER (PARTITION BY h.order_id ORDER BY h.transaction_id) AS rn
    FROM headers h LEFT JOIN dim d ON h.outlet_code = d.jilid
    WHERE h.payment_status = 'paid' AND h.fulfillment_status = 'fulfilled' AND h.transactions_status = 'success') x WHERE rn = 1)
SELECT transaction_date, week, month, year, lpad(outlet_code, 5, '0') AS jilid, {ATTR}, sales_type, payment_method, bq.bundling_name,
       {c.msum('quantity')} AS quantity, {c.msum('total_amount')} AS total_amount
FROM bq JOIN ba ON bq.order_id = ba.order_id AND bq.bundling_name = ba.bundling_name JOIN oh ON oh.order_id = bq.order_id
WHERE ownership_model IS NOT NULL AND outlet_brand IS NOT NULL
GROUP BY transaction_date, week, month, year, outlet_code, {ATTR}, sales_type, payment_method, bq.bundling_name""")
def daily_bundlings(spark, sf):
    return ops.daily_bundlings(s.headers(spark, sf), s.details(spark, sf), dimension(spark, sf))


_PART = f"""transaction_date, week, month, year, lpad(outlet_code, 5, '0') AS jilid, outlet_name, ownership_model, outlet_brand,
       region, provinsi, kota, coalesce(total_gross_sales, 0) AS total_gross_sales,
       coalesce(total_discount_amount + total_promotion_amount, 0) AS total_discount,
       coalesce(total_net_sales, 0) AS total_net_sales, coalesce(total_taxes, 0) AS total_taxes,
       coalesce(total_collected, 0) AS total_collected, CAST(coalesce(total_order, 0) AS DOUBLE) AS total_order"""


@query("companywide_mitra", f"SELECT {_PART}, {c.q(fv.SOURCE_LABELS[3])} AS datasource FROM ({DAILY_SQL}) x "
                            f"WHERE ownership_model = {c.q(fv.FRANCHISE_MODEL)}")
def companywide_mitra(spark, sf):
    return ops.franchise_part(ops.daily_transactions(s.headers(spark, sf), dimension(spark, sf)))


# four company-wide sources: outlets by nation key % 4; the first carries refunds (one per day with a refund header)
def _company_sources(spark, sf, hour: bool):
    h, dim = s.headers(spark, sf), dimension(spark, sf)
    build = ops.hourly_transactions if hour else ops.daily_transactions
    daily = build(h, dim)
    lane = F.col("outlet_code").cast("int") % 4
    dates = ["transaction_date", *(["transaction_hour"] if hour else [])]
    first = (daily.filter(lane == 0)
             .select(*dates, "outlet_code", *ops.COMPANY_COLUMNS[5:], "total_gross_sales",
                     (F.col("total_discount_amount") + F.col("total_promotion_amount")).alias("total_discount"),
                     "total_net_sales", "total_taxes", "total_collected", "total_order",
                     (F.col("total_order") % 2).alias("total_refund_order")))
    parts = [ops.refund_corrected(first, fv.SOURCE_LABELS[0], hour)]
    for i in (1, 2):
        parts.append(ops.companywide_part(daily.filter(lane == i), fv.SOURCE_LABELS[i], hour))
    last = daily.filter(lane == 3)
    if not hour:
        last = last.filter(F.col("ownership_model") != fv.FRANCHISE_MODEL)
    parts.append(ops.companywide_part(last, fv.SOURCE_LABELS[3], hour))
    return parts


def _company_oracle(sql: str, hour: bool) -> str:
    hr = "transaction_hour, " if hour else ""
    part = _PART.replace("year, ", "year, " + hr, 1)
    lane = "CAST(outlet_code AS INTEGER) % 4"
    own = "" if hour else f" AND ownership_model <> {c.q(fv.FRANCHISE_MODEL)}"
    return f"""WITH d AS ({sql})
SELECT transaction_date, week, month, year, {hr}outlet_code AS jilid, outlet_name, ownership_model, outlet_brand,
       region, provinsi, kota, {c.msum('total_gross_sales')} AS total_gross_sales,
       {c.msum('total_discount_amount + total_promotion_amount')} AS total_discount, {c.msum('total_net_sales')} AS total_net_sales,
       {c.msum('total_taxes')} AS total_taxes, {c.msum('total_collected')} AS total_collected,
       CAST(SUM(total_order) - SUM((total_order % 2) * 2) AS DOUBLE) AS total_order, {c.q(fv.SOURCE_LABELS[0])} AS datasource
FROM d WHERE {lane} = 0
GROUP BY transaction_date, week, month, year, {hr}outlet_code, outlet_name, ownership_model, outlet_brand, region, provinsi, kota
UNION SELECT {part}, {c.q(fv.SOURCE_LABELS[1])} FROM d WHERE {lane} = 1
UNION SELECT {part}, {c.q(fv.SOURCE_LABELS[2])} FROM d WHERE {lane} = 2
UNION SELECT {part}, {c.q(fv.SOURCE_LABELS[3])} FROM d WHERE {lane} = 3{own}"""


@query("companywide_daily", _company_oracle(DAILY_SQL, False))
def companywide_daily(spark, sf):
    sources = _company_sources(spark, sf, False)
    return ops.companywide([*sources, sources[0]])  # a source that is listed twice counts once


@query("companywide_hourly", _company_oracle(HOURLY_SQL, True))
def companywide_hourly(spark, sf):
    return ops.companywide(_company_sources(spark, sf, True))


# the app's own item summary: open lines per ship date, one outlet per supplier
def _app_items(spark, sf):
    d = s.details(spark, sf).filter(F.col("status") == "O")
    return d.select("transaction_date", F.lpad((F.col("product_id") % 25).cast("string"), 5, "0").alias("outlet_code"),
                    F.concat(F.lit("NATION_"), (F.col("product_id") % 25).cast("string")).alias("outlet_name"),
                    F.when(F.col("product_id") % 3 == 0, fv.FRANCHISE_MODEL).otherwise(fv.OWNED_MODEL).alias("ownership_model"),
                    "sku", "product_name", F.col("quantity").alias("total_quantity"),
                    F.col("total_order_amount").alias("total_gross_sales"), F.col("subtotal").alias("total_net_sales")) \
        .withColumn("transaction_date", F.to_date("transaction_date"))


@query("daily_items_sales_type", c.with_(c.HEADERS, c.OUTLETS, c.DETAILS) + f"""
, i AS (SELECT order_id, sku, product_name AS item_name, {c.msum('quantity')} AS total_quantity,
               {c.msum('total_order_amount')} * 1.1::DOUBLE AS total_gross_sales, {c.msum('total_amount')} AS total_collected
        FROM details GROUP BY order_id, sku, product_name),
oh AS (SELECT * FROM (
         SELECT h.order_id, CAST(h.transaction_date AS DATE) AS transaction_date, h.outlet_code, h.sales_type AS sales_type_name,
                {c.ATTRIBUTES}, row_number() OVER (PARTITION BY h.order_id ORDER BY h.transaction_id) AS rn
         FROM headers h LEFT JOIN dim d ON h.outlet_code = d.jilid WHERE {c.VALID}) x WHERE rn = 1)
SELECT transaction_date, lpad(outlet_code, 5, '0') AS jilid, ownership_model, outlet_name, sales_type_name, sku, item_name,
       {c.msum('total_quantity')} AS total_quantity, {c.msum('total_gross_sales')} AS total_gross_sales,
       {c.msum('total_collected')} AS total_collected
FROM oh JOIN i ON oh.order_id = i.order_id WHERE ownership_model IS NOT NULL
GROUP BY transaction_date, outlet_code, ownership_model, outlet_name, sales_type_name, sku, item_name
UNION ALL
SELECT CAST(transaction_date AS DATE), lpad(CAST(product_id % 25 AS VARCHAR), 5, '0'), {c.q(fv.OWNED_MODEL)},
       'NATION_' || CAST(product_id % 25 AS VARCHAR), {c.q(fv.SOURCE_LABELS[1])}, sku, product_name,
       {c.msum('quantity')}, {c.msum('total_order_amount')}, {c.msum('subtotal')}
FROM details WHERE status = 'O' AND product_id % 3 <> 0 GROUP BY 1, 2, 4, 6, 7""")
def daily_items_sales_type(spark, sf):
    return ops.daily_items_sales_type(s.headers(spark, sf), s.details(spark, sf), dimension(spark, sf), _app_items(spark, sf))


