"""Committed loads: every query stores tables, runs its load twice and reads the stored table back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillworks import fixed_values as fv
from tillworks.functions.scalars import lookback_start, to_number, week_bounds
from tillworks.operators import dispatch, income, landlord, loads, sinks
from tillworks.operators import orders as order_ops
from tillworks.operators.documents import orders_to_tables
from tillworks.plans import commission as com
from tillworks.plans import ctes as c
from tillworks.plans import dispatch as dis
from tillworks.plans import income as inc
from tillworks.plans import loads as frames
from tillworks.plans import orders as ords
from tillworks.plans.registry import ORACLES, query
from tillworks.session import cut_lineage, scratch_path
from tillworks.sources import standin as s
from tillworks.sources.tables_on_disk import Tables, by_bucket, by_month
from tillworks.streaming.upsert import order_tables


def _tables(spark, name: str, **layouts) -> Tables:
    return Tables(spark, scratch_path(spark, name), layouts)


def _twice(load) -> None:
    load()
    load()


@query("committed_window", ORACLES["replace_window"])
def committed_window(spark, sf):
    stored, t = _tables(spark, "window", daily=by_month("transaction_date")), frames._daily(spark, sf)
    loads.load_table(stored, "daily", t)
    owned = F.col("ownership_model") == fv.FRANCHISE_MODEL
    new = frames._daily_new(t.filter(sinks.in_window("transaction_date", frames.START, frames.END) & owned))
    _twice(lambda: loads.load_window(stored, "daily", new, "transaction_date", frames.START, frames.END, owned))
    return stored.read("daily")


@query("committed_dates", ORACLES["replace_dates"])
def committed_dates(spark, sf):
    stored, t = _tables(spark, "dates", daily=by_month("transaction_date")), frames._daily(spark, sf)
    loads.load_table(stored, "daily", t)
    new = frames._daily_new(t.filter(F.col("outlet_code") == "00002"))
    _twice(lambda: loads.load_dates(stored, "daily", new, "transaction_date"))
    return stored.read("daily")


@query("committed_batch_log", ORACLES["replace_batch_log"])
def committed_batch_log(spark, sf):
    stored = _tables(spark, "batches", daily=by_month("transaction_date"))
    t = frames._daily(spark, sf).withColumn("batch_label", F.explode(F.array(F.lit("08AM"), F.lit("11AM"))))
    loads.load_table(stored, "daily", t)
    new = frames._daily_new(t.filter((F.col("outlet_code") == "00002") & (F.col("batch_label") == "11AM")))
    _twice(lambda: loads.load_batch(stored, "daily", new, "transaction_date", "batch_label", "11AM"))
    return stored.read("daily")


_RECENT = "transaction_date >= TIMESTAMP '1998-07-01' AND payment_type = 'GoFood'"


@query("pruned_window", """
SELECT order_id, transaction_id, transaction_date, total_amount FROM (%s SELECT * FROM headers) x
WHERE CAST(transaction_date AS DATE) BETWEEN DATE '1996-12-30' AND DATE '1997-02-02'""" % c.with_(c.HEADERS))
def pruned_window(spark, sf):
    """A window, widened by a day before and two behind, of headers that are stored by month."""
    stored = _tables(spark, "months", headers=by_month("transaction_date"))
    loads.load_table(stored, "headers", s.headers(spark, sf).select("order_id", "transaction_id", "transaction_date", "total_amount"))
    return stored.window("headers", "transaction_date", "1996-12-31", "1997-01-31", 1, 2)


@query("pruned_details", c.with_(c.HEADERS, c.DETAILS) + f"""
SELECT order_id, order_detail_id, total_amount FROM details WHERE order_id IN (SELECT order_id FROM headers WHERE {_RECENT})""")
def pruned_details(spark, sf):
    """Details stored by a month that may be a day off their order's: the selected orders decide which months are read."""
    headers = s.headers(spark, sf)
    days = headers.groupBy("order_id").agg(F.min("transaction_date").alias("day"))
    off = (F.col("order_detail_id") % 3 - 1).cast("int")
    details = s.details(spark, sf).select("order_id", "order_detail_id", "total_amount").join(days, "order_id", "left").withColumn(
        "day", F.date_add(F.to_date("day"), off))
    stored = _tables(spark, "months", details=by_month("day"))
    loads.load_table(stored, "details", details)
    return stored.of_keys("details", headers.where(_RECENT), "order_id", "transaction_date").drop("day")


@query("committed_orders", frames.HEAD + """
SELECT 'header' AS part, order_id, transaction_id AS row_id, total_amount FROM headers
UNION ALL SELECT 'detail', order_id, order_detail_id, total_amount FROM details WHERE order_id NOT IN (SELECT order_id FROM sh)
UNION ALL SELECT 'detail', order_id, order_detail_id, total_amount FROM sd""")
def committed_orders(spark, sf):
    stored = order_tables(spark, scratch_path(spark, "orders"), 16)
    stored.load({"headers": frames._sh(spark, sf), "details": frames._sd(spark, sf)})
    _twice(lambda: loads.load_new_orders(stored, frames._h(spark, sf), frames._d(spark, sf)))
    part = lambda name, row: stored.read(f"{name}s").select(F.lit(name).alias("part"), "order_id", F.col(row).alias("row_id"), "total_amount")
    return part("header", "transaction_id").unionByName(part("detail", "order_detail_id"))


@query("committed_upsert", frames.UP_HEAD + f"""
SELECT order_id, transaction_id, total_amount, version FROM (
  SELECT order_id, transaction_id, total_amount, transaction_date, 'old' AS version FROM kh WHERE order_id NOT IN (SELECT order_id FROM dec WHERE decision = 'update')
  UNION ALL SELECT order_id, transaction_id, total_amount, transaction_date, 'new' FROM nh WHERE order_id IN (SELECT order_id FROM dec WHERE decision <> 'held')) x
WHERE transaction_date >= TIMESTAMP '{frames.CUTOFF}'""")
def committed_upsert(spark, sf):
    stored = order_tables(spark, scratch_path(spark, "upsert"), 16)
    headers, details, new, new_details = frames._upsert_inputs(spark, sf)
    new = cut_lineage(new)
    dates = new.groupBy("order_id").agg(F.min("order_date").alias("order_date"))
    new_details = cut_lineage(new_details.drop("order_date").join(dates, "order_id"))
    loads.load_upsert(stored, headers, details, spread=False)
    _twice(lambda: loads.load_upsert(stored, new, new_details, frames.CUTOFF, staged=True, spread=False))
    return loads.stored_orders(stored, "headers", frames.CUTOFF).select("order_id", "transaction_id", "total_amount", "version")


@query("committed_fulfilled", ORACLES["update_fulfilled"])
def committed_fulfilled(spark, sf):
    stored = _tables(spark, "fulfilled", headers=by_bucket("order_id", 16))
    loads.load_table(stored, "headers", s.headers(spark, sf))
    done = (s.details(spark, sf).filter(F.col("type") == fv.BUNDLE_TYPE).groupBy("order_id")
            .agg(F.when(F.max(F.col("product_id") % 50 == 7), "listed").alias("sales_type")))
    _twice(lambda: loads.load_fulfilled(stored, done))
    return stored.read("headers").select("order_id", "transaction_id", "fulfillment_status", "sales_type")


@query("committed_patch", ORACLES["patch_column"])
def committed_patch(spark, sf):
    stored, t = _tables(spark, "patch", daily=by_month("transaction_date")), frames._daily(spark, sf)
    loads.load_table(stored, "daily", t)
    patch = t.filter(F.col("total_order") % 2 == 1).select("transaction_date", "outlet_code", (F.col("total_order") + 100).alias("total_order"))
    _twice(lambda: loads.load_patch(stored, "daily", patch, ["transaction_date", "outlet_code"], "total_order", only=F.col("outlet_code") < "00012"))
    return stored.read("daily")


# stored: every week and day with one more than they should have; loaded: the week of 1996-07-01, its days up to the day before its end
WEEK, WEEK_END, DATA_END = "1996-07-01", "1996-07-07", "1996-07-06"


@query("committed_commission", c.with_(com.SUMS) + f"""
SELECT 'daily' AS part, rider_id, transaction_date AS start_date, transaction_date AS end_date,
       total_item_qty + CASE WHEN transaction_date BETWEEN DATE '{WEEK}' AND DATE '{DATA_END}' THEN 0 ELSE 1 END AS qty FROM rs
UNION ALL SELECT 'product', rider_id, transaction_date, transaction_date,
       qty + CASE WHEN transaction_date BETWEEN DATE '{WEEK}' AND DATE '{DATA_END}' THEN 0 ELSE 1 END FROM prod
UNION ALL SELECT 'weekly', rider_id, w, w + 6, CAST(sum(total_item_qty) AS BIGINT) + CASE WHEN w = DATE '{WEEK}' THEN 0 ELSE 1 END
FROM (SELECT *, CAST(date_trunc('week', transaction_date) AS DATE) AS w FROM rs) x GROUP BY rider_id, w""")
def committed_commission(spark, sf):
    days = s.rider_summaries(spark, sf).select("rider_id", F.to_date("transaction_date").alias("transaction_date"), F.col("total_item_qty").alias("qty"))
    products = s.rider_day_products(spark, sf).select("rider_id", F.to_date("transaction_date").alias("transaction_date"), "qty")
    first, last = week_bounds("transaction_date")
    weeks = days.groupBy("rider_id", first.alias("start_date"), last.alias("end_date")).agg(F.sum("qty").alias("qty"))
    more = lambda df: df.withColumn("qty", F.col("qty") + 1)
    stored = _tables(spark, "commission", weekly=by_month("start_date"), daily=by_month("transaction_date"), products=by_month("transaction_date"))
    stored.load({"weekly": more(weeks), "daily": more(days), "products": more(products)})
    until = lambda df: df.filter(sinks.in_window("transaction_date", WEEK, DATA_END))
    week = weeks.filter((F.col("start_date") == F.to_date(F.lit(WEEK))))
    _twice(lambda: loads.load_commission(stored, week, until(days), until(products), WEEK, WEEK_END, DATA_END))
    one = lambda name, part: stored.read(name).select(
        F.lit(part).alias("part"), "rider_id", F.col("transaction_date").alias("start_date"), F.col("transaction_date").alias("end_date"), "qty")
    weekly = stored.read("weekly").select(F.lit("weekly").alias("part"), "rider_id", "start_date", "end_date", "qty")
    return one("daily", "daily").unionByName(one("products", "product")).unionByName(weekly)


@query("committed_send_log", inc.HEAD + f""", {inc.PAYLOAD}
SELECT jilid, transaction_number, transaction_date, payment_type, amount, CASE WHEN amount > 100000 THEN 'success' ELSE 'error' END AS status,
       CASE WHEN amount > 100000 THEN 'X' || jilid END AS mall_transaction_id, CASE WHEN amount <= 100000 THEN 'refused' END AS error_message FROM payload""")
def committed_send_log(spark, sf):
    stored, payload = _tables(spark, "log", send_log=by_month("transaction_date")), landlord.payload_from_income(inc.daily(spark, sf), inc.PREFIX, inc.RUN)
    loads.load_pending(stored, payload, "2024-01-05 10:30:00")
    ok = F.col("amount") > 100000
    result = payload.select("jilid", "transaction_number", F.when(ok, "success").otherwise("error").alias("status"),
                            F.when(ok, F.concat(F.lit("X"), "jilid")).alias("mall_transaction_id"), F.when(~ok, "refused").alias("error_message"))
    loads.load_results(stored, result)
    return stored.read("send_log").select("jilid", "transaction_number", "transaction_date", "payment_type", "amount", "status", "mall_transaction_id",
                                         "error_message")


@query("committed_order_income", inc.HEAD + "SELECT order_id, transaction_id, subtotal, sales_type_commission FROM orderinc")
def committed_order_income(spark, sf):
    """Gated on the totals; the planted tables differ in order counts on some days, which the gate leaves to the report."""
    stored, orders = _tables(spark, "income", order_income=by_bucket("order_id", 16)), inc.orderinc(spark, sf)
    off = F.col("side") != "both"
    for x in income.MONEY_CHECK:
        off = off | (F.abs(f"diff_{x}") >= income.TOLERANCE)
    _twice(lambda: loads.load_order_income(stored, orders, income.reconcile_with_daily(orders, inc.daily(spark, sf)).filter(off)))
    return stored.read("order_income").select("order_id", "transaction_id", "subtotal", "sales_type_commission")


@query("committed_flags", ORACLES["membership_flag"])
def committed_flags(spark, sf):
    """The gate on row counts: flags are stored only if the join kept the number of orders."""
    orders = dis.pending(spark, sf).select("pending_order_id", "customer_id")
    members = dispatch.members_on(s.vouchers(spark, sf), dis.AS_OF)
    stored = _tables(spark, "flags", flags=by_bucket("pending_order_id", 16))
    loads.load_joined(stored, "flags", orders, lambda rows: dispatch.membership_flag(rows, members))
    return stored.read("flags")


@query("orders_read_twice", ORACLES["orders_to_tables"])
def orders_read_twice(spark, sf):
    """The details of documents that were pulled twice are those of the documents."""
    docs = s.order_documents(spark, sf)
    prices = order_ops.product_weights(s.products(spark, sf))
    return orders_to_tables(docs.unionAll(docs), prices, "discounts", s.LISTED)[1].select(*ords._DETAIL_OUT)


# --- scans by date arithmetic and by text that is mostly a number ---------------------------------------------------

@query("lookback_window", """
SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) >= greatest(DATE '1998-08-02' - 60, DATE '1998-06-20')""")
def lookback_window(spark, sf):
    start = lookback_start(F.to_date(F.lit("1998-08-02")), 60, "1998-06-20")
    return s.table(spark, sf, "orders").filter(F.to_date("o_orderdate") >= start).select("o_orderkey", "o_orderdate")


@query("numbers_from_text", """
SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS priority, coalesce(TRY_CAST(o_orderpriority AS DOUBLE), 0.0) AS whole FROM orders""")
def numbers_from_text(spark, sf):
    return s.table(spark, sf, "orders").select("o_orderkey", to_number(F.substring_index("o_orderpriority", "-", 1)).alias("priority"),
                                               to_number("o_orderpriority", 0).alias("whole"))
