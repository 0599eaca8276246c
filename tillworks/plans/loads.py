"""Scans, loads and audits: queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillworks import fixed_values as fv
from tillworks.operators import audit, sinks
from tillworks.operators import dedup as dedup_ops
from tillworks.operators import summaries as sums_ops
from tillworks.plans import cleaning
from tillworks.plans import ctes as c
from tillworks.plans import summaries as sums
from tillworks.plans.registry import query
from tillworks.session import scratch_path
from tillworks.sources import standin as s
from tillworks.sources.tables import scan_by_keys as keyed_scan
from tillworks.sources.tables import window_scan

START, END = "1997-01-01", "1998-12-31"
HSEL = ["order_id", "transaction_id", "outlet_code", "transaction_date", "total_amount"]
HCOLS = ", ".join(HSEL)


def _h(spark, sf):
    return s.headers(spark, sf).select(*HSEL)


# --- scans ----------------------------------------------------------------------------------------------------------

@query("scan_window", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'""")
def scan_window(spark, sf):
    return window_scan(s.table(spark, sf, "lineitem"), "l_shipdate", START, END).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")


@query("scan_padded_window", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate FROM lineitem
WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{START}' - 1 AND DATE '{END}' + 1""")
def scan_padded_window(spark, sf):
    return window_scan(s.table(spark, sf, "lineitem"), "l_shipdate", START, END, 1, 1).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")


@query("scan_by_keys", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def scan_by_keys(spark, sf):
    keys = s.table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("l_orderkey"))
    return keyed_scan(s.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"), keys, "l_orderkey")


@query("sorted_headers", c.with_(c.HEADERS) + """
SELECT order_id, transaction_id, total_amount, row_number() OVER (ORDER BY total_amount, transaction_id) AS place FROM headers""")
def sorted_headers(spark, sf):
    """Places that come from the files alone: the file's name and the row within it."""
    path = scratch_path(spark, "sorted")
    sinks.write_sorted(s.headers(spark, sf).select("order_id", "transaction_id", "total_amount"), path, "total_amount", "transaction_id", files=12)
    return sinks.read_sorted(spark, path)


@query("sorted_file_ranges", c.with_(c.HEADERS) + "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS overlapping FROM headers")
def sorted_file_ranges(spark, sf):
    path = scratch_path(spark, "sorted")
    sinks.write_sorted(s.headers(spark, sf).select("transaction_id", "total_amount"), path, "transaction_id", files=12)
    files = sinks.file_ranges(spark, path, "transaction_id")
    behind = F.col("least") <= F.lag("greatest").over(Window.orderBy("file"))
    return files.withColumn("behind", F.coalesce(behind, F.lit(False))).agg(F.sum("rows").alias("rows"), F.count_if("behind").alias("overlapping"))


# --- window and date replaces: target = the daily summary, some owners unknown; new = a recomputation with other sums ---

_T = "transaction_date, outlet_code, ownership_model, total_collected, total_order"


def _daily(spark, sf):
    d = sums_ops.daily_transactions(s.headers(spark, sf), sums.dimension(spark, sf))
    return d.select("transaction_date", "outlet_code", "ownership_model", "total_collected", "total_order")


def _daily_new(d):
    return d.withColumn("total_collected", F.col("total_collected") + 1)


@query("replace_window", f"""WITH t AS (SELECT {_T} FROM ({sums.DAILY_SQL}) x)
SELECT * FROM t WHERE NOT coalesce(transaction_date BETWEEN DATE '{START}' AND DATE '{END}' AND ownership_model = {c.q(fv.FRANCHISE_MODEL)}, FALSE)
UNION ALL SELECT transaction_date, outlet_code, ownership_model, total_collected + 1, total_order FROM t
WHERE transaction_date BETWEEN DATE '{START}' AND DATE '{END}' AND ownership_model = {c.q(fv.FRANCHISE_MODEL)}""")
def replace_window(spark, sf):
    t = _daily(spark, sf)
    owned = F.col("ownership_model") == fv.FRANCHISE_MODEL
    new = _daily_new(t.filter(sinks.in_window("transaction_date", START, END) & owned))
    return sinks.replace_window(t, new, "transaction_date", START, END, owned)


@query("replace_dates", f"""WITH t AS (SELECT {_T} FROM ({sums.DAILY_SQL}) x),
n AS (SELECT transaction_date, outlet_code, ownership_model, total_collected + 1, total_order FROM t WHERE outlet_code = '00002')
SELECT * FROM t WHERE transaction_date NOT IN (SELECT transaction_date FROM n) UNION ALL SELECT * FROM n""")
def replace_dates(spark, sf):
    t = _daily(spark, sf)
    return sinks.replace_dates(t, _daily_new(t.filter(F.col("outlet_code") == "00002")), "transaction_date")


@query("replace_batch_log", f"""WITH t AS (SELECT {_T}, b AS batch_label FROM ({sums.DAILY_SQL}) x, (VALUES ('08AM'), ('11AM')) v(b)),
n AS (SELECT transaction_date, outlet_code, ownership_model, total_collected + 1, total_order, batch_label FROM t WHERE outlet_code = '00002' AND batch_label = '11AM')
SELECT * FROM t WHERE NOT (batch_label = '11AM' AND transaction_date IN (SELECT transaction_date FROM n)) UNION ALL SELECT * FROM n""")
def replace_batch_log(spark, sf):
    t = _daily(spark, sf).withColumn("batch_label", F.explode(F.array(F.lit("08AM"), F.lit("11AM"))))
    new = _daily_new(t.filter((F.col("outlet_code") == "00002") & (F.col("batch_label") == "11AM")))
    return sinks.replace_batch_log(t, new, "transaction_date", "batch_label", "11AM")


# --- order loads: the store holds outlets below 00015 ----------------------------------------------------------------

STORED = """sh AS (SELECT * FROM headers WHERE outlet_code < '00015'),
sd AS (SELECT * FROM details WHERE order_id IN (SELECT order_id FROM sh) AND type <> 'standard')"""
HEAD = c.with_(c.HEADERS, c.DETAILS, STORED)
DSEL = ["order_id", "order_detail_id", "type", "product_id", "quantity", "total_amount"]
DCOLS = ", ".join(DSEL)


def _sh(spark, sf):
    return _h(spark, sf).filter(F.col("outlet_code") < "00015")


def _d(spark, sf):
    return s.details(spark, sf).select(*DSEL)


def _sd(spark, sf):
    return _d(spark, sf).filter(F.col("type") != "standard").join(_sh(spark, sf).select("order_id").distinct(), "order_id", "left_semi")


@query("append_new_orders", HEAD + f"""
SELECT 'header' AS part, order_id, transaction_id AS row_id, total_amount FROM headers WHERE order_id NOT IN (SELECT order_id FROM sh)
UNION ALL SELECT 'detail', order_id, order_detail_id, total_amount FROM details WHERE order_id NOT IN (SELECT order_id FROM sh)""")
def append_new_orders(spark, sf):
    h, d = sinks.append_new_orders(_sh(spark, sf), _h(spark, sf), _d(spark, sf))
    part = lambda df, name, row: df.select(F.lit(name).alias("part"), "order_id", F.col(row).alias("row_id"), "total_amount")
    return part(h, "header", "transaction_id").unionByName(part(d, "detail", "order_detail_id"))


@query("append_counts", HEAD + """
SELECT (SELECT count(*) FROM headers WHERE order_id NOT IN (SELECT order_id FROM sh)) AS headers_inserted,
       (SELECT count(DISTINCT order_id) FROM headers WHERE order_id NOT IN (SELECT order_id FROM sh)) AS orders_inserted,
       (SELECT count(*) FROM details WHERE order_id NOT IN (SELECT order_id FROM sh)) AS details_inserted,
       (SELECT count(DISTINCT order_id) FROM headers WHERE order_id IN (SELECT order_id FROM sh)) AS orders_skipped_existing""")
def append_counts(spark, sf):
    stored, h = _sh(spark, sf), _h(spark, sf)
    return sinks.load_counts(stored, h, *sinks.append_new_orders(stored, h, _d(spark, sf)))


@query("fill_missing_details", HEAD + f"""
SELECT {DCOLS} FROM details WHERE order_id IN (SELECT order_id FROM sh) AND order_id NOT IN (SELECT order_id FROM sd)""")
def fill_missing_details(spark, sf):
    return sinks.fill_missing_details(_sh(spark, sf), _sd(spark, sf), _d(spark, sf))


# unique key (outlet, customer); the batch holds every order, the target the orders of 1995
@query("insert_ignore", c.with_(c.HEADERS) + """
SELECT outlet_code, customer_id, min(transaction_id) AS transaction_id FROM headers h
WHERE NOT EXISTS (SELECT 1 FROM headers t WHERE year(t.transaction_date) = 1995 AND t.outlet_code = h.outlet_code AND t.customer_id = h.customer_id) GROUP BY 1, 2""")
def insert_ignore(spark, sf):
    h = s.headers(spark, sf).select("outlet_code", "customer_id", "transaction_id", "transaction_date")
    target = h.filter(F.year("transaction_date") == 1995)
    return sinks.insert_ignore(target, h.drop("transaction_date"), ["outlet_code", "customer_id"], ["transaction_id"])


# new version: orders with id % 3 = 0 lost their refund, those with id % 4 = 0 their variant lines; cutoff 1996-07-01
CUTOFF = "1996-07-01 00:00:00"
UPSERT = f"""{STORED},
kh AS (SELECT * FROM sh WHERE transaction_date >= TIMESTAMP '{CUTOFF}'),
kd AS (SELECT sd.* FROM sd JOIN (SELECT order_id, min(transaction_date) AS od FROM sh GROUP BY 1) o ON sd.order_id = o.order_id WHERE od >= TIMESTAMP '{CUTOFF}'),
nh AS (SELECT * FROM headers WHERE NOT (order_id % 3 = 0 AND transactions_type = 'refund')),
nd AS (SELECT * FROM details WHERE NOT (order_id % 4 = 0 AND type = 'variant')),
dec AS (
  SELECT n.order_id, CASE WHEN oh IS NULL THEN 'new' WHEN nn < oh OR coalesce(m, 0) < coalesce(od, 0) THEN 'held' ELSE 'update' END AS decision
  FROM (SELECT order_id, count(*) AS nn FROM nh GROUP BY 1) n
  LEFT JOIN (SELECT order_id, count(*) AS m FROM nd GROUP BY 1) a ON n.order_id = a.order_id
  LEFT JOIN (SELECT order_id, count(*) AS oh FROM kh GROUP BY 1) b ON n.order_id = b.order_id
  LEFT JOIN (SELECT order_id, count(*) AS od FROM kd GROUP BY 1) e ON n.order_id = e.order_id)"""
UP_HEAD = c.with_(c.HEADERS, c.DETAILS, UPSERT)


def _upsert_inputs(spark, sf):
    h = s.headers(spark, sf).select(*HSEL, "transactions_type", F.col("transaction_date").alias("order_date"))
    stored = h.filter(F.col("outlet_code") < "00015").withColumn("version", F.lit("old"))
    dates = stored.groupBy("order_id").agg(F.min("order_date").alias("order_date"))
    stored_d = _sd(spark, sf).join(dates, "order_id").withColumn("version", F.lit("old"))
    new = h.filter(~((F.col("order_id") % 3 == 0) & (F.col("transactions_type") == "refund"))).withColumn("version", F.lit("new"))
    new_d = (_d(spark, sf).filter(~((F.col("order_id") % 4 == 0) & (F.col("type") == "variant")))
             .withColumn("order_date", F.lit(None).cast("timestamp_ntz")).withColumn("version", F.lit("new")))
    return stored, stored_d, new, new_d


def _upsert(spark, sf):
    return sinks.upsert_hold_shrink(*_upsert_inputs(spark, sf), CUTOFF)


@query("upsert_hold_shrink", UP_HEAD + """
SELECT order_id, transaction_id, total_amount, 'old' AS version FROM kh WHERE order_id NOT IN (SELECT order_id FROM dec WHERE decision = 'update')
UNION ALL SELECT order_id, transaction_id, total_amount, 'new' FROM nh WHERE order_id IN (SELECT order_id FROM dec WHERE decision <> 'held')""")
def upsert_hold_shrink(spark, sf):
    return _upsert(spark, sf).headers.select("order_id", "transaction_id", "total_amount", "version")


@query("upsert_hold_shrink_details", UP_HEAD + """
SELECT order_id, order_detail_id, total_amount, 'old' AS version FROM kd WHERE order_id NOT IN (SELECT order_id FROM dec WHERE decision = 'update')
UNION ALL SELECT order_id, order_detail_id, total_amount, 'new' FROM nd WHERE order_id IN (SELECT order_id FROM dec WHERE decision <> 'held')""")
def upsert_hold_shrink_details(spark, sf):
    return _upsert(spark, sf).details.select("order_id", "order_detail_id", "total_amount", "version")


@query("upsert_decisions", UP_HEAD + "SELECT * FROM dec")
def upsert_decisions(spark, sf):
    return _upsert(spark, sf).decisions


@query("upsert_counts", UP_HEAD + """
SELECT count(*) FILTER (WHERE decision = 'new') AS orders_new, count(*) FILTER (WHERE decision = 'update') AS orders_updated, count(*) FILTER (WHERE decision = 'held') AS orders_held,
       (SELECT count(*) FROM nh WHERE order_id IN (SELECT order_id FROM dec WHERE decision <> 'held')) AS headers_written,
       (SELECT count(*) FROM nd WHERE order_id IN (SELECT order_id FROM dec WHERE decision <> 'held')) AS details_written,
       (SELECT count(*) FROM sh) - (SELECT count(*) FROM kh) AS rollover_headers, (SELECT count(*) FROM sd) - (SELECT count(*) FROM kd) AS rollover_details FROM dec""")
def upsert_counts(spark, sf):
    inputs = _upsert_inputs(spark, sf)
    return sinks.upsert_counts(sinks.upsert_hold_shrink(*inputs, CUTOFF), *inputs, CUTOFF)


@query("held_sample", UP_HEAD + "SELECT order_id FROM dec WHERE decision = 'held' ORDER BY order_id LIMIT 10")
def held_sample(spark, sf):
    return sinks.held_sample(_upsert(spark, sf).decisions)


# orders whose details have arrived; listed ones get a new channel
@query("update_fulfilled", c.with_(c.HEADERS, c.DETAILS) + """
SELECT h.order_id, transaction_id, CASE WHEN d.order_id IS NOT NULL THEN 'fulfilled' ELSE fulfillment_status END AS fulfillment_status,
       CASE WHEN d.k THEN 'listed' ELSE sales_type END AS sales_type
FROM headers h LEFT JOIN (SELECT order_id, bool_or(product_id % 50 = 7) AS k FROM details WHERE type = 'comboset' GROUP BY 1) d ON h.order_id = d.order_id""")
def update_fulfilled(spark, sf):
    done = (s.details(spark, sf).filter(F.col("type") == fv.BUNDLE_TYPE).groupBy("order_id")
            .agg(F.when(F.max(F.col("product_id") % 50 == 7), "listed").alias("sales_type")))
    return sinks.update_fulfilled(s.headers(spark, sf), done).select("order_id", "transaction_id", "fulfillment_status", "sales_type")


@query("mirror_distinct", c.with_(c.HEADERS) + "SELECT DISTINCT outlet_code, customer_id, payment_type FROM headers")
def mirror_distinct(spark, sf):
    return sinks.mirror_distinct(s.headers(spark, sf), ["outlet_code", "customer_id", "payment_type"])


@query("patch_column", f"""WITH t AS (SELECT {_T} FROM ({sums.DAILY_SQL}) x)
SELECT transaction_date, outlet_code, ownership_model, total_collected, CASE WHEN outlet_code < '00012' AND total_order % 2 = 1 THEN total_order + 100 ELSE total_order END AS total_order FROM t""")
def patch_column(spark, sf):
    t = _daily(spark, sf)
    patch = t.filter(F.col("total_order") % 2 == 1).select("transaction_date", "outlet_code", (F.col("total_order") + 100).alias("total_order"))
    return sinks.patch_column(t, patch, ["transaction_date", "outlet_code"], "total_order", only=F.col("outlet_code") < "00012")


# --- audits ---------------------------------------------------------------------------------------------------------

OPEN = f"""open AS (
  SELECT CAST(transaction_date AS DATE) AS date, outlet_code, coalesce(customer_name, '-') AS outlet_name, order_id, {c.msum("total_amount")} AS total_amount
  FROM headers h LEFT JOIN (SELECT DISTINCT jilid, customer_name FROM outlets) o ON h.outlet_code = o.jilid
  WHERE fulfillment_status = 'none' AND payment_status = 'paid' GROUP BY 1, 2, 3, 4)"""


def _open(spark, sf):
    return audit.unfulfilled_orders(s.headers(spark, sf), s.outlets(spark, sf))


@query("unfulfilled_by_outlet", c.with_(c.HEADERS, c.OUTLETS, OPEN) + """
SELECT outlet_code, outlet_name, date, count(DISTINCT order_id) AS total_orders_unfulfilled, """ + c.msum("total_amount") + """ AS total_amount FROM open GROUP BY 1, 2, 3""")
def unfulfilled_by_outlet(spark, sf):
    return audit.unfulfilled_by_outlet(_open(spark, sf))


@query("fulfillment_outcome", c.with_(c.HEADERS, c.OUTLETS, c.DETAILS, OPEN) + """
SELECT CASE WHEN order_id IN (SELECT order_id FROM details WHERE type = 'comboset') THEN 'fulfilled' ELSE 'unfulfilled' END AS outcome,
       count(DISTINCT order_id) AS total_orders, """ + c.msum("total_amount") + """ AS total_amount FROM open GROUP BY 1""")
def fulfillment_outcome(spark, sf):
    return audit.fulfillment_outcome(_open(spark, sf), s.details(spark, sf).filter(F.col("type") == fv.BUNDLE_TYPE))


_AC = ["quantity", "total_amount", "discount_amount"]


@query("before_after_audit", c.with_(c.DOUBLED) + " UNION ALL ".join(f"""
SELECT '{x}' AS column_name, (SELECT {c.msum(x, True)} FROM doubled) AS before, (SELECT {c.msum(x, True)} FROM details) AS after,
       round((SELECT {c.msum(x, True)} FROM details) - (SELECT {c.msum(x, True)} FROM doubled), 4) AS difference""" for x in _AC))
def before_after_audit(spark, sf):
    return audit.before_after(s.details(spark, sf, doubled=True), s.details(spark, sf), _AC)


@query("parity_by_date", c.with_(c.DOUBLED) + f"""
SELECT coalesce(n.date, o.date) AS date, {", ".join(f"n.{x} AS {x}_new, o.{x} AS {x}_stored" for x in ["rows", "quantity", "total_amount"])},
       {" AND ".join(f"coalesce(abs(n.{x} - o.{x}) <= 0.01, FALSE)" for x in ["rows", "quantity", "total_amount"])} AS matches
FROM (SELECT CAST(transaction_date AS DATE) AS date, CAST(count(*) AS DOUBLE) AS rows, {c.msum('quantity', True)} AS quantity, {c.msum('total_amount', True)} AS total_amount
      FROM doubled WHERE year(transaction_date) <> 1996 GROUP BY 1) n
FULL OUTER JOIN (SELECT CAST(transaction_date AS DATE) AS date, CAST(count(*) AS DOUBLE) AS rows, {c.msum('quantity', True)} AS quantity, {c.msum('total_amount', True)} AS total_amount
      FROM details WHERE year(transaction_date) <> 1997 GROUP BY 1) o ON n.date = o.date""")
def parity_by_date(spark, sf):
    year = F.year("transaction_date")
    return audit.parity_by_date(s.details(spark, sf, doubled=True).filter(year != 1996), s.details(spark, sf).filter(year != 1997), ["quantity", "total_amount"])


@query("outlet_report_rollup", c.with_(c.HEADERS) + f"""
SELECT CAST(transaction_date AS DATE) AS transaction_date, count(order_id) AS total_order_count, {c.msum('total_amount')} AS total_amount
FROM headers GROUP BY ROLLUP (CAST(transaction_date AS DATE))""")
def outlet_report_rollup(spark, sf):
    return audit.outlet_report(s.headers(spark, sf))


@query("intraday_metrics", c.with_(c.HEADERS, c.DETAILS) + f"""
SELECT count(DISTINCT outlet_code) AS table_outlets, count(DISTINCT order_id) AS table_orders, {c.msum('total_amount', True)} AS amount_headers,
       count(DISTINCT order_id) FILTER (WHERE fulfillment_status = 'none') AS orders_unfulfilled, max(transaction_date) AS last_load,
       (SELECT {c.msum('total_amount', True)} FROM details) AS amount_details FROM headers""")
def intraday_metrics(spark, sf):
    return audit.intraday_metrics(s.headers(spark, sf).withColumn("load_data_at", F.col("transaction_date")), s.details(spark, sf))


RATIO = f"""r AS (
  SELECT h.order_id, header_total, details_total, details_total / nullif(header_total, 0) AS ratio
  FROM (SELECT order_id, {c.msum('total_amount', True)} AS header_total FROM headers WHERE transactions_type = 'sale' GROUP BY 1) h
  JOIN (SELECT order_id, {c.msum('total_amount', True)} AS details_total FROM details GROUP BY 1) d ON h.order_id = d.order_id),
ro AS (SELECT *, coalesce(abs(ratio - 1) > 0.01, FALSE) AS is_off FROM r)"""


@query("header_detail_ratio", c.with_(c.HEADERS, c.DETAILS, RATIO) + "SELECT * FROM ro")
def header_detail_ratio(spark, sf):
    return audit.header_detail_ratio(s.headers(spark, sf), s.details(spark, sf))


@query("header_detail_total", c.with_(c.HEADERS, c.DETAILS, RATIO) + f"""
SELECT count(*) AS n_orders, count(*) FILTER (WHERE is_off) AS n_off, {c.msum('details_total')} / {c.msum('header_total')} AS total_ratio FROM ro""")
def header_detail_total(spark, sf):
    return audit.overall_ratio(audit.header_detail_ratio(s.headers(spark, sf), s.details(spark, sf)))


@query("accuracy_by_date", c.with_(c.HEADERS, cleaning.HEADERS2, c.DOUBLED, c.SLOTS, cleaning.WORK) + f"""
, parts AS (
  SELECT 0 AS part, CAST(transaction_date AS DATE) AS d, total_amount FROM h2 UNION ALL SELECT 1, CAST(transaction_date AS DATE), total_amount FROM doubled
  UNION ALL SELECT 2, CAST(transaction_date AS DATE), total_amount FROM headers UNION ALL SELECT 3, CAST(transaction_date AS DATE), total_amount FROM work WHERE keep)
SELECT *, round_even(details_clean / nullif(headers_clean, 0) * 100 * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE AS acc_details_pct FROM (
  SELECT coalesce(strftime(d, '%Y-%m-%d'), 'TOTAL') AS day, {", ".join(f"{c.msum('total_amount', True, where=f'part = {i}')} AS {n}"
  for i, n in enumerate(["headers_raw", "details_raw", "headers_clean", "details_clean"]))} FROM parts GROUP BY ROLLUP (d)) x""")
def accuracy_by_date(spark, sf):
    doubled = s.details(spark, sf, doubled=True)
    work = cleaning.work(spark, sf)
    clean = dedup_ops.repeat_rows(work.select("transaction_date", "total_amount", "_keep"), "_keep")
    return audit.accuracy_by_date(cleaning._loaded_twice(spark, sf), doubled, s.headers(spark, sf), clean)


@query("accuracy_split", c.with_(c.HEADERS, c.DETAILS) + f"""
SELECT k.*, amount_details, round_even(amount_details / amount_headers * 100 * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE AS accuracy_pct FROM (
  SELECT CASE WHEN order_id IN (SELECT order_id FROM details WHERE type <> 'standard') THEN 'with_details' WHEN fulfillment_status = 'none' THEN 'unfulfilled_without_details'
              ELSE 'other_without_details' END AS kind, count(DISTINCT order_id) AS orders, {c.msum('total_amount')} AS amount_headers FROM headers GROUP BY 1) k
LEFT JOIN (SELECT 'with_details' AS kk, {c.msum('total_amount')} AS amount_details FROM details WHERE type <> 'standard') d ON k.kind = d.kk""")
def accuracy_split(spark, sf):
    return audit.accuracy_split(s.headers(spark, sf), s.details(spark, sf).filter(F.col("type") != "standard"))


# side B lacks the night transactions of outlets above 00010 and has refunds of its own
PRESENCE = """pa AS (SELECT order_id, transaction_id, outlet_code, transaction_date FROM headers WHERE transactions_type = 'sale'),
pb AS (SELECT order_id, transaction_id FROM headers WHERE NOT (outlet_code > '00010' AND hour(transaction_date) < 9)),
mb AS (
  SELECT outlet_code, lpad(CAST(hour(transaction_date) // 4 * 4 AS VARCHAR), 2, '0') || ':00-' || lpad(CAST(hour(transaction_date) // 4 * 4 + 3 AS VARCHAR), 2, '0') || ':59' AS block,
         count(*) AS n_missing FROM pa WHERE transaction_id NOT IN (SELECT transaction_id FROM pb) GROUP BY 1, 2)"""


def _presence(spark, sf):
    h = s.headers(spark, sf)
    return audit.presence(h.filter(F.col("transactions_type") == "sale"), h.filter(~((F.col("outlet_code") > "00010") & (F.hour("transaction_date") < 9))))


@query("completeness_4h", c.with_(c.HEADERS, PRESENCE) + "SELECT * FROM mb")
def completeness_4h(spark, sf):
    return audit.missing_blocks(_presence(spark, sf))


@query("top_missing_blocks", c.with_(c.HEADERS, PRESENCE) + "SELECT * FROM mb ORDER BY n_missing DESC, outlet_code, block LIMIT 30")
def top_missing_blocks(spark, sf):
    return audit.top_missing_blocks(_presence(spark, sf))


@query("presence_counts", c.with_(c.HEADERS, PRESENCE) + """
SELECT count(*) FILTER (WHERE a AND b) AS in_both, count(*) FILTER (WHERE a AND NOT b) AS only_a, count(*) FILTER (WHERE b AND NOT a) AS only_b
FROM (SELECT transaction_id, bool_or(s = 0) AS a, bool_or(s = 1) AS b FROM (SELECT transaction_id, 0 AS s FROM pa UNION ALL SELECT transaction_id, 1 FROM pb) u GROUP BY 1) x""")
def presence_counts(spark, sf):
    return audit.presence_counts(_presence(spark, sf))


@query("key_except", c.with_(c.HEADERS, c.DETAILS) + """
SELECT DISTINCT order_id FROM headers WHERE order_id NOT IN (SELECT order_id FROM details WHERE type = 'comboset')""")
def key_except(spark, sf):
    return audit.key_except(s.headers(spark, sf), s.details(spark, sf).filter(F.col("type") == fv.BUNDLE_TYPE), "order_id")
