"""De-duplication, its reports and the load gates: queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillworks import fixed_values as fv
from tillworks.operators import dedup as ops
from tillworks.operators import orders as orders_ops
from tillworks.plans import ctes as c
from tillworks.plans.registry import query
from tillworks.sources import standin as s

KEY = ", ".join(fv.DETAIL_KEY)
GROUP = ", ".join(fv.BUNDLE_GROUP_KEY)
ORDER = ["total_order_amount", "quantity", "transaction_date"]
_REST = [x for x in ("product_name", "product_generic_name", "price", "discount_amount", "promotion_amount", "subtotal",
                     "tax_percentage", "tax_amount", "total_amount")]
ORDER_SQL = ", ".join(ORDER + _REST)

WORK = f"""stats AS (
  SELECT *, count(*) OVER (PARTITION BY {KEY}) AS rows_per_key,
         row_number() OVER (PARTITION BY {KEY} ORDER BY {ORDER_SQL}) - 1 AS row_seq_in_key,
         type = 'comboset' AS is_combo FROM doubled),
factor0 AS (
  SELECT stats.*, sl.bundling_slot_count,
         CASE WHEN is_combo THEN count(*) OVER (PARTITION BY {GROUP}, is_combo) END AS combo_group_rows
  FROM stats LEFT JOIN (SELECT bundling_id AS bid, bundling_slot_count FROM slots) sl ON stats.bundling_id = sl.bid),
factor AS (
  SELECT *, CASE WHEN combo_group_rows >= bundling_slot_count AND combo_group_rows % bundling_slot_count = 0
                 THEN CAST(combo_group_rows // bundling_slot_count AS INTEGER) END AS by_master FROM factor0),
work0 AS (
  SELECT *, coalesce(by_master, 1) AS dup_factor,
         CASE WHEN by_master IS NOT NULL THEN 'bundling' WHEN bundling_slot_count IS NULL THEN 'not_in_master'
              ELSE 'slot_mismatch' END AS dup_factor_source FROM factor),
work1 AS (
  SELECT *, CASE WHEN is_combo AND rows_per_key % dup_factor = 0 THEN rows_per_key // dup_factor
                 WHEN is_combo THEN rows_per_key ELSE 1 END AS rows_to_keep,
         is_combo AND (rows_per_key % dup_factor <> 0 OR dup_factor_source <> 'bundling') AS needs_manual_check FROM work0),
work AS (SELECT *, row_seq_in_key < rows_to_keep AS keep FROM work1),
slot_check AS (
  SELECT {GROUP}, min(product_generic_name) AS bundling_name, count(*) AS rows_after,
         min(bundling_slot_count) AS bundling_slot_count, min(dup_factor) AS dup_factor, min(dup_factor_source) AS dup_factor_source
  FROM work WHERE is_combo AND keep GROUP BY {GROUP})"""
HEAD = c.with_(c.DOUBLED, c.SLOTS, WORK)
COLS = ", ".join(["order_id", "order_detail_id", "type", "bundling_id", "product_id", "product_name", "product_generic_name",
                  "sku", "price", "quantity", "total_order_amount", "discount_amount", "promotion_amount", "subtotal",
                  "tax_percentage", "tax_amount", "total_amount", "status", "payment_status", "transactions_type",
                  "transaction_date"])


def _bucket():
    return F.floor(F.col("total_order_amount") / 1000)


def _doubled(spark, sf):
    return s.details(spark, sf, doubled=True)


def work(spark, sf):
    return ops.dedup_work(_doubled(spark, sf), s.slot_counts(spark, sf), ORDER, _bucket())


@query("dedup_key_stats", HEAD + f"SELECT {COLS}, CAST(rows_per_key AS BIGINT) AS rows_per_key, row_seq_in_key, is_combo FROM stats")
def dedup_key_stats(spark, sf):
    return ops.dedup_key_stats(_doubled(spark, sf), ORDER, _bucket())


@query("combo_dup_factor", HEAD + f"SELECT {COLS}, combo_group_rows, bundling_slot_count, dup_factor, dup_factor_source FROM work0 WHERE is_combo")
def combo_dup_factor(spark, sf):
    return ops.combo_dup_factor(_doubled(spark, sf), s.slot_counts(spark, sf))


@query("dedup_details", HEAD + f"SELECT {COLS} FROM work WHERE keep")
def dedup_details(spark, sf):
    return ops.dedup_details(_doubled(spark, sf), s.slot_counts(spark, sf), ORDER, _bucket())


@query("dedup_manual_check", HEAD + """
SELECT DISTINCT order_id, order_detail_id, bundling_id, product_generic_name AS bundling_name, product_name, sku, transactions_type,
       CAST(rows_per_key AS BIGINT) AS rows_per_key, bundling_slot_count, dup_factor, dup_factor_source FROM work WHERE needs_manual_check""")
def dedup_manual_check(spark, sf):
    return ops.manual_check(work(spark, sf))


@query("dedup_slot_mismatch", HEAD + "SELECT * FROM slot_check WHERE bundling_slot_count IS NOT NULL AND rows_after <> bundling_slot_count")
def dedup_slot_mismatch(spark, sf):
    return ops.slot_mismatch(work(spark, sf))


@query("bundles_not_in_master", HEAD + """
SELECT bundling_id, bundling_name, count(*) AS n_order_detail, string_agg(DISTINCT dup_factor_source, ', ') AS dup_factor_source
FROM slot_check WHERE bundling_slot_count IS NULL GROUP BY bundling_id, bundling_name ORDER BY 3 DESC, 1, 2""")
def bundles_not_in_master(spark, sf):
    return ops.bundles_not_in_master(work(spark, sf))


@query("dedup_summary", HEAD + """
SELECT * FROM (
  SELECT count(*) AS details_raw, count(*) FILTER (WHERE keep) AS details_clean,
         count(*) FILTER (WHERE NOT is_combo) AS details_noncombo_raw, count(*) FILTER (WHERE NOT is_combo AND keep) AS details_noncombo_clean,
         count(*) FILTER (WHERE is_combo) AS details_combo_raw, count(*) FILTER (WHERE is_combo AND keep) AS details_combo_clean,
         count(DISTINCT order_id) FILTER (WHERE needs_manual_check) AS needs_manual_check_orders,
         count(DISTINCT bundling_id) FILTER (WHERE is_combo) AS bundling_in_period FROM work) a
CROSS JOIN (
  SELECT count(*) AS combo_order_details, count(bundling_slot_count) AS combo_in_master,
         count(*) FILTER (WHERE bundling_slot_count IS NULL) AS combo_not_in_master,
         count(*) FILTER (WHERE bundling_slot_count IS NOT NULL AND rows_after <> bundling_slot_count) AS slot_mismatch_count,
         round(count(*) FILTER (WHERE rows_after = bundling_slot_count) * 100.0::DOUBLE / nullif(count(bundling_slot_count), 0), 2) AS combo_slot_match_pct
  FROM slot_check) b""")
def dedup_summary(spark, sf):
    return ops.dedup_summary(work(spark, sf))


# every bundle detail should have 1 + id % 3 components
@query("violations_details", c.with_(c.DOUBLED) + f"""
SELECT order_id, order_detail_id, transactions_type, 'single' AS kind, count(*) AS n_rows, CAST(1 AS BIGINT) AS expected
FROM doubled WHERE type <> 'comboset' GROUP BY {KEY} HAVING count(*) > 1
UNION ALL
SELECT order_id, order_detail_id, transactions_type, 'bundle', count(*), 1 + order_detail_id % 3
FROM doubled WHERE type = 'comboset' GROUP BY order_id, order_detail_id, transactions_type HAVING count(*) <> 1 + order_detail_id % 3""")
def violations_details(spark, sf):
    d = _doubled(spark, sf)
    counts = (d.filter(F.col("type") == fv.BUNDLE_TYPE).select("order_detail_id").distinct()
              .withColumn("n_components", 1 + F.col("order_detail_id") % 3))
    return ops.violations_details(d, counts)


@query("duplicate_keys", c.with_(c.DOUBLED) + f"""
SELECT count(*) FILTER (WHERE type <> 'comboset') AS duplicated_single, count(*) FILTER (WHERE type = 'comboset') AS duplicated_bundle
FROM (SELECT {KEY} FROM doubled GROUP BY {KEY} HAVING count(*) > 1) k""")
def duplicate_keys(spark, sf):
    return ops.duplicate_keys(_doubled(spark, sf))


# type names from the line status, so that some are unknown
@query("unknown_types", c.with_(c.DETAILS) + """
SELECT coalesce(t, '<NULL>') AS type, count(*) AS n_rows
FROM (SELECT CASE WHEN status = 'O' AND type = 'variant' THEN 'package' WHEN status = 'O' AND type = 'standard' THEN NULL ELSE type END AS t FROM details) x
WHERE t IS NULL OR t NOT IN ('standard', 'variant', 'comboset') GROUP BY 1""")
def unknown_types(spark, sf):
    odd = F.col("status") == "O"
    return ops.unknown_types(s.details(spark, sf).withColumn(
        "type", F.when(odd & (F.col("type") == "variant"), "package")
        .when(odd & (F.col("type") == "standard"), F.lit(None)).otherwise(F.col("type"))))


HEADERS2 = """h2 AS (SELECT *, 1 AS load_no FROM headers UNION ALL SELECT *, 2 FROM headers WHERE order_id % 3 = 0)"""


def _loaded_twice(spark, sf):
    times = F.when(F.col("order_id") % 3 == 0, 2).otherwise(1)
    return s.headers(spark, sf).withColumn("load_no", F.explode(F.sequence(F.lit(1), times)))


@query("duplicate_transactions", c.with_(c.HEADERS, HEADERS2) +
       "SELECT order_id, transaction_id, count(*) AS n_rows FROM h2 GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_transactions(spark, sf):
    return ops.duplicate_transactions(_loaded_twice(spark, sf))


@query("key_cardinality", c.with_(c.HEADERS, HEADERS2) +
       "SELECT count(*) AS n_rows, count(DISTINCT order_id) AS n_orders, count(DISTINCT transaction_id) AS n_keys FROM h2")
def key_cardinality(spark, sf):
    return ops.key_cardinality(_loaded_twice(spark, sf))


@query("dedup_headers", c.with_(c.HEADERS, HEADERS2) +
       "SELECT order_id, transaction_id, total_amount, min(load_no) AS load_no FROM h2 GROUP BY 1, 2, 3")
def dedup_headers(spark, sf):
    h = _loaded_twice(spark, sf).select("order_id", "transaction_id", "total_amount", "load_no")
    return orders_ops.dedup_headers(h, ["load_no"])


@query("latest_version", c.with_(c.HEADERS, HEADERS2) +
       "SELECT order_id, max(transaction_id * 10 + load_no) AS pulled, max(load_no) AS load_no FROM h2 GROUP BY order_id")
def latest_version(spark, sf):
    h = _loaded_twice(spark, sf).select("order_id", "load_no", (F.col("transaction_id") * 10 + F.col("load_no")).alias("pulled"))
    return orders_ops.latest_version(h, "pulled")
