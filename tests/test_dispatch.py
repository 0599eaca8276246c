"""The order summary on literal rows: repeated and missing order ids, an app that knows a transaction twice, and what its plan shuffles."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillworks.operators import dispatch as ops
from tillworks.session import bucketed

T0 = dt.datetime(2024, 1, 1, 8)
ORDERS = ("pending_order_id long, order_ref string, transaction_id long, hub_code string, customer_id long, dispatcher_status string, total_item_qty long, "
          "total_price double, payment_type string, delivery_lat double, delivery_lng double, accepted_rider_lat double, accepted_rider_lng double, "
          "accepted_rider_code string, created_at_local timestamp_ntz, accepted_at_local timestamp_ntz, order_ttl_minutes double, seconds_to_accept double")
PINGS = ("pending_order_id long, blast_id long, rider_code string, response string, wa_status string, push_status string, distance_in_meter double, "
         "blast_rider_lat double, blast_rider_long double, created_at timestamp_ntz")
DELIVERIES = ("pending_order_id long, trx_id long, transaction_status string, transaction_date date, paid_at_local timestamp_ntz, "
              "trx_completed_at_local timestamp_ntz, delivery_status string, rider_completion_lat double, rider_completion_lng double, "
              "out_for_delivery_at_local timestamp_ntz, delivered_at_local timestamp_ntz")


def _order(key, to, rider=None, customer=1, transaction=None):
    status = "EXPIRED" if rider is None else "ACCEPTED"
    return (key, f"OD-{key}", transaction, "H1", customer, status, 2, 10.0, "Cash", to, to, rider, rider, None if rider is None else "RA", T0, T0, 5.0, 1.0)


def _summary(spark, orders, store):
    """(summary, the bucketed or plain tables it reads)."""
    frame = spark.createDataFrame
    pings = frame([(1, 11, "RA", "ACCEPTED", "SENT", "SENT", 5.0, 1.0, 1.0, T0), (1, 12, "RB", None, "SENT", "SENT", 9.0, 2.0, 2.0, T0),
                   (2, 21, "RC", "REJECTED", "SENT", "SENT", 7.0, 1.0, 1.0, T0)], PINGS)
    blasts = frame([(11, 1, 1), (12, 1, 2), (21, 2, 1)], "blast_id long, pending_order_id long, blast_round int")
    done = frame([(1, 5, "COMPLETED", T0.date(), T0, T0, "DELIVERED", 3.0, 3.0, T0, T0), (1, 4, "COMPLETED", T0.date(), T0, T0, "DELIVERED", 2.0, 2.0, T0, T0)],
                 DELIVERIES)
    records = frame([("OD-2", "late", T0), ("OD-2", "early", T0 - dt.timedelta(hours=1))], "order_ref string, reason string, created_at timestamp_ntz")
    tables = ops.dispatch_tables(frame(orders, ORDERS), pings, blasts, done, records, store)
    app = frame([(100, T0, "PAID", "Ann", "62"), (100, T0, "REFUNDED", "Ann", "62"), (300, T0, "PAID", "Cy", "63")],
                "transaction_id long, transaction_datetime timestamp_ntz, latest_transaction_status string, customer_name string, customer_phone string")
    pairs = [(1.0, 8.0), (2.0, 8.0), (1.0, 9.0), (2.0, 9.0), (1.0, 3.0), (6.0, 7.0)]
    routes = frame([(a, a, b, b, a * 100 + b, a + b, "TABLE") for a, b in pairs],
                   "lat1 double, lng1 double, lat2 double, lng2 double, distance_m double, duration_s double, source string")
    return ops.order_summary(tables, app, routes, frame([(7,), (None,)], "user_id long"), store), tables


def _stores(spark):
    return {"plain": lambda df, name: df, "bucketed": lambda df, name: bucketed(df, "pending_order_id", 8, name)}


@pytest.mark.parametrize("kind", ["plain", "bucketed"])
def test_repeated_and_missing_order_ids_keep_their_own_lookups(spark, kind):
    orders = [_order(1, 8.0, 1.0, customer=7, transaction=100), _order(1, 9.0, 2.0, transaction=200), _order(2, 8.0, transaction=300),
              _order(None, 7.0, 6.0, customer=7), _order(None, 7.0, 1.0, customer=None, transaction=300), _order(3, 8.0)]
    summary, _ = _summary(spark, orders, _stores(spark)[kind])
    assert summary.columns == ops.SUMMARY_COLUMNS
    got = summary.select("pending_order_id", "delivery_lat", "has_membership", "latest_transaction_status", "actual_route_distance_m", "route_source",
                         "delivered_distance_m", "origin_type", "total_rider_blasted", "blasted_rider_codes", "order_status_detail",
                         "median_blasted_rider_distance_m", "total_blast_rounds")
    key = lambda r: tuple((x is None, x) for x in r)
    # two orders of one id: each ping is there for both delivery points
    one = (4, "RA, RA, RB, RB", None, 158.5, 2)
    expected = [(1, 8.0, True, "PAID", 108.0, "TABLE", 103.0, "ACCEPTED_RIDER", *one), (1, 8.0, True, "REFUNDED", 108.0, "TABLE", 103.0, "ACCEPTED_RIDER", *one),
                (1, 9.0, False, None, 209.0, "TABLE", None, "ACCEPTED_RIDER", *one),
                (2, 8.0, False, "PAID", 108.0, "TABLE", None, "NEAREST_BLASTED_RIDER", 1, "RC", "early", 108.0, 1),
                (3, 8.0, False, None, None, "NO_COORDINATE", None, "NO_RIDER_BLASTED", 0, None, None, None, 0),
                (None, 7.0, True, None, 607.0, "TABLE", None, "ACCEPTED_RIDER", 0, None, None, None, 0),
                (None, 7.0, True, "PAID", None, "NO_ROUTE", None, "ACCEPTED_RIDER", 0, None, None, None, 0)]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(expected, key=key)


def _exchanges(plan):
    """Columns of every row that a plan shuffles."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    own = [plan.output().size()] if plan.nodeName() == "Exchange" else []
    below = plan.children()
    return own + [n for i in range(below.size()) for n in _exchanges(below.apply(i))]


def test_the_summary_shuffles_narrow_rows_only(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        summary, _ = _summary(spark, [_order(1, 8.0, 1.0, transaction=100), _order(2, 8.0, transaction=300)], _stores(spark)["bucketed"])
        widths = _exchanges(summary._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert widths and max(widths) <= 8, widths


def test_median_of_stored_rows_equals_that_of_dealt_rows(spark):
    df = spark.range(4000).select((F.col("id") % 7).alias("pending_order_id"), F.when(F.col("id") % 5 != 0, (F.col("id") * 7919 % 6007).cast("double")).alias("route_distance_m"))
    assert ops.distance_stats(df).exceptAll(ops.distance_stats(df, cut=True)).isEmpty() and ops.distance_stats(df).count() == 7
    stored = ops.distance_stats(bucketed(df, "pending_order_id", 8), cut=True)
    assert _exchanges(stored._jdf.queryExecution().executedPlan()) == []
