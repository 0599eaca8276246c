"""On-demand dispatch: queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillworks.functions.scalars import haversine
from tillworks.operators import dispatch as ops
from tillworks.plans import ctes as c
from tillworks.plans.registry import query
from tillworks.session import bucketed, cut_lineage
from tillworks.sources import standin as s

START, END, AS_OF = "1995-01-01", "2001-12-31", "2001-06-01"
LAT = lambda k: f"(-6.0::DOUBLE + ({k} % 1000) / 10000.0::DOUBLE)"
LNG = lambda k: f"(106.0::DOUBLE + ({k} % 700) / 10000.0::DOUBLE)"


def hav(a, b, x, y):
    return (f"(round_even({2 * 6371000.0}::DOUBLE * asin(sqrt(power(sin(radians({x} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({x})) "
            f"* power(sin(radians({y} - {b}) / 2), 2))) * 100.0::DOUBLE, 0) / 100.0::DOUBLE)")


PENDING = f"""{c.BASE},
po AS (
  SELECT order_id AS pending_order_id, 'OD-' || order_id AS order_ref, order_id * 10 + 1 AS transaction_id, outlet_code AS hub_code, customer_id,
         CASE WHEN taken THEN 'ACCEPTED' WHEN fulfillment_status = 'fulfilled' THEN 'EXPIRED' ELSE 'CANCELLED' END AS dispatcher_status,
         1 + order_id % 5 AS total_item_qty, total_amount AS total_price, payment_type,
         CASE WHEN order_id % 97 <> 0 THEN {LAT('order_id')} END AS delivery_lat, CASE WHEN order_id % 97 <> 0 THEN {LNG('order_id')} END AS delivery_lng,
         CASE WHEN taken AND order_id % 13 <> 0 THEN {LAT('customer_id')} END AS accepted_rider_lat,
         CASE WHEN taken AND order_id % 13 <> 0 THEN {LNG('customer_id')} END AS accepted_rider_lng, CASE WHEN taken THEN 'R' || customer_id END AS accepted_rider_code,
         transaction_date AS created_at_local, CASE WHEN taken THEN transaction_date + INTERVAL 1 SECOND * (order_id % 300) END AS accepted_at_local,
         round((300 + order_id % 61) / 60.0::DOUBLE, 2) AS order_ttl_minutes, CASE WHEN taken THEN CAST(order_id % 300 AS DOUBLE) END AS seconds_to_accept
  FROM (SELECT *, fulfillment_status = 'fulfilled' AND order_id % 3 <> 0 AS taken FROM base) b)"""
PINGS = f"""pings AS (
  SELECT l_orderkey AS pending_order_id, l_orderkey * 10 + l_linenumber AS blast_id, l_linenumber AS blast_round, 'R' || l_suppkey AS rider_code,
         CASE WHEN l_returnflag = 'A' THEN 'ACCEPTED' WHEN l_returnflag = 'R' THEN 'REJECTED' WHEN l_linestatus = 'F' THEN 'TIMEOUT' END AS response,
         CASE WHEN l_quantity > 25 THEN 'SENT' ELSE 'SKIPPED' END AS wa_status, CASE WHEN l_discount > 0.05 THEN 'SENT' ELSE 'FAILED' END AS push_status,
         CASE WHEN l_suppkey % 10 <> 3 THEN l_extendedprice END AS distance_in_meter, CASE WHEN l_partkey % 9 <> 0 THEN {LAT('l_partkey')} END AS blast_rider_lat,
         CASE WHEN l_partkey % 9 <> 0 THEN {LNG('l_partkey')} END AS blast_rider_long, l_shipdate AS created_at, l_returnflag FROM lineitem)"""
METRICS = """pm AS (
  SELECT pending_order_id, count(*) AS total_riders_blasted, count(*) FILTER (WHERE response = 'ACCEPTED') AS riders_accepted,
         count(*) FILTER (WHERE response = 'REJECTED') AS riders_rejected, count(*) FILTER (WHERE response = 'TIMEOUT') AS riders_timeout,
         count(*) FILTER (WHERE response IS NULL) AS riders_no_response, count(*) FILTER (WHERE wa_status = 'SENT') AS riders_wa_sent,
         count(*) FILTER (WHERE push_status = 'SENT') AS riders_push_sent FROM pings GROUP BY 1),
rm AS (
  SELECT pending_order_id, count(DISTINCT blast_round) AS total_blast_rounds, max(blast_round) AS last_blast_round, min(1500 + 1500 * blast_round) AS first_blast_radius_m,
         max(1500 + 1500 * blast_round) AS max_blast_radius_m, count(*) AS total_riders_notified, min(sent_at) + INTERVAL 7 HOUR AS first_blast_at, max(sent_at) + INTERVAL 7 HOUR AS last_blast_at
  FROM (SELECT *, min(created_at) OVER (PARTITION BY blast_id) AS sent_at FROM pings) x GROUP BY 1),
ac AS (
  SELECT p.pending_order_id, min(acc) AS accepted_blast_round, count(*) FILTER (WHERE blast_round <= acc) AS riders_blasted_until_accept
  FROM pings p JOIN (SELECT pending_order_id, min(blast_round) AS acc FROM pings WHERE response = 'ACCEPTED' GROUP BY 1) a ON p.pending_order_id = a.pending_order_id GROUP BY 1),
nr AS (
  SELECT pending_order_id, rider_code AS nearest_blasted_rider_code, blast_rider_lat AS nearest_blasted_rider_lat, blast_rider_long AS nearest_blasted_rider_lng
  FROM (SELECT *, row_number() OVER (PARTITION BY pending_order_id ORDER BY distance_in_meter, created_at, rider_code, blast_rider_lat NULLS FIRST, blast_rider_long NULLS FIRST) AS rn
        FROM pings WHERE distance_in_meter IS NOT NULL) x WHERE rn = 1),
er AS (
  SELECT pending_order_id, reason AS order_status_detail FROM (
    SELECT pending_order_id, reason, row_number() OVER (PARTITION BY pending_order_id ORDER BY created_at, reason) AS rn
    FROM (SELECT pending_order_id, created_at, CASE l_returnflag WHEN 'A' THEN 'rider accepted' WHEN 'R' THEN 'no nearby rider' ELSE 'no rider with stock' END AS reason FROM pings) y) x WHERE rn = 1),
codes AS (SELECT pending_order_id, string_agg(rider_code, ', ' ORDER BY distance_in_meter NULLS LAST, created_at, rider_code) AS blasted_rider_codes FROM pings GROUP BY 1)"""
DELIV = f"""dtrx AS (
  SELECT CASE WHEN order_id % 101 <> 0 THEN order_id END AS pending_order_id, order_id * 10 + n AS trx_id, CASE WHEN order_id % 11 = 4 THEN 'REGULAR' ELSE 'ON_DEMAND' END AS transaction_type,
         'COMPLETED' AS transaction_status, CAST(transaction_date AS DATE) AS transaction_date, transaction_date - INTERVAL 7 HOUR - INTERVAL 1 SECOND * (order_id % 90) AS paid_at,
         transaction_date - INTERVAL 7 HOUR - INTERVAL 1 SECOND * (order_id % 90) + INTERVAL 1 SECOND * (600 + order_id % 1000 + n) AS completed_at
  FROM base b, LATERAL (SELECT unnest(range(1, CASE WHEN b.order_id % 8 = 0 THEN 3 ELSE 2 END)) AS n) u),
dd AS (
  SELECT pending_order_id, t.trx_id, transaction_status, transaction_date, paid_at + INTERVAL 7 HOUR AS paid_at_local, completed_at + INTERVAL 7 HOUR AS trx_completed_at_local,
         CASE WHEN trx_id % 7 <> 0 THEN CASE WHEN trx_id % 5 = 0 THEN 'FAILED' ELSE 'DELIVERED' END END AS delivery_status,
         CASE WHEN trx_id % 7 <> 0 AND trx_id % 6 <> 0 THEN {LAT('trx_id')} END AS rider_completion_lat, CASE WHEN trx_id % 7 <> 0 AND trx_id % 6 <> 0 THEN {LNG('trx_id')} END AS rider_completion_lng,
         CASE WHEN trx_id % 7 <> 0 THEN paid_at + INTERVAL 7 HOUR + INTERVAL 1 SECOND * (200 + trx_id % 77) END AS out_for_delivery_at_local,
         CASE WHEN trx_id % 7 <> 0 THEN completed_at + INTERVAL 7 HOUR END AS delivered_at_local
  FROM dtrx t WHERE transaction_type = 'ON_DEMAND' AND pending_order_id IS NOT NULL)"""


def route(prefix, a, b, x, y):
    """SQL for the route table's answer between two points: distance, duration and source."""
    hit = f"CAST(round_even(({a} + {x}) * 10000, 0) AS BIGINT) % 11 <> 0"
    none = f"({a} IS NULL OR {b} IS NULL OR {x} IS NULL OR {y} IS NULL)"
    return {
        "distance": f"CASE WHEN NOT {none} AND {hit} THEN round_even({hav(a, b, x, y)} * 1.3::DOUBLE * 100.0::DOUBLE, 0) / 100.0::DOUBLE END",
        "duration": f"CASE WHEN NOT {none} AND {hit} THEN round_even({hav(a, b, x, y)} / 5 * 10.0::DOUBLE, 0) / 10.0::DOUBLE END",
        "source": f"CASE WHEN {none} THEN 'NO_COORDINATE' WHEN {hit} THEN 'TABLE' ELSE 'NO_ROUTE' END",
    }


_PING_ROUTE = route("", "blast_rider_lat", "blast_rider_long", "delivery_lat", "delivery_lng")
ROUTED = f"""routed AS (
  SELECT p.pending_order_id, rider_code, {_PING_ROUTE['distance']} AS route_distance_m, {_PING_ROUTE['duration']} AS route_duration_seconds, {_PING_ROUTE['source']} AS route_source
  FROM pings p JOIN po ON p.pending_order_id = po.pending_order_id)"""
STATS = f"""dstats AS (
  SELECT pending_order_id, {", ".join(f"round_even({e} * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS {n}_blasted_rider_distance_m" for n, e in
         (("nearest", "min(d)"), ("avg", "(CAST(sum(CAST(d AS DECIMAL(20,6))) AS DOUBLE) / nullif(count(d), 0))"), ("median", "median(d)"), ("max", "max(d)")))}
  FROM (SELECT pending_order_id, route_distance_m AS d FROM routed) x GROUP BY 1)"""


def pending(spark, sf):
    return ops.pending_orders(s.dispatch_orders(spark, sf), START, END)


def _points(df, *cols):
    return df.select(*[F.col(x).alias(n) for x, n in zip(cols, ("lat1", "lng1", "lat2", "lng2"))])


def _positions(spark, sf):
    to = s.dispatch_orders(spark, sf).select("pending_order_id", "delivery_lat", "delivery_lng")
    return s.dispatch_pings(spark, sf).select("pending_order_id", "rider_code", "blast_rider_lat", "blast_rider_long").join(to, "pending_order_id")


PING_POINTS = ("blast_rider_lat", "blast_rider_long", "delivery_lat", "delivery_lng")


def ping_routes(spark, sf):
    return cut_lineage(s.routes_between(_points(_positions(spark, sf), *PING_POINTS)))


@query("pending_orders", c.with_(PENDING) + "SELECT * FROM po")
def pending_orders(spark, sf):
    return pending(spark, sf)


@query("blast_rider_metrics", c.with_(PINGS, METRICS) + "SELECT * FROM pm")
def blast_rider_metrics(spark, sf):
    return ops.ping_metrics(s.dispatch_pings(spark, sf))


@query("blast_round_metrics", c.with_(PINGS, METRICS) + "SELECT * FROM rm")
def blast_round_metrics(spark, sf):
    return ops.round_metrics(s.dispatch_blasts(spark, sf))


@query("accept_context", c.with_(PINGS, METRICS) + "SELECT * FROM ac")
def accept_context(spark, sf):
    return ops.accept_context(s.dispatch_pings(spark, sf), s.dispatch_blasts(spark, sf))


@query("nearest_per_group", c.with_(PINGS, METRICS) + "SELECT * FROM nr")
def nearest_per_group(spark, sf):
    return ops.nearest_rider(s.dispatch_pings(spark, sf))


@query("earliest_per_group", c.with_(PINGS, METRICS) + "SELECT * FROM er")
def earliest_per_group(spark, sf):
    return ops.earliest_reason(pending(spark, sf), s.dispatch_records(spark, sf))


@query("ordered_code_list", c.with_(PINGS, METRICS) + "SELECT * FROM codes")
def ordered_code_list(spark, sf):
    return ops.rider_code_list(s.dispatch_pings(spark, sf))


@query("delivery_detail", c.with_(c.BASE, DELIV) + "SELECT * FROM dd")
def delivery_detail(spark, sf):
    return ops.delivery_detail(s.dispatch_transactions(spark, sf), s.dispatch_deliveries(spark, sf), START, END)


_MEMBER = f"customer_id IN (SELECT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '{AS_OF}')"


@query("membership_flag", c.with_(PENDING) + f"SELECT pending_order_id, customer_id, {_MEMBER} AS has_membership FROM po")
def membership_flag(spark, sf):
    return ops.membership_flag(pending(spark, sf).select("pending_order_id", "customer_id"), ops.members_on(s.vouchers(spark, sf), AS_OF))


@query("haversine", c.with_(PENDING) + f"""
SELECT pending_order_id, {hav('accepted_rider_lat', 'accepted_rider_lng', 'delivery_lat', 'delivery_lng')} AS distance_m FROM po""")
def haversine_query(spark, sf):
    return pending(spark, sf).select("pending_order_id", haversine("accepted_rider_lat", "accepted_rider_lng", "delivery_lat", "delivery_lng").alias("distance_m"))


@query("route_lookup", c.with_(PENDING, PINGS, ROUTED) + "SELECT * FROM routed")
def route_lookup(spark, sf):
    return ops.route_lookup(_positions(spark, sf), ping_routes(spark, sf), list(PING_POINTS)).drop(*PING_POINTS)


@query("distance_stats", c.with_(PENDING, PINGS, ROUTED, STATS) + "SELECT * FROM dstats")
def distance_stats(spark, sf):
    return ops.distance_stats(ops.route_lookup(_positions(spark, sf), ping_routes(spark, sf), list(PING_POINTS)))


ORIGIN = """origin AS (
  SELECT *, CASE WHEN ok THEN accepted_rider_lat WHEN near THEN nearest_blasted_rider_lat END AS origin_lat,
         CASE WHEN ok THEN accepted_rider_lng WHEN near THEN nearest_blasted_rider_lng END AS origin_lng,
         CASE WHEN ok THEN accepted_rider_code WHEN near THEN nearest_blasted_rider_code END AS origin_rider_code,
         CASE WHEN ok THEN 'ACCEPTED_RIDER' WHEN near THEN 'NEAREST_BLASTED_RIDER' WHEN total_riders_blasted = 0 THEN 'NO_RIDER_BLASTED' ELSE 'NO_RIDER_COORDINATE' END AS origin_type
  FROM (SELECT po.*, nr.* EXCLUDE (pending_order_id), coalesce(pm.total_riders_blasted, 0) AS total_riders_blasted,
               dispatcher_status = 'ACCEPTED' AND accepted_rider_lat IS NOT NULL AS ok, nearest_blasted_rider_lat IS NOT NULL AS near
        FROM po LEFT JOIN nr ON po.pending_order_id = nr.pending_order_id LEFT JOIN pm ON po.pending_order_id = pm.pending_order_id) x)"""


@query("resolve_origin", c.with_(PENDING, PINGS, METRICS, ORIGIN) + "SELECT pending_order_id, origin_lat, origin_lng, origin_rider_code, origin_type FROM origin")
def resolve_origin(spark, sf):
    pings = s.dispatch_pings(spark, sf)
    df = (pending(spark, sf).join(ops.nearest_rider(pings), "pending_order_id", "left")
          .join(ops.ping_metrics(pings).select("pending_order_id", "total_riders_blasted"), "pending_order_id", "left").na.fill(0, ["total_riders_blasted"]))
    return ops.resolve_origin(df).select("pending_order_id", "origin_lat", "origin_lng", "origin_rider_code", "origin_type")


_TO = route("", "origin_lat", "origin_lng", "delivery_lat", "delivery_lng")
_DONE = route("", "origin_lat", "origin_lng", "rider_completion_lat", "rider_completion_lng")

def _min(a, b):
    return f"round_even((epoch_us({b}) - epoch_us({a})) / 6e7::DOUBLE * 100.0::DOUBLE, 0) / 100.0::DOUBLE"


SUMMARY = f"""prouted AS (
  SELECT p.pending_order_id, {_PING_ROUTE['distance']} AS d FROM pings p JOIN po ON p.pending_order_id = po.pending_order_id
  WHERE blast_rider_lat IS NOT NULL AND blast_rider_long IS NOT NULL),
ds AS (
  SELECT pending_order_id, {", ".join(f"round_even({e} * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS {n}_blasted_rider_distance_m" for n, e in
         (("nearest", "min(d)"), ("avg", "(CAST(sum(CAST(d AS DECIMAL(20,6))) AS DOUBLE) / nullif(count(d), 0))"), ("median", "median(d)"), ("max", "max(d)")))}
  FROM prouted GROUP BY 1),
lastd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pending_order_id ORDER BY trx_id DESC) AS rn FROM dd) x WHERE rn = 1),
summary AS (
  SELECT o.transaction_id, CASE WHEN o.pending_order_id % 17 <> 0 THEN created_at_local END AS transaction_datetime, CAST(created_at_local AS DATE) AS order_date,
         CAST(hour(created_at_local) AS INTEGER) AS order_hour, o.pending_order_id,
         CASE WHEN o.pending_order_id % 17 <> 0 THEN CASE WHEN o.pending_order_id % 4 = 0 THEN 'REFUNDED' ELSE 'PAID' END END AS latest_transaction_status,
         dispatcher_status AS order_status, order_status_detail, hub_code, customer_id,
         CASE WHEN o.pending_order_id % 17 <> 0 THEN 'Customer ' || customer_id END AS customer_name, CASE WHEN o.pending_order_id % 17 <> 0 THEN '62' || customer_id END AS customer_phone,
         {_MEMBER} AS has_membership, total_item_qty AS order_qty, total_price, payment_type,
         {_min('paid_at_local', 'trx_completed_at_local')} AS minutes_paid_to_completed, seconds_to_accept, {_min('accepted_at_local', 'out_for_delivery_at_local')} AS minutes_accept_to_otw,
         {_min('out_for_delivery_at_local', 'delivered_at_local')} AS minutes_otw_to_delivered, {_min('accepted_at_local', 'delivered_at_local')} AS minutes_accept_to_delivered,
         origin_type, origin_rider_code, origin_lat, origin_lng, delivery_lat, delivery_lng,
         {hav('origin_lat', 'origin_lng', 'delivery_lat', 'delivery_lng')} AS straight_line_distance_m, {_TO['distance']} AS actual_route_distance_m,
         {_TO['duration']} AS route_duration_seconds, {_DONE['distance']} AS delivered_distance_m, nearest_blasted_rider_distance_m, avg_blasted_rider_distance_m,
         median_blasted_rider_distance_m, max_blasted_rider_distance_m, {_TO['source']} AS route_source, total_riders_blasted AS total_rider_blasted,
         coalesce(riders_blasted_until_accept, 0) AS total_rider_blasted_until_accept, coalesce(total_blast_rounds, 0) AS total_blast_rounds,
         coalesce(accepted_blast_round, 0) AS accepted_blast_round, blasted_rider_codes
  FROM origin o LEFT JOIN rm ON o.pending_order_id = rm.pending_order_id LEFT JOIN ac ON o.pending_order_id = ac.pending_order_id
  LEFT JOIN lastd ON o.pending_order_id = lastd.pending_order_id LEFT JOIN codes ON o.pending_order_id = codes.pending_order_id
  LEFT JOIN ds ON o.pending_order_id = ds.pending_order_id LEFT JOIN er ON o.pending_order_id = er.pending_order_id)"""
SUMMARY_SQL = c.with_(PENDING, PINGS, METRICS, DELIV, ORIGIN, SUMMARY)


def _by_order(df, name):
    """Store a frame bucketed by order id, in as many buckets as the session's shuffles have parts: what is shuffled by order meets them as it is."""
    return bucketed(df, "pending_order_id", int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), name)


def stored_tables(spark, sf):
    """The summary's tables; those that are read several times are stored, bucketed by order id."""
    deliveries = ops.delivery_detail(s.dispatch_transactions(spark, sf), s.dispatch_deliveries(spark, sf), START, END)
    return ops.dispatch_tables(pending(spark, sf), s.dispatch_pings(spark, sf), s.dispatch_blasts(spark, sf), deliveries, s.dispatch_records(spark, sf), _by_order)


def summary_routes(tables):
    """Route table for all point pairs the summary may ask for; it is read once, so it is not stored."""
    ends = ops.order_ends(tables)
    points = _points(tables.pings, *PING_POINTS).unionByName(_points(ends, *ops.TO)).unionByName(_points(ends, *ops.DONE))
    return s.routes_between(points)


def summary(spark, sf):
    tables = stored_tables(spark, sf)
    return ops.order_summary(tables, s.app_order_detail(spark, sf), summary_routes(tables), ops.members_on(s.vouchers(spark, sf), AS_OF), _by_order)


@query("ondemand_order_summary", SUMMARY_SQL + "SELECT * FROM summary")
def ondemand_order_summary(spark, sf):
    return summary(spark, sf)


@query("detour_ratio", SUMMARY_SQL + """
SELECT pending_order_id, CASE WHEN straight_line_distance_m > 0 THEN round_even(actual_route_distance_m / straight_line_distance_m * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE END AS route_detour_ratio
FROM summary""")
def detour_ratio(spark, sf):
    """Origin and route of each order only, not the whole summary."""
    pings = s.dispatch_pings(spark, sf)
    df = (pending(spark, sf).join(ops.nearest_rider(pings), "pending_order_id", "left")
          .withColumn("total_riders_blasted", F.lit(1)))
    to = ["origin_lat", "origin_lng", "delivery_lat", "delivery_lng"]
    df = cut_lineage(ops.resolve_origin(df).select("pending_order_id", *to))
    df = ops.route_lookup(df, s.routes_between(_points(df, *to)), to)
    df = df.select("pending_order_id", haversine(*to).alias("straight_line_distance_m"), F.col("route_distance_m").alias("actual_route_distance_m"))
    return ops.route_detour(df)


@query("status_counts", c.with_(PENDING) + "SELECT dispatcher_status AS value, count(*) AS n FROM po GROUP BY 1")
def status_counts(spark, sf):
    return ops.status_counts(pending(spark, sf), "dispatcher_status")
