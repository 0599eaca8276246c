"""Riders and app usage: queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillworks import fixed_values as fv
from tillworks.functions.scalars import canonical_id
from tillworks.operators import riders as ops
from tillworks.plans import ctes as c
from tillworks.plans.registry import query
from tillworks.sources import standin as s

AS_OF = "2024-01-30"
R = "'R' || lpad(CAST(user_id AS VARCHAR), 5, '0')"

LOGS = f"""logs AS (
  SELECT event_id AS id, {R} AS rider_code, ts AS timestamp,
         CASE WHEN event_type IN ('view', 'click') THEN TRUE WHEN event_type IN ('error', 'purchase') THEN FALSE END AS is_stationed FROM events)"""
SHIFTS = f"""shifts AS (
  SELECT id, rider_code, date, a - INTERVAL 7 HOUR AS checkin, CASE WHEN user_id % 11 = 0 THEN b - INTERVAL 4 HOUR ELSE b - INTERVAL 7 HOUR END AS checkout
  FROM (SELECT user_id, {R} AS rider_code, CAST(ts AS DATE) AS date, min(ts) AS a, max(ts) AS b, min(event_id) AS id
        FROM events WHERE user_id % 7 <> 0 GROUP BY 1, 2, 3) x)"""
SLOTS = """slots AS (
  SELECT rider_code, date, checkin, checkout, CAST(hour(h) AS INTEGER) AS hour_slot
  FROM (SELECT rider_code, date, checkin + INTERVAL 7 HOUR AS checkin, checkout + INTERVAL 7 HOUR AS checkout FROM shifts) l,
       LATERAL (SELECT unnest(generate_series(date_trunc('hour', l.checkin), date_trunc('hour', l.checkout), INTERVAL 1 HOUR)) AS h) u)"""
TRX = f"""trx AS (
  SELECT event_id AS id, {R} AS rider_code, 'Rider ' || user_id AS rider_name, 'HB' || (user_id % 25) AS hub_code, CAST(ts AS DATE) AS transaction_date,
         ts - INTERVAL 7 HOUR + INTERVAL 1 HOUR * (event_id % 3) AS transaction_datetime_utc,
         CASE WHEN event_id % 29 = 0 THEN 'VOID' ELSE 'COMPLETED' END AS transaction_status,
         CASE event_id % 3 WHEN 0 THEN 'CASH' WHEN 1 THEN 'QRIS' ELSE 'APP' END AS payment_type,
         CASE WHEN user_id % 2 = 0 THEN {c.q(fv.OWNED_MODEL)} ELSE {c.q(fv.FRANCHISE_MODEL)} END AS ownership_status,
         1 + event_id % 2 AS total_item_qty, value AS total_price_after_discount FROM events WHERE event_type = 'purchase'),
prod AS (SELECT id AS transaction_id, unnest(range(1, total_item_qty + 1)) AS line, 1 AS qty, total_price_after_discount / total_item_qty AS price FROM trx),
hourly AS (
  SELECT rider_code, transaction_date AS date, CAST(weekofyear(transaction_datetime_utc) AS INTEGER) AS week,
         CAST(hour(transaction_datetime_utc + INTERVAL 7 HOUR) AS INTEGER) AS hour, payment_type,
         count(DISTINCT id) AS total_orders, CAST(sum(qty) AS BIGINT) AS total_qty, {c.msum('price')} AS total_sales
  FROM trx JOIN (SELECT transaction_id, sum(qty) AS qty, {c.msum('price')} AS price FROM prod GROUP BY 1) AS lines ON trx.id = lines.transaction_id
  WHERE transaction_status = 'COMPLETED' AND rider_code <> 'R00065' GROUP BY ALL)"""
HUBS = f"""hubs AS (
  SELECT DISTINCT {R} AS rider_id, CASE WHEN user_id % 13 <> 1 THEN lpad(CAST(user_id % 25 AS VARCHAR), 5, '0') END AS jilid,
         'HB' || (user_id % 25) AS hub_id, ' Hub ' || (user_id % 25) AS hub_name,
         TIMESTAMP '2024-01-30 05:00:00' - INTERVAL 1 DAY * (user_id % 3) AS load_data_at FROM events WHERE user_id % 13 <> 0),
otypes AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS jilid, CASE WHEN n_nationkey % 6 = 0 THEN ' ' ELSE 'Region ' || (n_nationkey % 5) END AS region,
         'P' || (n_nationkey % 7) AS provinsi, CASE WHEN n_nationkey % 4 = 0 THEN 'None' ELSE 'K' || (n_nationkey % 11) END AS kota,
         CASE WHEN n_nationkey % 5 <> 0 THEN 'HUB' ELSE 'SHOP' END AS rider_type, n_name AS outlet_name,
         CASE WHEN n_nationkey % 3 = 0 THEN {c.q(fv.FRANCHISE_MODEL)} ELSE {c.q(fv.OWNED_MODEL)} END AS ownership_status FROM nation),
mapping AS (SELECT DISTINCT rider_id, hubs.jilid, hub_name, region, provinsi, kota, rider_type FROM hubs JOIN otypes ON hubs.jilid = otypes.jilid)"""


def mapping(spark, sf):
    return ops.rider_outlets(s.riders_hubs(spark, sf), s.rider_outlet_types(spark, sf))


def hourly(spark, sf):
    return ops.rider_hourly_sales(s.rider_transactions(spark, sf), s.rider_products(spark, sf), ["R00065"])


def slots(spark, sf):
    return ops.shift_hour_slots(s.shifts(spark, sf))


@query("shift_hour_slots", c.with_(SHIFTS, SLOTS) + "SELECT * FROM slots")
def shift_hour_slots(spark, sf):
    return slots(spark, sf)


@query("rider_hourly_sales", c.with_(TRX) + "SELECT * FROM hourly")
def rider_hourly_sales(spark, sf):
    return hourly(spark, sf)


@query("semi_join_riders", c.with_(TRX, HUBS) + "SELECT * FROM hourly WHERE rider_code IN (SELECT rider_id FROM mapping WHERE rider_type = 'HUB')")
def semi_join_riders(spark, sf):
    return ops.semi_join_riders(hourly(spark, sf), mapping(spark, sf))


_SCRUB = lambda x: f"CASE WHEN trim({x}) IN ('', 'None', 'nan', 'null', 'NULL') THEN NULL ELSE trim({x}) END"


@query("tito_hourly", c.with_(TRX, HUBS, SHIFTS, SLOTS) + f"""
, span AS (SELECT rider_code, date, min(hour_slot) AS lo, max(hour_slot) AS hi FROM slots GROUP BY 1, 2),
fixed AS (
  SELECT rider_code, date, week, hour, payment_type, CAST(sum(total_orders) AS BIGINT) AS total_orders, CAST(sum(total_qty) AS BIGINT) AS total_qty,
         {c.msum('total_sales', True)} AS total_sales
  FROM (SELECT h.rider_code, h.date, week, CASE WHEN lo IS NOT NULL AND h.hour < lo THEN lo WHEN hi IS NOT NULL AND h.hour > hi THEN hi ELSE h.hour END AS hour,
               payment_type, total_orders, total_qty, total_sales
        FROM hourly h LEFT JOIN span ON h.rider_code = span.rider_code AND h.date = span.date
        WHERE h.rider_code IN (SELECT rider_id FROM mapping WHERE rider_type = 'HUB')) x GROUP BY 1, 2, 3, 4, 5),
days AS (SELECT rider_code, date, min(hour) AS a, max(hour) AS b FROM fixed GROUP BY 1, 2),
made AS (SELECT d.rider_code, d.date, CAST(NULL AS TIMESTAMP) AS checkin, CAST(NULL AS TIMESTAMP) AS checkout, CAST(unnest(range(a, b + 1)) AS INTEGER) AS hour_slot
         FROM days d WHERE NOT EXISTS (SELECT 1 FROM span WHERE span.rider_code = d.rider_code AND span.date = d.date)),
base AS (SELECT DISTINCT * FROM (SELECT slots.* FROM slots SEMI JOIN days ON slots.rider_code = days.rider_code AND slots.date = days.date UNION ALL SELECT * FROM made) x)
SELECT rider_id, jilid, {_SCRUB('hub_name')} AS hub_name, {_SCRUB('region')} AS region, provinsi, {_SCRUB('kota')} AS kota, rider_type, b.date, checkin, checkout,
       hour_slot, coalesce(week, CAST(weekofyear(b.date) AS INTEGER)) AS week, f.hour, payment_type, total_orders, total_qty, total_sales
FROM base b LEFT JOIN fixed f ON b.rider_code = f.rider_code AND b.date = f.date AND b.hour_slot = f.hour
LEFT JOIN mapping m ON b.rider_code = m.rider_id""")
def tito_hourly(spark, sf):
    return ops.hourly_performance(hourly(spark, sf), slots(spark, sf), mapping(spark, sf))


SESSIONS = """marked AS (
  SELECT *, coalesce(is_stationed, FALSE) AND NOT coalesce(lag(is_stationed) OVER w, FALSE) AS is_session_start FROM logs
  WINDOW w AS (PARTITION BY rider_code ORDER BY timestamp, id)),
seqd AS (SELECT *, CAST(sum(CAST(is_session_start AS INTEGER)) OVER (PARTITION BY rider_code ORDER BY timestamp, id) AS BIGINT) AS session_seq FROM marked),
flagged AS (SELECT *, CASE WHEN session_seq > 0 THEN rider_code || '_S' || lpad(CAST(session_seq AS VARCHAR), 4, '0') END AS session_id FROM seqd),
sessions AS (
  SELECT *, coalesce(session_last_false, session_last_event) AS session_end,
         round((epoch_us(coalesce(session_last_false, session_last_event)) - epoch_us(session_start)) / 6e7, 2) AS session_duration_minutes
  FROM (SELECT rider_code, session_seq, session_id, min(timestamp) FILTER (WHERE is_stationed) AS session_start,
               max(timestamp) FILTER (WHERE NOT is_stationed) AS session_last_false, max(timestamp) AS session_last_event, count(*) AS total_logs,
               count(*) FILTER (WHERE is_stationed) AS total_true_logs, count(*) FILTER (WHERE NOT is_stationed) AS total_false_logs
        FROM flagged WHERE session_id IS NOT NULL GROUP BY 1, 2, 3) x)"""


@query("flag_sessions", c.with_(LOGS, SESSIONS) + "SELECT * FROM flagged")
def flag_sessions(spark, sf):
    return ops.flag_sessions(s.stationed_logs(spark, sf))


@query("session_summary", c.with_(LOGS, SESSIONS) + "SELECT * FROM sessions")
def session_summary(spark, sf):
    return ops.session_summary(ops.flag_sessions(s.stationed_logs(spark, sf)))


WORKING = """working AS (
  SELECT date AS operating_date, rider_code, checkin + INTERVAL 7 HOUR AS checkin, checkout + INTERVAL 7 HOUR AS checkout, rev + INTERVAL 7 HOUR AS reversed_at,
         (epoch_us(rev) - epoch_us(checkin)) / 6e7 AS total_working_minutes, (epoch_us(rev) - epoch_us(checkin)) / 6e7 / 60 AS total_working_hour,
         (epoch_us(checkout) - epoch_us(rev)) / 6e7 AS total_reverse_process_admin
  FROM (SELECT *, checkout - INTERVAL 10 MINUTE AS rev FROM shifts WHERE id % 3 <> 0) x)"""


@query("rider_working_time", c.with_(SHIFTS, WORKING) + "SELECT * FROM working")
def rider_working_time(spark, sf):
    return ops.rider_working_time(s.shifts(spark, sf), s.reverse_requests(spark, sf))


CLICKS = """clicks AS (
  SELECT event_id, user_id, ts AS timestamp, CASE WHEN user_id % 10 <> 0 THEN 'R' || lpad(CAST((user_id * 3) % 150 AS VARCHAR), 5, '0') END AS rider_id,
         CASE event_type WHEN 'purchase' THEN 'buy' ELSE 'contactRider' END AS event_name,
         CASE event_type WHEN 'click' THEN 'direction' WHEN 'view' THEN 'whatsapp' ELSE 'other' END AS event_label
  FROM events WHERE event_type IN ('click', 'view', 'purchase'))"""
HUBDIM = """hubdim AS (
  SELECT DISTINCT hub_id AS hub_code, hubs.jilid, hub_name, rider_type AS business_unit, region, kota, provinsi
  FROM hubs JOIN otypes ON hubs.jilid = otypes.jilid)"""


def _hub_mapping(spark, sf):
    m = s.riders_hubs(spark, sf).join(s.rider_outlet_types(spark, sf), "jilid")
    return m.select(F.col("hub_id").alias("hub_code"), "jilid", "hub_name", F.col("rider_type").alias("business_unit"), "region", "kota",
                    "provinsi").distinct()


@query("hub_mapping", c.with_(HUBS, HUBDIM) + "SELECT * FROM hubdim")
def hub_mapping(spark, sf):
    return _hub_mapping(spark, sf)


@query("rider_day_summary", c.with_(TRX, HUBS, HUBDIM, SHIFTS, WORKING, LOGS, SESSIONS, CLICKS) + f"""
SELECT operating_date, rider_code, jilid, hub_name, business_unit, region, kota, provinsi, total_working_minutes, total_standing_time, total_standing_session,
       coalesce(round(total_standing_time / nullif(total_working_minutes, 0) * 100, 2), 0) AS standing_mins_pct, total_sales, total_order, total_qty, total_click_by_user
FROM (
  SELECT t.operating_date, t.rider_code, coalesce(jilid, '0') AS jilid, coalesce(hub_name, '0') AS hub_name, coalesce(business_unit, '0') AS business_unit,
         coalesce(region, '0') AS region, coalesce(kota, '0') AS kota, coalesce(provinsi, '0') AS provinsi, coalesce(w.total_working_minutes, 0) AS total_working_minutes,
         coalesce(st.tt, 0) AS total_standing_time, coalesce(st.n, 0) AS total_standing_session, coalesce(total_sales, 0) AS total_sales, total_order,
         coalesce(total_qty, 0) AS total_qty, coalesce(cl.n, 0) AS total_click_by_user
  FROM (SELECT transaction_date AS operating_date, rider_code, rider_name, hub_code, {c.msum('total_price_after_discount')} AS total_sales,
               count(DISTINCT id) AS total_order, CAST(sum(total_item_qty) AS BIGINT) AS total_qty
        FROM trx WHERE transaction_status = 'COMPLETED' GROUP BY 1, 2, 3, 4) t
  LEFT JOIN working w ON t.operating_date = w.operating_date AND t.rider_code = w.rider_code
  LEFT JOIN (SELECT CAST(session_start AS DATE) AS d, rider_code, {c.msum('session_duration_minutes')} AS tt, count(DISTINCT session_id) AS n
             FROM sessions GROUP BY 1, 2) st ON t.operating_date = st.d AND t.rider_code = st.rider_code
  LEFT JOIN hubdim h ON t.hub_code = h.hub_code
  LEFT JOIN (SELECT CAST(timestamp AS DATE) AS d, rider_id, count(*) AS n FROM clicks WHERE rider_id IS NOT NULL GROUP BY 1, 2) cl
    ON t.operating_date = cl.d AND t.rider_code = cl.rider_id) x""")
def rider_day_summary(spark, sf):
    return ops.rider_day_summary(
        s.rider_transactions(spark, sf).filter(F.col("transaction_status") == "COMPLETED"), rider_working_time(spark, sf),
        session_summary(spark, sf), _hub_mapping(spark, sf), s.click_tracker(spark, sf))


MISSING = f"""missing AS (
  SELECT DISTINCT rider_code, rider_name, jilid, hub_name AS outlet_name FROM trx LEFT JOIN hubs ON rider_code = rider_id
  WHERE transaction_status = 'COMPLETED' AND jilid IS NULL AND transaction_date >= DATE '{AS_OF}' - 10 AND ownership_status = {c.q(fv.OWNED_MODEL)})"""


@query("missing_riders", c.with_(TRX, HUBS, MISSING) + "SELECT * FROM missing")
def missing_riders(spark, sf):
    return ops.missing_riders(s.rider_transactions(spark, sf), s.riders_hubs(spark, sf), AS_OF, fv.OWNED_MODEL)


@query("hub_dim", c.with_(HUBS) + """
SELECT DISTINCT 'riders' AS origin, jilid, hub_id, hub_name FROM hubs
UNION ALL SELECT 'outlets', jilid, jilid, outlet_name FROM otypes WHERE ownership_status = 'MITRA' AND rider_type = 'HUB'""")
def hub_dim(spark, sf):
    o = s.rider_outlet_types(spark, sf).withColumnRenamed("jilid", "outlet_code").withColumnRenamed("rider_type", "hub_type")
    return (ops.hub_dim(s.riders_hubs(spark, sf)).withColumn("origin", F.lit("riders"))
            .unionByName(ops.hub_dim_from_outlets(o).withColumn("origin", F.lit("outlets"))))


# rider list: every user twice (two snapshots), hubs of known riders plus the testing hub for id % 17 = 0
@query("rider_mapping", c.with_(TRX, HUBS) + f"""
, hd AS (SELECT DISTINCT jilid, hub_id, hub_name FROM hubs),
riders AS (SELECT DISTINCT user_id, {R} AS rider_code, 'Name ' || user_id AS name, CASE WHEN user_id % 17 = 0 THEN 'HB-TESTING' ELSE 'HB' || (user_id % 25) END AS hub_code,
                  user_id % 4 <> 0 AS is_active, CASE WHEN user_id % 3 = 0 THEN '628123456789' ELSE '62' || user_id END AS phone_number FROM events)
SELECT hub_id, jilid, hub_name, rider_code AS rider_id, rider_code AS cart_id, name AS rider_name, status, 'COMMISSION' AS scheme,
       CASE WHEN phone_number <> '628123456789' THEN phone_number END AS phone_number, 'rider.' || lower(rider_code) || '@example.com' AS cashier_id, 'job' AS updated_by
FROM (
  SELECT CASE WHEN hub_code = 'HB-TESTING' THEN hub_code ELSE hd.hub_id END AS hub_id, CASE WHEN hub_code = 'HB-TESTING' THEN 'JILID-TESTING' ELSE hd.jilid END AS jilid,
         CASE WHEN hub_code = 'HB-TESTING' THEN hub_code ELSE hd.hub_name END AS hub_name, r.*, CASE WHEN is_active THEN 'ACTIVE' ELSE 'INACTIVE' END AS status,
         row_number() OVER (PARTITION BY CASE WHEN hub_code = 'HB-TESTING' THEN hub_code ELSE hd.hub_id END, rider_code ORDER BY hd.jilid NULLS FIRST) AS rn
  FROM riders r LEFT JOIN hd ON r.hub_code = hd.hub_id
  WHERE rider_code IN (SELECT rider_code FROM trx LEFT JOIN hubs ON rider_code = rider_id WHERE transaction_status = 'COMPLETED' AND jilid IS NULL)) x WHERE rn = 1""")
def rider_mapping(spark, sf):
    uid = F.col("user_id")
    riders = s.table(spark, sf, "events").select("user_id").distinct().select(
        s._rider().alias("rider_code"), F.concat(F.lit("Name "), uid.cast("string")).alias("name"),
        F.when(uid % 17 == 0, fv.TEST_HUB).otherwise(F.concat(F.lit("HB"), (uid % 25).cast("string"))).alias("hub_code"),
        (uid % 4 != 0).alias("is_active"),
        F.when(uid % 3 == 0, fv.DUMMY_PHONE).otherwise(F.concat(F.lit("62"), uid.cast("string"))).alias("phone_number"))
    t = s.rider_transactions(spark, sf).filter(F.col("transaction_status") == "COMPLETED")
    m = s.riders_hubs(spark, sf)
    missing = t.join(m, t.rider_code == m.rider_id, "left").filter(F.col("jilid").isNull()).select("rider_code")
    return ops.rider_mapping(riders, missing, ops.hub_dim(m), "job", ["jilid"], "rider.", "@example.com")


@query("riders_by_type", c.with_(HUBS) + f"""
SELECT rider_type, count(*) AS total_riders FROM hubs JOIN otypes ON hubs.jilid = otypes.jilid
WHERE CAST(load_data_at AS DATE) = DATE '{AS_OF}' GROUP BY 1""")
def riders_by_type(spark, sf):
    return ops.riders_by_type(s.riders_hubs(spark, sf), s.rider_outlet_types(spark, sf), AS_OF)


# --- app usage ------------------------------------------------------------------------------------------------------

APP = """app AS (SELECT CAST(ts + INTERVAL 7 HOUR AS DATE) AS date, count(DISTINCT event_id) AS total_session, count(DISTINCT user_id) AS total_users_open_app
        FROM events GROUP BY 1)"""
FUNNEL = f"""{CLICKS},
funnel AS (
  SELECT o.date, total_rider_found, total_rider_not_found, total_rider_found + total_rider_not_found AS total_users_open, total_click_direction, total_click_whatsapp,
         total_click_direction + total_click_whatsapp AS total_click,
         CAST(total_rider_found AS DOUBLE) / nullif(total_rider_found + total_rider_not_found, 0) AS rider_found_perc,
         CAST(total_click_direction + total_click_whatsapp AS DOUBLE) / nullif(total_rider_found, 0) AS click_ratio_to_found_rider
  FROM (SELECT CAST(ts + INTERVAL 7 HOUR AS DATE) AS date, count(DISTINCT user_id) FILTER (WHERE event_type = 'signup') AS total_rider_found,
               count(DISTINCT user_id) FILTER (WHERE event_type = 'error') AS total_rider_not_found
        FROM events WHERE event_type IN ('signup', 'error') GROUP BY 1) o
  JOIN (SELECT CAST(timestamp AS DATE) AS date, count(DISTINCT user_id) FILTER (WHERE event_label = 'direction') AS total_click_direction,
               count(DISTINCT user_id) FILTER (WHERE event_label = 'whatsapp') AS total_click_whatsapp
        FROM clicks WHERE event_name = 'contactRider' GROUP BY 1) k ON o.date = k.date)"""


@query("app_sessions", c.with_(APP) + "SELECT * FROM app")
def app_sessions(spark, sf):
    return ops.app_sessions(s.app_events(spark, sf))


@query("funnel_daily", c.with_(FUNNEL) + "SELECT * FROM funnel")
def funnel_daily(spark, sf):
    return ops.funnel_daily(s.found_logs(spark, sf), s.click_tracker(spark, sf))


_NUM = ["total_session", "total_users_open_app", "total_rider_found", "total_rider_not_found", "total_users_open", "total_click_direction",
        "total_click_whatsapp", "total_click", "rider_found_perc", "click_ratio_to_found_rider"]


@query("app_sessions_combined", c.with_(APP, FUNNEL) + f"""
SELECT coalesce(app.date, funnel.date) AS date, {", ".join(f"CAST({x} AS DOUBLE) AS {x}" for x in _NUM)} FROM app FULL OUTER JOIN funnel ON app.date = funnel.date""")
def app_sessions_combined(spark, sf):
    return ops.app_sessions_combined(app_sessions(spark, sf), funnel_daily(spark, sf))


# --- small text operators on the event table ------------------------------------------------------------------------

_MESSY = "CASE event_type WHEN 'signup' THEN '  ' WHEN 'error' THEN 'None' WHEN 'click' THEN ' nan ' WHEN 'view' THEN ' null' ELSE ' paid ' END"


@query("scrub_nulls", f"SELECT event_id, {_SCRUB(_MESSY)} AS note, trim(props) AS props FROM events")
def scrub_nulls(spark, sf):
    kind = F.col("event_type")
    note = (F.when(kind == "signup", "  ").when(kind == "error", "None").when(kind == "click", " nan ").when(kind == "view", " null").otherwise(" paid "))
    return ops.scrub_nulls(s.table(spark, sf, "events").select("event_id", note.alias("note"), "props"))


_ID = "CASE event_id % 5 WHEN 0 THEN CAST(user_id AS VARCHAR) || '.0' WHEN 1 THEN CAST(user_id AS VARCHAR) || '.75' WHEN 2 THEN ' x' || user_id || ' ' WHEN 3 THEN '00' || user_id END"


@query("canonical_ids", f"""
SELECT event_id, CASE WHEN raw IS NULL THEN 'NaN' WHEN event_id % 5 IN (0, 1, 3) THEN CAST(CAST(trunc(CAST(raw AS DOUBLE)) AS BIGINT) AS VARCHAR) ELSE trim(raw) END AS id
FROM (SELECT event_id, {_ID} AS raw FROM events) x""")
def canonical_ids(spark, sf):
    five, uid = F.col("event_id") % 5, F.col("user_id").cast("string")
    raw = (F.when(five == 0, F.concat(uid, F.lit(".0"))).when(five == 1, F.concat(uid, F.lit(".75")))
           .when(five == 2, F.concat(F.lit(" x"), uid, F.lit(" "))).when(five == 3, F.concat(F.lit("00"), uid)))
    return s.table(spark, sf, "events").select("event_id", canonical_id(raw).alias("id"))


@query("batch_label", """
SELECT event_id, CASE WHEN hour(ts) < 11 THEN '08AM' WHEN hour(ts) < 15 THEN '11AM' ELSE '03PM' END AS three_runs,
       CASE WHEN hour(ts) < 12 THEN '09AM' WHEN hour(ts) < 15 THEN '12PM' WHEN hour(ts) < 17 THEN '03PM' ELSE '05PM' END AS four_runs FROM events""")
def batch_label(spark, sf):
    return s.table(spark, sf, "events").select("event_id", ops.batch_label("ts", *ops.THREE_RUNS).alias("three_runs"),
                                               ops.batch_label("ts", *ops.FOUR_RUNS).alias("four_runs"))


@query("ascii_strip", r"SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS text FROM documents")
def ascii_strip(spark, sf):
    from tillworks.functions.scalars import ascii_only

    return s.table(spark, sf, "documents").select("doc_id", ascii_only("text").alias("text"))
