"""Riders: shifts, standing sessions, hourly performance, day summaries, mapping and app usage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillworks import fixed_values as fv
from tillworks.functions.scalars import (hour_start, iso_week, local_time, minutes_between, money_sum, money_total, np_round, null_like,
                                         parse_flag, ratio, strip, zero_pad)
from tillworks.functions.skew import first_per_key, join_per_key, join_slots, running_sum


# --- text -----------------------------------------------------------------------------------------------------------

def scrub_nulls(df: DataFrame) -> DataFrame:
    """Trim every text column and turn '', 'None', 'nan', 'null' and 'NULL' into NULL."""
    return df.select(*[null_like(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                       for f in df.schema.fields])


def batch_label(ts, cuts: dict[int, str], last: str) -> Column:
    """Label of the run a local time belongs to: first entry whose hour is later, else ``last``."""
    hour = F.hour(ts)
    out = None
    for cut, label in sorted(cuts.items()):
        out = F.when(hour < cut, label) if out is None else out.when(hour < cut, label)
    return out.otherwise(last)


THREE_RUNS = ({11: "08AM", 15: "11AM"}, "03PM")
FOUR_RUNS = ({12: "09AM", 15: "12PM", 17: "03PM"}, "05PM")


# --- shifts and hourly performance ----------------------------------------------------------------------------------

def shift_hour_slots(shifts: DataFrame) -> DataFrame:
    """One row per clock hour a shift touches (local time). A shift past midnight gives hours 23, 0, 1, ... of its date."""
    local = (shifts.filter(F.col("checkin").isNotNull() & F.col("checkout").isNotNull())
             .select("rider_code", "date", local_time("checkin").alias("checkin"), local_time("checkout").alias("checkout"))
             .filter(hour_start("checkin") <= hour_start("checkout")))
    hours = F.sequence(hour_start("checkin"), hour_start("checkout"), F.expr("INTERVAL 1 HOUR"))
    return local.withColumn("_h", F.explode(hours)).withColumn("hour_slot", F.hour("_h")).drop("_h")


def rider_hourly_sales(transactions: DataFrame, products: DataFrame, excluded_riders: list[str] = ()) -> DataFrame:
    """Completed sales per rider, date, ISO week, local hour and payment type."""
    t = transactions.filter(F.col("transaction_status") == "COMPLETED")
    if excluded_riders:
        t = t.filter(~F.col("rider_code").isin(*excluded_riders))
    t = t.select("id", "rider_code", F.col("transaction_date").alias("date"),
                 iso_week(F.coalesce("transaction_datetime_utc", F.col("transaction_date").cast("timestamp_ntz"))).alias("week"),
                 F.hour(local_time("transaction_datetime_utc")).alias("hour"), "payment_type")
    lines = products.groupBy("transaction_id").agg(F.sum("qty").alias("_qty"), money_sum("total_price_after_discount").alias("_sales"))
    return (t.join(lines, t.id == lines.transaction_id).groupBy("rider_code", "date", "week", "hour", "payment_type")
            .agg(F.countDistinct("id").alias("total_orders"), F.sum("_qty").alias("total_qty"),
                 money_sum("_sales").alias("total_sales")))


def semi_join_riders(sales: DataFrame, mapping: DataFrame, kind: str = "HUB") -> DataFrame:
    """Rows of riders whose outlet is of the given type."""
    riders = mapping.filter(F.col("rider_type") == kind).select(F.col("rider_id").alias("rider_code")).distinct()
    return join_per_key(sales, riders, ["rider_code"], "left_semi")


def hourly_performance(sales: DataFrame, slots: DataFrame, mapping: DataFrame) -> DataFrame:
    """Hour slots of hub riders with their sales.

    Sales outside the shift move to its first or last hour; riders with sales but no shift get slots from their first to
    their last sale; rider-days without sales are left out. All joins run on rider-day aggregates.
    """
    trx = semi_join_riders(sales, mapping)
    day = ["rider_code", "date"]
    span = slots.groupBy(*day).agg(F.min("hour_slot").alias("slot_min"), F.max("hour_slot").alias("slot_max"))
    trx = trx.join(span, day, "left")
    hour = F.greatest(F.least(F.col("hour"), F.col("slot_max")), F.col("slot_min"))
    keys = [*day, "week", "hour", "payment_type"]
    fixed = trx.withColumn("hour", F.when(F.col("slot_min").isNull(), F.col("hour")).otherwise(hour))
    for k in keys:
        fixed = fixed.filter(F.col(k).isNotNull())
    fixed = fixed.groupBy(*keys).agg(F.sum("total_orders").alias("total_orders"), F.sum("total_qty").alias("total_qty"),
                                     money_total("total_sales").alias("total_sales"))
    days = fixed.groupBy(*day).agg(F.min("hour").alias("_from"), F.max("hour").alias("_to"))
    made = (days.join(span, day, "left_anti").withColumn("hour_slot", F.explode(F.sequence("_from", "_to")))
            .select(*day, F.lit(None).cast("timestamp_ntz").alias("checkin"), F.lit(None).cast("timestamp_ntz").alias("checkout"), "hour_slot"))
    base = (slots.select(*day, "checkin", "checkout", "hour_slot").join(days, day, "left_semi").unionByName(made).distinct())
    final = (base.join(fixed.withColumn("hour_slot", F.col("hour")), [*day, "hour_slot"], "left")
             .withColumn("week", F.coalesce("week", iso_week("date"))))
    out = final.join(mapping, final.rider_code == mapping.rider_id, "left")
    return scrub_nulls(out.select("rider_id", "jilid", "hub_name", "region", "provinsi", "kota", "rider_type", "date", "checkin",
                                  "checkout", "hour_slot", "week", "hour", "payment_type", "total_orders", "total_qty", "total_sales"))


# --- standing sessions ----------------------------------------------------------------------------------------------

def flag_sessions(logs: DataFrame) -> DataFrame:
    """Number the standing sessions of each rider: one starts where the flag turns true.

    The previous flag and the running number cross hour buckets through one summary row per rider and hour, so a rider with
    any number of events is never sorted in one task.
    """
    df = (logs.withColumn("is_stationed", parse_flag("is_stationed"))
          .withColumn("_bucket", hour_start("timestamp")))
    tail = df.groupBy("rider_code", "_bucket").agg(F.max_by(F.coalesce("is_stationed", F.lit(False)), F.struct("timestamp", "id")).alias("_last"))
    before = F.lag("_last").over(Window.partitionBy("rider_code").orderBy("_bucket"))
    start = tail.select("rider_code", "_bucket", F.coalesce(before, F.lit(False)).alias("_carry"))
    inside = Window.partitionBy("_slot").orderBy("timestamp", "id")
    df = join_slots(df, start, ["rider_code"], "_bucket")
    on = F.coalesce("is_stationed", F.lit(False))
    prev = F.lag(on, 1).over(inside)
    df = df.withColumn("is_session_start", on & ~F.coalesce(prev, F.col("_carry"))).drop("_carry")
    df = running_sum(df, ["rider_code"], "_bucket", ["timestamp", "id"], F.col("is_session_start").cast("int"), "session_seq")
    return df.withColumn("session_id", F.when(F.col("session_seq") > 0, session_name())).drop("_bucket", "_slot")


def session_name() -> Column:
    return F.concat("rider_code", F.lit("_S"), zero_pad(F.col("session_seq"), 4))


def session_summary(flagged: DataFrame) -> DataFrame:
    """One row per session with start, end, counts and minutes (2 decimals). It ends with its last false event, else with its last one."""
    on, off = F.col("is_stationed"), ~F.col("is_stationed")
    parts = (flagged.filter(F.col("session_seq") > 0).groupBy("rider_code", "session_seq")
            .agg(F.min(F.when(on, F.col("timestamp"))).alias("session_start"), F.max(F.when(off, F.col("timestamp"))).alias("session_last_false"),
                 F.max("timestamp").alias("session_last_event"), F.count("id").alias("total_logs"),
                 F.count_if(on).alias("total_true_logs"), F.count_if(off).alias("total_false_logs")))
    return session_ends(parts)


def session_ends(parts: DataFrame) -> DataFrame:
    """Name, end and minutes of sessions with their bounds."""
    return (parts.withColumn("session_id", session_name())
            .withColumn("session_end", F.coalesce("session_last_false", "session_last_event"))
            .withColumn("session_duration_minutes", np_round(minutes_between("session_start", "session_end"), 2)))


def rider_standing_days(sessions: DataFrame) -> DataFrame:
    """Minutes and sessions per rider and the day the session started."""
    return (sessions.groupBy(F.to_date("session_start").alias("operating_date"), "rider_code")
            .agg(money_sum("session_duration_minutes").alias("total_standing_time"),
                 F.countDistinct("session_id").alias("total_standing_session")))


def rider_working_time(shifts: DataFrame, reverses: DataFrame) -> DataFrame:
    """Minutes and hours from check-in to the approved reverse request, and how long the office took afterwards."""
    approved = reverses.filter(F.col("status") == "APPROVED").select("shift_id", "reverse_request_at")
    df = shifts.filter(F.col("checkin").isNotNull()).join(approved, shifts.id == approved.shift_id)
    minutes = minutes_between("checkin", "reverse_request_at")
    return df.select(F.col("date").alias("operating_date"), "rider_code", local_time("checkin").alias("checkin"),
                     local_time("checkout").alias("checkout"), local_time("reverse_request_at").alias("reversed_at"),
                     minutes.alias("total_working_minutes"), (minutes / 60).alias("total_working_hour"),
                     minutes_between("reverse_request_at", "checkout").alias("total_reverse_process_admin"))


def profile_clicks(clicks: DataFrame) -> DataFrame:
    """Profile clicks per day and rider; the click time is local already."""
    return (clicks.filter(F.col("rider_id").isNotNull()).groupBy(F.to_date("timestamp").alias("date"), F.col("rider_id").cast("string").alias("rider_id"))
            .agg(F.count(F.lit(1)).alias("total_click_by_user")))


def rider_day_summary(transactions: DataFrame, working: DataFrame, sessions: DataFrame, hubs: DataFrame,
                      clicks: DataFrame) -> DataFrame:
    """Sales per rider and day with working time, standing time, hub and clicks; missing numbers are 0."""
    keys = ["transaction_date", "rider_code", "rider_name", "hub_code"]
    sales = transactions
    for k in keys:
        sales = sales.filter(F.col(k).isNotNull())
    sales = (sales.groupBy(*keys)
             .agg(money_sum("total_price_after_discount").alias("total_sales"), F.countDistinct("id").alias("total_order"),
                  F.sum("total_item_qty").alias("total_qty"))
             .withColumnRenamed("transaction_date", "operating_date").withColumn("rider_code", strip("rider_code")))
    on = ["operating_date", "rider_code"]
    work = working.select("operating_date", strip("rider_code").alias("rider_code"), "total_working_minutes")
    stand = rider_standing_days(sessions).withColumn("rider_code", strip("rider_code"))
    click = profile_clicks(clicks).select(F.col("date").alias("operating_date"), strip("rider_id").alias("rider_code"), "total_click_by_user")
    df = sales.join(work, on, "left").join(stand, on, "left").join(hubs, "hub_code", "left").join(click, on, "left")
    df = df.na.fill(0, ["total_working_minutes", "total_standing_time", "total_standing_session", "total_sales", "total_order",
                        "total_qty", "total_click_by_user"])
    texts = ["jilid", "hub_name", "business_unit", "region", "kota", "provinsi"]
    df = df.na.fill("0", texts)
    pct = F.coalesce(np_round(ratio("total_standing_time", "total_working_minutes") * 100, 2), F.lit(0.0))
    return df.select(*on, *texts, "total_working_minutes", "total_standing_time", "total_standing_session",
                     pct.alias("standing_mins_pct"), "total_sales", "total_order", "total_qty", "total_click_by_user")


# --- mapping --------------------------------------------------------------------------------------------------------

def missing_riders(transactions: DataFrame, mapping: DataFrame, as_of: str, ownership: str, days: int = 10) -> DataFrame:
    """Riders with recent completed sales and no outlet: not in the mapping, or in it without an outlet code."""
    t = transactions.filter((F.col("transaction_status") == "COMPLETED") & (F.col("ownership_status") == ownership)
                            & (F.col("transaction_date") >= F.date_sub(F.to_date(F.lit(as_of)), days)))
    riders = t.select("rider_code", "rider_name").distinct()
    m = mapping.select("rider_id", "jilid", "hub_name")
    return (riders.join(m, riders.rider_code == m.rider_id, "left").filter(F.col("jilid").isNull())
            .select("rider_code", "rider_name", "jilid", F.col("hub_name").alias("outlet_name")).distinct())


def hub_dim(mapping: DataFrame) -> DataFrame:
    return mapping.select("jilid", "hub_id", "hub_name").distinct()


def hub_dim_from_outlets(outlets: DataFrame, ownership: str = fv.FRANCHISE_MODEL, kind: str = "HUB") -> DataFrame:
    """Hubs of the franchise segment: the outlet code is both hub and outlet id."""
    return (outlets.filter((F.col("ownership_status") == ownership) & (F.col("hub_type") == kind))
            .select(F.col("outlet_code").alias("hub_id"), F.col("outlet_code").alias("jilid"), F.col("outlet_name").alias("hub_name")))


def rider_mapping(riders: DataFrame, missing: DataFrame, hubs: DataFrame, updated_by: str, order: list[str],
                  cashier_prefix: str, cashier_suffix: str) -> DataFrame:
    """Mapping rows for riders that lack one, the first per (hub, rider) by ``order``.

    The cashier id is the lower-case rider code between ``cashier_prefix`` and ``cashier_suffix``.
    """
    hub = hubs.select(F.col("hub_id").alias("_hub"), "jilid", "hub_name")
    df = riders.join(missing.select("rider_code").distinct(), "rider_code", "left_semi")
    df = df.join(hub, F.col("hub_code") == F.col("_hub"), "left")
    test = F.col("hub_code") == fv.TEST_HUB
    df = df.select(
        F.when(test, fv.TEST_HUB).otherwise(F.col("_hub")).alias("hub_id"),
        F.when(test, fv.TEST_OUTLET).otherwise(F.col("jilid")).alias("jilid"),
        F.when(test, fv.TEST_HUB).otherwise(F.col("hub_name")).alias("hub_name"),
        F.col("rider_code").alias("rider_id"), F.col("rider_code").alias("cart_id"), F.col("name").alias("rider_name"),
        F.when(F.col("is_active"), "ACTIVE").otherwise("INACTIVE").alias("status"), F.lit("COMMISSION").alias("scheme"),
        F.when(F.col("phone_number") != fv.DUMMY_PHONE, F.col("phone_number")).alias("phone_number"),
        F.concat(F.lit(cashier_prefix), F.lower("rider_code"), F.lit(cashier_suffix)).alias("cashier_id"),
        F.lit(updated_by).alias("updated_by"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    return first_per_key(df, ["hub_id", "rider_id"], [f"_o{i}" for i in range(len(order))]).drop(*[f"_o{i}" for i in range(len(order))])


def rider_outlets(mapping: DataFrame, outlets: DataFrame) -> DataFrame:
    """Distinct riders with hub and outlet attributes; riders without an outlet are left out."""
    return (mapping.join(outlets, "jilid").select("rider_id", "jilid", "hub_name", "region", "provinsi", "kota", "rider_type").distinct())


def riders_by_type(mapping: DataFrame, outlets: DataFrame, day: str) -> DataFrame:
    """Riders per outlet type among the mapping rows loaded on a day."""
    loaded = mapping.filter((F.col("load_data_at") >= F.to_date(F.lit(day)).cast("timestamp_ntz"))
                            & (F.col("load_data_at") < F.date_add(F.to_date(F.lit(day)), 1).cast("timestamp_ntz")))
    return loaded.join(outlets, "jilid").groupBy("rider_type").agg(F.count(F.lit(1)).alias("total_riders"))


# --- app usage ------------------------------------------------------------------------------------------------------

def app_sessions(opens: DataFrame) -> DataFrame:
    """Sessions and users per local day."""
    return (opens.groupBy(F.to_date(local_time("created_at")).alias("date"))
            .agg(F.countDistinct("id").alias("total_session"), F.countDistinct("user_id").alias("total_users_open_app")))


def funnel_daily(found_logs: DataFrame, clicks: DataFrame) -> DataFrame:
    """Users who found a rider or none, and users who asked for the way or a chat, per day with ratios."""
    found = F.col("riders_found_count") >= 1
    opened = (found_logs.filter(F.col("riders_found_count") >= 0).groupBy(F.to_date(local_time("created_at")).alias("date"))
              .agg(F.countDistinct(F.when(found, F.col("user_id"))).alias("total_rider_found"),
                   F.countDistinct(F.when(~found, F.col("user_id"))).alias("total_rider_not_found"))
              .withColumn("total_users_open", F.col("total_rider_found") + F.col("total_rider_not_found")))
    label = F.col("event_label")
    clicked = (clicks.filter((F.col("event_name") == "contactRider") & label.isin("direction", "whatsapp"))
               .groupBy(F.to_date("timestamp").alias("date"))
               .agg(F.countDistinct(F.when(label == "direction", F.col("user_id"))).alias("total_click_direction"),
                    F.countDistinct(F.when(label == "whatsapp", F.col("user_id"))).alias("total_click_whatsapp"))
               .withColumn("total_click", F.col("total_click_direction") + F.col("total_click_whatsapp")))
    df = opened.join(clicked, "date")
    return (df.withColumn("rider_found_perc", ratio("total_rider_found", "total_users_open"))
            .withColumn("click_ratio_to_found_rider", ratio("total_click", "total_rider_found")))


def app_sessions_combined(sessions: DataFrame, funnel: DataFrame) -> DataFrame:
    """Both apps side by side; days seen by one only are kept. Numbers as doubles."""
    df = sessions.join(funnel, "date", "full_outer")
    return df.select("date", *[F.col(c).cast("double").alias(c) for c in df.columns if c != "date"])


def rider_status_filter(rows: DataFrame, summaries: DataFrame, status: str = fv.OWNED_MODEL) -> DataFrame:
    """Rows of riders whose greatest recorded ownership status is ``status``."""
    riders = summaries.groupBy("rider_id").agg(F.max("ownership_status").alias("_s")).filter(F.col("_s") == status)
    return join_per_key(rows, riders.drop("_s"), ["rider_id"], "left_semi")


def prefix_filter(df: DataFrame, column: str = "rider_code", prefixes: list[str] = tuple(fv.EXTRA_RIDER_PREFIXES)) -> DataFrame:
    """Rows whose code starts with one of the prefixes."""
    keep = F.lit(False)
    for p in prefixes:
        keep = keep | F.col(column).startswith(p)
    return df.filter(keep)


def products_of_selected_riders(products: DataFrame, summaries: DataFrame) -> DataFrame:
    """Product rows of the riders picked by :func:`prefix_filter`, once per (code, id) pair of the rider."""
    riders = prefix_filter(summaries).select("rider_code", "rider_id").distinct()
    return products.join(riders, "rider_id")
