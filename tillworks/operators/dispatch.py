"""On-demand dispatch: ping and round metrics, nearest rider, routes, distance statistics and the order summary."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillworks.functions.scalars import detour, haversine, local_time, micros, minutes_between, money, np_round, seconds_between
from tillworks.functions.skew import bucket_offsets, first_per_key, join_per_key

ORDER = "pending_order_id"


def pending_orders(orders: DataFrame, start: str, end: str) -> DataFrame:
    """Orders created on a local day of the window, with local times, time to live and seconds to accept."""
    created = local_time("created_at")
    lower = F.to_date(F.lit(start)).cast("timestamp_ntz") - F.expr("INTERVAL 7 HOURS")
    upper = F.date_add(F.to_date(F.lit(end)), 1).cast("timestamp_ntz") - F.expr("INTERVAL 7 HOURS")
    times = ["created_at", "accepted_at", "expires_at"]
    return (orders.filter((F.col("created_at") >= lower) & (F.col("created_at") < upper))
            .select(*[c for c in orders.columns if c not in times], created.alias("created_at_local"),
                    local_time("accepted_at").alias("accepted_at_local"),
                    F.round(seconds_between("created_at", "expires_at") / 60, 2).alias("order_ttl_minutes"),
                    F.round(seconds_between("created_at", "accepted_at"), 1).alias("seconds_to_accept")))


def ping_metrics(pings: DataFrame) -> DataFrame:
    """Riders pinged per order and how they answered."""
    response = F.col("response")
    return pings.groupBy(ORDER).agg(
        F.count(F.lit(1)).alias("total_riders_blasted"), F.count_if(response == "ACCEPTED").alias("riders_accepted"),
        F.count_if(response == "REJECTED").alias("riders_rejected"), F.count_if(response == "TIMEOUT").alias("riders_timeout"),
        F.count_if(response.isNull()).alias("riders_no_response"), F.count_if(F.col("wa_status") == "SENT").alias("riders_wa_sent"),
        F.count_if(F.col("push_status") == "SENT").alias("riders_push_sent"))


def round_metrics(blasts: DataFrame) -> DataFrame:
    """Rounds per order: number, last, radii, riders notified, first and last time."""
    return blasts.groupBy(ORDER).agg(
        F.count(F.lit(1)).alias("total_blast_rounds"), F.max("blast_round").alias("last_blast_round"),
        F.min("radius_m").alias("first_blast_radius_m"), F.max("radius_m").alias("max_blast_radius_m"),
        F.sum("riders_notified").alias("total_riders_notified"), F.min(local_time("sent_at")).alias("first_blast_at"),
        F.max(local_time("sent_at")).alias("last_blast_at"))


def accept_context(pings: DataFrame, blasts: DataFrame) -> DataFrame:
    """First accepted round per order and the pings up to it. Pings are counted per round before any join."""
    per_blast = (pings.groupBy(ORDER, "blast_id")
                 .agg(F.count(F.lit(1)).alias("_n"), F.max(F.coalesce(F.col("response") == "ACCEPTED", F.lit(False))).alias("_acc")))
    rounds = per_blast.join(blasts.select("blast_id", "blast_round"), "blast_id")
    first = rounds.filter("_acc").groupBy(ORDER).agg(F.min("blast_round").alias("accepted_blast_round"))
    return (rounds.join(first, ORDER).groupBy(ORDER)
            .agg(F.min("accepted_blast_round").alias("accepted_blast_round"),
                 F.sum(F.when(F.col("blast_round") <= F.col("accepted_blast_round"), F.col("_n")).otherwise(0)).alias("riders_blasted_until_accept")))


def nearest_rider(pings: DataFrame) -> DataFrame:
    """Nearest pinged rider per order; pings without a distance are left out, ties go to time, then code and place."""
    place = ["rider_code", "blast_rider_lat", "blast_rider_long"]
    rows = pings.filter(F.col("distance_in_meter").isNotNull()).select(ORDER, *place, "distance_in_meter", "created_at")
    near = first_per_key(rows, [ORDER], ["distance_in_meter", "created_at", *place])
    return near.select(ORDER, F.col("rider_code").alias("nearest_blasted_rider_code"),
                       F.col("blast_rider_lat").alias("nearest_blasted_rider_lat"), F.col("blast_rider_long").alias("nearest_blasted_rider_lng"))


def blast_rounds(blasts: DataFrame) -> DataFrame:
    """Per order: its number of rounds, and the round of each blast as a map. An order's rounds are few, so they fit into one row."""
    rounds = blasts.groupBy(ORDER, "blast_id").agg(F.min("blast_round").alias("blast_round"), F.count(F.lit(1)).alias("_n"))
    return rounds.groupBy(ORDER).agg(
        F.sum("_n").alias("total_blast_rounds"),
        F.map_from_entries(F.collect_list(F.when(F.col("blast_id").isNotNull(), F.struct("blast_id", "blast_round")))).alias("_round_of"))


def ping_summary(pings: DataFrame, rounds: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """What the order summary needs of the pings, from one grouping of them: their number, the nearest rider, and the first accepted
    round with the pings up to it; and the number of rounds. ``rounds`` comes from :func:`blast_rounds`. Pings are folded per blast first.
    ``orders`` names the orders that are wanted; joined to them, what is cut by order stays so."""
    place = ["rider_code", "blast_rider_lat", "blast_rider_long"]
    near = F.min(F.when(F.col("distance_in_meter").isNotNull(), F.struct("distance_in_meter", "created_at", *place)))
    per_blast = pings.groupBy(ORDER, "blast_id").agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.coalesce(F.col("response") == "ACCEPTED", F.lit(False))).alias("_acc"), near.alias("_near"))
    per_order = per_blast.groupBy(ORDER).agg(
        F.sum("_n").alias("total_riders_blasted"), F.min("_near").alias("_near"), F.collect_list(F.struct("blast_id", "_n", "_acc")).alias("_blasts"))
    if orders is None:
        df = per_order.join(rounds, ORDER, "full")
    else:
        df = orders.select(ORDER).distinct().join(per_order, ORDER, "left").join(rounds, ORDER, "left")
    round_of = lambda b: F.try_element_at("_round_of", b["blast_id"])
    accepted = F.array_min(F.transform(F.filter("_blasts", lambda b: b["_acc"]), round_of))
    df = df.withColumn("accepted_blast_round", accepted)
    until = F.filter("_blasts", lambda b: round_of(b) <= F.col("accepted_blast_round"))
    return df.select(
        ORDER, "total_riders_blasted", "total_blast_rounds", "accepted_blast_round",
        F.when(F.col("accepted_blast_round").isNotNull(), F.aggregate(until, F.lit(0).cast("bigint"), lambda a, b: a + b["_n"]))
        .alias("riders_blasted_until_accept"),
        F.col("_near.rider_code").alias("nearest_blasted_rider_code"), F.col("_near.blast_rider_lat").alias("nearest_blasted_rider_lat"),
        F.col("_near.blast_rider_long").alias("nearest_blasted_rider_lng"))


def earliest_reason(orders: DataFrame, records: DataFrame) -> DataFrame:
    """First recorded dispatch reason per order; records know the order by its text reference."""
    first = first_per_key(records.select("order_ref", "reason", "created_at"), ["order_ref"], ["created_at", "reason"])
    return (orders.select(ORDER, "order_ref").join(first, "order_ref")
            .select(ORDER, F.col("reason").alias("order_status_detail")))


def rider_code_list(pings: DataFrame, bucket_m: float = 500.0) -> DataFrame:
    """Rider codes per order, nearest first, unknown distances last, joined by ', '.

    Codes are sorted and joined per band first, so a task sorts one band; an order then joins its bands' texts. Bands are distances, and
    hours where the distance is unknown.
    """
    unknown = F.col("distance_in_meter").isNull()
    hour = F.coalesce(F.floor(micros("created_at") / 3.6e9), F.lit(-(2 ** 63)))
    band = F.struct(unknown.alias("u"), F.coalesce(F.floor(F.col("distance_in_meter") / bucket_m), hour).alias("b"))
    entry = F.struct("distance_in_meter", "created_at", "rider_code")
    sorted_codes = lambda c, f: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x[f]), ", ")
    bands = pings.groupBy(ORDER, band.alias("band")).agg(sorted_codes(entry, "rider_code").alias("codes"))
    return bands.groupBy(ORDER).agg(sorted_codes(F.struct("band", "codes"), "codes").alias("blasted_rider_codes"))


# --- routes ---------------------------------------------------------------------------------------------------------

ROUTE_KEY = ["from_lat", "from_lng", "to_lat", "to_lng"]


def route_key(*coordinates) -> list[Column]:
    """Coordinates as whole millionths of a degree: equal after rounding to 6 places, and safe to join on."""
    return [F.rint((F.col(c) if isinstance(c, str) else c) * 1e6).cast("bigint").alias(k) for k, c in zip(ROUTE_KEY, coordinates)]


def route_lookup(rows: DataFrame, routes: DataFrame, coordinates: list[str], prefix: str = "") -> DataFrame:
    """Add route distance, duration and source from a route table with one row per pair of points.

    A missing coordinate gives NO_COORDINATE, an unknown pair NO_ROUTE. The rows of a popular pair are split over tasks. Coordinates that are
    not read afterwards are not shuffled, only their key is.
    """
    none = F.lit(False)
    for c in coordinates:
        none = none | F.col(c).isNull()
    df = rows.select("*", *route_key(*coordinates), none.alias("_none"))
    table = routes.select(*route_key("lat1", "lng1", "lat2", "lng2"), F.col("distance_m").alias(f"{prefix}route_distance_m"),
                          F.col("duration_s").alias(f"{prefix}route_duration_seconds"), F.col("source").alias("_source"))
    df = join_per_key(df, table, ROUTE_KEY)
    return (df.withColumn(f"{prefix}route_source", F.when(F.col("_none"), "NO_COORDINATE").otherwise(F.coalesce("_source", F.lit("NO_ROUTE"))))
            .drop("_source", "_none", *ROUTE_KEY))


def distance_stats(positions: DataFrame, bucket_m: float = 1000.0, value: str = "route_distance_m", cut: bool = False) -> DataFrame:
    """Min, mean, exact median and max per order, 2 decimals; all NULL when no distance is known.

    Distances are counted per value. Counts per distance band tell which one or two bands of an order hold its middle ranks; only the rows
    of these are ranked. ``cut``: the rows are stored by order, so nothing is shuffled; else a hot order's rows are split over tasks.
    """
    counts = positions.select(ORDER, F.col(value).alias("_v")).groupBy(ORDER, "_v").agg(F.count("_v").alias("_c"))  # 0 where it is unknown
    stats = counts.groupBy(ORDER).agg(
        F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        (F.sum(money("_v") * F.col("_c")).cast("double") / F.nullif(F.sum("_c"), F.lit(0))).alias("_mean"))
    banded = counts.withColumn("_bucket", F.floor(F.col("_v") / bucket_m))
    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    holds = lambda rank: (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_t"))
    bands = bucket_offsets(banded, [ORDER], "_bucket", F.col("_c")).filter(holds(low) | holds(high))
    bands = bands.groupBy(ORDER).agg(F.collect_list(F.struct("_bucket", "_before", "_total")).alias("_bands"))  # two at most
    rows = banded.join(bands, ORDER) if cut else join_per_key(banded, bands, [ORDER], "inner")
    rows = rows.select(ORDER, "_bucket", "_v", "_c", F.inline(F.filter("_bands", lambda b: b["_bucket"] == F.col("_bucket"))).alias("_in", "_before", "_total"))
    inside = Window.partitionBy(ORDER, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = rows.withColumn("_upto", F.sum("_c").over(inside) + F.col("_before"))
    at = lambda rank: F.max(F.when((rank >= F.col("_upto") - F.col("_c")) & (rank < F.col("_upto")), F.col("_v")))
    middle = ranked.groupBy(ORDER).agg(((at(low) + at(high)) / 2).alias("_median"))
    return (stats.join(middle, ORDER, "left")
            .select(ORDER, *[np_round(f"_{a}", 2).alias(f"{b}_blasted_rider_distance_m") for a, b in
                             (("min", "nearest"), ("mean", "avg"), ("median", "median"), ("max", "max"))]))


def delivery_detail(transactions: DataFrame, deliveries: DataFrame, start: str, end: str) -> DataFrame:
    """On-demand transactions of the window widened by a day on both sides, with their delivery if there is one."""
    t = transactions.filter((F.col("transaction_type") == "ON_DEMAND") & F.col(ORDER).isNotNull()
                            & F.col("transaction_date").between(F.date_sub(F.to_date(F.lit(start)), 1), F.date_add(F.to_date(F.lit(end)), 1)))
    df = t.join(deliveries, t.trx_id == deliveries.transaction_id, "left")
    return df.select(ORDER, "trx_id", "transaction_status", "transaction_date", local_time("paid_at").alias("paid_at_local"),
                     local_time("completed_at").alias("trx_completed_at_local"), "delivery_status", "rider_completion_lat",
                     "rider_completion_lng", local_time("out_for_delivery_at").alias("out_for_delivery_at_local"),
                     local_time("delivered_at").alias("delivered_at_local"))


def members_on(vouchers: DataFrame, as_of: str) -> DataFrame:
    """Distinct users holding a voucher that is active after a date."""
    return vouchers.filter(F.col("active_at") > F.to_date(F.lit(as_of)).cast("timestamp_ntz")).select("user_id").distinct()


def membership_flag(rows: DataFrame, members: DataFrame, user: str = "customer_id", name: str = "has_membership") -> DataFrame:
    """Flag rows whose user is a member."""
    m = members.select(F.col("user_id").alias(user)).distinct().withColumn("_member", F.lit(True))
    return join_per_key(rows, m, [user]).withColumn(name, F.coalesce("_member", F.lit(False))).drop("_member")


def resolve_origin(df: DataFrame) -> DataFrame:
    """Where the ride starts: the accepting rider, else the nearest pinged rider, else a reason why it is unknown."""
    accepted = (F.col("dispatcher_status") == "ACCEPTED") & F.col("accepted_rider_lat").isNotNull()
    nearest = F.col("nearest_blasted_rider_lat").isNotNull()
    pick = lambda a, n: F.when(accepted, F.col(a)).when(nearest, F.col(n))
    return (df.withColumn("origin_lat", pick("accepted_rider_lat", "nearest_blasted_rider_lat"))
            .withColumn("origin_lng", pick("accepted_rider_lng", "nearest_blasted_rider_lng"))
            .withColumn("origin_rider_code", pick("accepted_rider_code", "nearest_blasted_rider_code"))
            .withColumn("origin_type", F.when(accepted, "ACCEPTED_RIDER").when(nearest, "NEAREST_BLASTED_RIDER")
                        .when(F.col("total_riders_blasted") == 0, "NO_RIDER_BLASTED").otherwise("NO_RIDER_COORDINATE")))


# fixed values: column layout of the order summary
SUMMARY_COLUMNS = [
    "transaction_id", "transaction_datetime", "order_date", "order_hour", "pending_order_id", "latest_transaction_status", "order_status",
    "order_status_detail", "hub_code", "customer_id", "customer_name", "customer_phone", "has_membership", "order_qty", "total_price",
    "payment_type", "minutes_paid_to_completed", "seconds_to_accept", "minutes_accept_to_otw", "minutes_otw_to_delivered",
    "minutes_accept_to_delivered", "origin_type", "origin_rider_code", "origin_lat", "origin_lng", "delivery_lat", "delivery_lng",
    "straight_line_distance_m", "actual_route_distance_m", "route_duration_seconds", "delivered_distance_m",
    "nearest_blasted_rider_distance_m", "avg_blasted_rider_distance_m", "median_blasted_rider_distance_m", "max_blasted_rider_distance_m",
    "route_source", "total_rider_blasted", "total_rider_blasted_until_accept", "total_blast_rounds", "accepted_blast_round",
    "blasted_rider_codes"]


@dataclass(frozen=True)
class DispatchTables:
    """What the order summary reads, cut by the order id: orders (:func:`pending_orders`), pings with the order's delivery point, blasts,
    the last delivery and the first reason of each order. Pings, blasts and deliveries have the summary's columns only."""

    orders: DataFrame
    pings: DataFrame
    blasts: DataFrame
    deliveries: DataFrame
    reasons: DataFrame


Store = Callable[[DataFrame, str], DataFrame]


def _as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def dispatch_tables(orders: DataFrame, pings: DataFrame, blasts: DataFrame, deliveries: DataFrame, records: DataFrame, store: Store = _as_is) -> DispatchTables:
    """The tables of the order summary; ``store`` writes those that are read several times, e.g. bucketed by the order id, when they are
    taken in.

    ``deliveries`` comes from :func:`delivery_detail`; its last row per order counts. Records know an order by its text reference.
    """
    orders = store(orders, "orders")
    to = orders.select(ORDER, "delivery_lat", "delivery_lng")
    pings = store(pings.select(ORDER, "blast_id", "rider_code", "response", "distance_in_meter", "blast_rider_lat", "blast_rider_long", "created_at"), "pings")
    deliveries = deliveries.select(ORDER, "trx_id", "paid_at_local", "trx_completed_at_local", "rider_completion_lat", "rider_completion_lng",
                                   "out_for_delivery_at_local", "delivered_at_local")
    return DispatchTables(orders, pings.join(to, ORDER, "left"), blasts.select(ORDER, "blast_id", "blast_round"),
                          store(first_per_key(deliveries, [ORDER], ["trx_id"], last=True), "deliveries"), earliest_reason(orders, records))


TO = ["origin_lat", "origin_lng", "delivery_lat", "delivery_lng"]
DONE = ["origin_lat", "origin_lng", "rider_completion_lat", "rider_completion_lng"]
_POINTS = ["lat1", "lng1", "lat2", "lng2"]
PING, TO_ORDER, TO_DONE = range(3)


def order_ends(tables: DispatchTables) -> DataFrame:
    """Per order: where its ride starts, where it leads to and where it was completed."""
    df = tables.orders.join(nearest_rider(tables.pings), ORDER, "left").withColumn("total_riders_blasted", F.lit(1))
    df = resolve_origin(df).join(tables.deliveries.select(ORDER, *DONE[2:]), ORDER, "left")
    return df.select(ORDER, *TO, *DONE[2:])


def summary_lookups(tables: DispatchTables, routes: DataFrame) -> DataFrame:
    """The routes of the order summary from one lookup of narrow rows: per ping (``kind`` is PING) and per order with an id (TO_ORDER, TO_DONE).
    ``pair`` tells the points of an order whose id is there with several, else it is NULL."""
    pings = tables.pings
    points = lambda cols: [F.col(a).alias(b) for a, b in zip(cols, _POINTS)]
    asked = order_ends(tables).filter(F.col(ORDER).isNotNull()).distinct()
    asked = asked.withColumn("_several", F.count(F.lit(1)).over(Window.partitionBy(ORDER)) > 1)
    kinds = F.array(*[F.struct(F.lit(kind).cast("byte").alias("kind"), *points(cols), F.when(F.col("_several"), F.struct(*points(cols))).alias("pair"))
                      for kind, cols in ((TO_ORDER, TO), (TO_DONE, DONE))])
    asked = asked.select(ORDER, F.inline(kinds))
    from_pings = pings.select(ORDER, F.lit(PING).cast("byte").alias("kind"), *points(["blast_rider_lat", "blast_rider_long", "delivery_lat", "delivery_lng"]),
                              F.lit(None).cast(asked.schema["pair"].dataType).alias("pair"))
    known = F.lit(True)
    for c in _POINTS:
        known = known & F.col(c).isNotNull()
    rows = from_pings.filter(known).unionByName(asked)
    return route_lookup(rows, routes, _POINTS).drop(*_POINTS)


def order_summary(tables: DispatchTables, app_detail: DataFrame, routes: DataFrame, members: DataFrame, store: Store = _as_is) -> DataFrame:
    """One row per order (41 columns). Every support frame has one row per order before it is joined, so rows never multiply, but by an
    app that knows a transaction several times. All joins by order are on the plain order id: none of them shuffles bucketed tables.

    What is known by another key (routes, the app's view, members) is looked up by narrow rows and comes back by order; ``store`` keeps
    the routes. Rows without an order id, which no join by order finds, are looked up themselves; they cost nothing where there are none.
    """
    parts = [ping_summary(tables.pings, blast_rounds(tables.blasts), tables.orders), tables.deliveries]
    blank = ["total_riders_blasted", "total_blast_rounds", "accepted_blast_round", "riders_blasted_until_accept"]
    place = lambda df: resolve_origin(df.na.fill(0, blank))
    df = tables.orders
    for part in parts:
        df = df.join(part, ORDER, "left")
    df = place(df)
    found = store(summary_lookups(tables, routes), "routes")
    distances = distance_stats(found.filter(F.col("kind") == PING).select(ORDER, "route_distance_m"), cut=True)
    ways = found.filter(F.col("kind") != PING).groupBy(ORDER).agg(F.collect_list(
        F.struct("kind", "pair", "route_distance_m", "route_duration_seconds", "route_source")).alias("_ways"))
    seen = [c for c in app_detail.columns if c != "transaction_id"]
    app = tables.orders.select(ORDER, "transaction_id").distinct().join(app_detail, "transaction_id")
    app = app.groupBy(ORDER).agg(F.collect_list(F.struct("transaction_id", *seen)).alias("_app"))
    users = membership_flag(tables.orders.select(ORDER, "customer_id").distinct(), members).filter("has_membership")
    users = users.groupBy(ORDER).agg(F.collect_list(F.struct("customer_id")).alias("_members"))
    by_order = [rider_code_list(tables.pings), distances, tables.reasons]
    lost = tables.orders.filter(F.col(ORDER).isNull())
    df = df.filter(F.col(ORDER).isNotNull())
    for part in (*by_order, ways, app, users):
        df = df.join(part, ORDER, "left")

    def way(kind: int, cols: list[str]) -> Column:
        here = F.struct(*[F.col(a).alias(b) for a, b in zip(cols, _POINTS)])
        return F.get(F.filter("_ways", lambda w: (w["kind"] == kind) & (w["pair"].isNull() | w["pair"].eqNullSafe(here))), F.lit(0))

    df = df.withColumn("_to", way(TO_ORDER, TO)).withColumn("_done", way(TO_DONE, DONE))
    df = df.withColumn("has_membership", F.coalesce(F.exists("_members", lambda m: m["customer_id"].eqNullSafe(F.col("customer_id"))), F.lit(False)))
    df = df.select("*", F.col("_to.route_distance_m").alias("route_distance_m"), F.col("_to.route_duration_seconds").alias("route_duration_seconds"),
                   F.col("_to.route_source").alias("route_source"), F.col("_done.route_distance_m").alias("delivered_route_distance_m"),
                   F.explode_outer(F.filter("_app", lambda a: a["transaction_id"] == F.col("transaction_id"))).alias("_seen"))
    df = _summary_columns(df.select("*", *[F.col(f"_seen.{c}").alias(c) for c in seen]))
    if lost.isEmpty():
        return df
    for part in parts:
        lost = lost.join(part.limit(0), ORDER, "left")
    lost = place(lost)
    for part in by_order:
        lost = lost.join(part.limit(0), ORDER, "left")
    lost = route_lookup(route_lookup(lost, routes, TO), routes, DONE, prefix="delivered_")
    return df.unionByName(_summary_columns(membership_flag(lost.join(app_detail, "transaction_id", "left"), members)))


def _summary_columns(df: DataFrame) -> DataFrame:
    minutes = lambda a, b: np_round(minutes_between(a, b), 2)
    made = {
        "order_date": F.to_date("created_at_local"), "order_hour": F.hour("created_at_local"), "order_status": F.col("dispatcher_status"),
        "order_qty": F.col("total_item_qty"), "actual_route_distance_m": F.col("route_distance_m"),
        "delivered_distance_m": F.col("delivered_route_distance_m"), "total_rider_blasted": F.col("total_riders_blasted"),
        "total_rider_blasted_until_accept": F.col("riders_blasted_until_accept"),
        "straight_line_distance_m": haversine("origin_lat", "origin_lng", "delivery_lat", "delivery_lng"),
        "minutes_paid_to_completed": minutes("paid_at_local", "trx_completed_at_local"),
        "minutes_accept_to_otw": minutes("accepted_at_local", "out_for_delivery_at_local"),
        "minutes_otw_to_delivered": minutes("out_for_delivery_at_local", "delivered_at_local"),
        "minutes_accept_to_delivered": minutes("accepted_at_local", "delivered_at_local"),
    }
    return df.select(*[made.get(c, F.col(c)).alias(c) for c in SUMMARY_COLUMNS])


def route_detour(summary: DataFrame) -> DataFrame:
    """Route ÷ straight line per order, for quality checks."""
    return summary.select(ORDER, detour("actual_route_distance_m", "straight_line_distance_m").alias("route_detour_ratio"))


def status_counts(summary: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return summary.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")
