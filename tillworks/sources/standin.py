"""Stand-ins: the test tables shaped as order headers, order lines, outlets, rider logs and so on.

Every function reads the whole table it names; nothing is sampled. ``tillworks.plans.ctes`` holds the same shapes as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks import fixed_values as fv
from tillworks.functions.scalars import haversine, money_sum, np_round
from tillworks.sources.tables import table

MONEY_COLUMNS = ["total_order_amount", "total_discount_amount", "total_promotion_amount", "subtotal",
                 "total_tax_amount", "total_amount"]


def _code(c: str):
    return F.lpad(F.col(c).cast("string"), 5, "0")


def orders_base(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order with its outlet, local time and order-level money."""
    return shape_orders(table(spark, sf, "orders"), table(spark, sf, "customer"))


def shape_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """:func:`orders_base` of any (also streaming) frame of orders."""
    customer = customer.select("c_custkey", "c_nationkey")
    total = F.col("o_totalprice")
    priority = F.col("o_orderpriority")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                _code("c_nationkey").alias("outlet_code"),
                (F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))).alias("transaction_date"),
                F.when(priority == "1-URGENT", "GoFood").when(priority == "2-HIGH", "GrabFood")
                .when(priority == "3-MEDIUM", "ShopeeFood").when(priority == "5-LOW", "Cash")
                .otherwise(fv.APP_CHANNEL).alias("payment_type"),
                F.when(F.col("o_orderstatus") == "P", "none").otherwise("fulfilled").alias("fulfillment_status"),
                F.lit("paid").alias("payment_status"),
                F.lit("completed").alias("status"),
                F.lit("success").alias("transactions_status"),
                (total / 1.1 + 0.05 * total).alias("total_order_amount"),
                (0.05 * total).alias("total_discount_amount"),
                (0.02 * total).alias("total_promotion_amount"),
                (total / 1.1).alias("subtotal"),
                (total - total / 1.1).alias("total_tax_amount"),
                total.alias("total_amount"),
            ))


def _transactions(base: DataFrame) -> DataFrame:
    """Every order one sale; id % 10 = 0 a second sale (60/40); % 50 = 5 a zero sale; % 37 = 0 a refund."""
    oid, total = F.col("order_id"), F.col("total_amount")
    split = oid % 10 == 0
    tx = lambda pos, kind, amount: F.struct(
        F.lit(pos).alias("pos"), F.lit(kind).alias("transactions_type"), amount.cast("double").alias("tx_amount"))
    rows = F.filter(F.array(
        F.struct(F.lit(True).alias("on"), tx(1, "sale", F.when(split, total * 0.6).otherwise(total)).alias("t")),
        F.struct(split.alias("on"), tx(2, "sale", total * 0.4).alias("t")),
        F.struct((oid % 50 == 5).alias("on"), tx(3, "sale", F.lit(0.0)).alias("t")),
        F.struct((oid % 37 == 0).alias("on"), tx(4, "refund", total).alias("t")),
    ), lambda x: x["on"])
    return (base.withColumn("_x", F.explode(rows))
            .select("*", "_x.t.pos", (oid * 10 + F.col("_x.t.pos")).alias("transaction_id"),
                    "_x.t.transactions_type", "_x.t.tx_amount").drop("_x"))


def raw_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions as delivered: the order's full money on every one of its rows."""
    return _transactions(orders_base(spark, sf)).withColumn("sales_type", F.col("payment_type"))


def headers(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions as stored: no zero sales, split orders share their money 60/40."""
    return shape_headers(orders_base(spark, sf))


def shape_headers(base: DataFrame) -> DataFrame:
    share = F.when((F.col("transactions_type") == "sale") & (F.col("order_id") % 10 == 0),
                   F.when(F.col("pos") == 1, 0.6).otherwise(0.4)).otherwise(1.0)
    df = _transactions(base).filter(F.col("pos") != 3)
    return df.select(*[c for c in df.columns if c not in MONEY_COLUMNS],
                     *[(F.col(c) * share).alias(c) for c in MONEY_COLUMNS],
                     F.col("payment_type").alias("sales_type"))


def details(spark: SparkSession, sf: str, doubled: bool = False) -> DataFrame:
    """Order lines; with ``doubled`` the orders with id % 5 = 0 are there twice, as after loading a file twice."""
    df = shape_details(table(spark, sf, "lineitem"), table(spark, sf, "part"))
    if not doubled:
        return df
    times = F.when(F.col("order_id") % 5 == 0, 2).otherwise(1)
    return df.withColumn("_i", F.explode(F.sequence(F.lit(1), times))).drop("_i")


def shape_details(line: DataFrame, part: DataFrame, *also: str) -> DataFrame:
    """:func:`details` of any frame of order lines, with columns of it that are kept ``also``."""
    part = part.select("p_partkey", "p_name", "p_brand", "p_retailprice", "p_type")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    bundle = F.col("l_returnflag") == "A"
    return line.join(part, line.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("order_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_detail_id"),
        F.when(bundle, fv.BUNDLE_TYPE).when(F.col("l_returnflag") == "N", "standard").otherwise("variant").alias("type"),
        F.when(bundle, (F.col("l_suppkey") % 20).cast("string")).otherwise("").alias("bundling_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(bundle, F.concat(F.lit("Bundle "), (F.col("l_suppkey") % 20).cast("string")))
        .otherwise(F.col("p_type")).alias("product_generic_name"),
        F.col("p_brand").alias("sku"),
        F.col("p_retailprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_order_amount"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
        F.lit(0.0).alias("promotion_amount"),
        net.alias("subtotal"),
        (F.col("l_tax") * 100).alias("tax_percentage"),
        (net * F.col("l_tax")).alias("tax_amount"),
        (net * (1 + F.col("l_tax"))).alias("total_amount"),
        F.col("l_linestatus").alias("status"),
        F.lit("paid").alias("payment_status"),
        F.lit("sale").alias("transactions_type"),
        F.col("l_shipdate").alias("transaction_date"), *also,
    )


def outlets(spark: SparkSession, sf: str) -> DataFrame:
    """Outlet master: nations joined to regions. Nation 24 is left out, so its sales meet no outlet."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    key = F.col("n_nationkey")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .filter(key != 24)
            .select(_code("n_nationkey").alias("jilid"), F.col("n_name").alias("customer_name"),
                    F.col("r_name").alias("region"),
                    F.concat(F.lit("P"), (key % 7).cast("string")).alias("provinsi"),
                    F.concat(F.lit("K"), (key % 11).cast("string")).alias("kota"),
                    F.when(key % 3 == 0, fv.FRANCHISE_MODEL).otherwise(fv.OWNED_MODEL).alias("ownership_model"),
                    F.concat(F.lit("B"), (key % 4).cast("string")).alias("brand")))


def brand_names(spark: SparkSession, sf: str) -> DataFrame:
    """Brand code -> shown name; B3 has none."""
    key = F.col("n_nationkey")
    return (table(spark, sf, "nation").filter(key % 4 != 3)
            .select(F.concat(F.lit("B"), (key % 4).cast("string")).alias("brand"),
                    F.concat(F.lit("Brand "), (key % 4).cast("string")).alias("brand_name")).distinct())


def transitions(spark: SparkSession, sf: str) -> DataFrame:
    """Outlets that changed hands on 1998-01-01; nation 8 has no recorded old model, nation 12 no named old brand."""
    key = F.col("n_nationkey")
    return (table(spark, sf, "nation").filter(key % 4 == 0)
            .select(_code("n_nationkey").alias("jilid"), F.to_date(F.lit("1998-01-01")).alias("start_date"),
                    F.when(key != 8, fv.FRANCHISE_MODEL).alias("ownership_model"),
                    F.when(key == 12, "B3").otherwise("B1").alias("brand")))


def slot_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Bundle master: 1 + id % 3 slots; ids from 18 up are unknown."""
    bid = F.col("s_suppkey") % 20
    return (table(spark, sf, "supplier").filter(bid < 18)
            .select(bid.cast("string").alias("bundling_id"),
                    (1 + bid % 3).cast("int").alias("bundling_slot_count")).distinct())


# --- nested order documents -----------------------------------------------------------------------------------------

LISTED = ["3", "77", "205"]
PAYMENT_NAMES = {"GoFood": "Go Food", "GrabFood": "Grab Food", "ShopeeFood": "Shopee Food", "Cash": "QPON"}


def order_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One document per order, built from the order's own key: 1-4 details, bundles of 1-4 components, 0-2 promotions.

    Orders with id % 41 = 7 are unpaid (no transaction). Texts carry characters outside ASCII. The orders are dealt anew before they grow
    into documents, so that as many tasks as there are cores work on them, however the file is cut.
    """
    b = orders_base(spark, sf).hint("rebalance", "order_id")
    oid, total = F.col("order_id"), F.col("total_amount")
    n = 1 + oid % 4
    utc = F.col("transaction_date")
    name = F.col("payment_type")
    for short, spaced in PAYMENT_NAMES.items():
        name = F.when(F.col("payment_type") == short, spaced).otherwise(name)

    def tx(pos: int, kind: str, amount):
        return F.struct((oid * 10 + pos).cast("string").alias("transaction_id"), utc.alias("transaction_date"),
                        F.lit(kind).alias("type"), F.lit("success").alias("status"), F.lit("edc").alias("gateway"),
                        name.alias("payment_type_name"), F.lit(0.0).alias("mdr"), amount.cast("double").alias("amount"))

    split = oid % 10 == 0
    pairs = F.array(
        F.struct((oid % 41 != 7).alias("on"), tx(1, "sale", F.when(split, total * 0.6).otherwise(total)).alias("t")),
        F.struct((split & (oid % 41 != 7)).alias("on"), tx(2, "sale", total * 0.4).alias("t")),
        F.struct(((oid % 50 == 5) & (oid % 41 != 7)).alias("on"), tx(3, "sale", F.lit(0.0)).alias("t")),
        F.struct(((oid % 37 == 0) & (oid % 41 != 7)).alias("on"), tx(4, "refund", total).alias("t")))
    transactions = F.transform(F.filter(pairs, lambda p: p["on"]), lambda p: p["t"])

    def detail(line):
        i, k = line["i"], line["k"]
        text = lambda c: c.cast("string")
        kind = F.when(k % 3 == 0, fv.BUNDLE_TYPE).when(k % 3 == 1, "standard").otherwise("variant")
        combos = F.when(k % 3 == 0, F.transform(F.sequence(F.lit(1).cast("bigint"), 1 + k % 4), lambda j: F.struct(
            text((k * 5 + F.floor(j / 2)) % 300).alias("product_id"), F.concat(F.lit("C"), text(j)).alias("product_sku"),
            F.concat(F.lit("Part "), text(k)).alias("product_name"), F.lit("-").alias("variant_name"),
            (1 + j % 2).cast("double").alias("quantity"))))
        promotions = F.when(k % 3 != 0, F.transform(F.sequence(F.lit(1).cast("bigint"), k % 3), lambda j: F.struct(
            F.concat(F.lit("P"), text(j % 2)).alias("promotion_id"), F.concat(F.lit("Promo "), text(j % 2)).alias("promotion_name"),
            F.lit("T").alias("promotion_type"), (j * 100).cast("double").alias("promotion_amount"))))
        discounts = F.when(k % 2 == 1, F.array(F.struct(
            F.concat(F.lit("D"), text(k)).alias("discount_name"), (k * 50).cast("double").alias("discount_amount"))))
        return F.struct(
            text(oid * 10 + i).alias("order_detail_id"), text((oid * 3 + i * 17) % 300).alias("product_id"),
            F.concat(F.lit("Item "), text(k)).alias("product_name"), F.concat(F.lit("Generic "), text(k)).alias("product_generic_name"),
            F.lit("food").alias("product_type"), F.lit("v").alias("product_variant_id"), F.lit("Hot").alias("product_variant_name"),
            F.when(k % 4 == 1, "").when(k % 4 > 1, F.concat(F.lit("M"), text(k))).alias("product_modifier_id"),
            F.lit("").alias("product_modifier_name"),
            F.when(k % 10 == 0, F.concat(F.lit("MS"), text(k))).otherwise("").alias("modifier_product_sku"),
            F.concat(F.lit("café "), text(k)).alias("notes"), F.concat(F.lit("S"), text(k)).alias("sku"),
            F.col("fulfillment_status").alias("fulfillment_status"), kind.alias("type"), (1 + k % 4).cast("double").alias("quantity"),
            F.when(k % 13 == 0, 0.0).otherwise((k * 1000).cast("double")).alias("base_price"),
            (total / n).alias("total_order_amount"), F.lit(0.0).alias("additional_charge"), F.lit(0.0).alias("discount_percentage"),
            (k * 10).cast("double").alias("discount_order_amount"), F.lit("yes").alias("taxable"),
            F.when(k % 29 != 0, F.when(k % 5 == 0, 11.0).otherwise(10.0)).alias("tax_percentage"),
            combos.alias("product_combos"), promotions.alias("promotions"), discounts.alias("discounts"))

    # a line's number is worked out once: inside a lambda nothing is shared
    numbers = F.transform(F.sequence(F.lit(1).cast("bigint"), n), lambda i: F.struct(i.alias("i"), ((oid * 7 + i * 13) % 97).alias("k")))
    lit = lambda v: F.lit(v).cast("string")
    return b.select(
        oid.cast("string").alias("order_id"), F.concat(F.lit("R"), oid.cast("string")).alias("order_reference"),
        F.col("outlet_code").alias("outlet_id"), F.col("outlet_code").cast("int").cast("string").alias("outlet_code"),
        F.concat(F.lit("NATION_"), F.col("outlet_code").cast("int").cast("string")).alias("outlet_name"),
        "status", lit("pos").alias("channel"), lit("counter").alias("channel_detail"), "payment_status", "fulfillment_status",
        lit("café").alias("notes"), F.col("customer_id").cast("string").alias("customer_id"),
        F.concat(F.lit("Zoë "), F.col("customer_id").cast("string")).alias("customer_first_name"), lit(None).alias("customer_last_name"),
        lit(None).alias("customer_phone_number"), lit(None).alias("customer_email"), lit("c1").alias("cashier_id"),
        utc.alias("order_date"), utc.alias("closed_date"), *MONEY_COLUMNS, transactions.alias("transactions"),
        F.transform(numbers, detail).alias("order_details"))


def products(spark: SparkSession, sf: str) -> DataFrame:
    """Product master with bundle slot lists; some products are free or have no SKU."""
    pk = F.col("p_partkey")
    slots = F.transform(F.sequence(F.lit(1).cast("bigint"), 1 + pk % 5), lambda j: F.struct(
        F.concat(F.lit("cat"), (j % 3).cast("string")).alias("category")))
    return table(spark, sf, "part").select(
        pk.cast("string").alias("product_id"),
        F.when(F.col("p_size") % 10 == 0, fv.BUNDLE_TYPE).otherwise("standard").alias("type"),
        F.when(pk % 23 == 0, "").otherwise(F.col("p_brand")).alias("sku"),
        F.when(pk % 17 == 0, 0.0).otherwise(F.col("p_retailprice")).alias("price"),
        F.when(F.col("p_size") % 10 == 0, slots).alias("bundles"))


# --- riders (events) ------------------------------------------------------------------------------------------------

def _rider(c="user_id"):
    return F.concat(F.lit("R"), F.lpad(F.col(c).cast("string"), 5, "0"))


def stationed_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Standing flags as text; sign-ups carry an unreadable flag."""
    return shape_logs(table(spark, sf, "events"))


def shape_logs(events: DataFrame) -> DataFrame:
    """:func:`stationed_logs` of any (also streaming) frame of events."""
    kind = F.col("event_type")
    flag = F.when(kind.isin("view", "click"), "True").when(kind == "error", "false").when(kind == "purchase", "FALSE").otherwise("?")
    return events.select(F.col("event_id").alias("id"), _rider().alias("rider_code"), F.col("ts").alias("timestamp"),
                                             flag.alias("is_stationed"))


def shifts(spark: SparkSession, sf: str) -> DataFrame:
    """One shift per rider and day from first to last event (stored 7 hours earlier); users with id % 7 = 0 have none, those
    with id % 11 = 0 stay 3 hours longer, past midnight."""
    e = table(spark, sf, "events").filter(F.col("user_id") % 7 != 0)
    hours = lambda n: F.expr(f"INTERVAL {n} HOURS")
    df = e.groupBy("user_id", F.to_date("ts").alias("date")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.min("event_id").alias("id"))
    return df.select("id", _rider().alias("rider_code"), "date", (F.col("a") - hours(7)).alias("checkin"),
                     F.when(F.col("user_id") % 11 == 0, F.col("b") - hours(4)).otherwise(F.col("b") - hours(7)).alias("checkout"))


def reverse_requests(spark: SparkSession, sf: str) -> DataFrame:
    return shifts(spark, sf).select(F.col("id").alias("shift_id"), (F.col("checkout") - F.expr("INTERVAL 10 MINUTES")).alias("reverse_request_at"),
                                    F.when(F.col("id") % 3 != 0, "APPROVED").otherwise("REJECTED").alias("status"))


def rider_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases as rider sales, up to two hours late so that some fall outside the shift."""
    eid, uid = F.col("event_id"), F.col("user_id")
    return table(spark, sf, "events").filter(F.col("event_type") == "purchase").select(
        eid.alias("id"), _rider().alias("rider_code"), F.concat(F.lit("Rider "), uid.cast("string")).alias("rider_name"),
        F.concat(F.lit("HB"), (uid % 25).cast("string")).alias("hub_code"), F.to_date("ts").alias("transaction_date"),
        (F.col("ts") - F.expr("INTERVAL 7 HOURS") + F.make_dt_interval(hours=(eid % 3).cast("int"))).alias("transaction_datetime_utc"),
        F.when(eid % 29 == 0, "VOID").otherwise("COMPLETED").alias("transaction_status"),
        F.when(eid % 3 == 0, "CASH").when(eid % 3 == 1, "QRIS").otherwise("APP").alias("payment_type"),
        F.when(uid % 2 == 0, fv.OWNED_MODEL).otherwise(fv.FRANCHISE_MODEL).alias("ownership_status"),
        (1 + eid % 2).alias("total_item_qty"), F.col("value").alias("total_price_after_discount"))


def rider_products(spark: SparkSession, sf: str) -> DataFrame:
    """One or two product rows per rider sale."""
    t = rider_transactions(spark, sf)
    return t.select(F.col("id").alias("transaction_id"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("total_item_qty"))).alias("line"),
                    F.lit(1).cast("bigint").alias("qty"), (F.col("total_price_after_discount") / F.col("total_item_qty")).alias("total_price_after_discount"))


def riders_hubs(spark: SparkSession, sf: str) -> DataFrame:
    """Rider -> hub mapping; users with id % 13 = 0 are missing, those with id % 13 = 1 have no outlet code."""
    uid = F.col("user_id")
    return (table(spark, sf, "events").filter(uid % 13 != 0).select("user_id").distinct()
            .select(_rider().alias("rider_id"), F.when(uid % 13 != 1, F.lpad((uid % 25).cast("string"), 5, "0")).alias("jilid"),
                    F.concat(F.lit("HB"), (uid % 25).cast("string")).alias("hub_id"),
                    F.concat(F.lit(" Hub "), (uid % 25).cast("string")).alias("hub_name"),
                    (F.to_timestamp_ntz(F.lit("2024-01-30 00:00:00")) - F.make_dt_interval(days=(uid % 3).cast("int"), hours=F.lit(-5))).alias("load_data_at")))


def rider_outlet_types(spark: SparkSession, sf: str) -> DataFrame:
    """Outlets with the type of their riders; nation key % 6 = 0 has an empty region."""
    k = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        _code("n_nationkey").alias("jilid"), F.when(k % 6 == 0, " ").otherwise(F.concat(F.lit("Region "), (k % 5).cast("string"))).alias("region"),
        F.concat(F.lit("P"), (k % 7).cast("string")).alias("provinsi"), F.when(k % 4 == 0, "None").otherwise(F.concat(F.lit("K"), (k % 11).cast("string"))).alias("kota"),
        F.when(k % 5 != 0, "HUB").otherwise("SHOP").alias("rider_type"), F.col("n_name").alias("outlet_name"),
        F.when(k % 3 == 0, fv.FRANCHISE_MODEL).otherwise(fv.OWNED_MODEL).alias("ownership_status"))


def app_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), "user_id", F.col("ts").alias("created_at"), "event_type")


def found_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Sign-ups found 1-3 riders, errors found none."""
    e = table(spark, sf, "events").filter(F.col("event_type").isin("signup", "error"))
    return e.select("user_id", F.col("ts").alias("created_at"),
                    F.when(F.col("event_type") == "error", 0).otherwise(1 + F.col("event_id") % 3).alias("riders_found_count"))


def click_tracker(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks ask for the way, views for a chat, purchases are another event; users with id % 10 = 0 click on nobody."""
    kind = F.col("event_type")
    e = table(spark, sf, "events").filter(kind.isin("click", "view", "purchase"))
    return e.select(F.col("event_id"), "user_id", F.col("ts").alias("timestamp"),
                    F.when(F.col("user_id") % 10 != 0, F.concat(F.lit("R"), F.lpad(((F.col("user_id") * 3) % 150).cast("string"), 5, "0"))).alias("rider_id"),
                    F.when(kind == "purchase", "buy").otherwise("contactRider").alias("event_name"),
                    F.when(kind == "click", "direction").when(kind == "view", "whatsapp").otherwise("other").alias("event_label"))


# --- on-demand dispatch ---------------------------------------------------------------------------------------------

def _seconds(n):
    return F.make_dt_interval(secs=n.cast("decimal(18,6)"))


def _lat(k):
    return F.lit(-6.0) + (k % 1000) / F.lit(10000.0)


def _lng(k):
    return F.lit(106.0) + (k % 700) / F.lit(10000.0)


def dispatch_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as an on-demand order; some lack a delivery point or the accepting rider's position."""
    b = orders_base(spark, sf)
    k, rider = F.col("order_id"), F.col("customer_id")
    created = F.col("transaction_date") - F.expr("INTERVAL 7 HOURS")
    accepted = F.col("fulfillment_status") == "fulfilled"
    taken = accepted & (k % 3 != 0)
    status = F.when(taken, "ACCEPTED").when(accepted, "EXPIRED").otherwise("CANCELLED")
    return b.select(
        k.alias("pending_order_id"), F.concat(F.lit("OD-"), k.cast("string")).alias("order_ref"), (k * 10 + 1).alias("transaction_id"),
        F.col("outlet_code").alias("hub_code"), "customer_id", status.alias("dispatcher_status"), (1 + k % 5).alias("total_item_qty"),
        F.col("total_amount").alias("total_price"), "payment_type",
        F.when(k % 97 != 0, _lat(k)).alias("delivery_lat"), F.when(k % 97 != 0, _lng(k)).alias("delivery_lng"),
        F.when(taken & (k % 13 != 0), _lat(rider)).alias("accepted_rider_lat"), F.when(taken & (k % 13 != 0), _lng(rider)).alias("accepted_rider_lng"),
        F.when(taken, F.concat(F.lit("R"), rider.cast("string"))).alias("accepted_rider_code"),
        created.alias("created_at"), F.when(taken, created + _seconds(k % 300)).alias("accepted_at"),
        (created + _seconds(F.lit(300) + k % 61)).alias("expires_at"))


def dispatch_pings(spark: SparkSession, sf: str) -> DataFrame:
    """Every order line as a pinged rider."""
    part, flag = F.col("l_partkey"), F.col("l_returnflag")
    known = part % 9 != 0
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("pending_order_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("blast_id"),
        F.concat(F.lit("R"), F.col("l_suppkey").cast("string")).alias("rider_code"),
        F.when(flag == "A", "ACCEPTED").when(flag == "R", "REJECTED").when(F.col("l_linestatus") == "F", "TIMEOUT").alias("response"),
        F.when(F.col("l_quantity") > 25, "SENT").otherwise("SKIPPED").alias("wa_status"),
        F.when(F.col("l_discount") > 0.05, "SENT").otherwise("FAILED").alias("push_status"),
        F.when(F.col("l_suppkey") % 10 != 3, F.col("l_extendedprice")).alias("distance_in_meter"),
        F.when(known, _lat(part)).alias("blast_rider_lat"), F.when(known, _lng(part)).alias("blast_rider_long"),
        F.col("l_shipdate").alias("created_at"))


def dispatch_blasts(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order and round that pinged anyone. The lines are dealt by order, which is how rounds are grouped further."""
    line = F.col("l_linenumber")
    return (table(spark, sf, "lineitem").repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber")
            .agg(F.count(F.lit(1)).alias("riders_notified"), F.min("l_shipdate").alias("sent_at"))
            .select((F.col("l_orderkey") * 10 + line).alias("blast_id"), F.col("l_orderkey").alias("pending_order_id"),
                    line.alias("blast_round"), (1500 + 1500 * line).alias("radius_m"), "riders_notified", "sent_at"))


def dispatch_records(spark: SparkSession, sf: str) -> DataFrame:
    """Reasons written while an order was handled; the order is known by its text reference."""
    flag = F.col("l_returnflag")
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("OD-"), F.col("l_orderkey").cast("string")).alias("order_ref"),
        F.when(flag == "A", "rider accepted").when(flag == "R", "no nearby rider").otherwise("no rider with stock").alias("reason"),
        F.col("l_shipdate").alias("created_at"))


def dispatch_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions of the orders: id % 8 = 0 has two, id % 11 = 4 is not on demand, id % 101 = 0 has no order."""
    b = orders_base(spark, sf)
    k = F.col("order_id")
    df = b.withColumn("_n", F.explode(F.sequence(F.lit(1), F.when(k % 8 == 0, 2).otherwise(1))))
    paid = F.col("transaction_date") - F.expr("INTERVAL 7 HOURS") - _seconds(k % 90)
    return df.select(
        F.when(k % 101 != 0, k).alias("pending_order_id"), (k * 10 + F.col("_n")).alias("trx_id"),
        F.when(k % 11 == 4, "REGULAR").otherwise("ON_DEMAND").alias("transaction_type"), F.lit("COMPLETED").alias("transaction_status"),
        F.to_date("transaction_date").alias("transaction_date"), paid.alias("paid_at"),
        (paid + _seconds(F.lit(600) + k % 1000 + F.col("_n"))).alias("completed_at"))


def dispatch_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries of the transactions; those with id % 7 = 0 have none."""
    t = dispatch_transactions(spark, sf).filter(F.col("trx_id") % 7 != 0)
    k = F.col("trx_id")
    return t.select(F.col("trx_id").alias("transaction_id"), F.when(k % 5 == 0, "FAILED").otherwise("DELIVERED").alias("delivery_status"),
                    F.when(k % 6 != 0, _lat(k)).alias("rider_completion_lat"), F.when(k % 6 != 0, _lng(k)).alias("rider_completion_lng"),
                    (F.col("paid_at") + _seconds(F.lit(200) + k % 77)).alias("out_for_delivery_at"),
                    F.col("completed_at").alias("delivered_at"))


def app_order_detail(spark: SparkSession, sf: str) -> DataFrame:
    """The app's view of a transaction; orders with id % 17 = 0 are unknown there."""
    b = orders_base(spark, sf).filter(F.col("order_id") % 17 != 0)
    return b.select((F.col("order_id") * 10 + 1).alias("transaction_id"), F.col("transaction_date").alias("transaction_datetime"),
                    F.when(F.col("order_id") % 4 == 0, "REFUNDED").otherwise("PAID").alias("latest_transaction_status"),
                    F.concat(F.lit("Customer "), F.col("customer_id").cast("string")).alias("customer_name"),
                    F.concat(F.lit("62"), F.col("customer_id").cast("string")).alias("customer_phone"))


def vouchers(spark: SparkSession, sf: str) -> DataFrame:
    """Membership vouchers: one per order, active from its date on."""
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("active_at"))


def routes_between(points: DataFrame) -> DataFrame:
    """A route table for distinct pairs of points: 1.3 x the great-circle distance; every 11th pair is absent."""
    key = F.rint((F.col("lat1") + F.col("lat2")) * 10000).cast("bigint")
    d = haversine("lat1", "lng1", "lat2", "lng2")
    return (points.filter(F.col("lat1").isNotNull() & F.col("lat2").isNotNull()).distinct().filter(key % 11 != 0)
            .withColumn("distance_m", np_round(d * 1.3, 2)).withColumn("duration_s", np_round(d / 5, 1)).withColumn("source", F.lit("TABLE")))


# --- commission -----------------------------------------------------------------------------------------------------

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _segment_number():
    n = None
    for i, name in enumerate(SEGMENTS, 1):
        n = F.when(F.col("c_mktsegment") == name, i) if n is None else n.when(F.col("c_mktsegment") == name, i)
    return n


def rider_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer (as rider) and order day; the scheme follows the market segment, some riders have none."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    k = F.col("o_custkey")
    price = lambda p: money_sum(F.when(F.col("o_orderpriority").isin(*p), F.col("o_totalprice")))
    days = o.groupBy("o_custkey", F.to_date("o_orderdate").alias("transaction_date")).agg(
        price(["1-URGENT", "2-HIGH"]).alias("total_price_after_discount_cash"), price(["3-MEDIUM", "5-LOW"]).alias("total_price_after_discount_qris"),
        price(["4-NOT SPECIFIED"]).alias("total_price_after_discount_app"), F.count(F.lit(1)).alias("total_item_qty"))
    scheme = _segment_number()
    return days.join(c, k == F.col("c_custkey")).select(
        k.alias("rider_id"), "transaction_date", F.concat(F.when(k % 5 == 0, "BLITZ").when(k % 5 == 1, "HMS").otherwise("JW"), k.cast("string")).alias("rider_code"),
        F.when(F.year("transaction_date") < 1998, _code("c_nationkey")).otherwise("H1").alias("hub_code"),
        *[F.col(x) for x in ("total_price_after_discount_cash", "total_price_after_discount_qris", "total_price_after_discount_app", "total_item_qty")],
        F.when(k % 19 != 0, F.concat(scheme.cast("string"), F.lit(".0"))).alias("commission_scheme_id"),
        F.when(k % 4 != 0, (1 + k % 3).cast("string")).alias("commission_extra_scheme_id"),
        F.when(k % 3 == 0, "product_sold").otherwise("daily_sales").alias("commission_extra_type"),
        F.when(k % 23 == 0, fv.FRANCHISE_MODEL).when(F.col("c_nationkey") % 3 != 0, fv.OWNED_MODEL).otherwise("-").alias("ownership_status"))


def rider_day_products(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as products sold by a rider on a day."""
    line, o = table(spark, sf, "lineitem"), table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    df = line.join(o, line.l_orderkey == o.o_orderkey).join(p, line.l_partkey == p.p_partkey)
    return df.select(F.col("o_custkey").alias("rider_id"), F.to_date("o_orderdate").alias("transaction_date"), F.col("l_partkey").alias("product_id"),
                     F.col("p_brand").alias("sku_code"), F.when(F.col("l_partkey") % 6 != 0, F.concat(F.lit("S"), F.col("l_partkey").cast("string"))).alias("short_code"),
                     F.col("p_name").alias("product_name"), F.col("p_retailprice").alias("product_price"), F.col("l_quantity").cast("bigint").alias("qty"),
                     F.col("l_extendedprice").alias("total_price"), (F.col("l_extendedprice") * F.col("l_discount")).alias("total_bundling_discount"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("total_price_after_discount"))


def schemes(spark: SparkSession) -> DataFrame:
    """Commission schemes 1-5 (configuration)."""
    i = F.col("id")
    return spark.range(1, 6).select(i.cast("string").alias("id"), F.when(i.isin(1, 4), "weekly_sales").when(i == 3, "product_sold").otherwise("daily_sales").alias("type"),
                                    (i * 10000).cast("double").alias("attendance_commission_in_idr"), F.when(i.isin(2, 5), i.cast("double")).alias("daily_commission_in_percentage"))


def extra_schemes(spark: SparkSession) -> DataFrame:
    """Extra schemes 1-3 (configuration)."""
    i = F.col("id")
    return spark.range(1, 4).select(i.cast("string").alias("id"), F.when(i == 1, "product_sold").otherwise("daily_sales").alias("type"),
                                    (i * 500).cast("double").alias("attendance_commission_in_idr"), F.when(i > 1, (i / 4).cast("double")).alias("daily_commission_in_percentage"))


def tiers(spark: SparkSession) -> DataFrame:
    """Weekly tiers of schemes 1 and 4 (configuration): width 500,000, touching in scheme 1, with gaps in scheme 4."""
    n = F.col("id") % 8
    scheme = F.when(F.col("id") < 8, 1).otherwise(4)
    return spark.range(0, 16).select(F.col("id"), scheme.cast("string").alias("commission_scheme_id"), (n * 500000).cast("double").alias("start_range"),
                                     F.when(scheme == 1, (n + 1) * 500000).otherwise(n * 500000 + 400000).cast("double").alias("end_range"),
                                     (n + 1).cast("int").alias("tier"), (n + 2).cast("double").alias("commission_in_percentage"),
                                     F.when(n % 2 == 0, (n * 1000).cast("double")).alias("attendance_commission_in_idr"))


def product_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Amount per piece of schemes 3 and 2 by brand; brands ending in 7 have none."""
    b = table(spark, sf, "part").select("p_brand").distinct().filter(~F.col("p_brand").endswith("7"))
    return b.select(F.explode(F.array(F.lit("3"), F.lit("2"))).alias("commission_scheme_id"), F.col("p_brand").alias("sku_code"),
                    (F.length("p_brand") * 100).cast("double").alias("commission_in_idr"))


def extra_product_rates(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "part").select("p_brand").distinct().filter(~F.col("p_brand").endswith("1"))
    return b.select(F.lit("1").alias("commission_extra_scheme_id"), F.col("p_brand").alias("sku_code"), F.lit(25.0).alias("commission_in_idr"))
