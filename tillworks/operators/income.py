"""Estimated income of landlord outlets: per day and payment type, per order, checks between the two."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import fixed_values as fv
from tillworks.functions.scalars import as_name, casefold, col, lookup, money_sum, money_total, strip
from tillworks.functions.skew import with_group
from tillworks.operators.summaries import paid_and_fulfilled

MONEY_CHECK = ["subtotal", "tax_amount", "total_sales", "sales_type_commission"]
TOLERANCE = 0.01


def completed_sales(headers: DataFrame, outlets: Iterable[str] | None = None) -> DataFrame:
    """Paid, fulfilled, successful and completed rows, of the given outlets only when a list is given."""
    df = headers.filter(paid_and_fulfilled(status=True))
    return df if outlets is None else df.filter(F.col("outlet_code").isin(*outlets))


def normalize_payment_type(raw, table: dict[str, str] = fv.PAYMENT_TYPES) -> Column:
    """Official payment type: looked up trimmed and case-insensitively; unknown -> trimmed, NULL -> 'Unknown'."""
    raw = col(raw)
    return F.when(raw.isNull(), F.lit(fv.UNKNOWN_PAYMENT_TYPE)).otherwise(F.coalesce(lookup(raw, table, fold=True), strip(raw)))


def commission_rate(payment_type, rates: dict[str, float] = fv.COMMISSION_RATES) -> Column:
    """Rate of an official payment type (exact name), 0 when it has none."""
    out = None
    for name, rate in rates.items():
        hit = col(payment_type) == name
        out = F.when(hit, F.lit(rate)) if out is None else out.when(hit, F.lit(rate))
    return out.otherwise(F.lit(0.0))


def daily_income(sales: DataFrame, raw: str = "payment_type_raw") -> DataFrame:
    """Per day, outlet and payment type (ignoring case): money, distinct orders and commission.

    Orders are counted per raw name, as the database tells names apart, and then added, so an order paid with two names of one type counts
    twice.
    """
    day, official = F.to_date("transaction_date"), normalize_payment_type(raw)
    keys = ["date", "outlet_code", "outlet_name", "_type"]
    per_name = (sales.select(day.alias("date"), "outlet_code", "outlet_name", official.alias("_official"),
                             as_name(raw).alias("_raw"), "order_id", "subtotal",
                             F.col("total_tax_amount").alias("tax_amount"), F.col("total_amount").alias("total_sales"))
                .withColumn("_type", casefold("_official"))
                .groupBy(*keys, "_raw")
                .agg(F.min("_official").alias("payment_type"), *[money_sum(c).alias(c) for c in ("subtotal", "tax_amount", "total_sales")],
                     F.countDistinct("order_id").alias("total_order")))
    out = per_name.groupBy(*keys).agg(
        F.min("payment_type").alias("payment_type"),
        *[money_total(c).alias(c) for c in ("subtotal", "tax_amount", "total_sales")],
        F.sum("total_order").alias("total_order"))
    return (out.withColumn("sales_type_commission", F.col("subtotal") * commission_rate("payment_type"))
            .select("date", "outlet_code", "outlet_name", "payment_type", "subtotal", "tax_amount", "total_sales",
                    "total_order", "sales_type_commission"))


def order_income(sales: DataFrame, raw: str = "payment_type_raw") -> DataFrame:
    """Per order and transaction: official payment type, rate and commission."""
    df = (sales.withColumn("payment_type", normalize_payment_type(raw))
          .withColumn("commission_pct", commission_rate("payment_type"))
          .withColumn("sales_type_commission", F.col("subtotal") * F.col("commission_pct")))
    return df.select(F.to_date("transaction_date").alias("date"), "transaction_date", "outlet_code", "outlet_name", "order_id",
                     "transaction_id", "order_reference", F.col(raw).alias("payment_type_raw"), "payment_type",
                     "total_order_amount", "total_discount_amount", "total_promotion_amount", "subtotal",
                     F.col("total_tax_amount").alias("tax_amount"), F.col("total_amount").alias("total_sales"),
                     "commission_pct", "sales_type_commission")


def unmapped_payment_types(income: DataFrame, rates: dict[str, float] = fv.COMMISSION_RATES) -> DataFrame:
    """Sales of payment types without a rate."""
    return (income.filter(~F.col("payment_type").isin(*rates)).groupBy("payment_type")
            .agg(money_total("total_sales").alias("total_sales")).orderBy("payment_type"))


def split_payment_orders(orders: DataFrame) -> DataFrame:
    """All rows of orders that have more than one row."""
    return with_group(orders, ["order_id"], F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).drop("_n")


def reconcile_with_daily(orders: DataFrame, daily: DataFrame) -> DataFrame:
    """Rows where order income and daily income disagree: on one side only, money off by 0.01 or more, other order count."""
    per_order = (orders.filter(F.col("outlet_code").isNotNull() & F.col("payment_type").isNotNull())
                 .groupBy("date", "outlet_code", casefold("payment_type").alias("_type"))
                 .agg(*[money_total(c).alias(f"{c}_order") for c in MONEY_CHECK],
                      F.countDistinct("order_id").cast("double").alias("total_order_order")))
    other = daily.select("date", "outlet_code", casefold("payment_type").alias("_type"),
                         *[F.col(c).cast("double").alias(f"{c}_daily") for c in [*MONEY_CHECK, "total_order"]])
    both = (per_order.withColumn("_in_order", F.lit(True))
            .join(other.withColumn("_in_daily", F.lit(True)), ["date", "outlet_code", "_type"], "full_outer"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    diffs = {c: F.round(zero(f"{c}_order") - zero(f"{c}_daily"), 4) for c in [*MONEY_CHECK, "total_order"]}
    side = (F.when(F.col("_in_daily").isNull(), "order only").when(F.col("_in_order").isNull(), "daily only").otherwise("both"))
    bad = side != "both"
    for c in MONEY_CHECK:
        bad = bad | (F.abs(diffs[c]) >= TOLERANCE)
    bad = bad | (diffs["total_order"] != 0)
    return both.filter(bad).select("date", "outlet_code", F.col("_type").alias("payment_type"), side.alias("side"),
                                   *[d.alias(f"diff_{c}") for c, d in diffs.items()])


def income_pivot(income: DataFrame, buckets: dict[str, str] = fv.DASHBOARD_BUCKETS) -> DataFrame:
    """Per day and outlet name: orders, income per payment bucket (0 where none) and their sum."""
    names = list(dict.fromkeys([*buckets.values(), fv.OTHER_BUCKET]))
    net = F.col("subtotal") - F.coalesce(F.col("sales_type_commission"), F.lit(0.0))
    df = income.select("date", F.coalesce("outlet_name", F.lit("")).alias("outlet_name"), "total_order", net.alias("_net"),
                       F.coalesce(lookup("payment_type", buckets, fold=True), F.lit(fv.OTHER_BUCKET)).alias("_bucket"))
    filled = df.groupBy("date", "outlet_name").agg(
        F.sum("total_order").cast("double").alias("total_order"),
        *[money_total(F.when(F.col("_bucket") == n, F.col("_net"))).alias(n) for n in names])
    total = F.col(names[0])
    for n in names[1:]:
        total = total + F.col(n)
    return filled.withColumn("daily_income", total)


def payment_type_inventory(income: DataFrame) -> DataFrame:
    """Days and sales per outlet and payment type, biggest first within an outlet."""
    return (income.groupBy("outlet_code", "payment_type")
            .agg(F.count(F.lit(1)).alias("days"), money_sum("total_sales").alias("total_sales"))
            .orderBy("outlet_code", F.desc("total_sales")))


def warehouse_vs_lake(income: DataFrame, sales: DataFrame) -> DataFrame:
    """Outlet-days whose order count in the income table differs from the distinct orders of the headers."""
    table = income.groupBy("date", "outlet_code").agg(F.sum("total_order").alias("orders_table"))
    lake = (sales.groupBy(F.to_date("transaction_date").alias("date"), "outlet_code")
            .agg(F.countDistinct("order_id").alias("orders_lake")))
    both = table.join(lake, ["date", "outlet_code"], "left")
    found = F.coalesce(F.col("orders_lake"), F.lit(0))
    return both.filter(F.col("orders_table") != found).withColumn("diff", F.col("orders_table") - found)


def old_new_reconcile(old: DataFrame, new: DataFrame) -> DataFrame:
    """Outlet-days of the old table that are missing from the new one or off by more than 0.01 in any measure."""
    measures = ["total_sales", "subtotal", "tax_amount"]
    sums = new.groupBy("date", "outlet_code").agg(*[money_sum(c).alias(f"new_{c}") for c in measures])
    both = old.join(sums.withColumn("_found", F.lit(True)), ["date", "outlet_code"], "left")
    off = F.col("_found").isNull()
    for c in measures:
        off = off | F.coalesce(F.abs(F.col(f"new_{c}") - F.col(c)) > TOLERANCE, F.lit(False))
    return both.filter(off).select("date", "outlet_code", *[x for c in measures for x in (
        F.col(c).alias(f"old_{c}"), F.col(f"new_{c}"), F.round(F.col(f"new_{c}") - F.col(c), 4).alias(f"diff_{c}"))])


def commission_reconcile(old: DataFrame, new: DataFrame) -> DataFrame:
    """Outlet-days in both tables whose total commission differs by more than 0.01."""
    sums = new.groupBy("date", "outlet_code").agg(money_sum("sales_type_commission").alias("new_commission"))
    return (old.select("date", "outlet_code", F.col("commission").alias("old_commission")).join(sums, ["date", "outlet_code"])
            .filter(F.abs(F.col("new_commission") - F.col("old_commission")) > TOLERANCE)
            .withColumn("diff", F.round(F.col("new_commission") - F.col("old_commission"), 4)))


