"""Daily and hourly sales summaries.

Order rows are folded to (date, outlet, ...) before the outlet attributes are looked up: the attributes depend on date and
outlet only, so the join touches summary rows instead of order rows and needs neither a broadcast nor a shuffle of the fact
table by outlet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import fixed_values as fv
from tillworks.functions.scalars import lookup, merged_money, money_state, money_sum, money_value, week_from_monday, zero_pad
from tillworks.functions.skew import first_per_key
from tillworks.operators.outlets import ATTRIBUTES, with_outlet

HEADER_SUMS = {
    "total_gross_sales": "total_order_amount",
    "total_discount_amount": "total_discount_amount",
    "total_promotion_amount": "total_promotion_amount",
    "total_net_sales": "subtotal",
    "total_taxes": "total_tax_amount",
    "total_collected": "total_amount",
}
ITEM_SUMS = {
    "total_quantity": "quantity",
    "total_gross_sales": "total_order_amount",
    "total_discount_amount": "discount_amount",
    "total_promotion_amount": "promotion_amount",
    "total_net_sales": "subtotal",
    "total_taxes": "tax_amount",
    "total_collected": "total_amount",
}
CALENDAR = ["transaction_date", "week", "month", "year"]


def paid_and_fulfilled(status: bool = False) -> Column:
    """Paid, fulfilled and successful; with ``status`` the order must be completed too."""
    keep = ((F.col("payment_status") == "paid") & (F.col("fulfillment_status") == "fulfilled")
            & (F.col("transactions_status") == "success"))
    return keep & (F.col("status") == "completed") if status else keep


def not_app_sale(label: str = fv.APP_CHANNEL) -> Column:
    """sales_type does not contain the app channel's name in any case; a NULL sales_type is dropped too."""
    return ~F.contains(F.lower("sales_type"), F.lit(label.lower()))


def valid_sales(headers: DataFrame) -> DataFrame:
    return headers.filter(paid_and_fulfilled() & not_app_sale())


def _calendar(ts: str) -> list[Column]:
    return [F.to_date(ts).alias("transaction_date"), week_from_monday(ts).alias("week"),
            F.month(ts).alias("month"), F.year(ts).alias("year")]


def _headers_by(headers: DataFrame, dimension: DataFrame, extra: dict[str, Column], how: str) -> DataFrame:
    day = F.to_date("transaction_date")
    keys = {"_day": day, "outlet_code": F.col("outlet_code"), **extra}
    folded = (valid_sales(headers)
              .select(*[c.alias(k) for k, c in keys.items()], "order_id", *[F.col(c).alias(f"_{n}") for n, c in HEADER_SUMS.items()])
              .groupBy(*keys)
              .agg(*[money_state(f"_{n}").alias(n) for n in HEADER_SUMS],
                   F.countDistinct("order_id").alias("total_order")))
    return _dated_sums(folded, dimension, list(extra), how)


def _dated_sums(folded: DataFrame, dimension: DataFrame, extra: list[str], how: str) -> DataFrame:
    """Sums per ``_day``, outlet and more keys with the outlet's attributes of that day."""
    dated = with_outlet(folded, dimension, "_day", how=how)
    group = ["_day", "outlet_code", *extra, *ATTRIBUTES]
    # two dimension rows can end up with equal attributes: their sums add, their distinct orders are the same ones
    merged = dated.groupBy(*group).agg(*[merged_money(n).alias(n) for n in HEADER_SUMS],
                                       F.max("total_order").alias("total_order"))
    return merged.select(*_calendar("_day"), "outlet_code", *extra, *ATTRIBUTES, *[money_value(n).alias(n) for n in HEADER_SUMS], "total_order")


def daily_transactions(headers: DataFrame, dimension: DataFrame, how: str = "left") -> DataFrame:
    """Money sums and distinct orders per day and outlet."""
    return _headers_by(headers, dimension, {}, how)


def hourly_transactions(headers: DataFrame, dimension: DataFrame, how: str = "inner") -> DataFrame:
    """As :func:`daily_transactions` per hour; outlets outside the master are left out."""
    return _headers_by(headers, dimension, {"transaction_hour": F.hour("transaction_date")}, how)


def daily_sales_type(headers: DataFrame, dimension: DataFrame, how: str = "inner",
                     channels: dict[str, str] = fv.SUMMARY_CHANNELS) -> DataFrame:
    """Per day, outlet, channel and payment name; both uppercased, plus their concatenation as spelled."""
    extra = {"_channel": lookup("payment_type", channels, F.lit(fv.WALK_IN)), "_payment": F.col("payment_type")}
    df = _headers_by(headers, dimension, extra, how)
    return df.select(*CALENDAR, "outlet_code", F.upper("_channel").alias("sales_type"),
                     F.upper("_payment").alias("payment_method"),
                     F.concat("_channel", "_payment").alias("sales_type_payment_method"),
                     *ATTRIBUTES, *HEADER_SUMS, "total_order")


def _present(*names: str) -> Column:
    """All keys given: rows with a missing grouping key are left out of these summaries."""
    keep = F.lit(True)
    for n in names:
        keep = keep & F.col(n).isNotNull()
    return keep


def _totals(sums) -> list[Column]:
    """Merged money states as doubles, 0 where there was nothing to add."""
    return [F.coalesce(money_value(n), F.lit(0.0)).alias(n) for n in sums]


def item_lines(details: DataFrame, variant: str | None = None) -> DataFrame:
    """Details in summary columns; a missing variant is '-'."""
    shown = F.coalesce(F.col(variant), F.lit("-")) if variant else F.lit("-")
    return details.select("order_id", "sku", F.col("product_name").alias("item_name"), shown.alias("item_variant_name"),
                          *[F.col(c).alias(n) for n, c in ITEM_SUMS.items()])


def daily_items(headers: DataFrame, details: DataFrame, dimension: DataFrame, filter_details: bool = True,
                variant: str | None = None) -> DataFrame:
    """Items per day and outlet; an order with headers on several (day, outlet) pairs counts once for each of them.

    Details are shuffled once, by order for the join, and folded right after it. Both join sides come straight out of their
    shuffles, so a hot order is split. ``filter_details`` keeps paid, successful, non-app details only.
    """
    if filter_details:
        details = details.filter((F.col("payment_status") == "paid") & (F.col("transactions_status") == "success")
                                 & not_app_sale())
    orders = valid_sales(headers).select("order_id", F.to_date("transaction_date").alias("_day"), "outlet_code").distinct()
    keys = ["_day", "outlet_code", "sku", "item_name", "item_variant_name"]
    folded = (orders.join(item_lines(details, variant), "order_id").groupBy(*keys)
              .agg(*[money_state(n).alias(n) for n in ITEM_SUMS]))
    dated = with_outlet(folded, dimension, "_day").withColumn("jilid", zero_pad("outlet_code"))
    group = ["_day", "jilid", *ATTRIBUTES, "sku", "item_name", "item_variant_name"]
    return (dated.filter(_present(*group)).groupBy(*group)
            .agg(*[merged_money(n).alias(n) for n in ITEM_SUMS])
            .select(*_calendar("_day"), *group[1:], *_totals(ITEM_SUMS)))


def _bundle_lines(details: DataFrame) -> DataFrame:
    return (details.filter((F.col("bundling_id") != "") & (F.col("type") == fv.BUNDLE_TYPE))
            .withColumn("bundling_name", F.col("product_generic_name")))


def bundle_qty(details: DataFrame) -> DataFrame:
    """Bundles sold per order: component rows of one detail collapse to one before adding."""
    unique = _bundle_lines(details).select("order_id", "order_detail_id", "bundling_id", "bundling_name", "quantity").distinct()
    return unique.groupBy("order_id", "bundling_name").agg(money_sum("quantity").alias("quantity"))


def bundle_amount(details: DataFrame) -> DataFrame:
    """Bundle money per order: all component rows added."""
    return _bundle_lines(details).groupBy("order_id", "bundling_name").agg(money_sum("total_amount").alias("total_amount"))


def one_header_per_order(headers: DataFrame, order: str = "transaction_id") -> DataFrame:
    """First header of each order, so that a split payment does not multiply its details."""
    return first_per_key(headers, ["order_id"], [order])


def daily_bundlings(headers: DataFrame, details: DataFrame, dimension: DataFrame,
                    channels: dict[str, str] = fv.SUMMARY_CHANNELS) -> DataFrame:
    """Bundles per day, outlet, channel, payment and bundle."""
    sold = bundle_qty(details).join(bundle_amount(details), ["order_id", "bundling_name"])
    paid = headers.filter(paid_and_fulfilled()).select("order_id", "transaction_id", "transaction_date", "outlet_code", "payment_type")
    one = (one_header_per_order(paid)
           .select("order_id", F.to_date("transaction_date").alias("_day"), "outlet_code",
                   F.upper(lookup("payment_type", channels, F.lit(fv.WALK_IN))).alias("sales_type"),
                   F.col("payment_type").alias("payment_method")))
    keys = ["_day", "outlet_code", "sales_type", "payment_method", "bundling_name"]
    sums = ["quantity", "total_amount"]
    folded = (sold.join(one, "order_id").groupBy(*keys)
              .agg(*[money_state(n).alias(n) for n in sums]))
    dated = with_outlet(folded, dimension, "_day").withColumn("jilid", zero_pad("outlet_code"))
    group = ["_day", "jilid", *ATTRIBUTES, "sales_type", "payment_method", "bundling_name"]
    return (dated.filter(_present(*group)).groupBy(*group).agg(*[merged_money(n).alias(n) for n in sums])
            .select(*_calendar("_day"), *group[1:], *_totals(sums)))


COMPANY_COLUMNS = [*CALENDAR, "jilid", "outlet_name", "ownership_model", "outlet_brand", "region", "provinsi", "kota"]
COMPANY_SUMS = ["total_gross_sales", "total_discount", "total_net_sales", "total_taxes", "total_collected", "total_order"]


def companywide_part(daily: DataFrame, label: str, hour: bool = False) -> DataFrame:
    """A daily (hourly) outlet summary in company-wide columns: discount and promotion become one."""
    dates = [*CALENDAR, *(["transaction_hour"] if hour else [])]
    return daily.select(
        *dates, F.lpad("outlet_code", 5, "0").alias("jilid"), *COMPANY_COLUMNS[5:], "total_gross_sales",
        (F.col("total_discount_amount") + F.col("total_promotion_amount")).alias("total_discount"),
        "total_net_sales", "total_taxes", "total_collected",
        F.col("total_order").cast("double").alias("total_order"), F.lit(label).alias("datasource"))


def franchise_part(daily: DataFrame) -> DataFrame:
    """The franchise outlets' part of the company-wide table; missing numbers become 0."""
    part = companywide_part(daily.filter(F.col("ownership_model") == fv.FRANCHISE_MODEL), fv.SOURCE_LABELS[3])
    return part.na.fill(0, COMPANY_SUMS)


def refund_corrected(source: DataFrame, label: str, hour: bool = False) -> DataFrame:
    """Legacy source: every refund was booked as two orders, so orders = sum(orders) - sum(refunds * 2)."""
    dates = ["transaction_date", *(["transaction_hour"] if hour else [])]
    group = [*dates, "outlet_code", *COMPANY_COLUMNS[5:]]
    folded = source.groupBy(*group).agg(
        *[money_sum(c).alias(c) for c in COMPANY_SUMS[:-1]],
        (F.sum("total_order") - F.sum(F.col("total_refund_order") * 2)).cast("double").alias("total_order"))
    return folded.select(*_calendar("transaction_date"), *dates[1:], F.col("outlet_code").alias("jilid"),
                         *COMPANY_COLUMNS[5:], *COMPANY_SUMS, F.lit(label).alias("datasource"))


def companywide(parts: list[DataFrame]) -> DataFrame:
    """UNION (distinct rows) of the sources; missing numbers become 0."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct().na.fill(0, COMPANY_SUMS)


def daily_items_sales_type(headers: DataFrame, details: DataFrame, dimension: DataFrame, app_items: DataFrame,
                           gross_factor: float = 1.1) -> DataFrame:
    """Items per day, outlet and channel (one header per order, gross with tax), plus the app's own item summary."""
    per_order = (item_lines(details).groupBy("order_id", "sku", "item_name")
                 .agg(money_sum("total_quantity").alias("total_quantity"),
                      (money_sum("total_gross_sales") * gross_factor).alias("total_gross_sales"),
                      money_sum("total_collected").alias("total_collected")))
    one = (one_header_per_order(valid_sales(headers).select("order_id", "transaction_id", "transaction_date", "outlet_code", "sales_type"))
           .select("order_id", F.to_date("transaction_date").alias("transaction_date"), "outlet_code",
                   F.col("sales_type").alias("sales_type_name")))
    sums = ["total_quantity", "total_gross_sales", "total_collected"]
    keys = ["transaction_date", "outlet_code", "sales_type_name", "sku", "item_name"]
    folded = (one.join(per_order, "order_id").groupBy(*keys)
              .agg(*[money_state(n).alias(n) for n in sums]))
    dated = with_outlet(folded, dimension, "transaction_date").withColumn("jilid", zero_pad("outlet_code"))
    group = ["transaction_date", "jilid", "ownership_model", "outlet_name", "sales_type_name", "sku", "item_name"]
    stored = dated.filter(_present(*group)).groupBy(*group).agg(*[merged_money(n).alias(n) for n in sums]).select(*group, *_totals(sums))
    app = (app_items.filter((F.col("ownership_model") == fv.OWNED_MODEL) & F.col("transaction_date").isNotNull())
           .groupBy("transaction_date", F.col("outlet_code").alias("jilid"), "outlet_name", "sku",
                    F.col("product_name").alias("item_name"))
           .agg(money_sum("total_quantity").alias("total_quantity"), money_sum("total_gross_sales").alias("total_gross_sales"),
                money_sum("total_net_sales").alias("total_collected"))
           .withColumn("ownership_model", F.lit(fv.OWNED_MODEL)).withColumn("sales_type_name", F.lit(fv.SOURCE_LABELS[1])))
    return stored.unionByName(app)
