"""Rider commission: per product and day, per day, per week.

Three kinds of scheme: ``weekly_sales`` (tiers on the week's revenue), ``daily_sales`` (a share of the day's revenue) and
``product_sold`` (an amount per piece). Rider-day rows are the finest grain that is joined; product rows are added up first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions.scalars import canonical_id, money_total
from tillworks.functions.skew import bucketed_lead

REVENUE = ["total_price_after_discount_cash", "total_price_after_discount_qris", "total_price_after_discount_app"]
PRODUCT_KEY = ["rider_id", "transaction_date", "product_id", "sku_code", "short_code", "product_name", "product_price"]
PRODUCT_SUMS = ["qty", "total_price", "total_bundling_discount", "total_price_after_discount"]


def canonical_ids(df: DataFrame, *columns: str) -> DataFrame:
    """Id columns as plain text ('12.0' -> '12'); a missing id is the text 'NaN'."""
    return df.select(*[canonical_id(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def whole_id(c: str) -> Column:
    """Canonical id text as a number, 'NaN' as NULL."""
    return F.col(c).try_cast("bigint")


def next_tier_start(tiers: DataFrame, width: float = 1_000_000.0) -> DataFrame:
    """Tiers with the start of the next tier of their scheme; looked up within bands of ``width``."""
    banded = tiers.withColumn("_band", F.floor(F.col("start_range") / width))
    return bucketed_lead(banded, ["commission_scheme_id"], "_band", "start_range", "next_start_range").drop("_band")


def tier_range_join(weekly: DataFrame, tiers: DataFrame) -> DataFrame:
    """Every tier whose range holds the revenue, both ends included: touching tiers give two rows, gaps none."""
    t = next_tier_start(tiers).select(
        F.col("commission_scheme_id").alias("_scheme"), "start_range", "end_range", "tier", "commission_in_percentage",
        "attendance_commission_in_idr", "next_start_range")
    hit = (F.col("commission_scheme_id") == F.col("_scheme")) & F.col("total_revenue").between(F.col("start_range"), F.col("end_range"))
    return weekly.join(t, hit, "left").drop("_scheme")


def revenue(columns: list[str] = tuple(REVENUE)) -> Column:
    out = F.coalesce(F.col(columns[0]), F.lit(0.0))
    for c in columns[1:]:
        out = out + F.coalesce(F.col(c), F.lit(0.0))
    return out


def daily_products(products: DataFrame, summaries: DataFrame, rates: DataFrame, extra_rates: DataFrame) -> DataFrame:
    """Product sales per rider and day with the amount per piece of the scheme and the extra scheme.

    The extra amount counts only while the rider's extra scheme is of the product_sold kind.
    """
    filled = products.na.fill(0).na.fill("0")
    df = filled.groupBy(*PRODUCT_KEY).agg(F.sum("qty").alias("qty"), *[money_total(c).alias(c) for c in PRODUCT_SUMS[1:]])
    days = summaries.select("rider_id", "transaction_date", whole_id("commission_scheme_id").alias("commission_scheme_id"),
                            whole_id("commission_extra_scheme_id").alias("commission_extra_scheme_id"), "commission_extra_type")
    normal = rates.select(F.col("commission_scheme_id").cast("bigint").alias("commission_scheme_id"), "sku_code",
                          F.col("commission_in_idr").alias("commission_per_product_in_idr"))
    extra = extra_rates.select(F.col("commission_extra_scheme_id").cast("bigint").alias("commission_extra_scheme_id"), "sku_code",
                               F.col("commission_in_idr").alias("_extra"))
    df = (df.join(days, ["rider_id", "transaction_date"], "left")
          .join(normal, ["commission_scheme_id", "sku_code"], "left")
          .join(extra, ["commission_extra_scheme_id", "sku_code"], "left"))
    is_extra = F.coalesce(F.col("commission_extra_type") == "product_sold", F.lit(False))
    df = df.withColumn("commission_extra_per_product_in_idr", F.when(is_extra, F.col("_extra")).otherwise(0.0))
    return df.select(*PRODUCT_KEY, *PRODUCT_SUMS,
                     (F.col("qty") * F.col("commission_per_product_in_idr")).alias("total_product_sold_commission"),
                     (F.col("qty") * F.col("commission_extra_per_product_in_idr")).alias("total_product_sold_commission_extra"),
                     "commission_per_product_in_idr", "commission_extra_per_product_in_idr")


def daily_summaries(summaries: DataFrame, schemes: DataFrame, extra_schemes: DataFrame, products: DataFrame,
                    revenue_columns: list[str] = tuple(REVENUE)) -> DataFrame:
    """Commission per rider and day: a share of the revenue, or the products' sum for product_sold schemes."""
    sold = products.groupBy("rider_id", "transaction_date").agg(
        money_total("total_product_sold_commission").alias("_sold"), money_total("total_product_sold_commission_extra").alias("_sold_extra"))

    def terms(df: DataFrame, key: str, suffix: str) -> DataFrame:
        return df.select(
            F.col("id").alias(key), F.col("type").alias(f"_type{suffix}"), F.col("attendance_commission_in_idr").alias(f"attendance_commission{suffix}"),
            F.col("daily_commission_in_percentage").alias(f"daily_sales_commission{suffix}_percentage"))

    df = (summaries.join(terms(schemes, "commission_scheme_id", ""), "commission_scheme_id", "left")
          .join(terms(extra_schemes, "commission_extra_scheme_id", "_extra"), "commission_extra_scheme_id", "left")
          .join(sold, ["rider_id", "transaction_date"], "left"))
    total = revenue(list(revenue_columns))
    share = lambda suffix: total * F.col(f"daily_sales_commission{suffix}_percentage") * 0.01
    by_piece = lambda suffix: F.coalesce(F.col(f"_type{suffix}") == "product_sold", F.lit(False))
    df = (df.withColumn("daily_commission", F.when(by_piece(""), F.col("_sold")).otherwise(share("")))
          .withColumn("daily_commission_extra", F.when(by_piece("_extra"), F.col("_sold_extra")).otherwise(share("_extra"))))
    return df.select(
        *[c for c in summaries.columns if c not in ("commission_scheme_id", "commission_extra_scheme_id")],
        whole_id("commission_scheme_id").alias("commission_scheme_id"), whole_id("commission_extra_scheme_id").alias("commission_extra_scheme_id"),
        "attendance_commission", "attendance_commission_extra", "daily_commission", "daily_commission_extra",
        "daily_sales_commission_percentage", "daily_sales_commission_extra_percentage")


def weekly_facts(summaries: DataFrame, revenue_columns: list[str] = tuple(REVENUE)) -> DataFrame:
    """Per rider and hub: revenue, operating days and the scheme of the last day (of several rows on it the largest id)."""
    keys = ["rider_id", "rider_code", "hub_code"]
    df = summaries
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    sums = [money_total(c).alias(c) for c in revenue_columns]
    out = df.groupBy(*keys).agg(*sums, F.countDistinct("transaction_date").alias("total_operating_days"),
                                F.max_by("commission_scheme_id", F.struct("transaction_date", "commission_scheme_id")).alias("commission_scheme_id"))
    return out.withColumn("total_revenue", revenue(list(revenue_columns))).drop(*revenue_columns)


def weekly_summaries(summaries: DataFrame, schemes: DataFrame, tiers: DataFrame, daily: DataFrame, start: str, end: str,
                     revenue_columns: list[str] = tuple(REVENUE)) -> DataFrame:
    """Commission per rider and hub for the whole window.

    Weekly schemes pay by tier; the others take the sum of the daily rows. That sum is per rider, so a rider with two hubs
    gets the rider's total on both rows.
    """
    df = tier_range_join(weekly_facts(summaries, revenue_columns), tiers)
    kinds = schemes.select(F.col("id").alias("commission_scheme_id"), F.col("type").alias("_type"))
    df = df.join(kinds, "commission_scheme_id", "left")
    sums = daily.groupBy("rider_id").agg(
        money_total("daily_commission").alias("_commission"), money_total("attendance_commission").alias("_attendance"),
        money_total("daily_commission_extra").alias("total_commission_extra"),
        money_total("attendance_commission_extra").alias("total_attendance_commission_extra"))
    df = df.join(sums, "rider_id", "left")
    by_day = F.coalesce(F.col("_type").isin("daily_sales", "product_sold"), F.lit(False))
    tier_pay = F.coalesce(F.col("total_revenue") * F.col("commission_in_percentage") * 0.01, F.lit(0.0))
    tier_attendance = F.col("total_operating_days") * F.coalesce(F.col("attendance_commission_in_idr"), F.lit(0.0))
    return df.select(
        "rider_id", F.to_date(F.lit(start)).alias("start_date"), F.to_date(F.lit(end)).alias("end_date"), "rider_code", "hub_code",
        "total_revenue", "total_operating_days", F.coalesce(F.col("_type") == "weekly_sales", F.lit(False)).alias("is_weekly_commission"),
        F.nullif("commission_scheme_id", F.lit("NaN")).alias("weekly_commission_scheme_id"),
        F.col("commission_in_percentage").alias("current_weekly_commission_percentage"), F.col("tier").alias("current_commission_tier"),
        F.col("next_start_range").alias("next_revenue_target"),
        F.when(by_day, F.col("_commission")).otherwise(tier_pay).alias("total_commission"),
        F.when(by_day, F.col("_attendance")).otherwise(tier_attendance).alias("total_attendance_commission"),
        "total_commission_extra", "total_attendance_commission_extra")


def force_scheme(summaries: DataFrame, schemes: DataFrame, tiers: DataFrame) -> DataFrame:
    """Put every rider on the first tiered scheme (lowest id). Without schemes or tiers the job raises when it runs.

    The two configuration values are scalar subqueries, so nothing runs while the plan is built.
    """
    tier = tiers.agg(F.min_by("commission_scheme_id", F.struct("id", "commission_scheme_id"))).scalar()
    kind = schemes.agg(F.min_by("type", "id")).scalar()
    known = lambda value: F.coalesce(value, F.raise_error(F.lit("no commission scheme or no tiers")))
    return summaries.withColumn("commission_scheme_id", known(tier)).withColumn("commission_type", known(kind))


def check_week(start: str, end: str) -> None:
    """Gate: the window is one week, Monday to Sunday."""
    from datetime import date, timedelta

    monday = date.fromisoformat(start)
    if monday.weekday() != 0 or date.fromisoformat(end) != monday + timedelta(days=6):
        raise ValueError(f"{start}..{end} is not a Monday-to-Sunday week")


