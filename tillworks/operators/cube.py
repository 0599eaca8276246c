"""One fold of headers by hour, outlet and payment name, from which every sales summary is rolled up.

Sums are kept as exact partial sums, and the distinct orders of a group as a bitmap: one row per word of 64 order numbers, its bits the
orders seen. Bitmaps of the same word merge with ``bit_or``, so distinct orders stay exact from hour to day, channel and
company, and a hot outlet is spread over its words. (Words of 32,768 numbers, as ``bitmap_construct_agg`` makes them, take 4 KB
for each bucket that an outlet's hour touches, however few its orders.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks import fixed_values as fv
from tillworks.functions.scalars import lookup, merged_money, money_state
from tillworks.operators.summaries import ATTRIBUTES, CALENDAR, HEADER_SUMS, _dated_sums, valid_sales

CUBE_KEYS = ["_day", "transaction_hour", "outlet_code", "payment_type"]


def header_cube(headers: DataFrame, order_id: str = "order_id") -> DataFrame:
    """(day, hour, outlet, payment name, word of order numbers) with the orders' bits and money states. Order ids must be whole numbers; an
    order without an id has sums only."""
    if not isinstance(headers.schema[order_id].dataType, T.IntegralType):
        raise TypeError(f"{order_id} must be a whole number to be a place in a bitmap")
    number = F.col(order_id).cast("bigint")
    rows = valid_sales(headers).select(
        F.to_date("transaction_date").alias("_day"), F.hour("transaction_date").alias("transaction_hour"), "outlet_code", "payment_type",
        F.shiftright(number, 6).alias("word"), F.expr(f"shiftleft(1L, cast(`{order_id}` & 63 as int))").alias("bit"),
        *[F.col(c).alias(f"_{n}") for n, c in HEADER_SUMS.items()])
    return rows.groupBy(*CUBE_KEYS, "word").agg(F.bit_or("bit").alias("orders"), *[money_state(f"_{n}").alias(n) for n in HEADER_SUMS])


def rolled_up(cube: DataFrame, keys: list[str]) -> DataFrame:
    """The cube by fewer keys (or expressions named so before): money states and ``total_order``."""
    merged = [merged_money(n).alias(n) for n in HEADER_SUMS]
    words = cube.groupBy(*keys, "word").agg(F.bit_or("orders").alias("orders"), *merged)
    return words.groupBy(*keys).agg(*merged, F.coalesce(F.sum(F.bit_count("orders")).cast("bigint"), F.lit(0)).alias("total_order"))


def daily_from_cube(cube: DataFrame, dimension: DataFrame, how: str = "left") -> DataFrame:
    """As :func:`tillworks.operators.summaries.daily_transactions`."""
    return _dated_sums(rolled_up(cube, ["_day", "outlet_code"]), dimension, [], how)


def hourly_from_cube(cube: DataFrame, dimension: DataFrame, how: str = "inner") -> DataFrame:
    """As :func:`tillworks.operators.summaries.hourly_transactions`."""
    hour = ["transaction_hour"]
    return _dated_sums(rolled_up(cube, ["_day", "outlet_code", *hour]), dimension, hour, how)


def sales_type_from_cube(cube: DataFrame, dimension: DataFrame, how: str = "inner", channels: dict[str, str] = fv.SUMMARY_CHANNELS) -> DataFrame:
    """As :func:`tillworks.operators.summaries.daily_sales_type`."""
    cube = cube.withColumn("_channel", lookup("payment_type", channels, F.lit(fv.WALK_IN))).withColumn("_payment", F.col("payment_type"))
    extra = ["_channel", "_payment"]
    df = _dated_sums(rolled_up(cube, ["_day", "outlet_code", *extra]), dimension, extra, how)
    return df.select(*CALENDAR, "outlet_code", F.upper("_channel").alias("sales_type"), F.upper("_payment").alias("payment_method"),
                     F.concat("_channel", "_payment").alias("sales_type_payment_method"), *ATTRIBUTES, *HEADER_SUMS, "total_order")


def company_days_from_cube(cube: DataFrame) -> DataFrame:
    """Money states and distinct orders per day over all outlets: an order with headers at two outlets counts once."""
    return rolled_up(cube, ["_day"])
