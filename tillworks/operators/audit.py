"""Checks between tables and before/after a load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions.scalars import four_hour_block, money_sum, money_total, np_round, ratio
from tillworks.functions.skew import first_per_key, join_per_key, side_by_side

TOLERANCE = 0.01
OFF_BY = 0.01


def unfulfilled_orders(headers: DataFrame, outlets: DataFrame) -> DataFrame:
    """Paid orders that are not fulfilled, one row per day, outlet and order."""
    names = outlets.select("jilid", F.col("customer_name").alias("outlet_name")).distinct()
    open_ = headers.filter((F.col("fulfillment_status") == "none") & (F.col("payment_status") == "paid"))
    per_order = (open_.groupBy(F.to_date("transaction_date").alias("date"), "outlet_code", "order_id")
                 .agg(money_sum("total_amount").alias("total_amount")))
    return (per_order.join(names, F.col("outlet_code") == F.col("jilid"), "left").drop("jilid")
            .withColumn("outlet_name", F.coalesce("outlet_name", F.lit("-"))))


def unfulfilled_by_outlet(orders: DataFrame) -> DataFrame:
    """Distinct open orders and their money per outlet and day."""
    return (orders.groupBy("outlet_code", "outlet_name", "date")
            .agg(F.countDistinct("order_id").alias("total_orders_unfulfilled"),
                 money_sum("total_amount").alias("total_amount")).orderBy("date", "outlet_code"))


def fulfillment_outcome(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Open orders split into those whose details have arrived and those still open."""
    arrived = details.select("order_id").distinct().withColumn("_done", F.lit(True))
    df = join_per_key(orders, arrived, ["order_id"])
    return (df.groupBy(F.when(F.col("_done"), "fulfilled").otherwise("unfulfilled").alias("outcome"))
            .agg(F.countDistinct("order_id").alias("total_orders"), money_sum("total_amount").alias("total_amount")))


def before_after(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """Sum of each column before and after a load, with the difference."""
    def sums(df: DataFrame, name: str) -> DataFrame:
        one = df.agg(*[money_total(c).alias(c) for c in columns])
        return one.unpivot([], columns, "column_name", name)
    return (sums(before, "before").join(sums(after, "after"), "column_name")
            .withColumn("difference", np_round(F.col("after") - F.col("before"), 4)))


def parity_by_date(new: DataFrame, stored: DataFrame, columns: list[str], date: str = "transaction_date") -> DataFrame:
    """Rows and sums per date, computed against stored; a date on one side only or off by more than 0.01 does not match."""
    def sums(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(F.to_date(date).alias("date")).agg(F.count(F.lit(1)).cast("double").alias(f"rows_{side}"),
                                                             *[money_total(c).alias(f"{c}_{side}") for c in columns])
    both = sums(new, "new").join(sums(stored, "stored"), "date", "full_outer")
    same = [F.coalesce(F.abs(F.col(f"{c}_new") - F.col(f"{c}_stored")) <= TOLERANCE, F.lit(False)) for c in ["rows", *columns]]
    return both.withColumn("matches", reduce(lambda a, b: a & b, same))


def missing_columns(new: DataFrame, stored: DataFrame) -> list[str]:
    """Columns a load would write that the target does not have."""
    return [c for c in new.columns if c not in stored.columns]


def outlet_report(headers: DataFrame, outlet: str | None = None) -> DataFrame:
    """Orders and money per day with a grand total (NULL date), for one outlet or all."""
    df = headers if outlet is None else headers.filter(F.col("outlet_code") == outlet)
    return (df.select(F.to_date("transaction_date").alias("transaction_date"), "order_id", "total_amount")
            .rollup("transaction_date").agg(F.count("order_id").alias("total_order_count"), money_sum("total_amount").alias("total_amount"))
            .orderBy(F.col("transaction_date").asc_nulls_last()))


def intraday_metrics(headers: DataFrame, details: DataFrame) -> DataFrame:
    """One row: outlets, orders, money of both tables, open orders and the last load time."""
    h = headers.agg(F.countDistinct("outlet_code").alias("table_outlets"), F.countDistinct("order_id").alias("table_orders"),
                    money_total("total_amount").alias("amount_headers"),
                    F.countDistinct(F.when(F.col("fulfillment_status") == "none", F.col("order_id"))).alias("orders_unfulfilled"),
                    F.max("load_data_at").alias("last_load"))
    d = details.agg(money_total("total_amount").alias("amount_details"))
    return side_by_side(h, d)


def header_detail_ratio(headers: DataFrame, details: DataFrame, off_by: float = OFF_BY) -> DataFrame:
    """Details ÷ header per order over sale rows of orders in both tables; ``is_off`` beyond the tolerance."""
    sale = lambda df: df.filter(F.col("transactions_type") == "sale")
    unique = first_per_key(sale(headers).select("order_id", "transaction_id", "total_amount"), ["order_id", "transaction_id"], ["total_amount"])
    h = unique.groupBy("order_id").agg(money_total("total_amount").alias("header_total"))
    d = sale(details).groupBy("order_id").agg(money_total("total_amount").alias("details_total"))
    df = h.join(d, "order_id").withColumn("ratio", ratio("details_total", "header_total"))
    return df.withColumn("is_off", F.coalesce(F.abs(F.col("ratio") - 1) > off_by, F.lit(False)))


def overall_ratio(per_order: DataFrame) -> DataFrame:
    """Orders compared, orders off and the ratio of the sums."""
    return per_order.agg(F.count(F.lit(1)).alias("n_orders"), F.count_if("is_off").alias("n_off"),
                         ratio(money_sum("details_total"), money_sum("header_total")).alias("total_ratio"))


def accuracy_by_date(headers_raw: DataFrame, details_raw: DataFrame, headers_clean: DataFrame, details_clean: DataFrame,
                     date: str = "transaction_date") -> DataFrame:
    """Money per day of four tables side by side (0 where a table has none), a TOTAL row and clean details ÷ clean headers.

    The four tables are stacked and added up in one pass instead of three outer joins.
    """
    names = ["headers_raw", "details_raw", "headers_clean", "details_clean"]
    parts = [df.select(F.to_date(date).alias("day"), F.lit(i).alias("part"), F.col("total_amount").alias("amount"))
             for i, df in enumerate([headers_raw, details_raw, headers_clean, details_clean])]
    stacked = reduce(lambda a, b: a.unionByName(b), parts).filter(F.col("day").isNotNull())
    sums = stacked.rollup("day").agg(*[money_total(F.when(F.col("part") == i, F.col("amount"))).alias(n)
                                       for i, n in enumerate(names)])
    return sums.select(F.coalesce(F.date_format("day", "yyyy-MM-dd"), F.lit("TOTAL")).alias("day"), *names,
                       np_round(ratio("details_clean", "headers_clean") * 100, 3).alias("acc_details_pct"))


def accuracy_split(headers: DataFrame, details: DataFrame) -> DataFrame:
    """Header and detail money for orders with details, open orders without (expected) and others without (suspicious)."""
    sums = details.groupBy("order_id").agg(money_sum("total_amount").alias("_details"))
    df = join_per_key(headers, sums.withColumn("_has", F.lit(True)), ["order_id"])
    kind = (F.when(F.col("_has"), "with_details").when(F.col("fulfillment_status") == "none", "unfulfilled_without_details")
            .otherwise("other_without_details"))
    rows = df.groupBy(kind.alias("kind")).agg(F.countDistinct("order_id").alias("orders"), money_sum("total_amount").alias("amount_headers"))
    known = join_per_key(sums, headers.select("order_id").distinct(), ["order_id"], "left_semi")
    total = known.agg(money_sum("_details").alias("amount_details")).withColumn("kind", F.lit("with_details"))
    both = rows.unionByName(total, allowMissingColumns=True).groupBy("kind").agg(
        *[F.max(c).alias(c) for c in ("orders", "amount_headers", "amount_details")]).filter(F.col("orders").isNotNull())
    return both.withColumn("accuracy_pct", np_round(ratio("amount_details", "amount_headers") * 100, 3))


# --- completeness ---------------------------------------------------------------------------------------------------

TX_KEY = ["order_id", "transaction_id"]


def presence(a: DataFrame, b: DataFrame) -> DataFrame:
    """Transactions of both sides, each once, with flags where they were seen and side A's outlet and time."""
    left = first_per_key(a.select(*TX_KEY, "outlet_code", "transaction_date"), TX_KEY, ["transaction_date", "outlet_code"])
    right = b.select(*TX_KEY).distinct().withColumn("_b", F.lit(True))
    both = left.withColumn("_a", F.lit(True)).join(right, TX_KEY, "full_outer")
    return both.withColumn("in_a", F.col("_a").isNotNull()).withColumn("in_b", F.col("_b").isNotNull()).drop("_a", "_b")


def presence_counts(p: DataFrame) -> DataFrame:
    """How many transactions are in both, in A only and in B only."""
    return p.agg(F.count_if(F.col("in_a") & F.col("in_b")).alias("in_both"), F.count_if(F.col("in_a") & ~F.col("in_b")).alias("only_a"),
                 F.count_if(~F.col("in_a") & F.col("in_b")).alias("only_b"))


def missing_blocks(p: DataFrame) -> DataFrame:
    """Transactions of A that B lacks, per outlet and 4-hour block, most first."""
    return (p.filter(F.col("in_a") & ~F.col("in_b")).groupBy("outlet_code", four_hour_block("transaction_date").alias("block"))
            .agg(F.count(F.lit(1)).alias("n_missing")).orderBy(F.desc("n_missing"), "outlet_code", "block"))


def top_missing_blocks(p: DataFrame, k: int = 30) -> DataFrame:
    return missing_blocks(p).limit(k)


def key_except(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of A that B does not have."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")
