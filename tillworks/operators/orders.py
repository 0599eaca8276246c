"""Operators on order headers and details in table form."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import fixed_values as fv
from tillworks.functions.scalars import lookup, money_sum
from tillworks.functions.skew import first_per_key, join_per_key, with_group

HEADER_MONEY = ["total_order_amount", "total_discount_amount", "total_promotion_amount", "subtotal",
                "total_tax_amount", "total_amount"]


# --- split payments -------------------------------------------------------------------------------------------------

def _is_sale() -> Column:
    return (F.col("transactions_type") == "sale") & (F.col("transactions_status") == "success")


def with_payment_facts(headers: DataFrame, amount: str = "tx_amount", pos: str = "pos") -> DataFrame:
    """Per row: is it a ghost, is its order really split, its share and whether it carries the details.

    Everything follows from one aggregate per order (no window): with any positive sale only positive sales survive,
    otherwise only the first sale does.
    """
    df = (headers.withColumn("_amt", F.coalesce(F.col(amount).cast("double"), F.lit(0.0)))
          .withColumn("_sale", F.coalesce(_is_sale(), F.lit(False))))
    paid = F.col("_sale") & (F.col("_amt") > 0)
    df = with_group(
        df, ["order_id"],
        F.max(F.when(F.col("_sale"), F.col("_amt")).otherwise(0.0)).alias("_top"),
        F.min(F.when(F.col("_sale"), F.col(pos))).alias("_first"),
        F.count_if(paid).alias("_n_paid"),
        money_sum(F.when(paid, F.col("_amt"))).alias("_sum_paid"),
        F.max(F.when(paid, F.struct(F.col("_amt").alias("a"), (-F.col(pos)).alias("p")))).alias("_best"))
    ghost = F.col("_sale") & (F.col("_amt") <= 0) & ((F.col("_top") > 0) | (F.col(pos) > F.col("_first")))
    split = F.col("_sale") & (F.col("_n_paid") > 1)
    return (df.withColumn("is_ghost", ghost)
            .withColumn("is_split", split & ~ghost)
            .withColumn("pay_share", F.when(split & ~ghost, F.col("_amt") / F.col("_sum_paid")).otherwise(1.0))
            .withColumn("takes_details", ~ghost & (~split | (F.col(pos) == -F.col("_best.p"))))
            .drop("_amt", "_sale", "_top", "_first", "_n_paid", "_sum_paid", "_best"))


_FACTS = ["is_ghost", "is_split", "pay_share", "takes_details"]


def drop_ghost_payments(headers: DataFrame) -> DataFrame:
    """Zero sales go when the order has a paid sale or they are not its first sale."""
    return with_payment_facts(headers).filter(~F.col("is_ghost")).drop(*_FACTS)


def allocate_split_payment(headers: DataFrame) -> DataFrame:
    """Ghosts out; money of really split orders shared by payment amount, so an order keeps its total."""
    df = with_payment_facts(headers).filter(~F.col("is_ghost"))
    present = [c for c in HEADER_MONEY if c in df.columns]
    return df.select(*[c for c in df.columns if c not in present + _FACTS],
                     *[(F.col(c).cast("double") * F.col("pay_share")).alias(c) for c in present])


def primary_payment(headers: DataFrame) -> DataFrame:
    """Header rows that may receive details: of a split order only its largest payment."""
    return with_payment_facts(headers).filter(F.col("takes_details")).drop(*_FACTS)


# --- channel --------------------------------------------------------------------------------------------------------

def classify_sales_type(headers: DataFrame, details: DataFrame, products: Iterable[str] = tuple(fv.LISTED_PRODUCTS),
                        payment: str = "transactions_payment_type_name",
                        channels: dict[str, str] = fv.INGEST_CHANNELS) -> DataFrame:
    """Channel by payment name; an order with any listed product is LISTED_PRODUCT_CHANNEL on all its rows."""
    listed = (details.filter(F.col("product_id").cast("string").isin(*products))
              .groupBy("order_id").agg(F.lit(True).alias("_listed")))
    df = join_per_key(headers, listed, ["order_id"])
    return df.withColumn("sales_type", F.when(F.col("_listed"), F.lit(fv.LISTED_PRODUCT_CHANNEL))
                         .otherwise(lookup(payment, channels, F.lit(fv.WALK_IN)))).drop("_listed")


# --- details --------------------------------------------------------------------------------------------------------

def drop_zero_modifiers(details: DataFrame) -> DataFrame:
    """Drop free modifier rows. A NULL modifier differs from '' here, so a free row with a NULL modifier goes too."""
    modifier = F.coalesce(F.col("product_modifier_id") != "", F.lit(True))
    free = F.coalesce(F.col("base_price") == 0, F.lit(False))
    return details.filter(~(modifier & free))


def combo_share(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Share of every bundle component: price × quantity over the bundle, equal shares when one is unpriced."""
    weight = F.greatest(F.coalesce(F.col("price"), F.lit(0.0)) * F.coalesce(F.col("quantity"), F.lit(0.0)), F.lit(0.0))
    df = lines.withColumn("_w", weight)
    df = with_group(df, keys, F.min(F.col("_w") > 0).alias("_priced"), money_sum("_w").alias("_sum"),
                    F.count(F.lit(1)).alias("_n"))
    share = F.when(F.col("_priced"), F.col("_w") / F.col("_sum")).otherwise(1 / F.col("_n"))
    return df.withColumn("combo_share", share).drop("_w", "_priced", "_sum", "_n")


def allocate_detail_amounts(lines: DataFrame, keys: list[str], discount: str) -> DataFrame:
    """Promotion, discount, subtotal, tax and total per row of a detail.

    Bundle components take ``combo_share`` of the bundle; other rows an equal part. Discount and promotion come with tax and
    are taken out of it. ``discount`` names the base column: the summed discount list or the order-level discount.
    """
    rate = F.coalesce(F.col("tax_percentage"), F.lit(0.0)) / 100
    bundle = F.col("type") == fv.BUNDLE_TYPE
    df = with_group(lines, keys, F.count(F.lit(1)).alias("_rows"))

    def part(c: str) -> Column:
        base = F.coalesce(F.col(c), F.lit(0.0))
        return F.when(bundle, base * F.col("combo_share") / (1 + rate)).otherwise(base / F.col("_rows") / (1 + rate))

    df = (df.withColumn("_disc", part(discount)).withColumn("_promo", part("promotion_amount"))
          .withColumn("total_order_amount", F.when(bundle, F.col("total_order_amount") * F.col("combo_share"))
                      .otherwise(F.col("total_order_amount")))
          .withColumn("subtotal", F.col("total_order_amount") - F.col("_disc") - F.col("_promo"))
          .withColumn("tax_amount", F.col("subtotal") * rate)
          .withColumn("total_amount", F.col("subtotal") + F.col("tax_amount")))
    kept = [c for c in df.columns if c not in ("_rows", "_disc", "_promo", "discount_amount", "promotion_amount")]
    return df.select(*kept, F.col("_disc").alias("discount_amount"), F.col("_promo").alias("promotion_amount"))


def details_with_header(details: DataFrame, headers: DataFrame) -> DataFrame:
    """Details of orders that have at least one transaction."""
    return join_per_key(details, headers.select("order_id").distinct(), ["order_id"], "left_semi")


def product_weights(products: DataFrame) -> DataFrame:
    """Priced single products: not a bundle, with a SKU, price not 0."""
    return (products.filter((F.col("type") != fv.BUNDLE_TYPE) & F.col("sku").isNotNull() & (F.col("sku") != "")
                            & F.col("price").isNotNull() & (F.col("price") != 0))
            .select("product_id", "price"))


def slot_counts(products: DataFrame) -> DataFrame:
    """Number of distinct categories in each bundle's slot list; bundles without one are left out."""
    categories = F.array_distinct(F.transform("bundles", lambda b: b["category"]))
    return (products.filter((F.col("type") == fv.BUNDLE_TYPE) & F.col("bundles").isNotNull() & (F.size("bundles") > 0))
            .groupBy(F.col("product_id").alias("bundling_id"))
            .agg(F.max(F.size(categories)).alias("bundling_slot_count")))


# --- versions and missing orders -------------------------------------------------------------------------------------

def latest_version(orders: DataFrame, sequence: str, key: str = "order_id") -> DataFrame:
    """One version per order: the one pulled last."""
    return first_per_key(orders, [key], [sequence], last=True)


def dedup_headers(headers: DataFrame, order: list[str]) -> DataFrame:
    """One row per (order, transaction), the first by ``order``."""
    return first_per_key(headers, ["order_id", "transaction_id"], order)


def missing_orders(source: DataFrame, stored: DataFrame, sequence: str) -> DataFrame:
    """Source orders that are not stored, once each (the last pulled version)."""
    fresh = join_per_key(source, stored.select("order_id").distinct(), ["order_id"], "left_anti")
    return latest_version(fresh, sequence)


def orders_without_details(headers: DataFrame, details: DataFrame) -> DataFrame:
    """Paid, fulfilled and successful orders that have no detail row at all."""
    done = headers.filter((F.col("payment_status") == "paid") & (F.col("fulfillment_status") == "fulfilled")
                          & (F.col("transactions_status") == "success")).select("order_id").distinct()
    return done.join(details.select("order_id").distinct(), "order_id", "left_anti")


def order_state(headers: DataFrame, details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is stored: (per order: its flags and whether it has details, per transaction: its status)."""
    flags = (headers.groupBy("order_id")
             .agg(F.min_by(F.struct("status", "payment_status", "fulfillment_status"), "transaction_id").alias("_old")))
    has = details.groupBy("order_id").agg(F.lit(True).alias("_has_details"))
    orders = flags.join(has, "order_id", "left")
    transactions = headers.groupBy("order_id", "transaction_id").agg(F.max("transactions_status").alias("_old_status"))
    return orders, transactions


def changed_orders(incoming: DataFrame, stored_headers: DataFrame, stored_details: DataFrame,
                   has_details: str = "has_details") -> DataFrame:
    """Orders to write: new, other flags, a new or changed transaction (an unseen zero sale is none), or details where
    none are stored. ``incoming`` has one row per order and transaction, so unpaid orders are not in it."""
    orders, transactions = order_state(stored_headers, stored_details)
    tx = incoming.join(transactions, ["order_id", "transaction_id"], "left")
    zero_sale = (F.col("transactions_type") == "sale") & (F.coalesce(F.col("tx_amount"), F.lit(0.0)) <= 0)
    tx_changed = F.when(F.col("_old_status").isNotNull(), ~F.col("transactions_status").eqNullSafe(F.col("_old_status"))) \
        .otherwise(~zero_sale)
    per_order = tx.groupBy("order_id").agg(
        F.max(tx_changed).alias("_tx_changed"),
        F.min_by(F.struct("status", "payment_status", "fulfillment_status"), "transaction_id").alias("_new"),
        F.max(has_details).alias("_details"))
    joined = per_order.join(orders, "order_id", "left")
    is_new = F.col("_old").isNull()
    changed = (F.col("_tx_changed") | ~F.col("_new").eqNullSafe(F.col("_old"))
               | (F.col("_details") & F.col("_has_details").isNull()))
    return (joined.filter(is_new | changed)
            .select("order_id", F.when(is_new, "new").otherwise("changed").alias("reason")))
