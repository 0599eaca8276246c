"""Payloads for landlords, the guard against sending twice, the send log and response reconciliation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks import fixed_values as fv
from tillworks.functions.scalars import exact_rest, exact_sum, lookup, money_sum, money_total, np_round, strip
from tillworks.functions.skew import first_per_key, join_per_key

SENDABLE = list(fv.COMMISSION_RATES)
PENDING = "pending"
ACCEPTED_ERROR = "duplicate"
# fixed values: field names of the landlord's answer
RESPONSE = T.StructType([
    T.StructField("RevenueBatchId", T.StringType()),
    T.StructField("transactionReturnDatas", T.ArrayType(T.StructType([
        T.StructField("TenantTransactionNumber", T.StringType()),
        T.StructField("MallTransactionId", T.StringType())]))),
    T.StructField("ErrorTransactionNumber", T.ArrayType(T.StringType())),
])


def _numbers(prefix: str, outlet: str, day: str, kind: str, run_time: str) -> tuple[Column, Column]:
    """Transaction number and remarks of a payload row; ``run_time`` is HHMMSS."""
    head = F.concat(F.lit(prefix + "_"), F.col(outlet), F.lit("_"), F.col(kind), F.lit("_"))
    return (F.concat(head, F.date_format(day, "yyyyMMdd"), F.lit("_" + run_time)),
            F.concat(head, F.date_format(day, "yyyy-MM-dd"), F.lit("_" + run_time)))


def _payload(grouped: DataFrame, prefix: str, run_time: str) -> DataFrame:
    number, remarks = _numbers(prefix, "jilid", "transaction_date", "payment_type", run_time)
    return grouped.select("jilid", "transaction_date", "payment_type", "total_sales", "total_tax",
                          np_round("amount", 4).alias("amount"), number.alias("transaction_number"), remarks.alias("remarks"))


def payload_from_sales(sales: DataFrame, prefix: str, run_time: str, payment: str = "payment_type_raw") -> DataFrame:
    """One row per outlet, day and payment name straight from the headers; the QRIS names share one label."""
    label = lookup(payment, {name: fv.QRIS_LABEL for name in fv.QRIS_ALIASES}, F.col(payment))
    df = (sales.select(F.col("outlet_code").alias("jilid"), F.to_date("transaction_date").alias("transaction_date"),
                       label.alias("payment_type"), F.col("total_amount").alias("s"), F.col("total_tax_amount").alias("t"))
          .filter(F.col("jilid").isNotNull() & F.col("payment_type").isNotNull())
          .groupBy("jilid", "transaction_date", "payment_type")
          .agg(money_sum("s").alias("total_sales"), money_sum("t").alias("total_tax"),
               ((exact_sum("s") - exact_sum("t")).cast("double") + (exact_rest("s") - exact_rest("t"))).alias("amount")))
    return _payload(df, prefix, run_time)


def sendable(income: DataFrame, types: Iterable[str] = tuple(SENDABLE)) -> DataFrame:
    """Listed payment types with non-zero sales."""
    return income.filter(F.col("payment_type").isin(*types) & (F.col("total_sales") != 0))


def unsent_payment_types(income: DataFrame, types: Iterable[str] = tuple(SENDABLE)) -> DataFrame:
    """Sales of payment types that are not sent."""
    return (income.filter(~F.col("payment_type").isin(*types) & (F.col("total_sales") != 0))
            .groupBy("payment_type").agg(money_total("total_sales").alias("total_sales")).orderBy("payment_type"))


def payload_from_income(income: DataFrame, prefix: str, run_time: str, types: Iterable[str] = tuple(SENDABLE)) -> DataFrame:
    """One row per outlet, day and listed payment type; amount = subtotal - commission, 4 decimals."""
    net = F.col("subtotal") - F.col("sales_type_commission")
    df = (sendable(income, types).groupBy(F.col("outlet_code").alias("jilid"), F.col("date").alias("transaction_date"), "payment_type")
          .agg(money_total("total_sales").alias("total_sales"), money_total("tax_amount").alias("total_tax"),
               money_total(net).alias("amount")))
    return _payload(df, prefix, run_time)


def order_payload(orders: DataFrame, run_time: str) -> DataFrame:
    """One row per order row with sales; ``key`` is the number without its run time. The zero rows are left out."""
    base = F.concat_ws("_", "outlet_code", "order_reference", "payment_type")
    return (orders.filter(F.col("total_sales") != 0).withColumn("key", base)
            .select(F.col("outlet_code").alias("jilid"), F.col("date").alias("transaction_date"), "payment_type", "total_sales",
                    F.col("tax_amount").alias("total_tax"),
                    np_round(F.col("subtotal") - F.col("sales_type_commission"), 4).alias("amount"),
                    F.concat("key", F.lit("_" + run_time)).alias("transaction_number"),
                    F.concat("key", F.lit("_"), F.date_format("date", "yyyy-MM-dd"), F.lit("_" + run_time)).alias("remarks"), "key"))


def payload_violations(payload: DataFrame, max_length: int = fv.MAX_PAYLOAD_NUMBER) -> DataFrame:
    """Numbers that occur twice or are too long; both stop the sending."""
    counted = payload.groupBy("transaction_number").agg(F.count(F.lit(1)).alias("n_rows"))
    long = F.length("transaction_number") > max_length
    return (counted.filter((F.col("n_rows") > 1) | long)
            .select("transaction_number", "n_rows", long.alias("too_long")))


# --- guard ----------------------------------------------------------------------------------------------------------

def _accepted() -> Column:
    duplicate = strip(F.coalesce(F.col("error_message"), F.lit(""))) == ACCEPTED_ERROR
    return (F.col("status") == "success") | duplicate


def log_keys(log: DataFrame) -> DataFrame:
    """Send log with the key of per-order numbers: outlet prefix and run time tell them from the old format (NULL key)."""
    number = F.col("transaction_number")
    per_order = F.startswith(number, F.concat(F.col("jilid"), F.lit("_"))) & number.rlike(r"_\d{6}$")
    key = F.regexp_replace(F.regexp_replace(number, r"_\d{6}$", ""), r"_\d{8}$", "")
    return log.withColumn("key", F.when(per_order, key)).withColumn("accepted", _accepted())


def resend_guard(payload: DataFrame, log: DataFrame, resend_uncertain: bool = False) -> DataFrame:
    """Payload rows with what to do: 'already' at the landlord, 'uncertain' (time-out or pending) or 'send'."""
    per_key = (log_keys(log).filter(F.col("key").isNotNull()).groupBy("key")
               .agg(F.max("accepted").alias("_accepted"),
                    F.max(F.col("status").isin("timeout_error", PENDING)).alias("_uncertain")))
    df = join_per_key(payload, per_key, ["key"])
    already, uncertain = F.coalesce("_accepted", F.lit(False)), F.coalesce("_uncertain", F.lit(False))
    held = F.lit("send") if resend_uncertain else F.lit("uncertain")
    action = F.when(already, "already").when(uncertain, held).otherwise("send")
    return df.withColumn("action", action).drop("_accepted", "_uncertain")


def legacy_conflicts(payload: DataFrame, log: DataFrame) -> DataFrame:
    """Days of the payload that the landlord already accepted in the old format; sending them again would double them."""
    days = payload.select("transaction_date").distinct()
    return (log_keys(log).filter(F.col("key").isNull() & F.col("accepted")).join(days, "transaction_date", "left_semi")
            .groupBy("transaction_date").agg(F.count(F.lit(1)).alias("n_rows"), money_total("amount").alias("amount")))


def unsent_rows(payload: DataFrame, log: DataFrame) -> DataFrame:
    """Payload rows whose outlet, day and payment type were never accepted."""
    sent = log.filter(_accepted()).select("jilid", "transaction_date", "payment_type").distinct()
    return payload.join(sent, ["jilid", "transaction_date", "payment_type"], "left_anti")


# --- send log -------------------------------------------------------------------------------------------------------

def pending_rows(payload: DataFrame, created_at: str) -> DataFrame:
    """Log rows to write before sending."""
    return payload.select("jilid", "transaction_number", "transaction_date", "payment_type", "total_sales", "total_tax", "amount",
                          "remarks", F.lit(None).cast("string").alias("mall_transaction_id"), F.lit(PENDING).alias("status"),
                          F.lit(None).cast("string").alias("error_message"),
                          F.lit(created_at).cast("timestamp_ntz").alias("created_at"))


def finalize_log(log: DataFrame, result: DataFrame) -> DataFrame:
    """Log with pending rows set to their final status. ``result``: jilid, transaction_number, status,
    mall_transaction_id, error_message."""
    final = result.select("jilid", "transaction_number", F.col("status").alias("_status"),
                          F.col("mall_transaction_id").alias("_mall"), F.col("error_message").alias("_err"), F.lit(True).alias("_hit"))
    df = log.join(final, ["jilid", "transaction_number"], "left")
    hit = F.col("_hit").isNotNull() & (F.col("status") == PENDING)
    return df.select(*[F.when(hit, F.col(n)).otherwise(F.col(c)).alias(c) if n else F.col(c) for c, n in (
        (c, {"status": "_status", "mall_transaction_id": "_mall", "error_message": "_err"}.get(c)) for c in log.columns)])


def unmatched_results(log: DataFrame, result: DataFrame) -> DataFrame:
    """Numbers whose results do not hit exactly one pending log row, or that have several; any of them aborts the final update."""
    pending = (log.filter(F.col("status") == PENDING).groupBy("jilid", "transaction_number")
               .agg(F.count(F.lit(1)).alias("n_pending")))
    asked = result.groupBy("jilid", "transaction_number").agg(F.count(F.lit(1)).alias("n_results"))
    return (join_per_key(asked, pending, ["jilid", "transaction_number"])
            .select("jilid", "transaction_number", F.coalesce("n_pending", F.lit(0)).alias("n_pending"), "n_results")
            .filter((F.col("n_pending") != 1) | (F.col("n_results") != 1)))


def response_reconcile(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Final status of every sent row from the JSON answer of its batch.

    ``requests``: batch, transaction_number, ...; ``responses``: batch, body. A row with a landlord id succeeded; its error
    text is what follows the first '|' of its error entry.
    """
    body = responses.select("batch", F.from_json("body", RESPONSE).alias("b"))
    done = (body.select("batch", F.col("b.RevenueBatchId").alias("revenue_batch_id"), F.explode("b.transactionReturnDatas").alias("d"))
            .select("batch", F.col("d.TenantTransactionNumber").alias("transaction_number"),
                    F.col("d.MallTransactionId").alias("mall_transaction_id")))
    entry = F.col("e")
    bar = F.instr(entry, "|")
    errors = (body.select("batch", F.posexplode("b.ErrorTransactionNumber").alias("pos", "e"))
              .select("batch", "pos", F.when(bar > 0, F.substring_index(entry, "|", 1)).otherwise(entry).alias("transaction_number"),
                      F.when((bar > 0) & (F.length(entry) > bar), F.expr("substring(e, instr(e, '|') + 1)"))
                      .otherwise("unknown error").alias("error_message")))
    errors = first_per_key(errors, ["batch", "transaction_number"], ["pos"], last=True).drop("pos")
    out = (requests.join(done, ["batch", "transaction_number"], "left").join(errors, ["batch", "transaction_number"], "left")
           .join(body.select("batch", F.col("b.RevenueBatchId").alias("revenue_batch_id")), "batch", "left"))
    return out.withColumn("status", F.when(F.col("mall_transaction_id").isNotNull(), "success").otherwise("error"))
