"""Reading: parquet tables, windowed scans, key scans, order documents and JDBC sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.session import observed

PROMOTION = T.StructType([
    T.StructField("promotion_id", T.StringType()),
    T.StructField("promotion_name", T.StringType()),
    T.StructField("promotion_type", T.StringType()),
    T.StructField("promotion_amount", T.DoubleType()),
])
DISCOUNT = T.StructType([
    T.StructField("discount_name", T.StringType()),
    T.StructField("discount_amount", T.DoubleType()),
])
COMBO = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_sku", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("variant_name", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
])
TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("transaction_date", T.TimestampNTZType()),
    T.StructField("type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("gateway", T.StringType()),
    T.StructField("payment_type_name", T.StringType()),
    T.StructField("mdr", T.DoubleType()),
    T.StructField("amount", T.DoubleType()),
])
ORDER_DETAIL = T.StructType([
    T.StructField("order_detail_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("product_generic_name", T.StringType()),
    T.StructField("product_type", T.StringType()),
    T.StructField("product_variant_id", T.StringType()),
    T.StructField("product_variant_name", T.StringType()),
    T.StructField("product_modifier_id", T.StringType()),
    T.StructField("product_modifier_name", T.StringType()),
    T.StructField("modifier_product_sku", T.StringType()),
    T.StructField("notes", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("fulfillment_status", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("base_price", T.DoubleType()),
    T.StructField("total_order_amount", T.DoubleType()),
    T.StructField("additional_charge", T.DoubleType()),
    T.StructField("discount_percentage", T.DoubleType()),
    T.StructField("discount_order_amount", T.DoubleType()),
    T.StructField("taxable", T.StringType()),
    T.StructField("tax_percentage", T.DoubleType()),
    T.StructField("product_combos", T.ArrayType(COMBO)),
    T.StructField("promotions", T.ArrayType(PROMOTION)),
    T.StructField("discounts", T.ArrayType(DISCOUNT)),
])
ORDER_TEXT = [
    "order_id", "order_reference", "outlet_id", "outlet_code", "outlet_name", "status", "channel", "channel_detail",
    "payment_status", "fulfillment_status", "notes", "customer_id", "customer_first_name", "customer_last_name",
    "customer_phone_number", "customer_email", "cashier_id",
]
ORDER_MONEY = [
    "total_order_amount", "total_discount_amount", "total_promotion_amount", "subtotal", "total_tax_amount",
    "total_amount",
]
ORDER_DOCUMENT = T.StructType(
    [T.StructField(c, T.StringType()) for c in ORDER_TEXT]
    + [T.StructField(c, T.TimestampNTZType()) for c in ("order_date", "closed_date")]
    + [T.StructField(c, T.DoubleType()) for c in ORDER_MONEY]
    + [T.StructField("transactions", T.ArrayType(TRANSACTION)),
       T.StructField("order_details", T.ArrayType(ORDER_DETAIL))])


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its footers are read once per session and path; later openings take the schema from there, without a job."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def order_documents(spark: SparkSession, path: str) -> DataFrame:
    """Order documents as JSON lines, with a fixed schema (no inference pass)."""
    return spark.read.schema(ORDER_DOCUMENT).json(path)


CORRUPT = "_corrupt"
#: White space that JSON allows around a value.
BLANKS = " \t\r\n"
#: Why a line is not taken as a document, in the order in which the reasons are looked for.
BROKEN_REASONS = ("not JSON", "not a document", "wrong type", "no order id")


def document_lines(spark: SparkSession, path: str, schema: T.StructType = ORDER_DOCUMENT, key: str = "order_id") -> DataFrame:
    """Every line of JSON text with the document in it: value, file, doc (typed by ``schema``) and reason (null where the document is good).

    One bad line costs one line: syntax is settled by parsing it as a VARIANT, types by the permissive parser. Blank lines are left out;
    fields that the schema lacks are no fault, :func:`unknown_fields` counts them.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    doc = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # conditions on what an outer explode gives stay above it; on a plain column they are pushed below, where all is parsed again for each of them
    parsed = F.struct(doc.alias("doc"), F.try_parse_json("value").isNotNull().alias("json"))
    lines = lines.select("*", F.explode_outer(F.array(parsed)).alias("_parsed")).select("value", "file", "_parsed.doc", F.col("_parsed.json").alias("_json"))
    opens = F.startswith(F.ltrim("value", F.lit(BLANKS)), F.lit("{"))
    tests = (~F.col("_json"), ~opens, F.col(f"doc.{CORRUPT}").isNotNull(), F.col(f"doc.{key}").isNull())
    reason = F.lit(None).cast("string")
    for test, name in reversed(list(zip(tests, BROKEN_REASONS))):
        reason = F.when(test, F.lit(name)).otherwise(reason)
    return lines.withColumn("reason", reason).drop("_json")


def good_documents(lines: DataFrame, schema: T.StructType = ORDER_DOCUMENT) -> DataFrame:
    """The typed documents of :func:`document_lines`."""
    return lines.where(F.col("reason").isNull()).select(*[F.col(f"doc.{f.name}").alias(f.name) for f in schema.fields])


def quarantined(lines: DataFrame) -> DataFrame:
    """The lines that hold no good document, as they came, with their file and the reason."""
    return lines.where(F.col("reason").isNotNull()).select("value", "file", "reason")


def unknown_fields(lines: DataFrame, schema: T.StructType = ORDER_DOCUMENT) -> DataFrame:
    """(field, documents): top-level fields of good documents that the schema lacks, as a sign that the source has changed."""
    names = F.explode(F.array_except(F.json_object_keys("value"), F.array(*[F.lit(f.name) for f in schema.fields])))
    return lines.where(F.col("reason").isNull()).select(names.alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("documents"))


def stage_documents(lines: DataFrame, folder: str, schema: T.StructType = ORDER_DOCUMENT) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Parse once: (documents, quarantine, lines per reason; good ones count as ``good``), both written below ``folder``. The counts are
    observed while the lines are written, so nothing is read twice."""
    told = Observation()
    reason = F.col("reason")
    counts = [F.count_if(reason == name).alias(name) for name in BROKEN_REASONS]
    watched = lines.observe(told, F.count_if(reason.isNull()).alias("good"), *counts)
    watched.withColumn("broken", reason.isNotNull()).select(
        F.when(reason.isNotNull(), F.col("value")).alias("value"), F.when(reason.isNotNull(), F.col("file")).alias("file"), "reason",
        F.when(reason.isNull(), F.col("doc")).alias("doc"), "broken").write.partitionBy("broken").parquet(folder)
    spark = lines.sparkSession
    kept = T.StructType([T.StructField("value", T.StringType()), T.StructField("file", T.StringType()), T.StructField("reason", T.StringType()),
                         lines.schema["doc"], T.StructField("broken", T.BooleanType())])
    staged = spark.read.schema(kept).parquet(folder)
    return good_documents(staged.where("NOT broken"), schema), quarantined(staged.where("broken")), {"good": 0, **dict.fromkeys(BROKEN_REASONS, 0), **observed(told)}


def jdbc_table(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None,
               partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """One JDBC source. Several databases are read one frame each and joined in Spark.

    ``partition`` = (numeric column, lower, upper, number of parts) for a parallel read.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q")
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition:
        column, lower, upper, parts = partition
        reader = (reader.option("partitionColumn", column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", parts))
    return reader.load()


def window_scan(df: DataFrame, ts: str, start: str, end: str, days_before: int = 0, days_after: int = 0) -> DataFrame:
    """Rows whose date is in [start, end], widened by whole days. A half-open range on the raw column, so it prunes."""
    check_window(start, end)
    lower = F.date_sub(F.to_date(F.lit(start)), days_before)
    upper = F.date_add(F.to_date(F.lit(end)), days_after + 1)
    kind = df.schema[ts].dataType
    return df.filter((F.col(ts) >= lower.cast(kind)) & (F.col(ts) < upper.cast(kind)))


def check_window(start: str, end: str, max_days: int | None = None, not_after: str | None = None) -> tuple[str, str]:
    """Window arguments: both given, ordered, not longer than ``max_days`` and not past ``not_after`` (yesterday)."""
    from datetime import date

    if not start or not end:
        raise ValueError("start and end are both required")
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    if first > last:
        raise ValueError(f"start {start} is after end {end}")
    if max_days is not None and (last - first).days + 1 > max_days:
        raise ValueError(f"window longer than {max_days} days")
    if not_after is not None and last > date.fromisoformat(not_after):
        raise ValueError(f"end {end} is after {not_after}")
    return start, end


def scan_by_keys(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is in another frame: one semi join instead of id lists in chunks; a NULL key is in none.

    The join stands on the plain columns and both sides come straight from their shuffles. So adaptive execution can split a hot key's
    rows, and where the scan is large (``spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold``) the optimizer filters
    it by a Bloom filter of the keys before it is shuffled.
    """
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on), on, "left_semi")


def write_reports(reports: dict[str, DataFrame], folder: str) -> list[str]:
    """One CSV folder per report that has rows; the names written."""
    written = []
    for name, frame in reports.items():
        if not frame.isEmpty():
            frame.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
            written.append(name)
    return written
