"""Hourly outlet sales: a stream for what comes in time, a trailing job for what comes late.

The intake sorts each micro-batch of headers into rows in time and side rows: behind the watermark (the newest sale of earlier batches
less ``delay``), or without the id or time that state needs. The hours stream reads the rows in time, drops a transaction that comes again
while its state lives and adds sums per hour, outlet and salt (an outlet with a third of all sales is one row per salt; orders are dealt
to salts, so distinct orders add up). Its watermark never passes the intake's, so it drops nothing. The trailing job works out anew, from
all rows, the hours that side rows touch; the answer is the stream's hours with these put in place.

Hours of one run read whole batches of the intake: run :func:`start_intake` to its end, then :func:`start_hours`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillworks.functions.scalars import as_instant, exact_rest, exact_sum, from_instant, from_micros, hour_start, micros, money_sum
from tillworks.functions.skew import first_per_key, join_per_key
from tillworks.operators.summaries import HEADER_SUMS, valid_sales
from tillworks.session import observed
from tillworks.streaming.state import newest, start_updates

DELAY = "30 days"
SALTS = 16
AMOUNTS = list(dict.fromkeys(HEADER_SUMS.values()))
HOUR = ["hour_start", "outlet_code"]


def sale_rows(headers: DataFrame) -> DataFrame:
    """What hours are made of."""
    return valid_sales(headers).select("transaction_id", "order_id", "outlet_code", "transaction_date", F.to_date("transaction_date").alias("day"), *AMOUNTS)


def intake_batches(folder: str, delay: str = DELAY) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: rows go to ``rows/late=.../from_batch=...``, the newest time of each batch to ``newest``. A batch that runs again
    writes the same files again."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = spark.read.schema("at long, of long").parquet(f"{folder}/newest").where(F.col("of") < batch_id)
        mark = F.lit(seen.agg(F.max("at")).first()[0])
        span = f"INTERVAL '{delay.split()[0]}' {delay.split()[1]}"
        behind = F.coalesce(F.col("transaction_date") <= from_micros(mark) - F.expr(span), F.lit(False))
        late = behind | F.col("transaction_id").isNull() | F.col("transaction_date").isNull()
        told = Observation()
        rows = sale_rows(batch).observe(told, F.max(micros("transaction_date")).alias("at"))
        (rows.withColumn("late", late).withColumn("from_batch", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("late", "from_batch").parquet(f"{folder}/rows"))
        spark.createDataFrame([(observed(told).get("at"), batch_id)], "at long, of long").write.mode("overwrite").parquet(f"{folder}/newest/b={batch_id}")
    return apply


def start_intake(headers: DataFrame, folder: str, checkpoint: str, delay: str = DELAY) -> StreamingQuery:
    """Sort what the source holds now into rows in time and side rows."""
    spark = headers.sparkSession
    sales = sale_rows(headers)
    spark.createDataFrame([], "at long, of long").write.mode("overwrite").parquet(f"{folder}/newest/b=-1")
    spark.createDataFrame([], sales.schema).write.mode("overwrite").parquet(f"{folder}/rows/late=false/from_batch=-1")
    return (headers.writeStream.foreachBatch(intake_batches(folder, delay)).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def hour_updates(sales: DataFrame, delay: str = DELAY, salts: int = SALTS) -> DataFrame:
    """A stream of rows in time as updated sums per hour, outlet and salt."""
    sums = [f(c).alias(f"{n}{end}") for n, c in HEADER_SUMS.items() for f, end in ((exact_sum, ""), (exact_rest, "_rest"))]
    return (sales.withColumn("at", as_instant("transaction_date")).withWatermark("at", delay)
            .dropDuplicatesWithinWatermark(["day", "transaction_id"])
            .groupBy(F.window("at", "1 hour").alias("hour"), "outlet_code", F.pmod(F.xxhash64("order_id"), F.lit(salts)).alias("salt"))
            .agg(*sums, F.size(F.collect_set("order_id")).alias("orders"))
            .select(from_instant(F.col("hour.start")).alias("hour_start"), "outlet_code", "salt", *_sum_columns(), "orders"))


def _sum_columns() -> list[str]:
    return [f"{n}{end}" for n in HEADER_SUMS for end in ("", "_rest")]


def rows_in_time(spark: SparkSession, folder: str) -> DataFrame:
    """The intake's rows in time, as a stream."""
    return spark.readStream.schema(spark.read.parquet(f"{folder}/rows").drop("late", "from_batch").schema).parquet(f"{folder}/rows/late=false")


def start_hours(spark: SparkSession, folder: str, checkpoint: str, delay: str = DELAY, salts: int = SALTS) -> StreamingQuery:
    """Add up what the intake has sorted so far; returns the streaming query. :func:`hours` reads the answer."""
    return start_updates(hour_updates(rows_in_time(spark, folder), delay, salts), f"{folder}/hours", checkpoint)


def side_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that came behind the watermark, or without id or time."""
    return spark.read.parquet(f"{folder}/rows").where(F.col("late").cast("boolean")).drop("late", "from_batch")


def hourly_sums(sales: DataFrame) -> DataFrame:
    """Sums and distinct orders per hour and outlet. A transaction delivered twice on its day counts once; rows without an id all count."""
    rest = [c for c in sales.columns if c not in ("day", "transaction_id")]
    known = first_per_key(sales.filter(F.col("transaction_id").isNotNull()), ["day", "transaction_id"], rest)
    return (known.unionByName(sales.filter(F.col("transaction_id").isNull()))
            .groupBy(hour_start("transaction_date").alias("hour_start"), "outlet_code")
            .agg(*[money_sum(c).alias(n) for n, c in HEADER_SUMS.items()], F.countDistinct("order_id").alias("total_order")))


def streamed_hours(spark: SparkSession, folder: str) -> DataFrame:
    """The hours of the stream: salts added up."""
    sums = ", ".join(f"`{c}` {'double' if c.endswith('_rest') else 'decimal(38,6)'}" for c in _sum_columns())
    outlet = spark.read.parquet(f"{folder}/rows").schema["outlet_code"].dataType.simpleString()
    schema = T.StructType.fromDDL(f"hour_start timestamp_ntz, outlet_code {outlet}, salt bigint, {sums}, orders int")
    rows = newest(spark, f"{folder}/hours", schema, [*HOUR, "salt"])
    return rows.groupBy(*HOUR).agg(*[(F.sum(n).cast("double") + F.sum(f"{n}_rest")).alias(n) for n in HEADER_SUMS],
                                   F.sum("orders").alias("total_order"))


def trailing_hours(spark: SparkSession, folder: str) -> DataFrame:
    """The hours that side rows touch, worked out anew from all rows."""
    touched = side_rows(spark, folder).select(hour_start("transaction_date").alias("hour_start"), "outlet_code").distinct()
    rows = spark.read.parquet(f"{folder}/rows").drop("late", "from_batch").withColumn("hour_start", hour_start("transaction_date"))
    return hourly_sums(join_per_key(rows, touched, HOUR, "left_semi").drop("hour_start"))


def hours(spark: SparkSession, folder: str) -> DataFrame:
    """Hour, outlet, sums and orders of all that came so far, whenever it came."""
    anew = trailing_hours(spark, folder)
    return join_per_key(streamed_hours(spark, folder), anew.select(*HOUR), HOUR, "left_anti").unionByName(anew)
