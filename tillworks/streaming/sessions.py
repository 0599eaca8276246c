"""Standing sessions of riders as a stateful stream.

Events may arrive in any order and more than once. The state is keyed by rider and day, so a rider with a third of all events is
worked on by many tasks: it is an aggregate that holds the day's events as they were delivered, and a micro-batch reads the state of its own
days only. What goes out for such a day are its runs: the pieces between two moments at which the flag turns true. A late event cuts a run or
joins two within its day; whether the first run of a day goes on from the day before is settled when the answer is read, from one row per
rider and day. No stored event is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from tillworks.functions.scalars import from_micros, micros, parse_flag
from tillworks.operators.riders import session_ends
from tillworks.streaming.state import newest, start_updates

KEYS = ["rider_code", "slot"]
RUN = "first_true bigint, last_false bigint, last bigint, logs bigint, true_logs bigint, false_logs bigint"
SLOTS = f"rider_code string, slot date, first_on boolean, last_on boolean, runs array<struct<{RUN.replace(' bigint', ':bigint')}>>"


def _on(event: Column) -> Column:
    return F.coalesce(event["flag"], F.lit(False))


def _first_deliveries(events: Column) -> Column:
    """Events without those delivered again; one without id always counts. ``events``: in order of time, id and delivery, missing ones first."""
    def kept(x: Column, i: Column) -> Column:
        before = F.get(events, i - 1)
        return (i == 0) | x["id"].isNull() | ~(x["id"].eqNullSafe(before["id"]) & x["at"].eqNullSafe(before["at"]))
    return F.filter(events, kept)


def _run(part: Column) -> Column:
    true, false = F.filter(part, _on), F.filter(part, lambda x: ~x["flag"])
    times = lambda events: F.transform(events, lambda x: x["at"])
    n = lambda events: F.size(events).cast("bigint")
    return F.struct(F.array_min(times(true)).alias("first_true"), F.array_max(times(false)).alias("last_false"), F.array_max(times(part)).alias("last"),
                    n(F.filter(part, lambda x: x["id"].isNotNull())).alias("logs"), n(true).alias("true_logs"), n(false).alias("false_logs"))


def day_runs(logs: DataFrame) -> DataFrame:
    """A stream of (id, rider_code, timestamp, is_stationed) events as updated runs per rider and day; the first run begins with the day. Of
    deliveries of one event the first counts, told by the time of their micro-batch."""
    event = F.struct(micros("timestamp").alias("at"), F.col("id").cast("long").alias("id"), F.current_timestamp().alias("delivered"),
                     parse_flag("is_stationed").alias("flag"))
    days = logs.select("rider_code", F.to_date("timestamp").alias("slot"), event.alias("event")).groupBy(*KEYS).agg(F.collect_list("event").alias("events"))
    days = days.withColumn("events", F.sort_array("events"))
    days = days.withColumn("events", _first_deliveries(F.col("events")))
    places = F.sequence(F.lit(0), F.size("events") - 1)
    begins = lambda i: (i == 0) | (_on(F.get("events", i)) & ~_on(F.get("events", i - 1)))
    days = days.withColumn("starts", F.filter(places, begins))
    ends = lambda k: F.coalesce(F.get("starts", k + 1), F.size("events"))
    parts = F.transform("starts", lambda start, k: F.slice("events", start + 1, ends(k) - start))
    return days.select(*KEYS, _on(F.get("events", F.lit(0))).alias("first_on"), _on(F.element_at("events", -1)).alias("last_on"),
                       F.transform(parts, _run).alias("runs"))


def start_sessions(logs: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Run over what the source holds now; returns the streaming query. :func:`sessions` reads the answer from ``folder``."""
    return start_updates(day_runs(logs), folder, checkpoint)


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    """All sessions of what came so far, as the batch operator tells them.

    The windows run over one row per rider and day.
    """
    days = newest(spark, folder, T.StructType.fromDDL(SLOTS), KEYS)
    order = Window.partitionBy("rider_code").orderBy("slot")
    opens = F.col("first_on") & ~F.coalesce(F.lag("last_on").over(order), F.lit(False))
    days = days.withColumn("opens", opens.cast("int"))
    begun = F.sum(F.size("runs") - 1 + F.col("opens")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    days = days.withColumn("begun", F.coalesce(begun, F.lit(0)) + F.col("opens"))
    runs = days.select("rider_code", "begun", F.posexplode("runs").alias("place", "run")).select(
        "rider_code", (F.col("begun") + F.col("place")).alias("session_seq"), "run.*")
    parts = runs.where(F.col("session_seq") > 0).groupBy("rider_code", "session_seq").agg(
        from_micros(F.min("first_true")).alias("session_start"), from_micros(F.max("last_false")).alias("session_last_false"),
        from_micros(F.max("last")).alias("session_last_event"), F.sum("logs").alias("total_logs"), F.sum("true_logs").alias("total_true_logs"),
        F.sum("false_logs").alias("total_false_logs"))
    return session_ends(parts)
