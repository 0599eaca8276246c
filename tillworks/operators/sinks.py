"""Loads as table rewrites: each function returns the table after the load, ``loads.py`` and the writers below put it on disk.

Parquet has no row-level update, so a replace is "rows that stay" + new rows. Where the rows that go are whole partitions, write
the new rows with :func:`overwrite_partitions` instead and nothing else is read or rewritten.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillworks.functions.skew import first_per_key, join_per_key, side_by_side


def in_window(column: str, start: str, end: str) -> Column:
    return F.col(column).between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))


def window_rows(target: DataFrame, column: str, start: str, end: str, owned: Column | None = None) -> Column:
    """Rows a job replaces: inside its window and owned by it. An unknown ownership is not owned."""
    mine = in_window(column, start, end)
    return F.coalesce(mine & owned if owned is not None else mine, F.lit(False))


def replace_window(target: DataFrame, new: DataFrame, column: str, start: str, end: str, owned: Column | None = None) -> DataFrame:
    """Delete the job's rows of the window, insert the new ones. :func:`refuse_empty` is its gate."""
    return target.filter(~window_rows(target, column, start, end, owned)).unionByName(new)


def refuse_empty(target: DataFrame, new: DataFrame, column: str, start: str, end: str, owned: Column | None = None) -> None:
    """Gate: an empty result must not wipe a filled window. ``new`` should be stored, so that it is not worked out twice."""
    if new.isEmpty() and not target.filter(window_rows(target, column, start, end, owned)).isEmpty():
        raise RuntimeError(f"no rows computed although the target has some in {start}..{end}; nothing was deleted")


def replace_dates(target: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """Replace exactly the dates the result holds; an empty result leaves the target as it is."""
    return join_per_key(target, new.select(column).distinct(), [column], "left_anti").unionByName(new)


def replace_batch_log(target: DataFrame, new: DataFrame, column: str, batch: str, label: str) -> DataFrame:
    """Replace one batch of the result's dates; other batches of the same day stay."""
    gone = new.select(column).distinct().withColumn(batch, F.lit(label))
    return join_per_key(target, gone, [column, batch], "left_anti").unionByName(new)


def _not_in(rows: DataFrame, stored: DataFrame, key: str = "order_id") -> DataFrame:
    return join_per_key(rows, stored.select(key).distinct(), [key], "left_anti")


def append_new_orders(stored_headers: DataFrame, headers: DataFrame, details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Headers and details of orders the target does not know; the order decides for both tables."""
    return _not_in(headers, stored_headers), _not_in(details, stored_headers)


def load_counts(stored_headers: DataFrame, headers: DataFrame, new_headers: DataFrame, new_details: DataFrame) -> DataFrame:
    """What an insert-new-only load does, as one row."""
    seen = headers.agg(F.countDistinct("order_id").alias("_orders"))
    h = new_headers.agg(F.count(F.lit(1)).alias("headers_inserted"), F.countDistinct("order_id").alias("orders_inserted"))
    d = new_details.agg(F.count(F.lit(1)).alias("details_inserted"))
    return (side_by_side(h, d, seen)
            .withColumn("orders_skipped_existing", F.col("_orders") - F.col("orders_inserted")).drop("_orders"))


def fill_missing_details(stored_headers: DataFrame, stored_details: DataFrame, details: DataFrame) -> DataFrame:
    """Details to append: their order has a header but not a single detail yet."""
    known = join_per_key(details, stored_headers.select("order_id").distinct(), ["order_id"], "left_semi")
    return _not_in(known, stored_details)


def insert_ignore(target: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows really inserted: the first per unique key of the batch whose key the target lacks."""
    fresh = join_per_key(new, target.select(*keys).distinct(), keys, "left_anti")
    return first_per_key(fresh, keys, order)


@dataclass
class Upsert:
    """Result of :func:`upsert_hold_shrink`."""

    headers: DataFrame
    details: DataFrame
    decisions: DataFrame


def _per_order(df: DataFrame, name: str, keep: Column, like: DataFrame) -> DataFrame:
    """Per order: how many rows are kept, and what tells all its rows: their number and the sums of both halves of a hash of each row."""
    whole = F.xxhash64(*[F.col(c) for c in like.columns])
    return df.groupBy("order_id").agg(F.nullif(F.count_if(keep), F.lit(0)).alias(name), F.struct(
        F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(whole, 32)).alias("high"), F.sum(whole.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low")).alias(f"{name}_rows"))


def _kept(cutoff: str | None, order_date: str) -> Column:
    return F.lit(True) if cutoff is None else F.coalesce(F.col(order_date) >= F.lit(cutoff).cast("timestamp_ntz"), F.lit(True))


def upsert_states(stored_headers: DataFrame, stored_details: DataFrame, headers: DataFrame, details: DataFrame, cutoff: str | None = None,
                  order_date: str = "order_date") -> DataFrame:
    """Per incoming order: its decision (:func:`upsert_decisions`, rows of orders before ``cutoff`` do not count as stored), and whether what
    is stored ``changes``: an order that is stored row for row as it comes in does not."""
    keep, all_rows = _kept(cutoff, order_date), F.lit(True)
    counts = _per_order(headers, "new_headers", all_rows, stored_headers)
    for other, name, kept, like in ((details, "new_details", all_rows, stored_details), (stored_headers, "old_headers", keep, stored_headers),
                                    (stored_details, "old_details", keep, stored_details)):
        counts = counts.join(_per_order(other, name, kept, like), "order_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    shrinks = (F.col("new_headers") < F.col("old_headers")) | (zero("new_details") < zero("old_details"))
    decision = F.when(F.col("old_headers").isNull(), "new").when(shrinks, "held").otherwise("update")
    same = [F.col(f"new_{t}_rows").eqNullSafe(F.col(f"old_{t}_rows")) for t in ("headers", "details")]
    return counts.select("order_id", decision.alias("decision"), ((decision != "held") & ~(same[0] & same[1])).alias("changes"))


def upsert_decisions(stored_headers: DataFrame, stored_details: DataFrame, headers: DataFrame, details: DataFrame) -> DataFrame:
    """Per incoming order: 'new', 'update', or 'held' when its new version has fewer headers or details than stored."""
    return upsert_states(stored_headers, stored_details, headers, details).select("order_id", "decision")


def upsert_hold_shrink(stored_headers: DataFrame, stored_details: DataFrame, headers: DataFrame, details: DataFrame,
                       cutoff: str | None = None, order_date: str = "order_date", decisions: DataFrame | None = None) -> Upsert:
    """Replace whole orders by their new version unless it shrank; rows of orders before ``cutoff`` roll out first. ``decisions``: those of
    these rows, where they are known already."""
    if cutoff is not None:
        keep = _kept(cutoff, order_date)
        stored_headers, stored_details = stored_headers.filter(keep), stored_details.filter(keep)
    if decisions is None:
        decisions = upsert_decisions(stored_headers, stored_details, headers, details)
    updated = decisions.filter(F.col("decision") == "update").select("order_id")
    written = decisions.filter(F.col("decision") != "held").select("order_id")

    def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
        kept = join_per_key(stored, updated, ["order_id"], "left_anti")
        return kept.unionByName(join_per_key(new, written, ["order_id"], "left_semi"))

    return Upsert(merge(stored_headers, headers), merge(stored_details, details), decisions)


def upsert_counts(result: Upsert, stored_headers: DataFrame, stored_details: DataFrame, headers: DataFrame, details: DataFrame,
                  cutoff: str | None = None, order_date: str = "order_date") -> DataFrame:
    """What an upsert does, as one row: orders per decision, rows written and rows rolled out."""
    written = result.decisions.filter(F.col("decision") != "held").select("order_id")
    old = F.lit(False) if cutoff is None else F.coalesce(F.col(order_date) < F.lit(cutoff).cast("timestamp_ntz"), F.lit(False))
    kinds = result.decisions.agg(*[F.count_if(F.col("decision") == d).alias(n) for d, n in
                                   (("new", "orders_new"), ("update", "orders_updated"), ("held", "orders_held"))])
    n = F.count(F.lit(1))
    parts = [kinds, join_per_key(headers, written, ["order_id"], "left_semi").agg(n.alias("headers_written")),
             join_per_key(details, written, ["order_id"], "left_semi").agg(n.alias("details_written")),
             stored_headers.filter(old).agg(n.alias("rollover_headers")), stored_details.filter(old).agg(n.alias("rollover_details"))]
    return side_by_side(*parts)


def held_sample(decisions: DataFrame, k: int = 10) -> DataFrame:
    """The first held orders for a report."""
    return decisions.filter(F.col("decision") == "held").select("order_id").orderBy("order_id").limit(k)


def update_fulfilled(headers: DataFrame, done: DataFrame) -> DataFrame:
    """Set fulfilled, and the sales type where one is known. ``done``: order_id, sales_type (may be NULL)."""
    found = done.groupBy("order_id").agg(F.max("sales_type").alias("_type"), F.lit(True).alias("_hit"))
    df = join_per_key(headers, found, ["order_id"])
    return df.select(*[
        F.when(F.col("_hit"), "fulfilled").otherwise(F.col(c)).alias(c) if c == "fulfillment_status"
        else F.coalesce("_type", c).alias(c) if c == "sales_type" else F.col(c) for c in headers.columns])


def patch_column(target: DataFrame, patch: DataFrame, keys: list[str], column: str, only: Column | None = None) -> DataFrame:
    """Overwrite one column where the patch has the key; ``only`` limits the rows that may change."""
    df = join_per_key(target, patch.select(*keys, F.col(column).alias("_new")).withColumn("_hit", F.lit(True)), keys)
    hit = F.col("_hit").isNotNull() & (only if only is not None else F.lit(True))
    return df.select(*[F.when(hit, F.col("_new")).otherwise(F.col(c)).alias(c) if c == column else F.col(c) for c in target.columns])


def mirror_distinct(source: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct projection that is copied to the mirrors."""
    return source.select(*columns).distinct()


# --- writers --------------------------------------------------------------------------------------------------------

def overwrite_partitions(df: DataFrame, path: str, *partitions: str) -> None:
    """Write ``df`` and replace only the partitions it holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_sorted(df: DataFrame, path: str, *order: str, files: int | None = None) -> None:
    """Write a table in order: the rows of each file come before those of the next one, and are sorted within. Ranges are sampled, so
    files are about equal in size; rows of one key are never split, so ``order`` should tell rows apart."""
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.parquet(path)


def read_sorted(spark: SparkSession, path: str, place: str = "place") -> DataFrame:
    """A table of :func:`write_sorted` with the place of each row in the whole order, from 1: its row within the file behind all rows of
    the files before."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    starts = sizes.select("_file", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(starts, "_file").withColumn(place, F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_before")


def file_ranges(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(file, rows, least and greatest key) per file of a table."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), key)
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("least"), F.max(key).alias("greatest"))


def write_mirrors(df: DataFrame, paths: list[str]) -> int:
    """Copy one frame to several targets; an empty source is a no-op. Rows written per target."""
    if df.isEmpty():
        return 0
    first, *rest = paths
    df.write.mode("overwrite").parquet(first)
    copy = df.sparkSession.read.parquet(first)
    for path in rest:
        copy.write.mode("overwrite").parquet(path)
    return copy.count()
