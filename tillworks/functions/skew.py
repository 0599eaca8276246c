"""Grouping without putting a whole group into one task.

A plain window pulls every row of a key into one task, so one key holding a third of the table stalls the job. The helpers
here only aggregate (with map-side partial aggregates), join against one-row-per-key frames in a form that adaptive execution
can split, or run windows inside bounded buckets whose carry-over is computed from per-bucket totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

def join_per_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``rows`` to a frame with one row per key (NULL keys match), safe for keys holding a large part of the rows.

    Both sides are joined on one struct column. An aggregate's output is already partitioned by the plain key columns, and a
    join that reuses this partitioning cannot be split: adaptive execution only splits a skewed partition that comes
    straight out of a shuffle. The struct column makes the planner shuffle both sides for the join, so a hot key's rows are
    read by as many tasks as their size asks for (``spark.sql.adaptive.skewJoin``), each with the key's single right row.
    """
    extra = [c for c in per_key.columns if c not in keys]
    right = per_key.select(F.struct(*keys).alias("_rk"), *extra)
    return rows.withColumn("_lk", F.struct(*keys)).join(right, F.col("_lk") == F.col("_rk"), how).drop("_lk", "_rk")


def with_group(rows: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Attach per-key aggregates to every row: a whole-partition window without the whole partition in one task."""
    return join_per_key(rows, rows.groupBy(*keys).agg(*aggs), keys, "inner")


def _ordered(order: Sequence[Column | str]) -> Column:
    return F.struct(*[F.col(c) if isinstance(c, str) else c.alias(f"o{i}") for i, c in enumerate(order)])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], last: bool = False) -> DataFrame:
    """The first (or last) row of each key by ``order``, as a partial aggregate. ``order`` must be unique within a key."""
    rest = [c for c in df.columns if c not in keys]
    if all(isinstance(c, str) for c in order) and sorted(rest) == sorted(order):  # the order tells the whole row
        least = (F.max if last else F.min)(F.struct(*order)).alias("_row")
        return df.groupBy(*keys).agg(least).select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    pick = (F.max_by if last else F.min_by)(F.struct(*rest), _ordered(order)).alias("_row")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def count_copies(df: DataFrame, name: str = "_copies") -> DataFrame:
    """Identical rows folded into one with their number, so a flood of copies shrinks before any shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name))


def among(keys: DataFrame, on: str, words: int = 1 << 16) -> Column:
    """Whether a row's key may be among ``keys``: never false for one that is, and rarely true for another while the keys are few.

    The keys set bits by their hash, 64 in a word, which a subquery gathers while the query runs: ``words`` numbers (512 KB), however
    many keys there are.
    """
    place = F.pmod(F.xxhash64(on), F.lit(64 * words))
    bits = keys.groupBy(F.floor(place / 64).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))).alias("bits"))
    dense = keys.sparkSession.range(words).join(bits, F.col("id") == F.col("word"), "left")
    entry = F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    table = dense.agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["bits"]).alias("table")).scalar()
    return F.getbit(F.element_at(table, (F.floor(place / 64) + 1).cast("int")), (place % 64).cast("int")) == 1


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Undo :func:`count_copies`: each row as often as column ``times`` says (0 drops it)."""
    return (df.filter(F.col(times) > 0)
            .withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times).cast("bigint"))))
            .drop("_i", times))


def bucket_offsets(df: DataFrame, keys: Sequence[str], bucket: str, value: Column) -> DataFrame:
    """Per (key, bucket): ``_t`` = total, ``_before`` = total of the key's earlier buckets, ``_total`` = of the whole key.

    The windows run over one row per bucket, so their partitions are as long as a key has buckets: keep that bounded.
    """
    total = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_t"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return (total.withColumn("_before", F.coalesce(F.sum("_t").over(before), F.lit(0)))
            .withColumn("_total", F.sum("_t").over(Window.partitionBy(*keys))))


def add_slot(df: DataFrame, keys: Sequence[str], bucket: str) -> DataFrame:
    """Add ``_slot`` = (keys, bucket), the unit later joins and windows share, so they shuffle the rows once."""
    return df if "_slot" in df.columns else df.withColumn("_slot", F.struct(*keys, bucket))


def join_slots(df: DataFrame, per_bucket: DataFrame, keys: Sequence[str], bucket: str) -> DataFrame:
    """Join rows to the facts of their slot. Slots are bounded by their bucket, so this join need not be split. The keys travel in the slot
    only."""
    own = (*keys, bucket)
    extra = [c for c in per_bucket.columns if c not in own]
    right = per_bucket.select(F.struct(*own).alias("_rk"), *extra)
    rows = add_slot(df, keys, bucket)
    joined = rows.drop(*own).join(right, F.col("_slot") == F.col("_rk"))
    return joined.select(*[F.col(f"_slot.{c}").alias(c) if c in own else F.col(c) for c in [*rows.columns, *extra]])


def running_sum(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column | str],
                value: Column, name: str) -> DataFrame:
    """Inclusive running sum of ``value`` per key in (bucket, order).

    Rows are windowed per (key, bucket) only; what earlier buckets add comes from per-bucket totals, so the longest
    sorted run is one bucket of one key. ``bucket`` must grow with the order and be deterministic.
    """
    offsets = bucket_offsets(df, keys, bucket, value).drop("_t", "_total")
    inside = Window.partitionBy("_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (join_slots(df, offsets, keys, bucket)
            .withColumn(name, F.sum(value).over(inside) + F.col("_before")).drop("_before"))


def bucketed_lead(df: DataFrame, keys: Sequence[str], bucket: str, order: str, name: str) -> DataFrame:
    """Next value of ``order`` within a key, looking across buckets through one row per bucket."""
    starts = df.groupBy(*keys, bucket).agg(F.min(order).alias("_s"))
    after = starts.withColumn("_next", F.lead("_s").over(Window.partitionBy(*keys).orderBy(bucket))).drop("_s")
    inside = Window.partitionBy("_slot").orderBy(order)
    return (join_slots(df, after, keys, bucket)
            .withColumn(name, F.coalesce(F.lead(order).over(inside), F.col("_next"))).drop("_next", "_slot"))


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row, by a union instead of a join without keys."""
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])
