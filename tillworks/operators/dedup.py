"""Bundle-aware de-duplication of order details.

Details have no unique key: a bundle may legally hold identical components. A file loaded n times multiplies everything by n,
so a bundle key keeps rows ÷ n, where n = component rows of the bundle ÷ its slots in the master.

Rows are shuffled once, by the group of their bundle, and numbered there. Where a group has more than FLOOD rows, identical rows are folded
to (row, copies) first, so a flood of copies is one row before any shuffle, and keys are cut into buckets; the numbers per key are then sums
over the folded rows. ``keep`` is arithmetic on running copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillworks import fixed_values as fv
from tillworks.functions.scalars import np_round
from tillworks.functions.skew import among, bucket_offsets, count_copies, join_per_key, join_slots, repeat_rows

#: Rows of a group that one task sorts as they are.
FLOOD = 1000


def _few_and_many(details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of groups with up to FLOOD rows, all others): groups are told apart by a hash, a clash only sends rows the longer way."""
    rows = details.withColumn("_h", F.xxhash64(*fv.BUNDLE_GROUP_KEY))
    floods = rows.groupBy("_h").agg(F.count(F.lit(1)).alias("_t")).filter(F.col("_t") > FLOOD).select("_h")
    flooded = among(floods, "_h")
    return rows.filter(~flooded).drop("_h"), rows.filter(flooded).drop("_h")


def _numbered(few: DataFrame, order: list[str]) -> DataFrame:
    """Rows of small groups with the facts of :func:`_ranked`: one shuffle serves all three windows."""
    key = [*fv.BUNDLE_GROUP_KEY, *[c for c in fv.DETAIL_KEY if c not in fv.BUNDLE_GROUP_KEY]]
    rest = [c for c in few.columns if c not in fv.DETAIL_KEY and c not in order]
    combo = F.col("type") == fv.BUNDLE_TYPE
    # the coarsest window comes first: its shuffle does for the others
    return (few.withColumn("combo_group_rows", F.when(combo, F.count_if(combo).over(Window.partitionBy(*fv.BUNDLE_GROUP_KEY))))
            .withColumn("_upto", F.row_number().over(Window.partitionBy(*key).orderBy(*order, *rest)).cast("bigint"))
            .withColumn("rows_per_key", F.count(F.lit(1)).over(Window.partitionBy(*key))).withColumn("_copies", F.lit(1).cast("bigint")))


def _stats(details: DataFrame, bucket: Column) -> tuple[DataFrame, DataFrame]:
    """(folded rows with ``_copies`` and ``_bucket``, per key and bucket: rows, rows before the bucket, rows in the key)."""
    folded = count_copies(details).withColumn("_bucket", bucket)
    rows = details.select(*fv.DETAIL_KEY, bucket.alias("_bucket"))
    return folded, bucket_offsets(rows, fv.DETAIL_KEY, "_bucket", F.lit(1)).withColumnRenamed("_total", "rows_per_key")


def _ranked(folded: DataFrame, per_bucket: DataFrame, details: DataFrame, order: list[str]) -> DataFrame:
    """Folded rows with the facts of their bucket and ``_upto``: copies in the key up to and including the row."""
    rest = [c for c in details.columns if c not in fv.DETAIL_KEY and c not in order]
    inside = Window.partitionBy("_slot").orderBy(*order, *rest).rowsBetween(Window.unboundedPreceding, 0)
    return (join_slots(folded, per_bucket.drop("_t"), fv.DETAIL_KEY, "_bucket")
            .withColumn("_upto", F.sum("_copies").over(inside) + F.col("_before")).drop("_before", "_bucket", "_slot"))


def dedup_key_stats(details: DataFrame, order: list[str], bucket: Column) -> DataFrame:
    """Every row with the number of rows of its null-safe key and its sequence number (from 0) within the key.

    ``order`` fixes which rows of a key come first; ``bucket`` is a coarse, growing function of ``order[0]`` with few values.
    """
    few, many = _few_and_many(details)
    folded, per_bucket = _stats(many, bucket)
    df = _ranked(folded, per_bucket, details, order)
    df = df.unionByName(_numbered(few, order).select(*df.columns))
    first = F.col("_upto") - F.col("_copies")
    return (df.withColumn("row_seq_in_key", F.explode(F.sequence(first, F.col("_upto") - 1)))
            .withColumn("is_combo", F.col("type") == fv.BUNDLE_TYPE).drop("_copies", "_upto"))


def _with_factor(df: DataFrame, rows: str, slots: DataFrame) -> DataFrame:
    """How often a bundle was loaded: its component rows ÷ its slots when that is a whole number from 1 up.

    ``df`` is already aggregated (``rows`` per key and bucket). Only bundles are grouped, and their sizes are joined back in a form that
    adaptive execution can split: rows with missing ids all share one group.
    """
    combo = F.coalesce(F.col("type") == fv.BUNDLE_TYPE, F.lit(False))
    bundles = df.filter(combo)
    sizes = bundles.groupBy(*fv.BUNDLE_GROUP_KEY).agg(F.sum(rows).alias("combo_group_rows"))
    bundles = join_per_key(bundles, sizes, fv.BUNDLE_GROUP_KEY, "inner").join(slots, "bundling_id", "left")
    single = df.filter(~combo)
    empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in bundles.schema.fields if f.name not in df.columns}
    return _judged(bundles.select(*df.columns, *empty).unionByName(single.select(*df.columns, *empty.values())))


def _judged(df: DataFrame) -> DataFrame:
    """The factor of :func:`_with_factor` from ``combo_group_rows`` and ``bundling_slot_count``."""
    whole = F.col("combo_group_rows") % F.col("bundling_slot_count") == 0
    by_master = F.when(whole & (F.col("combo_group_rows") >= F.col("bundling_slot_count")),
                       (F.col("combo_group_rows") / F.col("bundling_slot_count")).cast("int"))
    return (df.withColumn("_by_master", by_master)
            .withColumn("dup_factor", F.coalesce("_by_master", F.lit(1)))
            .withColumn("dup_factor_source", F.when(F.col("_by_master").isNotNull(), "bundling")
                        .when(F.col("bundling_slot_count").isNull(), "not_in_master").otherwise("slot_mismatch"))
            .drop("_by_master"))


def combo_dup_factor(details: DataFrame, slots: DataFrame) -> DataFrame:
    """Bundle rows with their group size, slot count, duplication factor and where it came from."""
    folded = count_copies(details.filter(F.col("type") == fv.BUNDLE_TYPE))
    sizes = folded.groupBy("type", *fv.BUNDLE_GROUP_KEY).agg(F.sum("_copies").alias("_rows"))
    factors = _with_factor(sizes, "_rows", slots).drop("_rows", "type")
    return repeat_rows(join_per_key(folded, factors, fv.BUNDLE_GROUP_KEY, "inner"), "_copies")


def dedup_work(details: DataFrame, slots: DataFrame, order: list[str], bucket: Column) -> DataFrame:
    """Rows, folded where they are many, with everything the decision needs; ``_keep`` of their ``_copies`` stay."""
    few, many = _few_and_many(details)
    folded, per_bucket = _stats(many, bucket)
    df = _ranked(folded, _to_keep(_with_factor(per_bucket, "_t", slots)), details, order)
    known = slots.select(F.col("bundling_id").alias("_bundle"), *[c for c in slots.columns if c != "bundling_id"])
    numbered = _numbered(few, order)
    bundle = F.when(F.col("combo_group_rows").isNotNull(), F.col("bundling_id"))
    numbered = _to_keep(_judged(numbered.join(known, bundle == F.col("_bundle"), "left").drop("_bundle")))
    df = df.unionByName(numbered.select(*df.columns))
    before = F.col("_upto") - F.col("_copies")
    return df.withColumn("_keep", F.greatest(F.lit(0).cast("bigint"), F.least(F.col("_copies"), F.col("rows_to_keep") - before)))


def _to_keep(df: DataFrame) -> DataFrame:
    """How many rows of a key stay, and whether someone must look at them."""
    combo = F.col("type") == fv.BUNDLE_TYPE
    divisible = F.col("rows_per_key") % F.col("dup_factor") == 0
    keep = (F.when(combo & divisible, (F.col("rows_per_key") / F.col("dup_factor")).cast("bigint"))
            .when(combo, F.col("rows_per_key")).otherwise(F.lit(1).cast("bigint")))
    return (df.withColumn("rows_to_keep", keep)
            .withColumn("needs_manual_check", combo & (~divisible | (F.col("dup_factor_source") != "bundling"))))


def checked_types(details: DataFrame, known: list[str] = fv.DETAIL_TYPES) -> DataFrame:
    """Gate in the plan: unknown detail types could pass as single items, so a row of one stops the job that reads it."""
    message = F.concat(F.lit("unknown detail type, nothing was de-duplicated: "), F.coalesce("type", F.lit("<NULL>")))
    return details.withColumn("type", F.when(F.col("type").isin(*known), F.col("type")).otherwise(F.raise_error(message).cast("string")))


def unknown_types(details: DataFrame, known: list[str] = fv.DETAIL_TYPES) -> DataFrame:
    """Detail types outside the known ones with their row counts."""
    return (details.filter(F.col("type").isNull() | ~F.col("type").isin(*known))
            .groupBy(F.coalesce(F.col("type"), F.lit("<NULL>")).alias("type")).agg(F.count(F.lit(1)).alias("n_rows")))


def dedup_details(details: DataFrame, slots: DataFrame | None, order: list[str], bucket: Column,
                  strict: bool = True) -> DataFrame:
    """Single items: one row per key. Bundles: rows ÷ duplication factor, or all rows where the factor is uncertain."""
    if slots is None:
        raise ValueError("the bundle master is required: without it bundles cannot be told from duplicates")
    if strict:
        details = checked_types(details)
    work = dedup_work(details, slots, order, bucket)
    return repeat_rows(work.select(*details.columns, "_keep"), "_keep")


# --- reports --------------------------------------------------------------------------------------------------------

def slot_check(work: DataFrame) -> DataFrame:
    """Bundle groups after cleaning: rows left against slots in the master."""
    return (work.filter((F.col("type") == fv.BUNDLE_TYPE) & (F.col("_keep") > 0))
            .groupBy(*fv.BUNDLE_GROUP_KEY)
            .agg(F.min("product_generic_name").alias("bundling_name"), F.sum("_keep").alias("rows_after"),
                 F.first("bundling_slot_count").alias("bundling_slot_count"), F.first("dup_factor").alias("dup_factor"),
                 F.first("dup_factor_source").alias("dup_factor_source")))


def manual_check(work: DataFrame) -> DataFrame:
    """Distinct bundle rows whose duplication could not be settled."""
    return (work.filter("needs_manual_check")
            .select("order_id", "order_detail_id", "bundling_id", F.col("product_generic_name").alias("bundling_name"),
                    "product_name", "sku", "transactions_type", "rows_per_key", "bundling_slot_count", "dup_factor",
                    "dup_factor_source").distinct())


def slot_mismatch(work: DataFrame) -> DataFrame:
    """Bundle groups known to the master whose rows after cleaning differ from their slots."""
    return slot_check(work).filter(F.col("bundling_slot_count").isNotNull()
                                   & (F.col("rows_after") != F.col("bundling_slot_count")))


def bundles_not_in_master(work: DataFrame) -> DataFrame:
    """Bundles the master does not know, most frequent first."""
    return (slot_check(work).filter(F.col("bundling_slot_count").isNull())
            .groupBy("bundling_id", "bundling_name")
            .agg(F.count(F.lit(1)).alias("n_order_detail"),
                 F.array_join(F.array_sort(F.collect_set("dup_factor_source")), ", ").alias("dup_factor_source"))
            .orderBy(F.desc("n_order_detail"), "bundling_id", "bundling_name"))


def dedup_summary(work: DataFrame) -> DataFrame:
    """Counters of one cleaning run as one row, from one pass: rows are folded per detail before anything is counted."""
    combo = F.coalesce(F.col("type") == fv.BUNDLE_TYPE, F.lit(False))
    per_detail = work.groupBy(combo.alias("_combo"), *fv.BUNDLE_GROUP_KEY).agg(
        F.sum("_copies").alias("_raw"), F.sum("_keep").alias("_clean"), F.max("needs_manual_check").alias("_manual"),
        F.max("bundling_slot_count").alias("_slots"))
    is_combo = F.col("_combo")
    group = is_combo & (F.col("_clean") > 0)
    known = group & F.col("_slots").isNotNull()
    hit = F.col("_clean") == F.col("_slots")
    added = lambda c, keep: F.sum(F.when(keep, F.col(c)).otherwise(0))
    return per_detail.agg(
        F.sum("_raw").alias("details_raw"), F.sum("_clean").alias("details_clean"),
        added("_raw", ~is_combo).alias("details_noncombo_raw"), added("_clean", ~is_combo).alias("details_noncombo_clean"),
        added("_raw", is_combo).alias("details_combo_raw"), added("_clean", is_combo).alias("details_combo_clean"),
        F.countDistinct(F.when(F.col("_manual"), F.col("order_id"))).alias("needs_manual_check_orders"),
        F.countDistinct(F.when(is_combo, F.col("bundling_id"))).alias("bundling_in_period"),
        F.count_if(group).alias("combo_order_details"), F.count_if(known).alias("combo_in_master"),
        F.count_if(group & F.col("_slots").isNull()).alias("combo_not_in_master"),
        F.count_if(known & ~hit).alias("slot_mismatch_count"),
        np_round(F.try_divide(F.count_if(known & hit) * 100.0, F.nullif(F.count_if(known), F.lit(0))), 2).alias("combo_slot_match_pct"))


# --- gates ----------------------------------------------------------------------------------------------------------

def violations_details(details: DataFrame, component_counts: DataFrame) -> DataFrame:
    """Rows that must stop a load: single items twice on their key, bundles whose rows are not their components.

    ``component_counts``: order_detail_id, n_components (0 counts as 1; a detail that is not listed counts as 1).
    """
    single = (details.filter(~F.col("type").eqNullSafe(fv.BUNDLE_TYPE)).groupBy(*fv.DETAIL_KEY)
              .agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
              .select("order_id", "order_detail_id", "transactions_type", F.lit("single").alias("kind"), "n_rows",
                      F.lit(1).cast("bigint").alias("expected")))
    bundles = (details.filter(F.col("type") == fv.BUNDLE_TYPE).groupBy("order_id", "order_detail_id", "transactions_type")
               .agg(F.count(F.lit(1)).alias("n_rows")))
    expected = F.greatest(F.coalesce(F.col("n_components"), F.lit(0)), F.lit(1)).cast("bigint")
    bad = (bundles.join(component_counts, "order_detail_id", "left").withColumn("expected", expected)
           .filter(F.col("n_rows") != F.col("expected"))
           .select("order_id", "order_detail_id", "transactions_type", F.lit("bundle").alias("kind"), "n_rows", "expected"))
    return single.unionByName(bad)


def stop_on(violations: DataFrame, what: str, sample: int = 3) -> None:
    """Raise with a few examples when a gate found anything."""
    rows = violations.limit(sample).collect()
    if rows:
        raise ValueError(f"{what}: {[r.asDict() for r in rows]}")


def duplicate_keys(details: DataFrame) -> DataFrame:
    """Keys with more than one row, split in bundle and other."""
    return (details.groupBy(*fv.DETAIL_KEY).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)
            .agg(F.count_if(F.col("type") != fv.BUNDLE_TYPE).alias("duplicated_single"),
                 F.count_if(F.col("type") == fv.BUNDLE_TYPE).alias("duplicated_bundle")))


def duplicate_transactions(headers: DataFrame) -> DataFrame:
    """(order, transaction) pairs that occur more than once."""
    return (headers.groupBy("order_id", "transaction_id").agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def key_cardinality(headers: DataFrame) -> DataFrame:
    """Rows, orders and (order, transaction) pairs; pairs with a NULL part do not count."""
    return headers.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("order_id").alias("n_orders"),
                       F.countDistinct("order_id", "transaction_id").alias("n_keys"))
