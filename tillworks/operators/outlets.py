"""Outlet dimension and its effective-dated attributes.

No broadcast hints: the planner broadcasts a dimension below spark.sql.autoBroadcastJoinThreshold and shuffles beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ATTRIBUTES = ["ownership_model", "outlet_name", "outlet_brand", "region", "provinsi", "kota"]


def outlet_dimension(outlets: DataFrame, brand_names: DataFrame, transitions: DataFrame) -> DataFrame:
    """One row per distinct outlet: shown brand name, plus old model, old brand and date where it changed hands."""
    current = (outlets.join(brand_names, "brand", "left")
               .select("jilid", "customer_name", "region", "provinsi", "kota", "ownership_model",
                       F.coalesce("brand_name", "brand").alias("outlet_brand"))
               .distinct())
    old = (transitions.join(brand_names, "brand", "left")
           .select("jilid", F.to_date("start_date").alias("start_date"),
                   F.col("ownership_model").alias("old_ownership_model"),
                   F.col("brand_name").alias("old_outlet_brand")))
    return (current.join(old, "jilid", "left")
            .select("jilid", F.col("customer_name").alias("outlet_name"), "region", "provinsi", "kota",
                    "ownership_model", "outlet_brand", "start_date", "old_ownership_model", "old_outlet_brand"))


def as_of(day: Column, changed: str, old: str, current: str) -> Column:
    """Before the change the old value, even when NULL; else the current one, else '-'."""
    return (F.when(day < F.col(changed), F.col(old))
            .when(F.col(current).isNotNull(), F.col(current)).otherwise("-"))


def dated_attributes(day: Column) -> list[Column]:
    known = lambda c: F.coalesce(F.col(c), F.lit("-")).alias(c)
    return [
        as_of(day, "start_date", "old_ownership_model", "ownership_model").alias("ownership_model"),
        known("outlet_name"),
        as_of(day, "start_date", "old_outlet_brand", "outlet_brand").alias("outlet_brand"),
        known("region"), known("provinsi"), known("kota"),
    ]


def with_outlet(df: DataFrame, dimension: DataFrame, day: str, outlet: str = "outlet_code",
                how: str = "left") -> DataFrame:
    """Add the six outlet attributes valid on ``day``. Call it on aggregated rows: it then shuffles almost nothing."""
    dim = dimension.withColumnRenamed("jilid", "_jilid")
    joined = df.join(dim, F.col(outlet) == F.col("_jilid"), how)
    return joined.select(*df.columns, *dated_attributes(F.col(day)))
