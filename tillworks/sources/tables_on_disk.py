"""Stored tables in partitioned folders, changed by whole loads.

Every table is cut into parts by a label of its rows, a month or a bucket of keys, and a load rewrites the parts it touches and no others.
A load writes its output to a staging folder, gates look at what was written, one pointer then says that the load counts, and the staged
part folders are moved in place. A load that fails before its pointer leaves the tables as they were; one that stops behind it is
finished by whoever opens the tables next, which may be done any number of times. One load runs at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillworks.functions.scalars import col
from tillworks.session import delete_path, folders_below, move_path, observed, path_exists, write_text
from tillworks.sources.tables import window_scan

PART = "_part"
#: The part that holds no rows, but the schema of a table.
EMPTY = "-"

Gate = Callable[[Mapping[str, DataFrame]], None]


def by_month(day: str | Column) -> Column:
    """Label: the month of a date or time, ``none`` where there is none."""
    return F.coalesce(F.substring(F.to_date(col(day)).cast("string"), 1, 7), F.lit("none"))


def by_bucket(key: str | Column, buckets: int) -> Column:
    """Label: one of ``buckets`` numbers by the hash of a key; NULL has one of its own."""
    return F.pmod(F.xxhash64(col(key)), F.lit(buckets)).cast("string")


def months_between(start: str, end: str) -> list[str]:
    """The labels of :func:`by_month` for a window of days."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]


class Tables:
    """Tables below one folder, which must be shared by the whole cluster. ``layouts``: the label of each table's rows."""

    def __init__(self, spark: SparkSession, path: str, layouts: Mapping[str, Column]):
        self.spark, self.path, self.layouts = spark, path.rstrip("/"), dict(layouts)

    def _folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def has(self, name: str) -> bool:
        self.finish()
        return path_exists(self.spark, self._folder(name))

    def read(self, name: str, parts: Iterable[str] | None = None) -> DataFrame:
        """A table, or some of its parts: the others are not listed for reading."""
        self.finish()
        rows = self.spark.read.parquet(self._folder(name))
        if parts is not None:
            rows = rows.where(F.col(PART).isin(*parts, EMPTY))
        return rows.drop(PART)

    def window(self, name: str, ts: str, start: str, end: str, days_before: int = 0, days_after: int = 0) -> DataFrame:
        """Rows of a table cut by months of ``ts`` whose date is in [start, end], widened by whole days; only these months are listed."""
        first, last = date.fromisoformat(start) - timedelta(days_before), date.fromisoformat(end) + timedelta(days_after)
        return window_scan(self.read(name, months_between(str(first), str(last))), ts, start, end, days_before, days_after)

    def of_keys(self, name: str, keys: DataFrame, on: str, day: str, days: int = 1) -> DataFrame:
        """Rows of a table cut by months whose key is in another frame, and whose month lies within some days of that frame's ``day``. The
        months are found while the query runs: where ``keys`` is small enough to be broadcast, only their parts are read."""
        self.finish()
        edges = F.array(*[by_month(F.date_add(F.to_date(day), n)) for n in sorted({-days, 0, days})])
        wanted = keys.select(on, F.explode(F.array_distinct(edges)).alias(PART))
        return self.spark.read.parquet(self._folder(name)).join(wanted, [PART, on], "left_semi").drop(PART)

    def parts(self, rows: DataFrame, name: str) -> list[str]:
        """The labels that rows have in a table: months or buckets, so a bounded list."""
        return sorted(r[0] for r in rows.select(self.layouts[name]).distinct().collect())

    def stage(self, frame: DataFrame, like: str | None = None) -> DataFrame:
        """Work a frame out once, into a folder of its own that goes with the load; with ``like`` its files are cut by the parts of that table,
        so that a load need not spread its rows."""
        folder = f"{self.path}/_staged/{uuid.uuid4().hex}"
        rows = frame if like is None else frame.withColumn(PART, self.layouts[like]).hint("rebalance", PART).drop(PART)
        rows.write.option("compression", "zstd").parquet(folder)
        return self.spark.read.schema(frame.schema).parquet(folder)

    def load(self, frames: Mapping[str, DataFrame], touched: Mapping[str, list[str]] | None = None, gates: Iterable[Gate] = (),
             spread: bool = True) -> dict[str, int]:
        """Put frames in place of the touched parts of their tables (of all parts, where ``touched`` does not name the table). Every gate sees
        what was written and may raise. Returns the rows written per table, counted while they were written. Rows are shuffled by part first,
        unless they are read by part already and ``spread`` says no."""
        self.finish()
        load = uuid.uuid4().hex
        written, rows, plan = {}, {}, {}
        for name, frame in frames.items():
            told, folder = Observation(), f"{self.path}/_staged/{load}/{name}"
            labelled = frame.observe(told, F.count(F.lit(1)).alias("n")).withColumn(PART, self.layouts[name])
            (labelled.hint("rebalance", PART) if spread else labelled).write.option("compression", "zstd").partitionBy(PART).parquet(folder)
            self.spark.createDataFrame([], frame.schema).write.parquet(f"{folder}/{PART}={EMPTY}")
            rows[name] = observed(told).get("n", 0)
            written[name] = self.spark.read.parquet(folder).drop(PART)
            new = self._labels(folder)
            old = (touched or {}).get(name)
            plan[name] = {"new": new, "gone": sorted(set(self._labels(self._folder(name)) if old is None else old) - set(new))}
        for gate in gates:
            gate(written)
        write_text(self.spark, f"{self.path}/pointer.json", json.dumps({"load": load, "tables": plan}))
        self.finish()
        return rows

    def _labels(self, folder: str) -> list[str]:
        """The parts that a folder holds."""
        return sorted(n.removeprefix(f"{PART}=") for n in folders_below(self.spark, folder) if n.startswith(f"{PART}="))

    def finish(self) -> None:
        """Put the parts of a load in place that has its pointer; nothing to do if there is none. A part that is not staged any more is in
        place already."""
        if not path_exists(self.spark, f"{self.path}/pointer.json"):
            return
        pointer = json.loads(self.spark.read.text(f"{self.path}/pointer.json", wholetext=True).first()[0])
        for name, plan in pointer["tables"].items():
            for part in plan["gone"]:
                delete_path(self.spark, f"{self._folder(name)}/{PART}={part}")
            for part in plan["new"]:
                move_path(self.spark, f"{self.path}/_staged/{pointer['load']}/{name}/{PART}={part}", f"{self._folder(name)}/{PART}={part}")
        delete_path(self.spark, f"{self.path}/pointer.json")
        delete_path(self.spark, f"{self.path}/_staged")
