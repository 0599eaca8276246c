"""What the stateful streams share: the state store, the tables their batches leave, and figures of the state.

A stream that updates rows appends each micro-batch's rows to a folder of its own below the answer's folder; a batch that runs again writes
the same folder again. The answer holds, for each key, the row of the newest batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillworks.functions.skew import first_per_key

#: State in RocksDB, on disk instead of in the heap; no batch without rows, as these streams tell nothing new when the watermark moves.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
BATCH = "batch"


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """Streams started inside run with SETTINGS; the session's own ones come back."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start_updates(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Run a stateful stream over what its source holds now; every batch's rows go to ``folder``."""
    # an empty batch, so that the answer can be read before the first row came
    rows.sparkSession.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{folder}/{BATCH}=-1")
    with state_settings(rows.sparkSession):
        return (rows.writeStream.outputMode("update").foreachBatch(batch_writer(folder)).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())


def batch_writer(folder: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that keeps each batch in a folder named by its number."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")
    return write


def newest(spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(folder)
    return first_per_key(rows, keys, [F.col(BATCH)], last=True).drop(BATCH)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait until a stream has read what was there; raises what stopped it."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return query


def state_figures(query: StreamingQuery) -> dict[str, int]:
    """Rows and bytes that the stream's operators hold, and rows that came too late for them, over all its batches."""
    operators = [op for p in query.recentProgress for op in p["stateOperators"]]
    last = query.lastProgress["stateOperators"] if query.lastProgress else []
    return {"rows": sum(op["numRowsTotal"] for op in last), "bytes": sum(op["memoryUsedBytes"] for op in last),
            "dropped": sum(op["numRowsDroppedByWatermark"] for op in operators)}
