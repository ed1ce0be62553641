"""Exactly-once de-duplication of a stream by id, in the state store of the query.

The state store holds each id; the first event of an id goes on, later ones do
not. The store is checkpointed with the offsets, and a file sink commits a
micro-batch as a whole, so a run that is stopped and started again gives each
event once. Without a time to live an id is remembered for good, by the engine's
own operator, which looks ids up where the store is. With one an id is forgotten
so long after it came; then each id of a micro-batch is a call of Python. A
checkpoint belongs to one of the two: Spark does not continue it with the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

#: The store that arbitrary state needs.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstOfId(StatefulProcessor):
    """Passes the first event of each id on, until its time to live is over."""

    def __init__(self, time_to_live_ms: int):
        self.time_to_live_ms = time_to_live_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.time_to_live_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.seen.exists()
        for batch in rows:
            if not known and len(batch):
                known = True
                self.seen.update((True,))
                yield batch.head(1)

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """Set the store this needs; queries that run already keep theirs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def first_of_ids(events: DataFrame, key: str = "event_id", time_to_live_ms: int | None = None) -> DataFrame:
    """The first event of each id of a stream, all columns; events without an id are left out.

    Which of several events with one id in one micro-batch comes first is not
    fixed; order them by making the id tell them apart. ``time_to_live_ms``
    bounds the state of ids that never come again.
    """
    use_state_store(events.sparkSession)
    schema: StructType = events.schema
    known = events.where(f"length(`{key}`) > 0")
    if time_to_live_ms is None:
        # Inside a struct a watermark of the input can't make this operator leave late events out.
        packed = known.select(F.col(f"`{key}`").alias("id"), F.struct("*").alias("event"))
        return packed.dropDuplicates(["id"]).select("event.*")
    return known.groupBy(key).transformWithStateInPandas(
        FirstOfId(time_to_live_ms), outputStructType=schema, outputMode="Append", timeMode="ProcessingTime"
    )
