"""The upsert as a stream: what has arrived since the last run, once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeward.operators.merge import upsert
from lakeward.operators.retype import latest_by
from lakeward.sources.snapshot import Table


def upsert_stream(source: DataFrame, table: Table, keys: list[str], order: list, checkpoint: str, update: list[str] | None = None) -> None:
    """Merges all new rows of a streaming frame into a table, batch by batch; of rows with
    one key in a batch the first in `order` counts. A partitioned table rewrites the partitions
    that a batch touches, so its partition column has to be one of the keys. Returns when all
    input is read."""
    if table.partition is not None and table.partition not in keys:
        raise ValueError(f"{table.partition} is not one of the keys {keys}")

    def merge(batch: DataFrame, _: int) -> None:
        rows = latest_by(batch, keys, order)
        if table.exists():
            table.merge_partitions(rows, lambda stored, new: upsert(stored, new, keys, update, check=False))
        else:
            table.replace_all(rows)

    source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
