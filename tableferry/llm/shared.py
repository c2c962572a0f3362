"""What the operators share: results kept in the shared folder, sums over partitions."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tableferry.functions.names import quote
from tableferry.plans.workspace import shared_folder

#: Partial results that one task adds up
FAN_IN = 32
#: Rows that a worker turns into Python objects at once
SLICE_ROWS = 1024


class Scratch:
    """A folder of one call's own below the shared one, for tables that later steps read.

    Written tables cut the lineage: a lost executor costs its running tasks, not
    the steps before.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(self.path(name))
        return self.spark.read.schema(rows.schema).parquet(self.path(name))


def text_column(rows: DataFrame, name: str = "text") -> Column:
    return F.col(quote(name)).cast("string")


def sliced(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches as slices of at most SLICE_ROWS rows, none empty."""
    for batch in each:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def batches(
    rows: DataFrame, convert: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType
) -> DataFrame:
    """``convert`` on slices of every Arrow batch; memory is bounded by the batch."""

    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(each):
            yield convert(batch)

    return rows.mapInArrow(run, schema)


def added_up(rows: DataFrame, column: str, combine=np.add, dtype=np.int64) -> np.ndarray | None:
    """One vector out of the vectors (as bytes, of a fixed length) in ``column``.

    A tree of tasks that each hold two vectors, however many there are; only
    the last one comes to the driver.
    """

    def fold(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in each:
            for value in batch.column(0):
                if (blob := value.as_py()) is not None:
                    one = np.frombuffer(blob, dtype)
                    total = one.copy() if total is None else combine(total, one, out=total)
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["v"])

    parts = rows.select(F.col(column).alias("v"))
    n = parts.rdd.getNumPartitions()
    parts = parts.mapInArrow(fold, "v binary")
    while n > 1:
        n = -(-n // FAN_IN)
        parts = parts.repartition(n).mapInArrow(fold, "v binary")
    found = parts.collect()
    return np.frombuffer(bytes(found[0]["v"]), dtype) if found else None
