"""Names for the jobs of each table in the Spark UI."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import SparkContext

GROUP = "spark.jobGroup.id"
DESCRIPTION = "spark.job.description"
POOL = "spark.scheduler.pool"


@contextmanager
def labelled(sc: SparkContext, table: str, order: int, total: int) -> Iterator[Callable[[str], None]]:
    """Name the jobs of this thread after the table until the block ends.

    Yields a function that takes what the next jobs do. Under
    ``spark.scheduler.mode=FAIR`` each table is a pool, so large and small ones
    share the cluster.
    """
    own = f"tableferry-{order}"
    earlier = {key: sc.getLocalProperty(key) for key in (GROUP, DESCRIPTION, POOL)}
    sc.setLocalProperty(GROUP, own)
    sc.setLocalProperty(POOL, own)
    try:
        yield lambda doing: sc.setLocalProperty(
            DESCRIPTION, f"table {order} of {total}, {table}: {doing}"
        )
    finally:
        for key, value in earlier.items():
            sc.setLocalProperty(key, value)
