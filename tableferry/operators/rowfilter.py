"""The row filter of a run and the emptiness test."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_filter(rows: DataFrame, condition: str | Column | None) -> DataFrame:
    """Rows that meet a Spark SQL predicate or a Column; none or blank keeps all.

    Placed on the scan, below any conversion, so that Spark can push it into
    the source.
    """
    if condition is None or (isinstance(condition, str) and not condition.strip()):
        return rows
    return rows.filter(condition)


def is_empty(rows: DataFrame) -> bool:
    """Whether there is no row, reading no more of the source than it takes to tell.

    ``take`` starts with one partition and goes on to more only while it finds
    nothing; ``DataFrame.isEmpty`` would start a task for every partition.
    """
    return not rows.select(F.lit(1)).take(1)


def is_repeatable(rows: DataFrame, condition: str | Column | None) -> bool:
    """Whether the filter picks the same rows whenever it is evaluated; nothing is run to tell.

    Spark refuses expressions such as ``rand()`` as arguments of aggregates.
    """
    if condition is None:
        return True
    column = F.expr(condition) if isinstance(condition, str) else condition
    try:
        rows.agg(F.count_if(column))
    except AnalysisException as error:
        if "NONDETERMINISTIC" in str(error.getCondition() or ""):
            return False
        raise
    return True
