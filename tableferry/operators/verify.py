"""Row counts of source and sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.operators.projection import restore_text
from tableferry.operators.rowfilter import apply_filter

SOURCE = "source"
SINK = "sink"


def sink_rows(
    spark: SparkSession, sink: str, condition: str | Column | None, converted: list[str]
) -> DataFrame:
    """The sink rows that meet the filter of the run.

    Converted columns are read as text again, so the predicate means on the
    sink what it meant on the source.
    """
    table = spark.table(sink)
    if condition is not None and converted:
        table = restore_text(table, converted)
    return apply_filter(table, condition)


def count_rows(rows: DataFrame) -> int:
    return rows.count()


def verification_counts(source: DataFrame, sink: DataFrame) -> DataFrame:
    """Rows ``(side, rows)`` for both sides in one plan, so both scans run at the same time."""

    def counted(rows: DataFrame, side: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(side).alias("side"), "rows")

    return counted(source, SOURCE).unionByName(counted(sink, SINK))


def count_both(source: DataFrame, sink: DataFrame) -> tuple[int, int]:
    rows = {r["side"]: r["rows"] for r in verification_counts(source, sink).collect()}
    return rows[SOURCE], rows[SINK]
