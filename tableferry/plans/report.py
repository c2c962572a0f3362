"""Outcomes of a run as data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COPIED = "copied"
SKIPPED_EMPTY = "skipped_empty"
SKIPPED_EXISTS = "skipped_exists"
FAILED = "failed"

REPORT_SCHEMA = (
    "run_order int, table string, sink string, mode string, status string, "
    "source_rows long, rows_before long, sink_rows long, verified boolean, error string"
)


@dataclass(frozen=True)
class TableOutcome:
    """What happened to one table.

    ``source_rows`` are the rows given to the writer. ``rows_before`` are the
    sink rows that the write kept; it and ``sink_rows`` are counted, under the
    filter of the run, only for verification.
    """

    run_order: int
    table: str
    sink: str
    mode: str
    status: str
    source_rows: int | None = None
    rows_before: int | None = None
    sink_rows: int | None = None
    verified: bool | None = None
    error: str | None = None

    @property
    def succeeded(self) -> bool:
        return self.status != FAILED


@dataclass(frozen=True)
class RunReport:
    """The outcomes of a run, in the order of its table list."""

    outcomes: Sequence[TableOutcome]

    @property
    def failed(self) -> list[TableOutcome]:
        return [o for o in self.outcomes if not o.succeeded]

    def outcome(self, sink_name: str) -> TableOutcome:
        return next(o for o in self.outcomes if o.sink == sink_name)

    def to_df(self, spark: SparkSession) -> DataFrame:
        """One row per table of the run."""
        return spark.createDataFrame([astuple(o) for o in self.outcomes], REPORT_SCHEMA)

    def totals(self, spark: SparkSession) -> DataFrame:
        return run_totals(self.to_df(spark))


def run_totals(report: DataFrame) -> DataFrame:
    """``total, succeeded, failed, success_pct``; the rate has one decimal, NULL without tables."""
    counts = report.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") != FAILED).alias("succeeded"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
    )
    rate = F.try_divide(F.col("succeeded") * 100.0, F.col("total"))
    return counts.withColumn("success_pct", F.round(rate, 1))


class TransferFailed(RuntimeError):
    """At least one table of a run failed; ``report`` has all outcomes."""

    def __init__(self, report: RunReport):
        self.report = report
        lines = [f"  {o.table}: {o.error}" for o in report.failed]
        super().__init__(
            f"{len(report.failed)} of {len(report.outcomes)} tables failed\n" + "\n".join(lines)
        )
