"""What became of each table of a load: a repeated load copies only what is not in its sink yet.

The ledger is a table beside the sinks. It gets a row when the copy of a table begins and one when it has
ended; rows are never changed, the last one of a load and sink counts. An append of a load puts a mark into
the names of its files that follows from the load's id, so what an attempt left that failed its
verification, or whose job died after it had written, is found and removed before the append is tried again.
"""

from __future__ import annotations

import hashlib
import json
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.config import ConfigError, SaveMode, TableSpec, TransferConfig
from tableferry.functions.names import identifier_parts, qualified
from tableferry.operators import newfiles
from tableferry.operators.sink import described, sink_exists, sink_identifier
from tableferry.plans.report import COPIED, SKIPPED_EMPTY, SKIPPED_EXISTS, TableOutcome

BEGUN = "begun"
#: States that a repeated load leaves as they are
_DONE = (COPIED, SKIPPED_EMPTY, SKIPPED_EXISTS)
_COUNTS = ("source_rows", "rows_before", "sink_rows", "verified")

_SCHEMA = (
    "load_id string, config string, sink string, state string, at_micros long, source_rows long, "
    "rows_before long, sink_rows long, verified boolean, error string"
)


@dataclass(frozen=True)
class Attempt:
    """The last thing known of a table of a load."""

    state: str
    counts: dict


def configuration_key(config: TransferConfig) -> str:
    """A digest of what decides which rows go where, apart from how tables are scheduled or verified."""
    said = {
        "source": [config.source_format, config.source_table_key, dict(config.source_options)],
        "sink": [config.sink_schema, config.sink_format, config.sink_location],
        "mode": config.save_mode.value,
        "filter": None if config.filter is None else str(config.filter),
        "bitmaps": config.bitmap_to_binary,
    }
    return hashlib.sha256(json.dumps(said, sort_keys=True, default=str).encode()).hexdigest()


def mark_of(config: TransferConfig, spec: TableSpec) -> str | None:
    """What the files of this load's append to a sink are named after."""
    if config.load_id is None or config.save_mode is not SaveMode.APPEND:
        return None
    return hashlib.sha256(f"{config.load_id}\n{spec.sink_name.lower()}".encode()).hexdigest()[:32]


class Ledger:
    def __init__(self, spark: SparkSession, config: TransferConfig):
        self.spark, self.config = spark, config
        self.key = configuration_key(config)
        self.name = qualified(*identifier_parts(config.sink_schema), config.ledger)
        if not sink_exists(spark, self.name):
            spark.createDataFrame([], _SCHEMA).write.mode("ignore").saveAsTable(self.name)

    def attempts(self) -> dict[str, Attempt]:
        """The last attempt for each sink of this load."""
        names = [t.sink_name for t in self.config.tables]
        mine = self.spark.table(self.name).where(
            (F.col("load_id") == self.config.load_id) & F.col("sink").isin(*names)
        )
        last = mine.groupBy("sink").agg(F.max_by(F.struct("state", "config", *_COUNTS), "at_micros").alias("last"))
        found = {}
        for row in last.select("sink", "last.*").collect():
            if row["config"] != self.key:
                raise ConfigError(
                    f"load {self.config.load_id!r} was begun with another source, sink, mode or filter; "
                    "give this one an id of its own"
                )
            found[row["sink"]] = Attempt(row["state"], {k: row[k] for k in _COUNTS})
        return found

    def _note(self, sink: str, state: str, outcome: TableOutcome | None = None) -> None:
        counts = [getattr(outcome, k, None) for k in _COUNTS]
        row = (self.config.load_id, self.key, sink, state, time.time_ns() // 1000, *counts, getattr(outcome, "error", None))
        self.spark.createDataFrame([row], _SCHEMA).coalesce(1).write.insertInto(self.name)

    def done(self, spec: TableSpec, order: int, attempt: Attempt | None) -> TableOutcome | None:
        """The outcome of a table that this load has copied already."""
        if attempt is None or attempt.state not in _DONE:
            return None
        mode = self.config.save_mode.value
        return TableOutcome(order, spec.source, spec.sink_name, mode, attempt.state, **attempt.counts)

    def begin(self, spec: TableSpec, attempt: Attempt | None) -> None:
        """Note that a table is begun; what an earlier attempt appended goes first."""
        sink = sink_identifier(self.config, spec.sink_name)
        mark = mark_of(self.config, spec)
        if mark and attempt is not None and sink_exists(self.spark, sink):
            if not newfiles.can_be_told(self.spark, sink, described(self.spark, sink)):
                raise ConfigError(
                    f"{sink} may hold rows of an earlier attempt of load {self.config.load_id!r}, and rows "
                    "of this sink cannot be told by their files"
                )
            newfiles.remove(self.spark, sink, mark)
        self._note(spec.sink_name, BEGUN)

    def end(self, spec: TableSpec, outcome: TableOutcome) -> None:
        self._note(spec.sink_name, outcome.status, outcome)


def ledger_rows(spark: SparkSession, config: TransferConfig) -> DataFrame:
    """The ledger beside the sinks of a run."""
    return spark.table(qualified(*identifier_parts(config.sink_schema), config.ledger))
