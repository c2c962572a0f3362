"""A run over a list of tables."""

from __future__ import annotations

import logging
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tableferry.config import TableSpec, TransferConfig
from tableferry.functions.masking import mask_text
from tableferry.operators.swap import recover
from tableferry.plans.ledger import Ledger
from tableferry.plans.report import FAILED, RunReport, TableOutcome, TransferFailed
from tableferry.plans.transfer import transfer_table
from tableferry.sources.logical import discovered
from tableferry.sources.scan import open_table

log = logging.getLogger(__name__)

_JVM_FRAME = re.compile(r"^\t+(at |\.\.\. |Suppressed: ).*\n?", re.MULTILINE)


def describe(error: Exception) -> str:
    """Class and message, without the frames of the JVM and without secrets."""
    text = _JVM_FRAME.sub("", f"{type(error).__name__}: {error}")
    return mask_text(text.strip())


def _opened(spark: SparkSession, config: TransferConfig, spec: TableSpec) -> DataFrame | None:
    """The source of a table; None if it cannot be opened, which its own transfer will tell."""
    try:
        return open_table(spark, config, spec)
    except Exception:
        return None


def _size(table: DataFrame | None) -> int:
    """Bytes that Spark expects of a source; very many where the source does not say."""
    if table is None:
        return 0
    try:
        return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return 0


def longest_first(numbered: list[tuple[int, TableSpec]], sizes: dict[int, int]) -> list[tuple[int, TableSpec]]:
    """The tables in the order in which they should begin: large ones first, else as listed."""
    return sorted(numbered, key=lambda one: (-sizes.get(one[0], 0), one[0]))


def run(spark: SparkSession, config: TransferConfig, fail_on_error: bool = True) -> RunReport:
    """Copy every table; one that fails does not stop the others.

    Tables go one after another, or up to ``max_concurrent`` at a time, each as
    its own Spark jobs. Outcomes keep the order of the list either way. If any
    table failed, :class:`TransferFailed` is raised at the end, unless
    ``fail_on_error`` is off. Of several at a time the larger ones begin first. Overwrites that a job began and did not live to
    finish are settled first.
    """

    if config.types:
        config = replace(config, tables=discovered(spark, config.types, config.tables), types=None)

    try:
        recover(spark, config.sink_schema, [spec.sink_name for spec in config.tables])
    except Exception as error:  # the tables themselves will tell what is wrong with the schema
        log.warning("looking for swaps that died: %s", describe(error))

    ledger = Ledger(spark, config) if config.load_id else None
    attempts = ledger.attempts() if ledger else {}

    def loaded(order: int, spec: TableSpec, table: DataFrame | None) -> TableOutcome:
        given = () if table is None else (table,)
        if ledger is None:
            return transfer_table(spark, config, spec, order, *given)
        attempt = attempts.get(spec.sink_name)
        if earlier := ledger.done(spec, order, attempt):
            log.info("%s: done by an earlier run of load %s", spec.source, config.load_id)
            return earlier
        ledger.begin(spec, attempt)
        outcome = transfer_table(spark, config, spec, order, *given)
        ledger.end(spec, outcome)
        return outcome

    def isolated(order: int, spec: TableSpec, table: DataFrame | None = None) -> TableOutcome:
        try:
            return loaded(order, spec, table)
        except Exception as error:
            reason = describe(error)
            log.error("%s failed: %s", spec.source, reason)
            return TableOutcome(
                order,
                spec.source,
                spec.sink_name,
                config.save_mode.value,
                FAILED,
                error=reason,
            )

    numbered = list(enumerate(config.tables, 1))
    if config.concurrent:
        with ThreadPoolExecutor(min(config.max_concurrent, len(numbered))) as pool:
            # each table gets its own copy of the caller's Spark properties: a shared
            # one would mix up the job labels of tables that run at the same time
            def submit(*work):
                return pool.submit(inheritable_thread_target(spark)(work[0]), *work[1:])

            opened: dict[int, DataFrame] = {}
            if len(numbered) > config.max_concurrent:
                # a large table that begins last would run alone
                looked = {order: submit(_opened, spark, config, spec) for order, spec in numbered}
                opened = {order: w.result() for order, w in looked.items()}
                numbered = longest_first(numbered, {o: _size(t) for o, t in opened.items()})
            waiting = {order: submit(isolated, order, spec, opened.get(order)) for order, spec in numbered}
            try:
                outcomes = [waiting[order].result() for order in sorted(waiting)]
            except BaseException:  # an interrupt: tables not yet begun stay undone
                pool.shutdown(wait=False, cancel_futures=True)
                raise
    else:
        outcomes = [isolated(order, spec) for order, spec in numbered]

    report = RunReport(outcomes)
    if report.failed and fail_on_error:
        raise TransferFailed(report)
    return report
