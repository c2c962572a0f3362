"""The transfer of one table."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession

from tableferry.config import ConfigError, OnEmpty, SaveMode, TableSpec, TransferConfig, Verify
from tableferry.operators import newfiles, verify
from tableferry.operators.fingerprint import ROWS, facts, row_count
from tableferry.operators.projection import bitmap_text_columns, project
from tableferry.operators.rowfilter import apply_filter, is_empty, is_repeatable
from tableferry.operators.sink import (
    check_existing,
    create_sink,
    described,
    insert,
    insert_observed,
    sink_exists,
    sink_identifier,
)
from tableferry.operators.swap import replace
from tableferry.plans.labels import labelled
from tableferry.plans.ledger import mark_of
from tableferry.plans.report import (
    COPIED,
    FAILED,
    SKIPPED_EMPTY,
    SKIPPED_EXISTS,
    TableOutcome,
)
from tableferry.sources.scan import open_table, register_view

log = logging.getLogger(__name__)


class SinkNotEmpty(RuntimeError):
    """The sink holds rows and the save mode is errorifexists."""


def transfer_table(
    spark: SparkSession,
    config: TransferConfig,
    spec: TableSpec,
    order: int = 1,
    table: DataFrame | None = None,
) -> TableOutcome:
    """Copy one table. Errors are raised, a failed verification is an outcome.

    The source is opened once, unless it is given as ``table``, so that every job sees the same listing of it,
    and is scanned in full once.
    """
    total = len(config.tables)
    mode = config.save_mode

    def outcome(status: str, **found) -> TableOutcome:
        log.info("%s (%d/%d): %s", spec.source, order, total, status)
        return TableOutcome(order, spec.source, spec.sink_name, mode.value, status, **found)

    with labelled(spark.sparkContext, spec.source, order, total) as step:
        step("looking at the source")
        table = open_table(spark, config, spec) if table is None else table
        rows = apply_filter(table, config.filter)
        projected = project(rows, config.bitmap_to_binary)
        converted = bitmap_text_columns(rows) if config.bitmap_to_binary else []
        sink = sink_identifier(config, spec.sink_name)
        _check_verification(config, table)

        step("looking at the sink")
        exists = sink_exists(spark, sink)
        if exists:
            check_existing(spark, sink, projected)
        may_hold_rows = exists or config.sink_outside_catalog
        skipped = _prepare(spark, config, spec, sink, exists, rows, projected)
        if skipped == SKIPPED_EMPTY:
            return outcome(skipped, source_rows=0)
        if skipped:
            return outcome(skipped)
        if config.register_source_views:
            register_view(rows, spec.sink_name)

        # rows that were there before count only where they stay; only then does the filter
        # tell old and new ones apart, or at least keep the count to the partitions loaded
        added_to = mode is SaveMode.APPEND and may_hold_rows
        if config.verify in (Verify.ADDED, Verify.FINGERPRINT):
            step("writing and verifying")
            status, found = _checked_write(spark, config, spec, table, projected, sink, added_to)
            return outcome(status, **found)
        condition = config.filter if added_to else None
        rows_before = None
        if config.verify is not Verify.OFF:
            step("counting the sink")
            # analysed before anything is written, so a filter the sink cannot take fails here
            before = verify.sink_rows(spark, sink, condition, converted)
            rows_before = verify.count_rows(before) if added_to else 0

        step("writing")
        if mode is SaveMode.OVERWRITE and not is_empty(spark.table(sink)):
            source_rows = replace(spark, projected, sink, config.rebalance)
        else:
            source_rows = _insert(spark, config, spec, projected, sink)
        if source_rows == 0 and not _may_truncate(config):
            return outcome(SKIPPED_EMPTY, source_rows=0)
        if config.verify is Verify.OFF:
            return outcome(COPIED, source_rows=source_rows)

        step("verifying")
        after = verify.sink_rows(spark, sink, condition, converted)
        if config.verify is Verify.RECOUNT:
            source_rows, sink_rows = verify.count_both(rows, after)
        else:
            sink_rows = verify.count_rows(after)
            if sink_rows - rows_before != source_rows and is_repeatable(table, config.filter):
                # either the count did not come, or a sink that shuffles the rows once more
                # had lost tasks counted twice: a recount of the source settles it
                source_rows = verify.count_rows(rows)
        if source_rows is None:
            return outcome(
                FAILED,
                rows_before=rows_before,
                sink_rows=sink_rows,
                verified=False,
                error="verification failed: the write gave no count of its rows",
            )
        added = sink_rows - rows_before
        verified = added == source_rows
        return outcome(
            COPIED if verified else FAILED,
            source_rows=source_rows,
            rows_before=rows_before,
            sink_rows=sink_rows,
            verified=verified,
            error=None
            if verified
            else f"verification failed: {source_rows} source rows, {added} new sink rows",
        )


def _insert(
    spark: SparkSession, config: TransferConfig, spec: TableSpec, projected: DataFrame, sink: str
) -> int | None:
    mark = mark_of(config, spec)
    if mark and newfiles.can_be_told(spark, sink, described(spark, sink)):
        written = insert_observed(spark, projected, sink, False, config.rebalance, mark=mark)
        return written[ROWS] if written else None
    return insert(spark, projected, sink, config.save_mode is SaveMode.OVERWRITE, config.rebalance)


def _checked_write(
    spark: SparkSession,
    config: TransferConfig,
    spec: TableSpec,
    table: DataFrame,
    projected: DataFrame,
    sink: str,
    added_to: bool,
) -> tuple[str, dict]:
    """Write, and compare facts about the rows written with those about the rows found.

    After an append the rows found are those of its own files, so what the sink held and what other
    jobs append meanwhile does not matter. Facts can be added up: where rows cannot be told by
    their files they are taken before and after, and subtracted.
    """
    by_value = config.verify is Verify.FINGERPRINT
    measured = facts if by_value else row_count
    overwrite = config.save_mode is SaveMode.OVERWRITE

    def of(rows: DataFrame) -> dict[str, int]:
        return rows.agg(*measured(schema)).first().asDict()

    schema = spark.table(sink).schema
    mark = None
    if config.save_mode is SaveMode.APPEND and newfiles.can_be_told(spark, sink, described(spark, sink)):
        mark = mark_of(config, spec) or uuid.uuid4().hex
    before = of(spark.table(sink)) if added_to and not mark else None

    def write(spark: SparkSession, rows: DataFrame, to: str, overwrite: bool, rebalance: bool):
        return insert_observed(spark, rows, to, overwrite, rebalance, measured, mark)

    if overwrite and not is_empty(spark.table(sink)):
        written = replace(spark, projected, sink, config.rebalance, write)
    else:
        written = write(spark, projected, sink, overwrite, config.rebalance)
    if written and written[ROWS] == 0 and not _may_truncate(config):
        return SKIPPED_EMPTY, {"source_rows": 0}

    spark.catalog.refreshTable(sink)
    found = of(newfiles.rows_of(spark, sink, mark) if mark else spark.table(sink))
    if before:
        found = {k: v - before[k] for k, v in found.items()}
    if written != found and is_repeatable(table, config.filter):
        # the facts did not come, or a sink that shuffles the rows once more had lost tasks counted twice
        written = of(projected)
    error = None
    if written is None:
        error = "verification failed: the write gave no facts about its rows"
    elif found[ROWS] != written[ROWS]:
        error = f"verification failed: {written[ROWS]} source rows, {found[ROWS]} new sink rows"
    elif found != written:
        error = f"verification failed: the values of the {found[ROWS]} new sink rows are not those of the source"
    return FAILED if error else COPIED, {
        "source_rows": written[ROWS] if written else None,
        "rows_before": before[ROWS] if before else None if added_to else 0,
        "sink_rows": found[ROWS] + (before[ROWS] if before else 0),
        "verified": error is None,
        "error": error,
    }


def _check_verification(config: TransferConfig, table: DataFrame) -> None:
    """Refuse checks that would evaluate a filter again which picks other rows each time."""
    again = config.verify is Verify.RECOUNT or (
        config.verify is Verify.OBSERVED and config.save_mode is SaveMode.APPEND
    )
    if again and not is_repeatable(table, config.filter):
        raise ConfigError(
            "the filter picks other rows each time it is evaluated, so this load cannot be "
            "verified by counting under it; overwrite with verify='observed', or do not verify"
        )


def _may_truncate(config: TransferConfig) -> bool:
    return config.save_mode is SaveMode.OVERWRITE and config.on_empty is OnEmpty.TRUNCATE


def _prepare(
    spark: SparkSession,
    config: TransferConfig,
    spec: TableSpec,
    sink: str,
    exists: bool,
    rows: DataFrame,
    projected: DataFrame,
) -> str | None:
    """Create the sink if it is absent; returns a status if the table must be skipped.

    The source is probed for rows only where an empty one must leave the sink
    alone: before a sink is created and before one with rows is overwritten,
    refused or skipped. Elsewhere writing no rows changes nothing, and the count
    from the write tells.
    """
    truncate = _may_truncate(config)
    if not exists:
        if not (truncate and config.sink_outside_catalog) and is_empty(rows):
            return SKIPPED_EMPTY
        create_sink(spark, config, sink, spec.sink_name, projected.schema)
        if not config.sink_outside_catalog:
            return None
    if config.save_mode is SaveMode.APPEND or is_empty(spark.table(sink)):
        return None
    if exists and not truncate and is_empty(rows):
        return SKIPPED_EMPTY
    if config.save_mode is SaveMode.IGNORE:
        return SKIPPED_EXISTS
    if config.save_mode is SaveMode.ERROR_IF_EXISTS:
        raise SinkNotEmpty(f"{sink} holds rows and the save mode is errorifexists")
    return None
