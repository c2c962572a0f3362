"""Scanning source tables, and previews of them."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession

from tableferry.config import TableSpec, TransferConfig
from tableferry.functions.names import quote
from tableferry.operators.rowfilter import apply_filter
from tableferry.sources.logical import native_schema, tag_logical_types
from tableferry.sources.splits import both, ends_of_ranges, predicates, united

log = logging.getLogger(__name__)

CATALOG = "catalog"


def read_table(
    spark: SparkSession,
    source_format: str,
    table: str,
    table_key: str = "path",
    options: dict[str, str] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Any table of any Spark reader: ``table`` goes under the option ``table_key``.

    A predicate that the source itself should evaluate is one more reader
    option; filters on the result are pushed down by Spark where the source
    supports it. The files of a table are listed anew, since Spark would
    otherwise go by the listing of an earlier use in the same session. With a
    ``schema`` (DDL text) readers that would infer one from the rows need not.
    """
    reader = spark.read.options(**(options or {}))
    if schema:
        reader = reader.schema(schema)
    if source_format == CATALOG:
        spark.catalog.refreshTable(table)
        return reader.table(table)
    return reader.format(source_format).option(table_key, table).load()


def open_table(spark: SparkSession, config: TransferConfig, spec: TableSpec) -> DataFrame:
    """All rows of one table, with its logical column types in the metadata.

    A source that takes a predicate gets the filter of the run, which Spark evaluates again on
    what comes, and the ranges of a table that is to be split.
    """
    table = _split(spark, config, spec) if spec.split_column else _scan(spark, config, spec)
    tagged = tag_logical_types(table, spec.logical_types)
    if log.isEnabledFor(logging.INFO):
        log.info("schema of %s:\n%s", spec.source, tagged.schema.treeString())
    return tagged


def _scan(spark: SparkSession, config: TransferConfig, spec: TableSpec, within: str | None = None) -> DataFrame:
    """One scan of the source, of a range of its rows if one is given."""
    options = {**config.source_options, **spec.source_options}
    if key := config.source_predicate_key:
        wanted = config.filter if isinstance(config.filter, str) else None
        if said := both(options.get(key), wanted, within):
            options[key] = said
    if within is None and not spec.split_column:
        _warn_of_one_task(config.source_format, spec.source, options)
    return read_table(
        spark, config.source_format, spec.source, config.source_table_key, options, spec.schema
    )


def _split(spark: SparkSession, config: TransferConfig, spec: TableSpec) -> DataFrame:
    """Scans of disjoint ranges side by side.

    Spark evaluates the ranges too, so rows come once even if the source takes no notice of them.
    """
    whole = _scan(spark, config, spec)
    column = quote(spec.split_column)
    ends = ends_of_ranges(apply_filter(whole, config.filter), spec.split_column, spec.splits)
    ranges = predicates(spec.split_column, ends)
    if not ranges:
        return whole
    if config.source_format.lower() == "jdbc" and not config.source_predicate_key:
        options = {**config.source_options, **spec.source_options}
        return spark.read.jdbc(options.pop("url"), spec.source, predicates=ranges, properties=options)
    checks = predicates(column, ends)
    return united([_scan(spark, config, spec, r).where(check) for r, check in zip(ranges, checks)])


def open_source(spark: SparkSession, config: TransferConfig, spec: TableSpec) -> DataFrame:
    """The filtered rows of one table, with its logical column types in the metadata."""
    return apply_filter(open_table(spark, config, spec), config.filter)


def _warn_of_one_task(source_format: str, table: str, options: dict[str, str]) -> None:
    given = {k.lower() for k in options}
    if source_format.lower() == "jdbc" and not given & {"numpartitions", "partitioncolumn"}:
        log.warning(
            "%s is read by one task; give it a split column, or partitionColumn, lowerBound, "
            "upperBound and numPartitions as table options",
            table,
        )


def schema_report(spark: SparkSession, config: TransferConfig) -> DataFrame:
    """The columns of every source table as rows ``(table, position, column, type)``.

    The type is the logical one where the Spark schema does not show it.
    """
    rows = [
        (spec.source, position, name, kind)
        for spec in config.tables
        for position, (name, kind) in enumerate(native_schema(open_source(spark, config, spec)), 1)
    ]
    return spark.createDataFrame(rows, "table string, position int, column string, type string")


def register_view(rows: DataFrame, name: str) -> str:
    """Make rows available to SQL as ``source_<name>``; returns the view name."""
    view = f"source_{name}"
    rows.createOrReplaceTempView(quote(view))
    return view


def preview(rows: DataFrame, n: int = 20, order_by: list[str | Column] | None = None) -> DataFrame:
    """The first ``n`` rows; which ones is only defined with an order over a unique key."""
    return (rows.orderBy(*order_by) if order_by else rows).limit(n)
