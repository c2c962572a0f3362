"""Sink tables: creation and by-name writes."""

from __future__ import annotations

import re
from collections.abc import Callable
from contextlib import suppress

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    MapType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tableferry.config import ConfigError, TransferConfig
from tableferry.functions.names import identifier_parts, qualified, quote
from tableferry.operators.fingerprint import ROWS, row_count
from tableferry.operators.newfiles import FILE_NAME, begin_of_names
from tableferry.operators.types import fits

# looks at a count that Spark has not delivered yet, each of a tenth of a second
OBSERVATION_LOOKS = 100

# Formats that cannot give every value back: csv has no binary and rewrites line
# ends inside text, text files hold one string column split at line ends.
_LOSSY_FORMATS = ("csv", "text")

# JSON files get milliseconds by default, which would cut off microseconds.
_FULL_PRECISION = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}

_ARGUMENTS = ("tableName", "source", "schema", "description")


def sink_identifier(config: TransferConfig, name: str) -> str:
    return qualified(*identifier_parts(config.sink_schema), name)


def sink_exists(spark: SparkSession, sink: str) -> bool:
    """Whether the catalog has the sink; if so, its files are listed anew.

    Spark keeps the listing of a table from earlier use, but other sessions may
    have loaded or emptied the sink since.
    """
    if not spark.catalog.tableExists(sink):
        return False
    spark.catalog.refreshTable(sink)
    return True


def check_format(sink_format: str) -> None:
    if sink_format.lower() in _LOSSY_FORMATS:
        raise ConfigError(
            f"a {sink_format} sink would change values; use a format such as parquet, orc or json"
        )


def create_sink(
    spark: SparkSession, config: TransferConfig, sink: str, name: str, schema: StructType
) -> None:
    """Create the sink table through the catalog API.

    The API takes option values as they are, where SQL text would need quoting
    and would end up in logs.
    """
    check_format(config.sink_format)
    options = dict(config.sink_options)
    if config.sink_format.lower() == "json":
        options = {**_FULL_PRECISION, **options}
    if config.sink_table_key:
        options[config.sink_table_key] = name
    if config.rows_per_file:
        options["maxRecordsPerFile"] = str(config.rows_per_file)
    path = f"{config.sink_location.rstrip('/')}/{name}" if config.sink_location else None
    declared = None
    if config.declare_sink_schema:
        # later loads may bring NULLs that this one has not
        declared = StructType(
            [StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields]
        )
    # Spark ignores the case of option names, Python does not: this keeps options
    # apart from arguments of the call
    options = {k.upper() if k in _ARGUMENTS else k: v for k, v in options.items()}
    try:
        spark.catalog.createTable(
            sink, path=path, source=config.sink_format, schema=declared, **options
        )
    except Exception:
        # another job may have made it since; the checks before a write then hold for it
        if not sink_exists(spark, sink):
            raise


def described(spark: SparkSession, sink: str) -> dict[str, str]:
    """What the catalog says of a table beside its columns."""
    rows = [tuple(r)[:2] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {sink}").collect()]
    names = [name for name, _ in rows]
    begin = names.index("# Detailed Table Information") if "# Detailed Table Information" in names else 0
    return {name: value for name, value in rows[begin:] if name}


def _holds_times(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_holds_times(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _holds_times(kind.elementType)
    if isinstance(kind, MapType):
        return _holds_times(kind.keyType) or _holds_times(kind.valueType)
    return isinstance(kind, (TimestampType, TimestampNTZType))


def check_existing(spark: SparkSession, sink: str, rows: DataFrame) -> None:
    """Refuse a sink that the catalog has already if its files would change values of the rows."""
    known = described(spark, sink)
    check_format(known.get("Provider", ""))
    if known.get("Provider", "").lower() == "json" and _holds_times(rows.schema):
        found = known.get("Storage Properties", "")
        for name in _FULL_PRECISION:
            if not re.search(rf"\b{name}=[^,]*SSSSSS", found, re.IGNORECASE):
                raise ConfigError(
                    f"{sink} is a json table without {name} to the microsecond: "
                    "times would be cut off"
                )


def align_by_name(rows: DataFrame, sink: DataFrame) -> DataFrame:
    """The columns in sink order; both sides must have the same names and fitting types.

    A positional insert would silently swap columns of equal type, and Spark
    would narrow values to the sink's types: fractions, times of day and
    digits would be lost.
    """
    sensitive = rows.sparkSession.conf.get("spark.sql.caseSensitive") == "true"

    def key(name: str) -> str:
        return name if sensitive else name.lower()

    have = {key(f.name): f.dataType for f in rows.schema}
    want = {key(f.name): f.dataType for f in sink.schema}
    if set(have) != set(want):
        raise ConfigError(
            "source and sink columns differ: "
            f"only in source {sorted(set(have) - set(want))}, "
            f"only in sink {sorted(set(want) - set(have))}"
        )
    narrower = [
        f"{name} ({have[name].simpleString()} into {kind.simpleString()})"
        for name, kind in want.items()
        if not fits(have[name], kind)
    ]
    if narrower:
        raise ConfigError(f"the sink's types would change values: {', '.join(narrower)}")
    if rows.columns == sink.columns:
        return rows
    return rows.select(*[F.col(quote(c)) for c in sink.columns])


def check_whole_overwrite(spark: SparkSession, sink: str) -> None:
    """Refuse an overwrite that would leave old partitions in place."""
    dynamic = spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    if dynamic and any(c.isPartition for c in spark.catalog.listColumns(sink)):
        raise ConfigError(
            f"{sink} is partitioned and spark.sql.sources.partitionOverwriteMode is dynamic: "
            "overwrite would keep the partitions that the source does not touch; set it to static"
        )


def insert(
    spark: SparkSession,
    rows: DataFrame,
    sink: str,
    overwrite: bool = False,
    rebalance: bool = False,
) -> int | None:
    """Write rows by column name into an existing table; returns how many were written.

    None means that Spark did not tell, see :func:`_value`.
    """
    written = insert_observed(spark, rows, sink, overwrite, rebalance)
    return written[ROWS] if written else None


def insert_observed(
    spark: SparkSession,
    rows: DataFrame,
    sink: str,
    overwrite: bool = False,
    rebalance: bool = False,
    facts: Callable[[StructType], list[Column]] = row_count,
    mark: str | None = None,
) -> dict[str, int] | None:
    """Write rows by column name into an existing table; returns facts about the rows written.

    With a ``mark`` the files of an append are named after it (:mod:`tableferry.operators.newfiles`).

    One job without a shuffle: the facts are taken by an observation on the rows
    that go to the writer. It sits directly under the write, in the result
    stage, where Spark counts each task once however often it is retried;
    ``rebalance`` (even output files after a selective filter, for one shuffle)
    therefore comes below it.
    """
    if overwrite:
        check_whole_overwrite(spark, sink)
    table = spark.table(sink)
    aligned = align_by_name(rows, table)
    if rebalance:
        aligned = aligned.hint("rebalance")
    written = Observation()
    observed = aligned.observe(written, *facts(table.schema))
    try:
        if mark:
            to = sink.replace("{", "{{").replace("}", "}}")
            named = f"'{FILE_NAME}' = '{begin_of_names(mark)}'"
            spark.sql(f"INSERT INTO {to} WITH ({named}) SELECT * FROM {{rows}}", rows=observed)
        else:
            observed.write.insertInto(sink, overwrite=overwrite)
    except Exception:
        # an overwrite removes the old files first: forget the listing that has them
        with suppress(Exception):
            spark.catalog.refreshTable(sink)
        raise
    return _value(written)


def _value(written: Observation) -> dict[str, int] | None:
    """The observed facts, or None if they do not come although the write is done.

    Spark delivers them through its event queue, which drops events under heavy
    load, and not at all for providers that run the rows in a query of their
    own; ``Observation.get`` would then wait for ever. So this looks, a bounded
    number of times, whether they have come.
    """
    for _ in range(OBSERVATION_LOOKS):
        if not written._jo.getOrEmpty().isEmpty():  # waits a tenth of a second at most
            return dict(written.get)
    return None
