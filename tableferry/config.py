"""What to copy, from where, to where and how."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import Column, DataFrame, SparkSession

from tableferry.functions.masking import mask_value
from tableferry.functions.names import short_name

log = logging.getLogger(__name__)


class ConfigError(ValueError):
    """The configuration cannot be run as given."""


class SaveMode(Enum):
    """What to do with a sink that may already hold rows.

    ``ERROR_IF_EXISTS`` and ``IGNORE`` look at the rows of the sink, not at its
    existence: an empty sink table is loaded. Spark's own modes of the same
    names differ there.
    """

    APPEND = "append"
    OVERWRITE = "overwrite"
    ERROR_IF_EXISTS = "errorifexists"
    IGNORE = "ignore"

    @classmethod
    def parse(cls, text: str | SaveMode, lenient: bool = False) -> SaveMode:
        """Case-insensitive. An unknown name is an error, unless ``lenient`` makes it overwrite."""
        if isinstance(text, SaveMode):
            return text
        try:
            return cls(text.strip().lower())
        except ValueError:
            if lenient:
                log.warning("unknown save mode %r, using overwrite", text)
                return cls.OVERWRITE
            raise ConfigError(
                f"unknown save mode {text!r}; use one of {[m.value for m in cls]}"
            ) from None


class Verify(Enum):
    """How the sink is checked after a write.

    ``OBSERVED`` counts the source rows inside the write itself, so the source
    is scanned once. ``RECOUNT`` scans the source a second time, which also
    notices a first read that came up short. Both count the whole sink before and
    after an append; ``ADDED`` counts as ``OBSERVED`` does, but after an append the rows in
    its new files alone. ``FINGERPRINT`` compares sums of row hashes as well, so changed
    values are noticed, after an append in its new files.
    """

    OFF = "off"
    OBSERVED = "observed"
    RECOUNT = "recount"
    ADDED = "added"
    FINGERPRINT = "fingerprint"


class OnEmpty(Enum):
    """What overwrite does when the source has no rows: leave the sink, or empty it."""

    SKIP = "skip"
    TRUNCATE = "truncate"


@dataclass(frozen=True)
class TableSpec:
    """One table to copy.

    ``logical_types`` names column types that the Spark schema no longer shows,
    such as ``{"uv": "bitmap"}``; letter case of the type does not matter.
    ``source_options`` add to the reader options of the run, for instance to
    split the scan of a large table. ``schema`` is DDL text for readers that
    would otherwise scan the rows once more to infer one. ``split_column`` has the scan of a
    source that cannot split itself cut into up to ``splits`` ranges of even size.
    """

    source: str
    sink: str | None = None
    logical_types: Mapping[str, str] = field(default_factory=dict)
    source_options: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None
    split_column: str | None = None
    splits: int = 16

    @property
    def sink_name(self) -> str:
        return self.sink or short_name(self.source)


@dataclass(frozen=True)
class TypesRelation:
    """A relation that lists the source's own column types, such as ``information_schema.columns``.

    Read by Spark like any table. ``table_column`` holds the table ids of the run, or,
    with ``schema_column``, the part of them after the schema's name and a dot.
    """

    source_format: str
    table: str
    table_key: str = "path"
    options: Mapping[str, str] = field(default_factory=dict)
    table_column: str = "table_name"
    column_column: str = "column_name"
    type_column: str = "data_type"
    schema_column: str | None = None


@dataclass(frozen=True)
class TransferConfig:
    """A run: a list of tables between one source and one sink.

    The source is any format of ``spark.read``; ``source_table_key`` is the
    reader option that carries the table name. Format ``catalog`` reads
    ``spark.read.table`` instead and needs no key.

    Sinks are catalog tables ``sink_schema.<sink name>`` of ``sink_format``.
    ``declare_sink_schema=False`` and ``sink_table_key`` are for providers that
    look up the schema themselves, under a table name given as an option.

    A run with a ``load_id`` keeps a ledger, a table named ``ledger`` in
    ``sink_schema``: repeated under the same id it copies only the tables that are not
    done, and an append is never there twice. ``source_predicate_key`` is the reader
    option through which the source takes a predicate of its own: it then gets the filter of
    the run (if that is text) and the ranges of split tables.
    """

    tables: Sequence[TableSpec | str]
    source_format: str
    sink_schema: str
    source_table_key: str = "path"
    source_options: Mapping[str, str] = field(default_factory=dict)
    sink_format: str = "parquet"
    sink_options: Mapping[str, str] = field(default_factory=dict)
    sink_table_key: str | None = None
    sink_location: str | None = None
    declare_sink_schema: bool = True
    save_mode: SaveMode | str = SaveMode.OVERWRITE
    filter: str | Column | None = None
    verify: Verify | str = Verify.OFF
    concurrent: bool = False
    max_concurrent: int = 8
    bitmap_to_binary: bool = True
    on_empty: OnEmpty | str = OnEmpty.SKIP
    rows_per_file: int | None = None
    rebalance: bool = False
    register_source_views: bool = False
    types: TypesRelation | None = None
    load_id: str | None = None
    ledger: str = "tableferry_loads"
    source_predicate_key: str | None = None

    def __post_init__(self) -> None:
        def put(name: str, value: object) -> None:
            object.__setattr__(self, name, value)

        put("tables", tuple(TableSpec(t) if isinstance(t, str) else t for t in self.tables))
        put("save_mode", SaveMode.parse(self.save_mode))
        put("verify", _choice(Verify, self.verify, "verify"))
        put("on_empty", _choice(OnEmpty, self.on_empty, "on_empty"))
        if isinstance(self.filter, str) and not self.filter.strip():
            put("filter", None)
        self._check()

    @property
    def sink_outside_catalog(self) -> bool:
        """Whether a sink may hold rows although the catalog does not know it yet."""
        return bool(self.sink_location or self.sink_table_key or not self.declare_sink_schema)

    def _check(self) -> None:
        if not self.tables:
            raise ConfigError("no tables to copy")
        if self.max_concurrent < 1:
            raise ConfigError("max_concurrent must be at least 1")
        if self.rows_per_file is not None and self.rows_per_file < 1:
            raise ConfigError("rows_per_file must be at least 1")
        if self.load_id is not None and not self.load_id.strip():
            raise ConfigError("load_id is empty")
        if any(k.lower() == "path" for k in self.sink_options):
            raise ConfigError("one path cannot serve several sink tables; use sink_location")
        taken: dict[str, str] = {}
        if self.load_id is not None:
            taken[self.ledger.lower()] = "the ledger"
        for spec in self.tables:
            if spec.splits < 1:
                raise ConfigError("splits must be at least 1")
            if spec.split_column and not self.source_predicate_key and self.source_format != "jdbc":
                raise ConfigError(
                    f"{spec.source!r} can be split if the source takes a predicate: name its option "
                    "as source_predicate_key"
                )
            if not spec.source.strip() or not spec.sink_name:
                raise ConfigError(f"no usable table name in {spec.source!r}")
            key = spec.sink_name.lower()  # catalogs ignore the case of table names
            if key in taken:
                raise ConfigError(
                    f"{taken[key]!r} and {spec.source!r} both go to sink table "
                    f"{spec.sink_name!r}; give one of them another sink name"
                )
            taken[key] = spec.source


def _choice(kind: type[Enum], value: object, what: str):
    if isinstance(value, kind):
        return value
    try:
        return kind(str(value).strip().lower())
    except ValueError:
        raise ConfigError(f"{what}={value!r}; use one of {[m.value for m in kind]}") from None


# The setting names of the job. Spark drops settings without the
# "spark." prefix, so every name has it.
SOURCE_FORMAT = "spark.source.format"
SOURCE_TABLE_KEY = "spark.source.table.key"
SOURCE_TABLE_VALUES = "spark.source.table.values"
SOURCE_OPTION_PREFIX = "spark.source.connector."
SOURCE_TABLE_SINK_PREFIX = "spark.source.table.sink."
SOURCE_TABLE_OPTION_PREFIX = "spark.source.table.option."
SOURCE_LOGICAL_PREFIX = "spark.source.logical."
SOURCE_SCHEMA_PREFIX = "spark.source.schema."
SOURCE_TYPES_PREFIX = "spark.source.types."
SOURCE_SPLIT_PREFIX = "spark.source.split.column."
SOURCE_SPLITS = "spark.source.split.count"
SOURCE_PREDICATE_KEY = "spark.source.predicate.key"
FILTER_QUERY = "spark.filter.query"
SINK_PREFIX = "spark.sink."
# Names under the sink prefix that steer the job and are not sink options.
SINK_CONTROL_KEYS = frozenset(
    {
        "format",
        "save.mode",
        "save.mode.lenient",
        "enable.results.verify",
        "verify.method",
        "enable.concurrent.copy",
        "max.concurrent",
        "enable.bitmap_to_binary",
        "on.empty",
        "table.key",
        "location",
        "declare.schema",
        "rows.per.file",
        "rebalance",
        "load.id",
        "ledger",
    }
)


# First words of control names: no sink option starts with them, so such a name is a typo.
_CONTROL_STARTS = ("save.", "enable.", "verify.", "on.", "max.")

_TYPES_KEYS = {
    "format": "source_format",
    "table": "table",
    "table.key": "table_key",
    "table.column": "table_column",
    "column.column": "column_column",
    "type.column": "type_column",
    "schema.column": "schema_column",
}


def table_list(text: str) -> list[str]:
    """``"db.a, db.b,,"`` to ``["db.a", "db.b"]``."""
    return [name.strip() for name in text.split(",") if name.strip()]


def options_under(settings: Mapping[str, str], prefix: str) -> dict[str, str]:
    """The settings that start with ``prefix``, without it."""
    return {k[len(prefix) :]: v for k, v in settings.items() if k.startswith(prefix)}


def _per_table(
    settings: Mapping[str, str], prefix: str, tables: Sequence[str]
) -> dict[str, dict[str, str]]:
    """Settings named ``<prefix><table>.<rest>`` as ``{table: {rest: value}}``.

    Table names may hold dots; the longest one that fits is meant.
    """
    found: dict[str, dict[str, str]] = {name: {} for name in tables}
    for name, value in options_under(settings, prefix).items():
        table = max((t for t in tables if name.startswith(t + ".")), key=len, default=None)
        if table is None:
            raise ConfigError(f"setting {prefix}{name} is for a table that is not copied")
        found[table][name[len(table) + 1 :]] = value
    return found


def _one_per_table(settings: Mapping[str, str], prefix: str, tables: Sequence[str]) -> dict[str, str]:
    """Settings named ``<prefix><table>``."""
    found = options_under(settings, prefix)
    for name in found:
        if name not in tables:
            raise ConfigError(f"setting {prefix}{name} is for a table that is not copied")
    return found


def _types_relation(settings: Mapping[str, str]) -> TypesRelation | None:
    given = options_under(settings, SOURCE_TYPES_PREFIX)
    options = options_under(given, "option.")
    fields = {k: v for k, v in given.items() if not k.startswith("option.")}
    if not given:
        return None
    for key in fields:
        if key not in _TYPES_KEYS:
            raise ConfigError(f"unknown setting {SOURCE_TYPES_PREFIX}{key}")
    for key in ("format", "table"):
        if key not in fields:
            raise ConfigError(f"setting {SOURCE_TYPES_PREFIX}{key} is required with the others")
    return TypesRelation(**{_TYPES_KEYS[k]: v for k, v in fields.items()}, options=options)


def from_settings(settings: Mapping[str, str], sink_prefix: str = SINK_PREFIX) -> TransferConfig:
    """Build the configuration from flat string settings."""
    sink = options_under(settings, sink_prefix)

    def required(key: str) -> str:
        if key not in settings:
            raise ConfigError(f"setting {key} is required")
        return settings[key]

    def flag(key: str, default: bool) -> bool:
        text = sink.get(key, str(default)).strip().lower()
        if text not in ("true", "false"):
            raise ConfigError(f"{sink_prefix}{key}={sink[key]!r} is neither true nor false")
        return text == "true"

    def number(key: str) -> int | None:
        try:
            return int(sink[key]) if key in sink else None
        except ValueError:
            raise ConfigError(f"{sink_prefix}{key}={sink[key]!r} is not a whole number") from None

    for key in sink:
        if key.startswith(_CONTROL_STARTS) and key not in SINK_CONTROL_KEYS:
            raise ConfigError(f"unknown setting {sink_prefix}{key}")
    names = table_list(required(SOURCE_TABLE_VALUES))
    logical = _per_table(settings, SOURCE_LOGICAL_PREFIX, names)
    options = _per_table(settings, SOURCE_TABLE_OPTION_PREFIX, names)
    sinks = _one_per_table(settings, SOURCE_TABLE_SINK_PREFIX, names)
    schemas = _one_per_table(settings, SOURCE_SCHEMA_PREFIX, names)
    split = _one_per_table(settings, SOURCE_SPLIT_PREFIX, names)
    optional = {}
    if number("max.concurrent") is not None:
        optional["max_concurrent"] = number("max.concurrent")
    if "ledger" in sink:
        optional["ledger"] = sink["ledger"]
    try:
        splits = int(settings.get(SOURCE_SPLITS, TableSpec.splits))
    except ValueError:
        raise ConfigError(f"{SOURCE_SPLITS}={settings[SOURCE_SPLITS]!r} is not a whole number") from None
    return TransferConfig(
        tables=[
            TableSpec(
                name, sinks.get(name), logical[name], options[name], schemas.get(name), split.get(name), splits
            )
            for name in names
        ],
        source_format=required(SOURCE_FORMAT),
        source_table_key=required(SOURCE_TABLE_KEY),
        source_options=options_under(settings, SOURCE_OPTION_PREFIX),
        sink_schema=required(sink_prefix + "schema"),
        sink_format=sink.get("format", "parquet"),
        sink_options={k: v for k, v in sink.items() if k not in SINK_CONTROL_KEYS},
        sink_table_key=sink.get("table.key"),
        sink_location=sink.get("location"),
        declare_sink_schema=flag("declare.schema", True),
        save_mode=SaveMode.parse(
            sink.get("save.mode", "overwrite"), lenient=flag("save.mode.lenient", False)
        ),
        filter=settings.get(FILTER_QUERY),
        verify=(
            sink.get("verify.method", Verify.OBSERVED.value)
            if flag("enable.results.verify", False)
            else Verify.OFF
        ),
        concurrent=flag("enable.concurrent.copy", False),
        bitmap_to_binary=flag("enable.bitmap_to_binary", True),
        on_empty=sink.get("on.empty", OnEmpty.SKIP.value),
        rows_per_file=number("rows.per.file"),
        rebalance=flag("rebalance", False),
        register_source_views=True,
        types=_types_relation(settings),
        load_id=sink.get("load.id"),
        source_predicate_key=settings.get(SOURCE_PREDICATE_KEY),
        **optional,
    )


def from_spark_conf(spark: SparkSession, sink_prefix: str = SINK_PREFIX) -> TransferConfig:
    """Build the configuration from the settings of a session (``spark-submit --conf``)."""
    return from_settings(dict(spark.conf.getAll), sink_prefix)


def config_report(spark: SparkSession, config: TransferConfig) -> DataFrame:
    """The configuration as rows ``(section, key, value)``, sorted, with secrets masked."""
    run = {
        "source.format": config.source_format,
        "source.table.key": config.source_table_key,
        "sink.schema": config.sink_schema,
        "sink.format": config.sink_format,
        "sink.location": config.sink_location,
        "save.mode": config.save_mode.value,
        "verify": config.verify.value,
        "concurrent": config.concurrent,
        "max.concurrent": config.max_concurrent,
        "bitmap_to_binary": config.bitmap_to_binary,
        "on.empty": config.on_empty.value,
        "filter": config.filter,
        "load.id": config.load_id,
        "source.predicate.key": config.source_predicate_key,
    }
    sections = {
        "run": {k: "" if v is None else str(v) for k, v in run.items()},
        "tables": {f"{i:05d}": t.source for i, t in enumerate(config.tables, 1)},
        "source options": config.source_options,
        "sink options": config.sink_options,
        "spark": {k: v for k, v in dict(spark.conf.getAll).items() if k.startswith("spark.")},
    }
    own = spark.conf.get("spark.redaction.regex", None)
    rows = [
        (section, key, mask_value(key, str(entries[key]), own))
        for section, entries in sections.items()
        for key in sorted(entries)
    ]
    return spark.createDataFrame(rows, "section string, key string, value string")
