"""Transfers of the given tables, each with the SQL that states its result.

Every query runs real transfers into sink tables in a database of its own and
returns what a reader of those sinks, or of the run report, sees.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tableferry.config import SaveMode, TableSpec, TransferConfig, TypesRelation, Verify
from tableferry.functions.bitmap import bytes_to_text
from tableferry.functions.names import qualified, quote
from tableferry.operators.projection import compare_conversions
from tableferry.operators.verify import count_rows, verification_counts
from tableferry.plans.ledger import ledger_rows
from tableferry.plans.report import RunReport
from tableferry.plans.run import run
from tableferry.plans.workspace import for_one_call, new_database, shared_folder
from tableferry.sources.logical import tag_logical_types
from tableferry.sources.scan import CATALOG, open_source, preview, read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def query(oracle: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with equivalent SQL over the same tables."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = oracle
        return function

    return register


# --- shared pieces ---------------------------------------------------------


def _files(sf_dir: str, sinks: Mapping[str, str]) -> list[TableSpec]:
    """Specs for ``{sink: given table}``."""
    return [TableSpec(f"{sf_dir}/{table}.parquet", sink) for sink, table in sinks.items()]


def _config(spark: SparkSession, sf_dir: str, sinks: Mapping[str, str], **settings):
    settings.setdefault("sink_schema", new_database(spark))
    return TransferConfig(_files(sf_dir, sinks), "parquet", **settings)


def _sink(spark: SparkSession, config: TransferConfig, name: str) -> DataFrame:
    return spark.table(qualified(config.sink_schema, name))


def _copy(spark: SparkSession, sf_dir: str, table: str, **settings) -> DataFrame:
    """Copy one given table and read the sink back."""
    config = _config(spark, sf_dir, {table: table}, **settings)
    run(spark, config)
    return _sink(spark, config, table)


def _times_as_text(rows: DataFrame) -> DataFrame:
    """Dates and times as text, which reads the same in every engine."""
    return rows.select(
        *[
            F.col(quote(f.name)).cast("string").alias(f.name)
            if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))
            else F.col(quote(f.name))
            for f in rows.schema.fields
        ]
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Users per bitmap row: ids are split into ranges of this width, so no group
# ever collects more than this many ids, however many users a day has.
BITMAP_WIDTH = 1024


def _bitmap_source(spark: SparkSession, sf_dir: str, database: str) -> TableSpec:
    """A table with a bitmap column, derived from ``events``, as a source in the catalog.

    One row per day, event type and range of user ids, with the distinct users
    as ascending comma-separated text.
    """
    users = (
        read_table(spark, "parquet", f"{sf_dir}/events.parquet")
        .select(F.to_date("ts").alias("dt"), "event_type", "user_id")
        .distinct()
    )
    ids = F.array_sort(F.collect_list("user_id")).cast("array<string>")
    bitmaps = users.groupBy(
        "dt", "event_type", F.expr(f"user_id DIV {BITMAP_WIDTH}").alias("id_range")
    ).agg(F.array_join(ids, ",").alias("uv_bitmap"))
    name = qualified(database, "pv_bitmap_source")
    bitmaps.write.format("parquet").saveAsTable(name)
    return TableSpec(name, "pv_bitmap", logical_types={"uv_bitmap": "BITMAP"})


def _copy_bitmap(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    database = new_database(spark)
    spec = _bitmap_source(spark, sf_dir, database)
    config = TransferConfig([spec], CATALOG, database, verify=Verify.OBSERVED, **settings)
    run(spark, config)
    return _sink(spark, config, "pv_bitmap")


_BITMAP_SQL = f"""
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, event_type,
           user_id // {BITMAP_WIDTH} AS id_range,
           array_to_string(list_sort(list(DISTINCT user_id)), ',') AS uv_bitmap
    FROM events GROUP BY ALL"""


# --- scans, filters, projection --------------------------------------------

_ORDERS_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
    FROM orders"""
_LINEITEM_SQL = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus,
           CAST(l_shipdate AS VARCHAR) AS l_shipdate
    FROM lineitem"""
_EVENTS_SQL = """
    SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, "value", props
    FROM events"""


@query(f"{_ORDERS_SQL} WHERE o_orderstatus = 'F'")
def transfer_orders_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan, filter, project, create and overwrite a sink, verified."""
    return _times_as_text(
        _copy(spark, sf_dir, "orders", filter="o_orderstatus = 'F'", verify=Verify.OBSERVED)
    )


@query(f"{_LINEITEM_SQL} WHERE l_shipdate BETWEEN '1995-01-01' AND '1995-12-31'")
def transfer_lineitem_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date range given as text, as submit lines do."""
    condition = "l_shipdate BETWEEN '1995-01-01' AND '1995-12-31'"
    return _times_as_text(_copy(spark, sf_dir, "lineitem", filter=condition))


@query(f"{_EVENTS_SQL} WHERE ts BETWEEN '2024-01-05' AND '2024-01-10'")
def transfer_events_until_midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upper bound of a date range on a timestamp is midnight: that day is left out."""
    condition = "ts BETWEEN '2024-01-05' AND '2024-01-10'"
    return _times_as_text(_copy(spark, sf_dir, "events", filter=condition))


@query(f"{_LINEITEM_SQL}")
def transfer_lineitem_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blank filter copies every row, duplicates included."""
    return _times_as_text(_copy(spark, sf_dir, "lineitem", filter="  "))


@query(
    """
    SELECT vec_id, label, pos, CAST(embedding[pos] AS DOUBLE) AS element
    FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS pos
          FROM embeddings)"""
)
def transfer_nested_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested columns pass through unchanged; the sink's arrays are unrolled to compare them."""
    return (
        _copy(spark, sf_dir, "embeddings")
        .select("vec_id", "label", F.posexplode("embedding").alias("pos", "element"))
        .withColumn("pos", F.col("pos").cast("long") + 1)
        .withColumn("element", F.col("element").cast("double"))
    )


_ODD_NAMES = {
    "event_id": "event.id",
    "ts": "event time",
    "user_id": "user-id;",
    "event_type": "SELECT",
    "value": "va`lue",
    "props": "props {}",
}


@query(
    f"""
    SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, "value", props,
           '{"|".join(_ODD_NAMES.values())}' AS sink_columns
    FROM events"""
)
def transfer_special_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names with a dot, a space, a back-tick and a keyword survive."""
    database = new_database(spark)
    view = for_one_call(f"{database}_odd_events")
    read_table(spark, "parquet", f"{sf_dir}/events.parquet").select(
        *[F.col(name).alias(odd) for name, odd in _ODD_NAMES.items()]
    ).createOrReplaceTempView(view)
    config = TransferConfig([TableSpec(view, "odd_events")], CATALOG, database)
    run(spark, config)
    sink = _sink(spark, config, "odd_events")
    return _times_as_text(
        sink.select(
            *[F.col(quote(odd)).alias(name) for name, odd in _ODD_NAMES.items()],
            F.lit("|".join(sink.columns)).alias("sink_columns"),
        )
    )


@query(
    " UNION ALL ".join(
        f"""
    SELECT '{read}' AS "read", o_orderpriority, COUNT(*) AS n_orders,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(20, 2))) AS DOUBLE) AS total
    FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority"""
        for read in ("view", "sink")
    )
)
def filter_column_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter given as a Column; the source view of the run and the sink are queried with SQL."""
    name = f"orders_{new_database(spark)}"
    config = _config(
        spark,
        sf_dir,
        {name: "orders"},
        filter=F.col("o_totalprice") > 100000,
        register_source_views=True,
    )
    run(spark, config)
    for_one_call(f"source_{name}")
    return _union(
        [
            spark.sql(
                f"""
        SELECT '{read}' AS read, o_orderpriority, COUNT(*) AS n_orders,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(20, 2))) AS DOUBLE) AS total
        FROM {table} GROUP BY o_orderpriority"""
            )
            for read, table in (
                ("view", f"source_{name}"),
                ("sink", qualified(config.sink_schema, name)),
            )
        ]
    )


@query(f"{_ORDERS_SQL} ORDER BY o_orderkey LIMIT 20")
def preview_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preview of a source: its first 20 rows by a unique key."""
    config = _config(spark, sf_dir, {"orders": "orders"})
    rows = open_source(spark, config, config.tables[0])
    return _times_as_text(preview(rows, 20, ["o_orderkey"]))


# --- bitmap conversion -----------------------------------------------------


@query(
    f"""SELECT dt, event_type, id_range, hex(encode(uv_bitmap)) AS uv_bitmap_hex
    FROM ({_BITMAP_SQL})"""
)
def bitmap_text_to_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmap text arrives in the sink as UTF-8 bytes."""
    sink = _copy_bitmap(spark, sf_dir)
    return _times_as_text(
        sink.select("dt", "event_type", "id_range", F.hex("uv_bitmap").alias("uv_bitmap_hex"))
    )


@query(_BITMAP_SQL)
def bitmap_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the conversion off the text arrives as it is."""
    return _times_as_text(_copy_bitmap(spark, sf_dir, bitmap_to_binary=False))


@query(
    f"""
    SELECT dt, event_type, id_range, uv_bitmap,
           hex(encode(uv_bitmap)) AS uv_bitmap_bytes_hex,
           hex(CAST(uv_bitmap AS BLOB)) AS uv_bitmap_cast_hex,
           decode(encode(uv_bitmap)) AS uv_bitmap_decoded
    FROM ({_BITMAP_SQL})"""
)
def conversion_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text, both conversions and the decoded bytes side by side."""
    database = new_database(spark)
    spec = _bitmap_source(spark, sf_dir, database)
    source = tag_logical_types(spark.table(spec.source), spec.logical_types)
    return _times_as_text(compare_conversions(source))


@query(
    f"""SELECT dt, event_type, id_range, hex(encode(uv_bitmap)) AS uv_bitmap_hex
    FROM ({_BITMAP_SQL})"""
)
def bitmap_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nobody names the bitmap column: the source's own list of columns tells."""
    database = new_database(spark)
    given = _bitmap_source(spark, sf_dir, database)
    source = spark.table(given.source)
    bitmaps = given.logical_types
    listed = [
        (database, "pv_bitmap_source", f.name, bitmaps.get(f.name, f.dataType.simpleString()))
        for f in source.schema
    ]
    spark.createDataFrame(
        [*listed, (database, "another", "uv_bitmap", "BITMAP")],
        "table_schema string, table_name string, column_name string, data_type string",
    ).write.saveAsTable(qualified(database, "columns"))
    config = TransferConfig(
        [TableSpec(f"{database}.pv_bitmap_source", "pv_bitmap")],
        CATALOG,
        database,
        types=TypesRelation(CATALOG, qualified(database, "columns"), schema_column="table_schema"),
    )
    run(spark, config)
    return _times_as_text(
        _sink(spark, config, "pv_bitmap").select(
            "dt", "event_type", "id_range", F.hex("uv_bitmap").alias("uv_bitmap_hex")
        )
    )


def _document_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with the text, much of it not ASCII, converted to bytes."""
    spec = TableSpec(f"{sf_dir}/documents.parquet", "documents", {"text": "bitmap"})
    config = TransferConfig([spec], "parquet", new_database(spark))
    run(spark, config)
    return _sink(spark, config, "documents")


@query(
    "SELECT doc_id, md5(text) AS digest, octet_length(encode(text)) AS n_bytes FROM documents"
)
def utf8_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of non-ASCII text."""
    return _document_bytes(spark, sf_dir).select(
        "doc_id",
        F.md5("text").alias("digest"),
        F.octet_length("text").cast("long").alias("n_bytes"),
    )


@query("SELECT doc_id, text FROM documents")
def binary_decode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoding the sink's bytes gives the source's text back."""
    sink = _document_bytes(spark, sf_dir)
    return sink.select("doc_id", bytes_to_text(F.col("text")).alias("text"))


# --- runs over all tables, with verification -------------------------------

_COPIED_SQL = " UNION ALL ".join(
    f"SELECT {i} AS run_order, '{t}' AS sink, 'copied' AS status, COUNT(*) AS source_rows, "
    f"COUNT(*) AS sink_rows, TRUE AS verified FROM {t}"
    for i, t in enumerate(TABLES, 1)
)


def _copy_all(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    config = _config(spark, sf_dir, {t: t for t in TABLES}, **settings)
    return (
        run(spark, config)
        .to_df(spark)
        .select("run_order", "sink", "status", "source_rows", "sink_rows", "verified")
    )


@query(_COPIED_SQL)
def copy_all_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables at the same time, counts taken inside the writes."""
    return _copy_all(spark, sf_dir, concurrent=True, verify=Verify.OBSERVED)


@query(_COPIED_SQL)
def copy_all_recounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables at the same time, the sources counted a second time."""
    return _copy_all(spark, sf_dir, concurrent=True, verify=Verify.RECOUNT)


@query(_COPIED_SQL)
def copy_all_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables, one after another."""
    return _copy_all(spark, sf_dir, verify=Verify.OBSERVED)


@query(_COPIED_SQL)
def copy_all_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables at the same time; hashes of all rows, taken inside the writes, agree with the sinks'."""
    return _copy_all(spark, sf_dir, concurrent=True, verify=Verify.FINGERPRINT)


# Whole numbers, texts and one fraction of each table that no other query shows, in one shape:
# (table, two numbers, three texts, a fraction)
_CONTENTS = {
    "region": ("r_regionkey", "NULL", "r_name", "NULL", "NULL", "NULL"),
    "nation": ("n_nationkey", "n_regionkey", "n_name", "NULL", "NULL", "NULL"),
    "customer": ("c_custkey", "c_nationkey", "c_name", "c_mktsegment", "NULL", "c_acctbal"),
    "supplier": ("s_suppkey", "s_nationkey", "s_name", "NULL", "NULL", "s_acctbal"),
    "part": ("p_partkey", "p_size", "p_name", "p_brand", "p_type", "p_retailprice"),
    "pages": ("page_id", "NULL", "url", "html", "NULL", "NULL"),
    "benchmark": ("item_id", "NULL", "text", "NULL", "NULL", "NULL"),
    "labels": ("doc_id", "quality", "NULL", "NULL", "NULL", "toxic"),
    "conversations": ("conv_id", "turn", "role", "text", "NULL", "NULL"),
}


def _contents_sql(table: str, source: str, text: str) -> str:
    """Valid in Spark and in DuckDB, which name the text type differently."""
    kinds = ("BIGINT", "BIGINT", text, text, text, "DOUBLE")
    names = ("number_1", "number_2", "text_1", "text_2", "text_3", "fraction")
    columns = ", ".join(
        f"CAST({c} AS {kind}) AS {name}" for c, kind, name in zip(_CONTENTS[table], kinds, names)
    )
    return f"SELECT '{table}' AS sink, {columns} FROM {source}"


@query(" UNION ALL ".join(_contents_sql(t, t, "VARCHAR") for t in _CONTENTS))
def copy_all_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the sinks of a concurrent run over all tables."""
    config = _config(spark, sf_dir, {t: t for t in TABLES}, concurrent=True, verify=Verify.OBSERVED)
    run(spark, config)
    return _union(
        [
            spark.sql(_contents_sql(t, qualified(config.sink_schema, t), "STRING"))
            for t in _CONTENTS
        ]
    )


@query(
    """
    SELECT o_orderstatus, COUNT(*) AS n_rows, MIN(o_orderkey) AS first_key,
           any_value(n) AS source_rows, CAST(0 AS BIGINT) AS rows_before, any_value(n) AS sink_rows,
           TRUE AS verified
    FROM orders, (SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'F')
    WHERE o_orderstatus <> 'F' GROUP BY o_orderstatus"""
)
def copy_filtered_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An overwrite under a filter, of a sink whose old rows the filter does not meet."""
    first = _config(spark, sf_dir, {"orders": "orders"}, filter="o_orderstatus = 'F'")
    run(spark, first)
    config = _config(
        spark,
        sf_dir,
        {"orders": "orders"},
        sink_schema=first.sink_schema,
        filter="o_orderstatus <> 'F'",
        verify=Verify.OBSERVED,
    )
    report = run(spark, config).to_df(spark)
    found = _sink(spark, config, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("first_key")
    )
    # the report is one row
    counts = report.select("source_rows", "rows_before", "sink_rows", "verified").first()
    return found.withColumns({k: F.lit(v).cast("long" if k != "verified" else "boolean") for k, v in counts.asDict().items()})


@query(
    """
    SELECT 'source' AS side, COUNT(*) AS "rows" FROM orders WHERE o_totalprice > 100000
    UNION ALL
    SELECT 'sink' AS side, COUNT(*) AS "rows" FROM orders WHERE o_totalprice > 100000"""
)
def sink_count_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source and sink rows under the same predicate, counted by one plan over a whole copy."""
    condition = "o_totalprice > 100000"
    sink = _copy(spark, sf_dir, "orders")
    source = read_table(spark, "parquet", f"{sf_dir}/orders.parquet")
    return verification_counts(source.filter(condition), sink.filter(condition))


@query(
    """
    SELECT r.load, c.n AS source_rows, (r.load - 1) * c.n AS rows_before,
           r.load * c.n AS sink_rows, TRUE AS verified
    FROM (SELECT unnest([1, 2]) AS load) r, (SELECT COUNT(*) AS n FROM customer) c"""
)
def append_twice_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verification of an append compares the new rows, not the whole sink."""
    config = _config(
        spark,
        sf_dir,
        {"customer": "customer"},
        save_mode=SaveMode.APPEND,
        verify=Verify.OBSERVED,
    )
    loads = [run(spark, config).to_df(spark).withColumn("load", F.lit(i)) for i in (1, 2)]
    return _union(loads).select("load", "source_rows", "rows_before", "sink_rows", "verified")


@query(
    """
    SELECT COUNT(*) FILTER (o_orderstatus = 'F') AS source_rows,
           CAST(0 AS BIGINT) AS rows_before,
           COUNT(*) FILTER (o_orderstatus = 'F') AS sink_rows,
           TRUE AS verified,
           COUNT(*) AS rows_in_sink
    FROM orders WHERE o_orderstatus IN ('F', 'O')"""
)
def append_filtered_recounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sink count uses the filter of the run: rows already there that fail it do not count."""
    config = _config(spark, sf_dir, {"orders": "orders"}, filter="o_orderstatus = 'O'")
    run(spark, config)
    config = _config(
        spark,
        sf_dir,
        {"orders": "orders"},
        sink_schema=config.sink_schema,
        filter="o_orderstatus = 'F'",
        save_mode=SaveMode.APPEND,
        verify=Verify.RECOUNT,
    )
    report = run(spark, config).to_df(spark)
    in_sink = count_rows(_sink(spark, config, "orders"))
    return report.select("source_rows", "rows_before", "sink_rows", "verified").withColumn(
        "rows_in_sink", F.lit(in_sink).cast("long")
    )


@query(
    """
    SELECT v.verify, r.load, COUNT(*) FILTER (o_orderstatus = 'F' OR r.load = 1) AS source_rows,
           CASE WHEN r.load = 1 THEN CAST(0 AS BIGINT) END AS rows_before,
           COUNT(*) FILTER (o_orderstatus = 'F' OR r.load = 1) AS sink_rows, TRUE AS verified
    FROM orders, (SELECT unnest([1, 2]) AS load) r, (SELECT unnest(['added', 'fingerprint']) AS verify) v
    GROUP BY ALL"""
)
def append_added_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After an append its own files are looked at, not the rows that were there."""
    loads = []
    for method in (Verify.ADDED, Verify.FINGERPRINT):
        first = _config(spark, sf_dir, {"orders": "orders"}, verify=method)
        second = _config(
            spark,
            sf_dir,
            {"orders": "orders"},
            sink_schema=first.sink_schema,
            filter="o_orderstatus = 'F'",
            save_mode=SaveMode.APPEND,
            verify=method,
        )
        for i, config in ((1, first), (2, second)):
            report = run(spark, config).to_df(spark)
            loads.append(report.withColumns({"verify": F.lit(method.value), "load": F.lit(i)}))
    return _union(loads).select("verify", "load", "source_rows", "rows_before", "sink_rows", "verified")


# --- save modes ------------------------------------------------------------

_CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
_OLD = "c_acctbal < 0"


def _mode_sql(mode: SaveMode) -> str:
    """Sink contents after a load of ``customer``, by what the sink was before."""

    def rows(before: str, status: str, where: str = "TRUE") -> str:
        return (
            f"SELECT '{before}' AS sink_before, '{status}' AS status, {_CUSTOMER} "
            f"FROM customer WHERE {where}"
        )

    loaded = [rows("absent", "copied"), rows("empty", "copied")]
    full = {
        SaveMode.APPEND: [rows("full", "copied", _OLD), rows("full", "copied")],
        SaveMode.OVERWRITE: [rows("full", "copied")],
        SaveMode.ERROR_IF_EXISTS: [rows("full", "failed", _OLD)],
        SaveMode.IGNORE: [rows("full", "skipped_exists", _OLD)],
    }
    return " UNION ALL ".join(loaded + full[mode])


def _load_in_mode(spark: SparkSession, sf_dir: str, mode: SaveMode) -> DataFrame:
    """Load ``customer`` into an absent, an empty and a full sink at the same time."""
    database = new_database(spark)
    run(spark, _config(spark, sf_dir, {"full": "customer"}, sink_schema=database, filter=_OLD))
    spark.catalog.createTable(
        qualified(database, "empty"),
        source="parquet",
        schema=read_table(spark, "parquet", f"{sf_dir}/customer.parquet").schema,
    )
    cases = {before: "customer" for before in ("absent", "empty", "full")}
    config = _config(
        spark,
        sf_dir,
        cases,
        sink_schema=database,
        save_mode=mode,
        concurrent=True,
        verify=Verify.OBSERVED,
    )
    report = run(spark, config, fail_on_error=False)
    return _union(
        [
            _sink(spark, config, before).select(
                F.lit(before).alias("sink_before"),
                F.lit(report.outcome(before).status).alias("status"),
                "*",
            )
            for before in cases
        ]
    )


@query(_mode_sql(SaveMode.APPEND))
def save_mode_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows join the old ones."""
    return _load_in_mode(spark, sf_dir, SaveMode.APPEND)


@query(_mode_sql(SaveMode.OVERWRITE))
def save_mode_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows replace the old ones."""
    return _load_in_mode(spark, sf_dir, SaveMode.OVERWRITE)


@query(_mode_sql(SaveMode.ERROR_IF_EXISTS))
def save_mode_errorifexists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink with rows fails and keeps them; an empty one is loaded."""
    return _load_in_mode(spark, sf_dir, SaveMode.ERROR_IF_EXISTS)


@query(_mode_sql(SaveMode.IGNORE))
def save_mode_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink with rows is skipped and keeps them; an empty one is loaded."""
    return _load_in_mode(spark, sf_dir, SaveMode.IGNORE)


@query(f"SELECT {_CUSTOMER} FROM customer UNION ALL SELECT {_CUSTOMER} FROM customer")
def insert_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink with its columns in another order keeps its definition; values go by name."""
    database = new_database(spark)
    customer = read_table(spark, "parquet", f"{sf_dir}/customer.parquet")
    spark.catalog.createTable(
        qualified(database, "customer"),
        source="parquet",
        schema=customer.select(*reversed(customer.columns)).schema,
    )
    config = _config(
        spark, sf_dir, {"customer": "customer"}, sink_schema=database, save_mode=SaveMode.APPEND
    )
    run(spark, config)
    run(spark, config)
    return _sink(spark, config, "customer")


@query(
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_partkey, l_suppkey,
           CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_extendedprice, l_discount,
           l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
    FROM lineitem"""
)
def insert_into_wider_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink with wider types takes every value as it is."""
    database = new_database(spark)
    source = read_table(spark, "parquet", f"{sf_dir}/lineitem.parquet")
    wider = source.withColumns(
        {
            "l_orderkey": F.col("l_orderkey").cast("decimal(20,0)"),
            "l_linenumber": F.col("l_linenumber").cast("long"),
        }
    )
    spark.catalog.createTable(qualified(database, "lineitem"), source="parquet", schema=wider.schema)
    config = _config(
        spark, sf_dir, {"lineitem": "lineitem"}, sink_schema=database, save_mode=SaveMode.APPEND
    )
    run(spark, config)
    sink = _sink(spark, config, "lineitem")
    return _times_as_text(sink.withColumn("l_orderkey", F.col("l_orderkey").cast("string")))


@query(
    """
    SELECT "mode", 'failed' AS status, TRUE AS names_columns, CAST(o_orderkey AS BIGINT) AS o_orderkey,
           CAST(floor(o_totalprice) AS INTEGER) AS o_totalprice
    FROM orders, (SELECT unnest(['append', 'overwrite']) AS "mode")"""
)
def insert_into_narrower_sink_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink whose types would cut values off is refused and keeps its rows."""
    database = new_database(spark)
    old = read_table(spark, "parquet", f"{sf_dir}/orders.parquet").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.floor("o_totalprice").cast("int").alias("o_totalprice"),
        F.to_date("o_orderdate").alias("o_orderdate"),
        "o_orderpriority",
    )
    old.write.saveAsTable(qualified(database, "orders"))
    found = []
    for mode in (SaveMode.APPEND, SaveMode.OVERWRITE):
        config = _config(
            spark, sf_dir, {"orders": "orders"}, sink_schema=database, save_mode=mode
        )
        outcome = run(spark, config, fail_on_error=False).outcomes[0]
        named = all(c in (outcome.error or "") for c in ("o_totalprice", "o_orderdate"))
        found.append(
            _sink(spark, config, "orders").select(
                F.lit(mode.value).alias("mode"),
                F.lit(outcome.status).alias("status"),
                F.lit(named).alias("names_columns"),
                "o_orderkey",
                "o_totalprice",
            )
        )
    return _union(found)


# --- empty sources, failures, totals ---------------------------------------

_NOTHING = "l_quantity < 0"


def _overwrite_with_nothing(spark: SparkSession, sf_dir: str, on_empty: str) -> DataFrame:
    """Overwrite a loaded sink with a source that the filter leaves empty."""
    first = _config(spark, sf_dir, {"lineitem": "lineitem"}, filter="l_quantity >= 25")
    run(spark, first)
    second = _config(
        spark,
        sf_dir,
        {"lineitem": "lineitem", "untouched": "lineitem"},
        sink_schema=first.sink_schema,
        filter=_NOTHING,
        on_empty=on_empty,
    )
    report = run(spark, second)
    status = {o.sink: o.status for o in report.outcomes}
    return _sink(spark, second, "lineitem").agg(
        F.lit(status["lineitem"]).alias("status"),
        F.lit(status["untouched"]).alias("status_of_absent"),
        F.lit(spark.catalog.tableExists(qualified(second.sink_schema, "untouched"))).alias(
            "absent_created"
        ),
        F.count(F.lit(1)).alias("rows_left"),
    )


@query(
    """
    SELECT 'skipped_empty' AS status, 'skipped_empty' AS status_of_absent,
           FALSE AS absent_created, COUNT(*) AS rows_left
    FROM lineitem WHERE l_quantity >= 25"""
)
def skip_empty_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty source neither creates a sink nor empties one."""
    return _overwrite_with_nothing(spark, sf_dir, "skip")


@query(
    """
    SELECT 'copied' AS status, 'skipped_empty' AS status_of_absent,
           FALSE AS absent_created, COUNT(*) AS rows_left
    FROM lineitem WHERE l_quantity < 0"""
)
def truncate_on_empty_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On request an empty source empties the sink it overwrites."""
    return _overwrite_with_nothing(spark, sf_dir, "truncate")


def _run_with_failures(spark: SparkSession, sf_dir: str) -> RunReport:
    """One predicate for all tables: those without its column fail, and one is missing."""
    config = _config(
        spark,
        sf_dir,
        {**{t: t for t in TABLES}, "no_such_table": "no_such_table"},
        filter="o_orderstatus = 'F'",
        concurrent=True,
    )
    return run(spark, config, fail_on_error=False)


@query(
    " UNION ALL ".join(
        f"SELECT {i} AS run_order, '{t}' AS sink, "
        + (
            "'copied' AS status, COUNT(*) FILTER (o_orderstatus = 'F') AS source_rows, "
            "'' AS reason FROM orders"
            if t == "orders"
            else "'failed' AS status, CAST(0 AS BIGINT) AS source_rows, "
            f"'{'PATH_NOT_FOUND' if t == 'no_such_table' else 'UNRESOLVED_COLUMN'}' AS reason"
        )
        for i, t in enumerate((*TABLES, "no_such_table"), 1)
    )
)
def failure_isolation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that fail do not stop the one that can be copied."""
    reason = F.regexp_extract(F.coalesce("error", F.lit("")), r"\[([A-Z_]+)", 1)
    return (
        _run_with_failures(spark, sf_dir)
        .to_df(spark)
        .select(
            "run_order",
            "sink",
            "status",
            F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
            reason.alias("reason"),
        )
    )


# every table and whether it has rows with the column of the predicate
_HAS_ROWS = " UNION ALL ".join(
    f"SELECT '{t}' AS t, COUNT(*) AS n FROM {t}" for t in TABLES
)


@query(
    f"""
    SELECT COUNT(*) + 1 AS total,
           COUNT(*) FILTER (t = 'orders') AS succeeded,
           COUNT(*) FILTER (t <> 'orders') + 1 AS failed,
           ROUND(100e0 * COUNT(*) FILTER (t = 'orders') / (COUNT(*) + 1), 1) AS success_pct,
           CAST(SUM(n) FILTER (t = 'orders') AS BIGINT) AS rows_copied
    FROM (SELECT t, CASE WHEN t = 'orders' THEN
              (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F') ELSE n END AS n
          FROM ({_HAS_ROWS}))"""
)
def run_totals_with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and success rate of a run, and the rows that it copied."""
    report = _run_with_failures(spark, sf_dir)
    copied = report.to_df(spark).agg(F.sum("source_rows").alias("rows_copied")).first()[0]
    return report.totals(spark).withColumn("rows_copied", F.lit(copied).cast("long"))


@query(
    """
    SELECT c.*, 2 AS loads, 'copied' AS status
    FROM customer c, (SELECT unnest([1, 2]) AS load)"""
)
def append_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of a table, each run twice: a repeated load adds nothing."""
    database = new_database(spark)
    for load in ("monday", "tuesday"):
        for _ in range(2):
            config = _config(
                spark,
                sf_dir,
                {"customer": "customer"},
                sink_schema=database,
                save_mode=SaveMode.APPEND,
                verify=Verify.FINGERPRINT,
                load_id=load,
            )
            status = run(spark, config).outcomes[0].status
    loads = ledger_rows(spark, config).where("state = 'copied'").count()
    return _sink(spark, config, "customer").withColumns({"loads": F.lit(loads), "status": F.lit(status)})


@query(
    """
    SELECT s.sink, s.first, 'copied' AS second, s.attempts,
           CASE s.sink WHEN 'orders' THEN (SELECT COUNT(*) FROM orders)
                       ELSE (SELECT COUNT(*) FROM customer) END AS rows_in_sink
    FROM (VALUES ('orders', 'failed', 2), ('customer', 'copied', 1)) s(sink, first, attempts)"""
)
def run_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of which one table failed; run again, it copies that one alone."""
    sinks = ["orders", "customer"]
    config = _config(spark, sf_dir, {t: t for t in sinks}, load_id="once", verify=Verify.ADDED, save_mode=SaveMode.APPEND)
    orders = qualified(config.sink_schema, "orders")
    spark.sql(f"CREATE TABLE {orders} (other BIGINT) USING parquet")  # does not take the rows
    first = run(spark, config, fail_on_error=False)
    spark.sql(f"DROP TABLE {orders}")
    second = run(spark, config)
    begun = ledger_rows(spark, config).where("state = 'begun'").groupBy("sink").agg(F.count(F.lit(1)).cast("int").alias("attempts"))
    rows = [(t, first.outcome(t).status, second.outcome(t).status) for t in sinks]
    found = _union([_sink(spark, config, t).agg(F.lit(t).alias("sink"), F.count(F.lit(1)).alias("rows_in_sink")) for t in sinks])
    return spark.createDataFrame(rows, "sink string, first string, second string").join(begun, "sink").join(found, "sink")


# --- sinks at a location of their own ---------------------------------------


def _at_location(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    """Overwrite a loaded sink at a location; the sink, and the status of that load."""
    first = _config(spark, sf_dir, {"customer": "customer"}, filter=_OLD)
    at = f"{shared_folder(spark)}/{first.sink_schema}/at"
    run(spark, replace(first, sink_location=at))
    second = replace(first, sink_location=at, verify=Verify.FINGERPRINT, **settings)
    outcome = run(spark, second, fail_on_error=False).outcomes[0]
    return _sink(spark, second, "customer").withColumn("status", F.lit(outcome.status))


@query(f"SELECT {_CUSTOMER}, 'copied' AS status FROM customer WHERE c_nationkey < 12")
def overwrite_at_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink at a location of its own is replaced as a whole."""
    return _at_location(spark, sf_dir, filter="c_nationkey < 12")


@query(f"SELECT {_CUSTOMER}, 'failed' AS status FROM customer WHERE {_OLD}")
def overwrite_at_location_fails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that breaks off halfway leaves a sink at a location as it was."""
    middle = read_table(spark, "parquet", f"{sf_dir}/customer.parquet").agg(F.expr("CAST(AVG(c_custkey) AS BIGINT)")).first()[0]
    breaks = f"c_custkey < {middle} OR raise_error('connection lost') IS NULL"
    return _at_location(spark, sf_dir, filter=breaks)


# --- sink formats ----------------------------------------------------------


@query(_ORDERS_SQL)
def sink_format_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORC files."""
    return _times_as_text(_copy(spark, sf_dir, "orders", sink_format="orc"))


@query(_EVENTS_SQL)
def sink_format_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files, over a table whose text is itself JSON."""
    return _times_as_text(_copy(spark, sf_dir, "events", sink_format="json"))


@query(_ORDERS_SQL)
def transfer_between_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any format to any format: parquet files to orc files to a json table to a parquet table."""
    database = new_database(spark)
    folder = f"{shared_folder(spark)}/{database}/files"

    def step(source: str, source_format: str, sink: str, sink_format: str, **settings) -> None:
        config = TransferConfig(
            [TableSpec(source, sink)],
            source_format,
            database,
            sink_format=sink_format,
            verify=Verify.OBSERVED,
            **settings,
        )
        run(spark, config)

    step(f"{sf_dir}/orders.parquet", "parquet", "as_orc", "orc", sink_location=folder)
    step(f"{folder}/as_orc", "orc", "as_json", "json")
    step(qualified(database, "as_json"), CATALOG, "as_parquet", "parquet")
    return _times_as_text(spark.table(qualified(database, "as_parquet")))


@query(
    f"""SELECT dt, event_type, id_range, hex(encode(uv_bitmap)) AS uv_bitmap_hex
    FROM ({_BITMAP_SQL})"""
)
def sink_format_json_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Converted bitmaps survive JSON files."""
    sink = _copy_bitmap(spark, sf_dir, sink_format="json")
    return _times_as_text(
        sink.select("dt", "event_type", "id_range", F.hex("uv_bitmap").alias("uv_bitmap_hex"))
    )
