import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tableferry import ConfigError, TableSpec, TransferConfig, run
from tableferry.functions.names import qualified
from tableferry.operators.rowfilter import is_empty
from tableferry.operators.sink import (
    align_by_name,
    create_sink,
    insert,
    sink_exists,
    sink_identifier,
)
from tableferry.operators.swap import replace


def config_for(database, **settings):
    return TransferConfig(["t"], "parquet", database, **settings)


@pytest.fixture
def rows(spark):
    return spark.range(100).select("id", (F.col("id") * 2).alias("twice"))


def test_identifier_takes_catalog_and_schema():
    assert sink_identifier(config_for("cat.`my.db`"), "t x") == "`cat`.`my.db`.`t x`"


def test_create_declares_the_schema(spark, database, rows):
    sink = qualified(database, "t")
    assert not sink_exists(spark, sink)
    create_sink(spark, config_for(database), sink, "t", rows.schema)
    assert sink_exists(spark, sink) and is_empty(spark.table(sink))
    assert all(f.nullable for f in spark.table(sink).schema)
    assert insert(spark, rows, sink) == 100
    assert not is_empty(spark.table(sink))


def test_option_values_and_keys_are_taken_as_they_are(spark, database, rows):
    sink = qualified(database, "t")
    odd = {"owner-name": "it's \"quoted\"", "schema": "s", "compression": "zstd"}
    config = config_for(database, sink_options=odd, sink_table_key="table")
    create_sink(spark, config, sink, "t", rows.schema)
    assert insert(spark, rows, sink) == 100
    stored = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {sink}").collect()}
    assert "owner-name=it's \"quoted\"" in stored["Storage Properties"]
    assert "SCHEMA=s" in stored["Storage Properties"]
    assert "table=t" in stored["Storage Properties"]
    assert all(".zstd." in f for f in spark.table(sink).inputFiles())


def test_location_and_rows_per_file(spark, database, rows, tmp_path):
    sink = qualified(database, "t")
    create_sink(
        spark,
        config_for(database, sink_location=f"{tmp_path}/out/", rows_per_file=10),
        sink,
        "t",
        rows.schema,
    )
    insert(spark, rows.coalesce(1), sink)
    assert len(list((tmp_path / "out" / "t").glob("*.parquet"))) == 10
    assert spark.read.parquet(f"{tmp_path}/out/t").count() == 100


def test_insert_by_name(spark, database, rows):
    sink = qualified(database, "t")
    create_sink(spark, config_for(database), sink, "t", rows.select("twice", "id").schema)
    insert(spark, rows, sink)
    assert spark.table(sink).columns == ["twice", "id"]
    assert spark.table(sink).filter("twice = 2 * id").count() == 100


def test_columns_must_agree(spark, rows):
    with pytest.raises(ConfigError, match=r"only in source \['twice'\], only in sink \['other'\]"):
        align_by_name(rows, rows.withColumnRenamed("twice", "other"))
    assert align_by_name(rows, rows.withColumnRenamed("id", "ID")).count() == 100


def test_append_overwrite_and_empty_writes(spark, database, rows):
    sink = qualified(database, "t")
    create_sink(spark, config_for(database), sink, "t", rows.schema)
    assert insert(spark, rows, sink) == 100
    assert insert(spark, rows, sink) == 100
    assert spark.table(sink).count() == 200
    assert insert(spark, rows.filter("id < 7"), sink, overwrite=True) == 7
    assert spark.table(sink).count() == 7
    # also where the optimizer sees that there is nothing
    assert insert(spark, rows.filter("false"), sink) == 0
    assert insert(spark, rows.filter("id < 0"), sink) == 0
    assert spark.table(sink).count() == 7
    assert insert(spark, rows.filter("false"), sink, overwrite=True) == 0
    assert spark.table(sink).count() == 0


def test_rebalance_counts_the_same(spark, database, rows):
    sink = qualified(database, "t")
    create_sink(spark, config_for(database), sink, "t", rows.schema)
    assert insert(spark, rows.repartition(50), sink, rebalance=True) == 100
    assert len(spark.table(sink).inputFiles()) < 8
    assert spark.table(sink).distinct().count() == 100


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_overwrite_of_a_partitioned_sink_is_whole_or_refused(spark, database, rows, mode):
    sink = qualified(database, "t")
    parts = rows.select("twice", (F.col("id") % 4).alias("id"))
    parts.write.partitionBy("id").saveAsTable(sink)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        if mode == "static":
            insert(spark, parts.filter("id = 1"), sink, overwrite=True)
            assert [r.id for r in spark.table(sink).select("id").distinct().collect()] == [1]
        else:
            with pytest.raises(ConfigError, match="static"):
                insert(spark, parts.filter("id = 1"), sink, overwrite=True)
            assert spark.table(sink).count() == 100
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


ALL_TYPES = (
    "i int, l bigint, f float, d double, b boolean, s string, bin binary, dec decimal(30,10), "
    "day date, ts timestamp, ntz timestamp_ntz, arr array<string>, m map<string,int>, "
    "st struct<x:int,y:array<struct<z:string>>>"
)
VALUES = [
    (
        1,
        2**62,
        0.1,
        float("nan"),
        True,
        'quote " comma , line\r\nend 数🙂',
        b"\x00\xff",
        decimal.Decimal("12345678901234567890.0123456789"),
        dt.date(1900, 1, 1),
        dt.datetime(2024, 2, 29, 23, 59, 59, 999999),
        dt.datetime(1969, 12, 31, 23, 59, 59, 1),
        ["a", None, ""],
        {"k": 1, "n": None},
        (1, [("q",), (None,)]),
    ),
    (None,) * 14,
    (0, -1, float("-inf"), -0.0, False, "", b"", decimal.Decimal(0), dt.date(9999, 12, 31),
     dt.datetime(1970, 1, 1), dt.datetime(2024, 1, 1), [], {}, (None, [])),
]


@pytest.mark.parametrize("sink_format", ["parquet", "orc", "json"])
def test_every_type_passes_through(spark, database, tmp_path, sink_format):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame(VALUES, ALL_TYPES).coalesce(1).write.parquet(path)
    config = TransferConfig([path], "parquet", database, sink_format=sink_format)
    run(spark, config)
    source, sink = spark.read.parquet(path), spark.table(f"{database}.t")
    assert sink.dtypes == source.dtypes
    assert repr(sorted(sink.collect(), key=repr)) == repr(sorted(source.collect(), key=repr))


@pytest.mark.parametrize("sink_format", ["csv", "TEXT"])
def test_formats_that_change_values_are_refused(spark, database, rows, sink_format):
    sink = qualified(database, "t")
    with pytest.raises(ConfigError, match="would change values"):
        create_sink(spark, config_for(database, sink_format=sink_format), sink, "t", rows.schema)
    assert not sink_exists(spark, sink)


def test_one_path_for_all_tables_is_refused(database):
    with pytest.raises(ConfigError, match="sink_location"):
        config_for(database, sink_options={"Path": "/x"})


def test_provider_that_knows_its_schema(spark, database, rows, tmp_path):
    """Without a declared schema the provider resolves it, here from files that exist."""
    rows.select("twice", "id").write.parquet(str(tmp_path / "t"))
    sink = qualified(database, "t")
    config = config_for(
        database, sink_location=str(tmp_path), sink_table_key="table", declare_sink_schema=False
    )
    create_sink(spark, config, sink, "t", rows.schema)
    assert spark.table(sink).columns == ["twice", "id"]
    assert "'table' = 't'" in spark.sql(f"SHOW CREATE TABLE {sink}").first()[0]
    assert insert(spark, rows, sink) == 100
    assert spark.table(sink).filter("twice = 2 * id").count() == 200


def test_char_and_varchar_columns(spark, database):
    source = qualified(database, "source")
    spark.sql(f"CREATE TABLE {source} (c CHAR(4), v VARCHAR(5), s STRING) USING parquet")
    spark.sql(f"INSERT INTO {source} VALUES ('ab', 'abc', 'x'), (NULL, NULL, NULL)")
    for _ in range(2):
        run(spark, TransferConfig([TableSpec(source, "t")], "catalog", database, verify="recount"))
    sink = spark.table(f"{database}.t")
    assert sorted(map(tuple, sink.collect()), key=repr) == [("ab  ", "abc", "x"), (None, None, None)]


def test_a_failed_overwrite_leaves_the_old_rows(spark, database, rows):
    source = qualified(database, "source")
    rows.write.saveAsTable(source)
    config = TransferConfig([TableSpec(source, "t")], "catalog", database)
    run(spark, config)
    breaks = "id < 99 OR raise_error('broken') IS NULL"
    failing = TransferConfig([TableSpec(source, "t")], "catalog", database, filter=breaks)
    outcome = run(spark, failing, fail_on_error=False).outcomes[0]
    assert outcome.status == "failed" and "broken" in outcome.error
    assert spark.table(f"{database}.t").count() == 100
    assert {t.name for t in spark.catalog.listTables(database) if not t.isTemporary} == {"source", "t"}
    config = TransferConfig([TableSpec(source, "t")], "catalog", database, filter="id < 40")
    assert run(spark, config).outcomes[0].source_rows == 40
    assert spark.table(f"{database}.t").count() == 40
    assert {t.name for t in spark.catalog.listTables(database) if not t.isTemporary} == {"source", "t"}


def test_a_swapped_sink_keeps_its_definition(spark, database, rows):
    sink = qualified(database, "t")
    spark.sql(
        f"CREATE TABLE {sink} (twice BIGINT COMMENT 'two', id BIGINT) USING orc "
        "PARTITIONED BY (id) COMMENT 'mine' TBLPROPERTIES ('team' = 'it\\'s me')"
    )
    insert(spark, rows, sink)
    assert replace(spark, rows.where("id < 5"), sink) == 5
    shown = spark.sql(f"SHOW CREATE TABLE {sink}").first()[0]
    assert "USING orc" in shown and "PARTITIONED BY (id)" in shown and "it\\'s me" in shown
    assert "COMMENT 'two'" in shown and "COMMENT 'mine'" in shown
    assert spark.table(sink).count() == 5


@pytest.mark.parametrize(
    "source, sink",
    [
        ("double", "int"), ("timestamp", "date"), ("bigint", "int"), ("bigint", "double"),
        ("decimal(10,2)", "decimal(10,1)"), ("decimal(12,2)", "decimal(10,2)"), ("int", "decimal(9,0)"),
        ("array<double>", "array<int>"), ("map<string,bigint>", "map<string,int>"),
        ("struct<a:double>", "struct<a:int>"), ("struct<a:int,b:int>", "struct<b:int,a:int>"),
        ("string", "int"), ("int", "string"), ("timestamp", "timestamp_ntz"), ("double", "float"),
        ("string", "binary"),
    ],
)
def test_narrower_sinks_are_refused(spark, database, source, sink):
    rows = spark.sql(f"SELECT 1 AS id, CAST(NULL AS {source}) AS v")
    spark.sql(f"CREATE TABLE {database}.t (id INT, v {sink}) USING parquet")
    with pytest.raises(ConfigError, match="would change values: v"):
        insert(spark, rows, qualified(database, "t"))
    assert spark.table(f"{database}.t").count() == 0


@pytest.mark.parametrize(
    "source, sink, value",
    [
        ("tinyint", "smallint", "7"), ("int", "bigint", "-2147483648"), ("int", "double", "2147483647"),
        ("smallint", "float", "32767"), ("float", "double", "0.5"), ("bigint", "decimal(19,0)", "9223372036854775807"),
        ("decimal(10,2)", "decimal(12,3)", "12345678.91"), ("date", "timestamp", "date'2024-02-29'"),
        ("array<int>", "array<bigint>", "array(1, 2)"),
        ("struct<a:int>", "struct<a:bigint>", "named_struct('a', 3)"), ("string", "string", "'x'"),
    ],
)
def test_wider_sinks_take_every_value(spark, database, source, sink, value):
    rows = spark.sql(f"SELECT CAST({value} AS {source}) AS v")
    spark.sql(f"CREATE TABLE {database}.t (v {sink}) USING parquet")
    insert(spark, rows, qualified(database, "t"))
    assert spark.table(f"{database}.t").where(F.col("v") == F.expr(f"CAST({value} AS {source})")).count() == 1


@pytest.mark.parametrize("mode", ["append", "overwrite"])
@pytest.mark.parametrize("provider", ["csv", "json"])
def test_existing_sinks_that_change_values_are_refused(spark, database, provider, mode):
    source = qualified(database, "source")
    spark.sql("SELECT 'a\nb' AS s, timestamp'2024-01-01 00:00:00.123456' AS at").write.saveAsTable(source)
    spark.sql(f"CREATE TABLE {database}.t (s STRING, at TIMESTAMP) USING {provider}")
    spark.sql(f"INSERT INTO {database}.t VALUES ('old', timestamp'2020-01-01 00:00:00')")
    config = TransferConfig([TableSpec(source, "t")], "catalog", database, save_mode=mode)
    outcome = run(spark, config, fail_on_error=False).outcomes[0]
    assert outcome.status == "failed" and outcome.error.startswith("ConfigError")
    assert [r.s for r in spark.table(f"{database}.t").collect()] == ["old"]


def test_existing_json_sinks_with_full_precision_are_loaded(spark, database):
    source = qualified(database, "source")
    spark.sql("SELECT timestamp'2024-01-01 00:00:00.123456' AS at").write.saveAsTable(source)
    config = TransferConfig([TableSpec(source, "t")], "catalog", database, sink_format="json", save_mode="append")
    for n in (1, 2):
        run(spark, config)
        assert spark.table(f"{database}.t").where("at = timestamp'2024-01-01 00:00:00.123456'").count() == n


def test_a_sink_made_by_another_job_is_used(spark, database, rows):
    sink = qualified(database, "t")
    create_sink(spark, config_for(database), sink, "t", rows.schema)
    create_sink(spark, config_for(database), sink, "t", rows.schema)
    assert insert(spark, rows, sink) == 100


def test_rows_of_another_session_are_seen(spark, database, rows):
    """Spark keeps file listings; a sink is judged by what it holds now."""
    source = qualified(database, "source")
    rows.write.saveAsTable(source)
    sink = qualified(database, "t")
    create_sink(spark, config_for(database), sink, "t", rows.schema)
    assert is_empty(spark.table(sink))
    location = next(
        r.data_type
        for r in spark.sql(f"DESCRIBE EXTENDED {sink}").collect()
        if r.col_name == "Location"
    )
    rows.write.mode("append").parquet(location)  # behind the catalog's back
    config = TransferConfig([TableSpec(source, "t")], "catalog", database, save_mode="ignore")
    assert run(spark, config).outcomes[0].status == "skipped_exists"
    config = TransferConfig(
        [TableSpec(source, "t")], "catalog", database, save_mode="append", verify="observed"
    )
    outcome = run(spark, config).outcomes[0]
    assert (outcome.rows_before, outcome.sink_rows, outcome.verified) == (100, 200, True)
