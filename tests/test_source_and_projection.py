"""Scans, filters, logical types and conversions, and the plans they get."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tableferry import ConfigError, TableSpec, TransferConfig, TypesRelation, run
from tableferry.functions.bitmap import bytes_to_text, text_cast_to_bytes, text_to_bytes
from tableferry.operators.projection import compare_conversions, project, restore_text
from tableferry.operators.rowfilter import apply_filter, is_empty
from tableferry.operators.verify import sink_rows, verification_counts
from tableferry.sources.logical import discovered, native_schema, tag_logical_types
from tableferry.sources.scan import (
    CATALOG,
    open_source,
    preview,
    read_table,
    register_view,
    schema_report,
)

from .ledger_source import FORMAT, KEY, reads
from .oracle import SF_DIR

TEXTS = [None, "", "1,2,3", "héllo, wörld", "数据🙂", "x" * 100_000, "line\nbreak\t\x00"]


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.fixture
def small(spark):
    return spark.createDataFrame([(1, "oak"), (2, "elm"), (3, "ash")], "id int, value string")


def test_filter_forms(small):
    expected = [(2, "elm"), (3, "ash")]
    assert [tuple(r) for r in apply_filter(small, "id > 1").collect()] == expected
    assert [tuple(r) for r in apply_filter(small, F.col("id") > 1).collect()] == expected
    for none in (None, "", "  \n"):
        assert apply_filter(small, none).count() == 3


def test_filter_takes_any_spark_sql(spark, small):
    small.createOrReplaceTempView("small")
    assert apply_filter(small, "id IN (SELECT max(id) FROM small)").count() == 1
    assert apply_filter(small, "upper(value) LIKE '%LM'").count() == 1


def test_date_range_ends_at_midnight(spark):
    times = [dt.datetime(2022, 12, 31), dt.datetime(2022, 12, 31, 10), dt.datetime(2021, 1, 1)]
    rows = spark.createDataFrame([(t,) for t in times], "dt timestamp_ntz")
    kept = apply_filter(rows, "dt between '2022-01-01' and '2022-12-31'").collect()
    assert [r.dt for r in kept] == [dt.datetime(2022, 12, 31)]


def test_format_and_table_key(spark, tmp_path):
    options = {"ledger.log": str(tmp_path / "log"), "ledger.rows": "5", "ledger.partitions": "3"}
    rows = read_table(spark, FORMAT, "db.t", KEY, options)
    assert rows.count() == 15
    assert [r.source_table for r in rows.select("source_table").distinct().collect()] == ["db.t"]


def test_source_side_predicate_is_passed_on(spark, tmp_path):
    options = {"ledger.log": str(tmp_path / "log"), "ledger.rows": "5", "ledger.partitions": "3"}
    rows = read_table(spark, FORMAT, "db.t", KEY, options | {"ledger.min": "1000000"})
    assert rows.count() == 10


def test_reader_options_reach_a_file_source(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t" / "keep"))
    spark.range(5).write.orc(str(tmp_path / "t" / "other"))
    rows = read_table(
        spark,
        "parquet",
        str(tmp_path / "t"),
        options={"pathGlobFilter": "*.parquet", "recursiveFileLookup": "true"},
    )
    assert rows.count() == 10


def test_table_options_override_run_options(spark, tmp_path):
    log = str(tmp_path / "log")
    config = TransferConfig(
        [TableSpec("db.a"), TableSpec("db.b", source_options={"ledger.rows": "7"})],
        FORMAT,
        "s",
        source_table_key=KEY,
        source_options={"ledger.log": log, "ledger.rows": "5", "ledger.partitions": "1"},
    )
    assert [open_source(spark, config, t).count() for t in config.tables] == [5, 7]


def test_catalog_source(spark, small, database):
    small.write.saveAsTable(f"{database}.small")
    assert read_table(spark, CATALOG, f"{database}.small").count() == 3
    # rows that another session adds are read too
    location = next(
        r.data_type
        for r in spark.sql(f"DESCRIBE EXTENDED {database}.small").collect()
        if r.col_name == "Location"
    )
    small.write.mode("append").parquet(location)
    assert read_table(spark, CATALOG, f"{database}.small").count() == 6


def test_view_source(spark, small, tmp_path):
    small.write.parquet(str(tmp_path / "t"))
    spark.read.parquet(str(tmp_path / "t")).createOrReplaceTempView("small_files")
    assert read_table(spark, CATALOG, "small_files").count() == 3
    small.write.mode("append").parquet(str(tmp_path / "t"))
    assert read_table(spark, CATALOG, "small_files").count() == 6


def test_predicate_and_columns_reach_the_scan(spark):
    config = TransferConfig([f"{SF_DIR}/orders.parquet"], "parquet", "s", filter="o_custkey > 5")
    rows = project(open_source(spark, config, config.tables[0]))
    shown = plan(rows.select("o_orderkey"))
    assert "GreaterThan(o_custkey,5)" in shown
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in shown


def test_partitions_are_pruned_below_the_conversion(spark, tmp_path):
    path = str(tmp_path / "days.parquet")
    days = spark.range(100).selectExpr(
        "id", "string(id) AS uv", "date_add(DATE'2022-01-01', int(id % 10)) AS dt"
    )
    days.write.partitionBy("dt").parquet(path)
    spec = TableSpec(path, logical_types={"uv": "bitmap"})
    condition = "dt between '2022-01-03' and '2022-01-04' AND uv < '5'"
    config = TransferConfig([spec], "parquet", "s", filter=condition)
    rows = project(open_source(spark, config, spec))
    shown = plan(rows)
    assert "PartitionFilters: [isnotnull(dt" in shown
    assert "PushedFilters: [IsNotNull(uv), LessThan(uv,5)]" in shown
    assert len(rows.inputFiles()) > 0 and rows.count() == 10


def test_transfer_plan_is_one_stage_in_codegen(spark):
    spec = TableSpec(f"{SF_DIR}/documents.parquet", logical_types={"text": "bitmap"})
    config = TransferConfig([spec], "parquet", "s", filter="doc_id > 3")
    shown = plan(project(open_source(spark, config, spec)))
    assert "Exchange" not in shown
    assert "Python" not in shown
    assert "*(1) Project [doc_id" in shown


def test_logical_types(spark, small):
    tagged = tag_logical_types(small, {"VALUE": "BitMap"})
    assert native_schema(tagged) == [("id", "int"), ("value", "bitmap")]
    assert native_schema(tagged.filter("id > 1").select("value")) == [("value", "bitmap")]
    assert tag_logical_types(small, {}) is small
    with pytest.raises(ConfigError, match="nope"):
        tag_logical_types(small, {"nope": "bitmap"})


def test_conversion_of_bitmap_columns(spark):
    texts = [(i, t, t) for i, t in enumerate(TEXTS)]
    rows = spark.createDataFrame(texts, "i int, uv string, s string")
    tagged = tag_logical_types(rows, {"uv": "bitmap"})
    converted = project(tagged)
    assert converted.columns == ["i", "uv", "s"]
    assert [f.dataType.simpleString() for f in converted.schema] == ["int", "binary", "string"]
    assert native_schema(converted)[1] == ("uv", "bitmap")
    expected = {i: None if t is None else t.encode() for i, t in enumerate(TEXTS)}
    got = {r.i: None if r.uv is None else bytes(r.uv) for r in converted.collect()}
    assert got == expected
    back = restore_text(converted, ["UV"]).select("i", "uv", "s")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_conversion_off_or_not_needed(spark):
    rows = spark.createDataFrame([(1, "a", b"\xff")], "i int, uv string, done binary")
    tagged = tag_logical_types(rows, {"uv": "bitmap", "done": "bitmap"})
    off = project(tagged, bitmap_to_binary=False).schema
    assert [f.dataType.simpleString() for f in off] == ["int", "string", "binary"]
    row = project(tagged).first()
    assert (bytes(row.uv), bytes(row.done)) == (b"a", b"\xff")


def test_bitmap_that_is_not_text_is_refused(spark):
    arrays = spark.createDataFrame([(1, [2])], "i int, uv array<int>")
    rows = tag_logical_types(arrays, {"uv": "bitmap"})
    with pytest.raises(ConfigError, match="array<int>"):
        project(rows)
    assert project(rows, bitmap_to_binary=False).columns == ["i", "uv"]


def test_both_conversions_agree(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text")
    other = text_to_bytes(F.col("text")) != text_cast_to_bytes(F.col("text"))
    lost = bytes_to_text(text_to_bytes(F.col("text"))) != F.col("text")
    assert rows.filter(other | lost).count() == 0


def test_text_that_is_not_valid_utf8(spark):
    """The conversion always gives UTF-8, as a string of the JVM would; the cast keeps the bytes."""
    rows = spark.createDataFrame([(b"a\xffb",)], "b binary").select(F.col("b").cast("string"))
    row = rows.select(
        text_to_bytes(F.col("b")).alias("converted"), text_cast_to_bytes(F.col("b")).alias("cast")
    ).first()
    assert bytes(row.converted) == "a\ufffdb".encode()
    assert bytes(row["cast"]) == b"a\xffb"


def test_compare_conversions(spark):
    rows = tag_logical_types(
        spark.createDataFrame([(1, "é"), (2, None)], "i int, `u.v` string"), {"u.v": "bitmap"}
    )
    shown = compare_conversions(rows)
    assert shown.columns == ["i", "u.v", "u.v_bytes_hex", "u.v_cast_hex", "u.v_decoded"]
    assert [tuple(r) for r in shown.orderBy("i").collect()] == [
        (1, "é", "C3A9", "C3A9", "é"),
        (2, None, None, None, None),
    ]


def test_odd_column_names(spark):
    rows = spark.createDataFrame([(1, "a", "b")], "`a.b` int, `c d` string, `e``f` string")
    tagged = tag_logical_types(rows, {"c d": "bitmap", "e`f": "bitmap"})
    assert project(tagged).columns == ["a.b", "c d", "e`f"]
    assert restore_text(project(tagged), ["c d", "e`f"]).first() == rows.first()


def test_sink_predicate_sees_text_again(spark, database, small):
    tagged = tag_logical_types(small, {"value": "bitmap"})
    project(tagged).write.saveAsTable(f"{database}.t")
    # a predicate on text that bytes would not pass
    condition = "value IN ('oak', 'elm') AND id < 3"
    assert sink_rows(spark, f"{database}.t", condition, ["value"]).count() == 2
    # one that does not touch the converted column still reaches the scan alone
    shown = plan(sink_rows(spark, f"{database}.t", "id > 1", ["value"]).groupBy().count())
    assert "GreaterThan(id,1)" in shown and "ReadSchema: struct<id:int>" in shown


def test_counts_read_no_columns(spark):
    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    counts = verification_counts(rows, rows.limit(0))
    assert "ReadSchema: struct<>" in plan(counts)
    assert {r.side: r.rows for r in counts.collect()} == {"source": rows.count(), "sink": 0}


def test_preview_and_view(spark, small):
    assert preview(small, 2).count() == 2
    assert [r.id for r in preview(small, 2, [F.col("id").desc()]).collect()] == [3, 2]
    assert "TakeOrderedAndProject" in plan(preview(small, 2, ["id"]))
    assert register_view(small, "small") == "source_small"
    assert spark.sql("SELECT count(*) AS n FROM source_small WHERE id > 1").first().n == 2
    assert register_view(small, "a-b c") == "source_a-b c"
    assert spark.table("`source_a-b c`").count() == 3


def test_schema_report(spark, write_source):
    path = write_source([(1, "a")], "i int, uv string")
    config = TransferConfig([TableSpec(path, "t", {"uv": "bitmap"})], "parquet", "s")
    assert [tuple(r) for r in schema_report(spark, config).collect()] == [
        (path, 1, "i", "int"),
        (path, 2, "uv", "bitmap"),
    ]


def test_emptiness_reads_as_little_as_it_can(spark, tmp_path):
    log = tmp_path / "log"
    options = {"ledger.log": str(log), "ledger.rows": "10", "ledger.partitions": "60"}
    rows = read_table(spark, FORMAT, "db.t", KEY, options)
    assert not is_empty(rows)
    assert reads(log, "db.t") == 1
    assert not is_empty(rows.filter("id >= 3000000"))  # first found in partition 3
    assert reads(log, "db.t") == 1 + 1 + 4
    assert is_empty(rows.filter("id < 0"))
    assert reads(log, "db.t") == 1 + 1 + 4 + 60


@pytest.fixture
def listed(spark, tmp_path):
    path = str(tmp_path / "columns")
    spark.createDataFrame(
        [
            ("db", "a", "id", "bigint"),
            ("db", "a", "uv", "BITMAP"),
            ("db", "a", "uw", "bitmap(64)"),
            ("db", "b", "id", "bigint"),
            ("other", "a", "id", "bitmap"),
        ],
        "table_schema string, table_name string, column_name string, data_type string",
    ).write.parquet(path)
    return TypesRelation("parquet", path, schema_column="table_schema")


def test_bitmaps_are_discovered(spark, listed):
    tables = [TableSpec("db.a", logical_types={"id": "bitmap", "uw": "text"}), TableSpec("db.b", "x")]
    found = discovered(spark, listed, tables)
    assert found[0].logical_types == {"uv": "bitmap", "uw": "text", "id": "bitmap"}
    assert (found[1].logical_types, found[1].sink) == ({}, "x")


def test_tables_that_are_not_listed_are_an_error(spark, listed):
    with pytest.raises(ConfigError, match=r"no columns of \['db.c'\]"):
        discovered(spark, listed, [TableSpec("db.a"), TableSpec("db.c")])
    with pytest.raises(ConfigError, match="lists no columns"):
        run(spark, TransferConfig(["db.c"], "parquet", "x", types=listed))


def test_a_declared_schema_saves_a_scan(spark, tmp_path):
    path = str(tmp_path / "t.json")
    spark.range(1000).selectExpr("id", "cast(id as string) as s").write.json(path)
    tracker = spark.sparkContext.statusTracker()

    def jobs(schema):
        group = f"schema-{schema}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            config = TransferConfig([TableSpec(path, "t", schema=schema)], "json", "x")
            rows = open_source(spark, config, config.tables[0])
            return len(tracker.getJobIdsForGroup(group)), rows.dtypes, rows.count()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    assert jobs(None)[0] == 1  # infers
    assert jobs("id BIGINT, s STRING") == (0, [("id", "bigint"), ("s", "string")], 1000)


def test_jdbc_tables_read_by_one_task_are_pointed_out(spark, caplog):
    from tableferry.sources.scan import _warn_of_one_task

    _warn_of_one_task("jdbc", "t", {"url": "x"})
    assert "one task" in caplog.text
    caplog.clear()
    _warn_of_one_task("JDBC", "t", {"numPartitions": "8"})
    _warn_of_one_task("parquet", "t", {})
    assert not caplog.text
