"""Predicates that a source evaluates itself, and scans cut into ranges."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tableferry import ConfigError, TableSpec, TransferConfig, run
from tableferry.config import from_settings
from tableferry.sources.scan import open_source
from tableferry.sources.splits import both, ends_of_ranges, literal, predicates

from .predicate_source import FORMAT, PredicateSource, key


@pytest.fixture
def source(spark, database, tmp_path):
    spark.dataSource.register(PredicateSource)
    log = tmp_path / "log"

    def make(rows=3000, splits=8, column="k", options=(), **settings):
        settings.setdefault("source_predicate_key", "where")
        spec = TableSpec("t", split_column=column, splits=splits)
        given = {"rows": str(rows), "log": str(log), **dict(options)}
        return TransferConfig([spec], FORMAT, database, "table", given, **settings)

    make.scans = lambda: [int(x) for x in log.read_text().split()] if log.exists() else []
    return make


def test_the_source_gets_the_filter_and_spark_keeps_it(spark, source):
    config = source(column=None, filter="id >= 100 AND id < 150", verify="fingerprint")
    assert run(spark, config).outcomes[0].source_rows == 50
    assert source.scans()[-1] == 50
    deaf = source(column=None, filter="id >= 100 AND id < 150", options={"deaf": "1"})
    assert run(spark, deaf).outcomes[0].source_rows == 50
    assert source.scans()[-1] == 3000
    own = source(column=None, filter="id < 150", options={"where": "id >= 140"})
    assert run(spark, own).outcomes[0].source_rows == 10
    assert source.scans()[-1] == 10


def test_a_column_filter_is_not_text_and_stays_with_spark(spark, source):
    config = source(column=None, filter=F.col("id") < 5)
    assert run(spark, config).outcomes[0].source_rows == 5
    assert source.scans()[-1] == 3000


@pytest.mark.parametrize("rows", [0, 1, 9, 3000])
@pytest.mark.parametrize("splits", [1, 2, 8, 50])
def test_every_row_comes_once(spark, source, rows, splits):
    found = open_source(spark, source(rows, splits), source(rows, splits).tables[0])
    assert sorted((r.id, r.k) for r in found.collect()) == [(i, key(i)) for i in range(rows)]


def test_ranges_are_even_and_a_frequent_value_is_by_itself(spark, source):
    config = source(3000, 10)
    found = open_source(spark, config, config.tables[0])
    before = len(source.scans())
    assert found.count() == 3000
    scans = source.scans()[before:]
    assert sum(scans) == 3000 and 7 <= len(scans) <= 11
    hot = sum(key(i) == 7 for i in range(3000))
    assert max(scans) == hot and sorted(scans)[-2] <= 3000 / 10 * 2.2
    assert found.rdd.getNumPartitions() == len(scans)


def test_a_source_that_is_deaf_to_ranges_gives_rows_once_all_the_same(spark, source):
    config = source(300, 4, options={"deaf": "1"}, verify="fingerprint")
    assert run(spark, config).outcomes[0].source_rows == 300


def test_filter_and_ranges_together(spark, source, database):
    config = source(3000, 6, filter="id < 1000", verify="recount")
    assert run(spark, config).outcomes[0].source_rows == 1000
    assert all(n <= 1000 for n in source.scans())
    assert spark.table(f"{database}.t").select("id").distinct().count() == 1000


@pytest.mark.parametrize(
    "sql", ["date'2024-01-01' + CAST(id % 50 AS INT)", "timestamp_micros(id * 1234567890)", "id * 0.25D", "CAST(id AS DECIMAL(20, 3)) / 7",
            "CAST(timestamp_micros(id * 1234567) AS TIMESTAMP_NTZ)", "-id"]
)
def test_types_of_the_column(spark, sql):
    rows = spark.sql(f"SELECT IF(id % 9 = 0, NULL, {sql}) AS c, id FROM range(400)")
    parts = [rows.where(p) for p in predicates("`c`", ends_of_ranges(rows, "c", 7))]
    assert len(parts) >= 7
    counts = [p.count() for p in parts]
    assert sum(counts) == 400 and max(counts) < 400 / 7 * 2.5
    assert len({r.id for p in parts for r in p.collect()}) == 400


def test_predicates_and_literals():
    assert predicates("k", []) == []
    assert predicates("k", [3]) == ["k < 3 OR k IS NULL", "k >= 3"]
    assert predicates("k", [3, 5, 5, 9]) == [
        "k < 3 OR k IS NULL", "k >= 3 AND k < 5", "k >= 5 AND k <= 5", "k > 5 AND k < 9", "k >= 9",
    ]
    assert literal(decimal.Decimal("1E+3")) == "1000" and literal(0.5) == "0.5"
    assert literal(dt.date(2024, 2, 3)) == "DATE '2024-02-03'"
    assert literal(dt.datetime(2024, 2, 3, 4, 5, 6, 7)) == "TIMESTAMP '2024-02-03 04:05:06.000007'"
    assert both(None, " ", "a = 1") == "a = 1" and both("a", "b OR c") == "(a) AND (b OR c)" and both() is None


def test_what_cannot_be_split_is_refused(spark, source):
    with pytest.raises(ConfigError, match="source_predicate_key"):
        source(source_predicate_key=None)
    with pytest.raises(ConfigError, match="splits"):
        source(splits=0)
    with pytest.raises(ConfigError, match="split by a number"):
        ends_of_ranges(spark.sql("SELECT 'a' AS c"), "c", 4)


def test_settings():
    settings = {
        "spark.source.format": "f", "spark.source.table.key": "k", "spark.source.table.values": "a.b,c",
        "spark.sink.schema": "s", "spark.source.split.column.a.b": "id", "spark.source.split.count": "5",
        "spark.source.predicate.key": "filter.query", "spark.sink.load.id": "7", "spark.sink.ledger": "l",
    }
    config = from_settings(settings)
    assert [(t.split_column, t.splits) for t in config.tables] == [("id", 5), (None, 5)]
    assert (config.source_predicate_key, config.load_id, config.ledger) == ("filter.query", "7", "l")
    assert not {'load.id', 'ledger'} & set(config.sink_options)
