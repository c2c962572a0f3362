"""Verification of values, and of what an append added."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tableferry import TableSpec, TransferConfig, run, transfer_table
from tableferry.functions.names import qualified
from tableferry.operators import newfiles
from tableferry.operators.fingerprint import facts, row_hash
from tableferry.operators.sink import insert
from tableferry.plans import transfer as transfer_module

from .ledger_source import FORMAT, KEY, reads


def config_of(database, **settings):
    settings.setdefault("verify", "fingerprint")
    return TransferConfig([TableSpec(qualified(database, "source"), "t")], "catalog", database, **settings)


def copy(spark, config):
    return transfer_table(spark, config, config.tables[0])


def counts(got):
    return got.status, got.verified, got.source_rows, got.rows_before, got.sink_rows


@pytest.fixture
def source(spark, database):
    spark.sql(
        "SELECT id, CAST(id AS STRING) AS v, IF(id % 7 = 0, NULL, id * 0.5D) AS d, CAST(id % 3 AS INT) AS part, "
        "named_struct('a', IF(id % 2 = 0, NULL, id), 'b', array(id, NULL)) AS s, map('k', id, 'j', CAST(NULL AS BIGINT)) AS m, "
        "timestamp_micros(id * 1234567) AS at, CAST(id AS DECIMAL(30, 4)) AS e, CAST(CAST(id AS STRING) AS BINARY) AS y FROM range(60)"
    ).write.saveAsTable(qualified(database, "source"))
    return database


@pytest.mark.parametrize("sink_format", ["parquet", "orc", "json"])
@pytest.mark.parametrize("verify", ["added", "fingerprint"])
def test_every_mode_and_format(spark, source, verify, sink_format):
    settings = dict(verify=verify, sink_format=sink_format)
    assert counts(copy(spark, config_of(source, **settings))) == ("copied", True, 60, 0, 60)
    assert counts(copy(spark, config_of(source, **settings))) == ("copied", True, 60, 0, 60)
    for _ in range(2):
        got = copy(spark, config_of(source, save_mode="append", filter="id < 20", **settings))
        assert counts(got) == ("copied", True, 20, None, 20)
    got = copy(spark, config_of(source, save_mode="append", filter="id < 0", **settings))
    assert counts(got)[:3] == ("skipped_empty", None, 0)
    assert spark.table(f"{source}.t").count() == 100


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_partitioned_sinks_of_other_types(spark, source, mode):
    spark.sql(
        f"CREATE TABLE {source}.t (v VARCHAR(9), part BIGINT, id DECIMAL(20,0), d DOUBLE, s STRUCT<a: BIGINT, b: ARRAY<BIGINT>>, "
        "m MAP<STRING, BIGINT>, at TIMESTAMP, e DECIMAL(34, 6), y BINARY) USING parquet PARTITIONED BY (part)"
    )
    for _ in range(2):
        assert copy(spark, config_of(source, save_mode=mode)).verified
    assert spark.table(f"{source}.t").count() == (120 if mode == "append" else 60)


def test_padded_text(spark, database):
    spark.sql("SELECT 'ab' AS c, 'abc' AS v UNION ALL SELECT NULL, 'x  '").write.saveAsTable(f"{database}.source")
    spark.sql(f"CREATE TABLE {database}.t (c CHAR(4), v VARCHAR(5)) USING parquet")
    for mode in ("append", "append", "overwrite"):
        assert copy(spark, config_of(database, save_mode=mode)).verified


def altered(monkeypatch, change):
    """After every write something changes the sink's rows."""
    real = transfer_module.insert_observed

    def write(spark, rows, to, *rest):
        written = real(spark, rows, to, *rest)
        held = spark.table(to)
        changed = spark.createDataFrame(change(held).collect(), held.schema)
        changed.write.insertInto(to, overwrite=True)
        return written

    monkeypatch.setattr(transfer_module, "insert_observed", write)


ALTERED = {
    "one value": lambda t: t.withColumn("v", F.when(F.col("id") == 41, "x").otherwise(F.col("v"))),
    "a null moved": lambda t: t.withColumn("s", F.when(F.col("id") == 4, F.struct(F.lit(4).cast("long").alias("a"), F.col("s.b"))).otherwise(F.col("s"))),
    "inside an array": lambda t: t.withColumn("s", F.struct("s.a", F.reverse("s.b").alias("b"))),
    "a map value": lambda t: t.withColumn("m", F.when(F.col("id") == 9, F.create_map(F.lit("k"), F.lit(None).cast("long"), F.lit("j"), F.col("id"))).otherwise(F.col("m"))),
    "values of two rows swapped": lambda t: t.withColumn("v", F.when(F.col("id") == 1, "2").when(F.col("id") == 2, "1").otherwise(F.col("v"))),
    "one row lost and one doubled": lambda t: t.where("id <> 3").unionByName(t.where("id = 5")),
    "a microsecond": lambda t: t.withColumn("at", F.when(F.col("id") == 8, F.expr("at + interval 1 microsecond")).otherwise(F.col("at"))),
}


@pytest.mark.parametrize("what", list(ALTERED))
def test_changed_values_are_noticed(spark, source, monkeypatch, what):
    altered(monkeypatch, ALTERED[what])
    assert copy(spark, config_of(source, verify="added")).verified  # counts cannot see it
    got = copy(spark, config_of(source))
    assert (got.status, got.verified) == ("failed", False)
    assert got.error == "verification failed: the values of the 60 new sink rows are not those of the source"


def test_lost_rows_are_told(spark, source, monkeypatch):
    altered(monkeypatch, lambda t: t.where("id < 50"))
    for verify in ("added", "fingerprint"):
        got = copy(spark, config_of(source, verify=verify))
        assert got.error == "verification failed: 60 source rows, 50 new sink rows"


def test_an_append_does_not_open_what_was_there(spark, source):
    copy(spark, config_of(source))
    for path in spark.table(f"{source}.t").inputFiles():
        Path(path.removeprefix("file:").replace("///", "/")).write_bytes(b"not a parquet file")
    for verify in ("added", "fingerprint"):
        got = copy(spark, config_of(source, save_mode="append", verify=verify))
        assert counts(got) == ("copied", True, 60, None, 60)
    with pytest.raises(Exception):
        spark.table(f"{source}.t").count()


@pytest.mark.parametrize("verify", ["added", "fingerprint"])
@pytest.mark.parametrize("other", ["id < 5", "id >= 0"])
def test_appends_of_other_jobs_meanwhile_do_not_matter(spark, source, monkeypatch, verify, other):
    copy(spark, config_of(source))
    real = transfer_module.insert_observed

    def write(spark, rows, to, *rest):
        foreign = spark.table(f"{source}.source").where(other).withColumn("v", F.lit("other"))
        insert(spark, foreign, to)
        written = real(spark, rows, to, *rest)
        insert(spark, foreign, to)
        return written

    monkeypatch.setattr(transfer_module, "insert_observed", write)
    got = copy(spark, config_of(source, save_mode="append", filter="id < 30", verify=verify))
    assert counts(got) == ("copied", True, 30, None, 30)


def test_a_sink_that_is_not_made_of_files_is_measured_twice(spark, source, monkeypatch):
    copy(spark, config_of(source))
    monkeypatch.setattr(newfiles, "can_be_told", lambda *a: False)
    got = copy(spark, config_of(source, save_mode="append", filter="id < 20"))
    assert counts(got) == ("copied", True, 20, 60, 80)


def test_the_source_is_scanned_once(spark, database, tmp_path):
    ledger = tmp_path / "ledger"
    options = {"ledger.log": str(ledger), "ledger.rows": "50"}
    config = TransferConfig([TableSpec("db.a", "a")], FORMAT, database, KEY, options, verify="fingerprint")
    run(spark, config)
    scans = reads(ledger, "db.a")
    assert run(spark, config).outcomes[0].verified
    # the probe of the first rows reads one split, then each of the four is read once
    assert reads(ledger, "db.a") - scans == 5


def test_retried_tasks_are_measured_once(spark, database, tmp_path):
    options = {"ledger.log": str(tmp_path / "ledger"), "ledger.fail_first": "2"}
    config = TransferConfig([TableSpec("db.a", "a")], FORMAT, database, KEY, options, verify="fingerprint", save_mode="append")
    got = run(spark, config).outcomes[0]
    assert (got.verified, got.source_rows) == (True, 400)


def test_no_facts_is_no_verification(spark, source, monkeypatch):
    real = transfer_module.insert_observed
    monkeypatch.setattr(transfer_module, "insert_observed", lambda *a: real(*a) and None)
    assert copy(spark, config_of(source)).verified  # the source is measured instead
    got = copy(spark, config_of(source, filter="rand() >= 0"))
    assert (got.status, got.error) == ("failed", "verification failed: the write gave no facts about its rows")


def test_facts_do_not_depend_on_the_order_and_add_up(spark, source):
    rows = spark.table(f"{source}.source")
    whole, *parts = (
        r.agg(*facts(rows.schema)).first().asDict()
        for r in (rows, rows.where("id < 13").repartition(5), rows.where("id >= 13").orderBy(F.desc("id")))
    )
    assert whole == {k: parts[0][k] + parts[1][k] for k in whole}
    assert whole["hash_low"] < 60 << 21 and whole["hash_high"] < 60 << 21 and whole["hash_middle"] < 60 << 22


def test_nulls_in_other_columns_hash_differently(spark):
    draw = random.Random(3)
    rows = list({tuple(draw.choice([None, 1, 2]) for _ in range(4)) for _ in range(300)})
    table = spark.createDataFrame(rows, "a int, b int, `c.d` int, e int")
    assert table.select(row_hash(table.schema).alias("h")).distinct().count() == len(rows)
