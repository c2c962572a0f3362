"""Runs over several tables: order, isolation, labels, totals, the command line."""

import threading
import time

import pytest

from tableferry import (
    RunReport,
    TableOutcome,
    TableSpec,
    TransferConfig,
    TransferFailed,
    run,
    run_totals,
)
from tableferry.__main__ import main
from tableferry.plans import run as run_module
from tableferry.plans import transfer as transfer_module
from tableferry.plans.labels import labelled
from tableferry.plans.report import REPORT_SCHEMA

from .oracle import SF_DIR

LABELS = [
    "spark.jobGroup.id",
    "spark.job.description",
    "spark.scheduler.pool",
]


def files(*names):
    return [TableSpec(f"{SF_DIR}/{n}.parquet", n) for n in names]


@pytest.fixture
def config(database):
    def make(*names, **settings):
        return TransferConfig(files(*names), "parquet", database, **settings)

    return make


@pytest.mark.parametrize("concurrent", [False, True])
def test_failures_are_isolated_and_order_is_kept(spark, config, concurrent):
    names = ["region", "missing", "nation", "supplier"]
    report = run(
        spark, config(*names, concurrent=concurrent, verify="observed"), fail_on_error=False
    )
    assert [o.sink for o in report.outcomes] == names
    assert [o.run_order for o in report.outcomes] == [1, 2, 3, 4]
    assert [o.status for o in report.outcomes] == ["copied", "failed", "copied", "copied"]
    assert "PATH_NOT_FOUND" in report.outcome("missing").error
    assert report.outcome("missing").error.startswith("AnalysisException: ")
    assert [o.sink for o in report.failed] == ["missing"]
    totals = report.totals(spark).first()
    assert tuple(totals) == (4, 3, 1, 75.0)


def test_run_raises_after_the_last_table(spark, config, database):
    with pytest.raises(TransferFailed, match="1 of 2 tables failed") as caught:
        run(spark, config("missing", "nation"))
    assert caught.value.report.outcome("nation").status == "copied"
    assert spark.table(f"{database}.nation").count() == 25


def test_every_table_bad(spark, config):
    report = run(spark, config("x", "y", concurrent=True), fail_on_error=False)
    assert tuple(report.totals(spark).first()) == (2, 0, 2, 0.0)


def test_filter_that_fits_one_table_only(spark, config):
    report = run(spark, config("region", "nation", filter="n_regionkey = 1"), fail_on_error=False)
    assert [o.status for o in report.outcomes] == ["failed", "copied"]
    assert "UNRESOLVED_COLUMN" in report.outcomes[0].error


def test_predicate_that_does_not_fit_the_type(spark, config):
    report = run(spark, config("nation", filter="n_name > 0"), fail_on_error=False)
    assert report.outcomes[0].status == "failed"
    assert "CAST_INVALID_INPUT" in report.outcomes[0].error


def test_skips_are_successes(spark, config):
    run(spark, config("nation"))
    report = run(spark, config("nation", "region", save_mode="ignore"))
    assert [o.status for o in report.outcomes] == ["skipped_exists", "copied"]
    assert tuple(report.totals(spark).first()) == (2, 2, 0, 100.0)


def test_report_rows(spark, config):
    report = run(spark, config("nation", verify="observed"))
    rows = report.to_df(spark)
    copied = (1, f"{SF_DIR}/nation.parquet", "nation", "overwrite", "copied", 25, 0, 25, True, None)
    assert tuple(rows.first()) == copied
    assert rows.schema == spark.createDataFrame([], REPORT_SCHEMA).schema


def test_totals_round_and_handle_nothing(spark):
    def outcomes(good, bad):
        statuses = ["copied"] * good + ["failed"] * bad
        return RunReport([TableOutcome(i, "t", "t", "append", s) for i, s in enumerate(statuses)])

    assert tuple(outcomes(2, 1).totals(spark).first()) == (3, 2, 1, 66.7)
    assert tuple(run_totals(spark.createDataFrame([], REPORT_SCHEMA)).first()) == (0, 0, 0, None)


def test_errors_are_short(spark, database):
    report = run(spark, TransferConfig(["t"], "no.such.format", database), fail_on_error=False)
    error = report.outcomes[0].error
    assert "DATA_SOURCE_NOT_FOUND" in error and "no.such.format" in error
    assert "\tat " not in error and len(error) < 2000


def test_secrets_in_errors_are_masked(spark, config, monkeypatch):
    def broken(*_):
        raise RuntimeError("cannot reach jdbc:x://u:hunter2@h/db?password=hunter2")

    monkeypatch.setattr(run_module, "transfer_table", broken)
    report = run(spark, config("nation"), fail_on_error=False)
    assert "hunter2" not in report.outcomes[0].error
    assert "cannot reach" in report.outcomes[0].error


@pytest.mark.parametrize("concurrent", [False, True])
def test_an_interrupt_ends_the_run(spark, config, monkeypatch, concurrent):
    begun = []

    def interrupted(spark, config, spec, order):
        begun.append(order)
        time.sleep(0.2)
        raise KeyboardInterrupt

    monkeypatch.setattr(run_module, "transfer_table", interrupted)
    with pytest.raises(KeyboardInterrupt):
        run(spark, config(*"abcdefgh", concurrent=concurrent, max_concurrent=1))
    assert len(begun) < 4


def test_concurrency_is_bounded(spark, config, monkeypatch):
    running, most = [0], [0]
    lock, met = threading.Lock(), threading.Event()

    def counted(spark, config, spec, order):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
            if running[0] == 2:
                met.set()
        met.wait(10)
        with lock:
            running[0] -= 1
        return TableOutcome(order, spec.source, spec.sink_name, "append", "copied")

    monkeypatch.setattr(run_module, "transfer_table", counted)
    report = run(spark, config("a", "b", "c", "d", "e", concurrent=True, max_concurrent=2))
    assert most[0] == 2
    assert [o.sink for o in report.outcomes] == list("abcde")


@pytest.mark.parametrize("fails", [False, True])
def test_labels_are_set_and_given_back(spark, config, monkeypatch, fails):
    sc = spark.sparkContext
    seen = []
    real = transfer_module.insert

    def watching(*arguments):
        seen.append([sc.getLocalProperty(k) for k in LABELS])
        if fails:
            raise RuntimeError("write failed")
        return real(*arguments)

    monkeypatch.setattr(transfer_module, "insert", watching)
    sc.setJobGroup("mine", "my work")
    before = [sc.getLocalProperty(k) for k in LABELS]
    try:
        run(spark, config("region", "nation"), fail_on_error=False)
        assert [sc.getLocalProperty(k) for k in LABELS] == before
    finally:
        for key in LABELS:
            sc.setLocalProperty(key, None)
    groups = [s[0] for s in seen]
    assert groups == ["tableferry-1", "tableferry-2"]
    for (group, description, pool), name in zip(seen, ["region", "nation"]):
        assert pool == group
        assert description.endswith(f"{name}.parquet: writing")


def test_concurrent_tables_have_their_own_labels(spark, config, monkeypatch):
    sc = spark.sparkContext
    seen = {}
    real = transfer_module.insert

    def watching(spark, rows, sink, *rest):
        seen[sink.split("`")[-2]] = sc.getLocalProperty("spark.jobGroup.id")
        return real(spark, rows, sink, *rest)

    monkeypatch.setattr(transfer_module, "insert", watching)
    run(spark, config("region", "nation", "supplier", concurrent=True, max_concurrent=2))
    orders = {name: group.split("-")[1] for name, group in seen.items()}
    assert orders == {"region": "1", "nation": "2", "supplier": "3"}
    assert sc.getLocalProperty("spark.jobGroup.id") is None


def test_labels_name_table_and_step(spark):
    sc = spark.sparkContext
    with labelled(sc, "db.t", 2, 5) as step:
        step("writing")
        assert sc.getLocalProperty("spark.jobGroup.id") == "tableferry-2"
        assert sc.getLocalProperty("spark.job.description") == "table 2 of 5, db.t: writing"


@pytest.fixture
def settings(spark, database):
    given = {
        "spark.source.format": "parquet",
        "spark.source.table.key": "path",
        "spark.source.table.values": f"{SF_DIR}/nation.parquet, {SF_DIR}/region.parquet",
        "spark.source.logical." + f"{SF_DIR}/nation.parquet" + ".n_name": "bitmap",
        "spark.sink.schema": database,
        "spark.sink.enable.results.verify": "true",
        "spark.sink.enable.concurrent.copy": "true",
    }
    touched = set(given) | {"spark.filter.query", "spark.sink.save.mode"}

    def use(**more):
        for key, value in {**given, **more}.items():
            spark.conf.set(key, value)

    yield use
    for key in touched:
        spark.conf.unset(key)


def test_command_line(spark, database, settings):
    settings()
    assert main([]) == 0
    assert spark.table(f"{database}.region").count() == 5
    assert spark.table(f"{database}.nation").schema["n_name"].dataType.simpleString() == "binary"
    assert spark.table("source_nation").count() == 25
    assert spark.range(1).count() == 1  # the caller's session goes on


def test_command_line_reports_failure(spark, settings):
    settings(**{"spark.filter.query": "n_regionkey = 1"})
    assert main([]) == 1


def test_command_line_with_bad_settings(spark, settings):
    settings(**{"spark.sink.save.mode": "apend"})
    assert main([]) == 1
