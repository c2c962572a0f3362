"""Loads that are repeated, and the order in which tables begin."""

import pytest
from pyspark.sql import functions as F

from tableferry import ConfigError, TableSpec, TransferConfig, run
from tableferry.operators.sink import insert
from tableferry.plans import run as run_module
from tableferry.plans import transfer as transfer_module
from tableferry.plans.ledger import ledger_rows

from .oracle import SF_DIR


def load(database, *names, **settings):
    settings.setdefault("load_id", "day 1")
    settings.setdefault("save_mode", "append")
    return TransferConfig([TableSpec(f"{SF_DIR}/{n}.parquet", n) for n in names], "parquet", database, **settings)


def rows(spark, database, name):
    return spark.table(f"{database}.{name}").count()


@pytest.mark.parametrize("verify", ["off", "observed", "added", "fingerprint"])
def test_a_repeated_append_is_there_once(spark, database, verify):
    spark.read.parquet(f"{SF_DIR}/nation.parquet").write.saveAsTable(f"{database}.nation")
    config = load(database, "nation", verify=verify)
    first, second = (run(spark, config).outcomes[0] for _ in range(2))
    assert first == second and first.source_rows == 25
    assert rows(spark, database, "nation") == 50
    run(spark, load(database, "nation", load_id="day 2", verify=verify))
    assert rows(spark, database, "nation") == 75
    states = ledger_rows(spark, config).groupBy("load_id", "state").count().collect()
    assert sorted(map(tuple, states)) == [("day 1", "begun", 1), ("day 1", "copied", 1), ("day 2", "begun", 1), ("day 2", "copied", 1)]


@pytest.mark.parametrize("verify", ["observed", "added", "fingerprint"])
@pytest.mark.parametrize("partitioned", [False, True])
def test_an_append_that_failed_its_verification_goes_before_the_next(spark, database, monkeypatch, verify, partitioned):
    nation = spark.read.parquet(f"{SF_DIR}/nation.parquet")
    by = ["n_regionkey"] if partitioned else []
    nation.write.partitionBy(*by).saveAsTable(f"{database}.nation")
    real = transfer_module.insert_observed

    def loses(spark, rows, *rest, **more):
        return real(spark, rows.where("n_nationkey < 20"), *rest, **more) | {"rows": 25}

    config = load(database, "nation", verify=verify)
    with monkeypatch.context() as m:
        m.setattr(transfer_module, "insert_observed", loses)
        assert run(spark, config, fail_on_error=False).outcomes[0].error == "verification failed: 25 source rows, 20 new sink rows"
    assert rows(spark, database, "nation") == 45
    insert(spark, nation.where("n_nationkey = 3"), f"{database}.nation")  # another job's row stays
    assert run(spark, config).outcomes[0].verified
    assert rows(spark, database, "nation") == 51
    run(spark, config)
    assert rows(spark, database, "nation") == 51


class Killed(BaseException):
    pass


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_job_that_died_while_it_appended(spark, database, monkeypatch, when):
    real = transfer_module.insert_observed

    def dies(*a, **k):
        if when == "after":
            real(*a, **k)
        raise Killed

    config = load(database, "region", "nation", verify="added")
    with monkeypatch.context() as m, pytest.raises(Killed):
        m.setattr(transfer_module, "insert_observed", dies)
        run(spark, config)
    assert [o.status for o in run(spark, config).outcomes] == ["copied", "copied"]
    assert rows(spark, database, "nation") == 25 and rows(spark, database, "region") == 5


def test_a_resumed_run_copies_only_what_failed(spark, database, monkeypatch):
    copied = []
    real = run_module.transfer_table

    def noted(spark, config, spec, *rest):
        copied.append(spec.sink_name)
        if spec.sink_name == "nation" and len(copied) < 4:
            raise RuntimeError("source is away")
        return real(spark, config, spec, *rest)

    monkeypatch.setattr(run_module, "transfer_table", noted)
    config = load(database, "region", "nation", "supplier", save_mode="overwrite")
    first = run(spark, config, fail_on_error=False)
    assert [o.status for o in first.outcomes] == ["copied", "failed", "copied"]
    second = run(spark, config)
    assert copied == ["region", "nation", "supplier", "nation"]
    assert [o.status for o in second.outcomes] == ["copied"] * 3
    assert [o.source_rows for o in second.outcomes][:2] == [5, 25]


def test_an_id_is_for_one_load(spark, database):
    run(spark, load(database, "nation"))
    with pytest.raises(ConfigError, match="another source, sink, mode or filter"):
        run(spark, load(database, "nation", filter="n_nationkey < 3"))
    with pytest.raises(ConfigError, match="load_id is empty"):
        load(database, "nation", load_id=" ")
    with pytest.raises(ConfigError, match="ledger"):
        TransferConfig([TableSpec("x", "tableferry_loads")], "parquet", database, load_id="1")


def test_large_tables_begin_first(spark, database, monkeypatch):
    begun = []
    real = run_module.transfer_table

    def noted(spark, config, spec, *rest):
        begun.append(spec.sink_name)
        return real(spark, config, spec, *rest)

    monkeypatch.setattr(run_module, "transfer_table", noted)
    names = ["region", "nation", "missing", "lineitem", "orders"]
    config = load(database, *names, load_id=None, concurrent=True, max_concurrent=1)
    report = run(spark, config, fail_on_error=False)
    assert begun[:2] == ["lineitem", "orders"] and begun[-1] == "missing"
    assert [o.sink for o in report.outcomes] == names
    assert [o.status for o in report.outcomes] == ["copied", "copied", "failed", "copied", "copied"]


def test_makespan_with_the_largest_last():
    sizes = {i: s for i, s in enumerate([1] * 12 + [6, 6], 1)}

    def makespan(order, workers=3):
        free = [0] * workers
        for one in order:
            free[free.index(min(free))] += sizes[one]
        return max(free)

    listed = [(i, TableSpec(f"t{i}")) for i in sizes]
    ordered = [i for i, _ in run_module.longest_first(listed, sizes)]
    assert ordered[:2] == [13, 14] and ordered[2:] == list(range(1, 13))
    assert (makespan(sizes), makespan(ordered)) == (10, 8)


def test_facts_of_marked_files_are_observed(spark, database):
    """The write under a mark goes through SQL; the observation must come from there too."""
    sink = f"{database}.t"
    spark.range(0).write.saveAsTable(sink)
    from tableferry.operators.sink import insert_observed

    assert insert_observed(spark, spark.range(7), sink, mark="abc") == {"rows": 7}
    assert spark.table(sink).where(F.col("_metadata.file_name").startswith("part-abc-")).count() == 7
