from types import SimpleNamespace

import pytest

from tableferry.plans.workspace import for_one_call, new_database, release, shared_folder


def session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_session_names_the_folder(spark):
    assert shared_folder(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_must_name_one():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_a_local_session_gets_one():
    folder = shared_folder(session("local[2]"))
    assert folder and shared_folder(session("local[2]")) == folder


def test_databases_do_not_collide_and_are_dropped(spark):
    first, second = new_database(spark), new_database(spark)
    assert first != second
    spark.range(3).write.saveAsTable(f"{first}.t")
    spark.range(4).write.saveAsTable(f"{second}.t")
    assert [spark.table(f"{d}.t").count() for d in (first, second)] == [3, 4]
    release(spark)
    assert not spark.catalog.databaseExists(first)
    assert not spark.catalog.databaseExists(second)


def test_noted_views_are_dropped(spark):
    spark.range(2).createOrReplaceTempView(for_one_call("a_view_of_one_call"))
    assert spark.table("a_view_of_one_call").count() == 2
    release(spark)
    assert not spark.catalog.tableExists("a_view_of_one_call")


def test_queries_leave_no_views(spark):
    from tableferry.plans.catalogue import QUERIES

    from .oracle import SF_DIR

    before = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    for name in ("filter_column_view", "transfer_special_column_names"):
        QUERIES[name](spark, SF_DIR).count()
    assert {t.name for t in spark.catalog.listTables() if t.isTemporary} > before
    release(spark)
    assert {t.name for t in spark.catalog.listTables() if t.isTemporary} == before
