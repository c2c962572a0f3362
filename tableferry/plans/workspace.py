"""Databases and views that only live as long as a query's result is needed."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

from tableferry.functions.names import quote

CHECKPOINT_DIR = "spark.checkpoint.dir"
_created: list[str] = []
_views: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors reach, as the session names it.

    Where it is unset, a local session gets a temporary folder; a cluster
    session must name one, since no machine's own disk would do.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster is a cluster
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tableferry-")


def new_database(spark: SparkSession) -> str:
    """A database of its own for one call, so repeated or concurrent calls never collide."""
    name = f"ferry_{uuid.uuid4().hex}"
    location = f"{shared_folder(spark)}/{name}".replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {quote(name)} LOCATION '{location}'")
    _created.append(name)
    return name


def for_one_call(view: str) -> str:
    """Note a temporary view that is to go with the databases."""
    _views.append(view)
    return view


def release(spark: SparkSession) -> None:
    """Drop the databases made so far, with their tables, and noted views: results must have been read."""
    while _views:
        spark.catalog.dropTempView(_views.pop())
    while _created:
        spark.sql(f"DROP DATABASE IF EXISTS {quote(_created.pop())} CASCADE")
