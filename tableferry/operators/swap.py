"""Overwriting a sink as a whole: the new rows are written beside it and then take its place.

A swap has these steps:

1. a table ``<sink>__incoming_<mark>`` of the sink's definition is made; for sinks at a location of
   their own it has a folder ``<location>__incoming_<mark>`` beside theirs,
2. the rows are written to it and it is marked as written,
3. the old rows step aside: the sink is renamed ``<sink>__retired_<mark>``, or its folder
   ``<location>__retired_<mark>``,
4. the incoming table, or its folder, takes the name: from here on readers see the new rows,
   whether they go by the catalog or by the folder,
5. what stepped aside is deleted, last of all the table that holds the journal.

The table properties are the journal: ``mark``, ``phase`` (``writing``, ``written``) and a ``lease``, a time
that the writing job keeps putting off. If the job dies, whatever the step, the names that are there and
the journal tell the next run what to do (:func:`recover`): before step 3 the incoming rows go, between 3 and
4 they take the sink's name, after 4 the old rows go. A swap whose lease has not run
out belongs to a job that lives and is left alone.

Folders are only swapped where a rename is one step, which it is not in object stores.
"""

from __future__ import annotations

import logging
import re
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, suppress
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tableferry.functions.names import identifier_parts, qualified, quote
from tableferry.operators.newfiles import FILES
from tableferry.operators.sink import align_by_name, described, insert
from tableferry.operators.storage import delete_folder, folder_exists, move_folder, renames_at_once

log = logging.getLogger(__name__)

Written = TypeVar("Written")

#: A job that has not put off its lease for so long counts as dead (clocks may differ by less than that)
LEASE_SECONDS = 120

# The journal's table properties, and the marks in names
PREFIX = "tableferry.swap."
MARK, PHASE, LEASE = PREFIX + "mark", PREFIX + "phase", PREFIX + "lease"
WRITING, WRITTEN = "writing", "written"
_LEFT_OVER = re.compile(r"(.+)__(incoming|retired)_([0-9a-f]{32})")

# properties that the catalog writes itself
_CATALOG_PROPERTIES = ("spark.sql.", "option.", "transient", "comment", "owner")

# swaps of this process: True while they run; one that has ended needs no lease to be over
_own_marks: dict[str, bool] = {}


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _call(spark: SparkSession, statement: str) -> None:
    """One step of a swap."""
    spark.sql(statement)


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _listed(properties: dict[str, str]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())


def _lease() -> str:
    return str(int(time.time()) + LEASE_SECONDS)


def can_be_swapped(spark: SparkSession, sink: str) -> bool:
    """Whether another table can take the sink's place.

    That takes a table of the session catalog, managed or of files at a location of its own. Other
    catalogs commit an overwrite as a whole themselves, or not at all.
    """
    known = described(spark, sink)
    if known.get("Catalog", "spark_catalog") != "spark_catalog":
        return False
    if known.get("Type") == "MANAGED":
        return True
    return (
        known.get("Type") == "EXTERNAL"
        and known.get("Provider", "").lower() in FILES
        and renames_at_once(spark, known["Location"])
    )


class _Swap:
    """A swap of tables of the catalog, which move their folders along."""

    def __init__(self, spark: SparkSession, sink: str, mark: str):
        self.spark, self.sink, self.mark = spark, sink, mark
        *place, name = identifier_parts(sink)
        self.incoming = qualified(*place, f"{name}__incoming_{mark}")
        self.retired = qualified(*place, f"{name}__retired_{mark}")

    def begin(self) -> None:
        known = described(self.spark, self.sink)
        properties = {MARK: self.mark, PHASE: WRITING, LEASE: _lease()}
        _call(
            self.spark,
            f"CREATE TABLE {self.incoming} LIKE {self.sink}{self._place()} TBLPROPERTIES ({_listed(properties)})",
        )
        # the comment and properties of the table, which CREATE TABLE LIKE leaves out
        if comment := known.get("Comment"):
            _call(self.spark, f"COMMENT ON TABLE {self.incoming} IS {_text(comment)}")
        own = _properties(self.spark, self.sink).items()
        if kept := {k: v for k, v in own if not k.startswith((*_CATALOG_PROPERTIES, PREFIX))}:
            self.note(kept)

    def _place(self) -> str:
        return ""

    def note(self, properties: dict[str, str]) -> None:
        _call(self.spark, f"ALTER TABLE {self.incoming} SET TBLPROPERTIES ({_listed(properties)})")

    @contextmanager
    def kept_alive(self) -> Iterator[None]:
        """The lease is put off every quarter of its time while this lasts."""
        done = threading.Event()

        def renew() -> None:
            while not done.wait(LEASE_SECONDS / 4):
                with suppress(Exception):  # the next one may succeed; a lost table fails the write itself
                    self.note({LEASE: _lease()})

        thread = threading.Thread(target=inheritable_thread_target(self.spark)(renew), daemon=True)
        thread.start()
        try:
            yield
        finally:
            done.set()
            thread.join()

    def commit(self) -> None:
        self.note({PHASE: WRITTEN, LEASE: _lease()})
        self.step_aside()
        try:
            self.forward()
        except Exception:
            self.step_back()
            raise

    def there(self) -> bool:
        """Whether the sink's name is taken, by the old rows or the new ones."""
        return self.spark.catalog.tableExists(self.sink)

    def aside(self) -> bool:
        """Whether the old rows have stepped aside."""
        return self.spark.catalog.tableExists(self.retired)

    def step_aside(self) -> None:
        _call(self.spark, f"ALTER TABLE {self.sink} RENAME TO {self.retired}")

    def step_back(self) -> None:
        _call(self.spark, f"ALTER TABLE {self.retired} RENAME TO {self.sink}")

    def forward(self) -> None:
        _call(self.spark, f"ALTER TABLE {self.incoming} RENAME TO {self.sink}")

    def undo(self) -> None:
        _call(self.spark, f"DROP TABLE IF EXISTS {self.incoming}")

    def finish(self) -> None:
        self.spark.catalog.refreshTable(self.sink)
        _call(self.spark, f"DROP TABLE IF EXISTS {self.retired}")
        keys = ", ".join(map(_text, (MARK, PHASE, LEASE)))
        _call(self.spark, f"ALTER TABLE {self.sink} UNSET TBLPROPERTIES IF EXISTS ({keys})")


class _FolderSwap(_Swap):
    """A swap of the folders of tables at locations of their own; the sink's table stays."""

    def __init__(self, spark: SparkSession, sink: str, mark: str, home: str):
        super().__init__(spark, sink, mark)
        self.home = home.rstrip("/")
        self.new, self.old = f"{self.home}__incoming_{mark}", f"{self.home}__retired_{mark}"

    def _place(self) -> str:
        return f" LOCATION {_text(self.new)}"

    def there(self) -> bool:
        return folder_exists(self.spark, self.home)

    def aside(self) -> bool:
        return folder_exists(self.spark, self.old)

    def step_aside(self) -> None:
        _move(self.spark, self.home, self.old)

    def step_back(self) -> None:
        _move(self.spark, self.old, self.home)

    def forward(self) -> None:
        _move(self.spark, self.new, self.home)

    def undo(self) -> None:
        _delete(self.spark, self.new)
        super().undo()

    def finish(self) -> None:
        if any(c.isPartition for c in self.spark.catalog.listColumns(self.sink)):
            _call(self.spark, f"MSCK REPAIR TABLE {self.sink} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(self.sink)
        _delete(self.spark, self.old)
        super().undo()


def _move(spark: SparkSession, path: str, to: str) -> None:
    """One step of a swap."""
    move_folder(spark, path, to)


def _delete(spark: SparkSession, path: str) -> None:
    """One step of a swap."""
    delete_folder(spark, path)


def _swap_of(spark: SparkSession, sink: str, mark: str) -> _Swap:
    known = described(spark, sink)
    if known.get("Type") == "EXTERNAL":
        return _FolderSwap(spark, sink, mark, known["Location"])
    return _Swap(spark, sink, mark)


def replace(
    spark: SparkSession,
    rows: DataFrame,
    sink: str,
    rebalance: bool = False,
    write: Callable[..., Written] = insert,
) -> Written:
    """Overwrite a sink that holds rows; they are there until the new ones are written.

    If anything fails the sink is as it was. Sinks that cannot be swapped are overwritten in
    place. ``write`` puts the rows into a table; its result is returned.
    """
    if not can_be_swapped(spark, sink):
        return write(spark, rows, sink, True, rebalance)
    align_by_name(rows, spark.table(sink))  # before a table is made
    swap = _swap_of(spark, sink, uuid.uuid4().hex)
    _own_marks[swap.mark] = True
    try:
        try:
            swap.begin()
            with swap.kept_alive():
                written = write(spark, rows, swap.incoming, False, rebalance)
            swap.commit()
        except Exception:
            with suppress(Exception):
                swap.undo()
            raise
        try:
            swap.finish()
        except Exception as error:  # the sink has the new rows; the next run clears up
            log.warning("what a swap of %s leaves: %s", sink, error)
    finally:
        _own_marks[swap.mark] = False
    return written


def recover(spark: SparkSession, sink_schema: str, names: Iterable[str]) -> list[str]:
    """Finish or undo swaps of these sinks that died; returns what was done.

    One listing of the schema's tables; nothing else is asked unless something is left over.
    """
    place = identifier_parts(sink_schema)
    wanted = {name.lower(): name for name in names}
    shown = spark.sql(f"SHOW TABLES IN {qualified(*place)}").collect()
    there = {r["tableName"].lower() for r in shown if not r["isTemporary"]}
    done = []
    for table in sorted(there):
        found = _LEFT_OVER.fullmatch(table)
        if not found or found[1] not in wanted or _own_marks.get(found[3]):
            continue
        name, kind, mark = found.groups()
        if kind == "retired" and f"{name}__incoming_{mark}" in there:
            continue  # settled with the incoming table
        sink = qualified(*place, wanted[name])
        try:
            if act := _settle(spark, sink, mark, kind):
                done.append(f"{quote(wanted[name])}: {act}")
                log.warning("swap %s of %s, left by a job that died: %s", mark, sink, act)
        except Exception as error:  # another run may be at it as well
            log.warning("swap %s of %s could not be settled: %s", mark, sink, error)
    return done


def _settle(spark: SparkSession, sink: str, mark: str, kind: str) -> str | None:
    exists = spark.catalog.tableExists
    swap = _swap_of(spark, sink, mark) if exists(sink) else _Swap(spark, sink, mark)
    if kind == "retired":  # of a table whose place is taken
        if not exists(sink):
            swap.step_back()
            return "old rows put back"
        if _properties(spark, sink).get(MARK) != mark:
            return None  # not of ours
        swap.finish()
        return "old rows dropped"
    journal = _properties(spark, swap.incoming)
    if journal.get(MARK) != mark:
        return None
    if swap.there() and _lives(journal):
        return None
    while _lives(journal) and not swap.there():  # a job may be between its two renames
        time.sleep(0.2)
        if not exists(swap.incoming):
            return None
        journal = _properties(spark, swap.incoming)
    if _lives(journal):
        return None
    if journal.get(PHASE) == WRITTEN and swap.aside():
        if not swap.there():
            swap.forward()
        swap.finish()
        return "new rows put in place"
    swap.undo()
    return "incoming rows dropped"


def _lives(journal: dict[str, str]) -> bool:
    return _own_marks.get(journal[MARK], True) and int(journal.get(LEASE, "0")) > time.time()
