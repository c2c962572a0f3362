"""Line deduplication by site-relative frequency.

Pages are grouped by host. For each line the share of the host's pages that
contain it is its frequency; a line above a boilerplate ratio is dropped from
all pages of that host.

The ratio depends on the line's length. Short lines recur by chance, so it takes
a share of the host's pages to call them boilerplate. A line of more than
``long_words`` words (a passage) does not, so it also goes if ``long_pages``
different pages of the host hold it, whatever the host's size. Pages of equal text
count once for that: copies of one document do not erase it.

Lines travel as 64-bit hashes, one row for each page and distinct line, and are
counted with partial aggregation: a host with a third of all pages costs rows,
not a task. Lines above the ratio are few by definition (a host has at most ``lines
per page / ratio``) and go back to the pages as one array per host: broadcast
if their number is checked to be small, else by a join in which Spark splits
large hosts. Passages may be many, so they go back as one array per page that holds
some, by the hash of host and text. Built-in functions only.

Defined cases: a null host is a host of its own; a null text stays null and has
no lines; lines without a word are kept and never counted. Every row is a page,
repeated ones too. A line on exactly the ratio of the pages stays, one on exactly ``min_pages`` or
``long_pages`` may go; equal counts are treated alike. Pages of any length are cut whole, one by one. An
empty table gives no row. Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.functions.names import quote

from .shared import Scratch

RATIO = 0.05
#: A line on fewer pages of a host is never boilerplate
MIN_PAGES = 5
#: A line of more words than this is a passage, which goes if so many different pages of a host hold it
LONG_WORDS = 50
LONG_PAGES = 3
#: Boilerplate lines (8 bytes each) up to which the table is broadcast
BROADCAST_LINES = 200_000


def _worded(line: Column) -> Column:
    return line.rlike(r"[^ \t-\r]")


def _long(line: Column, words: int) -> Column:
    """More than so many words; the length, which is cheap, is looked at first."""
    more = rf"^[ \t-\r]*+(?:[^ \t-\r]++[ \t-\r]++){{{words}}}[^ \t-\r]"
    return (F.length(line) > 2 * words) & line.rlike(more)


def _host(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("h"), F.col(quote(name)).cast("string")), F.lit("null"))


def boilerplate(
    documents: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``(host, line, pages, host_pages)``: hashes of the lines above the ratio."""
    pages = documents.select(_host(host).alias("host"), F.col("text").cast("string").alias("text"))
    once = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), _worded), lambda x: F.xxhash64(x)))
    counted = (
        pages.select("host", F.explode(once).alias("line"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    return counted.join(totals, "host").where(F.col("pages") > ratio * F.col("host_pages"))


def passages(
    documents: DataFrame,
    scratch: Scratch,
    host: str = "source",
    long_words: int = LONG_WORDS,
    long_pages: int = LONG_PAGES,
) -> DataFrame:
    """``(page, passages)``: hashes of the repeated passages of each page that holds some."""
    text = F.col("text").cast("string")
    held = F.array_distinct(
        F.transform(F.filter(F.split(text, "\n"), lambda x: _long(x, long_words)), lambda x: F.xxhash64(x))
    )
    held = documents.select(
        _host(host).alias("host"), F.xxhash64(_host(host), text).alias("page"), F.explode(held).alias("line")
    )
    held = scratch.keep(held.distinct(), "passages")
    often = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= long_pages)
    return (
        held.join(often, ["host", "line"], "left_semi")
        .groupBy("page")
        .agg(F.collect_list("line").alias("passages"))
    )


def cleaned(
    documents: DataFrame,
    host: str = "source",
    long_words: int | None = LONG_WORDS,
    long_pages: int = LONG_PAGES,
    **options,
) -> DataFrame:
    """Per row: the row as ``doc``, ``n_lines`` with a word, ``n_dropped`` of them, the new ``text``.

    Without ``long_words`` the ratio is the same for lines of any length.
    """
    scratch = Scratch(documents.sparkSession, "lines")
    found = boilerplate(documents, host, **options)
    found = scratch.keep(
        found.groupBy("host").agg(F.collect_list("line").alias("drop")), "boilerplate"
    )
    pages = documents.select(
        F.struct(*[F.col(quote(c)) for c in documents.columns]).alias("doc"),
        _host(host).alias("host"),
        F.xxhash64(_host(host), F.col("text").cast("string")).alias("page"),
        F.split(F.col("text").cast("string"), "\n").alias("lines"),
    )
    pages = pages.join(_small(found, "drop"), "host", "left")
    if long_words is None:
        pages = pages.withColumn("passages", F.lit(None).cast("array<bigint>"))
    else:
        repeated = scratch.keep(passages(documents, scratch, host, long_words, long_pages), "repeated")
        pages = pages.join(_small(repeated, "passages"), "page", "left")

    def stays(line: Column) -> Column:
        own = F.xxhash64(line)
        gone = [F.coalesce(F.array_contains(c, own), F.lit(False)) for c in ("drop", "passages")]
        return ~_worded(line) | ~(gone[0] | gone[1])

    untouched = F.col("drop").isNull() & F.col("passages").isNull()
    rest = F.when(untouched, F.col("lines")).otherwise(F.filter("lines", stays))
    return pages.select("doc", "lines", rest.alias("rest")).select(
        "doc",
        F.coalesce(F.size(F.filter("lines", _worded)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("rest"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join("rest", "\n").alias("text"),
    )


def _small(found: DataFrame, lines: str) -> DataFrame:
    """Broadcast if the hashes are checked to be few."""
    size = found.agg(F.sum(F.size(lines))).first()[0] or 0
    return F.broadcast(found) if size <= BROADCAST_LINES else found


def drop_boilerplate(documents: DataFrame, **options) -> DataFrame:
    """All rows and columns; ``text`` without the boilerplate lines of its host."""
    return cleaned(documents, **options).select(
        *[
            F.col("text") if c == "text" else F.col(f"doc.{quote(c)}").alias(c)
            for c in documents.columns
        ]
    )
