"""Benchmark decontamination: documents that contain passages of test items.

A hash set of the items' word windows is broadcast; every window of every
document is looked up, each hit is verified word by word, and documents or just
the hit spans are removed.

The set goes out in blocks of a bounded size: a benchmark larger than
``broadcast_bytes`` is searched block by block, and what was found is kept
beside the documents in the shared folder in between. No limit drops windows.

Defined cases: a null or empty text has no words, no hits and is clean; so is
every document if the benchmark has no words. Repeated rows and repeated ids are
judged row by row; a null item_id counts as no item but its windows hit. Other
columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tableferry.functions.names import quote

from .shared import Scratch, batches, text_column
from .words import ALPHANUMERIC, pieces, window_hashes

WINDOW = 13
#: Contaminated if hit words are at least one in so many
ONE_IN = 20
BROADCAST_BYTES = 64 << 20
_FILTER_BITS = 20

SCAN = (
    "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "spans array<struct<first:long,n:long>>, clean_text string"
)
PARTIAL = "text string, spans array<struct<first:long,n:long>>, items array<string>"


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct ``(k, hash, words, item)``: windows of ``window`` words, or a shorter item whole."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = defaultdict(list)
        items = batch.column(0).to_pylist()
        for at, words in pieces(batch.column(1), ALPHANUMERIC):
            hashes = words.hashes()
            for i, (first, n) in enumerate(zip(words.first, words.counts)):
                k = min(window, int(n))
                if not k:
                    continue
                for j, h in enumerate(window_hashes(hashes[first : first + n], k)):
                    out["k"].append(k)
                    out["hash"].append(int(h.view(np.int64)))
                    out["words"].append(words.text(first + j, k))
                    out["item"].append(items[at + i])
        return pa.record_batch(
            [
                pa.array(out["k"], pa.int32()),
                pa.array(out["hash"], pa.int64()),
                pa.array(out["words"], pa.binary()),
                pa.array(out["item"], pa.string()),
            ],
            ["k", "hash", "words", "item"],
        )

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), text_column(benchmark))
    return batches(rows, convert, "k int, hash long, words binary, item string").distinct()


class WindowSet:
    """Windows by length and hash, with their words for verification and their items."""

    def __init__(self, rows):
        by_length = defaultdict(dict)
        for k, h, words, item in rows:
            items = by_length[k].setdefault(h, {}).setdefault(bytes(words), set())
            if item is not None:
                items.add(item)
        self.lengths = []
        for k, table in sorted(by_length.items()):
            keys = np.fromiter(table, np.int64, len(table)).view(np.uint64)
            near = np.zeros(1 << _FILTER_BITS, bool)
            near[keys >> np.uint64(64 - _FILTER_BITS)] = True
            self.lengths.append((k, near, table))

    def search(self, texts: pa.Array):
        """``(words, per text: spans, items)`` for successive pieces of a column."""
        for _, words in pieces(texts, ALPHANUMERIC):
            spans, items = defaultdict(list), defaultdict(set)
            hashes = words.hashes()
            for k, near, table in self.lengths:
                found = window_hashes(hashes, k)
                for i in np.flatnonzero(near[found >> np.uint64(64 - _FILTER_BITS)]):
                    exact = table.get(int(found[i].view(np.int64)))
                    if exact is None:
                        continue
                    doc = int(np.searchsorted(words.first, i, "right")) - 1
                    if i + k > words.first[doc + 1]:
                        continue  # runs into the next text
                    own = exact.get(words.text(i, k))
                    if own is not None:
                        spans[doc].append((int(i - words.first[doc]), k))
                        items[doc] |= own
            yield words, spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint ``(first, n)`` that cover the same words."""
    out: list[list[int]] = []
    for first, n in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], first + n)
        else:
            out.append([first, first + n])
    return [(a, b - a) for a, b in out]


def _clean(text: str, words, doc: int, begin: int, spans) -> str:
    """The text without the hit words and what stands between them."""
    raw, out, at = text.encode(), [], 0
    for first, n in spans:
        w = words.first[doc] + first
        out.append(raw[at : words.starts[w] - begin])
        at = words.ends[w + n - 1] - begin
    return b"".join([*out, raw[at:]]).decode()


def scan(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    one_in: int = ONE_IN,
    keep_rows: bool = False,
    clean: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per document ``doc_id`` (or, with ``keep_rows``, the row as ``doc``) and the columns of SCAN."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "decontaminate")
    windows = scratch.keep(benchmark_windows(benchmark, window), "windows")
    total = windows.agg(F.sum(F.length("words") + 64)).first()[0] or 0
    blocks = max(1, -(-total // broadcast_bytes))
    kept = F.struct(*[F.col(quote(c)) for c in documents.columns]) if keep_rows else F.col("doc_id")
    rows = documents.select(
        kept.alias("doc"),
        text_column(documents).alias("text"),
        F.lit(None).cast("array<struct<first:long,n:long>>").alias("spans"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    doc = [rows.schema["doc"]]
    for block in range(blocks):
        of_block = F.pmod(F.xxhash64("k", "hash", "item"), F.lit(blocks)) == block
        found = WindowSet(windows.where(of_block).select("k", "hash", "words", "item").collect())
        sent = spark.sparkContext.broadcast(found)
        last = block == blocks - 1
        rest = StructType.fromDDL(SCAN if last else PARTIAL).fields
        rows = batches(rows, _scanner(sent, last, one_in, clean), StructType(doc + rest))
        if not last:
            rows = scratch.keep(rows, f"block-{block}")
            sent.unpersist()
    return rows if keep_rows else rows.withColumnRenamed("doc", "doc_id")


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())]))


def _scanner(sent, last: bool, one_in: int, clean: bool):
    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1)
        had_spans, had_items = batch.column(2), batch.column(3)
        earlier = had_spans.null_count < len(had_spans)
        counts, spans_of, items_of, cleaned, at = [], [], [], [], 0
        for words, spans, items in sent.value.search(texts):
            counts.append(words.counts)
            for doc in range(words.texts):
                s, i = spans.get(doc, []), items.get(doc, set())
                if earlier:
                    s = s + [(x["first"], x["n"]) for x in had_spans[at].as_py() or ()]
                    i = i | set(had_items[at].as_py() or ())
                spans_of.append(merged(s))
                items_of.append(sorted(i))
                if clean and last:
                    text = texts[at].as_py()
                    begin = int(words.offsets[doc])
                    cleaned.append(_clean(text, words, doc, begin, spans_of[-1]) if s else text)
                at += 1
        spans = pa.array([[{"first": a, "n": n} for a, n in s] for s in spans_of], _SPANS)
        if not last:
            columns = [batch.column(0), texts, spans, pa.array(items_of, pa.list_(pa.string()))]
            return pa.record_batch(columns, ["doc", "text", "spans", "items"])
        n_words = np.concatenate(counts)
        n_hit = np.array([sum(n for _, n in s) for s in spans_of], np.int64)
        columns = {
            "doc": batch.column(0),
            "n_words": pa.array(n_words, pa.int64()),
            "n_hit": pa.array(n_hit),
            "n_items": pa.array([len(x) for x in items_of], pa.int64()),
            "items_sha256": pa.array(
                [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items_of]
            ),
            "contaminated": pa.array((n_hit > 0) & (one_in * n_hit >= n_words)),
            "spans": spans,
            "clean_text": pa.array(cleaned or [None] * len(texts), pa.string()),
        }
        return pa.record_batch(list(columns.values()), list(columns))

    return convert


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = scan(documents, benchmark, keep_rows=True, **options)
    return found.where("not contaminated").select("doc.*")


def remove_spans(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All documents; the words that stand in benchmark windows are cut out of ``text``."""
    found = scan(documents, benchmark, keep_rows=True, clean=True, **options)
    return found.select(
        *[
            F.col("clean_text").alias(c) if c == "text" else F.col(f"doc.{quote(c)}").alias(c)
            for c in documents.columns
        ]
    )
