"""Token ids in Parquet list columns, for selective reads of tokens and metadata.

Texts are encoded with a given tokenizer file and written in ascending id order
as ``(doc_id, n_tokens, tokens)``. Ids of the list column are dictionary
encoded, the two numbers delta encoded (format version 2); row groups and pages have set
sizes, and the column and offset indexes let a reader that wants a few documents skip
the pages of all others. Reading ``doc_id`` and ``n_tokens`` touches no token page.

The white space of the tokenizer's texts never becomes a token and no token
spans it, so a text's ids are those of its blank-separated chunks in turn; each chunk is
encoded once and remembered (up to a bounded number of chunks per worker). A tokenizer
for which this does not hold is refused: the chunks of a probe text are compared with
the whole. Marks that end a chunk after a letter or digit are looked up apart, and ASCII chunks in
lower case, where probes and the tokenizer's added tokens show that this gives the same ids.

Defined cases: a null text counts as empty and has the end id alone; null ids
come first; rows of one id go by the first letters of their texts, then a hash of them, over as
many files as they need. A text of any length is encoded whole, by one task. Other columns are
not written. An empty table gives files without rows.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import batches, text_column

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
#: Rows a file holds on average
FILE_ROWS = 50_000
#: Chunks a worker remembers, and text that it encodes at once
REMEMBERED = 1_000_000
PIECE_BYTES = 6 << 20
#: Chunks that are encoded as one text
TOGETHER = 16_384
#: Stands between chunks that are encoded together
MARK = "\x02"
#: Letters of a text by which rows of one id are ordered
HEAD = 32
#: Marks that are looked up apart from the chunk that they end
TAILS = ".,;:!?#*$%&"
_STEM_AND_TAIL = f"(?s)^(?P<stem>.*[0-9A-Za-zÀ-ÖØ-öø-ÿ])(?P<tail>[{TAILS}]+)$"
#: Added tokens may begin with this; chunks that hold it keep their case
ADDED = "<"
_PROBE = " Don't  stop,\n\tit's 42.5% <|endoftext|> ÉTÉ é naïve— x"


def _gathered(ids: np.ndarray, sizes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The ids of many chunks, by the chunks' places in ``sizes``."""
    n = sizes[code]
    place = (np.cumsum(sizes) - sizes)[code]
    end = np.cumsum(n)
    return ids[np.repeat(place - (end - n), n) + np.arange(end[-1] if len(end) else 0)]


class Encoder:
    """Ids of many texts; equal chunks are encoded once."""

    def __init__(self, path: str, end_id: int | None = END_ID):
        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        mark = self._ids(MARK)
        self.mark = mark[0] if len(mark) == 1 else -1  # no id, so all go one by one
        self.tails, self.lower = self._by_tails(), self._in_lower_case()
        self._forget()

    def _forget(self) -> None:
        self.code: dict[str, int] = {}  # place of each chunk in sizes
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)  # of all chunks, one after another

    def _forget_all_but(self, chunks: list[str]) -> None:
        code = np.fromiter(map(self.code.__getitem__, chunks), np.int64, len(chunks))
        self.ids = self._ids_of(code)
        self.sizes = self.sizes[code]
        self.code = dict(zip(chunks, range(len(chunks))))

    def _ids_of(self, code: np.ndarray) -> np.ndarray:
        return _gathered(self.ids, self.sizes, code)

    def by_chunks(self) -> bool:
        whole = self.tokenizer.encode(_PROBE, add_special_tokens=False).ids
        chunks = self.tokenizer.encode_batch(_PROBE.split(), add_special_tokens=False)
        return whole == [i for c in chunks for i in c.ids]

    def _added(self) -> list[str]:
        return [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]

    def _by_tails(self) -> bool:
        """Whether the marks that end a chunk after a letter or digit have the ids that they have alone."""
        if any(x in token for token in self._added() for x in TAILS):
            return False
        stems, tails = ("word", "Été9", "x's", "naïvÿ", "7"), (*TAILS, "...", TAILS, TAILS[::-1])
        return all(
            np.array_equal(self._ids(s + t), np.concatenate((self._ids(s), self._ids(t)))) for s in stems for t in tails
        )

    def _in_lower_case(self) -> bool:
        """Whether ASCII chunks without ADDED have the ids that they have in lower case."""
        normalizer = self.tokenizer.normalizer
        if normalizer is None or not all(ADDED in token for token in self._added()):
            return False
        upper = f"{string.ascii_uppercase} " + " ".join(string.ascii_uppercase)
        return normalizer.normalize_str(upper) == normalizer.normalize_str(upper.lower())

    def _parts(self, chunks: pa.Array) -> list[pa.Array]:
        """Chunks as the parts that are looked up, which have the chunks' ids one after the other."""
        parts = [chunks]
        if self.tails:
            found = pc.extract_regex(chunks, _STEM_AND_TAIL)
            parts = [pc.coalesce(pc.struct_field(found, "stem"), chunks), pc.struct_field(found, "tail").fill_null("")]
        if self.lower:
            plain = pc.and_not(pc.string_is_ascii(parts[0]), pc.match_substring(parts[0], ADDED))
            parts[0] = pc.if_else(plain, pc.ascii_lower(parts[0]), parts[0])
        return parts

    def _encoded(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, one after another, and their numbers.

        The chunks are encoded as one text with marks between, which is faster than one by one;
        should one of them hold the mark, its id stands too often and they go one by one.
        """
        whole = self._ids(f" {MARK} ".join(chunks))
        marks = whole == self.mark
        if np.count_nonzero(marks) == len(chunks) - 1:
            at = np.concatenate(([-1], np.flatnonzero(marks), [len(whole)]))
            return whole[~marks], np.diff(at) - 1
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def _codes(self, chunks: list[str]) -> np.ndarray:
        found = list(map(self.code.get, chunks))
        new = [c for c, f in zip(chunks, found) if f is None]
        if self.code and len(self.code) + len(new) > REMEMBERED:
            self._forget_all_but([c for c, f in zip(chunks, found) if f is not None])
            found = list(map(self.code.get, chunks))
        at = len(self.code)
        if new:
            parts = [self._encoded(new[i : i + TOGETHER]) for i in range(0, len(new), TOGETHER)]
            self.code.update(zip(new, range(at, at + len(new))))
            self.sizes = np.concatenate((self.sizes, *(p[1] for p in parts)))
            self.ids = np.concatenate((self.ids, *(p[0] for p in parts)))
        # the new ones have the next places, in their order
        codes = np.fromiter((-1 if f is None else f for f in found), np.int64, len(found))
        codes[codes < 0] = np.arange(at, at + len(new))
        return codes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all texts, where each text's ids end)``, with the end ids."""
        texts = texts.fill_null("") if texts.null_count else texts
        split = pc.ascii_split_whitespace(texts)
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        found = split.flatten().dictionary_encode()
        parts = self._parts(found.dictionary)
        each = pa.concat_arrays(parts).dictionary_encode()
        codes = self._codes(each.dictionary.to_pylist())[each.indices.to_numpy(zero_copy_only=False)]
        codes = codes.reshape(len(parts), -1).T  # a row for each chunk
        sizes = self.sizes[codes].sum(axis=1)
        word = found.indices.to_numpy(zero_copy_only=False)
        before = np.concatenate(([0], np.cumsum(sizes[word])))
        ends = before[np.cumsum(counts)]
        tokens = _gathered(self._ids_of(codes.ravel()), sizes, word)
        if self.end_id is not None:
            tokens = np.insert(tokens, ends, self.end_id)
            ends = ends + np.arange(1, len(ends) + 1)
        return tokens, ends


@lru_cache(maxsize=1)
def _encoder(path: str, end_id: int | None) -> Encoder:
    """One encoder per worker process, so tasks find the chunks of earlier ones."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for every core
    return Encoder(path, end_id)


def _encode(path: str, end_id: int | None):
    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, end_id)
        for batch in each:
            # some MB of text at a time, so a batch of long texts stays small
            step = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                tokens, ends = encoder.encode(part.column(1))
                offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(tokens, pa.int32()))
                sizes = np.diff(np.concatenate(([0], ends)))
                yield pa.record_batch(
                    [part.column(0), pa.array(sizes, pa.int64()), lists], ["doc_id", "n_tokens", "tokens"]
                )

    return run


def write_tokens(
    documents: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    end_id: int | None = END_ID,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    file_rows: int = FILE_ROWS,
) -> None:
    """Write the ids of all documents, in ascending ``doc_id`` order over files and rows."""
    if not Encoder(tokenizer).by_chunks():
        raise ValueError(f"{tokenizer}: white space matters to this tokenizer")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(documents).alias("text"))
    files = max(1, -(-documents.count() // file_rows))
    files = max(files, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # one id may be on a third of all rows, with one text: such rows part by the task that read them
    order = ["doc_id", "head", "hash", "task"]
    rows = texts.select(
        "*", F.left("text", F.lit(HEAD)).alias("head"), F.xxhash64("text").alias("hash"), F.spark_partition_id().alias("task")
    )
    rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text")
    rows = rows.mapInArrow(_encode(tokenizer, end_id), "doc_id long, n_tokens long, tokens array<int>")
    rows.write.options(
        **{
            "compression": "zstd",
            "parquet.writer.version": "PARQUET_2_0",
            "parquet.block.size": str(row_group_bytes),
            "parquet.page.size": str(page_bytes),
            "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#tokens.list.element": "true",
        }
    ).parquet(path)


def _crc(batch: pa.RecordBatch) -> pa.RecordBatch:
    lists = batch.column(2)
    offsets = lists.offsets.to_numpy()
    ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
    crc = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    columns = [batch.column(0), batch.column(1), pa.array(crc, pa.int64()), *batch.columns[3:]]
    return pa.record_batch(columns, ["doc_id", "n_tokens", "ids_crc32", "file", "row"])


def file_starts(files: DataFrame) -> DataFrame:
    """``(file, before)``: the ids in all files before each, from the two number columns alone."""
    sizes = files.select(F.col("_metadata.file_path").alias("file"), "doc_id", "n_tokens")
    per_file = sizes.groupBy("file").agg(
        F.sum("n_tokens").alias("ids"), F.min("doc_id").alias("first_id")
    )
    # files hold ranges in the order of their numbers; this window sees a row a file
    number = F.regexp_extract("file", r"part-(\d+)[^/]*$", 1).try_cast("long")
    earlier = Window.orderBy(F.col("first_id").asc_nulls_first(), number, "file")
    before = F.sum("ids").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    return per_file.select("file", F.coalesce(before, F.lit(0)).alias("before"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: ``doc_id, start, n_tokens, ids_crc32`` per document."""
    files = spark.read.parquet(path)
    rows = files.select(
        "doc_id",
        "n_tokens",
        "tokens",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    rows = batches(rows, _crc, "doc_id long, n_tokens long, ids_crc32 long, file string, row long")
    in_file = Window.partitionBy("file").orderBy("row")
    before = F.sum("n_tokens").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    return (
        rows.withColumn("in_file", F.coalesce(before, F.lit(0)))
        .join(file_starts(files), "file")
        .select("doc_id", (F.col("before") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32")
    )
