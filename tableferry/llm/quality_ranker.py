"""Bradley-Terry ranking of documents by quality.

From labelled documents, pairs (better, worse) are drawn; the weights of a linear
score are learned by logistic loss on the difference of the pair's features, so
that the chance that one document beats another is the sigmoid of the
difference of their scores. A quantile of the labelled documents' scores is the threshold:
as many of them fall below it as are labelled bad. The score given out is the sigmoid of
the distance from it, so 0.5 marks the threshold.

Features are counts and shares of the whole text (no label, source or id). The
fit uses at most ``sample_rows`` labelled rows, chosen by hash of the id; scoring is one
pass over all documents with the weights alone sent out.

Defined cases: null and empty texts have all features zero but are scored like any
other; documents without an id are scored, never fitted on. With no labels, or one kind only,
every score is 0.5. Rows are scored one by one, repeated ones alike; a
document labelled both ways counts on both sides. Other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import batches, text_column
from .words import SPACED, pieces, window_hashes

#: Labelled rows that the fit may use, and pairs drawn from them
SAMPLE_ROWS = 20_000
PAIRS = 100_000
STEPS = 25
PENALTY = 1e-3
SEED = 7

_CLASSES = np.zeros(256, np.int64)
for _i, _members in enumerate(
    (b"#*$%&|<>", b".,;:!?", b"0123456789", bytes(range(65, 91)), b"\n", bytes(range(128, 256))), 1
):
    _CLASSES[list(_members)] = _i
_N_CLASSES = 7
FEATURES = 17


def _in_text(words, flags: np.ndarray) -> np.ndarray:
    """How many of the flagged words each text has."""
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[words.first[1:]] - total[words.first[:-1]]


def _first_seen(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which entries are the first of their key in their text."""
    order = np.lexsort((np.arange(len(keys)), keys, text))
    k, t = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    out = np.empty(len(keys), bool)
    out[order] = new
    return out


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES numbers for each text."""
    raw = texts.fill_null("") if texts.null_count else texts
    out, at = [np.zeros((0, FEATURES))], 0
    for _, words in pieces(texts, SPACED):
        n = words.counts.astype(float)
        some = np.maximum(n, 1)
        text = np.repeat(np.arange(words.texts), words.counts)
        hashes = words.hashes()
        lengths = (words.ends - words.starts).astype(float)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
        repeats = np.zeros(len(hashes), bool)
        windows = window_hashes(hashes, 5)
        if len(windows):
            own = text[: len(windows)]
            inside = own == text[4:]
            late = ~_first_seen(windows, own) & inside
            for j in range(5):
                repeats[j : j + len(windows)] |= late
        distinct = _first_seen(hashes, text) if len(hashes) else again
        # characters by class; the words hold lower-cased bytes, so classes look at the original
        data = b"".join(raw[at + i].as_buffer().to_pybytes() for i in range(words.texts))
        kinds = _CLASSES[np.frombuffer(data, np.uint8)]
        of = np.repeat(np.arange(words.texts), np.diff(words.offsets))
        table = np.bincount(of * _N_CLASSES + kinds, minlength=words.texts * _N_CLASSES)
        table = table.reshape(words.texts, _N_CLASSES).astype(float)
        size = np.maximum(table.sum(axis=1), 1)
        mean = np.bincount(text, lengths, minlength=words.texts) / some
        square = np.bincount(text, lengths**2, minlength=words.texts) / some
        columns = [
            np.log1p(n),
            np.minimum(n, 10) / 10,
            np.log1p(size),
            mean,
            np.sqrt(np.maximum(square - mean**2, 0)),
            _in_text(words, again) / some,
            _in_text(words, repeats) / some,
            _in_text(words, distinct) / some,
            _in_text(words, lengths == 1) / some,
            _in_text(words, lengths > 20) / some,
            *(table[:, i] / size for i in range(1, _N_CLASSES)),
            table[:, 1] > 0.1 * n,
        ]
        out.append(np.column_stack([np.asarray(c, float) for c in columns]))
        at += words.texts
    return np.concatenate(out)


class Ranker:
    """Weights over standardised features, and the score at the threshold."""

    def __init__(self, mean, scale, weights, threshold):
        self.mean, self.scale, self.weights, self.threshold = mean, scale, weights, threshold

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) / self.scale).clip(-8, 8) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.raw(rows) - self.threshold).clip(-30, 30)))


def fit(rows: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = SEED) -> Ranker:
    """Learn from feature rows and their labels; Newton steps on the pairwise logistic loss."""
    n = rows.shape[1] if rows.ndim == 2 and len(rows) else FEATURES
    plain = Ranker(np.zeros(n), np.ones(n), np.zeros(n), 0.0)
    if not good.any() or good.all():
        return plain
    mean, scale = rows.mean(axis=0), rows.std(axis=0)
    scale[scale < 1e-9] = 1
    x = ((rows - mean) / scale).clip(-8, 8)
    draw = np.random.default_rng(seed)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    d = x[draw.choice(better, pairs)] - x[draw.choice(worse, pairs)]
    w = np.zeros(n)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-(d @ w).clip(-30, 30)))
        slope = d.T @ (1 - p) / pairs - PENALTY * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + PENALTY * np.eye(n)
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    raw = np.sort(x @ w)
    below = int((~good).sum())
    # halfway between the last that counts as bad and the first that counts as good
    return Ranker(mean, scale, w, float(raw[below - 1] + raw[below]) / 2)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Ranker:
    labelled = labels.where("doc_id is not null and quality in (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    )
    chosen = (
        labelled.where(~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(sample_rows)
    )
    texts = documents.select(F.col("doc_id").cast("long"), text_column(documents).alias("text"))
    # an id may repeat among the documents: one text, chosen by hash, for each sampled label
    chosen = chosen.groupBy("doc_id", "quality").agg(F.count(F.lit(1)).alias("labels"))
    one = F.min(F.struct(F.xxhash64("text").alias("at"), "text")).alias("one")
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "quality", "labels")
        .agg(one)
        .select("doc_id", "one.text", "quality", F.explode(F.sequence(F.lit(1).cast("long"), "labels")))
    )

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = features(batch.column(1))
        return pa.record_batch(
            [batch.column(0), batch.column(2), pa.array(list(found), pa.list_(pa.float64()))],
            ["doc_id", "quality", "x"],
        )

    found = batches(rows, convert, "doc_id long, quality int, x array<double>").toPandas()
    # in an order of its own, so that the pairs do not depend on the partitions
    found = found.sort_values(["doc_id", "quality"], kind="stable")
    if found.empty:
        return fit(np.zeros((0, FEATURES)), np.zeros(0, bool))
    return fit(np.stack(found["x"].to_numpy()), found["quality"].to_numpy() == 1)


def rank(documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``."""
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(train(documents, labels, **options))

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = sent.value.score(features(batch.column(1)))
        return pa.record_batch(
            [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
            ["doc_id", "score", "predicted"],
        )

    rows = documents.select(F.col("doc_id").cast("long"), text_column(documents).alias("text"))
    return batches(rows, convert, "doc_id long, score double, predicted int").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )
