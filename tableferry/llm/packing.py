"""Best-fit packing of documents into sequences of several permitted lengths.

Items go in by falling length. Each goes to the open sequence with the least
room that still takes it, whatever that sequence's length. If none does, a new one is opened, of
the permitted length with the least cost for each token it can hope to hold: the
item and whatever is still to be packed. In the end every sequence is
cut down to the shortest permitted length that holds its contents. What a sequence can
hope to hold is a guess, so each shard is also packed with the shortest permitted lengths
left out of the openings, up to the longest length only, and the cheapest of these packings counts:
none costs more than sequences of one fixed length.

Documents are dealt by a hash of their place in the table (so equal rows part) into shards of about ``shard_items`` items, each packed by
one task; the number of shards follows the data, so a task's work is bounded and
what is lost is at most a few part-filled sequences per shard. A document longer
than the longest sequence is cut into pieces of that length and a rest: nothing is dropped.

Defined cases: rows without words (null or empty text) are not packed and come
back with a null sequence; ties in length go by id (null first), then by place
in the shard; repeated rows are packed once each; an empty table gives no row. Other columns do
not matter.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rules import words
from .shared import Scratch

#: Permitted lengths and what a sequence of each costs: its tokens, attention, which grows with the
#: square of the length (as much as the rest at 8192), and a fixed part
SEQUENCE_COST = {n: n + n * n / 8192 + 64 for n in (256, 512, 1024, 2048, 4096, 8192)}
SHARD_ITEMS = 50_000

PACKED = "doc_id long, piece int, n_tokens long, sequence long, capacity int, start int"


Packing = tuple[list[int], list[int], list[int]]


def cheapest(lengths: list[int], cost: Mapping[int, float]) -> Packing:
    """The best fit of least cost, whichever length the openings begin at."""
    tries = (best_fit(lengths, cost, shortest) for shortest in sorted(cost))
    return min(tries, key=lambda x: sum(cost[c] for c in x[2]))


def best_fit(lengths: list[int], cost: Mapping[int, float], shortest: int = 0) -> Packing:
    """``(sequence of each item, start of each item in it, capacity of each sequence)``.

    ``lengths`` fall and none is over the largest permitted length. No sequence is opened
    shorter than ``shortest``.
    """
    permitted = sorted(cost)
    left = sum(lengths)
    rooms: list[tuple[int, int]] = []  # (room, sequence) of the open ones, sorted
    capacity, used = [], []
    into, start = [], []
    for n in lengths:
        at = bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, own = rooms.pop(at)
        else:
            size = min(
                (c for c in permitted if c >= max(n, shortest)), key=lambda c: (cost[c] / min(c, left), c)
            )
            own, room = len(capacity), size
            capacity.append(size)
            used.append(0)
        into.append(own)
        start.append(used[own])
        used[own] += n
        left -= n
        if room > n:
            insort(rooms, (room - n, own))
    return into, start, [permitted[bisect_left(permitted, u)] for u in used]


def _pack(cost: Mapping[int, float]):
    def run(table: pa.Table) -> pa.Table:
        # ids first: nulls, then rising; equal lengths keep this order
        order = sorted(
            zip(*(table.column(c).to_pylist() for c in ("n", "doc_id", "piece", "shard"))),
            key=lambda x: (-x[0], x[1] is not None, x[1] or 0, x[2]),
        )
        into, start, capacity = cheapest([x[0] for x in order], cost)
        shard = order[0][3]
        return pa.table(
            {
                "doc_id": pa.array([x[1] for x in order], pa.int64()),
                "piece": pa.array([x[2] for x in order], pa.int32()),
                "n_tokens": pa.array([x[0] for x in order], pa.int64()),
                "sequence": pa.array([(shard << 24) + x for x in into], pa.int64()),
                "capacity": pa.array([capacity[x] for x in into], pa.int32()),
                "start": pa.array(start, pa.int32()),
            }
        )

    return run


def pack(
    documents: DataFrame,
    n_tokens: Column | None = None,
    cost: Mapping[int, float] | None = None,
    shard_items: int = SHARD_ITEMS,
) -> DataFrame:
    """Per piece of a document: its sequence, the sequence's capacity and its start there.

    ``n_tokens`` is an expression over the documents; by default the words of the text.
    """
    cost = dict(cost or SEQUENCE_COST)
    longest = max(cost)
    if n_tokens is None:
        n_tokens = F.size(words(F.col("text").cast("string")))
    # kept, as the pieces are counted before they are dealt and texts shall be read once
    sizes = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(n_tokens, F.lit(0)).cast("long").alias("n"),
        # written down before it is used, so it stays the same for the rest
        F.monotonically_increasing_id().alias("spread"),
    )
    sizes = Scratch(documents.sparkSession, "packing").keep(sizes, "sizes")
    pieces = sizes.select(
        "doc_id",
        "spread",
        F.posexplode(
            F.when(F.col("n") == 0, F.array(F.lit(0).cast("long"))).otherwise(
                F.transform(
                    F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(longest).cast("long")),
                    lambda at: F.least(F.lit(longest), F.col("n") - at),
                )
            )
        ).alias("piece", "n"),
    )
    # of the pieces, not of the documents: a long text has many
    items = sizes.agg(F.sum(F.ceil(F.col("n") / longest))).first()[0] or 0
    shards = max(1, -(-items // shard_items))
    packed = (
        pieces.where("n > 0")
        .select("doc_id", "piece", "n", F.pmod(F.xxhash64("spread", "piece"), F.lit(shards)).alias("shard"))
        .groupBy("shard")
        .applyInArrow(_pack(cost), PACKED)
    )
    empty = pieces.where("n = 0").select(
        "doc_id",
        F.lit(0).alias("piece"),
        F.lit(0).cast("long").alias("n_tokens"),
        F.lit(None).cast("long").alias("sequence"),
        F.lit(None).cast("int").alias("capacity"),
        F.lit(None).cast("int").alias("start"),
    )
    return packed.unionByName(empty)
