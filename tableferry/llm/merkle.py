"""Merkle manifest of a table, with few levels stored and proofs recomputed from them.

Every row is a leaf: the hash of its fields. Rows of one tree (a language, say)
stand in the order of their key; while a level has several nodes, each two
neighbours, the last one alone if need be, become their hash. What remains is the
tree's subroot, and the subroots, in the order of their trees, are the leaves of one
more tree, whose top is the root of the manifest. A hash is SHA-256 over the
inputs' text, digests as lower-case hex.

Only the leaves and every ``every``-th level above are written (checkpoints). A node
of a stored level stands for an aligned subtree of ``2 ** every`` nodes of the stored
level below. A proof needs the siblings on a leaf's way up: level by level from the
top, a task takes the stored nodes of one aligned subtree, recomputes the levels
between, hands each node its siblings inside the subtree in front of those above it,
and forgets the rest. So storage is ``1 / 2 ** every`` of the leaves beside them, a
task holds one subtree at a time, and paths above are joined per subtree, not
per leaf.

No tree is ever in one task: leaves are sorted by ranges of (tree, key, hash, row),
a row's place follows from its place in its range and the rows of its tree in
earlier ranges, and each step above works on subtrees. The hash and a row number in the
sort key keep rows of equal keys, or wholly equal rows, in many ranges.

Defined cases: a null field is ``-``, an empty one ``0:``; a null tree is a tree of
its own and the first; null keys come first, equal keys stand in the order of their hashes; every
repeated row is a leaf of its own; texts of any length count whole; an
empty table has no proofs and no root. Columns that are not named play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField, StructType

from tableferry.functions.names import quote

from .shared import Scratch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a subtree: one level in so many is stored
EVERY = 8
#: Rows of a task
PART_ROWS = 50_000

_STEP = 33  # bytes of a path for each level: where the sibling stands, and its digest
_NONE, _RIGHT, _LEFT = b"\0", b"\1", b"\2"


def leaf(fields: Sequence[Column]) -> Column:
    """Hash of a row, as hex: each field as its byte count, a colon and its text, or ``-`` for null."""
    said = [
        F.when(c.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))
        )
        for c in fields
    ]
    return F.sha2(F.concat(*said).cast("binary"), 256)


def _parent(*digests: bytes) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def _levels(nodes: list[bytes], up: int) -> list[list[bytes]]:
    """``up`` levels above the nodes, which come first."""
    out = [nodes]
    for _ in range(up):
        below = out[-1]
        out.append([_parent(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return out


def _up(n: int, every: int) -> int:
    """Levels from a stored level with ``n`` nodes to the next one."""
    return min(every, (n - 1).bit_length())


def _whole_groups(each: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches that hold whole groups of the first two columns, and where each group begins."""
    rest: pa.RecordBatch | None = None
    for batch in each:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        starts = _starts(batch)
        rest = batch.slice(starts[-1])
        if starts[-1]:
            yield batch.slice(0, starts[-1]), starts[:-1]
    if rest is not None:
        yield rest, [0]


def _starts(batch: pa.RecordBatch) -> list[int]:
    keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    return [i for i, key in enumerate(keys) if not i or key != keys[i - 1]]


def _climb(every: int):
    """Subtrees (tree, block, n, hash) to their tops (tree, n, pos, hash)."""

    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in _whole_groups(each):
            n, digest = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            ends = [*starts[1:], batch.num_rows]
            at = pa.array(starts, pa.int64())
            yield pa.record_batch(
                [
                    batch.column(0).take(at),
                    pa.array([-(-n[a] >> every) if n[a] > 1 else 1 for a in starts], pa.int64()),
                    batch.column(1).take(at),
                    pa.array(
                        [_levels(digest[a:b], _up(n[a], every))[-1][0] for a, b in zip(starts, ends)],
                        pa.binary(),
                    ),
                ],
                ["tree", "n", "pos", "hash"],
            )

    return run


def _descend(every: int):
    """Subtrees (tree, block, n, hash, path, top, pos, row), the way above first, to nodes with their ways."""

    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in _whole_groups(each):
            n, digest, path, top = (batch.column(i).to_pylist() for i in range(2, 6))
            ways, tops = [], []
            for a, b in zip(starts, [*starts[1:], batch.num_rows]):
                up = _up(n[a + 1], every)
                levels = _levels(digest[a + 1 : b], up)
                for i in range(b - a - 1):
                    own = []
                    for d in range(up):
                        sibling = (i >> d) ^ 1
                        if sibling < len(levels[d]):
                            own += (_LEFT if sibling < i >> d else _RIGHT, levels[d][sibling])
                        else:
                            own.append(_NONE * _STEP)
                    ways.append(b"".join([*own, path[a]]))
                    tops.append(top[a])
            first = set(starts)
            nodes = batch.take(pa.array([i for i in range(batch.num_rows) if i not in first], pa.int64()))
            yield pa.record_batch(
                [nodes.column(0), nodes.column(6), nodes.column(3), pa.array(ways, pa.binary()),
                 pa.array(tops, pa.binary()), nodes.column(7)],
                ["tree", "pos", "hash", "path", "top", "row"],
            )

    return run


def _unpack(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths as two lists: the siblings' hex digests (null where there is none), and whether each stands left."""
    for batch in each:
        paths = batch.column(0).to_pylist()
        steps = [[p[i : i + _STEP] for i in range(0, len(p), _STEP)] for p in paths]
        digests = [[None if s[:1] == _NONE else s[1:].hex() for s in way] for way in steps]
        left = [[s[:1] == _LEFT for s in way] for way in steps]
        yield pa.record_batch(
            [pa.array(digests, pa.list_(pa.string())), pa.array(left, pa.list_(pa.bool_())), *batch.columns[1:]],
            ["siblings", "left", *batch.schema.names[1:]],
        )


def folded(leaf: Column, siblings: Column, left: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def step(node: Column, sibling: Column) -> Column:
        digest, stands_left = sibling["siblings"], sibling["left"]
        said = (
            F.when(digest.isNull(), node)
            .when(stands_left, F.concat(digest, node))
            .otherwise(F.concat(node, digest))
        )
        return F.sha2(said.cast("binary"), 256)

    return F.aggregate(F.arrays_zip(siblings.alias("siblings"), left.alias("left")), leaf, step)


class Manifest:
    """The stored levels of a table's trees.

    ``also`` names columns that every proof carries on: expressions over the rows.
    """

    def __init__(
        self,
        rows: DataFrame,
        fields: Sequence[str] = FIELDS,
        tree: str = "lang",
        key: str = "doc_id",
        also: Mapping[str, Column] | None = None,
        every: int = EVERY,
    ):
        self.spark: SparkSession = rows.sparkSession
        self.every = every
        self.scratch = Scratch(self.spark, "manifest")
        leaves = rows.select(
            F.col(quote(tree)).cast("string").alias("tree"),
            F.col(quote(key)).alias("key"),
            F.unhex(leaf([F.col(quote(c)) for c in fields])).alias("hash"),
            F.struct(F.col(quote(key)).alias("key"), *[c.alias(n) for n, c in (also or {}).items()]).alias("row"),
        )
        self.trees = self._stored(self._ranked(leaves, "leaves"), "trees")
        subroots = self.trees[-1].select(
            F.lit(None).cast("string").alias("tree"), F.col("tree").alias("key"), "hash", F.struct("tree").alias("row")
        )
        self.crown = self._stored(self._ranked(subroots, "subroots"), "crown")

    @property
    def root(self) -> str | None:
        """Hex digest over the whole table."""
        found = self.crown[-1].select(F.lower(F.hex("hash"))).first()
        return found[0] if found else None

    def _parts(self, rows: DataFrame) -> int:
        return max(1, -(-rows.count() // PART_ROWS))  # of written tables: footers only

    def _ranked(self, rows: DataFrame, name: str) -> DataFrame:
        """``(tree, n, pos, hash, row)``: each row's place among the ``n`` of its tree."""
        kept = self.scratch.keep(rows.withColumn("number", F.monotonically_increasing_id()), f"{name}-unsorted")
        order = ["tree", "key", "hash", "number"]
        by_range = kept.repartitionByRange(self._parts(kept), *order).sortWithinPartitions(*order)
        placed = by_range.select("tree", "hash", "row", F.monotonically_increasing_id().alias("at"))
        placed = self.scratch.keep(placed.withColumn("part", F.shiftright("at", 33)), name)
        # one row for each range and tree in it
        runs = placed.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
        of_tree = Window.partitionBy("tree")
        earlier = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        runs = runs.select(
            F.col("part").alias("of_part"),
            F.col("tree").alias("of"),
            F.sum("rows").over(of_tree).alias("n"),
            (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        )
        runs = self.scratch.keep(runs, f"{name}-runs")
        same = (F.col("part") == F.col("of_part")) & F.col("tree").eqNullSafe(F.col("of"))
        return placed.join(runs, same).select(
            "tree", "n", (F.col("at") + F.col("shift")).alias("pos"), "hash", "row"
        )

    def _stored(self, leaves: DataFrame, name: str) -> list[DataFrame]:
        """The leaves and each stored level above, up to one node a tree."""
        levels = [leaves]
        most = leaves.agg(F.max("n")).first()[0] or 1
        while most > 1 or len(levels) == 1:
            below = levels[-1]
            subtrees = self._by_subtree(below.select("tree", self._block(), "n", "hash", "pos"), "pos")
            tops = subtrees.mapInArrow(_climb(self.every), "tree string, n long, pos long, hash binary")
            levels.append(self.scratch.keep(tops, f"{name}-{len(levels) * self.every}"))
            most = -(-most >> self.every)
        return levels

    def _block(self) -> Column:
        return F.shiftright("pos", self.every).alias("block")

    def _by_subtree(self, rows: DataFrame, *order: str) -> DataFrame:
        at = ["tree", "block"]
        return rows.repartition(self._parts(rows), *at).sortWithinPartitions(*at, *order)

    def _ways(self, levels: list[DataFrame], above: DataFrame, scratch: Scratch, name: str) -> DataFrame:
        """``(tree, pos, hash, path, top, row)`` of the lowest level; ``above`` has the ways of the highest."""
        for depth in range(len(levels) - 2, -1, -1):
            row = F.col("row") if "row" in levels[depth].columns else F.lit(None).cast("boolean")
            nodes = levels[depth].select(
                "tree", self._block(), "n", "hash", F.lit(None).cast("binary").alias("path"),
                F.lit(None).cast("binary").alias("top"), "pos", row.alias("row"),
            )
            kind = nodes.schema["row"].dataType
            ways = above.select(
                "tree", F.col("pos").alias("block"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("binary").alias("hash"),
                "path", "top", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast(kind).alias("row"),
            )
            held = self._by_subtree(ways.unionByName(nodes), "pos")
            schema = StructType(
                [StructField("tree", StringType()), StructField("pos", LongType())]
                + [StructField(c, BinaryType()) for c in ("hash", "path", "top")]
                + [StructField("row", kind)]
            )
            found = held.mapInArrow(_descend(self.every), schema)
            above = scratch.keep(found, f"{name}-{depth}") if depth else found
        return above

    def proofs(self) -> DataFrame:
        """``key, leaf, subroot, root, siblings, left`` and the columns of ``also``, for each row.

        ``siblings`` has an element for each level on the way to the root, null where a
        node is alone; ``left`` says on which side the sibling stands.
        """
        scratch = Scratch(self.spark, "proofs")
        root = F.lit(self.root).cast("string")
        none = F.lit(None).cast("binary")
        above = self.crown[-1].select("tree", "pos", F.lit(b"").alias("path"), none.alias("top"))
        crown = self._ways(self.crown, above, scratch, "crown").select(
            F.col("row.tree").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("hash").alias("top")
        )
        ways = self._ways(self.trees, scratch.keep(crown, "subroots"), scratch, "trees")
        schema = StructType(
            [
                StructField("siblings", ArrayType(StringType())),
                StructField("left", ArrayType(BooleanType())),
                *(ways.schema[c] for c in ("hash", "top", "row")),
            ]
        )
        found = ways.select("path", "hash", "top", "row").mapInArrow(_unpack, schema)
        return found.select(
            "row.*",
            F.lower(F.hex("hash")).alias("leaf"),
            F.lower(F.hex("top")).alias("subroot"),
            root.alias("root"),
            "siblings",
            "left",
        )
