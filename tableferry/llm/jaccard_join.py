"""N-gram Jaccard self-join and the groups it links, by R-trees over count vectors.

Texts become sets of word shingles. Each set is hashed into groups and counted:
a point. The shingles that two sets share are at most the sum of the smaller of
their counts, so a pair (or a whole tree node, by the largest counts in it) whose
sum is too small for the similarity is passed over. What survives is verified
on the sets themselves.

Points of unrelated texts of one length lie near each other, so a single tree over
all documents would be searched in quadratic time. The join therefore builds
its trees in cells: two sets of similarity s share one of the first
``n - ceil(s n) + 1`` shingles in any common order, and the order here is rarest
first, so cells stay small. The place of the shingle in that order bounds the
partner's size: the smaller set has it among its first ``n / 9`` or so. The order comes from counts of all shingles of the
corpus in a table of a fixed size. Near copies share nearly all of their cells; short cells that begin with the
same class are therefore gathered into one, in which a class stands once, and large ones where that leaves no more
pairs of rows than before. Rows without a partner of a fitting size in their cell go no further.

Work on large groups stays in proportion to their rows:

* equal sets are one class, collapsed before the shuffle;
* in the first round each cell is cut into blocks, each block is a tree, and the trees are joined with
  themselves: a row gives away its best candidates by the bound, a few of them. Cells of one block
  that had no more are done. The points are coarse here, 64 groups, as they go along with every row;
* links come out of verified candidates, and components out of links. Of the cells that are not done, those that hold
  several components are looked at again, in a second round with a few candidates for each pair of components,
  and those that had more than these in a third without any limit. Blocks of one cell meet only if their bounds
  (sizes, components, counts) allow a link.

No step caps partners or candidates. Shingles are compared by 64-bit hashes.

Defined cases: null and empty texts have an empty set and are linked with
nothing; a text of fewer words than a shingle is one shingle. Rows of one id
count as one document, linked with all that any of its texts is linked with;
repeated rows give repeated rows. Rows without an id get no component. Sets of exactly the
similarity are linked; of equal bounds the candidate that a tree holds first is given away first,
which changes the round a link is found in, not the groups. A text of any length is shingled whole, by one task; its set
is held as 8 bytes a shingle. An empty table gives no row. Other columns do not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableferry.functions.names import quote

from .components import components
from .shared import SLICE_ROWS, Scratch, added_up, batches, sliced, text_column
from .words import SPACED, Words, pieces, window_hashes

SHINGLE = 5
#: Similarity as a percentage
SIMILARITY = 80
#: Groups that a set's shingles are counted in: its size up to the next power of two, within these
LEAST_GROUPS, MOST_GROUPS = 64, 16384
FAN_OUT = 16
#: Rows of a cell up to which its pairs of sizes are looked at one by one
SHORT_RUN = 8
#: Rows of a cell up to which it is gathered with others that begin with the same class
GATHERED = 32
#: Blocks that a task has ready before it gives them away
HELD_BYTES = 4 << 20
#: Counts that are compared at once
COUNTS_AT_ONCE = 1 << 20


@dataclass(frozen=True)
class Sizes:
    """Sizes of tables and work units. They change what a join costs, not what it finds.

    ``order_bits``: entries of the table that orders shingles; ``deal``: rows of a
    cell that go to one task; ``block``: points of a tree; ``few``: candidates of a row in the first
    round, and twice as many of two components in the second.
    """

    order_bits: int = 18
    deal: int = 2048
    block: int = 256
    few: int = 3


_ID_BITS = 23


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes = words.hashes()
    windows = window_hashes(hashes, k)
    for first, n in zip(words.first.tolist(), words.counts.tolist()):
        if n >= k:
            own = np.sort(windows[first : first + n - k + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif n:
            yield window_hashes(hashes[first : first + n], n)
        else:
            yield np.zeros(0, np.uint64)


def fingerprint(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def enough(a, b, similarity: int):
    """Shared shingles that sets of sizes ``a`` and ``b`` need."""
    return -(-similarity * (a + b) // (100 + similarity))


def prefix_length(n: int, similarity: int) -> int:
    return n - -(-similarity * n // 100) + 1


def reach(n: Column, place: Column, similarity: int) -> Column:
    """The largest partner that a set of size ``n`` can still be linked with if the first shingle
    they share, in the common order, has this place (from 0) in the set."""
    return F.floor((n - place) * (100 + similarity) / similarity) - n


# ------------------------------------------------------------------ points


def point_of(own: np.ndarray) -> bytes:
    """The counts of a set by group: a byte that tells their width in bytes, 0 for half a byte, then the counts."""
    groups = min(max(1 << len(own).bit_length(), LEAST_GROUPS), MOST_GROUPS)
    counts = np.bincount((own % np.uint64(groups)).astype(np.int64), minlength=groups)
    if counts.max() < 16:
        return b"\0" + (counts[0::2] | counts[1::2] << 4).astype(np.uint8).tobytes()
    width = np.min_scalar_type(counts.max())
    return bytes([width.itemsize]) + counts.astype(width).tobytes()


def _counts(point: bytes) -> np.ndarray:
    if point[0]:
        return np.frombuffer(point, f"u{point[0]}", offset=1)
    pairs = np.frombuffer(point, np.uint8, offset=1)
    return np.column_stack((pairs & 15, pairs >> 4)).ravel()


def folded(points: list[bytes]) -> np.ndarray:
    """Points as rows over the fewest groups that any of them has: groups nest, so counts add up."""
    rows = [_counts(x) for x in points]
    groups = min(len(x) for x in rows)
    return np.stack([x.reshape(-1, groups).sum(axis=0, dtype=np.int32) for x in rows])


def coarse(points: list[bytes]) -> np.ndarray:
    """Points over LEAST_GROUPS groups in a byte each: a scale, then the counts in its units, rounded up."""
    counts = np.stack([_counts(x).reshape(-1, LEAST_GROUPS).sum(axis=0, dtype=np.int64) for x in points])
    scale = np.maximum(1, -(-counts.max(axis=1) // 255))
    return np.column_stack((scale, -(-counts // scale[:, None]))).astype(np.uint8)


def _from_coarse(column: pa.Array) -> np.ndarray:
    """Counts that are not below the true ones."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), LEAST_GROUPS + 1)
    return raw[:, 1:].astype(np.int32) * raw[:, :1]


# ------------------------------------------------------------------ classes


def _measure(k: int, bits: int):
    """Per text its set's size, fingerprint and point; per task the counts of the order table."""
    names = ["doc_id", "n", "print", "point", "seen", "key"]

    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, np.int64)
        for batch in sliced(each):
            sizes, prints, points = [], [], []
            for _, words in pieces(batch.column(1), SPACED):
                for own in shingle_sets(words, k):
                    sizes.append(len(own))
                    prints.append(fingerprint(own) if len(own) else None)
                    points.append(point_of(own) if len(own) else None)
                    seen += np.bincount(_bucket(own, bits), minlength=len(seen))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary())]
            columns += [pa.array(points, pa.binary()), pa.nulls(len(sizes), pa.binary()), batch.column(2)]
            yield pa.record_batch(columns, names)
        row = [[None], [None], [None], [None], [seen.tobytes()], [None]]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
        yield pa.record_batch([pa.array(x, kind) for x, kind in zip(row, kinds)], names)

    return run


def _bucket(own: np.ndarray, bits: int) -> np.ndarray:
    return (own >> np.uint64(64 - bits)).astype(np.int64)


def _prefixes(sent, k: int, similarity: int, limit: int, sizes: Sizes):
    """Per text the rarest shingles; those in over ``limit`` sets get a salt, the others -1."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        often = sent.value
        prints, shingles, salts = [], [], []
        for _, words in pieces(batch.column(0), SPACED):
            for own in shingle_sets(words, k):
                if not len(own):
                    prints.append(None)
                    shingles.append(None)
                    salts.append(None)
                    continue
                count = often[_bucket(own, sizes.order_bits)]
                rare = np.argsort(count, kind="stable")[: prefix_length(len(own), similarity)]
                mark = fingerprint(own)
                spread = int.from_bytes(mark[:6], "little")
                count = count[rare]
                prints.append(mark)
                shingles.append(own[rare].view(np.int64))
                salts.append(np.where(count > limit, spread % (count // sizes.deal + 1), -1))
        columns = [
            pa.array(prints, pa.binary()),
            pa.array(shingles, pa.list_(pa.int64())),
            pa.array(salts, pa.list_(pa.int64())),
        ]
        return pa.record_batch(columns, ["print", "shingles", "salts"])

    return convert


def _within_reach(run: np.ndarray, n: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Rows that may have a partner in their run: exact for runs that lie within the batch.

    ``run`` numbers the runs of rows; the first and last may go on outside, so all their rows stay.
    """
    size = np.bincount(run - run[0])
    out = (run == run[0]) | (run == run[-1])
    for d in range(1, SHORT_RUN):
        fits = (run[d:] == run[:-d]) & (n[d:] <= far[:-d]) & (n[:-d] <= far[d:])
        out[d:] |= fits
        out[:-d] |= fits
    long = np.flatnonzero(size[run - run[0]] > SHORT_RUN)
    out[long] |= _long_within_reach(run[long], n[long], far[long])
    return out


def _long_within_reach(run: np.ndarray, n: np.ndarray, far: np.ndarray) -> np.ndarray:
    """The same for given rows by sorting: those that a row reaches begin its run, in the order of sizes."""
    out = np.zeros(len(run), bool)
    if not len(run):
        return out
    order = np.lexsort((n, run))
    run, n, far = run[order], n[order], far[order]
    first = np.searchsorted(run, run)
    base = 1 + max(n.max(), far.max(), 0)
    key = (run - run[0]) * base
    upto = np.searchsorted(key + n, key + np.maximum(far, -1), "right")
    here = np.arange(len(run))
    # the largest reach of 1, 2, 4, ... rows from each one on
    most = [far]
    while 2 << len(most) - 1 <= len(far):
        half = 1 << len(most) - 1
        most.append(np.maximum(most[-1][:-half], most[-1][half:]))
    for low, high in ((first, np.minimum(here, upto)), (here + 1, upto)):  # without the row itself
        some = np.flatnonzero(low < high)
        power = np.frexp(high[some] - low[some])[1] - 1
        for k in np.unique(power):
            at = some[power == k]
            widest = np.maximum(most[k][low[at]], most[k][high[at] - (1 << k)])
            out[order[at]] |= widest >= n[at]
    return out


def _shared(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by cell: those of cells with company, with the cell's first class.

    Holds one row back at most. Salted rows are parts of a large cell and always stay. ``short``: all rows of
    the cell are here, at most GATHERED; said of no cell that may go on in another batch.
    """
    names = ["cell", "n", "cls", "centre", "reach", "short"]
    last, centre, single = None, 0, None
    for batch in each:
        if not batch.num_rows:
            continue
        cell, salt, n, cls, far = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        new = np.empty(len(cell), bool)
        new[1:] = (cell[1:] != cell[:-1]) | (salt[1:] != salt[:-1])
        new[0] = last != (cell[0], salt[0])
        start = np.flatnonzero(new)
        run = np.cumsum(new) - 1  # -1: goes on from the batch before
        size = np.bincount(run + 1, minlength=len(start) + 1)[1:]
        company = np.concatenate(([True], size > 1))[run + 1] | (salt >= 0)
        centres = np.concatenate(([centre], cls[start]))[run + 1]
        company &= _within_reach(run, n, far) | (salt >= 0)
        short = (np.append(size, 0)[run] <= GATHERED) & (run > run[0]) & (run < run[-1]) & (salt < 0)
        out = [x[company] for x in (cell, n, cls, centres, far, short)]
        if single is not None and not new[0]:
            out = [np.concatenate(([x], y)) for x, y in zip(single, out)]
        last, centre = (cell[-1], salt[-1]), centres[-1]
        single = None if company[-1] else (cell[-1], n[-1], cls[-1], cls[-1], far[-1], False)
        yield pa.record_batch([*(pa.array(x, pa.int64()) for x in out[:5]), pa.array(out[5].astype(bool))], names)


# ------------------------------------------------------------- verification


def _id_bit(ids: np.ndarray) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - _ID_BITS)).astype(np.int64)


def _bitmap(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << _ID_BITS, bool)
    for batch in each:
        bits[_id_bit(batch.column(0).to_numpy(zero_copy_only=False))] = True
    yield pa.record_batch([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["v"])


def _sent_bits(ids: DataFrame):
    """The fixed-size bitmap of ids, for all workers."""
    bits = added_up(ids.mapInArrow(_bitmap, "v binary"), "v", np.bitwise_or, np.uint8)
    # workers keep what is broadcast as long as they live, so the bits stay packed
    return ids.sparkSession.sparkContext.broadcast(np.zeros(1 << _ID_BITS - 3, np.uint8) if bits is None else bits)


def _maybe(ids: pa.Array, bits: np.ndarray) -> np.ndarray:
    at = _id_bit(ids.fill_null(0).to_numpy(zero_copy_only=False))
    maybe = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return maybe | ids.is_null().to_numpy(zero_copy_only=False)


def _points_of(wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """Sizes and points of the classes ``wanted(cls)``, and of few others: the rest is not dealt out."""
    sent = _sent_bits(wanted)

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(_maybe(batch.column(0), sent.value)))

    return batches(classes.select("cls", "n", "point"), convert, "cls long, n long, point binary")


def _wanted_sets(sent, k: int):
    """The sets of the texts whose id may be wanted (a fixed-size bitmap; null ids always)."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        maybe = _maybe(batch.column(0), sent.value)
        prints, sets = [], []
        for _, words in pieces(batch.column(1).filter(pa.array(maybe)), SPACED):
            for own in shingle_sets(words, k):
                if len(own):
                    prints.append(fingerprint(own))
                    sets.append(own.tobytes())
        return pa.record_batch(
            [pa.array(prints, pa.binary()), pa.array(sets, pa.binary())], ["print", "set"]
        )

    return convert


def _linked(similarity: int):
    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for a, b in zip(batch.column(2), batch.column(3)):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            both = np.sort(np.concatenate((a, b)))
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= similarity * (len(a) + len(b) - common))
        chosen = pa.array(keep, pa.bool_())
        return pa.record_batch([batch.column(i).filter(chosen) for i in (0, 1)], ["a", "b"])

    return convert


def _verified(pairs, texts, classes, scratch, name, k, similarity) -> DataFrame:
    """The pairs of classes that are linked. Only the sets of classes in pairs are made again."""
    wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls")))
    wanted = scratch.keep(
        wanted.distinct().join(classes.select("cls", "print", "doc_id"), "cls"), f"{name}-wanted"
    )
    sent = _sent_bits(wanted.where("doc_id is not null").select("doc_id"))
    sets = batches(texts, _wanted_sets(sent, k), "print binary, set binary")
    sets = sets.groupBy("print").agg(F.first("set").alias("set"))
    sets = scratch.keep(sets.join(wanted.select("print", "cls"), "print").select("cls", "set"), f"{name}-sets")
    rows = (
        pairs.join(sets.select(F.col("cls").alias("b"), F.col("set").alias("set_b")), "b")
        .join(sets.select(F.col("cls").alias("a"), F.col("set").alias("set_a")), "a")
        .select("a", "b", "set_a", "set_b")
    )
    return scratch.keep(batches(rows, _linked(similarity), "a long, b long"), f"{name}-links")


# --------------------------------------------------------------- the R-tree


class Tree:
    """Packed R-trees over the count vectors of blocks, one for each, ``FAN_OUT`` entries a node.

    A level holds for each entry the largest counts, the smallest and largest
    size, the largest reach and the smallest and largest component below it. ``block``
    numbers the block of each row, ascending; nodes end where their block ends.
    """

    def __init__(self, n, comp, far, points, block=None, height: int = 0):
        self.levels = [(points, n, n, far, comp, comp)]
        self.begins: list[np.ndarray] = [np.arange(len(n) + 1)]
        block = np.zeros(len(n), np.int64) if block is None else block
        self.trees = 1 + int((block[1:] != block[:-1]).sum())
        while len(self.levels[-1][0]) > self.trees or len(self.levels) < height:
            new = np.concatenate(([True], block[1:] != block[:-1]))
            start = np.flatnonzero(new)
            place = np.arange(len(block)) - np.repeat(start, np.diff(np.append(start, len(block))))
            at = np.flatnonzero(place % FAN_OUT == 0)
            combine = (np.maximum, np.minimum, np.maximum, np.maximum, np.minimum, np.maximum)
            self.levels.append(
                tuple(f.reduceat(x, at) for f, x in zip(combine, self.levels[-1]))
            )
            self.begins.append(np.append(at, len(block)))
            block = block[at]

    def below(self, level: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(place in entries, entry of the next level)`` for all children."""
        begin = self.begins[level][entries]
        count = self.begins[level][entries + 1] - begin
        parent = np.repeat(np.arange(len(entries)), count)
        return parent, begin[parent] + np.arange(len(parent)) - (np.cumsum(count) - count)[parent]


def _possible(a, b, i: np.ndarray, j: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of entries that may hold a link between different components, and how far
    the bound is above what the link needs."""
    most_a, low_a, high_a, far_a, first_a, last_a = (x[i] if k else None for k, x in enumerate(a))
    most_b, low_b, high_b, far_b, first_b, last_b = (x[j] if k else None for k, x in enumerate(b))
    one = (first_a == last_b) & (last_a == first_b)
    out = (low_a <= far_b) & (low_b <= far_a) & ~one
    out &= (similarity * low_a <= 100 * high_b) & (similarity * low_b <= 100 * high_a)
    at = np.flatnonzero(out)
    bound = np.minimum(a[0][i[at]], b[0][j[at]]).sum(axis=1, dtype=np.int64)
    need = enough(low_a[at], low_b[at], similarity)
    fits = bound >= need
    return at[fits], (bound / need)[fits]


def tree_join(a: Tree, b: Tree, similarity: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of points that may be linked, by descending both trees at once, and their bounds.

    ``same``: the trees are the same, each is joined with itself, and each pair is wanted once.
    Trees have equal height.
    """
    top = len(a.levels) - 1
    most = max(1, COUNTS_AT_ONCE // a.levels[0][0].shape[1])
    roots = np.arange(a.trees)
    todo = [(top, roots, roots)]
    while todo:
        level, i, j = todo.pop()
        if same:
            once = i <= j if level else i < j
            i, j = i[once], j[once]
        if len(i) > most:
            todo += [(level, i[k : k + most], j[k : k + most]) for k in range(0, len(i), most)]
            continue
        fits, bound = _possible(a.levels[level], b.levels[level], i, j, similarity)
        i, j = i[fits], j[fits]
        if not len(i):
            continue
        if not level:
            yield i, j, bound
            continue
        at, i = a.below(level, i)
        again, j = b.below(level, j[at])
        todo.append((level - 1, i[again], j))


def _first_of(keys: np.ndarray, few: int) -> np.ndarray:
    """Which places are among the first ``few`` of their key."""
    order = np.argsort(keys, kind="stable")
    new = np.concatenate(([True], keys[order][1:] != keys[order][:-1]))
    start = np.flatnonzero(new)
    rank = np.arange(len(keys)) - np.repeat(start, np.diff(np.append(start, len(keys))))
    out = np.empty(len(keys), bool)
    out[order] = rank < few
    return out


def _same_groups(a, b):
    """Two blocks with their points over the same groups."""
    groups = min(a[4].shape[1], b[4].shape[1])
    return [(*x[:4], x[4].reshape(len(x[0]), -1, groups).sum(axis=1)) for x in (a, b)]


def _surviving(a, b, similarity: int, same: bool) -> np.ndarray:
    """Rows (smaller class, larger class) of two blocks in different components."""
    return _best(a, b, similarity, same, None)[0]


def _best(a, b, similarity: int, same: bool, few: int | None) -> tuple[np.ndarray, bool]:
    """Surviving rows of two blocks, and whether these are all.

    With ``few``, the best pairs by their bounds: so many for each row and for each two components.
    """
    height = max(len(Tree(*x[1:]).levels) for x in (a, b))
    left = Tree(*a[1:], height=height)
    right = left if same else Tree(*b[1:], height=height)
    found = list(tree_join(left, right, similarity, same))
    if not found:
        return np.zeros((0, 2), np.int64), True
    i, j, bound = (np.concatenate(x) for x in zip(*found))
    total = len(i)
    if few is not None:
        best = np.argsort(-bound, kind="stable")
        i, j = i[best], j[best]
        chosen = _first_of(i, few)
        i, j = i[chosen], j[chosen]
        ends = np.sort(np.column_stack((a[2][i], b[2][j])), axis=1)
        _, key = np.unique(ends, axis=0, return_inverse=True)
        chosen = _first_of(key.ravel(), few)
        i, j = i[chosen], j[chosen]
    return np.column_stack((np.minimum(a[0][i], b[0][j]), np.maximum(a[0][i], b[0][j]))), len(i) == total


def _first_round(similarity: int, most: int, few: int):
    """Rows (cell, n, cls, reach, point) sorted by cell: candidates (a, b), and cells that are not done.

    Each cell is cut into blocks of ``most`` rows. All blocks of a batch are joined with themselves at once.
    """

    def joined(cols: list[np.ndarray], block: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        cell, n, cls, far, points = cols
        tree = Tree(n, cls, far, points, block)
        found = list(tree_join(tree, tree, similarity, True))
        if not found:
            return [np.zeros(0, np.int64)] * 2, np.zeros(0, np.int64)
        i, j, bound = (np.concatenate(x) for x in zip(*found))
        best = np.argsort(-bound, kind="stable")
        i, j = i[best], j[best]
        chosen = _first_of(i, few)
        left = np.unique(cell[i[~chosen]])
        i, j = i[chosen], j[chosen]
        return [np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])], left

    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        last, cut = None, False  # the last cell, and whether a block of it has been joined

        def out(cols: list[np.ndarray], block: np.ndarray, long: np.ndarray) -> pa.RecordBatch:
            (a, b), left = joined(cols, block)
            pairs = np.unique(np.column_stack((a, b)), axis=0)
            return _pairs_and_cells(pairs, np.unique(np.concatenate((left, long))))

        for batch in each:
            for part in range(0, batch.num_rows, 4 * SLICE_ROWS):
                rows = batch.slice(part, 4 * SLICE_ROWS)
                cols = [rows.column(k).to_numpy(zero_copy_only=False) for k in range(4)] + [_from_coarse(rows.column(4))]
                if held:
                    cols = [np.concatenate((x, y)) for x, y in zip(held, cols)]
                cell = cols[0]
                start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
                size = np.diff(np.append(start, len(cell)))
                long = size > most
                long[0] |= cut and cell[0] == last
                # the last cell may go on: only whole blocks of it are joined yet
                upto = int(start[-1] + size[-1] // most * most)
                place = np.arange(len(cell)) - np.repeat(start, size)
                if upto:
                    yield out([x[:upto] for x in cols], np.cumsum(place[:upto] % most == 0), cell[start[long]])
                cut = upto > start[-1] or bool(len(start) == 1 and cut and cell[0] == last)
                last, held = cell[-1], [x[upto:] for x in cols]
        if held and len(held[0]):
            yield out(held, np.zeros(len(held[0]), np.int64), held[0][:1] if cut else held[0][:0])

    return run


def _within_bound(similarity: int):
    """The pairs whose counts leave a link possible."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_a, n_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        bound = [
            int(np.minimum(*folded([a, b])).sum())
            for a, b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())
        ]
        chosen = pa.array(np.array(bound, np.int64) >= enough(n_a, n_b, similarity))
        return pa.record_batch([batch.column(i).filter(chosen) for i in (0, 1)], ["a", "b"])

    return convert


def _plausible(pairs: DataFrame, classes: DataFrame, similarity: int) -> DataFrame:
    points = _points_of(pairs.select(F.explode(F.array("a", "b")).alias("cls")), classes)
    a, b = (
        points.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("point").alias(f"point_{x}"))
        for x in ("a", "b")
    )
    pairs = pairs.distinct()
    rows = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "point_a", "point_b")
    return batches(rows, _within_bound(similarity), "a long, b long")


def _pack(block) -> bytes:
    *columns, points = block
    kind = np.min_scalar_type(points.max(initial=0))
    return b"".join([bytes([kind.itemsize]), *(x.astype(np.int64).tobytes() for x in columns), points.astype(kind).tobytes()])


def _unpack(raw: bytes, m: int):
    columns = np.frombuffer(raw, np.int64, 4 * m, 1).reshape(4, m)
    return (*columns, np.frombuffer(raw, f"u{raw[0]}", offset=1 + 32 * m).reshape(m, -1).astype(np.int32))


_BLOCKS = (
    "a long, b long, cell long, id long, n_min long, n_max long, far_max long, comp_min long, "
    "comp_max long, size long, leads boolean, block binary"
)
_BLOCK_SCHEMA = pa.schema(
    [(x, pa.int64()) for x in "a b cell id n_min n_max far_max comp_min comp_max size".split()]
    + [("leads", pa.bool_()), ("block", pa.binary())]
)


def _blocks(similarity: int, most: int, few: int | None):
    """Of rows sorted by cell: pairs of the cells that fit in a block, these cells if they had more, blocks of the others."""

    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []

        def close(out: list[dict], rows) -> None:
            nonlocal serial
            cell, n, cls, comp, far, total, points = rows
            block = (cls, n, comp, far, folded(list(points)))
            if len(cls) == total[0]:
                found, whole = _best(block, block, similarity, True, few)
                out += [{"a": a, "b": b} for a, b in found.tolist()]
                out += [] if whole else [{"cell": int(cell[0])}]
                return
            serial += 1
            bounds = {
                "cell": cell[0],
                "id": (task << 32) + serial,
                "n_min": n.min(),
                "n_max": n.max(),
                "far_max": far.max(),
                "comp_min": comp.min(),
                "comp_max": comp.max(),
                "size": len(cls),
            }
            out.append(
                {k: int(v) for k, v in bounds.items()}
                | {"leads": bool((far >= n).any()), "block": _pack(block)}
            )

        for batch in sliced(each):
            out: list[dict] = []
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:6]]
            cols.append(np.array(batch.column(6).to_pylist(), object))
            if held:
                cols = [np.concatenate((x, y)) for x, y in zip(held, cols)]
            cell = cols[0]
            cuts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(cell)]
            for begin, end in zip(cuts, cuts[1:]):
                while end - begin > most:
                    close(out, [x[begin : begin + most] for x in cols])
                    begin += most
                if end < len(cell):
                    close(out, [x[begin:end] for x in cols])
                else:
                    held = [x[begin:end] for x in cols]
                if sum(len(x["block"]) for x in out if "block" in x) > HELD_BYTES:
                    yield pa.RecordBatch.from_pylist(out, _BLOCK_SCHEMA)
                    out = []
            yield pa.RecordBatch.from_pylist(out, _BLOCK_SCHEMA)
        if held:
            out = []
            close(out, held)
            yield pa.RecordBatch.from_pylist(out, _BLOCK_SCHEMA)

    return run


def _pairs_and_cells(pairs: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
    """Pairs (a, b), then cells that are not done."""
    none, empty = pa.nulls(len(cells), pa.int64()), pa.nulls(len(pairs), pa.int64())
    columns = [pa.concat_arrays([pa.array(pairs[:, k]), none]) for k in (0, 1)]
    return pa.record_batch([*columns, pa.concat_arrays([empty, pa.array(cells)])], ["a", "b", "cell"])


def _block_pairs(similarity: int, few: int | None):
    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, left = [np.zeros((0, 2), np.int64)], set()
        for row in range(batch.num_rows):
            cell, same, a, b, size_a, size_b = (c[row].as_py() for c in batch.columns)
            a, b = _unpack(a, size_a), _unpack(b, size_b)
            pairs, whole = _best(*_same_groups(a, b), similarity, same, few)
            found.append(pairs)
            left |= set() if whole else {cell}
        return _pairs_and_cells(np.unique(np.concatenate(found), axis=0), np.array(sorted(left), np.int64))

    return convert


def _gathered(cells: DataFrame) -> DataFrame:
    """``cells``, with the large ones that begin with the same class as one.

    Only where the rows of that one, squared, are no more than the squares of the rows before: cells of unlike
    classes stay as they are. A pair that shared a cell shares one still.
    """
    large = cells.groupBy("cell").agg(F.min("cls").alias("centre"), F.count(F.lit(1)).cast("double").alias("total"))
    large = large.where(F.col("total") > GATHERED)
    many = (
        large.groupBy("centre")
        .agg(F.sum(F.col("total") * F.col("total")).alias("before"), F.count(F.lit(1)).alias("n_cells"))
        .where("n_cells > 1")
    )
    large = large.join(many, "centre").select("cell", "centre", "before")
    after = cells.join(large, "cell").select("centre", "before", "cls").distinct()
    after = after.groupBy("centre", "before").agg(F.count(F.lit(1)).cast("double").alias("total"))
    after = after.where("total * total <= before").select("centre")
    moved = large.join(after, "centre").select("cell", "centre")
    return (
        cells.join(moved, "cell", "left")
        .groupBy(F.coalesce("centre", "cell").alias("cell"), "n", "cls")
        .agg(F.max("reach").alias("reach"))
    )


def _first_candidates(cells, classes, scratch, similarity, sizes: Sizes) -> tuple[DataFrame, DataFrame]:
    """Candidates of the first round, and the cells that are not done by them."""
    points = _points_of(cells.select("cls"), classes).select("cls", "point")
    points = batches(points, _coarse, "cls long, point binary")
    rows = cells.join(points, "cls").select("cell", "n", "cls", "reach", "point")
    rows = rows.repartition("cell").sortWithinPartitions("cell", "n", "cls")
    found = scratch.keep(rows.mapInArrow(_first_round(similarity, sizes.block, sizes.few), "a long, b long, cell long"), "first")
    return found.where("a is not null").select("a", "b"), found.where("a is null").select("cell").distinct()


def _coarse(batch: pa.RecordBatch) -> pa.RecordBatch:
    points = coarse(batch.column(1).to_pylist())
    return pa.record_batch([batch.column(0), pa.array([x.tobytes() for x in points], pa.binary())], ["cls", "point"])


def _tree_pairs(cells, classes, comps, compared, scratch, name, similarity, block, few) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs across components, from the trees of the cells that hold several, and the cells that had more.

    The smaller set of a pair must reach its own size (it leads); a cell without
    such a row holds no pair. ``compared`` pairs are left out.
    """
    labelled = cells.join(comps, F.col("cls") == F.col("node"), "left").select(
        "cell", "n", "cls", F.coalesce("component", "cls").alias("comp"), "reach"
    )
    labelled = scratch.keep(labelled, f"{name}-labelled")
    several = (
        labelled.groupBy("cell")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.min("comp").alias("low"),
            F.max("comp").alias("high"),
            F.max(F.col("reach") >= F.col("n")).alias("leads"),
        )
        .where("low < high and leads")
        .select("cell", "total")
    )
    rows = scratch.keep(labelled.join(several, "cell"), f"{name}-mixed")
    rows = rows.join(_points_of(rows.select("cls"), classes).drop("n"), "cls")
    rows = rows.select("cell", "n", "cls", "comp", "reach", "total", "point")
    # rows that lead together, then rows of one component; a large cell is cut up too
    order = ["cell", F.col("reach") >= F.col("n"), "comp", "n", "cls"]
    packed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    packed = scratch.keep(packed.mapInArrow(_blocks(similarity, block, few), _BLOCKS), f"{name}-blocks")
    pairs = packed.where("a is not null").select("a", "b")
    blocks = packed.where("block is not null")
    bounds = blocks.drop("a", "b", "block")
    left = bounds.select("cell", *[F.col(c).alias(f"l_{c}") for c in bounds.columns[1:]])
    meet = left.join(bounds, "cell").where(
        f"l_id <= id and (leads or l_leads) and l_n_min <= far_max and n_min <= l_far_max "
        f"and l_n_min * {similarity} <= n_max * 100 and n_min * {similarity} <= l_n_max * 100 "
        "and not (comp_min = comp_max and l_comp_min = l_comp_max and comp_min = l_comp_min)"
    )
    body = blocks.select("id", "block", "size")
    meet = (
        meet.select("cell", "l_id", "id")
        .join(body.select(*[F.col(c).alias(f"l_{c}") for c in body.columns]), "l_id")
        .join(body, "id")
        .select("cell", (F.col("l_id") == F.col("id")).alias("same"), "l_block", "block", "l_size", "size")
    )
    met = scratch.keep(batches(meet, _block_pairs(similarity, few), "a long, b long, cell long"), f"{name}-met")
    pairs = pairs.unionByName(met.where("a is not null").select("a", "b"))
    found = pairs.distinct().join(compared, ["a", "b"], "left_anti")
    left = packed.where("a is null and block is null").select("cell").unionByName(met.where("a is null").select("cell"))
    return scratch.keep(found, f"{name}-candidates"), left.distinct()


# ------------------------------------------------------------------ the join


def near_duplicates(
    documents: DataFrame,
    shingle: int = SHINGLE,
    similarity: int = SIMILARITY,
    sizes: Sizes = Sizes(),
) -> DataFrame:
    """Per row of ``documents``: ``doc_id, n_shingles, component_id``.

    Two documents are linked if they share ``similarity`` percent of the union of
    their sets; a component is named by the smallest id that links lead to.
    """
    scratch = Scratch(documents.sparkSession, "jaccard")
    texts = documents.select(
        F.col("doc_id").cast("long"), text_column(documents), F.lit(None).cast("binary").alias("key")
    )
    return _named(*_joined(texts, scratch, shingle, similarity, sizes), scratch)


def _joined(texts, scratch, shingle, similarity, sizes) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their sets' fingerprints, the classes of equal sets, and the links between these.

    ``texts`` has an id, a text and a key that comes back with the row. Ids only help to find the
    texts of a class again: unlike texts of one id stay apart here.
    """
    spark = scratch.spark
    measured = scratch.keep(
        texts.mapInArrow(
            _measure(shingle, sizes.order_bits),
            "doc_id long, n long, print binary, point binary, seen binary, key binary",
        ),
        "measured",
    )
    often = added_up(measured.where("seen is not null"), "seen")
    members = measured.where("seen is null").select("doc_id", "n", "print", "key")
    # each set stands with the smallest of its ids
    classes = (
        measured.where("print is not null")
        .groupBy("print")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("point").alias("point"))
        .select(F.monotonically_increasing_id().alias("cls"), "print", "doc_id", "n", "point")
    )
    classes = scratch.keep(classes, "classes")
    if often is None:
        often = np.zeros(1 << sizes.order_bits, np.int64)
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    limit = int(4 * often.mean()) + sizes.deal
    prefixes = batches(
        texts.select("text"),
        _prefixes(spark.sparkContext.broadcast(often), shingle, similarity, limit, sizes),
        "print binary, shingles array<long>, salts array<long>",
    )
    prefixes = (
        prefixes.where("print is not null")
        .groupBy("print")
        .agg(F.first("shingles").alias("shingles"), F.first("salts").alias("salts"))
        .join(classes.select("print", "cls", "n"), "print")
        .select("n", "cls", F.posexplode(F.arrays_zip("shingles", "salts")).alias("place", "x"))
        .select(
            F.col("x.shingles").alias("cell"),
            F.col("x.salts").alias("salt"),
            "n",
            "cls",
            reach(F.col("n"), F.col("place"), similarity).alias("reach"),
        )
    )
    deal = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(shingles / 5 / 4e6))
    shared = (
        prefixes.repartition(deal, "cell", "salt")
        .sortWithinPartitions("cell", "salt", "cls")
        .mapInArrow(_shared, "cell long, n long, cls long, centre long, reach long, short boolean")
    )
    # a pair stays within reach of each other: of a class's places the one that reaches farthest counts
    cells = scratch.keep(
        shared.groupBy(F.when(F.col("short"), F.col("centre")).otherwise(F.col("cell")).alias("cell"), "n", "cls")
        .agg(F.max("reach").alias("reach")),
        "cells",
    )
    cells = scratch.keep(_gathered(cells), "gathered")
    candidates, open_cells = _first_candidates(cells, classes, scratch, similarity, sizes)
    compared = scratch.keep(_plausible(candidates, classes, similarity), "first-plausible")
    links = _verified(compared, texts, classes, scratch, "first", shingle, similarity)
    comps = components(links, scratch, "first-components")
    cells = scratch.keep(cells.join(open_cells, "cell"), "open")
    # a few links of two components make them one, which settles most of their other pairs
    for name, few in (("second", 2 * sizes.few), ("third", None)):
        more, left = _tree_pairs(cells, classes, comps, compared, scratch, name, similarity, sizes.block, few)
        # blocks count in the groups of their smallest set, pairs in all that both have
        likely = scratch.keep(_plausible(more, classes, similarity), f"{name}-plausible")
        links = links.unionByName(_verified(likely, texts, classes, scratch, name, shingle, similarity))
        if few is not None:
            compared = compared.unionByName(more)
            comps = components(links, scratch, f"{name}-components")
            cells = scratch.keep(cells.join(left, "cell"), f"{name}-open")
    return members, classes, links


def _named(members: DataFrame, classes: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Components of classes, then of ids: an id that stands in several classes joins them."""
    of_id = members.where("print is not null and doc_id is not null").select("doc_id", "print").distinct()
    twice = of_id.groupBy("doc_id").agg(F.count(F.lit(1)).alias("x")).where("x > 1").select("doc_id")
    same = (
        of_id.join(twice, "doc_id")
        .join(classes.select("print", "cls"), "print")
        .select("doc_id", F.col("cls").alias("b"))
    )
    same = same.join(same.groupBy("doc_id").agg(F.min("b").alias("a")), "doc_id").select("a", "b")
    comps = components(links.unionByName(same), scratch, "components")
    comps = scratch.keep(
        classes.join(comps, F.col("cls") == F.col("node"), "left").select(
            "print", "doc_id", F.coalesce("component", "cls").alias("comp")
        ),
        "named",
    )
    smallest = comps.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of_class = comps.join(smallest, "comp").select("print", "component_id")
    return members.join(of_class, "print", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def keep_one(
    documents: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, sizes: Sizes = Sizes()
) -> DataFrame:
    """One row of each group stays: the one with the smallest id (null last), then MD5 of the text.

    Groups are those of texts, so repeated rows and rows without an id are members like others,
    and rows of one id whose texts are not linked belong to groups of their own. Rows
    without a shingle are in no group; all of them stay. Of equal texts of one id the least
    row by all columns stays. Texts are told apart by 128 bits.
    """
    scratch = Scratch(documents.sparkSession, "kept")
    whole = text_column(documents)
    text = F.unhex(F.md5(whole))
    # a text's hashes stand in for the id: rows of one text are one node
    texts = documents.select(F.xxhash64(whole).alias("doc_id"), whole.alias("text"), text.alias("key"))
    members, classes, links = _joined(texts, scratch, shingle, similarity, sizes)
    comps = components(links, scratch, "components")
    comps = classes.join(comps, F.col("cls") == F.col("node"), "left")
    of_text = (
        members.where("print is not null")
        .select("key", "print")
        .distinct()
        .join(comps.select("print", F.coalesce("component", "cls").alias("comp")), "print")
        .select("key", "comp")
    )
    doc_id = F.col("doc_id").cast("long")
    first = documents.select(text.alias("key"), F.struct(doc_id.isNull().alias("none"), doc_id.alias("id")).alias("who"))
    first = first.groupBy("key").agg(F.min("who").alias("who"), F.count(F.lit(1)).alias("n"))
    each = scratch.keep(of_text.join(first, "key"), "texts")
    best = (
        each.groupBy("comp")
        .agg(F.min(F.struct("who", "key")).alias("best"), F.sum("n").alias("n"))
        .where("n > 1")
        .select("comp", "best")
    )
    chosen = each.join(best, "comp").select(
        F.col("key").alias("of"), (F.col("key") == F.col("best.key")).alias("stays"), F.col("best.who.id").alias("keep")
    )
    chosen = scratch.keep(chosen, "chosen")
    inside = documents.select(F.struct(*[F.col(quote(c)) for c in documents.columns]).alias("doc"), text.alias("key"))
    # one way at every size: whole rows are dealt out once, which both joins read
    of_group = F.col("key") == F.col("of")
    alone = inside.join(chosen.select("of").hint("merge"), of_group, "left_anti").select("doc")
    stay = inside.join(chosen.where("stays").select("of", "keep").hint("merge"), of_group)
    # of several rows of the text and id that stay the least, by all columns
    one = (
        stay.where(F.col("doc.doc_id").cast("long").eqNullSafe(F.col("keep")))
        .groupBy("key")
        .agg(F.min_by("doc", F.to_json("doc", {"ignoreNullFields": "false"})).alias("doc"))
        .select("doc")
    )
    return alone.unionByName(one).select("doc.*")
