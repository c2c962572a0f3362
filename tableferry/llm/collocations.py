"""Phrase collocation mining with weighted acyclic automata.

Texts are cut into pieces at punctuation and line ends, pieces into words. Each position of a
piece gives the n-gram of up to ``LONGEST`` words that starts there, so the count of any shorter phrase is
the sum of the n-grams that it begins. An automaton holds such sums: a state for each
prefix, its arcs in the order of their words, on each arc the number of n-grams that pass it.

* **Build.** A task sorts the n-grams of its shard, some at a time, and adds them
  state by state into an automaton, which it cuts at fixed places of the n-grams' order.
* **Union.** All automata of one range of prefixes meet in a task: arcs of one state and word become
  one and their weights are summed, from the root down. A state whose sum is below the
  least count is not followed, since nothing below it can be more frequent. The prefixes of a
  cut lie in several ranges; they are kept whatever their weight, and their sums are added up afterwards.
* **Compose.** A candidate's first words are a prefix of its own path. The words after a cut are looked up
  in the automaton of the range that they fall into: requests are sent there and follow the arcs.

The cuts come from a sample of the rows (``SAMPLE_WORDS``), which settles where ranges end and nothing else.
Every count is exact and covers all texts. No task holds more than ``FRAGMENT_WORDS`` words of a
shard, or one range: ``RANGE_BYTES`` of text, or the whole divided by ``MOST_RANGES`` if that is more, which bounds what every task is
told of the cuts. A word that fills a third of all texts is cut by what follows it; n-grams of one
shard are added up before they travel.

Defined cases: a null language is ``und``, a null text is empty; a piece without words gives
nothing; texts of any length are taken in parts that overlap, so no phrase is lost; repeated
rows count each time; equal scores are ranked by count, then by phrase; an empty table has no phrases.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableferry.functions.names import quote

from .shared import Scratch, sliced, text_column
from .words import pieces

LONGEST = 5
LEAST = 100
TOP = 2000
#: Words of a shard that one automaton is built from
FRAGMENT_WORDS = 1 << 19
#: Text of a range, and the most ranges
RANGE_BYTES = 8 << 20
MOST_RANGES = 50_000
MOST_TASKS = 100_000
#: About so many words are sampled for the cuts, of which one n-gram in MARK_EVERY comes to the driver
SAMPLE_WORDS = 4_000_000
MARK_EVERY = 32

#: [.,;:!?\x0A-\x0D]
_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
#: [^\x20\x09]+ of a piece
_WORD = ~_BREAKS
_WORD[[0x20, 0x09]] = False

#: A place in the order of n-grams: a language and words, all as UTF-8
Key = tuple[bytes, ...]


class Automaton:
    """Words in order, and for each depth the arcs into its states, in the order of their paths.

    ``labels`` are places in ``words`` from 1 on, ``weights`` counts, ``kids`` the number of arcs
    out of each state.
    """

    def __init__(self, words: pa.Array, labels: list, weights: list, kids: list):
        self.words, self.labels, self.weights, self.kids = words, labels, weights, kids

    def to_bytes(self) -> bytes:
        arrays = [a for d in range(len(self.labels)) for a in (self.labels[d], self.weights[d], self.kids[d])]
        columns = [pa.array([x.astype(np.int64 if i % 3 == 1 else np.int32)]) for i, x in enumerate(arrays)]
        batch = pa.record_batch([pa.array([self.words.to_pylist()], pa.list_(pa.binary())), *columns], [str(i) for i in range(len(columns) + 1)])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Automaton:
        batch = pa.ipc.open_stream(data).read_next_batch()
        arrays = [batch.column(i).values.to_numpy() for i in range(1, batch.num_columns)]
        return cls(batch.column(0).values, arrays[0::3], arrays[1::3], arrays[2::3])

    def follow(self, paths: list[list[bytes]]) -> np.ndarray:
        """Weight of each path, 0 where there is none."""
        wide = len(self.words) + 1
        depth = np.array([len(p) for p in paths])
        found, state = np.zeros(len(paths), np.int64), np.zeros(len(paths), np.int64)
        parents = np.zeros(len(self.labels[0]), np.int64)
        for d in range(int(depth.max(initial=0))):
            on = np.flatnonzero((depth > d) & (state >= 0))
            asked = pc.index_in(pa.array([paths[i][d] for i in on], pa.binary()), self.words).fill_null(-1).to_numpy()
            keys = parents * wide + self.labels[d]
            want = state[on] * wide + asked + 1
            at = np.minimum(np.searchsorted(keys, want), max(len(keys) - 1, 0))
            hit = (asked >= 0) & (keys[at] == want) if len(keys) else np.zeros(len(on), bool)
            state[on] = np.where(hit, at, -1)
            last = on[hit & (depth[on] == d + 1)]
            found[last] = self.weights[d][state[last]]
            parents = np.repeat(np.arange(len(self.labels[d])), self.kids[d])
        return found


def _sorted_words(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in byte order, and for each word its place from 1 on."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order) + 1, np.int32)
    rank[order.to_numpy()] = np.arange(1, len(order) + 1)
    return coded.dictionary.take(order), rank[coded.indices.to_numpy()]


class _Shard:
    """Words of one language, and the sorted n-grams in them."""

    def __init__(self):
        self.parts: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        self.held = 0
        self.base = 0

    def add(self, words: pa.Array, piece: np.ndarray, starts: int) -> None:
        """Words with their pieces; n-grams start at the first ``starts`` of them, the others only follow."""
        begins = np.zeros(len(words), bool)
        begins[:starts] = True
        self.parts.append((words, piece + self.base, begins))
        self.base += int(piece[-1]) + 2
        self.held += starts

    def ngrams(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Words in order, distinct n-grams in order (0 after an end), and how often each occurs."""
        words, ids = _sorted_words(pa.concat_arrays([p[0] for p in self.parts]))
        piece = np.concatenate([p[1] for p in self.parts])
        begins = np.concatenate([p[2] for p in self.parts])
        grams = np.zeros((len(ids), LONGEST), np.int32)
        grams[:, 0] = ids
        for d in range(1, LONGEST):
            same = piece[d:] == piece[:-d]
            grams[:-d, d][same] = ids[d:][same]
        grams = grams[begins]
        bits = max(1, int(len(words)).bit_length())
        keys, left = [], 0
        for d in range(LONGEST):  # as many words as fit into 64 bits at a time
            if left < bits:
                keys.append(np.zeros(len(grams), np.uint64))
                left = 64
            keys[-1] = (keys[-1] << np.uint64(bits)) | grams[:, d].astype(np.uint64)
            left -= bits
        order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
        grams = grams[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]).any(axis=1)
        at = np.flatnonzero(new)
        self.__init__()
        return words, grams[at], np.diff(np.append(at, len(grams)))


def _built(words: pa.Array, grams: np.ndarray, counts: np.ndarray) -> Automaton:
    """The automaton of sorted n-grams: a state begins where a prefix differs from the one before."""
    n = len(grams)
    total = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    changed = np.zeros(n, bool)
    changed[0] = True
    labels, weights, begins, ends = [], [], [], []
    for d in range(LONGEST):
        changed[1:] |= grams[1:, d] != grams[:-1, d]
        begin = np.flatnonzero(changed & (grams[:, d] != 0))
        turns = np.append(np.flatnonzero(changed), n)
        end = turns[np.searchsorted(turns, begin, "right")]
        labels.append(grams[begin, d])
        weights.append(total[end] - total[begin])
        begins.append(begin)
        ends.append(end)
    kids = [np.searchsorted(begins[d + 1], ends[d]) - np.searchsorted(begins[d + 1], begins[d]) for d in range(LONGEST - 1)]
    kids.append(np.zeros(len(begins[-1]), np.int64))
    used = np.unique(np.concatenate(labels))
    place = np.zeros(len(words) + 1, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    return Automaton(words.take(pa.array(used - 1)), [place[x] for x in labels], weights, kids)


def _key(lang: str, words: pa.Array, gram: np.ndarray) -> Key:
    return (lang.encode(), *(words[int(w) - 1].as_py() for w in gram if w))


def _shards(each: Iterator[pa.RecordBatch], fragment: int) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
    """``(language, words, n-grams, counts)`` for some words at a time."""
    held: dict[str, _Shard] = {}
    for batch in sliced(each):
        langs = batch.column(0).fill_null("und")
        for lang in pc.unique(langs).to_pylist():
            texts = batch.column(1).filter(pc.equal(langs, lang))
            for _, found in pieces(texts, _WORD):
                n = len(found.starts)
                if not n:
                    continue
                size = found.ends - found.starts
                offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                data = np.ascontiguousarray(found.data[_WORD[found.data]])
                words = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                breaks = np.cumsum(_BREAKS[found.data])
                piece = breaks[found.starts] + np.repeat(np.arange(found.texts), found.counts)
                shard = held.setdefault(lang, _Shard())
                for at in range(0, n, fragment):
                    upto = min(n, at + fragment + LONGEST - 1)
                    shard.add(words.slice(at, upto - at), piece[at:upto], min(fragment, n - at))
                    if sum(s.held for s in held.values()) >= fragment:
                        for name, full in held.items():
                            if full.held:
                                yield name, *full.ngrams()
    for name, rest in held.items():
        if rest.held:
            yield name, *rest.ngrams()


def _marks(fragment: int, every: int):
    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, grams, _ in _shards(each, fragment):
            keys = [b" ".join(_key(lang, words, g)) for g in grams[every // 2 :: every]]
            yield pa.record_batch([pa.array(keys, pa.binary())], ["mark"])

    return run


def _cut(fragment: int, cuts: list[Key]):
    """Texts to automata: rows (range, lang, automaton)."""

    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, grams, counts in _shards(each, fragment):
            places, first = [0], bisect_right(cuts, (lang.encode(),))
            ranges = [first]
            for r in range(first, len(cuts)):
                if cuts[r][0] != lang.encode():
                    break
                at = _place(words, grams, cuts[r][1:])
                places.append(at)
                ranges.append(r + 1)
            places.append(len(grams))
            out = [
                (r, _built(words, grams[a:b], counts[a:b]).to_bytes())
                for r, a, b in zip(ranges, places[:-1], places[1:])
                if a < b
            ]
            yield pa.record_batch(
                [
                    pa.array([r for r, _ in out], pa.int32()),
                    pa.array([lang] * len(out), pa.string()),
                    pa.array([b for _, b in out], pa.binary()),
                ],
                ["range", "lang", "automaton"],
            )

    return run


def _place(words: pa.Array, grams: np.ndarray, cut: Key) -> int:
    """How many n-grams stand before a cut."""
    low, high = 0, len(grams)
    for d, word in enumerate(cut):
        column = grams[low:high, d]
        at = _rank(words, word)
        if at > 0:
            low, high = low + int(np.searchsorted(column, at)), low + int(np.searchsorted(column, at, "right"))
        else:  # no such word: all n-grams with lesser ones stand before
            return low + int(np.searchsorted(column, -at))
        if low == high:
            return low
    return low


def _rank(words: pa.Array, word: bytes) -> int:
    """Place of a word from 1 on; if it is missing, that of the next one, negative."""
    low, high = 0, len(words)
    while low < high:
        mid = (low + high) // 2
        if words[mid].as_py() < word:
            low = mid + 1
        else:
            high = mid
    return low + 1 if low < len(words) and words[low].as_py() == word else -(low + 1)


def _grouped(each: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, pa.RecordBatch]]:
    """Rows of one range and language after the other, in parts."""
    for batch in each:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        at = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[at]:
                yield *keys[at], batch.slice(at, i - at)
                at = i


def _open_paths(cuts: list[Key], r: int, lang: str) -> set[Key]:
    """Prefixes that this range shares with others: those of the cuts at its ends."""
    ends = [cuts[i] for i in (r - 1, r) if 0 <= i < len(cuts) and cuts[i][0] == lang.encode()]
    return {cut[1 : k + 1] for cut in ends for k in range(1, len(cut) - 1)}


def united(parts: list[Automaton], least: int, shared: set[Key]) -> tuple[Automaton, list[tuple[Key, int]], int]:
    """The union with summed weights, of states with ``least`` n-grams or a shared path; the shared
    paths with their weights here; all words."""
    words, ids = _sorted_words(pa.concat_arrays([p.words for p in parts]))
    mapped, at = [], 0
    for part in parts:
        mapped.append(np.concatenate(([0], ids[at : at + len(part.words)])))
        at += len(part.words)
    wide = len(words) + 1
    parent = np.zeros(sum(len(p.labels[0]) for p in parts), np.int64)
    paths: dict[int, Key] = {0: ()}  # shared states of the depth above
    labels, weights, kids, opened = [], [], [], []
    total = int(sum(p.weights[0].sum() for p in parts))
    for d in range(LONGEST):
        label = np.concatenate([m[p.labels[d]] for m, p in zip(mapped, parts)])
        weight = np.concatenate([p.weights[d] for p in parts])
        below = np.concatenate([p.kids[d] for p in parts])
        on = np.flatnonzero(parent >= 0)
        keys, which = np.unique(parent[on] * wide + label[on], return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, which, weight[on])
        kept = sums >= least
        next_paths: dict[int, Key] = {}
        for state, path in paths.items():
            for longer in {s for s in shared if len(s) == d + 1 and s[:d] == path}:
                rank = _rank(words, longer[d])
                if rank > 0 and (i := int(np.searchsorted(keys, state * wide + rank))) < len(keys) and keys[i] == state * wide + rank:
                    kept[i] = True
                    next_paths[i] = longer
                    opened.append((longer, int(sums[i])))
        new = np.where(kept, np.cumsum(kept) - 1, -1)
        paths = {int(new[i]): p for i, p in next_paths.items()}
        state = np.full(len(parent), -1, np.int64)
        state[on] = new[which]
        if d:
            kids.append(np.bincount((keys // wide)[kept], minlength=len(labels[-1])))
        labels.append((keys % wide)[kept])
        weights.append(sums[kept])
        parent = np.repeat(state, below)
    kids.append(np.zeros(len(labels[-1]), np.int64))
    used = np.unique(np.concatenate(labels)).astype(np.int64)
    place = np.zeros(wide, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    return Automaton(words.take(pa.array(used - 1)), [place[x] for x in labels], weights, kids), opened, total


_UNION = "range int, lang string, n long, automaton binary, opened array<struct<phrase: binary, a: long>>"


def _union(least: int, cuts: list[Key]):
    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> pa.RecordBatch:
            whole, opened, n = united(held, least, _open_paths(cuts, *key))
            opened = [{"phrase": b" ".join(p), "a": a} for p, a in opened]
            return pa.record_batch(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]]), pa.array([n], pa.int64()), pa.array([whole.to_bytes()], pa.binary()),
                 pa.array([opened], pa.list_(pa.struct([("phrase", pa.binary()), ("a", pa.int64())])))],
                ["range", "lang", "n", "automaton", "opened"],
            )

        for r, lang, rows in _grouped(each):
            if key != (r, lang):
                if held:
                    yield done()
                key, held = (r, lang), []
            held += [Automaton.from_bytes(blob) for blob in rows.column(2).to_pylist()]
        if held:
            yield done()

    return run


_ASKED = "range int, lang string, kind int, automaton binary, phrase string, a long, k int, l long, rest string"


def _requests(
    lang: str, phrases: list[Key], a: list[int], prefix: list[list[int]], cuts: list[Key], opened: dict[Key, int]
) -> pa.RecordBatch:
    """A row for each cut of each phrase, addressed to the range of the rest."""
    rows = []
    for words, count, firsts in zip(phrases, a, prefix):
        said = b" ".join(words)
        for k in range(1, len(words)):
            rest = (lang.encode(), *words[k:])
            # a shared path is whole in no range: its sum is known already
            r = -opened[rest] - 1 if rest in opened else bisect_right(cuts, rest)
            rows.append((r, said, count, k, firsts[k - 1], b" ".join(words[k:])))
    r, said, count, k, first, rest = zip(*rows) if rows else [()] * 6
    n = len(rows)
    return pa.record_batch(
        [pa.array(r, pa.int64()), pa.array([lang] * n, pa.string()), pa.array(said, pa.binary()).cast(pa.string()), pa.array(count, pa.int64()),
         pa.array(k, pa.int32()), pa.array(first, pa.int64()), pa.array(rest, pa.binary()).cast(pa.string())],
        ["to", "lang", "phrase", "a", "k", "l", "rest"],
    )


_REQUEST = "to long, lang string, phrase string, a long, k int, l long, rest string"


def _candidates(least: int, cuts: list[Key], opened: dict[Key, int]):
    """Rows (lang, automaton) to a request for each cut of each of its phrases."""

    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each:
            for lang, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                whole = Automaton.from_bytes(blob)
                words = whole.words.to_pylist()
                paths: list[Key] = [()]
                sums: list[list[int]] = [[]]
                for d in range(LONGEST):
                    parents = np.repeat(np.arange(len(paths)), whole.kids[d - 1]) if d else np.zeros(len(whole.labels[0]), int)
                    below = [paths[p] + (words[w - 1],) for p, w in zip(parents, whole.labels[d])]
                    counts = [opened.get((lang.encode(), *path), int(a)) for path, a in zip(below, whole.weights[d])]
                    sums = [[*sums[p], a] for p, a in zip(parents, counts)]
                    paths = below
                    if d:
                        # shared paths stand in several ranges and come from elsewhere
                        own = [i for i, p in enumerate(paths) if counts[i] >= least and (lang.encode(), *p) not in opened]
                        for at in range(0, len(own), 4096):
                            some = own[at : at + 4096]
                            yield _requests(lang, [paths[i] for i in some], [counts[i] for i in some], [sums[i] for i in some], cuts, opened)

    return run


def _answer(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Requests behind the automaton of their range (kind 0): what it says of the rest."""
    whole = None
    for _, _, rows in _grouped(each):
        kinds = rows.column(2).to_pylist()
        if kinds[0] == 0:
            whole = Automaton.from_bytes(rows.column(3)[0].as_py())
            rows = rows.slice(1)
        if rows.num_rows:
            rests = [r.encode().split(b" ") for r in rows.column(8).to_pylist()]
            yield pa.record_batch(
                [rows.column(1), *(rows.column(i) for i in (4, 5, 6, 7)), pa.array(whole.follow(rests))],
                ["lang", "phrase", "a", "k", "l", "r"],
            )


class Phrases:
    """Counts of all frequent phrases of ``texts (lang, text)``, as automata in the shared folder."""

    def __init__(self, texts: DataFrame, least: int = LEAST, lang: str = "lang", text: str = "text"):
        self.spark, self.least = texts.sparkSession, least
        self.scratch = Scratch(self.spark, "phrases")
        rows = texts.select(
            F.coalesce(F.col(quote(lang)).cast("string"), F.lit("und")).alias("lang"),
            F.coalesce(text_column(texts, text), F.lit("")).alias("text"),
        )
        self.cuts = self._cuts(rows)
        parts = rows.mapInArrow(_cut(FRAGMENT_WORDS, self.cuts), "range int, lang string, automaton binary")
        # several times the ranges, so that few of them meet in one task by chance
        self.tasks = min(4 * (len(self.cuts) + 1), MOST_TASKS)
        parts = parts.repartition(self.tasks, "range", "lang").sortWithinPartitions("range", "lang")
        self.ranges = self.scratch.keep(parts.mapInArrow(_union(least, self.cuts), _UNION), "ranges")
        shared = self.ranges.select("lang", F.explode("opened").alias("o")).groupBy("lang", "o.phrase").agg(F.sum("o.a").alias("a"))
        # at most LONGEST - 1 for each cut
        self.opened: dict[Key, int] = {
            (r["lang"].encode(), *bytes(r["phrase"]).split(b" ")): r["a"] for r in shared.collect()
        }

    def _cuts(self, rows: DataFrame) -> list[Key]:
        """Where ranges end: places of equal distance in a sample of the n-grams."""
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = min(MOST_RANGES, -(-size // RANGE_BYTES))
        if ranges < 2:
            return []
        share = min(1.0, SAMPLE_WORDS * 6 / size)
        found = rows.sample(share, seed=1).mapInArrow(_marks(FRAGMENT_WORDS, MARK_EVERY), "mark binary").distinct()
        marks = sorted(tuple(bytes(r[0]).split(b" ")) for r in found.collect())
        return sorted({marks[len(marks) * i // ranges] for i in range(1, ranges)}) if marks else []

    @property
    def sizes(self) -> DataFrame:
        """``(lang, n)``: words of each language."""
        return self.ranges.groupBy("lang").agg(F.sum("n").alias("n"))

    def cut_counts(self) -> DataFrame:
        """``(lang, phrase, a, k, l, r)`` for each cut of each phrase of two words and more."""
        asked = self.ranges.select("lang", "automaton").mapInArrow(
            _candidates(self.least, self.cuts, self.opened), _REQUEST
        )
        asked = asked.unionByName(self._shared_requests())
        asked = Scratch(self.spark, "requests").keep(asked, "asked")
        known = asked.where("to < 0").select("lang", "phrase", "a", "k", "l", (-F.col("to") - 1).alias("r"))
        null = {f.split()[0]: F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in _ASKED.split(", ")}
        sent = asked.where("to >= 0").select(
            F.col("to").cast("int").alias("range"), "lang", F.lit(1).alias("kind"), null["automaton"], "phrase", "a", "k", "l", "rest"
        )
        there = self.ranges.select(
            "range", "lang", F.lit(0).alias("kind"), "automaton", null["phrase"], null["a"], null["k"], null["l"], null["rest"]
        )
        met = there.unionByName(sent).repartition(self.tasks, "range", "lang").sortWithinPartitions("range", "lang", "kind")
        found = met.mapInArrow(_answer, "lang string, phrase string, a long, k int, l long, r long")
        return found.unionByName(known)

    def _shared_requests(self) -> DataFrame:
        """Requests of the phrases that lie on cuts."""
        whole: dict[str, list[Key]] = {}
        for path, a in self.opened.items():
            if len(path) > 2 and a >= self.least:
                whole.setdefault(path[0].decode(), []).append(path)
        rows = []
        for lang, paths in whole.items():
            counts = [[self.opened[p[: k + 1]] for k in range(1, len(p))] for p in paths]
            asked = _requests(lang, [p[1:] for p in paths], [c[-1] for c in counts], counts, self.cuts, self.opened)
            rows += [tuple(r.values()) for r in asked.to_pylist()]
        return self.spark.createDataFrame(rows, _REQUEST)


def _score(n: Column) -> Column:
    """floor(1000 a n / (l r)), in decimals: products pass 64 bits."""
    a, left, right, n = (F.col(c).cast("decimal(16,0)") if isinstance(c, str) else c.cast("decimal(16,0)") for c in ("a", "l", "r", n))
    above, under = a * n * F.lit(1000).cast("decimal(4,0)"), left * right
    return F.call_function("div", above, under)


def collocations(
    texts: DataFrame, least: int = LEAST, top: int = TOP, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the phrases of each language that hold together best.

    A phrase's score is that of its worst cut (the first of equal ones). One that stands in a longer
    phrase as often as by itself is left out.
    """
    found = Phrases(texts, least, lang, text)
    cuts = found.cut_counts().join(found.sizes, "lang")
    cuts = cuts.withColumn("score", _score(F.col("n")))
    words = F.split("phrase", " ")
    longer = (F.col("k") == 1) & (F.size(words) > 2)
    inside = F.array(F.array_join(F.slice(words, 2, 8), " "), F.array_join(F.slice(words, 1, F.size(words) - 1), " "))
    cover = cuts.where(longer).select("lang", F.explode(inside).alias("phrase"), F.col("a").alias("cover"))
    own = cuts.select("lang", "phrase", "a", "n", F.struct("score", "k", "l", "r").alias("cut"), F.lit(None).cast("long").alias("cover"))
    both = own.unionByName(cover, allowMissingColumns=True)
    whole = both.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.max("n").alias("n"), F.min("cut").alias("cut"), F.max("cover").alias("cover")
    )
    # a part is at least as frequent as what holds it, so one word more tells
    kept = whole.where("a IS NOT NULL AND (cover IS NULL OR cover < a)")
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
