"""License notices in texts, by fuzzy search of short phrases.

Texts are lower-cased and cut into words (letters and digits); phrases are looked for
in the words joined by single blanks. A phrase that may differ by k edits is split
into k + 1 parts; where it stands, at least one part stands unchanged (pigeonhole).
Only where an exact search finds a part does the ``regex`` library match the
whole phrase with at most k errors, which verifies the place and gives its span and edits.

The short phrases are looked for in the same way with one edit in all, of one byte, between the first and
last letter of one of their words of at least LONG_WORD letters ("mit licence",
"apche license"). Not searched: edits elsewhere ("mit licens", "fit license"), two
edits ("mit lisence"), phrases of shorter words only ("cc bi").

Exact places are counted with overlaps, on word boundaries. Everything is
one pass over the texts, a batch at a time, without a shuffle.

Defined cases: a null text counts as empty: no words, no places, score 0. Repeated
rows are scanned alike, row by row. Of overlapping places with equally few edits the first
counts. A text of any length is searched whole, by one task, in proportion to its length and
to its notices. An empty table gives no row. Other columns do not matter.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sliced, text_column
from .words import ALPHANUMERIC, pieces

PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices that the fuzzy search knows, and their labels
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under the apache license": "apache",
    "licensed under the mit license": "mit",
    "creative commons attribution": "cc-by",
    "mozilla public license": "mpl",
    "all rights reserved": "all-rights-reserved",
    "spdx license identifier": "spdx",
    "bsd 3 clause license": "bsd",
    "bsd 2 clause license": "bsd",
}
#: Words of a short phrase from so many letters on may have an edit
LONG_WORD = 6
#: One edit for each so many characters of a notice
CHARS_PER_EDIT = 9

SCAN = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label:string,first:long,n:long,edits:int>>"
)
_SPANS = pa.list_(
    pa.struct([("label", pa.string()), ("first", pa.int64()), ("n", pa.int64()), ("edits", pa.int32())])
)


class Notice:
    """A phrase, its parts as search seeds and the pattern that allows its edits."""

    def __init__(self, phrase: str, label: str, chars_per_edit: int):
        raw = phrase.encode()
        self.phrase, self.label, self.length = raw, label, len(raw)
        self.edits = max(1, len(raw) // chars_per_edit)
        n = self.edits + 1
        cuts = [len(raw) * i // n for i in range(n + 1)]
        self.seeds = [(raw[a:b], a) for a, b in zip(cuts, cuts[1:])]
        # best match, on word boundaries of the joined words
        self.pattern = regex.compile(
            rb"(?b)(?<![^ ])(?:" + regex.escape(phrase, literal_spaces=True).encode() + rb"){e<=%d}(?![^ ])" % self.edits
        )

    def places(self, joined: bytes) -> Iterator[tuple[int, int, int]]:
        """``(start, end, edits)`` in bytes, without overlaps, from left to right.

        Each seed's window is as long as one place may be, and is searched by itself. Of places
        that overlap, the one with the fewest edits counts (then the first), and what
        it leaves free of the windows around is searched again.
        """
        windows = []
        for seed, offset in self.seeds:
            at = joined.find(seed)
            while at >= 0:
                begin = max(0, at - offset - self.edits)
                end = min(len(joined) - 1, at - offset + self.length + self.edits)
                # out to the blanks around, so that no word is cut
                windows.append((joined.rfind(b" ", 0, begin + 1), joined.find(b" ", end) + 1))
                at = joined.find(seed, at + 1)
        tried = [self._best(joined, *w) for w in set(windows)]
        heap = [x for x in tried if x]
        heapify(heap)
        taken: list[tuple[int, int]] = []
        found = []
        while heap:
            edits, start, stop, begin, end = heappop(heap)
            at = bisect_left(taken, (begin, 0))
            at -= at > 0 and taken[at - 1][1] > begin
            inside = []
            while at < len(taken) and taken[at][0] < end:
                inside.append(taken[at])
                at += 1
            if not any(a < stop and start < b for a, b in inside):
                found.append((start, stop, edits))
                insort(taken, (start, stop))
                inside = sorted([*inside, (start, stop)])
            # what lies beside the places found may hold another
            for a, b in [*inside, (end, end)]:
                if a - begin >= self.length - self.edits and (x := self._best(joined, begin, a)):
                    heappush(heap, x)
                begin = max(begin, b)
        yield from sorted(found)

    def _best(self, joined: bytes, begin: int, end: int) -> tuple[int, int, int, int, int] | None:
        """``(edits, start, stop, begin, end)`` of the place with the fewest edits between begin and end."""
        m = self.pattern.search(joined, begin, end)
        if not m or not (text := m.group()).strip(b" "):
            return None
        start = m.start() + len(text) - len(text.lstrip(b" "))
        return sum(m.fuzzy_counts), start, m.start() + len(text.rstrip(b" ")), begin, end


class Spelling(Notice):
    """A short phrase; one of its long words may have an edit, but not in its first or last letter."""

    def __init__(self, phrase: str, label: str):
        super().__init__(phrase, label, len(phrase))
        words = [regex.escape(w).encode() for w in phrase.split(" ")]
        ways = []
        for i, w in enumerate(phrase.split(" ")):
            if len(w) >= LONG_WORD:
                # a word that only goes on after this one is another word
                own = rb"(?!%b[^ ])%b(?:%b){e<=1:[^ ]}%b" % (
                    words[i], *(regex.escape(x).encode() for x in (w[0], w[1:-1], w[-1]))
                )
                ways.append(b" ".join([*words[:i], own, *words[i + 1 :]]))
        self.pattern = regex.compile(rb"(?b)(?<![^ ])(?:" + b"|".join(ways) + rb")(?![^ ])") if ways else None


def spellings(phrases: Mapping[str, str], notices: Mapping[str, str]) -> list[Spelling]:
    """Of the phrases that are not searched as notices and have a word long enough."""
    found = [Spelling(p, label) for p, label in phrases.items() if notices.get(p) != label]
    return [x for x in found if x.pattern]


def _exact(joined: bytes, phrase: bytes) -> list[int]:
    """Byte places of a phrase on word boundaries; the text is padded with blanks."""
    padded, out = b" " + phrase + b" ", []
    at = joined.find(padded)
    while at >= 0:
        out.append(at + 1)
        at = joined.find(padded, at + 1)
    return out


def scan_text(joined: bytes, phrases, notices) -> tuple:
    """``(first words of exact places, their labels, fuzzy spans)`` of words joined and padded by blanks."""
    places, base, spans, held = [], set(), [], set()
    blanks = None  # places of all blanks, looked for once and only where something is found

    def blanks_before(at: list[int]) -> list[int]:
        nonlocal blanks
        if blanks is None:
            blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        return np.searchsorted(blanks, at).tolist()

    for phrase, label in phrases:
        if found := _exact(joined, phrase):
            base.add(label)
            places += [n - 1 for n in blanks_before(found)]
    for notice in notices:
        if any(seed in joined for seed, _ in notice.seeds):
            found = list(notice.places(joined))
            firsts = blanks_before([x[0] for x in found]) if found else []
            stops = blanks_before([x[1] for x in found]) if found else []
            for (_, _, edits), before, until in zip(found, firsts, stops):
                first, n = before - 1, until - before + 1
                ends = {(notice.label, first), (notice.label, first + n - 1)}
                if isinstance(notice, Spelling):
                    if ends <= held:  # part of a longer notice
                        continue
                else:
                    held.update((notice.label, first + i) for i in range(n))
                spans.append((notice.label, first, n, edits, 1 - edits / notice.length))
    return places, base, spans


def scan(
    documents: DataFrame,
    phrases: Mapping[str, str] | None = None,
    notices: Mapping[str, str] | None = None,
    chars_per_edit: int = CHARS_PER_EDIT,
) -> DataFrame:
    """Per row the columns of SCAN; ``score`` is 1 for an exact phrase, else the closest notice's share
    of unchanged characters, 0 if there is none."""
    short, known = dict(phrases or PHRASES), dict(notices or NOTICES)
    phrases = [(p.encode(), label) for p, label in short.items()]

    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [Notice(p, label, chars_per_edit) for p, label in known.items()] + spellings(short, known)
        for batch in sliced(each):
            yield _scan_batch(batch, phrases, compiled)

    rows = documents.select(F.col("doc_id").cast("long"), text_column(documents))
    return rows.mapInArrow(run, SCAN)


def _scan_batch(batch: pa.RecordBatch, phrases, notices) -> pa.RecordBatch:
    out: dict[str, list] = defaultdict(list)
    for _, words in pieces(batch.column(1), ALPHANUMERIC):
        # blanks between words only: every other byte becomes one, then runs shrink
        data = words.data.copy()
        data[~ALPHANUMERIC[data]] = 32
        for doc in range(words.texts):
            raw = data[words.offsets[doc] : words.offsets[doc + 1]].tobytes()
            joined = b" " + b" ".join(raw.split()) + b" "
            places, base, spans = scan_text(joined, phrases, notices)
            labels = base | {s[0] for s in spans}
            out["n_words"].append(int(words.counts[doc]))
            out["n_base"].append(len(places))
            out["first_word"].append(min(places, default=None))
            out["last_word"].append(max(places, default=None))
            out["base_labels"].append(",".join(sorted(base)))
            out["labels"].append(",".join(sorted(labels)))
            out["score"].append(1.0 if base else max((s[4] for s in spans), default=0.0))
            out["spans"].append([dict(zip(("label", "first", "n", "edits"), s)) for s in spans])
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPANS]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    return pa.record_batch(
        [batch.column(0), *(pa.array(out[n], k) for n, k in zip(names, kinds))], ["doc_id", *names]
    )
