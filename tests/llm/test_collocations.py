import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tableferry.llm import collocations as C

from .plain import LOWER

SCHEMA = "lang string, text string, phrase string, a string, n int, `range` int, automaton string, k int"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "p", "a", 1, 2, "x", 3) for r in rows], SCHEMA).repartition(parts)


def plain(rows, least, top=2000):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for m in range(1, 6):
                    if i + m <= len(w):
                        counts[lang][tuple(w[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        often = {g: a for g, a in f.items() if a >= least and len(g) > 1}
        rows = []
        for g, a in often.items():
            score, k = min((1000 * a * n[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            longer = [
                b for x, b in often.items()
                if len(x) > len(g) and any(x[i : i + len(g)] == g for i in range(len(x) - len(g) + 1))
            ]
            if not any(b >= a for b in longer):
                rows.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, said, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, said.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(n, seed):
    draw = random.Random(seed)
    words = ["the", "The", "of", "a", "new", "york", "Straße", "é", "x\x01y", "x\x1fz", "\x00", "日本", *[f"w{i}" for i in range(8)]]
    fixed = ["new york city council member", "on the one hand", "the the the the the the the", "a\x0bb c\x0cd"]
    rows = []
    for _ in range(n):
        said = []
        for _ in range(draw.randint(0, 30)):
            said.append(draw.choice(fixed) if draw.random() < 0.2 else draw.choice(words))
            said.append(draw.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! ", "\r\n", "  "]))
        rows.append((draw.choice(["en", "en", "en", "de", None, "", "und"]), "".join(said)))
    return rows + [("en", None), (None, None), ("fr", "..  , !"), ("long", "very long text " * 3000)] + rows[: n // 3]


@pytest.mark.parametrize("least", [2, 6])
@pytest.mark.parametrize("range_bytes, fragment", [(1 << 20, 1 << 19), (3000, 400), (500, 37), (60, 1000)])
def test_matches_plain_counting(spark, monkeypatch, least, range_bytes, fragment):
    monkeypatch.setattr(C, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(C, "FRAGMENT_WORDS", fragment)
    monkeypatch.setattr(C, "MARK_EVERY", 2)
    rows = texts(250, least)
    found = C.collocations(table(spark, rows), least=least).collect()
    assert sorted(tuple(r) for r in found) == plain(rows, least)


def test_ranges_are_many_and_shared_paths_are_whole(spark, monkeypatch):
    monkeypatch.setattr(C, "RANGE_BYTES", 400)
    monkeypatch.setattr(C, "MARK_EVERY", 2)
    rows = [("en", f"the w{i % 40} the w{i % 7} of the") for i in range(600)]
    found = C.Phrases(table(spark, rows), least=10)
    assert len(found.cuts) > 10 and found.opened[(b"en", b"the")] == 1800
    # a word in a third of all places is dealt to many ranges
    assert sum(c[1] == b"the" for c in found.cuts) > 3
    assert [tuple(r) for r in found.sizes.collect()] == [("en", 3600)]


def test_top_and_ties(spark):
    rows = [("en", "a b. c d. e f. g h") for _ in range(5)] + [("en", "a x")]
    found = C.collocations(table(spark, rows), least=5, top=2).collect()
    assert [tuple(r) for r in found] == plain(rows, 5, 2)
    assert [r.phrase for r in found] == ["c d", "e f"]


def test_products_beyond_64_bits(spark):
    a, left, right, n = 10**13, 10**14 - 1, 10**13 + 7, 10**15 + 3
    one = spark.createDataFrame([(a, left, right, n)], "a long, l long, r long, n long")
    assert one.select(C._score(one["n"])).first()[0] == 1000 * a * n // (left * right)


def test_automaton_round_trip_and_union():
    draw = np.random.default_rng(1)
    parts, counts = [], Counter()
    for _ in range(5):
        shard = C._Shard()
        for _ in range(20):
            w = [f"{i}" for i in draw.integers(0, 6, draw.integers(1, 12))]
            shard.add(pa.array([x.encode() for x in w], pa.binary()), np.zeros(len(w), np.int64), len(w))
            for i in range(len(w)):
                for m in range(1, min(5, len(w) - i) + 1):
                    counts[tuple(w[i : i + m])] += 1
        parts.append(C.Automaton.from_bytes(C._built(*shard.ngrams()).to_bytes()))
    for least in (1, 4):
        whole, opened, n = C.united(parts, least, set())
        asked = [*counts, ("0", "none"), ("7",), ("0",) * 5]
        got = C.Automaton.from_bytes(whole.to_bytes()).follow([[x.encode() for x in p] for p in asked])
        assert got.tolist() == [counts[p] if counts[p] >= least else 0 for p in asked]
        assert opened == [] and n == sum(a for g, a in counts.items() if len(g) == 1)


def test_empty_tables(spark):
    assert C.collocations(table(spark, [])).collect() == []
    assert C.collocations(table(spark, [("en", None), (None, ""), ("de", " .")]), least=1).collect() == []
