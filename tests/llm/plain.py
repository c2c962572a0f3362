"""The operators' results by plain code over lists, for small inputs."""

from __future__ import annotations

import hashlib
import re
import string
from collections import Counter
from itertools import combinations

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
ALPHANUMERIC = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")


def alphanumeric(text):
    return ALPHANUMERIC.findall((text or "").translate(LOWER))


def spaced(text):
    return SPACED.findall(text or "")


def contamination(docs, items, window=13, one_in=20):
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for rows (id, text)."""
    windows = []
    for item, text in items:
        w = alphanumeric(text)
        k = min(window, len(w))
        windows += [(item, w[i : i + k]) for i in range(len(w) - k + 1) if k]
    out = []
    for doc, text in docs:
        w = alphanumeric(text)
        hit, found = set(), set()
        for item, x in windows:
            for i in range(len(w) - len(x) + 1):
                if w[i : i + len(x)] == x:
                    hit.update(range(i, i + len(x)))
                    if item is not None:
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        bad = bool(hit) and one_in * len(hit) >= len(w)
        out.append((doc, len(w), len(hit), len(found), digest, bad))
    return out


def shingles(text, k=5):
    w = [x.translate(LOWER) for x in spaced(text)]
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(docs, similarity=80):
    """``doc_id, n_shingles, component_id`` for rows (id, text) with distinct ids."""
    sets = {doc: shingles(text) for doc, text in docs}
    links = [
        (a, b)
        for a, b in combinations(sorted(sets), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])
    ]
    named = components(sets, links)
    return [(doc, len(s), named[doc]) for doc, s in sets.items()]


def quality(text):
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``."""
    w = spaced(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    times = Counter(windows)
    repeat = {i + j for i, x in enumerate(windows) if times[x] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    chars, n, dup = sum(map(len, w)), len(w), len(lines) - len(set(lines))
    base = n < 10 or 100 * len(repeat) > 20 * n
    other = (
        10 * symbols > n or chars < 2 * n or chars > 15 * n or (len(lines) >= 4 and 2 * dup > len(lines))
    )
    return n, chars, symbols, dup, len(repeat), base, not (base or other)


def without_boilerplate(pages, ratio=0.05, min_pages=5):
    """``(kept text, lines, dropped)`` for rows (host, text)."""
    totals = Counter(host for host, _ in pages)
    seen = Counter(
        (host, line)
        for host, text in pages
        for line in set((text or "").split("\n"))
        if SPACED.search(line)
    )
    gone = {k for k, n in seen.items() if n >= min_pages and n > ratio * totals[k[0]]}
    out = []
    for host, text in pages:
        if text is None:
            out.append((None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if (host, x) not in gone]
        out.append(("\n".join(kept), sum(bool(SPACED.search(x)) for x in lines), len(lines) - len(kept)))
    return out
