import random

import pytest
from pyspark.sql import functions as F

from tableferry.llm import quality_rules as Q

from .conftest import rows_of
from .plain import quality

TEXTS = [
    None,
    "",
    " \n\t ",
    "one two",
    "one two three four five six seven eight nine ten",
    "a b c d e " * 4,
    "x y z u v w x y z u v a b c d e f g h i j k",
    "###" * 20 + " some words follow these symbols and they are not that many at all",
    "same line here\n" * 6 + "and one other line that is not the same as them",
    "\n".join(["same line"] * 3 + ["w%d v%d u%d t%d" % (i, i, i, i) for i in range(9)]),
    "é日 " * 30,
    "averyveryverylongword" * 3 + " b" * 30,
    " ".join(f"internationalisationword{i}" for i in range(20)),
    "a b c d e f g h a b c d e f g h i",
    "lead\x0bing\x0cchars\x1cstay \x00 here for ten words or so in this text",
]


def random_texts():
    rng = random.Random(9)
    out = []
    for _ in range(150):
        words = [f"w{i}" for i in range(rng.choice([3, 8, 60, 500]))]
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", " # ", "\t"]) for _ in range(rng.randrange(150)))
        out.append(text)
    return out


def test_counts_and_verdicts(documents):
    docs = list(enumerate(TEXTS + random_texts()))
    found = rows_of(Q.judge(documents(docs)))
    assert found == sorted(((i, *quality(t)) for i, t in docs), key=repr)


def test_the_cascade_keeps_the_same_rows(documents):
    docs = list(enumerate(TEXTS + random_texts())) + [(1, TEXTS[4]), (None, TEXTS[4])]
    table = documents(docs)
    kept = Q.keep_good(table)
    assert kept.columns == table.columns
    want = [r for r in table.collect() if quality(r["text"])[6]]
    assert rows_of(kept) == sorted((tuple(r) for r in want), key=repr)


@pytest.mark.parametrize("rows", [1, 50])
def test_order_by_rejections_per_cost(documents, rows):
    found = Q.cascade_order(documents(list(enumerate(TEXTS))), Q.RULES, rows)
    assert {name for name, _, _ in found} == set(Q.RULES)
    rates = [share / seconds for _, seconds, share in found]
    assert rates == sorted(rates, reverse=True)


def test_the_estimates_tell_rules_apart(documents):
    """A dear rule and a cheap one that reject alike: the cheap one comes first, whatever order they are in."""
    dear = lambda text, w: Q.let(Q.window_hashes(w), lambda h: Q.repeated_words(h) >= 0) & (F.size(w) > 30)
    cheap = lambda text, w: F.size(w) > 30
    docs = documents([(i, " ".join(f"w{i}-{j}" for j in range(200 if i % 2 else 20))) for i in range(60)])
    for rules in ({"dear": dear, "cheap": cheap}, {"cheap": cheap, "dear": dear}):
        (first, quick, share), (second, slow, same) = Q.cascade_order(docs, rules)
        assert (first, second) == ("cheap", "dear") and quick < slow and share == same == 0.5


def test_the_sample_comes_from_all_over(documents):
    docs = documents([(i, f"text {i}") for i in range(3000)])
    at = [int(r["text"].split()[1]) for r in Q._sampled(docs, 300).collect()]
    assert 150 < len(at) < 600 and len(set(at)) == len(at)
    assert all(sum(1 for x in at if lo <= x < lo + 1000) > 40 for lo in (0, 1000, 2000))


def test_later_rules_are_not_evaluated(documents):
    """A rule that fails on what an earlier one rejects is never reached by it."""
    rules = {
        "short": lambda text, w: F.size(w) < 3,
        "third": lambda text, w: F.when(F.size(w) < 3, F.raise_error(F.lit("reached"))).otherwise(F.lit(False)),
    }
    docs = documents([(1, "a"), (2, "a b c"), (3, None)])
    verdict = Q.rejected_by(F.col("text"), rules, ["short", "third"])
    assert rows_of(docs.select("doc_id", verdict)) == [(1, "short"), (2, None), (3, "short")]


def test_empty_table(documents):
    assert Q.judge(documents([])).collect() == []
    assert Q.keep_good(documents([])).collect() == []


def test_a_very_long_text(documents):
    long = " ".join(f"w{i % 40_000}" for i in range(100_000))
    assert rows_of(Q.judge(documents([(1, long)]))) == [(1, *quality(long))]
