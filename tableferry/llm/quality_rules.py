"""Quality rules as a short-circuit cascade of column expressions.

Each rule rejects texts by an expression of its own. Rules run one after
another inside one CASE expression, which stops at the first that rejects.
Their order is chosen from a sample of rows from all over the table: per rule the time it
takes for a row and the share it rejects, most rejections per second first. Order changes what
a scan costs, never what it keeps: a text is kept if no rule rejects it.

Where the counts are results themselves (``judge``) they are made once, and the cascade decides
on them; where only the rows matter (``keep_good``) a rule's counts are made when it is reached.

Words are runs of characters other than blanks, tabs and line ends. Everything
is built-in Spark expressions on one row at a time: no shuffle and no Python.
Windows of words are compared by 64-bit hashes within a text.

Defined cases: a null or empty text has no words and fails the rule of fewest
words like any short one. Rows are judged one by one, repeated ones alike. A count exactly
on a rule's bound passes; of rules of equal worth the cheaper one runs first. Texts of any length are judged
whole, one by one. An empty table gives no row, and rules in the order given. All columns pass
through, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, text_column

BLANKS = r"[ \t-\r]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
#: About so many rows of the whole table, chosen by a hash of their place, are the sample for the
#: estimates of cost and selectivity, which only order the rules; without one the given order stays
SAMPLE_ROWS = 500
#: A rule is timed on the sample repeated up to about so many characters, so that the rule and not the
#: start of a job is what counts
TIMED_CHARS = 4_000_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def word_chars(of: Column) -> Column:
    return F.length(F.concat_ws("", of)).cast("long")


def symbols(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long")


def lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^ \t-\r]")
    )


def duplicate_lines(of: Column) -> Column:
    return (F.size(of) - F.size(F.array_distinct(of))).cast("long")


def window_hashes(of: Column) -> Column:
    """A hash of each run of WINDOW words, in order; null where there is none."""
    last = F.size(of) - WINDOW

    def one(i: Column) -> Column:
        return F.xxhash64(*[F.get(of, i + j) for j in range(WINDOW)])

    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), one))


def repeated_words(hashes: Column) -> Column:
    """Words that stand in windows found twice or more.

    Places are sorted by hash, so equal windows are neighbours; the places of
    those, in order again, cover WINDOW words each or up to the next place.
    """
    at = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(of: Column) -> Column:
        def equal(x: Column, k: Column) -> Column:
            return F.get(of, k).getField("h").eqNullSafe(x.getField("h"))

        return F.filter(of, lambda x, k: equal(x, k - F.lit(1)) | equal(x, k + F.lit(1)))

    def covered(places: Column) -> Column:
        def gap(p: Column, k: Column) -> Column:
            following = F.get(places, k + F.lit(1))
            return F.least(F.lit(WINDOW), F.coalesce(following - p, F.lit(WINDOW)))

        return F.aggregate(F.transform(places, gap), F.lit(0), lambda s, g: s + g)

    places = let(at, lambda a: F.array_sort(F.transform(twice(a), lambda x: x.getField("i"))))
    none = hashes.isNull() | (F.size(F.array_distinct(hashes)) == F.size(hashes))
    return F.when(none, F.lit(0)).otherwise(let(places, covered)).cast("long")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def few(n: Column) -> Column:
    return n < 10


def repetitive(n: Column, repeated: Column) -> Column:
    return 100 * repeated > 20 * n


def noisy(n: Column, of_symbols: Column) -> Column:
    return 10 * of_symbols > n


def odd_words(n: Column, chars: Column) -> Column:
    return (chars < 2 * n) | (chars > 15 * n)


def copied_lines(n: Column, duplicates: Column) -> Column:
    return (n >= 4) & (2 * duplicates > n)


#: Rules as functions of the text and its words; true for what they reject. The first two
#: are the base, whose words of fewest and share of repeats are fixed.
Rule = Callable[[Column, Column], Column]
RULES: dict[str, Rule] = {
    "few_words": lambda text, w: few(F.size(w)),
    "repeated_words": lambda text, w: let(
        window_hashes(w), lambda h: repetitive(F.size(w), repeated_words(h))
    ),
    "symbols": lambda text, w: noisy(F.size(w), symbols(text)),
    "word_length": lambda text, w: let(word_chars(w), lambda c: odd_words(F.size(w), c)),
    "duplicate_lines": lambda text, w: let(
        lines(text), lambda x: copied_lines(F.size(x), duplicate_lines(x))
    ),
}
BASE = ("few_words", "repeated_words")
#: The same rules on the columns of ``metrics``: the test and the counts that it takes
ON_COUNTS: dict[str, tuple[Callable[..., Column], tuple[str, ...]]] = {
    "few_words": (few, ("n_words",)),
    "repeated_words": (repetitive, ("n_words", "n_repeat_words")),
    "symbols": (noisy, ("n_words", "n_symbols")),
    "word_length": (odd_words, ("n_words", "word_chars")),
    "duplicate_lines": (copied_lines, ("n_lines", "n_dup_lines")),
}


def on_counts(name: str) -> Column:
    test, counts = ON_COUNTS[name]
    return test(*[F.col(c) for c in counts])


def rejected_by(text: Column, rules: Mapping[str, Rule], order: list[str]) -> Column:
    """The first rule of the order that rejects, or null; later ones are not evaluated."""

    def verdict(w: Column) -> Column:
        chain = F
        for name in order:
            chain = chain.when(rules[name](text, w), F.lit(name))
        return chain.otherwise(F.lit(None).cast("string"))

    return let(words(text), verdict)


def _on(text: Column, rule: Rule) -> Callable[[Column], Column]:
    return lambda w: rule(text, w)


def _sampled(documents: DataFrame, rows: int) -> DataFrame:
    """About so many texts from all over the table, as a written table."""
    one_in = max(1, documents.count() // rows)
    found = documents.select(text_column(documents).alias("text"), F.monotonically_increasing_id().alias("at"))
    found = found.where(F.pmod(F.xxhash64("at"), F.lit(one_in)) == 0).select("text")
    return Scratch(documents.sparkSession, "rules").keep(found, "sample").coalesce(1)


def _seconds(rows: DataFrame, of: Column) -> tuple[float, int]:
    """The quicker of two passes over the rows, and in how many of them ``of`` is true."""
    took = []
    for _ in range(2):
        begin = time.perf_counter()
        n = rows.agg(F.count_if(of)).first()[0]
        took.append(time.perf_counter() - begin)
    return min(took), n


def cascade_order(
    documents: DataFrame, rules: Mapping[str, Rule], sample_rows: int = SAMPLE_ROWS
) -> list[tuple[str, float, float]]:
    """``(rule, seconds a row, share rejected)`` on a sample, most rejections per second first.

    The seconds are those beyond splitting the words, which all rules share. The sample is one task's
    and never comes to the driver.
    """
    sample = _sampled(documents, sample_rows)
    rows, chars = sample.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    if not rows:
        return [(name, float("inf"), 0.0) for name in rules]
    times = max(1, min(TIMED_CHARS // max(1, chars or 0), TIMED_CHARS // (100 * rows)))
    many = sample.select("text", F.explode(F.sequence(F.lit(1), F.lit(times)))).select("text")
    text = F.col("text")
    shared, _ = _seconds(many, F.size(words(text)) < 0)
    found = []
    for name, rule in rules.items():
        took, n = _seconds(many, let(words(text), _on(text, rule)))
        found.append((name, max(took - shared, 1e-4) / (rows * times), n / (rows * times)))
    return sorted(found, key=lambda x: (-x[2] / x[1], x[1]))


def keep_good(
    documents: DataFrame,
    rules: Mapping[str, Rule] | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The rows that no rule rejects, with all their columns."""
    rules = rules or RULES
    order = [name for name, _, _ in cascade_order(documents, rules, sample_rows)]
    return documents.where(rejected_by(F.col("text").cast("string"), rules, order).isNull())


def metrics(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the counts that the rules go by."""
    text = F.col("text")

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"), duplicate_lines(x).alias("n_dup_lines"))

    return (
        documents.select("doc_id", F.col("text").cast("string").alias("text"))
        .select("doc_id", "text", words(text).alias("w"))
        .select("doc_id", "text", "w", window_hashes(F.col("w")).alias("h"))
        .select(
            "doc_id",
            F.size("w").cast("long").alias("n_words"),
            word_chars(F.col("w")).alias("word_chars"),
            symbols(text).alias("n_symbols"),
            let(lines(text), of_lines).alias("of_lines"),
            repeated_words(F.col("h")).alias("n_repeat_words"),
        )
        .select("doc_id", "n_words", "word_chars", "n_symbols", "of_lines.*", "n_repeat_words")
    )


def judge(documents: DataFrame) -> DataFrame:
    """Per row the counts, ``base_failed`` and ``kept``.

    The counts are results, so all are made, once; the cascade, base rules included, reads them.
    """
    chain = F
    for name, _, _ in cascade_order(documents, RULES):
        chain = chain.when(on_counts(name), F.lit(False))
    base = F.lit(False)
    for name in BASE:
        base = base | on_counts(name)
    return metrics(documents).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        chain.otherwise(F.lit(True)).alias("kept"),
    )
