"""URL filter: listed rules first, then a model of segmented host and path words.

Hosts and paths are cut at everything but letters and digits; each piece is split into
words by Viterbi search under a unigram model (words as often as the pages use
them), so ``cheappills`` reads ``cheap pills``. A multinomial naive Bayes model over
those words scores the urls that no rule decides.

Training labels come from elsewhere than the words that are scored: a listed rule labels its
pages, the contents label the others. A page is unwanted by its contents if symbols or seed words fill
more of its text (html without tags) than a share; a page without text and without a rule has no
label. One host in ``hold_out`` (by a hash) gives no training row; ``held_out_error`` says how the
model does there. With ``labels="seeds"`` an url that holds a seed word itself counts as
unwanted, any other as wanted, as a start where there are no contents. Counts cover all other pages.

Everything is keyed by distinct sites (host, path) and distinct pieces. The candidate
words of a piece are its substrings of up to KEY letters (``length * KEY`` at most, with the
piece's number beside them), joined with the counts of the vocabulary; words longer than
that are found by their first KEY letters and looked for in the piece. No vocabulary or model is
broadcast. Joins from sites to pieces have a small side unique in its key, so Spark can split
pieces that most sites share.

Defined cases: a null url, or one without ``://``, has empty host and path, no
words, and is allowed. Rows are judged one by one, repeated ones alike; a share of exactly the bound is
wanted; without any unwanted url, or any wanted one, to learn from, the model allows all; a score of 0 is allowed. Of equally probable
splits the one whose last word is shortest counts, and so on to the left. Urls of any length are
judged whole, a piece by one task in proportion to its length, and so are contents. An empty table gives no row. Other
columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, batches

#: (verdict, host and path beginning)
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
SEEDS = (
    "adult", "bet", "casino", "cheap", "escort", "farm", "gambling", "loan", "lottery", "malware",
    "phishing", "pills", "poker", "porn", "replica", "sex", "spam", "viagra", "warez", "xxx",
)
#: Letters of a word that pieces are joined with the vocabulary by; runs of letters that are no known
#: word are read as words of up to this length
KEY = 20
#: Places of a piece whose substrings are made at once, and rows of a batch of them
PLACES, ROWS = 4096, 50_000
SMOOTHING = 1.0
#: Contents with more symbols than a tenth of their words, or more seed words than a fiftieth, are unwanted
SYMBOLS, WORDS_A_SYMBOL, WORDS_A_SEED = "[#*$%|]", 10, 50
#: One host in so many is kept from training
HOLD_OUT = 10


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    both = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(url, both, 1), upper, upper.lower())
    return host, F.regexp_extract(url, both, 2)


def matching_rule(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """``(verdict, rule)`` of the longest rule that fits, else null."""
    out = F
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        of, _, begin = rule.partition("/")
        begin = "/" + begin
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(begin)
        out = out.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule")))
    return out


def unwanted_contents(html: Column, seeds: Iterable[str] = SEEDS) -> Column:
    """True or false by the text of a page, null where it has none."""
    text = F.regexp_replace(html.cast("string"), "<[^<>]*>", " ")
    words = F.regexp_count(text, F.lit(r"\S+"))
    symbols = F.regexp_count(text, F.lit(SYMBOLS))
    listed = F.regexp_count(F.lower(text), F.lit(rf"(?<!\p{{L}})(?:{'|'.join(seeds)})(?!\p{{L}})"))
    return F.when(words > 0, (WORDS_A_SYMBOL * symbols > words) | (WORDS_A_SEED * listed > words))


def pieces_of(text: Column) -> Column:
    """Letters-or-digits runs, in lower case; runs of digits read as one word."""
    found = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    return F.transform(found, lambda x: F.when(x.rlike(r"^\p{N}+$"), "0").otherwise(x))


def best_split(piece: str, counts: dict[str, int], total: float) -> list[str]:
    """The split of most probable words; unknown words cost more the longer they are."""
    best = [(0.0, 0)]
    longer = sorted({len(w) for w in counts if len(w) > KEY})
    for end in range(1, len(piece) + 1):
        options = []
        for begin in range(max(0, end - KEY), end):
            word = piece[begin:end]
            n = counts.get(word)
            p = math.log(n / total) if n else math.log(0.1 / total) - 2.3 * len(word)
            options.append((best[begin][0] + p, begin))
        for size in longer:
            if size <= end and (n := counts.get(piece[end - size : end])):
                options.append((best[end - size][0] + math.log(n / total), end - size))
        best.append(max(options))
    out, end = [], len(piece)
    while end:
        begin = best[end][1]
        out.append(piece[begin:end])
        end = begin
    return out[::-1]


def unigrams(pages: DataFrame, extra: Iterable[str] = SEEDS) -> DataFrame:
    """``(word, n)`` over the pages' html; extra words count as often as an average one."""
    found = pages.select(
        F.explode(F.split(F.lower(F.col("html").cast("string")), r"[^\p{L}]+")).alias("word")
    )
    counted = found.where(F.length("word") > 0).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    own = pages.sparkSession.createDataFrame([(w,) for w in extra], "word string")
    own = own.select("word", F.lit(20).cast("long").alias("n"))
    return counted.unionByName(own).groupBy("word").agg(F.sum("n").alias("n"))


def _substrings(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, key)`` for the substrings of up to KEY letters, some places at a time."""
    ids: list[int] = []
    keys: list[str] = []

    def full() -> pa.RecordBatch:
        out = pa.record_batch([pa.array(ids, pa.int64()), pa.array(keys, pa.string())], ["id", "key"])
        ids.clear()
        keys.clear()
        return out

    for batch in each:
        for own, piece in zip(*(c.to_pylist() for c in batch.columns)):
            for at in range(0, len(piece), PLACES):
                here = range(at, min(at + PLACES, len(piece)))
                some = {piece[i:j] for i in here for j in range(i + 1, min(i + KEY, len(piece)) + 1)}
                keys += some
                ids += [own] * len(some)
                if len(keys) >= ROWS:
                    yield full()
    yield full()


def segmented(pieces: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(piece, words)`` for distinct pieces."""
    total = float(vocabulary.agg(F.sum("n")).first()[0] or 1)
    scratch = Scratch(pieces.sparkSession, "pieces")
    pieces = scratch.keep(pieces.select(F.monotonically_increasing_id().alias("id"), "piece"), "pieces")
    keyed = vocabulary.select(F.left("word", F.lit(KEY)).alias("key"), "word", "n")
    known = (
        pieces.mapInArrow(_substrings, "id long, key string")
        .join(keyed, "key")
        .groupBy("id")
        .agg(F.collect_set(F.struct("word", "n")).alias("known"))
    )

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = batch.column(0).to_pylist()
        out = [
            best_split(piece, {x["word"]: x["n"] for x in known or ()}, total)
            for piece, known in zip(own, batch.column(1).to_pylist())
        ]
        return pa.record_batch([batch.column(0), pa.array(out, pa.list_(pa.string()))], ["piece", "words"])

    rows = pieces.join(known, "id", "left").select("piece", "known")
    return batches(rows, convert, "piece string, words array<string>")


def filter_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str]] = RULES,
    seeds: Iterable[str] = SEEDS,
    smoothing: float = SMOOTHING,
    labels: str = "seeds",
    hold_out: int = 0,
) -> DataFrame:
    """Per row ``page_id, host, path, rule, verdict, score, learned, unwanted, held_out``.

    ``score`` is the log-odds that the url is unwanted, ``learned`` the model's own verdict,
    ``unwanted`` the label of ``labels="contents"`` (else null).
    """
    if labels not in ("seeds", "contents"):
        raise ValueError(f"labels must be seeds or contents, not {labels!r}")
    seeds = list(seeds)
    scratch = Scratch(pages.sparkSession, "urls")
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"), "html").withColumn(
        "ruled", matching_rule(F.col("host"), F.col("path"), rules)
    )
    by_contents = F.coalesce(F.col("ruled.verdict") == "block", unwanted_contents(F.col("html"), seeds))
    urls = urls.select(
        "page_id",
        "host",
        "path",
        "ruled",
        (by_contents if labels == "contents" else F.lit(None).cast("boolean")).alias("unwanted"),
        (F.pmod(F.xxhash64("host"), F.lit(hold_out)) == 0 if hold_out else F.lit(False)).alias("held_out"),
    )
    urls = scratch.keep(urls, "pages")
    sites = urls.groupBy("host", "path", "held_out").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("unwanted")).alias("bad"),
        F.count_if(~F.col("unwanted")).alias("good"),
    )
    sites = scratch.keep(sites.select(F.monotonically_increasing_id().alias("site"), "*"), "sites")
    parts = scratch.keep(
        sites.select("site", F.explode(pieces_of(F.concat_ws(" ", "host", "path"))).alias("piece"))
        .groupBy("site", "piece")
        .agg(F.count(F.lit(1)).alias("times")),
        "parts",
    )
    vocabulary = scratch.keep(unigrams(pages, seeds), "vocabulary")
    words = scratch.keep(segmented(parts.select("piece").distinct(), vocabulary), "words")
    training = sites.where("not held_out")
    if labels == "seeds":
        listed = F.arrays_overlap("words", F.array(*[F.lit(s) for s in seeds]).cast("array<string>"))
        seeded = parts.join(words.where(listed).select("piece"), "piece").select("site").distinct()
        training = training.join(seeded.withColumn("listed", F.lit(True)), "site", "left").select(
            "site",
            F.when(F.col("listed"), F.col("pages")).otherwise(0).alias("bad"),
            F.when(F.col("listed"), 0).otherwise(F.col("pages")).alias("good"),
        )
    odds, prior = _fitted(parts, words, training.select("site", "bad", "good"), smoothing, scratch)
    scores = (
        parts.join(odds, "piece").groupBy("site").agg(F.sum(F.col("times") * F.col("odds")).alias("odds"))
    )
    scored = sites.join(scores, "site", "left").select(
        "host", "path", (F.coalesce("odds", F.lit(0.0)) + F.lit(prior)).alias("score")
    )
    empty = (F.col("host") == "") & (F.col("path") == "")
    learned = F.when((F.col("score") > 0) & ~empty, "block").otherwise("allow")
    return (
        urls.join(scored, ["host", "path"])
        .withColumn("learned", learned)
        .select(
            "page_id",
            "host",
            "path",
            F.col("ruled.rule").alias("rule"),
            F.coalesce("ruled.verdict", "learned").alias("verdict"),
            "score",
            "learned",
            "unwanted",
            "held_out",
        )
    )


def _fitted(
    parts: DataFrame, words: DataFrame, training: DataFrame, smoothing: float, scratch: Scratch
) -> tuple[DataFrame, float]:
    """``(piece, odds)`` under naive Bayes and the log-odds of the classes, from sites with ``bad`` and ``good`` pages."""
    labelled = parts.join(training, "site", "left")
    per_piece = labelled.groupBy("piece").agg(
        *[F.sum(F.coalesce(c, F.lit(0)) * F.col("times")).alias(c) for c in ("bad", "good")]
    )
    per_word = (
        per_piece.join(words, "piece")
        .select(F.explode("words").alias("word"), "bad", "good")
        .groupBy("word")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        # a word of no training page says nothing; smoothing alone would side with the smaller class
        .where("bad + good > 0")
    )
    per_word = scratch.keep(per_word, "per-word")
    sums = per_word.agg(F.count(F.lit(1)), F.sum("bad"), F.sum("good")).first()
    n, bad, good = (float(x or 0) for x in sums)
    bad_pages, good_pages = (float(x or 0) for x in training.agg(F.sum("bad"), F.sum("good")).first())
    usable = bad_pages > 0 and good_pages > 0
    odds = F.log((F.col("bad") + smoothing) / (bad + smoothing * n)) - F.log(
        (F.col("good") + smoothing) / (good + smoothing * n)
    )
    per_word = per_word.select("word", (odds if usable else F.lit(0.0)).alias("odds"))
    odds_of = (
        words.select("piece", F.explode("words").alias("word"))
        .join(per_word, "word")
        .groupBy("piece")
        .agg(F.sum("odds").alias("odds"))
    )
    return odds_of, math.log(bad_pages / good_pages) if usable else -1.0


def held_out_error(found: DataFrame) -> DataFrame:
    """One row a value of ``held_out``: labelled pages, unwanted ones, and those the model gets wrong."""
    wrong = (F.col("learned") == "block") != F.col("unwanted")
    return (
        found.where("unwanted is not null")
        .groupBy("held_out")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.count_if(F.col("unwanted")).alias("n_unwanted"),
            F.count_if(F.col("unwanted") & (F.col("learned") == "allow")).alias("missed"),
            F.count_if(~F.col("unwanted") & (F.col("learned") == "block")).alias("blocked_wanted"),
            F.avg(wrong.cast("double")).alias("error"),
        )
    )
