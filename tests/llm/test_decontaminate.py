import random

import pytest

from tableferry.llm import decontaminate as D

from .conftest import rows_of
from .plain import alphanumeric, contamination

ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron."


def columns(df):
    return df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.fixture
def items(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id long, text string")

    return make


DOCS = [
    (1, "before " + ITEM.upper().replace(" ", " -- ") + " after"),
    (2, ITEM * 2),
    (3, "only " + " ".join(ITEM.split()[:12])),
    (4, "filler " * 300 + ITEM),
    (5, None),
    (6, ""),
    (7, "Short item here, short item here and short item"),
    (8, "no words shared"),
    (8, "no words shared"),
    (8, ITEM),
    (None, ITEM),
    (9, " ".join(ITEM.split()[:10]) + "\n" + " ".join(ITEM.split()[10:])),
]
ITEMS = [(10, ITEM), (9, "short item"), (11, ITEM + " pi"), (12, None), (13, " ,. "), (None, "words shared")]


def test_matches_plain_search(documents, items):
    found = D.scan(documents(DOCS), items(ITEMS))
    assert rows_of(columns(found)) == sorted(contamination(DOCS, ITEMS), key=repr)


@pytest.mark.parametrize("limit", [100, 700, 3000])
def test_a_large_benchmark_goes_out_in_blocks(documents, items, limit):
    found = D.scan(documents(DOCS), items(ITEMS), broadcast_bytes=limit)
    assert rows_of(columns(found)) == sorted(contamination(DOCS, ITEMS), key=repr)


def test_windows_do_not_run_over_text_borders(documents, items):
    half = ITEM.split()
    docs = [(i, " ".join(half[:8] if i % 2 else half[8:])) for i in range(40)]
    assert not columns(D.scan(documents(docs), items([(1, ITEM)]))).where("n_hit > 0").count()


def test_random_passages(documents, items):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(12)]
    benchmark = [(i, " ".join(rng.choices(words, k=rng.choice([2, 3, 5, 14])))) for i in range(25)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(120)))) for i in range(60)]
    docs += [(100 + i, "x " * rng.randrange(9) + t + " y") for i, t in benchmark]
    assert rows_of(columns(D.scan(documents(docs), items(benchmark)))) == sorted(
        contamination(docs, benchmark), key=repr
    )


def test_contaminated_documents_go_and_others_keep_all_columns(documents, items):
    docs = documents(DOCS)
    kept = D.remove_contaminated(docs, items(ITEMS))
    assert kept.columns == docs.columns
    bad = {(d, t) for (d, t), r in zip(DOCS, contamination(DOCS, ITEMS)) if r[5]}
    want = [r for r in docs.collect() if (r["doc_id"], r["text"]) not in bad]
    assert rows_of(kept) == sorted((tuple(r) for r in want), key=repr)
    assert (1, DOCS[0][1]) in bad and (4, DOCS[3][1]) not in bad


def test_spans_are_cut_out(documents, items):
    docs = documents([(1, f"É one, {ITEM} two!"), (2, None), (3, "clean"), (4, ITEM)])
    kept = D.remove_spans(docs, items([(10, ITEM)]))
    assert kept.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert texts == {1: "É one, . two!", 2: None, 3: "clean", 4: "."}


def test_empty_tables(documents, items):
    assert D.scan(documents([]), items(ITEMS)).count() == 0
    found = columns(D.scan(documents(DOCS), items([])))
    assert rows_of(found) == sorted(contamination(DOCS, []), key=repr)


def test_a_very_long_text(documents, items):
    long = "word " * 700_000 + ITEM
    found = D.scan(documents([(1, long), (2, "a")]), items(ITEMS)).where("doc_id = 1").first()
    assert (found["n_words"], found["n_hit"]) == (700_000 + 15, 15)
    assert len(alphanumeric(long)) == found["n_words"]
