import pytest

from tableferry.llm import line_dedup as L

from .conftest import rows_of
from .plain import without_boilerplate


def pages(n=60):
    rows = []
    for i in range(n):
        host = ["a", "b", None, "tiny"][0 if i < 40 else i % 4]
        text = f"own line {i}\nfooter of {host}\n\n" + ("promo\npromo\n" if i % 9 == 0 else "  \nend")
        rows.append((i, host, text))
    rows += [(100, "a", None), (101, "a", ""), (102, "a", "footer of a"), (102, "a", "footer of a"), (None, "b", "footer of a")]
    return rows


@pytest.fixture
def table(spark):
    def make(rows):
        data = [(*r, "x", "y", 1) for r in rows]
        return spark.createDataFrame(
            data, "doc_id long, source string, text string, drop string, host string, doc int"
        ).repartition(4)

    return make


@pytest.mark.parametrize("limit", [0, 200_000])
@pytest.mark.parametrize("ratio", [0.05, 0.3])
def test_matches_plain_counting(table, monkeypatch, limit, ratio):
    monkeypatch.setattr(L, "BROADCAST_LINES", limit)
    rows = pages()
    found = L.cleaned(table(rows), ratio=ratio).select("doc.doc_id", "text", "n_lines", "n_dropped")
    want = without_boilerplate([(h, t) for _, h, t in rows], ratio)
    assert rows_of(found) == sorted(((r[0], *w) for r, w in zip(rows, want)), key=repr)


def test_columns_pass_through(table):
    docs = table(pages())
    done = L.drop_boilerplate(docs)
    assert done.columns == docs.columns and done.count() == docs.count()
    assert rows_of(done.drop("text")) == rows_of(docs.drop("text"))


def test_empty_table(table):
    assert L.cleaned(table([])).collect() == []


def test_only_built_in_operators(table):
    plan = L.cleaned(table(pages()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("limit", [0, 200_000])
def test_repeated_passages_go_however_large_the_host(table, monkeypatch, limit):
    monkeypatch.setattr(L, "BROADCAST_LINES", limit)

    def said(name, n):
        return " ".join([name] * n)

    on = {"three": 3, "two": 2, "four": 4}
    rows = [(i, "a", f"own {i}\nshort of three" if i < 3 else f"own {i}") for i in range(200)]
    for name, n in on.items():
        rows += [(1000 + len(rows), "a", f"own {name} {i}\n {said(name, 51)}\nend {i}") for i in range(n)]
    rows += [(2000 + i, "a", f"own {i}\n{said('fifty', 50)}") for i in range(4)]
    rows += [(3000 + i, "a", f"copy\n{said('copied', 60)}") for i in range(4)]
    rows += [(4000 + i, h, f"small {h} {i}\n{said('tiny', 51)}") for h, n in [("s", 3), ("t", 2), (None, 3)] for i in range(n)]

    def want(host, text):
        held = {line for h, t in {(h, t) for _, h, t in rows} if h == host for line in set(t.split("\n"))}
        pages = {(h, t) for _, h, t in rows if h == host}
        gone = {x for x in held if len(x.split()) > 50 and sum(x in t.split("\n") for _, t in pages) >= 3}
        return "\n".join(x for x in text.split("\n") if x not in gone)

    found = rows_of(L.drop_boilerplate(table(rows)).select("doc_id", "source", "text"))
    assert found == sorted(((i, h, want(h, t)) for i, h, t in rows), key=repr)
    texts = " ".join(t for _, _, t in found)
    assert "three three" not in texts and "four four" not in texts and "fifty fifty" in texts
    assert "two two" in texts and "copied copied" in texts and "short of three" in texts
    assert rows_of(L.cleaned(table(rows), long_words=None).selectExpr("sum(n_dropped)")) == [(0,)]


def test_a_very_long_text(table):
    """Many lines on one page, and one line of many words; both whole."""
    many = "\n".join(f"line {i}" for i in range(100_000))
    wide = "word " * 200_000
    rows = [(i, "a", f"own {i}\nfooter\nend {i}") for i in range(30)] + [(50, "a", many + "\nfooter"), (51, "a", wide + "\nfooter")]
    found = {r["doc_id"]: r for r in L.cleaned(table(rows)).select("doc.doc_id", "text", "n_lines", "n_dropped").collect()}
    assert found[50]["text"] == many and (found[50]["n_lines"], found[50]["n_dropped"]) == (100_001, 1)
    assert found[51]["text"] == wide and found[3]["text"] == "own 3\nend 3"
