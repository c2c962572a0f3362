import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableferry.llm import components as C
from tableferry.llm import jaccard_join as J
from tableferry.llm.shared import Scratch

from .conftest import rows_of
from .plain import components, near_duplicates


def corpus(seed, groups=12, alphabet=400):
    """Groups of near copies around the threshold, copies, short and empty texts, a shared passage."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(alphabet)]
    passage = rng.choices(words, k=60)
    docs = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.choice([6, 20, 60, 150, 400]))
        for _ in range(rng.choice([1, 2, 3, 9])):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 25)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randrange(2)] = rng.choices(words, k=rng.randrange(3))
            if rng.random() < 0.3:
                copy += passage
            docs.append(" ".join(copy))
        base = base[: rng.randrange(len(base))] + rng.choices(words, k=4)
        docs.append("\t".join(base))
    docs += docs[:5] + [docs[0].upper(), "a b", "A  b", "", None, "  \n", "a", "b"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", range(2))
def test_components_match_all_pairs(documents, seed):
    docs = corpus(seed)
    assert rows_of(J.near_duplicates(documents(docs))) == sorted(near_duplicates(docs), key=repr)


def test_small_blocks_and_salted_cells_find_the_same(documents):
    docs = corpus(11)
    sizes = J.Sizes(order_bits=4, deal=2, block=3, few=1)
    assert rows_of(J.near_duplicates(documents(docs), sizes=sizes)) == sorted(near_duplicates(docs), key=repr)


def test_a_chain_is_one_component(documents):
    words = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(words[6 * i : 6 * i + 100])) for i in range(30)]
    found = rows_of(J.near_duplicates(documents(docs)))
    assert found == sorted(near_duplicates(docs), key=repr)
    assert {r[2] for r in found} == {0}


def test_repeated_ids_and_missing_ids(documents):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    docs = [(7, a), (7, b), (3, b), (9, a), (9, a), (None, a), (5, None), (None, None)]
    found = rows_of(J.near_duplicates(documents(docs)))
    assert found == sorted(
        [(7, 36, 3), (7, 36, 3), (3, 36, 3), (9, 36, 3), (9, 36, 3), (None, 36, None), (5, 0, 5), (None, 0, None)],
        key=repr,
    )


def test_one_of_each_group_stays_with_all_columns(documents):
    docs = corpus(2)
    table = documents(docs)
    kept = J.keep_one(table)
    assert kept.columns == table.columns
    stays = {d for d, _, c in near_duplicates(docs) if d == c}
    assert rows_of(kept) == sorted((tuple(r) for r in table.collect() if r["doc_id"] in stays), key=repr)


def test_one_row_of_each_group_stays_with_repeated_and_missing_ids(documents):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    docs = [(7, a), (7, b), (3, b), (3, b), (9, a), (9, a), (None, a), (9, c)]
    docs += [(None, d), (None, d), (None, d + " more"), (5, None), (5, None), (None, ""), (4, "")]
    kept = J.keep_one(documents(docs)).select("doc_id", "text")
    want = [(7, a), (3, b), (9, c), (5, None), (5, None), (None, ""), (4, "")]
    found = [tuple(r) for r in kept.collect()]
    last = [r for r in found if (r[1] or "").startswith("d0 ")]
    assert len(last) == 1 and last[0] in [(None, d), (None, d + " more")]
    assert sorted((r for r in found if r not in last), key=repr) == sorted(want, key=repr)


def test_empty_table(documents):
    assert J.near_duplicates(documents([])).collect() == []


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("sizes", [(300, 300), (5, 290), (40, 3)])
def test_the_trees_leave_over_exactly_what_the_bound_allows(monkeypatch, sizes, same):
    monkeypatch.setattr(J, "COUNTS_AT_ONCE", 1600)
    rng = np.random.default_rng(1)

    centre = rng.poisson(3, 16)

    def block(m, first=0):
        points = rng.poisson(3, (m, 16)).astype(np.int32)
        points[m // 3 : m // 2] = centre + rng.integers(0, 2, (m // 2 - m // 3, 16))
        n = points.sum(axis=1).astype(np.int64)
        order = np.argsort(n, kind="stable")
        return first + rng.permutation(10**6)[:m], n[order], rng.integers(0, 9, m), (n * rng.uniform(0.8, 1.2, m)).astype(int)[order], points[order]

    a = block(sizes[0])
    b = a if same else block(sizes[1], 10**6)
    want = set()
    for i in range(len(a[0])):
        for j in range(i + 1 if same else 0, len(b[0])):
            fits = a[1][i] <= b[3][j] and b[1][j] <= a[3][i] and a[2][i] != b[2][j]
            fits &= 80 * max(a[1][i], b[1][j]) <= 100 * min(a[1][i], b[1][j])
            if fits and 180 * np.minimum(a[4][i], b[4][j]).sum() >= 80 * (a[1][i] + b[1][j]):
                want.add(tuple(sorted((int(a[0][i]), int(b[0][j])))))
    found = [tuple(x) for x in J._surviving(a, b, 80, same).tolist()]
    assert len(found) == len(set(found)) and set(found) == want
    assert sizes != (300, 300) or len(want) > 10


def test_points_nest():
    """Folded to fewer groups a point is the point that those groups give."""
    rng = np.random.default_rng(5)
    short, long = (np.unique(rng.integers(0, 2**63, m).astype(np.uint64)) for m in (50, 40_000))
    rows = J.folded([J.point_of(x) for x in (short, long)])
    assert rows.shape[1] == J.LEAST_GROUPS
    for row, own in zip(rows, (short, long)):
        assert np.array_equal(row, np.bincount((own % np.uint64(rows.shape[1])).astype(int), minlength=rows.shape[1]))
    assert len(J.point_of(long)) == 1 + J.MOST_GROUPS // 2  # half a byte a count
    wide = np.arange(300, dtype=np.uint64) * np.uint64(J.MOST_GROUPS)
    assert J.folded([J.point_of(wide)])[0].tolist() == [300] + [0] * 511


def test_coarse_points_are_not_below_the_true_counts():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 2**63, m).astype(np.uint64)) for m in (3, 90, 9_000, 80_000)]
    points = [J.point_of(x) for x in sets]
    found = J._from_coarse(pa.array([x.tobytes() for x in J.coarse(points)], pa.binary()))
    for row, own in zip(found, sets):
        true = np.bincount((own % np.uint64(J.LEAST_GROUPS)).astype(int), minlength=J.LEAST_GROUPS)
        assert (row >= true).all() and row.sum() <= 1.05 * len(own) + (J.LEAST_GROUPS if len(own) > 80_000 // 8 else 0)


@pytest.mark.parametrize("cut", [7, 50, 1000])
def test_cells_keep_every_row_that_may_have_a_partner(cut):
    """Whatever the batches; of short cells inside one batch only those rows stay."""
    rng = np.random.default_rng(cut)
    cell = np.sort(rng.integers(0, 120, 400))
    n = rng.integers(5, 40, 400)
    far = n + rng.integers(-6, 7, 400)
    salt = np.where(cell % 40 == 0, 3, -1)
    cls = np.arange(400)
    batches = [
        pa.record_batch([pa.array(x[i : i + cut]) for x in (cell, salt, n, cls, far)], list("abcde"))
        for i in range(0, 400, cut)
    ]
    out = pa.Table.from_batches(J._shared(iter(batches))).to_pydict()
    kept = set(out["cls"])
    assert len(out["cls"]) == len(kept)
    for i in range(400):
        company = [j for j in range(400) if j != i and cell[j] == cell[i]]
        partners = [j for j in company if n[i] <= far[j] and n[j] <= far[i]]
        if partners or salt[i] >= 0:
            assert i in kept
        if not company and salt[i] < 0:
            assert i not in kept
        if cut == 1000 and len(company) < J.SHORT_RUN and not partners and salt[i] < 0 and 0 < cell[i] < cell[-1]:
            assert i not in kept
    first = {c: next(i for i in range(400) if cell[i] == c) for c in set(cell.tolist())}
    assert all(k == first[c] for c, k in zip(out["cell"], out["centre"]))


@pytest.mark.parametrize("cut", [7, 50, 1000])
def test_only_whole_short_cells_are_gathered(cut):
    """Whatever the batches, all rows of a cell say the same, and no large, salted or cut cell is short."""
    rng = np.random.default_rng(cut)
    cell = np.sort(np.concatenate((rng.integers(0, 120, 400), np.full(2 * J.GATHERED, 60))))
    m = len(cell)
    salt = np.where(cell % 40 == 3, 3, -1)
    cols = (cell, salt, np.full(m, 9), np.arange(m), np.full(m, 9))
    batches = [
        pa.record_batch([pa.array(x[i : i + cut]) for x in cols], list("abcde")) for i in range(0, m, cut)
    ]
    out = pa.Table.from_batches(J._shared(iter(batches))).to_pydict()
    says = {}
    for c, short in zip(out["cell"], out["short"]):
        says.setdefault(c, set()).add(short)
    for c, said in says.items():
        at = np.flatnonzero(cell == c)
        whole = at[0] // cut == at[-1] // cut
        assert len(said) == 1
        assert said == {False} or (whole and len(at) <= J.GATHERED and c % 40 != 3)
    assert cut == 7 or sum(True in said for said in says.values()) > 50


def test_near_copies_meet_in_few_cells(documents, monkeypatch):
    """Four near copies share some 50 rare shingles, but need not stand in 50 cells."""
    rng = random.Random(3)
    docs = []
    for g in range(20):
        base = [f"g{g}w{i}" for i in range(300)]
        for _ in range(4):
            copy = list(base)
            copy[rng.randrange(300)] = "other"
            docs.append(" ".join(copy))
    docs, kept = list(enumerate(docs)), {}
    keep = Scratch.keep

    def kept_too(self, rows, name):
        kept[name] = keep(self, rows, name)
        return kept[name]

    monkeypatch.setattr(Scratch, "keep", kept_too)
    assert rows_of(J.near_duplicates(documents(docs))) == sorted(near_duplicates(docs), key=repr)
    cells = kept["cells"].count()
    assert 80 <= cells < 10 * len(docs)


@pytest.mark.parametrize("seed", range(4))
def test_rows_of_long_cells_stay_only_with_a_partner(seed):
    """Cells of any length inside a batch: a row stays if a row other than itself is within reach both ways."""
    rng = np.random.default_rng(seed)
    run = np.sort(rng.choice(40, 900, p=rng.dirichlet(np.full(40, 0.3))))
    run = np.cumsum(np.append(0, run[1:] != run[:-1])) - 1  # -1: goes on from the batch before
    n = rng.integers(1, 400, len(run))
    far = n + rng.integers(-40, 15, len(run))
    found = J._within_reach(run, n, far)
    for i in range(len(run)):
        fits = (run == run[i]) & (n <= far[i]) & (n[i] <= far)
        fits[i] = False
        assert found[i] == (fits.any() or run[i] in (run[0], run[-1]))
    inner = (run > run[0]) & (run < run[-1])
    assert found[inner].any() and not found[inner].all()


def _cells(spark, members):
    rows = [(cell, 100, cls, 100 + cell % 5) for cell, classes in members.items() for cls in classes]
    return spark.createDataFrame(rows, "cell long, n long, cls long, reach long")


def test_large_cells_of_one_group_are_gathered(spark):
    """Of 50 cells of one large group a few are left, in which each class stands with its farthest reach."""
    rng = random.Random(4)
    group = range(1000, 1100)
    members = {c: sorted({1000, *rng.sample(group, 70)}) for c in range(50)}
    members |= {c: [1000, *range(100 * c, 100 * c + 60)] for c in range(50, 53)}  # begins alike, unlike otherwise
    members[53] = [7, 8]
    cells = J._gathered(_cells(spark, {c: x for c, x in members.items() if c < 50 or c == 53})).collect()
    assert len({r["cell"] for r in cells}) == 2 and len(cells) == 100 + 2
    assert {r["cls"] for r in cells} == {*group, 7, 8}
    farthest = {cls: max(100 + c % 5 for c, x in members.items() if c < 50 and cls in x) for cls in group}
    assert all(r["reach"] == farthest[r["cls"]] for r in cells if r["cls"] in farthest)
    unlike = {c: x for c, x in members.items() if c >= 50}
    assert rows_of(J._gathered(_cells(spark, unlike))) == rows_of(_cells(spark, unlike))


def _kept(monkeypatch):
    kept, keep = {}, Scratch.keep

    def kept_too(self, rows, name):
        kept[name] = keep(self, rows, name)
        return kept[name]

    monkeypatch.setattr(Scratch, "keep", kept_too)
    return kept


@pytest.mark.parametrize("block", [4, 64])
def test_only_cells_that_had_more_come_to_the_third_round(documents, monkeypatch, block):
    """30 texts of one passage, whose sizes fit and of which only pairs are near copies."""
    rng = random.Random(8)
    passage, docs = [f"p{i}" for i in range(90)], []
    for g in range(15):
        own = passage + [f"g{g}w{i}" for i in range(60)]
        docs += [" ".join(own), " ".join(own[:-1] + ["other"])]
    rng.shuffle(docs)
    docs, kept = list(enumerate(docs)), _kept(monkeypatch)
    wide = J.Sizes(order_bits=1, block=block, few=1000)  # no row has as many candidates
    assert rows_of(J.near_duplicates(documents(docs), sizes=wide)) == sorted(near_duplicates(docs), key=repr)
    assert kept["third-labelled"].count() == 0
    tight = J.Sizes(order_bits=1, block=block, few=1)
    assert rows_of(J.near_duplicates(documents(docs), sizes=tight)) == sorted(near_duplicates(docs), key=repr)


def test_points_are_fetched_for_wanted_classes_alone(spark):
    classes = spark.range(20_000).selectExpr("id AS cls", "id AS n", "binary('x') AS point", "binary('y') AS print")
    found = J._points_of(spark.createDataFrame([(7,), (7,), (9_999,)], "cls long"), classes)
    assert found.columns == ["cls", "n", "point"]
    ids = {r["cls"] for r in found.collect()}
    assert {7, 9_999} <= ids and len(ids) < 20


def test_blocks_come_back():
    rng = np.random.default_rng(0)
    block = (*rng.integers(0, 2**60, (4, 7)), rng.integers(0, 99, (7, 16)).astype(np.int32))
    assert all(np.array_equal(x, y) for x, y in zip(block, J._unpack(J._pack(block), 7)))


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components_of_graphs(spark, shape):
    rng = random.Random(5)
    edges = {
        "chain": [(i, i + 1) for i in range(200)],
        "star": [(0, i) for i in range(1, 200)] + [(500, 501)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
    }[shape]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = dict(rows_of(C.components(frame, Scratch(spark, "test"), "c")))
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert found == components(nodes, [e for e in edges if e[0] != e[1]])


def test_very_long_texts(documents):
    """Near copies of 150,000 words, one of unlike words and one long word."""
    words = [f"w{i * 7919 % 1_000_003}" for i in range(150_000)]
    far = words[:100_000] + [f"v{i}" for i in range(50_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:149_000] + ["other"] * 900)), (3, " ".join(far)), (4, "x" * 3_000_000)]
    assert rows_of(J.near_duplicates(documents(docs))) == sorted(near_duplicates(docs), key=repr)
    assert sorted(r["doc_id"] for r in J.keep_one(documents(docs)).collect()) == [1, 3, 4]


def test_texts_of_one_64_bit_hash_stay_apart(documents, monkeypatch):
    """Only the 128-bit key tells texts apart; the short hash merely helps to find them."""
    docs = [(i, " ".join(f"{x}{j}" for j in range(30))) for i, x in enumerate("abcab")]
    monkeypatch.setattr(J.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    assert sorted(r["doc_id"] for r in J.keep_one(documents(docs)).collect()) == [0, 1, 2]
