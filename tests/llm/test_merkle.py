import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tableferry.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, row string, n int, path string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, i):
    """Siblings from the bottom up, None where a node is alone."""
    return [level[i >> d ^ 1] if (i >> d ^ 1) < len(level) else None for d, level in enumerate(tree[:-1])]


def first_null(value):
    return (value is not None, value if value is not None else 0)


def plain(rows):
    """``(doc_id, leaf, subroot, root, siblings)`` for each row."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = []
    for lang in langs:
        own = sorted(((r[0], plain_leaf(r)) for r in rows if r[2] == lang), key=lambda x: (first_null(x[0]), x[1]))
        trees.append((own, levels([x for _, x in own])))
    crown = levels([t[-1][0] for _, t in trees])
    return [
        (doc, leaf, tree[-1][0], crown[-1][0], way(tree, i) + way(crown, at))
        for at, (own, tree) in enumerate(trees)
        for i, (doc, leaf) in enumerate(own)
    ]


def table_of(n, seed):
    draw = random.Random(seed)
    rows = [
        (draw.choice([i, i, 7, None]), draw.choice(["s", None, ""]), draw.choice(["de", "en", "en", "en", None, "é", ""]),
         draw.choice([i, None]), draw.choice([f"text {i}", "same ü", "", None]))
        for i in range(n)
    ]
    rows += rows[: n // 3]  # repeated rows
    rows += [(1, "s", "alone", 1, "long " * 50_000)]
    return [(*r, "own", 3, "p") for r in rows]


@pytest.mark.parametrize("every, part_rows", [(1, 7), (2, 50), (3, 1000), (8, 20)])
def test_matches_plain_trees(spark, monkeypatch, every, part_rows):
    monkeypatch.setattr(M, "PART_ROWS", part_rows)
    rows = table_of(150, every)
    manifest = M.Manifest(spark.createDataFrame(rows, SCHEMA).repartition(3), every=every)
    found = manifest.proofs().select("key", "leaf", "subroot", "root", "siblings").collect()
    want = plain(rows)
    assert sorted(map(repr, (tuple(r) for r in found))) == sorted(map(repr, want))
    assert manifest.root == want[0][3]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 16, 17, 33])
def test_every_size_of_a_tree(spark, n):
    rows = [(i, "s", "en", 1, f"t{i}", "r", 1, "p") for i in range(n)]
    proofs = M.Manifest(spark.createDataFrame(rows, SCHEMA), every=2).proofs()
    proofs = proofs.withColumn("folded", M.folded(F.col("leaf"), F.col("siblings"), F.col("left")))
    found = sorted(tuple(r) for r in proofs.select("key", "leaf", "subroot", "root", "siblings").collect())
    assert found == sorted(plain(rows))
    assert all(r.folded == r.root for r in proofs.collect())


def test_a_changed_row_does_not_lead_to_the_root(spark):
    rows = [(i, "s", "en" if i % 3 else None, i, f"t{i}", "r", 1, "p") for i in range(40)]
    chars = F.when(F.col("doc_id") == 5, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    shown = M.leaf([chars if c == "n_chars" else F.col(c) for c in M.FIELDS])
    proofs = M.Manifest(spark.createDataFrame(rows, SCHEMA), also={"shown": shown}, every=2).proofs()
    folded = M.folded(F.col("shown"), F.col("siblings"), F.col("left"))
    assert {r.key for r in proofs.where(folded != F.col("root")).collect()} == {5}


def test_one_row_in_a_third_of_the_table_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_ROWS", 100)
    rows = [(-1, "s", "en", 1, "copied", "r", 1, "p")] * 300 + [(i, "s", "en", 1, f"t{i}", "r", 1, "p") for i in range(600)]
    manifest = M.Manifest(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert manifest.trees[0].where("row.key = -1").select("pos").distinct().count() == 300
    held = spark.read.parquet(manifest.scratch.path("leaves")).groupBy("part").count().collect()
    assert max(r["count"] for r in held) < 300
    assert manifest.root == plain(rows)[0][3]


def test_storage_is_the_leaves_and_few_nodes(spark):
    rows = [(i, "s", "en", 1, f"t{i}", "r", 1, "p") for i in range(300)]
    manifest = M.Manifest(spark.createDataFrame(rows, SCHEMA), every=4)
    assert [t.count() for t in manifest.trees] == [300, 19, 2, 1]


def test_empty_table(spark):
    manifest = M.Manifest(spark.createDataFrame([], SCHEMA))
    assert manifest.root is None
    assert manifest.proofs().collect() == []


def test_odd_names(spark):
    rows = spark.createDataFrame([(1, "x", "a"), (2, None, "b")], "`k.e y` int, `t``r` string, `a:b, c` string")
    proofs = M.Manifest(rows, fields=["a:b, c"], tree="t`r", key="k.e y", also={"x:y, z": F.lit(1)}).proofs()
    assert proofs.columns == ["key", "x:y, z", "leaf", "subroot", "root", "siblings", "left"]
    assert {(r.key, r.leaf) for r in proofs.collect()} == {(1, sha("1:a")), (2, sha("1:b"))}
