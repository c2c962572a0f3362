import numpy as np
import pyarrow as pa

from tableferry.llm import shared as S


def test_vectors_are_added_up_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(S, "FAN_IN", 3)
    rows = [((np.arange(5, dtype=np.int64) * i).tobytes(),) for i in range(40)] + [(None,)]
    frame = spark.createDataFrame(rows, "v binary")
    assert S.added_up(frame.repartition(11), "v").tolist() == [780 * k for k in range(5)]
    assert S.added_up(frame.where("v is null"), "v") is None
    bits = [(bytes([1 << i, 255 * (i == 2)]),) for i in range(4)]
    found = S.added_up(spark.createDataFrame(bits, "v binary"), "v", np.bitwise_or, np.uint8)
    assert found.tolist() == [15, 255]


def test_kept_tables_are_read_from_the_shared_folder(spark):
    scratch = S.Scratch(spark, "test")
    kept = scratch.keep(spark.range(5), "five")
    assert scratch.folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert kept.count() == 5 and "five" in kept.inputFiles()[0]
    assert S.Scratch(spark, "test").folder != scratch.folder


def test_slices_hold_all_rows(monkeypatch):
    monkeypatch.setattr(S, "SLICE_ROWS", 4)
    each = [pa.record_batch([pa.array(range(n))], ["x"]) for n in (0, 3, 9)]
    found = [b.column(0).to_pylist() for b in S.sliced(each)]
    assert found == [[0, 1, 2], [0, 1, 2, 3], [4, 5, 6, 7], [8]]
