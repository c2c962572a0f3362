import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tableferry.llm import token_output as T

from .conftest import rows_of

TOKENIZER = Tokenizer.from_file(T.TOKENIZER)
DOCS = [
    (5, "Hello, WORLD!  it's 3.50\n"),
    (-2, None),
    (1, ""),
    (9, "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> İstanbul ΣΑΣ"),
    (3, "é e\u0301 naïve\u00a0non-breaking \u3000 wide 日本語"),
    (3, "again"),
    (None, "no id"),
]


def ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, T.END_ID]


def expected(docs):
    ordered = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out, start = [], 0
    for doc, text in ordered:
        own = ids(text)
        out.append((doc, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    return sorted(out, key=repr)


@given(st.lists(st.one_of(st.none(), st.text()), max_size=5))
def test_chunks_give_the_ids_of_whole_texts(texts):
    tokens, ends = T.Encoder(T.TOKENIZER).encode(pa.array(texts, pa.string()))
    parts = np.split(tokens, ends)[:-1]
    assert [p.tolist() for p in parts] == [ids(t) for t in texts]


def test_words_are_encoded_once_whatever_their_case_and_end_marks():
    encoder = T.Encoder(T.TOKENIZER)
    assert encoder.tails and encoder.lower
    text = "Word word, WORD. word!? wOrD### word"
    tokens, ends = encoder.encode(pa.array([text]))
    assert tokens.tolist() == ids(text) and ends.tolist() == [len(tokens)]
    assert set(encoder.code) == {"word", "", ",", ".", "!?", "###"}


def test_marks_and_capitals_that_matter():
    texts = [
        "<|endoftext|>, <|ENDOFTEXT|>. A<|endoftext|>B! <|endoftext|>B,",
        "H\u0331, h\u0331. H\u0331x, a\u0301; A\u0301: I\u0307, K\u212a, \u0130!",
        "foo', [', foo,' x's# ... .,;:!?#*$%& a.b, 4.5% \x02, a\x02, É, éÉ. ΑΣ, ñ",
    ]
    tokens, ends = T.Encoder(T.TOKENIZER).encode(pa.array(texts))
    assert [x.tolist() for x in np.split(tokens, ends[:-1])] == [ids(x) for x in texts]


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 3)
    encoder = T.Encoder(T.TOKENIZER)
    for text in ("one two three four", "two five six one", "one"):
        tokens, _ = encoder.encode(pa.array([text]))
        assert tokens.tolist() == ids(text)


@pytest.mark.parametrize("texts", [["a b", "\x02", "c \x02 d"], ["x\x02y z"], ["\x02\x02 q"], ["", " "], ["one"]])
def test_chunks_that_hold_the_mark(texts):
    encoder = T.Encoder(T.TOKENIZER)
    assert encoder.mark >= 0
    tokens, ends = encoder.encode(pa.array(texts, pa.string()))
    assert [p.tolist() for p in np.split(tokens, ends)[:-1]] == [ids(t) for t in texts]


def test_read_back(spark, documents, tmp_path):
    docs = DOCS + [(i, f"text number {i} " * (i % 7)) for i in range(20, 120)]
    T.write_tokens(documents(docs), str(tmp_path / "ids"), file_rows=30)
    assert rows_of(T.digests(spark, str(tmp_path / "ids"))) == expected(docs)


def test_files_have_the_asked_layout(spark, documents, tmp_path):
    docs = [(i, "some words that repeat " * 40) for i in range(12_000)]
    T.write_tokens(documents(docs), str(tmp_path / "ids"), row_group_bytes=8 << 10, page_bytes=2 << 10)
    files = sorted((tmp_path / "ids").glob("part-*"))
    meta = pq.ParquetFile(files[0]).metadata
    assert meta.num_row_groups > 1
    columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(3)}
    assert any("DICTIONARY" in e for e in columns["tokens.list.element"].encodings)
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    order = [i for f in files for i in pq.read_table(f, columns=["doc_id"]).column(0).to_pylist()]
    assert order == sorted(order) == list(range(12_000))


def test_metadata_reads_touch_no_tokens(spark, documents, tmp_path):
    T.write_tokens(documents(DOCS), str(tmp_path / "ids"))
    plan = T.file_starts(spark.read.parquet(str(tmp_path / "ids")))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan


def test_other_tokenizers_are_refused_if_blanks_matter(documents, tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError, match="white space"):
        T.write_tokens(documents(DOCS), str(tmp_path / "x"), tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


def test_empty_table(spark, documents, tmp_path):
    T.write_tokens(documents([]), str(tmp_path / "ids"))
    assert T.digests(spark, str(tmp_path / "ids")).collect() == []


def test_one_id_fills_several_files(spark, documents, tmp_path):
    """Null ids on most rows, half of them with one text: ids stay in order, starts whole."""
    docs = [(None, "the same text")] * 3000 + [(None, f"text {i}") for i in range(3000)] + [(i, "x") for i in range(500)]
    T.write_tokens(documents(docs).repartition(12), str(tmp_path / "ids"), file_rows=500)
    files = sorted((tmp_path / "ids").glob("part-*"))
    rows = [pq.ParquetFile(f).metadata.num_rows for f in files]
    assert sum(rows) == 6500 and sum(r > 0 for r in rows) > 8 and max(rows) < 1700
    order = [i for f in files for i in pq.read_table(f, columns=["doc_id"]).column(0).to_pylist()]
    assert order == [None] * 6000 + list(range(500))
    found = T.digests(spark, str(tmp_path / "ids")).orderBy("start").collect()
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    want = {t: len(ids(t)) for _, t in docs}
    assert len(found) == 6500 and at == sum(want[t] for _, t in docs)
    crc = sorted(zlib.crc32(np.array(ids(t), "<u4").tobytes()) for _, t in docs)
    assert sorted(r["ids_crc32"] for r in found) == crc


def test_a_very_long_text(spark, documents, tmp_path):
    docs = [(1, "some words, repeated. " * 100_000), (2, "end")]
    T.write_tokens(documents(docs), str(tmp_path / "ids"))
    assert rows_of(T.digests(spark, str(tmp_path / "ids"))) == expected(docs)
