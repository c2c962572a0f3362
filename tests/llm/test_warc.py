import gzip
import hashlib
import random

import pytest

from tableferry.llm import warc as W

SCHEMA = "page_id long, url string, html string, first string, digest string, page int, value string"


def pages_of(n, seed=0):
    draw = random.Random(seed)
    shared = ["same page " * 20, "ü" * 60, "short", "", None]
    rows = []
    for i in range(n):
        html = draw.choice([*shared, f"<p>{i}</p>" * draw.randint(1, 400)])
        rows.append((draw.choice([i, i, i, 3, None]), draw.choice([f"http://h/{i}", None, "a b\r\nWARC-Type: x", ""]), html))
    rows += rows[: n // 4]
    noise = "".join(chr(draw.randint(32, 0x2FFF)) for _ in range(700_000))
    rows += [(10**12, "u", noise), (-5, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40)]
    return [(*r, "a", "b", 1, "c") for r in rows]


def wanted(rows):
    first = {}
    for page, _, html, *_ in rows:
        if page is not None:
            first[html] = min(first.get(html, page), page)
    out = []
    for page, _, html, *_ in rows:
        payload = (html or "").encode()
        to = first.get(html) if len(payload) >= 100 else None
        kind = "response" if to is None or to == page else "revisit"
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(), kind, to if kind == "revisit" else None))
    return sorted(out, key=repr)


def read_back(salvage):
    rows = salvage.records.select(
        W.page_number(salvage.records["record_id"]), "payload_bytes", "payload_digest", "record_type",
        W.page_number(salvage.records["refers_to"]),
    )
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("split, groups, heavy", [(1 << 24, 10, 0.001), (1000, 0, 0.2), (40_000, 0, 0.001)])
def test_round_trip(spark, tmp_path, monkeypatch, compress, split, groups, heavy):
    monkeypatch.setattr(W, "BROADCAST_GROUPS", groups)
    monkeypatch.setattr(W, "HEAVY", heavy)
    rows = pages_of(200)
    W.write(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path / "w"), compress=compress)
    salvage = W.Salvage(spark, str(tmp_path / "w"), payloads=True, split_bytes=split)
    assert read_back(salvage) == wanted(rows)
    assert salvage.gaps.collect() == []
    for r in salvage.records.where("record_type = 'response'").select("payload", "payload_digest").collect():
        assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest


def test_files_are_plain_gzip(spark, tmp_path):
    rows = pages_of(30)
    W.write(spark.createDataFrame(rows, SCHEMA).repartition(2), str(tmp_path / "w"))
    W.write(spark.createDataFrame(rows, SCHEMA).repartition(2), str(tmp_path / "p"), compress=False)
    unpacked = [gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "w").glob("part-*"))]
    plain = [f.read_bytes() for f in sorted((tmp_path / "p").glob("part-*"))]
    assert sorted(unpacked) == sorted(plain) and b"".join(plain).count(b"WARC-Record-ID") == len(rows)


def test_a_record_over_16_mb(spark, tmp_path):
    big = "0123456789abcdef" * (1 << 20) + "end"
    rows = [(1, "u", big), (2, "u", big), (3, "u", "x")]
    W.write(spark.createDataFrame([(*r, "a", "b", 1, "c") for r in rows], SCHEMA).coalesce(1), str(tmp_path / "w"))
    salvage = W.Salvage(spark, str(tmp_path / "w"))
    assert read_back(salvage) == wanted(rows) and salvage.gaps.collect() == []


def member(i, digest=True):
    head, http = W._head(i, "u", 300, hashlib.sha256(b"%300d" % i).hexdigest(), None, False, W.DATE)
    if not digest:
        head = b"\r\n".join(x for x in head.split(b"\r\n") if b"Digest" not in x)
    return head + http + b"%300d" % i + b"\r\n\r\n"


def ids(salvage):
    return sorted(r[0] for r in salvage.records.select(W.page_number(salvage.records["record_id"])).collect())


def gaps(salvage):
    return sorted((r.begin, r.until) for r in salvage.gaps.collect())


@pytest.mark.parametrize("split", [1 << 24, 64, 700])
@pytest.mark.parametrize("pack", [gzip.compress, bytes])
def test_later_records_are_recovered(spark, tmp_path, pack, split):
    parts = [pack(member(i)) for i in range(12)]
    starts = [sum(map(len, parts[:i])) for i in range(13)]
    data = bytearray(b"".join(parts))
    for at in (2, 7):  # bytes changed in two records
        for j in range(4):
            data[starts[at] + 60 + j] ^= 0xFF
            data[starts[at] + len(parts[at]) - 60 + j] ^= 0xFF
    # the fifth lacks bytes, junk before the tenth, the last breaks off
    data = data[: starts[6] - 60] + data[starts[6] - 40 : starts[9]] + b"\x1f\x8b\x08 junk WARC/1.0 \r\n" + data[starts[9] : -30]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.warc").write_bytes(data)
    (tmp_path / "f" / "none.warc").write_bytes(b"nothing of the kind")
    (tmp_path / "f" / "empty.warc").write_bytes(b"")
    salvage = W.Salvage(spark, str(tmp_path / "f"), split_bytes=split)
    assert ids(salvage) == [0, 1, 3, 4, 6, 8, 9, 10]
    junk = 20
    assert gaps(salvage) == sorted([
        (0, 19), (starts[2], starts[3]), (starts[5], starts[6] - 20), (starts[7] - 20, starts[8] - 20),
        (starts[9] - 20, starts[9] - 20 + junk), (starts[11] - 20 + junk, len(data)),
    ])
    assert all(r.why for r in salvage.gaps.where("path LIKE '%a.warc'").collect())


@pytest.mark.parametrize("split", [1 << 24, 100, 900])
def test_records_inside_a_payload_are_not_records(spark, tmp_path, split):
    inner = b"".join(member(i) for i in range(100, 110))
    head, http = W._head(1, "u", len(inner), hashlib.sha256(inner).hexdigest(), None, False, W.DATE)
    data = member(0) + head + http + inner + b"\r\n\r\n" + b"junk" + member(2) + member(3)
    (tmp_path / "a.warc").write_bytes(data)
    salvage = W.Salvage(spark, str(tmp_path / "a.warc"), split_bytes=split)
    assert ids(salvage) == [0, 1, 2, 3]
    at = data.index(b"junk")
    assert gaps(salvage) == [(at, at + 4)]


def test_one_member_for_many_records(spark, tmp_path):
    whole = gzip.compress(b"".join(member(i, digest=i != 4) for i in range(300)))
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a").write_bytes(whole + gzip.compress(member(300)))
    assert ids(W.Salvage(spark, str(tmp_path / "w"))) == list(range(301))
    (tmp_path / "w" / "a").write_bytes(whole[: len(whole) // 2] + gzip.compress(member(300)))
    found = W.Salvage(spark, str(tmp_path / "w"))
    kept = ids(found)
    assert kept[-1] == 300 and 4 not in kept and kept[:-1] == [i for i in range(max(kept[:-1]) + 1) if i != 4]
    assert len(kept) > 50 and gaps(found) == [(0, len(whole) // 2)]


def test_long_false_lengths_and_headers(spark, tmp_path):
    false = b"".join(b"WARC/1.0\r\nContent-Length: %d\r\n\r\n" % (10**k) for k in range(18)) * 50
    (tmp_path / "a.warc").write_bytes(false + member(1, digest=False) + b"WARC/1.0\r\nX: " + b"y" * 2_000_000 + member(2))
    assert ids(W.Salvage(spark, str(tmp_path / "a.warc"), split_bytes=50_000)) == [1, 2]


def test_sha1_in_base_32(spark, tmp_path):
    payload = b"%300d" % 5
    import base64

    good = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    for name, digest, kept in [("good", good, [5]), ("bad", good[::-1], []), ("other", "md5:zz", [5])]:
        said = digest if ":" in digest else f"sha1:{digest}"
        record = member(5).replace(b"sha256:" + hashlib.sha256(payload).hexdigest().encode(), said.encode())
        (tmp_path / name).write_bytes(record)
        assert ids(W.Salvage(spark, str(tmp_path / name))) == kept


def test_empty_table(spark, tmp_path):
    W.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    salvage = W.Salvage(spark, str(tmp_path / "w"))
    assert salvage.records.collect() == [] and salvage.gaps.collect() == []
