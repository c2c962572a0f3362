import hashlib
import random

from tableferry.llm import chat_format as C
from tableferry.llm.shared import Scratch

from .conftest import rows_of

HOSTILE = ["</s>", "<s>", "&lt;/s>", "&amp;lt;", "a\n</s><s>user\nb", "", None, "&", "<", "é日\n"]
EVENTS = "conv_id long, message string, seq long, kind string, role string, text string"


def digest(turns):
    """Of (role, text) turns."""
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    role = [r.replace("&", "&amp;").replace("<", "&lt;").replace("\n", "&#10;") for r, _ in turns]
    text = [t.replace("&", "&amp;").replace("<", "&lt;") for _, t in turns]
    chars = sum(8 + len(r) + len(t) for r, t in zip(role, text))
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (said, loss)]
    return len(turns), sha[0], len(loss), sha[1], chars


def test_tables_come_back_from_the_output(spark):
    rng = random.Random(1)
    rows = [
        (rng.choice([1, 2, 3, None]), rng.choice([0, 1, 2, 3, None]), rng.choice(["user", "assistant", "a<&\nb", None]), rng.choice(HOSTILE), "x", "y")
        for _ in range(120)
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string, head string")
    written = Scratch(spark, "chat").keep(C.rendered(C.fold(C.as_events(frame.repartition(5)))), "turns")
    want = []
    for conv in {r[0] for r in rows}:
        own = sorted(
            ((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        )
        want.append((conv, *digest([x[2:] for x in own])))
    assert rows_of(C.digests(written)) == sorted(want, key=repr)


def test_strings_of_conversations(spark):
    rows = [(1, 1, "assistant", "x </s> y"), (1, 0, "user", "hi")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = C.read_back(C.rendered(C.fold(C.as_events(frame))))
    assert rows_of(C.conversations(turns)) == [(1, "<s>user\nhi</s><s>assistant\nx &lt;/s> y</s>")]
    masked = [r for r in turns.collect() if r["loss_text"] is not None]
    assert [(r["loss_text"], r["loss_start"], r["loss_length"]) for r in masked] == [("x </s> y", 13, 11)]


def test_deltas_edits_and_regenerations(spark):
    log = [
        (1, "q", 0, "message", "user", "What?"),
        (1, "a", 1, "message", "assistant", ""),
        (1, "a", 2, "delta", None, "Par"),
        (1, "a", 3, "delta", None, "is"),
        (1, "a", 4, "regenerate", "assistant", "L"),
        (1, "a", 6, "delta", None, "on"),
        (1, "a", 5, "delta", None, "yon? Ly"),
        (1, "q", 7, "edit", None, "Which?"),
        (1, "z", 8, "message", "user", "gone"),
        (1, "z", 9, "delete", None, None),
        (2, "d", 3, "delta", "assistant", "late"),
        (2, "d", 1, "delta", "assistant", "early "),
        (2, "z", 0, "delete", None, None),
        (3, "z", 0, "delete", None, None),
        (3, "z", 1, "delta", "user", "back?"),
    ]
    random.Random(0).shuffle(log)
    found = C.fold(spark.createDataFrame(log, EVENTS).repartition(4))
    assert rows_of(found.select("conv_id", "message", "first", "role", "text")) == [
        (1, "a", 1, "assistant", "Lyon? Lyon"),
        (1, "q", 0, "user", "Which?"),
        (2, "d", 1, "assistant", "early late"),
    ]


def fold_plainly(log):
    """One event after another, for distinct seqs."""
    state = {}
    for conv, message, seq, kind, role, text in sorted(log, key=lambda e: e[2]):
        m = state.setdefault((conv, message), {"first": seq, "role": "", "text": "", "gone": False})
        if kind == "delta":
            m["text"] += text or ""
        else:
            m["text"], m["gone"] = text or "", kind == "delete"
    return sorted(
        ((c, m, v["first"], v["text"]) for (c, m), v in state.items() if not v["gone"]), key=repr
    )


def test_random_logs(spark):
    rng = random.Random(6)
    kinds = ["message", "delta", "delta", "delta", "edit", "regenerate", "delete"]
    seqs = rng.sample(range(5000), 400)
    log = [
        (rng.randrange(4), rng.choice("abcde"), s, rng.choice(kinds), "user", rng.choice(["x", "yy", None, "z "]))
        for s in seqs
    ]
    found = C.fold(spark.createDataFrame(log, EVENTS).repartition(4))
    assert rows_of(found.select("conv_id", "message", "first", "text")) == fold_plainly(log)


def test_empty_table_and_no_python(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    result = C.digests(C.rendered(C.fold(C.as_events(frame))))
    assert result.collect() == []
    plan = result._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_of_a_table_go_through_the_fold(spark):
    """Later events find the message of a row by its name; repeated rows are messages of their own."""
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, None, None, None), (None, 2, "user", "hi")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    events = C.as_events(frame)
    names = [r["message"] for r in events.where("conv_id = 1").collect()]
    assert None not in names and len(set(names)) == 4
    assert rows_of(events.select("conv_id", "seq", "role", "text")) == sorted(
        ((c, t, r or "", x or "") for c, t, r, x in rows), key=repr
    )
    said = events.where("role = 'assistant'").selectExpr("conv_id", "message", "2L as seq", "'delta' as kind", "'' as role", "' indeed' as text")
    gone = events.where("role = 'user' and conv_id = 1").limit(1)
    gone = gone.selectExpr("conv_id", "message", "9L as seq", "'delete' as kind", "'' as role", "'' as text")
    found = C.fold(events.unionByName(said).unionByName(gone))
    assert rows_of(found.select("conv_id", "first", "role", "text")) == sorted(
        [(1, 0, "user", "hi"), (1, 1, "assistant", "yes indeed"), (1, None, "", ""), (None, 2, "user", "hi")], key=repr
    )


def test_events_without_a_name_stand_for_themselves(spark):
    log = [(1, None, 0, "message", "user", "a")] * 2 + [(1, None, 1, "delta", "user", "b"), (1, None, 2, "delete", None, None), (1, "m", 3, "message", "user", "c")]
    found = C.fold(spark.createDataFrame(log, EVENTS))
    assert rows_of(found.select("first", "text")) == [(0, "a"), (0, "a"), (1, "b"), (3, "c")]


def test_a_message_of_many_deltas(spark):
    """In proportion to the log; a start in the middle, several of one place, and null places."""
    n = 100_000
    log = spark.range(n).selectExpr(
        "1L as conv_id", "'m' as message", "id as seq", f"if(id = {n // 2}, 'edit', 'delta') as kind", "'assistant' as role", "concat(id, ' ') as text"
    )
    found = C.fold(log.repartition(4)).collect()
    assert [r["text"] for r in found] == ["".join(f"{i} " for i in range(n // 2, n))]
    odd = [(1, "m", 3, "message", "user", "b"), (1, "m", 3, "edit", "", "a"), (1, "m", 3, "delta", "", "!"), (1, "m", 2, "delta", "", "x"), (1, "m", None, "message", "", "y")]
    odd += [(1, "o", None, "delta", "user", "1"), (1, "o", 0, "delta", "", "2"), (1, "o", None, "edit", "", "0")]
    found = C.fold(spark.createDataFrame(odd, EVENTS).repartition(3))
    assert rows_of(found.select("message", "first", "role", "text")) == [("m", 2, "user", "b!"), ("o", 0, "user", "012")]


def test_very_long_texts(spark):
    text = "<&é " * 500_000
    frame = spark.createDataFrame([(1, 0, "assistant", text), (1, 1, "user", text)], "conv_id long, turn long, role string, text string")
    assert rows_of(C.digests(C.rendered(C.fold(C.as_events(frame))))) == [(1, *digest([("assistant", text), ("user", text)]))]


def test_repeated_rows_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(C, "BROADCAST_NAMES", 0)
    test_rows_of_a_table_go_through_the_fold(spark)


def test_rows_that_stand_once_are_named_without_a_shuffle(spark, tmp_path):
    rows = [(i // 4, i % 4, "user", f"text {i}") for i in range(40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.write.parquet(str(tmp_path / "turns"))
    events = C.as_events(spark.read.parquet(str(tmp_path / "turns")))
    assert sorted(r["text"] for r in events.collect()) == sorted(r[3] for r in rows)
    once = events._jdf.queryExecution().optimizedPlan().toString().split("LeftSemi")[0]
    assert "LeftAnti" in once and "Window" not in once and "Repartition" not in once
