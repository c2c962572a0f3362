"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events ``(conv_id, message, seq, kind, role, text)``.
``message``, ``edit`` and ``regenerate`` events start a message's text anew, ``delta``
events add to it, ``delete`` takes the message away. The log is folded in the
order of ``seq`` into final messages, and those are rendered by a template:

    <s>role
    text</s>

``&``, ``<`` and, in roles, line ends are written as ``&amp;``, ``&lt;`` and ``&#10;``
inside roles and texts, so control strings stand between turns only and reading
back is exact. The loss mask lists the places of assistant texts.

Messages are folded and rendered one by one and written a row per turn, so a
conversation of many messages is spread over tasks. Only where one value per
conversation is asked for (its string, its digest) do its turns come together.
Built-in functions only.

Defined cases: null texts and roles are empty; a log without a starting event
starts with its first delta; a message's role is the last one that its events
give; events of one message with equal ``seq`` go by kind (a
start first), then text; messages go by the ``seq`` of their first event, then by
name. Rows of a plain table are a message each, repeated rows too, with a name made for
them, and ordered by turn (null first), role and text. A conversation without messages gives no row; null
ids are one conversation; an empty table gives none. Texts and logs of any length are whole: a message is
one string and one task's work, in proportion to its events. Other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

OPEN, CLOSE = "<s>", "</s>"
#: What the names given to rows of a plain table begin with
ROW = "\0row "
STARTS = ("message", "edit", "regenerate")
ASSISTANT = "assistant"
#: Names of repeated rows (32 letters each) that are sent to every task; more are joined by a shuffle
BROADCAST_NAMES = 200_000


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def named(events: DataFrame) -> DataFrame:
    """Each event as a message of its own, named by what it holds and, as rows may repeat, a number.

    Only hashes are counted for it. Rows that stand once are named where they are; equal
    rows are counted and dealt out again. So the names are the same whenever they are made.
    """
    columns = ["conv_id", "seq", "kind", "role", "text"]
    held = [F.col(c).cast("string") for c in columns]
    sized = [(F.coalesce(F.length(h).cast("string"), F.lit("-")), F.coalesce(h, F.lit(""))) for h in held]
    whole = F.concat(*[x for size, h in sized for x in (size, F.lit(":"), h)])
    rows = events.select(*columns, F.md5(whole.cast("binary")).alias("held"))
    twice = rows.groupBy("held").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("held")
    twice = Scratch(events.sparkSession, "chats").keep(twice, "twice")
    twice = twice.hint("broadcast" if twice.count() <= BROADCAST_NAMES else "merge")
    once = rows.join(twice, "held", "left_anti").withColumn("copy", F.lit(1).cast("long"))
    many = (
        rows.join(twice, "held", "left_semi")
        .groupBy("held", *columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
        .drop("copies")
    )
    name = F.concat(F.lit(ROW), F.col("held"), F.lit(" "), F.col("copy").cast("string"))
    return once.unionByName(many).select(
        "conv_id", name.alias("message"), *columns[1:]
    )


def as_events(conversations: DataFrame) -> DataFrame:
    """The rows of a plain table of turns as one ``message`` event each, of a message of its own."""
    return named(
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("seq"),
            F.lit("message").alias("kind"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, message, first, role, text)``.

    Events are grouped by conversation and message; those without a message name
    are given one each. A message is its last start and the deltas after it, found by
    place in the sorted log, so the work is in proportion to the log.
    """
    clean = events.select(
        "conv_id",
        "message",
        "seq",
        "kind",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    nameless = clean.where("message is null")
    if not nameless.isEmpty():
        clean = clean.where("message is not null").unionByName(named(nameless))
    starts = F.col("kind").isin(*STARTS, "delete")
    event = F.struct("seq", (~starts).alias("later"), "kind", "text")
    together = clean.groupBy("conv_id", "message").agg(
        F.min("seq").alias("first"),
        F.max(F.when(F.col("role") != "", F.struct("seq", "role"))).alias("given"),
        F.array_sort(F.collect_list(event)).alias("log"),
    )
    begun = F.array_max(F.transform("log", lambda e, i: F.when(e["later"], 0).otherwise(i + 1)))
    last = F.get("log", F.col("begun") - 1)
    live = F.slice("log", F.greatest(F.col("begun"), F.lit(1)), F.size("log"))
    return (
        together.withColumn("begun", begun)
        .where(F.coalesce(last["kind"] != "delete", F.lit(True)))
        .select(
            "conv_id",
            "message",
            "first",
            F.coalesce("given.role", F.lit("")).alias("role"),
            F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"),
        )
    )


def rendered(messages: DataFrame) -> DataFrame:
    """A row per turn: ``conv_id, first, message``, the rendered ``turn`` and its loss mask.

    A conversation is its turns in the order of :func:`turn_order`, one after
    another. ``loss_start`` and ``loss_length`` are the place of the text in an
    assistant's turn, else null.
    """
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    masked = F.col("role") == ASSISTANT
    return messages.select(
        "conv_id",
        "first",
        "message",
        F.concat(head, body, F.lit(CLOSE)).alias("turn"),
        F.when(masked, F.length(head)).alias("loss_start"),
        F.when(masked, F.length(body)).alias("loss_length"),
    )


def turn_role(turn: Column) -> Column:
    after = F.length(F.lit(OPEN))
    return unescape_role(F.substring(turn, after + 1, F.instr(turn, "\n") - after - 1))


def turn_text(turn: Column) -> Column:
    end = F.instr(turn, "\n")
    return unescape(F.substring(turn, end + 1, F.length(turn) - end - F.length(F.lit(CLOSE))))


def masked_text(turn: Column, start: Column, length: Column) -> Column:
    """What stands under the loss mask, null if there is none."""
    return unescape(F.substring(turn, start + 1, length))


def read_back(turns: DataFrame) -> DataFrame:
    """Rendered turns with the ``role`` and ``text`` they hold and, under the mask, ``loss_text``."""
    turn = F.col("turn")
    return turns.select(
        "*",
        turn_role(turn).alias("role"),
        turn_text(turn).alias("text"),
        masked_text(turn, F.col("loss_start"), F.col("loss_length")).alias("loss_text"),
    )


def in_order(turns: DataFrame) -> DataFrame:
    """Per conversation its ``turns``, by first event, name (of other than plain rows), role and text.

    Each text travels once, in its rendered turn; all else is read from that afterwards.
    """
    name = F.when(~F.col("message").startswith(ROW), F.col("message"))
    entry = F.struct("first", name.alias("message"), "turn", "loss_start", "loss_length")
    whole = turns.groupBy("conv_id").agg(F.collect_list(entry).alias("turns"))
    read = F.transform(
        "turns",
        lambda t: F.struct(
            t["first"].alias("first"),
            t["message"].alias("message"),
            turn_role(t["turn"]).alias("role"),
            turn_text(t["turn"]).alias("text"),
            t["turn"].alias("turn"),
            masked_text(t["turn"], t["loss_start"], t["loss_length"]).alias("loss_text"),
        ),
    )
    return whole.select("conv_id", F.array_sort(read).alias("turns"))


def conversations(turns: DataFrame) -> DataFrame:
    """One string per conversation, ``formatted``, from rendered turns."""
    return in_order(turns).select("conv_id", F.array_join("turns.turn", "").alias("formatted"))


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation counts and digests of its turns as read back from the output."""
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        in_order(turns)
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.array_join(said, "").alias("said"),
            F.array_join("turns.loss_text", "").alias("loss"),  # leaves nulls out
            F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.length(t["turn"])).alias(
                "formatted_chars"
            ),
        )
        .select(
            "conv_id",
            "n_turns",
            F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
