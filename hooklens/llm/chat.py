"""Chat formatting by event-sourced reconstruction.

A conversation log is a table of events `conv_id, message, seq, kind, role, text`. Kinds:

- `delta`: the text is appended to the message (a streamed piece);
- `message`: the text is the whole message;
- `edit`: as `message`, said later;
- `regenerate`: the text so far is thrown away, new deltas follow.

The fold over a message, in order of `seq`: its text is that of the last event that resets it
and of all deltas after that one. Messages fold apart from each other, then the few folded ones
of a conversation are rendered, so a long log of one message never meets the other messages.
Events with equal `seq` are ordered by kind and text; null text is empty, a null role is the empty
role; a message without any text is a message; null ids are an id like any other.

The rendered form is `<|im_start|>role\\ntext<|im_end|>\\n` per message. In a text, every string
that any common template reads as control gets a backslash after its first character (one more if
it has some there already), which `unescape` takes away again. Only column expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END, LINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
#: What follows the first character of a control string; fixed values of known templates.
RESTS = r"\|im_start\|>|\|im_end\|>|\|nl\|>|\|endoftext\|>|/?s>|/?INST\]|/?<?SYS>"
RESETS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({RESTS})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({RESTS})", "$1$2$3")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(LINE), F.lit("\n")))


def fold_messages(events: DataFrame) -> DataFrame:
    """Final `conv_id, message, role, text`, one row per message. `message` may be any orderable value."""
    entry = F.struct(
        F.col("seq"), F.col("kind"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("role", F.lit("")).alias("role"),
    )
    logs = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(entry)).alias("log"))
    resets = F.transform(F.col("log"), lambda e, i: F.when(e["kind"].isin(*RESETS), i))
    last = F.coalesce(F.array_max(resets), F.lit(0))
    tail = F.slice(F.col("log"), F.col("last") + 1, F.size("log"))
    parts = F.transform(tail, lambda e: F.when(e["kind"] == "regenerate", "").otherwise(e["text"]))
    return logs.withColumn("last", last).select(
        "conv_id", "message", F.element_at("log", -1)["role"].alias("role"), F.array_join(parts, "").alias("text")
    )


def render(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """`conv_id, n_turns, formatted, loss_spans` of folded messages.

    `loss_spans` are `start, length` in code points of the formatted string, one for each message
    of the trained role: the text alone, without its marks.
    """
    entry = F.struct(
        F.col("message"), escape_role(F.col("role")).alias("role"), escape(F.col("text")).alias("text"),
        (F.col("role") == trained_role).alias("trained"),
    )
    grouped = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("turns"))
    parts = F.transform(
        "turns", lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END))
    )
    span_type = "array<struct<start:int,length:int>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(span_type).alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + len(START) + F.length(t["role"]) + 1
        size = F.length(t["text"])
        span = F.struct(start.alias("start"), size.alias("length"))
        return F.struct(
            (start + size + len(END)).alias("at"),
            F.when(t["trained"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    return grouped.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(parts, "").alias("formatted"),
        F.aggregate("turns", zero, step, lambda acc: acc["spans"]).alias("loss_spans"),
    )


def parse(formatted: Column) -> Column:
    """The messages, as structs `role, text`, of a formatted string."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda p: p != "")
    body = lambda p: F.substring(p, len(START) + 1, F.length(p))
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.split_part(body(p), F.lit("\n"), F.lit(1))).alias("role"),
            unescape(F.regexp_replace(body(p), r"^[^\n]*\n", "")).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped span by span and joined."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), ""
    )


def format_log(events: DataFrame) -> DataFrame:
    """Fold an event log and render its conversations."""
    return render(fold_messages(events))


def events_of_turns(conversations: DataFrame) -> DataFrame:
    """The log that a chat front end would have written for finished turns `conv_id, turn, role, text`.

    An assistant's turn is a draft that was regenerated and then streamed in two pieces; any other
    turn was sent short and then edited. Turns that share conversation and number stay apart.
    """
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    rows = conversations.groupBy("conv_id", "turn", role.alias("role"), text.alias("text")).agg(
        F.count("*").alias("copies")
    )
    half = F.floor(F.length("text") / 2).cast("int")
    head, tail = F.substring("text", 1, half), F.substring("text", half + 1, F.length("text"))
    event = lambda n, kind, text: F.struct(
        F.lit(n).alias("seq"), F.lit(kind).alias("kind"), text.alias("text")
    )
    streamed = F.array(
        event(0, "delta", F.col("text")), event(1, "regenerate", F.lit("")), event(2, "delta", head),
        event(3, "delta", tail),
    )
    edited = F.array(event(0, "message", head), event(1, "edit", F.col("text")))
    log = F.when(F.col("role") == "assistant", streamed).otherwise(edited)
    spread = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    # messages sort by turn; the rest of the key tells apart what shares a turn
    key = F.struct("turn", "role", F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("id"), "copy")
    return spread.select("conv_id", key.alias("message"), "role", F.inline(log))
