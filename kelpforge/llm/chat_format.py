"""Chat formatting from an event log, with DataFrame functions only.

A conversation is a log of events (conv_id, seq, message_id, kind, role, text):

* ``open`` starts a message and names its role,
* ``delta`` appends text to its message,
* ``edit`` replaces the message's text,
* ``regenerate`` empties the message and drops the messages that were opened after it and
  before the regeneration.

The log is partitioned by conversation (one shuffle), each message's events are folded in
order of seq, messages are put in order of their first event and rendered as
``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside roles and texts are escaped
reversibly: a backslash is doubled and ``<|`` becomes ``<\\|``; a role's line feed becomes
``\\n``. No escaped text holds ``<|``, so the marks can't be forged and turns are read back by
splitting at them. The loss mask lists spans of the rendering, and the loss text of the digest
is what lies under them.

A conversation is one sample whose rendering is one string, so its events meet in one task;
nothing else does.

Defined cases: null role or text counts as empty; events of one message with equal seq are
ordered open, regenerate, edit, delta, then by text; messages with equal first seq are ordered
by role, text and message_id; repeated rows of a turn table are turns of their own; a null
conv_id is a conversation; an empty table gives no conversation; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
KINDS = ("open", "regenerate", "edit", "delta")
#: Turns in a block of sums, code points in a block of text.
TURNS, CHARS = 64, 4096


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once even where ``use`` reads it in a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def escape(c: Column) -> Column:
    """No ``<|`` is left; ``unescape`` gives the text back."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([\\|])", "$1")


def escape_role(c: Column) -> Column:
    """As ``escape``, and without line feeds, which end a role in the template."""
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape_role(c: Column) -> Column:
    parts = F.transform(F.split(c, r"\\\\", -1), lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("<\\|"), F.lit("<|")))
    return F.array_join(parts, "\\")


def turn_events(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The event log of a table of finished turns: an open event and one delta each."""
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("seq"), F.monotonically_increasing_id().alias("message_id"), F.col(role).alias("role"), F.col(text).alias("text"))
    both = F.array(
        F.struct(F.lit("open").alias("kind"), F.lit("").alias("text")),
        F.struct(F.lit("delta").alias("kind"), F.coalesce("text", F.lit("")).alias("text")),
    )
    return rows.withColumn("e", F.explode(both)).select("conv_id", "seq", "message_id", "e.kind", F.when(F.col("e.kind") == "open", F.col("role")).alias("role"), "e.text")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's final messages, in order."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), F.lit(4)).cast("int")
    e = events.repartition("conv_id").select("conv_id", "seq", "message_id", rank.alias("rank"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    at = F.struct("seq", "rank")
    messages = e.groupBy("conv_id", "message_id").agg(
        F.min("seq").alias("first_seq"),
        F.max(F.when(F.col("rank") == 1, F.struct("seq", "role"))).alias("opened"),
        F.max(F.when(F.col("rank") == 2, F.col("seq"))).alias("regenerated"),
        F.max(F.when(F.col("rank") <= 3, at)).alias("reset"),
        F.sort_array(F.collect_list(F.when(F.col("rank") >= 3, F.struct("seq", "rank", "text")))).alias("parts"),
    )
    live = F.filter("parts", lambda p: F.coalesce(F.struct(p["seq"], p["rank"]) >= F.col("reset"), F.lit(True)))
    text = F.array_join(F.transform(live, lambda p: p["text"]), "")
    folded = messages.select("conv_id", F.struct("first_seq", F.coalesce("opened.role", F.lit("")).alias("role"), text.alias("text"), "message_id").alias("m"), F.when(F.col("regenerated").isNotNull(), F.struct("first_seq", "regenerated")).alias("r"))
    whole = folded.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("m"), F.collect_list("r").alias("r"))
    dropped = lambda m: F.exists("r", lambda r: (r["first_seq"] < m["first_seq"]) & (r["regenerated"] > m["first_seq"]))
    kept = F.when(F.size("r") == 0, F.col("m")).otherwise(F.filter("m", lambda m: ~dropped(m)))
    return whole.select("conv_id", F.transform(kept, lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text"))).alias("turns"))


def starts(sizes: Column) -> Column:
    """Where each of consecutive stretches starts, from 0: the sum of the whole blocks before
    its own, then of its own block's part, so that no turn sums or copies all before it."""
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    block = lambda i: F.floor(i / TURNS).cast("int")
    sums = lambda s: F.transform(F.sequence(F.lit(0), block(F.size(s))), lambda k: total(F.slice(s, k * TURNS + 1, F.lit(TURNS))))
    before = lambda b: F.transform(b, lambda _, k: total(F.slice(b, F.lit(1), k)))
    at = lambda s, c: F.transform(s, lambda _, i: F.get(c, block(i)) + total(F.slice(s, i - i % TURNS + 1, i % TURNS)))
    return bind(sizes, lambda s: bind(sums(s), lambda b: bind(before(b), lambda c: at(s, c))))


def render(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    """(conv_id, formatted, mask): the string, and start and length in code points of each
    text of role ``trained``, from 0."""
    pieces = F.transform("turns", lambda t: F.struct(F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"), (t["role"] == trained).alias("on")))
    laid = conversations.select("conv_id", pieces.alias("p"))
    n = lambda c: F.length(c).cast("long")
    sizes = F.transform("p", lambda p: F.struct(n(p["head"]).alias("head"), n(p["body"]).alias("body"), p["on"].alias("on")))
    span = lambda z, at: F.when(z["on"], F.struct((at + z["head"]).alias("start"), z["body"].alias("len")))
    spans = lambda s: F.array_compact(F.zip_with(s, starts(F.transform(s, lambda z: z["head"] + z["body"] + F.lit(len(END)))), span))
    return laid.select(
        "conv_id",
        F.array_join(F.transform("p", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        bind(sizes, spans).alias("mask"),
    )


def under_mask(formatted: Column, mask: Column) -> Column:
    """The texts at the mask's spans, unescaped, in the mask's order.

    A position in a string is found by counting from its start, so the string is cut once into
    blocks and a span reads its own blocks only.
    """
    blocks = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{CHARS}}}+"), F.lit(0))
    block = lambda n: F.floor(n / CHARS).cast("int")

    def cut(b: Column, m: Column) -> Column:
        near = F.array_join(F.slice(b, block(m["start"]) + 1, block(m["len"]) + 2), "")
        return unescape(F.substring(near, (m["start"] % CHARS + 1).cast("int"), m["len"].cast("int")))

    return bind(blocks, lambda b: F.transform(mask, lambda m: cut(b, m)))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda x: x != "")
    cut = lambda x: F.instr(x, "\n")
    return F.transform(
        pieces,
        lambda x: F.struct(
            unescape_role(F.substring(x, F.lit(len(START) + 1), cut(x) - F.lit(len(START) + 1))).alias("role"),
            unescape(F.substring(x, cut(x) + 1, F.length(x))).alias("text"),
        ),
    )


def chat_digest(rendered: DataFrame) -> DataFrame:
    """Counts and digests of rendered conversations, read back from the strings; the loss is
    the text under the mask, whatever the roles."""
    texts = F.array_join(under_mask(F.col("formatted"), F.col("mask")), "")
    back = rendered.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), texts.alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
