"""Chat formatting from event logs, in DataFrame expressions only.

A conversation is a log of events ordered by ``seq``. An event names the turn
it belongs to and one of these kinds:

* ``message``     the turn's text (replaces what the turn held before),
* ``delta``       text appended to the turn (a streamed answer),
* ``edit``        replaces the turn's text and drops every later turn written
                  before the edit (the conversation continues from there),
* ``regenerate``  empties the turn; the deltas that follow make the new text.

``fold_events`` partitions the log by conversation, orders it by sequence and
folds it into final messages; ``render`` writes them in the template; and
``read_back`` recovers roles, texts and the loss spans from the output alone.

Template: ``<s>`` then per turn ``[INST] text [/INST]`` (user), ``[ANS] text
[/ANS]`` (assistant), ``[SYS] text [/SYS]`` (system) or ``[ROLE:name] text
[/ROLE]`` (any other role), then ``</s>``. Inside texts and role names every
backslash, ``<``, ``[`` and ``]`` is written as a backslash and a digit, so no
control string can occur there, and reading back is exact. The loss mask is a
list of (start, length) code-point spans, one per assistant turn.

Defined results: a null text or role is empty; a null conversation id is a
conversation of its own; a null turn comes first; repeated rows of a plain turn
table stay separate turns. A rendered conversation is one string cell, so one
conversation is limited to the 2 GB of a Spark string; everything before the
last aggregation works on single turns, and its windows sort and spill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: the template's tags by role
TAGS = {"user": "INST", "assistant": "ANS", "system": "SYS"}
CODES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"), ("]", "\\3"))


def escape(text: Column) -> Column:
    for plain, code in CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def turns_as_events(turns: DataFrame) -> DataFrame:
    """Event log of a plain turn table: one ``message`` per row, in turn order.

    Rows of one conversation are numbered by (turn, role, text), so rows that
    share a turn number stay separate turns."""
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return turns.select("conv_id", "turn", "role", "text").select(
        "conv_id", F.row_number().over(w).cast("long").alias("turn"),
        F.row_number().over(w).cast("long").alias("seq"), F.lit("message").alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, turn, role, text.

    Only events from the last replacing event of a turn on count; a turn is
    dropped when an earlier turn was edited after the turn's last replacing
    event (or its first event, if nothing replaces it)."""
    log = events.select("conv_id", "turn", "seq", "kind", "role", "text")
    by_turn = Window.partitionBy("conv_id", "turn")
    resets = F.col("kind").isin("message", "edit", "regenerate")
    log = log.withColumn("since", F.coalesce(F.max(F.when(resets, F.col("seq"))).over(by_turn),
                                             F.min("seq").over(by_turn)))
    parts = F.when((F.col("seq") >= F.col("since")) & (F.col("kind") != "regenerate"),
                   F.struct("seq", F.coalesce("text", F.lit("")).alias("text")))
    turns = log.groupBy("conv_id", "turn").agg(
        F.max("since").alias("since"), F.max(F.when(F.col("kind") == "edit", F.col("seq"))).alias("edited"),
        F.max_by(F.coalesce("role", F.lit("")), "seq").alias("role"), F.sort_array(F.collect_list(parts)).alias("parts"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.max("edited").over(before)
    return (turns.withColumn("cut", cut).where(F.col("cut").isNull() | (F.col("since") > F.col("cut")))
            .select("conv_id", "turn", "role", F.array_join("parts.text", "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (array of start, length; code points from 0)."""
    role = F.col("role")
    named = F.concat(F.lit("ROLE:"), escape(role))
    tag, close = named, F.lit("ROLE")
    for name, known in TAGS.items():
        tag = F.when(role == name, F.lit(known)).otherwise(tag)
        close = F.when(role == name, F.lit(known)).otherwise(close)
    m = messages.select("conv_id", "turn", "role", F.concat(F.lit("["), tag, F.lit("] ")).alias("head"),
                        escape(F.col("text")).alias("body"), F.concat(F.lit(" [/"), close, F.lit("]")).alias("tail"))
    m = m.withColumn("piece", F.concat("head", "body", "tail"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    start = F.lit(3) + F.coalesce(F.sum(F.char_length("piece").cast("long")).over(before), F.lit(0)) + F.char_length("head")
    m = m.withColumn("span", F.when(role == "assistant", F.struct(
        "turn", start.alias("start"), F.char_length("body").cast("long").alias("length"))))
    out = m.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "piece"))).alias("pieces"),
                                   F.sort_array(F.collect_list("span")).alias("spans"))
    return out.select("conv_id", F.concat(F.lit("<s>"), F.array_join("pieces.piece", ""), F.lit("</s>")).alias("formatted"),
                      F.expr("transform(spans, s -> named_struct('start', s.start, 'length', s.length))").alias("loss_spans"))


def read_back(rendered: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text) and loss_texts, from the output alone."""
    pattern = r"\[([^/\[\]][^\[\]]*)\] ([^\[]*) \[/[A-Z]+\]"
    tags = F.regexp_extract_all("formatted", F.lit(pattern), F.lit(1))
    bodies = F.regexp_extract_all("formatted", F.lit(pattern), F.lit(2))

    def role_of(tag: Column) -> Column:
        out = unescape(F.substring(tag, 6, 2**31 - 1))
        for name, known in TAGS.items():
            out = F.when(tag == known, F.lit(name)).otherwise(out)
        return out

    turns = F.zip_with(tags, bodies, lambda t, b: F.struct(role_of(t).alias("role"), unescape(b).alias("text")))
    spoken = F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return rendered.select("conv_id", "formatted", turns.alias("turns"), spoken.alias("loss_texts"))


def chat_digest(events: DataFrame) -> DataFrame:
    """The digest columns of formatted conversations, all taken from the output."""
    back = read_back(render(fold_events(events)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                       F.char_length(loss).cast("long").alias("loss_chars"),
                       F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))
