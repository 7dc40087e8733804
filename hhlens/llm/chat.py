"""Chat formatting by event-sourced reconstruction (DataFrame functions only).

A log of events is partitioned by conversation, sorted by sequence and folded into final
messages, which are rendered with a turn template and a loss mask over assistant texts.

Events (column ``event``; null counts as ``message``):

* ``message``, ``edit``, ``regenerate``: the text of the turn starts anew with this text;
* ``delta``: the text is appended to the turn (a turn may start with a delta).

A turn stands where its first event stands; its role is that of its latest event with a
non-null role.  Events of one sequence number fold in the order (event kind, text), resets
first, so ties and repeated rows give one defined result.

Escaping inside texts is reversible: ``\\`` -> ``\\s`` and then ``<|`` -> ``<\\p`` (in roles also
a line feed -> ``\\n``), so the only ``<|`` in the output are the template's own.

Nulls: a null text or role is empty; a null conversation id forms one conversation; a null
sequence sorts first.  An empty log gives an empty frame.  Columns beyond the named ones
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\s"))
    if role:
        out = F.replace(out, F.lit("\n"), F.lit("\\n"))
    return F.replace(out, F.lit("<|"), F.lit("<\\p"))


def unescape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\p"), F.lit("|"))
    if role:
        out = F.replace(out, F.lit("\\n"), F.lit("\n"))
    return F.replace(out, F.lit("\\s"), F.lit("\\"))


def fold_events(log: DataFrame) -> DataFrame:
    """(conv_id, msg, seq, event, role, text) -> (conv_id, msg, first_seq, role, text)."""
    e = log.select("conv_id", "msg", "seq",
                   F.when(F.col("event") == "delta", 1).otherwise(0).alias("is_delta"),
                   "role", F.coalesce("text", F.lit("")).alias("text"))
    turn = Window.partitionBy("conv_id", "msg")
    order = F.struct("seq", "is_delta", "text")
    e = (e.withColumn("last_reset", F.max(F.when(F.col("is_delta") == 0, order)).over(turn))
         .withColumn("first_seq", F.min(F.struct(F.col("seq").isNotNull(), "seq")).over(turn)))
    live = F.col("last_reset").isNull() | (order >= F.col("last_reset"))
    piece = F.when(live & ((F.col("is_delta") == 1) | (order == F.col("last_reset"))), order)
    # Repeated resets are one reset: of equal ones a single text is kept.
    g = e.groupBy("conv_id", "msg", "first_seq").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"),
        F.max(F.when(F.col("role").isNotNull(),
                     F.struct(F.col("seq"), F.col("is_delta"), F.col("role")))).alias("r"))
    deltas = F.filter("pieces", lambda p: p["is_delta"] == 1)
    reset = F.filter("pieces", lambda p: p["is_delta"] == 0)
    text = F.concat(F.coalesce(F.get(reset, F.lit(0))["text"], F.lit("")),
                    F.array_join(F.transform(deltas, lambda p: p["text"]), ""))
    return g.select("conv_id", "msg", "first_seq", F.coalesce("r.role", F.lit("")).alias("role"),
                    text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """Messages -> one row per conversation: conv_id, formatted, loss_spans (array of
    start (0-based), length in characters of ``formatted``)."""
    m = messages.withColumn("_head", F.concat(F.lit(START), escape(F.col("role"), True), F.lit("\n"))) \
        .withColumn("_body", escape(F.col("text"))) \
        .withColumn("_len", F.length("_head") + F.length("_body") + len(END) + 1)
    w = Window.partitionBy("conv_id").orderBy("first_seq", "msg")
    m = m.withColumn("_n", F.row_number().over(w)) \
        .withColumn("_at", F.sum("_len").over(w.rowsBetween(Window.unboundedPreceding, 0))
                    - F.col("_len") + F.length("_head"))
    span = F.when(F.col("role") == "assistant",
                  F.struct(F.col("_n").alias("n"), F.col("_at").alias("start"),
                           F.length("_body").cast("long").alias("length")))
    g = m.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct(
            F.col("_n").alias("n"),
            F.concat("_head", "_body", F.lit(END + "\n")).alias("piece")))).alias("p"),
        F.array_sort(F.collect_list(span)).alias("s"))
    return g.select(
        "conv_id", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"),
        F.transform("s", lambda x: F.struct(x["start"].alias("start"),
                                            x["length"].alias("length"))).alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    parts = F.slice(F.split(formatted, "<\\|im_start\\|>"), 2, 2_000_000_000)

    def turn(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        body = F.substring(p, F.length(head) + 2, F.length(p) - F.length(head) - len(END) - 2)
        return F.struct(unescape(head, True).alias("role"), unescape(body).alias("text"))

    return F.transform(parts, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def format_chats(log: DataFrame) -> DataFrame:
    """Event log -> (conv_id, formatted, loss_spans)."""
    return render(fold_events(log))


def as_events(turns: DataFrame) -> DataFrame:
    """A table of whole turns as a log with one ``message`` event per row; rows of one turn
    number are distinct messages in the order (role, text)."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.select("conv_id", F.row_number().over(w).cast("long").alias("msg"),
                        F.col("role"), F.col("text")) \
        .select("conv_id", "msg", F.col("msg").alias("seq"), F.lit("message").alias("event"),
                "role", "text")
