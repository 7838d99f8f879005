"""Chat formatting from event logs, with DataFrame functions only.

A log holds events ``conv_id, seq, message, kind, role, text``. ``message`` starts a message with a text, ``delta``
appends to it, ``edit`` replaces what it says so far, ``regenerate`` drops it so that new deltas can follow. Events are
partitioned by conversation and message, sorted by sequence and folded into the final messages, which are rendered in
a template. The template's control strings begin with ``<|``; inside roles and texts that is written ``<\\|``, and a
backslash is doubled, so both can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: Roles whose texts are trained on.
LOSS_ROLES = ("assistant",)


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escaped_role(role: Column) -> Column:
    """As texts; line breaks become ``\\n`` as well, since one ends the role."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def events_of_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A log in which every row of ``turns`` starts a message of its own; rows of equal turn follow by role and text."""
    order = W.partitionBy(conv).orderBy(turn, role, text)
    seq = F.row_number().over(order).cast("long")
    return turns.select(
        F.col(conv).alias("conv_id"),
        seq.alias("seq"),
        seq.alias("message"),
        F.lit("message").alias("kind"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    )


def streamed(log: DataFrame, steps: int = 8) -> DataFrame:
    """A log of whole messages as an assistant's service would have written it, event by event.

    Every message starts with a draft that a regeneration drops; its text then streams in as two deltas. Every other
    message gets a slip of the pen appended, which an edit to the whole text repairs. Folding gives the first log's
    messages back.
    """
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    begin = F.substring(text, F.lit(1), half)
    rest = F.substring(text, half + 1, F.length(text))

    def event(step: int, kind: str, said: Column):
        return F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), said.cast("string").alias("said"))

    usual = [event(0, "message", F.reverse(begin)), event(1, "regenerate", F.lit(None)), event(2, "delta", begin), event(3, "delta", rest)]
    slip = [event(4, "delta", F.lit(" <|")), event(5, "edit", text)]
    events = F.when(F.col("message") % 2 == 0, F.array(*usual, *slip)).otherwise(F.array(*usual))
    rows = log.select("conv_id", "seq", "message", "role", F.explode(events).alias("e"))
    role = F.when(F.col("e.kind") == "message", F.col("role"))
    return rows.select("conv_id", (F.col("seq") * steps + F.col("e.step")).alias("seq"), "message", "e.kind", role.alias("role"), F.col("e.said").alias("text"))


def fold(events: DataFrame) -> DataFrame:
    """``conv_id, position, role, text``: the final messages, placed by their first event.

    Of events with equal sequence numbers, deltas follow the others. The role is the last one given. A null text adds
    nothing; deltas without a start make a message. Unknown kinds are an error.
    """
    known = F.col("kind").isin("message", "delta", "edit", "regenerate")
    kind = F.when(known, F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("unknown event kind "), F.coalesce("kind", F.lit("null")))))
    sets = kind != "delta"
    said = F.when(kind == "regenerate", F.lit("")).otherwise(F.coalesce("text", F.lit("")))
    place = F.struct(F.col("seq"), (~sets).cast("int").alias("late"))
    rows = events.select("conv_id", "message", place.alias("at"), sets.alias("sets"), "role", said.alias("text"))
    one = rows.groupBy("conv_id", "message").agg(
        F.min("at").alias("first"),
        F.max(F.when(F.col("sets"), F.col("at"))).alias("reset"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("at"))).alias("role"),
        F.sort_array(F.collect_list(F.struct("at", "text"))).alias("parts"),
    )
    live = F.filter("parts", lambda p: F.col("reset").isNull() | (p["at"] >= F.col("reset")))
    return one.select(
        "conv_id",
        F.struct("first", "message").alias("position"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.array_join(F.transform(live, lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """``conv_id, formatted, loss_spans``: one row per conversation; spans are ``start, length`` in code points of
    ``formatted`` (0-based) that hold the escaped texts to train on."""
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    parts = messages.select("conv_id", "position", "role", head.alias("head"), escaped(F.col("text")).alias("body"))
    parts = parts.withColumn("piece", F.concat("head", "body", F.lit(END)))
    before = W.partitionBy("conv_id").orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length("head")
    span = F.when(F.col("role").isin(*loss_roles), F.struct(at.alias("start"), F.length("body").cast("long").alias("length")))
    rows = parts.select("conv_id", "position", "piece", span.alias("span"))
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("position", "piece", "span"))).alias("rows"))
    spans = F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull())
    return lists.select("conv_id", F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"), spans.alias("loss_spans"))


def parse(formatted: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, loss``: the turns read back from ``formatted``; ``loss`` is the unescaped text of
    the turn's loss span, null without one."""
    pieces = formatted.select(
        "conv_id", F.posexplode(F.split("formatted", r"\Q<|im_end|>" + "\n" + r"\E")).alias("turn", "piece")
    ).where(F.col("piece") != "")
    head = F.instr("piece", "\n")
    before = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("piece") + F.lit(len(END))).over(before), F.lit(0)) + head
    role = F.substring("piece", F.lit(len(START) + 1), head - F.lit(len(START) + 1))
    turns = pieces.select("conv_id", "turn", "piece", head.alias("head"), role.alias("role"), at.alias("at"))
    spans = formatted.select(F.col("conv_id").alias("c"), F.explode("loss_spans").alias("s")).select("c", "s.start", "s.length")
    both = turns.join(spans, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("start")), "left")
    body = F.substring("piece", F.col("head") + 1, F.length("piece"))
    loss = F.substring("piece", F.col("head") + 1, F.col("length").cast("int"))
    return both.select(
        "conv_id", "turn", unescaped_role(F.col("role")).alias("role"), unescaped(body).alias("text"), unescaped(loss).alias("loss")
    )


def format_log(events: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """Events -> ``conv_id, formatted, loss_spans``. Other columns are not looked at; an empty log gives no rows."""
    return render(fold(events), loss_roles)
