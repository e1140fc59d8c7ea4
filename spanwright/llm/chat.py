"""Chat formatting: event logs folded into messages and rendered, in native columns.

Each turn's events are put in order of sequence. A `message` opens a
message; a `delta` adds text to it, an `edit` replaces its text and a `regenerate`
drops it so that later deltas build it anew; `turn` names the turn they mean.
The last message, edit or regeneration of each message is found by running counts,
what is before it goes, and the pieces after it are joined in order, so a turn of
any number of deltas costs a sort of them. Only the final messages are gathered by
conversation, so a log of streamed deltas is shrunk before the second shuffle.

The template opens each turn with <|im_start|>, its role and a line feed, and
ends it with <|im_end|> and a line feed. In roles and texts a backslash becomes
two and "<|" becomes "<\\|" (in roles also line feeds), so no text can hold a
control string, and unescape() gives the text back exactly. Assistant texts are
under the loss mask.

Defined cases: null text is empty; a null role is the empty role; events with a
null conversation form one conversation of their own; ties in sequence come in the
order message, edit, regenerate, delta, then any other kind (which does nothing), then by
role and text; repeated message rows are messages of their own; a
message that was only regenerated has the empty text; deltas, edits and
regenerations before any message of their turn open one, with the first one's role; a
turn of any length is one text of its task; an
empty table gives no conversations; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rounds import numbered

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    if role:
        # line feeds first where an odd run of backslashes ends before n
        text = F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.regexp_replace(text, r"\\([\\|])", "$1")


#: Order of kinds that share a sequence number.
KINDS = ("message", "edit", "regenerate", "delta")


def fold_events(events: DataFrame, conv: str, turn: str | list[str], seq: str, kind: str | None, role: str, text: str) -> DataFrame:
    """(conv_id, at, role, text): the final messages; kind None means that every row is a message."""
    turns = [turn] if isinstance(turn, str) else turn
    rows, c, s, r, x, *ts = numbered(events, conv, seq, role, text, *turns)
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, KINDS)), F.coalesce(rows[f"_{events.columns.index(kind)}"].cast("string"), F.lit("message"))), F.lit(1)) if kind else F.lit(1)
    named = [f"t{k}" for k in range(len(ts))]
    rows = rows.select(rows[c].alias("conv_id"), *[rows[t].alias(n) for t, n in zip(ts, named, strict=True)], rows[s].alias("seq"), rank.cast("int").alias("rank"), F.coalesce(rows[r].cast("string"), F.lit("")).alias("role"), F.coalesce(rows[x].cast("string"), F.lit("")).alias("text"))
    if kind is None:
        return rows.select("conv_id", F.struct(*named, "seq", F.lit(0).alias("nth")).alias("at"), "role", "text")
    rows = rows.where("rank > 0")
    w = Window.partitionBy("conv_id", *named).orderBy("seq", "rank", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"place": F.count("*").over(w), "nth": F.greatest(F.count_if(F.col("rank") == 1).over(w), F.lit(1)), "base": F.count_if(F.col("rank") < 4).over(w)})
    own = rows.groupBy("conv_id", *named, "nth")
    piece = F.struct("base", "place", F.when(F.col("rank") == 3, "").otherwise(F.col("text")).alias("text"))
    # an event with a text before the last base of its message is dropped below; what is gathered is one message's log
    done = own.agg(F.min("seq").alias("seq"), F.min_by("role", "place").alias("role"), F.max("base").alias("last"), F.sort_array(F.collect_list(piece)).alias("log"))
    said = F.array_join(F.transform(F.filter("log", lambda p: p["base"] == F.col("last")), lambda p: p["text"]), "")
    return done.select("conv_id", F.struct(*named, "seq", "nth").alias("at"), "role", said.alias("text"))


def chat_format(events: DataFrame, conv: str = "conv_id", turn: str | list[str] = "turn", seq: str = "turn", kind: str | None = None, role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: conv_id, formatted, segments (piece, loss) that join to formatted."""
    turns = fold_events(events, conv, turn, seq, kind, role, text)
    talks = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("turns"))
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"], role=True), F.lit("\n"))
    piece = lambda x, loss: F.struct(x.alias("piece"), loss.alias("loss"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(piece(head(t), F.lit(False)), piece(escape(t["text"]), t["role"] == LEARNED_ROLE), piece(F.lit(CLOSE + "\n"), F.lit(False)))))
    out = talks.select("conv_id", segments.alias("segments"))
    return out.select("conv_id", F.array_join("segments.piece", "").alias("formatted"), "segments")


def as_events(rows: DataFrame) -> DataFrame:
    """An event log (conv_id, turn, nth, seq, kind, role, text) whose fold gives back rows (conv_id, turn, role, text).

    Assistant texts are streamed: a draft, its regeneration, then the text in two
    deltas. Others are said as a draft and edited. Rows of one turn are told apart
    by their number in the order of role and text.
    """
    text = F.coalesce("text", F.lit(""))
    half = F.ceil(F.length(text) / 2).cast("int")
    event = lambda seq, kind, said: F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), said.alias("text"))
    streamed = F.array(event(0, "message", F.lit("")), event(1, "delta", F.lit("a draft")), event(2, "regenerate", F.lit("")), event(3, "delta", F.substring(text, F.lit(1), half)), event(4, "delta", F.substring(text, half + 1, F.length(text))))
    edited = F.array(event(0, "message", F.lit("a draft")), event(1, "edit", text))
    nth = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy(F.coalesce("role", F.lit("")), text))
    rows = rows.withColumn("nth", nth)
    return rows.select("conv_id", "turn", "nth", "role", F.explode(F.when(F.col("role") == LEARNED_ROLE, streamed).otherwise(edited)).alias("e")).select("conv_id", "turn", "nth", "e.seq", "e.kind", "role", "e.text")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation says."""
    bodies = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda x: x != "")

    def turn(body):
        cut = F.locate("\n", body)
        role = F.substr(body, F.lit(1), cut - 1)
        text = F.substr(body, cut + 1, F.length(body) - cut - len(CLOSE) - 1)
        return F.struct(unescape(role, role=True).alias("role"), unescape(text).alias("text"))

    return F.transform(bodies, turn)
