"""Language rows as the two nested columns of a frame table, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .validation import route

CALLS = "array<struct<type:string,function:struct<name:string,arguments:struct<text:string>>>>"
PERSISTENT_TYPE = f"array<struct<role:string,content:string,style:string,timestamp:double,camera:string,tool_calls:{CALLS}>>"
EVENT_TYPE = f"array<struct<role:string,content:string,style:string,camera:string,tool_calls:{CALLS}>>"
LEGACY = ("subtask_index", "tools")


def speech(text: Column) -> Column:
    """The tool call that says a text."""
    return F.array(F.struct(F.lit("function").alias("type"), F.struct(F.lit("say").alias("name"), F.struct(text.alias("text")).alias("arguments")).alias("function")))


def language_columns(frames: DataFrame, rows: DataFrame) -> DataFrame:
    """frames with language_persistent (one list an episode, on each frame) and language_events (rows at exactly the frame's time).

    rows: episode, t, role, content, style, camera, tool_calls, position. Both lists
    are in order of (time, style, role[, camera]) with nulls as ''; position settles ties.
    An episode's frames are joined with one row of its own, so both joins keep one clustering.
    """
    rows = rows.withColumns({c: rows[c] if c in rows.columns else F.lit(None).cast(k) for c, k in (("camera", "string"), ("tool_calls", CALLS), ("position", "long"))})
    key = [F.coalesce(c, F.lit("")).alias(f"_{c}") for c in ("style", "role", "camera")]
    keep = rows.where(route(F.col("style")) == "persistent")
    item = F.struct("role", "content", "style", F.col("t").alias("timestamp"), "camera", "tool_calls")
    lists = keep.groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("t", *key[:2], "position", item.alias("row")))).alias("l"))
    lists = lists.select("episode", F.transform("l", lambda x: x["row"]).cast(PERSISTENT_TYPE).alias("language_persistent"))
    at = rows.where(route(F.col("style")) == "events")
    item = F.struct("role", "content", "style", "camera", "tool_calls")
    events = at.groupBy("episode", "t").agg(F.array_sort(F.collect_list(F.struct(*key, "position", item.alias("row")))).alias("l"))
    events = events.select("episode", "t", F.transform("l", lambda x: x["row"]).cast(EVENT_TYPE).alias("language_events"))
    out = frames.drop("language_persistent", "language_events", *LEGACY).join(lists, "episode", "left").join(events, ["episode", "t"], "left")
    return out.withColumns({"language_persistent": F.coalesce("language_persistent", F.array().cast(PERSISTENT_TYPE)), "language_events": F.coalesce("language_events", F.array().cast(EVENT_TYPE))})


def subtask_rows(annotated: DataFrame) -> DataFrame:
    """(episode, idx, text, start) of the subtask rows that an episode's frames carry."""
    one = annotated.groupBy("episode").agg(F.min_by("language_persistent", "t").alias("l"))
    subtasks = F.filter("l", lambda x: x["style"] == "subtask")
    return one.select("episode", F.posexplode(subtasks).alias("idx", "s")).select("episode", F.col("idx").cast("long").alias("idx"), F.col("s.content").alias("text"), F.col("s.timestamp").alias("start"))


def strip(annotated: DataFrame) -> DataFrame:
    """The same frames with both lists empty."""
    return annotated.withColumns({"language_persistent": F.array().cast(PERSISTENT_TYPE), "language_events": F.array().cast(EVENT_TYPE)})
