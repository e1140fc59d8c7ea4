"""Span algebra over long-form spans (episode, idx, text, start, end) and frames (episode, t, label).

Everything is partitioned by episode: one exchange on it serves a whole chain of
these functions, as each asks for the same clustering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_episode(*order: str | Column):
    return Window.partitionBy("episode").orderBy(*order)


def run_length_spans(frames: DataFrame, label: str = "label", order: tuple[str, ...] = ("t", "event_id"), drop_blank: bool = False) -> DataFrame:
    """One span for each run of equal labels; a run ends at the next run's first frame, the last at the last frame."""
    w = by_episode(*order)
    new = F.when(F.lag(label).over(w).eqNullSafe(F.col(label)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    runs = frames.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("episode", "_run").agg(F.min(label).alias("text"), F.min("t").alias("start"), F.max("t").alias("_last"))
    after = by_episode("_run")
    spans = runs.select("episode", (F.col("_run") - 1).cast("long").alias("idx"), "text", "start", F.coalesce(F.lead("start").over(after), F.col("_last")).alias("end"))
    return spans.where(F.trim(F.coalesce("text", F.lit(""))) != "") if drop_blank else spans


def episode_extent(frames: DataFrame) -> DataFrame:
    return frames.groupBy("episode").agg(F.min("t").alias("t0"), F.max("t").alias("t_last"), F.count("*").alias("n_frames"))


def spans_from_starts(starts: DataFrame, extent: DataFrame) -> DataFrame:
    """Ends from the next start; the last span ends with the episode, or at its own start where that is later."""
    w = by_episode("start", "idx")
    last = F.greatest("start", "t_last")
    return starts.join(extent.select("episode", "t_last"), "episode", "left").select("episode", "idx", "text", "start", F.coalesce(F.lead("start").over(w), last, F.col("start")).alias("end"))


def stitch(spans: DataFrame, extent: DataFrame) -> DataFrame:
    """Full coverage: the first start is t0, each end the next start, the last end t_last; no end before its start."""
    w = by_episode("start", "idx")
    rows = spans.join(extent.select("episode", "t0", "t_last"), "episode").withColumn("_n", F.row_number().over(w)).withColumn("_next", F.lead("start").over(w))
    start = F.when(F.col("_n") == 1, F.col("t0")).otherwise(F.col("start"))
    return rows.select("episode", "idx", "text", start.alias("start"), F.greatest(F.coalesce("_next", "t_last"), start).alias("end"))


def collapse(spans: DataFrame, need_touch: bool = True, same_label=lambda x: x) -> DataFrame:
    """Merges neighbours of one label; with need_touch only where one ends exactly where the next starts.

    same_label maps a label to what is compared; the first label of a run stays.
    """
    w = by_episode("idx")
    key = same_label(F.col("text"))
    same = F.lag(key).over(w).eqNullSafe(key) & (F.row_number().over(w) > 1)
    if need_touch:
        same = same & (F.lag("end").over(w) == F.col("start"))
    runs = spans.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = runs.groupBy("episode", "_run").agg(F.min_by("text", "idx").alias("text"), F.min_by("start", "idx").alias("start"), F.max_by("end", "idx").alias("end"))
    return out.select("episode", (F.col("_run") - 1).cast("long").alias("idx"), "text", "start", "end")


def snap_to_frame(points: DataFrame, frames: DataFrame) -> DataFrame:
    """points (episode, id, at) and the nearest frame's t, the earlier of two as near; `at` itself without frames.

    One sort an episode of both sides together: linear, and no pairs are made.
    """
    both = points.select("episode", "id", F.col("at"), F.lit(None).cast("double").alias("t")).unionByName(frames.select("episode", F.lit(None).cast("long").alias("id"), F.col("t").alias("at"), "t"))
    w = by_episode("at", F.col("t").isNull())
    before = F.last("t", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("t", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    rows = both.withColumns({"_before": before, "_after": after}).where("id IS NOT NULL")
    nearest = F.when(F.col("_after") - F.col("at") < F.col("at") - F.col("_before"), F.col("_after")).otherwise(F.coalesce("_before", "_after", "at"))
    return rows.select("episode", "id", "at", nearest.alias("frame_t"))


def label_at(points: DataFrame, spans: DataFrame, extend_last: bool = False) -> DataFrame:
    """points (episode, id, at) with the text of the first span with start <= at < end; null where none.

    With extend_last, times after the last end get the last span's text.
    """
    s = spans.select("episode", "idx", F.col("text").alias("_text"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    inside = (F.col("at") >= F.col("_start")) & (F.col("at") < F.col("_end"))
    hit = points.join(s, "episode").where(inside).groupBy("episode", "id").agg(F.min(F.struct("idx", "_text")).alias("_hit"))
    out = points.join(hit, ["episode", "id"], "left").withColumn("text", F.col("_hit._text"))
    if extend_last:
        last = s.groupBy("episode").agg(F.max(F.struct("_end", "idx", "_text")).alias("_last"))
        out = out.join(last, "episode", "left").withColumn("text", F.when(F.col("text").isNull() & (F.col("at") >= F.col("_last._end")), F.col("_last._text")).otherwise(F.col("text")))
    return out.select("episode", "id", "at", "text")


def remaining_plan(spans: DataFrame) -> DataFrame:
    """At each span's start, the numbered list of the spans from there on."""
    w = by_episode("start", "idx").rowsBetween(0, Window.unboundedFollowing)
    todo = F.collect_list("text").over(w)
    numbered = F.array_join(F.transform(todo, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")
    return spans.select("episode", "idx", "start", numbered.alias("plan"))


def neighbours(spans: DataFrame) -> DataFrame:
    """Previous and next text, and how many spans are done and left."""
    w = by_episode("idx")
    total = F.count("*").over(Window.partitionBy("episode"))
    return spans.select("episode", "idx", "text", F.lag("text").over(w).alias("prev_text"), F.lead("text").over(w).alias("next_text"), (F.row_number().over(w) - 1).cast("long").alias("n_done"), (total - F.row_number().over(w)).cast("long").alias("n_left"))


def pack(spans: DataFrame, name: str = "spans") -> DataFrame:
    """One row an episode: spans in order as an array of structs (idx, text, start, end)."""
    return spans.groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("idx", "text", "start", "end"))).alias(name))


def keep_increasing(spans: Column) -> Column:
    """Drops each packed span whose start isn't after the last kept one's."""
    kind = "array<struct<idx:bigint,text:string,start:double,end:double>>"
    return F.aggregate(spans, F.array().cast(kind), lambda kept, s: F.when((F.size(kept) == 0) | (s["start"] > F.element_at(kept, -1)["start"]), F.concat(kept, F.array(s))).otherwise(kept))


def shift_starts(spans: Column, offsets: Column, t0: Column, t1: Column) -> Column:
    """Internal starts minus their offsets, held in the episode; each end follows the next start."""
    starts = F.transform(spans, lambda s, i: F.when(i == 0, s["start"]).otherwise(F.least(F.greatest(s["start"] - F.coalesce(F.get(offsets, i - 1), F.lit(0.0)), t0), t1)))
    return F.transform(F.arrays_zip(spans.alias("s"), starts.alias("b")), lambda z, i: F.struct(z["s"]["idx"].alias("idx"), z["s"]["text"].alias("text"), z["b"].alias("start"), F.coalesce(F.get(starts, i + 1), z["s"]["end"]).alias("end")))


def from_fractions(cuts: Column, labels: Column, t0: Column, t1: Column) -> Column:
    """Spans from relative boundaries, held in [0, 1] and non-decreasing; the first starts at t0."""
    held = F.aggregate(F.transform(cuts, lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))), F.array().cast("array<double>"), lambda a, c: F.concat(a, F.array(F.greatest(c, F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0.0))))))
    edges = F.concat(F.array(F.lit(0.0)), held, F.array(F.lit(1.0)))
    return F.transform(labels, lambda x, i: F.struct(i.cast("bigint").alias("idx"), x.alias("text"), (t0 + (t1 - t0) * F.get(edges, i)).alias("start"), (t0 + (t1 - t0) * F.get(edges, i + 1)).alias("end")))


def equal_split(extent: DataFrame, parts: Column) -> DataFrame:
    """`parts` equal spans of each episode."""
    rows = extent.withColumn("_k", parts.cast("int")).where("_k > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_i"))
    at = lambda i: F.col("t0") + (F.col("t_last") - F.col("t0")) * i / F.col("_k")
    return rows.select("episode", F.col("_i").cast("long").alias("idx"), F.concat(F.lit("segment "), (F.col("_i") + 1).cast("string")).alias("text"), at(F.col("_i")).alias("start"), at(F.col("_i") + 1).alias("end"))


def generation_windows(extent: DataFrame, fps: float, budget: int) -> DataFrame:
    """Tail-balanced windows (start, end) of at most budget - 1 intervals of 1/fps s.

    Full windows come first; the last two share what is left, the odd interval going to
    the later one. With a budget of one frame or less the episode is divided equally,
    a part an interval. An episode without duration has no windows.
    """
    cap, length = max(budget - 1, 1), F.col("t_last") - F.col("t0")
    rows = extent.where(length > 0)
    if budget <= 1:
        rows = rows.withColumn("_k", F.greatest(F.lit(1), F.ceil(length * fps)).cast("long"))
        rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)).alias("idx"))
        return rows.select("episode", "idx", (F.col("t0") + length * F.col("idx") / F.col("_k")).alias("start"), (F.col("t0") + length * (F.col("idx") + 1) / F.col("_k")).alias("end"))
    rows = rows.withColumn("_n", F.greatest(F.lit(1), F.rint(length * fps)).cast("long")).withColumn("_k", F.ceil(F.col("_n") / cap).cast("long"))
    # intervals and start of the last two together
    rows = rows.withColumn("_full", F.greatest(F.col("_k") - 2, F.lit(0))).withColumn("_from", F.col("t0") + F.col("_full") * cap / fps).withColumn("_left", F.col("_n") - F.col("_full") * cap)
    middle = F.col("_from") + (F.col("t_last") - F.col("_from")) * F.floor(F.col("_left") / 2) / F.col("_left")
    edge = lambda i: F.when(i == 0, F.col("t0")).when(i == F.col("_k"), F.col("t_last")).when(i <= F.col("_full"), F.col("t0") + i * cap / fps).otherwise(middle)
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)).alias("idx"))
    return rows.select("episode", "idx", edge(F.col("idx")).alias("start"), edge(F.col("idx") + 1).alias("end"))


def fixed_windows(extent: DataFrame, seconds: float) -> DataFrame:
    """Windows of `seconds` from t0; the last is what is left."""
    k = F.greatest(F.lit(1), F.ceil((F.col("t_last") - F.col("t0")) / seconds)).cast("int")
    rows = extent.select("*", F.explode(F.sequence(F.lit(0), k - 1)).alias("_i"))
    return rows.select("episode", F.col("_i").cast("long").alias("idx"), (F.col("t0") + F.col("_i") * seconds).alias("start"), F.least(F.col("t0") + (F.col("_i") + 1) * seconds, F.col("t_last")).alias("end"))


def uniform_grid(extent: DataFrame, fps: float, budget: int) -> DataFrame:
    """Evenly spaced times, both ends included: round-half-even(duration * fps) + 1 of them, `budget` at most."""
    n = F.least(F.rint((F.col("t_last") - F.col("t0")) * fps).cast("int") + 1, F.lit(budget))
    rows = extent.withColumn("_n", F.greatest(n, F.lit(1)))
    step = F.when(F.col("_n") > 1, (F.col("t_last") - F.col("t0")) / (F.col("_n") - 1)).otherwise(0.0)
    return rows.select("episode", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_i"), "t0", step.alias("_s")).select("episode", F.col("_i").cast("long").alias("idx"), (F.col("t0") + F.col("_i") * F.col("_s")).alias("at"))
