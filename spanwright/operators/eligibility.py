"""Who takes part: reasons that leave an episode, a row, a task or a feature out, and the repairs that keep one in.

A reason is the first failing check, as text, or null. Spans are long-form and judged an episode at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .spans import by_episode

SLACK = 1e-6


def _finite(c: str) -> Column:
    return F.coalesce(~F.isnan(c) & (F.abs(F.col(c)) != float("inf")), F.lit(False))


def _first(*checks: tuple[Column, str]) -> Column:
    """The text of the first check that holds for any row of the group."""
    return F.coalesce(*[F.when(F.max(F.coalesce(hit, F.lit(False))), text) for hit, text in checks])


def timing_reason(spans: DataFrame) -> DataFrame:
    """(episode, reason): why a seed's timeline can't be used."""
    w = by_episode("idx")
    rows = spans.withColumns({"_next": F.lead("start").over(w)})
    nonfinite = ~(_finite("start") & _finite("end"))
    return rows.groupBy("episode").agg(_first((nonfinite, "nonfinite_timestamp"), (F.col("end") <= F.col("start"), "nonpositive_span"), (F.col("_next") <= F.col("start"), "nonincreasing_starts"), (F.col("end") > F.col("_next"), "overlapping_spans")).alias("reason"))


def truth_reason(spans: DataFrame) -> DataFrame:
    """(episode, reason): why recorded truth isn't valid: label, finite times, start from 0, positive length, order."""
    w = by_episode("idx")
    rows = spans.withColumn("_before", F.lag("end").over(w))
    return rows.groupBy("episode").agg(
        _first(
            (F.col("text").isNull(), "label missing"), (~(_finite("start") & _finite("end")), "time not finite"), (F.col("start") < 0, "start before 0"),
            (F.col("end") <= F.col("start"), "no duration"), (F.col("start") < F.col("_before"), "starts before the previous end"),
        ).alias("reason")
    )


def _side_reason(spans: DataFrame, name: str) -> DataFrame:
    w, whole = by_episode("idx"), Window.partitionBy("episode")
    rows = spans.withColumns({"_next": F.lead("start").over(w), "_t0": F.min_by("start", "idx").over(whole), "_t1": F.max_by("end", "idx").over(whole)})
    checks = (
        (F.trim(F.coalesce("text", F.lit(""))) == "", f"{name} contains an empty or invalid label"), (~(_finite("start") & _finite("end")), f"{name} contains nonfinite timestamps"),
        (F.col("_t1") <= F.col("_t0"), f"{name} has zero or negative episode duration"), (F.col("end") <= F.col("start"), f"{name} contains a zero or negative segment duration"),
        (F.col("_next") <= F.col("start"), f"{name} has non-increasing boundaries"),
    )
    return rows.groupBy("episode").agg(F.count("*").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]).alias("labels"), _first(*checks).alias("reason"))


def seed_reason(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """(episode, reason) of every reference episode: why a prediction can't fit a calibration, or null."""
    r, p = _side_reason(ref, "ground truth"), _side_reason(pred, "prediction")
    p = p.select("episode", *[F.col(c).alias("p_" + c) for c in ("n", "labels", "reason")])
    whole = (
        F.when(F.col("n") < 2, "ground truth needs at least two segments")
        .when(F.coalesce("p_n", F.lit(0)) != F.col("n"), "prediction is incomplete or has a different segment count")
        .otherwise(F.coalesce("reason", "p_reason", F.when(F.col("labels") != F.col("p_labels"), "prediction labels do not exactly match its ground truth in order")))
    )
    return r.join(p, "episode", "left").select("episode", whole.alias("reason"))


def tiles(spans: DataFrame, slack: float = SLACK) -> DataFrame:
    """(episode, tiled): whether each span ends where the next starts."""
    gap = F.abs(F.lead("start").over(by_episode("idx")) - F.col("end"))
    return spans.withColumn("_gap", gap).groupBy("episode").agg(F.coalesce(F.max("_gap") <= slack, F.lit(True)).alias("tiled"))


def timing_only(before: DataFrame, after: DataFrame, slack: float = SLACK) -> DataFrame:
    """(episode, reason): how a correction changed more than inner times: number, labels, ends of the episode, order, gaps."""

    def side(x, p):
        own = x.groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("idx", "text", "start", "end"))).alias("s"))
        return own.select("episode", F.col("s").alias(p), F.transform("s", lambda v: v["text"]).alias(p + "_l"))

    rows = side(before, "a").join(side(after, "b"), "episode", "full")
    first, last = lambda c: F.col(c)[0]["start"], lambda c: F.element_at(c, -1)["end"]
    steps = F.sequence(F.lit(0), F.greatest(F.size("b") - 2, F.lit(0)))
    pair = lambda hit: F.exists(F.filter(steps, lambda i: i + 1 < F.size("b")), lambda i: hit(F.get("b", i), F.get("b", i + 1)))
    reason = (
        F.when(F.col("a").isNull() | F.col("b").isNull() | (F.size("a") != F.size("b")), "number of spans changed")
        .when(F.col("a_l") != F.col("b_l"), "labels changed")
        .when((F.abs(first("a") - first("b")) > slack) | (F.abs(last("a") - last("b")) > slack), "episode endpoints changed")
        .when(F.exists("b", lambda s: s["end"] < s["start"]) | pair(lambda x, y: y["start"] < x["start"]), "out of order")
        .when(pair(lambda x, y: F.abs(x["end"] - y["start"]) > slack), "not contiguous")
    )
    return rows.select("episode", reason.alias("reason"))


def population(rows: DataFrame, fields: list[str], arm: str = "arm") -> DataFrame:
    """Rows whose every listed field is true. A field that is null anywhere is an error: unknown isn't ineligible."""
    lost = rows.agg(*[F.array_sort(F.collect_set(F.when(F.col(f).isNull(), F.col(arm)))).alias(f) for f in fields]).first()  # arms: some dozens
    for f in fields:
        if lost[f]:
            raise ValueError(f"population field {f!r} is missing for arms {lost[f]}")
    return rows.where(" AND ".join(f"`{f}`" for f in fields)) if fields else rows


def usable_score(kind: str = "all_scored") -> Column:
    """Rows that count: scored ones (ok where nothing says whether), or successful ones that weren't refused."""
    if kind == "successful":
        return F.coalesce("ok", F.lit(False)) & F.coalesce("scored", F.lit(True))
    return F.coalesce("scored", "ok", F.lit(False))


def one_run(rows: DataFrame, matcher: str | None = None, repeat: int | None = 0) -> DataFrame:
    """Rows of one matcher and one repeat (a missing repeat is 0); None takes any."""
    rows = rows if matcher is None else rows.where(F.col("matcher") == matcher)
    return rows if repeat is None else rows.where(F.coalesce("repeat", F.lit(0)) == repeat)


def named(column: str, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """Names that hold any of include (all where it is empty) and none of exclude."""
    any_of = lambda xs: F.array_contains(F.transform(F.array(*[F.lit(x) for x in xs]), lambda x: F.contains(F.col(column), x)), True)
    out = any_of(include) if include else F.lit(True)
    return out & ~any_of(exclude) if exclude else out


def mixed_configs(rows: DataFrame, form: str = "format", fingerprint: str = "config_fingerprint") -> DataFrame:
    """(format, n) of the formats whose results come from more than one configuration."""
    return rows.groupBy(form).agg(F.count_distinct(fingerprint).alias("n")).where("n > 1")


def bad_task(text: Column, least_words: int, placeholders: tuple[str, ...]) -> Column:
    """Whether a task text says nothing: empty, too few words, or a placeholder."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return (t == "") | (F.size(F.split(t, r"\s+")) < least_words) | F.lower(t).isin(*placeholders)


def finite_rows(rows: DataFrame, value: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a finite value, number dropped by key)."""
    ok = F.coalesce(~F.isnan(F.col(value).cast("double")) & (F.abs(F.col(value)) != float("inf")), F.lit(False))
    return rows.where(ok), rows.groupBy(*keys).agg(F.count_if(~ok).alias("n_dropped"))


def usable_feature(dtype: Column, shape: Column) -> Column:
    """Whether a feature is a float vector of at most 256 dimensions."""
    return F.startswith(dtype, F.lit("float")) & (F.size(shape) == 1) & (F.get(shape, F.lit(0)) > 0) & (F.get(shape, F.lit(0)) <= 256)


def cameras(wanted: Column, have: Column, budget: int, default: Column) -> Column:
    """The wanted cameras that exist, in the order wanted, at most budget; the default where none does."""
    found = F.slice(F.array_intersect(wanted, have), 1, budget)
    return F.when(F.size(found) > 0, found).otherwise(F.array(default))


def clean_spans(spans: DataFrame, extent: DataFrame) -> DataFrame:
    """Text trimmed, times held in the episode and swapped where they are the wrong way round, in order of start.

    A span without text or with a time that isn't finite is an error.
    """
    bad = (F.trim(F.coalesce("text", F.lit(""))) == "") | ~(_finite("start") & _finite("end"))
    checked = lambda c: F.when(bad, F.raise_error(F.concat(F.lit("episode "), F.col("episode").cast("string"), F.lit(": a span needs text and finite times")))).otherwise(c)
    held = lambda c: F.least(F.greatest(F.col(c), F.col("t0")), F.col("t_last"))
    rows = spans.join(extent.select("episode", "t0", "t_last"), "episode").select("episode", "idx", checked(F.trim("text")).alias("text"), F.least(held("start"), held("end")).alias("start"), F.greatest(held("start"), held("end")).alias("end"))
    return rows.withColumn("idx", (F.row_number().over(by_episode("start", "idx")) - 1).cast("long"))


def distinct_frames(spans: DataFrame, frames: DataFrame) -> DataFrame:
    """Starts moved to frames, no two to one: to the nearest, or where that is taken to the next free later one; dropped where none is.

    In order of start, the n-th span's frame is the larger of its own and the one after the
    previous span's, which is n plus the running maximum of (own frame - n): no state is carried.
    """
    from .spans import snap_to_frame

    number = frames.select("episode", F.col("t").alias("frame_t")).distinct().withColumn("frame", F.row_number().over(by_episode("frame_t")).cast("long"))
    ids = spans.select("episode", F.col("idx").alias("id"), F.col("start").alias("at"))
    own = snap_to_frame(ids, frames).join(number, ["episode", "frame_t"]).select("episode", F.col("id").alias("idx"), "frame")
    w = by_episode("start", "idx")
    rows = spans.join(own, ["episode", "idx"]).withColumn("n", F.row_number().over(w))
    free = (F.col("n") + F.max(F.col("frame") - F.col("n")).over(w.rowsBetween(Window.unboundedPreceding, 0))).alias("frame")
    rows = rows.select("episode", "idx", "text", "end", free).join(number, ["episode", "frame"])
    return rows.select("episode", "idx", "text", F.col("frame_t").alias("start"), F.greatest("end", "frame_t").alias("end"))


def under_covered(placed: Column, given: Column, threshold: float) -> Column:
    """Whether too few of the given labels were placed; a threshold of 0 asks for nothing."""
    return F.lit(False) if threshold <= 0 else F.coalesce(placed / given < threshold, F.lit(False))


def accept_realigned(generated: DataFrame, aligned: DataFrame) -> DataFrame:
    """The aligned spans of episodes whose labels came back in the same order, else the generated ones; `realigned` tells."""
    labels = lambda x, n: x.groupBy("episode").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda s: s["text"]).alias(n))
    same = labels(generated, "a").join(labels(aligned, "b"), "episode", "left").select("episode", F.coalesce(F.col("a") == F.col("b"), F.lit(False)).alias("realigned"))
    keep = lambda x, want: x.join(same, "episode").where(F.col("realigned") == want).select("episode", "idx", "text", "start", "end", "realigned")
    return keep(aligned, True).unionByName(keep(generated, False))


def low_confidence(model: Column, solved: Column, residual_scale: float, length: Column) -> Column:
    """Whether the solver moved a boundary by more than three residual scales of the episode."""
    moved = F.array_max(F.zip_with(model, solved, lambda a, b: F.abs(a - b)))
    return F.coalesce(moved > 3 * residual_scale * length, F.lit(False))


def samples_per_segment(points: DataFrame, spans: DataFrame) -> DataFrame:
    """(episode, idx, n) of points (episode, at) in [start, end), the last span including its end."""
    last = F.col("idx") == F.max("idx").over(Window.partitionBy("episode"))
    s = spans.withColumn("_last", last)
    inside = (F.col("at") >= F.col("start")) & ((F.col("at") < F.col("end")) | (F.col("_last") & (F.col("at") == F.col("end"))))
    hits = points.select("episode", "at").join(s, "episode").where(inside).groupBy("episode", "idx").agg(F.count("*").alias("n"))
    return spans.select("episode", "idx").join(hits, ["episode", "idx"], "left").select("episode", "idx", F.coalesce("n", F.lit(0)).alias("n"))


def to_absolute(spans: DataFrame, origins: DataFrame) -> DataFrame:
    """Times of spans relative to an origin (episode, origin) as times of the episode."""
    return spans.join(origins, "episode").select("episode", "idx", "text", (F.col("start") + F.col("origin")).alias("start"), (F.col("end") + F.col("origin")).alias("end"))


def gap_frames(clips: DataFrame) -> DataFrame:
    """(episode, gap): frames between clips (first, last) that no clip holds."""
    step = F.col("first") - F.lag("last").over(by_episode("first"))
    return clips.withColumn("_d", step).groupBy("episode").agg(F.coalesce(F.sum(F.when(F.col("_d") > 1, F.col("_d") - 1)), F.lit(0)).alias("gap"))


def explicit_indices(spans: DataFrame, labels: DataFrame) -> DataFrame:
    """(episode, reason) of spans (label_index, text) against labels (idx, text): what is wrong with their indices.

    Null where all is well, 'none' where no span has an index; some with and some without is an error.
    """
    l = labels.select("episode", F.col("idx").alias("label_index"), F.col("text").alias("_label"))
    before = F.lag("label_index").over(by_episode("idx"))
    rows = spans.withColumn("_before", before).join(l, ["episode", "label_index"], "left")
    has = F.count("label_index")
    wrong = _first(
        (F.col("label_index").isNotNull() & F.col("_label").isNull(), "label index out of range"), (F.col("label_index") <= F.col("_before"), "label indices are not strictly increasing"),
        (F.col("text").isNotNull() & (F.col("text") != F.col("_label")), "span carries another text"),
    )
    return rows.groupBy("episode").agg(F.when(has == 0, "none").when(has < F.count("*"), "some spans carry a label index and others do not").otherwise(wrong).alias("reason"))
