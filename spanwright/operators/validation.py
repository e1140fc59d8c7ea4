"""Violation queries over language rows (episode, t, style, role, content, camera). Each gives (episode, check, severity, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Which styles live on every frame of an episode, and which on one frame.
PERSISTENT = ("subtask", "plan", "memory", "task_aug")
EVENTS = ("interjection", "vqa")


def route(style: Column) -> Column:
    """The column a style belongs to; null style is speech, an event. Null for an unknown style."""
    return F.when(style.isNull() | style.isin(*EVENTS), "events").when(style.isin(*PERSISTENT), "persistent")


def _found(rows: DataFrame, check: str, severity: str, detail: Column) -> DataFrame:
    return rows.select("episode", F.lit(check).alias("check"), F.lit(severity).alias("severity"), detail.cast("string").alias("detail"))


def bad_route(rows: DataFrame) -> DataFrame:
    return _found(rows.where(route(F.col("style")).isNull()), "routing", "error", F.col("style"))


def off_frame(rows: DataFrame, frames: DataFrame) -> DataFrame:
    """Event rows whose time isn't exactly a frame's."""
    events = rows.where(route(F.col("style")) == "events")
    return _found(events.join(frames.select("episode", "t"), ["episode", "t"], "left_anti"), "off_frame", "error", F.col("t"))


def orphans(rows: DataFrame) -> DataFrame:
    """Interjections without speech at the same time."""
    speech = rows.where("style IS NULL").select("episode", "t")
    return _found(rows.where("style = 'interjection'").join(speech, ["episode", "t"], "left_anti"), "orphan_interjection", "error", F.col("t"))


def plan_missing(rows: DataFrame) -> DataFrame:
    plans = rows.where("style = 'plan'").select("episode", "t")
    return _found(rows.where("style = 'interjection'").join(plans, ["episode", "t"], "left_anti"), "plan_missing", "error", F.col("t"))


def memory_off_subtask(rows: DataFrame) -> DataFrame:
    starts = rows.where("style = 'subtask'").select("episode", "t")
    return _found(rows.where("style = 'memory'").join(starts, ["episode", "t"], "left_anti"), "memory_off_subtask", "warning", F.col("t"))


def vqa_repeats(rows: DataFrame) -> DataFrame:
    many = rows.where("style = 'vqa'").groupBy("episode", "t", "camera", "role").count().where("count > 1")
    return _found(many, "vqa_repeated", "error", F.col("t"))


def missing_plans(rows: DataFrame) -> DataFrame:
    """Multiset difference: subtask times less plan times, with how many are missing."""
    n = lambda style: F.count_if(F.col("style") == style)
    short = rows.groupBy("episode", "t").agg(F.greatest(n("subtask") - n("plan"), F.lit(0)).alias("short")).where("short > 0")
    return _found(short, "plan_incomplete", "completeness", F.concat_ws(" x", F.col("t").cast("string"), F.col("short").cast("string")))


def bad_content(rows: DataFrame) -> DataFrame:
    """Rows with neither content nor being speech; vqa answers that aren't a JSON object."""
    empty = F.col("content").isNull() & F.col("style").isNotNull()
    answer = (F.col("style") == "vqa") & (F.col("role") == "assistant") & F.json_object_keys("content").isNull()
    return _found(rows.where(empty | answer), "content", "error", F.coalesce("style", F.lit("speech")))


def all_violations(rows: DataFrame, frames: DataFrame) -> DataFrame:
    checks = [bad_route(rows), off_frame(rows, frames), orphans(rows), plan_missing(rows), memory_off_subtask(rows), vqa_repeats(rows), missing_plans(rows), bad_content(rows)]
    return reduce(DataFrame.unionByName, checks)


def publish_gate(violations: DataFrame, episodes: DataFrame, most_skipped: float = 0.5) -> DataFrame:
    """One row: episodes left out for completeness, structural errors on the rest, and whether to publish."""
    skipped = violations.where("severity = 'completeness'").select("episode").distinct()
    hard = violations.where("severity = 'error'").join(skipped, "episode", "left_anti").agg(F.count("*").alias("n_errors"))
    out = episodes.agg(F.count_distinct("episode").alias("n")).join(skipped.agg(F.count("*").alias("n_skipped"))).join(hard)
    return out.withColumn("publish", (F.col("n_errors") == 0) & (F.col("n_skipped") < F.col("n")) & (F.col("n_skipped") <= most_skipped * F.col("n")))


def bad_times(frames: DataFrame) -> DataFrame:
    """Frames whose time is missing, not finite, negative, or not after the one before."""
    before = F.lag("t").over(Window.partitionBy("episode").orderBy("frame"))
    reason = F.when(F.col("t").isNull() | F.isnan("t") | (F.abs("t") == float("inf")), "not finite").when(F.col("t") < 0, "negative").when(before >= F.col("t"), "not increasing")
    return frames.withColumn("reason", reason).where("reason IS NOT NULL").select("episode", "frame", "reason")


def missing_cells(observed: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Cells of the expected matrix of two small lists that weren't observed."""
    return left.join(F.broadcast(right)).join(observed, [*left.columns, *right.columns], "left_anti")


def split_problems(rows: DataFrame, most_seeds: int = 10) -> DataFrame:
    """(problem, n) of splits (task, episode, role, has_truth): tasks with too many seeds, episodes named twice in a role,
    in two tasks or in two roles, seeds without truth."""
    seeds = rows.where("role = 'seed'")
    found = [
        ("too many seeds", seeds.groupBy("task").count().where(F.col("count") > most_seeds)),
        ("repeated", rows.groupBy("task", "role", "episode").count().where("count > 1")),
        ("shared", rows.groupBy("episode").agg(F.count_distinct("task").alias("a"), F.count_distinct("role").alias("b")).where("a > 1 OR b > 1")),
        ("seed without truth", seeds.where(~F.coalesce("has_truth", F.lit(False))).select("task", "episode").distinct()),
    ]
    out = [x.agg(F.lit(name).alias("problem"), F.count("*").alias("n")) for name, x in found]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def label_problems(rows: DataFrame, label: str) -> DataFrame:
    """Rows whose label is empty, or changes when white space at its ends is taken off."""
    bare = F.trim(F.coalesce(label, F.lit("")))
    return rows.withColumns({"empty": bare == "", "unstripped": ~F.col(label).eqNullSafe(bare)}).where("empty OR unstripped")


def coverage_difference(got: DataFrame, want: DataFrame, group: str, key: str) -> DataFrame:
    """(group, missing, unexpected) of the groups whose keys aren't exactly the wanted ones."""
    side = lambda x, name: x.select(group, key).distinct().withColumn(name, F.lit(1))
    both = side(got, "_g").join(side(want, "_w"), [group, key], "full")
    return both.groupBy(group).agg(F.count_if(F.col("_g").isNull()).alias("missing"), F.count_if(F.col("_w").isNull()).alias("unexpected")).where("missing + unexpected > 0")


def same_labels(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """(episode, same): whether the labels are the reference's, in order."""
    labels = lambda x, n: x.groupBy("episode").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda s: s["text"]).alias(n))
    return labels(ref, "r").join(labels(pred, "p"), "episode", "left").select("episode", F.coalesce(F.col("p") == F.col("r"), F.lit(False)).alias("same"))


def camera_problems(rows: DataFrame, known: list[str], styles: tuple[str, ...] = ("vqa", "trace")) -> DataFrame:
    """Rows whose camera doesn't fit: view-dependent styles need a known one, the others none."""
    dependent = F.coalesce(F.col("style").isin(*styles), F.lit(False))
    problem = F.when(dependent & F.col("camera").isNull(), "camera missing").when(dependent & ~F.col("camera").isin(*known), "unknown camera").when(~dependent & F.col("camera").isNotNull(), "camera given")
    return rows.withColumn("problem", problem).where("problem IS NOT NULL")
