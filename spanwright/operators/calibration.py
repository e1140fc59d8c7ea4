"""Fitting boundary offsets and duration priors, and what is made of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def boundary_errors(pred: DataFrame, ref: DataFrame, extent: DataFrame) -> DataFrame:
    """(episode, idx, e): predicted minus reference start over the episode's duration, of internal boundaries both have."""
    p = pred.select("episode", "idx", F.col("start").alias("p"))
    rows = ref.where("idx > 0").join(p, ["episode", "idx"]).join(extent, "episode").where("t_last > t0")
    return rows.select("episode", "idx", ((F.col("p") - F.col("start")) / (F.col("t_last") - F.col("t0"))).alias("e"))


def fit_offsets(errors: DataFrame) -> DataFrame:
    """The median error of each boundary."""
    return errors.groupBy("idx").agg(F.count("*").alias("n"), F.median("e").alias("offset"))


def residual_scale(errors: DataFrame, floor: float = 1e-3) -> DataFrame:
    """Pooled population deviation of the errors around their boundary's median, `floor` at least."""
    rows = errors.join(fit_offsets(errors).select("idx", "offset"), "idx")
    return rows.agg(F.greatest(F.lit(floor), F.stddev_pop(F.col("e") - F.col("offset"))).alias("residual_scale"), F.count("*").alias("n"))


def duration_fractions(ref: DataFrame, extent: DataFrame) -> DataFrame:
    """(idx, fraction): the median share of the episode that segment idx takes."""
    rows = ref.join(extent, "episode").where("t_last > t0")
    return rows.groupBy("idx").agg(F.median((F.col("end") - F.col("start")) / (F.col("t_last") - F.col("t0"))).alias("fraction"))


def cumulative_prior(ref: DataFrame, extent: DataFrame) -> DataFrame:
    """(idx, cumulative): running share of the normalised median fractions. One row a segment number."""
    f = duration_fractions(ref, extent)
    total = F.sum("fraction").over(Window.partitionBy())
    return f.select("idx", (F.sum("fraction").over(Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)) / total).alias("cumulative"))


def seed_statistics(values: DataFrame) -> DataFrame:
    """(cohort, stats) of values (cohort, episode, k, x): for each k in order, n, mean, sum of squares about it, and the middle values that a median without one of them needs."""
    own = Window.partitionBy("cohort", "k")
    ranked = values.withColumns({"_r": F.row_number().over(own.orderBy("x")), "_n": F.count("*").over(own)})
    first = F.when(F.col("_n") % 2 == 1, F.floor((F.col("_n") - 3) / 2)).otherwise(F.floor((F.col("_n") - 2) / 2)) + 1
    near = F.when(F.col("_r").between(first, first + 2), F.col("x"))
    one = ranked.groupBy("cohort", "k").agg(F.count("*").alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("*")).alias("square"), F.sort_array(F.collect_list(near)).alias("middle"))
    return one.groupBy("cohort").agg(F.array_sort(F.collect_list(F.struct("k", "n", "mean", "square", "middle"))).alias("stats"))


def leave_one_out(pred: DataFrame, ref: DataFrame, cohort: DataFrame) -> DataFrame:
    """(cohort, n_episodes, weight, held_out, bare) of episodes (episode, cohort): the duration weight that does best on episodes left out.

    Episodes whose prediction can't be fitted (seed_reason) don't take part. A cohort has one number of
    segments and any number of episodes: the fit of all but one follows from the cohort's sums and middle
    values, so each episode is a row of its own. With fewer than three, the weight is 1 and nothing is held out.
    """
    import pyarrow as pa

    from ..functions import kernels as K
    from .eligibility import seed_reason
    from .spans import pack

    usable = seed_reason(pred, ref).where("reason IS NULL").select("episode")
    rows = pack(pred, "p").join(pack(ref, "r"), "episode").join(usable, "episode", "left_semi").join(cohort.select("episode", "cohort"), "episode")
    kind, spans = dict(cohort.dtypes)["cohort"], lambda x: [(s["start"], s["end"], s["text"]) for s in x]

    def values(batches):
        for batch in batches:
            x = [K.seed_values(spans(p), spans(r)) for p, r in zip(batch["p"].to_pylist(), batch["r"].to_pylist(), strict=True)]
            size = np.array([len(v) for v in x], np.int64)
            flat = np.concatenate([np.array(v, float) for v in x]) if x else np.zeros(0)
            k = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            yield pa.RecordBatch.from_arrays([batch["cohort"].take(pa.array(np.repeat(np.arange(len(x)), size))), pa.array(k, pa.int64()), pa.array(flat, pa.float64())], ["cohort", "k", "x"])

    def held(batches):
        for batch in batches:
            out = []
            for row in batch.select(["p", "r", "stats"]).to_pylist():
                p, r, stats = spans(row["p"]), spans(row["r"]), row["stats"]
                if len({s["n"] for s in stats}) > 1:
                    raise ValueError("a positional calibration requires one segment count")
                if stats[0]["n"] < 3:
                    out.append([float("nan")] * (len(K.WEIGHTS) + 1))
                    continue
                model = K.left_out_model(p, r, stats)
                out.append([K.placed_iou(K.corrected(p, model, w), r) for w in K.WEIGHTS] + [K.placed_iou(K.corrected(p, {}), r)])
            yield pa.RecordBatch.from_arrays([batch["cohort"], *[pa.array([x[i] for x in out], pa.float64()) for i in range(len(K.WEIGHTS) + 1)]], ["cohort", *names])

    names = [*[f"w{i}" for i in range(len(K.WEIGHTS))], "bare"]
    stats = seed_statistics(rows.select("cohort", "p", "r").mapInArrow(values, f"cohort {kind}, k long, x double"))
    # a set number of tasks, as the runtime would join small exchanges into one: an episode takes milliseconds
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.alias("a").join(stats.alias("b"), F.expr("a.cohort <=> b.cohort")).select("episode", "a.cohort", "p", "r", "stats").repartition(spread, "episode").drop("episode")
    judged = placed.mapInArrow(held, f"cohort {kind}, " + ", ".join(f"{n} double" for n in names))
    means = judged.groupBy("cohort").agg(F.count("*").alias("n_episodes"), *[F.avg(n).alias(n) for n in names])
    tried = F.array(*names[:-1])
    best = F.get(F.array(*[F.lit(w) for w in K.WEIGHTS]), (F.array_position(tried, F.array_max(tried)) - 1).cast("int"))  # the first of equals
    few = F.col("n_episodes") < 3
    return means.select("cohort", "n_episodes", F.when(few, 1.0).otherwise(best).alias("weight"), F.array_max(tried).alias("held_out"), "bare")


def accept(first_mae: Column, gain: Column, least_mae: float = 1.5, least_gain: float = 3.0) -> Column:
    """The reason a fit is refused, or null: too little bias at the first boundary, or too little held-out gain."""
    return F.when(first_mae < least_mae, "first boundary error below limit").when(gain < least_gain, "held-out gain below limit")


def count_positions(ref: DataFrame, least: int = 3) -> DataFrame:
    """(n_segments, i, position): median relative boundary i of the episodes of a number of segments (at least `least`), made non-decreasing and at most 1."""
    rel = relative_boundaries(ref)
    own = rel.groupBy("n_segments", "i").agg(F.count("*").alias("n"), F.median("x").alias("m")).where(F.col("n") >= least)
    w = Window.partitionBy("n_segments").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return own.select("n_segments", "i", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.max("m").over(w))).alias("position"))


def relative_boundaries(ref: DataFrame) -> DataFrame:
    """(episode, n_segments, i, x): internal starts over the spans' own extent, i from 1."""
    w = Window.partitionBy("episode")
    rows = ref.withColumns({"_t0": F.min_by("start", "idx").over(w), "_t1": F.max_by("end", "idx").over(w), "n_segments": F.count("*").over(w), "i": F.row_number().over(w.orderBy("idx")) - 1})
    return rows.where("i > 0 AND _t1 > _t0").select("episode", "n_segments", "i", ((F.col("start") - F.col("_t0")) / (F.col("_t1") - F.col("_t0"))).alias("x"))


def progress_curve(ref: DataFrame) -> DataFrame:
    """(x, y): fraction of segments done to fraction of the episode, medians of all episodes' boundaries, never falling, with both ends."""
    knots = relative_boundaries(ref).groupBy(F.round(F.col("i") / F.col("n_segments"), 9).alias("x")).agg(F.median("x").alias("m"))
    ends = knots.sparkSession.sql("SELECT * FROM VALUES (0D, 0D), (1D, 1D) AS t(x, m)")
    # one row a fraction: as many as there are pairs of small numbers
    w = Window.orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    return knots.where("x > 0 AND x < 1").unionByName(ends).select("x", F.least(F.lit(1.0), F.max("m").over(w)).alias("y"))


def route(episodes: DataFrame, fits: DataFrame) -> DataFrame:
    """Episodes (task, n_segments, arm, ...) with the fit of their task, count and arm, or the arm's uncalibrated counterpart and a reason.

    fits: (task, n_segments, arm, fit), one row each.
    """
    out = episodes.join(fits, ["task", "n_segments", "arm"], "left")
    return out.withColumn("route", F.when(F.col("fit").isNull(), F.col("counterpart")).otherwise(F.col("arm"))).withColumn("reason", F.when(F.col("fit").isNull(), "no fit for task and count"))


def runtime_reason(configured: Column, n_placed: Column, scope: Column, exact_needed: Column, labels: Column, want: Column, n_segments: Column) -> Column:
    """Why a calibration isn't applied to an episode, in order, or 'applied'."""
    return (
        F.when(~configured, "not_configured").when(n_placed == 0, "empty_prediction").when(exact_needed & ((scope == "segment_count") | (F.size(want) == 0)), "generated_requires_exact_labels")
        .when((scope == "segment_count") & (F.size(labels) != n_segments), "segment_count_mismatch").when((scope != "segment_count") & (F.size(want) > 0) & (labels != want), "label_mismatch").otherwise("applied")
    )
