"""Scores of predicted against reference spans, one row an episode.

Both sides are long-form spans. Pairs are made inside an episode only (an
equi-join on it with what is left as a filter); an episode has tens of spans.
Pairs that can't count, as they touch too little, go in the join's own condition,
before labels are compared: what passes grows with spans, not with pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import EXACT, normalise_label
from .spans import by_episode, collapse


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0.0))


def iou(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Intersection over the hull; 1 for two equal spans without length."""
    hull = F.greatest(a1, b1) - F.least(a0, b0)
    return F.when(hull > 0, overlap(a0, a1, b0, b1) / hull).when((a0 == b0) & (a1 == b1), 1.0).otherwise(0.0)


def pairs(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """All (p, r) of an episode with their iou and overlap."""
    p = pred.select("episode", *[F.col(c).alias("p_" + c) for c in ("idx", "text", "start", "end")])
    r = ref.select("episode", *[F.col(c).alias("r_" + c) for c in ("idx", "text", "start", "end")])
    args = [F.col(c) for c in ("p_start", "p_end", "r_start", "r_end")]
    return p.join(r, "episode").withColumns({"iou": iou(*args), "overlap": overlap(*args)})


def covering(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """Duration-weighted best overlap of each reference span, the same the other way, and their harmonic mean.

    Where the covered side has no duration: 1 if the other side is empty, else 0.
    """

    def one(a, b, name):
        best = pairs(b, a).where("iou > 0").groupBy("episode", "r_idx").agg(F.max("iou").alias("best"))
        rows = a.join(best, (a["episode"] == best["episode"]) & (a["idx"] == best["r_idx"]), "left").select(a["episode"], (F.col("end") - F.col("start")).alias("d"), F.coalesce("best", F.lit(0.0)).alias("best"))
        total = F.sum("d")
        return rows.groupBy("episode").agg(F.when(total > 0, F.sum(F.col("d") * F.col("best")) / total).alias(name))

    has = lambda x, name: x.groupBy("episode").agg(F.count("*").alias(name))
    out = one(ref, pred, "covering").join(one(pred, ref, "covering_pred"), "episode", "full").join(has(pred, "_p"), "episode", "left").join(has(ref, "_r"), "episode", "left")
    # a side without duration is covered only by nothing
    bare = lambda other: F.when(F.col(other).isNull(), 1.0).otherwise(0.0)
    out = out.select("episode", F.coalesce("covering", bare("_p")).alias("covering"), F.coalesce("covering_pred", bare("_r")).alias("covering_pred"))
    both = F.col("covering") + F.col("covering_pred")
    return out.select("episode", "covering", "covering_pred", F.when(both > 0, 2 * F.col("covering") * F.col("covering_pred") / both).otherwise(0.0).alias("covering_f"))


def chamfer(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """Mean distance from each internal boundary to the nearest of the other side, both ways; null where a side has none."""
    side = lambda x, n: x.where("idx > 0").select("episode", F.col("start").alias("at"), F.lit(n).alias("side"))
    # one sort of both sides each way: the nearest of the other side is the last one before or after
    rows = side(pred, 0).unionByName(side(ref, 1))
    other = lambda w, n: F.last(F.when(F.col("side") != n, F.col("at")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    up, down = by_episode("at", "side"), by_episode(F.col("at").desc(), F.col("side").desc())
    rows = rows.withColumns({f"_{k}{n}": other(w, n) for n in (0, 1) for k, w in (("u", up), ("d", down))})
    mean = lambda n: F.avg(F.when(F.col("side") == n, F.least(F.abs(F.col("at") - F.col(f"_u{n}")), F.abs(F.col(f"_d{n}") - F.col("at")))))
    found = rows.groupBy("episode").agg(mean(0).alias("pred_to_ref"), mean(1).alias("ref_to_pred"))
    every = pred.select("episode").union(ref.select("episode")).distinct()
    return every.join(found, "episode", "left").select("episode", "pred_to_ref", "ref_to_pred", ((F.col("pred_to_ref") + F.col("ref_to_pred")) / 2).alias("chamfer"))


def segment_counts(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """Numbers of spans, their signed and absolute difference, ratio and log ratio (NaN where a side has none)."""
    p, r = pred.groupBy("episode").agg(F.count("*").alias("n_pred")), ref.groupBy("episode").agg(F.count("*").alias("n_ref"))
    out = r.join(p, "episode", "full").select("episode", F.coalesce("n_pred", F.lit(0)).alias("n_pred"), F.coalesce("n_ref", F.lit(0)).alias("n_ref"))
    d, ok = F.col("n_pred") - F.col("n_ref"), (F.col("n_pred") > 0) & (F.col("n_ref") > 0)
    return out.select("*", d.alias("count_error"), F.abs(d).alias("abs_count_error"), F.try_divide("n_pred", "n_ref").alias("count_ratio"), F.when(ok, F.log(F.col("n_pred") / F.col("n_ref"))).otherwise(float("nan")).alias("log_count_ratio"))


def labelled_pairs(pred: DataFrame, ref: DataFrame, matcher=EXACT, counts: Column | None = None) -> DataFrame:
    """pairs() with `same` and `sim`: whether the matcher takes the labels as one, and how similar (0 to 1) they are; only those that count, where a condition says which do."""
    both = pairs(pred, ref)
    return matcher.scored(both if counts is None else both.where(counts), "p_text", "r_text")


def f1_at_iou(pred: DataFrame, ref: DataFrame, thresholds: tuple[float, ...] = (0.10, 0.25, 0.50), matcher=EXACT) -> DataFrame:
    """Precision, recall and F1 over labelled spans, touching ones of one label merged first. A prediction takes its best
    equivalent reference, the first of equals, even one already claimed; only the first claim counts."""
    pred, ref = (collapse(x, same_label=normalise_label) for x in (pred, ref))
    best = labelled_pairs(pred, ref, matcher, F.col("iou") >= min(thresholds)).where("same").groupBy("episode", "p_idx").agg(F.max(F.struct("iou", -F.col("r_idx"))).alias("b")).select("episode", "p_idx", F.col("b.iou").alias("iou"), (-F.col("b.col2")).alias("r_idx"))
    sizes = segment_counts(pred, ref).select("episode", "n_pred", "n_ref")
    tag = lambda t: round(t * 100)
    claims = best.groupBy("episode", "r_idx").agg(*[F.max((F.col("iou") >= t).cast("int")).alias(f"c{tag(t)}") for t in thresholds])
    out = sizes.join(claims.groupBy("episode").agg(*[F.sum(f"c{tag(t)}").alias(f"tp_{tag(t)}") for t in thresholds]), "episode", "left")
    cols = []
    for t in thresholds:
        tp = F.coalesce(f"tp_{tag(t)}", F.lit(0)).cast("double")
        cols += [F.coalesce(F.try_divide(2 * tp, F.col("n_pred") + F.col("n_ref")), F.lit(0.0)).alias(f"f1_{tag(t)}"), F.coalesce(F.try_divide(tp, F.col("n_pred")), F.lit(0.0)).alias(f"precision_{tag(t)}"), F.coalesce(F.try_divide(tp, F.col("n_ref")), F.lit(0.0)).alias(f"recall_{tag(t)}")]
    return out.select("episode", *cols)


def dense_caption(pred: DataFrame, ref: DataFrame, thresholds: tuple[float, ...] = (0.3, 0.5, 0.7, 0.9), matcher=EXACT) -> DataFrame:
    """Mean over reference spans of the best similarity among predictions of IoU over each threshold, and the mean of these."""
    best = labelled_pairs(pred, ref, matcher, F.col("iou") >= min(thresholds)).groupBy("episode", "r_idx").agg(*[F.max(F.when(F.col("iou") >= t, F.col("sim")).otherwise(0.0)).alias(f"h{round(t * 10)}") for t in thresholds])
    rows = ref.select("episode", F.col("idx").alias("r_idx")).join(best, ["episode", "r_idx"], "left")
    cols = [F.avg(F.coalesce(f"h{round(t * 10)}", F.lit(0.0))).alias(f"recall_{round(t * 10)}") for t in thresholds]
    out = rows.groupBy("episode").agg(*cols)
    return out.withColumn("recall_mean", sum((F.col(f"recall_{round(t * 10)}") for t in thresholds), F.lit(0.0)) / len(thresholds))


def label_accuracy(pred: DataFrame, ref: DataFrame, matcher=EXACT) -> DataFrame:
    """Share of reference time that equivalent predictions overlap, at most its own length a span; 0 without duration."""
    got = labelled_pairs(pred, ref, matcher, F.col("overlap") > 0).where("same").groupBy("episode", "r_idx").agg(F.sum("overlap").alias("o"))
    rows = ref.select("episode", F.col("idx").alias("r_idx"), (F.col("end") - F.col("start")).alias("d")).join(got, ["episode", "r_idx"], "left")
    return rows.groupBy("episode").agg(F.coalesce(F.try_divide(F.sum(F.least(F.coalesce("o", F.lit(0.0)), F.col("d"))), F.sum("d")), F.lit(0.0)).alias("label_accuracy"))


def mof(pred: DataFrame, ref: DataFrame, step: float = 0.1, matcher=EXACT) -> DataFrame:
    """Share of a grid's midpoints, `step` apart over the reference's extent, where both sides say the same.

    A grid has max(1, int(duration / step)) points; an uncovered point is wrong; 0 and no points without duration.
    """
    extent = ref.groupBy("episode").agg(F.min_by("start", "idx").alias("t0"), F.max_by("end", "idx").alias("t1"))
    length = F.col("t1") - F.col("t0")
    n = F.when(length > 0, F.greatest(F.lit(1), F.floor(length / step).cast("long"))).otherwise(0)
    grid = extent.withColumns({"_n": n, "_s": F.least(F.lit(step), length)}).where("_n > 0").select("episode", "t0", "_n", "_s")
    nothing = F.lit(None).cast("struct<idx:bigint,text:string>")

    def inside(spans, side):
        """(episode, id, r, p): each span at the grid's points in it, which come from its own bounds; no pairs of points and spans."""
        near = lambda t: F.floor(F.greatest(F.lit(0.0), F.least(F.col("_n").cast("double"), (F.col(t) - F.col("t0")) / F.col("_s")))).cast("long")
        rows = spans.join(grid, "episode").withColumns({"_a": F.greatest(near("start") - 1, F.lit(0)), "_b": F.least(near("end") + 1, F.col("_n") - 1)}).where("_a <= _b")
        rows = rows.withColumn("id", F.explode(F.sequence("_a", "_b"))).withColumn("_at", F.col("t0") + (F.col("id") + 0.5) * F.col("_s"))
        own = F.struct(F.col("idx").cast("bigint").alias("idx"), F.col("text").alias("text"))
        return rows.where("_at >= start AND _at < end").select("episode", "id", *[(own if side == x else nothing).alias(x) for x in "rp"])

    points = grid.select("episode", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("id"), nothing.alias("r"), nothing.alias("p"))
    both = points.unionByName(inside(ref, "r")).unionByName(inside(pred, "p")).groupBy("episode", "id").agg(F.min("r").alias("r"), F.min("p").alias("p"))
    both = both.select("episode", "id", F.col("r.text").alias("r_text"), F.col("p.text").alias("p_text"))
    both = matcher.scored(both, "p_text", "r_text")
    share = both.groupBy("episode").agg(F.avg(F.col("same").cast("double")).alias("mof"), F.count("*").alias("n_samples"))
    return extent.select("episode").join(share, "episode", "left").select("episode", F.coalesce("mof", F.lit(0.0)).alias("mof"), F.coalesce("n_samples", F.lit(0)).alias("n_samples"))


def frame_accuracy(pred: DataFrame, ref: DataFrame, points: DataFrame) -> DataFrame:
    """Share of points (episode, id, at) where both sides say the same; an uncovered point is wrong."""
    from .spans import label_at

    a, b = label_at(points, pred), label_at(points, ref)
    both = b.withColumnRenamed("text", "r").join(a.select("episode", "id", F.col("text").alias("p")), ["episode", "id"])
    return both.groupBy("episode").agg(F.avg(F.when(F.col("p") == F.col("r"), 1.0).otherwise(0.0)).alias("mof"))


def ordered_matches(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """(episode, idx, p_idx, p_start, p_end): each label in turn takes the first prediction of the same text after the last taken one.

    A label that finds none takes nothing and moves nothing.
    """
    from .spans import pack

    rows = pack(ref.select("episode", "idx", "text", "start", "end"), "r").join(pack(pred, "p"), "episode", "left")
    free = lambda a, s: F.filter(F.coalesce("p", F.array().cast("array<struct<idx:bigint,text:string,start:double,end:double>>")), lambda p: (p["idx"] > a["last"]) & (p["text"] == s["text"]))
    kind = "struct<last:bigint,out:array<struct<idx:bigint,p:struct<idx:bigint,text:string,start:double,end:double>>>>"

    def step(a, s):
        hit = F.get(free(a, s), F.lit(0))
        return F.struct(F.coalesce(hit["idx"], a["last"]).alias("last"), F.concat(a["out"], F.array(F.struct(s["idx"].alias("idx"), hit.alias("p")))).alias("out"))

    begin = F.struct(F.lit(-(1 << 62)).cast("long").alias("last"), F.array().alias("out")).cast(kind)
    out = rows.select("episode", F.explode(F.aggregate("r", begin, step)["out"]).alias("m"))
    return out.select("episode", F.col("m.idx").alias("idx"), F.col("m.p.idx").alias("p_idx"), F.col("m.p.start").alias("p_start"), F.col("m.p.end").alias("p_end"))


def fixed_label(pred: DataFrame, ref: DataFrame, hits: tuple[float, ...] = (1.0, 3.0, 5.0)) -> DataFrame:
    """Scores where both sides should carry the same ordered labels, by ordered_matches.

    A label that isn't placed scores IoU 0, misses every threshold and counts the
    worst distance its reference allows.
    """
    rows = ref.join(ordered_matches(pred, ref), ["episode", "idx"])
    whole = Window.partitionBy("episode")
    first, last = F.min_by("start", "idx").over(whole), F.max_by("end", "idx").over(whole)
    placed = F.col("p_idx").isNotNull()
    rows = rows.select(
        "episode", "idx", placed.alias("placed"),
        F.when(placed, iou(F.col("p_start"), F.col("p_end"), F.col("start"), F.col("end"))).otherwise(0.0).alias("tiou"),
        F.when(placed, F.abs(F.col("p_start") - F.col("start"))).alias("error"),
        F.greatest(F.abs(F.col("start") - first), F.abs(last - F.col("start"))).alias("worst"),
        (F.row_number().over(whole.orderBy("idx")) > 1).alias("inner"),
    )
    inner = F.col("inner")
    scored = F.when(inner, F.coalesce("error", "worst"))
    aggs = [F.avg(F.col("placed").cast("double")).alias("placed_fraction"), F.avg("tiou").alias("tiou"), F.avg(F.when(inner, F.col("error"))).alias("mae_placed"), F.avg(scored).alias("mae"), F.percentile(scored, 0.5).alias("median_error"), F.percentile(scored, 0.9).alias("p90_error")]
    aggs += [F.coalesce(F.avg(F.when(inner, F.when(F.col("error") <= h, 1.0).otherwise(0.0))), F.lit(1.0)).alias(f"hit_{round(h)}") for h in hits]
    return rows.groupBy("episode").agg(*aggs)


def label_sets(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """Multiset agreement of labels: precision, recall, F1, missed and hallucinated (exact matching)."""
    p, r = pred.groupBy("episode", "text").agg(F.count("*").alias("a")), ref.groupBy("episode", "text").agg(F.count("*").alias("b"))
    rows = p.join(r, ["episode", "text"], "full").select("episode", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    out = rows.groupBy("episode").agg(F.sum(F.least("a", "b")).alias("matched"), F.sum("a").alias("n_pred"), F.sum("b").alias("n_ref"))
    precision, recall = F.try_divide("matched", "n_pred"), F.try_divide("matched", "n_ref")
    f1 = F.try_divide(2 * F.col("matched"), F.col("n_pred") + F.col("n_ref"))
    return out.select("episode", precision.alias("label_precision"), recall.alias("label_recall"), f1.alias("label_f1"), (F.col("n_ref") - F.col("matched")).alias("missed"), (F.col("n_pred") - F.col("matched")).alias("hallucinated"))


def sequence_valid(spans: DataFrame, slack: float = 1e-6) -> DataFrame:
    """Episodes whose spans are finite, don't end before they start, and don't start before the previous end (less slack)."""
    w = by_episode("idx")
    finite = ~(F.isnan("start") | F.isnan("end") | (F.abs("start") == float("inf")) | (F.abs("end") == float("inf")))
    ok = F.coalesce(finite & (F.col("end") >= F.col("start")) & (F.coalesce(F.lag("end").over(w), F.lit(float("-inf"))) - slack <= F.col("start")), F.lit(False))
    return spans.withColumn("_ok", ok).groupBy("episode").agg(F.min("_ok").alias("valid"), F.count("*").alias("n_spans"))
