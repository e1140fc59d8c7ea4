"""Whole plans: annotate a dataset from recorded spans, and score arms against references over a requested population."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions.labels import EXACT
from ..operators import language as G
from ..operators import metrics as M
from ..operators import spans as S
from ..operators import validation as V
from ..operators.studies import metric_tag

#: Seconds within which a boundary counts as found.
TOLERANCES = (0.5, 1.0, 2.0, 3.0, 5.0)


def annotate(frames: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(annotated frames, violations) of frames (episode, t, ...) and spans: stitched, subtask and plan rows, memory later."""
    whole = S.stitch(spans, S.episode_extent(frames))
    row = lambda style, t, text: [F.col("episode"), t.alias("t"), F.lit("assistant").alias("role"), text.alias("content"), F.lit(style).alias("style"), F.lit(None).cast("string").alias("camera"), F.col("idx").alias("position")]
    rows = whole.select(*row("subtask", F.col("start"), F.col("text"))).unionByName(S.remaining_plan(whole).select(*row("plan", F.col("start"), F.col("plan"))))
    return G.language_columns(frames, rows), V.all_violations(rows, frames)


def sequence_scores(pred: DataFrame, ref: DataFrame, tolerances: tuple[float, ...] = TOLERANCES) -> DataFrame:
    """(episode, boundary precision, recall and F1 at each tolerance, macro_iou, edit_score): what needs a dynamic program, in one pass over packed episodes."""
    import pyarrow as pa

    names = [f"boundary_{x}_{metric_tag(t)}" for t in tolerances for x in ("precision", "recall", "f1")]
    rows = S.pack(ref, "r").join(S.pack(pred, "p"), "episode", "left").select("episode", "p", "r")

    def run(batches):
        for batch in batches:
            out = {n: [] for n in (*names, "macro_iou", "edit_score")}
            for p, r in zip(batch["p"].to_pylist(), batch["r"].to_pylist(), strict=True):
                p = p or []
                inner = [x["start"] for x in p[1:]], [x["start"] for x in r[1:]]
                for t in tolerances:
                    for x, v in zip(("precision", "recall", "f1"), K.boundary_f1(*inner, t), strict=True):
                        out[f"boundary_{x}_{metric_tag(t)}"].append(v)
                out["macro_iou"].append(K.macro_iou([(x["start"], x["end"]) for x in p], [(x["start"], x["end"]) for x in r]))
                out["edit_score"].append(K.edit_score([x["text"] for x in p], [x["text"] for x in r]))
            yield pa.RecordBatch.from_arrays([batch["episode"], *[pa.array(v, pa.float64()) for v in out.values()]], ["episode", *out])

    kind = dict(ref.dtypes)["episode"]
    return rows.mapInArrow(run, f"episode {kind}, " + ", ".join(f"{n} double" for n in (*names, "macro_iou", "edit_score")))


def _cut(df: DataFrame) -> DataFrame:
    """A checkpoint, so that many metrics read the spans once; the rows as they are where no checkpoint folder is set."""
    return df.checkpoint() if df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined() else df


def scores(requested: DataFrame, pred: DataFrame, ref: DataFrame, matcher=EXACT, step: float = 0.1, tolerances: tuple[float, ...] = TOLERANCES) -> DataFrame:
    """A row for each requested (episode), scored or not, with `ok` and `error`: bad or missing reference, no prediction, bad prediction.

    The population comes from what was asked for, so failures stay in every denominator.
    """
    state = lambda x, name: M.sequence_valid(x).select("episode", F.col("valid").alias(name))
    p, r = _cut(pred), _cut(ref)
    judged = requested.select("episode").distinct().join(state(r, "_r"), "episode", "left").join(state(p, "_p"), "episode", "left")
    error = F.when(~F.coalesce("_r", F.lit(False)), "bad reference").when(F.col("_p").isNull(), "no prediction").when(~F.col("_p"), "bad prediction")
    out = _cut(judged.select("episode", error.isNull().alias("ok"), error.alias("error")))
    good = out.where("ok").select("episode")
    p, r = p.join(good, "episode", "left_semi"), r.join(good, "episode", "left_semi")
    parts = (
        sequence_scores(p, r, tolerances), M.covering(p, r), M.chamfer(p, r), M.segment_counts(p, r), M.f1_at_iou(p, r, matcher=matcher), M.mof(p, r, step, matcher),
        M.dense_caption(p, r, matcher=matcher), M.label_accuracy(p, r, matcher), M.label_sets(p, r), M.fixed_label(p, r),
    )
    for part in parts:
        out = out.join(part, "episode", "left")
    return out


def long_scores(wide: DataFrame) -> DataFrame:
    """(episode, ok, metric, value) of wide scores."""
    names = [c for c, t in wide.dtypes if t in ("double", "bigint") and c != "episode"]
    return wide.unpivot(["episode", "ok"], [F.col(c).cast("double").alias(c) for c in names], "metric", "value")
