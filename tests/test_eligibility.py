import numpy as np
import pytest
from pyspark.sql import functions as F

from spanwright.functions import kernels as K
from spanwright.functions import labels as L
from spanwright.operators import eligibility as E
from spanwright.operators import metrics as M
from spanwright.operators import spans as S
from spanwright.operators import studies as U

SPANS = "episode long, idx long, text string, start double, end double"


def spans(spark, *rows):
    return spark.createDataFrame([(e, i, t, float(a), float(b)) for e, i, t, a, b in rows], SPANS)


def extent(spark, *rows):
    return spark.createDataFrame([(e, float(a), float(b), 1) for e, a, b in rows], "episode long, t0 double, t_last double, n_frames long")


def test_repeated_runs_are_one_segment(spark):
    pred = spans(spark, (1, 0, "a", 0, 1), (1, 1, "The A.", 1, 2), (1, 2, "b", 2, 4))
    ref = spans(spark, (1, 0, "a", 0, 2), (1, 1, "b", 2, 4))
    row = M.f1_at_iou(pred, ref).first()
    assert (row.f1_10, row.f1_25, row.f1_50, row.precision_50, row.recall_50) == (1, 1, 1, 1, 1)
    assert K.edit_score(["a", "a", "b"], ["a", "b"]) == 1.0 == K.edit_score([], [])
    assert K.edit_score(["a", "c"], ["a", "b"]) == 0.5 and K.edit_score([], ["a"]) == 0.0
    assert K.edit_score(["a", "b", "c", "d"], ["b", "d"]) == 0.5


def test_runs_that_do_not_touch_stay_apart(spark):
    pred = spans(spark, (1, 0, "a", 0, 1), (1, 1, "a", 1.5, 2))
    assert M.f1_at_iou(pred, spans(spark, (1, 0, "a", 0, 2))).first().f1_50 == pytest.approx(2 / 3)


def test_covering_without_duration(spark):
    ref = spans(spark, (1, 0, "a", 3, 3), (2, 0, "a", 3, 3))
    out = {r.episode: r.covering for r in M.covering(spans(spark, (2, 0, "a", 0, 4)), ref).collect()}
    assert out == {1: 1.0, 2: 0.0}


@pytest.mark.parametrize(("length", "budget", "want"), [(13, 11, [(0, 6), (6, 13)]), (10, 11, [(0, 10)]), (25, 11, [(0, 10), (10, 17), (17, 25)]), (3, 1, [(0, 1), (1, 2), (2, 3)])])
def test_generation_windows(spark, length, budget, want):
    out = S.generation_windows(extent(spark, (1, 0, length), (2, 5, 5)), 1.0, budget).orderBy("episode", "idx").collect()
    assert [(r.start, r.end) for r in out] == want and {r.episode for r in out} == {1}


def test_fixed_labels_match_in_order(spark):
    ref = spans(spark, (1, 0, "a", 0, 2), (1, 1, "b", 2, 4))
    out = M.fixed_label(spans(spark, (1, 0, "a", 0, 2), (1, 1, "x", 2, 2.5), (1, 2, "b", 2.5, 4)), ref).first()
    assert (out.placed_fraction, out.mae) == (1.0, 0.5)
    none = M.fixed_label(spans(spark, (1, 0, "b", 0, 2), (1, 1, "a", 2, 4)), ref).first()
    assert none.placed_fraction == 0.5 and none.mae == 2.0 and none.hit_3 == 0.0


def test_contrasts(spark):
    pairs = [("open the door", "close the door", True), ("opening", "opened", False), ("in the box", "onto the box", True), ("cup down", "cup left", False), ("left right", "right", False), ("first can", "third can", True), ("pick up", "place", False)]
    df = spark.createDataFrame(pairs, "a string, b string, want boolean")
    assert df.select(L.contrast_conflict(F.col("a"), F.col("b")).alias("x"), "want").where("x <> want").count() == 0


def test_judge_asks_for_what_nothing_decides(spark):
    rows = spark.createDataFrame([("the cup", "Cup."), ("a mug", "the cup"), ("left", "right"), ("x", "y")], "p string, r string")
    verdicts = spark.createDataFrame([("a mug", "the cup")], "a string, b string").select(L.pair_id(F.col("a"), F.col("b")).alias("pair"), F.lit(True).alias("verdict"))
    judge = L.Judged(verdicts)
    got = judge.prepare(rows, "p", "r").select(judge.similarity("p", "r").alias("s")).collect()
    assert sorted(r.s for r in got) == [0, 0, 1, 1]
    assert [(r.left, r.right) for r in judge.misses(rows, "p", "r").collect()] == [("x", "y")]


def test_embedding_guard_and_missing_vectors(spark):
    v = spark.createDataFrame([("left cup", [1.0, 0.0]), ("right cup", [1.0, 0.01]), ("mug", [0.6, 0.8])], "label string, vector array<double>")
    m = L.Embedding(v)
    rows = m.prepare(spark.createDataFrame([("left cup", "right cup"), ("mug", "left cup"), ("mug", "unknown")], "p string, r string"), "p", "r")
    assert [round(r.s, 3) for r in rows.select(m.similarity("p", "r").alias("s"), "p", "r").orderBy("p", "r").collect()] == [0.0, 0.6, 0.0]


def test_distinct_frames_bump_and_drop(spark):
    frames = spark.createDataFrame([(1, float(t)) for t in range(4)], "episode long, t double")
    s = spans(spark, (1, 0, "a", 1.1, 2), (1, 1, "b", 1.2, 2), (1, 2, "c", 1.3, 2), (1, 3, "d", 2.9, 3))
    out = E.distinct_frames(s, frames).orderBy("idx").collect()
    assert [(r.text, r.start, r.end) for r in out] == [("a", 1, 2), ("b", 2, 2), ("c", 3, 3)]


def test_clean_spans_clamp_swap_and_refuse(spark):
    out = E.clean_spans(spans(spark, (1, 0, " b ", 9, 3), (1, 1, "a", -5, 2)), extent(spark, (1, 0, 8))).orderBy("idx").collect()
    assert [(r.text, r.start, r.end) for r in out] == [("a", 0, 2), ("b", 3, 8)]
    with pytest.raises(Exception, match="needs text"):
        E.clean_spans(spans(spark, (1, 0, " ", 0, 1)), extent(spark, (1, 0, 8))).collect()


def test_population_refuses_unknown_eligibility(spark):
    rows = spark.createDataFrame([("x", True), ("y", None)], "arm string, fits boolean")
    with pytest.raises(ValueError, match="y"):
        E.population(rows, ["fits"])
    assert E.population(rows.where("arm = 'x'"), ["fits"]).count() == 1


def test_small_predicates(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("x")).first().x
    assert value(E.usable_feature(F.lit("float32"), F.array(F.lit(7)))) and not value(E.usable_feature(F.lit("float32"), F.array(F.lit(300)))) and not value(E.usable_feature(F.lit("int64"), F.array(F.lit(7))))
    assert value(E.under_covered(F.lit(1), F.lit(4), 0.5)) and not value(E.under_covered(F.lit(1), F.lit(4), 0))
    assert value(E.low_confidence(F.array(F.lit(0.0), F.lit(5.0)), F.array(F.lit(0.0), F.lit(9.0)), 0.1, F.lit(10.0))) and not value(E.low_confidence(F.array(F.lit(5.0)), F.array(F.lit(6.0)), 0.1, F.lit(10.0)))
    assert value(U.family_of(F.lit("u850-fridge-drink-03-BC-v30"))) == "u850-fridge-drink" and value(U.family_of(F.lit("03-a"))) == "03-a" and value(U.family_of(F.lit("a-b"))) == "a-b"
    assert U.metric_tag(0.5) == "0p5" and U.metric_tag(1.0) == "1"
    assert value(U.centred_grid(F.lit(1.0), 4.0, 5, F.lit(0.0), F.lit(10.0))) == [0.0, 1.0, 2.0, 3.0]
    assert value(U.parse_clips(F.lit("[[0,89],[90,131]]"))) == [[0, 89], [90, 131]]
    assert value(U.sign_p(F.lit(4), F.lit(0))) == pytest.approx(0.125) and value(U.sign_p(F.lit(0), F.lit(0))) == 1.0 and value(U.sign_p(F.lit(60), F.lit(40))) == pytest.approx(K.sign_test(60, 40))


def test_stitch_fills_gaps(spark):
    """Gaps between kept spans go to the span before them."""
    out = S.stitch(spans(spark, (1, 1, "b", 2, 3), (1, 4, "c", 7, 8)), extent(spark, (1, 0, 10))).orderBy("idx").collect()
    assert [(r.start, r.end) for r in out] == [(0, 7), (7, 10)]


def test_motion_prefers_onsets():
    t = np.arange(100) / 10
    x = np.where(t < 3, 0.0, np.where(t < 6, t - 3, 3.0))
    times = K.motion_times(t.tolist(), [x[:, None].tolist()], 6)
    assert times[0] == 0 and times[-1] == 9.9 and len(times) == 6
    assert min(abs(v - 3.0) for v in times) <= 0.2 and min(abs(v - 6.0) for v in times) <= 0.2
    assert K.motion_times(t.tolist(), [np.zeros((100, 1)).tolist()], 6) is None and K.motion_times([0.0, 1.0], [[[0.0], [1.0]]], 6) == [0.0, 1.0]


def test_motion_fills_empty_strata_last():
    t = np.array([0, 0.1, 0.2, 0.3, 0.4, 9.0, 10.0])
    times = K.motion_times(t.tolist(), [np.array([0, 1, 0, 1, 0, 1, 0], float)[:, None].tolist()], 5)
    assert len(times) == 5 and {0.0, 10.0, 9.0} <= set(times)


def test_duration_weight_holds_out():
    ref = [[(0.0, 10 + k, "a"), (10.0 + k, 20, "b"), (20.0, 30, "c")] for k in range(4)]
    pred = [[(0.0, 13 + k, "a"), (13.0 + k, 23, "b"), (23.0, 30, "c")] for k in range(4)]
    w, held, bare = K.duration_weight(list(zip(pred, ref, strict=True)))
    assert w == 0.0 and held > 0.97 > bare
    assert K.duration_weight([(pred[0], ref[0])])[0] == 1.0
    m = K.fit_model(list(zip(pred, ref, strict=True)))
    assert np.allclose(m["offsets"], [0.1, 0.1]) and m["residual_scale"] == 1e-3
    assert K.corrected([(0.0, 1.0, "a"), (1.0, 1.0, "b"), (1.0, 2.0, "c")], {}) == [(0.0, 1.0, "a"), (1.0, 2.0, "b")]


def test_levels_of_resampling():
    tree = {"f": {"a": [1.0, 1.2], "b": [0.9, 1.1]}, "g": {"c": [2.0, 2.2], "d": [2.1, float("nan")]}}
    out = K.both_levels(tree, 300)
    assert out["n_dropped"] == 1 and out["family_low"] <= out["point"] <= out["family_high"] and out["width_ratio"] > 0
    point, low, high, p = K.paired_nested({"f": {"a": [1.0, 2.0]}, "g": {"b": [1.5, 2.5]}}, 200)
    assert low <= point <= high and p == 1 / 200
    assert all(np.isnan(x) for x in K.paired_nested({"f": {"a": [float("nan")]}}, 10))


def test_ablations_change_what_they_name():
    ref = [[(0.0, 10 + k, "a"), (10.0 + k, 20, "b"), (20.0, 30, "c")] for k in range(4)]
    pred = [[(0.0, 13 + k, "a"), (13.0 + k, 23, "b"), (23.0, 30, "c")] for k in range(4)]
    forms = K.ablations(K.fit_model(list(zip(pred, ref, strict=True))))
    score = {n: sum(K.placed_iou(K.corrected(p, m, 0.0), r) for p, r in zip(pred, ref, strict=True)) for n, m in forms.items()}
    assert score["full"] > score["duration"] and score["offsets"] > score["baseline"] and abs(sum(forms["normalised"]["fractions"]) - 1) < 1e-12
