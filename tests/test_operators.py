import json
import math

import pytest
from pyspark.sql import functions as F

from spanwright.functions import labels as L
from spanwright.operators import calibration, metrics, selection, stats, validation
from spanwright.operators import spans as S
from spanwright.plans.study import annotate, scores
from spanwright.sources import dataset as D
from spanwright.sources import publish as P
from spanwright.streaming.latest import latest_rows

SPANS = "episode long, idx long, text string, start double, end double"
FRAMES = "episode long, event_id long, t double, label string"


def test_nearest_frame_tie_is_earlier(spark):
    frames = spark.createDataFrame([(1, 0, 0.0, "a"), (1, 1, 1.0, "a")], FRAMES)
    points = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.6), (1, 3, -3.0), (1, 4, 9.0), (2, 5, 4.0)], "episode long, id long, at double")
    assert {r.id: r.frame_t for r in S.snap_to_frame(points, frames).collect()} == {1: 0.0, 2: 1.0, 3: 0.0, 4: 1.0, 5: 4.0}


def test_runs_and_blank_runs(spark):
    rows = [(1, i, float(i), x) for i, x in enumerate(["A", "A", "", "B"])]
    got = S.run_length_spans(spark.createDataFrame(rows, FRAMES), drop_blank=True).collect()
    assert sorted((r.text, r.start, r.end) for r in got) == [("A", 0, 2), ("B", 3, 3)]


def test_windows_balance_the_tail(spark):
    ext = spark.createDataFrame([(1, 0.0, 51.18, 1)], "episode long, t0 double, t_last double, n_frames long")
    got = sorted((r.start, r.end) for r in S.generation_windows(ext, 2.0, 100).collect())
    assert got == [(0, 25.59), (25.59, 51.18)]  # 51 intervals each


def test_metrics_of_equal_and_missing(spark):
    ref = spark.createDataFrame([(1, 0, "a", 0.0, 2.0), (1, 1, "b", 2.0, 5.0), (2, 0, "a", 0.0, 1.0)], SPANS)
    pred = ref.where("episode = 1")
    out = {r.episode: r for r in scores(ref.select("episode").union(spark.createDataFrame([(3,)], "episode long")), pred, ref).collect()}
    assert out[1].covering == 1 == out[1].f1_50 == out[1].label_f1 == out[1].tiou and out[1].chamfer == 0
    assert not out[2].ok and not out[3].ok and out[2].covering is None


def test_claimed_best_reference_is_a_false_positive(spark):
    ref = spark.createDataFrame([(1, 0, "a", 0.0, 10.0)], SPANS)
    pred = spark.createDataFrame([(1, 0, "a", 0.0, 6.0), (1, 1, "a", 4.0, 10.0)], SPANS)
    assert metrics.f1_at_iou(pred, ref).first()["f1_50"] == pytest.approx(2 / 3)


def test_only_pairs_that_touch_have_their_labels_compared(spark):
    rows = [(1, i, "ab"[i % 2], float(i), i + 1.0) for i in range(60)]
    ref, pred = (spark.createDataFrame([(e, i, t, a + late, b + late) for e, i, t, a, b in rows], SPANS) for late in (0.0, 0.25))
    seen = []

    class Counting(L.Exact):
        def scored(self, pairs, a, b):
            seen.append(pairs.count())
            return super().scored(pairs, a, b)

    assert metrics.label_accuracy(pred, ref, Counting()).first()["label_accuracy"] == pytest.approx(0.75)
    assert metrics.dense_caption(pred, ref, (0.3,), Counting()).first()["recall_3"] == 1
    assert metrics.f1_at_iou(pred, ref, (0.1,), Counting()).first()["f1_10"] == 1
    assert seen == [119, 60, 119]  # of 3,600 pairs


def test_grid_points_of_overlapping_spans_take_the_first(spark):
    ref = spark.createDataFrame([(1, 0, "a", 0.0, 6.0), (1, 1, "b", 4.0, 10.0)], SPANS)
    pred = spark.createDataFrame([(1, 0, "b", 5.0, 8.0), (1, 1, "a", 0.0, 5.5), (1, 2, "b", 5.5, 9.0)], SPANS)
    got = metrics.mof(pred, ref, 1.0).first()  # midpoints 0.5 to 9.5: b from 5.5 on, nothing at 9.5
    assert (got["mof"], got["n_samples"]) == (pytest.approx(0.8), 10)


def test_nearest_boundaries_either_way(spark):
    at = lambda xs: [(1, i, "a", x, x) for i, x in enumerate([0.0, *xs])]
    p, r = (spark.createDataFrame(at(x), SPANS) for x in ([1.0, 4.0, 9.0], [4.0, 6.0]))
    got = metrics.chamfer(p, r).first()
    assert (got["pred_to_ref"], got["ref_to_pred"]) == (pytest.approx(2.0), pytest.approx(1.0))


def test_holm(spark):
    tests = spark.createDataFrame([(1, 0.01), (2, 0.04), (3, 0.03), (4, float("nan"))], "test long, p double")
    got = {r.test: r.p_holm for r in stats.holm(tests).collect()}
    assert got[1] == pytest.approx(0.03) and got[2] == pytest.approx(0.06) == got[3] and got[4] != got[4]


def test_kappa_undefined(spark):
    assert stats.kappa(spark.createDataFrame([(1, 1), (1, 1)], "a int, b int"), "a", "b").first()["kappa"] is None


def test_rank_p90(spark):
    rows = spark.createDataFrame([("x", float(i)) for i in range(10)] + [("y", 5.0)], "k string, v double")
    assert {r.k: r.p90 for r in stats.rank_p90(rows, "k", "v").collect()} == {"x": 8.0, "y": 5.0}


def test_latest_wins_in_batch_and_stream(spark, tmp_path):
    log = [(1, 0, "ok1", None), (1, 1, None, "bad"), (1, 2, "ok2", None), (1, 3, None, "bad"), (2, 0, None, "bad"), (2, 1, None, "worse")]
    rows = spark.createDataFrame(log, "ep long, line long, spans string, error string")
    want = {1: "ok2", 2: None}
    got = selection.latest_wins(rows, ["ep"], "line", F.col("error").isNotNull()).collect()
    assert {r.ep: r.spans for r in got} == want and {r.ep: r.error for r in got}[2] == "worse"
    rows.coalesce(1).write.json(f"{tmp_path}/log")
    stream = spark.readStream.schema(rows.schema).json(f"{tmp_path}/log")
    q = latest_rows(stream, ["ep"], "line", F.col("error").isNotNull()).writeStream.format("memory").queryName("latest").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.ep: r.spans for r in spark.table("latest").collect()} == want


def test_labels(spark):
    rows = [("The  Open-Door!", "close a door", False), ("pick up", "pick up", False)]
    got = spark.createDataFrame(rows, "a string, b string, c boolean").select(L.normalise_label(F.col("a")).alias("n"), L.normalise_label_unicode(F.col("a")).alias("u"), L.contrast_conflict(F.col("a"), F.col("b")).alias("x"), L.token_f1(F.col("a"), F.col("b")).alias("f")).collect()
    assert got[0].n == got[0].u == "open door" and got[0].x and got[0].f == 0.5
    assert not got[1].x and got[1].f == 1
    times = spark.createDataFrame([("50.04s",), ("01:02.5",), ("1:00:01",), ("99:99",), ("x",)], "t string").select(L.clock_seconds(F.col("t")).alias("s")).collect()
    assert [r.s for r in times] == [50.04, 62.5, 3601.0, None, None]


def test_sources(spark, tmp_path):
    root = f"{tmp_path}/data_root"
    frames = [(e, i, i / 10, 0, e) for e in (0, 1) for i in range(12)]
    spark.createDataFrame(frames, "episode_index long, frame_index long, timestamp double, task_index long, x long").write.parquet(f"{root}/data/chunk-000")
    spark.createDataFrame([(0, "do it")], "task_index long, task string").write.parquet(f"{root}/meta/tasks.parquet")
    df = D.frame_shards(spark, root, [1], ["task_index"])
    assert df.columns == ["episode_index", "frame_index", "timestamp", "task_index", "shard"] and df.count() == 12
    assert D.with_task(df, D.tasks(spark, root)).first()["task"] == "do it"
    assert D.tasks(spark, f"{root}/none").count() == 0
    side = {"episodes": {"0": {"subtasks": [{"label": "a", "start": 0, "end": 1}], "atoms": []}, "1": {"atoms": [{"style": "subtask", "content": "b", "timestamp": 0.5}, {"style": "plan", "content": "p", "timestamp": 0}]}, "2": {"subtasks": [{"label": " ", "start": 0, "end": 1}]}}}
    (tmp_path / "side.json").write_text(json.dumps(side))
    got = sorted((r.episode_index, r.text, r.start, r.end) for r in D.sidecar_spans(spark, str(tmp_path / "side.json")).collect())
    assert got == [(0, "a", 0, 1), (1, "b", 0.5, 0.5)]
    (tmp_path / "labels.json").write_text(json.dumps({"default": ["x"], "1": ["y", "z"]}))
    eps = spark.createDataFrame([(0,), (1,)], "episode long")
    assert {r.episode: r.labels for r in D.labels_for(eps, D.given_labels(spark, str(tmp_path / "labels.json"))).collect()} == {0: ["x"], 1: ["y", "z"]}
    (tmp_path / "r.jsonl").write_text('{"e": 1}\n\n{"e": 2}\n')
    (tmp_path / "r.json").write_text('[{"e": 1}, {"e": 2}]')
    assert [sorted((r.line, r.e) for r in D.results(spark, str(tmp_path / n), "e int").collect()) for n in ("r.jsonl", "r.json")] == [[(0, 1), (2, 2)], [(0, 1), (1, 2)]]
    with pytest.raises(ValueError):
        D.check_storage({"codebase_version": "v2.1"})
    assert D.expand("$A/${B}", {"A": "x", "B": "y"}) == "x/y"
    meta = spark.createDataFrame([(0, None, None, None, ["s"], [0.0], [1.0]), (1, ["d"], [0.0], [2.0], ["s"], [0.0], [1.0]), (2, ["d"], [0.0, 1.0], [2.0], None, None, None)], "episode_index long, dense_subtask_names array<string>, dense_subtask_start_times array<double>, dense_subtask_end_times array<double>, sparse_subtask_names array<string>, sparse_subtask_start_times array<double>, sparse_subtask_end_times array<double>")
    assert sorted((r.episode_index, r.text) for r in D.metadata_spans(meta).collect()) == [(0, "s"), (1, "d")]


def test_publish_is_all_or_nothing(spark, tmp_path):
    target = f"{tmp_path}/out"
    frames = spark.createDataFrame([(0, 0.0, "a"), (0, 1.0, "b")], "episode_index long, timestamp double, x string")
    P.publish(frames, target, ["episode_index", "timestamp"])
    P.publish(frames.withColumn("y", F.lit(1)), target, ["episode_index", "timestamp"])
    with pytest.raises(ValueError):
        P.publish(frames.limit(1), target, ["episode_index", "timestamp"])
    assert spark.read.parquet(target).columns == ["episode_index", "timestamp", "x", "y"]
    (tmp_path / "out").rename(tmp_path / "out._old")  # a crash between the two renames
    P.recover(spark, target)
    assert spark.read.parquet(target).count() == 2


def test_annotate_and_validate(spark):
    frames = spark.createDataFrame([(1, i, float(i), "a" if i < 3 else "b") for i in range(6)], FRAMES)
    out, bad = annotate(frames, S.run_length_spans(frames))
    rows = out.collect()
    assert len(rows) == 6 and all(r.language_persistent == rows[0].language_persistent for r in rows)
    assert [x.style for x in rows[0].language_persistent] == ["plan", "subtask", "plan", "subtask"]
    assert bad.count() == 0
    lone = spark.createDataFrame([(1, 9.5, "user", "q", "interjection", None), (1, 0.0, "user", "q", "odd", None)], "episode long, t double, role string, content string, style string, camera string")
    assert {r.check for r in validation.all_violations(lone, frames).collect()} == {"routing", "off_frame", "orphan_interjection", "plan_missing"}


def test_leave_one_out_by_cohort(spark):
    ref = [(e, i, x, a, b) for e in range(4) for i, (x, a, b) in enumerate((("a", 0.0, 10.0 + e), ("b", 10.0 + e, 20.0), ("c", 20.0, 30.0)))]
    pred = [(e, i, x, a, b) for e in range(4) for i, (x, a, b) in enumerate((("a", 0.0, 13.0 + e), ("b", 13.0 + e, 23.0), ("c", 23.0, 30.0)))]
    ref, pred = ref + [(9, 0, "a", 0.0, 1.0), (9, 1, "b", 1.0, 2.0)], pred + [(9, 0, "b", 0.0, 1.0)]
    cohort = spark.createDataFrame([(e, "x") for e in (*range(4), 9)], "episode long, cohort string")
    row = calibration.leave_one_out(spark.createDataFrame(pred, SPANS), spark.createDataFrame(ref, SPANS), cohort).first()
    assert (row.cohort, row.n_episodes, row.weight) == ("x", 4, 0.0) and row.held_out > 0.97 > row.bare


def test_leave_one_out_takes_a_cohort_of_any_size(spark):
    """Hundreds of seeds, and the same result as fitting all others for each."""
    import random

    from spanwright.functions import kernels as K

    r, ref, pred, cohort = random.Random(8), [], [], []
    for e in range(230):
        name = "large" if e < 205 else "odd" if e < 218 else "even" if e < 228 else "two"
        cuts = [0.0, r.choice([8.0, 10.0, r.uniform(5, 12)]), r.uniform(13, 25), 30.0]
        late = [0.0, cuts[1] + r.choice([1.0, r.uniform(0, 2)]), cuts[2] + r.uniform(0, 3), 30.0]
        for rows, c in ((ref, cuts), (pred, late)):
            rows += [(e, i, x, c[i], c[i + 1]) for i, x in enumerate("abc")]
        cohort.append((e, name))
    out = calibration.leave_one_out(spark.createDataFrame(pred, SPANS), spark.createDataFrame(ref, SPANS), spark.createDataFrame(cohort, "episode long, cohort string"))
    got = {x.cohort: x[1:] for x in out.collect()}
    side = lambda rows, e: [(a, b, x) for f, _, x, a, b in rows if f == e]
    for name in ("large", "odd", "even", "two"):
        own = [e for e, c in cohort if c == name]
        want = K.duration_weight([(side(pred, e), side(ref, e)) for e in own])
        assert got[name] == (len(own), want[0], pytest.approx(want[1], nan_ok=True), pytest.approx(want[2], nan_ok=True))


def test_resampled_sums_draw_evenly():
    import numpy as np

    from spanwright.functions import kernels as K

    rng, values = np.random.default_rng(2), np.arange(1000.0)
    for counts in (np.ones(1000, int), np.arange(1000) % 3, np.full(1000, 90)):
        took = np.tile([0, 1, 700, 5], 4000)
        sums = K.resampled_sums(values, counts, took, rng)
        mean = float((values * counts).sum() / counts.sum())
        sd = float(np.sqrt(((values - mean) ** 2 * counts).sum() / counts.sum()))
        assert (sums[0::4] == 0).all() and set(sums[1::4]) <= set(values[counts > 0])
        for k, n in ((1, 1), (2, 700), (3, 5)):
            assert abs(sums[k::4].mean() - n * mean) < 5 * sd * (n / 4000) ** 0.5
            assert sums[k::4].std() == pytest.approx(sd * n**0.5, rel=0.06)


def test_entry_without_llm(tmp_path):
    """The rest imports and lists its queries where the llm folder and the pipeline aren't there."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "spanwright", tmp_path / "spanwright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'rle_spans' in q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_model_replies_become_spans(spark):
    from spanwright.plans.generate import canned, generate_json, reply_spans

    model = canned({"one": {"spans": [{"text": " a ", "start": 0, "end": 1}, {"text": "b", "start": 3, "end": 2}, {"index": 1, "text": "c", "start": 5, "end": 6}, {"text": "d", "start": None, "end": 1}]}})
    rows = spark.createDataFrame([(1, "say one"), (2, "say one"), (3, "say two"), (4, None)], "episode long, prompt string")
    out = generate_json(rows, model)
    assert {r.episode: r.reply is not None for r in out.collect()} == {1: True, 2: True, 3: False, 4: False}
    got = sorted((r.idx, r.text, r.start, r.end) for r in reply_spans(out).where("episode = 1").collect())
    assert got == [(0, "a", 0, 1), (1, "b", 2, 3)]


def test_cluster_bootstrap_draws_ten_thousand_times(spark, tmp_path):
    import random

    from spanwright import catalog
    from spanwright.functions import kernels as K
    from spanwright.operators import stats as T

    r = random.Random(4)
    rows = [(arm, c, r.gauss(10 * c, 40)) for arm in ("F", "O") for c in range(6) for _ in range(5 + 9 * c)]
    rows += [("F", 0, 1.5)] * 4
    spark.createDataFrame([(k, arm, x) for k, (arm, _, x) in enumerate(rows)], "o_custkey long, o_orderstatus string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, c) for k, (_, c, _) in enumerate(rows)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    got = {x.o_orderstatus: x[1:] for x in catalog.cluster_bootstrap(spark, str(tmp_path)).collect()}
    small = {x.arm: x[1:] for x in T.cluster_bootstrap(spark.createDataFrame(rows, "arm string, c int, x double"), "arm", "c", "x", part_rows=8).collect()}
    for arm in ("F", "O"):
        point, low, high = K.cluster_bootstrap([[x for a, c, x in rows if a == arm and c == k] for k in range(6)])
        for own in (got[arm], small[arm]):
            assert own[0] == pytest.approx(point)
            assert abs(own[1] - low) < 0.05 * (high - low) and abs(own[2] - high) < 0.05 * (high - low)
    bad = T.cluster_bootstrap(spark.createDataFrame([("a", 1, 1.0), ("a", 2, math.nan), ("b", 1, 2.0)], "arm string, c int, x double"), "arm", "c", "x", n_boot=70)
    bad = {x.arm: x[1:] for x in bad.collect()}
    assert all(math.isnan(x) for x in bad["a"]) and bad["b"] == (2.0, 2.0, 2.0)
