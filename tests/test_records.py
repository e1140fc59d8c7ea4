import json

import pytest

from spanwright.sources import records as R


def test_stats_and_metadata(spark, tmp_path):
    spark.createDataFrame([(1, 2.0), (2, 3.0)], "episode_index long, mean double").write.parquet(f"{tmp_path}/s")
    assert R.episode_stats(spark, f"{tmp_path}/s", ("episode_index", "mean")).count() == 2
    with pytest.raises(ValueError, match="lacks"):
        R.episode_stats(spark, f"{tmp_path}/s", ("std",))
    spark.createDataFrame([(1,), (1,)], "episode_index long").write.parquet(f"{tmp_path}/t")
    with pytest.raises(ValueError, match="several"):
        R.episode_stats(spark, f"{tmp_path}/t")
    (tmp_path / "e.jsonl").write_text('{"episode_index": 1, "length": 5}\nnot json\n{"length": 2}\n')
    assert [r.length for r in R.jsonl_metadata(spark, f"{tmp_path}/e.jsonl", "episode_index long, length long").collect()] == [5]


def test_calibration_files(spark, tmp_path):
    good = {"offsets": [0.1], "segment_fractions": [0.5, 0.5], "residual_scale": 0.05, "duration_scale": 0.1}
    (tmp_path / "one.json").write_text(json.dumps(good))
    (tmp_path / "two.json").write_text(json.dumps([good, {"offsets": []}]))
    assert len(R.calibrations(spark, f"{tmp_path}/one.json")) == 1 and len(R.calibrations(spark, f"{tmp_path}/two.json")) == 2
    for bad in ({"offsets": [True]}, {"offsets": [float("inf")]}, {**good, "segment_fractions": [1.0]}, {**good, "residual_scale": 0}, {"offsets": [0.1], "labels": ["a"]}):
        with pytest.raises(ValueError):
            R.check_calibration(bad)


def test_staged_and_raw(spark, tmp_path):
    assert R.staged_rows(spark, f"{tmp_path}/none", "t double").count() == 0
    spark.createDataFrame([(1.0, "plan")], "t double, module string").write.partitionBy("module").json(f"{tmp_path}/staged")
    assert [tuple(r) for r in R.staged_rows(spark, f"{tmp_path}/staged", "t double").collect()] == [(1.0, "plan")]
    spark.range(3).write.parquet(f"{tmp_path}/raw/chunk-000")
    (tmp_path / "raw/chunk-000/broken.parquet").write_bytes(b"PAR1 not parquet")
    assert R.raw_episodes(spark, f"{tmp_path}/raw", ["id"]).count() == 3


def test_write_scope(spark):
    frames = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "shard string, episode_index long")
    some = spark.createDataFrame([(1,), (3,)], "episode_index long")
    done = spark.createDataFrame([("c",)], "shard string")
    assert [tuple(r) for r in R.incompatible_shards(frames, some, done).collect()] == [("a", 1)]
    with pytest.raises(ValueError, match="a"):
        R.check_write_scope(frames, some, done)
    R.check_write_scope(frames, frames.select("episode_index"), done)
    assert R.has_language_columns(["language_persistent", "language_events"]) and not R.has_language_columns(["language_events"])


def test_writers_digests_and_locks(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0.5)], "episode long, score double")
    for _ in range(2):
        R.write_scores(rows, f"{tmp_path}/scores")
    assert spark.read.json(f"{tmp_path}/scores").count() == 1 and not list(tmp_path.glob("scores.partial*"))
    assert R.write_report(spark, {"contrasts": []}, f"{tmp_path}/r.json") == 3 and R.write_report(spark, {"contrasts": [1]}, f"{tmp_path}/r.json") == 0
    folder = tmp_path / "tree"
    folder.mkdir()
    (folder / "x").write_bytes(b"1")
    one = R.tree_hash(R.content_digests(spark, str(folder)), str(folder))
    assert one == R.tree_hash(R.content_digests(spark, str(folder)), str(folder))
    (folder / "x").write_bytes(b"2")
    spark.catalog.clearCache()
    assert R.tree_hash(R.content_digests(spark, str(folder)), str(folder)) != one
    with R.RunLock(spark, f"{tmp_path}/d"):
        with pytest.raises(RuntimeError):
            R.RunLock(spark, f"{tmp_path}/d").__enter__()
    with R.RunLock(spark, f"{tmp_path}/d"):
        pass


def test_manifest(spark, tmp_path):
    for name in ("data/chunk-000/file-000.parquet", "meta/info.json", "meta/other.json", "videos/top/chunk-000/file-000.mp4", "videos/side/chunk-000/file-000.mp4", "README.md", "data/notes.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    assert R.publication_manifest(spark, str(tmp_path), cameras=("top",)) == ["README.md", "data/chunk-000/file-000.parquet", "meta/info.json", "videos/top/chunk-000/file-000.mp4"]
    with pytest.raises(ValueError, match="overlaps"):
        R.publication_manifest(spark, str(tmp_path), f"{tmp_path}/data")
    with pytest.raises(ValueError, match="no data"):
        R.publication_manifest(spark, f"{tmp_path}/meta")


def test_registry_and_prompts():
    arms = R.Registry()

    @arms.add
    def single(x):
        return x

    assert arms["single"](3) == 3
    with pytest.raises(ValueError):
        arms.add(single)
    assert R.prompt("a", {"a": "text"}) == "text" and R.prompt("a", {"a": "text"}, " own ") == " own " and R.prompt("a", {"a": "t"}, "  ") == "t"
