"""Readers and writers of the small files around a dataset: statistics, calibrations, staged rows, raw episodes, scores, manifests."""

from __future__ import annotations

import json
import math
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .publish import _files

LANGUAGE = ("language_persistent", "language_events")

# The files of a dataset that may be published, as patterns of their paths.
PUBLISHED = (
    r"meta/(info|stats)\.json", r"meta/(tasks|subtasks)\.parquet", r"(README|LICENSE|NOTICE)(\.md|\.txt)?",
    r"data/chunk-\d+/file-\d+\.parquet", r"meta/episodes/chunk-\d+/file-\d+\.parquet",
)


def episode_stats(spark: SparkSession, path: str, required: tuple[str, ...] = ("episode_index",)) -> DataFrame:
    """Statistics with one row an episode; a missing column or a repeated episode is an error."""
    df = spark.read.parquet(path)
    lost = [c for c in required if c not in df.columns]
    if lost:
        raise ValueError(f"{path} lacks columns {lost}")
    twice = df.groupBy("episode_index").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"episode {twice[0]['episode_index']} has several rows of statistics")
    return df


def jsonl_metadata(spark: SparkSession, path: str, schema: str | None = None, key: str = "episode_index") -> DataFrame:
    """JSON lines keyed by episode; a line without the key, or one that isn't JSON, is left out."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("mode", "DROPMALFORMED").json(path).where(F.col(key).isNotNull())


def check_calibration(item: dict) -> dict:
    """A calibration with numeric, finite offsets and scales and as many shares as segments; else an error."""

    def numbers(name, least=None):
        xs = item.get(name)
        if not isinstance(xs, list) or any(isinstance(x, bool) or not isinstance(x, (int, float)) or not math.isfinite(x) for x in xs):
            raise ValueError(f"{name} must be a list of finite numbers")
        if least is not None and any(x < least for x in xs):
            raise ValueError(f"{name} must not be below {least}")
        return xs

    offsets = numbers("offsets")
    if item.get("segment_fractions"):
        shares = numbers("segment_fractions", 0)
        if len(shares) != len(offsets) + 1:
            raise ValueError("segment_fractions must be one more than offsets")
        for name in ("residual_scale", "duration_scale"):
            x = item.get(name)
            if isinstance(x, bool) or not isinstance(x, (int, float)) or not math.isfinite(x) or x <= 0:
                raise ValueError(f"{name} must be a positive number")
    labels = item.get("labels")
    if labels and len(labels) != len(offsets) + 1:
        raise ValueError("labels must be one more than offsets")
    return item


def calibrations(spark: SparkSession, path: str) -> list[dict]:
    """The calibrations of one file, an object or a list of them, all checked."""
    found = json.loads(spark.read.text(path, wholetext=True).first()["value"])
    if not isinstance(found, (dict, list)) or any(not isinstance(x, dict) for x in (found if isinstance(found, list) else [found])):
        raise ValueError(f"{path} holds no calibration")
    return [check_calibration(x) for x in (found if isinstance(found, list) else [found])]


def staged_rows(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows that modules staged, with their `module`; no rows where nothing was staged."""
    fs, path = _files(spark, folder)
    if not fs.exists(path(folder)):
        return spark.createDataFrame([], schema + ", module string")
    return spark.read.schema(schema + ", module string").json(folder)


def raw_episodes(spark: SparkSession, root: str, columns: list[str]) -> DataFrame:
    """Chosen columns of the per-episode files of all chunks, with the file; unreadable files are skipped."""
    df = spark.read.option("ignoreCorruptFiles", "true").option("mergeSchema", "true").parquet(f"{root}/chunk-*/*.parquet")
    return df.select(*columns, F.col("_metadata.file_path").alias("file"))


def incompatible_shards(frames: DataFrame, selected: DataFrame, canonical: DataFrame) -> DataFrame:
    """(shard, n_left_out) of shards that a partial run may not rewrite.

    frames: (shard, episode_index); selected: (episode_index); canonical: (shard), those that already carry the
    language columns and none of the dropped ones. A shard that isn't must be selected with all its episodes.
    """
    old = frames.select("shard", "episode_index").distinct().join(canonical.select("shard"), "shard", "left_anti")
    left = old.join(selected.select("episode_index").distinct(), "episode_index", "left_anti")
    return left.groupBy("shard").agg(F.count("*").alias("n_left_out"))


def check_write_scope(frames: DataFrame, selected: DataFrame, canonical: DataFrame) -> None:
    bad = incompatible_shards(frames, selected, canonical)
    some = [r["shard"] for r in bad.orderBy("shard").limit(3).collect()]
    if some:
        raise ValueError(f"a partial run can't rewrite shards with episodes that aren't selected: {', '.join(some)}; run once on all episodes")


def has_language_columns(columns: list[str], dropped: tuple[str, ...] = ("subtask_index",)) -> bool:
    return set(LANGUAGE) <= set(columns) and not set(dropped) & set(columns)


def write_scores(rows: DataFrame, target: str) -> str:
    """Score lines as gzip JSON, written beside the target and moved there when they are complete."""
    fs, path = _files(rows.sparkSession, target)
    part = f"{target}.partial-{uuid.uuid4().hex}"
    rows.write.option("compression", "gzip").json(part)
    fs.delete(path(target), True)
    if not fs.rename(path(part), path(target)):
        raise OSError(f"{target} could not be put in place")
    return target


def write_report(spark: SparkSession, report: dict, target: str, family: str = "contrasts", least: int = 1) -> int:
    """One JSON file with sorted keys; 0, or 3 where the family of tests is shorter than it should be."""
    fs, path = _files(spark, target)
    text = json.dumps(report, sort_keys=True, indent=1, allow_nan=False)
    out = fs.create(path(target), True)
    out.write(bytearray(text.encode()))
    out.close()
    return 0 if len(report.get(family) or ()) >= least else 3


def content_digests(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, size, sha256) of the files under a folder, hashed where they are read. A file is one row, so of 2 GB at most."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def tree_hash(digests: DataFrame, folder: str) -> str:
    """One hash of a folder's relative paths and digests, whatever the order of reading: the sum of rows' hashes and their number."""
    rows = digests.select(F.sha2(F.concat_ws("\0", F.regexp_extract("path", re.escape(folder.rstrip("/").removeprefix("file:")) + "/(.*)$", 1), "sha256"), 256).alias("h"))
    parts = [F.sum(F.conv(F.substring("h", 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)")).alias(f"s{k}") for k in range(5)]
    return ":".join(str(x or 0) for x in rows.agg(F.count("*"), *parts).first())


def publication_manifest(spark: SparkSession, root: str, staging: str | None = None, cameras: tuple[str, ...] = ()) -> list[str]:
    """The files of a dataset that may be published, by pattern; an error where staging overlaps them or there is no data shard."""
    patterns = [re.compile(p) for p in (*PUBLISHED, *(rf"videos/{re.escape(c)}/chunk-\d+/file-\d+\.mp4" for c in cameras))]
    fs, path = _files(spark, root)
    base = str(fs.getFileStatus(path(root)).getPath().toString()).rstrip("/")
    held = str(fs.makeQualified(path(staging)).toString()).rstrip("/") if staging else None
    found, walk = [], fs.listFiles(path(root), True)
    while walk.hasNext():
        status = walk.next()
        full = str(status.getPath().toString())
        name = full[len(base) + 1 :]
        if not any(p.fullmatch(name) for p in patterns):
            continue
        if held and (full == held or full.startswith(held + "/")):
            raise ValueError(f"staging overlaps dataset content: {name}")
        if status.isSymlink():
            raise ValueError(f"{name} is a symbolic link")
        found.append(name)
    if not any(name.startswith("data/") for name in found):
        raise ValueError("no data shards to publish")
    return sorted(found)


class RunLock:
    """One run a dataset: a lock file that only one writer can create. A second one fails at once."""

    def __init__(self, spark: SparkSession, target: str):
        self.fs, path = _files(spark, target)
        self.at = path(f"{target}._lock")

    def __enter__(self):
        if not self.fs.createNewFile(self.at):
            raise RuntimeError(f"{self.at.toString()} exists: another run is writing")
        return self

    def __exit__(self, *_):
        self.fs.delete(self.at, False)


class Registry(dict):
    """Functions by name, for arms and modules that are chosen by configuration."""

    def add(self, fn):
        if fn.__name__ in self:
            raise ValueError(f"{fn.__name__} is registered already")
        self[fn.__name__] = fn
        return fn


def prompt(name: str, packaged: dict[str, str], override: str | None = None) -> str:
    """A prompt's text: the override where there is one that isn't blank, else the packaged one."""
    if override and override.strip():
        return override
    if name not in packaged:
        raise KeyError(f"no prompt named {name!r}")
    return packaged[name]
