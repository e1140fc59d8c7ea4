"""Readers of episode datasets: frame shards, metadata, sidecars, results and logs, as DataFrames."""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPAN = "struct<label:string,text:string,start:double,end:double>"
ATOM = "struct<style:string,content:string,timestamp:double>"


# Fixed value: the name under which datasets declare Parquet storage.
PARQUET_STORAGE = "lerobot"


def check_storage(info: dict) -> None:
    """Only Parquet datasets of a numeric version 3."""
    if info.get("storage_format") not in (None, PARQUET_STORAGE):
        raise ValueError(f"storage format {info['storage_format']!r} isn't Parquet")
    if not re.fullmatch(r"v3(\.\d+)*", str(info.get("codebase_version", ""))):
        raise ValueError(f"version {info.get('codebase_version')!r} isn't v3.x")


def dataset_info(spark: SparkSession, root: str) -> dict:
    rows = spark.read.text(f"{root}/meta/info.json", wholetext=True).collect()  # one file
    return json.loads(rows[0]["value"])


def frame_shards(spark: SparkSession, root: str, episodes: list[int] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Frames of all shards under data/, with their shard; only the columns asked for are read.

    The episode filter is a predicate on the scan, so row groups of other episodes are skipped.
    """
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").option("mergeSchema", "true").parquet(f"{root}/data")
    if "timestamp" not in df.columns:
        raise ValueError("frames have no timestamp column")
    df = df.where("episode_index IS NOT NULL")
    if episodes is not None:
        df = df.where(F.col("episode_index").isin(list(episodes)))
    if "frame_index" not in df.columns:
        df = df.withColumn("frame_index", F.row_number().over(Window.partitionBy("episode_index").orderBy("timestamp")) - 1)
    keep = list(dict.fromkeys(["episode_index", "frame_index", "timestamp", *(columns if columns is not None else df.columns)]))
    return df.select(*keep, F.col("_metadata.file_path").alias("shard"))


def tasks(spark: SparkSession, root: str) -> DataFrame:
    """(task_index, task); empty where the file is missing."""
    try:
        df = spark.read.parquet(f"{root}/meta/tasks.parquet")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "task_index long, task string")
    name = "task" if "task" in df.columns else "__index_level_0__"
    return df.select("task_index", F.col(name).alias("task"))


def with_task(frames: DataFrame, task_table: DataFrame) -> DataFrame:
    """frames with the task's text, '' for an unknown index. A dictionary has a row a task; Spark broadcasts it if small."""
    return frames.join(task_table, "task_index", "left").withColumn("task", F.coalesce("task", F.lit("")))


def metadata_spans(meta: DataFrame) -> DataFrame:
    """(episode_index, idx, text, start, end) from three parallel list columns: dense, else sparse, else plain names.

    Lists of unequal length, missing numbers and blank names leave the whole episode out.
    """
    found = [p for p in ("dense_", "sparse_", "") if f"{p}subtask_names" in meta.columns]
    if not found:
        return meta.sparkSession.createDataFrame([], "episode_index long, idx long, text string, start double, end double")
    z = F.coalesce(*[F.when(F.size(F.col(f"{p}subtask_names")) > 0, F.struct(F.col(f"{p}subtask_names").alias("n"), F.col(f"{p}subtask_start_times").alias("s"), F.col(f"{p}subtask_end_times").alias("e"))) for p in found])
    rows = meta.select("episode_index", z.alias("z")).where("size(z.n) = size(z.s) AND size(z.n) = size(z.e)")
    spans = F.transform(F.arrays_zip(F.col("z.n").alias("n"), F.col("z.s").alias("s"), F.col("z.e").alias("e")), lambda x: F.struct(F.trim(x["n"]).alias("text"), x["s"].cast("double").alias("start"), x["e"].cast("double").alias("end")))
    return _explode(rows.select("episode_index", spans.alias("spans")))


def _explode(rows: DataFrame) -> DataFrame:
    """One row a span; episodes with a malformed span are left out."""
    bad = lambda s: s["text"].isNull() | (s["text"] == "") | s["start"].isNull() | s["end"].isNull() | F.isnan(s["start"]) | F.isnan(s["end"]) | (s["end"] < s["start"])
    good = rows.where(~F.coalesce(F.exists("spans", bad), F.lit(True)))
    out = good.select("episode_index", F.posexplode("spans").alias("idx", "s"))
    return out.select(F.col("episode_index").cast("long").alias("episode_index"), F.col("idx").cast("long").alias("idx"), "s.text", "s.start", "s.end")


def sidecar_spans(spark: SparkSession, path: str) -> DataFrame:
    """Spans of an annotation sidecar in either schema; intervals win over atoms, which end where the next begins."""
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<episodes:map<string,struct<subtasks:array<{SPAN}>,atoms:array<{ATOM}>>>>").alias("j"))
    rows = text.select(F.explode("j.episodes").alias("k", "v")).select(F.expr("try_cast(k AS bigint)").alias("episode_index"), "v").where("episode_index IS NOT NULL")
    spans = F.transform("v.subtasks", lambda s: F.struct(F.trim(F.coalesce(s["text"], s["label"])).alias("text"), s["start"].alias("start"), s["end"].alias("end")))
    atoms = F.array_sort(F.transform(F.filter("v.atoms", lambda a: a["style"] == "subtask"), lambda a: F.struct(a["timestamp"].alias("start"), F.trim(a["content"]).alias("text"))))
    atoms = F.transform(atoms, lambda a, i: F.struct(a["text"].alias("text"), a["start"].alias("start"), F.coalesce(F.get(atoms, i + 1)["start"], a["start"]).alias("end")))
    return _explode(rows.select("episode_index", F.when(F.size("v.subtasks") > 0, spans).otherwise(atoms).alias("spans")))


def span_files(spark: SparkSession, folder: str) -> DataFrame:
    """(dataset, episode, spans) of a folder of JSON files, one a dataset."""
    df = spark.read.schema(f"dataset string, episodes map<string,array<{SPAN}>>").option("multiLine", "true").json(folder)
    return df.select("dataset", F.explode("episodes").alias("episode", "spans")).select("dataset", F.col("episode").cast("long").alias("episode"), "spans")


def splits(spark: SparkSession, folder: str) -> DataFrame:
    """(dataset, episode, role) of split files."""
    df = spark.read.schema("dataset string, seed array<long>, eval array<long>").option("multiLine", "true").json(folder)
    one = lambda role: df.select("dataset", F.explode(role).alias("episode"), F.lit(role).alias("role"))
    return one("seed").unionByName(one("eval"))


def given_labels(spark: SparkSession, path: str) -> DataFrame:
    """(episode, labels) of a label file; episode null is the default. A list is a default for all."""
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    listed = text.where("v LIKE '[%'").select(F.lit(None).cast("long").alias("episode"), F.from_json("v", "array<string>").alias("labels"))
    keyed = text.where("v LIKE '{%'").select(F.explode(F.from_json("v", "map<string,array<string>>")).alias("k", "labels"))
    keyed = keyed.select(F.expr("CASE WHEN k <> 'default' THEN cast(k AS bigint) END").alias("episode"), "labels")
    return listed.unionByName(keyed)


def labels_for(episodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Each episode's own labels, else the default."""
    own = labels.where("episode IS NOT NULL").withColumnRenamed("labels", "_own")
    default = labels.where("episode IS NULL").agg(F.first("labels", ignorenulls=True).alias("_default"))  # one row
    return episodes.join(own, "episode", "left").join(F.broadcast(default)).select(*episodes.columns, F.coalesce("_own", "_default").alias("labels"))


def results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a result file, a JSON array or JSON lines, with their line from 0. Compressed files are read as they are."""
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    listed = text.where("v LIKE '[%'").select(F.posexplode(F.from_json("v", f"array<struct<{schema}>>")).alias("line", "r"))
    lines = text.where("v NOT LIKE '[%'").select(F.posexplode(F.split("v", "\n")).alias("line", "x")).where("trim(x) <> ''").select("line", F.from_json("x", f"struct<{schema}>").alias("r"))
    return listed.unionByName(lines).select(F.col("line").cast("long").alias("line"), "r.*")


def log_events(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """JSON objects that follow a tag on log lines."""
    lines = spark.read.text(path).where(F.col("value").contains(f"{tag} {{"))
    return lines.select(F.from_json(F.regexp_extract("value", re.escape(tag) + r" (\{.*\})", 1), schema).alias("r")).select("r.*")


def metric_total(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Sum over the samples of one metric in a Prometheus text file."""
    value = F.regexp_extract("value", rf"^{re.escape(name)}(?:\{{[^}}]*\}})?\s+([0-9.eE+-]+)", 1)
    return spark.read.text(path).select(value.alias("v")).where("v <> ''").agg(F.sum(F.expr("try_cast(v AS double)")).alias("total"))


def first_source(episodes: DataFrame, *sources: DataFrame) -> DataFrame:
    """Spans of each episode from the first source that has any."""
    ranked = [s.select("episode_index", "idx", "text", "start", "end", F.lit(i).alias("rank")) for i, s in enumerate(sources)]
    rows = ranked[0]
    for r in ranked[1:]:
        rows = rows.unionByName(r)
    best = F.min("rank").over(Window.partitionBy("episode_index"))
    return rows.join(episodes.select("episode_index"), "episode_index", "left_semi").withColumn("_best", best).where("rank = _best").drop("_best")


def arms(path: str, spark: SparkSession) -> DataFrame:
    """(name, tool, flags) of an arm configuration in YAML."""
    import yaml

    text = spark.read.text(path, wholetext=True).collect()[0]["value"]  # one file
    return spark.createDataFrame([(a["name"], a.get("tool"), {k: str(v) for k, v in (a.get("flags") or {}).items()}) for a in yaml.safe_load(text)["arms"]], "name string, tool string, flags map<string,string>")


def expand(text: str, env: dict | None = None) -> str:
    """$NAME and ${NAME} from the environment; an unset one is an error."""
    env = os.environ if env is None else env

    def one(m):
        name = m[1] or m[2]
        if name not in env:
            raise KeyError(f"{name} isn't set")
        return env[name]

    return re.sub(r"\$(?:\{(\w+)\}|(\w+))", one, text)


def substitute(flags: Column, values: dict[str, str]) -> Column:
    """{name} in the values of a map, replaced."""

    def one(v):
        for k, x in values.items():
            v = F.replace(v, F.lit("{" + k + "}"), F.lit(x))
        return v

    return F.transform_values(flags, lambda _, v: one(v))
