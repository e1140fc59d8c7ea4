"""Writing: staged rows, annotated frames by staged publication, reports and append-only logs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_rows(rows: DataFrame, folder: str) -> None:
    """One folder a module; a module that is staged again replaces its own."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("module").json(folder)


def differences(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of either side that the other lacks, with multiplicity."""
    x, y = a.select(*columns), b.select(*columns)
    return x.exceptAll(y).withColumn("only_in", F.lit("old")).unionByName(y.exceptAll(x).withColumn("only_in", F.lit("new")))


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def publish(frames: DataFrame, target: str, identity: list[str]) -> str:
    """Writes frames beside target, checks them against what is there, then puts them in its place.

    The rows are staged first; if row identities differ nothing changes. The old
    folder moves aside before the new one moves in, and `recover` completes or
    undoes a swap that was cut off. An episode's rows lie together and in order.
    """
    spark = frames.sparkSession
    fs, path = _files(spark, target)
    recover(spark, target)
    staged, old = f"{target}._staged_{uuid.uuid4().hex}", f"{target}._old"
    layout = frames.repartitionByRange("episode_index").sortWithinPartitions("episode_index", "timestamp") if "episode_index" in frames.columns else frames
    layout.write.parquet(staged)
    if fs.exists(path(target)):
        if not differences(spark.read.parquet(target), spark.read.parquet(staged), identity).isEmpty():
            fs.delete(path(staged), True)
            raise ValueError("the new rows aren't those of the dataset")
        fs.rename(path(target), path(old))
    fs.rename(path(staged), path(target))
    fs.delete(path(old), True)
    return target


def recover(spark: SparkSession, target: str) -> None:
    """After a crash: the old folder comes back unless the new one is in place."""
    fs, path = _files(spark, target)
    old = path(f"{target}._old")
    if fs.exists(old):
        if fs.exists(path(target)):
            fs.delete(old, True)
        else:
            fs.rename(old, path(target))


def append_log(rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").json(folder)


def timeline(start: Column, end: Column, duration: Column, width: int = 40) -> Column:
    """A text bar: blanks up to int(width * start / duration), then # for the span, one at least."""
    left = F.floor(width * start / duration).cast("int")
    return F.concat(F.repeat(F.lit(" "), left), F.repeat(F.lit("#"), F.greatest(F.lit(1), F.floor(width * (end - start) / duration).cast("int"))))


def feature_declarations(features: dict, dropped: tuple[str, ...] = ("subtask_index",)) -> dict:
    """Dataset features with the two language columns declared and dropped ones removed."""
    own = {k: v for k, v in features.items() if k not in dropped}
    return own | {name: {"dtype": "language", "shape": [1], "names": None} for name in ("language_persistent", "language_events")}
