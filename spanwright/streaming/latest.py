"""The append-only result log as a stream: the standing row of each key after each batch of late rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.selection import latest_wins


def latest_rows(stream: DataFrame, keys: list[str], line: str, failed: Column) -> DataFrame:
    """A streaming aggregate in update mode: the last row of each key, but an error never displaces a success.

    State is one row a key. The order is a struct compared by max: success first, then line.
    """
    rest = [c for c in stream.columns if c not in keys]
    best = F.max(F.struct((~failed).alias("_ok"), F.col(line).alias("_line"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(rest)]))
    return stream.groupBy(*keys).agg(best.alias("_b")).select(*keys, *[F.col(f"_b._{i}").alias(c) for i, c in enumerate(rest)])


def resumable(stream: DataFrame, cache: str, keys: list[str], answer, checkpoint: str) -> StreamingQuery:
    """Appends answer(rows) for keys that the cache folder lacks, batch by batch; a restart skips what is there."""

    def batch(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        new = rows.dropDuplicates(keys)
        try:
            new = new.join(spark.read.parquet(cache).select(*keys), keys, "left_anti")
        except Exception as e:
            if not any(x in str(e) for x in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
                raise
        answer(new).write.mode("append").parquet(cache)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def batch_equals(rows: DataFrame, keys: list[str], line: str, failed: Column) -> DataFrame:
    """What the stream holds in the end, computed at once."""
    return latest_wins(rows, keys, line, failed)
