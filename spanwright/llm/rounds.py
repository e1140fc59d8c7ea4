"""Rounds of messages between groups of documents and blocks of keys.

Documents are dealt once into groups of bounded bytes. In a round, each group
sends, for each block of the key space, one packed payload that already holds
every key at most once; each block answers each group with one packed reply.
So a key of any frequency reaches its block once a group, and what a task holds
is bounded by the group's bytes or the block's share of a uniform hash. All
rounds of a query read the same exchange of documents, which Spark reuses.

Number of messages: T bytes of text make G = T / (4 MB g) groups, and K keys
B = K / (2 M g) blocks, where g is the square root of T / 16 GB, between 1 and 16.
A round sends at most G B messages. From 16 GB to 4 TB that is T K / 8e12 * 16 GB / T,
so in proportion to the input, with about 500 keys a message; beyond, where g stays
16 (groups of 64 MB) so that a task's memory is bounded, a message has
2000 TB / T keys, some 20 at 100 TB.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb

MESSAGE = "p int, block long, payload binary"
_MESSAGE = pa.schema([("p", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or else the checkpoint folder that was set.

    Only a session in one process (local mode) may do without; there it is a folder of the warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            return found.get()
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends there and lost executors don't matter."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["_written_at"] = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that written() made and that nothing will read again."""
    for t in tables:
        if path := t.__dict__.pop("_written_at", None):
            jvm = t.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def numbered(docs: DataFrame, *columns: str) -> tuple:
    """docs with its columns named _0, _1, ... (whatever their names were), and the new names of some."""
    return docs.toDF(*[f"_{i}" for i in range(len(docs.columns))]), *[f"_{docs.columns.index(c)}" for c in columns]


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", parts: int = 4096) -> DataFrame:
    """left joined by key to right, which has one row a key, without a hot key.

    Keys of more than a parts-th of left's rows, which are fewer than `parts` by
    count, are looked up in a broadcast; the others, none of them large, shuffle.
    """
    often = left.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_often")).count().where(F.col("count") > left.count() // parts + 1).select("_often")
    hot = F.col(key) == F.col("_often")
    found = F.broadcast(right.join(F.broadcast(often), hot, "left_semi"))
    rest = left.join(F.broadcast(often), hot, "left_anti")
    if how == "inner":  # rows of frequent keys that right hasn't got go at once
        return left.join(found, key).unionByName(rest.join(right, key))
    # keys that are frequent in left but not in right match nothing in either way
    hot = left.join(F.broadcast(often), hot, "left_semi")
    return hot.join(found, key, how).unionByName(rest.join(right, key, how))


def growth(size: int) -> float:
    """How many times as large groups and blocks are as those of a small input (see above)."""
    return min(16.0, max(1.0, math.sqrt(size / (16 << 30))))


class Groups:
    """Documents dealt into groups `p` of about group_bytes of text by a hash of id and text.

    With carry, the columns of docs come along as _0, _1, ... for the last step to return.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = 4 << 20, carry: bool = False):
        spark = docs.sparkSession
        rows, ids, texts = numbered(docs, id_col, text_col)
        ids, texts = rows[ids].cast("long"), rows[texts].cast("string")
        self.bytes = int(rows.agg(F.sum(F.octet_length(texts)).alias("b")).first()["b"] or 0)
        self.grow = growth(self.bytes)
        self.n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(self.bytes / (group_bytes * self.grow)))
        self.table = rows.select(F.pmod(F.xxhash64(ids, texts), F.lit(self.n)).cast("int").alias("p"), ids.alias("doc_id"), texts.alias("text"), *([rows[c] for c in rows.columns] if carry else []))
        self.all = self.table

    def restrict(self, ids: DataFrame, small: bool) -> None:
        """From now on only documents with these ids take part; small: the ids' number is checked and may be broadcast."""
        self.table = self.all.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi").select(self.all.columns)

    def blocks(self, keys: float, per_block: int = 1 << 21) -> int:
        """Bits of a block number so that a block has about per_block of so many keys."""
        return max(3, math.ceil(math.log2(max(1.0, keys / (per_block * self.grow)))))

    def send(self, emit: Callable, replies: DataFrame | None = None) -> DataFrame:
        """emit(p, docs table, {(tag, block): payload}) yields (block, payload)."""

        def run(p, docs, back):
            rows = list(emit(p, docs, back))
            return pa.table({"p": pa.array([p] * len(rows), pa.int32()), "block": pa.array([b for b, _ in rows], pa.int64()), "payload": pa.array([x for _, x in rows], pa.binary())}, schema=_MESSAGE)

        return self.apply(run, MESSAGE, replies)

    def apply(self, fn: Callable, schema: str, replies: DataFrame | None = None) -> DataFrame:
        """fn(p, docs table, {block: payload}) for each group, with the replies sent to it."""
        def alone(docs: pa.Table) -> pa.Table:
            out = fn(docs["p"][0].as_py(), ordered(docs), {})
            tb.release()
            return out

        def both(docs: pa.Table, back: pa.Table) -> pa.Table:
            p = (docs if docs.num_rows else back)["p"][0].as_py()
            out = fn(p, ordered(docs), dict(zip(back["block"].to_pylist(), back["payload"].to_pylist(), strict=True)))
            tb.release()
            return out

        if replies is None:
            return self.table.groupBy("p").applyInArrow(alone, schema)
        return self.table.groupBy("p").cogroup(replies.groupBy("p")).applyInArrow(both, schema)


def ordered(docs: pa.Table) -> pa.Table:
    """In the same order each time, whatever order the rows arrived in."""
    return docs.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def answer(messages: DataFrame, resolve: Callable) -> DataFrame:
    """resolve(block, [p], [payload]) gives, for each block, rows (p, payload) of replies."""

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        order = table.sort_by([("p", "ascending")])
        rows = list(resolve(block, order["p"].to_pylist(), order["payload"].to_pylist()))
        tb.release()
        return pa.table({"p": pa.array([p for p, _ in rows], pa.int32()), "block": pa.array([block] * len(rows), pa.int64()), "payload": pa.array([x for _, x in rows], pa.binary())}, schema=_MESSAGE)

    return messages.groupBy("block").applyInArrow(run, MESSAGE)
