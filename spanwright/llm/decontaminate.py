"""Benchmark decontamination: Wu-Manber search of all benchmark windows in whole texts.

Texts are normalised to words joined by single spaces. Patterns are the windows of `window`
consecutive words of each item (an item of fewer words is one pattern), in
classes by length. For each class, a table indexed by a hash of the last
`block` bytes under the search window tells how far it may move; where that is 0,
the patterns filed under exactly that block are compared byte by byte. Many
cursors walk a batch at once, so a step of all of them is a few array operations.

The patterns are broadcast in shards of at most `shard_bytes` of item text each,
however large the benchmark is: the driver, and a worker, hold one at a time.
Documents are read once, where they lie, without a shuffle; skew doesn't matter.

Defined cases: null and wordless texts have no words and no hits; items without
words or with a null item_id are left out; items that share an id are one; a
window in several items counts for each; repeated documents each get their row;
an empty benchmark finds nothing; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .rounds import numbered, written

SCHEMA = "doc_id long, n_words long, n_hit long, items array<string>, hit_spans array<struct<first:long,words:long>>"
U64 = np.uint64
#: Bytes that aren't part of a word: ASCII but for digits and letters.
NOT_WORD = np.ones(256, bool)
NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = NOT_WORD[128:] = False
_TO = np.where(NOT_WORD, 32, tb.LOWER).astype(np.uint8)
_END = 10


def normalise(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Each text as a line feed, then its lower-case words with single spaces between; 8 line feeds at the end."""
    heads = offs[:-1] + np.arange(len(offs) - 1)
    n = int(offs[-1]) + len(heads)
    body = np.ones(n, bool)
    body[heads] = False
    out = np.full(n, _END, np.uint8)
    out[body] = _TO[buf[: offs[-1]]]
    word = (out != 32) & body
    keep = word | ~body
    keep[1:] |= word[:-1]
    return np.concatenate([out[keep], np.full(8, _END, np.uint8)])


def _view(text: np.ndarray) -> np.ndarray:
    return np.ndarray((len(text) - 7,), dtype="<u8", buffer=text, strides=(1,))


@dataclass
class Class:
    """Patterns of like length, filed by the block that ends at the shortest one's end."""

    least: int
    block: int
    bits: int
    shift: np.ndarray
    filed: np.ndarray
    pattern: np.ndarray


@dataclass
class Patterns:
    text: np.ndarray
    start: np.ndarray
    size: np.ndarray
    words: np.ndarray
    items: list[list[str]]
    classes: list[Class]

    @classmethod
    def of(cls, rows: list[tuple[str, str]], window: int) -> Patterns:
        found: dict[bytes, set[str]] = {}
        for item, text in rows:
            line = normalise(*tb.column_bytes(pa.array([text], pa.string()))).tobytes().strip(b"\n ")
            words = line.split(b" ") if line else []
            for i in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(b" ".join(words[i : i + window]), set()).add(item)
        keys = sorted(found)
        size = np.array([len(k) for k in keys], np.int64)
        text = np.frombuffer(b"".join(keys) + bytes(8), np.uint8)
        start = np.cumsum(size) - size
        classes = []
        kind = np.array([n.bit_length() for n in size.tolist()], np.int64)
        for k in np.unique(kind):
            own = np.flatnonzero(kind == k)
            least = int(size[own].min())
            block = max(1, min(8, (least + 1) // 2))
            mask = U64((1 << (8 * block)) - 1)
            view = _view(text)
            bits = min(24, max(12, math.ceil(math.log2(len(own) * (least - block + 1) * 16))))
            shift = np.full(1 << bits, least - block + 1, np.int32)
            for j in range(least - block + 1):  # ends least - block - j before the end
                np.minimum.at(shift, (tb.mix(view[start[own] + j] & mask) >> U64(64 - bits)).astype(np.int64), least - block - j)
            filed = view[start[own] + least - block] & mask
            order = np.argsort(filed, kind="stable")
            classes.append(Class(least, block, bits, shift, filed[order], own[order]))
        return cls(text, start, size, np.array([k.count(b" ") + 1 for k in keys], np.int64), [sorted(found[k]) for k in keys], classes)

    def search(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in text, pattern) of every occurrence between word ends."""
        places, patterns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        view = _view(text)
        for c in self.classes:
            ends = self._stops(c, view, len(text) - 8)
            block = view[ends - c.block + 1] & U64((1 << (8 * c.block)) - 1)
            lo, hi = np.searchsorted(c.filed, block), np.searchsorted(c.filed, block, side="right")
            n = hi - lo
            at = np.repeat(ends - c.least + 1, n)
            own = c.pattern[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
            good = np.flatnonzero(at + self.size[own] <= len(text) - 8)
            good = good[(text[at[good] - 1] <= 32) & (text[at[good] + self.size[own[good]]] <= 32)]
            own_view, step = _view(self.text), 0
            at, own = at[good], own[good]
            same = np.ones(len(at), bool)
            todo = np.arange(len(at))
            while len(todo):
                mask = tb._TAIL[np.minimum(self.size[own[todo]] - step, 8)]
                same[todo] = ((view[at[todo] + step] ^ own_view[self.start[own[todo]] + step]) & mask) == 0
                step += 8
                todo = todo[same[todo] & (self.size[own[todo]] > step)]
            places.append(at[same])
            patterns.append(own[same])
        return np.concatenate(places), np.concatenate(patterns)

    @staticmethod
    def _stops(c: Class, view: np.ndarray, size: int, stride: int = 1024) -> np.ndarray:
        """Ends of the search windows where the table says 0."""
        mask = U64((1 << (8 * c.block)) - 1)
        first = np.arange(c.least, size, stride)  # a text begins with a line feed, so place 0 starts nothing
        pos, last = first.copy(), np.minimum(first + stride, size)
        out = [np.zeros(0, np.int64)]
        while len(pos):
            step = c.shift[(tb.mix(view[pos - c.block + 1] & mask) >> U64(64 - c.bits)).astype(np.int64)]
            out.append(pos[step == 0])
            pos = pos + np.maximum(step, 1)
            on = pos < last
            pos, last = pos[on], last[on]
        return np.concatenate(out)


def scan(batch: pa.RecordBatch, shards: list, id_col: str = "doc_id", text_col: str = "text"):
    """Word count, hit words, items and hit spans of each text of the batch."""
    buf, offs = tb.column_bytes(batch[text_col])
    text = normalise(buf, offs)
    rows = len(offs) - 1
    heads = np.flatnonzero(text[:-8] == _END)
    word = text > 32
    word_at = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    edge = np.searchsorted(word_at, np.append(heads, len(text)))
    step = np.zeros(len(word_at) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for patterns in shards:
        at, own = patterns.search(text)
        first = np.searchsorted(word_at, at)
        np.add.at(step, first, 1)
        np.subtract.at(step, first + patterns.words[own], 1)
        doc = np.searchsorted(heads, at, side="right") - 1
        pairs = np.unique(np.stack([doc, own]), axis=1)
        for d, k in pairs.T.tolist():
            items.setdefault(d, set()).update(patterns.items[k])
    hit = np.cumsum(step)[:-1] > 0
    before = np.concatenate([[0], np.cumsum(hit)])
    n_hit = before[edge[1:]] - before[edge[:-1]]
    spans: list[list] = [[] for _ in range(rows)]
    for d in np.flatnonzero(n_hit).tolist():
        own = hit[edge[d] : edge[d + 1]]
        turn = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
        spans[d] = [{"first": a, "words": b - a} for a, b in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True)]
    return np.diff(edge), n_hit, [sorted(items.get(d, ())) for d in range(rows)], spans


def pattern_shards(benchmark: DataFrame, item_col: str, text_col: str, window: int, shard_bytes: int) -> list:
    """Broadcast patterns, each made of about shard_bytes of item text at most."""
    rows, i, t = numbered(benchmark, item_col, text_col)
    rows = rows.select(rows[i].cast("string").alias("item"), rows[t].cast("string").alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / shard_bytes))
    sc = benchmark.sparkSession.sparkContext
    if n > 1:  # written in order of shard, so that each is read by itself
        rows = written(rows.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(n))).repartition("shard").sortWithinPartitions("shard"))
    # each shard is bounded; an item is never split, so a longer one makes a longer shard
    return [sc.broadcast(Patterns.of([(r["item"], r["text"]) for r in (rows.where(F.col("shard") == k) if n > 1 else rows).select("item", "text").toLocalIterator()], window)) for k in range(n)]


def _values(shards: list):
    for b in shards:
        yield b.value
        if len(shards) > 1:
            b.__dict__.pop("_value", None)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, shard_bytes: int = 4 << 20) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, items (ids in order as strings), hit_spans (in words)."""
    shards = pattern_shards(benchmark, item_col, item_text_col, window, shard_bytes)

    def run(batches):
        for whole in batches:
            for batch in tb.slices(whole, "text"):
                n, hit, items, spans = scan(batch, _values(shards))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())])))],
                    ["doc_id", "n_words", "n_hit", "items", "hit_spans"],
                )
            tb.release()

    rows, i, t = numbered(docs, id_col, text_col)
    return rows.select(rows[i].cast("long").alias("doc_id"), rows[t].cast("string").alias("text")).mapInArrow(run, SCHEMA)


def clean_rows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, shard_bytes: int = 4 << 20) -> DataFrame:
    """The rows of docs, with their columns, whose text holds no benchmark window."""
    shards = pattern_shards(benchmark, item_col, item_text_col, window, shard_bytes)

    rows, t = numbered(docs, text_col)

    def hits(batches):
        for whole in batches:
            for batch in tb.slices(whole, t):
                _, hit, _, _ = scan(batch, _values(shards), text_col=t)
                yield batch.filter(pa.array(hit == 0))
            tb.release()

    return rows.mapInArrow(hits, rows.schema).toDF(*docs.columns)


def contaminated() -> Column:
    return F.col("n_hit") > 0
