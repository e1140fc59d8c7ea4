"""Substring dedup: runs of words that also start in a document with a smaller id are removed.

A count-min sketch over all windows of `window` words comes first. Each group of
documents sketches its distinct windows, the partial sketches meet block by
block (a block is a range of a row's cells) and are summed, and each group gets
back, for its own cells, whether the sum is two or more. The smallest answer
over the rows never falls below a window's count, so no repeat is lost. The
second pass sends only windows so estimated, as a 64-bit key and a 32-bit check
with the smallest doc_id of the group, and groups them by both; the chance that any
two different windows of 100 TB of text agree in both is 0.002.

The sketch has `cells` cells a window and row whatever the input's size, and no
task holds more than a block of it, so it is as sharp at 100 TB as at 1 GB.

Defined cases: null or blank text has no words and is kept as the empty string;
rows that share a doc_id are one document's texts, so they don't remove from one
another; a row with a null doc_id neither removes nor loses words; every input
row gives one row; a text is taken whole, however long (a task holds some 60 bytes
a word of its group); bytes that aren't UTF-8 stay; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textbytes as tb
from .rounds import Groups, answer

SCHEMA = "doc_id long, n_words long, n_removed long, kept_text string"
U64 = np.uint64


def _windows(docs: pa.Table, window: int, key_bits: int = 64):
    """Word bounds, and of each window: first word, doc_id, 64-bit key and 32-bit check."""
    buf, offs = tb.column_bytes(docs["text"])
    starts, ends, doc = tb.words(buf, offs)
    tokens = tb.hash_spans(buf, starts, ends)
    ids = docs["doc_id"].fill_null(0).to_numpy()
    real = docs["doc_id"].is_valid().to_numpy(zero_copy_only=False)
    n = max(len(tokens) - window + 1, 0)
    ok = np.flatnonzero((doc[:n] == doc[window - 1 :][:n]) & real[doc[:n]])
    key = tb.top_bits(tb.window_hashes(tokens, window, 1)[ok], key_bits)
    check = tb.window_hashes(tokens, window, 2)[ok] >> U64(32)
    return (buf, offs, starts, doc), ok, ids[doc[ok]], key, check


def _distinct(ids: np.ndarray, key: np.ndarray, check: np.ndarray):
    """For each distinct window of the group, in key order: its row, and whether two ids have it; then each row's window."""
    order, first = tb.grouped(key, check)
    at = np.flatnonzero(first)
    if not len(at):
        return order, first, order
    # rows are in order of doc_id, so a window's first row has the smallest and its last the largest
    rows, last = np.minimum.reduceat(order, at), np.maximum.reduceat(order, at)
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(first) - 1
    return rows, ids[rows] != ids[last], which


def _cells(key: np.ndarray, row: int, bits: int) -> np.ndarray:
    return tb.mix(key ^ U64(((row + 1) * 0xA0761D6478BD642F) & ((1 << 64) - 1))) >> U64(64 - bits)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, depth: int = 2, cells: int = 8, key_bits: int = 64) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept_text (words joined by one space).

    Fewer key_bits than 64 make different windows share keys, which only tests want.
    """
    groups = Groups(docs, id_col, text_col)
    expected = max(groups.bytes / 6, 1)  # words
    bits = min(60, max(16, math.ceil(math.log2(expected * cells))))
    block_bits = groups.blocks(expected)
    exact_bits = groups.blocks(expected / 4)

    def sketch(p, docs, _):
        _, _, ids, key, check = _windows(docs, window, key_bits)
        rows, several, _ = _distinct(ids, key, check)
        for row in range(depth):
            cell = _cells(key[rows], row, bits)
            order = np.argsort(cell)
            cell, count = cell[order], 1 + several[order].astype(U64)
            at = np.flatnonzero(tb.group_starts(cell))
            count = np.minimum(np.add.reduceat(count, at), 2) if len(at) else count
            cell = cell[at]
            block = cell >> U64(bits - block_bits)
            cut = np.append(np.flatnonzero(tb.group_starts(block)), len(block))
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if b > a:
                    data = tb.pack_sorted(cell[a:b])
                    yield (row << block_bits) | int(block[a]), len(data).to_bytes(4, "little") + data + np.packbits(count[a:b] > 1).tobytes()

    def merge(_, senders, payloads):
        parts = []
        for x in payloads:
            size = int.from_bytes(x[:4], "little")
            cell = tb.unpack_sorted(x[4 : 4 + size])
            parts.append((cell, 1 + np.unpackbits(np.frombuffer(x, np.uint8, -1, 4 + size), count=len(cell))))
        cell = np.concatenate([c for c, _ in parts])
        order = np.argsort(cell)
        first = tb.group_starts(cell[order])
        total = np.add.reduceat(np.concatenate([n for _, n in parts])[order].astype(np.int64), np.flatnonzero(first))
        often = np.empty(len(cell), bool)
        often[order] = (total > 1)[np.cumsum(first) - 1]
        at = 0
        for p, (c, _) in zip(senders, parts, strict=True):
            yield p, np.packbits(often[at : at + len(c)]).tobytes()
            at += len(c)

    def estimated(p, docs, back):
        """Sends the windows whose smallest sum over the rows is two or more."""
        _, _, ids, key, check = _windows(docs, window, key_bits)
        rows, _, _ = _distinct(ids, key, check)
        keep = np.ones(len(rows), bool)
        for row in range(depth):
            cell = _cells(key[rows], row, bits)
            order = np.argsort(cell)
            first = tb.group_starts(cell[order])
            own = cell[order][first]
            block = own >> U64(bits - block_bits)
            cut = np.append(np.flatnonzero(tb.group_starts(block)), len(block))
            often = [np.unpackbits(np.frombuffer(back[(row << block_bits) | int(block[a])], np.uint8), count=b - a) for a, b in zip(cut[:-1], cut[1:], strict=True) if b > a]
            if often:
                keep[order] &= np.concatenate(often).astype(bool)[np.cumsum(first) - 1]
        rows = rows[keep]
        k, c, d = key[rows], check[rows], ids[rows]
        block = k >> U64(64 - exact_bits)
        cut = np.append(np.flatnonzero(tb.group_starts(block)), len(block))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if b > a:
                parts = [tb.pack_sorted(k[a:b]), c[a:b].astype("<u4").tobytes(), tb.pack(d[a:b].view(U64) ^ U64(1 << 63))]
                yield int(block[a]), b"".join(len(x).to_bytes(4, "little") + x for x in parts)

    def group(_, senders, payloads):
        keys, checks, ids, sizes = [], [], [], []
        for x in payloads:
            k, c, d = _split(x)
            keys.append(tb.unpack_sorted(k))
            checks.append(np.frombuffer(c, "<u4"))
            ids.append(tb.unpack(d))
            sizes.append(len(keys[-1]))
        k, c, d = np.concatenate(keys), np.concatenate(checks), np.concatenate(ids)
        order = np.lexsort((d, c, k))
        first = tb.group_starts(k[order], c[order])
        least = d[order][first][np.cumsum(first) - 1]
        later = np.empty(len(k), bool)
        later[order] = d[order] > least
        at = 0
        for p, n in zip(senders, sizes, strict=True):
            mine = np.flatnonzero(later[at : at + n]) + at
            at += n
            if len(mine):
                parts = [tb.pack_sorted(k[mine]), c[mine].tobytes()]
                yield p, b"".join(len(x).to_bytes(4, "little") + x for x in parts)

    def remove(p, docs, back):
        (buf, offs, starts, doc), at, ids, key, check = _windows(docs, window, key_bits)
        rows, _, which = _distinct(ids, key, check)
        gone = ids > ids[rows][which] if len(rows) else np.zeros(0, bool)
        if back:
            k, c = (np.concatenate(x) for x in zip(*((tb.unpack_sorted(a), np.frombuffer(b, "<u4")) for a, b in (_split(back[n]) for n in sorted(back))), strict=True))
            hit = tb.located(k, c, key[rows], check[rows]) >= 0
            gone |= hit[which]
        lost = tb.covered(at[gone], window, len(starts))
        return kept_words(docs, buf, offs, doc, lost)

    estimates = answer(groups.send(sketch), merge)
    repeated = answer(groups.send(estimated, estimates), group)
    return groups.apply(remove, SCHEMA, repeated)


def _split(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return out


def kept_words(docs: pa.Table, buf: np.ndarray, offs: np.ndarray, doc: np.ndarray, lost: np.ndarray) -> pa.Table:
    n = len(docs)
    edge = np.searchsorted(doc, np.arange(n + 1))
    total = np.diff(edge)
    gone = np.bincount(doc[lost], minlength=n)
    raw, texts = buf.tobytes(), []
    for i in range(n):
        own = raw[offs[i] : offs[i + 1]].split()
        if gone[i]:
            own = [w for w, x in zip(own, lost[edge[i] : edge[i + 1]].tolist(), strict=True) if not x]
        texts.append(b" ".join(own))
    return pa.table({"doc_id": docs["doc_id"].cast(pa.int64()), "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept_text": tb.as_text(texts)})
