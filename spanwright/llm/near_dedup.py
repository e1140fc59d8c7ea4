"""MinHash near-dedup with an LSH forest, links confirmed on full shingle sets.

1. A pass makes each document's set of word shingles; sets with one digest of
   all their shingles are equal, and only the smallest doc_id of each goes on.
2. Each of `trees` trees orders the rest by its own sequence of minimum hashes.
   Documents that agree on a tree's first `depth` hashes form a region. In the
   sorted order the common prefix of each entry with the one before is measured,
   and a region of more than `near` + 1 documents is divided by one more hash as
   long as that takes it below that number, to `levels` hashes at most: its depth
   adapts to how dense it is. Candidates of a document are the `near` next ones
   of its own part, those with the longest common prefixes. Size bounds that no
   linked pair exceeds drop candidates early.
3. The text of the smaller id goes once to every group of documents that holds a
   candidate of it, and the exact similarity decides.
4. Links make components by alternating large and small stars.
5. Regions of more than `near` + 1 documents that aren't one component yet stay
   open. Of their documents, a count tells how many shingles occur in no other
   open document. That bounds every overlap: documents that can't reach the limit
   with any other are set aside, and of the rest, pairs across components whose
   bound reaches it are tested, at distances in the order of up to 16 times as
   many places each turn, until no region is open; pairs with so few equal
   minimum hashes that a linked pair has them by a chance of 3e-7 at most (by the
   binomial tail) are passed over. So no
   region has a cap on partners. A later turn sends a document only for the
   trees in which its region is open. Which regions are open is asked in a round
   of messages too: a group of documents sends the least and largest component of
   each region it has part of, so tables and joins hold one row a document, not
   one a document and tree.

What is sent grows with documents, never with pairs of a group: copies are
grouped first, a region gives at most `near` candidates a document, and a text
reaches a group of documents once. Where a join's key may be that of a large
group of copies, frequent keys go by a broadcast of counted size (spread_join).

Defined cases: null and blank texts have the empty set and link with nothing;
rows that share a doc_id are one node; a row with a null doc_id is its own
component, kept, with a null component_id; texts of any length are taken whole
(a task holds about 40 bytes for each byte of its longest text); other columns are
ignored, or come along unchanged, whatever their names, in near_dedup_rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .rounds import MESSAGE, Groups, answer, dropped, numbered, spread_join, written
from .suffix_dedup import _join, _runs
from .substring_dedup import _split

U64 = np.uint64
_SIGN = U64(1 << 63)
_NODE = "p int, doc_id long, n_shingles long, digest binary"
_TREE = U64(31)  # low bits of a region's key: its tree
_MEMBER = "p int, member long, regions array<bigint>"
#: How many times as far each turn looks.
_WIDER = 16


def _shingles(buf: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, with repeats, and where each text's begin (n + 1 edges)."""
    buf = tb.LOWER[buf]
    starts, ends, doc = tb.words(buf, offs)
    tokens = tb.hash_spans(buf, starts, ends)
    edge = np.searchsorted(doc, np.arange(len(offs)))
    count = np.diff(edge)
    n = max(len(tokens) - width + 1, 0)
    ok = np.flatnonzero(doc[:n] == doc[width - 1 :][:n])
    out, owner = tb.window_hashes(tokens, width, 1)[ok], doc[ok]
    few = np.flatnonzero((count > 0) & (count < width))
    if len(few):
        short = np.array([tb.window_hashes(tokens[edge[i] : edge[i + 1]], int(count[i]), 10 + int(count[i]))[0] for i in few], U64)
        out, owner = np.concatenate([out, short]), np.concatenate([owner, few])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, np.searchsorted(owner, np.arange(len(offs)))


def _signatures(shingles: np.ndarray, edge: np.ndarray, n: int) -> np.ndarray:
    """n minimum hashes of each (non-empty) text."""
    rng = np.random.default_rng(20240)
    turn = rng.integers(0, 1 << 63, n, dtype=U64)
    times = rng.integers(0, 1 << 63, n, dtype=U64) | U64(1)
    out = np.empty((len(edge) - 1, n), np.uint32)
    at = 0
    while at < len(edge) - 1:  # some texts a time, so that the arrays stay in cache
        end = max(at + 1, int(np.searchsorted(edge, edge[at] + (1 << 15), side="right")) - 1)
        x, heads = shingles[edge[at] : edge[end]], edge[at:end] - edge[at]
        for k in range(n):
            out[at:end, k] = np.minimum.reduceat((x ^ turn[k]) * times[k], heads) >> U64(32)
        at = end
    return out


def _least_alike(n: int, limit: float, chance: float = 3e-7) -> int:
    """The largest number of n equal hashes that a pair at the limit stays below with at most this chance."""
    tail, least = 0.0, 0
    while least < n and tail + (p := math.comb(n, least) * limit**least * (1 - limit) ** (n - least)) <= chance:
        tail, least = tail + p, least + 1
    return least


class Forest:
    """What the steps share."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, trees: int, depth: int, levels: int, near: int):
        self.shingle, self.percent, self.trees, self.depth, self.levels, self.near = shingle, percent, trees, depth, levels, near
        self.groups = Groups(docs, id_col, text_col)
        self.bits = self.groups.blocks(max(self.groups.bytes / 2000, 1) * trees, 1 << 18)

    def nodes(self) -> DataFrame:
        """(p, doc_id, n_shingles, key1, key2): sizes and hashes of the sets."""
        width = self.shingle

        def run(batches):
            for whole in batches:
                for batch in tb.slices(whole, "text"):
                    x, edge = _shingles(*tb.column_bytes(batch["text"]), width)
                    n, digest = np.zeros(batch.num_rows, np.int64), [b""] * batch.num_rows
                    for i in np.flatnonzero(np.diff(edge)).tolist():
                        own = np.unique(x[edge[i] : edge[i + 1]])
                        n[i] = len(own)
                        digest[i] = hashlib.blake2b(own.astype("<u8").tobytes(), digest_size=20).digest()
                    yield pa.RecordBatch.from_arrays([batch["p"], batch["doc_id"], pa.array(n), pa.array(digest, pa.binary())], ["p", "doc_id", "n_shingles", "digest"])
                tb.release()

        return self.groups.table.select("p", "doc_id", "text").mapInArrow(run, _NODE)

    def shared(self) -> DataFrame:
        """(doc_id, n): how many of a document's distinct shingles no other document now taking part has."""
        width = self.shingle

        def run(batches):
            for whole in batches:
                for batch in tb.slices(whole, "text", 1 << 20):
                    x, edge = _shingles(*tb.column_bytes(batch["text"]), width)
                    sets = [np.unique(x[i:j]).view(np.int64) for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                    ids = batch["doc_id"].take(pa.array(np.repeat(np.arange(len(sets)), [len(v) for v in sets])))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))], ["doc_id", "shingle"])
                tb.release()

        rows = self.groups.table.select("doc_id", "text").mapInArrow(run, "doc_id long, shingle long")
        alone = rows.groupBy("shingle").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last")).where("doc_id = last")
        return alone.groupBy("doc_id").agg(F.count("*").alias("n"))

    def candidates(self, chosen: DataFrame, turn: int) -> DataFrame:
        """Requests (p, block, payload) to the groups of smaller ids: which texts to send where.

        Rows with p < 0 tell group -1 - p which of its documents are in regions that have pairs at larger distances.
        chosen: (p, doc_id, n_shingles, most: how many of them another document may share, label, mask: a bit
        for each tree to look in); pairs with one label are left out.
        """
        trees, depth, levels, near, percent, width = self.trees, self.depth, self.levels, self.near, self.percent, self.shingle
        bits = self.bits
        n_hashes, limit = trees * levels, percent / 100
        least = _least_alike(n_hashes, limit)

        def plant(p, docs, back):
            pick, seen = [], set()
            for i, d in enumerate(docs["doc_id"].to_pylist()):
                if d in back and d not in seen:
                    seen.add(d)
                    pick.append((i, d, *np.frombuffer(back[d], ">i8").tolist()))
            if not pick:
                return
            column = docs["text"].combine_chunks().take(pa.array([i for i, *_ in pick]))
            x, edge = _shingles(*tb.column_bytes(column), width)
            has = np.flatnonzero(np.diff(edge))
            if not len(has):
                return
            edge = np.append(edge[has], edge[-1])
            sig = _signatures(x, edge, trees * levels)
            ids = np.array([pick[i][1] for i in has], np.int64)
            size, most, label, mask = (np.array([pick[i][k] for i in has], np.int64) for k in (2, 3, 4, 5))
            keys, rows = [], []
            for t in range(trees):
                at = np.flatnonzero(mask >> t & 1)
                key = np.full(len(at), (t + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, U64)
                for k in range(depth):
                    key = tb.mix(key ^ sig[at, t * levels + k])
                keys.append(key & ~_TREE | U64(t))
                rows.append(at)
            # all trees' entries together: one message a block
            key, row, tree = np.concatenate(keys), np.concatenate(rows), np.repeat(np.arange(trees), [len(x) for x in rows])
            order = np.argsort(key, kind="stable")
            key, row, tree = key[order], row[order], tree[order]
            deep = sig[row[:, None], (tree * levels)[:, None] + np.arange(depth, levels)]
            for a, b in _runs(key >> U64(64 - bits)):
                o = row[a:b]
                # in later turns, over few documents, each entry has a byte of every hash along
                whole = sig[o].astype(np.uint8).tobytes() if turn else b""
                yield int(key[a] >> U64(64 - bits)), _join(tb.pack_sorted(key[a:b]), np.ascontiguousarray(deep[a:b]).astype(">u4").tobytes(), tb.pack(ids[o].view(U64) ^ _SIGN), tb.pack(size[o]), tb.pack(most[o]), tb.pack(label[o].view(U64) ^ _SIGN), zstandard.ZstdCompressor(level=1).compress(whole))

        def neighbours(block, senders, payloads):
            keys, deeps, ids, sizes, mosts, labels, homes, sigs = [], [], [], [], [], [], [], []
            for p, x in zip(senders, payloads, strict=True):
                k, v, d, n, m, c, w = _split(x)
                sigs.append(zstandard.ZstdDecompressor().decompress(w))
                keys.append(tb.unpack_sorted(k))
                deeps.append(np.frombuffer(v, ">u4").reshape(len(keys[-1]), -1))
                ids.append((tb.unpack(d) ^ _SIGN).view(np.int64))
                sizes.append(tb.unpack(n).astype(np.int64))
                mosts.append(tb.unpack(m).astype(np.int64))
                labels.append((tb.unpack(c) ^ _SIGN).view(np.int64))
                homes.append(np.full(len(keys[-1]), p))
            key, deep, d, n, m, c, home = (np.concatenate(x) for x in (keys, deeps, ids, sizes, mosts, labels, homes))
            order = np.lexsort((d, *deep.T[::-1], key))
            key, deep, d, n, m, c, home = key[order], deep[order], d[order], n[order], m[order], c[order], home[order]
            sig = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(key), -1)[order] if turn else None
            first = tb.group_starts(key)
            members = _group_sizes(first)
            # the common prefix of each entry with the one before, and the depth at which its part is small enough
            prefix, parted = np.where(first, 0, depth), np.full(len(key), depth)
            new = first
            for level in range(deep.shape[1]):
                wide = _group_sizes(new) > near + 1
                new = new | np.append(True, deep[1:, level] != deep[:-1, level])[: len(key)]
                prefix[~new] += 1
                parted[wide] += 1
            if turn:  # all of an open region
                parted[:] = depth
            out = []
            live, common = np.flatnonzero(prefix[1:] >= depth), prefix[1:].copy()
            for step in range(1, near * _WIDER**turn + 1):
                live = live[live + step < len(key)]
                common[live] = np.minimum(common[live], prefix[live + step])  # a pair's prefix is the least on the way
                live = live[common[live] >= depth]
                if not len(live):
                    break
                i = live[common[live] >= parted[live]]
                j = i + step
                both = np.minimum(m[i], m[j])  # at most
                good = (100 * both >= percent * (n[i] + n[j] - both)) & (c[i] != c[j]) & (d[i] != d[j])
                i, j = i[good], j[good]
                if turn:  # estimates that a linked pair has by a chance of 3e-7 at most go
                    alike = np.zeros(len(i), bool)
                    for x in range(0, len(i), 1 << 17):
                        alike[x : x + (1 << 17)] = (sig[i[x : x + (1 << 17)]] == sig[j[x : x + (1 << 17)]]).sum(1) >= least
                    i, j = i[alike], j[alike]
                swap = d[i] > d[j]
                out.append(np.stack([np.where(swap, j, i), np.where(swap, i, j)]))
            if out:
                a, b = np.concatenate(out, axis=1)
                by = np.lexsort((d[b], d[a], home[b], home[a]))
                a, b = a[by], b[by]
                for x, y in _runs(home[a]):
                    yield int(home[a[x]]), _join(tb.pack(d[a[x:y]].view(U64) ^ _SIGN), tb.pack(d[b[x:y]].view(U64) ^ _SIGN), tb.pack(home[b[x:y]]))
            wide = members > near * _WIDER**turn + 1
            key, d, home = key[wide], d[wide], home[wide]
            by = np.lexsort((d, key, home))
            for x, y in _runs(home[by]):
                o = by[x:y]
                yield -1 - int(home[o[0]]), _join(tb.pack_sorted(key[o]), tb.pack(d[o].view(U64) ^ _SIGN))

        payload = F.expr("unhex(concat(lpad(hex(n_shingles), 16, '0'), lpad(hex(most), 16, '0'), lpad(hex(label), 16, '0'), lpad(hex(mask), 16, '0')))")
        return answer(self.groups.send(plant, chosen.select("p", F.col("doc_id").alias("block"), payload.alias("payload"))), neighbours)

    def confirmed(self, requests: DataFrame) -> DataFrame:
        """(a, b) of the candidates whose sets are alike enough."""
        width, percent = self.shingle, self.percent

        def deliver(p, docs, back):
            if not back:
                return
            a, b, to = (np.concatenate(x) for x in zip(*((tb.unpack(x), tb.unpack(y), tb.unpack(z)) for x, y, z in map(_split, back.values())), strict=True))
            order = np.lexsort((b, a, to))
            a, b, to = a[order], b[order], to[order]
            new = tb.group_starts(a, b, to)
            a, b, to = a[new], b[new], to[new]
            row = {d: i for i, d in reversed(list(enumerate(docs["doc_id"].to_pylist())))}
            texts = docs["text"].combine_chunks()
            pack = zstandard.ZstdCompressor(level=1)
            for x, y in _runs(to):
                heads = np.flatnonzero(tb.group_starts(a[x:y])) + x
                own = (a[heads] ^ _SIGN).view(np.int64).tolist()
                body = [texts[row[d]].as_py().encode() for d in own]
                yield int(to[x]), _join(tb.pack(a[heads]), tb.pack(np.diff(np.append(heads, y))), tb.pack(b[x:y]), tb.pack(np.array([len(t) for t in body], np.int64)), pack.compress(b"".join(body)))

        def verify(p, docs, back):
            out: list[tuple[int, int]] = []
            row = {d: i for i, d in reversed(list(enumerate(docs["doc_id"].to_pylist())))} if back else {}
            texts = docs["text"].combine_chunks() if back else None
            own: dict[int, np.ndarray] = {}

            def sets(column):
                x, edge = _shingles(*tb.column_bytes(column), width)
                return [np.unique(x[i:j]) for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]

            for sender in sorted(back):
                a, n, b, size, body = _split(back[sender])
                a, b = ((tb.unpack(v) ^ _SIGN).view(np.int64) for v in (a, b))
                n, size = tb.unpack(n).astype(np.int64), tb.unpack(size).astype(np.int64)
                body = zstandard.ZstdDecompressor().decompress(body)
                ends = np.cumsum(size)
                theirs = sets(pa.array([body[e - s : e] for s, e in zip(size.tolist(), ends.tolist(), strict=True)], pa.binary()))
                need = [d for d in np.unique(b).tolist() if d not in own]
                if need:
                    own.update(zip(need, sets(texts.take(pa.array([row[d] for d in need]))), strict=True))
                at = 0
                for d, m, s in zip(a.tolist(), n.tolist(), theirs, strict=True):
                    for e in b[at : at + m].tolist():
                        t = own[e]
                        if len(s) and len(t):
                            i = np.searchsorted(t, s)
                            both = int((t[np.minimum(i, len(t) - 1)] == s).sum())
                            if 100 * both >= percent * (len(s) + len(t) - both):
                                out.append((d, e))
                    at += m
            return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

        sent = self.groups.send(deliver, requests)
        return self.groups.apply(verify, "a long, b long", sent.select(F.col("block").cast("int").alias("p"), F.col("p").cast("long").alias("block"), "payload"))


def _group_sizes(first: np.ndarray) -> np.ndarray:
    """The size of each row's group, where groups begin at `first`."""
    at = np.flatnonzero(first)
    return np.diff(np.append(at, len(first)))[np.cumsum(first) - 1]


def _union(batches):
    """Components of all edges of one task, by union-find."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root[top] != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist(), strict=True):
            root.setdefault(u, u)
            root.setdefault(v, v)
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "component"])


def components(edges: DataFrame, task_edges: int = 500_000) -> DataFrame:
    """(node, component): for each node of an edge (a, b), the smallest node it is connected with.

    At most task_edges distinct edges, a counted bound of some MB, are joined by union-find in one
    task. More go through large and small stars in turn (Kiveris et al., 2014), each an aggregate
    and a join that spreads hubs, until nothing changes.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    if edges.count() <= task_edges:
        return edges.coalesce(1).mapInArrow(_union, "node long, component long")
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    last = None
    while True:
        now = edges.agg(F.count("*"), mark).first()
        if now == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v")).groupBy("node").agg(F.min("component").alias("component"))
        last, old = now, edges
        both = written(edges.union(edges.select("v", "u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = written(spread_join(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = spread_join(large, least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").union(least)
        edges = written(small.distinct())
        dropped(old, both, large)


def _lists(values: np.ndarray, count: np.ndarray) -> pa.Array:
    """Lists of so many values each."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)), pa.int32()), pa.array(values, pa.int64()))


def _members(found: pa.Table) -> pa.Table:
    """(p, member, regions) of a group: its documents in regions that have pairs at larger distances."""
    keys, ids = zip(*(_split(x) for x in found["payload"].to_pylist()), strict=True)
    key, d = np.concatenate([tb.unpack_sorted(x) for x in keys]), (np.concatenate([tb.unpack(x) for x in ids]) ^ _SIGN).view(np.int64)
    order = np.lexsort((key, d))
    key, d = key[order], d[order]
    new = tb.group_starts(d, key)
    key, d = key[new], d[new]
    at = np.flatnonzero(tb.group_starts(d))
    p = pa.array(np.full(len(at), found["p"][0].as_py()), pa.int32())
    return pa.table([p, pa.array(d[at]), _lists(key.view(np.int64), np.diff(np.append(at, len(d))))], names=["p", "member", "regions"])


def _open(members: DataFrame, bits: int) -> DataFrame:
    """The members (p, member, label, regions) with those of their regions that have two labels or more.

    A group sends each block of regions the least and largest label it has in each, and is told which are open.
    """

    def regions(docs: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        lists = docs["regions"].combine_chunks()
        return lists.flatten().to_numpy(zero_copy_only=False).view(U64), lists.value_lengths().to_numpy(zero_copy_only=False)

    def ask(docs: pa.Table) -> pa.Table:
        key, count = regions(docs)
        label = np.repeat(docs["label"].to_numpy(), count)
        order = np.lexsort((label, key))
        key, label = key[order], label[order].view(U64) ^ _SIGN
        at = np.flatnonzero(tb.group_starts(key))
        key, low, high = key[at], label[at], label[np.append(at[1:], len(key)) - 1]
        block = key >> U64(64 - bits)
        rows = [(int(block[x]), _join(tb.pack_sorted(key[x:y]), tb.pack(low[x:y]), tb.pack(high[x:y]))) for x, y in _runs(block)]
        return pa.table([pa.array([docs["p"][0].as_py()] * len(rows), pa.int32()), pa.array([x for x, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["p", "block", "payload"])

    def judge(block, senders, payloads):
        keys, lows, highs = zip(*(_split(x) for x in payloads), strict=True)
        keys = [tb.unpack_sorted(x) for x in keys]
        key, low, high = np.concatenate(keys), *(np.concatenate([tb.unpack(x) for x in v]) for v in (lows, highs))
        order = np.argsort(key, kind="stable")
        key, low, high = key[order], low[order], high[order]
        at = np.flatnonzero(tb.group_starts(key))
        several = key[at][np.minimum.reduceat(low, at) != np.maximum.reduceat(high, at)]
        for p, own in zip(senders, keys, strict=True):
            own = own[np.isin(own, several)]
            if len(own):
                yield p, tb.pack_sorted(own)

    def keep(docs: pa.Table, back: pa.Table) -> pa.Table:
        if not docs.num_rows or not back.num_rows:
            return docs.slice(0, 0)
        key, count = regions(docs)
        in_open = np.isin(key, np.concatenate([tb.unpack_sorted(x) for x in back["payload"].to_pylist()]))
        left = np.bincount(np.repeat(np.arange(len(count)), count)[in_open], minlength=len(count))
        docs = docs.set_column(docs.column_names.index("regions"), "regions", _lists(key[in_open].view(np.int64), left))
        return docs.filter(pa.array(left > 0))

    members = members.select("p", "member", "label", "regions")
    replies = answer(members.groupBy("p").applyInArrow(ask, MESSAGE), judge)
    return members.groupBy("p").cogroup(replies.groupBy("p")).applyInArrow(keep, members.schema)


def labelled(forest: Forest, restrict_rows: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """Nodes (p, doc_id, n_shingles, root: the smallest id with an equal set) and components of roots."""
    seen = written(forest.nodes())
    real = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    roots = seen.where(real).groupBy("digest").agg(F.min("doc_id").alias("root"))
    nodes = spread_join(seen.where(real), roots, "digest").select("p", "doc_id", "n_shingles", "root")
    nodes = written(nodes.unionByName(seen.where(~real).select("p", "doc_id", "n_shingles", F.col("doc_id").alias("root"))))
    dropped(seen)
    reps = nodes.where("doc_id = root AND n_shingles > 0").groupBy("p", "doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    # rows that share a doc_id tie their sets together
    several = nodes.where("n_shingles > 0").groupBy("doc_id").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.min("n_shingles").alias("m"), F.max("n_shingles").alias("n")).where("x <> y OR m <> n").select("doc_id")
    edges = nodes.where("doc_id <> root").join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("root").alias("b"))
    chosen, turn, labels, used = reps.select("*", F.col("n_shingles").alias("most"), F.col("doc_id").alias("label"), F.lit((1 << forest.trees) - 1).cast("long").alias("mask")), 0, None, []
    while True:
        # one job, so that its steps share one exchange of documents
        requests = forest.candidates(chosen, turn)
        links = forest.confirmed(requests.where("p >= 0")).select("a", "b", F.lit(None).cast("int").alias("p"), F.lit(None).cast("binary").alias("payload"))
        found = written(links.unionByName(requests.where("p < 0").select((-1 - F.col("p")).alias("p"), "payload"), allowMissingColumns=True))
        new = written(found.where("a IS NOT NULL").select("a", "b").distinct())
        edges = edges.unionByName(new)
        if not turn or not new.isEmpty():
            old, labels = labels, written(components(edges))
            if old is not None:
                dropped(old)
        members = found.where("p IS NOT NULL").select("p", "payload").groupBy("p").applyInArrow(_members, _MEMBER)
        members = written(members.join(labels, members["member"] == labels["node"], "left").select("p", "member", F.coalesce("component", "member").alias("label"), "regions"))
        left = written(_open(members, forest.bits))
        dropped(found, members, *used)
        n = left.select("member").distinct().count()
        if n:
            # an open document whose shingles are too rarely shared links with no other
            forest.groups.restrict(left.select(F.col("member").alias("doc_id")).distinct(), small=n <= restrict_rows)
            own = forest.shared().join(several, "doc_id", "left_anti").withColumnsRenamed({"doc_id": "member", "n": "own"})
            sizes = reps.groupBy(F.col("doc_id").alias("member")).agg(F.max("n_shingles").alias("n"))
            judged = written(left.select("member").distinct().join(own, "member", "left").join(sizes, "member").select("member", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("most")))
            maybe = written(left.join(judged.where(100 * F.col("most") >= forest.percent * F.col("n")), "member"))
            # a region's tree is in the low bits of its key
            mask = F.expr("aggregate(regions, 0L, (m, r) -> m | shiftleft(1L, CAST(r & 31 AS int)))")
            rest = written(_open(maybe, forest.bits).groupBy("member", "label").agg(F.bit_or(mask).alias("mask")).join(judged.select("member", "most"), "member"))
            dropped(judged, maybe, left)
            used, open_ = [rest], rest
            n = open_.count()
        if not n:
            return nodes, labels
        forest.groups.restrict(open_.select(F.col("member").alias("doc_id")), small=n <= restrict_rows)
        chosen, turn = reps.join(open_, reps["doc_id"] == open_["member"]).select("p", "doc_id", "n_shingles", "most", "label", "mask"), turn + 1


def _judged(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, trees: int, depth: int, levels: int, near: int) -> DataFrame:
    nodes, labels = labelled(Forest(docs, id_col, text_col, shingle, percent, trees, depth, levels, near))
    return spread_join(nodes, labels.select(F.col("node").alias("root"), "component"), "root", "left").withColumn("component", F.coalesce("component", "root"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, trees: int = 24, depth: int = 4, levels: int = 6, near: int = 4) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept (doc_id is the component's smallest)."""
    out = _judged(docs, id_col, text_col, shingle, percent, trees, depth, levels, near)
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def near_dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, trees: int = 24, depth: int = 4, levels: int = 6, near: int = 4) -> DataFrame:
    """The rows of docs, with their columns, but for all members of a component other than its smallest id."""
    judged = _judged(docs, id_col, text_col, shingle, percent, trees, depth, levels, near)
    drop = judged.where(F.col("doc_id") != F.col("component")).select(F.col("doc_id").alias("gone")).distinct()
    rows, at = numbered(docs, id_col)
    return rows.join(drop, rows[at].cast("long") == drop["gone"], "left_anti").toDF(*docs.columns)
