"""Suffix-array dedup: bytes covered by a 100-byte string that starts earlier are removed.

Every 100-byte window has an anchor, the least hash of its 48-byte parts, which
depends on the window's bytes alone; so equal windows meet wherever their anchor
does. Anchors deal the suffixes out: a run of windows with one anchor is a
context, and

1. the groups sketch their anchors; contexts whose anchor occurs once go no further;
2. equal contexts, by 96 bits of hash, are grouped; all but the earliest are repeats as
   a whole;
3. the earliest ones whose anchor also has other contexts go to the anchor's
   block, which leaves out windows whose hash occurs once there and sorts the
   suffixes of the rest with a difference cover modulo 3 (sort the sampled triples, recurse on their names, sort the rest by one byte and a
   sampled rank, merge) and compares neighbours' first 100 bytes: of the windows
   that agree, all but the earliest are repeats. Recursion ends once names stand
   for 100 bytes, as order beyond that isn't asked for;
4. each group removes what was found.

This departs from one difference cover over all suffixes, whose first level alone would
shuffle six times the text; the README has the figures. Windows of an anchor with more than `hot` places go to blocks by their own hash,
so one passage that fills a third of the corpus is still spread.

Defined cases: null text is empty; texts under 100 bytes keep all; windows are
ordered by (doc_id, start), and rows that share a doc_id are compared by it too,
so equal places of such rows don't remove one another; a row with a null doc_id
loses what it repeats itself and has no part in other rows; other columns are ignored. What is kept is
returned as bytes, as removal may cut a character.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textbytes as tb
from .rounds import Groups, answer
from .substring_dedup import _split

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
U64 = np.uint64
_CHUNK = 1 << 15
_PIECE = 256  # windows of a context at most; longer runs are several
_SIGN = U64(1 << 63)


def _join(*parts: bytes) -> bytes:
    return b"".join(len(x).to_bytes(4, "little") + x for x in parts)


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """best of x[i : i + width] for each i with a whole stretch."""
    have = 1
    while have * 2 <= width:
        x = best(x[:-have], x[have:]) if len(x) > have else x[:0]
        have *= 2
    rest = width - have
    return best(x[: len(x) - rest], x[rest:]) if rest and len(x) > rest else x[: max(len(x) - rest, 0)]


def _part_hashes(view: np.ndarray, part: int) -> np.ndarray:
    """A hash of each stretch of `part` bytes; view has the 8 bytes from each place."""
    h, have = tb.mix(view), 8
    while have * 2 <= part:
        h = h[: max(len(h) - have, 0)] * U64(0x9E3779B97F4A7C15) + h[have:] * U64(0xC2B2AE3D27D4EB4F + 2 * have)
        have *= 2
    rest = part - have
    if rest:
        h = h[: max(len(h) - rest, 0)] * U64(0xA0761D6478BD642F) + h[rest:] * U64(0xE7037ED1A0B428DB)
    return h ^ (h >> U64(32))


class Windows:
    """Anchors and contexts of a group's texts."""

    def __init__(self, docs: pa.Table, window: int, part: int):
        self.window, self.part, self.reach = window, part, window - part + 1
        self.buf, self.offs = tb.column_bytes(docs["text"])
        self.ids = docs["doc_id"].fill_null(0).to_numpy()
        real = docs["doc_id"].is_valid().to_numpy(zero_copy_only=False)
        n = int(self.offs[-1])
        self.places = max(n - window + 1, 0)
        self.h, self.least = np.empty(max(n - part + 1, 0), U64), np.empty(self.places, U64)
        view = np.ndarray((max(n - 7, 0),), dtype="<u8", buffer=self.buf, strides=(1,))
        for a in range(0, len(self.h), _CHUNK):  # chunks whose arrays stay in the processor's cache
            h = _part_hashes(view[a : a + _CHUNK + window], part)
            self.h[a : a + _CHUNK] = h[:_CHUNK]
            least = _slide(h, self.reach, np.minimum)[:_CHUNK]
            self.least[a : a + len(least)] = least[: max(self.places - a, 0)]
        size = np.diff(self.offs)
        long = (size >= window) & real
        step = np.bincount(self.offs[:-1][long], minlength=n + 1) - np.bincount(self.offs[1:][long] - window + 1, minlength=n + 1)
        self.valid = np.cumsum(step[: self.places]).astype(bool)

    def anchors(self) -> np.ndarray:
        """Places whose hash is the least of some window."""
        pad = np.zeros(self.reach - 1, U64)
        least = np.concatenate([pad, np.where(self.valid, self.least, U64(0)), pad])
        out = []
        for a in range(0, len(self.h), _CHUNK):
            h = self.h[a : a + _CHUNK]
            most = _slide(least[a : a + len(h) + self.reach - 1], self.reach, np.maximum)
            out.append(np.flatnonzero((most == h) & (h > 0)) + a)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """First window and number of windows of each run with one least hash."""
        if not self.places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = np.ones(self.places + 1, bool)
        new[1:-1] = (self.least[1:] != self.least[:-1]) | (self.valid[1:] != self.valid[:-1])
        cut = np.flatnonzero(new)
        start, count = cut[:-1], np.diff(cut)
        real = self.valid[start]
        start, count = start[real], count[real]
        pieces = (count + _PIECE - 1) // _PIECE
        if (pieces > 1).any():
            which = np.repeat(np.arange(len(start)), pieces)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start, count = start[which] + nth * _PIECE, np.minimum(count[which] - nth * _PIECE, _PIECE)
        return start, count

    def keys(self, start: np.ndarray, count: np.ndarray, key_bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each context's bytes, made from its parts' hashes."""
        last = start + count + self.reach - 2
        key = tb.mix(count.astype(U64) + U64(0x2545F4914F6CDD1D))
        check = key ^ self.h[last]
        todo, at = np.arange(len(start)), start.copy()
        while len(todo):
            h = self.h[np.minimum(at, last[todo])]
            key[todo] = tb.mix(key[todo] ^ h)
            check[todo] = (check[todo] ^ h) * U64(0x9FB21C651E98DF25)
            check[todo] ^= check[todo] >> U64(28)
            at += self.part
            on = at < last[todo] + self.part
            todo, at = todo[on], at[on]
        return tb.top_bits(key, key_bits), tb.mix(check) >> U64(32)

    def where(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        doc = np.searchsorted(self.offs, start, side="right") - 1
        return self.ids[doc], start - self.offs[doc]


def _runs(block: np.ndarray):
    cut = np.append(np.flatnonzero(tb.group_starts(block)), len(block))
    return [(int(a), int(b)) for a, b in zip(cut[:-1], cut[1:], strict=True) if b > a]


def suffix_order(text: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Ranks of the suffixes of an array of integers >= 1 by at least their first `depth` values.

    A difference cover modulo 3: places 1 and 2 modulo 3 are sampled. Where
    `wanted` (a mask) is given, only those suffixes are merged and ranked.
    """
    n = len(text)
    if n < 3:
        return _tiny(text)
    s = np.zeros(n + 4, U64)
    s[:n] = text
    bits = U64(int(text.max()).bit_length())
    one, two, zero = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([one, two])
    if 3 * int(bits) <= 64:
        triple = (s[sample] << (bits * U64(2))) | (s[sample + 1] << bits) | s[sample + 2]
        order = np.argsort(triple)
        triple = triple[order]
        new = tb.group_starts(triple)
    else:
        order = np.lexsort((s[sample + 2], s[sample + 1], s[sample]))
        new = tb.group_starts(s[sample][order], s[sample + 1][order], s[sample + 2][order])
    name = np.empty(len(sample), np.int64)
    name[order] = np.cumsum(new)
    if depth > 3 and not new.all():
        name = suffix_order(name, math.ceil(depth / 3)) + 1
    rank = np.zeros(n + 4, U64)
    rank[sample] = name
    wide = U64(max(1, int(name.max()).bit_length()))
    if wanted is not None:
        zero, one, two = zero[wanted[zero]], one[one < n], two[wanted[two]]
        one = one[wanted[one]]
        sample = np.concatenate([one, two])
    # what isn't sampled: a value, then a sampled rank
    key0 = (s[zero] << wide) | rank[zero + 1]
    by0 = np.argsort(key0)
    key0 = key0[by0]
    zeros = zero[by0]
    # merge: places 1 modulo 3 compare by a value and a rank, places 2 by two values and a rank
    by1, by2 = one[np.argsort(rank[one])], two[np.argsort(rank[two])]
    key1 = (s[by1] << wide) | rank[by1 + 1]
    place = np.zeros(n + 4, np.int64)
    if 2 * int(bits) + int(wide) <= 64:
        pair = lambda i: (s[i] << (bits + wide)) | (s[i + 1] << wide) | rank[i + 2]
        key02, key2 = pair(zeros), pair(by2)
    else:
        both = np.concatenate([zeros, by2])
        o = np.lexsort((rank[both + 2], s[both + 1], s[both]))
        dense = np.empty(len(both), U64)
        dense[o] = np.cumsum(tb.group_starts(s[both][o], s[both + 1][o], rank[both + 2][o]))
        key02, key2 = dense[: len(zeros)], dense[len(zeros) :]
    own = np.arange(len(zeros))
    place[zeros] = own + np.searchsorted(key1, key0, side="left") + np.searchsorted(key2, key02, side="left")
    all12 = sample[np.argsort(rank[sample])]
    nth = np.empty(n + 4, np.int64)
    nth[all12] = np.arange(len(all12))
    place[by1] = nth[by1] + np.searchsorted(key0, key1, side="right")
    place[by2] = nth[by2] + np.searchsorted(key02, key2, side="right")
    return place[:n]


def _tiny(text: np.ndarray) -> np.ndarray:
    out = np.empty(len(text), np.int64)
    out[sorted(range(len(text)), key=lambda i: text[i:].tolist())] = np.arange(len(text))
    return out


def _again(text: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """Numbers of the windows at `start` whose 64-bit hash other windows have too; no equal one is left out."""
    part = max(8, window // 2)
    view = np.ndarray((len(text) - 7,), dtype="<u8", buffer=text, strides=(1,))
    h = np.empty(len(view) - part + 8, U64)
    for a in range(0, len(h), _CHUNK):
        h[a : a + _CHUNK] = _part_hashes(view[a : a + _CHUNK + part - 8], part)[:_CHUNK]
    key = np.zeros(len(start), U64)
    for k in [*range(0, window - part + 1, part), window - part]:
        key = tb.mix(key ^ h[start + k])
    order = np.argsort(key)
    same = ~tb.group_starts(key[order])
    same[:-1] |= same[1:]
    return np.sort(order[same])


def later_windows(text: np.ndarray, start: np.ndarray, ids: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Of windows at `start` in text (with 8 zero bytes after it), those with an equal one of a smaller (id, at).

    Windows whose hash occurs once can't repeat; only the bytes of the others are sorted.
    """
    late = np.zeros(len(start), bool)
    again = _again(text, start, window)
    if len(again):
        held = tb.covered(start[again], window, len(text) - 8)
        moved = np.cumsum(held) - 1
        late[again] = _later_sorted(np.append(text[:-8][held], np.zeros(8, np.uint8)), moved[start[again]], ids[again], at[again], window)
    return late


def _later_sorted(text: np.ndarray, start: np.ndarray, ids: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    wanted = np.zeros(len(text) - 8, bool)
    wanted[start] = True
    place = suffix_order(text[:-8].astype(np.int64) + 1, window, wanted)
    order = start[np.argsort(place[start])]
    view = np.ndarray((len(text) - 7,), dtype="<u8", buffer=text, strides=(1,))
    same = np.zeros(len(order), bool)
    same[1:] = True
    for k in [*range(0, window - 7, 8), window - 8]:
        todo = np.flatnonzero(same)
        same[todo] = view[order[todo] + k] == view[order[todo - 1] + k]
    group = np.empty(len(text), np.int64)
    group[order] = np.cumsum(~same)
    group = group[start]
    by = np.lexsort((at, ids, group))
    first = tb.group_starts(group[by])
    head = np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))
    late = np.empty(len(start), bool)
    late[by] = (ids[by] != ids[by][head]) | (at[by] != at[by][head])
    return late


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 100, part: int = 48, cells: int = 32, hot: int = 4096, key_bits: int = 64) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (bytes).

    Fewer key_bits than 64 make different contexts share keys, which only tests want.
    """
    groups = Groups(docs, id_col, text_col)
    expected = max(groups.bytes / (window - part + 1) * 2, 1)  # anchors
    bits = min(60, max(16, math.ceil(math.log2(expected * cells))))
    anchor_bits = groups.blocks(expected)
    context_bits = groups.blocks(expected / 4)
    sort_bits = groups.blocks(groups.bytes, 2 << 20)

    def cell_of(value):
        return tb.mix(value ^ U64(0x589965CC75374CC3)) >> U64(64 - bits)

    def count(p, docs, _):
        w = Windows(docs, window, part)
        cell, n = np.unique(cell_of(w.h[w.anchors()]), return_counts=True)
        for a, b in _runs(cell >> U64(bits - anchor_bits)):
            yield int(cell[a] >> U64(bits - anchor_bits)), _join(tb.pack_sorted(cell[a:b]), tb.pack(n[a:b]))

    def total(_, senders, payloads):
        parts = [(tb.unpack_sorted(a), tb.unpack(b)) for a, b in map(_split, payloads)]
        cell = np.concatenate([a for a, _ in parts])
        order = np.argsort(cell)
        first = tb.group_starts(cell[order])
        sums = np.add.reduceat(np.concatenate([b for _, b in parts])[order], np.flatnonzero(first))
        n = np.empty(len(cell), U64)
        n[order] = sums[np.cumsum(first) - 1]
        at = 0
        for p, (c, _) in zip(senders, parts, strict=True):
            many = n[at : at + len(c)]
            at += len(c)
            if (many > 1).any():
                yield p, _join(tb.pack_sorted(c[many > 1]), tb.pack(many[many > 1]))

    def contexts(p, docs, back):
        """Sends each distinct context whose anchor has two places or more."""
        w = Windows(docs, window, part)
        start, n = w.contexts()
        if not back or not len(start):
            return
        cells_, sums = (np.concatenate(x) for x in zip(*((tb.unpack_sorted(a), tb.unpack(b)) for a, b in (_split(back[k]) for k in sorted(back))), strict=True))
        cell = cell_of(w.least[start])
        i = np.minimum(np.searchsorted(cells_, cell), len(cells_) - 1)
        keep = cells_[i] == cell
        start, n, places = start[keep], n[keep], sums[i[keep]]
        if not len(start):
            return
        anchors = w.anchors()
        lo, hi = np.searchsorted(anchors, start), np.searchsorted(anchors, start + n + w.reach - 1)
        which = np.repeat(np.arange(len(start)), hi - lo)
        each = np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[which]
        own = np.bincount(which[w.h[anchors[each]] == w.least[start[which]]], minlength=len(start))
        key, check = w.keys(start, n, key_bits)
        ids, at = w.where(start)
        order = np.lexsort((at, ids, check, key))
        first = np.flatnonzero(tb.group_starts(key[order], check[order]))
        times = np.diff(np.append(first, len(order))).astype(U64)
        rows = order[first]
        key, check, ids, at, places, alone = key[rows], check[rows], ids[rows], at[rows], places[rows], (own[rows] < 2)
        for a, b in _runs(key >> U64(64 - context_bits)):
            yield int(key[a] >> U64(64 - context_bits)), _join(tb.pack_sorted(key[a:b]), check[a:b].astype("<u4").tobytes(), tb.pack(ids[a:b].view(U64) ^ _SIGN), tb.pack(at[a:b]), tb.pack(times[a:b]), tb.pack(places[a:b]), np.packbits(alone[a:b]).tobytes())

    def earliest(_, senders, payloads):
        """Replies the contexts that aren't the earliest, and the earliest ones whose anchor has others."""
        cols: list[list] = [[] for _ in range(7)]
        for x in payloads:
            k, c, d, s, t, m, o = _split(x)
            k = tb.unpack_sorted(k)
            for col, v in zip(cols, (k, np.frombuffer(c, "<u4").astype(U64), tb.unpack(d), tb.unpack(s), tb.unpack(t), tb.unpack(m), np.unpackbits(np.frombuffer(o, np.uint8), count=len(k)).astype(bool)), strict=True):
                col.append(v)
        size = [len(k) for k in cols[0]]
        k, c, d, s, t, m, alone = map(np.concatenate, cols)
        order = np.lexsort((s, d, c, k))
        first = tb.group_starts(k[order], c[order])
        heads, of = np.flatnonzero(first), np.cumsum(first) - 1
        later, copies = np.empty(len(k), bool), np.empty(len(k), U64)
        later[order] = (d[order] != d[order][heads][of]) | (s[order] != s[order][heads][of])
        copies[order] = np.add.reduceat(t[order], heads)[of]
        need = ~later & ((m > copies) | ~alone)
        at = 0
        for p, n in zip(senders, size, strict=True):
            own = np.arange(at, at + n)
            at += n
            x, y = own[later[own]], own[need[own]]
            if len(x) or len(y):
                yield p, _join(tb.pack_sorted(k[x]), c[x].astype("<u4").tobytes(), tb.pack_sorted(k[y]), c[y].astype("<u4").tobytes(), np.packbits(m[y] > hot).tobytes())

    def listed(back, part_):
        """The keys in part_ and part_ + 1 of the replies, which are in order of key."""
        parts = [_split(back[k]) for k in sorted(k for k in back if k >= 0)]
        k = np.concatenate([tb.unpack_sorted(x[part_]) for x in parts]) if parts else np.zeros(0, U64)
        c = np.concatenate([np.frombuffer(x[part_ + 1], "<u4") for x in parts]).astype(U64) if parts else np.zeros(0, U64)
        extra = np.concatenate([np.unpackbits(np.frombuffer(x[4], np.uint8), count=len(x[3]) // 4) for x in parts]).astype(bool) if parts else np.zeros(0, bool)
        return k, c, extra

    def suffixes(p, docs, back):
        """Sends the bytes of the earliest contexts to the block of their anchor."""
        w = Windows(docs, window, part)
        start, n = w.contexts()
        k, c, busy = listed(back, 2)
        if not len(k) or not len(start):
            return
        key, check = w.keys(start, n, key_bits)
        at = tb.located(k, c, key, check)
        pick = np.flatnonzero(at >= 0)
        # of each context, the earliest place of the group; more only where rows share doc_id and place
        ids, off = w.where(start[pick])
        order = np.lexsort((off, ids, at[pick]))
        head = np.maximum.accumulate(np.where(tb.group_starts(at[pick][order]), np.arange(len(order)), 0))
        pick = pick[order[(ids[order] == ids[order][head]) & (off[order] == off[order][head])]]
        start, n, spread = start[pick], n[pick], busy[at[pick]]
        route = tb.mix(w.least[start] ^ U64(0x1D8E4E27C47D124F))
        if spread.any():
            s, m = start[spread], n[spread]
            each = np.repeat(s, m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            start, n = np.concatenate([start[~spread], each]), np.concatenate([n[~spread], np.ones(len(each), n.dtype)])
            route = np.concatenate([route[~spread], tb.hash_spans(w.buf, each, each + window, 7)])
        block = route >> U64(64 - sort_bits)
        ids, off = w.where(start)
        row = np.searchsorted(w.offs, start, side="right") - 1
        order = np.lexsort((off, row, block))
        raw = w.buf.tobytes()
        for a, b in _runs(block[order]):
            o = order[a:b]
            text = b"".join(raw[i:j] for i, j in zip(start[o].tolist(), (start[o] + n[o] + window - 1).tolist(), strict=True))
            yield int(block[o[0]]), _join(tb.pack(n[o]), tb.pack(ids[o].view(U64) ^ _SIGN), tb.pack(off[o]), tb.pack(row[o]), tb.zstandard.ZstdCompressor(level=1).compress(text))

    def sort(_, senders, payloads):
        counts, ids, offs, rows, texts = [], [], [], [], []
        for x in payloads:
            a, b, c, r, d = _split(x)
            counts.append(tb.unpack(a).astype(np.int64))
            ids.append(tb.unpack(b))
            offs.append(tb.unpack(c))
            rows.append(r)
            texts.append(tb.zstandard.ZstdDecompressor().decompress(d))
        n, d, s = np.concatenate(counts), np.concatenate(ids), np.concatenate(offs)
        size = n + window - 1
        base = np.cumsum(size) - size
        which = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        text = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
        late = later_windows(text, base[which] + nth, d[which], s[which] + nth.astype(U64), window)
        edge = np.cumsum(n) - n
        at = 0
        for p, m, r in zip(senders, map(len, counts), rows, strict=True):
            own = np.arange(at, at + m)
            at += m
            lo, hi = int(edge[own[0]]), int(edge[own[-1]] + n[own[-1]])
            if late[lo:hi].any():
                yield p, _join(tb.pack(n[own]), r, tb.pack(s[own]), np.packbits(late[lo:hi]).tobytes())

    def remove(p, docs, back):
        w = Windows(docs, window, part)
        start, n = w.contexts()
        gone = np.zeros(w.places, bool)
        if len(start):
            key, check = w.keys(start, n, key_bits)
            k, c, _ = listed(back, 0)
            whole = tb.located(k, c, key, check) >= 0
            # a context whose group holds an earlier one goes too
            order = tb.by_key(key, check)
            again = ~tb.group_starts(key[order])
            again[:-1] |= again[1:]
            order = order[again]
            ids, off = w.where(start[order])
            by = np.lexsort((off, ids, check[order], key[order]))
            order, ids, off = order[by], ids[by], off[by]
            head = np.maximum.accumulate(np.where(tb.group_starts(key[order], check[order]), np.arange(len(order)), 0))
            whole[order] |= (ids != ids[head]) | (off != off[head])
            step = np.bincount(start[whole], minlength=w.places + 1) - np.bincount((start + n)[whole], minlength=w.places + 1)
            gone |= np.cumsum(step[:-1]) > 0
        for b in (b for b in back if b < 0):
            m, row, s, late = _split(back[b])
            m, row, s = tb.unpack(m).astype(np.int64), tb.unpack(row).astype(np.int64), tb.unpack(s).astype(np.int64)
            late = np.unpackbits(np.frombuffer(late, np.uint8), count=int(m.sum())).astype(bool)
            first = w.offs[row] + s
            gone[(np.repeat(first - (np.cumsum(m) - m), m) + np.arange(len(late)))[late]] = True
        for i in np.flatnonzero((np.diff(w.offs) >= window) & ~docs["doc_id"].is_valid().to_numpy(zero_copy_only=False)).tolist():
            text = np.append(w.buf[w.offs[i] : w.offs[i + 1]], np.zeros(8, np.uint8))
            at = np.arange(len(text) - 7 - window)
            gone[w.offs[i] + at] = later_windows(text, at, np.zeros_like(at), at, window)
        lost = tb.covered(np.flatnonzero(gone), window, int(w.offs[-1]))
        return _kept(docs, w, lost)

    counted = answer(groups.send(count), total)
    judged = answer(groups.send(contexts, counted), earliest)
    sorted_ = answer(groups.send(suffixes, judged), sort)
    back = judged.unionByName(sorted_.selectExpr("p", "-1 - block AS block", "payload"))
    return groups.apply(remove, SCHEMA, back)


def _kept(docs: pa.Table, w: Windows, lost: np.ndarray) -> pa.Table:
    n = len(docs)
    cut = np.zeros(len(lost) + 1, bool)
    cut[w.offs] = True
    before = np.zeros(len(lost), bool)
    before[1:] = lost[:-1]
    heads = np.flatnonzero(lost & (~before | cut[:-1]))
    spans = np.bincount(np.searchsorted(w.offs, heads, side="right") - 1, minlength=n)
    total = np.concatenate([[0], np.cumsum(lost)])
    gone = total[w.offs[1:]] - total[w.offs[:-1]]
    raw, texts = w.buf.tobytes(), []
    for i in range(n):
        a, b = int(w.offs[i]), int(w.offs[i + 1])
        texts.append(w.buf[a:b][~lost[a:b]].tobytes() if gone[i] else raw[a:b])
    return pa.table({"doc_id": docs["doc_id"].cast(pa.int64()), "n_bytes": pa.array(np.diff(w.offs), pa.int64()), "n_removed": pa.array(gone, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept": pa.array(texts, pa.binary())})
