"""Line dedup: runs of lines that an earlier place already has are removed.

A document is the sequence of its lines that have a word, without the white
space at their ends. Of each `run` consecutive line hashes the least is a
fingerprint (winnowing with a guarantee of `run` lines: two places that share so
many lines share a fingerprint at the same distance from their beginnings).

1. Groups send each distinct fingerprint once, with its number of places; those
   with one place in all go no further.
2. Every other fingerprint's places are joined in its block: each comes with its
   doc_id, line number and the hashes of the lines around it, places with the
   same surroundings once a group. The match is extended both ways from the
   fingerprint, so and so many lines to the left and the rest to the right, until it is
   `run` lines long; of the places that still agree line by line, all but the
   earliest start a repeat.
3. Overlapping repeats make up the maximal repeated runs, and those lines go.

A fingerprint with more than `hot` places is not joined in one block: there the
groups extend the match themselves, and each stretch of `run` lines goes to a
block by its own 96-bit key, so a line that fills a third of the corpus is spread by what
stands beside it. With `words` given, one to `run` - 1 lines in a row that have
more words than that are matched too, each such stretch being its own
fingerprint, in the same way.

Places are ordered by (doc_id, line); no pairs of places are formed.

Defined cases: null text gives no lines and an empty text; blank lines are never
removed and don't part runs; texts with fewer than `run` lines keep all but
stretches of more than `words` words; rows that share
a doc_id are compared by (doc_id, line) too; a row with a null doc_id neither
removes nor loses lines; every input row gives one row; a text is taken whole, however
long; bytes that aren't UTF-8 stay; other columns are ignored, or come along
unchanged, whatever their names, in line_dedup_rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textbytes as tb
from .rounds import Groups, answer
from .substring_dedup import _split
from .suffix_dedup import _join, _runs, _slide

SCHEMA = "doc_id long, n_lines long, n_removed long, n_runs long, kept_text string"
U64 = np.uint64
_SIGN = U64(1 << 63)


class Lines:
    """Lines of a group's texts, their hashes, and the stretches of `run` lines, or fewer with more than `words` words."""

    def __init__(self, docs: pa.Table, run: int, words: int | None = None, key_bits: int = 64):
        self.run, self.key_bits = run, key_bits
        self.buf, self.offs = tb.column_bytes(docs["text"])
        starts, ends, doc = tb.words(self.buf, self.offs)
        feeds = np.flatnonzero(self.buf[: self.offs[-1]] == 10)
        number = np.searchsorted(feeds, starts)
        first = tb.group_starts(doc, number)
        self.start, self.doc, self.number = starts[first], doc[first], number[first]
        last = np.append(first[1:], True)[: len(first)]
        self.hash = tb.hash_spans(self.buf, self.start, ends[last])
        # the number of the line in its text, over all lines and over those with words
        self.nth = self.number - np.searchsorted(feeds, self.offs)[self.doc]
        self.edge = np.searchsorted(self.doc, np.arange(len(self.offs)))
        self.ids = docs["doc_id"].fill_null(0).to_numpy()
        real = docs["doc_id"].is_valid().to_numpy(zero_copy_only=False)
        n = max(len(self.hash) - run + 1, 0)
        self.valid = (self.doc[:n] == self.doc[run - 1 :][:n]) & real[self.doc[:n]]
        self.least = _slide(self.hash, run, np.minimum)[:n]
        # first lines of the long stretches of each smaller number of lines
        self.long = []
        if words is not None:
            total = np.append(np.flatnonzero(first), len(first))
            for width in range(1, run):
                n = max(len(self.hash) - width + 1, 0)
                many = total[width:][:n] - total[:n] > words
                self.long.append((width, np.flatnonzero(many & (self.doc[:n] == self.doc[width - 1 :][:n]) & real[self.doc[:n]])))

    def fingerprints(self) -> np.ndarray:
        pad = np.zeros(self.run - 1, U64)
        most = _slide(np.concatenate([pad, np.where(self.valid, self.least, U64(0)), pad]), self.run, np.maximum)[: len(self.hash)]
        return np.concatenate([self.hash[most == self.hash], *[tb.window_hashes(self.hash, width, 1)[at] for width, at in self.long]])

    def stretches(self):
        """First line, number of lines, fingerprint, key, check, doc_id and line of each stretch of one text."""
        parts = []
        for width, at in [(self.run, np.flatnonzero(self.valid)), *self.long]:
            key = tb.window_hashes(self.hash, width, 1)[at]
            check = tb.window_hashes(self.hash, width, 2)[at] >> U64(32)
            parts.append((at, np.full(len(at), width), self.least[at] if width == self.run else key, tb.top_bits(key, self.key_bits), check))
        at, width, mark, key, check = (np.concatenate(x) for x in zip(*parts, strict=True))
        return at, width, mark, key, check, self.ids[self.doc[at]], at - self.edge[self.doc[at]]

    def places(self, known: np.ndarray):
        """Lines whose hash is one of `known`, the distinct (hash, surroundings) among them, and which each line has.

        Surroundings are the hashes of run - 1 lines to the left, nearest first, and to the right; 0 beyond the text.
        """
        real = np.zeros(len(self.hash), bool)
        if len(self.valid):
            real[tb.covered(np.flatnonzero(self.valid), self.run, len(real))] = True
        at = np.flatnonzero(real & _among(known, self.hash))
        cols = [self.hash[at]]
        for step in [*range(-1, -self.run, -1), *range(1, self.run)]:
            i = np.clip(at + step, 0, max(len(self.hash) - 1, 0))
            cols.append(np.where((at + step == i) & (self.doc[i] == self.doc[at]), self.hash[i], U64(0)))
        order = np.lexsort((at, *cols[::-1]))
        first = tb.group_starts(*[c[order] for c in cols])
        which = np.empty(len(at), np.int64)
        which[order] = np.cumsum(first) - 1
        heads = order[first]
        return at, which, at[heads], [c[heads] for c in cols]


def _among(known: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _known(back: dict) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints with two places or more, and those with more than `hot`."""
    parts = [_split(back[k]) for k in sorted(k for k in back if k >= 0)]
    if not parts:
        return np.zeros(0, U64), np.zeros(0, U64)
    value = [tb.unpack_sorted(v) for v, _ in parts]
    busy = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(v)) for v, (_, b) in zip(value, parts, strict=True)]).astype(bool)
    value = np.concatenate(value)
    return value, value[busy]


def _later(order: np.ndarray, first: np.ndarray, d: np.ndarray, s: np.ndarray) -> np.ndarray:
    """True for each row that isn't at the place of the first of its group; rows in order are sorted by place in groups."""
    head = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    out = np.empty(len(order), bool)
    out[order] = (d[order] != d[order][head]) | (s[order] != s[order][head])
    return out


def _rounds(groups: Groups, run: int, words: int | None, hot: int, key_bits: int) -> DataFrame:
    """Replies to each group: repeated fingerprints, and which of its places and stretches are not the earliest (blocks below 0)."""
    expected = max(groups.bytes / 64, 1)
    bits = groups.blocks(expected)

    def fingerprints(p, docs, _):
        value, n = np.unique(Lines(docs, run, words).fingerprints(), return_counts=True)
        for a, b in _runs(value >> U64(64 - bits)):
            yield int(value[a] >> U64(64 - bits)), _join(tb.pack_sorted(value[a:b]), tb.pack(np.minimum(n[a:b], hot + 1)))

    def join(_, senders, payloads):
        parts = []
        for x in payloads:
            v, many = _split(x)
            parts.append((tb.unpack_sorted(v), tb.unpack(many).astype(np.int64)))
        value = np.concatenate([v for v, _ in parts])
        order = np.argsort(value)
        first = tb.group_starts(value[order])
        total = np.empty(len(value), np.int64)
        total[order] = np.add.reduceat(np.concatenate([n for _, n in parts])[order], np.flatnonzero(first))[np.cumsum(first) - 1]
        at = 0
        for p, (v, _) in zip(senders, parts, strict=True):
            own = total[at : at + len(v)]
            at += len(v)
            if (own > 1).any():
                yield p, _join(tb.pack_sorted(v[own > 1]), np.packbits(own[own > 1] > hot).tobytes())

    def extend(p, docs, back):
        known, busy = _known(back)
        if not len(known):
            return
        lines = Lines(docs, run, words, key_bits)
        _, _, heads, cols = lines.places(np.setdiff1d(known, busy))
        ids, nth = lines.ids[lines.doc[heads]], heads - lines.edge[lines.doc[heads]]
        for a, b in _runs(cols[0] >> U64(64 - bits)):
            around = np.stack([c[a:b] for c in cols[1:]]).astype("<u8")
            yield int(cols[0][a] >> U64(64 - bits)), _join(tb.pack_sorted(cols[0][a:b]), tb.zstandard.ZstdCompressor(level=1).compress(around.tobytes()), tb.pack(ids[a:b].view(U64) ^ _SIGN), tb.pack(nth[a:b]))
        _, width, mark, key, check, ids, nth = lines.stretches()
        keep = np.where(width == run, _among(busy, mark), _among(known, mark))
        key, check, ids, nth = key[keep], check[keep], ids[keep], nth[keep]
        order = np.lexsort((nth, ids, check, key))
        rows = order[tb.group_starts(key[order], check[order])]
        key, check, ids, nth = key[rows], check[rows], ids[rows], nth[rows]
        for a, b in _runs(key >> U64(64 - bits)):
            yield (1 << bits) + int(key[a] >> U64(64 - bits)), _join(tb.pack_sorted(key[a:b]), check[a:b].astype("<u4").tobytes(), tb.pack(ids[a:b].view(U64) ^ _SIGN), tb.pack(nth[a:b]))

    def earliest(block, senders, payloads):
        cols: list[list] = [[], [], [], []]
        for x in payloads:
            k, c, d, s = _split(x)
            k = tb.unpack_sorted(k)
            c = np.frombuffer(tb.zstandard.ZstdDecompressor().decompress(c), "<u8").reshape(-1, len(k)).T if block < 1 << bits else np.frombuffer(c, "<u4")
            for col, v in zip(cols, (k, c, tb.unpack(d), tb.unpack(s)), strict=True):
                col.append(v)
        size = [len(k) for k in cols[0]]
        k, c, d, s = map(np.concatenate, cols)
        if block < 1 << bits:
            # the match around a fingerprint, extended by `left` lines to the left and the rest to the right
            later = np.zeros((len(k), run), bool)
            for left in range(run):
                own = [k, *[c[:, x] for x in [*range(left), *range(run - 1, 2 * run - 2 - left)]]]
                order = np.lexsort((s, d, *own[::-1]))
                full = np.logical_and.reduce([x != 0 for x in own[1:]]) if run > 1 else np.ones(len(k), bool)
                later[:, left] = _later(order, tb.group_starts(*[x[order] for x in own]), d, s) & full
        else:
            order = np.lexsort((s, d, c, k))
            later = _later(order, tb.group_starts(k[order], c[order]), d, s)
        at = 0
        for p, n in zip(senders, size, strict=True):
            own = later[at : at + n]
            if own.any():
                if block < 1 << bits:
                    yield p, _join(np.packbits(own).tobytes(), n.to_bytes(8, "little"))
                else:
                    own = np.flatnonzero(own) + at
                    yield p, _join(tb.pack_sorted(k[own]), c[own].tobytes())
            at += n

    joined = answer(groups.send(fingerprints), join)
    extended = answer(groups.send(extend, joined), earliest)
    return joined.unionByName(extended.selectExpr("p", "-1 - block AS block", "payload"))


def _repeated(lines: Lines, back: dict, bits: int) -> np.ndarray:
    """True for each line in a stretch that starts earlier too."""
    at, width, _, key, check, ids, nth = lines.stretches()
    order = np.lexsort((nth, ids, check, key))
    gone = _later(order, tb.group_starts(key[order], check[order]), ids, nth)
    told = {-1 - b: x for b, x in back.items() if b < 0}
    far = sorted(b for b in told if b >= 1 << bits)
    if far:
        k, c = (np.concatenate(x) for x in zip(*((tb.unpack_sorted(a), np.frombuffer(b, "<u4")) for a, b in (_split(told[n]) for n in far)), strict=True))
        gone |= tb.located(k, c, key, check) >= 0
    lost = np.zeros(len(lines.hash), bool)
    for n in np.unique(width[gone]).tolist():
        lost |= tb.covered(at[gone & (width == n)], n, len(lost))
    if len(far) < len(told):
        known, busy = _known(back)
        places, which, _, cols = lines.places(np.setdiff1d(known, busy))
        later = np.zeros((len(cols[0]), lines.run), bool)
        for a, b in _runs(cols[0] >> U64(64 - bits)):
            if x := told.get(int(cols[0][a] >> U64(64 - bits))):
                later[a:b] = np.unpackbits(np.frombuffer(_split(x)[0], np.uint8), count=(b - a) * lines.run).reshape(-1, lines.run)
        for left in range(lines.run):
            lost |= tb.covered(places[later[which, left]] - left, lines.run, len(lost))
    return lost


def _remove(docs: pa.Table, back: dict, run: int, words: int | None, key_bits: int, bits: int):
    lines = Lines(docs, run, words, key_bits)
    lost = _repeated(lines, back, bits)
    n = len(lines.offs) - 1
    gone = np.bincount(lines.doc[lost], minlength=n)
    before = np.zeros(len(lost), bool)
    before[1:] = lost[:-1] & (lines.doc[1:] == lines.doc[:-1])
    runs = np.bincount(lines.doc[lost & ~before], minlength=n)
    raw, texts = lines.buf.tobytes(), []
    for i in range(n):
        text = raw[lines.offs[i] : lines.offs[i + 1]]
        if gone[i]:
            a, b = lines.edge[i], lines.edge[i + 1]
            drop = set(lines.nth[a:b][lost[a:b]].tolist())
            text = b"\n".join(x for k, x in enumerate(text.split(b"\n")) if k not in drop)
        texts.append(text)
    return np.diff(lines.edge), gone, runs, tb.as_text(texts)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 3, words: int | None = None, hot: int = 4096, key_bits: int = 64) -> DataFrame:
    """One row a document: doc_id, n_lines, n_removed, n_runs, kept_text."""
    groups = Groups(docs, id_col, text_col)
    bits = groups.blocks(max(groups.bytes / 64, 1))

    def remove(p, docs, back):
        total, gone, runs, texts = _remove(docs, back, run, words, key_bits, bits)
        return pa.table({"doc_id": docs["doc_id"].cast(pa.int64()), "n_lines": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "n_runs": pa.array(runs, pa.int64()), "kept_text": texts})

    return groups.apply(remove, SCHEMA, _rounds(groups, run, words, hot, key_bits))


def line_dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 3, words: int | None = None, hot: int = 4096, key_bits: int = 64) -> DataFrame:
    """The rows of docs with repeated runs taken out of the text; a row that loses its last word goes."""
    groups = Groups(docs, id_col, text_col, carry=True)
    bits = groups.blocks(max(groups.bytes / 64, 1))
    names = [f"_{i}" for i in range(len(docs.columns))]
    text_at = docs.columns.index(text_col)

    def remove(p, table, back):
        total, gone, _, texts = _remove(table, back, run, words, key_bits, bits)
        cols = [texts if i == text_at else table[c] for i, c in enumerate(names)]
        # a null text stays null
        cols[text_at] = pa.compute.if_else(table["text"].combine_chunks().is_valid(), texts, pa.scalar(None, pa.string()))
        return pa.table(dict(zip(names, cols, strict=True))).filter(pa.array((gone == 0) | (gone < total)))

    schema = ", ".join(f"{n} {docs.schema[i].dataType.simpleString()}" for i, n in enumerate(names))
    out = groups.apply(remove, schema, _rounds(groups, run, words, hot, key_bits))
    return out.toDF(*docs.columns)
