"""Toxicity by compression distance: two zstandard dictionaries and calibrated thresholds.

Two dictionaries are trained by zstandard's own trainer: one on windows of ordinary
text, one on passages of toxic text, namely the words that stand in significantly more different
contexts there than in ordinary text (copies of a document add no new contexts),
each with its neighbours. A window of `window` words is compressed with the
ordinary dictionary, and with the toxic one put before it (toxic texts are
made of ordinary words too); the bytes that the toxic one saves are its gain.

The thresholds are calibrated: whole bytes of gain, from one on and each another,
that a share of SHARES of ordinary windows stays below, among texts that the
dictionaries were not trained on (two folds).
Per document, counts of windows over each threshold, the largest and the mean
gain and the number of windows go into a logistic calibration, fitted on the same texts.

The fit reads at most `toxic_rows` and `ordinary_rows` labelled texts of at most
`text_bytes` bytes, those with the least MD5 of their id, one text an id; everything
else reads all data, where it lies, without a shuffle. Scores use the text alone.

Defined cases: null and empty texts have no windows and get the calibrated score
of that; rows without a usable label don't train; a document labelled both ways
trains as toxic; where one class is missing every score is its base rate;
repeated rows and rows with a null id each get a score; texts of any length are
scored whole, window by window; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .rounds import numbered

U64 = np.uint64
SCHEMA = "doc_id long, score double, n_windows long, top_gain long"
#: Shares of ordinary windows below each threshold of gain.
SHARES = (0.9, 0.97, 0.99, 0.997, 0.999)
_PARAMETERS = dict(window_log=17, chain_log=17, hash_log=17, search_log=6, min_match=4, target_length=64, strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _parts(column: pa.Array, limit: int = 1 << 20):
    batch = pa.RecordBatch.from_arrays([column], ["t"])
    for x in tb.slices(batch, "t", limit):
        yield x["t"]


def _contexts(texts: list[bytes]) -> tuple[Counter, int]:
    """In how many different contexts each word stands, and how many contexts there are."""
    seen, token, known = np.zeros(0, U64), np.zeros(0, U64), {}
    for part in _parts(pa.array(texts, pa.binary())):
        buf, offs = tb.column_bytes(part)
        starts, ends, doc = tb.words(buf, offs)
        own = tb.hash_spans(buf, starts, ends)
        around = np.zeros((2, len(own)), U64)
        same = doc[1:] == doc[:-1]
        around[0, 1:][same], around[1, :-1][same] = own[:-1][same], own[1:][same]
        context = tb.mix(tb.mix(around[0] + U64(1)) ^ own) ^ (around[1] * U64(0x9E3779B97F4A7C15))
        # each part's own distinct contexts first, so that the arrays that grow are joined once a part and no larger than need be
        context, at = np.unique(context, return_index=True)
        new = ~np.isin(context, seen, assume_unique=True)
        seen, token = np.concatenate([seen, context[new]]), np.concatenate([token, own[at[new]]])
        value, first = np.unique(own, return_index=True)
        raw = buf.tobytes()
        for h, i in zip(value.tolist(), first.tolist(), strict=True):
            if h not in known:
                known[h] = raw[starts[i] : ends[i]]
    return Counter({known[h]: n for h, n in zip(*(x.tolist() for x in np.unique(token, return_counts=True)), strict=True)}), len(seen)


def telling_words(toxic: list[bytes], ordinary: list[bytes], least_z: float = 5.0) -> set[bytes]:
    """Words of at least 3 contexts in toxic text, there ten times as frequent as in ordinary text or more, by `least_z` deviations."""
    a, na = _contexts(toxic)
    b, nb = _contexts(ordinary)
    share, out = na / max(1, na + nb), set()
    for w, n in a.items():
        both = n + b[w]
        z = (n - both * share) / max(1e-9, np.sqrt(both * share * (1 - share)))
        if n >= 3 and z > least_z and 10 * b[w] * na <= n * nb:
            out.add(w)
    return out


def _passages(texts: list[bytes], pick) -> list[bytes]:
    """Each picked word with the one before and the one after."""
    out = []
    for text in texts:
        words = text.split()
        out += [b" " + b" ".join(words[max(0, i - 1) : i + 2]) + b" " for i, w in enumerate(words) if pick(w)]
    return out


def _cut(texts: list[bytes], window: int) -> list[bytes]:
    return [b" ".join(words[i : i + window]) for words in map(bytes.split, texts) for i in range(0, len(words), window)]


def _train(samples: list[bytes], size: int) -> bytes:
    """The content of a trained dictionary; where there is too little to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=16, d=6).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes], window: int = 16, size: int = 2048, common: int = 110 << 10, samples: int = 60_000) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary contents."""
    rng = np.random.default_rng(5)
    some = lambda x: [x[i] for i in rng.permutation(len(x))[:samples].tolist()]
    telling = telling_words(toxic, ordinary)
    rude = some(_passages(toxic, telling.__contains__))
    tb.release()  # the driver's memory is bounded too
    base, own = _train(some(_cut(ordinary, window)), common), _train(rude, size)
    tb.release()
    # bytes that UTF-8 never has, so that the ordinary content is equally far away in both
    return b"\xff" * len(own) + base, own + base


class Gains:
    """Bytes of each window saved by the toxic dictionary."""

    def __init__(self, base: bytes, toxic: bytes, window: int):
        self.window = window
        self.packers = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=zstandard.ZstdCompressionParameters(**_PARAMETERS)) for x in (base, toxic)]

    def __call__(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(gain, text number) of each window; windows tile the whole of each text."""
        buf = tb.LOWER[buf]
        starts, ends, doc = tb.words(buf, offs)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        edge = np.searchsorted(doc, np.arange(len(offs)))
        nth = np.arange(len(starts)) - edge[doc]
        heads = np.flatnonzero(nth % self.window == 0)
        a, b = starts[heads], ends[np.append(heads[1:], len(starts)) - 1]
        segments = zstandard.BufferWithSegments(buf.tobytes(), np.stack([a, b - a], 1).astype("<u8").tobytes())
        size = [np.fromiter(map(len, p.multi_compress_to_buffer(segments)), np.int64, len(a)) for p in self.packers]
        return size[0] - size[1], doc[heads]


def features(gain: np.ndarray, doc: np.ndarray, n: int, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: the calibration's inputs, the number of windows, the largest gain."""
    windows = np.bincount(doc, minlength=n)
    top = np.full(n, -20)
    np.maximum.at(top, doc, gain)
    mean = np.bincount(doc, weights=gain, minlength=n) / np.maximum(windows, 1)
    counts = [np.bincount(doc[gain >= c], minlength=n) for c in cuts]
    cols = [np.log1p(c) for c in counts] + [np.sqrt(c / np.maximum(windows, 1)) for c in counts] + [np.where(windows > 0, np.clip(top, -20, 20), 0), mean, np.log1p(windows)]
    return np.stack(cols, 1), windows, np.where(windows > 0, top, 0)


@dataclass
class Model:
    base: bytes = b""
    toxic: bytes = b""
    window: int = 16
    rate: float = 0.0
    cuts: np.ndarray = field(default_factory=lambda: np.ones(len(SHARES)))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), self.rate)
        z = np.column_stack([np.ones(len(x)), (x - self.centre) / self.scale]) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_texts(texts: list[str], toxic: list[int], window: int = 16) -> Model:
    """A model of labelled texts."""
    y = np.array(toxic, float)
    if not len(y) or y.min() == y.max():
        return Model(window=window, rate=float(y.mean()) if len(y) else 0.0)
    column = pa.array(texts, pa.string())
    low = [tb.LOWER[np.frombuffer(t.encode(), np.uint8)].tobytes() for t in texts]
    fold = np.zeros(len(y), int)
    for c in (0, 1):  # each class dealt evenly
        own = np.flatnonzero(y == c)
        fold[own] = np.arange(len(own)) % 2
    found = []
    for k in (0, 1):
        own, other = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        gains = Gains(*train_dictionaries([low[i] for i in other if y[i]], [low[i] for i in other if not y[i]], window), window)
        at = 0
        for x in _parts(column.take(pa.array(own))):
            gain, doc = gains(*tb.column_bytes(x))
            found.append((own[at : at + len(x)], gain, doc))
            at += len(x)
    plain = np.concatenate([gain[y[own][doc] == 0] for own, gain, doc in found])
    cuts = np.ceil(np.quantile(plain, SHARES)) if len(plain) else np.ones(len(SHARES))
    # at least a byte, and each a byte above the one before
    cuts = np.maximum.accumulate(np.maximum(cuts, 1) - np.arange(len(cuts))) + np.arange(len(cuts))
    rows = np.zeros((len(y), 2 * len(SHARES) + 3))
    for own, gain, doc in found:
        rows[own] = features(gain, doc, len(own), cuts)[0]
    base, tox = train_dictionaries([t for t, v in zip(low, y, strict=True) if v], [t for t, v in zip(low, y, strict=True) if not v], window)
    centre, scale = rows.mean(0), np.maximum(rows.std(0), 1e-6)
    return Model(base, tox, window, float(y.mean()), cuts, centre, scale, _logistic(np.column_stack([np.ones(len(y)), (rows - centre) / scale]), y))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", label_id_col: str = "doc_id", toxic_rows: int = 2000, ordinary_rows: int = 6000, window: int = 16, text_bytes: int = 1 << 16) -> Model:
    """Fits on a bounded sample of labelled rows that aren't held out."""
    marks, i, c = numbered(labels, label_id_col, label_col)
    ids = marks.select(marks[i].cast("long").alias("label_id"), marks[c].cast("int").alias("label")).where("label_id IS NOT NULL AND label IN (0, 1)")
    ids = ids.where(~held_out(F.col("label_id"))).groupBy("label_id").agg(F.max("label").alias("label"))
    order = F.md5(F.col("label_id").cast("string"))
    picked = [ids.where(F.col("label") == c).orderBy(order, "label_id").limit(n) for c, n in ((1, toxic_rows), (0, ordinary_rows))]
    # at most toxic_rows + ordinary_rows pairs of integers
    picked = F.broadcast(picked[0].unionByName(picked[1]))
    rows, i, t = numbered(docs, id_col, text_col)
    texts = rows.select(rows[i].cast("long").alias("id"), rows[t].cast("string").alias("t")).where(F.col("t").isNotNull() & (F.octet_length("t") <= text_bytes))
    # one text an id, so no more bytes come than that many texts of text_bytes
    rows = texts.join(picked, F.col("id") == F.col("label_id")).groupBy("id").agg(F.min("t").alias("t"), F.max("label").alias("label")).toArrow().sort_by("id")
    texts, marks = rows["t"].to_pylist(), rows["label"].to_pylist()
    del rows
    tb.release()
    return fit_texts(texts, marks, window)


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, score (0 to 1), n_windows, top_gain (bytes)."""

    def run(batches):
        gains = Gains(model.base or b"the", model.toxic or b"the", model.window)
        for whole in batches:
            for batch in tb.slices(whole, "text"):
                x, windows, top = features(*gains(*tb.column_bytes(batch["text"])), batch.num_rows, model.cuts)
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.score(x), pa.float64()), pa.array(windows, pa.int64()), pa.array(top, pa.int64())], ["doc_id", "score", "n_windows", "top_gain"])

    rows, i, t = numbered(docs, id_col, text_col)
    return rows.select(rows[i].cast("long").alias("doc_id"), rows[t].cast("string").alias("text")).mapInArrow(run, SCHEMA)
