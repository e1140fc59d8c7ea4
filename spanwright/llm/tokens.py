"""Token counts from a table of frequent pre-token lengths, without a shuffle of pre-tokens.

Tier one: a table of at most `table_size` frequent pre-tokens and their numbers of
tokens is broadcast. They are taken from a random sample of about `sample_rows`
documents of at most `sample_bytes` bytes each, which the driver counts. Tier two: a
pre-token that misses is encoded by the library once and kept in the worker's
cache, which is emptied when it holds `cache_size` entries. The table only saves
time; counts don't depend on it, and every text is counted whole.

A pre-token is a maximal piece that the tokenizer's own pattern cuts out, so the
lengths of a text's pieces sum to its length. That holds for texts made of
characters on which the library's normaliser agrees with Python's lower();
any other text, and one that holds a special token's string, goes to the library
whole.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows each
count; a text of any length is one string of its task, and batches are cut to
about 4 MB; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .rounds import numbered

SCHEMA = "doc_id long, n_bytes long, n_tokens long"
#: The pre-token pattern of the tokenizer file this module counts for (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters whose normal form and lower case are single characters that Python and the library agree on:
#: ASCII, and the Latin-1 letters with their signs, but for controls and U+00A0.
_PLAIN = regex.compile(r"[\x09-\x0D\x20-\x7E¡-ÿ]*")
_PIECES = regex.compile(PATTERN)


class PieceCounter:
    """Counts tokens of texts with one tokenizer file."""

    def __init__(self, path: str, table: dict[str, int] | None = None, cache_size: int = 1 << 18):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.table, self.cache, self.cache_size = table or {}, {}, cache_size

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def pieces(self, text: str) -> list[str] | None:
        """The pre-tokens, or None where only the library can say."""
        if not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return None
        return _PIECES.findall(text.lower())

    def __call__(self, text: str) -> int:
        own = self.pieces(text)
        if own is None:
            return self.whole(text)
        known, cache, n = self.table, self.cache, 0
        for piece, times in Counter(own).items():
            size = known.get(piece)
            if size is None:
                size = cache.get(piece)
                if size is None:
                    if len(cache) >= self.cache_size:
                        cache.clear()
                    size = cache[piece] = self.whole(piece)
            n += size * times
        return n


def frequent_pieces(docs: DataFrame, path: str, text_col: str = "text", table_size: int = 1 << 15, sample_rows: int = 2000, sample_bytes: int = 1 << 15) -> dict[str, int]:
    """Pre-token -> number of tokens, for the most frequent pre-tokens of a sample of documents."""
    rows, t = numbered(docs, text_col)
    share = min(1.0, sample_rows / max(1, rows.count()))
    # some sample_rows rows, of sample_rows * sample_bytes bytes at most
    sample = rows.select(rows[t].cast("string").alias("text")).sample(share, 7).where(F.octet_length("text") <= sample_bytes)
    counter, own = PieceCounter(path), Counter()
    for row in sample.toLocalIterator():
        own.update(counter.pieces(row["text"]) or ())
    return {piece: counter.whole(piece) for piece, _ in own.most_common(table_size)}


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", table_size: int = 1 << 15, cache_size: int = 1 << 18) -> DataFrame:
    """One row a document: doc_id, n_bytes (UTF-8), n_tokens as the tokenizer file gives them."""
    known = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, path, text_col, table_size))

    def run(batches):
        counter = PieceCounter(path, known.value, cache_size)
        for whole in batches:
            for batch in tb.slices(whole, "text"):
                texts = batch["text"].to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()), pa.array([counter(t) if t else 0 for t in texts], pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
                )

    rows, i, t = numbered(docs, id_col, text_col)
    return rows.select(rows[i].cast("long").alias("doc_id"), rows[t].cast("string").alias("text")).mapInArrow(run, SCHEMA)
