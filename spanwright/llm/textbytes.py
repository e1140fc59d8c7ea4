"""NumPy kernels over Arrow string columns: words, word hashes, packed integers.

A batch of texts is one byte buffer plus offsets; every kernel works on the
whole buffer at once, so cost is a few vector passes a byte and memory is a
small multiple of the batch.
"""

from __future__ import annotations

import ctypes
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

U64 = np.uint64
_MASK64 = (1 << 64) - 1
_GOLD = 0x9E3779B97F4A7C15
_MIX = U64(0xD6E8FEB86659FD93)
_S32 = U64(32)
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [_MASK64], dtype=U64)

#: ASCII white space: space, tab, LF, VT, FF, CR.
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, 8 zero bytes after them, and n+1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "").cast(pa.large_binary())
    n = len(column)
    if not n:
        return np.zeros(8, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    size = int(offs[-1] - offs[0])
    buf = np.zeros(size + 8, np.uint8)
    if size:
        buf[:size] = np.frombuffer(column.buffers()[2], np.uint8, size, int(offs[0]))
    return buf, offs - offs[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> _S32)) * _MIX
    x = (x ^ (x >> _S32)) * _MIX
    return x ^ (x >> _S32)


def words(buf: np.ndarray, offs: np.ndarray, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of bytes that aren't white; runs end where a text ends."""
    n = int(offs[-1])
    inside = ~white[buf[:n]]
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 1) -> np.ndarray:
    """A 64-bit hash of each byte span, 8 bytes a step."""
    view = np.ndarray((max(len(buf) - 7, 0),), dtype="<u8", buffer=buf, strides=(1,))
    length = ends - starts
    out = mix(length.astype(U64) + U64((salt * _GOLD) & _MASK64))
    todo, at = np.flatnonzero(length > 0), 0
    while len(todo):
        part = view[starts[todo] + at] & _TAIL[np.minimum(length[todo] - at, 8)]
        out[todo] = mix(out[todo] ^ part) + U64(at + 1)
        at += 8
        todo = todo[length[todo] > at]
    return mix(out)


def window_hashes(tokens: np.ndarray, width: int, salt: int) -> np.ndarray:
    """A hash of each run of `width` tokens; runs that cross texts are for the caller to drop."""
    n = max(len(tokens) - width + 1, 0)
    out = np.full(n, (salt * _GOLD + 1) & _MASK64, U64)
    for k in range(width):
        out += tokens[k : k + n] * U64(((2 * k + 3 + 2 * 64 * salt) * _GOLD | 1) & _MASK64)
    return mix(out)


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, compressed; unpack() gives them back."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """pack() of the gaps of an ascending array."""
    gaps = np.empty(len(values), U64)
    gaps[:1] = values[:1]
    np.subtract(values[1:], values[:-1], out=gaps[1:])
    return pack(gaps)


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=U64)


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """True for each place in [s, s + width) of any start s."""
    step = np.bincount(starts, minlength=size + 1)
    step -= np.bincount(np.minimum(starts + width, size), minlength=size + 1)
    return np.cumsum(step[:-1]) > 0


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """True where a row of sorted keys differs from the one before."""
    first = np.ones(len(keys[0]), bool)
    if len(first):
        first[1:] = False
        for k in keys:
            first[1:] |= k[1:] != k[:-1]
    return first


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """The batch in pieces of about `limit` bytes of the column, each of a row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
    at = 0
    while at < batch.num_rows:
        done = int(size[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(size, done + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end


def located(keys: np.ndarray, checks: np.ndarray, key: np.ndarray, check: np.ndarray) -> np.ndarray:
    """The place of each (key, check) among keys, in ascending order, and their checks, or -1.

    Equal keys with different checks are searched to the end of their run.
    """
    out = np.full(len(key), -1)
    todo, at = np.arange(len(key)), np.searchsorted(keys, key)
    while True:
        on = at < len(keys)
        todo, at = todo[on], at[on]
        on = keys[at] == key[todo]
        todo, at = todo[on], at[on]
        if not len(todo):
            return out
        hit = checks[at] == check[todo]
        out[todo[hit]] = at[hit]
        todo, at = todo[~hit], at[~hit] + 1


def by_key(key: np.ndarray, check: np.ndarray) -> np.ndarray:
    """A stable order by key and check; the check is sorted only where equal keys have different ones."""
    order = np.argsort(key, kind="stable")
    k, c = key[order], check[order]
    return np.lexsort((check, key)) if ((k[1:] == k[:-1]) & (c[1:] != c[:-1])).any() else order


def grouped(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by key and check, and where its groups begin; rows of a group are in any order."""
    order = np.argsort(key)
    k, c = key[order], check[order]
    same = k[1:] == k[:-1]
    if (same & (c[1:] != c[:-1])).any():
        order = np.lexsort((check, key))
        return order, group_starts(key[order], check[order])
    return order, np.append(np.ones(min(len(key), 1), bool), ~same)


def top_bits(key: np.ndarray, bits: int) -> np.ndarray:
    return key if bits >= 64 else key >> U64(64 - bits) << U64(64 - bits)


def as_text(values: list[bytes]) -> pa.Array:
    """A string column of these bytes; those that aren't UTF-8 stay as they are."""
    return pa.array(values, pa.binary()).cast(options=pc.CastOptions(pa.string(), allow_invalid_utf8=True))


@cache
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library: nothing to call
        return None


def release() -> None:
    """Gives memory that is free in this worker back to the system, as Spark keeps workers for later stages."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)
