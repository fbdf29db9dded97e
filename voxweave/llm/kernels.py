"""NumPy kernels on UTF-8 buffers that run inside Arrow tasks: words, rolling hashes, packed entries.

A word is a maximal run of bytes other than space and tab to carriage return; UTF-8 never uses those bytes inside a
character, so words are found on bytes. Hashes are polynomials modulo 2**64 (Rabin-Karp with prefix sums), finished
with a bijective mixer. Work is done in blocks, so memory beside the text is a few arrays of one entry per word.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
SEPARATORS = (32, 9, 10, 11, 12, 13)
_U = np.uint64


class Words(NamedTuple):
    """Words of several texts: byte bounds, 64-bit hash, and for text ``i`` the words ``first[i]:first[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text; a longer text is a part of its own."""
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
    size = np.array(pc.fill_null(pc.binary_length(column), 0), np.int64)
    part = np.cumsum(size) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def cache() -> dict:
    """Tables of this process. They hang on a module that is never pickled, so tasks do not carry them."""
    return vars(sys).setdefault("_voxweave_tables", {})


def give_back() -> None:
    """Return freed memory of this process, tables included, to the system; workers are used again by later stages."""
    cache().clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse for i up to ``n``; ``base`` is odd."""
    have = cache().get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size, _U)
            p[1:] = _U(b)
            both.append(np.multiply.accumulate(p))
        have = cache()[base] = tuple(both)
    return have


def _bytes_table() -> np.ndarray:
    if "bytes" not in cache():
        cache()["bytes"] = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
    return cache()["bytes"]


def class_table(values: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


def runs(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of maximal runs of bytes with ``inside[byte]``, cut at text bounds, and the first run of each text."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    is_in = inside[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_in[:-1]
    inner = at[(at > 0) & (at < n)]
    before[inner] = False
    start = np.flatnonzero(is_in & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = is_in[1:]
    after[inner - 1] = False
    end = np.flatnonzero(is_in & ~after) + 1
    return start, end, np.searchsorted(start, at)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """64-bit hash of each byte span; spans are in order and do not overlap."""
    out = np.empty(len(start), _U)
    table, k = _bytes_table(), 0
    while k < len(start):
        a = start[k]
        stop = max(k + 1, int(np.searchsorted(end, a + BLOCK, "right")))
        b = end[stop - 1]
        power, inverse = _powers(base, b - a + 1)
        sums = np.zeros(b - a + 1, _U)
        np.cumsum(table[data[a:b]] * power[: b - a], out=sums[1:])
        s, e = start[k:stop] - a, end[k:stop] - a
        out[k:stop] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(_U))
        k = stop
    return out


_word_bytes = ~class_table(SEPARATORS)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def words(data: np.ndarray, at: np.ndarray) -> Words:
    start, end, first = runs(data, at, _word_bytes)
    return Words(start, end, span_hash(data, start, end), first)


def windows(values: np.ndarray, size: int, base: int) -> np.ndarray:
    """Rabin-Karp hash of each run of ``size`` values (one entry per start, ``len - size + 1`` of them)."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.empty(n, _U)
    for a in range(0, n, BLOCK):
        b = min(n, a + BLOCK)
        power, inverse = _powers(base, b - a + size)
        sums = np.zeros(b - a + size, _U)
        np.cumsum(values[a : b + size - 1] * power[: b - a + size - 1], out=sums[1:])
        out[a:b] = mix((sums[size:] - sums[:-size]) * inverse[: b - a])
    return out


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Indices of words where a window of ``size`` words fits in its text."""
    total = int(first[-1])
    fits = np.ones(total, bool)
    for back in range(1, size):
        last = first[1:] - back
        fits[last[last >= first[:-1]]] = False
    return np.flatnonzero(fits)


def pack_gaps(values: np.ndarray) -> bytes:
    """Ascending non-negative integers as bytes: each gap is so many 255s and a rest."""
    gaps = np.diff(values, prepend=0).astype(np.int64)
    full, rest = np.divmod(gaps, 255)
    out = np.full(int(full.sum()) + len(gaps), 255, np.uint8)
    out[np.cumsum(full + 1) - 1] = rest
    return out.tobytes()


def unpack_gaps(data: bytes | memoryview) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    return np.cumsum(raw, dtype=np.int64)[raw != 255]


def group_bounds(keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal keys in a sorted array, and its length at the end."""
    if len(keys) == 0:
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def to_stream(batch: pa.RecordBatch) -> bytes:
    """A batch as one compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_streams(blobs: pa.ChunkedArray, fields: dict[str, pa.DataType]) -> pa.Table:
    """The rows of all streams, with these columns."""
    schema = pa.schema(list(fields.items()))
    tables = [pa.ipc.open_stream(blob.as_buffer()).read_all().select(list(fields)).cast(schema) for blob in blobs]
    return pa.concat_tables([schema.empty_table(), *tables]).combine_chunks()
