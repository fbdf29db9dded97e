"""Packed rows for wide shuffles: places inside documents, and texts grouped by a hash of the document's id."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import kernels as K

NULL_ID = -(1 << 63)


def home(ids: np.ndarray, groups: int) -> np.ndarray:
    return (K.mix(ids.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)


def pack(ids: np.ndarray, lengths: np.ndarray, places: np.ndarray) -> bytes:
    """Places in the words of a batch, in order, with the documents they fall in.

    Layout: number of documents, their ids, their word counts, packed places where the documents that hold none are
    left out of the count.
    """
    first = np.concatenate([[0], np.cumsum(lengths)])
    doc = np.searchsorted(first, places, "right") - 1
    held = np.unique(doc)
    new_first = np.concatenate([[0], np.cumsum(lengths[held])])
    moved = places - first[doc] + new_first[np.searchsorted(held, doc)]
    head = np.array([len(held)], np.int64).tobytes() + ids[held].tobytes() + lengths[held].astype(np.uint32).tobytes()
    return head + K.pack_gaps(moved)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Document id and place in the document of every packed place."""
    n = int(np.frombuffer(data, np.int64, 1)[0])
    ids = np.frombuffer(data, np.int64, n, 8)
    lengths = np.frombuffer(data, np.uint32, n, 8 + 8 * n).astype(np.int64)
    places = K.unpack_gaps(memoryview(data)[8 + 12 * n :])
    first = np.concatenate([[0], np.cumsum(lengths)])
    doc = np.searchsorted(first, places, "right") - 1
    return ids[doc], places - first[doc]


def texts_by_home(groups: int):
    """Texts of each group of documents as compressed Arrow streams, which take half the room of rows in a shuffle."""

    def run(batches):
        for whole in batches:
            for batch in K.slices(whole, "text"):
                ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64)
                to = home(ids, groups)
                by = np.argsort(to, kind="stable")
                bounds = K.group_bounds(to[by])
                blobs = [K.to_stream(batch.take(pa.array(by[a:b]))) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[by][bounds[:-1]].astype(np.int32)), pa.array(blobs, pa.binary())], names=["home", "texts"]
                )

    return run
