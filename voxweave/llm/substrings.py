"""Substring dedup: Rabin-Karp hashes of every window of 20 words, counted in Spark; repeats merge into spans.

One pass hashes every window of every text. A batch of documents sends each window that is new to it to the window's
bucket, as 8 bytes of hash and about one byte for its place; a window that the batch already holds is known to be a
repeat and is not sent again, so a passage in a third of all rows costs its bucket one entry a batch. Each bucket finds
the first place of every hash and reports the other places to their documents' groups, where covered words become
maximal removal spans. A bucket number comes from a second polynomial, so two windows are taken as equal only if
64 bits and the bucket agree: for w windows in b buckets about w * w / (b * 2**65) pairs are mistaken.

Rows: a null or empty text has no words. Ids order documents; a null id comes before all others. Marks belong to a row,
told by its id and a hash of its text: of rows that share an id each loses only its own words. Windows of such rows are
compared by place like those of one document, so copies of a row neither remove each other nor lose what an earlier id
holds. Rows are grouped by the same key, so no id, null included, gathers its texts in one group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .packing import NULL_ID, home, pack, unpack
from .sizing import groups_for, text_bytes

WINDOW = 20
BATCH_WORDS = 1 << 20
BUCKET_BYTES = 8 << 20
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
PACKED = "bucket int, entries binary, known binary"


def _row_keys(ids: np.ndarray, column: pa.Array) -> np.ndarray:
    """A number for each row by id and text."""
    data, at = K.utf8(column)
    return (K.mix(ids.astype(np.uint64)) ^ K.span_hash(data, at[:-1], at[1:])).view(np.int64)


class _Batch:
    """Hashed words of documents until there are enough to send."""

    def __init__(self, window: int, buckets: int):
        self.window, self.buckets = window, buckets
        self.clear()

    def clear(self) -> None:
        self.ids, self.rows_of, self.lengths, self.hashes, self.total = [], [], [], [], 0

    def add(self, ids: np.ndarray, rows: np.ndarray, found: K.Words) -> None:
        lengths = np.diff(found.first)
        self.ids.append(ids)
        self.rows_of.append(rows)
        self.lengths.append(lengths)
        self.hashes.append(found.hash)
        self.total += len(found.hash)

    def rows(self) -> Iterator[tuple[int, bytes | None, bytes | None]]:
        """One row a bucket with the batch's first places, and one a group of documents with the places known to repeat."""
        ids, lengths = np.concatenate(self.ids), np.concatenate(self.lengths)
        values, keys = np.concatenate(self.hashes), np.concatenate(self.rows_of)
        self.clear()
        order = np.argsort(ids, kind="stable")  # so that a batch's first place is also the first by id
        moved = np.concatenate([[0], np.cumsum(lengths)])
        if not np.array_equal(order, np.arange(len(ids))):
            at = np.repeat(moved[order] - np.concatenate([[0], np.cumsum(lengths[order])[:-1]]), lengths[order])
            values, ids, keys, lengths = values[at + np.arange(len(values))], ids[order], keys[order], lengths[order]
        first = np.concatenate([[0], np.cumsum(lengths)])
        starts = K.window_starts(first, self.window)
        if not len(starts):
            return
        hashes = K.windows(values, self.window, BASES[0])[starts]
        bucket = (K.windows(values, self.window, BASES[1])[starts] % np.uint64(self.buckets)).astype(np.int32)
        doc = np.searchsorted(first, starts, "right") - 1
        place = starts - first[doc]
        if (ids[1:] == ids[:-1]).any():  # rows that share an id stand one after the other, whatever the places
            by = np.lexsort((place, ids[doc], hashes))
        else:
            by = np.argsort(hashes, kind="stable")
        same = np.zeros(len(by), bool)
        same[1:] = (hashes[by][1:] == hashes[by][:-1]) & (bucket[by][1:] == bucket[by][:-1])
        head = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))]
        # A repeat must start later than the first, which another row at the same id and place does not.
        tied = np.zeros(len(by), bool)
        tied[by] = same & (ids[doc[by]] == ids[doc[head]]) & (place[by] == place[head])
        repeat = np.zeros(len(by), bool)
        repeat[by] = same
        known = np.flatnonzero(repeat & ~tied)
        to = home(keys[doc[known]], self.buckets)
        known, to = known[np.argsort(to, kind="stable")], np.sort(to, kind="stable")
        bounds = K.group_bounds(to)
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield int(to[a]), None, pack(keys, lengths, starts[known[a:b]])
        # A tied window of another row is a first place too: a smaller id elsewhere may still make it a repeat.
        other = repeat & tied & (keys[doc] != keys[doc[_heads(head, by)]])
        keep = np.flatnonzero(~repeat | other)
        keep = keep[np.argsort(bucket[keep], kind="stable")]
        bounds = K.group_bounds(bucket[keep])
        for a, b in zip(bounds[:-1], bounds[1:]):
            part = keep[a:b]
            head = np.array([b - a], np.int64).tobytes() + hashes[part].tobytes()
            yield int(bucket[part[0]]), head + _pack(ids, keys, lengths, starts[part]), None


def _heads(head: np.ndarray, by: np.ndarray) -> np.ndarray:
    """``head`` in the order of windows and not of hashes."""
    out = np.empty_like(head)
    out[by] = head
    return out


def _pack(ids: np.ndarray, keys: np.ndarray, lengths: np.ndarray, places: np.ndarray) -> bytes:
    """As ``pack`` by row key, with the ids of the documents held in front."""
    first = np.concatenate([[0], np.cumsum(lengths)])
    held = np.unique(np.searchsorted(first, places, "right") - 1)
    return np.array([len(held)], np.int64).tobytes() + ids[held].tobytes() + pack(keys, lengths, places)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Id, row key and place of every packed place."""
    n = int(np.frombuffer(data, np.int64, 1)[0])
    ids, keys = np.frombuffer(data, np.int64, n, 8), np.frombuffer(data, np.int64, n, 16 + 8 * n)
    row, place = unpack(data[8 + 8 * n :])
    # The documents of a pack are told apart by their keys; copies of a row share both.
    by = np.argsort(keys, kind="stable")
    return ids[by[np.searchsorted(keys[by], row)]], row, place


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
        names=["bucket", "entries", "known"],
    )


def _hash_windows(window: int, buckets: int):
    def run(batches):
        held = _Batch(window, buckets)
        for whole in batches:
            for batch in K.slices(whole, "text"):
                ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64)
                held.add(ids, _row_keys(ids, batch.column(1)), K.words(*K.utf8(batch.column(1))))
                if held.total >= BATCH_WORDS:
                    yield _arrow(list(held.rows()))
        if held.total:
            yield _arrow(list(held.rows()))

    return run


def _later_places(groups: int):
    """Of a bucket: the places that are not the first of their hash, packed for each group of documents."""

    def run(table: pa.Table) -> pa.Table:
        hashes, ids, keys, places, known = [], [], [], [], []
        for entries, marked in zip(table.column("entries"), table.column("known")):
            if marked.is_valid:
                known.append(unpack(marked.as_buffer().to_pybytes()))
            if entries.is_valid:
                body = entries.as_buffer().to_pybytes()
                n = int(np.frombuffer(body, np.int64, 1)[0])
                hashes.append(np.frombuffer(body, np.uint64, n, 8))
                one = _unpack(body[8 + 8 * n :])
                ids.append(one[0])
                keys.append(one[1])
                places.append(one[2])
        out_keys, out_places = [k[0] for k in known], [k[1] for k in known]
        if hashes:
            h, i, r, p = np.concatenate(hashes), np.concatenate(ids), np.concatenate(keys), np.concatenate(places)
            by = np.argsort(h, kind="stable")
            equal = h[by][1:] == h[by][:-1]
            shared = np.zeros(len(by), bool)
            shared[1:] |= equal
            shared[:-1] |= equal
            by = by[shared]
            h, i, r, p = h[by], i[by], r[by], p[by]
            by = np.lexsort((p, i, h))
            h, i, r, p = h[by], i[by], r[by], p[by]
            bounds = K.group_bounds(h)
            head = np.repeat(bounds[:-1], np.diff(bounds))
            later = (i != i[head]) | (p != p[head])
            out_keys.append(r[later])
            out_places.append(p[later])
        r = np.concatenate([np.zeros(0, np.int64), *out_keys])
        p = np.concatenate([np.zeros(0, np.int64), *out_places])
        to = home(r, groups)
        by = np.lexsort((p, r, to))
        to, r, p = to[by], r[by], p[by]
        bounds = K.group_bounds(to)
        rows = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            docs = K.group_bounds(r[a:b])
            own, where = r[a:b][docs[:-1]], p[a:b]
            last = where[docs[1:] - 1] + 1
            shift = np.repeat(np.concatenate([[0], np.cumsum(last)[:-1]]), np.diff(docs))
            rows.append((int(to[a]), pack(own, last, where + shift)))
        return pa.table({"home": pa.array([r[0] for r in rows], pa.int32()), "marks": pa.array([r[1] for r in rows], pa.binary())})

    return run


def _texts(groups: int):
    """Texts of each group of rows as compressed Arrow streams, which take half the room of rows in a shuffle."""

    def run(batches):
        for whole in batches:
            for batch in K.slices(whole, "text"):
                ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64)
                keys = _row_keys(ids, batch.column(1))
                to = home(keys, groups)
                by = np.argsort(to, kind="stable")
                bounds = K.group_bounds(to[by])
                keyed = pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], names=["doc_id", "text", "key"])
                blobs = [K.to_stream(keyed.take(pa.array(by[a:b]))) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(to[by][bounds[:-1]].astype(np.int32)), pa.array(blobs, pa.binary())], names=["home", "texts"])

    return run


def _spans(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of words that windows at these ascending starts cover."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > window) + 1
    return starts[np.concatenate([[0], cut])], starts[np.concatenate([cut - 1, [len(starts) - 1]])] + window


def _rewrite(window: int):
    """Join a group's texts with its marks: one row a document."""

    def run(streams: pa.Table, marks: pa.Table) -> pa.Table:
        texts = K.from_streams(streams.column("texts"), {"doc_id": pa.int64(), "text": pa.string(), "key": pa.int64()})
        found = [unpack(m) for m in marks.column("marks").to_pylist()]
        ids = np.concatenate([np.zeros(0, np.int64), *[f[0] for f in found]])
        places = np.concatenate([np.zeros(0, np.int64), *[f[1] for f in found]])
        by = np.lexsort((places, ids))
        ids, places = ids[by], places[by]
        own = texts.column("key").to_numpy()
        data, at = K.utf8(texts.column("text"))
        body = data.tobytes()
        bounds = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        total, removed, digest, firsts, lasts = [], [], [], [], []
        for k in range(len(own)):
            text = body[at[k] : at[k + 1]]
            parts = text.split()  # on bytes: space and tab to carriage return only
            a, b = _spans(np.unique(places[bounds[0][k] : bounds[1][k]]), window)
            a, b = a[a < len(parts)], b[: len(a[a < len(parts)])]
            gone = 0
            kept, last = [], 0
            for x, y in zip(a.tolist(), b.tolist()):
                y = min(y, len(parts))
                kept.extend(parts[last:x])
                last, gone = y, gone + y - x
            kept = parts if not gone else kept + parts[last:]
            total.append(len(parts))
            removed.append(gone)
            digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            firsts.append(a)
            lasts.append(b)
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "n_words": pa.array(total, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digest, pa.string()),
                "span_starts": pa.array(firsts, pa.list_(pa.int64())),
                "span_ends": pa.array(lasts, pa.list_(pa.int64())),
            }
        )

    return run


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, span_starts, span_ends), one row for each row of ``docs``.

    Spans are in words, ends excluded. ``docs`` needs ``doc_id`` and ``text``; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = text_bytes(docs)
    buckets = groups_for(size, BUCKET_BYTES)
    later = (
        docs.mapInArrow(_hash_windows(window, buckets), PACKED)
        .repartition(buckets, "bucket")
        .groupBy("bucket")
        .applyInArrow(_later_places(buckets), "home int, marks binary")
    )
    texts = docs.mapInArrow(_texts(buckets), "home int, texts binary").repartition(buckets, "home")
    later = later.repartition(buckets, "home")
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string, span_starts array<long>, span_ends array<long>"
    return texts.groupBy("home").cogroup(later.groupBy("home")).applyInArrow(_rewrite(window), out)
