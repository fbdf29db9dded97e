"""N-gram Jaccard join: sets of 5-word shingles, size-aware heavy-light, exact; classes instead of all pairs of copies.

1. One pass makes every text's shingle set, its 128-bit fingerprint, and sends the half of the set with the smallest
   hashes to buckets by hash. A linked pair shares three quarters of either set, so a document whose half set holds more
   than a quarter of the set in shingles that no other document has is linked with nobody. A shingle that a batch holds
   twice is known not to be alone and takes one entry, so a passage in a third of all rows costs one entry a batch.
2. Equal fingerprints are one class. Classes that are left send their sets, and shingles are put in order of frequency
   (a count sketch of fixed size, hash as second key; any order is exact, this one keeps lists short).
3. Light sets, up to a size chosen by cost, file every pair of shingles in their first ``n // 4 + 2`` under the pair;
   heavy sets, and light ones large enough to be linked with them, file under each of their first ``n // 4 + 1``
   shingles, and these lists are scanned for heavy members. Two linked sets meet in one of the lists.
4. In each list the members are compared with the one that has least of its own, the likely middle of a group of copies;
   members already in one component need no comparison. A member that no size or place in its list fits leaves the list.
   Then lists are cut into cells of like sizes, and all pairs of different components that fit are compared, if these are
   few (``FEW``). Else sets that have too few shingles in common with other components are put aside, and if there are still
   too many (``LOOKED``, ``PAIRS``), cells go on with their next members, ``HUBS`` times as many each round: the number of rounds
   grows with the logarithm of the longest list. A pair is compared only if its sizes fit and what follows the meeting
   place in both sets suffices. Lists with the same members count once. Comparison is exact on whole sets. Nothing is capped.

Rows: null, empty and blank texts have empty sets and are linked with nothing. A null id is the smallest. Rows that share
an id are one node. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxweave.session import small_batches

from . import kernels as K
from .graph import components
from .native import SMALL_ROWS, settle, small
from .packing import NULL_ID, home, pack, texts_by_home, unpack
from .sizing import groups_for, text_bytes

SHINGLE = 5
SHARE = 75  # per cent of the union
BATCH = 1 << 19
SLICE = 1 << 20
TOKENS = 2 << 20  # bytes of sets that are put in order at a time
BUCKET_BYTES = 8 << 20
SKETCH_BITS = 24
SLICE_BITS = 16
PART_ROWS = 100
LOOKED = 1 << 27  # so many candidates, or EACH for each list entry, may be looked at in one step,
PAIRS = 1 << 24  # so many pairs, or EACH for each list entry, compared,
EACH = 64
FEW = 1 << 20  # and so many pairs before sets are put aside
HUBS = 8
DEALT = 1 << 20  # candidates of a list that one task looks at
_U = np.uint64
_BASE, _SHORT = 0x9FB21C651E98DF25, 0xD1B54A32D192ED03


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and the bounds of each text."""
    w = K.words(K.lower_ascii(data), at)
    starts = K.window_starts(w.first, size)
    h = K.windows(w.hash, size, _BASE)[starts]
    doc = np.searchsorted(w.first, starts, "right") - 1
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):  # the whole sequence is one shingle
        one = [K.windows(w.hash[w.first[i] : w.first[i + 1]], int(count[i]), _SHORT)[0] for i in short]
        h, doc = np.concatenate([h, np.array(one, _U)]), np.concatenate([doc, short])
    by = np.argsort(h)
    by = by[np.argsort(doc[by].astype(np.uint16 if len(at) <= 65536 else np.int64), kind="stable")]
    h, doc = h[by], doc[by]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(at) - 1))]).astype(np.int64)


def _fingerprints(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = []
    for salt in (_U(0x8EBC6AF09C88C6E3), _U(0x589965CC75374CC3)):
        sums = np.zeros(len(h) + 1, _U)
        np.cumsum(K.mix(h ^ salt), out=sums[1:])
        out.append(K.mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(_U)))
    return np.stack(out)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def _keys(ids: np.ndarray, print1: np.ndarray) -> np.ndarray:
    """A number for each row by id and text, so that rows which share an id are counted one by one."""
    return (K.mix(ids.view(_U)) ^ print1.view(_U)).view(np.int64)


class _Half:
    """Half sets of documents until there are enough to send."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.ids, self.sizes, self.sets, self.prints, self.total = [], [], [], [], 0

    def add(self, ids: np.ndarray, h: np.ndarray, first: np.ndarray) -> None:
        self.ids.append(ids)
        self.sizes.append(np.diff(first))
        self.sets.append(h)
        self.prints.append(_fingerprints(h, first))
        self.total += len(h)

    def rows(self) -> pa.RecordBatch:
        ids, sizes, h = np.concatenate(self.ids), np.concatenate(self.sizes), np.concatenate(self.sets)
        prints = np.concatenate(self.prints, axis=1)
        self.clear()
        rows: list[tuple] = []
        keys = _keys(ids, prints[0])
        to = home(keys, self.buckets)
        by = np.argsort(to, kind="stable")
        bounds = K.group_bounds(to[by])
        for a, b in zip(bounds[:-1], bounds[1:]):
            part = by[a:b]
            info = ids[part].tobytes() + sizes[part].astype(np.int64).tobytes() + prints[:, part].tobytes()
            rows.append((int(to[part[0]]), None, info))
        first = np.concatenate([[0], np.cumsum(sizes)])
        index = np.arange(len(h)) - np.repeat(first[:-1], sizes)
        half = np.flatnonzero((index < np.repeat(sizes // 4 + -(-sizes // 4), sizes)) & (np.repeat(sizes, sizes) > 2))
        values = h[half]
        by = np.argsort(values)
        alone = np.ones(len(by), bool)
        equal = values[by][1:] == values[by][:-1]
        alone[1:] &= ~equal
        alone[:-1] &= ~equal
        single = np.sort(by[alone])
        shared = by[~alone]
        shared = shared[np.concatenate([[True], values[shared][1:] != values[shared][:-1]])] if len(shared) else shared
        bucket_of = lambda v: ((v >> _U(32)) % _U(self.buckets)).astype(np.int32)
        for which, placed in ((single, True), (shared, False)):
            bucket = bucket_of(values[which])
            order = np.argsort(bucket, kind="stable")
            bounds = K.group_bounds(bucket[order])
            for a, b in zip(bounds[:-1], bounds[1:]):
                part = which[order[a:b]]
                head = np.array([b - a, placed], np.int64).tobytes() + values[part].astype(np.uint32).tobytes()
                rows.append((int(bucket[order[a]]), head + (pack(keys, sizes, half[part]) if placed else b""), None))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
            names=["bucket", "entries", "info"],
        )


def _send_halves(buckets: int):
    def run(batches):
        held = _Half(buckets)
        for whole in batches:
            for batch in K.slices(whole, "text", SLICE):
                held.add(_ids(batch.column(0)), *shingle_sets(*K.utf8(batch.column(1))))
                if held.total >= BATCH:
                    yield held.rows()
        if held.ids:
            yield held.rows()
        K.give_back()

    return run


def _count_alone(groups: int):
    """Of a bucket: how many of a row's shingles no other entry has, for each group of rows."""

    def run(table: pa.Table) -> pa.Table:
        values, placed, keys, info = [], [], [], []
        for entries, one in zip(table.column("entries").to_pylist(), table.column("info").to_pylist()):
            if one is not None:
                info.append(one)
                continue
            n, has = (int(x) for x in np.frombuffer(entries, np.int64, 2))
            values.append(np.frombuffer(entries, np.uint32, n, 16))
            placed.append(np.full(n, bool(has)))
            keys.append(unpack(entries[16 + 4 * n :])[0] if has else np.zeros(n, np.int64))
        firsts = [np.frombuffer(i, np.int64).reshape(4, -1)[:, :1] for i in info]
        rows = [(int(home(_keys(x[0], x[2]), groups)[0]), None, i) for x, i in zip(firsts, info)]
        if values:
            v, p, d = np.concatenate(values), np.concatenate(placed), np.concatenate(keys)
            by = np.argsort(v)
            equal = v[by][1:] == v[by][:-1]
            alone = np.ones(len(v), bool)
            alone[1:] &= ~equal
            alone[:-1] &= ~equal
            d = d[by[alone & p[by]]]
            d, n = np.unique(d, return_counts=True)
            to = home(d, groups)
            order = np.argsort(to, kind="stable")
            bounds = K.group_bounds(to[order])
            for a, b in zip(bounds[:-1], bounds[1:]):
                part = order[a:b]
                rows.append((int(to[part[0]]), d[part].tobytes() + n[part].astype(np.int64).tobytes(), None))
        return pa.table(
            {"home": pa.array([r[0] for r in rows], pa.int32()), "alone": pa.array([r[1] for r in rows], pa.binary()), "info": pa.array([r[2] for r in rows], pa.binary())}
        )

    return run


_DOCS = "home int, _id long, n long, print1 long, print2 long, isolated boolean"


def _sum_alone(groups: int):
    """Set size, fingerprint and verdict of every row of a group of rows, and the group of its id."""

    def run(table: pa.Table) -> pa.Table:
        info = [np.frombuffer(x, np.int64).reshape(4, -1) for x in table.column("info").to_pylist() if x is not None]
        ids, n, one, two = np.concatenate([np.zeros((4, 0), np.int64), *info], axis=1)
        told = [np.frombuffer(x, np.int64).reshape(2, -1) for x in table.column("alone").to_pylist() if x is not None]
        who, count = np.concatenate([np.zeros((2, 0), np.int64), *told], axis=1)
        u, inverse = np.unique(who, return_inverse=True)
        total = np.bincount(inverse, count, len(u)) if len(u) else np.zeros(0)
        keys = _keys(ids, one)
        at = np.minimum(np.searchsorted(u, keys), max(0, len(u) - 1))
        own = np.where(u[at] == keys, total[at], 0) if len(u) else np.zeros(len(ids))
        where = home(ids, groups).astype(np.int32)
        return pa.table({"home": where, "_id": ids, "n": n, "print1": one, "print2": two, "isolated": own > n // 4})

    return run


def _sets_of(texts: pa.Table, wanted: pa.Table) -> pa.Table:
    """Sets of the wanted classes of a group, each under the class's node."""
    rows = K.from_streams(texts.column("texts"), {"doc_id": pa.int64(), "text": pa.string()})
    ids = _ids(rows.column("doc_id").combine_chunks())
    rows = rows.filter(pa.array(np.isin(ids, wanted.column("_id").to_numpy())))
    node = {(a, b, n): c for a, b, n, c in zip(*(wanted.column(x).to_pylist() for x in ("print1", "print2", "n", "node")))}
    place, size, kept = [], [], [np.zeros(0, _U)]
    for whole in rows.to_batches():
        for batch in K.slices(whole, "text", SLICE):
            h, first = shingle_sets(*K.utf8(batch.column(1)))
            prints = _fingerprints(h, first).view(np.int64)
            # A row's id may be wanted for another of its texts, and a text may stand under an id more than once.
            for i, key in enumerate(zip(prints[0].tolist(), prints[1].tolist(), np.diff(first).tolist())):
                if key in node:
                    place.append(node.pop(key))
                    size.append(key[2])
                    kept.append(h[first[i] : first[i + 1]].copy())
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    h = np.concatenate(kept)
    tokens = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at * 8), pa.py_buffer(h)])
    return pa.table({"_id": pa.array(place, pa.int64()), "n": pa.array(size, pa.int64()), "tokens": tokens.cast(pa.binary())})


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, shingles and bounds of a batch of (_id, n, tokens)."""
    data, at = K.utf8(batch.column(2))
    return batch.column(0).to_numpy(), np.frombuffer(data.tobytes(), _U), at // 8


def _sketch_entries(batches):
    for whole in batches:
        for batch in K.slices(whole, "tokens"):
            slot = np.sort(_sets(batch)[1] >> _U(64 - SKETCH_BITS)).astype(np.int64)
            slot, n = np.unique(slot, return_counts=True)
            bounds = K.group_bounds(slot >> SLICE_BITS)
            rows = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                low = (slot[a:b] & ((1 << SLICE_BITS) - 1)).astype(np.uint16)
                rows.append((int(slot[a] >> SLICE_BITS), low.tobytes(), n[a:b].astype(np.uint32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                names=["part", "slots", "counts"],
            )


def _sketch_slice(table: pa.Table) -> pa.Table:
    total = np.zeros(1 << SLICE_BITS)
    for slots, counts in zip(table.column("slots").to_pylist(), table.column("counts").to_pylist()):
        total[np.frombuffer(slots, np.uint16)] += np.frombuffer(counts, np.uint32)
    level = np.minimum(255, np.ceil(6 * np.log2(np.maximum(total, 1)))).astype(np.uint8)
    return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "level": pa.array([level.tobytes()], pa.binary())})


def frequency_order(sets: DataFrame) -> np.ndarray:
    """For each of ``2**SKETCH_BITS`` hash slots, a level that grows with the logarithm of its count: 16 MB at any size."""
    rows = sets.select("_id", "n", "tokens").mapInArrow(_sketch_entries, "part int, slots binary, counts binary")
    level = np.zeros(1 << SKETCH_BITS, np.uint8)
    for part, own in rows.groupBy("part").applyInArrow(_sketch_slice, "part int, level binary").collect():
        level[part << SLICE_BITS : part + 1 << SLICE_BITS] = np.frombuffer(bytes(own), np.uint8)
    return level


def _prefixes(level: np.ndarray, batch: pa.RecordBatch, more: int):
    """Ids, sizes, first ``n // 4 + more`` shingles of every set in order of frequency, their levels, bounds, and mean level.

    The mean level of a whole set is high where the set has little of its own: at the middle of a group of copies.
    """
    ids, h, first = _sets(batch)
    n = np.diff(first)
    own = level[(h >> _U(64 - SKETCH_BITS)).astype(np.int64)]
    doc = np.repeat(np.arange(len(n)), n)
    key = doc.astype(np.int64) << 8 | own  # hashes ascend inside a set, so a stable sort leaves them as second key
    by = np.argsort(key, kind="stable")
    index = np.arange(len(h)) - first[:-1].repeat(n)
    kept = by[index < np.minimum(n, n // 4 + more)[doc]]
    size = np.minimum(n, n // 4 + more)
    total = np.concatenate([[0], np.cumsum(own, dtype=np.int64)])
    mean = ((total[first[1:]] - total[first[:-1]]) / np.maximum(n, 1)).astype(np.float32)
    return ids, n, h[kept], own[kept], np.concatenate([[0], np.cumsum(size)]), mean


def _cost_rows(shared):
    def run(batches):
        for whole in batches:
            for batch in K.slices(whole, "tokens", TOKENS):
                _, n, _, own, first, _ = _prefixes(shared.value, batch, 2)
                if not len(n):
                    continue
                size = np.diff(first)
                scan = np.add.reduceat(1 + own / 6.0, first[:-1])
                step = (8 * np.log2(n)).astype(np.int32)
                u, inverse = np.unique(step, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u), pa.array(np.bincount(inverse, size * (size - 1) / 2.0)), pa.array(np.bincount(inverse, scan))], names=["step", "pairs", "scan"]
                )

    return run


def boundary(sets: DataFrame, shared) -> int:
    """Largest light size: the cut with the least work, pairs filed by light sets against lists scanned for heavy ones.

    A filed pair is one row. A scanned shingle is one row, and one comparison more each time its list doubles: members
    that a first comparison puts into one component need no other.
    """
    rows = sets.select("_id", "n", "tokens").mapInArrow(_cost_rows(shared), "step int, pairs double, scan double")
    cost = sorted(rows.groupBy("step").agg(F.sum("pairs"), F.sum("scan")).collect())
    best, cut, light, heavy = None, 2, 0.0, sum(r[2] for r in cost)
    for step, pairs, scan in [(None, 0.0, 0.0), *cost]:
        light, heavy = light + pairs, heavy - scan
        if best is None or light + heavy < best:
            best, cut = light + heavy, 2 if step is None else int(2 ** ((step + 1) / 8) - 1e-9)
    return cut


_FILED = "key long, heavy boolean, _id long, n int, w float, place int"


def _file(shared, cut: int):
    def run(batches):
        for whole in batches:
            for batch in K.slices(whole, "tokens", TOKENS):
                ids, n, h, _, first, mean = _prefixes(shared.value, batch, 2)
                keys, heavy, who, place = [], [], [], []
                doc = np.repeat(np.arange(len(n)), np.diff(first))
                index = np.arange(len(h)) - first[:-1].repeat(np.diff(first))
                meets_heavy = 4 * n >= 3 * (cut + 1)
                single = (index < (n // 4 + 1)[doc]) & meets_heavy[doc]
                keys.append(K.mix(h[single] ^ _U(0x2545F4914F6CDD1D)))
                who.append(doc[single])
                place.append(index[single])
                heavy.append(n[doc[single]] > cut)
                for i in np.flatnonzero(n <= cut):
                    own = h[first[i] : first[i + 1]]
                    a, b = np.triu_indices(len(own), 1)
                    keys.append(K.mix(own[a] * _U(0x9E3779B97F4A7C15) + K.mix(own[b])))
                    who.append(np.full(len(a), i))
                    place.append(a)
                    heavy.append(np.ones(len(a), bool))  # any two light sets that share a pair are compared
                who = np.concatenate(who)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(heavy)), pa.array(ids[who]), pa.array(n[who].astype(np.int32)), pa.array(mean[who]), pa.array(np.concatenate(place).astype(np.int32))],
                    names=["key", "heavy", "_id", "n", "w", "place"],
                )
        K.give_back()

    return run


def lists(sets: DataFrame) -> DataFrame:
    """(key, _id, n, w, place): members of every list that has two and, if one of single shingles, a heavy one."""
    spark = sets.sparkSession
    shared = spark.sparkContext.broadcast(frequency_order(sets))
    cut = boundary(sets, shared)
    filed = sets.select("_id", "n", "tokens").mapInArrow(_file(shared, cut), _FILED)
    # Lists with the same members, as a shared passage makes them, become one, at the foremost place in each set.
    marks = F.bit_xor(F.xxhash64("_id")), F.bit_xor(F.xxhash64("_id", F.lit(17)))
    keys = filed.groupBy("key").agg(F.count("*").alias("c"), F.max("heavy").alias("heavy"), marks[0].alias("one"), marks[1].alias("two"))
    keys = keys.where("c > 1 and heavy").select("key", F.xxhash64("one", "two", "c").alias("same"))
    return settle(
        filed.join(keys, "key").groupBy(F.col("same").alias("key"), "_id").agg(F.max("n").alias("n"), F.max("w").alias("w"), F.min("place").alias("place"))
    )[0]


def _compare(share: int):
    def run(table: pa.Table) -> pa.Table:
        data, at = K.utf8(table.column("tokens"))
        h, at = data.view(_U), at // 8
        hubs: dict[tuple, list[np.ndarray]] = {}
        rows = [table.column(c).to_pylist() for c in ("hub", "salt", "_id", "is_hub")]
        for i, (hub, salt, _, is_hub) in enumerate(zip(*rows)):
            if is_hub:
                hubs.setdefault((hub, salt), []).append(h[at[i] : at[i + 1]])
        out = []
        for i, (hub, salt, doc, is_hub) in enumerate(zip(*rows)):
            if is_hub:
                continue
            own = h[at[i] : at[i + 1]]
            for other in hubs.get((hub, salt), ()):
                both = int((other[np.minimum(np.searchsorted(other, own), len(other) - 1)] == own).sum())
                if 100 * both >= share * (len(own) + len(other) - both):
                    out.append((hub, doc))
                    break
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return run


def links(pairs: DataFrame, sets: DataFrame, share: int = SHARE) -> tuple[DataFrame, int]:
    """Those of ``pairs`` (hub, _id) whose sets reach the similarity, and how many pairs there were.

    A hub with many members is dealt out with salts, its set once for each.
    """
    salts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("salts"))
    members = pairs.join(salts, "hub").select("_id", "hub", F.pmod(F.xxhash64("_id"), F.col("salts")).cast("int").alias("salt"), F.lit(False).alias("is_hub"))
    centres = salts.select(
        F.col("hub").alias("_id"), "hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("is_hub")
    )
    wanted, n = settle(members.unionAll(centres))
    rows = sets.select("_id", "tokens").join(F.broadcast(wanted) if n <= SMALL_ROWS else wanted, "_id")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("hub", "salt"), F.lit(max(8, n // PART_ROWS))).cast("int"))
    return settle(rows.groupBy("part").applyInArrow(_compare(share), "a long, b long"))


def _tokens_of(batches):
    for whole in batches:
        for batch in K.slices(whole, "tokens", 1 << 20):
            _, h, first = _sets(batch.select(["_id", "n", "tokens"]))
            each = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(first)))
            kept = [batch.column(batch.schema.get_field_index(c)).take(each) for c in ("_id", "n", "c")]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *kept], names=["token", "_id", "n", "c"])


def _with_strangers(members: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """``members`` (with component ``c``) whose sets can still be linked with one of another component.

    Such a link shares ``share`` per cent of the set, so at least as many of its shingles occur in other components.
    """
    ids, n = settle(members.select("_id", "c").distinct())
    rows = sets.join(F.broadcast(ids) if n <= SMALL_ROWS else ids, "_id").select("_id", "n", "c", "tokens")
    rows = rows.mapInArrow(_tokens_of, "token long, _id long, n long, c long")
    cross = rows.groupBy("token").agg(F.min("c").alias("least"), F.max("c").alias("most")).where("least <> most").select("token")
    able = rows.join(cross, "token").groupBy("_id", "n").count().where(100 * F.col("count") >= share * F.col("n")).select("_id")
    return members.join(able, "_id", "left_semi")


def _cells(members: DataFrame, share: int) -> DataFrame:
    """``members`` with every list cut by size: any two sets of a list whose sizes fit are in one cell, each set is in two."""
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(1.001 * 100 / share))
    cell = F.explode(F.array(band, band + 1)).alias("_cell")
    return members.select("*", cell).withColumn("key", F.xxhash64("key", "_cell")).drop("_cell")


def _beside(hubs: DataFrame, members: DataFrame, each: int | None = None) -> DataFrame:
    """Every one of ``hubs`` (at most ``each`` in a list) beside the ``members`` of its list.

    A long list is dealt out with salts, its hubs once for each, so that no task looks at more than about ``DEALT`` pairs.
    """
    of = F.col("size") if each is None else F.least(F.col("size"), F.lit(each))
    salts = F.least(F.ceil(F.col("size") * of / DEALT), F.col("size")).cast("int")
    first = hubs.select(
        "key", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
        *[F.col(x).alias(y) for x, y in (("_id", "hub"), ("n", "hub_n"), ("c", "hub_c"), ("place", "hub_place"))],
    )
    return first.join(members.withColumn("salt", F.pmod(F.xxhash64("_id"), salts).cast("int")), ["key", "salt"])


def linked_components(members: DataFrame, sets: DataFrame, share: int = SHARE) -> DataFrame:
    """(_id, component) of all sets that are linked with another, from the lists that they meet in."""
    spark = members.sparkSession
    labels = spark.createDataFrame([], "node long, component long")
    found, tested, rounds, narrowed, each = [], [], 0, 0, 1
    entry = ["key", "_id", "n", "w", "place"]
    # Sizes fit, and what follows the meeting place in either set is enough for the overlap (sizes * share / (100 + share)).
    fits = (100 * F.col("n") >= share * F.col("hub_n")) & (100 * F.col("hub_n") >= share * F.col("n"))
    rest = F.least(F.col("n") - F.col("place"), F.col("hub_n") - F.col("hub_place"))
    fits = fits & ((100 + share) * rest >= share * (F.col("n") + F.col("hub_n")))
    reach = 100 * F.col("n").cast("long") - (100 + share) * F.col("place")  # ``share`` times the largest size that fits
    while True:
        rounds += 1
        named = members.withColumn("c", F.col("_id"))
        if found:
            named = members.join(labels, F.col("_id") == F.col("node"), "left").select(*entry, F.coalesce("component", "_id").alias("c"))
        hub = [F.max(F.struct("w", "_id", "n", "c", "place")).alias("hub")] if rounds == 1 else []
        open_keys = named.groupBy("key").agg(
            F.min("c").alias("least"), F.max("c").alias("most"), F.min("n").alias("low"), F.max(reach).alias("high"), F.count("*").alias("size"), *hub
        )
        opened = named.join(open_keys.where("least <> most").drop("least", "most"), "key")
        members, n = settle(opened.where((reach >= share * F.col("low")) & (share * F.col("n") <= F.col("high"))).drop("low", "high"))
        if not n:
            break
        last = False
        if rounds == 1:
            pairs = members.select("_id", "n", "c", "place", F.col("hub._id").alias("hub"), F.col("hub.place").alias("hub_place"), F.col("hub.n").alias("hub_n"), F.col("hub.c").alias("hub_c"), F.col("hub.w").alias("hub_w")).where("hub_c <> c")
            pairs = pairs.where(fits).select("hub", "_id", "hub_w").distinct()
            # A member's best hub settles most of them.
            pairs, m = settle(pairs.groupBy("_id").agg(F.max(F.struct("hub_w", "hub")).alias("best")).select("best.hub", "_id"))
        else:
            size = members.groupBy("key", "c").count().groupBy("key").agg(F.sum("count").alias("all"), F.sum(F.col("count") * F.col("count")).alias("own"))
            if size.agg(F.sum((F.col("all") * F.col("all") - F.col("own")) / 2)).first()[0] <= max(EACH * n, LOOKED):
                pairs, m = settle(_untested(_beside(members, members).where("hub_c <> c and hub < _id").where(fits), tested))
                last = m <= (max(EACH * n, PAIRS) if narrowed == 2 else FEW)
            if not last and narrowed < 2:  # most of those left only share passages
                members, narrowed = _with_strangers(members, sets, share).select(*entry), narrowed + 1
                continue
            if not last:
                place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("w"), F.desc("_id")))
                members, _ = settle(members.withColumn("rank", place))
                pairs, m = settle(_untested(_beside(members.where(F.col("rank") <= each), members, each).where("hub_c <> c").where(fits), tested))
                members, each = members.where(F.col("rank") > each), each * HUBS
        if m:
            new, n_links = links(pairs, sets, share)
            if n_links:
                found.append(new)
                labels = components(reduce(DataFrame.unionAll, found))
            tested.append(pairs)
        if last:
            break
        members = _cells(members.select(*entry), share) if rounds == 1 else members.select(*entry)
    return labels.select(F.col("node").alias("_id"), "component")


def _untested(pairs: DataFrame, tested: list[DataFrame]) -> DataFrame:
    """The distinct pairs (hub, _id) that no table of ``tested`` has; either of a pair may stand first there."""
    pairs = pairs.select(F.greatest("hub", "_id").alias("hub"), F.least("hub", "_id").alias("_id")).distinct()
    for done in tested:
        done = done.select(F.greatest("hub", "_id").alias("hub"), F.least("hub", "_id").alias("_id"))
        pairs = pairs.join(done, ["hub", "_id"], "left_anti")
    return pairs


def jaccard_components(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    small_batches(docs.sparkSession)
    groups = groups_for(text_bytes(docs), BUCKET_BYTES)
    told = docs.mapInArrow(_send_halves(groups), "bucket int, entries binary, info binary").groupBy("bucket").applyInArrow(
        _count_alone(groups), "home int, alone binary, info binary"
    )
    rows, _ = settle(told.groupBy("home").applyInArrow(_sum_alone(groups), _DOCS))
    full = rows.where("n > 0")
    prints = ["print1", "print2", "n"]
    classes = full.groupBy(*prints).agg(F.min(F.struct("_id", "home")).alias("one"), F.min("isolated").alias("isolated"))
    classes, _ = settle(classes.withColumn("node", F.monotonically_increasing_id()))
    wanted = classes.where("n > 2 and not isolated").select(F.col("one.home").alias("home"), F.col("one._id").alias("_id"), *prints, "node")
    texts = docs.mapInArrow(texts_by_home(groups), "home int, texts binary")
    sets = texts.groupBy("home").cogroup(wanted.groupBy("home")).applyInArrow(_sets_of, "_id long, n long, tokens binary")
    sets, _ = settle(sets)
    linked = linked_components(lists(sets), sets, share)
    named = classes.join(linked.withColumnRenamed("_id", "node"), "node", "left")
    named, _ = settle(named.select(*prints, F.col("one._id").alias("_id"), F.coalesce("component", "node").alias("c")))
    named = _joined_by_ids(named, full, prints)
    least = named.groupBy("c").agg(F.min("_id").alias("component"))
    named = named.select(*prints, "c").join(least, "c").drop("c")
    joined = full.select("_id", *prints).join(named, prints).select("_id", "n", "component")
    empty = rows.where("n = 0").select("_id", "n")
    # An empty row goes with other rows of its id.
    others = joined.join(small(empty.select("_id").distinct()), "_id", "left_semi").groupBy("_id").agg(F.min("component").alias("component"))
    empty = empty.join(small(others), "_id", "left").select("_id", "n", F.coalesce("component", "_id").alias("component"))
    known = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return joined.unionAll(empty).select(known("_id").alias("doc_id"), F.col("n").alias("n_shingles"), known("component").alias("component_id"))


def _joined_by_ids(named: DataFrame, full: DataFrame, prints: list[str]) -> DataFrame:
    """``named`` (classes with component ``c``) after components that rows of one id fall in became one."""
    of = F.struct(*prints)
    several, n = settle(full.groupBy("_id").agg(F.min(of).alias("a"), F.max(of).alias("b")).where("a <> b").select("_id"))
    if not n:
        return named
    rows = full.select("_id", *prints).join(F.broadcast(several) if n <= SMALL_ROWS else several, "_id").distinct()
    rows, _ = settle(rows.join(named.select(*prints, "c"), prints).select("_id", "c").distinct())
    least = rows.groupBy("_id").agg(F.min("c").alias("b"))
    edges = rows.join(F.broadcast(least) if n <= SMALL_ROWS else least, "_id").where("c <> b").select(F.col("c").alias("a"), "b").distinct()
    merged = components(edges).select(F.col("node").alias("c"), F.col("component").alias("_to"))
    return named.join(merged, "c", "left").withColumn("c", F.coalesce("_to", "c")).drop("_to")
