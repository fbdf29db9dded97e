"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The vocabulary (pieces, scores, byte pieces) is read from a model file. An automaton over the pieces' bytes, failure
transitions filled in, moves one state a byte; at each byte the output links of the state name every piece that ends
there, longest first, and each relaxes the best score of that place. A character that is no piece costs the lowest score
less 10 and becomes byte pieces. The best path has the highest sum of scores; of equal ones the one whose last piece
is longest, from the end backwards.

Text is taken as it is, with one blank put in front; blanks are the pieces' word marks. No piece of the vocabulary goes
on after a letter and a blank, so the path is found for each distinct stretch of blanks and letters of a batch once, all
stretches in step. A vocabulary for which this does not hold is walked text by text. Decoding joins the pieces' bytes
and drops the first blank; every row is decoded and compared, and ``round_trip`` says whether it came back.

Rows: a null text has null ids and counts; an empty one has no ids. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import small_batches
from . import kernels as K

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_COST = 10.0
MARK = "▁"
SLICE = 1 << 19
_CELLS = 1 << 20


@dataclass
class Vocabulary:
    ids: np.ndarray  # of the pieces that text is matched with
    pieces: list[bytes]  # their bytes, with blanks for word marks
    scores: np.ndarray
    byte_ids: np.ndarray  # id of the piece of each byte value
    size: int


def load(model_file: str = MODEL_FILE) -> Vocabulary:
    """Read a model that has a piece for every byte; runs on the driver, the result goes to tasks as a broadcast variable."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=model_file)
    byte_ids, ids, pieces, scores = np.full(256, -1, np.int32), [], [], []
    for i in range(p.get_piece_size()):
        if p.is_byte(i):
            byte_ids[int(p.id_to_piece(i)[3:5], 16)] = i
        elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
            ids.append(i)
            pieces.append(p.id_to_piece(i).replace(MARK, " ").encode())
            scores.append(p.get_score(i))
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary lacks byte pieces")
    return Vocabulary(np.array(ids, np.int32), pieces, np.array(scores), byte_ids, p.get_piece_size())


class Automaton:
    """Transitions (state x class of bytes), the first output state of each state, and the next one after it.

    Bytes that no piece holds share one column, and states are numbered in 16 bits where they fit, so the table is a third
    of a dense one. It is built once, on the driver, and goes to tasks as a broadcast variable.
    """

    def __init__(self, v: Vocabulary):
        children: list[dict[int, int]] = [{}]
        piece_at: dict[int, int] = {}
        for k, piece in enumerate(v.pieces):
            state = 0
            for byte in piece:
                state = children[state].setdefault(byte, len(children)) if byte not in children[state] else children[state][byte]
                if state == len(children):
                    children.append({})
            piece_at[state] = k
        n = len(children)
        used = np.zeros(256, bool)
        used[list({b for p in v.pieces for b in p})] = True
        self.column = np.where(used, np.cumsum(used), 0).astype(np.int16)  # 0: bytes of no piece
        self.go = np.zeros((n, int(used.sum()) + 1), np.uint16 if n <= 1 << 16 else np.int32)
        fail = np.zeros(n, np.int32)
        self.piece = np.full(n, -1, np.int32)
        for state, k in piece_at.items():
            self.piece[state] = k
        self.out = np.zeros(n, np.int32)
        self.next = np.zeros(n, np.int32)
        level = [0]
        while level:
            below = []
            for state in level:
                link = fail[state]
                if state:
                    self.go[state] = self.go[link]
                    self.next[state] = self.out[link]
                    self.out[state] = state if self.piece[state] >= 0 else self.out[link]
                for byte, child in children[state].items():
                    fail[child] = self.go[link, self.column[byte]] if state else 0
                    self.go[state, self.column[byte]] = child
                    below.append(child)
            level = below
        self.length = np.array([len(p) for p in v.pieces], np.int32)
        self.scores = v.scores
        self.unknown = float(v.scores.min()) - UNKNOWN_COST
        self.ids, self.byte_ids = v.ids, v.byte_ids
        self.alone = ~used[:128]  # ASCII bytes of no piece stand by themselves
        self.splits = not any(b" " in p.lstrip(b" ") for p in v.pieces)
        size = np.ones(v.size, np.int64)
        size[v.ids] = self.length
        start = np.concatenate([[0], np.cumsum(size)])
        body = bytearray(int(start[-1]))
        for byte, i in enumerate(v.byte_ids):
            body[start[i]] = byte
        for i, piece in zip(v.ids, v.pieces):
            body[start[i] : start[i] + len(piece)] = piece
        self.body, self.body_start, self.body_size = np.frombuffer(bytes(body), np.uint8), start[:-1], size


def _viterbi(a: Automaton, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every stretch, one after the other, and how many each has. ``length`` does not increase."""
    n, longest = len(start), int(length[0])
    best = np.full((n, longest + 1), -np.inf)
    best[:, 0] = 0
    back = np.full((n, longest + 1), -1, np.int32)
    state = np.zeros(n, np.int32)
    char = np.zeros(n, np.int32)  # where the character at hand began
    for t in range(longest):
        k = int(np.searchsorted(-length, -t, "left"))  # stretches longer than t
        rows = np.arange(k)
        byte = data[start[:k] + t]
        state[:k] = a.go[state[:k], a.column[byte]]
        follow = np.zeros(k, np.uint8)
        more = length[:k] > t + 1
        follow[more] = data[start[:k][more] + t + 1]
        ended = (follow & 0xC0) != 0x80
        top, by = np.full(k, -np.inf), np.full(k, -1, np.int32)
        single = np.zeros(k, bool)
        out, live = a.out[state[:k]], rows
        while True:
            hit = out > 0
            if not hit.any():
                break
            live, out = live[hit], out[hit]
            piece = a.piece[out]
            size = a.length[piece]
            score = best[live, t + 1 - size] + a.scores[piece]
            single[live] |= size == t + 1 - char[live]
            better = score > top[live]
            top[live[better]], by[live[better]] = score[better], piece[better]
            out = a.next[out]
        lone = np.flatnonzero(ended & ~single)
        score = best[lone, char[lone]] + a.unknown
        better = score > top[lone]
        top[lone[better]], by[lone[better]] = score[better], -1
        done = np.flatnonzero(ended)
        best[done, t + 1], back[done, t + 1] = top[done], by[done]
        char[done] = t + 1
    place, live = length.astype(np.int64), np.arange(n)
    counts, steps = np.zeros(n, np.int64), []
    while len(live):
        piece = back[live, place[live]]
        byte = piece < 0
        found = a.ids[piece]
        found[byte] = a.byte_ids[data[start[live[byte]] + place[live[byte]] - 1]]
        steps.append((live, found))
        counts[live] += 1
        place[live] -= np.where(byte, 1, a.length[piece])
        live = live[place[live] > 0]
    first = np.concatenate([[0], np.cumsum(counts)])
    ids = np.empty(int(first[-1]), np.int32)
    for k, (rows, found) in enumerate(steps):
        ids[first[rows + 1] - 1 - k] = found
    return ids, counts


def _stretches(a: Automaton, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each stretch that is encoded on its own, and the first stretch of each text."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    if a.splits and n:
        blank = data == 32
        cut[1:n] |= blank[1:] & ~blank[:-1]
        alone = np.zeros(256, bool)
        alone[:128] = a.alone
        lone = np.flatnonzero(alone[data])
        cut[lone] = True
        cut[lone + 1] = True
    start = np.flatnonzero(cut[:n])
    return start, np.searchsorted(start, at)


def encode(a: Automaton, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts that already have their first blank, and the bounds of each text's ids."""
    start, first = _stretches(a, data, at)
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(len(at), np.int64)
    end = np.append(start[1:], len(data))
    h = K.span_hash(data, start, end)
    _, one, which = np.unique(h, return_index=True, return_inverse=True)
    s, length = start[one], end[one] - start[one]
    order = np.argsort(-length, kind="stable")
    s, length = s[order], length[order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    parts, counts, k = [], [], 0
    while k < len(s):
        stop = min(len(s), k + max(1, _CELLS // (int(length[k]) + 1)))
        ids, count = _viterbi(a, data, s[k:stop], length[k:stop])
        parts.append(ids)
        counts.append(count)
        k = stop
    ids, counts = np.concatenate(parts), np.concatenate(counts)
    own = np.concatenate([[0], np.cumsum(counts)])
    use = rank[which]
    n = counts[use]
    out = np.concatenate([[0], np.cumsum(n)])
    flat = ids[np.repeat(own[use] - out[:-1], n) + np.arange(out[-1])]
    return flat, out[first]


def decode(a: Automaton, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every row of ids, its first blank dropped, and the bounds of each row."""
    size = a.body_size[ids]
    out = np.concatenate([[0], np.cumsum(size)])
    data = a.body[np.repeat(a.body_start[ids] - out[:-1], size) + np.arange(out[-1])]
    at = out[bounds]
    keep = np.ones(len(data), bool)
    keep[at[:-1][np.diff(at) > 0]] = False
    return data[keep], at - np.concatenate([[0], np.cumsum(np.diff(at) > 0)])


def with_blank(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A blank in front of every text that is not empty."""
    held = np.diff(at) > 0
    more = np.concatenate([[0], np.cumsum(held)])
    out = np.full(len(data) + int(more[-1]), 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(more[1:], np.diff(at))] = data
    return out, at + more


def encode_texts(a: Automaton, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, bounds, and whether each text decodes to itself.

    Stretches are told apart by 64-bit hashes; a text that two stretches with one hash would spoil is encoded again alone.
    """
    ids, bounds = encode(a, *with_blank(data, at))
    back, where = decode(a, ids, bounds)
    if np.array_equal(where, at) and np.array_equal(back, data):
        return ids, bounds, np.ones(len(at) - 1, bool)
    if len(at) == 2:
        return ids, bounds, np.zeros(1, bool)
    parts = [encode_texts(a, data[x:y], np.array([0, y - x])) for x, y in zip(at[:-1], at[1:])]
    return (
        np.concatenate([p[0] for p in parts]),
        np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])]),
        np.concatenate([p[2] for p in parts]),
    )


def _encode(shared):
    def run(batches):
        a = shared.value
        for whole in batches:
            for batch in K.slices(whole, "text", SLICE):
                column = batch.column(1)
                ids, bounds, same = encode_texts(a, *K.utf8(column))
                valid = np.asarray(column.is_valid())
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32), mask=np.append(~valid, False)), pa.array(ids))
                counts = pa.array(np.diff(bounds), mask=~valid)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), counts, lists, pa.array(same, mask=~valid)], names=["doc_id", "n_tokens", "ids", "round_trip"]
                )
        K.give_back()

    return run


def tokenize(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) for every row; whole texts are encoded."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(vocabulary))
    K.give_back()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_encode(shared), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def _decode(shared):
    def run(batches):
        a = shared.value
        for batch in batches:
            lists = batch.column(1)
            lists = lists.fill_null([]) if lists.null_count else lists
            at = lists.offsets.to_numpy().astype(np.int64)
            data, where = decode(a, lists.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]], at - at[0])
            body = pa.py_buffer(data.tobytes())
            text = pa.Array.from_buffers(pa.large_string(), len(lists), [None, pa.py_buffer(where.astype(np.int64).tobytes()), body])
            text = pc.if_else(batch.column(1).is_valid(), text, pa.scalar(None, pa.large_string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), text.cast(pa.string())], names=["doc_id", "text"])

    return run


def detokenize(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give a null text."""
    shared = rows.sparkSession.sparkContext.broadcast(Automaton(vocabulary))
    return rows.select("doc_id", "ids").mapInArrow(_decode(shared), "doc_id long, text string")
