"""Hashed maximum-entropy language model: class-factored softmax over n-gram and skip features.

Tokens are the words of a text with A-Z lower-cased, then one end token. Every word has a class, a hash of its last two
letters, and a slot inside the class, a hash of the whole word; the end has a class to itself. So any word, seen or not,
has a place in a model of fixed size, and

    P(word | context) = P(class | context) * P(slot | class, context) * P(word | slot).

The first two are softmaxes whose scores are a fixed bias (the log of the unigram shares of classes and slots) plus one
learnt weight row for each feature of the context: the slot of the word before, that of the word before it (a skip
feature), and the hashed pair of the two. Rows of the second softmax are hashed by (feature, class). The
third factor is ``(c + 1) / (N + V + 1)`` over the training counts of the words that share the slot, the same rule as the
unigram base, and what is left is the slot's unknown words. The probabilities of all words, the end and the unknown
words of all slots sum to one.

The kernels here are NumPy on UTF-8 buffers. A minibatch adds up gradients and takes one Adagrad step. The gradient of a
softmax is what was seen less what the model expects; the expected part is one draw from the model for each token, which
is right on average and touches as few weights as the seen part.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from . import kernels as K

CLASSES = 64
SLOTS = 32
PAIRS = 4096
SHARED = 1 << 15
BATCH = 1 << 11  # tokens of one step; their scores fit the processor's cache
RATE = 0.12
MOST = 20.0
_ALL = CLASSES * SLOTS
START = _ALL  # stands before the first word
END_SLOT = (CLASSES - 1) * SLOTS
END_HASH = np.uint64(0x454E44)
_SKIPS = 2
CLASS_ROWS = _SKIPS * (_ALL + 1) + PAIRS
_UPTO = np.triu(np.ones((8, 8), np.float32))
_BLOCKS = np.repeat(np.eye(8, dtype=np.float32), 8, axis=0)
_letter = K.class_table([*range(48, 58), *range(97, 123), *range(128, 256)])


@dataclass
class Tokens:
    """Tokens of several texts, ends included: text ``i`` has ``first[i]:first[i + 1]``."""

    hash: np.ndarray
    slot: np.ndarray
    first: np.ndarray


@dataclass
class Weights:
    """Fixed biases (class, slot inside class) and learnt rows."""

    class_bias: np.ndarray
    slot_bias: np.ndarray
    by_class: np.ndarray = field(default_factory=lambda: np.zeros((CLASS_ROWS, CLASSES), np.float32))
    by_slot: np.ndarray = field(default_factory=lambda: np.zeros((SHARED, SLOTS), np.float32))


def word_slots(data: np.ndarray, words: K.Words) -> np.ndarray:
    """Slot of every word: the class from its last two letters or digits, found behind closing punctuation."""
    last, low = words.end - 1, words.start
    for _ in range(2):
        step = ~_letter[data[last]] & (last > low)
        last = last - step
    before = np.where(last > low, data[np.maximum(last - 1, 0)], 0).astype(np.uint64)
    tail = K.mix(data[last].astype(np.uint64) | before << np.uint64(8))
    own = words.hash >> np.uint64(40)
    return ((tail % np.uint64(CLASSES - 1)) * np.uint64(SLOTS) + own % np.uint64(SLOTS)).astype(np.int32)


def tokens(data: np.ndarray, at: np.ndarray) -> Tokens:
    low = K.lower_ascii(data)
    words = K.words(low, at)
    n = len(words.start)
    texts = len(at) - 1
    first = words.first + np.arange(texts + 1)
    place = np.ones(n + texts, bool)
    place[first[1:] - 1] = False
    hashes, slots = np.full(n + texts, END_HASH, np.uint64), np.full(n + texts, END_SLOT, np.int32)
    hashes[place] = words.hash
    slots[place] = word_slots(low, words)
    return Tokens(hashes, slots, first)


def features(t: Tokens) -> np.ndarray:
    """Rows of the class table for every token, one array a feature."""
    n = len(t.slot)
    back = []
    for k in range(1, _SKIPS + 1):
        prior = np.full(n, START, np.int32)
        prior[k:] = t.slot[: n - k] if k < n else []
        for j in range(k):  # the first k tokens of every text
            head = t.first[:-1] + j
            prior[head[head < t.first[1:]]] = START
        back.append(prior)
    pair = K.mix(back[0].astype(np.uint64) << np.uint64(32) | back[1].astype(np.uint64)) % np.uint64(PAIRS)
    rows = [prior + k * (_ALL + 1) for k, prior in enumerate(back)]
    return np.stack([*rows, _SKIPS * (_ALL + 1) + pair.astype(np.int32)]).astype(np.int32)


def shared_rows(rows: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Rows of the slot table: the feature's row hashed with the token's class."""
    x = rows.astype(np.uint32) * np.uint32(CLASSES) + own.astype(np.uint32)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    return (x >> np.uint32(17)).astype(np.uint16)


def _scores(table: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of the softmax's scores, and their sums."""
    z = table.take(rows[0], 0)
    for r in rows[1:]:
        z += table.take(r, 0)
    z += bias
    np.exp(z, out=z)  # weights are at most MOST, and biases not above 0
    return z, z @ np.ones(z.shape[1], np.float32) + np.float32(1e-30)


def log_probs(w: Weights, t: Tokens) -> np.ndarray:
    """Natural log of P(class) * P(slot | class) for every token."""
    rows, out = features(t), np.zeros(len(t.slot), np.float64)
    for a in range(0, len(out), BATCH):
        part = slice(a, a + BATCH)
        own, slot = t.slot[part] // SLOTS, t.slot[part] % SLOTS
        z, total = _scores(w.by_class, rows[:, part], w.class_bias)
        out[part] = np.log(np.maximum(z[np.arange(len(own)), own] / total, 1e-30))
        word = np.flatnonzero(own != CLASSES - 1)
        z, total = _scores(w.by_slot, shared_rows(rows[:, part][:, word], own[word]), w.slot_bias.take(own[word], 0))
        out[a + word] += np.log(np.maximum(z[np.arange(len(word)), slot[word]] / total, 1e-30))
    return out


class Learner:
    """Weights that follow one task's texts, with the squared gradients of every weight."""

    def __init__(self, w: Weights, rate: float = RATE, seed: int = 0):
        self.w, self.rate, self.rng = w, rate, np.random.default_rng(seed)
        self.tables = [w.by_class.copy(), w.by_slot.copy()]
        self.seen = [np.full(x.shape, 1.0, np.float32) for x in self.tables]
        self.grad = [np.zeros(x.size, np.float32) for x in self.tables]
        self.mark = [np.zeros(x.size, np.int32) for x in self.tables]

    def _expected(self, k: int, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """One draw for each token from the softmax: a block of 8 by the blocks' sums, then one of the block."""
        z, _ = _scores(self.tables[k], rows, bias)
        n, width = z.shape
        sums = z @ _BLOCKS[:width, : width // 8]
        upto = sums @ _UPTO[: width // 8, : width // 8]
        left = self.rng.random(n, np.float32) * upto[:, -1]
        block = np.minimum((upto < left[:, None]).astype(np.float32) @ np.ones(width // 8, np.float32), width // 8 - 1).astype(np.int64)
        each = np.arange(n)
        left -= upto[each, block] - sums[each, block]
        inside = z.reshape(n, width // 8, 8)[each, block] @ _UPTO
        return block * 8 + np.minimum((inside < left[:, None]).astype(np.float32) @ np.ones(8, np.float32), 7).astype(np.int64)

    def _step(self, k: int, rows: np.ndarray, bias: np.ndarray, target: np.ndarray) -> None:
        """Add what was seen and take off what was drawn."""
        table, seen, grad, mark = self.tables[k].reshape(-1), self.seen[k].reshape(-1), self.grad[k], self.mark[k]
        flat = rows.astype(np.int64) * self.tables[k].shape[1]
        real, drawn = (flat + target).ravel(), (flat + self._expected(k, rows, bias)).ravel()
        np.add.at(grad, real, np.float32(1))
        np.add.at(grad, drawn, np.float32(-1))
        places = np.concatenate([real, drawn])
        order = np.arange(len(places), dtype=np.int32)
        mark[places] = order  # the last of equal places stands for them
        own = places[mark[places] == order]
        g = grad[own]
        grad[own] = 0
        seen[own] += g * g
        table[own] = np.clip(table[own] + self.rate * g / np.sqrt(seen[own]), -MOST, MOST)

    def learn(self, t: Tokens) -> None:
        rows = features(t)
        for a in range(0, len(t.slot), BATCH):
            part = slice(a, a + BATCH)
            own, slot = t.slot[part] // SLOTS, t.slot[part] % SLOTS
            self._step(0, rows[:, part], self.w.class_bias, own)
            word = np.flatnonzero(own != CLASSES - 1)
            if len(word):
                self._step(1, shared_rows(rows[:, part][:, word], own[word]), self.w.slot_bias.take(own[word], 0), slot[word])


def biases(totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logs of the unigram shares of classes and of slots inside them, from the tokens of every slot."""
    n = totals.reshape(CLASSES, SLOTS).astype(float) + 1
    n[-1, 1:] = 0
    of_class = np.log(n.sum(1) / n.sum())
    with np.errstate(divide="ignore"):
        of_slot = np.log(n / n.sum(1, keepdims=True))
    return of_class.astype(np.float32), np.maximum(of_slot, -60).astype(np.float32)


def log_denominators(tokens_of: np.ndarray, words_of: np.ndarray) -> np.ndarray:
    """Log of ``N + V + 1`` of every slot; the end's slot holds nothing else, so its share is one."""
    out = np.log(tokens_of + words_of + 1.0)
    out[END_SLOT] = np.log(tokens_of[END_SLOT] + 1.0)
    return out


class Lookup:
    """Places of hashes in an ascending array of them, by a directory of their leading bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.shift = hashes, np.uint64(64 - max(1, int(len(hashes)).bit_length()))
        self.start = np.searchsorted(hashes >> self.shift, np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each wanted hash, or the number of hashes where it is not among them."""
        out = np.full(len(wanted), len(self.hashes))
        top = (wanted >> self.shift).astype(np.int64)
        at, end, open_at = self.start[top], self.start[top + 1], np.arange(len(wanted))
        while True:
            live = np.flatnonzero(at < end)
            if not len(live):
                return out
            at, end, open_at = at[live], end[live], open_at[live]
            hit = self.hashes[at] == wanted[open_at]
            out[open_at[hit]] = at[hit]
            miss = ~hit
            at, end, open_at = at[miss] + 1, end[miss], open_at[miss]
