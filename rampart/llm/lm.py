"""Language-model scores (operator 3): online logistic context mixing over bits.

Text is a chain of tokens: words in lower case A-Z, then one end.  A document's class
is named first, at the cost of log2(CLASSES) bits: the hash of its most frequent word,
so that texts of one language mostly share classes.  The running text is then coded bit
by bit:

* A token that the training texts hold twice or more (FREQUENT of them at most) is a
  leaf of a Huffman tree over these tokens.  One more leaf leads out of the tree: after
  it a token's bytes and a stop are spelled by the bits of a Huffman tree over bytes.
* Predictors are hashed contexts (_CONTEXTS), each with slots of two counts: how often
  the training texts went on with bit 0 and with bit 1 there.  In the tree a context is
  the inner node with the class and up to two tokens before; in the spelling, the
  bytes so far with the class and the token before.  A predictor gives the logit of its
  smoothed share.
* A gate (depth or place, how much the two contexts _SURE have seen) picks the weights that
  combine the logits.  Weights are learned online along the running text, a few words at
  a time, each bit predicted from counts without itself; tasks' weights are averaged.
* The mixed probability is refined by an adaptive map: what share of ones came at a
  gate and coarse probability, by the same leave-one-out predictions.

Every token of every training text is counted, learned from and, of every text, scored.
Spark sums the counts slot by slot; a slot's sums are kept as two levels of a fine
scale (_LEVELS).  The gathered vocabulary grows with the corpus; tree, slots, weights and map are bounded.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm import store
from rampart.llm.labelled import fold
from rampart.llm.tokens import Slots
from rampart.llm.words import U64, Words, mix, slices, words_of

CLASSES = 8
# (in the tree, in the spelling, log2 of slots); all with the node of the tree or byte
_CONTEXTS = (("-", "last 2 bytes, class", 19), ("class", "last 3 bytes, place, class", 21),
             ("token before", "word so far", 22), ("2 tokens before", "word so far, token before", 22))
_SURE = (2, 3)                     # the contexts whose totals choose the gate
PREDICTORS = len(_CONTEXTS)
_BASES = np.concatenate([[0], np.cumsum([1 << b for _, _, b in _CONTEXTS])])
SLOTS = int(_BASES[-1])
_CELL = 1 << 13                    # slots that travel together
FREQUENT = 1 << 18
HELD = 1 << 19                     # tokens a task keeps before it sends them on
TASK_TOKENS = 1 << 24              # running text that one set of slots counts
DEPTHS, PLACES, SEEN, STEPS = 8, 6, 4, 24
GATES = (DEPTHS + PLACES) * SEEN * SEEN      # at most 256
BLOCK, STEP_BITS = 1 << 13, 1 << 12          # tokens, bits learned from together
WINDOW = 1 << 12                   # tokens counted or scored together
NEAR = 4                           # a tree's nodes share a place in memory by so many levels
PRICES = 1 << 11                   # logits from -16 to 16 that the price list tells apart
STOP, END = b" ", b"\n"
U32 = np.uint32


_DEPTH = np.searchsorted([1, 2, 4, 6, 9, 12, 15], np.arange(64), "right")

# the key that stands for the end token in the place of a word's hash
END_KEY = int(mix(np.array([0xE2D], U64))[0].astype(np.int64))

# counts that a slot tells apart: all below 32, then steps of 28 %
_LEVELS = np.concatenate([np.arange(32), np.floor(32 * 1.28 ** np.arange(96))])
_STATE_BITS = 14


def state_of(counts: np.ndarray) -> np.ndarray:
    """The state of each slot: the levels of its zeros and ones."""
    level = np.searchsorted(_LEVELS, counts, "right") - 1
    return (level[:, 0] << 7 | level[:, 1]).astype(np.uint16)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Logits by state, less one zero, less one one, and as they are; the last two bits
    of each tell how much the slot has seen (a millionth of the logit at most)."""
    zero, one = (x.ravel() for x in np.meshgrid(_LEVELS, _LEVELS, indexing="ij"))
    logit, seen = [], []
    for z, o in ((np.maximum(zero - 1, 0), one), (zero, np.maximum(one - 1, 0)), (zero, one)):
        logit.append(np.log((o + 0.2) / (z + 0.2)))
        seen.append((z + o > 0).astype(np.int64) + (z + o > 3) + (z + o > 30))
    logit, seen = np.concatenate(logit).astype(np.float32), np.concatenate(seen)
    logit[logit == 0] = 1e-6                               # with these bits 0 is no normal number, and slow
    return (logit.view(U32) & U32(~3 & 0xFFFFFFFF) | seen.astype(U32)).view(np.float32)


_LOGIT = _tables()


def text_class(w: Words, h: np.ndarray) -> np.ndarray:
    """Class of each text: hash of its most frequent word, ties to the smaller hash;
    0 without words."""
    n = len(w.first) - 1
    out = np.zeros(n, np.int64)
    if not len(h):
        return out
    bits = U64(n.bit_length())                     # of the hash there is room for the others
    both = np.sort(w.row_of().astype(U64) << (U64(64) - bits) | h >> bits)
    new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    count, both = np.diff(np.append(new, len(h))), both[new]
    r = (both >> (U64(64) - bits)).astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
    top = np.flatnonzero(count == np.repeat(np.maximum.reduceat(count, begin), np.diff(np.append(begin, len(r)))))
    top = top[np.concatenate([[True], r[top][1:] != r[top][:-1]])]
    out[r[top]] = ((both[top] << bits) // U64((1 << 64) // CLASSES)).astype(np.int64)
    return out


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, bits, nodes) of each byte's code: bits[byte, i] and the inner node
    where it is decided.  Every byte has a code."""
    heap = [(float(c) + 0.01, b, b) for b, c in enumerate(counts.tolist())]
    heapq.heapify(heap)
    up: dict[int, tuple[int, int]] = {}
    node = 256
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        up[a[2]], up[b[2]] = (node, 0), (node, 1)
        heapq.heappush(heap, (a[0] + b[0], node, node))
        node += 1
    paths = []
    for b in range(256):
        x, path = b, []
        while x in up:
            path.append(up[x])
            x = up[x][0]
        paths.append(path[::-1])
    deep = max(map(len, paths))
    length, bits, nodes = np.array([len(p) for p in paths]), np.zeros((256, deep), np.int8), np.zeros((256, deep), np.int64)
    for b, path in enumerate(paths):
        bits[b, :len(path)] = [x[1] for x in path]
        nodes[b, :len(path)] = [x[0] - 256 for x in path]
    return length, bits, nodes


def tree(counts: np.ndarray) -> np.ndarray:
    """A Huffman code of leaves with these counts: for each its bits behind a leading
    one.  The leading one and the bits before a decision name the inner node."""
    n = len(counts)
    heap = [(float(c) + 0.01, i) for i, c in enumerate(counts.tolist())]
    heapq.heapify(heap)
    up = np.zeros(2 * n - 1, np.int64)
    side = np.zeros(2 * n - 1, np.int64)
    for node in range(n, 2 * n - 1):
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        up[a[1]] = up[b[1]] = node
        side[b[1]] = 1
        heapq.heappush(heap, (a[0] + b[0], node))
    code = np.ones(2 * n - 1, np.int64)
    for x in range(2 * n - 3, -1, -1):
        code[x] = code[up[x]] << 1 | side[x]
    return code[:n]


class Chain:
    """The tokens of the texts of a slice in order, each text's end after its words."""

    def __init__(self, w: Words, h: np.ndarray, cls: np.ndarray):
        texts = len(w.first) - 1
        row = w.row_of()
        at = np.arange(len(w)) + row                       # place of each word in the chain
        self.row = np.repeat(np.arange(texts), w.counts + 1)
        self.key = np.full(len(self.row), END_KEY, np.int64).view(U64)
        self.key[at] = h
        self.data = w.data
        self.start, self.size = np.zeros((2, len(self.row)), np.int64)
        self.start[at], self.size[at] = w.start, w.end - w.start
        self.cls = cls[self.row].astype(U64)
        self.first = w.first + np.arange(texts + 1)        # each text's first token, and the end
        self.before = []
        for k in (1, 2):                                   # 0 before the text
            b = np.zeros(len(self.key), U64)
            b[k:] = self.key[:-k]
            for d in range(k):
                b[np.minimum(self.first[:-1] + d, self.first[1:] - 1)] = 0
            self.before.append(b)


def _turn(x: np.ndarray) -> np.ndarray:
    return (mix(x) >> U64(32)).astype(U32)


def _spread(level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, left) for things with so many decisions each: whose each decision is, and
    how many of that one's follow, itself included."""
    end = np.cumsum(level)
    which = np.repeat(np.arange(len(level)), level)
    return which, end[which] - np.arange(len(which))


def _near(depth, prefix):
    """(how far up, name) of a node in its group: of a group's nodes, NEAR levels of one
    subtree, the slots in one context differ in the last NEAR bits only, which is why
    they are near in memory.  ``prefix`` holds at least the last NEAR - 1 bits before it."""
    up = depth % NEAR
    return up, 1 << up | prefix & ((1 << up) - 1)


class Coder:
    """Tokens as bit decisions with their slots.

    ``keys`` are the hashes of the tree's tokens in ascending order, ``codes`` the codes
    of their leaves and of the way out.  Without a tree every token is spelled."""

    def __init__(self, code, keys: np.ndarray | None = None, codes: np.ndarray | None = None):
        self.length, self.bits, nodes = code
        depth = np.arange(self.bits.shape[1])
        past = np.zeros(self.bits.shape, np.int64)             # the NEAR - 1 bits before
        for k in range(1, NEAR):
            past[:, k:] |= self.bits[:, :-k].astype(np.int64) << (k - 1)
        up, name = _near(depth, past)
        top = np.take_along_axis(nodes, np.broadcast_to(depth - up, nodes.shape), 1)
        self.steps = _packed(_turn(top.astype(U64) + U64(1 << 62)), name, self.bits).ravel()
        self.keys = np.zeros(0, U64) if keys is None else keys
        self.codes = np.ones(1, np.int64) if codes is None else codes
        self.deep = np.floor(np.log2(self.codes)).astype(np.int64)
        self.begin = np.searchsorted(self.keys, np.arange(1 << 18, dtype=U64) << U64(46))
        self._paths = None

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """(first, steps) of all leaves' decisions, one leaf after another, the frequent
        ones first; made where it is first needed, so it does not travel."""
        if self._paths is None:
            order = np.argsort(self.deep, kind="stable")
            first, steps = np.empty_like(self.deep), np.empty(int(self.deep.sum()), U32)
            first[order] = np.cumsum(self.deep[order]) - self.deep[order]
            for i in range(0, len(order), 1 << 14):
                some = order[i:i + (1 << 14)]
                which, left = _spread(self.deep[some])
                depth, code = self.deep[some][which] - left, self.codes[some][which]
                up, name = _near(depth, code >> left)
                group = ((code >> (left + up)) * 0x1E3779B97F4A7C15 >> 24).astype(U32)
                steps[first[some[0]]:][:len(which)] = _packed(group, name, code >> (left - 1) & 1, _DEPTH.take(depth))
            self._paths = first, steps
        return self._paths

    def walk(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owner, step) of the decisions that lead to some leaves."""
        first, steps = self.paths()
        deep = self.deep.take(leaf)
        owner = np.repeat(np.arange(len(leaf)), deep)
        at = (first.take(leaf) + deep - np.cumsum(deep)).take(owner)
        at += np.arange(len(owner))
        return owner, steps.take(at)

    def leaves(self, key: np.ndarray) -> np.ndarray:
        """Leaf of each token; len(keys) is the way out."""
        if not len(self.keys):
            return np.zeros(len(key), np.int64)
        at = self.begin.take(key >> U64(46))                # the first key of these 18 bits
        left = np.flatnonzero(self.keys.take(at, mode="clip") < key)
        while len(left):
            at[left] += 1
            left = left[self.keys.take(at[left], mode="clip") < key[left]]
            left = left[at[left] < len(self.keys)]
        at = np.minimum(at, len(self.keys) - 1)
        return np.where(self.keys.take(at) == key, at, len(self.keys))

    def pieces(self, chain: Chain, i: int, j: int, leaf: np.ndarray, skip: int = 0):
        """(owner, bit, slots[PREDICTORS], place) of the decisions of tokens i to j, a
        bounded number at a time; owners count from the chain's begin.  In the tree the
        first ``skip`` predictors have None for slots."""
        one, two = (b[i:j] for b in chain.before)
        cls, leaf = chain.cls[i:j], leaf[i:j]
        if len(self.keys):
            owner, step = self.walk(leaf)
            if len(owner):
                slots = self.tree_slots(owner, step, cls, one, two, range(skip, PREDICTORS))
                yield owner + i, step & U32(1), [None] * skip + slots, (step >> U32(NEAR + 1)).astype(np.uint8) & np.uint8(DEPTHS - 1)
        out = np.flatnonzero(leaf == len(self.keys))
        if len(out):
            size = chain.size[i:j][out]
            for a, b in _runs(size + 1, 1 << 13):
                yield from self._spelling(chain, i, out[a:b], size[a:b], cls, one)

    def tree_slots(self, owner, step, cls, one, two, which):
        """Slots of the predictors ``which`` for steps in the tree."""
        contexts = (lambda: None, lambda: _turn(cls + U64(1)), lambda: _turn(one ^ U64(0x51)), lambda: _turn(mix(one) + two))
        return self._slots([(k, contexts[k]()) for k in which], owner, step)

    def _spelling(self, chain, i, out, size, cls, one):
        """The bytes and stops of tokens ``out``; an end is its own stop."""
        first = np.cumsum(size + 1) - size - 1
        owner = np.repeat(np.arange(len(out)), size + 1)
        place = np.arange(len(owner)) - first[owner]
        data = np.full(len(owner), STOP[0], np.int64)
        inside = place < size[owner]
        data[inside] = chain.data[(chain.start[i:][out][owner] + place)[inside]]
        data[first[size == 0]] = END[0]
        yield from self.spelled(data, size + 1, cls[out], one[out], out + i)

    def spelled(self, data, size, cls, one, names):
        """(owner, bit, slots, place) of the bytes of some tokens, called ``names``, each
        of ``size`` bytes, of class ``cls`` and after token ``one``."""
        first = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(data)) - first[owner]
        cls, one, names = cls[owner], one[owner], names[owner]

        def back(k):
            x = np.zeros(len(data), np.int64)
            x[k:] = data[:-k]
            x[place < k] = 0
            return x.astype(U64)

        b1, b2, b3 = (back(k) for k in (1, 2, 3))
        pw, iv = _powers(len(data) + 1)
        acc = np.zeros(len(data) + 1, U64)
        np.cumsum(mix(data.astype(U64) + U64(1)) * pw[:len(data)], out=acc[1:])
        so_far = mix((acc[:-1] - acc[first[owner]]) * iv[first[owner]] + place.astype(U64) + U64(1 << 33))
        near = np.minimum(place, PLACES - 1)
        last2 = b2 << U64(8) | b1 | (cls + U64(1)) << U64(32)
        contexts = [_turn(c) for c in (last2 | U64(1 << 41), last2 | b3 << U64(16) | near.astype(U64) << U64(42), so_far, so_far + mix(one))]
        near = (DEPTHS + near).astype(np.uint8)
        for a in range(0, len(data), 1 << 14):               # a long word has many
            part = data[a:a + (1 << 14)]
            deep = self.length[part]
            end = np.cumsum(deep)
            which = np.repeat(np.arange(a, a + len(part)), deep)
            at = np.repeat(part * self.bits.shape[1] + deep - end, deep)
            at += np.arange(len(at))
            step = self.steps.take(at)
            yield names.take(which), step & U32(1), self._slots(list(enumerate(contexts)), which, step), near.take(which)

    @staticmethod
    def _slots(contexts, which, step):
        """Slots by the hash of context and group, the last bits turned by the name."""
        group, name = step >> U32(NEAR + 4), step >> U32(1) & U32((1 << NEAR) - 1)
        out = []
        for k, c in contexts:
            s = group * U32(0x9E3779B1) if c is None else (c.take(which) ^ group) * U32(0x9E3779B1)
            s >>= U32(32 - _CONTEXTS[k][2])
            s ^= name
            out.append(s)
        return out


def _packed(group, name, bit, depth=0) -> np.ndarray:
    """A decision in 32 bits: the group's hash, the class of depth, the name, the bit."""
    low = (np.asarray(depth) << NEAR | name) << 1 | bit
    return group >> U32(NEAR + 4) << U32(NEAR + 4) | low.astype(U32)


def _aligned(n: int, dtype) -> np.ndarray:
    """Zeros that begin where a line of memory does, so that a group's slots share lines."""
    raw = np.zeros(n * np.dtype(dtype).itemsize + 128, np.uint8)
    return raw[-raw.ctypes.data % 128:][:n * np.dtype(dtype).itemsize].view(dtype)


def _runs(size: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Neighbours of about ``limit`` together, one at least."""
    end, i = np.cumsum(size), 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(end, (end[i - 1] if i else 0) + limit, "right")))
        yield i, j
        i = j


def _powers(n: int):
    from rampart.llm import words
    if n <= len(words._POW):
        return words._POW, words._INV
    return words._powers(words._BASE, n), words._powers(words._INVERSE, n)


_ROWS = np.arange(PREDICTORS + 1)[:, None] * GATES


class Mixer:
    """States of all slots, weights of all gates and the adaptive map."""

    def __init__(self, code, counts: np.ndarray, keys: np.ndarray | None = None, codes: np.ndarray | None = None):
        """``counts``: SLOTS x 2, or the states of the slots."""
        self.coder = Coder(code, keys, codes)
        self.states = counts if counts.ndim == 1 else state_of(counts)
        self.weights = np.full((PREDICTORS + 1, GATES), 0.25, np.float32)
        self.weights[-1] = 0
        self.map = np.zeros((GATES, STEPS, 2))
        self.prices = None

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.states, sent = _aligned(SLOTS, np.uint16), self.states
        self.states[:] = sent

    def inputs(self, bit, slots, place, without: bool):
        """Logits of the predictors and the gates; ``without`` takes them from counts
        without each bit itself."""
        x = np.empty((PREDICTORS + 1, len(bit)), np.float32)
        x[-1] = 0.3                                        # a gate's own lean
        turn, gate = bit.astype(np.uint16) << np.uint16(_STATE_BITS), place * np.uint8(SEEN * SEEN)
        logit = _LOGIT if without else _LOGIT[2 << _STATE_BITS:]
        for i, s in enumerate(slots):
            state = self.states[_BASES[i]:_BASES[i + 1]].take(s, mode="clip")
            if without:
                state += turn
            logit.take(state, out=x[i], mode="clip")
            if i in _SURE:
                gate += (x[i].view(U32) & U32(3)).astype(np.uint8) * np.uint8(SEEN if i == _SURE[0] else 1)
        return x, gate.astype(np.intp)

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        z = self.weights[-1].take(gate)
        z *= x[-1]
        # a gate's weights in one reading
        w = np.ascontiguousarray(self.weights[:-1].T).view(np.complex128).ravel().take(gate).view(np.float32)
        for i in range(PREDICTORS):
            z += w[i::PREDICTORS] * x[i]
        return np.clip(z, -16, 16, out=z)

    def fresh(self) -> Mixer:
        """A mixer with the same states that has learned nothing."""
        out = Mixer.__new__(Mixer)
        out.__dict__.update(self.__dict__)
        out.weights, out.map, out.prices = self.weights.copy(), self.map.copy(), None
        return out

    def learn(self, chain: Chain, mass: np.ndarray, after: bool = False) -> None:
        """Online steps along the running text: the bits of a few words are predicted,
        noted in the adaptive map (at first only if ``after``, which moves no weights),
        and then move their gates' weights along their error.  ``mass`` counts the bits
        learned from by gate."""
        self.prices = None
        leaf = self.coder.leaves(chain.key)
        for i in range(0, len(leaf), BLOCK):
            done = mass.sum()
            rate, note = 0.0 if after else max(0.1 / (1 + done / 2e6), 0.005), after or done > 1 << 18
            for _, bit, slots, place in self.coder.pieces(chain, i, min(i + BLOCK, len(leaf)), leaf):
                inputs, gates = self.inputs(bit, slots, place, True)
                logits = []
                for a in range(0, len(bit), STEP_BITS):
                    x, gate, b = inputs[:, a:a + STEP_BITS], gates[a:a + STEP_BITS], bit[a:a + STEP_BITS]
                    z = self.mixed(x, gate)
                    logits.append(z)
                    if after:
                        continue
                    error = b.astype(np.float32) - 1 / (1 + np.exp(-z))
                    here = np.bincount(gate, minlength=GATES)
                    mass += here
                    along = np.bincount((gate + _ROWS).ravel(), weights=(x * error).ravel(), minlength=self.weights.size)
                    self.weights += along.reshape(self.weights.shape) * (rate / np.maximum(here, 32))
                if note:
                    at = (gates * STEPS + _step(np.concatenate(logits))) * 2 + bit
                    self.map += np.bincount(at, minlength=self.map.size).reshape(self.map.shape)

    def priced(self, bit, slots, place) -> np.ndarray:
        """Natural log of the probability of each bit."""
        x, gate = self.inputs(bit, slots, place, False)
        z = self.mixed(x, gate)
        z += np.float32(16)
        z *= np.float32(PRICES / 32)
        at = z.astype(np.int32)
        np.minimum(at, PRICES - 1, out=at)
        at <<= 1
        at |= bit.view(np.int32)
        gate *= 2 * PRICES
        gate += at
        return self.price_list().take(gate)

    def price_list(self) -> np.ndarray:
        """Natural log of the probability of a bit, by gate, logit and bit."""
        if self.prices is None:
            z = np.tile((np.arange(PRICES, dtype=np.float64) + 0.5) * (32 / PRICES) - 16, GATES)
            noted = np.repeat(np.arange(GATES), PRICES) * STEPS + _step(z)
            ones, mass = self.noted()
            p = np.clip((ones.take(noted) + 50 / (1 + np.exp(-z))) / mass.take(noted), 1e-6, 1 - 1e-6)
            self.prices = np.log(np.stack([1 - p, p], 1)).astype(np.float32).ravel()
        return self.prices

    def noted(self):
        """(ones, all and the weight of the mixed probability) of the adaptive map."""
        return self.map[:, :, 1].ravel(), (self.map.sum(2) + 50).ravel()

    def score(self, chain: Chain, leaf: np.ndarray, texts: int) -> np.ndarray:
        """Natural log of the probability of each text's tokens, given its class."""
        out = np.zeros(texts)
        for i in range(0, len(leaf), WINDOW):
            for owner, *rest in self.coder.pieces(chain, i, min(i + WINDOW, len(leaf)), leaf):
                a, b = chain.row[owner[0]], chain.row[owner[-1]] + 1      # owners come in order
                ends = np.searchsorted(owner, chain.first[a:b + 1])
                some = np.flatnonzero(np.diff(ends))
                out[a + some] += np.add.reduceat(self.priced(*rest), ends[some])
        return out

    def costs(self, words: list[bytes], classes: np.ndarray) -> np.ndarray:
        """Natural log of the probability of spelling each of these bytes at a text's
        begin, whatever the last of them is."""
        size = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        out, none = np.zeros(len(words)), np.zeros(len(words), U64)
        for piece in self.coder.spelled(data, size, classes.astype(U64), none, np.arange(len(words))):
            out += np.bincount(piece[0], weights=self.priced(*piece[1:]), minlength=len(words))
        return out


def _step(z: np.ndarray) -> np.ndarray:
    return np.clip(((z + 9) * (STEPS / 18)).astype(np.int64), 0, STEPS - 1)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words, Chain]]:
    for batch in batches:
        for part in slices(batch):
            w = words_of(part.column("text"), lower=True)
            h = w.hashes()
            yield part, w, Chain(w, h, text_class(w, h))


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, byte, n): how often the task met each token (byte -1) and each byte (key
    0) of a word, stop or end."""
    slot, keys, met = Slots(), [], 0
    count, octets = np.zeros(1 << 16, np.int64), np.zeros(256, np.int64)

    def rows(key, byte, n):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(byte.astype(np.int32)), pa.array(n)], ["key", "byte", "n"])

    def send():
        return rows(np.concatenate(keys).view(np.int64), np.full(met, -1), count[:met])

    for batch in batches:
        for part in slices(batch):
            w = words_of(part.column("text"), lower=True)
            octets += np.bincount(w.data, minlength=256)
            octets[STOP[0]] += len(w)
            octets[END[0]] += len(part)
            found, n = np.unique(np.concatenate([w.hashes(), np.full(len(part), END_KEY, np.int64).view(U64)]), return_counts=True)
            at = slot.find(found)
            new = np.flatnonzero(at < 0)
            at[new] = np.arange(met, met + len(new))
            slot.add(found[new], at[new])
            keys.append(found[new])
            met += len(new)
            while met > len(count):
                count = np.concatenate([count, np.zeros(len(count), np.int64)])
            count[at] += n
            if met > HELD:
                yield send()
                slot, keys, met, count = Slots(), [], 0, np.zeros(1 << 16, np.int64)
    if met:
        yield send()
        yield rows(np.zeros(256, np.int64), np.arange(256), octets)


def _slot_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the cells of a run that is sorted by cell; (cell, states of its slots)."""
    def done(cell, total):
        return pa.RecordBatch.from_arrays([pa.array([cell], pa.int64()), pa.array([state_of(total.reshape(-1, 2)).tobytes()], pa.binary())],
                                          ["cell", "v"])

    cell, total = None, None
    for b in batches:
        for k, v in zip(b.column("cell").to_pylist(), b.column("v").to_pylist()):
            if k != cell:
                if cell is not None:
                    yield done(cell, total)
                cell, total = k, np.zeros(_CELL * 2, np.int64)
            total += np.ascontiguousarray(np.frombuffer(v, np.uint8).reshape(4, -1).T).view(U32).ravel()
    if cell is not None:
        yield done(cell, total)


def train(texts: DataFrame, code, keys: np.ndarray, codes: np.ndarray, tokens: int):
    """(mixer, broadcast of the mixer before it learned) of the running text of
    ``texts`` (text), which hold ``tokens`` tokens."""
    context = texts.sparkSession.sparkContext
    texts = texts.coalesce(max(context.defaultParallelism, tokens // TASK_TOKENS))
    sent = context.broadcast((code, keys, codes))

    def slot_counts(batches):
        coder, out = Coder(*sent.value), _aligned(SLOTS * 2, U32)
        parts = [out[2 * _BASES[k]:2 * _BASES[k + 1]] for k in range(PREDICTORS)]
        met = np.zeros(CLASSES * len(coder.codes), U32)      # leaves by class: all that the first two contexts need in the tree

        def count(slots, bit, n):
            for part, s in zip(parts, slots):
                if s is not None:
                    np.add.at(part, (s << U32(1) | bit).astype(np.int64), n)

        for _, _, chain in _chains(batches):
            leaf = coder.leaves(chain.key)
            np.add.at(met, chain.cls.astype(np.int64) * len(coder.codes) + leaf, U32(1))
            for i in range(0, len(leaf), WINDOW):
                for _, bit, slots, _ in coder.pieces(chain, i, min(i + WINDOW, len(leaf)), leaf, skip=2):
                    count(slots, bit, U32(1))
        if len(coder.keys):
            some = np.flatnonzero(met)
            for i in range(0, len(some), WINDOW):
                cls, leaf = np.divmod(some[i:i + WINDOW], len(coder.codes))
                owner, step = coder.walk(leaf)
                count(coder.tree_slots(owner, step, cls.astype(U64), None, None, range(2)), step & U32(1), met[some[i:i + WINDOW]].take(owner))
        cells = out.reshape(-1, _CELL * 2)
        used = np.flatnonzero(cells.any(1))
        for i in range(0, len(used), 64):                    # low bytes first, high bytes, mostly 0, last
            some = [cells[k].view(np.uint8).reshape(-1, 4).T.tobytes() for k in used[i:i + 64]]
            yield pa.RecordBatch.from_arrays([pa.array(used[i:i + 64]), pa.array(some, pa.binary())], ["cell", "v"])

    sums = texts.mapInArrow(slot_counts, "cell long, v binary").repartition("cell").sortWithinPartitions("cell") \
        .mapInArrow(_slot_sums, "cell long, v binary").toArrow()           # SLOTS numbers, whatever the input
    states = np.zeros((SLOTS // _CELL, _CELL), np.uint16)
    for k, v in zip(sums.column("cell").to_pylist(), sums.column("v").to_pylist()):
        states[k] = np.frombuffer(v, np.uint16)
    mixer = Mixer(code, states.ravel(), keys, codes)
    sent.unpersist()
    sent = context.broadcast(mixer)

    def one_pass(batches):
        m, mass, last = sent.value.fresh(), np.zeros(GATES, np.int64), None
        for _, _, last in _chains(batches):
            m.learn(last, mass)
        if mass.any() and not m.map.any():       # a short run: note it all, after its steps
            m.learn(last, mass, after=True)
        got = np.concatenate([(m.weights * mass).ravel(), mass, m.map.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(got))), pa.array(got)], ["i", "v"])

    got = np.zeros(mixer.weights.size + GATES + mixer.map.size)
    for r in texts.mapInArrow(one_pass, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():   # a fixed size
        got[r["i"]] = r["v"]
    weights, mass, noted = np.split(got, [mixer.weights.size, mixer.weights.size + GATES])
    weights, known = weights.reshape(mixer.weights.shape), mass > 0
    mixer.weights[:, known] = weights[:, known] / mass[known]
    mixer.map = noted.reshape(mixer.map.shape)
    return mixer, sent


def grade(n: str):
    """Four grades for each doubling of a count."""
    return F.floor(F.log2(F.col(n) + 1) * 4).cast("int")


def frequent_from(costs: DataFrame) -> int:
    """The lowest grade from which on at most FREQUENT rows are left; rows per grade,
    a few hundred at most, are all that reaches the driver."""
    sizes = {r["g"]: r["count"] for r in costs.groupBy(grade("n").alias("g")).count().collect()}
    least, rows = max(sizes, default=0) + 1, 0
    while least - 1 in range(max(sizes, default=0) + 1) and rows + sizes.get(least - 1, 0) <= FREQUENT:
        least -= 1
        rows += sizes.get(least, 0)
    return least


def scores(docs: DataFrame, is_training, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of
    every row of ``docs``, with a model of the rows that ``is_training`` (a condition
    on the column ``id``) picks.

    base_score is the sum over tokens of log10((c + 0.1) / (N + 0.1 * (V + 1))).  A
    null or empty text is the end token alone.  A null id is not trained on.  Repeated
    rows count, and are scored, as often as they occur.  Other columns of ``docs`` are
    not looked at.  Without training rows N and V are 0 and every token is spelled."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = docs.where(is_training).select("text")
    raw = texts.mapInArrow(_vocabulary, "key long, byte int, n long")
    both = store.write(raw.groupBy("key", "byte").agg(F.sum("n").alias("n")), "vocabulary")
    octets = np.zeros(256)
    for r in both.where("byte >= 0").collect():
        octets[r["byte"]] = r["n"]
    octets[[9, 10, 11, 12, 13, 32]] = 0, octets[10], 0, 0, 0, octets[32]
    vocab = both.where("byte < 0").select("key", F.col("n").alias("c"))
    n_all, v_all = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    head = vocab.where((grade("c") >= frequent_from(vocab.withColumnRenamed("c", "n"))) & (F.col("c") > 1)).toArrow()
    keys = np.asarray(head.column("key").combine_chunks()).view(U64)
    order = np.argsort(keys)
    keys, known = keys[order], np.asarray(head.column("c").combine_chunks())[order]
    mixer, sent = train(texts, huffman(octets), keys, tree(np.append(known, n_all - known.sum())), n_all)
    learned = spark.sparkContext.broadcast((known, mixer.weights, mixer.map))
    floor = float(n_all) + 0.1 * (v_all + 1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value.fresh()
        counts, m.weights, m.map = learned.value
        rid = TaskContext.get().partitionId() << 36
        for part, w, chain in _chains(batches):
            rows, row = len(part), chain.row
            leaf = m.coder.leaves(chain.key)
            hit = leaf < len(counts)
            sums = [np.bincount(row[hit], minlength=rows),
                    np.bincount(row[hit], weights=np.log10((counts[leaf[hit]] + 0.1) / floor), minlength=rows).astype(float),
                    m.score(chain, leaf, rows)]
            r, k = row[~hit], chain.key[~hit]
            order = np.lexsort((k, r))
            r, k = r[order], k[order]
            new = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])])[:len(r)])
            rest = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(r[new], np.arange(rows + 1)).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(k[new].view(np.int64)),
                                            pa.array(np.diff(np.append(new, len(r))).astype(np.int64))], ["key", "m"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid + np.arange(rows)), part.column("id"), pa.array(w.counts + 1),
                 pa.array(np.bincount(row, weights=chain.size + 1, minlength=rows).astype(np.int64)),
                 *(pa.array(x) for x in sums), rest], ["rid", "id", "n_tokens", "n_bytes", "known", "base", "cost", "rest"])
            rid += rows

    kind = docs.schema["id"].dataType.simpleString()
    part = store.write(docs.mapInArrow(
        scan, f"rid long, id {kind}, n_tokens long, n_bytes long, known long, base double, cost double, "
              "rest array<struct<key:long,m:long>>"), "scanned")
    c = F.coalesce("c", F.lit(0))
    tail = part.select("rid", F.inline("rest")).join(vocab, "key", "left").groupBy("rid").agg(
        F.sum(F.when(c > 0, F.col("m")).otherwise(0)).alias("known2"),
        F.sum(F.col("m") * F.log10((c + 0.1) / F.lit(floor))).alias("base2"))
    out = part.drop("rest").join(tail, "rid", "left").select(
        F.col("id").alias(id_col), "n_tokens", "n_bytes", (F.col("known") + F.coalesce("known2", F.lit(0))).alias("n_known"),
        F.lit(int(n_all)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("base2", F.lit(0.0))).alias("base_score"),
        (F.col("cost") / F.lit(float(np.log(10))) - F.lit(float(np.log10(CLASSES)))).alias("score"))
    return out.withColumn("bits_per_byte", -F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).drop("n_bytes")


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = scores(docs, fold("id", 10) != 0)
    return out.withColumn("held_out", F.coalesce(fold("doc_id", 10) == 0, F.lit(False)))
