"""Prediction by partial matching over bytes: variable-order context trees of several languages, statistics frozen.

A context of up to ``order`` bytes has the counts of the bytes seen after it. A byte's code length in a language starts
at the longest context seen there: with probability c / (n + q) the byte is one of the q seen there, of n in all;
with q / (n + q) it escapes to the context shorter by one byte, where bytes that the longer one knows are excluded.
Below the empty context all bytes that are left are alike. So each context's code lengths sum to one in probability.

As statistics don't change while texts are scored, the code length of a context and a byte is a constant. All languages'
trees are laid out as tables over the union of their grams (context and byte as one integer): one look-up of the longest
gram gives the code lengths of all languages, and only grams that no language has go on to shorter ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

ORDER = 4
#: What a text begins after.
START = b"\n"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


class Index:
    """Places of uint64 keys by open addressing."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys, self.place = np.full(1 << bits, _FREE, np.uint64), np.zeros(1 << bits, np.int32)
        slot, left = (keys * _MIX) >> self.shift, np.arange(len(keys))
        while len(left):
            free = self.keys[slot] == _FREE
            _, first = np.unique(slot[free], return_index=True)
            took = np.flatnonzero(free)[first]
            self.keys[slot[took]], self.place[slot[took]] = keys[left[took]], left[took]
            rest = np.ones(len(left), bool)
            rest[took] = False
            slot, left = (slot[rest] + np.uint64(1)) & self.mask, left[rest]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 of a key that isn't there."""
        slot = (keys * _MIX) >> self.shift
        seen = self.keys[slot]
        out = np.where(seen == keys, self.place[slot], -1)
        left = np.flatnonzero((seen != keys) & (seen != _FREE))
        while len(left):
            slot = (slot if len(slot) == len(left) else slot[left]) + np.uint64(1) & self.mask
            seen, wanted = self.keys[slot], keys[left]
            hit = seen == wanted
            out[left[hit]] = self.place[slot[hit]]
            on = ~hit & (seen != _FREE)
            left, slot = left[on], slot[on]
        return out


def grams(data: np.ndarray, order: int, first: int) -> np.ndarray:
    """The codes of the bytes of data from ``first`` on, each with the ``order`` bytes before it; first >= order."""
    out = data[first:].astype(np.uint64)
    for back in range(1, order + 1):
        out |= data[first - back : len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    return out


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of each of the sorted keys."""
    if not len(keys):
        return keys, values
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(values, first, axis=0)


class Trees:
    """The context trees of languages, in the order of their texts, as tables by order."""

    def __init__(self, texts: Sequence[bytes], order: int = ORDER) -> None:
        """texts: of each language its sample, pieces joined by START * order."""
        self.order, self.size = order, len(texts)
        keys, counts = [], []
        for k in range(order + 1):
            own = [np.unique(grams(np.frombuffer(START * order + t, np.uint8), k, order), return_counts=True) for t in texts]
            every = np.unique(np.concatenate([np.empty(0, np.uint64), *[u for u, _ in own]]))
            table = np.zeros((len(every), len(texts)))
            for j, (u, c) in enumerate(own):
                table[np.searchsorted(every, u), j] = c
            keys.append(every)
            counts.append(table)
        self._freeze(keys, counts)

    def _freeze(self, keys: list[np.ndarray], counts: list[np.ndarray]) -> None:
        log = lambda x: np.log2(np.where(x > 0, x, 1))
        self.grams, self.contexts = [Index(u) for u in keys], []
        #: By context: bits of the escape from it as the longest; bits of an escape, and of a byte before its count, one order lower.
        self.escape, self.escape_below, self.byte_below = [], [], []
        #: By gram: bits from its context as the longest seen (or from the longest of its suffixes that is); bits once its context was escaped from; bits that its count takes off; whether a language has it.
        self.whole, self.after, self.off, self.has = [], [], [], []
        for k, (u, c) in enumerate(zip(keys, counts, strict=True)):
            context, n = _summed(u >> np.uint64(8), c)
            q = _summed(u >> np.uint64(8), (c > 0).astype(np.float64))[1]
            place = np.searchsorted(context, u >> np.uint64(8))
            has, seen = c > 0, n[place] > 0
            self.contexts.append(Index(context))
            self.escape.append(log(n + q) - log(q))
            self.seen = [*getattr(self, "seen", []), n > 0]
            if k == 0:
                below, after = np.zeros_like(n), np.broadcast_to(np.log2(256 - np.minimum(q, 255)), c.shape)
                self.byte_below.append(below)
                self.escape_below.append(below)
                whole = np.where(has, log(n + q)[place] - log(c), self.escape[0][place] + after)
                self.end = np.log2(256 - np.minimum(q, 255))[0] if len(q) else np.full(c.shape[1], 8.0)
                self.start = np.where(n[0] > 0, self.escape[0][0], 0.0) if len(n) else np.zeros(c.shape[1])
            else:
                shorter = np.searchsorted(keys[k - 1], u & np.uint64((1 << 8 * k) - 1))
                parent = np.searchsorted(parents, context & np.uint64((1 << 8 * (k - 1)) - 1))
                excluded = _summed(u >> np.uint64(8), np.where(has, counts[k - 1][shorter], 0))[1]
                new = parent_q[parent] - q
                left = parent_n[parent] - excluded + new
                self.byte_below.append(log(left))
                self.escape_below.append(np.where(new > 0, log(left) - log(new), 0))
                after = np.where(self.has[-1][shorter], self.byte_below[k][place] - self.off[-1][shorter], self.escape_below[k][place] + self.after[-1][shorter])
                whole = np.where(seen, np.where(has, log(n + q)[place] - log(c), self.escape[k][place] + after), self.whole[-1][shorter])
            self.whole.append(whole)
            self.after.append(after)
            self.off.append(log(c))
            self.has.append(has)
            parents, parent_n, parent_q = context, n, q

    def code_lengths(self, data: np.ndarray) -> np.ndarray:
        """Bits of each byte from the order-th on, in each language."""
        code = grams(data, self.order, self.order)
        place = self.grams[self.order].find(code)
        bits = self.whole[self.order][place] if len(self.whole[self.order]) else np.zeros((len(code), self.size))
        if len(rest := np.flatnonzero(place < 0)):
            bits[rest] = self._shorter(code[rest])
        return bits

    def _shorter(self, code: np.ndarray) -> np.ndarray:
        """Bits of grams that no language has whole."""
        bits = np.zeros((len(code), self.size))
        escaped, child = np.zeros(bits.shape, bool), np.zeros(len(code), np.int64)
        rows = np.arange(len(code))  # of those still open
        for k in range(self.order, -1, -1):
            # nobody has the gram of order k: languages that know its context escape from it
            if escaped.any():
                bits[rows] += np.where(escaped, self.escape_below[k + 1][child], 0)
            context = self.contexts[k].find(code >> np.uint64(8))
            known = context >= 0
            first = np.zeros(escaped.shape, bool)
            first[known] = self.seen[k][context[known]] & ~escaped[known]
            if first.any():
                own = np.maximum(context, 0)
                bits[rows] += np.where(first, self.escape[k][own], 0)
            escaped, child = escaped | first, np.maximum(context, 0)
            if k == 0:
                bits[rows] += self.end
                break
            code = code & np.uint64((1 << 8 * k) - 1)
            place = self.grams[k - 1].find(code)
            if len(hit := np.flatnonzero(place >= 0)):
                own, above = place[hit], child[hit]
                late = np.where(self.has[k - 1][own], self.byte_below[k][above] - self.off[k - 1][own], self.escape_below[k][above] + self.after[k - 1][own])
                bits[rows[hit]] += np.where(escaped[hit], late, self.whole[k - 1][own])
            on = np.flatnonzero(place < 0)
            rows, code, escaped, child = rows[on], code[on], escaped[on], child[on]
            if not len(rows):
                break
        return bits

    def text_bits(self, texts: Sequence[bytes], room: int = 1 << 17) -> np.ndarray:
        """Bits of each whole text in each language; ``room`` bytes are worked on at a time."""
        total = np.zeros((len(texts), self.size))
        lead = START * self.order
        data = np.frombuffer(b"".join(x for t in texts for x in (lead, t)), np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        start = np.cumsum(size + self.order) - size  # of each text after its lead
        for low, high in _cuts(len(data), room):
            low = max(low, self.order)
            if high <= low:
                continue
            bits = self.code_lengths(data[low - self.order : high])
            first, last = np.searchsorted(start + size, low, "right"), np.searchsorted(start, high, "left")
            inside = np.arange(first, last)
            inside = inside[size[inside] > 0]
            if len(inside):
                sums = np.concatenate([np.zeros((1, self.size)), np.cumsum(bits, axis=0)])
                total[inside] += sums[np.minimum(start[inside] + size[inside], high) - low] - sums[np.maximum(start[inside], low) - low]
        return total


def _cuts(n: int, room: int) -> Iterator[tuple[int, int]]:
    for low in range(0, n, room):
        yield low, min(n, low + room)
