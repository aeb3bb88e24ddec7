"""A suffix automaton over several word sequences, with weighted occurrence counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


class SuffixAutomaton:
    """Accepts the factors of all texts; ``count`` of a state is the weight of the places where its factors end."""

    def __init__(self, texts: Sequence[Sequence], weights: Sequence[int]) -> None:
        self.go: list[dict] = [{}]
        self.link = [-1]
        self.long = [0]
        self.count = [0]
        for text, weight in zip(texts, weights, strict=True):
            last = 0
            for token in text:
                last = self._extend(last, token)
                self.count[last] += weight
        # counts flow from longer factors to their suffixes
        for s in sorted(range(1, len(self.go)), key=self.long.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def _new(self, go: dict, link: int, long: int) -> int:
        self.go.append(go)
        self.link.append(link)
        self.long.append(long)
        self.count.append(0)
        return len(self.go) - 1

    def _split(self, above: int, below: int, token) -> int:
        """A state for the factors of ``below`` that are no longer than those of ``above`` followed by the token."""
        new = self._new(dict(self.go[below]), self.link[below], self.long[above] + 1)
        self.link[below] = new
        while above >= 0 and self.go[above].get(token) == below:
            self.go[above][token] = new
            above = self.link[above]
        return new

    def _extend(self, last: int, token) -> int:
        below = self.go[last].get(token)
        if below is not None:  # another text has been here
            return below if self.long[below] == self.long[last] + 1 else self._split(last, below, token)
        new = self._new({}, 0, self.long[last] + 1)
        at = last
        while at >= 0 and token not in self.go[at]:
            self.go[at][token] = new
            at = self.link[at]
        if at >= 0:
            below = self.go[at][token]
            self.link[new] = below if self.long[below] == self.long[at] + 1 else self._split(at, below, token)
        return new

    def repeated_ends(self, text: Sequence, length: int, least: int = 2) -> Iterator[int]:
        """Ends (exclusive) of the factors of ``length`` tokens of text that occur with a weight of ``least`` or more.

        These are the places where the matching statistic, taken over what occurs so often, reaches the length.
        """
        go, link, long, count = self.go, self.link, self.long, self.count
        state = matched = 0
        for end, token in enumerate(text, 1):
            while state and token not in go[state]:
                state = link[state]
                matched = long[state]
            if token in go[state]:
                state = go[state][token]
                matched += 1
            while state and long[link[state]] >= length:
                state = link[state]
                matched = long[state]
            if matched >= length and count[state] >= least:
                yield end
