"""Candidate words for misread ones: Levenshtein automata intersected with a trie, and glyph alignment."""

from __future__ import annotations

import unicodedata

# What a scanner may read (right) in place of a letter or pair of letters (left).
MISREADINGS = {
    "b": "h 6", "c": "e", "d": "cl", "e": "c", "f": "t †", "g": "q 9", "h": "b li", "i": "l 1 ! | j", "l": "1 ! | i",
    "m": "rn nn", "n": "ri", "o": "0 c", "q": "g 9", "s": "5", "t": "† f", "u": "ii v", "v": "u", "w": "vv", "z": "2",
    "rn": "m", "cl": "d", "ri": "n", "vv": "w", "ii": "u", "li": "h", "nn": "m",
}
_READ = [(true, seen) for true, many in MISREADINGS.items() for seen in many.split()]


def plain(c: str) -> str:
    """A letter without its diacritics."""
    return unicodedata.normalize("NFD", c)[0]


def glyph_edits(seen: str, true: str, most: int = 2) -> int | None:
    """How many misreadings turn ``true`` into ``seen``; None if it takes more than ``most`` or other edits."""
    n, m = len(seen), len(true)
    best = {(0, 0): 0}
    order = [(0, 0)]
    for at in order:
        cost = best[at]
        i, j = at
        steps = []
        if i < n and j < m:
            if seen[i] == true[j]:
                steps.append((i + 1, j + 1, 0))
            elif plain(seen[i]) == true[j]:
                steps.append((i + 1, j + 1, 1))
        if cost < most:
            steps += [(i + len(s), j + len(t), 1) for t, s in _READ if true.startswith(t, j) and seen.startswith(s, i)]
        for a, b, c in steps:
            if cost + c <= most and cost + c < best.get((a, b), most + 1):
                best[a, b] = cost + c
                order.append((a, b))
    return best.get((n, m))


def entered(seen: str, most: int = 2, letters: int = 2) -> set[str]:
    """The first letters that a word can have of which ``seen`` is a misreading: the tries its automaton can enter."""
    out, walk = set(), [(0, "", 0)]
    while walk:
        i, start, cost = walk.pop()
        if len(start) >= letters or i == len(seen):
            out.add(start[:letters])
            continue
        walk.append((i + 1, start + seen[i], cost))
        if cost < most:
            if (bare := plain(seen[i])) != seen[i]:
                walk.append((i + 1, start + bare, cost + 1))
            walk += [(i + len(s), start + t, cost + 1) for t, s in _READ if seen.startswith(s, i)]
    return out


class Trie:
    """A vocabulary as nested dictionaries; the empty key holds the word that ends there."""

    def __init__(self, words):
        self.root: dict = {}
        for word in words:
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = word

    def within(self, word: str, distance: int) -> list[str]:
        """All words at a Levenshtein distance up to ``distance``.

        The automaton's state is one bit set per number of errors: bit i of set d stands for i letters of the
        word read with d errors or fewer. The walk leaves a branch of the trie when all sets are empty.
        """
        n, goal = len(word), 1 << len(word)
        every = (1 << n + 1) - 1
        letters: dict[str, int] = {}
        for i, c in enumerate(word):
            letters[c] = letters.get(c, 0) | 1 << i
        found, walk = [], [(self.root, tuple((1 << d + 1) - 1 & every for d in range(distance + 1)))]
        while walk:
            node, state = walk.pop()
            for c, below in node.items():
                if not c:
                    if state[-1] & goal:
                        found.append(below)
                    continue
                match = letters.get(c, 0)
                last = (state[0] & match) << 1
                new = [last]
                for d in range(1, distance + 1):
                    last = ((state[d] & match) << 1 | state[d - 1] | state[d - 1] << 1 | last << 1) & every
                    new.append(last)
                if last:
                    walk.append((below, tuple(new)))
        return found
