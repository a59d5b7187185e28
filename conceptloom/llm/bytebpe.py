"""Byte-pair encoding of whole texts with a public vocabulary, vectorised over batches of texts.

Pre-tokenisation uses no regular expression. A batch becomes one array of code points, a table maps each to
a class (letter, number, white space, other, text edge), and the places where tokens may start follow from
run borders and three local corrections. Each position carries a transition on the state "start of the
current run": it either sets the state to its own index or keeps it. Composition of such transitions is
associative and is evaluated by ``maximum.accumulate``. Slices between borders go through cached pair merging.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from functools import lru_cache

import numpy as np

LETTER, NUMBER, SPACE, OTHER, EDGE = range(5)
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Code points with the property White_Space.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Suffixes that stay together with the apostrophe before them.
ONE_LETTER_SUFFIX = "stmd"
TWO_LETTER_SUFFIX = ["re", "ve", "ll"]


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for first, last in ((0, 0x32400), (0xE0000, 0xE1000)):
        kinds = [unicodedata.category(chr(c))[0] for c in range(first, last)]
        part = np.array(kinds)
        table[first:last][part == "L"] = LETTER
        table[first:last][part == "N"] = NUMBER
    table[WHITE_SPACE] = SPACE
    return table


class Vocabulary:
    """Ranks of a byte-level vocabulary and the merge loop over them."""

    def __init__(self, path: str):
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token)] = int(rank)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.joins = self._joins()

    def _joins(self) -> np.ndarray:
        """Which (last two bytes of a character, first byte of the next) some token spans, 7 bits each.

        Between two non-ASCII characters that no token spans, no merge can ever happen: text is cut there
        and each side is encoded alone, with the same result.
        """
        spans = np.zeros(1 << 21, bool)
        for token in self.ranks:
            for k in range(1, len(token)):
                if token[k] >= 0xC0 and token[k - 1] >= 0x80:
                    low = (token[k - 1] & 127) << 7 | token[k] & 127
                    if k == 1:
                        spans[low :: 1 << 14] = True
                    elif token[k - 2] >= 0x80:
                        spans[(token[k - 2] & 127) << 14 | low] = True
        return spans

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one slice: lowest rank first, leftmost first among equals; O(n log n)."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        parts = [piece[i : i + 1] for i in range(n)]
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        queue = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, joined = heapq.heappop(queue)
            j = after[i] if alive[i] else n
            if j >= n or parts[i] + parts[j] != joined:
                continue
            parts[i], alive[j], after[i] = joined, False, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(joined + parts[after[i]])) is not None:
                    heapq.heappush(queue, (r, i, joined + parts[after[i]]))
            if before[i] >= 0:
                k = before[i]
                if (r := ranks.get(parts[k] + joined)) is not None:
                    heapq.heappush(queue, (r, k, parts[k] + joined))
        return [ranks[parts[i]] for i in range(n) if alive[i]]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def borders(points: np.ndarray, kinds: np.ndarray, joins: np.ndarray | None = None) -> np.ndarray:
    """True where a token starts; with ``joins``, also at cuts inside tokens that no merge can cross."""
    n = len(points)
    starts = np.ones(n, bool)
    starts[1:] = kinds[1:] != kinds[:-1]
    where = np.arange(n)
    run_start = np.maximum.accumulate(np.where(starts, where, 0))
    following = np.append(kinds[1:], EDGE)
    # The last white space before other text stands apart from its run, and a blank joins what follows.
    last = np.flatnonzero((kinds == SPACE) & (following != SPACE) & (following != EDGE))
    starts[last] = True
    blank = last[points[last] == 32]
    starts[blank + 1] = False
    # A lone apostrophe takes a known suffix with it, unless a blank has joined it from the left.
    quote = np.flatnonzero((points == 39) & (following == LETTER))
    if len(quote):
        quote = quote[(run_start[quote] == quote) & starts[quote]]
        pad = np.append(points, [0, 0])
        one = quote[np.isin(pad[quote + 1], [ord(c) for c in ONE_LETTER_SUFFIX])]
        two = [quote[(pad[quote + 1] == ord(a)) & (pad[quote + 2] == ord(b))] for a, b in TWO_LETTER_SUFFIX]
        for found, width in [(one, 2), *((x, 3) for x in two)]:
            starts[found + 1] = False
            inside = found[found + width < n] + width
            starts[inside[kinds[inside] != SPACE]] = True
            starts[inside[kinds[inside] == SPACE]] = True
    if joins is not None:
        far = np.flatnonzero((points[1:] >= 0x80) & (points[:-1] >= 0x80) & ~starts[1:]) + 1
        a, b = points[far - 1], points[far]
        last_byte = a & 63
        second = np.where(a < 0x800, 0x40 | a >> 6, a >> 6 & 63)
        first = np.where(b < 0x800, 0x40 | b >> 6, np.where(b < 0x10000, 0x60 | b >> 12, 0x70 | b >> 18))
        starts[far[~joins[second << 14 | last_byte << 7 | first]]] = True
    return starts


class _Cache(dict):
    """Slice to its number; merges a slice when it is first seen."""

    def __init__(self, words: Vocabulary):
        super().__init__()
        self.words, self.ids, self.counts = words, [], []

    def __missing__(self, piece: str) -> int:
        found = self.words.merge(piece.encode("utf-8", "surrogatepass"))
        self[piece] = number = len(self.counts)
        self.ids.extend(found)
        self.counts.append(len(found))
        return number


class Encoder:
    """Encodes lists of texts; the cache of slices is dropped when it exceeds ``cache_size`` entries."""

    def __init__(self, path: str = DEFAULT_VOCABULARY, cache_size: int = 500_000, batch_chars: int = 600_000):
        self.words, self.cache_size, self.batch_chars = vocabulary(path), cache_size, batch_chars
        self.cache = _Cache(self.words)

    def batches(self, texts: list[str]):
        """Consecutive groups of texts of about ``batch_chars`` characters; a longer text stands alone."""
        group, size = [], 0
        for text in texts:
            if group and size + len(text) > self.batch_chars:
                yield group
                group, size = [], 0
            group.append(text)
            size += len(text)
        if group:
            yield group

    def _slices(self, texts: list[str]):
        """Numbers of the slices of a batch, their code-point starts in the joined text, and the text starts."""
        lengths = np.array([len(t) + 1 for t in texts])
        edges = np.cumsum(lengths) - 1
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        kinds = class_table()[points]
        kinds[edges] = EDGE
        starts = borders(points, kinds, self.words.joins)
        starts[edges] = True
        starts[edges[:-1] + 1] = True
        starts[0] = True
        at = np.flatnonzero(starts)
        at = at[kinds[at] != EDGE]
        ends = np.append(at[1:], len(points))
        first_edge = np.searchsorted(edges, at)
        ends = np.minimum(ends, edges[first_edge])
        get = self.cache.__getitem__
        numbers = np.fromiter((get(joined[a:b]) for a, b in zip(at.tolist(), ends.tolist())), np.int64, len(at))
        return numbers, at, first_edge, edges - lengths + 1

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the number of ids of each."""
        flat, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for group in self.batches(texts):
            if len(self.cache) > self.cache_size:
                self.cache = _Cache(self.words)
            numbers, _, owner, _ = self._slices(group)
            counts = np.array(self.cache.counts, np.int64)
            ids = np.array(self.cache.ids, np.int32)
            offsets = np.cumsum(counts) - counts
            width = counts[numbers]
            total = np.cumsum(width)
            flat.append(ids[np.repeat(offsets[numbers] - total + width, width) + np.arange(total[-1] if len(total) else 0)])
            sizes.append(np.bincount(owner, weights=width, minlength=len(group)).astype(np.int64))
        return np.concatenate(flat), np.concatenate(sizes)

    def count(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each text."""
        sizes = [np.zeros(0, np.int64)]
        for group in self.batches(texts):
            if len(self.cache) > self.cache_size:
                self.cache = _Cache(self.words)
            numbers, _, owner, _ = self._slices(group)
            width = np.array(self.cache.counts, np.int64)[numbers]
            sizes.append(np.bincount(owner, weights=width, minlength=len(group)).astype(np.int64))
        return np.concatenate(sizes)

    def decode(self, ids) -> str:
        """The text of ids."""
        return b"".join(self.words.tokens[int(i)] for i in ids).decode("utf-8", "surrogatepass")

    def byte_offsets(self, ids) -> list[int]:
        """Where each id begins in the UTF-8 form of its text."""
        at, out = 0, []
        for i in ids:
            out.append(at)
            at += len(self.words.tokens[int(i)])
        return out
