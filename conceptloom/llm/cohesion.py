"""Problem 1: splitting oversized texts where their topic changes.

Sentence units are the natural boundaries. Between any two, the words of a sliding block before and one after
are compared; a valley in this similarity marks a change of topic. Each piece ends at the deepest valley within
its size window, and the next piece repeats the last whole sentences of it.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .sentences import sentence_spans

_TOKENS = re.compile(r"[぀-ヿ㐀-鿿豈-﫿]|[^\W\d_぀-ヿ㐀-鿿豈-﫿]{2,}")
_JOINERS = "‍︎️"


def _likeness(texts: list[str], first: int, last: int, block: int) -> np.ndarray:
    """Cosine of the words of the blocks before and after each of the units from ``first`` to ``last``; only what these blocks hold is laid out."""
    low, high = max(first - block, 0), min(last - 1 + block, len(texts))
    words: dict[str, int] = {}
    rows, columns = [], []
    for i in range(low, high):
        for word in _TOKENS.findall(texts[i].lower()):
            rows.append(i - low + 1)
            columns.append(words.setdefault(word, len(words)))
    counts = np.zeros((high - low + 1, max(1, len(words))), np.float32)
    np.add.at(counts, (np.array(rows, int), np.array(columns, int)), 1)
    total = np.cumsum(counts, axis=0, out=counts)
    at = np.arange(first, last) - low
    before = total[at] - total[np.maximum(at - block, 0)]
    after = total[np.minimum(at + block, high - low)] - total[at]
    size = np.linalg.norm(before, axis=1) * np.linalg.norm(after, axis=1)
    return np.einsum("ij,ij->i", before, after) / np.where(size > 0, size, 1)


def valley_depths(texts: list[str], block: int = 6, span: int = 500) -> np.ndarray:
    """Depth of the similarity valley after each unit but the last: how far it lies below the peaks around it."""
    n = len(texts)
    if n < 2:
        return np.zeros(0)
    like = np.concatenate([_likeness(texts, a, min(a + span, n), block) for a in range(1, n, span)])
    left, right = like.copy(), like.copy()
    for i in range(1, len(like)):  # climb from each valley to the nearest peak on either side
        left[i] = max(like[i], left[i - 1]) if like[i - 1] >= like[i] else like[i]
    for i in range(len(like) - 2, -1, -1):
        right[i] = max(like[i], right[i + 1]) if like[i + 1] >= like[i] else like[i]
    return left + right - 2 * like


def _splittable(text: str, at: int) -> bool:
    """Whether a cut before ``at`` keeps combined characters together."""
    return at >= len(text) or not (unicodedata.combining(text[at]) or text[at] in _JOINERS or text[at - 1] == "‍")


def _forced(text: str, low: int, high: int) -> int:
    """A cut in (low, high] where no unit ends: at a line's end, else a word's, else between characters."""
    for gap in (r"\s*\n", r"\s+"):
        ends = [m.start() for m in re.finditer(gap, text[low:high])]
        ends = [low + e for e in ends if e > 0]
        if ends:
            return ends[-1]
    if high < len(text) and text[high].isspace():
        return high
    at = high
    while at > low + 1 and not _splittable(text, at):
        at -= 1
    return at if at > low + 1 else high


def pieces(text: str, limit: int = 2400, overlap: int = 300, block: int = 6, paragraph_bonus: float = 0.1) -> list[tuple[int, int]]:
    """(start, end) of the ordered pieces of a text, each of ``limit`` characters at most.

    A text within the limit is one piece. Pieces cover every character but white space between them. An end is the
    unit's end at the deepest valley of the window, the last of equal ones; the window is all that the limit leaves,
    but for ends that would add less than the overlap repeats, which count only if there is no other.
    """
    n = len(text)
    if n <= limit:
        return [(0, n)]
    units = sentence_spans(text)
    depth = np.append(valley_depths([text[a:b] for a, b in units], block), 0.0)
    starts = np.array([a for a, _ in units], int)
    ends = np.array([b for _, b in units], int)
    score = depth.copy()
    for i in range(len(units) - 1):
        if text.count("\n", ends[i], starts[i + 1]) > 1:
            score[i] += paragraph_bonus
    out: list[tuple[int, int]] = []
    start, done = 0, 0
    while n - start > limit:
        high = start + limit
        first, last = np.searchsorted(ends, done, "right"), np.searchsorted(ends, high, "right")
        begin = max(first, np.searchsorted(ends, done + overlap))
        if begin < last:
            end = int(ends[last - 1 - int(np.argmax(score[begin:last][::-1]))])
        elif first < last:
            end = int(ends[last - 1])
        else:
            end = _forced(text, max(done, start), high)
        out.append((start, end))
        done = end
        tail = starts[(starts >= end - overlap) & (starts < end) & (starts > start)]
        if overlap and len(tail):
            start = int(tail[0])
        elif overlap:
            low = max(start + 1, end - overlap)
            m = re.compile(r"\s(?=\S)").search(text, low - 1, end)
            start = m.end() if m and m.end() < end else next((k for k in range(low, end) if _splittable(text, k)), end)
        else:
            start = end
        if start >= end:
            start = end
            while start < n and text[start].isspace() and n - start > 1:
                start += 1
    rest = text[done:].strip()
    if rest or not out:
        out.append((start, n))
    return out


def _page_at(offsets: list[int], pages: list[int], at: int) -> int:
    return pages[max(0, int(np.searchsorted(offsets, at, "right")) - 1)]


def piece_pages(text: str, start: int, end: int, pages, offsets, bounds) -> tuple[int | None, int | None]:
    """First and last page of a piece, by its first and last character that is no white space.

    Without usable page offsets, the row's own bounds, the smaller first; null if both are null.
    """
    bare = text[start:end]
    first = start + len(bare) - len(bare.lstrip()) if bare.strip() else start
    last = start + len(bare.rstrip()) - 1 if bare.strip() else max(start, end - 1)
    if pages and offsets and len(pages) == len(offsets) and None not in pages and None not in offsets and sorted(offsets) == list(offsets):
        return _page_at(offsets, pages, first), _page_at(offsets, pages, last)
    known = sorted(b for b in bounds if b is not None)
    return (known[0], known[-1]) if known else (None, None)


def split_sections(chunks: DataFrame, limit: int = 2400, overlap: int = 300) -> DataFrame:
    """Pieces of every row: ``chunk_id``, ``piece`` (from 0), ``n_pieces``, ``source_chars``, ``start_char``,
    ``end_char``, ``text``, ``page_start``, ``page_end``.

    Rows with null or empty text have no piece; repeated rows give repeated pieces; other columns are not read.
    Texts are split where they are read: no shuffle.
    """
    names = ["chunk_id", "text", "pages", "page_offsets", "page_start", "page_end"]
    schema = "chunk_id string, piece int, n_pieces int, source_chars int, start_char int, end_char int, text string, page_start int, page_end int"
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32()]
    columns = [c.split()[0] for c in schema.split(", ")]

    def split(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text = row["text"]
                parts = pieces(text, limit, overlap)
                for k, (a, b) in enumerate(parts):
                    found = piece_pages(text, a, b, row["pages"], row["page_offsets"], (row["page_start"], row["page_end"]))
                    rows.append((row["chunk_id"], k, len(parts), len(text), a, b, text[a:b], *found))
            data = list(zip(*rows)) if rows else [[] for _ in columns]
            yield pa.RecordBatch.from_arrays([pa.array(list(d), t) for d, t in zip(data, kinds)], names=columns)

    return spread(chunks.where(F.length("text") > 0).select(*names)).mapInArrow(split, schema)


def latest_rows(df: DataFrame, key: str, order: str = "loaded_at") -> DataFrame:
    """The row of each key with the greatest ``order``; rows without a key are left out, ties fall to one row."""
    columns = df.columns
    kept = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(order, F.xxhash64("text"))).alias("_row"))
    return kept.select("_row.*")
