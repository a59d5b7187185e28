"""Chunking of page texts by sections, and tables around it: headings, section ranges, seeds."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

_HEADING = re.compile(r"(?m)^\s*(\d+\.\d+(?:\.\d+)*)\s+\S")


def _breaks(text: str, low: int, high: int) -> int | None:
    """The last paragraph, sentence, clause or word end in a window, whichever lies furthest."""
    window = text[low : high + 1]
    ends = [window.rfind(mark) + len(mark) for mark in ("\n\n", ". ", "? ", "! ", "; ", " ") if mark in window]
    return low + max(ends) if ends else None


def cut_text(text: str, limit: int, overlap: int = 0, least: int = 0, part: float = 0.65) -> list[str]:
    """Pieces of about ``limit`` characters that end at the last boundary of the window's end; a word is never cut.

    Neighbours share up to ``overlap`` characters from a word's beginning on; a tail shorter than ``least`` joins the
    piece before it if both fit.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must lie between 0 and the limit")
    out: list[str] = []
    start = 0
    while len(text) - start > limit:
        end = _breaks(text, start + max(1, int(limit * part)), start + limit)
        if end is None:
            gap = re.compile(r"\s").search(text, start + limit)
            end = gap.start() if gap else len(text)
        if piece := text[start:end].strip():
            out.append(piece)
        back = end - overlap
        if overlap and 0 < back < len(text) and text[back - 1].isalnum() and text[back].isalnum():
            gap = re.compile(r"\s+").search(text, back)
            back = gap.end() if gap else len(text)
        start = back if back > start else end
    tail = text[start:].strip()
    if tail:
        if out and len(tail) < least and len(out[-1]) + 2 + len(tail) <= limit:
            out[-1] += "\n\n" + tail
        else:
            out.append(tail)
    return out


def _tail(pieces: list[tuple[str, int]], overlap: int) -> list[tuple[str, int]]:
    """The end of a chunk from a sentence's beginning on, within ``overlap`` characters."""
    out: list[tuple[str, int]] = []
    left = overlap
    for text, page in reversed(pieces):
        room = left - (2 if out else 0)
        if room <= 0:
            break
        at = max(0, len(text) - room)
        if at or not text[:1].isupper():
            m = re.compile(r"(?:[.!?][\"')\]]?\s+|\n\s*\n)(?=[A-Z])").search(text, at)
            at = m.end() if m else len(text)
        if value := text[at:].strip():
            out.append((value, page))
            left -= len(value) + (2 if len(out) > 1 else 0)
    return out[::-1]


def primary_section(text: str, pages: list[int], sections: list[str], on_page: dict[int, list[str]]) -> str:
    """The section whose heading in the text is followed by most text, else the one on most of the pages; ties fall to the later section."""
    key = lambda s: [int(p) if p.isdigit() else 9999 for p in s.split(".")]
    starts = sorted((m.start(), s) for s in sections if (m := re.search(rf"(?m)^\s*{re.escape(s)}\s*(?:\n+\s*|[ \t]+)\S", text)))
    if starts:
        ends = [a for a, _ in starts[1:]] + [len(text)]
        return max(((end - a, key(s), s) for (a, s), end in zip(starts, ends)))[2]
    return max(((sum(s in on_page.get(p, ()) for p in pages), key(s), s) for s in sections), default=(0, [], ""))[2]


def section_chunks(pages: list[tuple[int, str]], sections: set[str], size: int = 2000, overlap: int = 300, least: int = 500, on_page: dict[int, list[str]] | None = None) -> list[dict]:
    """Chunks of pages: paragraphs are gathered up to ``size``; a registered heading begins a new chunk without overlap.

    Repeated text gives way where a new piece needs the room, so no chunk is longer than ``size`` unless a word alone is. A last
    chunk shorter than ``least`` joins the one before it within its section if both fit. on_page: sections of each page,
    for the primary section; without it those whose headings were met.
    """
    chunks: list[dict] = []
    held: list[tuple[str, int]] = []
    section = ""
    fresh, copied = False, 0
    length = lambda parts: sum(len(t) + 2 for t, _ in parts)

    def close(next_section: str) -> None:
        nonlocal held, fresh, copied
        if held and fresh:
            body = "\n\n".join(t for t, _ in held)
            before = chunks[-1] if chunks else None
            if before and before["section"] == section and len(body) < least and len(before["text"]) + 2 + len(new := "\n\n".join(t for t, _ in held[copied:])) <= size:
                before["text"] += "\n\n" + new
                before["pages"] = sorted({*before["pages"], *(p for _, p in held)})
            else:
                chunks.append({"text": body, "pages": sorted({p for _, p in held}), "section": section})
        held = _tail(held, overlap) if next_section == section and held else []
        copied, fresh = len(held), False

    for page, text in pages:
        for paragraph in re.split(r"\n\s*\n", text or ""):
            cuts = [m.start() for m in _HEADING.finditer(paragraph) if m.group(1) in sections]
            bounds = sorted({0, *cuts, len(paragraph)})
            for a, b in zip(bounds, bounds[1:]):
                part = paragraph[a:b].strip()
                if not part:
                    continue
                m = _HEADING.match(part)
                if m and m.group(1) in sections and m.group(1) != section:
                    close(m.group(1))
                    section = m.group(1)
                for piece in cut_text(part, size, part=0.6):
                    if held and length(held) + len(piece) > size:
                        close(section)
                    if held and length(held) + len(piece) > size:
                        held = _tail(held, size - len(piece) - 2)
                        copied = len(held)
                    held.append((piece, page))
                    fresh = True
    close("")
    for c in chunks:
        listed = sorted({s for p in c["pages"] for s in on_page.get(p, ())}) if on_page else [c["section"]] if c["section"] else []
        c["primary"] = primary_section(c["text"], c["pages"], listed, on_page or {}) if listed else ""
    return chunks


def chunk_documents(pages: DataFrame, sections: list[str], size: int = 2000, overlap: int = 300, least: int = 500) -> DataFrame:
    """``doc``, ``chunk_id`` (c0001 ...), ``section``, ``primary_section``, ``text``, ``pages``. pages: ``doc``, ``page``, ``text``.

    The state runs through a document, so each document is one group; documents of one task's size are assumed.
    """
    known = set(sections)

    def chunk(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("page", kind="stable")
        found = section_chunks(list(zip(rows["page"].tolist(), rows["text"].fillna("").tolist())), known, size, overlap, least)
        return pd.DataFrame([(key[0], f"c{i:04d}", c["section"], c["primary"], c["text"], c["pages"]) for i, c in enumerate(found, 1)], columns=["doc", "chunk_id", "section", "primary_section", "text", "pages"])

    return pages.groupBy("doc").applyInPandas(chunk, f"doc {pages.schema['doc'].dataType.simpleString()}, chunk_id string, section string, primary_section string, text string, pages array<int>")


def postprocess(chunks: DataFrame, key: str, text: str, limit: int = 2400, overlap: int = 300, least: int = 40) -> DataFrame:
    """Cleaned, trimmed and cut chunks: ``key``, ``part``, ``text``, ``text_length``; mixed, short and label-only ones are left out."""
    clean = T.trim_fragment(T.strip_labels(T.clean_chunk(text)))
    kept = chunks.select(key, clean.alias("text")).where((F.length("text") >= least) & ~T.label_fragment(F.col("text")) & ~F.array_contains(T.contamination(F.col("text")), "cross_section_or_sidebar_mixed_content"))

    def pieces(batches):
        for batch in batches:
            rows = [(k, i, p, len(p)) for k, t in zip(batch[key], batch["text"]) for i, p in enumerate(cut_text(t, limit, overlap, least))]
            yield pd.DataFrame(rows, columns=[key, "part", "text", "text_length"])

    return kept.mapInPandas(pieces, f"{key} {kept.schema[key].dataType.simpleString()}, part int, text string, text_length int")


def section_ranges(headings: DataFrame, last_page: int) -> DataFrame:
    """``doc``, ``section``, ``first``, ``last``: a section starts at its first heading and ends before the next start.

    headings: ``doc``, ``section``, ``page``. Sections that begin on one page share it.
    """
    starts = headings.groupBy("doc", "section").agg(F.min("page").alias("first"))
    distinct = starts.select("doc", "first").distinct().withColumn("next", F.lead("first").over(Window.partitionBy("doc").orderBy("first")))
    return starts.join(distinct, ["doc", "first"]).select("doc", "section", "first", F.greatest(F.col("first"), F.coalesce(F.col("next") - 1, F.lit(last_page))).alias("last"))


def section_pages(ranges: DataFrame) -> DataFrame:
    """``doc``, ``section``, ``page`` of every page of every section."""
    return ranges.select("doc", "section", F.explode(F.sequence("first", "last")).alias("page"))


def batches(rows: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """Adds ``batch``: runs of ``size`` rows of each group in an order."""
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1) / size))
