"""Problem 3: what a page scan leaves in texts - broken and misread words, headers, page numbers.

Three passes over the texts. The first counts words and lines. Then each rare word of the corpus is looked up once: a
Levenshtein automaton is intersected with tries of the corpus's own vocabulary, and candidates count if scanners'
misreadings explain the difference and they are far commoner. The second pass finds page furniture, broken words
and rare words where they stand, with the word before each, and counts what stands before the candidates. Rank and
context then decide each occurrence, by joins. The third pass, for whole texts, repairs words, drops furniture and reflows paragraphs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread
from .lexicon import Trie, entered, glyph_edits

BREAK_SIGNS = "-‐‑¬\xad"
_OUTER = ".,;:?()[]{}<>“”‘’\"'«»„…—–*•·=+&%$#@~`^/\\，。；：？！「」（）、…"
# The sign comes first, so that the search skips from sign to sign.
_BREAK = re.compile(rf"[{BREAK_SIGNS}](?<=[^\W\d_].)[ \t]*\r?\n[ \t]*(?=[^\W\d_])")
# Runs of characters between those of scripts without blanks and their wide signs.
_RUNS = re.compile(r"[^\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\uff00-\uffef]+")
_TECHNICAL = re.compile(r"[./_()\[\]{}=<>\\:@]")
_CLEAN = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_SEGMENT = re.compile(r"\s*[|·—–:]\s*|\s{2,}")
_SPACED = re.compile(r"\S(?:\s{1,4}\S)+")
_TAG = re.compile(r"(?i)(?:chap(?:ter|\.)?|sec(?:tion|\.|t\.)?|part|unit|lesson|第)?\s*\d+(?:\.\d+)*\s*[章節]?")
_NUMBERED = re.compile(r"\s*\d+(?:\.\d+)+\s+\S")
_CODE = re.compile(r"[{};]\s*$|^\s*(?:#include|if \(|for \(|while \(|return\b)|\(\);")
_LISTED = re.compile(r"\s*(?:[•‣◦▪●*–—-]|\(?\d{1,3}[.)]|[a-z]\))\s+\S")
_DUMP = re.compile(r"[0-9A-Fa-fx\s:.]{16,}")
# Words of notices about the edition.
_NOTICE = re.compile(r"(?i)\b(?:draft|pre-?print|proof|uncorrected|not for sale|course reader|review copy|reprint(?:ed)?|copyright|all rights reserved|not for distribution|for internal use)\b|\bedition(?:,? \d+)?$|版權|初稿|試讀")
_PAGE = re.compile(r"(?i)^[\s\[\](){}~*·|—–‐‑-]*(?:p(?:age|\.|p\.)?\s*|第\s*)?([0-9oOlI|SB]{1,5}|[ivxlcdm]{1,12})\s*(?:頁|页|of\s+\d+|/\s*\d+)?[\s\[\](){}~*·|—–‐‑-]*$")
_READ_DIGIT = str.maketrans("oOlI|SB", "0011158")
_READ_LETTER = str.maketrans("015689|!†ä", "olsbbglita")
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def _roman(word: str) -> int:
    values = [_ROMAN[c] for c in word.lower()]
    return sum(-v if any(w > v for w in values[i + 1 : i + 2]) else v for i, v in enumerate(values))


def page_value(line: str) -> int | None:
    """The number on a line that holds nothing but a page number; misread digits count as digits."""
    m = _PAGE.match(line)
    if not m:
        return None
    word = m.group(1)
    if re.search(r"\d", word) or not re.fullmatch(r"(?i)[ivxlcdm]+", word):
        number = word.translate(_READ_DIGIT)
        return int(number) if number.isdigit() and re.search(r"\d", word) else None
    return _roman(word)


def _near(a: str, b: str, most: int) -> bool:
    """Whether two strings are within ``most`` edits."""
    if abs(len(a) - len(b)) > most:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return False
    return row[-1] <= most


class Furniture:
    """Tells headers and page numbers, given the titles of books and chapters."""

    def __init__(self, titles):
        self.titles = {key for t in titles if t and len(key := self.key(t)) >= 6}
        self.longest = max(map(len, self.titles), default=0)
        # Of a title cut into one piece more than letters may be misread, some piece stands unchanged in every reading of it.
        self.pieces: dict[str, set[str]] = {}
        for t in self.titles:
            k = self._misread(t) + 1
            for i in range(k):
                self.pieces.setdefault(t[i * len(t) // k : (i + 1) * len(t) // k], set()).add(t)
        self.lengths = sorted({len(p) for p in self.pieces})
        self.is_title = lru_cache(maxsize=100_000)(self._is_title)

    @staticmethod
    def key(text: str) -> str:
        return "".join(c for c in text.casefold().translate(_READ_LETTER) if c.isalpha())

    @staticmethod
    def _misread(key: str) -> int:
        """How many letters of a title may be misread."""
        return max(1, len(key) // 7)

    def _is_title(self, text: str) -> bool:
        most = self.longest + self._misread("x" * self.longest)
        # A beginning with more letters than any title needs no further look.
        if len(text) > 4 * most and len(self.key(text[: 4 * most])) > most:
            return False
        key = self.key(text)
        if len(key) < 6 or len(key) > most:
            return False
        if key in self.titles:
            return True
        near = {t for n in self.lengths for i in range(len(key) - n + 1) for t in self.pieces.get(key[i : i + n], ())}
        return any(_near(key, t, self._misread(t)) for t in near)

    def kinds(self, line: str, pages) -> tuple[str, ...]:
        """'header' and 'page_number' as far as they hold for a line at a page's edge."""
        line = line.strip()
        if not line or line.startswith("|"):
            return ()
        value = page_value(line)
        if value is not None:
            return ("page_number",) if value in pages else ()
        if _NUMBERED.match(line):
            return ()
        if len(line) < 60 and line[0].isupper() and not any(c in line for c in ".!?;:。") and len(line.split()) < 9 and _NOTICE.search(line):
            return ("header",)
        if self.is_title(line) and not re.search(r"\S\s{2,}\S", line):
            return ("header",)
        parts = [p for p in _SEGMENT.split(line) if p]
        titled = [p for p in parts if self.is_title(p)]
        rest = [p for p in parts if not self.is_title(p)]
        if not titled and _SPACED.fullmatch(line) and self.is_title(line):
            return ("header",)
        if not titled or not all(_TAG.fullmatch(p.translate(_READ_DIGIT) if any(c.isdigit() for c in p) and " " not in p else p) for p in rest):
            return ()
        numbers = {int(n) for p in rest if (n := p.translate(_READ_DIGIT)).isdigit()}
        return ("header", "page_number") if any(n in pages for n in numbers) else ("header",)


def _in_code(line: str) -> bool:
    """Whether a line is part of code, a table or a dump."""
    bare = line.strip()
    return bare.startswith("|") or bool(_CODE.search(line)) or bool(_DUMP.fullmatch(bare))


def _edges(lines: list[str], offsets) -> tuple[list[int], list[tuple[list[int], list[int]]], set[int]]:
    """Lines that may be furniture, the two lines at each edge of each page, and the outermost ones.

    Without offsets of pages any line may be furniture.
    """
    filled = [i for i, line in enumerate(lines) if line.strip()]
    if offsets is None or not len(offsets):
        return filled, [], set(filled[:1] + filled[-1:])
    starts, at = [], 0
    for line in lines:
        starts.append(at)
        at += len(line) + 1
    cuts = sorted(int(o) for o in offsets if o is not None and o > 0)
    groups: list[list[int]] = [[]]
    for i in filled:
        while cuts and starts[i] >= cuts[0]:
            cuts.pop(0)
            groups.append([])
        groups[-1].append(i)
    near = {i for g in groups for i in g[:2] + g[-2:]}
    return [i for i in filled if i in near], [(g[:2], g[:-3:-1]) for g in groups], {i for g in groups for i in g[:1] + g[-1:]}


class Page:
    """A text as lines, each marked with the furniture it is."""

    def __init__(self, text: str, pages, offsets, bounds, furniture: Furniture):
        self.lines = text.split("\n")
        numbers = frozenset(int(p) for p in (pages if pages is not None else []) if p is not None)
        if not numbers:
            both = sorted(int(b) for b in bounds if b is not None)
            numbers = range(both[0], both[-1] + 1) if both else numbers
        self.kinds: list[tuple[str, ...]] = [()] * len(self.lines)
        candidates, by_edge, self.edges = _edges(self.lines, offsets)
        for i in candidates:
            self.kinds[i] = furniture.kinds(self.lines[i].rstrip("\r"), numbers)
        for top, bottom in by_edge:  # the second line counts only behind another piece of furniture
            for edge in (top, bottom):
                if len(edge) == 2 and not self.kinds[edge[0]] and edge[1] not in [e for t, b in by_edge for e in (t[:1] + b[:1])]:
                    self.kinds[edge[1]] = ()

    def body(self) -> str:
        """The text without furniture lines."""
        return "\n".join(line for line, k in zip(self.lines, self.kinds) if not k)

    def repeating(self) -> dict[str, list[int]]:
        """Lines at a page's edge that may be furniture if they come back on other pages, by their key."""
        out: dict[str, list[int]] = {}
        for i in self.edges:
            if not self.kinds[i] and (key := line_key(self.lines[i])):
                out.setdefault(key, []).append(i)
        return out

    def drop(self, keys) -> None:
        """Mark repeated lines as headers."""
        for key, lines in self.repeating().items():
            if key in keys:
                for i in lines:
                    self.kinds[i] = ("header",)


def line_key(line: str) -> str | None:
    """What stays the same of a running header from page to page, after a line end; None for lines that read like text, headings or code."""
    if len(line) > 400 or line[:1].islower():
        return None
    bare = line.strip()
    if not 4 <= len(bare) <= 400 or bare[-1] in ".!?;:,。！？；：，" or bare[0].islower() or _NUMBERED.match(bare) or _LISTED.match(bare) or _in_code(bare):
        return None
    letters = "".join(c for c in bare.casefold() if c.isalpha())
    return "\n" + letters if len(letters) >= 4 else None


@lru_cache(maxsize=200_000)
def _words_of(token: str) -> tuple[str, ...]:
    """Words of a token with signs that may stand for letters; parts of technical names are left out.

    A token that mixes in scripts without blanks is cut at their borders.
    """
    out: list[str] = []
    for run in (token,) if token.isascii() else _RUNS.findall(token):
        core = run.strip(_OUTER)
        if core and not _TECHNICAL.search(core):
            out += [part for part in core.split("-") if part]
    return tuple(out)


def _words(line: str):
    """Words of a line, token by token."""
    for token in line.split():
        yield from _words_of(token)


@lru_cache(maxsize=200_000)
def _keys_of(token: str) -> tuple[str, ...]:
    """Words of a token in lower case; only those with a letter may be looked up."""
    return tuple(_plain_end(word).lower() for word in _words_of(token))


def _sought(word: str) -> bool:
    return any(c.isalpha() for c in word)


def _parted(text: str) -> tuple[str, list[str]]:
    """A text without the tokens that a line's end has broken, and those tokens joined."""
    kept, broken, at = [], [], 0
    for m in _BREAK.finditer(text):
        a, b = m.start(), m.end()
        if a < at:
            continue
        while a > at and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        kept.append(text[at:a])
        broken.append(text[a : m.start()] + text[m.end() : b])
        at = b
    return (" ".join([*kept, text[at:]]), broken) if broken else (text, broken)


def _count(texts) -> tuple[Counter, Counter]:
    """Words of texts, and those that a line's end has broken, joined."""
    whole: Counter = Counter()
    broken: Counter = Counter()
    for text in texts:
        rest, parted = _parted(text)
        broken.update(parted)
        whole.update(rest.split())
    out: list[Counter] = []
    for counts in (whole, broken):
        words: Counter = Counter()
        for token, n in counts.items():
            for word in _keys_of(token):
                if _sought(word):
                    words[word] += n
            core = token.strip(_OUTER)
            if "-" in core and _CLEAN.fullmatch(core):
                words[core.lower()] += n
        out.append(words)
    return out[0], out[1]


def _plain_end(word: str) -> str:
    """A word without an exclamation mark that ends its sentence."""
    return word.rstrip("!") if word.endswith("!!") else word


def word_counts(texts: DataFrame) -> DataFrame:
    """``word``, ``n``, ``whole`` over all texts; each batch is summed before the shuffle.

    ``whole`` counts words that no line's end has broken. Lines that may be running headers count too, under their
    key, which begins with a line end: ``n`` everywhere, ``whole`` at the edges of pages.
    """

    def count(batches):
        for batch in batches:
            rows = batch.to_pylist()
            whole, broken = _count(r["text"] for r in rows)
            middle: Counter = Counter()
            for r in rows:
                lines = r["text"].split("\n")
                edges = _edges(lines, r["page_offsets"])[2]
                for i, line in enumerate(lines):
                    if key := line_key(line):
                        (whole if i in edges else middle)[key] += 1
            broken.update(middle)
            words = list(whole.keys() | broken.keys())
            n, w = [whole[x] + broken[x] for x in words], [whole[x] for x in words]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64()), pa.array(w, pa.int64())], names=["word", "n", "whole"])

    return texts.select("text", "page_offsets").mapInArrow(count, "word string, n long, whole long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("whole").alias("whole"))


def repeated_lines(counts: DataFrame, least: int = 10, share: float = 0.9) -> DataFrame:
    """``line``: keys of lines that stand at the edges of ``least`` pages or more and hardly anywhere else."""
    return counts.where(F.col("word").startswith("\n") & (F.col("whole") >= least) & (F.col("whole") >= share * F.col("n"))).select(F.col("word").alias("line"))


def corrections(counts: DataFrame, least: int = 5, ratio: int = 10, distance: int = 2, shard_words: int = 20_000, block_words: int = 20_000) -> DataFrame:
    """``word``, ``candidate``, ``edits``, ``n``, ``candidate_n`` for every misread word of the corpus.

    The vocabulary (clean words seen ``least`` times or more) is cut into tries by the words' first two letters. A word to
    look up goes only to the tries that its misreadings can enter, and there into one of several blocks, so each
    task holds a trie and a block whatever the size of the corpus. A candidate must be ``ratio`` times as common and
    differ by misreadings alone.
    """
    counts = counts.where((F.length("word") >= 2) & ~F.col("word").startswith("\n"))
    vocabulary = counts.where((F.col("n") >= least) & F.col("word").rlike("^\\p{Ll}{2,}$"))
    size, longest = vocabulary.agg(F.count(F.lit(1)), F.max(F.length("word"))).first()
    shards = max(1, -(-size // shard_words))
    # A word can only be a misreading if some word is ratio times as common, and about as long.
    top = counts.agg(F.max("n")).first()[0] or 0
    rare = counts.where((F.col("n") * ratio <= top) & (F.length("word") <= (longest or 0) + distance) & F.col("word").rlike("^[!|†]?[\\p{L}0-9!|†]+$") & ~F.col("word").rlike("^[0-9]+[a-z]?$")).select("word", "n")

    def route(batches):
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            starts = [entered(w, distance) for w in words]
            at = [i for i, s in enumerate(starts) for _ in s]
            yield pa.RecordBatch.from_arrays([pa.array([p for s in starts for p in s], pa.string()), pa.array([words[i] for i in at], pa.string()), pa.array([n[i] for i in at], pa.int64())], names=["start", "word", "n"])

    shard_of = lambda c: F.pmod(F.xxhash64(c), F.lit(shards))
    if shards > 1:
        looked = cut(rare.mapInArrow(route, "start string, word string, n long").select(shard_of("start").alias("shard"), "word", "n").distinct())
    else:
        looked = cut(rare.select(F.lit(0).cast("long").alias("shard"), "word", "n"))
    blocks = max(-(-8 // shards), -(-looked.count() // (shards * block_words)))
    words = vocabulary.select(shard_of(F.substring("word", 1, 2)).alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "word", "n")
    looked = looked.select("shard", F.pmod(F.xxhash64("word"), F.lit(blocks)).alias("block"), "word", "n")

    def match(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        common = dict(zip(shard["word"], shard["n"]))
        trie, rows = Trie(common), []
        for word, n in zip(block["word"], block["n"]):
            far = distance if len(word) > 3 else 1
            for found in trie.within(word, far):
                m = common[found]
                if found != word and m >= ratio * n and len(found) >= 3 and (edits := glyph_edits(word, found)):
                    rows.append((word, found, edits, int(n), int(m)))
        return pd.DataFrame(rows, columns=["word", "candidate", "edits", "n", "candidate_n"])

    # A known word with a sign behind it is no misreading, whatever shard the word is in.
    signed = vocabulary.where(F.length("word") >= 3).select(F.explode(F.array(F.concat("word", F.lit("!")), F.concat("word", F.lit("|")))).alias("word"))
    matched = words.groupBy("shard", "block").cogroup(looked.groupBy("shard", "block")).applyInPandas(match, "word string, candidate string, edits int, n long, candidate_n long")
    found = cut(matched.join(signed, "word", "left_anti"))
    # A candidate that is itself misread stands for the word it was misread from.
    onward = found.groupBy("word").agg(F.max_by("candidate", "candidate_n").alias("true_word"), F.max("candidate_n").alias("true_n")).withColumnRenamed("word", "candidate")
    return (
        found.join(onward, "candidate", "left")
        .select("word", F.coalesce("true_word", "candidate").alias("candidate"), (F.col("edits") + F.col("true_n").isNotNull().cast("int")).alias("edits"), "n", F.coalesce("true_n", "candidate_n").alias("candidate_n"))
        .groupBy("word", "candidate").agg(F.min("edits").alias("edits"), F.max("n").alias("n"), F.max("candidate_n").alias("candidate_n"))
    )


def _sources(section_chunks: DataFrame, chunks: DataFrame) -> DataFrame:
    """Both tables in one form; chunks have no offsets of pages."""
    common = ["chunk_id", "text", "pages", "page_start", "page_end"]
    empty = F.lit(None).cast("array<int>")
    return section_chunks.select(F.lit("section_chunks").alias("src_table"), *common, F.col("page_offsets").cast("array<int>")).unionByName(
        chunks.select(F.lit("chunks").alias("src_table"), *common, empty.alias("page_offsets"))
    ).where(F.length("text") > 0)


#: Commonest words that travel to the tasks, and marks of the table of words whose neighbours are counted.
KNOWN_WORDS, MARKS = 50_000, 1 << 22


class Noise:
    """What both queries need: counts, corrections, and what was spotted and judged in every text."""

    def __init__(self, section_chunks: DataFrame, chunks: DataFrame, titles: list[str], known_words: int = KNOWN_WORDS, as_is: int = 5):
        self.texts, self.titles = spread(_sources(section_chunks, chunks)), titles
        counts = cut(word_counts(self.texts))
        found = cut(corrections(counts))
        wrong = found.select("word").distinct()
        # All words that stand whole somewhere and are not misread; those that travel are the commonest of them.
        full = counts.where((F.col("whole") > 0) & ~F.col("word").startswith("\n")).select("word", "whole").join(wrong, "word", "left_anti")
        self.known = [r[0] for r in full.orderBy(F.desc("whole"), "word").limit(known_words).select("word").collect()]
        # Which words' neighbours to count: a table of fixed size, and exact after the join.
        marks = bytearray(MARKS // 8)
        for (m,) in found.select(F.pmod(F.crc32(F.col("candidate").cast("binary")), F.lit(MARKS))).distinct().collect():
            marks[m >> 3] |= 1 << (m & 7)
        spotted = cut(_spot(self.texts, titles, self.known, bytes(marks)))
        key = ["src_table", "chunk_id"]
        self.furniture = spotted.where(F.col("noise").isin("header", "page_number")).select(*key, "noise")
        lines = spotted.where("noise = 'line'").select(*key, F.col("word").alias("line")).join(repeated_lines(counts), "line", "left_semi")
        self.lines = cut(lines.distinct())
        # A broken word: its joined form is a word, or the form with the hyphen is none and the rest goes on in lower case.
        standing = full.select("word", F.lit(True).alias("stands"))
        broken = spotted.where(F.col("noise").isin("break", "break_lower", "compound")).select(*key, "noise", "word", F.col("other"))
        joined = broken.join(standing, "word", "left").withColumnRenamed("stands", "whole_word")
        parted = joined.join(standing.withColumnRenamed("word", "other").withColumnRenamed("stands", "compound_word"), "other", "left")
        lower = (F.col("noise") == "break_lower") & F.col("compound_word").isNull()
        self.broken = parted.where(F.coalesce("whole_word", F.lit(False)) | lower).select(*key, "word", "other").union(spotted.where("noise = 'broken'").select(*key, "word", "other")).distinct()
        # Misread words where they stand, without those on repeated lines.
        seen = spotted.where("noise = 'word'").select(*key, "word", F.col("other").alias("left"), "line").join(wrong, "word", "left_semi")
        seen = cut(seen.join(self.lines.withColumn("gone", F.lit(True)), [*key, "line"], "left").where("gone IS NULL").select(*key, "left", "word").distinct())
        own = seen.groupBy("left", "word").agg(F.count(F.lit(1)).alias("as_is"))
        pairs = spotted.where("noise = 'pair'").groupBy(F.col("other").alias("left"), F.col("word").alias("candidate")).agg(F.sum("n").alias("together"))
        ranked = own.join(found, "word").join(pairs, ["left", "candidate"], "left").withColumn("together", F.coalesce("together", F.lit(0).cast("long")))
        rank = F.struct("together", -F.col("edits"), F.col("candidate_n"), F.col("candidate"))
        best = ranked.groupBy("left", "word").agg(F.max_by("candidate", rank).alias("candidate"), F.max("together").alias("together"), F.first("as_is").alias("as_is"))
        # Where a word itself follows the one before it again and again, more often than any candidate, it stands.
        self.misread = seen.join(best.where((F.col("as_is") < as_is) | (F.col("as_is") <= F.col("together"))).select("left", "word", "candidate"), ["left", "word"])


def find_noise(section_chunks: DataFrame, chunks: DataFrame, titles: list[str], known_words: int = KNOWN_WORDS) -> DataFrame:
    """Distinct ``src_table``, ``chunk_id``, ``noise`` ('hyphen', 'ocr', 'header', 'page_number').

    Null and empty texts have none; repeated rows count once; a null page list falls back to the page bounds
    in either order. Only the ``known_words`` commonest words travel to the tasks; all others are decided in joins
    with the whole table of words, by the same rules.
    """
    found = Noise(section_chunks, chunks, titles, known_words)
    key = ["src_table", "chunk_id"]
    each = found.furniture.union(found.lines.select(*key, F.lit("header"))).union(found.broken.select(*key, F.lit("hyphen"))).union(found.misread.select(*key, F.lit("ocr")))
    return each.distinct()


def _running(body: str) -> str:
    """The running text: no code, tables, dumps and numbered headings; broken words joined."""
    return "\n".join(line for line in body.split("\n") if not _in_code(line) and not _NUMBERED.match(line))


def _break_forms(text: str, m: re.Match) -> tuple[str, str, bool] | None:
    """The word around a sign at a line's end joined, with the hyphen, and whether its rest goes on in lower case."""
    a, b = m.start(), m.end()
    while a and (text[a - 1].isalpha() or text[a - 1] == "-"):
        a -= 1
    while b < len(text) and (text[b].isalpha() or text[b] == "-"):
        b += 1
    left, right = re.search(r"[^\W\d_]+(?:-[^\W\d_]+)*\Z", text[a : m.start()]), re.match(r"[^\W\d_]+(?:-[^\W\d_]+)*", text[m.end() : b])
    if not left or not right or "一" <= right.group()[0] <= "鿿":
        return None
    x, y = left.group().lower(), right.group().lower()
    return x + y, f"{x}-{y}", right.group()[0].islower()


def _spot(texts: DataFrame, titles: list[str], known: list[str], marks: bytes) -> DataFrame:
    """What stands where: ``src_table``, ``chunk_id``, ``noise``, ``word``, ``other``, ``line``, ``n``.

    By ``noise``: furniture; 'line', a line at a page's edge that may be repeated; 'word', a word of running text outside
    ``known``, behind ``other`` and on ``line`` if that may be repeated; 'broken', 'break', 'break_lower' and 'compound', a word
    broken at a line's end, joined and with its hyphen (the first is decided, the last known as a compound); 'pair', how often
    a marked word follows ``other`` in the texts of a batch.
    """
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast((list(titles), frozenset(known), marks))

    def spot(batches):
        names, common, bits = sent.value
        furniture = Furniture(names)
        cache: dict[str, tuple] = {}

        def kind_of(word: str) -> int:
            """Two marks: whether a word is to be looked up, and whether its neighbours are counted."""
            m = zlib.crc32(word.encode()) % MARKS
            return (word not in common and _sought(word)) + 2 * (bits[m >> 3] >> (m & 7) & 1)

        def look_at(token: str) -> tuple:
            """The last word of a token, and its words with a mark, each with the word of the token before it."""
            words = _keys_of(token)
            before = (None, *words)
            cache[token] = c = (words[-1] if words else None, tuple((w, k, b) for w, b in zip(words, before) if (k := kind_of(w))))
            return c

        for batch in batches:
            rows, pairs = [], Counter()
            if len(cache) > 300_000:
                cache.clear()
            for row in batch.to_pylist():
                page = Page(row["text"], row["pages"], row["page_offsets"], (row["page_start"], row["page_end"]), furniture)
                key = (row["src_table"], row["chunk_id"])
                rows += [(*key, k, None, None, None, None) for k in {k for kinds in page.kinds for k in kinds}]
                may_repeat = {page.lines[i]: k for k, many in page.repeating().items() for i in many}
                rows += [(*key, "line", k, None, None, None) for k in set(may_repeat.values())]
                running = _running(page.body())
                forms = set()
                for m in _BREAK.finditer(running):
                    if f := _break_forms(running, m):
                        forms.add(f)
                for whole, parted, lower in forms:
                    name = "broken" if whole in common else "compound" if parted in common else "break_lower" if lower else "break"
                    rows.append((*key, name, whole, None if name == "compound" else parted, None, None))
                seen = set()
                left = ""
                text = _BREAK.sub("", running)
                for line in text.split("\n") if may_repeat else (text,):
                    on = may_repeat.get(line)
                    for token in line.split():
                        last, marked = cache.get(token) or look_at(token)
                        for word, k, before in marked:
                            before = left if before is None else before
                            if k & 1:
                                seen.add((before, word, on))
                            if k & 2:
                                pairs[before, word] += 1
                        left = left if last is None else last
                rows += [(*key, "word", word, left, on, None) for left, word, on in seen]
            rows += [(None, None, "pair", word, left, None, n) for (left, word), n in pairs.items()]
            columns = list(zip(*rows)) if rows else [[]] * 7
            types = [pa.string()] * 6 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["src_table", "chunk_id", "noise", "word", "other", "line", "n"])

    return texts.mapInArrow(spot, "src_table string, chunk_id string, noise string, word string, other string, line string, n long")


def clean_texts(section_chunks: DataFrame, chunks: DataFrame, titles: list[str], known_words: int = KNOWN_WORDS) -> DataFrame:
    """``src_table``, ``chunk_id``, ``text`` of every row with text, repaired, as paragraphs between blank lines.

    Furniture is dropped, broken words are joined, misread words replaced by the candidate that follows the
    word before it most often, then by fewest misreadings, then by frequency. Lines of a paragraph become one;
    code, tables, dumps, lists and headings keep their lines. Null and empty texts have no row; repeated rows
    come out as often as they came in.
    """
    found = Noise(section_chunks, chunks, titles, known_words)
    key = ["src_table", "chunk_id"]
    form = lambda kind, a, b, c: F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), c.alias("c"))
    none = F.lit(None).cast("string")
    each = (
        found.misread.select(*key, form("word", F.col("left"), F.col("word"), F.col("candidate")).alias("fix"))
        .union(found.broken.select(*key, form("broken", F.col("word"), none, none)))
        .union(found.lines.select(*key, form("line", F.col("line"), none, none)))
    )
    fixes = each.groupBy(*key).agg(F.collect_set("fix").alias("fixes"))
    return _repair(found.texts.join(fixes, key, "left"), titles)


def _repair(texts: DataFrame, titles: list[str]) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(list(titles))

    def repair(batches):
        furniture = Furniture(sent.value)
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for row in rows:
                page = Page(row["text"], row["pages"], row["page_offsets"], (row["page_start"], row["page_end"]), furniture)
                fixes = row["fixes"] or ()
                page.drop({f["a"] for f in fixes if f["kind"] == "line"})
                words = {(f["a"], f["b"]): f["c"] for f in fixes if f["kind"] == "word"}
                out.append(repaired(page, {f["a"] for f in fixes if f["kind"] == "broken"}, words))
            columns = [[r["src_table"] for r in rows], [r["chunk_id"] for r in rows], out]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["src_table", "chunk_id", "text"])

    return texts.mapInArrow(repair, "src_table string, chunk_id string, text string")


def _cased(word: str, like: str) -> str:
    return word.upper() if like.isupper() and len(like) > 1 else word.capitalize() if like[:1].isupper() else word


def _fixed(line: str, left: str, fixes: dict) -> tuple[str, str]:
    """A line with misread words replaced, and its last word."""
    out, at = [], 0
    for m in re.finditer(r"\S+", line):
        token = m.group()
        for word in _words(token):
            low = _plain_end(word).lower()
            if (left, low) in fixes:
                bare = _plain_end(word)
                token = token.replace(bare, _cased(fixes[left, low], bare), 1)
            left = low
        out.append(line[at : m.start()] + token)
        at = m.end()
    return "".join(out) + line[at:], left


_CJK = "　-鿿豈-﫿＀-￯"


def repaired(page: Page, broken: set[str], fixes: dict) -> str:
    """The body of a page text with broken words joined and misread words replaced, as paragraphs."""
    kept = [(line.rstrip("\r"), bool(k)) for line, k in zip(page.lines, page.kinds)]
    filled = [i for i, (line, _) in enumerate(kept) if line.strip()]
    lines: list[str] = []
    for n, i in enumerate(filled):
        gap = i - filled[n - 1] > 1 if n else False
        if kept[i][1]:
            continue
        passed = n > 0 and kept[filled[n - 1]][1]
        before = lines[-1] if lines else ""
        # A blank line beside a page's edge parts nothing when the sentence goes on.
        if gap and lines and not (passed and before.strip() and before.strip()[-1] not in ".!?。！？”」:：" and kept[i][0].lstrip()[:1].islower()):
            lines.append("")
        lines.append(kept[i][0])
    body = "\n".join(lines)
    joined, at = [], 0
    for m in _BREAK.finditer(body):
        if (forms := _break_forms(body, m)) and forms[0] in broken:
            joined.append(body[at : m.start()])
            at = m.end()
    body = "".join(joined) + body[at:]
    paragraphs: list[str] = []
    open_paragraph, left = False, ""
    for line in body.split("\n"):
        if not line.strip():
            open_paragraph = False
        elif _in_code(line):
            paragraphs.append(line)
            open_paragraph = False
        elif _NUMBERED.match(line) and len(line) < 80:
            paragraphs.append(line.strip())
            open_paragraph = False
        else:
            listed = bool(_LISTED.match(line))
            line, left = _fixed(line.strip(), left, fixes)
            if open_paragraph and not listed:
                tight = re.search(f"[{_CJK}]\\Z", paragraphs[-1]) and re.match(f"[{_CJK}]", line)
                paragraphs[-1] += ("" if tight else " ") + line
            else:
                paragraphs.append(line)
            open_paragraph = True
    return "\n\n".join(paragraphs)
