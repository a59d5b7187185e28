"""Problem 9: sentence units of texts in any language and script.

Sentence-break classes of characters (terminators of all scripts, ambiguous full stops, closing marks, what extends a
character), taken from the Unicode property, decide where a unit may end. Abbreviations of the block's own language suppress
full stops: the script of the word tells it, or, among languages in Latin letters, the function words of the block or
else of the text. Matched quotations and brackets stay whole where a clause of their sentence stands before or after them.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import spread



def _of_class(*classes: str) -> str:
    """All characters of some sentence-break classes."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, sys.maxunicode + 1))))
    return "".join(regex.findall("[" + "".join(rf"\p{{Sentence_Break={c}}}" for c in classes) + "]", every))


TERMINATORS = _of_class("STerm")
FULL_STOPS = _of_class("ATerm")
#: Marks and signs that belong to the character before them, but for the byte-order mark.
EXTENDING = _of_class("Extend", "Format").replace("\ufeff", "")
GREEK_QUESTION = ";\u037e"
ELLIPSIS = "…⋯"
# Marks that open and close quotations and brackets.
BRACKETS = {"(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "【": "】", "〔": "〕", "〖": "〗"}
QUOTES = {"“": "”", "‘": "’", "«": "»", "‹": "›", "「": "」", "『": "』", "《": "》", "〈": "〉", "„": "“”", "‚": "‘’"}
OPENERS = BRACKETS | QUOTES
CLOSERS = (set("".join(OPENERS.values())) | {c for c in _of_class("Close") if unicodedata.category(c) in ("Pe", "Pf")}) - {"“", "‘"}
# Abbreviations by language that never end a sentence: titles, and words that need what follows.
NEVER_FINAL = {
    "en": "mr mrs ms messrs dr prof rev hon st gen col capt lt sgt mt vs v cf e.g i.e viz esp incl",
    "de": "hr fr dr prof dipl ing d.h z.b u.a i.d.r ca bzw vgl sog inkl evtl ggf d h z",
    "fr": "m mm mme mlle dr pr me c.-à-d p.ex env cf",
    "es": "sr sra srta sres dr dra d dña ud uds p.ej aprox",
    "ru": "см т.е т.к напр ок г-н г-жа проф акад им ул пр пл обл",
    "hi": "डॉ डा श्री प्रो पं सुश्री",
    "it": "sig sig.ra dott prof ing avv",
    "pt": "sr sra dr dra prof",
}
# Abbreviations by language that go with a number or name after them and may end a sentence otherwise.
BEFORE_NUMBER = {
    "en": "fig figs sec secs chap ch tab vol vols p pp no nos nr ref refs ver eq eqs art approx par app ed jan feb mar apr jun jul aug sep sept oct nov dec",
    "de": "abb kap tab nr s bd abs art jan feb mrz apr jun jul aug sep okt nov dez",
    "fr": "fig chap art vol p pp n° no tabl sect",
    "es": "fig cap pág págs núm art vol secc tab",
    "ru": "рис табл гл стр с п пп разд",
}
# Abbreviations that may end a sentence, but do not when it goes on in lower case.
MAY_BE_FINAL = {
    "en": "inc ltd corp co bros jr sr etc al a.m p.m u.s u.k dept govt univ assn est min max std orig anon resp ext",
    "de": "usw u.a etc jh gmbh evtl o.ä",
    "fr": "etc cie p.m",
    "es": "etc cía ee.uu",
    "ru": "г гг т.п т.д др в вв руб тыс млн млрд",
}
# Names of months after a German ordinal day.
MONTHS = "Januar Februar März April Mai Juni Juli August September Oktober November Dezember Jan Feb Mrz Apr Jun Jul Aug Sep Okt Nov Dez".split()
# Particles by which a Japanese sentence goes on after a quotation.
PARTICLES = "とはがをにでもやへのっ"
# Bullets that always begin a list item at the start of a line.
BULLETS = "•‣◦▪●○■□∙⁃*"

# Russian words that end a sentence after a number (a year, a century) and otherwise stand before a name.
AFTER_NUMBER = frozenset("г гг в вв".split())
# The commonest function words of languages in Latin letters.
FUNCTION_WORDS = {
    "en": "the of and to is in a that it for with as are on be this by an from or not when then",
    "de": "der die das und ist ein eine einen nicht mit den von zu im auf des dem sich wird für oder wenn",
    "fr": "le la les des et est un une que dans pour du qui sur au aux ne pas ce se par ou il elle",
    "es": "el la los las de y es un una que en por para con del se no al lo como si cuando",
    "it": "il lo la gli le di e è un una che per con del della dei non si nel quando",
    "pt": "o a os as de e é um uma que em para com do da dos das não se no na quando",
}
TITLES = frozenset("mr mrs ms messrs dr prof rev hon gen col capt lt sgt mt m mm mme mlle pr sr sra srta sres dra hr fr ud uds sig ing".split())


class Abbreviations:
    """The lists of one language."""

    def __init__(self, language: str):
        self.never = frozenset(NEVER_FINAL.get(language, "").split())
        self.numbered = frozenset(BEFORE_NUMBER.get(language, "").split())
        self.final = frozenset(MAY_BE_FINAL.get(language, "").split())


_LISTS = {x: Abbreviations(x) for x in NEVER_FINAL}
_LISTED = frozenset().union(*(lists.never | lists.numbered | lists.final for lists in _LISTS.values()))
_NONE = Abbreviations("")
_SPEAKERS: dict[str, list[str]] = {}
for _language, _words in FUNCTION_WORDS.items():
    for _one in _words.split():
        _SPEAKERS.setdefault(_one, []).append(_language)


def votes_of(text: str) -> dict[str, int]:
    """How many function words of each language in Latin letters stand in a text."""
    votes: dict[str, int] = {}
    for word in filter(_SPEAKERS.__contains__, text.lower().split()):
        for language in _SPEAKERS[word]:
            votes[language] = votes.get(language, 0) + 1
    return votes


def speaker(text: str) -> Callable[[str, int, int], Abbreviations]:
    """The lists for a word of a block of a text; languages are told only when a listed word asks for it.

    The language with most function words in the block counts; among level ones, and where there are none, that with most
    in the whole text, and English where nothing tells.
    """
    known: dict[tuple[int, int], str] = {}
    whole: dict[str, int] | None = None

    def lists(word: str, start: int, end: int) -> Abbreviations:
        nonlocal whole
        first = next((c for c in word if c.isalpha()), "a")
        if "Ѐ" <= first <= "ԯ":
            return _LISTS["ru"]
        if "ऀ" <= first <= "ॿ":
            return _LISTS["hi"]
        language = known.get((start, end))
        if language is None:
            votes = votes_of(text[start:end])
            level = [x for x, n in votes.items() if n == max(votes.values())] or list(FUNCTION_WORDS)
            if len(level) > 1 and whole is None:
                whole = votes_of(text)
            language = known[start, end] = level[0] if len(level) == 1 else max(level, key=lambda x: (whole.get(x, 0), x == "en", x))
        return _LISTS[language]

    return lists


_LINE = r"(?:\r\n|[\n\r\x0b\x0c\x85 ])"
_FLAT = r"[^\S\n\r\x0b\x0c\x85  ]"
_BLANK = re.compile(rf"{_LINE}(?:[^\S\n\r\x0b\x0c\x85  ]|﻿)*{_LINE}(?:\s|﻿)*| (?:\s|﻿)*")
_ITEM = re.compile(rf"{_LINE}{_FLAT}*(?=([{re.escape(BULLETS)}]|[-–—]|\(?(?:\d{{1,3}}|[a-z])\)|\d{{1,3}}\.){_FLAT}+\S)")
_MARKER = re.compile(rf"(?:\s|﻿)*(?:[{re.escape(BULLETS)}]|[-–—]|\(?(?:\d{{1,3}}|[a-z])\)|\d{{1,3}}\.){_FLAT}+")
_ENDS = TERMINATORS + FULL_STOPS + ELLIPSIS
_MARKS = "".join(OPENERS) + "".join(sorted(CLOSERS)) + '"'


def _patterns(most: str) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """Terminators, quotation marks and brackets, and extended terminators, among characters up to one: small sets are searched fastest."""
    ends, marks, extending = ("".join(c for c in x if c <= most) for x in (_ENDS, _MARKS, EXTENDING))
    extended = f"[{re.escape(ends)}][{re.escape(extending)}]" if extending else r"(?!)"
    return re.compile(f"[{re.escape(ends)}]+"), re.compile(f"[{re.escape(marks)}]"), re.compile(extended)


_ASCII, _BASIC, _FULL = (_patterns(c) for c in ("\x7f", "\uffff", "\U0010ffff"))
_BEYOND = re.compile("[\U00010000-\U0010ffff]")
_GREEK_STOP = re.compile(f"[{re.escape(_ENDS)}]+|(?<=[\u0370-\u03ff\u1f00-\u1fff])[{GREEK_QUESTION}]")
_GREEK = re.compile(r"[\u0370-\u03ff\u1f00-\u1fff]{3}")
_EXTENDING = re.compile(f"[{re.escape(EXTENDING)}]+")
_UNSPACED = re.compile(r"(?<=[ก-๛ກ-ໟ])\s+(?=[ก-๛ກ-ໟ])")
_HAS_UNSPACED = re.compile(r"[ก-๛ກ-ໟ]")
_SPACE = re.compile(r"(?:\s|﻿)*")
_TOKEN = re.compile(r"[^\s\ufeff(\[{“„«‘‚‹「『（\"]*\Z")
_WORD = re.compile(r"\w*")
_YEAR = re.compile(r"[0-9IVXLCХІ]\s*\Z")
_NAME_OF_CALL = re.compile(r"[a-z]\w*(?:\(\)|_\w)")


def _cjk(c: str) -> bool:
    """A letter of a script written without blanks between words."""
    return "ぁ" <= c <= "ヿ" or "㐀" <= c <= "鿿" or "豈" <= c <= "﫿" or "\U00020000" <= c <= "\U000323af" or c in "々〇"


def _spans(text: str, start: int, end: int, marks: re.Pattern) -> list[tuple[int, int]]:
    """Outermost matched quotations and brackets, as (opening, closing) positions in order.

    A mark without partner counts for nothing; a single closing quote between letters is an apostrophe.
    """
    stack: list[tuple[int, str]] = []
    pairs: list[tuple[int, int]] = []
    for m in marks.finditer(text, start, end):
        c, i = m.group(), m.start()
        if c == "’" and i + 1 < end and text[i + 1].isalnum():
            continue
        depth = next((k for k in range(len(stack) - 1, -1, -1) if c in stack[k][1]), None)
        if depth is not None:
            pairs.append((stack[depth][0], i))
            del stack[depth:]
        elif c == '"':
            stack.append((i, '"'))
        elif c in OPENERS:
            stack.append((i, OPENERS[c]))
    pairs.sort()
    outer: list[tuple[int, int]] = []
    for a, b in pairs:
        if not outer or a > outer[-1][1]:
            outer.append((a, b))
    return outer


def _ends_inside(text: str, opening: int, closing: int) -> str:
    """The terminator with which the contents of a quotation or bracket end, or nothing."""
    k = closing
    while k > opening + 1 and (text[k - 1].isspace() or text[k - 1] in CLOSERS):
        k -= 1
    c = text[k - 1]
    return c if c in TERMINATORS or c in FULL_STOPS or c in ELLIPSIS else ""


def _goes_on(text: str, opening: int, closing: int, end: int, before: bool) -> bool:
    """Whether the sentence of a quotation or bracket goes on after it; before: a clause stands before it."""
    last = _ends_inside(text, opening, closing)
    if not last:
        return True
    k = _SPACE.match(text, closing + 1, end).end()
    if k >= end:
        return False
    c = text[k]
    if c.islower() and not _NAME_OF_CALL.match(text, k, end) or c in ",;:，；：、—–-)]）】" or c in TERMINATORS or c in FULL_STOPS or c in ELLIPSIS:
        return True
    if c.islower() or c.isupper() or c.isdigit() or not c.isalpha():
        return False
    if k == closing + 1:
        if text[opening] in BRACKETS:
            return before
        inner = text[opening + 1 : closing].rstrip(last + " ")
        if before and _cjk(c) and inner and not _cjk(inner[-1]):
            return False
        return c in PARTICLES if last in "。．." else True
    return not before and last not in FULL_STOPS and last not in "。।"


def _full_stop_ends(text: str, start: int, at: int, after: int, k: int, end: int, lists_of, block: tuple[int, int]) -> bool:
    """Whether one full stop at ``at`` ends the sentence; ``after``: past its closing marks, inside ``end``; ``k``: where the text goes on."""
    c = text[k]
    token = _TOKEN.search(text, max(start, at - 24), at).group()
    low = token.lower()
    lists = lists_of(low, *block) if low in _LISTED else _NONE
    numbered, final = lists.numbered, lists.final
    never = low in lists.never and (low not in TITLES or token[0].isupper())
    if low in AFTER_NUMBER and not _YEAR.search(text, max(start, at - len(token) - 24), at - len(token)):
        never = True
    last = token[-1:]
    uncased = last.isalpha() and not last.islower() and not last.isupper()
    whole = token.isalpha() and len(token) > 2 and low not in lists.never and low not in numbered and low not in final
    if c in ",;:，；：、" or c.islower() and not uncased and not (k > after and (whole or len(token) > 3 and _NAME_OF_CALL.match(text, k, end))):
        return False
    if k == after:
        if c.isdigit():
            return False
        plain = token.isalpha() and len(token) > 1 and last.islower() and not never
        if c.isupper():
            return plain or token.isdigit() and len(token) > 2 and (k + 1 >= end or not text[k + 1].isupper() and text[k + 1] not in FULL_STOPS)
        if _cjk(c):
            return not token.isdigit() and not never
        return plain and c in OPENERS
    if never:
        return False
    if len(token) == 1 and token.isupper():
        return False
    if c.isdigit():
        return low not in numbered
    if low in numbered and _WORD.match(text, k, end).end() - k == 1 and c.isupper():
        return False
    if token.isdigit() and len(token) < 3:
        return _WORD.match(text, k, end).group() not in MONTHS
    return True


def _ends(text: str, start: int, at: int, stop: int, after: int, end: int, lists_of, block: tuple[int, int]) -> bool:
    """Whether the terminators from ``at`` to ``stop`` end the sentence."""
    k = _SPACE.match(text, after, end).end()
    if k >= end:
        return True
    run, c = text[at:stop], text[k]
    if c in ",;，；、":
        return False
    if len(run) == 1:
        if run in FULL_STOPS:
            return _full_stop_ends(text, start, at, after, k, end, lists_of, block)
        if run in GREEK_QUESTION:
            return not c.islower()
    if all(x in FULL_STOPS or x in ELLIPSIS for x in run):
        if k == after:
            return (_cjk(c) or c in OPENERS and _cjk(text[at - 1])) and at > start and not text[at - 1].isspace()
        return not c.isdigit() and (not c.islower() or bool(_NAME_OF_CALL.match(text, k, end)))
    if k == after and run[-1] in "!?" and c.isalnum():
        return _cjk(c) or c.isupper() and at > start and text[at - 1].islower()
    return True


def _block(text: str, start: int, end: int, out: list[tuple[int, int]], lists_of, stops: re.Pattern, marks: re.Pattern, extended: bool) -> None:
    """Sentences of one block without blank lines and list items inside."""
    spans = _spans(text, start, end, marks) if marks.search(text, start, end) else []
    cuts = [m.start() for m in _UNSPACED.finditer(text, start, end)] if _HAS_UNSPACED.search(text, start, end) else []
    marker = _MARKER.match(text, start, end)
    begin, at, k, free = start, marker.end() if marker else start, 0, None
    stop, here = None, -1
    while at < end:
        if here < at:  # a terminator ahead stays the next one however many brackets lie before it
            stop = stops.search(text, at, end)
            here = stop.start() if stop else end
        if k < len(spans) and spans[k][0] < here and spans[k] != free:
            opening, closing = spans[k]
            before = bool(text[begin:opening].strip("﻿ \t\r\n\xa0")) and not (marker and begin == start and opening <= marker.end())
            on = _goes_on(text, opening, closing, end, before)
            if not before and not on:
                free = spans[k]
                continue
            at, k = closing + 1, k + 1
            if not on:
                while at < end and text[at] in CLOSERS:
                    at += 1
                out.append((begin, at))
                begin = at
            continue
        if not stop:
            break
        after = stop.end()
        if extended and (m := _EXTENDING.match(text, after, end)):
            after = m.end()
        while k < len(spans) and after > spans[k][1]:
            k += 1
        close = after
        while close < end:
            if text[close] in CLOSERS or text[close] == '"' and k < len(spans) and spans[k][1] == close:
                close += 1
            elif text[close].isspace() and free and (q := _SPACE.match(text, close, end).end()) == free[1]:
                close = q + 1
            else:
                break
        if _ends(text, begin, here, stop.end(), close, end, lists_of, (start, end)):
            out.append((begin, close))
            begin = close
        at = close
        while k < len(spans) and at > spans[k][1]:
            k, free = k + 1, None
    if begin < end:
        out.append((begin, end))
    if cuts:
        whole, kept = out[:], []
        for a, b in whole:
            if a < start:
                kept.append((a, b))
                continue
            for c in cuts:
                if a < c < b:
                    kept.append((a, c))
                    a = c
            kept.append((a, b))
        out[:] = kept


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """Units of a text as (start, end) positions of characters, end exclusive."""
    raw: list[tuple[int, int]] = []
    at, n = 0, len(text)
    ascii_only = text.isascii()
    stops, marks, extended = _ASCII if ascii_only else _FULL if _BEYOND.search(text) else _BASIC
    if not ascii_only and _GREEK.search(text):
        stops = _GREEK_STOP
    shared = speaker(text), stops, marks, not ascii_only and bool(extended.search(text))
    for blank in [*_BLANK.finditer(text), None]:
        end = blank.start() if blank else n
        listed = False
        for item in _ITEM.finditer(text, at, end):
            head = text[at : item.start()].rstrip()
            listed = listed or bool(_MARKER.match(text, at, end))
            if item.group(1) in BULLETS or listed or head[-1:] in (":", ";", "："):
                _block(text, at, item.start(), raw, *shared)
                at, listed = item.end(), True
        if at < end:
            _block(text, at, end, raw, *shared)
        at = blank.end() if blank else n
    out = []
    for a, b in raw:
        while a < b and (text[a].isspace() or text[a] == "﻿"):
            a += 1
        while b > a and (text[b - 1].isspace() or text[b - 1] == "﻿"):
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def split_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per unit: the id, ``sent_start``, ``sent_end`` and, if asked for, ``sentence``.

    Null, empty and blank texts have no units. Repeated rows give repeated units. Other columns are not read.
    Texts are split where they are read: no shuffle.
    """
    source = spread(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")))
    fields = [source.schema[id_col], T.StructField("sent_start", T.IntegerType(), False), T.StructField("sent_end", T.IntegerType(), False)]
    if with_text:
        fields.append(T.StructField("sentence", T.StringType(), False))

    def split(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            owners, starts, ends, pieces = [], [], [], []
            for i, text in enumerate(texts):
                if text:
                    for a, b in sentence_spans(text):
                        owners.append(i)
                        starts.append(a)
                        ends.append(b)
                        if with_text:
                            pieces.append(text[a:b])
            columns = [batch.column(0).take(pa.array(owners, pa.int32())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
            if with_text:
                columns.append(pa.array(pieces, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return source.mapInArrow(split, T.StructType(fields))
