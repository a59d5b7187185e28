"""Text normalisation, predicates and scores as Column expressions.

All run inside the JVM, but for compatibility normalisation (NFKC), which no built-in offers: it is a pandas
UDF and can be switched off for text that is known to be plain.
"""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as K

#: White space as the reference's patterns understand it.
SPACES = "\\t\\n\\x0B\\f\\r \\x1C-\\x1F\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
_DASH = "\\u2010-\\u2015"

# Words that say nothing about a definition.
DEFINITION_STOPS = "the a an of to and or that in on for with by from is are as which through system operating service mechanism process program".split()
# Words that cannot anchor a quote.
ANCHOR_STOPS = "a an and as at by for from in is of on or the to with system operating process program computer service mechanism concept".split()
# Words that do not count when candidates are sought.
CANDIDATE_STOPS = (
    "the a an of to and or that in on for with by from is are as which through system operating service mechanism concept computer "
    "program process memory data information using used use provides provide support supports within between"
).split()
# Least confidence of evidence by type, least overlap of a definition, least coverage of a name.
EVIDENCE_FLOORS = {"definition": 0.75, "example": 0.70, "usage": 0.70, "mention": 0.75}
OVERLAP_FLOOR, COVERAGE_FLOOR = 0.18, 0.67
# Words that signal a kind of statement.
CUES = {
    "causal": r"cause(s|d|ing)?|lead(s|ing)?\s+to|result(s|ed|ing)?\s+in|therefore|thus|consequently|because\s+of",
    "management": r"manage(s|d|ment)?|administer(s|ed|ing)?",
    "provision": r"provide(s|d|ing)?|offer(s|ed|ing)?|return(s|ed|ing)?",
    "enablement": r"enable(s|d|ing)?|allow(s|ed|ing)?|permit(s|ted|ting)?",
    "transition": r"transition(s|ed|ing)?|switch(es|ed|ing)?|move(s|d|ing)?|change(s|d|ing)?\s+(from|to)",
    "reduction": r"reduc(e|es|ed|ing)|decreas(e|es|ed|ing)|lower(s|ed|ing)?",
    "increase": r"increas(e|es|ed|ing)|rais(e|es|ed|ing)|higher",
}
# Endings and beginnings that a name may lose, and what is too general to stay alone.
VARIANT_SUFFIXES = [" Service", " Services", " Mechanism", " Method", " Model", " Approach", " Strategy", "-Service", "-Mechanism"]
VARIANT_PREFIXES = ["Operating-System ", "Operating System ", "OS "]
GENERIC_VARIANTS = "system service method model approach strategy mechanism process program interface operation".split()
# How general a type is, by words in its name; the first line that fits holds.
GENERALITY = [
    (10, "framework architecture discipline paradigm"),
    (8, "_category _type _family _group"),
    (8, "model approach strategy principle"),
    (8, "classification taxonomy"),
    (6, "service mechanism interface"),
    (6, "system_program system_software runtime"),
    (6, "design_concept design_principle design_decision design_goal"),
    (5, "concept abstraction layer"),
    (3, "implementation_strategy linking_mechanism compilation_strategy"),
    (3, "metadata artifact structure"),
]
GENERAL_ANYWHERE = "category type family framework architecture".split()
# Terms that are no concepts.
SEED_STOPS = (
    "chapter|section|figure|table|example|exercise|the|this|that|these|those|there|here|note|notes|practice|summary|review|questions|exercises|"
    "further|reading|programming|problems|bibliographical|bibliography|references|index|contents|preface|acknowledgments|appendix|"
    "figure caption|as shown|shown in|see also|next chapter|last chapter"
).split("|")


@F.pandas_udf(K.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility normalisation; nulls stay null."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def _text(c: Column | str, compat: bool) -> Column:
    c = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    return nfkc(c) if compat else c


def squeeze(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, f"[{SPACES}]+", " "))


def normalize_text(c: Column | str, compat: bool = False) -> Column:
    """Text as quotes are compared. Null becomes empty."""
    c = F.regexp_replace(_text(c, compat), "\\xAD", "")
    c = F.regexp_replace(c, f"([A-Za-z])[-{_DASH}][{SPACES}]*\\n[{SPACES}]*(?=[A-Za-z])", "$1")
    return F.lower(squeeze(c))


def normalize_search(c: Column | str, compat: bool = False) -> Column:
    """Text as names are sought in it: lower-case words of letters, digits, plus, hash and dot."""
    c = F.regexp_replace(F.lower(_text(c, compat)), "\\xAD", "")
    return _separate(c)


def _separate(c: Column) -> Column:
    c = F.regexp_replace(c, f"([a-z])[-{_DASH}][{SPACES}]*\\n[{SPACES}]*(?=[a-z])", "$1")
    return F.trim(F.regexp_replace(F.replace(c, F.lit("&"), F.lit(" and ")), "[^a-z0-9+#.]+", " "))


def singular(token: Column) -> Column:
    """T4: a token without a plain plural ending; words such as process and bus stay."""
    n = F.length(token)
    return (
        F.when((n > 5) & token.endswith("ies"), F.concat(token.substr(F.lit(1), n - 3), F.lit("y")))
        .when((n > 5) & token.endswith("sses"), token.substr(F.lit(1), n - 2))
        .when((n > 4) & token.endswith("s") & ~token.rlike("(ss|us|is|ics)$"), token.substr(F.lit(1), n - 1))
        .otherwise(token)
    )


def normalize_name(c: Column | str, singularize: bool = False, compat: bool = False) -> Column:
    """A name as lower-case words, singular if asked for."""
    name = _separate(F.lower(_text(c, compat)))
    return singular_words(name) if singularize else name


def singular_words(name: Column) -> Column:
    """T4: a normalised name with each word singular."""
    return F.array_join(F.transform(F.split(name, " "), singular), " ")


def name_keys(c: Column | str, compat: bool = False) -> Column:
    """T5: the distinct non-empty keys under which a name is found."""
    return F.array_distinct(F.filter(F.array(normalize_name(c, False, compat), normalize_name(c, True, compat)), lambda k: k != ""))


def has_phrase(phrase: Column, text: Column) -> Column:
    """A normalised phrase in normalised text, not inside a longer run of letters and digits."""
    safe = F.regexp_replace(phrase, "([.+])", "\\\\$1")
    # The plain search is cheap and rules out nearly all texts before a pattern is compiled.
    return (phrase != "") & F.contains(text, phrase) & F.regexp_like(text, F.concat(F.lit("(?<![a-z0-9])"), safe, F.lit("(?![a-z0-9])")))


def quote_in_text(quote: Column | str, text: Column | str, compat: bool = False) -> Column:
    """A normalised quote in normalised text; long quotes may differ in blanks and hyphens."""
    return quote_in_normal(normalize_text(quote, compat), normalize_text(text, compat))


def quote_in_normal(q: Column, t: Column) -> Column:
    """T7 for a quote and a text that are normalised already, so that a text is normalised once and not once per quote."""
    short_q, short_t = (F.regexp_replace(x, f"[-{SPACES}]+", "") for x in (q, t))
    return (q != "") & (F.contains(t, q) | ((F.length(short_q) >= 12) & F.contains(short_t, short_q)))


def clamp(c: Column, default: float = 0.0) -> Column:
    """A confidence within 0 and 1; null, NaN and infinity become the default."""
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(bad, F.lit(default)).otherwise(c.cast("double"))))


def words_of(c: Column) -> Column:
    """Distinct words of a normalised name; none for the empty one."""
    return F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Shared part of two arrays of distinct words."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def token_jaccard(a: Column | str, b: Column | str, compat: bool = False) -> Column:
    """Shared part of the singular words of two names."""
    return jaccard(words_of(normalize_name(a, True, compat)), words_of(normalize_name(b, True, compat)))


def content_words(c: Column | str, stops: list[str], shortest: int, singularize: bool = False, compat: bool = False) -> Column:
    """Distinct words of at least ``shortest`` letters that are no stop words."""
    words = words_of(normalize_name(c, singularize, compat))
    return F.filter(words, lambda w: (F.length(w) >= shortest) & ~w.isin(stops))


def definition_overlap(a: Column | str, b: Column | str, compat: bool = False) -> Column:
    """Shared part of the content words of two definitions."""
    return jaccard(content_words(a, DEFINITION_STOPS, 3, False, compat), content_words(b, DEFINITION_STOPS, 3, False, compat))


def section_compatible(section: Column, others: Column) -> Column:
    """A section equal to one of others, inside it or around it, by dotted numbers."""
    s = F.trim(F.coalesce(section, F.lit("")))
    return (s != "") & F.coalesce(F.exists(others, lambda o: (o == s) | o.startswith(F.concat(s, F.lit("."))) | s.startswith(F.concat(o, F.lit(".")))), F.lit(False))


def section_key(section: Column, unknown: int = 9999) -> Column:
    """A dotted section as numbers that sort naturally; what is no number sorts last."""
    numbers = F.transform(F.split(F.trim(section), "\\."), lambda p: F.when(p.rlike("^[0-9]{1,9}$"), p.cast("int")))
    return F.when(section.isNull() | F.exists(numbers, lambda n: n.isNull()), F.array(F.lit(unknown))).otherwise(numbers)


def lexically_present(names: Column, text: Column | str, compat: bool = False) -> Column:
    """Any of an array of names as a phrase of a text."""
    t = normalize_search(text, compat)
    return F.exists(names, lambda n: has_phrase(normalize_name(n), t))


def telling_words(names: Column) -> Column:
    """Of each name its singular words that can anchor a quote."""
    return F.transform(names, lambda n: F.filter(words_of(normalize_name(n, True)), lambda w: (F.length(w) > 2) & ~w.isin(ANCHOR_STOPS)))


def _coverage(telling: Column, seen: Column) -> Column:
    def share(words: Column) -> Column:
        both = F.size(F.array_intersect(words, seen))
        return F.when((F.size(words) >= 2) & (both >= 2), both / F.size(words)).otherwise(F.lit(0.0))

    return F.coalesce(F.array_max(F.transform(telling, share)), F.lit(0.0))


def name_coverage(names: Column, quote: Column | str, compat: bool = False) -> Column:
    """The best share of a name's telling words found in a quote, where two or more are found."""
    return _coverage(telling_words(names), words_of(normalize_name(quote, True, compat)))


def anchor_terms(names: Column, definition: Column | str) -> Column:
    """What ``anchored`` needs of a concept, so that it is made once per concept and not once per quote."""
    return F.struct(
        F.filter(F.transform(names, lambda n: normalize_name(n)), lambda n: n != "").alias("plain"),
        telling_words(names).alias("telling"),
        content_words(definition, DEFINITION_STOPS, 3).alias("content"),
    )


def anchored(rows: DataFrame, terms: str, quote: str, evidence_type: str) -> DataFrame:
    """Adds ``anchor`` and ``score``: by what a quote is tied to a concept, and how well.

    terms: a column made by ``anchor_terms``; null stands for an unknown concept. A name in the quote comes
    first, then enough of its telling words, then a definition's overlap.
    """
    made = rows.withColumns({"_q": normalize_search(quote), "_w": words_of(normalize_name(quote, True)), "_c": content_words(quote, DEFINITION_STOPS, 3)})
    made = made.withColumns(
        {
            "_named": F.coalesce(F.exists(F.col(f"{terms}.plain"), lambda n: has_phrase(n, F.col("_q"))), F.lit(False)),
            "_coverage": _coverage(F.col(f"{terms}.telling"), F.col("_w")),
            "_overlap": F.coalesce(jaccard(F.col("_c"), F.col(f"{terms}.content")), F.lit(0.0)),
        }
    )
    kind = (
        F.when(F.col("_named"), "name_or_alias_in_quote")
        .when(F.col("_coverage") >= COVERAGE_FLOOR, "distinctive_name_tokens_in_quote")
        .when((F.col(evidence_type) == "definition") & (F.col("_overlap") >= OVERLAP_FLOOR), "definition_overlap")
    )
    score = F.when(F.col("_named"), F.lit(1.0)).when(F.col("_coverage") >= COVERAGE_FLOOR, F.col("_coverage")).otherwise(F.col("_overlap"))
    return made.withColumns({"anchor": kind, "score": score}).drop("_q", "_w", "_c", "_named", "_coverage", "_overlap")


def json_object(c: Column) -> Column:
    """The outermost braces of a model's answer, with or without a code fence; null if there are none."""
    found = F.regexp_extract(c, "(?s)(\\{.*\\})", 1)
    return F.when(found != "", found)


def evidence_key(c: Column) -> Column:
    """Letters and digits alone, lower case."""
    return F.regexp_replace(F.lower(c), "[^\\p{L}\\p{N}]", "")


def spaceless_key(c: Column) -> Column:
    """Trimmed, lower case, without blanks."""
    return F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit(""))


def collapsed_key(c: Column) -> Column:
    """ASCII letters and digits alone, lower case."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def split_pascal(c: Column) -> Column:
    """Words of a name written together, parted at case and digit borders."""
    c = F.regexp_replace(c, "([A-Z]+)([A-Z][a-z])", "$1 $2")
    c = F.regexp_replace(c, "([a-z0-9])([A-Z])", "$1 $2")
    return F.trim(F.regexp_replace(c, "([A-Za-z])([0-9])", "$1 $2"))


def auto_variants(c: Column | str) -> Column:
    """Shorter forms of a name that are still telling: without known endings or beginnings, or its head before a comma."""
    base = squeeze(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))
    cut = [F.when(base.endswith(s), F.trim(base.substr(F.lit(1), F.length(base) - len(s)))) for s in VARIANT_SUFFIXES]
    cut += [F.when(base.startswith(p), F.trim(base.substr(F.lit(len(p) + 1), F.length(base)))) for p in VARIANT_PREFIXES]
    cut.append(F.when(F.contains(base, F.lit(",")), F.trim(F.substring_index(base, ",", 1))))

    def telling(v: Column) -> Column:
        return v.isNotNull() & (F.length(v) >= 3) & ~F.lower(v).isin(GENERIC_VARIANTS) & (F.contains(v, F.lit(" ")) | (F.length(v) >= 7))

    return F.array_sort(F.array_distinct(F.filter(F.array(*cut), telling)))


def cue(c: Column, kind: str) -> Column:
    """Whether a text has a word of a family of cues."""
    return F.regexp_like(c, F.lit(f"(?i)\\b({CUES[kind]})\\b"))


def clean_chunk(c: Column | str, compat: bool = False) -> Column:
    """H7: chunk text without soft hyphens, wrapped words, blanks at line ends and more than one empty line."""
    c = F.regexp_replace(_text(c, compat), "\\xAD", "")
    c = F.regexp_replace(c, f"([A-Za-z])[-{_DASH}][{SPACES}]*\\n[{SPACES}]*(?=[A-Za-z])", "$1")
    c = F.regexp_replace(F.regexp_replace(c, "[ \\t]+\\n", "\n"), "\\n{3,}", "\n\n")
    return F.regexp_replace(c, f"^[{SPACES}]+|[{SPACES}]+$", "")


def damaged_start(c: Column) -> Column:
    """A beginning that an overlap has cut: a mark, or a word that joins."""
    return F.regexp_like(F.regexp_replace(c, f"^[{SPACES}]+", ""), F.lit("^([,.;:)]|(?i)(is|are|was|were|and|or|but|which|that)\\b)"))


def trim_fragment(c: Column) -> Column:
    """Text from its next sentence on if its beginning is damaged and a sentence follows."""
    bare = F.regexp_replace(c, f"^[{SPACES}]+", "")
    rest = F.regexp_extract(bare, f"(?s)^.*?(?:[.!?][\"')\\]]?[{SPACES}]+|\\n[{SPACES}]*\\n)([A-Z].*)$", 1)
    return F.when(damaged_start(c) & (rest != ""), rest).otherwise(bare)


def incomplete_end(c: Column) -> Column:
    """An end that is surely cut: no closing mark, and a last word that needs another."""
    tail = F.substring(squeeze(F.coalesce(c, F.lit(""))), -180, 180)
    closed = F.regexp_like(tail, F.lit("[.!?;:)}\\]][\"']?$"))
    return (tail != "") & ~closed & F.regexp_like(tail, F.lit("(?i)\\b(a|an|the|and|or|but|to|of|in|on|for|with|from|that|which|whose|when|where)$"))


def contamination(c: Column) -> Column:
    """What a page's layout has mixed into a text, as an array of flags."""
    head = F.regexp_like(c, F.lit("(?m)^[ \\t]*[A-Z][A-Z ]{6,}[ \\t]*$"))
    side = F.regexp_like(c, F.lit("(?i)\\bIN\\s+PRACTICE\\b"))
    code = F.regexp_like(c, F.lit("\\b(DWORD|SIZE\\s+\\d+|char\\s*\\*|\\w+\\s*\\[\\s*\\d+\\s*\\])"))
    return F.array_compact(
        F.array(
            F.when(head, F.lit("sidebar_or_running_head")),
            F.when(side, F.lit("sidebar_contamination")),
            F.when(code, F.lit("code_fragment_contamination")),
            F.when(side & code, F.lit("cross_section_or_sidebar_mixed_content")),
        )
    )


def strip_labels(c: Column) -> Column:
    """Text without runs of figure labels before a caption, and words joined again that a caption had parted."""
    c = F.regexp_replace(c, "(?ims)(?:^|\\n)\\s*(?:from:|to:|port:).{0,2200}?(?=\\b(?:figure|table|diagram)\\s+\\d+\\.\\d+\\b)", "\n")
    return F.regexp_replace(c, "(?is)([A-Za-z]{3,})(?:figure|table|diagram)\\s+\\d+\\.\\d+[^\\n]{0,220}(?:\\n\\s*)+([a-z]{2,})", "$1$2")


def label_fragment(c: Column) -> Column:
    """Four lines or more, most of them short, with a sentence at most."""
    lines = F.filter(F.transform(F.split(c, "\\n"), lambda x: F.trim(x)), lambda x: x != "")
    short = F.size(F.filter(lines, lambda x: F.length(x) <= 35))
    return (F.size(lines) >= 4) & (short / F.greatest(F.size(lines), F.lit(1)) >= 0.7) & (F.regexp_count(c, F.lit("[.!?](\\s|$)")) <= 1)


def end_matter(c: Column) -> Column:
    """Headings of summaries, exercises and reading lists."""
    return F.regexp_like(F.trim(c), F.lit("(?i)^(\\d+(\\.\\d+)*\\s+)?(summary|practice exercises|exercises|further reading|bibliographical notes|bibliography|review questions|programming (problems|projects))$"))


def clean_title(c: Column) -> Column:
    """A title without a page number at its end and a chapter number at its beginning."""
    c = F.regexp_replace(squeeze(c), "\\s+\\d{1,4}\\s*$", "")
    return F.trim(F.regexp_replace(c, "^(?:Chapter|CHAPTER)\\s+\\d+\\s*[:：.]?\\s*", ""))


def plausible_seed(c: Column) -> Column:
    """A term that may be a concept: right length, capital first, no stop term, no number of a page or figure."""
    low = F.lower(F.trim(c))
    return (
        F.length(c).between(3, 60) & ~low.isin(SEED_STOPS) & ~F.regexp_like(low, F.lit("\\b(page|figure|table|section|chapter)\\s*\\d"))
        & ~F.regexp_like(c, F.lit("^[\\d.\\s-]+$")) & F.regexp_like(c, F.lit("^[A-Z]"))
    )


def generality(c: Column) -> Column:
    """How general a type is, from 1 to 10, by its words."""
    low = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    out = None
    for score, words in GENERALITY:
        for word in words.split():
            hit = low.endswith(word) if word.startswith("_") else (low == word) | F.contains(low, F.lit(f"_{word}")) | F.contains(low, F.lit(f"{word}_"))
            out = F.when(hit, score) if out is None else out.when(hit, score)
    anywhere = F.regexp_like(low, F.lit("|".join(GENERAL_ANYWHERE)))
    return out.when(anywhere, 7).otherwise(1)


# Phrases that speak for (+) or against (-) a relation from {s} to {t}.
DIRECTIONS = {
    "HAS_SUBTYPE": [
        ("+", r"\b{t}\s+is\s+(?:a|an|one\s+of\s+the)\s+(?:(?:type|kind|form|specific|specialized|example)\s+of\s+)?{s}\b"),
        ("+", r"\b{t},?\s+(?:which|that)\s+is\s+(?:a|an)\s+{s}\b"),
        ("+", r"\b{s}\s+(?:such\s+as|including|like|e\.g\.?|for\s+example)\s+[^.]*?{t}\b"),
        ("-", r"\b{s}\s+is\s+(?:a|an|one\s+of\s+the)\s+(?:(?:type|kind|form|specific|example)\s+of\s+)?{t}\b"),
        ("-", r"\b{t}\s+(?:such\s+as|including|like|e\.g\.?)\s+[^.]*?{s}\b"),
    ],
    "PART_OF": [
        ("+", r"\b{s}\s+is\s+(?:a\s+)?(?:part|component|element|piece|module)\s+of\s+{t}\b"),
        ("+", r"\b{s}\s+is\s+contained\s+in\s+{t}\b"),
        ("+", r"\b{t}\s+(?:contains|consists\s+of|includes|is\s+composed\s+of|comprises)\s+[^.]*?{s}\b"),
        ("+", r"\b{t}\s+provides\s+{s}\b"),
        ("+", r"\b{s}\s+within\s+{t}\b"),
        ("-", r"\b{t}\s+is\s+(?:a\s+)?(?:part|component|element|piece|module)\s+of\s+{s}\b"),
        ("-", r"\b{s}\s+(?:contains|consists\s+of|includes|comprises)\s+[^.]*?{t}\b"),
    ],
    "EXAMPLE_OF": [("+", r"\b{s}\s+is\s+(?:a|an)\s+example\s+of\s+{t}\b"), ("+", r"\b{t},?\s+(?:such\s+as|for\s+example|e\.g\.?)\s+[^.]*?{s}\b")],
    "IMPLEMENTS": [("+", r"\b{s}\s+implements?\s+{t}\b"), ("+", r"\b{s}\s+(?:is\s+an?\s+)?implementation\s+of\s+{t}\b"), ("+", r"\b{s}\s+provides?\s+{t}\s+interface\b")],
    "USED_FOR": [("+", r"\b{s}\s+(?:is\s+)?used\s+(?:for|to)\s+{t}\b"), ("+", r"\b{s}\s+enables?\s+{t}\b"), ("+", r"use\s+{s}\s+to\s+{t}\b")],
    "REQUIRES": [("+", r"\b{s}\s+requires?\s+{t}\b"), ("+", r"\b{s}\s+(?:needs?|depends?\s+on)\s+{t}\b")],
    "CAUSES": [("+", r"\b{s}\s+causes?\s+{t}\b"), ("+", r"\b{s}\s+leads?\s+to\s+{t}\b"), ("+", r"\b{s}\s+results?\s+in\s+{t}\b")],
}


def direction_signal(quote: Column, source: Column, target: Column, relation: Column) -> Column:
    """How a quote speaks for the direction of a relation: 3 for each phrase that fits, with its sign."""
    low = F.lower(F.coalesce(quote, F.lit("")))
    s, t = (F.concat(F.lit("\\Q"), F.lower(F.trim(x)), F.lit("\\E")) for x in (source, target))
    total = F.lit(0.0)
    for kind, phrases in DIRECTIONS.items():
        part = F.lit(0.0)
        for sign, phrase in phrases:
            pattern = F.replace(F.replace(F.lit(phrase), F.lit("{s}"), s), F.lit("{t}"), t)
            part = part + F.when(F.regexp_like(low, pattern), 3.0 if sign == "+" else -3.0).otherwise(0.0)
        total = F.when(relation == kind, part).otherwise(total)
    return total


@F.pandas_udf(K.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two strings; for pairs that another key has brought together."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])


def can_reach(a: str, b: str, floor: float) -> Column:
    """Whether the lengths of two strings allow a ratio of ``floor``."""
    return 2.0 * F.least(F.length(a), F.length(b)) >= (floor - 1e-9) * (F.length(a) + F.length(b))


def sequence_ratio_from(floor: float):
    """The ratio where it can reach ``floor`` by the letters of both strings, else null; letters alone rule out most pairs."""

    @F.pandas_udf(K.DoubleType())
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            m = difflib.SequenceMatcher(None, x or "", y or "")
            out.append(m.ratio() if m.quick_ratio() >= floor else None)
        return pd.Series(out, dtype="float64")

    return ratio


def snippet(text: Column, terms: Column, before: int = 180, width: int = 900) -> Column:
    """A window of a text around the earliest of some terms; its beginning if none occurs."""
    at = F.array_min(F.filter(F.transform(terms, lambda t: F.position(F.lower(t), F.lower(text))), lambda p: p > 0))
    return text.substr(F.greatest(F.coalesce(at, F.lit(1)) - before, F.lit(1)), F.lit(width))


def stable_id(kind: Column, payload: Column) -> Column:
    """A short id that the content alone decides."""
    return F.concat(kind, F.lit(":"), F.substring(F.sha1(payload), 1, 12))


def fingerprint(*parts: Column) -> Column:
    """A hash of all that an extraction depends on."""
    return F.sha2(F.concat_ws("\n", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def parse_chapters(value: str) -> list[int]:
    """Chapter numbers of a list such as "3,5-7": distinct, in order of first mention. Empty parts are skipped."""
    found: dict[int, None] = {}
    for part in value.split(","):
        first, dash, last = part.strip().partition("-")
        if first:
            low, high = int(first), int(last) if dash else int(first)
            if high < low:
                raise ValueError(f"range runs backwards: {part!r}")
            found.update(dict.fromkeys(range(low, high + 1)))
    return list(found)


def local_id(chapter: Column, section: Column, number: Column) -> Column:
    """The id of a local knowledge point."""
    return F.format_string("CH%02d_%s_KP%03d", chapter.cast("int"), F.coalesce(section, F.lit("sec")), number.cast("int"))


@F.pandas_udf(K.ArrayType(K.StringType()))
def _segment(tokens: pd.Series, words: pd.Series) -> pd.Series:
    out = []
    for token, known in zip(tokens, words):
        known = set(known) if known is not None else set()
        best: list = [None] * (len(token or "") + 1)
        best[0] = []
        for end in range(1, len(best)):
            for start in range(end):
                if best[start] is not None and token[start:end] in known and (best[end] is None or len(best[start]) + 1 < len(best[end])):
                    best[end] = [*best[start], token[start:end]]
        out.append(best[-1] if token and best[-1] else [token] if token else [])
    return pd.Series(out)


def segment(token: Column, words: Column) -> Column:
    """A token as the fewest words of a dictionary, leftmost first; the token itself if it has no such parts."""
    return _segment(token, words)
