"""SQL fragments for the oracle's dialect: the same normalisations without look-around."""

from __future__ import annotations

from ..functions import text as T

SPACES = r"\t\n\x0B\f\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
DASH = r"\x{2010}-\x{2015}"


def squeeze(c: str) -> str:
    return f"trim(regexp_replace({c}, '[{SPACES}]+', ' ', 'g'))"


def _unwrap(c: str, letters: str) -> str:
    # Without look-ahead the letter after the break is put back.
    return f"regexp_replace({c}, '([{letters}])[-{DASH}][{SPACES}]*\\n[{SPACES}]*([{letters}])', '\\1\\2', 'g')"


def normal_text(c: str) -> str:
    bare = f"regexp_replace(coalesce({c}, ''), '\\x{{AD}}', '', 'g')"
    return f"lower({squeeze(_unwrap(bare, 'A-Za-z'))})"


def separate(c: str) -> str:
    return f"trim(regexp_replace(replace({_unwrap(c, 'a-z')}, '&', ' and '), '[^a-z0-9+#.]+', ' ', 'g'))"


def search(c: str) -> str:
    return separate(f"regexp_replace(lower(coalesce({c}, '')), '\\x{{AD}}', '', 'g')")


def singular(t: str) -> str:
    return (
        f"CASE WHEN length({t}) > 5 AND {t} LIKE '%ies' THEN left({t}, length({t}) - 3) || 'y' WHEN length({t}) > 5 AND {t} LIKE '%sses' THEN left({t}, length({t}) - 2) "
        f"WHEN length({t}) > 4 AND {t} LIKE '%s' AND NOT regexp_matches({t}, '(ss|us|is|ics)$') THEN left({t}, length({t}) - 1) ELSE {t} END"
    )


def name(c: str, one: bool = False) -> str:
    flat = separate(f"lower(coalesce({c}, ''))")
    return f"array_to_string(list_transform(string_split({flat}, ' '), lambda x: {singular('x')}), ' ')" if one else flat


def words(c: str) -> str:
    return f"list_distinct(list_filter(string_split({c}, ' '), lambda w: w <> ''))"


def content(c: str, stops: list[str], shortest: int) -> str:
    listed = ", ".join(f"'{s}'" for s in stops)
    return f"list_filter({words(name(c))}, lambda w: length(w) >= {shortest} AND w NOT IN ({listed}))"


def jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"


def quote_in(q: str, t: str) -> str:
    q, t = normal_text(q), normal_text(t)
    sq, st = (f"regexp_replace({x}, '[-{SPACES}]+', '', 'g')" for x in (q, t))
    return f"({q} <> '' AND (contains({t}, {q}) OR (length({sq}) >= 12 AND contains({st}, {sq}))))"


def clean_chunk(c: str) -> str:
    bare = _unwrap(f"regexp_replace(coalesce({c}, ''), '\\x{{AD}}', '', 'g')", "A-Za-z")
    lines = f"regexp_replace(regexp_replace({bare}, '[ \\t]+\\n', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"regexp_replace({lines}, '^[{SPACES}]+|[{SPACES}]+$', '', 'g')"


def clamp(c: str, default: float = 0.0) -> str:
    return f"CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN {default} ELSE greatest(0.0, least(1.0, {c})) END"


def collapsed(c: str) -> str:
    return f"regexp_replace(lower({c}), '[^a-z0-9]', '', 'g')"


def cue(c: str, kind: str) -> str:
    return f"regexp_matches({c}, '(?i)\\b({T.CUES[kind]})\\b')"
