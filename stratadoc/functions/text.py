"""Text functions as Spark columns: no UDF, so they stay inside whole-stage code generation."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed patterns.
DATA_IMAGE = r"(?i)!\[[^\]]*\]\(data:image/[^)]*\)|data:image/[^\s)]+"
BASE64_WORD = r"(?iU)\bbase64\b"
LINE_ENDS = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
#: Lengths that answers and result lists are cut to.
CONTEXT_CHARS, PREVIEW_CHARS = 2400, 200


def tokens(text: Column) -> Column:
    """Runs of letters and digits of the lower-cased text; accents stay."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def squeezed(text: Column) -> Column:
    """White space runs become one space; none at the ends; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


@cache
def _changes(rule: Callable[[str], str]) -> dict[str, str]:
    """What a rule makes of characters beyond ASCII, Hangul syllables and surrogates aside, where that is something else."""
    codes = (*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x110000))
    return {c: new for c in map(chr, codes) if (new := rule(c)) != c}


def respelled(text: Column, rule: Callable[[str], str]) -> Column:
    """Text with each character beyond ASCII as the rule (a Python function of one) has it; the rule's table is part of the plan."""
    table = _changes(rule)
    ones, none, more = ([c for c, new in table.items() if min(len(new), 2) == n] for n in (1, 0, 2))
    out = F.translate(text, "".join(ones + none), "".join(table[c] for c in ones))
    if not more:
        return out
    longer = F.map_from_arrays(*(F.split(F.lit("\n".join(x)), "\n") for x in (more, [table[c] for c in more])))
    found = F.filter(F.array_distinct(F.regexp_extract_all(out, F.lit(r"([^\x00-\x7F])"), F.lit(1))), lambda c: F.map_contains_key(longer, c))
    return F.aggregate(found, out, lambda s, c: F.replace(s, c, F.element_at(longer, c)))


def _fold(c: str) -> str:
    return c.casefold() if c == c.lower() else c


def _bare(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


def folded(text: Column) -> Column:
    """Squeezed text for comparison without case: Unicode's full case folding."""
    lower = F.lower(squeezed(text))
    early = "".join(c for c in _changes(_fold) if c < "\u0370")
    return F.when(lower.rlike(f"[{early}\u0370-\U0010ffff]"), respelled(lower, _fold)).otherwise(lower)


def bare(text: Column) -> Column:
    """Lower case of the compatibility decomposition without combining marks (Hangul syllables stay whole)."""
    return F.lower(F.when(text.rlike("[^\\x00-\\x7F]"), respelled(text, _bare)).otherwise(text))


def plain(text: Column) -> Column:
    """Paragraphs (between blank lines) of one line each, inner lines and blanks joined by single spaces."""
    stripped = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    line = lambda x: F.trim(F.regexp_replace(x, r"[ \t]+", " "))
    joined = lambda p: F.array_join(F.filter(F.transform(F.split(p, LINE_ENDS), line), lambda x: x != ""), " ")
    return F.array_join(F.filter(F.transform(F.split(stripped, r"(?U)\n\s*\n+"), joined), lambda x: x != ""), "\n\n")


def without_assets(text: Column) -> Column:
    """Plain text without inline images and the word base64."""
    return plain(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), DATA_IMAGE, ""), BASE64_WORD, ""))


def asset_markers(text: Column) -> Column:
    """How many inline images, and base64 words besides, a text holds."""
    text = F.coalesce(text, F.lit(""))
    return F.regexp_count(text, F.lit(DATA_IMAGE)) + F.regexp_count(F.regexp_replace(text, DATA_IMAGE, ""), F.lit(BASE64_WORD))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\w+"))


def letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\P{L}", ""))


def upper_heading(text: Column) -> Column:
    """Four letters or more, four fifths upper case, at most 180 characters, no full stop at the end."""
    upper = F.length(F.regexp_replace(text, r"\P{Lu}", ""))
    return (letters(text) >= 4) & (upper * 5 >= letters(text) * 4) & (F.length(text) <= 180) & ~F.rtrim(text).endswith(".")


def truncated(text: Column, limit: int = CONTEXT_CHARS) -> Column:
    """At most ``limit`` characters, with a note if any are missing; a limit of 0 or less is none."""
    if limit <= 0:
        return text
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.regexp_replace(F.substring(text, 1, limit), r"(?U)\s+$", ""), F.lit("\n[trecho truncado]")))


def pages(start: Column, end: Column) -> Column:
    """The pages of a range: none without either end, one if only one is known or the range is reversed."""
    first, last = F.coalesce(start, end), F.coalesce(end, start)
    return F.when(first.isNull(), F.array().cast("array<int>")).when(last < first, F.array(first)).otherwise(F.sequence(first, last))


def starts_mid(text: Column, numbered: Column) -> Column:
    """Begins with punctuation or a lower-case letter, and not with a clause number."""
    left = F.regexp_replace(text, r"(?U)^\s+", "")
    return (left != "") & ~numbered & (left.rlike(r"(?U)^[^\w\s]") | left.rlike(r"^\p{Ll}"))


def ends_mid(text: Column) -> Column:
    """Does not end in closing punctuation; a table never does."""
    right = F.regexp_replace(text, r"(?U)\s+$", "")
    return (right != "") & ~(right.startswith("|") & right.contains("\n|")) & ~right.rlike(r"[.!?:;)\]}|]$")
