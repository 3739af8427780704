"""Text functions: masking, tokens, sentences, cleaning, list flattening."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.functions.arrays import let_sql, quoted
from pagemill.functions.porter import stems

_SPECIAL = re.compile(r"([\\.\[\]{}()*+?^$|#&~\-/])")
WORD = r"[\p{L}\p{N}_]+"


def _alternatives(phrases: Sequence[str]) -> str:
    """One alternation, grouped by first letter: a position that starts no phrase
    costs one test per letter. Phrases of one letter keep their order, and those
    of different letters never compete."""
    quote = lambda p: _SPECIAL.sub(r"\\\1", p)
    groups: dict[str, list[str]] = {}
    for phrase in phrases:
        first = phrase[0].lower() if phrase[0].isascii() else phrase[0]
        groups.setdefault(first, []).append(phrase[1:])
    return "|".join(f"{quote(first)}(?:{'|'.join(quote(r) for r in rests)})" for first, rests in groups.items())


def mask_phrases(text: Column, phrases: Sequence[str]) -> Column:
    """Replace listed phrases. Left of a match: the start or a character outside
    letters, digits, '-' and '.'. Right of it: the end or a non-word character."""
    listed = [p.strip() for p in phrases if p and p.strip()]
    if not listed:
        return text
    body = _alternatives(listed)
    # A dollar or backslash in a replacement is special; the mask has neither.
    return F.regexp_replace(text, rf"(?i)(?<![a-zA-Z0-9\-.])(?:{body})(?=\z|\W)", fixed.MASK_TEXT)


_WORDS = f"filter(regexp_extract_all(s, {quoted(WORD)}, 0), w -> NOT contains(w, '_'))"


def words(text: Column) -> Column:
    """Alphanumeric tokens in order, case kept. `foo_bar` vanishes; `it's` gives
    `it` and `s`."""
    return let_sql(text, f"s -> {_WORDS}")


def _outside(word: str, stop: Sequence[str]) -> str:
    return f"NOT {word} IN ({', '.join(quoted(x) for x in stop)})" if stop else "true"


def tokens(text: Column, stop: Sequence[str] | None = None) -> Column:
    """Lower-cased alphanumeric tokens without stop words, order kept."""
    stop = [*fixed.STOP_WORDS, fixed.MASK_TOKEN] if stop is None else list(stop)
    return let_sql(text, f"s -> filter(transform({_WORDS}, w -> lower(w)), w -> {_outside('w', stop)})")


def model_words(text: Column, stop: Sequence[str] | None = None) -> Column:
    """Tokens of the relevance model before stemming: longer than two letters,
    stop list tested before lower-casing."""
    stop = [*fixed.STOP_WORDS, *fixed.MODEL_STOP_WORDS] if stop is None else list(stop)
    return let_sql(
        text, f"s -> transform(filter({_WORDS}, w -> length(w) > 2 AND {_outside('w', stop)}), w -> lower(w))"
    )


def model_tokens(text: Column, stop: Sequence[str] | None = None) -> Column:
    """Stemmed model tokens; a stem that is a stop word is dropped as well."""
    stop = [*fixed.STOP_WORDS, *fixed.MODEL_STOP_WORDS] if stop is None else list(stop)
    return let_sql(stems(model_words(text, stop)), f"t -> filter(t, w -> {_outside('w', stop)})")


def is_alnum(token: Column) -> Column:
    return token.rlike(r"^[\p{L}\p{N}]+$")


def sentences(text: Column) -> Column:
    """Sentences of more than three words, split after .!? and at newlines."""
    spaced = F.regexp_replace(text, r"(.)\.(.)", "$1. $2")
    pieces = F.flatten(
        F.transform(F.split(spaced, r"(?<=[.!?])\s+"), lambda s: F.split(s, "\n"))
    )
    trimmed = F.transform(
        F.filter(pieces, lambda s: F.length(s) > 3), lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")
    )
    return F.filter(trimmed, lambda s: F.size(F.split(s, r"\s+")) > 3)


def clean_control(text: Column) -> Column:
    """Newline, carriage return and tab become dots."""
    return F.translate(text, "\n\r\t", "...")


def clean_csv(text: Column) -> Column:
    """Newline, carriage return and comma become dots."""
    return F.translate(text, "\n\r,", "...")


def strip_csv(text: Column) -> Column:
    """Newline, carriage return and comma removed."""
    return F.translate(text, "\n\r,", "")


def comma_list(values: Column) -> Column:
    return F.array_join(values, ",")


def semicolon_list(values: Column) -> Column:
    return F.array_join(values, ";")
