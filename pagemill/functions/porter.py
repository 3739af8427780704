"""Porter stemming (Porter 1980, with the common toolkit extensions) as native
expressions: a chain of transforms, one per step, for the tokens whose ending some
step looks for; nothing leaves the JVM or the row."""

from __future__ import annotations

from pyspark.sql import Column

from pagemill.functions.arrays import let_sql

# Stem shapes. [C]V... with y a vowel after a consonant.
_HEAD = r"^(?:[^aeiou][^aeiouy]*[aeiouy]|[aeiou])[aeiou]*"
_C = r"[^aeiou][^aeiouy]*"
_V = r"[aeiouy][aeiou]*"
M_GT_0 = _HEAD + _C
M_GT_1 = _HEAD + _C + _V + _C
M_EQ_1 = _HEAD + _C + f"(?:{_V})?"
HAS_VOWEL = r"^(?:[^aeiou][^aeiouy]*[aeiouy]|[aeiou])"
CVC = r"(?:(?:[^aeiouy]|(?:^|[aeiou])y)[aeiouy][^aeiouwxy]|^[aeiou][^aeiou])"

# Irregular forms.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}

# Suffix, replacement; the first suffix that matches decides.
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
    "iti", "ous", "ive", "ize",
]


def _cut(n: int) -> str:
    return f"left(x, length(x) - {n})"


def _swap(suffix: str, to: str) -> str:
    return f"concat({_cut(len(suffix))}, '{to}')" if to else _cut(len(suffix))


def _first_rule(rules: list[tuple[str, str, str]]) -> str:
    """CASE over (suffix, pattern, result): the first suffix decides. Most tokens are
    told apart by their last two letters."""
    ends = ", ".join(sorted({f"'{suffix[-2:]}'" for suffix, _, _ in rules}))
    body = " ".join(
        f"WHEN endswith(x, '{suffix}') THEN CASE WHEN x RLIKE '{pattern}' THEN {result} ELSE x END"
        for suffix, pattern, result in rules
    )
    return f"CASE WHEN NOT substring(x, -2) IN ({ends}) THEN x {body} ELSE x END"


# A token that lost "ed" or "ing" carries this mark until the next step.
_MARK = "\x01"

_STEPS = [
    # 1a
    f"""CASE WHEN NOT endswith(x, 's') THEN x WHEN endswith(x, 'ies') AND length(x) = 4 THEN {_cut(1)}
      WHEN endswith(x, 'sses') THEN {_cut(2)} WHEN endswith(x, 'ies') THEN {_cut(2)} WHEN endswith(x, 'ss') THEN x
      ELSE {_cut(1)} END""",
    # 1b
    f"""CASE WHEN endswith(x, 'ied') THEN CASE WHEN length(x) = 4 THEN {_cut(1)} ELSE {_cut(2)} END
      WHEN endswith(x, 'eed') THEN CASE WHEN x RLIKE '{M_GT_0}.*eed$' THEN {_cut(1)} ELSE x END
      WHEN endswith(x, 'ed') AND x RLIKE '{HAS_VOWEL}.*ed$' THEN concat({_cut(2)}, '{_MARK}')
      WHEN endswith(x, 'ing') AND x RLIKE '{HAS_VOWEL}.*ing$' THEN concat({_cut(3)}, '{_MARK}')
      ELSE x END""",
    # 1b, repair of what is left
    f"""CASE WHEN NOT endswith(x, '{_MARK}') THEN x
      WHEN x RLIKE '(?:at|bl|iz){_MARK}$' THEN concat({_cut(1)}, 'e')
      WHEN length(x) > 2 AND left(right(x, 2), 1) = left(right(x, 3), 1)
        AND (NOT contains('aeiouy', left(right(x, 2), 1)) OR x RLIKE '[^aeiouy]yy{_MARK}$')
        THEN CASE WHEN left(right(x, 2), 1) IN ('l', 's', 'z') THEN {_cut(1)} ELSE {_cut(2)} END
      WHEN x RLIKE '{M_EQ_1}{_MARK}$' AND x RLIKE '{CVC}{_MARK}$' THEN concat({_cut(1)}, 'e')
      ELSE {_cut(1)} END""",
    # 1c
    f"CASE WHEN endswith(x, 'y') AND x RLIKE '(?:.[^aeiouy]|[aeiou]y)y$' THEN concat({_cut(1)}, 'i') ELSE x END",
    # 2: "alli" first, because its result goes through the step again
    f"CASE WHEN endswith(x, 'alli') AND x RLIKE '{M_GT_0}.*alli$' THEN {_cut(2)} ELSE x END",
    _first_rule(
        [(s, f"{M_GT_0}.*{s}$", _swap(s, to)) for s, to in STEP_2] + [("logi", f"{M_GT_0}.*ogi$", _cut(1))]
    ),
    # 3
    _first_rule([(s, f"{M_GT_0}.*{s}$", _swap(s, to)) for s, to in STEP_3]),
    # 4
    _first_rule(
        [(s, f"{M_GT_1}.*{'(?<=[st])' if s == 'ion' else ''}{s}$", _cut(len(s))) for s in STEP_4]
    ),
    # 5
    f"""CASE WHEN endswith(x, 'e') THEN CASE WHEN x RLIKE '{M_GT_1}.*e$' OR (x RLIKE '{M_EQ_1}e$' AND NOT x RLIKE '{CVC}e$')
        THEN {_cut(1)} ELSE x END
      WHEN endswith(x, 'll') AND x RLIKE '{M_GT_1}.*l$' THEN {_cut(1)} ELSE x END""",
]


def _endings() -> tuple[list[str], list[str]]:
    """Last letters and last pairs of letters that some step looks for. A token that
    has none of them passes all steps as it is."""
    letters = ["s", "y", "e", _MARK]
    suffixes = ["ed", "ing", "alli", "logi", "ll", *(x for x, _ in STEP_2 + STEP_3), *STEP_4]
    return letters, sorted({x[-2:] for x in suffixes if x[-1] not in letters})


def _program() -> str:
    body = "array(token)"
    for step in _STEPS:
        body = f"transform({body}, x -> {step})"
    odd = " ".join(f"WHEN '{word}' THEN '{stem}'" for word, stem in IRREGULAR.items())
    letters, pairs = (", ".join(f"'{x}'" for x in xs) for xs in _endings())
    listed = ", ".join(f"'{word}'" for word in IRREGULAR)
    return f"""t -> transform(t, token -> CASE WHEN length(token) <= 2 THEN token
      WHEN NOT (substring(token, -1) IN ({letters}) OR substring(token, -2) IN ({pairs})) THEN token
      WHEN token IN ({listed}) THEN CASE token {odd} END ELSE get({body}, 0) END)"""


_PROGRAM = _program()


def stems(tokens: Column) -> Column:
    """Stem of every token of an array of lower-case tokens."""
    return let_sql(tokens, _PROGRAM)
