"""The same text steps as SQL, for checking results in another engine."""

from __future__ import annotations

import unicodedata

from ..functions import lexicon as X
from ..functions.language import terms
from ..functions.text import matchable_literal
from ..functions.tokens import STOP


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _nfkc_map() -> str:
    """Characters of the scripts that occur whose compatibility form differs, as a SQL map."""
    codes = [*range(0xA0, 0x250), *range(0x2000, 0x2200), *range(0x3000, 0x3001), *range(0xFB00, 0xFFF0), 0x1680]
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))) for c in codes if not unicodedata.is_normalized("NFKD", chr(c))]
    return "MAP {" + ", ".join(f"{lit(a)}: {lit(b)}" for a, b in pairs) + "}"


def nfkc(c: str) -> str:
    return f"nfc_normalize(array_to_string(list_transform(string_split({c}, ''), lambda x: coalesce({_nfkc_map()}[x], x)), ''))"


def replaced(c: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({c}, {lit(pattern)}, {lit(by)}, 'g')"


def strip(c: str) -> str:
    return replaced(c, f"^{X.WS}+|{X.WS}+$")


def collapse(c: str) -> str:
    return f"trim({replaced(c, X.WS + '+', ' ')})"


def clean_steps(table: str, key: str, text: str, where: str = "") -> str:
    """CTEs c0 ... that end in `cleaned(key, c, m)`: the cleaned and the matchable form of each row."""
    steps = [f"c0 AS MATERIALIZED (SELECT {key}, {nfkc(f'coalesce({text}, {lit(chr(0)[:0])})')} AS t FROM {table} {where})"]
    t = replaced(replaced(replaced("t", X.INVISIBLE), X.MARKS), X.INLINE_TIME, "-")
    n = 0

    def step(expression: str) -> None:
        nonlocal n
        n += 1
        steps.append(f"c{n} AS MATERIALIZED (SELECT {key}, {expression} AS t FROM c{n - 1})")

    step(t)
    for i in range(2):
        for k in range(0, len(X.BOILERPLATE), 8):
            e = "t"
            for p in X.BOILERPLATE[k : k + 8]:
                e = replaced(e, f"(?m){p}")
            step(e)
        if not i:
            step(replaced(replaced("t", X.URL), X.EMOJI, " "))
    step(collapse("t"))
    m = replaced("t", r"[\x{5f3}\x{5f4}]", " ")
    m = replaced(m, rf"[^\p{{L}}\p{{N}}_\x{{590}}-\x{{5ff}}{X.WS[1:-1]}]", " ")
    steps.append(f"cleaned AS MATERIALIZED (SELECT {key}, t AS c, lower({collapse(m)}) AS m FROM c{n})")
    return ", ".join(steps)


def has_any(c: str, words) -> str:
    return "(" + (" OR ".join(f"contains({c}, {lit(w)})" for w in terms(words)) or "false") + ")"


def term_in(c: str, word: str) -> str:
    w = matchable_literal(word)
    return f"contains(' ' || {c} || ' ', {lit(f' {w} ')})" if len(w) <= 3 else f"contains({c}, {lit(w)})"


def tokens(m: str) -> str:
    """The list of significant tokens of a matchable text, in order."""
    bare = (
        f"CASE WHEN length(w) > 3 AND regexp_matches(w, '^[{X.ATTACHED}]') THEN CASE WHEN length(w) > 4 AND w[2] = 'ה' THEN w[3:] ELSE w[2:] END "
        "WHEN length(w) > 3 AND starts_with(w, 'ה') THEN w[2:] ELSE w END"
    )
    stem = "CASE " + " ".join(f"WHEN ends_with(w, '{e}') AND length(w) - {len(e)} >= 3 THEN w[:length(w) - {len(e)}]" for e in X.ENDINGS) + " ELSE w END"
    stop = ", ".join(lit(w) for w in STOP)
    return f"list_filter(list_transform(list_transform(string_split({m}, ' '), lambda w: {bare}), lambda w: {stem}), lambda w: length(w) > 2 AND w NOT IN ({stop}))"


def severity(m: str, default: str = "'low'") -> str:
    calm = has_any(m, X.CALMING)
    arms = " ".join(f"WHEN {has_any(m, words)} THEN " + (f"CASE WHEN {calm} THEN 'medium' ELSE '{level}' END" if level in ("critical", "high") else f"'{level}'") for level, words in X.SEVERITY.items())
    return f"CASE WHEN {m} = '' THEN {default} {arms} ELSE {default} END"
