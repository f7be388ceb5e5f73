"""String column functions (STR-1 .. STR-7).

All are built-in Spark expressions: they run inside whole-stage codegen (or,
for the lambda ones, JVM-side interpreted), never in Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import (FULL_COLUMN_COUNT, PADDING_RULES, PARITY_LEADING_DOT,
                     PARITY_NUMBER_PATTERN)

# Default number pattern keeps the sign and a bare leading dot ("-.5").
NUMBER_PATTERN = r"[-+]?(\d+\.?\d*|\.\d+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text: Column | str) -> Column:
    """Whole text -> array of lines, trailing empty line kept (limit -1).  A line
    ends at CRLF, CR or LF; two literal replacements (which leave a text without
    CR as it is) and a one-character split take a fraction of a pattern's time."""
    one_kind = F.replace(F.replace(_col(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.split(one_kind, "\n", -1)


def _ws_flag(unicode_ws: bool) -> str:
    # Java's \s is ASCII whitespace; (?U) widens it to Unicode White_Space
    # (no-break and em spaces ...), closer to Python's str.split().
    return "(?U)" if unicode_ws else ""


def trim_ws(c: Column | str, unicode_ws: bool = False) -> Column:
    """Strip leading/trailing whitespace of any kind (SQL ``trim`` strips spaces only)."""
    return F.regexp_replace(_col(c), _ws_flag(unicode_ws) + r"^\s+|\s+$", "")


def has_text(c: Column | str, unicode_ws: bool = False) -> Column:
    """Whether anything but white space is there: ``trim_ws`` is not empty."""
    return F.rlike(_col(c), F.lit(_ws_flag(unicode_ws) + r"\S"))


def tokens(line: Column | str, unicode_ws: bool = False) -> Column:
    """STR-1: split on runs of whitespace, ends trimmed; a blank line -> [].

    ``split('')`` in Spark gives ``['']``; removing empty strings keeps token
    counts right (a trimmed line has no other empty token), and the trimmed
    line is used once, so its regex runs once.  ``unicode_ws=True`` also
    splits on non-ASCII spaces.
    """
    t = trim_ws(line, unicode_ws)
    return F.array_remove(F.split(t, _ws_flag(unicode_ws) + r"\s+"), "")


def _pad_for_count(t: Column, n: int, inserts: Sequence[tuple[int, int]]) -> Column:
    parts: list[Column] = []
    start = 0
    for after, k in sorted(inserts):
        parts.append(F.slice(t, start + 1, after - start + 1))
        parts.append(F.array_repeat(F.lit(""), k))
        start = after + 1
    parts.append(F.slice(t, start + 1, max(n - start, 0)))
    return F.concat(*parts)


def pad_ragged(t: Column | str,
               rules: Mapping[int, Sequence[tuple[int, int]]] = PADDING_RULES) -> Column:
    """STR-2: insert empty cells after given token positions, by token count.

    ``rules`` maps a token count to ``[(after_index, cells), ...]``; arrays of
    any other length pass through unchanged.
    """
    t = _col(t)
    out = None
    for n, inserts in sorted(rules.items()):
        branch = _pad_for_count(t, n, inserts)
        out = (F.when(F.size(t) == n, branch) if out is None
               else out.when(F.size(t) == n, branch))
    return t if out is None else out.otherwise(t)


def is_irregular(t: Column | str,
                 rules: Mapping[int, Sequence[tuple[int, int]]] = PADDING_RULES,
                 full_count: int = FULL_COLUMN_COUNT) -> Column:
    """True when a line's token count is neither full nor covered by a padding rule."""
    ok = sorted(set(rules) | {full_count})
    return ~F.size(_col(t)).isin(ok)


def token_columns(t: Column | str, names: Sequence[str]) -> list[Column]:
    """SRC-3 / PRJ-2: array cells -> named columns, NULL past the end."""
    t = _col(t)
    return [F.get(t, i).alias(n) for i, n in enumerate(names)]


def join_tokens(t: Column | str, sep: str = ",") -> Column:
    """STR-3: tokens joined by a separator."""
    return F.array_join(_col(t), sep)


def first_number(c: Column | str, parity: bool = False) -> Column:
    """STR-4/STR-5: first number found in a string, as DOUBLE; NULL when none.

    Default keeps the sign and reads ``-.5`` as -0.5.  ``parity=True``
    reproduces the source jobs: ``^\\.`` -> ``0.`` then the first unsigned
    ``\\d+\\.?\\d*`` (so ``-0.5`` -> 0.5 and ``-.5`` -> 5.0).
    """
    s = _col(c).cast("string")
    # regexp_substr is NULL when nothing matches (regexp_extract would give
    # ''), so the match is used once and needs no emptiness test.
    if parity:
        s = F.regexp_replace(s, *PARITY_LEADING_DOT)
        m = F.regexp_substr(s, F.lit(PARITY_NUMBER_PATTERN))
    else:
        m = F.regexp_substr(s, F.lit(NUMBER_PATTERN))
        # "-.5" / ".5" -> "-0.5" / "0.5" so every engine parses it alike
        m = F.regexp_replace(m, r"^([-+]?)\.", "$10.")
    return m.try_cast("double")


def strip_spaces(c: Column | str) -> Column:
    """STR-6: remove every space ('PADD 3' -> 'PADD3')."""
    return F.replace(_col(c), F.lit(" "), F.lit(""))


def compose_key(sep: str, *parts: Column | str) -> Column:
    """STR-7: key parts joined by a separator (NULL parts skipped)."""
    return F.concat_ws(sep, *[_col(p) for p in parts])


def contains_text(c: Column | str, needle: Column | str) -> Column:
    """FLT-1: case-sensitive substring test."""
    n = F.lit(needle) if isinstance(needle, str) else needle
    return F.contains(_col(c), n)
