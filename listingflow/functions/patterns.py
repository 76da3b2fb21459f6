"""Regular-expression portability.

Rule patterns are written the way the listing rules define them (ASCII word
boundaries, Unicode white space). Java reads ``\\b`` as Unicode-aware and ``\\s`` as
ASCII-only, so patterns go through :func:`java` before they reach Spark.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the rules understand it: ASCII blanks, no-break space, byte-order mark, Unicode separators.
_SPACES = r"\t\n\x0B\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
_BOUNDARY = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
_OPENS, _CLOSES = r"(?<!\w)", r"(?!\w)"


def _boundary(before: str, after: str) -> str:
    """The cheapest equivalent of an ASCII ``\\b`` between two pattern texts.

    Before a word character the boundary only has to look back, after one only ahead. Where the
    neighbours do not tell, both sides are looked at.
    """
    if re.match(r"(\(\?:|\()*([A-Za-z0-9]|\\[dw])", after) and re.search(r"(^|[(|:!])$", before):
        return _OPENS
    if re.search(r"(?<!\\)[A-Za-z0-9]\??\)?$", before) and re.match(r"$|[)|]|\\s|\(", after):
        return _CLOSES
    return _BOUNDARY


def java(pattern: str, ignore_case: bool = False) -> str:
    out: list[str] = []
    in_class = False
    i = 0
    while i < len(pattern):
        pair = pattern[i : i + 2]
        if pair == r"\s":
            out.append(_SPACES if in_class else f"[{_SPACES}]")
            i += 2
        elif pair == r"\b" and not in_class:
            out.append(_boundary(pattern[:i], pattern[i + 2 :]))
            i += 2
        elif pair.startswith("\\"):
            out.append(pair)
            i += 2
        else:
            in_class = (in_class or pair[0] == "[") and pair[0] != "]"
            out.append(pair[0])
            i += 1
    return ("(?i)" if ignore_case else "") + "".join(out)


def matches(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    return text.rlike(java(pattern, ignore_case))


def first_group(text: Column, pattern: str, group: int = 1, ignore_case: bool = False) -> Column:
    """The group of the first match, null when there is none."""
    compiled = java(pattern, ignore_case)
    return F.when(text.rlike(compiled), F.regexp_extract(text, compiled, group))


def all_groups(text: Column, pattern: str, group: int = 0, ignore_case: bool = False) -> Column:
    return F.regexp_extract_all(text, F.lit(java(pattern, ignore_case)), F.lit(group))


def replace_all(text: Column, pattern: str, replacement: str, ignore_case: bool = False) -> Column:
    return F.regexp_replace(text, java(pattern, ignore_case), replacement)


def trimmed(text: Column) -> Column:
    return replace_all(text, r"^\s+|\s+$", "")


def collapsed(text: Column) -> Column:
    """Every run of white space as one space; a run that is one space already is passed over."""
    other = _SPACES.replace(" ", "")
    return F.regexp_replace(text, f"[{other}][{_SPACES}]*| [{_SPACES}]+", " ")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    The value becomes a lambda variable, so an expression that reads it many times stays as small as
    it is written, also when the optimizer copies it into a pushed-down filter.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
