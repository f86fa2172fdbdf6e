"""Regular expressions written for RE2, matched by Java with the same result.

In RE2 the classes ``\\s \\d \\w`` and the boundary ``\\b`` are ASCII, ``$`` is the very end of the text, ``.`` excludes
only the newline, and case folding covers all of Unicode. Java differs in each of these, so patterns are rewritten
once, on the driver; the JVM then matches them inside generated code.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = "0-9A-Za-z_"
_SPACE = r"\t\n\f\r "
_BOUNDARY = f"(?:(?<=[{_WORD}])(?![{_WORD}])|(?<![{_WORD}])(?=[{_WORD}]))"
_NO_BOUNDARY = f"(?:(?<=[{_WORD}])(?=[{_WORD}])|(?<![{_WORD}])(?![{_WORD}]))"
_OUTSIDE = {"s": f"[{_SPACE}]", "S": f"[^{_SPACE}]", "d": "[0-9]", "D": "[^0-9]", "w": f"[{_WORD}]", "W": f"[^{_WORD}]", "b": _BOUNDARY, "B": _NO_BOUNDARY}
_INSIDE = {"s": _SPACE, "d": "0-9", "w": _WORD}


@cache
def to_java(pattern: str) -> str:
    """The Java form of an RE2 pattern. A leading ``(?i)`` is kept as Unicode-aware case folding."""
    flags = "d"
    if pattern.startswith("(?i)"):
        flags, pattern = "iud", pattern[4:]
    out: list[str] = []
    in_class, i = False, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            table = _INSIDE if in_class else _OUTSIDE
            out.append(table.get(pattern[i + 1], pattern[i : i + 2]))
            i += 2
            continue
        if in_class:
            # Java reads an inner bracket or a double ampersand as a set operation
            out.append("\\" + c if c in "[&" else c)
            in_class = c != "]"
        elif c == "[":
            out.append(c)
            in_class = True
            if pattern[i + 1 : i + 2] == "^":
                out.append("^")
                i += 1
            if pattern[i + 1 : i + 2] == "]":
                out.append("\\]")
                i += 1
        else:
            out.append("\\z" if c == "$" else c)
        i += 1
    return f"(?{flags})" + "".join(out)


def matches(col: Column | str, pattern: str) -> Column:
    """Partial match of an RE2 pattern; null for a null text."""
    return F.rlike(F.col(col) if isinstance(col, str) else col, F.lit(to_java(pattern)))


def sql_literal(text: str) -> str:
    """The text as a literal of standard SQL."""
    return "'" + text.replace("'", "''") + "'"
