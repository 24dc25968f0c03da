"""Flag expressions such as ``flags.WATER and not (flags.LAND or flags.CLOUD)`` as Columns.

OR binds least, then AND, then NOT; keywords in any case; ``|``, ``&`` and ``!`` are the same operators.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\s*(?:([A-Za-z_]\w*(?:\.[A-Za-z_]\w*)?)|([()|&!]))")
_WORDS = {"or": "|", "and": "&", "not": "!"}


def tokens(text: str) -> list[str]:
    out, at = [], 0
    while at < len(text.rstrip()):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"unexpected {text[at:]!r}")
        word = m[1] or m[2]
        out.append(_WORDS.get(word.lower(), word))
        at = m.end()
    return out


def compile_flags(text: str, flags: dict[str, int], column: str = "flags") -> Column:
    """``flags`` gives each name's bit mask; a name may be qualified by its column."""
    todo = tokens(text)[::-1]

    def one() -> Column:
        if not todo:
            raise ValueError("the expression ends too early")
        t = todo.pop()
        if t == "!":
            return ~one()
        if t == "(":
            inner = level("|")
            if not todo or todo.pop() != ")":
                raise ValueError("missing )")
            return inner
        if t in ")|&":
            raise ValueError(f"unexpected {t}")
        owner, _, name = t.rpartition(".")
        return F.col(owner or column).bitwiseAND(F.lit(flags[name])) == flags[name]

    def level(op: str) -> Column:
        under = one if op == "&" else lambda: level("&")
        left = under()
        while todo and todo[-1] == op:
            todo.pop()
            right = under()
            left = left | right if op == "|" else left & right
        return left

    out = level("|")
    if todo:
        raise ValueError(f"unexpected {todo[-1]}")
    return out
