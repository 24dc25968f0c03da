"""Grid expressions in reverse Polish notation, compiled to one Column: names of columns, numbers and operators."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .algebra import compared, either

ONE = {
    "ABS": F.abs, "NEG": lambda a: -a, "SQR": lambda a: a * a, "SQRT": F.sqrt, "COS": F.cos, "SIN": F.sin, "EXP": F.exp, "LOG": F.log, "LOG2": F.log2, "LOG10": F.log10, "RINT": F.rint,
    "COSD": lambda a: F.cos(F.radians(a)), "ISNAN": lambda a: a.isNull().cast("double"),
}
TWO = {
    "ADD": lambda a, b: a + b, "SUB": lambda a, b: a - b, "MUL": lambda a, b: a * b, "DIV": lambda a, b: a / F.nullif(b, F.lit(0.0)), "POW": F.pow, "HYPOT": F.hypot, "ATAN2": F.atan2,
    "MOD": lambda a, b: F.pmod(a, b), "MIN": lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.least(a, b)), "MAX": lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b)),
    "NAN": F.nullif, "DENAN": either, "AND": either, "OR": lambda a, b: F.when(b.isNotNull(), a),
    **{op.upper(): (lambda a, b, op=op: compared(a, op, b)) for op in ("ge", "le", "gt", "lt", "eq")},
}


def compile_rpn(text: str, columns: list[str]) -> Column:
    """``"z im ADD 2 DIV"``: a Column; unknown words, missing operands and leftovers are errors."""
    stack: list[Column] = []

    def pop() -> Column:
        if not stack:
            raise ValueError(f"{text!r}: an operator lacks an operand")
        return stack.pop()

    for word in text.split():
        if word in columns:
            stack.append(F.col(word))
        elif word == "PI":
            stack.append(F.lit(math.pi))
        elif word == "DUP":
            stack += [pop()] * 2
        elif word == "IFELSE":
            no, yes, test = pop(), pop(), pop()
            stack.append(F.when(test != 0, yes).otherwise(no))
        elif word in ONE:
            stack.append(ONE[word](pop()))
        elif word in TWO:
            b, a = pop(), pop()
            stack.append(TWO[word](a, b))
        else:
            try:
                stack.append(F.lit(float(word)))
            except ValueError:
                raise ValueError(f"{text!r}: {word!r} is no column, number or operator") from None
    if len(stack) != 1:
        raise ValueError(f"{text!r}: {len(stack)} values are left")
    return stack[0]
