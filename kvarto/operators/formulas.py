"""Small formulas given as text, compiled to column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_PART = re.compile(r"\s*(?:(\d+(?:\.\d+)?)|([A-Za-zÅÄÖåäö_]\w*)|(//|[-+*/()]))")
_FUNCTIONS = {"ceil": F.ceil, "floor": F.floor}


def compile_formula(text: str, values: dict[str, Column]) -> Column:
    """The value of names, numbers, + - * / //, ceil() and floor(); null if a name has no column or a value is null, or on division by 0.

    Anything else in the formula is an error. Nothing of the text reaches the SQL parser.
    """
    parts, at = [], 0
    while at < len(text.rstrip()):
        m = _PART.match(text, at)
        if not m:
            raise ValueError(f"not a formula: {text!r}")
        parts.append(m.groups())
        at = m.end()
    place = 0

    def peek() -> str | None:
        return parts[place][2] if place < len(parts) else None

    def take(sign: str) -> None:
        nonlocal place
        if peek() != sign:
            raise ValueError(f"{sign!r} expected: {text!r}")
        place += 1

    def atom() -> Column:
        nonlocal place
        if place >= len(parts):
            raise ValueError(f"the formula ends too early: {text!r}")
        number, name, sign = parts[place]
        place += 1
        if number:
            return F.lit(float(number))
        if name:
            if peek() == "(":
                if name not in _FUNCTIONS:
                    raise ValueError(f"unknown function {name}: {text!r}")
                take("(")
                inner = total()
                take(")")
                return _FUNCTIONS[name](inner).cast("double")
            return values[name].cast("double") if name in values else F.lit(None).cast("double")
        if sign == "-":
            return -atom()
        if sign == "(":
            inner = total()
            take(")")
            return inner
        raise ValueError(f"not a formula: {text!r}")

    def product() -> Column:
        nonlocal place
        out = atom()
        while peek() in ("*", "/", "//"):
            sign = peek()
            place += 1
            right = atom()
            out = out * right if sign == "*" else F.try_divide(out, right) if sign == "/" else F.floor(F.try_divide(out, right)).cast("double")
        return out

    def total() -> Column:
        nonlocal place
        out = product()
        while peek() in ("+", "-"):
            sign = peek()
            place += 1
            out = out + product() if sign == "+" else out - product()
        return out

    result = total()
    if place != len(parts):
        raise ValueError(f"not a formula: {text!r}")
    return result
