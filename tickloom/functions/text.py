"""Text functions with 0-based positions and ``''`` (not NULL) for what is out of range."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.core import col
from tickloom.functions.dates import strftime


def _int(n: int | str | Column) -> Column:
    return F.lit(n) if isinstance(n, int) else col(n)


def length(c: str | Column) -> Column:
    return F.length(col(c)).cast("long")


def trim(c: str | Column) -> Column:
    return F.trim(col(c))


def ltrim(c: str | Column) -> Column:
    return F.ltrim(col(c))


def rtrim(c: str | Column) -> Column:
    return F.rtrim(col(c))


def lower(c: str | Column) -> Column:
    return F.lower(col(c))


def upper(c: str | Column) -> Column:
    return F.upper(col(c))


def token(c: str | Column, sep: str | Column = " ", n: int | Column = 0) -> Column:
    """The n-th piece between separators, from the end if negative."""
    sep = F.lit(sep) if isinstance(sep, str) else sep
    quoted = F.concat(F.lit("\\Q"), sep, F.lit("\\E"))
    n = _int(n)
    position = F.when(n >= 0, n + 1).otherwise(n)
    return F.coalesce(F.try_element_at(F.split(col(c), quoted), position), F.lit(""))


def get(c: str | Column, i: int | Column) -> Column:
    return substr(c, i, 1)


def substr(c: str | Column, start: int | Column, n: int | Column | None = None, rtrim: bool = False) -> Column:
    """``n`` characters from a 0-based start; a negative start counts from the end."""
    text = F.rtrim(col(c)) if rtrim else col(c)
    start, size = _int(start), F.length(text)
    first = F.when(start >= 0, start).otherwise(F.greatest(size + start, F.lit(0)))
    count = size if n is None else _int(n)
    return F.substring(text, first + 1, count)


def first(c: str | Column, n: int = 1) -> Column:
    return F.left(col(c), F.lit(n))


def last(c: str | Column, n: int = 1) -> Column:
    return F.right(col(c), F.lit(n))


def slice_(c: str | Column, start: int | Column | None = None, stop: int | Column | None = None) -> Column:
    """Python's ``text[start:stop]``."""
    size = F.length(col(c))

    def bound(b: int | Column | None, otherwise: Column) -> Column:
        if b is None:
            return otherwise
        b = _int(b)
        return F.when(b >= 0, F.least(b, size)).otherwise(F.greatest(size + b, F.lit(0)))

    low, high = bound(start, F.lit(0)), bound(stop, size)
    return F.substring(col(c), low + 1, F.greatest(high - low, F.lit(0)))


def contains(c: str | Column, sub: str | Column) -> Column:
    return F.contains(col(c), F.lit(sub) if isinstance(sub, str) else sub)


def startswith(c: str | Column, sub: str) -> Column:
    return col(c).startswith(sub)


def endswith(c: str | Column, sub: str) -> Column:
    return col(c).endswith(sub)


def find(c: str | Column, sub: str | Column, start: int = 0) -> Column:
    """0-based position of a text from ``start`` on, -1 if absent."""
    sub = F.lit(sub) if isinstance(sub, str) else sub
    return (F.position(sub, col(c), F.lit(start + 1)) - 1).cast("long")


def match(c: str | Column, pattern: str, case: bool = True) -> Column:
    return col(c).rlike(pattern if case else f"(?i){pattern}")


def _java_groups(replacement: str) -> str:
    return re.sub(r"\\(\d)", r"$\1", replacement.replace("$", r"\$"))


def regex_replace(
    c: str | Column, pattern: str, replacement: str, every: bool = False, caseless: bool = False
) -> Column:
    """Replace the first match, or every match; ``\\1`` refers to a group."""
    flag = "(?i)" if caseless else ""
    if every:
        return F.regexp_replace(col(c), f"{flag}{pattern}", _java_groups(replacement))
    # the text before the match is group 1, so the pattern's own groups move up by one
    later = lambda s: re.sub(r"(\\\\)|\\([1-9])", lambda m: m[1] or f"\\{int(m[2]) + 1}", s)
    groups = re.compile(pattern).groups
    return F.regexp_replace(
        col(c), f"{flag}^([\\s\\S]*?)(?:{later(pattern)})([\\s\\S]*)$", "$1" + _java_groups(later(replacement)) + f"${groups + 2}"
    )


def extract(c: str | Column, pattern: str, rewrite: str = r"\0", caseless: bool = False) -> Column:
    """The first match, rewritten: ``\\1`` a group, ``\\u1`` and ``\\l1`` in upper and lower case."""
    p = f"(?i){pattern}" if caseless else pattern
    pieces = []
    for literal, case, group in re.findall(r"([^\\]+)|\\([ul]?)(\d)", rewrite):
        if literal:
            pieces.append(F.lit(literal))
        else:
            got = F.regexp_extract(col(c), p, int(group))
            pieces.append({"u": F.upper, "l": F.lower}.get(case, lambda x: x)(got))
    return F.when(col(c).rlike(p), F.concat(*pieces)).otherwise(F.lit(""))


def like(c: str | Column, pattern: str) -> Column:
    return col(c).like(pattern)


def ilike(c: str | Column, pattern: str) -> Column:
    return col(c).ilike(pattern)


def replace(c: str | Column, old: str, new: str) -> Column:
    return F.replace(col(c), F.lit(old), F.lit(new))


def repeat(c: str | Column, n: int | Column) -> Column:
    return F.repeat(col(c), n)


def concat(*parts: str | Column) -> Column:
    return F.concat(*[col(p).cast("string") for p in parts])


def insert(c: str | Column, start: int, n: int, value: str | Column) -> Column:
    """Put ``value`` in place of ``n`` characters from the 1-based position ``start``."""
    return F.overlay(col(c), F.lit(value) if isinstance(value, str) else value, F.lit(start), F.lit(n))


def format_(line: str, *args: Column, **kwargs: Column) -> Column:
    """``'{} {0} {name} {:.2f} {:%Y-%m-%d}'`` over columns."""
    pieces, auto = [], 0
    for literal, field in re.findall(r"([^{}]+)|\{([^{}]*)\}", line):
        if literal:
            pieces.append(F.lit(literal))
            continue
        name, _, spec = field.partition(":")
        if name == "":
            value, auto = args[auto], auto + 1
        else:
            value = args[int(name)] if name.isdigit() else kwargs[name]
        if spec.endswith("f"):
            pieces.append(F.format_string(f"%{spec}", value.cast("double")))
        elif spec:
            pieces.append(strftime(value, spec))
        else:
            pieces.append(value.cast("string"))
    return reduce(lambda a, b: F.concat(a, b), pieces, F.lit(""))
